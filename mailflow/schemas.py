"""Table schemas of the mail store, as DDL text."""

HEADERS = "array<struct<name:string,value:string>>"
RECIPIENTS = "array<string>"
ATTACHMENTS = "array<struct<name:string,size:bigint>>"
ENTITY_KINDS = [
    "people",
    "companies",
    "dates",
    "locations",
    "amounts",
    "phone_numbers",
    "email_addresses",
]
ENTITIES = "struct<" + ",".join(f"{k}:array<string>" for k in ENTITY_KINDS) + ">"

RAW_EMAIL_FILES = (
    "file_id string, file_name string, file_path string, file_size bigint,"
    " upload_timestamp timestamp_ntz, file_content variant, file_text string,"
    " processing_status string, error_message string"
)

PROCESSED_EMAILS = (
    "email_id string, file_id string, sender_email string,"
    f" recipient_emails {RECIPIENTS}, subject string, email_body string,"
    f" email_date timestamp_ntz, attachments {ATTACHMENTS},"
    " extracted_timestamp timestamp_ntz, email_classification string,"
    f" extracted_entities {ENTITIES}, priority_score double,"
    " validation_errors array<string>"
)

EMAIL_SUMMARIES = (
    "summary_id string, email_id string, summary_type string,"
    " summary_text string, confidence_score double,"
    " created_timestamp timestamp_ntz, model_used string"
)

PROCESSING_JOBS = (
    "job_id string, job_type string, start_time timestamp_ntz,"
    " end_time timestamp_ntz, status string, files_processed bigint,"
    " files_failed bigint, error_details string"
)
