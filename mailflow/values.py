"""Fixed values.

The names, labels, patterns and messages below are part of the mail data
format or of the results users filter on, so they are stated literally.
"""

# Payload tags found in ``email_type`` and used as route names.
API = "gmail_api"
SIMPLE = "simple_format"
MARKETING = "marketing"
EXCHANGE = "exchange"
RAW_TEXT = "raw_text"
FLAT = "flat"
UNKNOWN = "unknown"
TAGGED_FORMATS = [API, SIMPLE, MARKETING]

# Labels the statistics views use for untagged payloads.
LABEL_EXCHANGE = "outlook_exchange"
LABEL_SIMPLE = "simple_text"

# File states.
PENDING = "PENDING"
COMPLETED = "COMPLETED"
FAILED = "FAILED"

# Job states and job types.
RUNNING = "RUNNING"
PARTIAL_FAILURE = "PARTIAL_FAILURE"
JOB_BATCH = "BATCH_PROCESSING"
JOB_SUMMARIZATION = "SUMMARIZATION"
JOB_REALTIME = "REALTIME_PROCESSING"
JOB_REALTIME_AI = "REALTIME_AI_ANALYSIS"
JOB_URGENT = "URGENT_ALERT"
JOB_HEALTH = "HEALTH_CHECK"
JOB_MAINTENANCE = "SIMPLE_MAINTENANCE"
JOB_FORMATS = "FORMAT_ANALYSIS"

# Summary types.
BRIEF = "BRIEF"
DETAILED = "DETAILED"
ACTION_ITEMS = "ACTION_ITEMS"
SENTIMENT = "SENTIMENT"
SUMMARY_TYPES = [BRIEF, DETAILED, ACTION_ITEMS, SENTIMENT]

# Classes a mail can get, in tie order.
CLASSES = [
    "URGENT",
    "INFORMATIONAL",
    "ACTION_REQUIRED",
    "MEETING_REQUEST",
    "MARKETING",
    "SUPPORT",
    "PERSONAL",
    "OTHER",
]

# Address rule and validation messages, in rule order.
ADDRESS_PATTERN = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}$"
INVALID_SENDER = "Invalid sender email format"
MISSING_SUBJECT = "Missing email subject"
SHORT_BODY = "Email body too short or missing"
MISSING_DATE = "Missing email date"
VALIDATION_RULES = [INVALID_SENDER, MISSING_SUBJECT, SHORT_BODY, MISSING_DATE]
VALIDATION_PASSED = "Email validation passed"
VALIDATION_FAILED = "Email validation failed: "
MIN_BODY_CHARS = 10

# Urgent words (substring, case-insensitive) and the indicator codes.
URGENT_PATTERNS = ["%urgent%", "%asap%", "%critical%", "%emergency%", "%immediate%"]
SUBJECT_INDICATORS = [
    ("%urgent%", "URGENT_SUBJECT"),
    ("%asap%", "ASAP_SUBJECT"),
    ("%critical%", "CRITICAL_SUBJECT"),
]
BODY_INDICATORS = [
    ("%immediately%", "IMMEDIATE_CONTENT"),
    ("%emergency%", "EMERGENCY_CONTENT"),
]

# Health labels, stage names and error categories, in display order.
ACTIVE = "ACTIVE"
IDLE = "IDLE"
ISSUES = "ISSUES_DETECTED"
STAGE_FILES = "Files in S3 Stage"
STAGE_MAILS = "Emails Processed"
STAGE_SUMMARIES = "AI Summaries Ready"
ERRORS_FILES = "File Processing"
ERRORS_JOBS = "Job Processing"
UNKNOWN_ERROR = "Unknown error"

# Defaults and markers.
DEFAULT_SENDER = "unknown@unknown.com"
DEFAULT_SUBJECT = "No Subject"
NO_CONTENT = "No readable content found"
BAD_CONTENT = "Content extraction failed"
NO_ACTION_ITEMS = "No action items found."
METRIC_COUNT = "GMAIL_FETCH_COUNT"
METRIC_LATENCY = "GMAIL_FETCH_LATENCY"

# Keyword filters, caps and thresholds.
INCLUDE_KEYWORDS = ["meeting", "urgent", "action", "deadline", "project", "client", "demo"]
EXCLUDE_KEYWORDS = ["newsletter", "unsubscribe", "marketing", "promotional"]
FILTER_DAYS = 7
BODY_CAP = 50000
CLASSIFY_CAP = 500
MAX_LATENCY_SECONDS = 300
MAX_ERROR_PERCENT = 5
MAX_QUEUE_DEPTH = 100
PARSE_BATCH = 50
ENRICH_BATCH = 10
KEEP_JOB_DAYS = 30
