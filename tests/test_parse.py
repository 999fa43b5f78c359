"""Edge cases of parsing, on files with our own text."""

import base64
import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from mailflow import values
from mailflow.functions import payload
from mailflow.operators import parse, quality
from mailflow.sources import files, landing

API = {
    "email_type": "gmail_api",
    "payload": {
        "headers": [
            {"name": "FROM", "value": "Ann Lee <ann@example.com>"},
            {"name": "From", "value": "second@example.com"},
            {"name": "To", "value": "a@example.com , b@example.com,c@example.com"},
            {"name": "Subject", "value": ""},
        ],
        "parts": [{"body": {"data": "hello there"}}],
    },
    "internalDate": "1700000000123",
}


def parsed(spark, text, **options):
    raw = spark.createDataFrame([("f", text)], "file_id string, file_text string")
    return parse.parse_mail(raw, **options).first()


def test_first_header_wins_in_any_case(spark):
    mail = parsed(spark, json.dumps(API))
    assert mail.sender_email == "Ann Lee <ann@example.com>"
    assert mail.recipient_emails == ["a@example.com", "b@example.com", "c@example.com"]
    assert mail.subject == ""
    assert mail.email_date == datetime(2023, 11, 14, 22, 13, 20, 123000)


def test_no_headers_and_no_recipients(spark):
    mail = parsed(spark, '{"payload": {"body": {"data": "text"}}}')
    assert (mail.email_format, mail.sender_email, mail.subject) == (values.API, None, None)
    assert mail.recipient_emails == [] and mail.email_body == "text"


@pytest.mark.parametrize(
    "date, expected",
    [
        ("2024-05-06T07:08:09Z", datetime(2024, 5, 6, 7, 8, 9)),
        ("soon", datetime(2024, 3, 5, 13, 7)),
        (None, datetime(2024, 3, 5, 13, 7)),
    ],
)
def test_date_falls_back_to_the_header(spark, date, expected):
    headers = [{"name": "Date", "value": "Tue, 5 Mar 2024 14:07:00 +0100 (CET)"}]
    mail = parsed(spark, json.dumps({"payload": {"headers": headers}, "internalDate": date}))
    assert mail.email_date == expected


def test_named_zone_in_date_header(spark):
    df = spark.createDataFrame([("Tue, 05 Mar 2024 14:07:00 GMT",)], "d string")
    assert df.select(payload.header_time(F.col("d"))).first()[0] == datetime(2024, 3, 5, 14, 7)


@pytest.mark.parametrize("text, error", [
    ('{"email_text": ', parse.BAD_JSON), ("", parse.NO_FILE), (None, parse.NO_FILE),
])
def test_unreadable_content_fails_alone(spark, text, error):
    mail = parsed(spark, text)
    assert (mail.status, mail.error_message, mail.email_body) == (values.FAILED, error, None)
    assert mail.email_format is None


def test_json_null_counts_as_absent(spark):
    mail = parsed(spark, '{"payload": null, "email_type": null, "email_text": "x", "sender": null}')
    assert (mail.email_format, mail.email_body, mail.sender_email) == (values.SIMPLE, "x", None)


def test_declared_type_wins_over_fields(spark):
    mail = parsed(spark, '{"email_type": "marketing", "email_text": "buy", "payload": {}}')
    assert (mail.email_format, mail.email_classification) == (values.MARKETING, "MARKETING")


def test_marketing_without_body(spark):
    mail = parsed(spark, '{"email_type": "marketing", "sender": "m@example.com"}')
    assert mail.email_body is None and mail.email_classification == "MARKETING"


def test_unrecognised_type_is_routed_by_fields(spark):
    assert parsed(spark, '{"email_type": "other", "raw_text": "t"}').email_format == values.RAW_TEXT


def test_unknown_document_is_kept_whole(spark):
    text = '{ "b": 1, "a": [1, 2] }'
    mail = parsed(spark, text)
    assert (mail.email_format, mail.email_body, mail.status) == (values.UNKNOWN, text, values.COMPLETED)


def test_flat_row_needs_the_option(spark):
    text = '{"id": "7", "body": "b", "timestamp": "1700000000000"}'
    assert parsed(spark, text).email_format == values.UNKNOWN
    mail = parsed(spark, text, flat=True)
    assert (mail.email_format, mail.sender_email, mail.subject) == (
        values.FLAT, values.DEFAULT_SENDER, values.DEFAULT_SUBJECT,
    )


def test_exchange_without_recipient(spark):
    mail = parsed(spark, '{"MessageClass": "IPM.Note", "Body": "b", "DateTimeReceived": "2024-01-02 03:04:05"}')
    assert mail.recipient_emails == [] and mail.email_date == datetime(2024, 1, 2, 3, 4, 5)


def test_wrong_types_do_not_fail(spark):
    mail = parsed(
        spark,
        '{"email_type": "simple_format", "sender": 5, "recipients": "x@example.com, y@example.com",'
        ' "email_date": {"a": 1}, "attachments": "none"}',
    )
    assert mail.sender_email == "5" and mail.recipient_emails == ["x@example.com", "y@example.com"]
    assert mail.email_date is None and mail.attachments is None and mail.status == values.COMPLETED


def b64(text, pad):
    coded = base64.urlsafe_b64encode(text.encode()).decode()
    return coded if pad else coded.rstrip("=")


@pytest.mark.parametrize("pad", [True, False])
@pytest.mark.parametrize("text", ["hi", "héllo wörld", "a?b>c~~", ""])
def test_base64url_round_trip(spark, text, pad):
    content = json.dumps({"payload": {"parts": [{"body": {"data": b64(text, pad)}}]}})
    assert parsed(spark, content, decode="base64url").email_body == text


@pytest.mark.parametrize("data", ["plain words here", "____", "A"])
def test_undecodable_body_is_kept(spark, data):
    content = json.dumps({"payload": {"parts": [{"body": {"data": data}}]}})
    assert parsed(spark, content, decode="base64url").email_body == data


def leaf(mime, text):
    return {"mimeType": mime, "body": {"data": b64(text, False)}}


def nest(node, levels):
    for _ in range(levels):
        node = {"mimeType": "multipart/mixed", "parts": [leaf("text/html", "<p>"), node]}
    return node


@pytest.mark.parametrize("levels", range(1, 9))
def test_first_text_part_at_any_depth(spark, levels):
    tree = nest(leaf("text/plain", f"level {levels}"), levels)
    raw = spark.createDataFrame([("f", json.dumps({"payload": tree}))], "file_id string, file_text string")
    assert parse.extract_body(raw).first().body == f"level {levels}"


def test_empty_branch_does_not_hide_later_siblings(spark):
    tree = {"parts": [{"parts": [leaf("text/html", "x")]}, leaf("text/plain", "found"), leaf("text/plain", "no")]}
    raw = spark.createDataFrame([("f", json.dumps({"payload": tree}))], "file_id string, file_text string")
    assert parse.extract_body(raw).first().body == "found"


@pytest.mark.parametrize("message, expected", [
    ({"parts": [{"mimeType": "text/html"}]}, values.NO_CONTENT),
    ({"body": {}}, values.NO_CONTENT),
    ({"body": {"data": b64("single", True)}}, "single"),
    ({"parts": [{"mimeType": "text/plain", "body": {"data": "???"}}]}, values.BAD_CONTENT),
])
def test_body_markers(spark, message, expected):
    raw = spark.createDataFrame([("f", json.dumps({"payload": message}))], "file_id string, file_text string")
    assert parse.extract_body(raw).first().body == expected


@pytest.mark.parametrize("levels", [1, 6])
@pytest.mark.parametrize("part, expected", [
    ({"mimeType": "text/plain", "body": {"data": "????"}}, values.BAD_CONTENT),
    ({"mimeType": "text/plain", "body": {"data": "aGk!"}}, values.BAD_CONTENT),
    ({"mimeType": "text/plain", "body": {"data": "_w"}}, values.BAD_CONTENT),
    ({"mimeType": "text/plain", "body": {"data": "aG\nk="}}, "hi"),
    ({"mimeType": "text/plain", "body": "str"}, values.NO_CONTENT),
    ({"mimeType": "text/plain", "body": {"data": None}, "parts": 7}, values.NO_CONTENT),
    ("no object", values.NO_CONTENT),
])
def test_a_part_reads_the_same_at_any_depth(spark, levels, part, expected):
    tree = nest(part, levels)
    raw = spark.createDataFrame([("f", json.dumps({"payload": tree}))], "file_id string, file_text string")
    assert parse.extract_body(raw).first().body == expected


def test_only_whole_arrays_are_split(spark):
    texts = ["[]", '[{"email_text": "a"}] behind', '[{"email_text": "a"}, {', '[{"email_text": "a"}]']
    raw = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "file_id string, file_text string")
    rows = parse.parse_mail(files.explode_mail_batch(raw.withColumn("file_content", payload.parse_whole(F.col("file_text")))))
    found = {(r.file_id, r.email_body, r.status) for r in rows.collect()}
    assert found == {("f0", None, "FAILED"), ("f1", None, "FAILED"), ("f2", None, "FAILED"), ("f3#0", "a", "COMPLETED")}


@pytest.mark.parametrize("text, whole", [
    ('{"a": 1}', True), (' [1, 2]\n', True), ("null", True), ('{"a": 1} behind', False), ('{"a": 1}\n{"a": 2}', False),
    ("1, 2", False), ("1], [2", False), ("", False), ("{oops", False),
])
def test_only_whole_texts_are_json(spark, text, whole):
    df = spark.createDataFrame([(text,)], "t string").select(payload.parse_whole(F.col("t")).isNotNull())
    assert df.first()[0] is whole


def test_times_name_their_day(spark):
    df = spark.createDataFrame([("12:30",), ("2024-03-05T12:30:00",)], "t string").select(payload.iso_time(F.col("t")))
    assert [r[0] for r in df.collect()] == [None, datetime(2024, 3, 5, 12, 30)]
    df = spark.createDataFrame([("Tue, 5 Mar 2024 14:07 +0000",)], "d string")
    assert df.select(payload.header_time(F.col("d"))).first()[0] == datetime(2024, 3, 5, 14, 7)


def test_text_parts_are_read_in_their_charset(spark):
    mail = "From: a@b.c\r\nContent-Type: text/plain; charset=ISO-8859-1\r\n\r\ncafé".encode("latin-1")
    raw = spark.createDataFrame([("m", bytearray(mail))], "message_id string, content binary")
    assert files.parse_rfc822(raw).first().body == "café"


def test_files_and_arrays(spark, tmp_path):
    (tmp_path / "two.json").write_text('[{"email_text": "one"}, {"raw_text": "two"}]')
    (tmp_path / "one.json").write_text('{"email_text": "three"}')
    (tmp_path / "bad.json").write_text("{oops")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "note.txt").write_text("line 1\nline 2 \"quoted\"")
    raw = files.read_json_mail(spark, str(tmp_path), "*.json")
    exploded = files.explode_mail_batch(raw)
    assert exploded.select("file_id").distinct().count() == exploded.count() == 4
    rows = parse.parse_mail(exploded, keep=["file_name"]).collect()
    bodies = {(r.file_name, r.email_body, r.status) for r in rows}
    assert bodies == {
        ("two.json", "one", "COMPLETED"), ("two.json", "two", "COMPLETED"),
        ("one.json", "three", "COMPLETED"), ("bad.json", None, "FAILED"),
    }
    note = parse.parse_mail(files.read_text_mail(spark, str(tmp_path), "*.txt")).first()
    assert (note.email_format, note.email_body) == (values.RAW_TEXT, 'line 1\nline 2 "quoted"')


def test_rfc822_files(spark, tmp_path):
    (tmp_path / "a.eml").write_bytes(
        b"From: =?utf-8?q?J=C3=BCrgen?= <j@example.com>\r\nSubject: Hi\r\n"
        b"Date: Tue, 5 Mar 2024 14:07:00 +0000\r\nMIME-Version: 1.0\r\n"
        b'Content-Type: multipart/mixed; boundary="b"\r\n\r\n'
        b"--b\r\nContent-Type: text/html\r\n\r\n<p>x</p>\r\n"
        b"--b\r\nContent-Type: text/plain; charset=utf-8\r\n\r\nplain \xff text\r\n--b--\r\n"
    )
    (tmp_path / "b.eml").write_bytes(b"just text without any header\r\n")
    rows = {r.message_id[-5:]: r for r in files.parse_rfc822(files.read_rfc822(spark, str(tmp_path))).collect()}
    assert rows["a.eml"].sender == "Jürgen <j@example.com>"
    assert rows["a.eml"].body.strip() == "plain  text"
    assert rows["a.eml"].email_date == datetime(2024, 3, 5, 14, 7)
    assert (rows["b.eml"].sender, rows["b.eml"].subject) == ("unknown", "No Subject")


def test_header_map_keeps_the_last(spark):
    headers = [{"name": n, "value": v} for n, v in [("A", "1"), ("B", "2"), ("A", "3"), ("C", None)]]
    raw = spark.createDataFrame(
        [("f", json.dumps({"payload": {"headers": headers}})), ("g", "{}")], "file_id string, file_text string"
    )
    maps = {r.file_id: r.headers for r in parse.headers_map(raw).collect()}
    assert maps == {"f": {"A": "3", "B": "2", "C": None}, "g": None}


@pytest.mark.parametrize("body, ok", [("x" * 9, False), ("x" * 10, True)])
def test_validation_limits(spark, body, ok):
    mails = spark.createDataFrame(
        [("a@example.com", "s", body, datetime(2024, 1, 1)), ("a@example", "", None, None)],
        "sender_email string, subject string, email_body string, email_date timestamp_ntz",
    )
    first, second = quality.validate_mail(mails).collect()
    assert (first.validation_result == values.VALIDATION_PASSED) is ok
    assert (first.validation_errors == []) is ok
    assert second.validation_errors == values.VALIDATION_RULES


def test_parse_is_one_projection(spark, sf):
    from mailflow.catalog import testbed as tb

    raw = tb.table(spark, sf, "documents").selectExpr("string(doc_id) AS file_id", "text AS file_text")
    plan = parse.parse_mail(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "EvalPython" not in plan


mail_text = st.text(st.characters(blacklist_categories=("Cs",)), max_size=80)
addresses = st.lists(st.from_regex(r"[a-z]{1,8}@[a-z]{1,8}\.org", fullmatch=True), min_size=1, max_size=3)
mails = st.lists(st.tuples(mail_text, mail_text, addresses), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(mails)
def test_parse_undoes_compose(spark, batch):
    def payloads(subject, body, to):
        headers = [{"name": "To", "value": ", ".join(to)}, {"name": "Subject", "value": subject}]
        coded = base64.urlsafe_b64encode(body.encode()).decode()
        yield {"payload": {"headers": headers, "parts": [{"body": {"data": coded}}]}}
        yield {"email_type": "simple_format", "recipients": to, "subject": subject, "email_text": body}
        yield {"email_type": "marketing", "recipients": to, "subject": subject, "email_text": body}

    rows = [(f"{i}-{k}", json.dumps(p)) for i, m in enumerate(batch) for k, p in enumerate(payloads(*m))]
    raw = spark.createDataFrame(rows, "file_id string, file_text string")
    got = {r.file_id: r for r in parse.parse_mail(raw, decode="base64url").collect()}
    for i, (subject, body, to) in enumerate(batch):
        for k in range(3):
            mail = got[f"{i}-{k}"]
            assert (mail.subject, mail.email_body, mail.recipient_emails) == (subject, body, to)


def test_landed_unknown_documents_keep_their_text(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", '{ "z": 1, "b": 2 }'), ("b", '{"raw_text": "t"}'), ("c", "{")], "file_name string, file_text string"
    )
    table = landing.land_raw(rows, str(tmp_path / "raw"), as_of=datetime(2024, 1, 1))
    mails = {r.file_name: r.email_body for r in parse.parse_mail(table, keep=["file_name"]).collect()}
    assert mails == {"a": '{ "z": 1, "b": 2 }', "b": "t", "c": None}
