"""Reading mail payloads held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from mailflow import schemas, values
from mailflow.functions.arrays import let

END = "end of the text"


def parse_whole(text: Column) -> Column:
    """JSON text as a VARIANT; NULL unless the whole text is one JSON value.

    The parser by itself stops after the first value, so the text is parsed as the
    first of two elements, of which the second must be found in its place.
    """

    def first(pair: Column) -> Column:
        ended = F.try_variant_get(pair, "$[1]", "string") == F.lit(END)
        more = F.try_variant_get(pair, "$[2]", "variant").isNotNull()
        return F.when(ended & ~more, F.try_variant_get(pair, "$[0]", "variant"))

    return let(F.try_parse_json(F.concat(F.lit("["), text, F.lit(f', "{END}"]'))), first)


def text_at(content: Column, path: str) -> Column:
    return F.try_variant_get(content, path, "string")


def present(content: Column, path: str) -> Column:
    """True when the path holds something other than JSON null."""
    found = F.try_variant_get(content, path, "variant")
    return found.isNotNull() & ~F.is_variant_null(found)


def route_format(content: Column, flat: bool = False) -> Column:
    """Which parser a payload goes to.

    A recognised ``email_type`` decides; otherwise the fields present decide,
    in a fixed order.  With ``flat`` rows that look like a flat API row (an id
    and a body at top level) get their own route instead of ``unknown``.
    """
    tag = text_at(content, "$.email_type")
    route = (
        F.when(tag.isin(values.TAGGED_FORMATS), tag)
        .when(present(content, "$.payload"), values.API)
        .when(present(content, "$.email_text"), values.SIMPLE)
        .when(present(content, "$.MessageClass"), values.EXCHANGE)
        .when(present(content, "$.raw_text"), values.RAW_TEXT)
    )
    if flat:
        route = route.when(
            present(content, "$.id")
            & (present(content, "$.body") | present(content, "$.subject")),
            values.FLAT,
        )
    return F.when(content.isNotNull(), route.otherwise(values.UNKNOWN))


def format_label(content: Column) -> Column:
    """Label used by the statistics: any declared type passes through."""
    tag = text_at(content, "$.email_type")
    return (
        F.when(tag.isNotNull(), tag)
        .when(present(content, "$.payload"), values.API)
        .when(present(content, "$.MessageClass"), values.LABEL_EXCHANGE)
        .when(present(content, "$.email_text"), values.LABEL_SIMPLE)
        .when(present(content, "$.raw_text"), values.RAW_TEXT)
        .otherwise(values.UNKNOWN)
    )


def headers_at(content: Column, path: str = "$.payload.headers") -> Column:
    return F.try_variant_get(content, path, schemas.HEADERS)


def header(headers: Column, name: str) -> Column:
    """Value of the first header with this name, in any letter case."""
    same = F.filter(headers, lambda h: F.lower(h["name"]) == F.lit(name.lower()))
    return F.get(same, F.lit(0))["value"]


def headers_map(headers: Column) -> Column:
    """Header list as a map; of headers with the same name the last one wins.

    Header lists are short (tens of entries), so each one is looked for among
    those after it.
    """
    numbered = F.transform(headers, lambda h, i: F.struct(i.alias("i"), h.alias("h")))
    last = F.filter(
        numbered,
        lambda x: ~F.exists(
            headers_after(headers, x["i"]), lambda y: y["name"] == x["h"]["name"]
        )
        & x["h"]["name"].isNotNull(),
    )
    return F.map_from_entries(
        F.transform(last, lambda x: F.struct(x["h"]["name"], x["h"]["value"]))
    )


def headers_after(headers: Column, position: Column) -> Column:
    return F.slice(headers, position + 2, F.greatest(F.size(headers), F.lit(1)))


def address_list(text: Column) -> Column:
    """Comma-separated addresses as an array; nothing gives an empty array."""
    return F.coalesce(
        F.filter(F.split(F.trim(text), r"\s*,\s*"), lambda a: a != ""),
        F.array().cast("array<string>"),
    )


def bare_address(sender: Column) -> Column:
    """``Name <addr>`` without the name."""
    inner = F.regexp_extract(sender, "<([^<>]*)>", 1)
    return F.trim(F.when(inner != "", inner).otherwise(sender))


def domain_of(sender: Column) -> Column:
    return F.lower(F.substring_index(bare_address(sender), "@", -1))


def epoch_millis(text: Column) -> Column:
    """Epoch milliseconds as a zone-less UTC time."""
    millis = text.try_cast("bigint")
    return F.timestamp_add("MILLISECOND", millis, F.lit("1970-01-01").cast("timestamp_ntz"))


def iso_time(text: Column) -> Column:
    """ISO time that names its day; a bare time of day would depend on today."""
    dated = F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), text)
    return dated.try_cast("timestamp").cast("timestamp_ntz")


def header_time(text: Column) -> Column:
    """Mail ``Date`` header: day, month name, year, time (seconds or not) and zone."""
    plain = F.regexp_replace(
        F.regexp_replace(text, "^ *[A-Za-z]{3}, *", ""), r" *\([^)]*\) *$", ""
    )
    forms = [f"d MMM yyyy {clock} {zone}" for clock in ("HH:mm:ss", "HH:mm") for zone in "Zz"]
    read = [F.try_to_timestamp(plain, F.lit(form)) for form in forms]
    return F.coalesce(*read).cast("timestamp_ntz")
