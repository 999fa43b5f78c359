"""Message bodies: transfer decoding and the search through a part tree."""

from __future__ import annotations

import base64
import json
import re

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from mailflow import values
from mailflow.functions.arrays import let

# Part trees up to this depth are searched by column expressions alone; deeper
# ones go to ``_deep_body``.
TREE_DEPTH = 3

_PLAIN = str.maketrans("-_", "+/", "\r\n")
_BASE64 = re.compile("[A-Za-z0-9+/]*")


def decode_base64url(data: Column) -> Column:
    """URL-safe base64 to text, padded and in lines or not; NULL where it does
    not decode."""

    def decoded(plain: Column) -> Column:
        padded = F.concat(plain, F.repeat(F.lit("="), (4 - F.length(plain) % 4) % 4))
        legal = plain.rlike("^[A-Za-z0-9+/]*$") & (F.length(plain) % 4 != 1)
        binary = F.try_to_binary(F.when(legal, padded), F.lit("base64"))
        return F.try_validate_utf8(binary.cast("string"))

    return let(F.rtrim(F.translate(data, "-_\r\n", "+/"), F.lit("=")), decoded)


def _parts(node: Column) -> Column:
    return F.try_variant_get(node, "$.parts", "array<variant>")


def _leaves(parts: Column, depth: int) -> Column:
    """Parts below ``parts`` in depth-first order as (mime, data)."""

    def visit(part: Column) -> Column:
        own = F.array(
            F.struct(
                F.try_variant_get(part, "$.mimeType", "string").alias("mime"),
                F.try_variant_get(part, "$.body.data", "string").alias("data"),
            )
        )
        if depth == 1:
            return own
        below = F.when(_parts(part).isNotNull(), _leaves(_parts(part), depth - 1))
        return F.concat(own, F.coalesce(below, F.slice(own, 1, 0)))

    return F.flatten(F.transform(parts, visit))


def _deeper(parts: Column, depth: int) -> Column:
    """True when some part at the last searched level has parts of its own."""
    if depth == 1:
        return F.exists(parts, lambda p: _parts(p).isNotNull())
    return F.exists(
        parts, lambda p: F.coalesce(_deeper(_parts(p), depth - 1), F.lit(False))
    )


def _decoded(data: str) -> str:
    """As ``decode_base64url``; a marker where it does not decode."""
    plain = data.translate(_PLAIN).rstrip("=")
    if len(plain) % 4 == 1 or not _BASE64.fullmatch(plain):
        return values.BAD_CONTENT
    return base64.b64decode(plain + "=" * (-len(plain) % 4)).decode("utf-8")


def _parts_of(node) -> list:
    parts = node.get("parts") if isinstance(node, dict) else None
    return parts if isinstance(parts, list) else []


def _text_data(node) -> str | None:
    """Data of a text/plain part, read as the column expressions read it."""
    body = node.get("body")
    data = body.get("data") if isinstance(body, dict) else None
    if node.get("mimeType") != "text/plain" or data is None:
        return None
    return data if isinstance(data, str) else json.dumps(data, separators=(",", ":"))


@F.pandas_udf(T.StringType())
def _deep_body(payloads: pd.Series) -> pd.Series:
    """First text/plain part of trees deeper than the column expressions go."""

    def first_plain(text):
        if text is None:
            return None
        try:
            stack = _parts_of(json.loads(text))[::-1]
            while stack:
                node = stack.pop()
                if not isinstance(node, dict):
                    continue
                data = _text_data(node)
                if data is not None:
                    return _decoded(data)
                stack.extend(reversed(_parts_of(node)))
        except Exception:  # one bad message must not stop the batch
            return values.BAD_CONTENT
        return values.NO_CONTENT

    return payloads.map(first_plain)


def extract_body(payload: Column) -> Column:
    """Text of a message payload: its first text/plain part, depth first, else
    its own body, else a marker.  Data is URL-safe base64."""
    parts = _parts(payload)
    plain = F.filter(
        _leaves(parts, TREE_DEPTH),
        lambda leaf: (leaf["mime"] == "text/plain") & leaf["data"].isNotNull(),
    )
    own = F.try_variant_get(payload, "$.body.data", "string")
    found = F.when(parts.isNotNull(), F.get(plain, F.lit(0))["data"]).otherwise(
        F.nullif(own, F.lit(""))
    )
    shallow = let(
        found,
        lambda data: F.when(data.isNull(), values.NO_CONTENT).otherwise(
            F.coalesce(decode_base64url(data), F.lit(values.BAD_CONTENT))
        ),
    )
    deep = F.when(F.coalesce(_deeper(parts, TREE_DEPTH), F.lit(False)), F.to_json(payload))
    return F.coalesce(_deep_body(deep), shallow)
