"""P3 strict base64 decoding with the reference's failure reasons, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, is_blank

# Failure reasons of certificate-data decoding.
ERR_DATA_EMPTY = "certificate data is empty"
ERR_BAD_BASE64 = "failed to decode base64 certificate data"
ERR_DECODED_EMPTY = "decoded certificate data is empty"

# Standard alphabet, '=' only as 0-2 trailing pad characters; length checked separately
# (a character-class loop, unlike a repeated group, does not recurse in Java's regex engine).
B64_SHAPE = r"^[A-Za-z0-9+/]*={0,2}\z"


def strip_crlf(c) -> Column:
    """The standard decoder ignores CR and LF anywhere in the input; nothing else.
    (A byte search guards the regular expression: most values hold no line break.)"""
    c = col_(c)
    return F.when(c.contains("\r") | c.contains("\n"), F.regexp_replace(c, r"[\r\n]", "")).otherwise(c)


def base64_valid(c, lenient: bool = False) -> Column:
    s = strip_crlf(c)
    if lenient:
        s = F.regexp_replace(s, r"[ \t]", "")
    return s.rlike(B64_SHAPE) & (F.length(s) % 4 == 0)


def decode_base64_strict(c, lenient: bool = False) -> Column:
    """Decoded BINARY, or null when the input is not canonical padded base64."""
    s = strip_crlf(c)
    if lenient:
        s = F.regexp_replace(s, r"[ \t]", "")
    return F.when(base64_valid(c, lenient), F.unbase64(s))


def base64_error(c, lenient: bool = False) -> Column:
    """Reason string, null when the data decodes to a non-empty byte string."""
    decoded = decode_base64_strict(c, lenient)
    return (
        F.when(is_blank(c), F.lit(ERR_DATA_EMPTY))
        .when(decoded.isNull(), F.lit(ERR_BAD_BASE64))
        .when(F.length(decoded) == 0, F.lit(ERR_DECODED_EMPTY))
    )


def base64_line(bin_col) -> Column:
    """Standard base64 without line breaks (Spark may chunk long output with CRLF)."""
    return F.regexp_replace(F.base64(col_(bin_col)), r"[\r\n]", "")


def decode_base64(c, lenient: bool = False) -> Column:
    """P3 as one column: struct(data BINARY, error STRING)."""
    return F.struct(F.when(base64_error(c, lenient).isNull(), decode_base64_strict(c, lenient)).alias("data"), base64_error(c, lenient).alias("error"))
