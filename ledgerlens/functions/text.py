"""Text, money and id cleaning expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.layouts import SPANISH_MONTHS

# A number as Python's float() reads it (sign, digits, one dot, exponent).
# Spark's own double cast also takes suffixes such as '1d' or '2f'; the
# reports never mean those, so text must match this first.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INTEGER = r"^[+-]?\d+$"

# The characters str.strip() removes: every code point Python calls space.
# Trimming a set of characters avoids a per-row regular expression.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c) -> Column:
    """Strip leading and trailing white space of any kind, as str.strip().

    Trimming a 29-character set costs a scan of the set per boundary
    character, so it only runs when the first or last character is white
    space (a hash-set test); other text is returned as is."""
    x = _c(c)
    ws = list(WHITESPACE)
    edge = F.substring(x, 1, 1).isin(ws) | F.substring(x, -1, 1).isin(ws)
    return F.when(edge, F.btrim(x, F.lit(WHITESPACE))).otherwise(x)


def clean_text(c) -> Column:
    """Drop zero-width spaces (U+200B), then strip."""
    return strip_text(F.replace(_c(c), F.lit("\u200b"), F.lit("")))


def is_strict_number(c) -> Column:
    return F.coalesce(_c(c).rlike(_NUMBER), F.lit(False))


# Spark's double cast also reads forms Python's float() rejects: suffixes
# ('1d', '2f'), 'NaN' / 'Infinity' and hex ('0x1p3'). A number must start
# with a digit, sign or dot, end with a digit or dot, and hold no 'x'; the
# cast does the rest. Set lookups on two characters, no regex per value.
_FIRST = list("0123456789+-.")
_LAST = list("0123456789.")


def _to_double(text: Column) -> Column:
    ok = (F.substring(text, 1, 1).isin(_FIRST) & F.substring(text, -1, 1).isin(_LAST)
          & ~F.lower(text).contains("x"))
    return F.when(ok, text.try_cast("double"))


def money_text(c) -> Column:
    """The text step of ``money``: thousands commas removed, stripped."""
    return strip_text(F.replace(_c(c), F.lit(","), F.lit("")))


def text_to_double(c) -> Column:
    """Number text -> double; anything else NULL (never NaN)."""
    return _to_double(_c(c))


def money(c) -> Column:
    """'1,234.50' -> 1234.5: thousands commas removed, stripped, to double.
    Blank or non-numeric text gives NULL (never NaN)."""
    return _to_double(strip_text(F.replace(_c(c), F.lit(","), F.lit(""))))


def money_eu(c) -> Column:
    """'12,50' -> 12.5: decimal comma to dot, to double; '1.234,5' -> NULL."""
    return _to_double(strip_text(F.replace(_c(c), F.lit(","), F.lit("."))))


_DECIMAL = r"^[+-]?(?:\d+\.?\d*|\.\d+)$"
# Amounts that decimal(18,2) holds as they are written.
_CENTS = r"^[+-]?\d{1,15}(?:\.\d{1,2})?$"


def money_decimal(c) -> Column:
    """Amount text (see ``money_text``) -> decimal(18,2), exactly: NULL for
    text that is no plain number, has more than two decimals that count, or is
    too large. Nothing is rounded."""
    t = _c(c)
    wide = F.when(t.rlike(_DECIMAL), t.try_cast("decimal(38,10)"))
    cents = wide.try_cast("decimal(18,2)")
    # Eleven decimals and more are seen in the text only.
    exact = F.when((cents == wide) & ~t.rlike(r"\.\d{10}\d*[1-9]"), cents)
    return F.when(t.rlike(_CENTS), t.try_cast("decimal(18,2)")).otherwise(exact)


def decimal_reasons(c) -> list[tuple[Column, str]]:
    """Why ``money_decimal`` gives NULL."""
    t = _c(c)
    return [(~t.rlike(_DECIMAL), "not a number"),
            (t.rlike(r"\.\d\d\d*[1-9]"), "more than two decimals"),
            (F.lit(True), "too large for decimal(18,2)")]


def int_or_zero(c) -> Column:
    """Coerce to a number, NULL or bad text to 0, truncate toward zero.

    Integers are cast straight to bigint so values above 2^53 stay exact;
    other numbers go through double ('12.9' -> 12, '-3.7' -> -3).
    """
    t = strip_text(_c(c))
    integer = F.substring(t, 1, 1).isin(list("0123456789+-")) & t.rlike(_INTEGER)
    as_int = F.when(integer, t.try_cast("bigint"))
    as_dbl = _to_double(t).try_cast("bigint")
    return F.coalesce(as_int, as_dbl, F.lit(0).cast("bigint"))


def localise_month(c, months=SPANISH_MONTHS) -> Column:
    """Spanish month tokens to English names, case-insensitive, in order.

    Tokens are matched as whole words, so an English name that already
    contains a token ('July', 'October') is left alone.
    """
    src = _c(c)

    def named(text: Column, es: str, en: str) -> Column:
        return F.regexp_replace(text, rf"(?i)\b{es}\b", en)

    out = src
    for es, en in months:
        out = named(out, es, en)
    if any(not (es.isascii() and es.isalpha()) or re.search(rf"(?i)\b{es}\b", en) for es, _ in months for _, en in months):
        return out
    # A text that holds the letters of one token takes one step, not all.
    lower = F.lower(src)
    holds = [lower.contains(es.lower()) for es, _ in months]
    found = sum((h.cast("int") for h in holds[1:]), holds[0].cast("int"))
    one = F.when(found == 0, src).when(found > 1, out)
    for h, (es, en) in zip(holds, months):
        one = one.when(h, named(src, es, en))
    return one


def percent_text(c) -> Column:
    """Number -> text with a '%' suffix; NULL stays NULL.

    Plain decimal notation is used for magnitudes Spark would print with an
    exponent (>= 1e7, and below 1e-3), as Python does below 1e16 and from
    1e-4 up; below that Python writes an exponent too ('5e-05').
    """
    x = _c(c).cast("double")
    big = (F.abs(x) >= F.lit(1e7)) | ((F.abs(x) < F.lit(1e-3)) & (F.abs(x) >= F.lit(1e-4)))
    as_dec = F.regexp_replace(
        F.when(F.abs(x) >= 1, x.try_cast("decimal(38,10)").cast("string"))
        .otherwise(x.cast("string").try_cast("decimal(38,24)").cast("string")), r"(\.\d*?)0+$", "$1")
    as_dec = F.regexp_replace(as_dec, r"\.$", ".0")
    tiny = F.regexp_replace(F.regexp_replace(x.cast("string"), r"\.0E", "e"), r"[Ee]-(\d)$", "e-0$1")
    text = F.when(big, as_dec).when((x != 0) & (F.abs(x) < 1e-4), F.replace(tiny, F.lit("E"), F.lit("e"))) \
        .otherwise(x.cast("string"))
    return F.when(x.isNotNull(), F.concat(text, F.lit("%")))
