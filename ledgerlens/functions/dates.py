"""Date, time and zone expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.layouts import PACIFIC


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# strptime directive -> Spark pattern letters. Single letters are used for
# day, month, hour, minute and second because strptime accepts one or two
# digits there, while Spark's 'dd' demands two.
_STRPTIME = {"%d": "d", "%m": "M", "%Y": "yyyy", "%H": "H", "%M": "m",
             "%S": "s", "%y": "yy", "%b": "MMM", "%B": "MMMM", "%p": "a",
             "%I": "h"}


def strptime_to_spark(fmt: str) -> str:
    out = fmt
    for k, v in _STRPTIME.items():
        out = out.replace(k, v)
    return out


# English month names as Spark's US-locale parser reads them.
_MONTH_FULL = "(?i:January|February|March|April|May|June|July|August|September|October|November|December)"
_MONTH_SHORT = "(?i:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"

_SHAPE_LETTERS = [  # longest first
    ("MMMM", _MONTH_FULL), ("MMM", _MONTH_SHORT), ("yyyy", "\\d{4}"), ("SSSSSS", "\\d{6}"),
    ("yy", "\\d{2}"), ("MM", "\\d{2}"), ("dd", "\\d{2}"), ("HH", "\\d{2}"), ("hh", "\\d{2}"),
    ("mm", "\\d{2}"), ("ss", "\\d{2}"), ("M", "\\d{1,2}"), ("d", "\\d{1,2}"), ("H", "\\d{1,2}"),
    ("h", "\\d{1,2}"), ("m", "\\d{1,2}"), ("s", "\\d{1,2}"), ("a", "[AaPp][Mm]"),
]


def pattern_shape(pattern: str) -> str:
    """Regular expression a text must match to have a chance with a Spark
    datetime pattern. Failed parses are costly (the JVM builds an exception
    per miss), so each parse is guarded by this cheap test."""
    out, i = "^", 0
    while i < len(pattern):
        if pattern[i] == "'":
            j = pattern.index("'", i + 1)
            out += _re_escape(pattern[i + 1:j])
            i = j + 1
            continue
        for letters, rx in _SHAPE_LETTERS:
            if pattern.startswith(letters, i):
                out += rx
                i += len(letters)
                break
        else:
            out += _re_escape(pattern[i])
            i += 1
    return out + "$"


def _re_escape(text: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\/-" else ch for ch in text)


def try_parse(c, pattern: str) -> Column:
    """try_to_timestamp behind the shape test; NULL when either fails."""
    text = _c(c)
    return F.when(text.rlike(pattern_shape(pattern)), F.try_to_timestamp(text, F.lit(pattern)))


def parse_first(c, patterns: list[str]) -> Column:
    """First pattern that parses the text, as a wall-clock timestamp_ntz."""
    text = _c(c)
    return F.coalesce(*[try_parse(text, p) for p in patterns]).cast("timestamp_ntz")


# Month-first shapes come before day-first ones: '10-11-2024' is 11 Oct,
# '25-10-2024' can only be 25 Oct. A text is brought to one spelling first
# (see iso_date), so commas, zones, fractions and 'T' need no shapes here.
ISO_DATE_PATTERNS = [
    "M-d-yyyy", "d-M-yyyy", "yyyy-M-d", "yyyy-d-M", "yyyyMMdd", "MMM d yyyy", "MMMM d yyyy",
    "d MMM yyyy", "d MMMM yyyy", "yyyy MMM d", "yyyy MMMM d",
]
# Two digits of a year at the end of a date that does not begin with one.
_LATE_YEAR, _EARLY_YEAR = r"^(?!\d{4})(?<y>.+[- ])([0-6]\d|7[0-3])$", r"^(?!\d{4})(?<y>.+[- ])(7[4-9]|[89]\d)$"

# A time of day after a date: hours, minutes, perhaps seconds and a fraction,
# AM or PM, or an hour with AM or PM alone, and a zone name or offset.
_TIME = (r"[T\s]+\d{1,2}(?:(?::\d{1,2}){1,2}(?:[.,]\d{1,9})?(?:\s*[AaPp]\.?[Mm]\.?)?|\s*[AaPp]\.?[Mm]\.?)"
         r"(?:\s*(?:Z|[A-Z]{2,5}|(?:GMT|UTC)?[+-]\d{1,2}(?::?\d{2})?))?$")
_WEEKDAY = r"(?i)^(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\.?,?\s+"


def iso_date(c, patterns: list[str] = ISO_DATE_PATTERNS) -> Column:
    """Free-form date text -> 'yyyy-MM-dd'; text nothing parses -> NULL.

    The calendar date as written counts: a time of day, zone or weekday is
    cut off, '.' and '/' separate as '-' does, and commas and runs of blanks
    count as one blank ('Oct 20, 2024', '20 Oct 2024 10:00',
    '2024-10-20T10:11:12+00:00'). Month names may stand between '-' or '/'
    ('5-Oct-24'), September may be 'Sept', and days may be ordinals. A year of
    two digits is one from 1974 to 2073."""
    text = F.regexp_replace(F.regexp_replace(_c(c), _TIME, ""), _WEEKDAY, "")
    # Only texts with a letter can hold a month name or an ordinal.
    named = F.regexp_replace(text, r"(?i)(?<=\d)(?:st|nd|rd|th)\b", "")
    named = F.regexp_replace(F.regexp_replace(named, r"(?i)\bsept\b", "Sep"), r"[-/.]+", " ")
    text = F.when(text.rlike("[A-Za-z]"), named).otherwise(F.regexp_replace(text, r"(?<=\d)[./](?=\d)", "-"))
    text = F.btrim(F.regexp_replace(text, r"[,\s]+|\.\s*(?=\d)", " "))
    text = F.regexp_replace(F.regexp_replace(text, _LATE_YEAR, "${y}20$2"), _EARLY_YEAR, "${y}19$2")
    # The cleaned text is bound to a name: each pattern would spell it out
    # again, and Spark does not share it across the branches of COALESCE.
    return F.element_at(F.transform(F.array(text), lambda t: F.date_format(parse_first(t, patterns), "yyyy-MM-dd")), 1)


# Trailing zone token: an abbreviation (PDT, UTC), or an offset (GMT-7); an
# AM/PM marker is not a zone.
_ZONE = r"\s+((?:GMT|UTC)[+-]\d{1,2}(?::?\d{2})?|(?!AM$|PM$)[A-Z]{2,5})$"


def split_zone(c) -> tuple[Column, Column]:
    """('Oct 20, 2024 1:05:12 PM PDT') -> ('Oct 20, 2024 1:05:12 PM', 'PDT').

    Spark's 'z' pattern would apply the named zone and shift the value; the
    reports' wall time must be kept, so the token is cut off before parsing.
    """
    text = _c(c)
    tail = F.regexp_extract(text, _ZONE, 0)
    zone = F.ltrim(tail, F.lit(" \t\n\x0b\f\r"))
    # The end that was found is cut off; one search serves both.
    body = F.when(tail == "", text).when(text.endswith(tail), F.substring(text, F.lit(1), F.length(text) - F.length(tail))) \
        .otherwise(F.regexp_replace(text, _ZONE, ""))
    return body, F.when(zone != "", zone)


def pacific_if_utc(ts, zone, utc_tokens=("UTC",)) -> Column:
    """Convert to US Pacific wall time only when the text named UTC; any
    other token (PDT, GMT-7) or none keeps the wall time as written."""
    conv = F.convert_timezone(F.lit("UTC"), F.lit(PACIFIC), _c(ts))
    return F.when(_c(zone).isin(*utc_tokens), conv).otherwise(_c(ts))


def utc_to_pacific(ts) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(PACIFIC), _c(ts).cast("timestamp_ntz"))


def utc_to_pacific_text(ts) -> Column:
    """UTC wall time -> US Pacific 'yyyy-MM-dd HH:mm:ss' (DST aware)."""
    return F.date_format(utc_to_pacific(ts), "yyyy-MM-dd HH:mm:ss")


def run_window(run_date) -> dict[str, Column]:
    """A run's dates by name: the day itself, the days around it, the compact
    text of report names, and that text read back."""
    day = F.to_date(_c(run_date))
    compact = F.date_format(day, "yyyyMMdd")
    return {"run_date": day, "previous_day": F.date_sub(day, 1), "two_days_before": F.date_sub(day, 2),
            "next_day": F.date_add(day, 1), "run_compact": compact,
            "run_iso": F.date_format(F.to_date(compact, "yyyyMMdd"), "yyyy-MM-dd")}


def weekday_list(run_date, prefix: str = "list_files_", suffix: str = ".csv") -> Column:
    """Name of the job list of a run date's weekday (Monday 0)."""
    return F.concat(F.lit(prefix), F.weekday(_c(run_date)).cast("string"), F.lit(suffix))


def duration_seconds(start, end) -> Column:
    return (F.unix_timestamp(_c(end).cast("timestamp"))
            - F.unix_timestamp(_c(start).cast("timestamp")))


def duration_text(start, end) -> Column:
    """'H hours M minutes' of end - start; whole days are not shown
    (a 25 h 30 min run reads '1 hours 30 minutes')."""
    secs = duration_seconds(start, end)
    hours = F.floor(F.pmod(secs, F.lit(86400)) / 3600).cast("bigint")
    minutes = F.floor(F.pmod(secs, F.lit(3600)) / 60).cast("bigint")
    return F.when(secs.isNotNull(), F.concat_ws(
        "", hours.cast("string"), F.lit(" hours "), minutes.cast("string"),
        F.lit(" minutes")))
