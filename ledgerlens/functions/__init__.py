"""Column -> Column expressions. All are built-in Spark functions, so they
stay inside whole-stage code generation; none calls Python per row."""

from ledgerlens.functions.text import (  # noqa: F401
    clean_text, int_or_zero, is_strict_number, localise_month, money, money_eu,
    percent_text, strip_text,
)
from ledgerlens.functions.dates import (  # noqa: F401
    duration_seconds, duration_text, iso_date, pacific_if_utc, parse_first,
    split_zone, strptime_to_spark, utc_to_pacific, utc_to_pacific_text,
)
