"""Frame-level operators. Each takes and returns a lazy DataFrame.

Per-key work is expressed with aggregates that Spark evaluates partially
before the shuffle (min over a struct, bool_and, count), so a key that holds
a large share of all rows is reduced on the map side and never lands whole
in one task. Small per-file or per-key summaries are joined back with a
plain join; AQE turns it into a broadcast only when the measured size of the
summary is below spark.sql.adaptive.autoBroadcastJoinThreshold, and splits
skewed partitions otherwise.
"""

from ledgerlens.operators.frames import (  # noqa: F401
    conform, distinct_files, fill_from_first, first_per_key, flag_duplicates,
    merge_lines, order_key, pick_formats, with_constants,
)
