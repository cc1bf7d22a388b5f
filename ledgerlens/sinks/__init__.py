"""Writers: CSV with header, partitioned publication, completion markers."""

from ledgerlens.sinks.writers import (  # noqa: F401
    publish_or_blank, publish_partitioned, publish_zones, read_markers, read_zones, write_csv, write_lines, write_marker,
)
from ledgerlens.sinks.publication import (  # noqa: F401
    read_manifest, read_published, replace_partitions, vacuum,
)
