"""Writers for counts and top lists."""

from tallywork.sinks.counts import (
    layout_path,
    write_by_range,
    write_counts,
    write_spans_by_range,
    write_top,
)

__all__ = ["layout_path", "write_by_range", "write_counts", "write_spans_by_range", "write_top"]
