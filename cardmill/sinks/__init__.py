"""Parquet writers."""

from cardmill.sinks.parquet import (
    drop_partition,
    overwrite_day,
    overwrite_days,
    overwrite_partitions,
    overwrite_single_file,
    replace_partitions,
    replace_table,
)
from cardmill.sinks.swap import recover, recover_partitions

__all__ = ["drop_partition", "overwrite_day", "overwrite_days", "overwrite_partitions", "overwrite_single_file", "recover", "recover_partitions", "replace_partitions", "replace_table"]
