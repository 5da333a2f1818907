from cdcspark.sources.changes import (
    capture_name,
    changes_between,
    changes_since,
    jdbc_changes_options,
    last_sync,
    last_sync_of,
    lsn_range,
    max_lsn,
    min_lsn,
    misplaced,
    resolve_capture_instance,
    resolve_change_table,
    stream_changes,
    with_capture_instances,
    with_change_tables,
)
from cdcspark.sources.logstream import DatabaseLog, FileLog, file_log, planned_position, position_stream
from cdcspark.sources.snapshot import read_snapshot
from cdcspark.sources.splits import Splits, boundary_statement, plan_splits, splits_of_bounds
from cdcspark.sources.tables import FileSource, JdbcSource, Source
