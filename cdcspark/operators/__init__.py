from cdcspark.operators.apply import (
    apply_changes,
    data_columns,
    expand_key_changes,
    last_changes,
    merge_last,
    new_watermark,
    to_types,
    watermark_after,
)
from cdcspark.operators.feed import (
    capture_changes,
    change_counts,
    change_report,
    net_changes,
    pair_status,
    reconcile,
    reconcile_counts,
    stamped,
)
from cdcspark.operators.quarantine import cast_to, quarantine_split, with_reason
from cdcspark.operators.ranges import DatabaseEnd, FrameEnd, portable_hash, reconcile_ends, reconcile_ranges
from cdcspark.operators.rows import delete_by_key, sample_one, thin_rows, update_by_key
from cdcspark.operators.skew import hot_keys, lookup_join
