"""DataFrame-in / DataFrame-out operators: lazy plans, except for the batch key profile (one small job)
and, with hot keys, one write of the sliced hot rows."""

from tidemark.operators.asof import as_of_join, point_in_time  # noqa: F401
from tidemark.operators.envelope import normalize_after_image, normalize_envelope  # noqa: F401
from tidemark.operators.evolving import merged_fields, normalize_envelope_evolving  # noqa: F401
from tidemark.operators.marts import top_users  # noqa: F401
from tidemark.operators.merge import (  # noqa: F401
    delete_history,
    last_change_per_key,
    merge_close_and_insert,
    merge_close_and_insert_with_archive,
    merge_current,
    merge_current_bucketed,
    merge_current_with_history,
)
from tidemark.operators.scd import (  # noqa: F401
    as_of_view,
    closed_intervals,
    current_of_state,
    fold_latest,
    latest_current,
    open_intervals,
    scd2_apply,
    scd2_from_log,
    scd2_init,
    scd2_step,
    snapshot_current,
    stamp_partition,
)
from tidemark.operators.sequence import latest_per_key, next_in_key  # noqa: F401
from tidemark.operators.snapshots import snapshot_changes, snapshot_intervals  # noqa: F401
from tidemark.operators.truncates import close_at_truncates, truncate_events  # noqa: F401
