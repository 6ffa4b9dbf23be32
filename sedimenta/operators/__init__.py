"""DataFrame -> DataFrame operators."""

from sedimenta.operators.audit import (
    normalize_temporal,
    null_to_nan,
    only_unprocessed,
    with_audit,
)
from sedimenta.operators.changes import replace_by_key, table_changes
from sedimenta.operators.dedupe import dedupe, latest_per_key
from sedimenta.operators.history import merge_history, valid_at
from sedimenta.operators.joins import join_on_columns, join_on_concat, join_skewed
from sedimenta.operators.merge import merge_frames
from sedimenta.operators.quarantine import cast_fails, split_rejected
from sedimenta.operators.skew import hot_keys, join_hot_keys

__all__ = [
    "cast_fails",
    "dedupe",
    "hot_keys",
    "join_hot_keys",
    "join_on_columns",
    "join_on_concat",
    "join_skewed",
    "latest_per_key",
    "merge_frames",
    "merge_history",
    "normalize_temporal",
    "null_to_nan",
    "only_unprocessed",
    "replace_by_key",
    "split_rejected",
    "table_changes",
    "valid_at",
    "with_audit",
]
