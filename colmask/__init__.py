"""Find sensitive columns by name and mask them, on Spark."""

from colmask.functions.redact import UnsupportedTypeError, mask_expr
from colmask.functions.sql import register_mask_functions
from colmask.operators.control import (
    duplicate_keys,
    flagged,
    flagged_tables,
    prune_control,
    stale_columns,
    upsert_control,
)
from colmask.operators.discover import classify_columns, classify_fields, excluded_by_suffix
from colmask.operators.grants import group_closure, has_grant
from colmask.operators.planning import (
    mask_plan,
    masked_columns_from_ddl,
    pending_columns,
    unsupported,
    unsupported_messages,
)
from colmask.operators.rule_index import classify_indexed
from colmask.operators.rules import Rule, default_rules, shadowed_rules
from colmask.operators.tokens import extend_vault, tokenize
from colmask.plans.apply import ApplyRun, apply_control, apply_views
from colmask.plans.discover import discover_catalog, discover_frames, discover_table
from colmask.plans.follow import FollowRun, MaskedCopy, follow_control
from colmask.plans.mask import MaskRunError, create_masked_view, mask_all, mask_table, write_masked
from colmask.plans.rescan import Rescan, Snapshot, discover_changes, rescan_catalog
from colmask.session import drop_work_folders
from colmask.sources.versions import ControlTable, StreamedCopy, Vault
from colmask.streaming.masked_stream import write_masked_stream, write_tokenized_stream

__all__ = [
    "ApplyRun",
    "ControlTable",
    "FollowRun",
    "MaskRunError",
    "MaskedCopy",
    "Rescan",
    "Rule",
    "Snapshot",
    "StreamedCopy",
    "UnsupportedTypeError",
    "Vault",
    "apply_control",
    "apply_views",
    "classify_columns",
    "classify_fields",
    "classify_indexed",
    "create_masked_view",
    "default_rules",
    "discover_catalog",
    "discover_changes",
    "discover_frames",
    "discover_table",
    "drop_work_folders",
    "duplicate_keys",
    "excluded_by_suffix",
    "extend_vault",
    "flagged",
    "flagged_tables",
    "follow_control",
    "group_closure",
    "has_grant",
    "mask_all",
    "mask_expr",
    "mask_plan",
    "mask_table",
    "masked_columns_from_ddl",
    "pending_columns",
    "prune_control",
    "register_mask_functions",
    "rescan_catalog",
    "shadowed_rules",
    "stale_columns",
    "tokenize",
    "unsupported",
    "unsupported_messages",
    "upsert_control",
    "write_masked",
    "write_masked_stream",
    "write_tokenized_stream",
]
