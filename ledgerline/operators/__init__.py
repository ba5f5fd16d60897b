"""``DataFrame -> DataFrame`` building blocks: CDC netting, state, SCD2, checks, diffs."""

from ledgerline.operators.cdc import (
    batch_counts, delta_events, high_mark, high_mark_value, initial_events, load_mode, log_window,
    net_change, stamp_batch,
)
from ledgerline.operators.quality import (
    accepted_values, conform, contract_violations, not_null, primary_key, relationships, unique,
    unique_combination,
)
from ledgerline.operators.scd2 import scd2_history, scd2_versions
from ledgerline.operators.setops import table_diff
from ledgerline.operators.state import current_state, latest_per_key, replay, state_as_of

__all__ = [
    "batch_counts", "delta_events", "high_mark", "high_mark_value", "initial_events", "load_mode",
    "log_window", "net_change", "stamp_batch", "accepted_values", "conform",
    "contract_violations", "not_null", "primary_key", "relationships", "unique",
    "unique_combination", "scd2_history", "scd2_versions", "table_diff", "current_state",
    "latest_per_key", "replay", "state_as_of",
]
