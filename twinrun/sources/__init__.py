"""Sources and sinks: frozen history (O1) and pinned results."""

from .history import TABLES, history_counts, load_history, snapshot_history
from .pin import (compare_to_bucketed_pin, compare_to_pin, discard, materialize, pin, pin_bucketed,
                  read_pin, scratch)

__all__ = ["TABLES", "history_counts", "load_history", "snapshot_history",
           "compare_to_bucketed_pin", "compare_to_pin", "discard", "materialize", "pin", "pin_bucketed",
           "read_pin", "scratch"]
