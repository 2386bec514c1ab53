"""Column expressions shared by the operators; all of them run inside the JVM.

They are built from column names as single SQL expressions: one parsed text per
column instead of a chain of calls from Python into the JVM.
"""

from skylattice.functions.columns import (
    airline_key,
    calendar_columns,
    label_or,
    quoted,
    seconds_between,
    time_cell,
)
from skylattice.functions.means import (
    exact_means,
    gather_means,
    mean_columns,
    mean_parts,
    mean_ranges,
    mean_value,
    merge_mean_parts,
)

__all__ = [
    "airline_key",
    "calendar_columns",
    "exact_means",
    "gather_means",
    "label_or",
    "mean_columns",
    "mean_parts",
    "mean_ranges",
    "mean_value",
    "merge_mean_parts",
    "quoted",
    "seconds_between",
    "time_cell",
]
