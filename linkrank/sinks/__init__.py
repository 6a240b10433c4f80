"""Text files and run reports."""

from linkrank.sinks.reports import (
    append_ledger,
    compare_runs,
    convergence_report,
    ledger_row,
    run_summary,
    times_report,
    top_report,
    write_csv,
    write_ledger_csv,
    write_summary,
)
from linkrank.sinks.text import (
    adjacency_lines,
    ranked_lines,
    ranked_records,
    write_history,
    write_lines,
)

__all__ = [
    "adjacency_lines",
    "append_ledger",
    "compare_runs",
    "convergence_report",
    "ledger_row",
    "ranked_lines",
    "ranked_records",
    "run_summary",
    "times_report",
    "top_report",
    "write_csv",
    "write_history",
    "write_ledger_csv",
    "write_lines",
    "write_summary",
]
