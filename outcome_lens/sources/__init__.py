"""Reading tables under a contract, writing result tables."""

from outcome_lens.sources.delimited import normalise, parsing, read_contract, read_lines, read_quarantined, read_raw
from outcome_lens.sources.results import published_runs, read_results, write_results

__all__ = [
    "normalise", "parsing", "published_runs", "read_contract", "read_lines", "read_quarantined", "read_raw", "read_results", "write_results",
]
