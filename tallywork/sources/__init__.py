"""Readers for text corpora, persisted counts and CSV tables."""

from tallywork.sources.counts import read_pair_counts, read_token_counts
from tallywork.sources.tables import read_csv_table
from tallywork.sources.text import dealt, read_lines, read_sources, split_lines

__all__ = [
    "dealt",
    "read_csv_table",
    "read_lines",
    "read_pair_counts",
    "read_sources",
    "read_token_counts",
    "split_lines",
]
