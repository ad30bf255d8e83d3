"""Column expressions and the fixed rules they follow."""

from tallywork.functions.text import (
    accepted_tokens,
    ends_in_digit,
    is_number,
    is_word,
    pair_key,
    pair_parts,
    parse_count,
    token_kind,
    tokens,
)
from tallywork.functions.values import null_default

__all__ = [
    "accepted_tokens",
    "ends_in_digit",
    "is_number",
    "is_word",
    "null_default",
    "pair_key",
    "pair_parts",
    "parse_count",
    "token_kind",
    "tokens",
]
