"""Token, pair and count expressions.

All of them are built-in functions with a code-generated form, so a tokenizer
stays inside one whole-stage-codegen span from the scan to the partial
aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywork.functions import rules


def _whole(pattern: str) -> str:
    # rlike searches, and "$" would also accept a trailing line feed.
    return rf"^(?:{pattern})\z"


# One token is a maximal run of token characters. Anchoring the alternatives
# to the ends of such a run gives the same tokens as splitting on the
# separator and testing each piece, without building the rejected pieces. The
# possessive "+" after the word and the look for a digit before the number
# only make the pattern give up on a rejected piece sooner.
_RUN_START = rf"(?<!{rules.TOKEN_CHARACTER})"
_RUN_END = rf"(?!{rules.TOKEN_CHARACTER})"
_FITTING_LENGTH = (
    rf"(?={rules.TOKEN_CHARACTER}"
    rf"{{{rules.NUMBER_MIN_LENGTH},{rules.NUMBER_MAX_LENGTH}}}{_RUN_END})"
)
_WORD = rf"{rules.WORD_PATTERN}+"
_NUMBER = rf"(?=-?[0-9]){_FITTING_LENGTH}{rules.NUMBER_PATTERN}"
ACCEPTED_PATTERN = rf"{_RUN_START}(?:{_WORD}|{_NUMBER}){_RUN_END}"


# The separator once more, as a run of characters that are not token
# characters. Spark threads of one JVM slow each other down on the negated
# class, on eight cores to a third of the speed.
_SEPARATOR = rf"(?:(?!{rules.TOKEN_CHARACTER})(?s:.))++"


def tokens(text: Column) -> Column:
    """Every piece of the lower-cased text, accepted or not, in order."""
    return F.split(F.lower(text), _SEPARATOR, -1)


def accepted_tokens(text: Column) -> Column:
    """The words and numbers of the text, in order, duplicates kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(ACCEPTED_PATTERN), F.lit(0))


def is_word(token: Column) -> Column:
    return token.rlike(_whole(rules.WORD_PATTERN))


def is_number(token: Column) -> Column:
    return token.rlike(_whole(rules.NUMBER_PATTERN)) & F.length(token).between(
        rules.NUMBER_MIN_LENGTH, rules.NUMBER_MAX_LENGTH
    )


def ends_in_digit(token: Column) -> Column:
    """Whether an accepted token is a number: those end in a digit, and words hold none."""
    return F.substring(token, -1, 1).between("0", "9")


def token_kind(token: Column) -> Column:
    """``word``, ``number`` or null; no token is both."""
    return F.when(is_word(token), "word").when(is_number(token), "number")


def pair_key(left: Column, right: Column) -> Column:
    return F.concat(left, F.lit(rules.PAIR_SEPARATOR), right)


def pair_parts(key: Column) -> Column:
    """Both sides of a pair key as a struct; null unless there are exactly two."""
    left = F.substring_index(key, rules.PAIR_SEPARATOR, 1)
    right = F.substring_index(key, rules.PAIR_SEPARATOR, -1)
    return F.when(
        (pair_key(left, right) == key) & (right != ""),
        F.struct(left.alias("left"), right.alias("right")),
    )


def parse_count(text: Column) -> Column:
    """A whole number that fits 64 bits, surrounding blanks allowed; else null."""
    return F.when(
        text.rlike(_whole(rf"\s*{rules.COUNT_PATTERN}\s*")), text.try_cast("bigint")
    )
