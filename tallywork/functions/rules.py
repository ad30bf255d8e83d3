"""Rules that results depend on."""

# Fixed values. Changing any of these changes results. SEPARATOR_PATTERN is the
# specification that SQL and tests follow; tokens are cut by an equal pattern.
SEPARATOR_PATTERN = r"[^a-z0-9.,_\-]+"
TOKEN_CHARACTER = r"[a-z0-9.,_\-]"
WORD_PATTERN = r"[a-z_\-]{6,24}"
NUMBER_PATTERN = r"-?[0-9]+([.,][0-9]+)?"
NUMBER_MIN_LENGTH = 4
NUMBER_MAX_LENGTH = 16
LINE_END_PATTERN = r"\r\n|\n|\r"
COUNT_PATTERN = r"[+-]?[0-9]+"
PAIR_SEPARATOR = ":"
PAIR_WINDOW = 2
COUNT_WANTED = 1000
TOP_K = 100
MISSING_VALUE_DEFAULT = 23
MEDIAN_RELATIVE_ERROR = 0.01
GAP_LIMIT = 10
SMALL_GAP_VERDICT = "not very different"
LARGE_GAP_VERDICT = "noticeably different"
