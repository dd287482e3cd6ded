"""Fixed values that results depend on, and the scalar expressions built on them.

The word lists, patterns and thresholds below must stay exactly as they are:
the semantic-type, role and target rules are defined by them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES (rule definitions; do not edit)
# ---------------------------------------------------------------------------

# Date-like text, searched anywhere in the value (not anchored).
DATETIME_PATTERNS = [
    r"\d{4}[-/]\d{1,2}[-/]\d{1,2}",
    r"\d{1,2}[-/]\d{1,2}[-/]\d{4}",
    r"\d{4}-\d{2}-\d{2}\s\d{2}:\d{2}:\d{2}",
]

# Identifier-looking values; each must match the whole value.
IDENTIFIER_PATTERNS = [
    r"[a-zA-Z0-9]{8,}",
    r"\d{5,}",
    r"[A-Z]{2,}\d+",
    r"[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}",
    r"\+?\d{7,15}",
    r"\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}",
    r"[\w\.-]+@[\w\.-]+\.\w+",
    r"[A-Z][a-z]+(\s[A-Z][a-z]+)+",
]

# Substrings of a lower-cased column name.
IDENTIFIER_KEYWORDS = [
    "id", "key", "uuid", "guid", "identifier", "code", "ref", "name",
    "fullname", "firstname", "lastname", "user", "phone", "mobile",
    "contact", "email", "mail", "ssn", "passport", "account",
]
TARGET_KEYWORDS = [
    "target", "label", "class", "outcome", "result", "prediction", "default",
    "churn", "fraud", "risk", "score", "rating", "price", "value", "amount",
    "cost", "revenue", "sales",
]
METADATA_KEYWORDS = [
    "date", "time", "created", "updated", "modified", "name", "description",
    "comment", "note",
]

# Lower-cased value set that makes a column binary.
BINARY_TOKENS = ["true", "false", "1", "0", "yes", "no", "y", "n"]

# Target-choice scoring (rule-based fallback). Points: +10 name word, +8
# description word, +5 binary, +7 categorical with exactly 2 values, -15 id
# word in the name, -12 identifier, -20 fully missing.
TARGET_NAME_WORDS = ["target", "label", "class", "outcome", "result"]
TARGET_DESCRIPTION_WORDS = ["target", "label", "class", "predict"]
TARGET_ID_WORDS = ["id", "key", "index", "number", "code", "ref"]

# Read-time missing-value tokens (the common CSV-reader default set).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Spellings a CSV reader types as boolean, where a column has no other value.
BOOLEAN_TEXT = ["True", "TRUE", "true", "False", "FALSE", "false"]

# Decimal literal guard used before any text -> number cast, so that Spark and
# other engines agree on what parses ('5d', '1_000', 'inf', 'NaN' do not).
NUMERIC_TEXT = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"

# Thresholds.
NUMERIC_PARSE_SHARE = 0.8        # > : text column is numeric
DATETIME_SHARE = 0.6             # >= : 3 of 5 in the sampled form
IDENTIFIER_UNIQUE_RATIO = 0.9    # >=
TEXT_UNIQUE_RATIO = 0.7          # >
TEXT_MEAN_LENGTH = 30            # >
ROLE_MAX_CATEGORIES = 5          # <=
OUTLIER_SHARE = 0.05             # > share outside 1.5 IQR
IQR_FACTOR = 1.5
CARDINALITY_LOW = 10             # <
CARDINALITY_MEDIUM = 50          # <
DROP_COLUMN_NULL_PCT = 70        # > : column dropped
DROP_ROW_NULL_SHARE = 0.8        # > : row dropped
MISSING_ISSUE_LOW, MISSING_ISSUE_HIGH = 10, 50   # low < pct <= high
CAP_QUANTILES = (0.05, 0.95)
PROFILE_QUANTILES = [0.05, 0.25, 0.75, 0.95]

# ---------------------------------------------------------------------------


def keyword_regex(words: list[str]) -> str:
    """One alternation for substring tests on a name."""
    return "|".join(re.escape(w) for w in words)


def full_match_regex(patterns: list[str]) -> str:
    """Anchored alternation; ``\\z`` so a trailing newline does not match."""
    return "^(?:" + "|".join(f"(?:{p})" for p in patterns) + r")\z"


def search_regex(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def parse_number(c: Column) -> Column:
    """Lenient text -> double: NULL unless the trimmed text is a decimal literal."""
    t = F.trim(c)
    return F.when(t.rlike("^" + NUMERIC_TEXT + r"\z"), t.try_cast("double"))


def nan_to_null(c: Column) -> Column:
    """NaN and +-inf become NULL (Spark orders NaN above every number)."""
    d = c.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def name_has(c: Column, words: list[str]) -> Column:
    return F.lower(c).rlike(keyword_regex(words))


def title_case(c: Column) -> Column:
    """'keep_outliers' -> 'Keep Outliers'."""
    return F.initcap(F.regexp_replace(c, "_", " "))


def fmt2(c: Column) -> Column:
    return F.format_string("%.2f", c)


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)
