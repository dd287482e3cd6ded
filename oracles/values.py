"""Fixed values of the rules, stated for the oracles alone.

Nothing here is imported from the engine or by it, so a value changed on one
side shows as a mismatch. The values themselves are fixed.
"""

from __future__ import annotations

import re

# ---- fixed values ---------------------------------------------------------------

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
CARDINALITY_LOW = 10             # <
CARDINALITY_MEDIUM = 50          # <

# The dirty orders view (FIXTURES.md section 3).
_ORDERS = """
SELECT o_orderkey,
 CASE WHEN o_orderkey % 101 = 0 OR o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS cust_num,
 CASE WHEN o_orderkey % 101 = 0 OR o_orderkey % 10 < 8 THEN NULL ELSE o_totalprice END AS sparse_num,
 CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN o_totalprice * 20 ELSE o_totalprice END AS total_price,
 CASE WHEN o_orderkey % 101 = 0 OR o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status,
 CASE WHEN o_orderkey % 101 = 0 OR o_orderkey % 3 = 0 THEN NULL WHEN o_orderpriority < '3' THEN 'Yes' ELSE 'no' END AS urgent,
 CASE WHEN o_orderkey % 101 = 0 OR o_orderkey % 4 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
 CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE CAST(o_custkey % 40 AS STRING) END AS num_text
FROM orders"""
DIRTY_ORDERS = f"(SELECT * FROM ({_ORDERS}) UNION ALL SELECT * FROM ({_ORDERS}) WHERE o_orderkey % 50 = 0)"

# Columns of the scalar expressions, by query.
N_COLUMNS = {
    "n01_cast_text": ["n01_text"], "n02_lower": ["n02_lower"], "n03_length": ["n03_length"],
    "n04_regex": ["n04_search", "n04_full"], "n05_parse": ["n05_parse"],
    "n06_clip": ["n06_clip"], "n07_fill_null": ["n07_fill"],
    "n08_round": ["n08_round1", "n08_bround"], "n09_title_case": ["n09_title"],
    "n10_keyword_test": ["n10_keyword"], "n11_timestamp_format": ["n11_timestamp"],
    "n12_number_format": ["n12_format"], "n13_abs_sqrt": ["n13_abs_sqrt"],
}

# ---------------------------------------------------------------------------------


def keyword_regex(words: list[str]) -> str:
    """A name holds one of ``words``."""
    return "|".join(map(re.escape, words))


def search_regex(patterns: list[str]) -> str:
    return "|".join(f"({p})" for p in patterns)
