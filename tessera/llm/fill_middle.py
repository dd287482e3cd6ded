"""Fill-in-middle transformation by in-place block rotation.

A text is cut at two token ends into prefix, middle and suffix. A token is a
run of white space with the word after it, so every token but a last one of
white space ends where a word does: one scan of the bytes gives all cuts. The
sentinels are inserted into a bytearray that holds the text, which gives the
three blocks ``<P>prefix<M>middle<S>suffix``. Blocks that stand side by side
are exchanged where they stand, each reversed and then both together:

* psm: the last two change places, ``<P>prefix<S>suffix<M>middle``;
* spm: then the first two, ``<S>suffix<P>prefix<M>middle``.

``restored`` finds the sentinels, does the same rotations the other way round
and deletes the sentinels: the exact text. It cannot mistake text for a
sentinel: a text that holds one is left plain, and none can arise where a
block and a sentinel meet, as each sentinel begins with its only ``<``.

Cuts and form are drawn from SHA-256 of the seed and the key, so a row's result
depends on nothing else and a task run again gives the same. There is no
shuffle; a text is one Python object at a time, whatever its length.

Edge cases: a null or empty text is plain and empty, ``n`` 0; a null key is
drawn as the empty string; a text of white space alone is one token; repeated
rows give repeated results; columns of the table that have a working or result
column's name are kept out of the work and out of the query's result (the
operator's general form takes a prefix for its result columns); an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tessera.llm.common import boxed, table

SEED = 42
FIM_PCT = 50
SPM_PCT = 80
PRE, SUF, MID = b"<P>", b"<S>", b"<M>"
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FIELDS = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
           ("output", pa.binary())]
RESULT = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary"


def token_ends(text: bytes) -> np.ndarray:
    """Where each token ends, in order, by one scan over the bytes (white space is ASCII)."""
    word = ~_SPACE[np.frombuffer(text, np.uint8)]
    ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    return np.r_[ends, len(text)] if text else ends  # the last word, or white space after it


def drawn(key: str, seed: int = SEED) -> tuple[int, ...]:
    """Four numbers below 2**32."""
    h = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return tuple(int(h[8 * i:8 * i + 8], 16) for i in range(4))


def rotate(block: np.ndarray, left: int) -> None:
    """Exchange block[:left] with the rest of ``block`` in place, by three reversals."""
    for part in (block[:left], block[left:], block):
        half = len(part) // 2
        if half:  # the first half changes places with the mirrored second
            held = part[:half].copy()
            part[:half] = part[len(part) - half:][::-1]
            part[len(part) - half:] = held[::-1]


def _chars(part) -> int:
    """Code points of UTF-8 bytes: those that do not continue one."""
    return int(np.count_nonzero((np.frombuffer(part, np.uint8) & 0xC0) != 0x80)) if len(part) else 0


def rearranged(text: bytes, key: str, seed: int = SEED, fim_pct: int = FIM_PCT, spm_pct: int = SPM_PCT):
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    ends = token_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = drawn(key, seed)
    if not text or any(s in text for s in (PRE, SUF, MID)) or h3 % 100 >= fim_pct:
        return n, "plain", None, None, text
    at = np.r_[0, ends]
    low, high = sorted((int(at[h1 % (n + 1)]), int(at[h2 % (n + 1)])))
    buffer = bytearray(text)
    buffer[high:high] = SUF
    buffer[low:low] = MID
    buffer[0:0] = PRE
    middle, suffix = low + len(PRE), high + len(PRE) + len(MID)  # where their blocks begin
    view = np.frombuffer(buffer, np.uint8)
    rotate(view[middle:], suffix - middle)
    form = "spm" if h4 % 100 < spm_pct else "psm"
    if form == "spm":  # the suffix block now ends where the middle block begins
        rotate(view[:middle + len(view) - suffix], middle)
    return n, form, _chars(text[:low]), _chars(text[low:high]), bytes(buffer)


def restored_text(output: bytes, form: str) -> bytes:
    """The text that ``rearranged`` was given, from its output and form."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    view = np.frombuffer(buffer, np.uint8)
    if form == "spm":
        prefix, middle = output.index(PRE), output.index(MID)
        rotate(view[:middle], prefix)
    suffix, middle = buffer.index(SUF), buffer.index(MID)
    rotate(view[suffix:], middle - suffix)
    del view
    for sentinel in (SUF, MID, PRE):
        at = buffer.index(sentinel)
        del buffer[at:at + len(sentinel)]
    return bytes(buffer)


def transformed(text: Column, key: Column, seed: int = SEED, fim_pct: int = FIM_PCT, spm_pct: int = SPM_PCT) -> Column:
    """A struct with the fields of RESULT; ``output`` is UTF-8."""
    @arrow_udf(RESULT)
    def run(texts: pa.Array, keys: pa.Array) -> pa.Array:
        # one text at a time is a Python object, not a batch of them
        columns = zip(*(rearranged(t.as_py() or b"", k.as_py() or "", seed, fim_pct, spm_pct) for t, k in zip(texts, keys)))
        columns = list(columns) or [()] * len(_FIELDS)
        return pa.StructArray.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, _FIELDS)],
                                          names=[f for f, _ in _FIELDS])
    return run(text.cast("string").cast("binary"), key.cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text, as UTF-8 bytes, of an output and its form."""
    @arrow_udf("binary")
    def run(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        return pa.array((restored_text(o.as_py() or b"", f.as_py()) for o, f in zip(outputs, forms)), pa.binary(),
                        size=len(outputs))
    return run(output, form)


def fill_middle(docs: DataFrame, text: str = "text", key: str = "doc_id", prefix: str = "fim_", **params) -> DataFrame:
    """``docs`` with the fields of RESULT as columns named with ``prefix`` (which replace any of that name); output as text."""
    fields = [f for f, _ in _FIELDS]
    d = boxed(docs, __fim=transformed(F.col(f"`{text}`"), F.col(f"`{key}`"), **params))
    kept = [F.col(f"__row.`{c}`").alias(c) for c in docs.columns if c not in {prefix + f for f in fields}]
    of = {f: F.col(f"__fim.{f}") for f in fields}
    return d.select(*kept, *[c.cast("string").alias(prefix + f) if f == "output" else c.alias(prefix + f) for f, c in of.items()])


def run(spark, sf_dir: str) -> DataFrame:
    d = fill_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), prefix="")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return d.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                    sha(restored(F.col("output").cast("binary"), F.col("form"))).alias("restored_sha256"))


SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
       regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS w FROM documents),
h AS (SELECT *, CAST(len(w) AS BIGINT) AS n, list_transform(range(0, 4), lambda i: CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT)) AS r FROM t),
c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS lo, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS hi,
       CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR r[3] % 100 >= 50 THEN 'plain'
            WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(w[1:lo], '') AS pre, array_to_string(w[lo + 1:hi], '') AS mid, array_to_string(w[hi + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(x) AS restored_sha256
FROM p
"""
