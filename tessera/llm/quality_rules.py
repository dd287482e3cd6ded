"""Quality rules with host verdicts (DataFrame functions only).

Each document is measured once: word, symbol, line and repetition counts, all
from array functions on its own row, so nothing but one narrow row a document
is ever shuffled. Rule failures are summed by host (``source``). For each rule
the hosts give an empirical beta prior by the method of moments: its mean is the
failure rate of all documents, its concentration follows from the variance
between hosts, weighted by documents, less what chance within hosts explains. A
host's rate is its posterior mean under that prior. The verdicts are joined
back, and the query and the pipeline's stage judge alike: a document goes if it
fails a base rule, or another rule that its host does not clear. A host clears a
rule by a shrunk rate under ``clear_ratio`` of the prior mean, unless one of its
shrunk rates exceeds ``max_host_rate``; hosts that do not differ clear nothing.
A document that fails no rule always stays, whatever its host.

Edge cases: a null text has no words and fails the base rule; a null host is a
host of its own; repeated rows count and are judged one by one; an empty table
gives an empty result; columns of the input with the same names as the
measures are never read (the query) or are kept as they are (the stage); a very long text is one row, its words an
array of one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE_CHARS, boxed, cut, lookup, unboxed, words_of, written

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20

#: Rules whose failures hosts are judged by; each is true where the document fails.
RULES = {
    "few_words": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
}
MAX_HOST_RATE = 0.5
#: Share of the prior mean under which a host's rate clears a failed rule.
CLEAR_RATIO = 0.5
#: Concentration of the prior of hosts that do not differ.
MAX_CONCENTRATION = 1e6


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.withColumns({"__words": words_of(F.col(text)), "__lines": lines, "__t": t})
    n = F.size("__words")
    d = d.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.translate("__t", SPACE_CHARS, "")).cast("long"),
        "n_symbols": (F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        # a hash for each window, in order of position
        "__win": F.when(n >= WINDOW, F.transform(
            F.sequence(F.lit(1), n - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice("__words", i, WINDOW)))).otherwise(
                F.array().cast("array<bigint>")),
    }).drop("__words", "__lines", "__t")
    # (hash, position) in order of hash: equal windows are neighbours; texts without any skip the sort
    d = d.withColumn("__by_hash", F.when(
        F.size(F.array_distinct("__win")) < F.size("__win"),
        F.sort_array(F.transform("__win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter("__by_hash", lambda x, j: (x["h"] == F.get("__by_hash", j - 1)["h"])
                     | (x["h"] == F.get("__by_hash", j + 1)["h"]))
    d = d.withColumn("__at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    # a window that starts d words after the one before it covers min(d, 5) new words
    covered = F.aggregate(
        "__at", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(
            F.lit(WINDOW), i - a["last"]).cast("long")).alias("n")), lambda a: a["n"])
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop(
        "__win", "__by_hash", "__at")


def _rules():
    return {name: F.expr(rule) for name, rule in RULES.items()}


def prior(hosts: int, docs: float, squares: float, failed: float, spread: float) -> tuple[float, float]:
    """(mean, concentration) of the beta prior of a rule.

    ``squares``: sum of squared host sizes; ``spread``: sum of squared failures
    by size. The variances between and within hosts give the correlation of two
    documents of a host; its inverse less one is the concentration.
    """
    if not docs:
        return 0.0, MAX_CONCENTRATION
    m = failed / docs
    if hosts < 2 or docs <= hosts:
        return m, MAX_CONCENTRATION
    between, within = (spread - failed * failed / docs) / (hosts - 1), (failed - spread) / (docs - hosts)
    size = (docs - squares / docs) / (hosts - 1)
    if between <= within:  # chance explains what differs
        return m, MAX_CONCENTRATION
    share = (between - within) / (between + (size - 1) * within)
    return m, min(max(1 / share - 1, 1.0), MAX_CONCENTRATION)


def condemned_hosts(failures: DataFrame, max_host_rate: float = MAX_HOST_RATE,
                    clear_ratio: float = CLEAR_RATIO) -> DataFrame:
    """(host, host_rate, condemned, clears_<rule>) from one row a document: host and one boolean for each rule.

    Sums are combined on the map side, so a host with a third of all documents
    sends one row a task. The prior is one row of sums over hosts.
    """
    hosts = cut(failures.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES]))
    n = F.col("n").cast("double")
    t = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("docs"), F.sum(n * n).alias("squares"),
                  *[f.alias(f"{k}_{r}") for r in RULES for k, f in (("s", F.sum(r)), ("q", F.sum(F.col(r) * F.col(r) / n)))]).first()
    rates, clears = [], []
    for r in RULES:
        m, k = prior(t["hosts"], t["docs"] or 0.0, t["squares"] or 0.0, t[f"s_{r}"] or 0, t[f"q_{r}"] or 0.0)
        rates.append(((F.col(r) + F.lit(m * k)) / (F.col("n") + F.lit(k))).alias(r))
        clears.append((rates[-1] < clear_ratio * m).alias(f"clears_{r}"))
    worst = F.greatest(*rates)
    return hosts.select("host", worst.alias("host_rate"),
                        (worst > max_host_rate).alias("condemned"), *clears)


def _faults():
    """(fails a base rule, fails a rule that its host does not clear)."""
    return (F.col("few_words") | F.col("repeats"),
            F.greatest(*[F.col(r) & (F.col("condemned") | ~F.col(f"clears_{r}")) for r in RULES]))


def judged(docs: DataFrame, text: str = "text", host: str = "source",
           max_host_rate: float = MAX_HOST_RATE, clear_ratio: float = CLEAR_RATIO) -> DataFrame:
    """One row a document: doc_id, the measures, base_failed, host_rate, kept."""
    d = docs.select("doc_id", F.col(host).cast("string").alias("host"), F.col(text).alias("text"))
    m = cut(measured(d).drop("text"))
    m = m.withColumns(_rules())
    hosts = condemned_hosts(m.select("host", *RULES), max_host_rate, clear_ratio)
    j = lookup(m, hosts, "host", "left", ["doc_id", "n_words"])
    base, soft = _faults()
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", base.alias("base_failed"),
                    (~base & ~soft).alias("kept"))


def stage(docs: DataFrame, text: str = "text", host: str = "source",
          max_host_rate: float = MAX_HOST_RATE, clear_ratio: float = CLEAR_RATIO) -> DataFrame:
    """The documents that pass, with their columns unchanged.

    Documents are measured once and written with the rules they fail, in the
    order they came: hosts are judged from the narrow columns of that table, and
    whole texts need no shuffle while the host table is small enough to broadcast.
    """
    d = boxed(docs, text=F.col(text), host=F.col(host).cast("string"), doc_id=F.col("doc_id"))
    d = measured(d).withColumns(_rules())
    d, _ = written(d.select("__row", "doc_id", "host", "n_words", *RULES), "measured")
    hosts = cut(condemned_hosts(d.select("host", *RULES), max_host_rate, clear_ratio))
    base, soft = _faults()
    return unboxed(lookup(d, hosts, "host", "left", ["doc_id", "n_words"]).filter(~base & ~soft))


def run(spark, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_MEASURES = """
d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM {docs}),
w AS (SELECT rid, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, ws[i:i+4] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, sum(least(5, coalesce(i - p, 5))) AS n FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS p FROM dup) GROUP BY rid),
m AS (SELECT d.*, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid)),
f AS (SELECT *, n_words < 10 AS r1, 100 * n_repeat_words > 20 * n_words AS r2, 10 * n_symbols > n_words AS r3,
             (word_chars < 2 * n_words OR word_chars > 15 * n_words) AS r4, 10 * n_dup_lines > 3 * n_lines AS r5 FROM m),
h AS (SELECT source, count(*) AS n, {sums} FROM f GROUP BY source),
p AS (SELECT count(*) AS hosts, sum(n) AS docs, sum(n * n) AS squares, {totals} FROM h),
k AS (SELECT {ks} FROM p),
v AS (SELECT h.source, greatest({rates}) > 0.5 AS bad, {clears} FROM h, k)
"""


def verdict_sql(docs: str = "documents") -> str:
    """DuckDB CTEs: f (measures and rules) and v (host verdicts: bad, and c1 to c5 for the rules a host clears)."""
    five = range(1, 6)
    between = "((q{i} - s{i} * s{i} / docs) / (hosts - 1))"
    within = "((s{i} - q{i}) / (docs - hosts))"
    size = "((docs - squares / docs) / (hosts - 1))"
    k = (f"CASE WHEN hosts < 2 OR docs <= hosts THEN 1e6 WHEN {between} <= {within} THEN 1e6 ELSE least(greatest("
         f"({between} + ({size} - 1) * {within}) / ({between} - {within}) - 1, 1.0), 1e6) END AS k{{i}}")
    rate = "(s{i} + m{i} * k{i}) / (n + k{i})"
    each = lambda t: ", ".join(t.format(i=i) for i in five)
    return _MEASURES.format(
        docs=docs, sums=each("sum(r{i}::INT) AS s{i}"), totals=each("sum(s{i}) AS s{i}, sum(s{i} * s{i} / n) AS q{i}"),
        ks=each("s{i} / docs AS m{i}, " + k), rates=each(rate), clears=each(rate + " < 0.5 * m{i} AS c{i}"))


SQL = "WITH " + verdict_sql() + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (r1 OR r2) AS base_failed,
       NOT (r1 OR r2) AND NOT (r1 AND (bad OR NOT c1) OR r2 AND (bad OR NOT c2) OR r3 AND (bad OR NOT c3)
         OR r4 AND (bad OR NOT c4) OR r5 AND (bad OR NOT c5)) AS kept
FROM f LEFT JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
