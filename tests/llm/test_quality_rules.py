import re
from collections import Counter, defaultdict
from statistics import mean

import duckdb

from tessera.llm import quality_rules as Q


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), len(lines))


def brute(rows, max_rate=0.5, clear=0.5):
    out, fails = [], defaultdict(list)
    for r in rows:
        n, chars, symbols, dup, rep, lines = m = measures(r[1])
        f = (n < 10, 100 * rep > 20 * n, 10 * symbols > n, chars < 2 * n or chars > 15 * n, 10 * dup > 3 * lines)
        fails[r[3]].append(f)
        out.append((r[0], m[:5], f, r[3]))
    bad, cleared = set(), set()
    sizes = [len(v) for v in fails.values()]
    docs, hosts = sum(sizes), len(sizes)
    for k in range(5):
        m = mean(f[k] for v in fails.values() for f in v)
        c = 1e6
        if hosts > 1 and docs > hosts:
            between = sum(len(v) * (mean(f[k] for f in v) - m) ** 2 for v in fails.values()) / (hosts - 1)
            within = sum(len(v) * mean(f[k] for f in v) * (1 - mean(f[k] for f in v)) for v in fails.values()) / (docs - hosts)
            size = (docs - sum(x * x for x in sizes) / docs) / (hosts - 1)
            if between > within:
                c = min(max((between + (size - 1) * within) / (between - within) - 1, 1.0), 1e6)
        for h, v in fails.items():
            rate = (sum(f[k] for f in v) + m * c) / (len(v) + c)
            if rate > max_rate:
                bad.add(h)
            if rate < clear * m:
                cleared.add((h, k))
    res = []
    for doc, m, f, h in out:
        base = f[0] or f[1]
        res.append((doc, *m, base, not base and not any(x and (h in bad or (h, k) not in cleared) for k, x in enumerate(f))))
    return res, bad, cleared


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_matches_brute_force(docs, corpus):
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
           for r in Q.judged(docs).collect()]
    expected, bad, _ = brute(corpus)
    assert bad >= {"junk"}
    assert order(got) == order(expected)


def test_stage_keeps_rows_and_columns(clashing, corpus):
    out = Q.stage(clashing)
    assert out.columns == clashing.columns
    expected = [r[0] for r in brute(corpus)[0] if r[-1]]
    assert order([(r.doc_id,) for r in out.collect()]) == order([(x,) for x in expected])
    assert {r.n_words for r in out.select("n_words").collect()} == {"own n_words"}


def test_hosts_decide_both_ways(spark):
    """The same text goes from one host and stays on another; query and stage judge alike, and as brute force does."""
    good = "plain words that stand in a text without any of the signs"
    junk = good + " # # # % % |"
    rows = [(i, junk if i < 20 else good, "en", "mixed", 0) for i in range(100)]
    rows += [(1000 + i, junk if i < 1 else good, "en", "clean", 0) for i in range(400)]
    rows += [(2000 + i, junk if i < 90 else good, "en", "junk", 0) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    expected, bad, cleared = brute(rows)
    assert bad == {"junk"} and ("clean", 2) in cleared and ("mixed", 2) not in cleared
    kept = {r[0] for r in expected if r[-1]}
    assert 1000 in kept and 0 not in kept and 2000 not in kept and 2099 in kept
    assert {r.doc_id for r in Q.stage(df).collect()} == kept
    assert {r.doc_id for r in Q.judged(df).collect() if r.kept} == kept


def test_sql_judges_alike_with_hosts_that_differ(spark, docs, tmp_path):
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert order(con.execute(Q.SQL).fetchall()) == order(tuple(r) for r in Q.run(spark, str(tmp_path)).collect())


def test_prior():
    assert Q.prior(0, 0.0, 0.0, 0, 0.0) == (0.0, Q.MAX_CONCENTRATION)
    m, k = Q.prior(2, 200.0, 20000.0, 100, 100.0)      # one host fails always, one never
    assert m == 0.5 and k == 1.0
    assert Q.prior(2, 200.0, 20000.0, 20, 2.0) == (0.1, Q.MAX_CONCENTRATION)   # alike


def test_lookup_by_shuffle_equals_broadcast(docs, monkeypatch):
    from tessera.llm import common
    one = order(map(tuple, Q.judged(docs).collect()))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert order(map(tuple, Q.judged(docs).collect())) == one


def test_empty(empty):
    assert Q.judged(empty).collect() == []
    assert Q.stage(empty).collect() == []


def test_no_python_in_plan(docs):
    plan = Q.judged(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
