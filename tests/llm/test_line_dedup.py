from collections import defaultdict

from tessera.llm import line_dedup as L

SPACES = " \t\n\x0b\x0c\r"


def brute(rows, pct=L.MAX_RATIO_PCT, least=L.MIN_PAGES):
    pages, holds = defaultdict(set), defaultdict(set)
    for doc, text, _, host, _ in rows:
        if text is not None:
            pages[host].add(text)
            for line in text.split("\n"):
                if line.strip(SPACES):
                    holds[host, line.strip(SPACES)].add(text)
    out = []
    for doc, text, _, host, _ in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if not x.strip(SPACES) or not (
            len(n := holds[host, x.strip(SPACES)]) >= least and len(n) * 100 > pct * len(pages[host]))]
        out.append((doc, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def result(docs):
    return order((r["doc_id"], r.n_lines, r.n_removed, r.text)
                 for r in L.stripped(docs).select("__row.doc_id", "n_lines", "n_removed", "text").collect())


def test_matches_brute_force(docs, corpus):
    expected = order(brute(corpus))
    assert sum(r[2] for r in expected) >= 12
    assert result(docs) == expected


def test_shuffled_lookup(docs, monkeypatch):
    from tessera.llm import common
    one = result(docs)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert result(docs) == one


def test_stage(clashing, corpus):
    out = L.stage(clashing)
    assert out.columns == clashing.columns
    got = order((r.doc_id, r.text, r.n_chars, r.lines) for r in out.collect())
    assert got == order((d, t, len(t or ""), "own lines") for d, _, _, t in brute(corpus))


def test_copies_are_one_page(spark):
    rows = [(i, "same prose\nall through", "en", "s", 0) for i in range(50)] + [(60 + i, f"page {i}", "en", "s", 0) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert all(r[2] == 0 for r in result(df))


def test_stage_keeps_the_lines_of_near_copies(spark):
    rows = [(i, "\n".join(f"page {i} line {k} of its own" for k in range(8)) + "\nShare this page", "en", "s", 0)
            for i in range(40)]
    prose = [f"a passage of the copied text, number {k}" for k in range(10)]
    for i in range(20):  # a third of the pages: one line of ten changed
        text = "\n".join(f"changed {i}" if k == i % 10 else x for k, x in enumerate(prose))
        rows.append((100 + i, text, "en", "s", 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in L.stage(df).collect()}
    assert got == {r[0]: r[1].replace("\nShare this page", "") for r in rows}


def test_stage_empty(empty):
    assert L.stage(empty).collect() == []


def test_empty(empty):
    assert result(empty) == []
