import random
import re

import numpy as np
import pytest

from tessera.llm import license_scan as L


def words(t):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def best_score(text, template):
    score = np.zeros((len(template) + 1, len(text) + 1), int)
    for q in range(1, len(template) + 1):
        for p in range(1, len(text) + 1):
            score[q, p] = max(0, score[q - 1, p - 1] + (1 if text[p - 1] == template[q - 1] else -1),
                              score[q - 1, p] - 1, score[q, p - 1] - 1)
    return int(score.max())


def test_align_matches_full_matrix():
    rng = random.Random(4)
    for _ in range(300):
        t = [rng.randrange(6) for _ in range(rng.randrange(1, 15))]
        x = [rng.randrange(6) for _ in range(rng.randrange(0, 20))]
        if rng.random() < 0.6:
            y = t[:]
            y[rng.randrange(len(y))] = 99
            x += y + [7]
        m, a, b = L.align(np.array(x, np.uint64), np.array(t, np.uint64), -len(t), len(x))
        s = best_score(x, t)
        assert m >= s and (s == 0) == (m == 0) and 0 <= a <= b <= len(x)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    junk = lambda n: " ".join(rng.choice("onre blehe thander stion lywh".split()) for _ in range(n))
    out = [(1, None), (2, ""), (3, junk(50)), (None, "é Released under the MIT License.")]
    for i, (_, t) in enumerate(L.TEMPLATES.items()):
        out.append((10 + i, f"{junk(7)}\n{t.upper()}\n{junk(5)} ñ"))
        w = t.split()
        if len(w) > 20:
            w[9:9] = ["extra", "words"]
            del w[15]
            w[-3] = "changed"
            out.append((50 + i, junk(3) + " " + " ".join(w)))
            out.append((90 + i, " ".join(w[:len(w) // 2])))  # half: not reported
    out.append((200, "Released under the MIT License.\n" * 40))
    return out


def test_templates_are_found(spark, rows):
    got = L.scanned(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    text = {d: t for d, t in rows}
    for r in got:
        assert text[r.doc_id][r.start:r.end] == r.matched
        assert r.coverage == r.matched_words / r.template_words >= L.MIN_COVERAGE
        assert r.template_words == len(words(L.TEMPLATES[r.license]))
    found = {(r.doc_id, r.license) for r in got}
    # brute force: the best local alignment of the whole text with the whole template
    for d, t in rows:
        for name, template in L.TEMPLATES.items():
            ws, ts = words(t), words(template)
            hit = (d, name) in found
            if best_score(ws, ts) >= L.MIN_COVERAGE * len(ts):
                assert hit, (d, name)
            elif sum((np.array(ts)[:, None] == np.array(ws or [""])).any(1)) < L.MIN_COVERAGE * len(ts):
                assert not hit, (d, name)
    assert sum(r.doc_id == 200 for r in got) == 40
    for i, name in enumerate(L.TEMPLATES):
        assert (10 + i, name) in found


def test_winnowed_index_is_in_every_template():
    index = L.Index(L.TEMPLATES)
    assert set(np.concatenate([t for _, t, _ in index.by_size.values()])) == set(range(len(L.TEMPLATES)))
    assert L.found([b"anything"], L.Index({"none": "...", "one": "word"})) == []
    assert [m[:4] for m in L.found([b"a Word b"], L.Index({"one": "word"}))] == [(0, 0, 1, 1)]


def test_one_word_changes_of_short_notices():
    names = list(L.TEMPLATES)
    index = L.Index(L.TEMPLATES)
    for name, template in L.TEMPLATES.items():
        w = template.split()
        if 5 <= len(words(template)) <= 20 and len(w) == len(words(template)):
            for i in range(len(w)):
                text = " ".join(["onre", *w[:i], "changed", *w[i + 1:], "lywh"]).encode()
                hits = {(names[k], m) for _, k, m, *_ in L.found([text], index)}
                assert (name, len(w) - 1) in hits, (name, i)


def test_empty(empty):
    assert L.scanned(empty).collect() == []


def test_clashing_names(clashing):
    d = clashing.selectExpr("*", "'own' AS license", "1 AS start", "2 AS matched")
    assert L.scanned(d).columns[:2] == ["doc_id", "license"]
    assert L.scanned(d).count() == L.scanned(clashing).count()


def test_templates_from_a_table(spark, empty):
    t = spark.createDataFrame([("A", "alpha beta gamma delta"), ("A", "zeta eta theta iota"), ("A", "alpha beta gamma delta"),
                               ("B", None), (None, "lost words"), ("C", " ,. "), ("D", "kappa " * 3000)], "license string, text string")
    got = L.templates_of(t)
    assert got == {"A": "alpha beta gamma delta", "A (2)": "zeta eta theta iota", "D": "kappa " * 3000}
    with pytest.raises(ValueError):
        L.templates_of(t, most=100)
    assert L.templates_of(empty, name="lang") == {}
    docs = spark.createDataFrame([(1, "so Zeta, eta; THETA iota it is"), (2, "nothing")], "doc_id long, text string")
    assert [(r.doc_id, r.license, r.matched) for r in L.scanned(docs, templates=got).collect()] == [
        (1, "A (2)", "Zeta, eta; THETA iota")]
