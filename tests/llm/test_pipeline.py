import pytest

import corpus_pipeline as P
from pyspark.sql import functions as F
from tests.llm.conftest import CLASHING
from tests.llm import test_decontaminate, test_line_dedup, test_quality_rules, test_simhash_dedup


def brute(corpus, items):
    """The rows each stage leaves, by the brute-force versions of its operator."""
    judged = test_quality_rules.brute(corpus)[0]
    rows = [r for r, j in zip(corpus, judged) if j[-1]]
    stages = [rows]
    rows = [(d, t, r[2], r[3], len(t or "")) for r, (d, _, _, t) in zip(rows, test_line_dedup.brute(rows))]
    stages.append(rows)
    keep, seen = [], set()
    for r, (d, f, c) in zip(rows, test_simhash_dedup.expected(rows)):
        if d == c and d not in seen:
            seen.add(d)
            keep.append(r)
    stages.append(keep)
    bad = {d for d, _ in test_decontaminate.brute([r[:2] for r in keep], items)}
    stages.append([r for r in keep if r[0] not in bad])
    return stages


@pytest.fixture(scope="module")
def data(spark, corpus, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("pipeline"))
    rows = [r for r in corpus if r[0] is not None]
    # items: a passage of a document that stays, one that no document holds
    items = [(1, " ".join(rows[11][1].split()[2:22])), (2, "none of these words is anywhere in the texts at all")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, brute(rows, items)


def test_stages(spark, data, tmp_path):
    at, expected = data
    docs = spark.read.parquet(f"{at}/documents.parquet")
    columns = docs.columns
    assert [len(x) for x in expected] == sorted((len(x) for x in expected), reverse=True)
    assert len({len(x) for x in expected}) == 3  # line dedup drops no row
    for (name, stage), exp in zip(P.STAGES, expected):
        stage(spark, docs, at).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        assert sorted(map(tuple, docs.collect())) == sorted(exp), name


def test_run(spark, data):
    at, expected = data
    total, text = {}, {}
    for r in P.run(spark, at).collect():
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        text[r.doc_id, r.start] = bytes(r.content)
        assert r.bin_id is None or r.offset + r.length <= r.used <= r.capacity
    assert total == {r[0]: len((r[1] or "").encode()) for r in expected[-1]}
    assert {d: b"".join(text[k] for k in sorted(text) if k[0] == d) for d in total} == {
        r[0]: (r[1] or "").encode() for r in expected[-1]}


def test_clashing_and_extra_columns(spark, data, tmp_path):
    at, expected = data
    names = [c for c in CLASHING if c != "n_words"] + ["content", "row_hash", "bin_id", "spread"]
    docs = spark.read.parquet(f"{at}/documents.parquet").withColumns({c: F.lit(f"own {c}") for c in names})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{at}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r.doc_id for r in P.run(spark, str(tmp_path)).collect()} == {r[0] for r in expected[-1]}


def test_empty(spark, tmp_path, empty):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_stage_names():
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination",
                                        "best_fit_packing"]
