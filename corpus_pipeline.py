"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next one's ``docs``. A document that the quality
rules reject goes; boilerplate lines go from those that stay; of each group of
near copies one stays; one that holds a benchmark item goes; the rest is packed
into sequences of the permitted lengths, one row a piece with its bytes.

Edge cases: a null or empty text fails the base rule and goes; a null doc_id or
host is a value of its own; repeated rows are near copies, of which one stays;
columns beside those of ``documents``, whatever their names, pass through to the
last stage, which reads doc_id and text alone; a very long text is one row until
it is packed in pieces; empty tables give an empty result. A stage's table is
deleted when the next one is written; the last one stays, as the result reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, line_dedup, packing, quality_rules, simhash_dedup
from tessera.llm.common import discard, scratch_path, table

STAGES = [
    ("quality_rules", lambda spark, docs, sf_dir: quality_rules.stage(docs)),
    ("line_dedup", lambda spark, docs, sf_dir: line_dedup.stage(docs)),
    ("simhash_near_dedup", lambda spark, docs, sf_dir: simhash_dedup.stage(docs)),
    ("benchmark_decontamination",
     lambda spark, docs, sf_dir: decontaminate.stage(docs, table(spark, sf_dir, "benchmark"))),
    ("best_fit_packing", lambda spark, docs, sf_dir: packing.stage(docs)),
]

#: Fingerprints are XXH64, which SQL does not have; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over ``documents``, each written and reread."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        discard(spark, *before)
        before = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
