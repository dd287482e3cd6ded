"""F11 on a streaming frame equals the batch transform."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators.features import FeatureProcessor
from tessera.streaming.score import score_stream


def test_stream_scoring_equals_batch(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    fp = FeatureProcessor("regression")
    fp.fit_transform(part.where(F.col("p_size") <= 25), "p_retailprice")
    batch = sorted(tuple(r) for r in fp.transform(part).collect())
    stream = (spark.readStream.schema(part.schema).option("pathGlobFilter", "part.parquet")
              .parquet(SF_SMALL))
    q = score_stream(stream, fp).writeStream.format("memory").queryName("scored_parts") \
        .outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.sql("SELECT * FROM scored_parts").collect())
    assert got == batch
