"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

#: Words of the text contracts: maximal runs of anything but space and U+0009..U+000D.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: Rows up to which a lookup table of a few narrow columns may be broadcast (checked by a count).
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words of a text (null: none), as an array of strings."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), SPACES), "")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to a table in the shared folder and read again, and its path.

    Lineage is cut: a lost executor costs a reread, not a recomputation.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def boxed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` as one struct column ``__row`` beside ``columns``: no name of ``df`` can clash with a working column."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
    return df.select(row, *[c.alias(n) for n, c in columns.items()])


def unboxed(df: DataFrame) -> DataFrame:
    return df.select("__row.*")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; Spark's cleaner removes it with its last reference."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def lookup(big: DataFrame, small: DataFrame, key: str, how: str, salt_by: list[str],
           rows: int | None = None, salts: int = 32, most: int | None = None) -> DataFrame:
    """Join ``big`` with ``small``, whose ``key`` is unique and may be null.

    ``small`` is broadcast if its counted rows stay under ``most`` (``BROADCAST_ROWS``).
    Beyond that both sides are shuffled on (key, salt): ``small`` is repeated
    for every salt and ``big`` is dealt by a hash of ``salt_by``, so that one
    key with a third of the rows spreads over ``salts`` tasks.
    """
    s = small.withColumnRenamed(key, "__key")
    if (small.count() if rows is None else rows) <= (BROADCAST_ROWS if most is None else most):
        return big.join(F.broadcast(s), F.col(key).eqNullSafe(F.col("__key")), how).drop("__key")
    s = s.withColumn("__salt_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    b = big.withColumn("__salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
    on = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__salt") == F.col("__salt_s"))
    return b.join(s, on, how).drop("__key", "__salt", "__salt_s")
