"""Local frames of every kind, types and gaps kept, whole or in chunks."""

import datetime as dt
import decimal
import re
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pytest

from tessera.sources import io

DAY = dt.date(2024, 2, 29)
AT = dt.datetime(2024, 2, 29, 12, 30)
ROWS = [(1, 1.5, "a", True, DAY, AT, decimal.Decimal("1.10")),
        (None, float("nan"), "NA", None, None, None, None),
        (3, None, "", False, DAY, AT, decimal.Decimal("-2.00"))]
NAMES = ["i", "d", "s", "b", "day", "at", "dec"]
WANT = [(1, 1.5, "a", True, DAY, AT, decimal.Decimal("1.10")), (None,) * 7,
        (3, None, None, False, DAY, AT, decimal.Decimal("-2.00"))]
TYPES = ["bigint", "double", "string", "boolean", "date", "timestamp_ntz", "decimal(3,2)"]


def arrow():
    types = [pa.int64(), pa.float64(), pa.string(), pa.bool_(), pa.date32(), pa.timestamp("us"), pa.decimal128(3, 2)]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(NAMES, zip(*ROWS), types)})


def frame():
    f = pd.DataFrame({n: pd.Series(c, dtype=object) for n, c in zip(NAMES, zip(*ROWS))})
    return f.astype({"i": "Int64", "d": "float64", "b": "boolean", "at": "datetime64[us]"})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0))


@pytest.mark.parametrize("data", [arrow, frame, lambda: arrow().to_batches()[0]])
def test_types_and_gaps(spark, data):
    df = io.ingest(spark, data())
    assert [t for _, t in df.dtypes] == TYPES
    assert rows(df) == sorted(WANT, key=lambda r: (r[0] is None, r[0] or 0))


@pytest.mark.parametrize("chunks", [
    lambda: arrow().to_reader(max_chunksize=1),
    lambda: (frame().iloc[i:i + 1] for i in range(3)),
    lambda: [arrow().slice(0, 1), arrow().slice(1, 0), arrow().slice(1)]])
def test_chunks(spark, chunks):
    df = io.ingest(spark, chunks())
    assert [t for _, t in df.dtypes] == TYPES
    assert rows(df) == sorted(WANT, key=lambda r: (r[0] is None, r[0] or 0))


def test_mixed_objects_are_text(spark):
    df = io.ingest(spark, pd.DataFrame({"x": [1, "b", None, float("nan"), 2.5], 7: range(5)}))
    assert df.dtypes == [("x", "string"), ("7", "bigint")]
    assert [r.x for r in df.orderBy("`7`").collect()] == ["1", "b", None, None, "2.5"]


def test_empty_frame_and_no_chunks(spark):
    assert io.ingest(spark, arrow().slice(0, 0)).count() == 0
    with pytest.raises(ValueError):
        io.ingest(spark, iter([]))


def test_spark_frame_passes_through(spark):
    assert io.ingest(spark, spark.sql("SELECT 'NA' s, double('nan') d")).first() == (None, None)


def test_oracles_import_nothing_of_the_engine():
    import oracles
    for file in Path(oracles.__file__).parent.glob("*.py"):
        assert not re.search(r"^\s*(from|import) +tessera", file.read_text(), re.M), file
