"""Sources and sinks.

Reads are declarative (parquet / CSV / JSON readers; Catalyst prunes columns
and pushes filters into parquet scans). Missing-value tokens become NULL in
one projection right after the read, before any type inference.
"""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from ..functions import rules as R
from ..session import checkpoint_dir


def normalize_na(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """NA tokens -> NULL in text columns, NaN -> NULL in float columns."""
    tokens = R.NA_TOKENS if tokens is None else tokens
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(~c.isin(tokens), c)
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def read_table(spark: SparkSession, path: str, fmt: str | None = None,
               na_tokens: list[str] | None = None) -> DataFrame:
    """Parquet / CSV (header, inferred schema) / JSON by extension or ``fmt``."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "json" if path.endswith(".json")
                  else "parquet")
    if fmt == "csv":
        # read as text, turn tokens into NULL, then infer column types
        # RFC 4180: a quote within a field is doubled, a quoted field may hold line ends
        raw = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"',
                             multiLine=True)
        return _infer_types(normalize_na(raw, na_tokens))
    df = spark.read.json(path) if fmt == "json" else spark.read.parquet(path)
    return normalize_na(df, na_tokens)


def _infer_types(df: DataFrame) -> DataFrame:
    """Per text column: boolean if every non-null is a spelling of true or false,
    integer if every one is an integer literal that fits a long, else double if
    every one is a decimal literal, else text. One aggregate pass (as a reader's schema inference would take)."""
    cols = df.columns
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        aggs += [F.count(x).alias(f"n{i}"),
                 F.count(F.when(F.trim(x).rlike(r"^[+-]?[0-9]+\z") &
                                F.trim(x).try_cast("long").isNotNull(), 1)).alias(f"l{i}"),
                 F.count(R.parse_number(x)).alias(f"d{i}"),
                 F.count_if(x.isin(R.BOOLEAN_TEXT)).alias(f"b{i}")]
    row = df.agg(*aggs).collect()[0]
    out = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        n = row[f"n{i}"]
        if n and row[f"b{i}"] == n:
            x = F.lower(x) == "true"
        elif n and row[f"l{i}"] == n:
            x = F.trim(x).try_cast("long")
        elif n and row[f"d{i}"] == n:
            x = R.parse_number(x)
        out.append(x.alias(c))
    return df.select(*out)


def arrow_table(data) -> pa.Table:
    """A pandas frame, Arrow table or record batch as an Arrow table with the types it holds.

    pandas keeps integers, booleans, dates and decimals with gaps as objects or
    floats; whole floats of a column that has gaps become integers again only
    where pandas says so (its nullable types), and NaN becomes NULL. A column of
    mixed types is text. Column labels become text; the index is left out.
    """
    if isinstance(data, pa.RecordBatch):
        return pa.Table.from_batches([data])
    if isinstance(data, pa.Table):
        return data
    arrays = []
    for i in range(data.shape[1]):
        column = data.iloc[:, i]
        try:
            arrays.append(pa.Array.from_pandas(column))
        except (pa.ArrowInvalid, pa.ArrowTypeError):
            arrays.append(pa.array([None if x is None or x != x else str(x) for x in column], pa.string()))
    return pa.Table.from_arrays(arrays, names=[str(c) for c in data.columns])


def _local(spark: SparkSession, table: pa.Table) -> DataFrame:
    """An Arrow table as a Spark frame; timestamps without a zone stay so."""
    return spark.createDataFrame(table, schema=from_arrow_schema(table.schema, prefer_timestamp_ntz=True))


def ingest(spark: SparkSession, data, na_tokens: list[str] | None = None) -> DataFrame:
    """A frame as a Spark frame, NA tokens and NaN as NULL.

    ``data`` is a Spark frame, which passes through; a pandas frame, Arrow table
    or record batch; or an iterable of these of one schema (a
    ``RecordBatchReader``, a chunked pandas reader), which is unioned chunk by
    chunk through Parquet files in the shared folder, so that the driver holds
    one chunk at a time. Large data belongs in files read by ``read_table``.
    """
    if isinstance(data, DataFrame):
        return normalize_na(data, na_tokens)
    if isinstance(data, (pa.Table, pa.RecordBatch)) or hasattr(data, "iloc"):
        return normalize_na(_local(spark, arrow_table(data)), na_tokens)
    path = f"{checkpoint_dir(spark)}/ingest-{uuid.uuid4().hex}"
    schema = None
    for chunk in data:
        table = arrow_table(chunk)
        # a chunk may lack a column's values and so its type: the first one decides
        schema = schema or table.schema
        _local(spark, table.select(schema.names).cast(schema)).write.mode("append").parquet(path)
    if schema is None:
        raise ValueError("no chunk to take a schema from")
    return normalize_na(spark.read.parquet(path), na_tokens)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Analysis report (one JSON document per file)."""
    return spark.read.json(path, multiLine=True)


def write_training_set(df: DataFrame, target: str | None, path: str,
                       fmt: str = "parquet") -> str:
    """Target column last, written as parquet (or CSV with header)."""
    cols = [c for c in df.columns if c != target] + ([target] if target in df.columns else [])
    out = df.select(*[F.col(f"`{c}`") for c in cols]).write.mode("overwrite")
    if fmt == "csv":
        out.option("header", True).option("escape", '"').csv(path)
    else:
        out.parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """JSON lines sink."""
    df.write.mode("overwrite").json(path)
    return path


def report_text(report: dict) -> str:
    """S05/S08/S09 one-document form (driver-side small dict)."""
    return json.dumps(report, indent=2, default=str)
