"""Tenant dimension and machine price list.

Both are joined without a broadcast hint. Catalyst knows the size of a literal
table or of the files behind it and broadcasts below
``spark.sql.autoBroadcastJoinThreshold``; a dimension that outgrows the
threshold falls back to a shuffled join by itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RATE_CARD, TENANTS
from ..settings import DEFAULT_WEEKLY_BUDGET

# Accelerator, accelerator count and hourly rates by machine.
DEFAULT_RATES = (
    ("n1-standard-4", None, 0, 0.0, 0.19),
    ("n1-standard-8", None, 0, 0.0, 0.38),
    ("n1-highmem-16", "NVIDIA_TESLA_T4", 1, 0.35, 0.64),
    ("a2-highgpu-1g", "NVIDIA_TESLA_A100", 1, 2.93, 0.0),
    ("a2-highgpu-4g", "NVIDIA_TESLA_A100", 4, 2.93, 0.0),
)


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A few rows as a literal table, whose size Catalyst knows.

    A DataFrame made from a Python list counts as unboundedly large and would
    never be broadcast; one made from an Arrow table is a local relation.
    """
    columns = list(zip(*rows)) or [()] * len(schema)
    table = pa.table({name: list(column) for name, column in zip(schema.names, columns)})
    return spark.createDataFrame(table, schema)


def tenant_table(spark: SparkSession, rows: Iterable[Sequence]) -> DataFrame:
    """Tenants given as rows in the order of the schema; larger sets come from files."""
    return literal_table(spark, rows, TENANTS)


def rate_card(spark: SparkSession, rows: Iterable[Sequence] = DEFAULT_RATES) -> DataFrame:
    return literal_table(spark, rows, RATE_CARD)


def read_tenants(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Tenant table from a JSON, CSV or Parquet folder; absent columns read as NULL."""
    reader = spark.read.schema(TENANTS)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def read_tenant_settings(spark: SparkSession, pattern: str) -> DataFrame:
    """Tenant table from one flat ``key: value`` settings file per tenant.

    Lines without a key (blank ones, comments) are skipped. A value may stand in quotes; outside of
    them a ``#`` after a space starts a comment. Of a repeated key the last line counts.
    """
    files = spark.read.text(pattern, wholetext=True)
    key, rest = r"^[ \t]*([A-Za-z_][A-Za-z0-9_]*)[ \t]*:", r"^[^:]*:[ \t]*(.*?)[ \t]*$"

    def value(line: Column) -> Column:
        text = F.regexp_extract(line, rest, 1)
        quoted = F.regexp_extract(text, r"""^(["'])(.*?)\1[ \t]*(?:#.*)?$""", 2)
        plain = F.rtrim(F.regexp_replace(text, r"(^|[ \t]+)#.*$", ""))
        return F.when(text.rlike(r"""^(["'])(.*?)\1[ \t]*(?:#.*)?$"""), quoted).otherwise(F.nullif(plain, F.lit("")))

    def last(name: str) -> Column:
        own = F.filter("lines", lambda x: F.regexp_extract(x, key, 1) == name)
        return F.element_at(F.transform(own, value), -1)

    lines = F.split(F.regexp_replace("value", "\r", ""), "\n")
    named = files.select(F.filter(lines, lambda x: x.rlike(key)).alias("lines"))
    renamed = {"budget_weekly": "budget_threshold_weekly"}

    def field(f: T.StructField) -> Column:
        name = renamed.get(f.name, f.name)
        known = F.exists("lines", lambda x: F.regexp_extract(x, key, 1) == name)
        return F.when(known, last(name)).cast(f.dataType).alias(f.name)

    return named.select(*[field(f) for f in TENANTS]).filter(F.col("tenant_id").isNotNull())


def with_budget(df: DataFrame, ten: DataFrame, *extra: str) -> DataFrame:
    """Add ``budget_weekly`` (and ``extra`` tenant columns); unknown tenants get the default."""
    joined = df.join(ten.select("tenant_id", "budget_weekly", *extra), "tenant_id", "left")
    return joined.withColumn(
        "budget_weekly", F.coalesce("budget_weekly", F.lit(DEFAULT_WEEKLY_BUDGET))
    )
