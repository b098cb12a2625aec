"""Reading events: stored tables, raw lines, streams; and decoding the wire format."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clock import Moment, clip, stamp
from ..functions.numeric import real
from ..schemas import EVENT_DEFAULTS, JOB_EVENTS, PARTITIONS, SLICED, STORED, WIRE_EVENT
from .slices import SliceTable


def slice_table(spark: SparkSession, root: str, name: str) -> SliceTable:
    return SliceTable(spark, f"{root}/{name}_slices", STORED[name], PARTITIONS[name])


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One stored table under ``root``, with its declared schema."""
    if name in SLICED and (table := slice_table(spark, root, name)).exists():
        return table.read()
    return spark.read.schema(STORED[name]).parquet(f"{root}/{name}")


def table_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def scan_events(
    ev: DataFrame,
    since: Moment | None = None,
    tenant: str | None = None,
    upto: Moment | None = None,
) -> DataFrame:
    """Optional tenant equality and start-time range, both fit for pushdown."""
    if tenant is not None:
        ev = ev.filter(F.col("tenant_id") == F.lit(tenant))
    if since is not None or upto is not None:
        ev = clip(ev, since=since, before=upto)
    return ev


def query(spark: SparkSession, text: str, tables: Mapping[str, DataFrame] | None = None, **args):
    """Ad-hoc SQL over named frames, with ``:name`` parameters. Errors are raised."""
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args or None)


# --- streams -----------------------------------------------------------------


def read_events_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    **options: str,
) -> DataFrame:
    """Topic as a stream of text lines (column ``value``)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic).option("startingOffsets", starting)
    reader = reader.option("failOnDataLoss", "false").options(**options)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_lines_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None):
    """Folder of text files as the same stream of lines."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


# --- decoding ----------------------------------------------------------------


def parse_lines(raw: DataFrame, schema: T.StructType = WIRE_EVENT) -> DataFrame:
    """Decode JSON lines; keeps ``value`` so that what fails can be put aside.

    Times become TIMESTAMP (a stream watermark needs that type); text that is
    no time becomes NULL instead of failing the job. ``inline`` keeps later
    filters on decoded columns above the decoding: pushed below a plain
    projection they would parse every line a second time.
    """
    decoded = raw.select("value", F.inline(F.array(F.from_json("value", schema))))
    times = [n for n in ("started_at", "completed_at", "emitted_at") if n in decoded.columns]
    return decoded.withColumns({n: F.try_to_timestamp(F.col(n)) for n in times})


def decode_events(
    raw: DataFrame, schema: T.StructType = WIRE_EVENT
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)``: events with an id, and the lines that gave none.

    The second reads nothing but the id out of a line.
    """
    good = parse_lines(raw, schema).filter(F.col("event_id").isNotNull()).drop("value")
    return good, rejected_lines(parse_lines(raw, T.StructType([schema["event_id"]])))


def rejected_lines(parsed: DataFrame) -> DataFrame:
    no_id = parsed.filter(F.col("event_id").isNull())
    readable = F.get_json_object("value", "$").isNotNull()
    reason = F.when(readable, F.lit("missing event_id")).otherwise(F.lit("malformed record"))
    return no_id.select("value", reason.alias("reason"))


def apply_defaults(ev: DataFrame, as_of: Moment) -> DataFrame:
    """Fill the columns that have a default; arrival time defaults to ``as_of``."""
    filled = {
        name: F.coalesce(F.col(name), F.lit(value))
        for name, value in EVENT_DEFAULTS.items()
        if name in ev.columns
    }
    arrival = stamp(as_of)
    if "ingested_at" in ev.columns:
        arrival = F.coalesce(F.col("ingested_at"), arrival)
    return ev.withColumns({**filled, "ingested_at": arrival})


def as_stored(ev: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Shape of the stored table: declared columns and types plus the date companions; NaN is NULL. ``keep``: columns to go along."""
    shaped = ev.select(
        *keep,
        *[
            (real(f.name) if f.dataType == T.DoubleType() else F.col(f.name).cast(f.dataType)).alias(f.name)
            for f in JOB_EVENTS
        ]
    )
    return shaped.withColumns(
        {"ingest_date": F.to_date("ingested_at"), "event_date": F.to_date("started_at")}
    )
