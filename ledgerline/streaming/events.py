"""Event stream: build (ST5), enrich (ST1/ST6), keyed Kafka records (K5/ST4), file and Kafka
sources (S4/S5), a file sink (K4) and a warehouse sink with offset tracking (ST3), and runs bounded by a
number of messages (ST2).

The enrich step is stateless, so it is the same column expressions in batch and in streaming. A micro-batch
is read once, replaces the folders that carry its id, and then commits its offsets, so a batch that runs again after a
failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import nan_to_null
from ..operators.ranking import sequence_in_group
from ..schemas import EVENT
from ..session import scratch_tables
from ..sources import json_arrays
from ..sources.warehouse import LOAD, LoadResult, load_by_date, read_loads

# Fixed values (parameters with the reference's defaults).
HIGH_VALUE = 50.0
EVENT_FEE_RATE = 0.005
CORRUPT = json_arrays.CORRUPT
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def build_events(ledger: DataFrame, fee_rate: float = EVENT_FEE_RATE) -> DataFrame:
    """ST5: ledger rows -> event records (PENDING, fee from the amount, ISO timestamp text)."""
    return ledger.select(
        "tx_hash", "sender", "receiver", "amount",
        F.round(F.col("amount") * F.lit(fee_rate), 8).alias("fee"),
        F.lit("PENDING").alias("status"),
        "network",
        F.date_format("timestamp", ISO_FORMAT).alias("timestamp"))


def enrich_events(events: DataFrame, high_value: float = HIGH_VALUE) -> DataFrame:
    """ST1/ST6: amount = max(number or 0, 0); 0 -> status INVALID; > high_value -> flag HIGH_VALUE.

    The amount may arrive as a number, a numeric string, junk or nothing: it is read as text and
    converted with try_cast; NaN counts as missing.
    """
    raw = F.col("amount").cast("string")
    amt = F.greatest(F.coalesce(nan_to_null(raw.try_cast("double")), F.lit(0.0)), F.lit(0.0))
    out = events.withColumn("amount", amt)
    return (out.withColumn("status", F.when(F.col("amount") == 0, F.lit("INVALID")).otherwise(F.col("status")))
            .withColumn("flag", F.when((F.col("amount") != 0) & (F.col("amount") > F.lit(high_value)),
                                       F.lit("HIGH_VALUE"))))


# ---- Kafka (S4, K5, ST4) ---------------------------------------------------------------------

def to_kafka_records(events: DataFrame, key: str = "network", fields: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """K5/ST4: key = network (one network stays in one Kafka partition), value = JSON of ``fields`` (default: all); the
    columns ``keep`` stay beside them."""
    return events.select(F.col(key).cast("string").alias("key"),
                         F.to_json(F.struct(*[F.col(c) for c in fields or events.columns])).alias("value"), *(keep or []))


def parse_kafka_records(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """S4 payload: binary/text key and JSON value -> key, event columns and ``_corrupt_record``: the value's text where it
    is no event (no JSON object, a field of the wrong type; a missing value is the empty text), else NULL. The columns
    ``keep`` of the records stay."""
    schema = StructType([*EVENT.fields, StructField(CORRUPT, StringType())])
    value = F.col("value").cast("string")
    kept = keep or []
    parsed = records.select(*kept, F.col("key").cast("string").alias("key"), value.alias("value"),
                            F.from_json(value, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("e"))
    bad = F.when(F.col("value").isNull(), F.lit("")).when(F.col("e").isNull(), F.col("value")).otherwise(F.col(f"e.{CORRUPT}"))
    return parsed.select("key", *kept, *[f"e.{f.name}" for f in EVENT.fields], bad.alias(CORRUPT))


def to_ordered_records(events: DataFrame, key: str = "network", time: str = "timestamp") -> DataFrame:
    """K5/ST4 with order: the records of ``to_kafka_records`` and ``seq``, 1..n inside each key by time, then hash, then
    the other fields. A hot key is numbered by many tasks, and its records may be sent by many at once: a consumer puts them
    in order by ``seq`` (``ready_records``). Equal events are numbered one after another."""
    rest = [c for c in events.columns if c not in (key, time, "tx_hash")]
    ordered = events.withColumn("_order", F.struct(time, "tx_hash", *rest))
    records = to_kafka_records(ordered, key, events.columns, ["_order"])
    return sequence_in_group(records, ["key"], "_order", "seq").drop("_order")


def in_key_order(records: DataFrame) -> DataFrame:
    """``records`` over many tasks, each key's in ascending ``seq`` inside a task and from one task to the next."""
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return records.repartitionByRange(n, "key", "seq").sortWithinPartitions("key", "seq")


def write_ordered_files(records: DataFrame, path: str) -> None:
    """The file stand-in for an ordered topic: read in the order of their names, the files give each key's records in order."""
    in_key_order(records).write.mode("overwrite").json(path)


def ready_records(records: DataFrame) -> DataFrame:
    """The merge rule of a consumer: of what has arrived (key, value, seq) every record that no record of its key is missing
    before, once each. Its place among the key's distinct numbers then equals its number. Order them by ``in_key_order``;
    a record that waits for an earlier one, or has no number, is left out until it comes again with the missing one."""
    once = records.where("seq >= 1").groupBy("key", "seq").agg(F.min("value").alias("value"))
    placed = sequence_in_group(once, ["key"], "seq", "_place")
    return placed.where("_place = seq").select("key", "value", "seq")


def write_kafka(events: DataFrame, bootstrap: str, topic: str) -> None:
    """K5 batch write, each task in key order, the number as header ``seq``. Needs the Kafka connector on the classpath (not
    bundled with PySpark)."""
    numbered = in_key_order(to_ordered_records(events))
    header = F.array(F.struct(F.lit("seq").alias("key"), F.col("seq").cast("string").cast("binary").alias("value")))
    (numbered.select("key", "value", header.alias("headers")).write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
     .option("kafka.acks", "all").option("includeHeaders", True).option("topic", topic).save())


def read_kafka_stream(spark: SparkSession, bootstrap: str, topic: str,
                      max_per_trigger: int | None = None) -> DataFrame:
    """From the earliest offsets; ``max_per_trigger`` records per micro-batch, if given. Pass the
    result to ``run_enrich_stream``."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return parse_kafka_records(reader.load())


# ---- files (S5, K4, ST2, ST3) ----------------------------------------------------------------

FILE_ROWS = 100_000             # messages of one file


def write_event_files(events: DataFrame, path: str, rows: int = FILE_ROWS) -> None:
    """Land events as JSON-lines files (the file stand-in for a topic) of at most ``rows`` messages, so there are more files
    when there are more events. Each task writes what it has; nothing is shuffled."""
    events.write.mode("overwrite").option("maxRecordsPerFile", rows).json(path)


def read_event_stream(spark: SparkSession, path: str, multiline: bool = False,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of JSON event files: JSON lines with the event schema and ``_corrupt_record``, the text of what cannot be
    parsed; or with ``multiline`` JSON arrays (or objects), as text that ``parsed_batch`` parses by many tasks a file."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if multiline:
        return reader.option("lineSep", ",").text(path).select(
            "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    schema = StructType([*EVENT.fields, StructField(CORRUPT, StringType())])
    return reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def parsed_batch(batch: DataFrame) -> DataFrame:
    """The events of a micro-batch with ``_corrupt_record``, whichever source it comes from."""
    if batch.columns == ["value", "file", "block"]:
        return json_arrays.parse(json_arrays.elements(batch), EVENT, CORRUPT)
    return batch if CORRUPT in batch.columns else batch.withColumn(CORRUPT, F.lit(None).cast("string"))


def _run(source: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Everything that ``source`` has now, in micro-batches; no time limit: it returns at the end of the data, or raises."""
    query = source.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_enrich_stream(source: DataFrame, sink: str, checkpoint: str) -> None:
    """ST1 + K4 + ST3: process everything that ``source`` (a file or Kafka stream of events) has now, then stop.

    Each micro-batch is read and parsed once; its events go to ``<sink>/batch=<id>`` and the records that could not be
    parsed to ``<sink>_corrupt/batch=<id>``. Both folders are overwritten when Spark runs a batch again after a failure, and
    its offsets are committed after them, so every record is there once."""

    def work(batch: DataFrame, batch_id: int) -> None:
        events = parsed_batch(batch).persist()
        try:
            good = enrich_events(events.where(F.col(CORRUPT).isNull()).drop(CORRUPT))
            good.write.mode("overwrite").json(f"{sink.rstrip('/')}/batch={batch_id}")
            bad = events.where(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "record")
            bad.write.mode("overwrite").json(f"{sink.rstrip('/')}_corrupt/batch={batch_id}")
        finally:
            events.unpersist()

    _run(source, checkpoint, work)


# ---- into the warehouse (ST1 -> K7) ------------------------------------------------------------

def event_rows(events: DataFrame) -> DataFrame:
    """Enriched events as warehouse rows: with ``date_key`` from the event's time, NULL without a readable one."""
    day = F.to_date(F.col("timestamp").try_cast("timestamp_ntz"))
    return events.withColumn("date_key", (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int"))


def load_event_batch(batch: DataFrame, batch_id: int, path: str, name: str = "stream") -> LoadResult:
    """One micro-batch into the warehouse, as load ``<name>-<batch_id>``: the batch id is the commit mark, since a batch
    that Spark runs again replaces its own folders. Source and parser run once. Corrupt records go to
    ``<path>_corrupt``; events without a hash are the load's rejects."""
    load_id = f"{name}-{batch_id}"
    with scratch_tables(batch.sparkSession) as stage:
        events = stage(parsed_batch(batch), "event-batch")
        good = event_rows(enrich_events(events.where(F.col(CORRUPT).isNull()).drop(CORRUPT)))
        result = load_by_date(good, path, load_id)
        bad = events.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record"))
        bad.write.mode("overwrite").parquet(f"{path.rstrip('/')}_corrupt/{LOAD}={load_id}")
    return result


def stream_into_warehouse(source: DataFrame, path: str, checkpoint: str, name: str = "stream") -> StreamingQuery:
    """ST1 -> K7: everything that ``source`` has now is enriched and loaded by date, each event once. ``name`` belongs to
    the checkpoint: another stream into the same table needs another one."""
    return _run(source, checkpoint, lambda batch, batch_id: load_event_batch(batch, batch_id, path, name) and None)


# ---- bounded by messages (ST2) -----------------------------------------------------------------

@dataclass(frozen=True)
class Position:
    """The next message: files come by time of change and name, messages by their place in the file."""

    run: int
    modified: datetime | None = None
    file: str | None = None
    message: int = 0


def last_position(spark: SparkSession, checkpoint: str) -> Position:
    log = read_loads(spark, checkpoint)
    row = None if log is None else log.orderBy(F.desc("run")).first()
    return Position(0) if row is None else Position(int(row["run"]), row["modified"], row["file"], row["message"])


def consume_bounded(spark: SparkSession, src: str, sink: str, checkpoint: str, max_messages: int) -> int:
    """ST2: take exactly the next ``max_messages`` JSON lines under ``src`` (all there are, if fewer), enrich them into
    ``<sink>/run=<n>``, and remember the place in ``checkpoint``. Returns the number of messages taken.

    Admission is planned by offsets before anything is read into the sink: the lines of each split are counted, a running
    sum over the splits (one row each) numbers them, and the end falls on a file and a message. The sink's folder is
    overwritten and the place is written after it, so a run that failed anywhere is repeated as it was. Messages that are
    no event count, and go to ``<sink>_corrupt/run=<n>``. Files must not change once they are there; new ones are later.
    """
    at = last_position(spark, checkpoint)
    lines = spark.read.text(src).select("value", F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_path").alias("file"),
                                        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    if at.file is not None:
        here = F.lit(at.modified)
        lines = lines.where((F.col("modified") > here) | ((F.col("modified") == here) & (F.col("file") >= at.file)))
    split = ["modified", "file", "block"]
    with scratch_tables(spark) as stage:
        counted = lines.groupBy(*split).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
        before = F.coalesce(F.sum("n").over(Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        in_file = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        splits = stage(counted.withColumns({"start": before, "in_file": in_file}), "splits")
        stop = at.message + max_messages
        end = splits.where((F.col("start") < stop)).orderBy(F.desc("start"), F.desc("n")).first()
        if end is None or end["start"] + end["n"] <= at.message:
            return 0
        taken = min(end["n"], stop - end["start"])
        keys = splits.where(F.col("start") < stop).select(F.col("file").alias("_f"), F.col("block").alias("_b"), "first", "start")
        number = F.col("place") - F.col("first") + F.col("start")
        admitted = (lines.join(keys, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b"))).where((number >= at.message) & (number < stop))
                    .select(F.lit(None).cast("string").alias("key"), "value"))
        events = stage(parse_kafka_records(admitted).drop("key"), "admitted")
        run = at.run + 1
        enrich_events(events.where(F.col(CORRUPT).isNull()).drop(CORRUPT)).write.mode("overwrite").json(f"{sink.rstrip('/')}/run={run}")
        events.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record")).write.mode("overwrite").json(f"{sink.rstrip('/')}_corrupt/run={run}")
        place = spark.createDataFrame([(end["modified"], end["file"], int(end["in_file"] + taken))], "modified timestamp, file string, message long")
        place.coalesce(1).write.mode("overwrite").parquet(f"{checkpoint.rstrip('/')}/run={run}")
    return int(end["start"] + taken - at.message)
