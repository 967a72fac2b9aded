"""Online CUSUM monitor (M5) on Structured Streaming.

Plan: event stream -> watermark -> native windowed aggregate per
(entity, event-time day): mean, population std and count of the residual
-> per-entity stateful fold (``transformWithStateInPandas``) holding only
(cusum_pos, cusum_neg) -> one output row per closed day, with alerts.

The state per entity is two doubles; raw rows never reach Python (the
aggregation is JVM-side). Several closed days can arrive in one call, so
they are sorted by window start before folding. A day is emitted once the
watermark passes its end; rows later than the watermark are dropped
(Spark's late-data policy). The fold is the same as the batch ``cusum``
(positive side checked first, only the side that fired resets).
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tillcast.session import ensure_checkpoint_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

OUTPUT = T.StructType([
    T.StructField("entity", T.StringType()), T.StructField("batch", T.DateType()),
    T.StructField("mean_residual", T.DoubleType()), T.StructField("std_residual", T.DoubleType()),
    T.StructField("n_samples", T.LongType()), T.StructField("cusum_pos", T.DoubleType()),
    T.StructField("cusum_neg", T.DoubleType()), T.StructField("alert", T.StringType()),
    T.StructField("alert_value", T.DoubleType()),
])
STATE = T.StructType([T.StructField("pos", T.DoubleType()), T.StructField("neg", T.DoubleType())])


class CusumProcessor(StatefulProcessor):
    """Per-entity two-sided CUSUM over closed daily batches."""

    def __init__(self, threshold: float = 5.0, k_factor: float = 0.5):
        self.threshold = threshold
        self.k_factor = k_factor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("cusum", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N803
        self.state.update((float(initialState["cusum_pos"].iloc[0]), float(initialState["cusum_neg"].iloc[0])))

    def handleInputRows(self, key, rows, timerValues):
        batches = pd.concat(list(rows), ignore_index=True).sort_values("batch", kind="stable")
        pos, neg = (0.0, 0.0)
        if self.state.exists():
            pos, neg = self.state.get()
        out = []
        for r in batches.itertuples(index=False):
            k = self.k_factor * r.std_residual
            p = max(0.0, pos + r.mean_residual - k)
            n = max(0.0, neg - r.mean_residual - k)
            alert, value = None, None
            if p > self.threshold:
                alert, value, p = "POSITIVE_DRIFT", p, 0.0
            elif n > self.threshold:
                alert, value, n = "NEGATIVE_DRIFT", n, 0.0
            pos, neg = p, n
            out.append((key[0], r.batch, r.mean_residual, r.std_residual, int(r.n_samples), pos, neg, alert, value))
        self.state.update((pos, neg))
        yield pd.DataFrame(out, columns=[f.name for f in OUTPUT.fields])

    def close(self) -> None:
        pass


def daily_batches(events: DataFrame, entity: str, ts: str, residual, watermark: str = "1 hour") -> DataFrame:
    """Native streaming aggregate: residual mean / population std / count per (entity, day).

    Days are UTC days. A zone-less (NTZ) event time is turned into the
    instant whose UTC wall clock equals it (from its fields, independent of
    the session time zone), so the stream's days are the calendar days of
    the batch form; the batch date is read from the window start's epoch day.
    """
    if isinstance(events.schema[ts].dataType, T.TimestampNTZType):
        t = F.col(ts)
        secs = (F.unix_date(F.to_date(t)).cast("long") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
                + F.second(t))
        events = events.withColumn(ts, F.timestamp_seconds(secs))
    return (events.withWatermark(ts, watermark)
            .groupBy(F.col(entity).alias("entity"), F.window(ts, "1 day").alias("w"))
            .agg(F.avg(residual).alias("mean_residual"), F.stddev_pop(residual).alias("std_residual"),
                 F.count(residual).alias("n_samples"))
            .select("entity", F.date_from_unix_date(F.floor(F.unix_seconds(F.col("w.start")) / 86400).cast("int"))
                    .alias("batch"), "mean_residual", "std_residual", "n_samples"))


def cusum_stream(events: DataFrame, entity: str, ts: str, residual, threshold: float = 5.0,
                 k_factor: float = 0.5, watermark: str = "1 hour", initial: DataFrame | None = None) -> DataFrame:
    """Streaming DataFrame of per-day CUSUM states and alerts (append mode).

    ``initial`` (``drift.last_states`` of a batch fold or of an earlier stream's rows) warms the
    state up: the stream goes on where those days ended. Its events must be later ones."""
    b = daily_batches(events, entity, ts, residual, watermark)
    start = None if initial is None else initial.select(F.col("entity").cast("string").alias("entity"), "cusum_pos", "cusum_neg").groupBy("entity")
    return b.groupBy("entity").transformWithStateInPandas(
        CusumProcessor(threshold, k_factor), OUTPUT, "Append", "None", initialState=start)


def run_to_table(spark: SparkSession, stream: DataFrame, name: str | None = None) -> DataFrame:
    """Drive a streaming DataFrame over all available input (availableNow) into
    Parquet files under ``spark.checkpoint.dir`` (exactly once) and read them back.
    The session's state store setting is put back afterwards."""
    key = "spark.sql.streaming.stateStore.providerClass"
    name = name or f"tc_stream_{uuid.uuid4().hex[:8]}"
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        q = (stream.writeStream.format("parquet").outputMode("append").option("path", f"{base}/rows")
             .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def event_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
                 max_files: int | None = None) -> DataFrame:
    """File-source stream over parquet files of ``folder`` matching ``pattern``."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)
