"""Streams: scoring by a saved model, windowed telemetry, deduplication, and named hooks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.shared import kept
from quillon.functions.text import store_key
from quillon.operators.pooling import apply_pool, load_pool


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None):
    """Score each micro-batch of entities with a batch function and hand it to an idempotent sink (by batch number)."""

    def batch(df: DataFrame, number: int) -> None:
        sink(score(df), number)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stamped(stream: DataFrame, column: str = "ts") -> DataFrame:
    """A timestamp column fit for watermarks (time-zone-less timestamps are not)."""
    return stream.withColumn(column, F.col(column).cast("timestamp"))


def telemetry_stream(stream: DataFrame, *, window: str = "5 minutes", slide: str | None = None, late: str = "10 minutes", key: str = "event_type", value: str = "value", ts: str = "ts") -> DataFrame:
    """key, start, end, n, total, peak by tumbling or sliding windows; rows later than the watermark are dropped."""
    rows = stamped(stream, ts).withWatermark(ts, late)
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    out = rows.groupBy(span.alias("_w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.max(value).alias("peak"))
    return out.select(key, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), "n", "total", "peak")


def session_stream(stream: DataFrame, *, gap: str = "30 minutes", late: str = "10 minutes", key: str = "user_id", ts: str = "ts") -> DataFrame:
    """key, start, end, n by sessions that a gap closes."""
    rows = stamped(stream, ts).withWatermark(ts, late)
    out = rows.groupBy(F.session_window(ts, gap).alias("_w"), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), "n")


def dedupe_stream(stream: DataFrame, *, structure: str = "smiles", ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """The first row of each structure within the watermark's reach; state is dropped as the watermark passes."""
    rows = stamped(stream, ts).withColumn("key", store_key(F.col(structure))).withWatermark(ts, late)
    return rows.dropDuplicatesWithinWatermark(["key"])


def dedupe_store(stream: DataFrame, store: str, checkpoint: str, *, key: str = "key", order: str = "ts", trigger: dict | None = None):
    """Append the rows of keys that no earlier micro-batch had to a store of Parquet, a folder a batch; of rows of one key in
    a batch the first by `order` stays.

    What was seen is the store itself, so it has no horizon and survives lost executors and restarts; a batch that runs
    again overwrites its own folder and reads earlier ones alone."""

    def batch(df: DataFrame, number: int) -> None:
        spark, at = df.sparkSession, f"{store}/batch={number}"
        first = df.groupBy(key).agg(F.min(F.struct(order, *(c for c in df.columns if c not in (key, order)))).alias("_row")).select(key, "_row.*")
        if number:
            seen = spark.read.schema(first.schema).option("basePath", store).parquet(store).filter(F.col("batch") < number)
            first = first.join(seen.select(key), key, "left_anti")
        first.write.mode("overwrite").parquet(at)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def pooled_stream(stream: DataFrame, scores: Callable[[DataFrame], DataFrame], model: str, out: str, checkpoint: str, *, trigger: dict | None = None, **signals: bool):
    """Pool each micro-batch by a saved pool model (see pooling.save_pool): scores makes (compound_id, descriptor, p, ...) of
    the entities, and a folder a batch is written below `out`. The model is read at each batch, so a new one is picked up."""

    def score(df: DataFrame) -> DataFrame:
        # the entities are read once
        return apply_pool(kept(scores(df), "scores"), load_pool(df.sparkSession, model), **signals)

    return score_stream(stream, score, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"), checkpoint, trigger)


def run_to_end(stream: DataFrame, build: Callable[[DataFrame], DataFrame], at: str, *, ts: str = "ts", end: str = "9999-01-01") -> DataFrame:
    """The rows of build(stream) over all there is now, with the windows that are open at its end, as a table below `at`.

    A second run on the same state reads one closing row, null but for its time `end`; it moves the watermark past every
    window, and its own window stays open, so it adds nothing. For a stream that is over: later rows would be too late.
    """
    spark, schema = stream.sparkSession, stream.schema
    spark.createDataFrame([], schema).write.parquet(f"{at}/closing")
    built = build(stream.unionByName(spark.readStream.schema(schema).parquet(f"{at}/closing")))
    for closing in (False, True):
        if closing:
            row = (F.lit(end if f.name == ts else None).cast(f.dataType).alias(f.name) for f in schema.fields)
            spark.range(1).select(*row).write.mode("append").parquet(f"{at}/closing")
        sink = built.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state")
        sink.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(built.schema).parquet(f"{at}/out")


def register_hooks(spark: SparkSession, functions: dict[str, Callable], tables: dict[str, Callable] | None = None) -> list[str]:
    """Register pandas or plain user functions, and user table functions, under their names, for SQL."""
    for name, fn in functions.items():
        spark.udf.register(name, fn)
    for name, fn in (tables or {}).items():
        spark.udtf.register(name, fn)
    return sorted([*functions, *(tables or {})])
