"""Structured Streaming sources, windowed and stateful features, sinks and health."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tallgrass.sources.scratch import shared_path

EVENT = "entity_id long, event_type string, ts timestamp, amount double"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def source(spark: SparkSession, kind: str, location: str, schema: str | None = None, rate: int | None = None, **options: str) -> DataFrame:
    """A stream of raw rows: 'kafka' (location: topic), or a file format (location: folder)."""
    if kind == "kinesis":
        raise ValueError("no open-source connector for this source; read it through kafka or files")
    reader = spark.readStream.format(kind).options(**options)
    if kind == "kafka":
        reader = reader.option("subscribe", location)
        return (reader.option("maxOffsetsPerTrigger", rate) if rate else reader).load()
    reader = reader.schema(schema) if schema else reader
    return (reader.option("maxFilesPerTrigger", rate) if rate else reader).load(location)


def parsed(raw: DataFrame, column: str = "value", delay: str | None = "10 minutes") -> DataFrame:
    """JSON rows as typed columns with a watermark; rows that don't parse have null columns and their text in raw."""
    df = raw.select(F.col(column).cast("string").alias("raw")).select("raw", F.from_json("raw", EVENT).alias("e")).select("raw", "e.*")
    return df.withWatermark("ts", delay) if delay else df


def tumbling(df: DataFrame, sizes: tuple[int, ...] = (60, 300, 900)) -> DataFrame:
    """Per entity and window of each size (seconds): count, sum, mean, spread, extremes, the last amount and the balance (sum of
    amounts up to the last row of the window is the caller's; here the window's net and its in- and outflow).

    A row is exploded into its windows, one of each size, and the size is a key: one query with one state serves all sizes, and
    the source is read once."""
    second = F.col("ts").cast("long")
    windows = F.array(*[F.struct(F.lit(s).alias("window_size"), (second - F.pmod(second, F.lit(s))).alias("start_sec")) for s in sizes])
    rows = df.withColumn("__w", F.explode(windows)).select("entity_id", "ts", "amount", "__w.*", F.window("ts", f"{max(sizes)} seconds").alias("__late"))
    inflow, outflow = F.sum(F.greatest("amount", F.lit(0.0))), F.sum(F.greatest(-F.col("amount"), F.lit(0.0)))
    g = rows.groupBy("entity_id", "__late", "window_size", "start_sec").agg(
        F.count("*").alias("n"), F.sum("amount").alias("total"), F.avg("amount").alias("mean"), F.stddev("amount").alias("std"), F.min("amount").alias("low"), F.max("amount").alias("high"),
        F.max_by("amount", F.struct("ts", "amount")).alias("last"), inflow.alias("inflow"), outflow.alias("outflow"),
    )
    return g.drop("__late")


def sessions(df: DataFrame, gap: str = "6 hours") -> DataFrame:
    """Activity sessions per entity: closed by a gap without rows."""
    g = df.groupBy("entity_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.sum("amount").alias("total"))
    return g.select("entity_id", F.col("w.start").alias("start"), "n", "total")


class Lifetime(StatefulProcessor):
    """Lifetime count, deposit sum, first and latest time and latest event per entity, kept in the state store; the state of
    an entity without rows for ttl_days goes."""

    def __init__(self, ttl_days: float | None):
        self.ttl_ms = int(ttl_days * 86_400_000) if ttl_days else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("lifetime", "n long, total double, first double, last double, event string", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, total, first, last, event = self.state.get() if self.state.exists() else (0, 0.0, float("inf"), float("-inf"), "")
        for batch in rows:
            n += len(batch)
            total += float(batch["amount"].clip(lower=0).sum())
            first = min(first, float(batch["sec"].min()))
            newest = batch.sort_values(["sec", "event_type"]).iloc[-1]
            if float(newest["sec"]) >= last:
                last, event = float(newest["sec"]), str(newest["event_type"])
        self.state.update((n, total, first, last, event))
        yield pd.DataFrame({"entity_id": [key[0]], "n": [n], "total": [total], "first_sec": [int(first)], "last_sec": [int(last)], "last_event": [event]})

    def close(self) -> None:
        pass


def lifetime(df: DataFrame, ttl_days: float | None = 30) -> DataFrame:
    """Updated lifetime totals of the entities in each batch (needs the RocksDB state store). With ttl_days the query runs
    until it is stopped, as state goes by the clock; None keeps all state, which is a plain aggregate that needs no Python for
    each entity, and availableNow ends."""
    rows = df.select("entity_id", "amount", "event_type", F.col("ts").cast("double").alias("sec"))
    if ttl_days:
        return rows.groupBy("entity_id").transformWithStateInPandas(Lifetime(ttl_days), "entity_id long, n long, total double, first_sec long, last_sec long, last_event string", "Update", "ProcessingTime")
    return rows.groupBy("entity_id").agg(
        F.count("*").alias("n"), F.sum(F.greatest("amount", F.lit(0.0))).alias("total"), F.min("sec").cast("long").alias("first_sec"), F.max("sec").cast("long").alias("last_sec"),
        F.max_by("event_type", F.struct("sec", "event_type")).alias("last_event"),
    )


def drain(stream: DataFrame, mode: str, name: str, batches: list | None = None, checkpoint: str | None = None, path: str | None = None) -> DataFrame:
    """Run a stream over what is there (availableNow) into the shared folder; in update mode each batch under its number. With
    the checkpoint and path of a run before, it goes on from there."""
    spark, path = stream.sparkSession, path or shared_path(stream.sparkSession, name)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint or shared_path(spark, f"{name}-checkpoint")).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", path).start()
    else:
        query = writer.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/batch={n}")).start()
    query.awaitTermination()
    if batches is not None:
        batches.extend(query.recentProgress)
    return spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in stream.schema)}{', batch long' if mode != 'append' else ''}").parquet(path)


def sink(stream: DataFrame, path: str, checkpoint: str, seconds: int | None = 30):
    """Append a stream to a Parquet folder, a batch every so many seconds (None: what is there, then end). A restart of
    the checkpoint may bring more columns; merged() reads the files of both."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)
    return writer.start(path)


def merged(spark: SparkSession, path: str) -> DataFrame:
    """All files that a sink wrote, with the columns of any of them; null where a file lacks one."""
    return spark.read.option("mergeSchema", True).parquet(path)


def newest(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Of update-mode output the last row of each key."""
    rest = [c for c in updates.columns if c not in (*keys, "batch")]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")


def arm_totals(rewards: DataFrame) -> DataFrame:
    """Pulls and rewards of each arm so far, updated by each batch of rewards (arm, reward)."""
    return rewards.groupBy("arm").agg(F.count("*").alias("pulls"), F.sum("reward").alias("reward"))


def arm_metrics(updates: DataFrame, last: int) -> DataFrame:
    """Of arm_totals' output by batch: pulls and mean reward so far, those of the batch, and the mean reward of an arm's last
    so many batches."""
    w = Window.partitionBy("arm").orderBy("batch")
    before = lambda c, k: F.coalesce(F.lag(c, k).over(w), F.lit(0))
    own, recent = (lambda c: F.col(c) - before(c, 1)), (lambda c: F.col(c) - before(c, last))
    return updates.select("arm", "batch", "pulls", (F.col("reward") / F.col("pulls")).alias("mean_reward"), own("pulls").alias("batch_pulls"), (own("reward") / own("pulls")).alias("batch_reward"), (recent("reward") / recent("pulls")).alias("rolling_reward"))


def split_invalid(batch: DataFrame, number: int, path: str, most_bad: float = 0.1) -> None:
    """For foreachBatch: rows without entity or time go to path/ok=false, the others to path/ok=true, in one write under the
    batch's number, so a repeated batch replaces itself. More than most_bad of them stops the stream before anything is
    written."""
    rows = batch.withColumn("ok", F.col("entity_id").isNotNull() & F.col("ts").isNotNull())
    rows = rows.withColumn("raw", F.when(~F.col("ok"), F.col("raw"))).persist()
    try:
        share = rows.agg(F.avg((~F.col("ok")).cast("double"))).first()[0] or 0.0
        if share > most_bad:
            raise ValueError(f"{share:.1%} of the events are invalid")
        rows.write.mode("overwrite").partitionBy("ok").parquet(f"{path}/batch={number}")
    finally:
        rows.unpersist()


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches that are written whole below path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in files.listStatus(place)] if files.exists(place) else []
    return sorted(int(f.getName().removeprefix("batch=")) for f in found if f.getName().startswith("batch=") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS")))


def recalibrated(stream: DataFrame, name: str, label: str, p: str, window: int, checkpoint: str | None = None, path: str | None = None) -> DataFrame:
    """(batch, rows, before, after): each batch's Brier score by the curve of the batches before it and by one refitted on
    the window latest rows of all, written under the batch's number.

    The window is a table beside the checkpoint, one version a batch; a curve is what isotonic regression makes of a version,
    so a restart with the same checkpoint and path goes on as if there had been no stop, and a batch that is repeated starts
    from the version before it. Versions but the last two go. Rows of one time are ordered by outcome and score, so the edge of
    the window doesn't depend on how rows arrive."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import IsotonicRegression

    spark = stream.sparkSession
    path, checkpoint = path or shared_path(spark, name), checkpoint or shared_path(spark, f"{name}-checkpoint")
    kept = f"{checkpoint.rstrip('/')}-window"
    vectors = VectorAssembler(inputCols=[p], outputCol="__features")
    head = f"ts timestamp, `{label}` double, `{p}` double"

    def held(number: int | None) -> DataFrame:
        return spark.read.schema(head).parquet(f"{kept}/batch={number}") if number is not None else spark.createDataFrame([], head)

    def fitted(rows: DataFrame):
        return IsotonicRegression(featuresCol="__features", labelCol=label).fit(vectors.transform(rows)) if rows.take(1) else None

    def brier(rows: DataFrame, model) -> float | None:
        scored = model.transform(vectors.transform(rows)).withColumn("__q", F.col("prediction")) if model else rows.withColumn("__q", F.col(p))
        return scored.agg(F.avg((F.col("__q") - F.col(label)) ** 2)).first()[0]

    def step(batch: DataFrame, n: int) -> None:
        rows = batch.select("ts", F.col(label).cast("double").alias(label), F.col(p).cast("double").alias(p)).where(F.col(label).isNotNull() & F.col(p).isNotNull())
        earlier = [k for k in _batches(spark, kept) if k < n]
        past = held(earlier[-1] if earlier else None)
        latest = rows.unionByName(past).orderBy(F.desc("ts"), F.desc(label), F.desc(p)).limit(window)
        latest.write.mode("overwrite").parquet(f"{kept}/batch={n}")
        found = [(rows.count(), brier(rows, fitted(past)), brier(rows, fitted(held(n))))]
        spark.createDataFrame(found, "rows long, before double, after double").coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={n}")
        for old in earlier[:-1]:
            _remove(spark, f"{kept}/batch={old}")

    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start().awaitTermination()
    return spark.read.schema("rows long, before double, after double, batch long").parquet(path)


def health(spark: SparkSession, progress: list) -> DataFrame:
    """(batch, rows, input_rate, processed_rate, behind) from a query's progress reports."""
    rows = [(p["batchId"], p["numInputRows"], float(p["inputRowsPerSecond"] or 0), float(p["processedRowsPerSecond"] or 0)) for p in progress]
    return spark.createDataFrame(rows, "batch long, rows long, input_rate double, processed_rate double").withColumn("behind", F.col("processed_rate") < F.col("input_rate"))
