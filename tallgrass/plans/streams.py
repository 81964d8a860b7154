"""Queries of the streaming operators: events as a file stream, drained with availableNow, against batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators.windows import rounded
from tallgrass.sources.scratch import shared_path
from tallgrass.sources.tables import TXN, scores, txn
from tallgrass.streaming import streams as x

from .registry import query
from .windows import r


def events(spark, sf_dir, files: int = 4):
    """Transactions as a stream of JSON files in the order of time, a file in each batch."""
    path = shared_path(spark, "events-json")
    rows = txn(spark, sf_dir).select("entity_id", F.col("category").alias("event_type"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"), "amount")
    rows.repartitionByRange(files, "ts").select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    return x.parsed(x.source(spark, "text", path, rate=1), delay="60 days")


@query("X1_stream_sources", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def x1(spark, sf_dir):
    found = x.drain(events(spark, sf_dir).drop("raw"), "append", "x1")
    return found.groupBy("event_type").agg(F.count("*").alias("n"))


@query("X2_stream_parse", f"WITH {TXN} SELECT entity_id, count(*) AS n, {r('sum(amount)', 'total', 2)} FROM txn GROUP BY 1")
def x2(spark, sf_dir):
    found = x.drain(events(spark, sf_dir).drop("raw"), "append", "x2")
    return rounded(found.groupBy("entity_id").agg(F.count("*").alias("n"), F.sum("amount").alias("total")), ["entity_id", "n"], ["total"], 2)


X3 = " UNION ALL ".join(f"""SELECT CAST({w} AS BIGINT) AS window_size, entity_id, CAST(floor(sec / {w}) * {w} AS BIGINT) AS start_sec, count(*) AS n, {r('sum(amount)', 'total', 2)}, {r('avg(amount)', 'mean', 2)}, {r('stddev_samp(amount)', 'std', 2)},
{r('min(amount)', 'low', 2)}, {r('max(amount)', 'high', 2)}, {r('arg_max(amount, (ts, amount))', 'last', 2)}, {r('sum(greatest(amount, 0))', 'inflow', 2)}, {r('sum(greatest(-amount, 0))', 'outflow', 2)} FROM txn GROUP BY 2, 3""" for w in (60, 300, 900))


@query("X3_tumbling_features", f"WITH {TXN} {X3}")
def x3(spark, sf_dir):
    found = x.newest(x.drain(x.tumbling(events(spark, sf_dir)), "update", "x3"), ["window_size", "entity_id", "start_sec"])
    found = found.withColumn("window_size", F.col("window_size").cast("long"))
    return rounded(found, ["window_size", "entity_id", "start_sec", "n"], ["total", "mean", "std", "low", "high", "last", "inflow", "outflow"], 2)


@query("X4_lifetime_state", f"WITH {TXN} SELECT entity_id, count(*) AS n, {r('sum(CASE WHEN amount > 0 THEN amount ELSE 0 END)', 'total', 2)}, min(sec) AS first_sec, max(sec) AS last_sec, arg_max(category, (ts, category)) AS last_event, max(sec) // 86400 - min(sec) // 86400 AS days_active FROM txn GROUP BY 1")
def x4(spark, sf_dir):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", x.ROCKS)
    try:
        found = x.drain(x.lifetime(events(spark, sf_dir), None), "update", "x4")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    days = F.floor(F.col("last_sec") / 86400) - F.floor(F.col("first_sec") / 86400)
    return rounded(x.newest(found, ["entity_id"]).withColumn("days_active", days), ["entity_id", "n", "first_sec", "last_sec", "last_event", "days_active"], ["total"], 2)


@query("X5_stream_sink", f"WITH {TXN} SELECT CAST(day AS VARCHAR) AS day, count(*) AS n, count(CASE WHEN event_id % 2 = 1 THEN 1 END) AS marked FROM txn GROUP BY 1")
def x5(spark, sf_dir):
    """Even events, then, after the stream has got a column more, odd ones: one folder, read with both schemas merged."""
    path, checkpoint, out = (shared_path(spark, n) for n in ("x5-in", "x5-checkpoint", "x5"))
    rows = txn(spark, sf_dir)
    for odd in (0, 1):
        part = rows.where(F.col("event_id") % 2 == odd).select("entity_id", "day")
        (part.withColumn("mark", F.lit("new")) if odd else part).write.mode("append").parquet(path)
        x.sink(x.source(spark, "parquet", path, "entity_id long, day date" + ", mark string" * odd), out, checkpoint, None).awaitTermination()
    return x.merged(spark, out).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"), F.count("mark").alias("marked"))


X6 = f"""WITH {TXN}, m AS (SELECT max(epoch(ts)) - 600 AS mark FROM txn WHERE event_id % 20 <> 0) SELECT entity_id, CAST(floor(sec / 3600) * 3600 AS BIGINT) AS start_sec, count(*) AS n
FROM txn, m WHERE event_id % 20 <> 0 OR floor(sec / 3600) * 3600 + 3600 > mark GROUP BY 1, 2"""


@query("X6_late_data", X6)
def x6(spark, sf_dir):
    """A twentieth of the events comes after all others: those whose window is over by ten minutes are dropped."""
    path, checkpoint, out = (shared_path(spark, n) for n in ("x6-in", "x6-checkpoint", "x6"))
    late = F.col("event_id") % 20 == 0
    for rows in (txn(spark, sf_dir).where(~late), txn(spark, sf_dir).where(late)):
        value = F.to_json(F.struct("entity_id", F.col("category").alias("event_type"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"), "amount"))
        rows.select(value.alias("value")).write.mode("append").text(path)
        counted = x.parsed(x.source(spark, "text", path)).groupBy("entity_id", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"))
        found = x.drain(counted.select("entity_id", F.col("w.start").alias("start"), "n"), "update", "x6", checkpoint=checkpoint, path=out)
    return x.newest(found, ["entity_id", "start"]).select("entity_id", F.col("start").cast("long").alias("start_sec"), "n")


@query("X7_dead_letter", "SELECT count(*) FILTER (event_id % 50 <> 0) AS good, count(*) FILTER (event_id % 50 = 0) AS bad, count(*) FILTER (event_id % 50 = 0) AS kept_texts FROM events")
def x7(spark, sf_dir):
    path, out = shared_path(spark, "x7-in"), shared_path(spark, "x7")
    rows = txn(spark, sf_dir).select(F.when(F.col("event_id") % 50 == 0, "{broken").otherwise(F.to_json(F.struct("entity_id", F.col("category").alias("event_type"), "ts", "amount"))).alias("value"))
    rows.write.text(path)
    stream = x.parsed(x.source(spark, "text", path), delay=None)
    stream.writeStream.option("checkpointLocation", shared_path(spark, "x7-checkpoint")).trigger(availableNow=True).foreachBatch(lambda b, n: x.split_invalid(b, n, out)).start().awaitTermination()
    found = spark.read.parquet(out).withColumn("ok", F.col("ok").cast("boolean"))
    return found.agg(F.count_if("ok").alias("good"), F.count_if(~F.col("ok")).alias("bad"), F.count("raw").alias("kept_texts"))


@query("X10_dynamic_calibration")
def x10(spark, sf_dir):
    """Orders in the order of time; the probability is squared, so a curve has something to correct."""
    path = shared_path(spark, "x10-in")
    rows = scores(spark, sf_dir).select(F.col("day").cast("timestamp").alias("ts"), "label", (F.col("p") * F.col("p")).alias("p"))
    rows.repartitionByRange(4, "ts").write.parquet(path)
    stream = x.source(spark, "parquet", path, "ts timestamp, label int, p double", rate=1)
    return x.recalibrated(stream, "x10", "label", "p", 2000)


@query("X8_stream_health", "SELECT count(*) AS rows, 4 AS batches, true AS measured FROM events")
def x8(spark, sf_dir):
    batches: list = []
    x.drain(events(spark, sf_dir).drop("raw"), "append", "x8", batches)
    found = x.health(spark, batches).where("rows > 0")
    return found.agg(F.sum("rows").alias("rows"), F.count("*").alias("batches"), F.bool_and((F.col("processed_rate") > 0) & F.col("behind").isNotNull()).alias("measured"))


X9 = f"""WITH {TXN}, b AS (SELECT category AS arm, least(3, (day - DATE '2024-01-01') // 8) AS batch, CAST(abs(amount) > 30 AS INT) AS reward FROM txn), g AS (SELECT arm, batch, count(*) AS n, sum(reward) AS s FROM b GROUP BY 1, 2)
SELECT arm, CAST(batch AS BIGINT) AS batch, CAST(sum(n) OVER w AS BIGINT) AS pulls, {r('sum(s) OVER w / sum(n) OVER w', 'mean_reward')}, n AS batch_pulls, {r('s / n', 'batch_reward')}, {r('sum(s) OVER p / sum(n) OVER p', 'rolling_reward')} FROM g
WINDOW w AS (PARTITION BY arm ORDER BY batch), p AS (PARTITION BY arm ORDER BY batch ROWS 1 PRECEDING)"""


@query("X9_online_bandit", X9)
def x9(spark, sf_dir):
    """Rewards in four batches of eight days: an arm's figures so far, those of the batch, and those of the last two."""
    path, checkpoint, out = (shared_path(spark, n) for n in ("x9-in", "x9-checkpoint", "x9"))
    rows = txn(spark, sf_dir).select(F.col("category").alias("arm"), (F.abs("amount") > 30).cast("double").alias("reward"), F.least(F.lit(3), F.floor(F.datediff("day", F.lit("2024-01-01")) / 8)).alias("k"))
    for k in range(4):
        rows.where(F.col("k") == k).drop("k").coalesce(1).write.mode("append").parquet(path)
        found = x.drain(x.arm_totals(x.source(spark, "parquet", path, "arm string, reward double")), "update", "x9", checkpoint=checkpoint, path=out)
    return rounded(x.arm_metrics(found, 2), ["arm", "batch", "pulls", "batch_pulls"], ["mean_reward", "batch_reward", "rolling_reward"])


X11 = f"""WITH {TXN}, g AS (SELECT entity_id, ts, amount, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS fresh FROM txn WINDOW w AS (PARTITION BY entity_id ORDER BY ts)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY entity_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT entity_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS start_sec, count(*) AS n, {r('sum(amount)', 'total', 2)} FROM s GROUP BY entity_id, k"""


@query("X11_session_activity", X11)
def x11(spark, sf_dir):
    rows = txn(spark, sf_dir)
    return rounded(x.sessions(rows).withColumn("start_sec", F.col("start").cast("long")), ["entity_id", "start_sec", "n"], ["total"], 2)
