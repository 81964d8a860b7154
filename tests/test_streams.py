"""Streams: state that goes by the clock, dead letters that stop, repeated batches, refitted curves."""

import time

import pytest
from pyspark.sql import functions as F

from tallgrass.sources.scratch import shared_path
from tallgrass.streaming import streams


def events(spark, rows):
    return spark.createDataFrame(rows, "raw string, entity_id long, event_type string, ts timestamp, amount double")


def test_invalid_events_stop_the_stream_and_repeats_replace(spark):
    path = shared_path(spark, "t7")
    good = [("g", k, "click", None, 1.0) for k in range(19)]
    rows = events(spark, good).withColumn("ts", F.current_timestamp()).unionByName(events(spark, [("{bad", None, None, None, None)]))
    for _ in range(2):
        streams.split_invalid(rows, 3, path)
    found = spark.read.parquet(path)
    assert (found.where("ok = 'true'").count(), found.where("ok = 'false'").count()) == (19, 1)
    assert [r.raw for r in found.where("ok = 'false'").collect()] == ["{bad"]
    with pytest.raises(ValueError, match="invalid"):
        streams.split_invalid(events(spark, [("{bad", None, None, None, None)]), 4, path)
    assert spark.read.parquet(path).count() == 20


def test_curve_is_refitted(spark):
    path = shared_path(spark, "t10")
    spark.range(400).select((F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).alias("ts"), (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 2 * 0.2 + 0.1).alias("p")).repartitionByRange(3, "ts").write.parquet(path)
    stream = streams.source(spark, "parquet", path, "ts timestamp, label int, p double", rate=1)
    found = sorted(streams.recalibrated(stream, "t10", "label", "p", 100).where("rows > 0").collect(), key=lambda r: r.batch)
    assert len(found) == 3 and sum(r.rows for r in found) == 400
    assert found[0].before > 0.2 and all(r.after < 1e-9 for r in found) and found[1].before < 1e-9


def calibration_input(spark, name, days):
    """Files of scored cases, one for each of these thirds."""
    path = shared_path(spark, name)
    rows = spark.range(600).select(F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), F.floor(F.col("id") / 100), F.lit(0), F.lit(0)).alias("ts"), (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("int").alias("label"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) / 100).alias("p"), (F.col("id") / 200).cast("int").alias("k"))
    return path, lambda k: rows.where(F.col("k") == k).drop("k").coalesce(1).write.mode("append").parquet(path)


def test_stop_and_restart_give_the_same_curves(spark):
    """Six rows of each time are many equal times at the window's edge; two runs of one checkpoint are as one run."""
    schema, found = "ts timestamp, label int, p double", []
    for stops in ((), (1,), (1, 2)):
        source, add = calibration_input(spark, "t10b", 3)
        checkpoint, out = shared_path(spark, "t10b-checkpoint"), shared_path(spark, "t10b-out")
        run = lambda: streams.recalibrated(streams.source(spark, "parquet", source, schema, rate=1), "t10b", "label", "p", 150, checkpoint, out)  # noqa: B023, E731
        for k in range(3):
            add(k)
            if k in stops or k == 2:
                last = run()
        found.append(sorted(tuple(r)[:3] for r in last.where("rows > 0").collect()))
        assert len(streams._batches(spark, f"{checkpoint}-window")) <= 2
    assert found[0] == found[1] == found[2] and len(found[0]) == 3


def test_state_goes_after_its_time(spark):
    """Two events of one entity with a pause longer than the state's life: the second one starts anew."""
    path = shared_path(spark, "t4")
    row = lambda n: spark.range(1).select(F.lit(7).cast("long").alias("entity_id"), F.lit("click").alias("event_type"), F.current_timestamp().alias("ts"), F.lit(float(n)).alias("amount"))
    row(1).write.parquet(path)
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.ROCKS)
    seen = []
    try:
        stream = streams.lifetime(streams.source(spark, "parquet", path, "entity_id long, event_type string, ts timestamp, amount double"), 4 / 86_400)
        query = stream.writeStream.outputMode("update").option("checkpointLocation", shared_path(spark, "t4-checkpoint")).foreachBatch(lambda b, n: seen.extend(r.n for r in b.collect())).start()
        for n in (1, 2):
            until = time.time() + 60
            while len(seen) < n and time.time() < until:
                time.sleep(0.3)
            if n == 1:
                time.sleep(6)
                row(2).write.mode("append").parquet(path)
        query.stop()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    assert seen == [1, 1]


def test_lifetime_without_clock_is_an_aggregate_that_keeps_the_latest_event(spark):
    """Of rows of one second the event that comes last by name stands, whichever batch brought it; no Python for each entity."""
    path = shared_path(spark, "x4")
    for kind, amount in (("z", 2.0), ("a", -5.0)):
        rows = spark.createDataFrame([(1, kind, amount), (1, "b", None)], "entity_id long, event_type string, amount double")
        rows.withColumn("ts", F.lit("2024-01-01 00:00:07.5").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)
    stream = streams.source(spark, "parquet", path, "entity_id long, event_type string, ts timestamp, amount double", rate=1)
    lifetime = streams.lifetime(stream, None)
    assert "InPy" not in lifetime._jdf.queryExecution().analyzed().toString() and "InPandas" not in lifetime._jdf.queryExecution().analyzed().toString()
    found = streams.newest(streams.drain(lifetime, "update", "x4"), ["entity_id"]).collect()
    second = int(spark.sql("SELECT unix_timestamp(timestamp'2024-01-01 00:00:07')").first()[0])
    assert [tuple(r) for r in found] == [(1, 4, 2.0, second, second, "z")]
