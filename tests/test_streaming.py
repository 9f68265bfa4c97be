"""The gate over micro-batches."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import GOOD, ORDER_SCHEMA, default_checks, orders

from siltgate.operators import gate
from siltgate.plans.sizing import stored
from siltgate.streaming import gated


@pytest.mark.parametrize("scale", ["small", "large"])
def test_batches_share_uniqueness(spark, tmp_path, large, scale):
    landing, output = str(tmp_path / "in"), str(tmp_path / "out")
    limits = large if scale == "large" else gated.DEFAULT_LIMITS

    def deliver(*rows):
        orders(spark, *rows).coalesce(1).write.mode("append").parquet(landing)

    def drain():
        stream = spark.readStream.schema(ORDER_SCHEMA).parquet(landing)
        gated.start(
            stream, lambda rows: rows, default_checks(spark), output, str(tmp_path / "checkpoint"), limits,
        ).awaitTermination()

    deliver({}, {"order_id": "O2", "quantity": "-1"}, {"order_id": None})
    drain()
    deliver({"_ingested_at": datetime(2025, 1, 2)}, {"order_id": "O3"}, {"order_id": "O3"}, {"order_id": None})
    drain()
    rows = gated.read(spark, output)
    assert rows.count() == 7
    by_batch = {
        (r.batch, r.order_id, r[gate.PASSED]) for r in rows.select("batch", "order_id", gate.PASSED).collect()
    }
    assert by_batch == {
        (0, "O1", True), (0, "O2", False), (0, None, True),
        (1, "O1", False), (1, "O3", True), (1, "O3", False), (1, None, False),
    }


def drain(spark, landing, tmp_path, checkpoint="checkpoint", schema=ORDER_SCHEMA, **how):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    query = gated.start(stream, lambda rows: rows, default_checks(spark), str(tmp_path / "out"), str(tmp_path / checkpoint), **how)
    query.awaitTermination()
    return query


def deliver(spark, landing, *rows):
    orders(spark, *rows).coalesce(1).write.mode("append").parquet(landing)


def day(n):
    return datetime(2025, 1, 1) + timedelta(days=n)


def test_late_rows_go_apart_and_keys_outlive_restarts(spark, tmp_path):
    landing, how = str(tmp_path / "in"), {"event_time": "_ingested_at", "delay": "5 days"}
    deliver(spark, landing, {"order_id": "A"}, {"order_id": "B", "_ingested_at": day(2)})
    drain(spark, landing, tmp_path, **how)
    deliver(spark, landing, {"order_id": "C", "_ingested_at": day(20)}, {"order_id": "A", "_ingested_at": day(-3)})
    drain(spark, landing, tmp_path, **how)
    deliver(spark, landing, {"order_id": "D", "_ingested_at": day(15)}, {"order_id": "E", "_ingested_at": day(16)}, {"order_id": "B", "_ingested_at": None})
    deliver(spark, landing, {"order_id": "C", "_ingested_at": day(30)}, {"order_id": "D", "_ingested_at": day(30)})
    drain(spark, landing, tmp_path, **how)
    landed = sorted((r.order_id, r[gate.PASSED]) for r in gated.read(spark, str(tmp_path / "out")).collect())
    # A came again behind the watermark's 3 days, D first at the watermark itself: both are late, and claim nothing.
    assert landed == [("A", True), ("B", False), ("B", True), ("C", False), ("C", True), ("D", True), ("E", True)]
    late = gated.read_late(spark, str(tmp_path / "out"))
    assert sorted(r.order_id for r in late.collect()) == ["A", "D"]
    assert set(GOOD) <= set(late.columns)


def test_keys_are_forgotten_behind_the_watermark(spark, tmp_path):
    landing, how = str(tmp_path / "in"), {"event_time": "_ingested_at", "delay": "5 days", "forget": True}
    # Others move the watermark on; A is forgotten once it has passed day 5.
    for n, key in ((0, "A"), (4, "A"), (30, "Y"), (31, "Z"), (60, "A"), (61, "A")):
        deliver(spark, landing, {"order_id": key, "_ingested_at": day(n)})
    drain(spark, landing, tmp_path, **how)
    rows = gated.read(spark, str(tmp_path / "out")).where("order_id = 'A'").collect()
    assert sorted((r._ingested_at, r[gate.PASSED]) for r in rows) == [(day(0), True), (day(4), False), (day(60), True), (day(61), False)]
    with pytest.raises(ValueError):
        gated.with_claims(spark.range(1), [("id",)], forget=True)


def test_a_batch_reads_nothing_that_landed_before(spark, tmp_path, monkeypatch):
    landing, read = str(tmp_path / "in"), []
    judge = gated.judge_batch

    def spy(batch, checks, claims, limits):
        read.append([*batch.inputFiles(), *claims(("order_id",)).inputFiles()])
        return judge(batch, checks, claims, limits)

    monkeypatch.setattr(gated, "judge_batch", spy)
    for n in range(3):
        deliver(spark, landing, *[{"order_id": f"O{n}-{i}"} for i in range(20)], {"order_id": "same"})
        drain(spark, landing, tmp_path)
    assert len(read) >= 3 and not any("/rows/" in f for files in read for f in files)
    # One batch's rows and claims each time, however many came before.
    assert len({len(files) for files in read[:3]}) <= 2
    assert gated.read(spark, str(tmp_path / "out")).where(f"order_id = 'same' AND {gate.PASSED}").count() == 1


def test_a_batch_delivered_again_lands_once(spark, tmp_path):
    output, checks = str(tmp_path / "out"), default_checks(spark)
    for batch_id, ids, new in ((0, ("O1", "O2"), ("O1", "O2")), (1, ("O2", "O3"), ("O3",)), (1, ("O2", "O3"), ("O3",))):
        rows = orders(spark, *[{"order_id": i} for i in ids]).select(F.struct("*").alias(gated.ROW), F.lit(None).cast("int").alias(gated.CLAIM))
        claims = orders(spark, *[{"order_id": i} for i in new]).select(F.struct("*").alias(gated.ROW), F.lit(0).alias(gated.CLAIM))
        gated.land(stored(rows.union(claims), "arrivals"), batch_id, "s", checks, output)
    rows = gated.read(spark, output)
    assert sorted((r.batch, r.order_id, r[gate.PASSED]) for r in rows.collect()) == [
        (0, "O1", True), (0, "O2", True), (1, "O2", False), (1, "O3", True),
    ]
    assert set(GOOD) <= set(rows.columns)


def test_another_checkpoint_has_rows_and_keys_of_its_own(spark, tmp_path):
    landing = str(tmp_path / "in")
    deliver(spark, landing, {})
    for checkpoint in ("one", "two"):
        drain(spark, landing, tmp_path, checkpoint)
    rows = gated.read(spark, str(tmp_path / "out"))
    assert [r[gate.PASSED] for r in rows.collect()] == [True, True] and rows.select("stream").distinct().count() == 2


def test_keys_are_kept_on_disk_unless_the_session_names_a_store(spark, tmp_path):
    def stores(checkpoint):
        query = drain(spark, str(tmp_path / "in"), tmp_path, checkpoint)
        return [any(name.startswith("rocksdb") for name in op["customMetrics"]) for op in query.lastProgress["stateOperators"]]

    provider = next(iter(gated.STATE_STORE))
    deliver(spark, str(tmp_path / "in"), {}, {"order_id": "O2"})
    assert stores("mine") == [True]
    assert not [key for key in gated.STATE_STORE if spark.conf.get(key, None)]
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        assert stores("theirs") == [False] and "HDFS" in spark.conf.get(provider)
    finally:
        spark.conf.unset(provider)
    # A checkpoint that was begun with the other store goes on with it, and knows its keys.
    deliver(spark, str(tmp_path / "in"), {}, {"order_id": "O3"})
    assert stores("theirs") == [False]
    judged = gated.read(spark, str(tmp_path / "out")).select("stream", "batch", "order_id", gate.PASSED).collect()
    assert sorted((r.order_id, r[gate.PASSED]) for r in judged if r.batch == 1) == [("O1", False), ("O3", True)]
