"""Streaming ingest through the same gate, one micro-batch at a time.

Uniqueness across batches is a stateful operator of the query itself: a second branch of the stream
drops keys that Spark's state store has seen, so each batch arrives together with a claim for every key
that is new. Nothing that earlier batches have landed is read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltgate.operators import gate
from siltgate.operators.checks import Check, Repeated, key_exists
from siltgate.plans.sizing import DEFAULT_LIMITS, Limits, stored

# Columns of a micro-batch: a row, or the number of the key set that the row's key is claimed for.
ROW, CLAIM = "row", "claim"
# Keys are kept for ever, and Spark's own store holds them on the heap: 230 bytes each. This one holds them on local disk
# and a fixed part of memory.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def _with_safe_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add stand-ins for the keys under which NULL equals NULL."""
    safe = {f"_text_{k}": F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys}
    safe |= {f"_null_{k}": F.col(k).isNull() for k in keys}
    return df.withColumns(safe), list(safe)


def key_sets(checks: Sequence[Check]) -> list[tuple[str, ...]]:
    """The distinct sets of columns that some check wants unique."""
    return list(dict.fromkeys(n.keys for c in checks for n in c.needs if isinstance(n, Repeated)))


def with_claims(
    rows: DataFrame, sets: Sequence[tuple[str, ...]], event_time: str | None = None, delay: str = "0 seconds", forget: bool = False
) -> DataFrame:
    """Every row of a stream, and for each set of keys one row per key that the state store has not seen.

    With ``event_time`` the watermark trails the newest row by ``delay``; rows behind it claim nothing.
    Keys are kept for ever, or with ``forget`` until the watermark has passed the first row by ``delay``.
    """
    if event_time:
        rows = rows.withWatermark(event_time, delay)
    if forget and not event_time:
        raise ValueError("keys can only be forgotten by event time")

    def packed(frame: DataFrame, claim: int | None) -> DataFrame:
        fields = [
            (F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema
        ]
        return frame.select(F.struct(*fields).alias(ROW), F.lit(claim).cast("int").alias(CLAIM))

    out = packed(rows, None)
    for i, keys in enumerate(sets):
        slim = rows.select(*dict.fromkeys([*keys, *([event_time] if event_time else [])]))
        new = slim.dropDuplicatesWithinWatermark(list(keys)) if forget else slim.dropDuplicates(list(keys))
        out = out.union(packed(new, i))
    return out


def judge_batch(
    batch: DataFrame,
    checks: Sequence[Check],
    claims: Callable[[tuple[str, ...]], DataFrame],
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Judge a batch; a row whose key is not among the claims repeats an earlier batch's."""
    repeats = {n.column: n for c in checks for n in c.needs if isinstance(n, Repeated)}
    known, news = batch, {}
    # Before the shuffle for repeats: most rows stay where they are, and none is ranked twice.
    for need in repeats.values():
        if need.keys in news:
            continue
        news[need.keys] = f"_new_{len(news)}"
        keyed, safe = _with_safe_keys(known, need.keys)
        new, _ = _with_safe_keys(claims(need.keys), need.keys)
        probe, _ = _with_safe_keys(batch, need.keys)
        known = key_exists(keyed, safe, new, news[need.keys], limits, probe).drop(*safe)
    prepared = gate.prepare(known, checks, limits, probe=batch)
    again = {column: F.col(column) | ~F.col(news[need.keys]) for column, need in repeats.items()}
    return gate.evaluate((prepared.withColumns(again) if again else prepared).drop(*news.values()), checks)


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state on disk, unless the session names a store. A checkpoint keeps the store it was begun with."""
    provider = next(iter(STATE_STORE))
    added = {} if spark.conf.get(provider, None) else {k: v for k, v in STATE_STORE.items() if spark.conf.get(k, None) is None}
    for key, value in added.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in added:
            spark.conf.unset(key)


def start(
    stream: DataFrame,
    shape: Callable[[DataFrame], DataFrame],
    checks: Sequence[Check],
    output: str,
    checkpoint: str,
    limits: Limits = DEFAULT_LIMITS,
    event_time: str | None = None,
    delay: str = "0 seconds",
    forget: bool = False,
    **trigger,
) -> StreamingQuery:
    """Gate every micro-batch of ``stream`` into ``output/rows/stream=<name>/batch=<id>``.

    ``shape`` makes bronze rows of the stream, without an operator that keeps state. Rows behind the
    watermark are not judged, since their key may have been forgotten; they go to ``output/late`` as
    they came. A stream is named by its checkpoint, which also holds the keys it has seen: another
    checkpoint has rows and keys of its own. A batch that is delivered again after a failure overwrites
    its own folder, so each row lands once. Clean rows, quarantine and metrics are read from the
    evaluated rows with the functions of the gate.
    """
    name = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    sets = key_sets(checks)
    rows = shape(stream)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # Stored first: a micro-batch that is read twice would run its stateful branch twice.
        land(stored(batch, "arrivals"), batch_id, name, checks, output, limits, event_time, delay)

    writer = with_claims(rows, sets, event_time, delay, forget).writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    with _state_on_disk(stream.sparkSession):
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def _clock(output: str, name: str, batch_id: int) -> str:
    return f"{output}/_clock/stream={name}/batch={batch_id}"


def _newest(spark: SparkSession, output: str, name: str, batch_id: int):
    """The newest event time up to a batch, None before the first."""
    return spark.read.schema("newest timestamp").parquet(_clock(output, name, batch_id)).first()["newest"] if batch_id >= 0 else None


def _behind(event_time: str, delay: str, newest) -> Column:
    """Whether a row is behind the watermark that the state store drops rows by, 1970 to begin with.

    That is the watermark of the batch before, so it comes from the rows up to two batches ago.
    """
    watermark = F.timestamp_seconds(F.lit(0)) if newest is None else F.date_trunc("millisecond", F.lit(newest)) - F.expr(f"INTERVAL {delay}")
    return F.coalesce(F.col(event_time) <= watermark, F.lit(False))


def land(
    arrived: DataFrame,
    batch_id: int,
    name: str,
    checks: Sequence[Check],
    output: str,
    limits: Limits = DEFAULT_LIMITS,
    event_time: str | None = None,
    delay: str = "0 seconds",
) -> None:
    """Judge one stored batch of rows and claims, and write its rows, late rows apart.

    The newest event time of all batches so far is one row beside each batch: a batch reads the last
    two of them and nothing else of the past.
    """
    spark, place, sets = arrived.sparkSession, f"stream={name}/batch={batch_id}", key_sets(checks)
    rows = arrived.where(F.col(CLAIM).isNull()).select(f"{ROW}.*")
    if event_time:
        newest, settled = (_newest(spark, output, name, batch_id - n) for n in (1, 2))
        behind = _behind(event_time, delay, settled)
        rows.where(behind).write.mode("overwrite").parquet(f"{output}/late/{place}")
        seen = rows.agg(F.greatest(F.max(F.col(event_time).cast("timestamp")), F.lit(newest).cast("timestamp")).alias("newest"))
        seen.coalesce(1).write.mode("overwrite").parquet(_clock(output, name, batch_id))
        rows = rows.where(~behind)

    def claims(keys: tuple[str, ...]) -> DataFrame:
        return arrived.where(F.col(CLAIM) == sets.index(keys)).select(*[F.col(f"{ROW}.`{k}`").alias(k) for k in keys])

    judge_batch(rows, checks, claims, limits).write.mode("overwrite").parquet(f"{output}/rows/{place}")


def read(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(f"{output}/rows")


def read_late(spark: SparkSession, output: str) -> DataFrame:
    """Rows that came behind the watermark, as they arrived."""
    return spark.read.parquet(f"{output}/late")
