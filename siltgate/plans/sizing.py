"""What may be broadcast, which keys are hot, and where shared scratch tables go.

Two questions decide every plan here. Is one side small enough to broadcast? The
optimiser's own size estimate answers that, and Catalyst broadcasts without a
hint. Does one key hold so many rows that the task that receives it would drown?
A sample of the key columns answers that. The sample only picks the strategy:
every strategy returns the same whole result.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.functions.expressions import quoted


@dataclass(frozen=True)
class Limits:
    """Where the plans change.

    broadcast_bytes: largest estimated side that may be broadcast; None takes the
        session's own spark.sql.autoBroadcastJoinThreshold.
    small_bytes: inputs whose files are below this fit one task, so no key is looked at.
    hot_rows: a key with about this many rows is handled apart.
    sample: fraction of the rows read to find such keys.
    """

    broadcast_bytes: int | None = None
    small_bytes: int = 256 << 20
    hot_rows: int = 1_000_000
    sample: float = 0.001


DEFAULT_LIMITS = Limits()
# Bytes of files that a bucket is made for: compressed orders of it are some 650,000 rows, which a task sorts without spilling.
BUCKET_BYTES = 24 << 20
# Keys that are handled apart at most. A key beyond them holds no more rows than any of them, so
# less than a thousandth of all rows, which is no more than a task's share.
MOST_HOT = 1000
# Scratch folders of local sessions that name none, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a result."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def input_bytes(df: DataFrame) -> int:
    """Summed size of everything a plan reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def buckets_for(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> int:
    """Into how many buckets the rows are dealt: 0 for inputs that fit one task, never more than a shuffle's partitions."""
    size, spark = input_bytes(df), df.sparkSession
    if size <= limits.small_bytes:
        return 0
    return min(max(-(-size // BUCKET_BYTES), spark.sparkContext.defaultParallelism), int(spark.conf.get("spark.sql.shuffle.partitions")))


def broadcasts(side: DataFrame, limits: Limits = DEFAULT_LIMITS) -> bool:
    limit = limits.broadcast_bytes
    if limit is None:
        reader = side.sparkSession._jsparkSession.sessionState().conf()
        limit = int(reader.autoBroadcastJoinThreshold())
    return estimated_bytes(side) <= limit


def bounded(side: DataFrame) -> DataFrame:
    """``side`` with a broadcast hint if its estimate is within the session's limit.

    Beyond it there is no hint: the join shuffles, and AQE splits what is skewed.
    """
    return F.broadcast(side) if broadcasts(side) else side


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or a local one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL_FOLDERS.setdefault(context.applicationId, tempfile.mkdtemp(prefix="siltgate-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/siltgate/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared folder and read it back: lineage ends, lost executors do not matter."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_keys(df: DataFrame, keys: Sequence[str], limits: Limits = DEFAULT_LIMITS) -> DataFrame | None:
    """Distinct keys that hold about limits.hot_rows rows or more; None when there is none.

    At most rows/hot_rows keys can qualify, and of these the MOST_HOT with the most rows
    are taken, which is what makes the result safe to broadcast however many rows there are.
    The groups are counted map-side first, so the hot key itself is no problem here. NULL is
    a key like any other.
    """
    if input_bytes(df) <= limits.small_bytes:
        return None
    picked = df.select(*keys)
    if limits.sample < 1:
        picked = picked.sample(fraction=limits.sample, seed=17)
    least = max(1, int(limits.hot_rows * min(limits.sample, 1.0)))
    hot = picked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    hot = hot.orderBy(F.desc("_n")).limit(MOST_HOT)
    # Stored once: later branches must agree on the set even if the sample is drawn again.
    hot = stored(hot.select(*keys), "hot-keys")
    return None if hot.isEmpty() else hot


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "") -> Column:
    """Null-safe equality of all keys."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[prefix + key])
    return condition


def spread_slot(df: DataFrame, fan: int) -> Column:
    """A number that scatters rows of one key: map partition times ``fan``, plus a content hash.

    Both parts are the same when a task is run again, so a retried map task sends
    every row where it went before; a random number or a row counter would not.
    """
    hashable = [name for name, kind in df.dtypes if "map<" not in kind and kind != "variant"]
    return F.spark_partition_id().cast("bigint") * fan + F.pmod(
        F.xxhash64(*quoted(hashable)), F.lit(fan)
    )
