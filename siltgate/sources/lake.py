"""Layered tables with versions, as Parquet directories or as catalog tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "gold", "quarantine", "ops")
SNAPSHOT = "snapshot"
LOG = "log"
# Of a version's files: a quarter to a third smaller than with Spark's default.
COMPRESSION = "zstd"
_VERSION = re.compile(r"version=(\d+)$")
_RESTORED = re.compile(r"(\d+)-from-(\d+)$")
_DEALT = re.compile(r"(\d+)-into-(\d+)-by-(.+)$")


@dataclass(frozen=True)
class Table:
    """A table in a layer. A snapshot reads as its newest version, a log as all of them."""

    layer: str
    name: str
    kind: str = SNAPSHOT

    def __post_init__(self) -> None:
        if self.layer not in LAYERS:
            raise ValueError(f"unknown layer: {self.layer}")


BRONZE_ORDERS = Table("bronze", "orders", LOG)
BRONZE_CUSTOMERS = Table("bronze", "customers", LOG)
BRONZE_PRODUCTS = Table("bronze", "products", LOG)
SILVER_ORDERS = Table("silver", "orders")
SILVER_CUSTOMERS = Table("silver", "customers")
SILVER_PRODUCTS = Table("silver", "products")
ORDERS_CANDIDATE = Table("silver", "orders__candidate")
QUARANTINE_ORDERS = Table("quarantine", "orders", LOG)
DQ_METRICS = Table("ops", "dq_metrics", LOG)
DIM_CUSTOMER = Table("gold", "dim_customer")
DIM_PRODUCT = Table("gold", "dim_product")
DIM_DATE = Table("gold", "dim_date")
REFUSED_FEEDS = Table("quarantine", "refused_feeds", LOG)
RECOVERED_ORDERS = Table("quarantine", "orders_recovered", LOG)
FACT_SALES = Table("gold", "fact_sales")
REVENUE_BY_COUNTRY = Table("gold", "revenue_by_country")
REVENUE_BY_CATEGORY = Table("gold", "revenue_by_category")


def _scratch_name() -> str:
    """A name in the session's own catalog, for as long as a table needs one."""
    return f"spark_catalog.default.siltgate_{uuid.uuid4().hex}"


class Lake:
    """Tables under one root folder: ``<root>/<layer>/<table>/version=<n>``.

    Every write makes a new version and never touches an older one, so a plan may
    read the table it replaces. A version counts once Spark's committer has left its
    _SUCCESS file. One writer per table is assumed.

    A version may be dealt by keys into buckets: each task writes a file per bucket, so nothing is
    shuffled, and ``read_dealt`` gives the rows with rows of equal keys in one partition.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.layer}/{table.name}"

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _names(self, path: str) -> list[str]:
        fs, at = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def ensure(self) -> None:
        for layer in LAYERS:
            fs, at = self._fs(f"{self.root}/{layer}")
            fs.mkdirs(at)

    def _written(self, table: Table) -> list[int]:
        found = (_VERSION.match(name) for name in self._names(self.path(table)))
        return sorted(int(m.group(1)) for m in found if m)

    def _restored(self, table: Table) -> dict[int, int]:
        found = (_RESTORED.match(name) for name in self._names(f"{self.path(table)}/_restored"))
        return {int(m.group(1)): int(m.group(2)) for m in found if m}

    def versions(self, table: Table) -> list[int]:
        """Committed versions, oldest first."""
        done = []
        for n in self._written(table):
            fs, at = self._fs(f"{self.path(table)}/version={n}/_SUCCESS")
            if fs.exists(at):
                done.append(n)
        return sorted({*done, *self._restored(table)})

    def exists(self, table: Table) -> bool:
        return bool(self.versions(table))

    def _next(self, table: Table) -> int:
        return max([0, *self._written(table), *self._restored(table)]) + 1

    def _parts(self, table: Table, version: int) -> list[int]:
        """The written versions that make up what version n shows."""
        restored = self._restored(table)
        committed = [v for v in self.versions(table) if v <= version]
        shown: dict[int, list[int]] = {}
        before: list[int] = []
        for v in committed:
            if v in restored:
                shown[v] = shown[restored[v]]
            else:
                shown[v] = [*before, v] if table.kind == LOG else [v]
            before = shown[v]
        return before

    def _dealt(self, table: Table) -> dict[int, tuple[int, tuple[str, ...]]]:
        """Into how many buckets, and by which keys, the versions that are dealt are."""
        found = (_DEALT.match(name) for name in self._names(f"{self.path(table)}/_dealt"))
        return {int(m.group(1)): (int(m.group(2)), tuple(m.group(3).split(","))) for m in found if m}

    def _write(self, df: DataFrame, table: Table, partition_by: Sequence[str], deal_by: Sequence[str] = (), buckets: int = 0) -> int:
        if buckets and partition_by:
            raise ValueError("a version is dealt or partitioned, not both")
        version = self._next(table)
        path = f"{self.path(table)}/version={version}"
        writer = df.write.mode("errorifexists").option("compression", COMPRESSION)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if not buckets:
            writer.parquet(path)
            return version
        # Spark writes buckets for a table of the catalog only; its files stay when the name goes.
        name = _scratch_name()
        try:
            writer.option("path", path).bucketBy(buckets, *deal_by).saveAsTable(name, format="parquet")
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        fs, at = self._fs(f"{self.path(table)}/_dealt/{version}-into-{buckets}-by-{','.join(deal_by)}")
        fs.create(at).close()
        return version

    def append(self, df: DataFrame, table: Table, partition_by: Sequence[str] = (), deal_by: Sequence[str] = (), buckets: int = 0) -> int:
        if table.kind != LOG:
            raise ValueError(f"{table.layer}.{table.name} is not a log")
        return self._write(df, table, partition_by, deal_by, buckets)

    def overwrite(self, df: DataFrame, table: Table, partition_by: Sequence[str] = (), deal_by: Sequence[str] = (), buckets: int = 0) -> int:
        """Replace the content, schema included."""
        if table.kind != SNAPSHOT:
            raise ValueError(f"{table.layer}.{table.name} is not a snapshot")
        return self._write(df, table, partition_by, deal_by, buckets)

    def _newest(self, table: Table) -> str:
        """The folder that the newest version's rows are in."""
        return f"{self.path(table)}/version={self._parts(table, self.versions(table)[-1])[-1]}"

    def extend(self, df: DataFrame, table: Table) -> None:
        """Add rows to the newest version of a snapshot; its files stay as they are. It is not dealt any more."""
        version = self._parts(table, self.versions(table)[-1])[-1]
        for name in self._names(f"{self.path(table)}/_dealt"):
            if name.startswith(f"{version}-into-"):
                fs, at = self._fs(f"{self.path(table)}/_dealt/{name}")
                fs.delete(at, False)
        df.write.mode("append").option("compression", COMPRESSION).parquet(self._newest(table))

    def replace_partitions(self, df: DataFrame, table: Table, by: Sequence[str]) -> None:
        """Replace those partitions of the newest version that ``df`` has rows of; others keep their files."""
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
        writer.partitionBy(*by).parquet(self._newest(table))

    def read(
        self, table: Table, version: int | None = None, merge_schema: bool | None = None
    ) -> DataFrame:
        """The newest version, or the one asked for.

        Bronze logs take what arrives, so their versions' schemas are merged; the other
        logs have a fixed schema, and merging would only read every file's footer.
        """
        known = self.versions(table)
        if not known or (version is not None and version not in known):
            raise LookupError(f"{table.layer}.{table.name} has no version {version or ''}".strip())
        parts = self._parts(table, known[-1] if version is None else version)
        if merge_schema is None:
            merge_schema = table.layer == "bronze" and len(parts) > 1
        paths = [f"{self.path(table)}/version={n}" for n in parts]
        return self.spark.read.option("mergeSchema", merge_schema).parquet(*paths)

    def buckets(self, table: Table, by: Sequence[str]) -> int:
        """Into how many buckets the newest version's rows are dealt by ``by``; 0 unless one write dealt all of them."""
        parts = self._parts(table, self.versions(table)[-1])
        n, keys = self._dealt(table).get(parts[0], (0, ()))
        return n if len(parts) == 1 and keys == tuple(by) else 0

    def read_dealt(self, table: Table, by: Sequence[str]) -> DataFrame:
        """The rows of ``read``. Where they are dealt by ``by``, a plan that groups by it does not shuffle them.

        A bucket is one task, however full it is, so this is for keys of which none is hot.
        """
        n = self.buckets(table, by)
        if not n:
            return self.read(table)
        path, name = self._newest(table), _scratch_name()
        columns, keys = self.spark.read.parquet(path).schema.toDDL(), ", ".join(f"`{k}`" for k in by)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) INTO {n} BUCKETS LOCATION '{place}'")
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def restore(self, table: Table, version: int) -> int:
        """Make an older version the newest again. Only a marker is written, no data is copied."""
        if version not in self.versions(table):
            raise LookupError(f"{table.layer}.{table.name} has no version {version}")
        number = self._next(table)
        fs, at = self._fs(f"{self.path(table)}/_restored/{number}-from-{version}")
        fs.create(at).close()
        return number


class CatalogLake:
    """The same layers as schemas of a catalog. Versions are left to the catalog's table format.

    ``schema_prefix`` keeps the schemas of one lake apart from another's in the same catalog.
    """

    def __init__(self, spark: SparkSession, catalog: str | None = None, schema_prefix: str = "") -> None:
        self.spark = spark
        self.prefix = (f"{catalog}." if catalog else "") + schema_prefix

    def path(self, table: Table) -> str:
        return f"{self.prefix}{table.layer}.{table.name}"

    def ensure(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer}")

    def remove(self) -> None:
        """Drop the schemas with everything in them."""
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.prefix}{layer} CASCADE")

    def exists(self, table: Table) -> bool:
        return self.spark.catalog.tableExists(self.path(table))

    def append(self, df: DataFrame, table: Table, partition_by: Sequence[str] = (), deal_by: Sequence[str] = (), buckets: int = 0) -> None:
        """Columns that the table lacks are added to it; columns that ``df`` lacks are NULL. Dealing is the table format's matter."""
        if self.exists(table):
            known = self.spark.read.table(self.path(table)).schema
            taken = {f.name.lower() for f in known}
            added = [f for f in df.schema if f.name.lower() not in taken]
            if added:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                self.spark.sql(f"ALTER TABLE {self.path(table)} ADD COLUMNS ({columns})")
            here = {c.lower() for c in df.columns}
            df = df.select(
                *[
                    F.col(f.name) if f.name.lower() in here else F.lit(None).cast(f.dataType).alias(f.name)
                    for f in [*known, *added]
                ]
            )
        self._write(df, table, "append", partition_by)

    def overwrite(self, df: DataFrame, table: Table, partition_by: Sequence[str] = (), deal_by: Sequence[str] = (), buckets: int = 0) -> None:
        self._write(df, table, "overwrite", partition_by)

    def extend(self, df: DataFrame, table: Table) -> None:
        self._write(df, table, "append", ())

    def replace_partitions(self, df: DataFrame, table: Table, by: Sequence[str]) -> None:
        """``by`` are the columns that the catalog's table is partitioned by."""
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(setting)
        # Inserts into catalog tables read the session's mode and no option of the writer.
        self.spark.conf.set(setting, "dynamic")
        try:
            df.select(*self.read(table).columns).write.mode("overwrite").insertInto(self.path(table))
        finally:
            self.spark.conf.set(setting, before)

    def _write(self, df: DataFrame, table: Table, mode: str, partition_by: Sequence[str]) -> None:
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(self.path(table))

    def read(
        self, table: Table, version: int | None = None, merge_schema: bool | None = None
    ) -> DataFrame:
        if version is not None:
            return self.spark.sql(f"SELECT * FROM {self.path(table)} VERSION AS OF {int(version)}")
        return self.spark.read.table(self.path(table))

    def buckets(self, table: Table, by: Sequence[str]) -> int:
        return 0

    def read_dealt(self, table: Table, by: Sequence[str]) -> DataFrame:
        return self.read(table)
