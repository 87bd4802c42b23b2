"""Where layers are written and read back: a folder of parquet tables, or catalog tables.

A run writes every table under a version of its own and switches to it at the end by one small write,
which all readers of all layers look at. So a run that fails, or has not ended, leaves all layers as they
were, and no reader ever sees two versions at once. Marks tell how far a run has come: what a run that
broke off has left is removed by the next one, unless that takes it up where it ended.

A version that was replaced stays readable for `keep` seconds, and for as long as a snapshot holds it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import warnings
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cache
from threading import Lock
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

START, END = "start", "end"

_one_at_a_time, _marking = Lock(), Lock()
DAY = 86_400.0

# Most columns of stored tables are ids, amounts and moments, for which a writer builds dictionaries only
# to drop them. zstd more than makes up for that in size. Files of few rows can be dealt evenly to tasks.
PARQUET = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
    "parquet.enable.dictionary": "false",
    "maxRecordsPerFile": "500000",
}
MOMENTS = "spark.sql.parquet.outputTimestampType"


def writer(table: DataFrame) -> DataFrameWriter:
    """How layers and tables between two steps are written. Moments are whole numbers; Spark's default, 12
    bytes a moment, costs a fifth more time. That is a setting of the session, which keeps it."""
    table.sparkSession.conf.set(MOMENTS, "TIMESTAMP_MICROS")
    return table.write.options(**PARQUET)


def new_version() -> str:
    """Later versions sort after earlier ones."""
    return f"v{time.time_ns():020d}_{uuid4().hex[:8]}"


def started_at(version: str) -> float:
    return int(version[1:21]) / 1e9


def outdated(
    published: dict[str, float], runs: dict[str, set[str]], held: set[str], own: str, keep: float
) -> list[str]:
    """Versions that nobody needs: replaced for longer than keep, or of runs that broke off before `own`.

    `published` tells when each version was. The last one and the one before it always stay.
    """
    order = sorted(published)
    replaced = [
        version
        for version, successor in zip(order[:-2], order[1:], strict=False)
        if published[successor] + keep < time.time()
    ]
    broken = [version for version in runs if version < own and version not in published]
    return [version for version in (*replaced, *broken) if version not in held]


@dataclass(frozen=True)
class Snapshot:
    """One version of all layers, whatever is published meanwhile. It is kept until its time is over
    or release() is called."""

    warehouse: FolderWarehouse | CatalogWarehouse
    version: str
    until: float

    def read(self, layer: str, name: str) -> DataFrame:
        return self.warehouse.read_version(layer, name, self.version)

    def release(self) -> None:
        self.warehouse.let_go(self.version, self.until)


class Versions:
    """What both kinds of warehouse do alike with marks, publications and snapshots."""

    def published(self) -> str | None:
        """The version that is read."""
        return max(self.publications(), default=None)

    def finished(self, layer: str) -> bool:
        """True if this run, or the broken-off one that it takes up, has written the whole layer."""
        return layer in self.runs().get(self.version, ())

    def unfinished(self) -> str | None:
        """The last run that has begun after the last publication and not ended."""
        runs, last = self.runs(), self.published() or ""
        return max((v for v, marks in runs.items() if v > last and END not in marks), default=None)

    def snapshot(self, hold: float = DAY) -> Snapshot:
        """A handle on the version that is read now, which stays for so many seconds."""
        version = self.published()
        if version is None:
            raise LookupError("nothing is published yet")
        held = Snapshot(self, version, time.time() + hold)
        self.hold(version, held.until)
        if version not in self.publications() or not self.stored(version):
            raise LookupError(f"{version} was removed just now")
        return held

    def publish(self) -> None:
        """Make this version the one that is read, and remove those that nobody needs."""
        self.switch()
        self.mark(END)
        published = self.publications()
        for version in outdated(published, self.runs(), self.held(), self.version, self.keep):
            self.remove(version)


@dataclass(frozen=True)
class FolderWarehouse(Versions):
    """Tables are root/versions/<version>/<layer>/<name>; root/published names the versions that are
    complete, of which the last one counts. Publishing adds one small file and moves nothing.
    root/runs and root/held have an empty file for each mark and each snapshot."""

    spark: SparkSession
    root: str
    version: str = field(default_factory=new_version)
    keep: float = DAY

    @classmethod
    def resumed(cls, spark: SparkSession, root: str, keep: float = DAY) -> FolderWarehouse:
        """A warehouse that goes on with the run that broke off last, if there is one."""
        found = cls(spark, root, keep=keep).unfinished()
        return cls(spark, root, found or new_version(), keep)

    def publications(self) -> dict[str, float]:
        try:
            rows = self.spark.read.text(f"{self.root}/published").distinct().collect()  # one a run
        except AnalysisException:
            return {}
        told = [row["value"].partition(" ") for row in rows]
        return {version: float(at or started_at(version)) for version, _, at in told}

    def runs(self) -> dict[str, set[str]]:
        found = {}
        for version in list_folder(self.spark, f"{self.root}/runs"):
            found[version] = set(list_folder(self.spark, f"{self.root}/runs/{version}"))
        return found

    def mark(self, name: str) -> None:
        touch(self.spark, f"{self.root}/runs/{self.version}/{name}")

    def hold(self, version: str, until: float) -> None:
        touch(self.spark, f"{self.root}/held/{version}-{until}")

    def let_go(self, version: str, until: float) -> None:
        remove_folder(f"{self.root}/held/{version}-{until}", self.spark)

    def held(self) -> set[str]:
        told = [name.partition("-") for name in list_folder(self.spark, f"{self.root}/held")]
        return {version for version, _, until in told if float(until) > time.time()}

    def location(self, layer: str, name: str, version: str | None = None) -> str:
        return f"{self.root}/versions/{version or self.version}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        """A table of the version that was published last."""
        version = self.published()
        if version is None:
            raise LookupError(f"nothing is published in {self.root}")
        return self.read_version(layer, name, version)

    def read_version(self, layer: str, name: str, version: str) -> DataFrame:
        return self.spark.read.parquet(self.location(layer, name, version))

    def stored(self, version: str) -> bool:
        return version in list_folder(self.spark, f"{self.root}/versions")

    def write(self, layer: str, name: str, table: DataFrame) -> DataFrame:
        self.mark(START)
        location = self.location(layer, name)
        writer(table).mode("overwrite").parquet(location)
        return self.spark.read.schema(table.schema).parquet(location)

    def switch(self) -> None:
        marker = self.spark.createDataFrame([(f"{self.version} {time.time()}",)], "value string")
        marker.coalesce(1).write.mode("append").text(f"{self.root}/published")

    def remove(self, version: str) -> None:
        """Data first, so that a removal which breaks off is done again."""
        if remove_folder(f"{self.root}/versions/{version}", self.spark):
            remove_folder(f"{self.root}/runs/{version}", self.spark)


@dataclass(frozen=True)
class CatalogWarehouse(Versions):
    """One namespace per layer, such as raw, staging and marts. A table <name>_versions has a partition
    for each version, and the view <name> shows the partition of the version that the table
    <prefix>ledger.published names last. So one row that is written there switches all views of all
    layers, and a reader's partition is chosen before it reads any file. One run at a time writes to it."""

    spark: SparkSession
    prefix: str = ""
    location: str | None = None  # folder of the tables; else the catalog's own
    version: str = field(default_factory=new_version)
    keep: float = DAY
    written: list[tuple[str, str, tuple[str, ...]]] = field(default_factory=list, compare=False)

    @classmethod
    def resumed(
        cls, spark: SparkSession, prefix: str = "", location: str | None = None, keep: float = DAY
    ) -> CatalogWarehouse:
        """A warehouse that goes on with the run that broke off last, if there is one."""
        found = cls(spark, prefix, location, keep=keep).unfinished()
        return cls(spark, prefix, location, found or new_version(), keep)

    def _namespace(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    @property
    def _ledger(self) -> str:
        return self._namespace("ledger")

    def _create(self, namespace: str, name: str, columns: str, more: str = "") -> None:
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
        where = f"LOCATION '{self.location}/{namespace}/{name}'" if self.location else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {namespace}.{name} ({columns}) USING parquet {more} {where}")

    def _log(self, name: str, *values: str | float) -> None:
        """Add a row to a table of the ledger: one file, seen whole or not at all."""
        kinds = {"published": "version string, at double", "marks": "version string, mark string", "held": "version string, until double"}
        self._create(self._ledger, name, kinds[name])
        row = self.spark.createDataFrame([values], kinds[name]).coalesce(1)
        with _one_at_a_time:  # writers of one table would share its folder of files in the making
            row.write.insertInto(f"{self._ledger}.{name}")

    def _logged(self, name: str) -> list[tuple]:
        table = f"{self._ledger}.{name}"
        if not self.spark.catalog.tableExists(table):
            return []
        self.spark.catalog.refreshTable(table)  # other sessions write to it
        return [tuple(row) for row in self.spark.table(table).distinct().collect()]  # a few a run

    def publications(self) -> dict[str, float]:
        return dict(self._logged("published"))

    def runs(self) -> dict[str, set[str]]:
        found: dict[str, set[str]] = {}
        for version, name in self._logged("marks"):
            found.setdefault(version, set()).add(name)
        return {version: marks for version, marks in found.items() if "removed" not in marks}

    def mark(self, name: str) -> None:
        with _marking:
            if name not in self.runs().get(self.version, ()):
                self._log("marks", self.version, name)

    def hold(self, version: str, until: float) -> None:
        self._log("held", version, until)

    def let_go(self, version: str, until: float) -> None:
        self._log("held", version, -until)

    def held(self) -> set[str]:
        rows = self._logged("held")
        gone = {(version, -until) for version, until in rows if until < 0}
        return {version for version, until in rows if until > time.time() and (version, until) not in gone}

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(f"{self._namespace(layer)}.{name}")

    def read_version(self, layer: str, name: str, version: str) -> DataFrame:
        rows = self.spark.table(f"{self._namespace(layer)}.{name}_versions")
        return rows.where(F.col("version") == version).drop("version")

    def stored(self, version: str) -> bool:
        return version in self.runs()

    def write(self, layer: str, name: str, table: DataFrame) -> DataFrame:
        self.mark(START)
        namespace = self._namespace(layer)
        stored = f"{namespace}.{name}_versions"
        kinds = {f.name: f.dataType.simpleString() for f in table.schema}
        columns = ", ".join(f"`{c}` {kind}" for c, kind in kinds.items())
        options = ", ".join(f"'{key}' = '{value}'" for key, value in PARQUET.items())
        self._create(namespace, f"{name}_versions", f"{columns}, version string", f"OPTIONS ({options}) PARTITIONED BY (version)")
        known = self.spark.table(stored).columns[:-1]
        new = [f"`{c}` {kind}" for c, kind in kinds.items() if c not in known]
        if new:
            self.spark.sql(f"ALTER TABLE {stored} ADD COLUMNS ({', '.join(new)})")
            known = self.spark.table(stored).columns[:-1]
        view = f"written_{uuid4().hex}"
        self.spark.conf.set(MOMENTS, "TIMESTAMP_MICROS")
        table.createOrReplaceTempView(view)
        values = ", ".join(f"`{c}`" if c in kinds else "NULL" for c in known)
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {stored} PARTITION (version = '{self.version}') SELECT {values} FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)
        self.written.append((layer, name, tuple(kinds)))
        return self.read_version(layer, name, self.version).select(*kinds)

    def show(self, layer: str, name: str, columns: Iterable[str]) -> None:
        """Create the view; it reads the version that is published whenever it is asked."""
        view = f"{self._namespace(layer)}.{name}"
        chosen = ", ".join(f"`{c}`" for c in columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {view} AS SELECT {chosen} FROM {view}_versions "
            f"WHERE version = (SELECT max(version) FROM {self._ledger}.published)"
        )

    def switch(self) -> None:
        """Views first: they go on showing the version published last, until the row is there."""
        self._create(self._ledger, "published", "version string, at double")
        for layer, name, columns in self.written:
            view = f"{self._namespace(layer)}.{name}"
            if not self.spark.catalog.tableExists(view) or tuple(self.spark.table(view).columns) != columns:
                self.show(layer, name, columns)
        self._log("published", self.version, time.time())

    def remove(self, version: str) -> None:
        """Drop the version's partitions from all tables of all layers, then note that."""
        for row in self.spark.sql("SHOW NAMESPACES").collect():
            namespace = row["namespace"]
            if not namespace.startswith(self.prefix) or namespace == self._ledger:
                continue
            for table in self.spark.sql(f"SHOW TABLES IN {namespace} LIKE '*_versions'").collect():
                stored = f"{namespace}.{table['tableName']}"
                if "version" not in self.spark.table(stored).columns:
                    continue
                self.spark.sql(f"ALTER TABLE {stored} DROP IF EXISTS PARTITION (version = '{version}')")
                if self.location:  # such tables keep their files
                    remove_folder(f"{self.location}/{namespace}/{table['tableName']}/version={version}", self.spark)
        self._log("marks", version, "removed")


def register_views(tables: dict[str, DataFrame]) -> None:
    """Temporary views, for readers that want the layer in SQL without storing it."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors reach, as the cluster names it in spark.checkpoint.dir. Only
    local[...], whose executors are threads of one process, does with a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="tallyline-")
    atexit.register(remove_folder, folder)
    return folder


def _store(spark: SparkSession, location: str):
    """The file system that Spark itself uses for a location, and the location's path in it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def list_folder(spark: SparkSession, location: str) -> list[str]:
    """Names in a folder; none if it is missing."""
    store, path = _store(spark, location)
    return [status.getPath().getName() for status in store.listStatus(path)] if store.exists(path) else []


def touch(spark: SparkSession, location: str) -> None:
    """Create an empty file, if it is not there."""
    store, path = _store(spark, location)
    store.mkdirs(path.getParent())
    if not store.exists(path):
        store.create(path, True).close()


def remove_folder(location: str, spark: SparkSession | None = None) -> bool:
    """Remove a folder or file in any store that Spark reaches; a missing one is fine.

    False, with a warning, if that fails: what is left over is no reason to fail a run. Without a
    session, as at exit, only local folders can be removed.
    """
    spark = spark or SparkSession.getActiveSession()
    try:
        if spark is not None and spark.sparkContext._jsc is not None:
            store, path = _store(spark, location)
            if store.exists(path):
                store.delete(path, True)
        elif ":" not in location.removeprefix("file:"):
            shutil.rmtree(location.removeprefix("file:").removeprefix("//"), ignore_errors=True)
        return True
    except Exception as error:  # noqa: BLE001  any store, any kind of failure
        warnings.warn(f"could not remove {location}: {error}", stacklevel=2)
        return False


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder. clear_scratch() removes it, at the latest at exit."""
    folder = f"{shared_folder(spark)}/tallyline-{uuid4().hex}"
    if not _scratch:
        atexit.register(clear_scratch)
    _scratch.append(folder)
    return f"{folder}/{name}"


@contextmanager
def scratch_of_its_own() -> Iterator[list[str]]:
    """The folders that scratch_path() gives out within the block, in order. Those that are removed
    early need not be told: removing a missing folder is fine."""
    before, used = len(_scratch), []
    yield used
    used += _scratch[before:]


def clear_scratch() -> None:
    """Remove what scratch_path() has given out. Tables that read from there must be done with."""
    while _scratch:
        remove_folder(_scratch.pop())


def materialize(table: DataFrame, name: str) -> DataFrame:
    """Write a table that several readers need and read it back.

    Unlike a checkpoint it stays columnar, so each reader scans only its own columns.
    """
    spark = table.sparkSession
    location = scratch_path(spark, name)
    writer(table).parquet(location)
    return spark.read.schema(table.schema).parquet(location)
