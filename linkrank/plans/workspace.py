"""Tables that a run keeps in the shared folder.

Every step of an iterative run is written there as a table. That cuts the lineage, survives the loss
of executors, and keeps the hash partitioning by bucketing, so that later joins need no exchange.
The tables live in a database of their own, which ``close`` drops together with its files.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or else the warehouse; executors reach both."""
    for setting in (CHECKPOINT_SETTING, "spark.sql.warehouse.dir"):
        folder = spark.conf.get(setting, "")
        if folder:
            return folder
    raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors can reach")


@contextmanager
def shuffle_partitions(spark: SparkSession, count: int) -> Iterator[None]:
    """Plan exchanges with as many partitions as the bucketed tables have, so that both sides line up."""
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(count))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


_open: list[Workspace] = []


@atexit.register
def _close_all() -> None:
    """Drop what is left when the driver program ends, provided its session is still there."""
    for workspace in list(_open):
        with suppress(Exception):
            if SparkSession.getActiveSession() is not None:
                workspace.close()


class Workspace:
    """A database in the shared folder for the tables of one run.

    With a ``name`` the tables are kept when the program ends, and ``Workspace.reopen`` finds them again, also from
    another session after the driver died. Without one the database has a random name and goes at the end.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, name: str | None = None) -> None:
        self.spark, self.kept = spark, name is not None
        self.database = name or f"linkrank_{uuid.uuid4().hex[:16]}"
        self.location = f"{(folder or shared_folder(spark)).rstrip('/')}/{self.database}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS spark_catalog.{self.database} LOCATION '{self.location}'")
        self.names = 0
        if not self.kept:
            _open.append(self)

    @classmethod
    def reopen(cls, spark: SparkSession, name: str, folder: str | None = None) -> Workspace:
        """A named workspace of an earlier session; its tables are attached as they are asked for."""
        return cls(spark, folder, name)

    def new_name(self, base: str) -> str:
        """A table name that this workspace has not given before."""
        self.names += 1
        return f"{base}_{self.names}_{uuid.uuid4().hex[:8]}"

    def attach(self, name: str, key: str | None = None, buckets: int | None = None, ordered: bool = False) -> DataFrame:
        """A table that an earlier session wrote, with the buckets it was written in."""
        if not self.spark.catalog.tableExists(self.table_name(name)):
            path = f"{self.location}/{name}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema)
            clustered = "" if key is None else f"CLUSTERED BY ({key})" + (f" SORTED BY ({key})" if ordered else "") + f" INTO {buckets} BUCKETS"
            self.spark.sql(f"CREATE TABLE {self.table_name(name)} ({columns}) USING parquet {clustered} LOCATION '{path}'")
        return self.table(name)

    def table_name(self, name: str) -> str:
        return f"spark_catalog.{self.database}.{name}"

    def save(
        self,
        df: DataFrame,
        name: str,
        key: str | None = None,
        buckets: int | None = None,
        ordered: bool = False,
        apart: str | None = None,
    ) -> DataFrame:
        """Write ``df`` as a table and return it as read back, bucketed by ``key`` if one is given.

        ``ordered`` also sorts each bucket by the key, which compresses repeated keys to almost
        nothing; worth it for tables that are read often. ``apart`` is a column of few values, each of which has a folder of its
        own, so that a reader of one value leaves the others alone; rows go there as they come, without a sort.
        """
        writer = df.write.format("parquet")
        if apart is not None:
            writers = "spark.sql.maxConcurrentOutputFileWriters"
            before = self.spark.conf.get(writers)
            self.spark.conf.set(writers, "16")
            try:
                writer.partitionBy(apart).saveAsTable(self.table_name(name))
            finally:
                self.spark.conf.set(writers, before)
            return self.table(name)
        if key is not None:
            writer = writer.bucketBy(buckets, key)
            if ordered:
                writer = writer.sortBy(key)
        writer.saveAsTable(self.table_name(name))
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.table_name(name))

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table_name(name)} PURGE")

    def forget(self, name: str) -> None:
        """Drop a table of files that lie elsewhere; they stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table_name(name)}")

    def close(self) -> None:
        """Drop the database with all its tables and files."""
        self.spark.sql(f"DROP DATABASE IF EXISTS spark_catalog.{self.database} CASCADE")
        if self in _open:
            _open.remove(self)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc: object) -> None:
        self.close()
