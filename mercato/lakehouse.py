"""Tables as Parquet files plus a small commit record.

A write lands in a ``w=<id>`` folder of its own and becomes visible when its commit
file appears, so readers never see half a write and a lost job leaves only an
unread folder. A commit lists, per partition value, the writes that make it up: an
append adds one, a rewrite of some days replaces those days only. Appends of
several writers all get in; a rewrite fails if its days were written meanwhile.
Commits need a file system that refuses to rename onto an existing file (HDFS does);
on others keep to one writer per table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.schemas import (
    ENTITIES,
    EVENT_METRICS_SCHEMA,
    EVENTS_ERRORS_SCHEMA,
    INGESTION_LOG_SCHEMA,
)

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
WHOLE = ""


class TableMissing(RuntimeError):
    """Writers never create tables."""


class TableChanged(RuntimeError):
    """Rows a rewrite was computed from have been replaced by another writer."""


class TableNotEmpty(RuntimeError):
    """The ``empty`` disposition found rows."""


class _Folder:
    """The few file-system calls needed, on whatever storage the path names."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._jvm = jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def names(self, path: str) -> list[str]:
        where = self._path(path)
        if not self._fs.exists(where):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(where)]

    def has(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        stream.write(bytearray(text, "utf-8"))
        stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write to a side name first, then rename; False if another writer was faster."""
        final, side = self._path(path), self._path(f"{path}.{uuid.uuid4().hex}.tmp")
        self.put(side.toString(), text)
        return not self._fs.exists(final) and self._fs.rename(side, final)


class Table:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 partition: str | None = None, partition_of: str | None = None,
                 cluster: tuple[str, ...] = (), races: int = 1000):
        self.spark, self.path, self.schema, self.races = spark, path.rstrip("/"), schema, races
        self.partition, self.partition_of, self.cluster = partition, partition_of, cluster
        self._dir = _Folder(spark, self.path)

    # ---- commits

    def _commit_path(self, version: int) -> str:
        return f"{self.path}/_commits/{version:010d}.json"

    def exists(self) -> bool:
        return self._dir.has(self._commit_path(0))

    def _commit(self, version: int) -> dict:
        return json.loads(self._dir.read(self._commit_path(version)))

    def added_after(self, version: int, upto: dict) -> list[str]:
        """Ids of the writes that appends brought after a version, up to a state.

        What compaction or a rewrite put in other folders since is not listed again.
        """
        found = [self._commit(v).get("added") for v in range(version + 1, upto["version"] + 1)]
        return [w for w in found if w]

    def state(self) -> dict:
        """The latest commit. ``_CURRENT`` says where to start looking, so nothing is listed."""
        if not self.exists():
            raise TableMissing(self.path)
        hint = f"{self.path}/_CURRENT"
        version = int(self._dir.read(hint) or 0) if self._dir.has(hint) else 0
        while self._dir.has(self._commit_path(version + 1)):
            version += 1
        return self._commit(version)

    def create(self) -> Table:
        if not self.exists():
            self._dir.create(self._commit_path(0), json.dumps({"version": 0, "parts": {}, "txns": {}}))
        return self

    # ---- reads

    def read(self, first: date | str | None = None, last: date | str | None = None,
             keep_partition: bool = False, only: Iterable[str] | None = None) -> DataFrame:
        """The current rows; ``first``..``last`` (inclusive) or ``only`` select whole days."""
        parts = self.state()["parts"]
        if first is not None or last is not None:
            low, high = str(first or ""), str(last or "9999-12-31")
            parts = {p: v for p, v in parts.items() if p != NULL_PARTITION and low <= p <= high}
        if only is not None:
            parts = {p: parts[p] for p in only if p in parts}
        stored = T.StructType(list(self.schema))
        if self.partition:
            stored.add(self.partition, T.DateType())
        paths = [self._part_path(write, part) for part, writes in parts.items() for write in writes]
        if not paths:
            df = self._no_rows(stored)
        else:
            stored.add("w", T.StringType())
            df = self.spark.read.schema(stored).option("basePath", self.path).parquet(*paths).drop("w")
        return df if keep_partition or not self.partition else df.drop(self.partition)

    def _no_rows(self, schema: T.StructType) -> DataFrame:
        """Known to be empty when the plan is made, so a merge into a new table plans no join."""
        return self.spark.range(1).where(F.lit(False)).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

    def _part_path(self, write_id: str, part: str) -> str:
        tail = f"/{self.partition}={part}" if self.partition else ""
        return f"{self.path}/w={write_id}{tail}"

    def days(self) -> list[str]:
        return sorted(self.state()["parts"])

    # ---- writes

    def _write(self, df: DataFrame, one_day: bool = False) -> tuple[str, list[str]]:
        """Write a folder of its own; returns its id and the partition values it holds."""
        write_id = uuid.uuid4().hex
        where = f"{self.path}/w={write_id}"
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        if self.partition:
            columns.append(F.to_date(F.col(self.partition_of)).alias(self.partition))
        out = df.select(*columns)
        if (self.cluster or self.partition) and not one_day:
            # Rebalance, not repartition: AQE splits a day or value that holds most rows over many tasks.
            out = out.hint("rebalance", *([self.partition] if self.partition else self.cluster))
        if self.cluster:
            out = out.sortWithinPartitions(*([self.partition] if self.partition else []), *self.cluster)
        if not self.partition:
            out.write.parquet(where)
            return write_id, [WHOLE]
        out.write.partitionBy(self.partition).parquet(where)
        head = f"{self.partition}="
        return write_id, [n[len(head):] for n in self._dir.names(where) if n.startswith(head)]

    def _done(self, state: dict, txn: tuple[str, int] | None) -> bool:
        return txn is not None and state["txns"].get(txn[0], -1) >= txn[1]

    def _commit_change(self, change: Callable[[dict], None], txn: tuple[str, int] | None = None,
                       added: str | None = None) -> bool:
        """Apply a change to the latest state; if another commit comes first, to the one after it.

        Gives up only after ``races`` lost races.
        """
        for _ in range(self.races):
            state = self.state()
            if self._done(state, txn):
                return False
            change(state["parts"])
            state["version"] += 1
            state["added"] = added
            if txn is not None:
                state["txns"][txn[0]] = txn[1]
            if self._dir.create(self._commit_path(state["version"]), json.dumps(state)):
                self._dir.put(f"{self.path}/_CURRENT", str(state["version"]))
                return True
        raise RuntimeError(f"could not commit to {self.path}")

    def append(self, df: DataFrame, txn: tuple[str, int] | None = None, seen: dict | None = None,
               one_day: bool = False) -> str | None:
        """Add rows and return the id of the write.

        ``one_day`` says that a large load has one partition value only: each task writes what it has
        made. A shuffle by day would send all rows to one part, which is cut up again by the tasks that
        filled it, so it moves the whole load and evens out nothing. Rows of other days get in as well.

        ``txn`` = (writer, batch number) makes a repeated batch a no-op, with None returned.
        ``seen`` is the ``parts`` the rows were computed from: if the table has changed
        since, in whichever partition, the write fails.
        """
        if self._done(self.state(), txn):
            return None
        write_id, held = self._write(df, one_day) if one_day else self._write(df)

        def add(parts: dict) -> None:
            self._unchanged(parts, seen)
            for part in held:
                parts.setdefault(part, []).append(write_id)

        return write_id if self._commit_change(add, txn, write_id) else None

    def _unchanged(self, parts: dict, seen: dict | None) -> None:
        if seen is not None and parts != seen:
            raise TableChanged(f"{self.path} was written meanwhile; run the write again")

    def read_write(self, *write_ids: str) -> DataFrame:
        """Only the rows the named writes brought."""
        if not write_ids:
            return self._no_rows(self.schema)
        stored = T.StructType(list(self.schema)).add("w", T.StringType())
        if self.partition:
            stored.add(self.partition, T.DateType())
        found = self.spark.read.schema(stored).option("basePath", self.path).parquet(
            *[f"{self.path}/w={w}" for w in write_ids])
        return found.select(*self.schema.names)

    def replace(self, df: DataFrame, parts: Iterable[str] | None = None, seen: dict | None = None,
                txn: tuple[str, int] | None = None, whole: bool = False) -> str:
        """Put ``df`` in place of the named partitions (default: of everything).

        Partitions ``df`` brings that are not among the named ones gain rows. ``seen``
        is the ``parts`` of the state ``df`` was computed from (default: the present
        one): if a partition to be replaced has changed since, the write fails; with
        ``whole`` also if any other has, as when new keys must be new to the table.
        """
        before = self.state()["parts"] if seen is None else seen
        gone = None if parts is None else set(parts)
        write_id, held = self._write(df)

        def swap(now: dict) -> None:
            if whole:
                self._unchanged(now, before)
            dropped = set(now) | set(before) if gone is None else gone
            if any(now.get(p) != before.get(p) for p in dropped):
                raise TableChanged(f"{self.path} was written meanwhile; run the write again")
            for part in dropped:
                now.pop(part, None)
            for part in held:
                now.setdefault(part, []).append(write_id)

        self._commit_change(swap, txn)
        return write_id

    def compact(self, until: date | str | None = None) -> list[str]:
        """Rewrite partitions made up of several writes (up to day ``until``) as one; returns them.

        Many small appends, as from a stream, otherwise leave many small files.
        """
        seen, last = self.state()["parts"], str(until or "9999-12-31")
        many = [p for p, v in seen.items() if len(v) > 1 and (p <= last or p == NULL_PARTITION)]
        if many:
            self.replace(self.read(only=many), many, seen)
        return sorted(many)

    def drop_parts(self, parts: Iterable[str]) -> None:
        """Forget whole partitions (retention); their files are no longer read."""
        gone = set(parts)

        def forget(now: dict) -> None:
            for part in gone:
                now.pop(part, None)

        self._commit_change(forget)

    def write(self, df: DataFrame, disposition: str = "append") -> None:
        """``append`` adds, ``truncate`` replaces, ``empty`` fails if rows exist."""
        if disposition == "append":
            self.append(df)
        elif disposition == "truncate":
            self.replace(df)
        elif disposition == "empty":
            if not self.read().isEmpty():
                raise TableNotEmpty(self.path)
            self.append(df)
        else:
            raise ValueError(f"unknown disposition {disposition!r}")


class Lakehouse:
    """A folder with a Bronze and a Silver table per entity."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def bronze(self, name: str) -> Table:
        if name == "events_errors":
            return Table(self.spark, f"{self.root}/bronze/{name}", EVENTS_ERRORS_SCHEMA,
                         "error_date", "error_timestamp")
        if name == "_ingestion_log":
            return Table(self.spark, f"{self.root}/bronze/{name}", INGESTION_LOG_SCHEMA)
        spec = ENTITIES[name.removesuffix("_raw")]
        return Table(self.spark, f"{self.root}/bronze/{spec.bronze_table}", spec.bronze_schema,
                     "ingest_date", "ingested_at")

    def silver(self, name: str) -> Table:
        if name == "event_metrics_5min":
            return Table(self.spark, f"{self.root}/silver/{name}", EVENT_METRICS_SCHEMA,
                         "window_start_date", "window_start")
        spec = ENTITIES[name]
        return Table(self.spark, f"{self.root}/silver/{name}", spec.silver_schema,
                     spec.partition_column, spec.partition, spec.cluster)

    def create(self) -> Lakehouse:
        for name in (*ENTITIES, "events_errors", "_ingestion_log"):
            self.bronze(name).create()
        for name in (*ENTITIES, "event_metrics_5min"):
            self.silver(name).create()
        return self

    def table(self, layer: str, name: str, first: date | str | None = None,
              last: date | str | None = None, limit: int | None = None) -> DataFrame:
        """Rows of a table, optionally of a day range or the first ``limit``."""
        found = (self.bronze if layer == "bronze" else self.silver)(name).read(first, last)
        return found if limit is None else found.limit(limit)

