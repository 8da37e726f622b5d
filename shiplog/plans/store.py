"""Tables on disk: parquet folders under one root.

Merged tables are partitioned, so a batch rewrites only the partitions it touches. Usage facts are
partitioned by org and day. Tables without a natural partition are partitioned by arrival: keys
that come together lie together, and a key directory, itself a table, tells which partition holds
a key. Later changes mostly concern what came lately, so they touch few partitions.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplog import schemas
from shiplog.operators.audits import REQUIRED_COLUMNS, audit
from shiplog.operators.merge import (
    MERGE_REQUEST_POLICY,
    PROJECT_POLICY,
    MergePolicy,
    existing,
    merge_by_key,
)
from shiplog.operators.usage_facts import USAGE_POLICY
from shiplog.session import staged

ARRIVAL = "arrival"
#: Marks a root whose tables are laid out as here.
LAYOUT = "_layout-key-directory"
#: Files of a key directory after which it is written anew in sorted ones.
DIRECTORY_FILES = 200
CLAIM_ATTEMPTS = 5
#: Files of an event table, beyond its snapshot, after which a job takes a new one.
EVENT_FILES = 100


class BrokenTable(Exception):
    """Rows that a table must not hold: found before any was published."""


class ClaimHeld(Exception):
    """Another job works on a scope, or died without letting go of it (see `Store.recover`)."""


def _name(path: str) -> str:
    return path.rpartition("/")[2]


@dataclass(frozen=True)
class Table:
    schema: T.StructType
    policy: MergePolicy | None = None
    partitions: tuple[str, ...] = ()

    @property
    def by_arrival(self) -> bool:
        return self.partitions == (ARRIVAL,)

    @property
    def stored(self) -> T.StructType:
        arrival = [T.StructField(ARRIVAL, T.IntegerType())] * self.by_arrival
        return T.StructType([*self.schema.fields, *arrival])

    def directory(self) -> Table:
        """(key, arrival): where each key lies, for good."""
        keys = [self.schema[k] for k in self.policy.keys]
        return Table(T.StructType([*keys, T.StructField(ARRIVAL, T.IntegerType())]))


TABLES = {
    "projects": Table(schemas.PROJECTS, PROJECT_POLICY, (ARRIVAL,)),
    "merge_requests": Table(schemas.MERGE_REQUESTS, MERGE_REQUEST_POLICY, (ARRIVAL,)),
    "usage_facts": Table(schemas.USAGE_FACTS, USAGE_POLICY, ("org_slug", "report_day")),
    "collector_runs": Table(schemas.COLLECTOR_RUNS),
    "usage_runs": Table(schemas.USAGE_RUNS),
    "usage_day_prints": Table(schemas.USAGE_DAY_PRINTS),
    "import_events": Table(schemas.IMPORT_EVENTS),
    "model_replies": Table(schemas.MODEL_REPLIES),
}
TABLES |= {f"{name}_keys": t.directory() for name, t in TABLES.items() if t.by_arrival}


@dataclass
class Store:
    """One job writes a table at a time; imports claim their scopes. Readers may read at any time."""

    spark: SparkSession
    root: str
    # Rows after which new keys go to a new partition; may change from one job to the next.
    part_rows: int = 250_000
    _fs: object = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if self._exists(self._path("collector_runs")) and not self._exists(f"{self.root}/{LAYOUT}"):
            raise ValueError(f"the tables under {self.root} are laid out in another way")

    # ------------------------------------------------------------ reading

    def read(self, name: str) -> DataFrame:
        """All rows; of an event table with a snapshot those that have not been deleted yet."""
        table = TABLES[name]
        return self._read_partitioned(name).select(*table.schema.fieldNames())

    def _read_partitioned(self, name: str) -> DataFrame:
        schema = TABLES[name].stored
        if not self._exists(self._path(name)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(name))

    # ------------------------------------------------------------ writing

    def create(self, seed: bool = True) -> None:
        """Write the empty tables and, for a new store, the seed run."""
        fresh = not self._exists(self._path("collector_runs"))
        self._mark(self.root, LAYOUT)
        for name, table in TABLES.items():
            if not self._exists(self._path(name)):
                empty = self.spark.createDataFrame([], table.stored)
                # A partitioned table starts as an empty folder; its first merge adds partitions.
                if table.partitions:
                    self._fs.mkdirs(self._hadoop_path(self._path(name)))
                else:
                    empty.write.parquet(self._path(name))
        if seed and fresh:
            started, completed = schemas.SEED_RUN
            self.append(
                "collector_runs",
                self.spark.range(1).select(
                    F.lit(started).cast("timestamp").alias("started_at"),
                    F.lit(completed).cast("timestamp").alias("completed_at"),
                ),
            )

    def append(self, name: str, rows: DataFrame) -> None:
        rows.select(*TABLES[name].schema.fieldNames()).write.mode("append").parquet(
            self._path(name)
        )

    def merge(self, name: str, folded: DataFrame, touched: DataFrame | None = None) -> None:
        """Merge a folded batch into a table by its policy.

        Reads and rewrites only the touched partitions; if all are new, as on a normal day, the
        batch is written once and without a join. A caller that knows the partitions of its
        batch passes them as `touched` and saves writing the batch aside to find them.
        """
        table = TABLES[name]
        batch = self._placed(name, folded) if table.by_arrival else folded
        batch = batch.select(*table.stored.fieldNames())
        if touched is None:
            batch = staged(batch, f"{name}-batch")
            touched = staged(batch.select(*table.partitions).distinct(), f"{name}-touched")
        target = self._touched(name, touched)
        if target.isEmpty():
            self._publish(name, batch)
            return
        # A key lies in one partition, so that partitions may be joined one by one.
        keys = tuple(dict.fromkeys((*table.policy.keys, *table.partitions)))
        self._publish(name, merge_by_key(target, batch, replace(table.policy, keys=keys)))

    def insert(self, name: str, folded: DataFrame) -> None:
        """Add rows whose keys the table does not hold: files are added, none is read or changed."""
        table = TABLES[name]
        batch = self._placed(name, folded) if table.by_arrival else folded
        batch = staged(batch.select(*table.stored.fieldNames()), f"{name}-batch")
        self._refuse_broken(name, batch)
        self._sized(name, batch).write.mode("append").partitionBy(*table.partitions).parquet(
            self._path(name)
        )

    def holding(self, name: str, rows: DataFrame) -> DataFrame:
        """The keys of `rows` that a table by arrival holds; reads the partitions they point to."""
        keys = list(TABLES[name].policy.keys)
        wanted = rows.select(*keys)
        found = self._look_up(name, wanted)
        return existing(wanted, self._touched(name, found.select(ARRIVAL).distinct()), keys)

    # ------------------------------------------------------------ the key directory
    # Keys are entered before the rows are published. A job that dies in between leaves entries
    # without rows; the next batch with such a key puts its row where the entry says.

    def _look_up(self, name: str, wanted: DataFrame) -> DataFrame:
        """(key, arrival) of the wanted keys that the directory has; `wanted` is read twice."""
        keys = list(TABLES[name].policy.keys)
        directory = self.read(f"{name}_keys")
        # Keys that come together are often alike: files of others are skipped by their bounds.
        least, most = wanted.agg(F.min(keys[0]), F.max(keys[0])).first()
        directory = directory.filter(F.col(keys[0]).between(F.lit(least), F.lit(most)))
        found = directory.join(wanted, keys, "left_semi")
        return staged(found.groupBy(*keys).agg(F.min(ARRIVAL).alias(ARRIVAL)), f"{name}-places")

    def _placed(self, name: str, folded: DataFrame) -> DataFrame:
        """The batch with the partition of each row; new keys are entered in the directory.

        New keys go to the last partition while it has room, else to as many new ones as they fill.
        """
        table = TABLES[name]
        keys = list(table.policy.keys)
        batch = staged(folded.select(*table.schema.fieldNames()), f"{name}-arrived")
        places = self._look_up(name, batch.select(*keys))
        fresh = staged(batch.select(*keys).join(places, keys, "left_anti"), f"{name}-new-keys")
        n = fresh.count()
        if n:
            directory = self.read(f"{name}_keys")
            filled = directory.groupBy(ARRIVAL).count()
            last = filled.agg(F.max_by(F.struct(ARRIVAL, "count"), ARRIVAL).alias("p")).first()["p"]
            part, held = last or (0, 0)
            if held and held + n > self.part_rows:
                part, held = part + 1, 0
            parts = max(1, -(-n // self.part_rows)) if not held else 1
            spread = F.pmod(F.xxhash64(*keys), F.lit(parts)) + part
            fresh = staged(fresh.select(*keys, spread.cast("int").alias(ARRIVAL)), f"{name}-entries")
            self.append(f"{name}_keys", fresh.orderBy(*keys))
            self._compact(f"{name}_keys", keys)
            places = places.unionByName(fresh)
        return batch.join(places, keys)

    def _compact(self, name: str, keys: list[str]) -> None:
        folder = self._hadoop_path(self._path(name))
        if len(self._fs.listStatus(folder)) > DIRECTORY_FILES:
            self.rewrite(name, lambda rows: rows.distinct().orderBy(*keys))

    # ------------------------------------------------------------ whole tables

    def _refuse_broken(self, name: str, rows: DataFrame) -> None:
        """Raise if rows lack a required value or repeat a key."""
        policy = TABLES[name].policy
        broken = audit(rows, policy.keys, REQUIRED_COLUMNS[name]).collect()  # a row per rule
        if broken:
            raise BrokenTable(f"{name}: " + "; ".join(str(r.asDict()) for r in broken))

    def rewrite(self, name: str, change: Callable[[DataFrame], DataFrame]) -> None:
        """Put `change` of an append-only table's rows in the place of the files they lie in.

        Files that others append meanwhile are left alone. Until the old files are gone, or if
        that is cut short, rows may be there twice; readers of such tables drop equal rows.
        """
        folder = self._hadoop_path(self._path(name))
        files = [f.getPath() for f in self._fs.listStatus(folder)]
        files = [f for f in files if f.getName().startswith("part-")]
        if not files:
            return
        rows = self.spark.read.schema(TABLES[name].stored).parquet(*map(str, files))
        self.append(name, staged(change(rows), f"{name}-rewritten"))
        for f in files:
            self._fs.delete(f, False)

    def replace(self, name: str, rows: DataFrame) -> None:
        """Replace a table as a whole."""
        self._publish(name, rows.select(*TABLES[name].schema.fieldNames()))

    def _touched(self, name: str, touched: DataFrame) -> DataFrame:
        """Table rows of the touched partitions.

        The list that goes through the driver holds the last partition column only: days of the
        plan, or arrivals, of which a batch has no more than rows.
        """
        parts = TABLES[name].partitions
        last = parts[-1]
        values = [r[0] for r in touched.select(last).distinct().collect()]
        rows = self._read_partitioned(name).filter(F.col(last).isin(values))
        return rows.join(touched, list(parts), "left_semi") if len(parts) > 1 else rows

    def _sized(self, name: str, rows: DataFrame) -> DataFrame:
        """Group rows by partition for writing; AQE splits a hot partition and joins small ones."""
        return rows.hint("rebalance", *[F.col(c) for c in TABLES[name].partitions])

    # ------------------------------------------------------------ snapshots
    # A snapshot of an event table holds the states that its events so far lead to, and the names
    # of the files they lie in. Readers take it and the files it does not name. Those it names go
    # when the next snapshot is complete, so that whoever still reads by the one before finds them.

    def states_and_events(
        self, name: str, states: T.StructType
    ) -> tuple[DataFrame, DataFrame]:
        """The states of the latest snapshot and the events that have been appended since."""
        snapshot, _, later = self._beyond(name)
        return self._of_files(states, [f"{snapshot}/states"] if snapshot else []), self._of_files(
            TABLES[name].stored, later
        )

    def take_snapshot(
        self,
        name: str,
        states: T.StructType,
        fold: Callable[[DataFrame, DataFrame], DataFrame],
        least: int = 0,
    ) -> bool:
        """Fold later events into the states and publish these as the new snapshot, if more than
        `least` files have come. A claim keeps two jobs from doing this at once."""
        if len(self._beyond(name)[2]) <= least:
            return False
        with self.claim([f"_snapshot/{name}"]):
            snapshot, files, later = self._beyond(name)
            old = self._of_files(states, [f"{snapshot}/states"] if snapshot else [])
            events = self._of_files(TABLES[name].stored, later)
            folder, last = f"{self.root}/_snapshots/{name}", snapshot.rpartition("/")[2]
            number = int(last.partition("-")[0]) + 1 if last else 0
            new = f"{number:012d}-{uuid.uuid4().hex}"
            fold(old, events).select(*states.fieldNames()).write.parquet(f"{folder}/{new}/states")
            names = self.spark.createDataFrame([(_name(f),) for f in files], "file string")
            names.coalesce(1).write.parquet(f"{folder}/{new}/files")
            self._mark(f"{folder}/{new}", "_COMPLETE")
            for f in set(files) - set(later):
                self._fs.delete(self._hadoop_path(f), False)
            for f in self._fs.listStatus(self._hadoop_path(folder)):
                if f.getPath().getName() not in (last, new):
                    self._fs.delete(f.getPath(), True)
        return True

    def _of_files(self, schema: T.StructType, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*files)

    def _beyond(self, name: str) -> tuple[str, list[str], list[str]]:
        """(folder of the latest complete snapshot or '', all files, those it does not cover).

        A snapshot taken while this looks leaves the files that the one before names alone, so
        that either is read whole.
        """
        snapshot, covered = "", set()
        folder = f"{self.root}/_snapshots/{name}"
        if self._exists(folder):
            found = [f.getPath().getName() for f in self._fs.listStatus(self._hadoop_path(folder))]
            found = [n for n in found if self._exists(f"{folder}/{n}/_COMPLETE")]
            if found:
                snapshot = f"{folder}/{max(found)}"
                # As many as there were files when it was taken.
                listed = self.spark.read.schema("file string").parquet(f"{snapshot}/files")
                covered = {r.file for r in listed.collect()}
        files = self._event_files(name)
        return snapshot, files, [f for f in files if _name(f) not in covered]

    def _event_files(self, name: str) -> list[str]:
        if not self._exists(self._path(name)):
            return []
        files = self._fs.listStatus(self._hadoop_path(self._path(name)))
        return [str(f.getPath()) for f in files if f.getPath().getName().startswith("part-")]

    # ------------------------------------------------------------ claims

    @contextmanager
    def claim(self, scopes: Sequence[str]) -> Iterator[None]:
        """Holds the scopes for one job at a time."""
        held = []
        try:
            for scope in dict.fromkeys(scopes):
                path = self._claimed(f"{self.root}/_claims/{quote(scope, safe='')}")
                if path is None:
                    raise ClaimHeld(f"{scope} is claimed by another job")
                held.append(path)
            yield
        finally:
            for path in held:
                self._fs.delete(path, False)

    def _claimed(self, folder: str):
        """Leaves a file in the folder and looks: whoever finds his alone holds the claim, the
        others take theirs away. Of two jobs the one that looks last sees the other's file."""
        path = self._hadoop_path(f"{folder}/{uuid.uuid4().hex}")
        for _ in range(CLAIM_ATTEMPTS):
            self._fs.create(path).close()
            if len(self._fs.listStatus(path.getParent())) == 1:
                return path
            self._fs.delete(path, False)
            # Jobs that came at the same moment may have made way for one another.
            time.sleep(random.uniform(0, 0.3))
        return None

    # ------------------------------------------------------------ publishing
    # New content, also of new partitions, is written aside in full, audited and marked complete.
    # Then its folders take the places of those in the table, by renaming: nothing is written
    # twice. If that is cut short, `recover` goes on with the folders that are still aside; content
    # that is not marked complete was never used.

    def _publish(self, name: str, rows: DataFrame) -> None:
        parts = TABLES[name].partitions
        path = f"{self.root}/_publish/{name}/{uuid.uuid4().hex}"
        if parts:
            self._sized(name, rows).write.partitionBy(*parts).parquet(path)
        else:
            rows.write.parquet(path)
        try:
            if TABLES[name].policy:
                aside = self.spark.read.schema(TABLES[name].stored).parquet(path)
                self._refuse_broken(name, aside)
        except BrokenTable:
            self._fs.delete(self._hadoop_path(path), True)
            raise
        self._mark(path, "_COMPLETE")
        self._swap_in(name, path)

    def _swap_in(self, name: str, path: str) -> None:
        aside, table = self._hadoop_path(path), self._hadoop_path(self._path(name))
        depth = len(TABLES[name].partitions)
        if not depth:
            self._move(aside, table)
            return
        folders = [(aside, table)]
        for _ in range(depth):
            folders = [
                (f.getPath(), self._child(place, f.getPath().getName()))
                for folder, place in folders
                for f in self._fs.listStatus(folder)
                if f.isDirectory()
            ]
        for folder, place in folders:
            self._move(folder, place)
        self._fs.delete(aside, True)

    def _move(self, folder, place) -> None:
        self._fs.delete(place, True)
        self._fs.mkdirs(place.getParent())
        if not self._fs.rename(folder, place):
            raise OSError(f"{folder} cannot be renamed to {place}")

    def recover(self) -> None:
        """Finish or clear what jobs that died have left. Call it only while no job runs: opening
        a store never does this, as it cannot tell a dead job from a running one."""
        self._fs.delete(self._hadoop_path(f"{self.root}/_claims"), True)
        for name in TABLES:
            waiting = f"{self.root}/_publish/{name}"
            if not self._exists(waiting):
                continue
            for status in self._fs.listStatus(self._hadoop_path(waiting)):
                path = f"{waiting}/{status.getPath().getName()}"
                if self._exists(f"{path}/_COMPLETE"):
                    self._swap_in(name, path)
                else:
                    self._fs.delete(self._hadoop_path(path), True)

    def _mark(self, path: str, mark: str) -> None:
        self._fs.create(self._hadoop_path(f"{path}/{mark}")).close()

    # ------------------------------------------------------------ paths

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _hadoop_path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _child(self, folder, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(folder, name)

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._hadoop_path(path))
