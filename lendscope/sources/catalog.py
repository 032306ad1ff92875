"""Published tables of one folder, switched together.

    <root>/<table>/version-000007/...   files, never changed once they are written
    <root>/_runs/run-000012.json        which folders are the tables after run 12, all of them

A run writes versions beside the current ones, may read them back and check them, and becomes
current by creating the next file of `_runs`: all of its tables at once, or none. Two runs that
began from the same state cannot both create it, so the one that comes second is refused.

A table is a list of folders. A plain table has one, an appended table one for each load, a
bucketed table one for each bucket of its key's hash, so that a merge rewrites the buckets it
touches and goes on pointing at the others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lendscope.sources import files

RUNS, BUCKET = "_runs", "_bucket"
NO_METRICS: Mapping[str, Column] = {}


class ReconciliationError(RuntimeError):
    """What was written is not what was read."""


class OvertakenError(RuntimeError):
    """Another run became current since this one began."""


@dataclass(frozen=True)
class Entry:
    """A table as a run left it: folders and their rows by label, in paths relative to the root."""

    schema: str
    folders: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    buckets: int | None = None
    key: tuple[str, ...] = ()
    note: str | None = None

    @property
    def n_rows(self) -> int:
        return sum(self.rows.values())


def _load(text: str) -> dict[str, Entry]:
    tables = json.loads(text)
    return {name: Entry(**{**entry, "key": tuple(entry["key"])}) for name, entry in tables.items()}


def _dump(entries: dict[str, Entry]) -> str:
    return json.dumps({name: entry.__dict__ for name, entry in sorted(entries.items())}, indent=1)


def _run_numbers(spark: SparkSession, root: str) -> list[int]:
    found = files.names(spark, f"{root}/{RUNS}")
    return sorted(int(n[4:-5]) for n in found if n.startswith("run-") and n.endswith(".json"))


def _run_path(root: str, number: int) -> str:
    return f"{root}/{RUNS}/run-{number:06d}.json"


def current(spark: SparkSession, root: str) -> tuple[int, dict[str, Entry]]:
    """Number and tables of the newest run; 0 and none before the first."""
    numbers = _run_numbers(spark, root)
    if not numbers:
        return 0, {}
    return numbers[-1], _load(files.read_text(spark, _run_path(root, numbers[-1])))


def read_entry(
    spark: SparkSession, root: str, entry: Entry, labels: Iterable[str] | None = None
) -> DataFrame:
    """The rows of a table, or of some of its folders."""
    schema = StructType.fromJson(json.loads(entry.schema))
    chosen = entry.folders if labels is None else [x for x in labels if x in entry.folders]
    paths = [f"{root}/{entry.folders[label]}" for label in chosen]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def reconcile_counts(name: str, source_rows: int, loaded_rows: int) -> int:
    if source_rows != loaded_rows:
        raise ReconciliationError(
            f"{name}: {loaded_rows} rows were written, {source_rows} were read"
        )
    return loaded_rows


def observed(seen: Observation, *names: str) -> dict:
    """What was observed. Rows that the optimizer knows to be none are not observed: all zeros,
    which whoever counts back what was written finds out if it is wrong."""
    try:
        return seen.get
    except Py4JJavaError:
        return dict.fromkeys(names, 0)


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


class Run:
    """Tables written by one run. Nothing of it is current before `commit`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.number, self.entries = current(spark, self.root)
        self.changed: dict[str, Entry] = {}
        #: What was observed while a table was written, besides its rows.
        self.observed: dict[str, dict] = {}

    # --- reading

    def entry(self, name: str) -> Entry | None:
        return self.changed.get(name) or self.entries.get(name)

    def read(self, name: str, labels: Iterable[str] | None = None) -> DataFrame | None:
        """The table as this run sees it: as it has written it, else as it was when it began."""
        entry = self.entry(name)
        return None if entry is None else read_entry(self.spark, self.root, entry, labels)

    # --- writing

    def _next_version(self, name: str) -> str:
        """One past every version folder, also those of runs that never finished."""
        taken = [0]
        for found in files.names(self.spark, f"{self.root}/{name}"):
            if found.startswith("version-"):
                taken.append(int(found.removeprefix("version-")))
        return f"version-{max(taken) + 1:06d}"

    def _write(self, name: str, df: DataFrame, metrics: Mapping[str, Column]) -> tuple[str, int, str]:
        """A new version: its folder, its rows (counted as they are written and counted back)
        and its schema."""
        folder = f"{name}/{self._next_version(name)}"
        seen = Observation()
        rows = F.count(F.lit(1)).alias("rows")
        df.observe(seen, rows, *(c.alias(n) for n, c in metrics.items())).write.parquet(
            f"{self.root}/{folder}"
        )
        found = observed(seen, "rows", *metrics)
        self.observed[name] = found
        loaded = self.spark.read.schema(df.schema).parquet(f"{self.root}/{folder}").count()
        return folder, reconcile_counts(name, found["rows"], loaded), df.schema.json()

    def publish(
        self, name: str, df: DataFrame, note: str | None = None, metrics: Mapping[str, Column] = NO_METRICS
    ) -> DataFrame:
        """Replace a table. `metrics` are aggregates taken while it is written."""
        folder, rows, schema = self._write(name, df, metrics)
        self.changed[name] = Entry(schema, {"0": folder}, {"0": rows}, note=note)
        return self.read(name)

    def put(
        self,
        name: str,
        label: str,
        df: DataFrame,
        note: str | None = None,
        metrics: Mapping[str, Column] = NO_METRICS,
    ) -> DataFrame:
        """Add a folder to a table, or replace the one of that label; the others are neither
        read nor written."""
        before = self.entry(name)
        if before is None:
            folder, rows, schema = self._write(name, df, metrics)
            self.changed[name] = Entry(schema, {label: folder}, {label: rows}, note=note)
            return self.read(name)
        if before.buckets:
            raise ValueError(f"{name} is bucketed: merge into it")
        names = StructType.fromJson(json.loads(before.schema)).fieldNames()
        folder, rows, _ = self._write(name, df.select(*names), metrics)
        self.changed[name] = replace(
            before, folders=before.folders | {label: folder}, rows=before.rows | {label: rows}, note=note
        )
        return self.read(name)

    def append(
        self, name: str, df: DataFrame, note: str | None = None, metrics: Mapping[str, Column] = NO_METRICS
    ) -> DataFrame:
        """Add rows to a table as a folder of their own."""
        before = self.entry(name)
        taken = [] if before is None else [int(x) for x in before.folders if x.isdigit()]
        return self.put(name, str(max(taken, default=-1) + 1), df, note, metrics)

    def annotate(self, name: str, note: str | None) -> None:
        """Change the note of a table, and nothing else."""
        self.changed[name] = replace(self.entry(name), note=note)

    def _write_buckets(self, name: str, df: DataFrame, key: Sequence[str], buckets: int):
        """Folders and rows of a new version by bucket; buckets without rows have no folder."""
        folder = f"{name}/{self._next_version(name)}"
        seen = Observation()
        placed = df.withColumn(BUCKET, bucket_of(key, buckets)).observe(
            seen, F.count(F.lit(1)).alias("rows")
        )
        # Rows come as the last aggregate or join dealt them out, by their keys. To bring a bucket's
        # rows together would move all rows once more and put a bucket into one task; instead each
        # task writes a file for each bucket, sorted by bucket, so that one is open at a time.
        placed.write.partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        labels = [n.partition("=")[2] for n in files.names(self.spark, f"{self.root}/{folder}") if n.startswith(BUCKET)]
        rows = {}
        if labels:
            back = self.spark.read.schema(placed.schema).parquet(f"{self.root}/{folder}")
            # One row for each bucket.
            rows = {str(r[BUCKET]): r["count"] for r in back.groupBy(BUCKET).count().collect()}
        reconcile_counts(name, observed(seen, "rows")["rows"], sum(rows.values()))
        return {label: f"{folder}/{BUCKET}={label}" for label in labels}, rows

    def publish_buckets(
        self, name: str, df: DataFrame, key: Sequence[str], buckets: int, note: str | None = None
    ) -> DataFrame:
        """Replace a table, laid out in buckets of its key's hash.

        Choose the key so that no value of it holds a great part of the rows, and so many
        buckets that one of them fits into a task.
        """
        folders, rows = self._write_buckets(name, df, key, buckets)
        self.changed[name] = Entry(df.schema.json(), folders, rows, buckets, tuple(key), note)
        return self.read(name)

    def rewrite_buckets(
        self,
        name: str,
        delta: DataFrame,
        combine: Callable[[DataFrame, DataFrame], DataFrame],
        note: str | None = None,
    ) -> Change:
        """Replace the buckets that the rows of `delta` fall into by `combine(old, delta)`.

        `delta` is computed and written once, and counted as it is written; `combine` gets the
        old rows of the touched buckets and the delta, and returns the rows they are to have. An
        empty delta changes nothing.
        """
        before = self.entry(name)
        # The delta is for this run's use; no table ever names it.
        folder = f"{self.root}/{name}/delta-{uuid.uuid4().hex}"
        seen = Observation()
        placed = delta.withColumn(BUCKET, bucket_of(before.key, before.buckets)).observe(
            seen, F.count(F.lit(1)).alias("rows")
        )
        placed.write.partitionBy(BUCKET).parquet(folder)
        change = Change(self, folder, delta.schema, observed(seen, "rows")["rows"])
        if change.rows:
            old = self.read(name, change.labels)
            new = combine(old, change.delta).select(*old.columns)
            folders, rows = self._write_buckets(name, new, before.key, before.buckets)
            # A touched bucket may have lost all its rows.
            stay = {x: f for x, f in before.folders.items() if x not in change.labels}
            self.changed[name] = replace(
                before,
                folders=stay | folders,
                rows={x: n for x, n in before.rows.items() if x in stay} | rows,
                note=note if note is not None else before.note,
            )
        return change

    def merge(self, name: str, delta: DataFrame, note: str | None = None) -> Change:
        """Rows of `delta` replace those of equal key and are added to the others."""
        key = list(self.entry(name).key)
        return self.rewrite_buckets(
            name,
            delta,
            lambda old, new: old.join(new.select(*key), key, "left_anti").unionByName(new),
            note,
        )

    # --- switching

    def commit(self, names: Iterable[str] | None = None) -> int:
        """Make the tables this run has written (or some of them) current. Returns its number."""
        wanted = set(self.changed if names is None else names)
        chosen = {n: e for n, e in self.changed.items() if n in wanted}
        if not chosen:
            return self.number
        entries = self.entries | chosen
        if not files.create_text(self.spark, _run_path(self.root, self.number + 1), _dump(entries)):
            raise OvertakenError(
                f"{self.root}: run {self.number + 1} is there already; nothing of this run was made current"
            )
        self.number, self.entries = self.number + 1, entries
        self.changed = {n: e for n, e in self.changed.items() if n not in chosen}
        return self.number


@dataclass
class Change:
    """What a rewrite was made of: the rows of the delta, and where they are for later steps."""

    run: Run
    folder: str
    schema: StructType
    rows: int

    @property
    def labels(self) -> list[str]:
        """The buckets touched."""
        found = files.names(self.run.spark, self.folder)
        return [n.partition("=")[2] for n in found if n.startswith(BUCKET)]

    @property
    def delta(self) -> DataFrame:
        if not self.rows:
            return self.run.spark.createDataFrame([], self.schema)
        found = self.run.spark.read.schema(self.schema).parquet(self.folder)
        return found.select(*self.schema.fieldNames())

    def forget(self) -> None:
        """Remove the delta once nothing reads it any more."""
        files.remove_folder(self.run.spark, self.folder)


def expire(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Remove what only runs before the newest `keep` refer to. Never called by the library.

    Folders that no run ever named (of a run under way, or one that never finished) are left
    alone. Returns the folders removed. Readers of the runs that go must have ended.
    """
    if keep < 1:
        raise ValueError("at least the current run is kept")
    numbers = _run_numbers(spark, root)
    folders = {
        n: {f for e in _load(files.read_text(spark, _run_path(root, n))).values() for f in e.folders.values()}
        for n in numbers
    }
    kept = set().union(*(folders[n] for n in numbers[-keep:])) if numbers else set()
    gone = sorted(set().union(*(folders[n] for n in numbers[:-keep])) - kept) if numbers[:-keep] else []
    for number in numbers[:-keep]:
        files.remove_folder(spark, _run_path(root, number))
    for folder in gone:
        files.remove_folder(spark, f"{root}/{folder}")
    return gone
