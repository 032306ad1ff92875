"""A type-2 history as one published table of two kinds of folders.

Open versions, one for each key, lie in a folder that every load replaces. Closed versions lie in
folders that are written once, one for each load, and that a load does not read, unless it brings
rows of a moment that the history has passed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lendscope.operators import scd2
from lendscope.sources import files
from lendscope.sources.catalog import Run, observed

OPEN = "open"


class PastMomentError(RuntimeError):
    """A load says something else of a moment than the history does."""


@dataclass(frozen=True)
class Applied:
    """What a load did."""

    opened: int
    past: int
    refused: int


class StatusHistory:
    """The history `name` of a run; rows it refuses go to the table `<name>_refused`."""

    def __init__(
        self,
        run: Run,
        name: str,
        key: str = "sk_id_prev",
        check_cols: Sequence[str] = ("name_contract_status",),
    ):
        self.run, self.name = run, name
        self.key, self.check_cols = key, check_cols

    @property
    def refused_name(self) -> str:
        return f"{self.name}_refused"

    def exists(self) -> bool:
        return self.run.entry(self.name) is not None

    def read(self) -> DataFrame:
        return self.run.read(self.name)

    def open_versions(self) -> DataFrame:
        return self.run.read(self.name, [OPEN])

    def closed_versions(self) -> DataFrame:
        return self.run.read(self.name, [x for x in self.run.entry(self.name).folders if x != OPEN])

    def build(self, history: DataFrame, note: str | None = None) -> DataFrame:
        """Replace the history by one that is there as a whole."""
        self.run.publish(self.name, history.where(F.col(scd2.VALID_TO).isNotNull()), note)
        return self.run.put(self.name, OPEN, history.where(F.col(scd2.VALID_TO).isNull()), note)

    def apply(
        self,
        batch: DataFrame,
        moment: Column | None = None,
        note: str | None = None,
        stop_on_refused: bool = False,
    ) -> Applied:
        """The history after a batch of rows, one for each key and moment, of one or several
        moments. A batch that was applied before changes nothing.

        A row that contradicts what the history says of a moment it has passed leaves the
        history as it is: it stops the load, or is written to the table of refused rows and the
        others count.
        """
        if not self.exists():
            moment_col = F.col("as_of_month") if moment is None else moment
            self.build(scd2.start_history(batch.where("false"), self.key, moment_col), note)
        before = self.open_versions()
        found = scd2.scd2_changes(before, batch, self.key, self.check_cols, moment)
        # Written once; what follows reads it.
        folder = f"{self.run.root}/{self.name}/changes-{uuid.uuid4().hex}"
        seen = Observation()
        count = lambda kind: F.count_if(F.col(scd2.KIND) == kind).alias(kind)
        found.observe(seen, *map(count, (scd2.OPENS, scd2.PAST, scd2.REFUSED))).write.parquet(folder)
        changes = self.run.spark.read.schema(found.schema).parquet(folder)
        n = observed(seen, scd2.OPENS, scd2.PAST, scd2.REFUSED)
        n_refused = self._refuse(changes, n, stop_on_refused)
        if n[scd2.OPENS]:
            self.run.append(self.name, scd2.closed_by(before, changes, self.key), note)
            self.run.put(self.name, OPEN, scd2.open_after(before, changes, self.key), note)
        elif note is not None:
            self.run.annotate(self.name, note)
        files.remove_folder(self.run.spark, folder)
        return Applied(n[scd2.OPENS], n[scd2.PAST], n_refused)

    def _refuse(self, changes: DataFrame, n: dict, stop: bool) -> int:
        if not n[scd2.PAST] + n[scd2.REFUSED]:
            return 0
        columns = self.open_versions().columns
        bad = changes.where(F.col(scd2.KIND) == scd2.REFUSED).select(*columns)
        if n[scd2.PAST]:
            bad = bad.unionByName(
                scd2.contradictions(self.closed_versions(), changes, self.key, self.check_cols)
            )
        if stop:
            first = bad.first()
            if first is not None:
                raise PastMomentError(
                    f"status history is past moment {first[scd2.VALID_FROM]} of {self.key} {first[self.key]}"
                )
            return 0
        known = self.run.read(self.refused_name)
        # A load that is applied again is refused again, and recorded once.
        bad = bad.distinct() if known is None else bad.distinct().exceptAll(known.select(*columns).distinct())
        n_bad = bad.count()
        if n_bad:
            self.run.append(self.refused_name, bad)
        return n_bad
