"""Keyed incremental updates without a MERGE-capable table format.

Two ways to the same rows. `schedule_delta` needs nothing stored but the target: it aggregates
the touched installments again, from all their payments. `ScheduleTables` stores, in buckets of
the installment's hash, what the payments add up to: new payments are merged into the states of
the buckets they touch, and no earlier payment is read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.operators.schedule import (
    INSTALLMENT,
    installment_schedule,
    merge_states,
    schedule_of_states,
    version_states,
)
from lendscope.sources import store
from lendscope.sources.catalog import Change, Run

#: Buckets of the installment tables. A bucket is rewritten as a whole.
BUCKETS = 64


def delta_since(source: DataFrame, target: DataFrame, column: str = "loaded_at") -> DataFrame:
    """Source rows above the target's high-water mark; all of them if it has none.

    The mark is a scalar subquery: it is computed inside the same job and reaches the
    scan as a literal.
    """
    mark = target.agg(F.max(column)).scalar()
    return source.where(mark.isNull() | (F.col(column) > mark))


def upsert(
    target: DataFrame, delta: DataFrame, key: str, full_refresh: bool = False
) -> DataFrame:
    """Target with delta rows replacing those of equal key and new keys added.

    Rows are never deleted. Both sides have one row per key, so no key is large.
    """
    if full_refresh:
        return delta
    store.require_same_columns(key, target, delta)
    return target.join(delta.select(key), key, "left_anti").select(target.columns).unionByName(delta)


def schedule_delta(payments: DataFrame, target: DataFrame) -> DataFrame:
    """Schedule rows that any payment newer than the target has touched, in full.

    Only touched installments are aggregated again, from all their payments old and new.
    An installment's load time is the latest of its rows, so this is the same set as
    filtering a complete schedule by load time. The touched keys are distinct before
    they meet the payments; whether they are broadcast is decided by their measured size.
    """
    touched = (
        delta_since(payments, target)
        .select("sk_id_prev", "num_instalment_number")
        .distinct()
    )
    return installment_schedule(
        payments.join(touched, ["sk_id_prev", "num_instalment_number"], "left_semi")
    )


class ScheduleTables:
    """States, schedule and fact of a run, all in buckets of the installment's hash.

    Payments must be added once: what has been added is the caller's to know (a note of the
    states table, published with it).
    """

    STATES, SCHEDULE, FACT = "int_installment_states", "int_installment_schedule", "fct_installments"

    def __init__(self, run: Run, buckets: int = BUCKETS):
        self.run = run
        self.buckets = buckets

    def build(self, payments: DataFrame, note: str | None = None) -> DataFrame:
        """States and schedule of all payments."""
        key = list(INSTALLMENT)
        states = self.run.publish_buckets(self.STATES, version_states(payments), key, self.buckets, note)
        return self.run.publish_buckets(self.SCHEDULE, schedule_of_states(states), key, self.buckets)

    def add(self, payments: DataFrame, note: str | None = None) -> Change | None:
        """Merge new payments. The schedule rows that changed, or None if nothing did.

        Reads the new payments and the touched buckets of the states; rewrites the touched
        buckets of states and schedule.
        """
        change = self.run.rewrite_buckets(self.STATES, version_states(payments), merge_states, note)
        if not change.rows:
            change.forget()
            if note is not None:
                self.run.annotate(self.STATES, note)
            return None
        touched = change.delta.select(*INSTALLMENT).distinct()
        states = self.run.read(self.STATES, change.labels)
        rows = schedule_of_states(states.join(touched, list(INSTALLMENT), "left_semi"))
        moved = self.run.merge(self.SCHEDULE, rows)
        change.forget()
        return moved

    def build_fact(self, fact_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
        rows = fact_of(self.run.read(self.SCHEDULE))
        return self.run.publish_buckets(self.FACT, rows, list(INSTALLMENT), self.buckets)

    def merge_fact(
        self, fact_of: Callable[[DataFrame], DataFrame], moved: Change | None = None
    ) -> int:
        """Merge the fact rows of changed schedule rows. Returns how many there were.

        Changed are the rows of `moved`; without it, those loaded since the fact's newest row.
        """
        if moved is None:
            changed = delta_since(self.run.read(self.SCHEDULE), self.run.read(self.FACT))
        else:
            changed = moved.delta
        change = self.run.merge(self.FACT, fact_of(changed))
        change.forget()
        return change.rows
