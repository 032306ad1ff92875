"""Every model of the library over the generic test tables, built on demand."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lendscope.operators import clients, monthly, schedule, scd2
from lendscope.operators.staging import stage
from lendscope.plans import marts
from lendscope.sources import scratch
from verification import mapping

BACKFILL_START, BACKFILL_END = -24, -1

#: Test tables of few bytes whose rows become very wide: a file of them is one or two splits, and
#: what is derived and typed from a split is one task's work. Tasks for each core.
WIDENED, TASKS_PER_CORE = ("customer",), 4

#: Models by the name of their table, where the two differ.
ATTRIBUTES = {
    "int_installment_schedule": "schedule",
    "int_loan_payment_performance": "performance",
    "int_pos_cash_loan": "pos_loans",
    "int_credit_card_loan": "cards",
    "int_bureau_client": "bureau_clients",
    "int_client_credit_history": "history",
    "mart_credit_risk": "segments",
    "mart_vintage_curves": "vintage",
    "snp_loan_status": "status_history",
}
#: Models in an order in which each follows those it is built on.
MODELS = (
    "pos", "schedule", "performance", "pos_loans", "pos_measures", "cards", "bureau_clients", "history", "dim_client",
    "fct_loans", "fct_installments", "segments", "vintage", "status_history",
)


class Frames:
    """Lazy frames of one scale factor; each is one plan over the Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

        self._sources: dict[str, DataFrame] = {}
        self._written: set[str] = set()

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._sources[name]

    def raw(self, name: str) -> DataFrame:
        """RAW-shaped table; reads only the test tables it is derived from."""
        for table in mapping.DERIVED_FROM[name]:
            self._spread(table).createOrReplaceTempView(table)
        return self.spark.sql(mapping.raw_sql(mapping.SPARK)[name])

    def _spread(self, table: str) -> DataFrame:
        """The source, dealt out to all cores while its rows are narrow, if they will be widened."""
        rows = self.source(table)
        if table not in WIDENED:
            return rows
        return rows.repartition(TASKS_PER_CORE * self.spark.sparkContext.defaultParallelism)

    def stg(self, name: str) -> DataFrame:
        return stage(self.raw(name), name)

    @cached_property
    def train(self) -> DataFrame:
        return self.stg("application_train")

    @cached_property
    def test(self) -> DataFrame:
        return self.stg("application_test")

    @cached_property
    def previous(self) -> DataFrame:
        return self.stg("previous_application")

    @cached_property
    def payments(self) -> DataFrame:
        return self.stg("installments_payments")

    @cached_property
    def pos(self) -> DataFrame:
        return self.stg("pos_cash_balance")

    @cached_property
    def status_months(self) -> DataFrame:
        """What a status history reads of the months, written once as the job has it: each load
        reads it, each dictionary of statuses too, and to derive it is a join and an aggregate."""
        if "pos" in self._written:
            return self.pos
        return scratch.written(
            self.pos.select("sk_id_prev", "sk_id_curr", "months_balance", "name_contract_status"),
            "status-months",
        )

    @cached_property
    def card_balances(self) -> DataFrame:
        return self.stg("credit_card_balance")

    @cached_property
    def bureau(self) -> DataFrame:
        return self.stg("bureau")

    @cached_property
    def schedule(self) -> DataFrame:
        return schedule.installment_schedule(self.payments)

    @cached_property
    def performance(self) -> DataFrame:
        return schedule.loan_performance(self.schedule)

    @cached_property
    def pos_loans(self) -> DataFrame:
        return monthly.monthly_loan_summary(self.pos, mapping.POS_WINDOW_START)

    @cached_property
    def pos_measures(self) -> DataFrame:
        """`pos_loans` for whoever does not ask for the last status: its dictionary, a scan of all
        months, is not made."""
        return monthly.monthly_loan_summary(self.pos, mapping.POS_WINDOW_START, with_status=False)

    @cached_property
    def cards(self) -> DataFrame:
        return monthly.card_summary(self.card_balances)

    @cached_property
    def bureau_clients(self) -> DataFrame:
        return clients.bureau_footprint(self.bureau)

    @cached_property
    def history(self) -> DataFrame:
        return clients.client_history(
            self.train,
            self.test,
            self.schedule,
            self.previous,
            self.pos_measures,
            self.cards,
            self.bureau_clients,
        )

    @cached_property
    def dim_client(self) -> DataFrame:
        return marts.dim_client(self.train, self.test)

    @cached_property
    def fct_loans(self) -> DataFrame:
        return marts.fct_loans(
            self.previous, self.train, self.performance, self.pos_measures, self.cards
        )

    @cached_property
    def fct_installments(self) -> DataFrame:
        return marts.fct_installments(self.schedule, self.train, self.previous)

    @cached_property
    def segments(self) -> DataFrame:
        return marts.segment_risk(marts.risk_universe(self.dim_client, self.history))

    @cached_property
    def vintage(self) -> DataFrame:
        return marts.vintage_curves(self.fct_loans, self.pos_measures)

    @cached_property
    def status_history(self) -> DataFrame:
        return scd2.scd2_backfill(self.status_months, BACKFILL_START, BACKFILL_END)

    def tables(self, names) -> dict[str, DataFrame]:
        """The named tables, as the declared checks name them. Every check reads its table apart,
        so those that are not staged are written first."""
        self.publish(*(ATTRIBUTES.get(n, n) for n in names if not n.startswith("stg_")))
        return {name: self._table(name) for name in names}

    def publish(self, *attributes: str) -> None:
        """Write these models once, as the job does between its layers; whoever reads them from
        here on, and models that are built on them from here on, read what was written."""
        for name in MODELS:
            if name in attributes:
                self.__dict__[name] = scratch.written(getattr(self, name), name.replace("_", "-"))
                self._written.add(name)

    def _table(self, name: str) -> DataFrame:
        if name.startswith("stg_"):
            return self.stg(name.removeprefix("stg_"))
        return getattr(self, ATTRIBUTES.get(name, name))


class StagedFrames(Frames):
    """Frames over staged tables that were written before, as the job has them."""

    def __init__(self, spark: SparkSession, sf_dir: str, staged: str):
        super().__init__(spark, sf_dir)
        self.staged = staged

    def stg(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.staged}/{name}")

    @cached_property
    def status_months(self) -> DataFrame:
        return self.pos
