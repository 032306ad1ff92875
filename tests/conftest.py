"""One local session and a small portfolio of source tables, all text as they are landed."""

from __future__ import annotations

import random
from types import SimpleNamespace

import pytest

from lendscope.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))},
    )
    yield session
    session.stop()


def _portfolio(seed: int = 11) -> dict[str, tuple[str, list[tuple]]]:
    """Columns and rows of each table. Clients have none to several credits and loans, loans
    have several schedule versions, unpaid installments and payments of unknown loans."""
    rng = random.Random(seed)
    labelled = [f"{7_000 + 13 * i}" for i in range(23)]
    unlabelled = [f"{90_000 + 7 * i}" for i in range(9)]
    rows: dict[str, list[tuple]] = {
        name: []
        for name in (
            "bureau", "bureau_balance", "previous_application", "installments_payments",
            "pos_cash_balance", "credit_card_balance",
        )
    }
    loan = credit = 0
    for client in labelled + unlabelled:
        for _ in range(rng.randrange(4)):
            credit += 1
            rows["bureau"].append((client, f"b{credit}"))
            rows["bureau_balance"] += [
                (f"b{credit}", str(-m), rng.choice(["C", "X", "0", "1"])) for m in range(rng.randrange(5))
            ]
        for _ in range(rng.randrange(3)):
            loan += 1
            rows["previous_application"].append((client, f"p{loan}"))
            for version in range(1, 1 + rng.randrange(1, 3)):
                for number in range(1, 1 + rng.randrange(1, 4)):
                    paid = None if rng.random() < 0.3 else str(rng.randrange(1, 90))
                    rows["installments_payments"].append(
                        (f"p{loan}", client, str(version), str(number), paid)
                    )
            table = rng.choice(["pos_cash_balance", "credit_card_balance"])
            rows[table] += [(f"p{loan}", client, str(-m)) for m in range(1, 2 + rng.randrange(4))]
    rows["installments_payments"] += [("p999", labelled[0], "1", "1", "5"), (None, None, "1", "1", None)]
    rows["bureau_balance"].append((None, "-1", "0"))
    columns = {
        "application_train": "SK_ID_CURR TARGET",
        "application_test": "SK_ID_CURR",
        "bureau": "SK_ID_CURR SK_ID_BUREAU",
        "bureau_balance": "SK_ID_BUREAU MONTHS_BALANCE STATUS",
        "previous_application": "SK_ID_CURR SK_ID_PREV",
        "installments_payments": (
            "SK_ID_PREV SK_ID_CURR NUM_INSTALMENT_VERSION NUM_INSTALMENT_NUMBER AMT_PAYMENT"
        ),
        "pos_cash_balance": "SK_ID_PREV SK_ID_CURR MONTHS_BALANCE",
        "credit_card_balance": "SK_ID_PREV SK_ID_CURR MONTHS_BALANCE",
    }
    rows["application_train"] = [(c, str(int(rng.random() < 0.25))) for c in labelled]
    rows["application_test"] = [(c,) for c in unlabelled]
    return {name: (columns[name], rows[name]) for name in columns}


@pytest.fixture(scope="session")
def portfolio(spark):
    """`rows` by table as plain tuples, `tables` as frames."""
    made = _portfolio()
    return SimpleNamespace(
        rows={name: rows for name, (_, rows) in made.items()},
        tables={
            name: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.split()))
            for name, (columns, rows) in made.items()
        },
    )
