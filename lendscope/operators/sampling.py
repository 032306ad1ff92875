"""A reproducible sample of clients with everything that refers to them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.sources.readers import write_sorted

# Fixed value: how the manifest describes the selection.
SELECTION = "ORDER BY md5(seed || ':' || SK_ID_CURR) LIMIT n_clients"
#: Hex digits of the hash that one histogram tells apart: 65,536 counts at most.
DIGITS = 4
#: Ids that may meet in one task to be sorted. Where more share the digits told apart so far, the
#: next histogram parts them.
SORTED_IDS = 10_000
#: Ids joined into one text on the way to a digest.
BLOCK_IDS = 10_000
CLIENT_TABLES = (
    "bureau",
    "previous_application",
    "installments_payments",
    "pos_cash_balance",
    "credit_card_balance",
)


def _hash(seed: int, key: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)))


def hash_sample(ids: DataFrame, n: int, seed: int, key: str = "sk_id_curr") -> DataFrame:
    """The n ids that come first in the order of a seeded hash; all if there are no more.

    The place of the n-th hash is found by histograms of its leading digits, each over the ids
    that share the digits found so far; the ids before that place are then a filter, and only
    the few at it are sorted. So n may be any number, and nothing is gathered or sorted as a
    whole. Repeated ids count each, null ids come last.
    """
    if n <= 0:
        return ids.select(key).limit(0)
    hashed = ids.select(key, _hash(seed, key).alias("_hash")).where(F.col(key).isNotNull())
    prefix, left = "", n
    before = F.lit(False)
    while True:
        here = hashed.where(F.col("_hash").startswith(prefix)) if prefix else hashed
        digits = F.substr(F.col("_hash"), F.lit(len(prefix) + 1), F.lit(DIGITS))
        counts = here.groupBy(digits.alias("digits")).agg(F.count(F.lit(1)).alias("n")).collect()
        taken = 0
        for row in sorted(counts, key=lambda r: r["digits"]):
            if taken + row["n"] >= left:
                break
            taken += row["n"]
        else:  # there are no more than n, and none are left out but null ids
            known = hashed.select(key)
            missing = left - taken
            return known.unionByName(ids.select(key).where(F.col(key).isNull()).limit(missing))
        at, left = prefix + row["digits"], left - taken
        before = before | (F.substr(F.col("_hash"), F.lit(1), F.lit(len(at))) < at)
        prefix = at
        if row["n"] <= SORTED_IDS or len(prefix) >= 32:
            break
    last = hashed.where(F.col("_hash").startswith(prefix)).orderBy("_hash", key).limit(left)
    return hashed.where(before).unionByName(last).select(key)


def sample_clients(
    train: DataFrame, test: DataFrame, n: int, n_test: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Selected labelled and unlabelled clients, each independent of the other."""
    return hash_sample(train, n, seed), hash_sample(test, n_test, seed)


def sample_closure(
    raw: Mapping[str, DataFrame], train_ids: DataFrame, test_ids: DataFrame
) -> dict[str, DataFrame]:
    """Every RAW row that belongs to a selected client; no orphans inside the sample."""
    everyone = train_ids.unionByName(test_ids)

    def of(table: str, ids: DataFrame, key: str = "sk_id_curr") -> DataFrame:
        return raw[table].join(ids, key, "left_semi").select(raw[table].columns)

    sample = {table: of(table, everyone) for table in CLIENT_TABLES}
    sample["application_train"] = of("application_train", train_ids)
    sample["application_test"] = of("application_test", test_ids)
    sample["bureau_balance"] = of(
        "bureau_balance", sample["bureau"].select("sk_id_bureau"), "sk_id_bureau"
    )
    return sample


def ids_digest(ids: DataFrame, key: str = "sk_id_curr") -> Column:
    """sha256 over the comma-joined ids in text order.

    Ids are sorted over partitions and joined block by block there. The hash itself can only be
    computed from front to back: one task reads the blocks in order, one at a time.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = (
        ids.select(key)
        .repartitionByRange(parts, key)
        .sortWithinPartitions(key)
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    blocks = laid.groupBy(F.expr(f"_seq div {BLOCK_IDS}").alias("_block")).agg(
        F.array_join(F.sort_array(F.collect_list(key)), ",").alias("_ids")
    )
    return sequential_sha256(blocks, "_block", "_ids").select("sha256").scalar()


def sequential_sha256(blocks: DataFrame, order: str, text: str) -> DataFrame:
    """One row: sha256 of the comma-joined texts in order. Holds one block at a time."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, first = hashlib.sha256(), True
        for batch in batches:
            for value in batch.column(0):
                running.update((b"" if first else b",") + value.as_py().encode())
                first = False
        yield pa.RecordBatch.from_pydict({"sha256": [running.hexdigest()]})

    return (
        blocks.repartition(1, F.lit(0)).sortWithinPartitions(order).select(text).mapInArrow(digest, "sha256 string")
    )


def sample_manifest(sample: Mapping[str, DataFrame], seed: int) -> DataFrame:
    """One row describing the sample: seed, digests of the ids, label rate, row counts."""
    train, test = sample["application_train"], sample["application_test"]

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count("*")).scalar()

    defaults = F.sum(F.when(F.col("target") == "1", 1).otherwise(0)).cast("double")
    rate = train.agg(F.round((defaults / F.count("*")).cast("decimal(18,10)"), 6)).scalar()
    counts = F.struct(*(rows(sample[name]).alias(name) for name in sorted(sample)))
    return train.sparkSession.range(1).select(
        F.lit(seed).cast("bigint").alias("seed"),
        rows(train).alias("n_clients"),
        F.lit(SELECTION).alias("selection"),
        ids_digest(train).alias("client_ids_sha256"),
        rows(test).alias("n_test_clients"),
        ids_digest(test).alias("test_client_ids_sha256"),
        rate.alias("default_rate"),
        counts.alias("row_counts"),
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.coalesce(1).write.mode("error").json(path)


def build_sample(
    raw: Mapping[str, DataFrame], path: str, n: int, n_test: int, seed: int
) -> DataFrame:
    """Write all tables of a sample, each in the order of its columns, and its manifest.

    The selected ids are written first and read by every table, so the selection runs once.
    Returns the manifest.
    """
    spark = raw["application_train"].sparkSession
    chosen = sample_clients(raw["application_train"], raw["application_test"], n, n_test, seed)
    ids = []
    for name, frame in zip(("train_ids", "test_ids"), chosen, strict=True):
        frame.write.mode("error").parquet(f"{path}/_{name}")
        ids.append(spark.read.schema(frame.schema).parquet(f"{path}/_{name}"))
    written = {}
    for name, df in sample_closure(raw, *ids).items():
        write_sorted(df, f"{path}/{name}")
        written[name] = spark.read.schema(df.schema).parquet(f"{path}/{name}")
    write_manifest(sample_manifest(written, seed), f"{path}/manifest")
    return spark.read.json(f"{path}/manifest")
