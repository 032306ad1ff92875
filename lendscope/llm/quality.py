"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1. The unlabelled side is web text whose labels
are hidden from the fit. With the class prior p, the risk of a scorer f is

    p * E_pos[loss(f, +1)] + max(0, E_unl[loss(f, -1)] - p * E_pos[loss(f, -1)])

whose second part estimates the risk on the negatives and is kept from going below zero: as
soon as it does, the step goes the other way, which stops the fit from explaining positives
inside the unlabelled text as negatives. The loss is logistic, so the sigmoid of f is the
probability of quality 1.

The scorer is linear over soft threshold units of text statistics (shares of letter cases,
digits, signs and repeats, line and word shapes). It sees whole texts and nothing else.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import small_batches, spread

#: Labelled rows the fit may take, the positives and the unlabelled side together.
TRAIN_ROWS = 20_000
#: Quantile units for each statistic, steps of the fit, step width and weight decay.
UNITS, STEPS, RATE, DECAY = 8, 600, 0.05, 1e-4
#: Rows and bytes of a batch where rows pass through with all their columns.
PASSED_ROWS, PASSED_BYTES = 1_000, 4 * 1024 * 1024

STATISTICS = (
    "empty", "log_words", "chars_per_word", "long_words", "short_words", "upper", "digits",
    "signs", "stops", "brackets_pipes", "spaces", "wide", "control", "upper_words",
    "plain_words", "signs_per_word", "distinct_words", "top_word", "top_two_words",
    "next_same", "words_per_line", "repeated_lines", "lines_without_end", "words_per_stop",
)

_BYTE_GROUPS = {
    "upper": range(65, 91),
    "digits": range(48, 58),
    "stops": b".,;:!?'\"-",
    "brackets_pipes": b"|()[]{}<>",
    "signs": b"#$%&*+/=@\\^_`~!",
    "spaces": b" \t\r\n",
    "wide": range(128, 256),
    "control": [*range(0, 9), *range(14, 32), 127],
}
_GROUP_OF_BYTE = np.zeros((256, len(_BYTE_GROUPS)))
for _k, _members in enumerate(_BYTE_GROUPS.values()):
    _GROUP_OF_BYTE[list(_members), _k] = 1.0


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text; all are 0 for a null or empty one, but `empty`."""
    words = text.split() if text else []
    if not words:
        return [1.0] + [0.0] * (len(STATISTICS) - 1)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    group = dict(
        zip(_BYTE_GROUPS, np.bincount(raw, minlength=256) @ _GROUP_OF_BYTE / len(raw), strict=True)
    )
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    n = len(words)
    counts = Counter(words)
    tops = [c for _, c in counts.most_common(2)]
    lines = text.split("\n")
    filled = [line for line in lines if line]
    ended = sum(line[-1] in ".!?\"'" for line in filled)
    stops = group["stops"] * len(raw)
    return [
        0.0,
        math.log1p(n),
        float(sizes.mean()),
        float((sizes > 14).mean()),
        float((sizes < 3).mean()),
        group["upper"],
        group["digits"],
        group["signs"],
        group["stops"],
        group["brackets_pipes"],
        group["spaces"],
        group["wide"],
        group["control"],
        sum(map(str.isupper, words)) / n,
        sum(map(str.isalpha, words)) / n,
        group["signs"] * len(raw) / n,
        len(counts) / n**0.8,
        tops[0] / n,
        sum(tops) / n,
        sum(map(eq, words, words[1:])) / n,
        math.log1p(n / max(1, len(filled))),
        1.0 - len(set(filled)) / max(1, len(filled)),
        1.0 - ended / max(1, len(filled)),
        math.log1p(n / (1.0 + stops)),
    ]


@dataclass(frozen=True)
class Model:
    """A fitted scorer. `cuts` and `width` make the threshold units of each statistic."""

    cuts: np.ndarray
    width: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Probability of quality 1 of each row of statistics."""
        margin = _units(stats, self.cuts, self.width) @ self.weights + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))


def _units(stats: np.ndarray, cuts: np.ndarray, width: np.ndarray) -> np.ndarray:
    """A ramp from -1 to 1 around each cut of each statistic."""
    ramp = (stats[:, :, None] - cuts[None]) / width[None, :, None]
    return np.clip(ramp, -1.0, 1.0).reshape(len(stats), -1)


def fit_scorer(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative risk by Adam over all rows at once; deterministic.

    Without positives or unlabelled rows the score is the prior everywhere.
    """
    k = len(STATISTICS)
    if not len(positive) or not len(unlabelled):
        prior = min(max(prior, 1e-6), 1 - 1e-6)
        return Model(
            np.zeros((k, UNITS)), np.ones(k), np.zeros(k * UNITS), math.log(prior / (1 - prior)), prior
        )
    # Cuts spread over the range that occurs, half by rank and half evenly, so that rare
    # extreme values get units of their own.
    ranks = np.quantile(unlabelled, np.linspace(0.05, 0.95, UNITS // 2), axis=0).T
    low, high = unlabelled.min(axis=0), unlabelled.max(axis=0)
    even = low[:, None] + (high - low)[:, None] * np.linspace(0.1, 0.8, UNITS - UNITS // 2)
    cuts = np.concatenate([ranks, even], axis=1)
    width = np.maximum(unlabelled.std(axis=0), 1e-6)
    xp, xu = _units(positive, cuts, width), _units(unlabelled, cuts, width)
    w, b = np.zeros(xp.shape[1]), math.log(prior / (1 - prior)) if 0 < prior < 1 else 0.0
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sigmoid = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, STEPS + 1):
        fp, fu = xp @ w + b, xu @ w + b
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        up, uu = sigmoid(fp) / len(fp), sigmoid(fu) / len(fu)
        g_neg = np.append(xu.T @ uu - prior * (xp.T @ up), uu.sum() - prior * up.sum())
        down = (sigmoid(fp) - 1.0) / len(fp)
        g_pos = prior * np.append(xp.T @ down, down.sum())
        grad = g_pos + g_neg if negative >= 0 else -g_neg
        grad[:-1] += DECAY * w
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        rate = RATE * (1 - (step - 1) / STEPS)
        w, b = w - rate * move[:-1], b - rate * move[-1]
    return Model(cuts, width, w, float(b), prior)


def training_rows(labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[DataFrame, float]:
    """doc_id and role (1 trusted positive, 0 unlabelled) of at most `rows` labelled rows, and
    the class prior: the share of positives among all rows that may be learned from.

    Held-out rows (crc32 of the id as text, modulo 3, is 1) and rows without id or label never
    take part. An id with labels that disagree is not trusted. Which rows are taken, and on
    which side, depends on a hash of the id only; on the unlabelled side the label is hidden.
    """
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    prior = usable.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    order = F.xxhash64("doc_id")
    taken = usable.orderBy(order, "doc_id").limit(rows)
    side = F.when(F.pmod(order, F.lit(2)) == 0, F.lit(0)).when(F.col("quality") == 1, F.lit(1))
    chosen = taken.select("doc_id", side.alias("role")).where(F.col("role").isNotNull())
    return chosen, 0.5 if prior is None else float(prior)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most `rows` labelled documents; their statistics are what comes to the driver."""
    small_batches(docs.sparkSession)
    chosen, prior = training_rows(labels, rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(stats, pa.list_(pa.float64()))], names=["role", "stats"]
            )

    # At most `rows` ids, so the broadcast is bounded.
    sample = (
        docs.select("doc_id", F.col("text").cast("string").alias("words"))
        .join(F.broadcast(chosen), "doc_id")
        .select("role", "words")
        .mapInArrow(measure, "role int, stats array<double>")
        .toPandas()
    )
    stats = np.array(sample["stats"].tolist(), float).reshape(len(sample), len(STATISTICS))
    # The order in which rows arrive must not show in the sums.
    order = np.lexsort(stats.T) if len(stats) else np.zeros(0, int)
    stats, role = stats[order], sample["role"].to_numpy()[order]
    return fit_scorer(stats[role == 1], stats[role == 0], prior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row. Null and empty texts have a score, too; other columns are
    ignored; an empty table gives an empty result."""
    small_batches(docs.sparkSession)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = np.array([statistics(text) for text in batch.column(1).to_pylist()], float)
            scores = model.score(stats.reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores)], names=["doc_id", "score"]
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("words")
    )
    return spread(rows).mapInArrow(rate, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that score at least `least`, with all their columns as they are."""
    small_batches(docs.sparkSession, PASSED_ROWS, PASSED_BYTES)
    place = docs.columns.index(text_col)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = np.array([statistics(text) for text in batch.column(place).to_pylist()], float)
            good = model.score(stats.reshape(-1, len(STATISTICS))) >= least
            yield batch.filter(pa.array(good))

    return spread(docs).mapInArrow(sift, docs.schema)
