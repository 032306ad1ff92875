"""Collocations: phrases that occur far more often than their parts would let them.

Every task turns runs of its texts into count transducers (`transducer.build`) of their sorted
phrases and cuts them at the same prefixes (language, first word, second word), so all counts of
a phrase lie in one range; a range unites its automata and sums their counts. The counts of the
parts of a phrase are found by composing an automaton of the parts with that of their range.

What cannot reach the least count is not counted: a phrase only occurs as often as its least
frequent word, pair, or three words in a row. So words are counted first, then 64-bit hashes of the
pairs of frequent words, as plain numbers, then those of the triples of which both pairs are frequent, and
then the phrases whose pairs and triples all are. Which words (pairs, triples) are frequent travels as a bitmap of bounded size, by hash: a collision lets a rare one pass and
never stops a frequent one. Phrases are counted by their words, so counts stay exact at any size
of the vocabulary.

The prefixes that bound the ranges come from the exact counts of words; a word that alone is more
than a range is cut by the word that follows it.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import running_bases, saved, small_batches, spread
from lendscope.llm.transducer import Phrase, Transducer, build, unite

#: Words of one shard and bytes of text split at once: what a task holds in memory.
SHARD_WORDS, SLICE_BYTES = 2_000_000, 2 * 1024 * 1024
#: Automata united at once.
UNITED = 32
#: Bits of the hash bitmap: 16 for each frequent key, within these bounds (16 MB at most).
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
#: Language of texts that have none.
UNKNOWN = "und"
#: Rows of one language are ranked in so many groups first.
RANK_GROUPS = 64

# A break between pieces; A-Z become a-z, a tab parts words as a blank does.
BREAK = b"."
_SPLIT = bytes.maketrans(
    b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b".......... abcdefghijklmnopqrstuvwxyz"
)

BLOBS = "lang string, bucket long, blob binary"
Bounds = dict[str, list[Phrase]]


# --- shards: texts as runs of word numbers


class _Words(dict):
    """Word to number, in order of first sight. Number 0 is the break."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


class Shard:
    """Words of a run of texts of one language. The first `skip` of them only lead in: phrases
    that end among them were counted before."""

    def __init__(self, lead: Iterable[bytes] = ()):
        self.numbers = _Words({BREAK: 0})
        self.runs: list[np.ndarray] = []
        self.add(list(lead))
        self.skip = sum(map(len, self.runs))

    def add(self, words: list[bytes]) -> int:
        run = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        self.runs.append(run)
        return len(run)

    def ids(self) -> np.ndarray:
        self.runs = [np.concatenate(self.runs) if self.runs else np.zeros(0, np.int32)]
        return self.runs[0]

    def words(self) -> list[bytes]:
        return list(self.numbers)


def split_words(text: bytes) -> list[bytes]:
    """Words of translated text, with breaks as words of their own."""
    return text.replace(BREAK, b" . ").split()


def _slices(texts: list[bytes]) -> Iterator[tuple[bytes, bool]]:
    """Translated text in slices, and whether a text ends with the slice. Short texts share one,
    parted by breaks; long ones are cut between words."""
    joined: list[bytes] = []
    size = 0
    for text in texts:
        text = text.translate(_SPLIT)
        if len(text) >= SLICE_BYTES:
            start = 0
            while len(text) - start > SLICE_BYTES:
                end = max(
                    text.rfind(b" ", start, start + SLICE_BYTES), text.rfind(BREAK, start, start + SLICE_BYTES)
                )
                if end <= start:  # one word longer than a slice
                    ends = [e for e in (text.find(b" ", start + SLICE_BYTES), text.find(BREAK, start + SLICE_BYTES)) if e > 0]
                    end = min(ends, default=len(text))
                yield text[start:end], False
                start = end
            yield text[start:] + BREAK, True
            continue
        joined.append(text)
        size += len(text)
        if size >= SLICE_BYTES:
            yield BREAK.join(joined) + BREAK, True
            joined, size = [], 0
    if joined:
        yield BREAK.join(joined) + BREAK, True


def shards(batches: Iterator[pa.RecordBatch], overlap: int) -> Iterator[tuple[str, Shard]]:
    """The texts of (lang, text) batches as shards of bounded size, all languages together.

    A text that goes on in the next shard hands over its last `overlap` words.
    """
    opened: dict[str, Shard] = {}
    size = 0
    for batch in batches:
        texts: dict[str, list[bytes]] = {}
        column = batch.column(1).cast(pa.binary())
        for lang, text in zip(batch.column(0).to_pylist(), column.to_pylist(), strict=True):
            texts.setdefault(lang, []).append(text)
        for lang, of_lang in texts.items():
            for piece, ends in _slices(of_lang):
                shard = opened.setdefault(lang, Shard())
                size += shard.add(split_words(piece))
                if size >= SHARD_WORDS:
                    words, last = shard.words(), shard.ids()[-overlap:] if overlap else []
                    yield from opened.items()
                    opened, size = {}, 0
                    if not ends:
                        opened[lang] = Shard(words[i] for i in last)
    yield from opened.items()


# --- what a shard counts


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """As `xxhash64` of lang, a zero byte and the word."""
    seed, digest = lang.encode() + b"\0", xxhash.xxh64_intdigest
    return np.fromiter((digest(seed + word, 42) for word in words), np.uint64, len(words))


def _pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * np.uint64(0x9E3779B97F4A7C15) + right
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def _marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def word_counts(shard: Shard) -> tuple[list[bytes], np.ndarray]:
    counts = np.bincount(shard.ids()[shard.skip :], minlength=len(shard.numbers))
    return shard.words()[1:], counts[1:]


def _frequent_pairs(shard: Shard, lang: str, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which word numbers are frequent, where two such words meet, and the hash of each meeting."""
    hashes = _hashes(lang, shard.words())
    good = _marked(bitmap, hashes)
    good[0] = False
    ids = shard.ids()
    at = np.flatnonzero(good[ids[:-1]] & good[ids[1:]])
    return good, at, _pair_hashes(hashes[ids[at]], hashes[ids[at + 1]])


def pair_hash_counts(shard: Shard, lang: str, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the pairs of frequent words, and how often each occurs."""
    _, at, hashes = _frequent_pairs(shard, lang, bitmap)
    return np.unique(hashes[at + 1 >= shard.skip], return_counts=True)


def _triples(at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where two of the pairs overlap in a word, and the hash of the three words, from places of
    pairs and their hashes."""
    follows = np.flatnonzero(at[1:] == at[:-1] + 1)
    return at[follows], _pair_hashes(hashes[follows], hashes[follows + 1])


def triple_hash_counts(
    shard: Shard, lang: str, bitmap: np.ndarray, pair_bitmap: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of three words in a row, both pairs frequent, and how often each occurs."""
    _, at, hashes = _frequent_pairs(shard, lang, bitmap)
    frequent = _marked(pair_bitmap, hashes)
    at, hashes = _triples(at[frequent], hashes[frequent])
    return np.unique(hashes[at + 2 >= shard.skip], return_counts=True)


def phrase_counts(
    shard: Shard,
    lang: str,
    bitmap: np.ndarray,
    pair_bitmap: np.ndarray,
    longest: int,
    triple_bitmap: np.ndarray | None = None,
) -> list[tuple[Phrase, int]]:
    """Phrases of 2 to `longest` words, all pairs (and triples, if a bitmap tells them) in them
    frequent, with their counts, ascending."""
    ids = shard.ids()
    good, at, hashes = _frequent_pairs(shard, lang, bitmap)
    frequent = _marked(pair_bitmap, hashes)
    at, hashes = at[frequent], hashes[frequent]
    triples, triple_hashes = _triples(at, hashes)
    # Whether a frequent triple begins at a place.
    linked = np.zeros(max(len(ids), 1), bool)
    if triple_bitmap is not None:
        triples = triples[_marked(triple_bitmap, triple_hashes)]
    linked[triples] = True
    words = shard.words()
    numbers = sorted(np.flatnonzero(good).tolist(), key=words.__getitem__)
    place = np.zeros(len(words), np.int64)
    place[numbers] = np.arange(len(numbers))
    words = [words[i] for i in numbers]
    places = place[ids]
    keys: list[Phrase] = [(word,) for word in words]
    which = places[at]
    found: list[tuple[Phrase, int]] = []
    for length in range(2, longest + 1):
        if length > 2:
            goes_on = linked[at + length - 3]
            at, which = at[goes_on], which[goes_on]
        if not len(at):
            break
        codes, which = np.unique(which * len(words) + places[at + length - 1], return_inverse=True)
        keys = [(*keys[c // len(words)], words[c % len(words)]) for c in codes.tolist()]
        counts = np.bincount(which[at + length - 1 >= shard.skip], minlength=len(keys)).tolist()
        found += [(key, count) for key, count in zip(keys, counts, strict=True) if count]
    return sorted(found)


# --- ranges


def bucket_of(bounds: list[Phrase], phrase: Phrase) -> int:
    return bisect_right(bounds, phrase[:2])


def _blobs(lang: str, items: Iterable[tuple[Phrase, int]], bounds: Bounds) -> Iterator[tuple[str, int, bytes]]:
    """Automata of ascending phrases, one for each range."""
    of_lang, run, bucket = bounds.get(lang, []), [], None
    for phrase, count in items:
        here = bucket_of(of_lang, phrase)
        if here != bucket and run:
            yield lang, bucket, build(run).to_bytes()
            run = []
        bucket = here
        run.append((phrase, count))
    if run:
        yield lang, bucket, build(run).to_bytes()


def _batch(rows: list[tuple], **types: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in types]
    arrays = [pa.array(list(c), t) for c, t in zip(columns, types.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(types))


_BLOB_TYPES = {"lang": pa.string(), "bucket": pa.int64(), "blob": pa.binary()}


def _shard_blobs(
    texts: DataFrame, overlap: int, bounds: Bounds, count: Callable[[Shard, str], list[tuple[Phrase, int]]]
) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, shard in shards(batches, overlap):
            for row in _blobs(lang, count(shard, lang), bounds):
                yield _batch([row], **_BLOB_TYPES)

    return texts.mapInArrow(run, BLOBS)


def united(blobs: DataFrame, least: int) -> DataFrame:
    """One automaton for each range, with the counts of all, without phrases below `least`.

    A task holds one range at a time, as the union so far and at most `UNITED` parts.
    """
    parts = int(blobs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def finished():
            whole = held[0] if len(held) == 1 else unite(held)
            kept = build((phrase, n) for phrase, n in whole.items() if n >= least)
            return _batch([(*key, kept.to_bytes())], **_BLOB_TYPES)

        for batch in batches:
            for i in range(batch.num_rows):
                here = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                if here != key:
                    if held:
                        yield finished()
                    key, held = here, []
                held.append(Transducer.from_bytes(batch.column(2)[i].as_py()))
                if len(held) == UNITED:
                    held = [unite(held)]
        if held:
            yield finished()

    return saved(
        blobs.repartition(parts, "lang", "bucket").sortWithinPartitions("lang", "bucket").mapInArrow(run, BLOBS),
        "collocations",
    )


def word_hash() -> Column:
    return F.xxhash64(F.concat(F.col("lang"), F.lit("\0"), F.col("word")))


def bitmap_of(hashes: DataFrame) -> np.ndarray:
    """A bit for each hash (column `hash`); bounded by `MOST_BITS` whatever their number."""
    bits = LEAST_BITS
    wanted = 16 * hashes.count()
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    rows = (
        hashes.select(F.col("hash").bitwiseAND(F.lit(bits - 1)).alias("at"))
        .groupBy(F.expr("at div 8").alias("byte"))
        .agg(F.bit_or(F.expr("shiftleft(1, cast(at % 8 as int))")).alias("value"))
        .toPandas()
    )
    bitmap = np.zeros(bits // 8, np.uint8)
    bitmap[rows["byte"].to_numpy(np.int64)] = rows["value"].to_numpy(np.int64)
    return bitmap


def range_bounds(words: DataFrame, totals: dict[str, int], ranges: int) -> Bounds:
    """For each language the prefixes (first word, second word) that cut the mass of its frequent
    words into equal ranges; languages have ranges in proportion to their words.

    A cut lies inside the mass of one word; the second word cuts that mass as it cuts the mass of
    all words. Driver and tasks hold `ranges` prefixes, at most one more for each language.
    """
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    everything = sum(totals.values()) or 1
    laid = words.repartitionByRange(parts, "lang", "word").sortWithinPartitions("lang", "word")
    laid = saved(laid.withColumn("part", F.spark_partition_id()), "collocations")
    sums = laid.groupBy("lang", "part").agg(F.sum("n").alias("mass"))
    bases = running_bases(sums, "part", {"base": "mass"}, by=["lang"])
    inside = Window.partitionBy("lang", "part").orderBy("word").rowsBetween(Window.unboundedPreceding, 0)
    placed = saved(
        laid.join(bases, ["lang", "part"]).select(
            "lang", "word", "n", (F.col("base") + F.sum("n").over(inside) - F.col("n")).alias("before")
        ),
        "collocations",
    )
    mass = {row["lang"]: row["mass"] for row in sums.groupBy("lang").agg(F.sum("mass").alias("mass")).collect()}
    counts = {lang: max(1, round(ranges * totals[lang] / everything)) for lang in mass}
    cuts = [
        (lang, i, mass[lang] * i // counts[lang]) for lang in mass for i in range(1, counts[lang])
    ]
    if not cuts:
        return {}

    def words_at(targets: list[tuple]) -> dict[tuple[str, int], tuple[bytes, int, int]]:
        """For each (lang, number, place in the mass) the word there, what lies before it, its count."""
        by_lang: dict[str, list[tuple[int, int]]] = {}
        for lang, i, place in targets:
            by_lang.setdefault(lang, []).append((place, i))
        places = {lang: sorted(p) for lang, p in by_lang.items()}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for lang, word, n, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    of_lang = places.get(lang, [])
                    k = bisect_right(of_lang, (before, -1))
                    while k < len(of_lang) and of_lang[k][0] < before + n:
                        found.append((lang, of_lang[k][1], word, before, n))
                        k += 1
                yield _batch(found, lang=pa.string(), i=pa.int64(), word=pa.string(), before=pa.int64(), n=pa.int64())

        rows = placed.mapInArrow(run, "lang string, i long, word string, before long, n long").collect()
        return {(r["lang"], r["i"]): (r["word"].encode(), r["before"], r["n"]) for r in rows}

    first = words_at(cuts)
    inner = [
        (lang, i, (place - first[lang, i][1]) * mass[lang] // first[lang, i][2]) for lang, i, place in cuts
    ]
    second = words_at(inner)
    bounds: Bounds = {lang: [] for lang in mass}
    for lang, i, _ in cuts:
        bounds[lang].append((first[lang, i][0], second[lang, i][0]))
    return {lang: sorted(set(cut)) for lang, cut in bounds.items()}


# --- the operator


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return spread(
        docs.select(
            F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        )
    )


def _all_words(texts: DataFrame) -> DataFrame:
    """lang, word, n of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, shard in shards(batches, 0):
            words, counts = word_counts(shard)
            for start in range(0, len(words), 50_000):
                some = words[start : start + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.binary()).cast(pa.string()),
                     pa.array(counts[start : start + 50_000], pa.int64())],
                    names=["lang", "word", "n"],
                )

    counted = texts.mapInArrow(run, "lang string, word string, n long")
    return saved(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "collocations")


def _frequent_hashes(
    texts: DataFrame, overlap: int, count: Callable[[Shard, str], tuple[np.ndarray, np.ndarray]], least: int
) -> DataFrame:
    """Hashes, of pairs or triples, that occur `least` times; plain numbers, added up before and
    after the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, shard in shards(batches, overlap):
            hashes, counts = count(shard, lang)
            for start in range(0, len(hashes), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[start : start + 100_000].view(np.int64)), pa.array(counts[start : start + 100_000], pa.int64())],
                    names=["hash", "n"],
                )

    counted = texts.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return saved(counted.where(F.col("n") >= least).select("hash"), "collocations")


def _word_blobs(words: DataFrame, bounds: Bounds) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list] = {}
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by_lang.setdefault(lang, []).append(((word.encode(),), n))
            for lang, items in by_lang.items():
                for row in _blobs(lang, sorted(items), bounds):
                    yield _batch([row], **_BLOB_TYPES)

    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = words.select("lang", "word", "n").repartitionByRange(parts, "lang", "word")
    return laid.sortWithinPartitions("lang", "word").mapInArrow(run, BLOBS)


def _cuts(blobs: DataFrame, bounds: Bounds) -> DataFrame:
    """Every way to cut every phrase in two, and the ranges that count its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                of_lang = bounds.get(row["lang"], [])
                cuts = []
                for phrase, n in Transducer.from_bytes(row["blob"]).items():
                    for k in range(1, len(phrase)):
                        first, rest = phrase[:k], phrase[k:]
                        cuts.append(
                            (row["lang"], b" ".join(phrase).decode(), len(phrase), n, k,
                             b" ".join(first).decode(), bucket_of(of_lang, first),
                             b" ".join(rest).decode(), bucket_of(of_lang, rest))
                        )
                yield _batch(
                    cuts, lang=pa.string(), phrase=pa.string(), n_words=pa.int32(), a=pa.int64(), k=pa.int32(),
                    first=pa.string(), first_bucket=pa.int64(), rest=pa.string(), rest_bucket=pa.int64(),
                )

    schema = (
        "lang string, phrase string, n_words int, a long, k int, "
        "first string, first_bucket long, rest string, rest_bucket long"
    )
    return saved(blobs.mapInArrow(run, schema), "collocations")


def _part_counts(cuts: DataFrame, blobs: DataFrame) -> DataFrame:
    """lang, part, n: the automaton of the distinct parts of a range, composed with its counts.

    A part is itself a counted phrase of the range, so a group is no larger than the automaton.
    """
    parts = (
        cuts.select("lang", F.col("first_bucket").alias("bucket"), F.col("first").alias("part"))
        .unionByName(cuts.select("lang", F.col("rest_bucket").alias("bucket"), F.col("rest").alias("part")))
        .distinct()
    )

    def look_up(wanted: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        if not len(wanted):
            return pd.DataFrame({"lang": [], "part": [], "n": []}).astype({"lang": str, "part": str, "n": "int64"})
        acceptor = build(sorted((tuple(part.encode().split(b" ")), 1) for part in wanted["part"]))
        found = list(Transducer.from_bytes(counted["blob"][0]).compose(acceptor))
        return pd.DataFrame(
            {
                "lang": wanted["lang"][0],
                "part": [b" ".join(phrase).decode() for phrase, _ in found],
                "n": [n for _, n in found],
            }
        )

    return saved(
        parts.groupBy("lang", "bucket")
        .cogroup(blobs.groupBy("lang", "bucket"))
        .applyInPandas(look_up, "lang string, part string, n long"),
        "collocations",
    )



def collocations(
    docs: DataFrame,
    least: int = 100,
    longest: int = 5,
    absorb_percent: int = 100,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """lang, phrase, a, l, r, n, score of every phrase that holds against longer ones.

    Phrases have 2 to `longest` words and occur a >= `least` times inside pieces of their
    language. Of the ways to cut a phrase in two, the one with the lowest score
    floor(1000 * a * n / (l * r)) counts (l, r: occurrences of the parts, n: of all words), the
    first of equals. A phrase inside a longer candidate that makes up `absorb_percent` of its
    occurrences is left out. Arithmetic is in decimals of 38 digits and exact.

    A null text is empty, a null language is `und`. Texts of any length are counted, in slices.
    Repeated rows count each. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = _texts(docs, text_col, lang_col)
    words = _all_words(texts)
    by_lang = words.groupBy("lang").agg(F.sum("n").alias("n"))
    by_lang = saved(by_lang, "collocations")
    frequent = saved(words.where(F.col("n") >= least), "collocations")
    bitmap = bitmap_of(frequent.select(word_hash().alias("hash")))
    # One number for each language.
    totals = {row["lang"]: row["n"] for row in by_lang.collect()}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(frequent, totals, 2 * parts)

    pair_bitmap = bitmap_of(
        _frequent_hashes(texts, 1, lambda shard, lang: pair_hash_counts(shard, lang, bitmap), least)
    )
    # Phrases of two words hold no triples.
    triple_bitmap = None
    if longest > 2:
        triple_bitmap = bitmap_of(
            _frequent_hashes(
                texts, 2, lambda shard, lang: triple_hash_counts(shard, lang, bitmap, pair_bitmap), least
            )
        )
    phrases = _shard_blobs(
        texts,
        longest - 1,
        bounds,
        lambda shard, lang: phrase_counts(shard, lang, bitmap, pair_bitmap, longest, triple_bitmap),
    )
    counted = united(_word_blobs(frequent, bounds).unionByName(phrases), least)

    cuts = _cuts(counted, bounds)
    answers = _part_counts(cuts, counted)
    lefts = answers.select("lang", F.col("part").alias("first"), F.col("n").alias("l"))
    rights = answers.select("lang", F.col("part").alias("rest"), F.col("n").alias("r"))
    with_parts = saved(cuts.join(lefts, ["lang", "first"]), "collocations")
    with_parts = saved(with_parts.join(rights, ["lang", "rest"]), "collocations")
    # One row for each language.
    scored = with_parts.join(F.broadcast(by_lang), "lang").withColumn(
        "score", F.expr("cast(1000 * a as decimal(19,0)) * cast(n as decimal(19,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    )
    lowest = scored.groupBy("lang", "phrase").agg(
        F.first("n").alias("n"),
        F.first("a").alias("a"),
        F.min(F.struct("score", "k", "l", "r")).alias("cut"),
    )
    # A phrase inside a longer candidate is also inside one that has a word more.
    inside = (
        cuts.where("k = 1 and n_words > 2").select("lang", F.col("rest").alias("phrase"), "a")
        .unionByName(
            cuts.where("k = n_words - 1 and n_words > 2").select("lang", F.col("first").alias("phrase"), "a")
        )
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("around"))
    )
    absorbed = F.coalesce(100 * F.col("around") >= absorb_percent * F.col("a"), F.lit(False))
    return (
        lowest.join(inside, ["lang", "phrase"], "left")
        .where(~absorbed)
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def best(found: DataFrame, first: int = 2000) -> DataFrame:
    """The first rows of each language by score and a descending and phrase ascending, with their
    rank. Ranked in groups by hash first, so a language is spread over tasks."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    some = Window.partitionBy("lang", "group").orderBy(*order)
    near = (
        found.withColumn("group", group)
        .withColumn("rank", F.row_number().over(some))
        .where(F.col("rank") <= first)
        .drop("group", "rank")
    )
    of_lang = Window.partitionBy("lang").orderBy(*order)
    return near.withColumn("rank", F.row_number().over(of_lang).cast("long")).where(F.col("rank") <= first)
