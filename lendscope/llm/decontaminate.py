"""Benchmark decontamination by template canonicalisation. DataFrame expressions only.

Numbers, names and units become typed placeholders, so a question asked with other values has
the same template. Every window of template words of every document is hash-joined with the
windows of the benchmark. Where windows meet, the values in the slots are compared along the
alignment of document and item: a value of the item must always stand for one and the same
value of the document. What shares the template by chance gives conflicting slots and is let
go; what repeats or re-parameterises the item is reported.

The typed template hinges on case and full stops, which tell names from other words. So a
second form of every text stands beside it, without signs and case, in which only numbers and
units are replaced: it finds copies without punctuation, in title case or in capitals. A place
of the item counts as found if either form is. Items that say too little in both forms, and items
of a few words only, are looked for with their values as they are.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import saved, small_table, text_hash

#: Words of a window; items with fewer words are one window. An item needs so many words for its
#: template to say anything; shorter ones are looked for word by word.
WINDOW, TEMPLATE_WORDS = 8, 4
#: Windows of all items up to which their texts are broadcast.
BROADCAST_WINDOWS = 200_000
#: Share of an item's windows that a document must hold, and of slots that may conflict.
COVERAGE, CONFLICTS = 0.5, 0.2

#: What a row is known by: its id may be that of other texts, too.
ROW = ["doc_id", "text_hash"]

NUMBER, NAME, UNIT = "<n>", "<p>", "<u>"
UNITS = (
    "mm|cm|dm|m|km|inch|inches|feet|foot|ft|yards?|miles?|mg|g|kg|tons?|tonnes?|grams?|"
    "kilograms?|pounds?|lbs?|ounces?|oz|ml|cl|l|liters?|litres?|gallons?|ms|s|seconds?|min|"
    "minutes?|h|hours?|days?|weeks?|months?|years?|cents?|dollars?|euros?|usd|eur|gbp|"
    "percent|degrees?|mph|kmh|km/h|watts?|kw|kwh|volts?|hz|khz|mhz|bytes?|kb|mb|gb|tb"
)
# A capitalised word that follows another word of the same sentence and line; words in
# capitals throughout are no names, they are a way to shout.
_NAME = r"(?=\p{Lu})(?<=[^.!?:\s\p{N}] )\p{Lu}\p{Ll}[\p{L}'-]*"
_NUMBER = r"(?=[-+$€£\p{N}])[-+]?[$€£]?\p{N}[\p{N}.,:/]*%?"
_UNIT = rf"(?i)(?<=<n>\s)(?:{UNITS})(?![\p{{L}}\p{{N}}])"
# Signs at the rim of a word; a word of signs only stays, so words keep their places. What begins
# a pattern is looked at first, so that most places need no look back.
_SIGN = r"[^\p{L}\p{N}\s<>]"
_RIM = rf"(?={_SIGN})(?:(?<=[\p{{L}}\p{{N}}>]){_SIGN}+(?=\s|$)|(?<=^|\s){_SIGN}+(?=[\p{{L}}\p{{N}}<]))"


# The second form: numbers, units behind them, and signs, in lower case.
_PLAIN_NUMBER = r"\p{N}[\p{N}.,:/-]*"
_PLAIN_UNIT = rf"<n>(\s+)(?:{UNITS})(?![\p{{L}}\p{{M}}\p{{N}}])"
_SIGNS = r"[^\p{L}\p{M}\p{N}\p{Z}\s<>]+"


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def template(text: Column) -> Column:
    """Template words, one for each word of the text and in the same places."""
    plain = F.translate(text, "<>", "**")
    named = F.regexp_replace(plain, _NAME, NAME)
    numbered = F.regexp_replace(named, _NUMBER, NUMBER)
    united = F.regexp_replace(numbered, _UNIT, UNIT)
    return words(F.lower(F.regexp_replace(united, _RIM, "")))


def _bare(text: Column, number: str | None) -> Column:
    """The text without case and signs, numbers replaced if a placeholder is given."""
    lowered = F.replace(F.translate(F.lower(text), "<>", ""), F.lit("ß"), F.lit("ss"))
    if number:
        lowered = F.regexp_replace(lowered, _PLAIN_NUMBER, number)
    return F.regexp_replace(lowered, _SIGNS, "")


def folded(text: Column) -> Column:
    """Words without case and signs, numbers and units replaced; words of signs only are left
    out, so places are counted among these words."""
    return words(F.regexp_replace(_bare(text, NUMBER), _PLAIN_UNIT, f"{NUMBER}$1{UNIT}"))


def bare(text: Column) -> Column:
    """The words of `folded`, in the same places, with their values."""
    return words(_bare(text, None))


#: Forms of a text by kind, and the words that stand in their places.
TYPED, FOLDED, BARE = 1, 2, 3
FORMS = {TYPED: template, FOLDED: folded, BARE: bare}
VALUES = {TYPED: words, FOLDED: bare, BARE: bare}


def _origins(text: Column, kind: int) -> Column:
    """For each place of a form its place among the words of the text."""
    places = F.transform(
        words(text), lambda w, i: i + 1 if kind == TYPED else F.when(_bare(w, None) != "", i + 1)
    )
    return F.filter(places, lambda i: i.isNotNull())


def _with_windows(rows: DataFrame, length: int) -> DataFrame:
    """The rows (word hashes in h) with w: a hash of each run of `length` words, by first place.

    Hashes of 2, 4, ... words are made from two of half the length; a run of any length is put
    together from those of the powers of two in it.
    """

    def joined(runs: str, behind: str, shift: int) -> Column:
        return F.transform(runs, lambda x, i: F.xxhash64(x, F.get(F.col(behind), i + shift)))

    size, made = 1, rows.withColumn("w1", F.col("h"))
    while 2 * size <= length:
        made = made.withColumn(f"w{2 * size}", joined(f"w{size}", f"w{size}", size))
        size *= 2
    made, done = made.withColumn("w", F.col(f"w{size}")), size
    while done < length:
        while size > length - done:
            size //= 2
        made = made.withColumn("w", joined("w", f"w{size}", done))
        done += size
    n_runs = F.greatest(F.size("h") - length + 1, F.lit(0))
    return made.withColumn("w", F.slice("w", F.lit(1), n_runs)).select(*rows.columns, "w")


def _run_hash(place: Column, length: int) -> Column:
    """As `_with_windows` for the one run of word hashes (in h) at a place, from 1."""

    def whole(at: Column, size: int) -> Column:
        if size == 1:
            return F.get("h", at - 1)
        return F.xxhash64(whole(at, size // 2), whole(at + size // 2, size // 2))

    size = 1 << (length.bit_length() - 1)
    run, done = whole(place, size), size
    while done < length:
        size = 1 << ((length - done).bit_length() - 1)
        run, done = F.xxhash64(run, whole(place + done, size)), done + size
    return run


def _telling(items: DataFrame, kind: int) -> DataFrame:
    """item_id, kind, length, place, hash, origin of the windows of one form that say enough:
    half of their words are no placeholders. Where values stand for themselves, a window needs
    a letter. origin has the places of the text that a window begins at."""
    fewest = 1 if kind == BARE else TEMPLATE_WORDS
    formed = (
        items.select("item_id", FORMS[kind](F.col("text")).alias("t"), _origins(F.col("text"), kind).alias("at"))
        .where(F.size("t") >= fewest)
        .withColumn("length", F.least(F.size("t"), F.lit(WINDOW)))
        .withColumn("h", F.transform("t", lambda w: F.xxhash64(w)))
    )
    window = F.slice("t", F.col("place"), F.col("length"))
    if kind == BARE:
        enough = F.exists(window, lambda w: w.rlike(r"\p{L}"))
    else:
        said = F.size(F.filter(window, lambda w: ~w.isin(NUMBER, NAME, UNIT)))
        enough = said * 2 >= F.col("length")
    # Words that the form leaves out belong to the word behind them.
    before = F.coalesce(F.get("at", F.col("place") - 2), F.lit(0))
    return (
        formed.select(
            "*", F.explode(F.sequence(F.lit(1), F.size("t") - F.col("length") + 1)).alias("place")
        )
        .where(enough)
        .select(
            "item_id",
            F.lit(kind).alias("kind"),
            "length",
            "place",
            F.coalesce(
                *(F.when(F.col("length") == n, _run_hash(F.col("place"), n)) for n in range(fewest, WINDOW + 1))
            ).alias("hash"),
            F.sequence(before + 1, F.get("at", F.col("place") - 1)).alias("origin"),
        )
    )


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """item_id, kind, length, place, hash, origin, n_windows of the windows that say enough.

    The places to be found are those of the typed form or, of items without any, those of the
    next form that has some; origin has those of them that a window stands for.
    """
    items = benchmark.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(item_col).alias("item_id"), F.col(text_col).alias("text")
    )
    both = _telling(items, TYPED).unionAll(_telling(items, FOLDED))
    rest = items.join(both.select("item_id").distinct(), "item_id", "left_anti")
    windows = both.unionAll(_telling(rest, BARE))
    first = windows.groupBy("item_id").agg(F.min("kind").alias("kind"))
    wanted = (
        windows.join(first, ["item_id", "kind"])
        .groupBy("item_id")
        .agg(F.array_distinct(F.flatten(F.collect_set("origin"))).alias("wanted"))
    )
    return (
        windows.join(wanted.hint("merge"), "item_id")
        .withColumn("origin", F.array_intersect("origin", "wanted"))
        .withColumn("n_windows", F.size("wanted"))
        .where(F.size("origin") > 0)
        .drop("wanted")
        .distinct()
    )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    conflicts: float = CONFLICTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """doc_id, text_hash, item_id, coverage, first_word, n_slots, n_conflicts, n_changed of every
    document that holds an item, or the item with other values.

    coverage is the share of the item's windows found; n_changed counts slots whose value
    differs from the item's. Rows with a null id or text hold nothing; each text of rows that
    share an id is judged by itself (text_hash), and rows that repeat an id and a text are one.
    Items of fewer than four words are found word for word, case and signs aside. Items of numbers
    only cannot be recognised, nor can names be told from other words where a copy has other names
    and another case. Texts of any length are searched as a whole. Empty tables give an empty result; other columns are ignored.
    """
    items = saved(benchmark_windows(benchmark, item_col, item_text_col), "leaks")
    # At most three times as many as a window has words.
    lengths = sorted(map(tuple, items.select("kind", "length").distinct().collect()))
    lengths = lengths or [(TYPED, WINDOW)]
    kinds = sorted({kind for kind, _ in lengths})
    usable = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"),
        text_hash(F.col(text_col)).alias("text_hash"),
        F.col(text_col).cast("string").alias("text"),
    )
    hashed = {
        kind: usable.select(
            *ROW, F.transform(FORMS[kind](F.col("text")), lambda w: F.xxhash64(w)).alias("h")
        )
        for kind in kinds
    }
    every = _union(
        # An outer explode: from a plain one Spark infers a filter on the size of w and pushes it
        # below the projections, with all hashes written out in it. Rows without runs meet nothing.
        _with_windows(hashed[kind], n).select(
            *ROW, F.lit(kind).alias("kind"), F.lit(n).alias("length"), F.posexplode_outer("w")
        )
        for kind, n in lengths
    )
    met = saved(
        every.withColumnsRenamed({"pos": "at", "col": "hash"})
        .join(small_table(items), ["kind", "length", "hash"])
        .select(
            *ROW, "item_id", "n_windows", "kind", "length", "place", "origin", (F.col("at") + 1).alias("at")
        ),
        "leaks",
    )
    # What falls short even if all alignments are taken together needs no look at its slots.
    likely = saved(
        met.select(*ROW, "item_id", "n_windows", F.explode("origin").alias("origin"))
        .groupBy(*ROW, "item_id", "n_windows")
        .agg(F.countDistinct("origin").alias("found"))
        .where(F.col("found") >= F.col("n_windows") * coverage)
        .select(*ROW, "item_id"),
        "leaks",
    )
    # A semi join: of an inner one Spark may broadcast `met`, whose files are a hundredth of its rows.
    aligned = saved(
        met.join(small_table(likely), [*ROW, "item_id"], "left_semi")
        .groupBy(*ROW, "item_id", "n_windows", "kind", (F.col("at") - F.col("place")).alias("shift"))
        .agg(
            F.array_sort(F.collect_set("place")).alias("places"),
            F.array_distinct(F.flatten(F.collect_set("origin"))).alias("origins"),
            F.max("length").alias("length"),
        ),
        "leaks",
    )
    asked = saved(aligned.select(*ROW).distinct(), "leaks")
    found = usable.join(small_table(asked), ROW, "left_semi").dropDuplicates(ROW)
    texts = _union(
        found.select(
            *ROW,
            F.lit(kind).alias("kind"),
            VALUES[kind](F.col("text")).alias("doc_words"),
            _origins(F.col("text"), kind).alias("doc_at"),
        )
        for kind in kinds
    )
    item_texts = _union(
        benchmark.where(F.col(item_text_col).isNotNull()).select(
            F.col(item_col).alias("item_id"),
            F.lit(kind).alias("kind"),
            VALUES[kind](F.col(item_text_col)).alias("item_words"),
            FORMS[kind](F.col(item_text_col)).alias("item_template"),
        )
        for kind in kinds
    )
    item_texts = item_texts.hint("broadcast" if items.count() <= BROADCAST_WINDOWS else "merge")
    # Places of the item that lie in a matched window and hold a placeholder.
    inside = F.array_distinct(
        F.flatten(
            F.transform("places", lambda p: F.sequence(p, p + F.col("length") - 1))
        )
    )
    slots = F.transform(
        F.filter(
            inside, lambda p: F.get(F.col("item_template"), p - 1).isin(NUMBER, NAME, UNIT)
        ),
        lambda p: F.struct(
            _value(F.get(F.col("item_words"), p - 1)).alias("said"),
            _value(F.get(F.col("doc_words"), p - 1 + F.col("shift"))).alias("says"),
        ),
    )
    compared = (
        aligned.join(item_texts, ["item_id", "kind"])
        .join(texts, [*ROW, "kind"])
        .withColumn("slots", slots)
        .select(
            *ROW,
            "item_id",
            "n_windows",
            "kind",
            "origins",
            F.get("doc_at", F.array_min("places") + F.col("shift") - 1).alias("first_word"),
            F.size("slots").alias("n_slots"),
            # Different values of the document for one value of the item.
            (
                F.size(F.array_distinct("slots"))
                - F.size(F.array_distinct(F.transform("slots", lambda s: s["said"])))
            ).alias("n_conflicts"),
            F.size(F.filter("slots", lambda s: ~s["said"].eqNullSafe(s["says"]))).alias("n_changed"),
        )
        .where(F.col("n_conflicts") <= F.col("n_slots") * conflicts)
    )

    def by_typed(of, name: str) -> Column:
        """Of the typed alignments, if there are any."""
        return F.coalesce(of(F.when(F.col("kind") == TYPED, F.col(name))), of(name)).alias(name)

    return (
        compared.withColumn("origin", F.explode("origins"))
        .groupBy(*ROW, "item_id", "n_windows")
        .agg(
            (F.countDistinct("origin") / F.first("n_windows")).alias("coverage"),
            F.min("first_word").alias("first_word"),
            by_typed(F.max, "n_slots"),
            by_typed(F.min, "n_conflicts"),
            by_typed(F.min, "n_changed"),
        )
        .where(F.col("coverage") >= coverage)
        .drop("n_windows")
    )


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def _value(word: Column) -> Column:
    """A word as slots compare it: lower case, without signs at its rim."""
    return F.regexp_replace(F.lower(word), _RIM, "")


def drop_leaks(
    docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` that hold no leak, with all their columns; rows without id or text
    stay, and so do texts that share an id with one that goes."""
    gone = leaks.select(F.col("doc_id").alias("_leaked"), F.col("text_hash").alias("_hash")).distinct()
    gone = small_table(saved(gone, "leaks"))
    same = (docs[id_col] == gone["_leaked"]) & (text_hash(docs[text_col]) == gone["_hash"])
    return docs.join(gone, same, "left_anti")
