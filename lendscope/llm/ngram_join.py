"""Set similarity join on word shingles: heavy and light sets by size.

Two documents are linked when the Jaccard similarity of their shingle sets reaches a
threshold. Sets share one global order of shingles, rare ones first, so two linked sets have
at least k shingles in common among the first n - ceil(t * n) + k of each.

* Small sets enumerate the 2-subsets of that prefix (k = 2): a subset in common is one key.
* Large sets have too many subsets; they scan the inverted lists of the single shingles of
  their prefix (k = 1). Small sets of nearly large size stand in those lists, too.

The boundary between the two minimises the cost measured on all sets: rows of subset keys
against rows of lists. A list is first read against one member only (see below), so beyond its
own row a set pays for the length of a list by its logarithm. Sets are nodes; exact copies are one node, so they cost nothing more.

Links are what connects: inside a key, every set is first compared with one of them only (the
pivot, the one with the commonest shingles). Sets that are connected after that need no
comparison among each other. While many pairs of a key are still apart, they are compared with
further members of its largest group: where about half of all pairs are linked, each halves
what is left. Sets that are apart after that are compared exactly, after
a count of common prefix shingles has let go of pairs that cannot reach the threshold. So no link that joins different groups is
lost, and a group of near copies never becomes all its pairs.

Whole sets travel for pairs that may be linked only. Every set has 512 parity bits, each the
parity of the number of its shingles that fall on it. Two sets differ in at least as many
shingles as bits, so the bits refuse a pair without losing a link; they are compared inside the
join of sets that are apart, and before the sets of any pair are made.

The order counts how many sets hold a shingle, for the part of the shingles whose hash falls
into the lowest share of the hash range (a little wider than a prefix); the others follow by
hash. Every set sees the same order, so this choice cannot lose links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import TASK_SETS, gathered, saved, small_batches, small_table, spread, text_hash
from lendscope.llm.components import components
from lendscope.llm.word_ids import slices

#: Words of a shingle and similarity in per cent.
WORDS, PERCENT = 4, 85
#: Width of the counted part of the hash range against the share a prefix has of its set.
WIDER = 1.7
#: Sizes among which the boundary is sought.
SIZES = 512
#: Parity bits of a set, a multiple of 64.
BITS = 512
#: Pairs of sets apart, for each row of their keys, beyond which one more pivot is tried first;
#: the share of compared pairs that must be links for another pivot to follow; and pivots at most.
#: They choose how links are found, not which.
PAIRS_PER_ROW, LINKED, PIVOTS = 8, 0.1, 4
#: Rows and bytes of a batch of texts: the sets made of it take several times as much.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 * 1024 * 1024


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], words: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles as ascending 64-bit hashes.

    Words are runs of anything but ASCII white space, A-Z in lower case. A text with fewer
    words is one shingle; one without words has none.
    """
    from xxhash import xxh3_64_intdigest

    for text in texts:
        parts = text.encode("utf-8", "surrogatepass").lower().split()
        hashes = np.fromiter(map(xxh3_64_intdigest, parts), np.uint64, len(parts))
        runs = max(1, len(parts) - words + 1) if len(parts) else 0
        if len(parts) < words:
            words_here = len(parts)
        else:
            words_here = words
        mixed = np.full(runs, np.uint64(words_here))
        for k in range(words_here):
            mixed = _mix(mixed + hashes[k : k + runs])
        yield np.unique(mixed)


def _name(shingles: np.ndarray) -> int:
    """64-bit hash of a whole set."""
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """BITS bits as longs: whether an odd number of shingles falls on each."""
    places = (shingles & np.uint64(BITS - 1)).astype(np.intp)
    return np.packbits((np.bincount(places, minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


def least_overlap(n, percent: int):
    """ceil(t * n), for integers and columns alike."""
    return (n * percent + 99) // 100


def _signature(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, limit: int) -> DataFrame:
    """doc_id, text_hash, n, node, counted, shingles (those in the counted part, or as many as a
    prefix needs), bits (where there are shingles) of every row. A node is a 64-bit hash of a whole
    set; an empty set has none."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            for start, texts in slices(batch.column(1).to_pylist()):
                n, node, counted, lists, bits = [], [], [], [], []
                for shingles in shingle_sets(texts, words):
                    size = len(shingles)
                    name = _name(shingles) if size else None
                    low = int(np.searchsorted(shingles, np.uint64(limit)))
                    n.append(size)
                    node.append(name)
                    counted.append(low)
                    alone = size * 100 // percent == size and least_overlap(size, percent) == size
                    if name in seen or alone:  # said before, or like no other set
                        lists.append([])
                        bits.append(None)
                    else:
                        needed = size - least_overlap(size, percent) + 2
                        # Signed numbers in the order of the unsigned hashes, by which lists are cut.
                        lists.append((shingles[: max(low, needed)] ^ np.uint64(1 << 63)).view(np.int64))
                        bits.append(parity_bits(shingles))
                        seen.add(name)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)),
                        batch.column(2).slice(start, len(texts)),
                        pa.array(n, pa.int32()),
                        pa.array(node, pa.int64()),
                        pa.array(counted, pa.int32()),
                        pa.array(lists, pa.list_(pa.int64())),
                        pa.array(bits, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_hash", "n", "node", "counted", "shingles", "bits"],
                )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("words"),
        text_hash(F.col(text_col)).alias("text_hash"),
    )
    return spread(rows).mapInArrow(
        sign,
        "doc_id long, text_hash long, n int, node long, counted int, shingles array<long>, bits array<long>",
    )


def _whole_sets(docs: DataFrame, id_col: str, text_col: str, words: int, owners: DataFrame) -> DataFrame:
    """node, shingles for every owner (doc_id, node): a document that stands for its node.

    Of rows that share the owner's id only those that hold the node's set count.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(0).to_pylist()
            for start, texts in slices(batch.column(1).to_pylist()):
                made = zip(wanted[start : start + len(texts)], shingle_sets(texts, words), strict=True)
                held = [(node, s.view(np.int64)) for node, s in made if len(s) and _name(s) == node]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([node for node, _ in held], pa.int64()),
                        pa.array([s for _, s in held], pa.list_(pa.int64())),
                    ],
                    names=["node", "shingles"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("words"))
    return (
        rows.join(small_table(owners), "doc_id")
        .select("node", F.col("words").cast("string").alias("words"))
        .mapInArrow(sets, "node long, shingles array<long>")
    )


def _prefix(size: Column, percent: int, k: int) -> Column:
    """Length of the k-prefix of a set."""
    return size - F.floor((size * percent + 99) / 100).cast("int") + k


def _shared(signed: DataFrame, limit: int) -> DataFrame:
    """node, n, bits, rare, shared, usual: per node the shingles it has in common with other nodes, in
    the global order, the number of counted shingles that stand before them (held by it alone),
    and how common its counted shingles are on average (logarithm)."""
    # One row for each set and shingle; a shingle holds at most one row of each set.
    same = Window.partitionBy("shingle")
    common = (
        signed.select("node", F.explode("shingles").alias("shingle"))
        .select(
            "node",
            "shingle",
            F.min("node").over(same).alias("least"),
            F.max("node").over(same).alias("most"),
            F.count(F.lit(1)).over(same).alias("df"),
        )
        .where("least <> most")
    )
    counted = F.col("shingle") < limit - (1 << 63)
    ordered = (
        common.groupBy("node")
        .agg(
            F.array_sort(
                F.collect_set(
                    F.struct(
                        F.when(counted, 0).otherwise(1).alias("part"),
                        F.when(counted, F.col("df")).otherwise(0).alias("df"),
                        "shingle",
                    )
                )
            ).alias("shared")
        )
    )
    sizes = signed.where(F.size("shingles") > 0).select("node", "n", "counted", "bits").distinct()
    mine = F.filter("shared", lambda s: s["part"] == 0)
    rare = F.col("counted") - F.size(mine)
    usual = F.aggregate(mine, F.lit(0.0), lambda a, s: a + F.log2(s["df"] + 1))
    return ordered.join(sizes, "node").select(
        "node",
        "n",
        "bits",
        rare.alias("rare"),
        "shared",
        # Nodes are hashes, so their share of the range breaks ties the same way everywhere.
        (
            (usual + rare) / F.greatest(F.col("counted"), F.lit(1))
            + F.pmod("node", F.lit(1_000_003)) * 1e-12
        ).alias("usual"),
    )


def _taken(percent: int, k: int) -> Column:
    """The shared shingles of the k-prefix."""
    room = F.greatest(_prefix(F.col("n"), percent, k) - F.col("rare"), F.lit(0))
    return F.slice("shared", F.lit(1), room)


def choose_boundary(costs: list[tuple[int, float, float]]) -> int:
    """First size that scans lists, from (size, cost of subsets, cost of lists) by size."""
    sizes, subsets, lists = (np.array(x, float) for x in zip(*sorted(costs), strict=True))
    total = np.concatenate([[0], np.cumsum(subsets)]) + np.concatenate(
        [np.cumsum(lists[::-1])[::-1], [0]]
    )
    best = int(np.argmin(total))
    return int(sizes[best]) if best < len(sizes) else int(sizes[-1]) + 1


def _boundary(nodes: DataFrame, percent: int) -> int:
    pairs = F.size(_taken(percent, 2))
    measured = (
        nodes.groupBy(F.least("n", F.lit(SIZES)).alias("size"))
        .agg(
            F.sum((pairs * (pairs - 1) / 2).cast("double")).alias("subsets"),
            F.sum(
                F.aggregate(
                    _taken(percent, 1), F.lit(0.0), lambda a, s: a + F.log2(s["df"] + 1)
                )
            ).alias("lists"),
        )
        .collect()  # at most SIZES rows
    )
    costs = [(r["size"], r["subsets"], r["lists"]) for r in measured]
    return choose_boundary(costs) if costs else 0


def _keys(nodes: DataFrame, percent: int, boundary: int) -> DataFrame:
    """kind (1 list, 2 subset), key, node, n, usual, place: how many shingles of the set stand
    before the (last) one of the key, without the other one of a subset."""
    lists = nodes.where(F.col("n") * 100 >= boundary * percent).select(
        F.lit(1).alias("kind"),
        F.posexplode(_taken(percent, 1)["shingle"]).alias("at", "key"),
        "node",
        "n",
        "usual",
        "rare",
    )
    lists = lists.select("kind", "key", "node", "n", "usual", (F.col("rare") + F.col("at")).alias("place"))
    two = _taken(percent, 2)
    subsets = nodes.where(F.col("n") < boundary).select(
        F.explode(
            F.flatten(
                F.transform(
                    two,
                    lambda a, i: F.transform(
                        F.slice(two, i + 2, F.greatest(F.size(two) - i - 1, F.lit(0))),
                        lambda b, j: F.struct(
                            F.xxhash64(a["shingle"], b["shingle"]).alias("key"), (i + j).alias("at")
                        ),
                    ),
                )
            )
        ).alias("subset"),
        "node",
        "n",
        "usual",
        "rare",
    )
    subsets = subsets.select(
        F.lit(2).alias("kind"),
        "subset.key",
        "node",
        "n",
        "usual",
        (F.col("rare") + F.col("subset.at")).alias("place"),
    )
    return lists.unionAll(subsets)


def _near_in_size(percent: int) -> Column:
    return F.least("n", "m") * 100 >= F.greatest("n", "m") * percent


def _alike(percent: int) -> Column:
    """Whether sets with n and m shingles may be linked, by their parity bits.

    They differ in d shingles at least, so at most (n + m - d) / 2 are in common, and a link
    needs (n + m) * t / (1 + t) of them.
    """
    differ = sum(
        F.bit_count(F.get("bits", F.lit(i)).bitwiseXOR(F.get("their_bits", F.lit(i))))
        for i in range(BITS // 64)
    )
    return differ * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent)


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that parity bits do not refuse."""
    theirs = nodes.select(F.col("node").alias("other"), F.col("bits").alias("their_bits"))
    return (
        pairs.join(nodes.select("node", "bits"), "node")
        .join(theirs, "other")
        .where(_alike(percent))
        .select("node", "other", "n", "m")
    )


def _star_pairs(keys: DataFrame, rows: int, percent: int) -> DataFrame:
    """Every node of a key with the key's pivot: node, other, n, m.

    The pivot is the node with the commonest shingles: of many copies of one text that were
    changed here and there, it is the text itself or the copy next to it.
    """
    pivots = (
        keys.groupBy("kind", "key")
        .agg(
            F.max_by("node", "usual").alias("other"),
            F.max_by("n", "usual").alias("m"),
            F.min("node").alias("least"),
            F.max("node").alias("most"),
        )
        .where("least <> most")
        .drop("least", "most")
    )
    pivots = saved(gathered(pivots, rows), "pivots")
    return (
        keys.join(pivots, ["kind", "key"])
        .where((F.col("node") != F.col("other")) & _near_in_size(percent))
        .select("node", "other", "n", "m")
        .distinct()
    )


def _mixed(keys: DataFrame, count: int, labels: DataFrame) -> tuple[DataFrame, int, int]:
    """kind, key, node, n, place, label, major (the label of most rows) of the keys whose sets are not
    all connected, their number, and the number of pairs with different labels in them. `count` is
    the number of rows of `keys`."""
    named = (
        keys.select("kind", "key", "node", "n", "place")
        .join(labels.withColumnRenamed("component", "label"), "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    per_label = named.groupBy("kind", "key", "label").agg(F.count(F.lit(1)).alias("rows"))
    mixed = (
        per_label.groupBy("kind", "key")
        .agg(
            F.max_by("label", "rows").alias("major"),
            F.count(F.lit(1)).alias("labels"),
            ((F.pow(F.sum("rows"), F.lit(2)) - F.sum(F.pow("rows", F.lit(2)))) / 2).alias("pairs"),
        )
        .where("labels > 1")
    )
    mixed = saved(gathered(mixed, count), "apart")
    rows = named.join(mixed.select("kind", "key", "major"), ["kind", "key"])
    rows = saved(gathered(rows, count), "apart")
    return rows, rows.count(), mixed.agg(F.sum("pairs")).first()[0] or 0


def _pivot_pairs(rows: DataFrame, count: int, turn: int, percent: int) -> DataFrame:
    """Every node of a key that is not connected with its largest group, with one member of that
    group: node, other, n, m. Another member each turn, the same one in all keys if it can be."""
    order = F.xxhash64("node", F.lit(turn))
    pivots = (
        rows.where("label = major")
        .groupBy("kind", "key")
        .agg(F.max_by("node", order).alias("other"), F.max_by("n", order).alias("m"))
    )
    pivots = saved(gathered(pivots, count), "pivots")
    return (
        rows.where("label <> major")
        .join(pivots, ["kind", "key"])
        .where(_near_in_size(percent))
        .select("node", "other", "n", "m")
        .distinct()
    )


def _apart_pairs(mixed: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of one key that are not connected, and have enough of their prefixes in common.

    A pair comes out of the join if it can reach the threshold, were the key its first common one:
    nothing that stands before is in common then, and sets differ in at least as many shingles
    as parity bits. Rows are narrow there. Prefixes are fetched for the pairs that come out: what
    is not in one of the two is at most all in common.
    """
    rows = saved(mixed.join(nodes.select("node", "bits"), "node"), "apart")
    # The largest group of a key is compared with the others, never with itself.
    minor = rows.where("label <> major").select(
        "kind", "key", "node", "n", "bits", "place", F.col("label").alias("own")
    )
    every = rows.select(
        F.col("kind").alias("same_kind"),
        F.col("key").alias("same_key"),
        F.col("node").alias("other"),
        F.col("n").alias("m"),
        F.col("bits").alias("their_bits"),
        F.col("label").alias("others"),
        "major",
        F.col("place").alias("their_place"),
    )
    least = lambda c: F.floor((c * percent + 99) / 100)
    wanted = F.ceil((F.col("n") + F.col("m")) * percent / (100 + percent))
    met = minor.join(
        every,
        (F.col("kind") == F.col("same_kind"))
        & (F.col("key") == F.col("same_key"))
        & (F.col("own") != F.col("others"))
        & ((F.col("others") == F.col("major")) | (F.col("node") < F.col("other")))
        & _near_in_size(percent)
        & (F.col("place") + wanted <= F.col("n"))
        & (F.col("their_place") + wanted <= F.col("m"))
        & _alike(percent),
    )
    pairs = met.select(
        F.least("node", "other").alias("node"),
        F.greatest("node", "other").alias("other"),
        F.when(F.col("node") < F.col("other"), F.col("n")).otherwise(F.col("m")).alias("n"),
        F.when(F.col("node") < F.col("other"), F.col("m")).otherwise(F.col("n")).alias("m"),
    )
    pairs = saved(pairs.distinct(), "apart")
    prefixes = nodes.select("node", _taken(percent, 2)["shingle"].alias("prefix"))
    common = F.size(F.array_intersect("mine", "prefix"))
    beyond = F.greatest(least(F.col("n")), least(F.col("m"))) - 2
    return (
        pairs.join(prefixes.withColumnRenamed("prefix", "mine"), "node")
        .join(prefixes.withColumnRenamed("node", "other"), "other")
        .where(common + beyond >= wanted)
        .select("node", "other", "n", "m")
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs that reach the threshold, by their whole sets."""
    left = pairs.join(sets.withColumnRenamed("shingles", "s"), "node")
    both = left.join(
        sets.select(F.col("node").alias("other"), F.col("shingles").alias("t")), "other"
    )
    shared = F.size(F.array_intersect("s", "t"))
    return both.where(shared * 100 >= (F.col("n") + F.col("m") - shared) * percent).select(
        F.col("node").alias("a"), F.col("other").alias("b")
    )


def groups(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, text_hash, n, group and first of every row: its group (a number of its own; null
    for an empty set) and the smallest doc_id in it. See `near_copies`."""
    spark = docs.sparkSession
    small_batches(spark, BATCH_ROWS, BATCH_BYTES)
    limit = int(min(0.49, WIDER * (1 - percent / 100)) * 2**64)
    signed = saved(_signature(docs, id_col, text_col, words, percent, limit), "shingles")
    nodes = saved(gathered(_shared(signed, limit), signed.count(), TASK_SETS), "shingles")
    keys = saved(_keys(nodes, percent, _boundary(nodes, percent)), "keys")
    # For each node a document that holds its set.
    holders = signed.where(F.col("doc_id").isNotNull() & F.col("node").isNotNull())
    holders = holders.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    holders = saved(gathered(holders, signed.count()), "holders")

    def compare(pairs: DataFrame) -> tuple[DataFrame, int, int]:
        """Links among pairs, their number, and the number of pairs; the whole sets are made again,
        for the nodes in question only."""
        pairs = saved(pairs, "pairs")
        count = pairs.count()
        asked = pairs.select("node").unionAll(pairs.select(F.col("other").alias("node"))).distinct()
        owners = saved(gathered(holders.join(asked, "node"), 2 * count), "pairs")
        sets = _whole_sets(docs, id_col, text_col, words, owners).dropDuplicates(["node"])
        sets = saved(gathered(sets, 2 * count, TASK_SETS), "sets")
        links = saved(gathered(_verified(pairs, sets, percent), count, TASK_SETS), "links")
        return links, links.count(), count

    total = keys.count()
    star = gathered(_possible(_star_pairs(keys, total, percent), nodes, percent), total)
    links, linked, _ = compare(star)
    labels = saved(components(links, linked), "components")
    apart, rows_apart, pairs = _mixed(keys, total, labels)
    for turn in range(PIVOTS):
        if pairs <= PAIRS_PER_ROW * rows_apart:
            break
        met = _possible(_pivot_pairs(apart, rows_apart, turn, percent), nodes, percent)
        more, found, asked = compare(gathered(met, rows_apart))
        if found:
            links, linked = links.unionAll(more), linked + found
            labels = saved(components(links, linked), "components")
            apart, rows_apart, pairs = _mixed(apart, rows_apart, labels)
        if found <= LINKED * asked:
            break
    far, found, _ = compare(_apart_pairs(apart, nodes, percent))
    if found:
        labels = saved(components(links.unionAll(far), linked + found), "components")
    rows = signed.select("doc_id", "text_hash", "n", "node")
    named = rows.join(labels, "node", "left").select(
        "doc_id", "text_hash", "n", F.coalesce("component", "node").alias("group")
    )
    named = saved(named, "components")
    first = saved(
        named.where("group is not null and doc_id is not null")
        .groupBy("group")
        .agg(F.min("doc_id").alias("first")),
        "components",
    )
    return named.join(first, "group", "left")


def near_copies(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    component_id is the smallest doc_id reachable by links. A row without words is empty and
    linked with nothing (its component is itself); so is a row with a null id, whose component
    is null. Equal sets are linked. Rows that share an id are taken as they are: each links by
    its own text. An empty table gives an empty result; other columns are ignored.
    """
    return groups(docs, words, percent, id_col, text_col).select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(
            F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id")
        ).alias("component_id"),
    )


def copies(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, text_hash of the texts that go if one of each group stays: of those with the
    smallest doc_id of the group, the one with the smallest text_hash.

    Texts that share an id are judged one by one. Rows with a null id, and texts without words,
    are in no list.
    """
    rows = saved(groups(docs, words, percent, id_col, text_col), "components")
    rows = rows.where("group is not null and doc_id is not null")
    stays = rows.where("doc_id = first").groupBy("group").agg(F.min("text_hash").alias("stays"))
    one = saved(stays, "components")
    goes = (F.col("doc_id") != F.col("first")) | (F.col("text_hash") != F.col("stays"))
    return rows.join(one, "group").where(goes).select("doc_id", "text_hash").distinct()
