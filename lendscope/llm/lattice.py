"""Near-duplicate embeddings by lattice hashing.

Unit vectors are projected twice to eight dimensions for each table, scaled, and decoded to
the nearest points of the E8 lattice; the two lattice points together are the cell. A vector
also probes the neighbouring cells: those in which one of its two lattice points is replaced
by one of the lattice points next to it that lie nearest to the vector. Two vectors of one
label are candidates if they meet in a cell of some table. Candidates are compared by cosine
in double precision. Two projections keep chance meetings rare in large tables.

Vectors that are equal in every component and label are one point with a multiplicity, so
exact copies cost nothing. A cell with many points is split into blocks of bounded size; each
pair of blocks is compared as one small matrix product, which hands on counts of links and a
spanning forest of them, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import saved, small_batches
from lendscope.llm.components import components

#: Tables, lattice points of a vector in each of the two projections of a table, distance of
#: two vectors at the cosine looked for against the lattice's unit, and points of one block.
TABLES, POINTS, SIDE, BLOCK = 4, 5, 0.5, 256
SEED = 20_240_229

def _shortest_vectors() -> np.ndarray:
    """The 240 lattice points next to the origin: (+-1, +-1, 0...) in all places, and
    (+-1/2)^8 with an even number of minus signs."""
    found = []
    for i in range(8):
        for j in range(i):
            for a in (-1.0, 1.0):
                for b in (-1.0, 1.0):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    found.append(v)
    for bits in range(256):
        signs = np.array([1.0 if bits >> k & 1 else -1.0 for k in range(8)])
        if signs.prod() > 0:
            found.append(signs / 2)
    return np.array(found)


NEIGHBOURS = _shortest_vectors()


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer point with an even sum: round, and if the sum is odd, round the
    coordinate that lies furthest from its integer the other way."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    step = np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    near[odd, worst] += step
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice point of each row: the nearer of an even-sum integer point and one
    shifted by a half in all places."""
    whole = _nearest_even(x)
    half = _nearest_even(x - 0.5) + 0.5
    nearer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(nearer[:, None], half, whole)


def projections(dims: int, tables: int, seed: int = SEED) -> np.ndarray:
    """For each table two sets of eight orthogonal directions; fewer dimensions are padded."""
    rng = np.random.default_rng(seed)
    size = max(dims, 8)
    made = [np.linalg.qr(rng.standard_normal((size, 8)))[0][:dims] for _ in range(2 * tables)]
    return np.stack(made).reshape(tables, 2, dims, 8)


def _mixed(parts: np.ndarray, seed: int) -> np.ndarray:
    """One 64-bit hash of the last axis."""
    hashed = np.full(parts.shape[:-1], np.uint64(seed))
    for k in range(parts.shape[-1]):
        hashed ^= parts[..., k]
        hashed *= np.uint64(0xFF51AFD7ED558CCD)
        hashed ^= hashed >> np.uint64(33)
    return hashed


def _points(x: np.ndarray, points: int) -> np.ndarray:
    """Hashes of the nearest lattice points of each row, the nearest of all first."""
    own = decode(x)
    toward = (x - own) @ NEIGHBOURS.T
    order = np.argsort(-toward, axis=1, kind="stable")[:, : points - 1]
    near = np.concatenate([own[:, None], own[:, None] + NEIGHBOURS[order]], axis=1)
    return _mixed(np.rint(2 * near).astype(np.int64).astype(np.uint64), 17)


def cells_of(unit: np.ndarray, scale: float, directions: np.ndarray, points: int = POINTS) -> np.ndarray:
    """Hashes of all cells of each unit vector: its own, then the probed ones, by table."""
    found = []
    for table, (first, second) in enumerate(directions):
        a, b = _points(unit @ first * scale, points), _points(unit @ second * scale, points)
        own_a, own_b = (np.repeat(x[:, :1], points - 1, axis=1) for x in (a, b))
        pairs = [(a[:, :1], b[:, :1]), (a[:, 1:], own_b), (own_a, b[:, 1:])]
        stacked = np.concatenate([np.stack(p, axis=-1) for p in pairs], axis=1)
        found.append(_mixed(stacked, (table + 1) * 1_000_003 + unit.shape[1]))
    return np.concatenate(found, axis=1).view(np.int64)


def scale_for(dims: int, cosine: float, side: float = SIDE) -> float:
    """Scale at which two vectors at the cosine looked for are about `side` apart after the
    projection (the lattice's shortest vectors are sqrt(2) long)."""
    apart = np.sqrt(2 * (1 - cosine)) * np.sqrt(min(8, dims) / dims)
    return side / max(apart, 1e-6)


def _unit_rows(vectors: list, dims: int) -> np.ndarray:
    flat = np.array(vectors, dtype=np.float64).reshape(len(vectors), dims)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _cells(points: DataFrame, cosine: float, tables: int) -> DataFrame:
    """label, point, cell: every cell of every point."""

    def decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, tuple] = {}
        for batch in batches:
            lengths = np.array(batch.column(2).value_lengths())
            vectors = batch.column(2).to_pylist()
            for dims in np.unique(lengths).tolist():
                if dims not in made:
                    made[dims] = scale_for(dims, cosine), projections(dims, tables)
                rows = np.flatnonzero(lengths == dims)
                cells = cells_of(_unit_rows([vectors[i] for i in rows], dims), *made[dims])
                # A cell may come up twice for one vector; once is enough.
                which, cell = np.nonzero(np.ones(cells.shape, bool))
                pairs = np.unique(np.stack([rows[which], cells[which, cell]]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(pairs[0])),
                        batch.column(1).take(pa.array(pairs[0])),
                        pa.array(pairs[1]),
                    ],
                    names=["label", "point", "cell"],
                )

    schema = f"label {points.schema['label'].dataType.simpleString()}, point long, cell long"
    return points.select("label", "point", "vector").mapInArrow(decode_batches, schema)


def _compare(cell: int, first: int, second: int, members: list[dict], cosine: float):
    """Links of one pair of blocks: for each linked point its root in the block pair, and the
    number of vectors it is linked to here and in no smaller cell that it shares with them."""
    dims = len(members[0]["vector"])
    members = [m for m in members if len(m["vector"]) == dims]
    if len(members) < 2:
        return [], [], []
    point = np.array([m["point"] for m in members])
    block = np.array([m["block"] for m in members])
    unit = _unit_rows([m["vector"] for m in members], dims)
    linked = unit @ unit.T >= cosine
    if first != second:
        linked &= block[:, None] != block[None]
    np.fill_diagonal(linked, False)
    if not linked.any():
        return [], [], []
    # Members that share a smaller cell are counted there.
    at = [(i, c) for i, m in enumerate(members) for c in m["cells"] if c < cell]
    counted = linked
    if at:
        rows, cells = zip(*at, strict=True)
        _, column = np.unique(np.array(cells), return_inverse=True)
        smaller = np.zeros((len(members), column.max() + 1), np.float32)
        smaller[list(rows), column] = 1
        counted = linked & (smaller @ smaller.T == 0)
    n = counted @ np.array([m["copies"] for m in members])
    root = point.copy()
    while True:  # the smallest point of each tree spreads along the links
        lower = np.minimum(root, np.where(linked, root[None], np.iinfo(np.int64).max).min(axis=1))
        if (lower == root).all():
            break
        root = lower
    has = linked.any(axis=1)
    return point[has].tolist(), root[has].tolist(), n[has].tolist()


def near_duplicates(
    vectors: DataFrame,
    cosine: float = 0.98,
    tables: int = TABLES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    Rows are linked when their labels are equal and not null and their cosine is at least
    `cosine`. A row without id or label, or whose vector is null, empty, zero or holds a null
    or non-finite component, is linked with nothing (a row without id has no component).
    Vectors of different length are never linked. Repeated rows count as vectors of their own.
    An empty table gives an empty result; other columns are ignored.
    """
    small_batches(vectors.sparkSession)
    vector = F.col(vector_col)
    usable = (
        F.col(id_col).isNotNull()
        & F.col(label_col).isNotNull()
        & F.coalesce(
            F.forall(
                vector,
                lambda x: x.isNotNull()
                & ~F.isnan(x.cast("double"))
                & (F.abs(x.cast("double")) < float("inf")),
            )
            & F.exists(vector, lambda x: x != 0),
            F.lit(False),
        )
    )
    given = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).alias("label"),
        vector.alias("vector"),
        usable.alias("usable"),
        F.xxhash64(label_col, vector_col).alias("h1"),
        F.xxhash64(F.lit(1), vector_col, label_col).alias("h2"),
    )
    narrow = given.select("vec_id", "usable", "h1", "h2")
    groups = saved(
        narrow.where("usable")
        .groupBy("h1", "h2")
        # Rows that share a vec_id may hold different vectors, so a point has an id of its own.
        .agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .select("h1", "h2", F.xxhash64("h1", "h2").alias("point"), "first", "copies"),
        "points",
    )
    points = saved(
        given.where("usable")
        .join(groups.withColumnRenamed("first", "vec_id"), ["vec_id", "h1", "h2"])
        .dropDuplicates(["h1", "h2"])
        .select("label", "point", "copies", "vector"),
        "points",
    )
    cells = saved(_cells(points, cosine, tables), "cells")
    crowded = saved(
        cells.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "cells"
    )
    # At most as many cells for each point as it was decoded to.
    own = (
        cells.join(crowded, ["label", "cell"])
        .groupBy("point")
        .agg(F.collect_list(F.struct("cell", "n")).alias("crowd"))
    )
    blocks = F.ceil(F.col("c.n") / BLOCK).cast("int")
    rows = (
        own.join(points, "point")
        .select("*", F.explode("crowd").alias("c"))
        .withColumn("block", F.pmod(F.xxhash64("point"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "label",
            F.col("c.cell").alias("cell"),
            F.least("block", "other").alias("first"),
            F.greatest("block", "other").alias("second"),
            F.struct(
                "point", "copies", "block", "vector", F.col("crowd.cell").alias("cells")
            ).alias("member"),
        )
    )
    # Two blocks of about BLOCK points at most, however many points the cell has.
    pairs = (
        rows.groupBy("label", "cell", "first", "second")
        .agg(F.collect_list("member").alias("members"))
        .where(F.size("members") > 1)
        .select("cell", "first", "second", "members")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                cell, first, second, members = (c[k].as_py() for c in batch.columns)
                found = _compare(cell, first, second, members, cosine)
                if found[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()) for x in found], names=["point", "root", "n"]
                    )

    found = saved(pairs.mapInArrow(compare, "point long, root long, n long"), "links")
    counts = found.groupBy("point").agg(F.sum("n").alias("n"))
    joined = components(found.select(F.col("point").alias("a"), F.col("root").alias("b")))
    named = saved(
        groups.select("point", "first").join(joined.withColumnRenamed("node", "point"), "point"),
        "links",
    )
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    results = saved(
        counts.join(
            named.join(least, "component").select("point", F.col("least").alias("component")),
            "point",
            "full",
        ),
        "links",
    )
    placed = narrow.join(groups, ["h1", "h2"], "left").select(
        "vec_id",
        F.when(F.col("usable"), F.col("point")).alias("point"),
        F.when(F.col("usable"), F.col("first")).alias("first"),
        F.when(F.col("usable"), F.col("copies")).alias("copies"),
    )
    component = F.coalesce("component", "first", "vec_id")
    return placed.join(results, "point", "left").select(
        "vec_id",
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("n", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
