"""Components, the n-gram join and lattice hashing against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.llm import lattice, ngram_join, queries
from lendscope.llm.components import components

SF = "/root/testdata/sf0.001"


def _classes(nodes, links):
    """Smallest member of the class of each node."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("kind", ["random", "chain", "hub", "none"])
def test_components(spark, kind):
    rng = np.random.default_rng(3)
    links = {
        "random": [tuple(x) for x in rng.integers(0, 60, (45, 2)).tolist()],
        "chain": [(i, i + 1) for i in rng.permutation(40).tolist()],
        "hub": [(99, i) for i in range(40)] + [(99, 0), (0, 99)],
        "none": [(1, 1), (None, 2)],
    }[kind]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    real = [x for x in links if None not in x and x[0] != x[1]]
    assert {r.node: r.component for r in got} == _classes({n for x in real for n in x}, real)


def test_few_links_need_few_tasks_whatever_the_number_of_partitions(spark, monkeypatch):
    from lendscope.llm import components as module

    held = {"spark.sql.shuffle.partitions": "90", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in held}
    tasks, write = [], module.saved
    monkeypatch.setattr(module, "saved", lambda df, name: (tasks.append(df.rdd.getNumPartitions()), write(df, name))[1])
    links = [(i, i + 1) for i in range(0, 300, 2)] + [(i, i + 2) for i in range(0, 40)]
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        found = module.components(spark.createDataFrame(links, "a long, b long"), len(links))
        tasks.append(found.rdd.getNumPartitions())
        got = {r.node: r.component for r in found.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == _classes({n for x in links for n in x}, links)
    assert max(tasks) <= spark.sparkContext.defaultParallelism


def _shingles(text, words):
    parts = text.encode().lower().split()
    if len(parts) < words:
        return {tuple(parts)} if parts else set()
    return {tuple(parts[i : i + words]) for i in range(len(parts) - words + 1)}


def _brute(rows, words, percent):
    sets = [(doc_id, _shingles(text or "", words)) for doc_id, text in rows]
    links = []
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            common = len(s & t)
            if s and t and 100 * common >= percent * len(s | t):
                links.append((a, b))
    group = _classes({a for a, _ in sets}, links)
    return {a: (len(s), group[a]) for a, s in sets}


def _texts(rng):
    """Near copies of several degrees, chains of copies of copies, a passage that many texts
    share, a large group of copies, and short texts."""
    vocabulary = [f"w{i}" for i in range(400)]
    words = lambda n: rng.choice(vocabulary, n).tolist()
    passage, texts = words(40), []

    def changed(text, times):
        text = list(text)
        for _ in range(times):
            text[rng.integers(len(text))] = "new" + str(rng.integers(10**6))
        return text

    for size in (6, 9, 14, 25, 60, 200):
        for _ in range(6):
            base = words(size)
            texts += [base, changed(base, 1), changed(base, max(1, size // 60)), base + words(size // 9 + 1)]
            link = base
            for _ in range(4):
                link = changed(link, 1)
                texts.append(link)
    texts += [words(12) + passage + words(12) for _ in range(60)]
    texts += [passage + words(int(k)) for k in rng.integers(1, 9, 40)]
    big = words(80)
    texts += [changed(big, 1) for _ in range(150)] + [big] * 50
    texts += [words(int(n)) for n in rng.integers(1, 6, 60)]
    texts = [" ".join(t) for t in texts] + ["", "   \n", None, "one", "ONE", "one two three", "One  two\tTHREE"]
    return [(i, texts[k]) for i, k in enumerate(rng.permutation(len(texts)))]


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80)])
@pytest.mark.parametrize("boundary", [None, 0, 10**6])
def test_ngram_join_finds_the_classes_of_all_links(spark, monkeypatch, words, percent, boundary):
    """The boundary is a matter of cost only: all lists, all subsets or both."""
    if boundary is not None:
        if percent == 80:
            pytest.skip("one setting is enough for the forced boundaries")
        monkeypatch.setattr(ngram_join, "_boundary", lambda *_: boundary)
    rows = _texts(np.random.default_rng(words))
    if boundary:
        rows = [r for r in rows if len((r[1] or "").split()) < 90]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ngram_join.near_copies(docs.withColumn("n", F.lit("x")), words, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _brute(rows, words, percent)
    assert len(got) == len(rows)


def test_ngram_join_of_odd_rows(spark):
    schema = "doc_id long, text string"
    assert ngram_join.near_copies(spark.createDataFrame([], schema)).count() == 0
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (7, None), (8, long), (9, long + " end")]
    got = ngram_join.near_copies(spark.createDataFrame(rows, schema)).collect()
    assert sorted(((r.doc_id or -1), r.component_id) for r in got) == [
        (-1, None), (5, 5), (5, 5), (7, 7), (8, 8), (9, 8)
    ]


def test_ngram_join_of_different_texts_under_one_id(spark):
    """Each row links by its own text, whichever of the texts of its id is met first."""
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for k in range(40):
        base = [f"w{x}" for x in rng.integers(0, 10**6, 60)]
        other = " ".join(f"v{x}" for x in rng.integers(0, 10**6, 40))
        texts = [" ".join(base), other] if k % 2 else [other, " ".join(base)]
        rows += [(2 * k, t) for t in texts] + [(2 * k + 1, " ".join([*base, "end"]))]
        want[2 * k + 1] = 2 * k
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.near_copies(docs).collect()
    assert {r.doc_id: r.component_id for r in got if r.doc_id % 2} == want


def test_every_set_has_the_order_by_which_lists_are_cut(spark):
    """Behind the counted part shingles follow by unsigned hash, also those from 2^63 on."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, int(n))) for n in rng.integers(9, 24, 60)]
    rows = [(2 * i + k, t + " end" * k) for i, t in enumerate(texts) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (40, 85):
        limit = int(0.1 * 2**64)
        signed = ngram_join._signature(docs, "doc_id", "text", 4, percent, limit).cache()
        low = 2**63 - 1  # the bits that tell shingles apart, signed or not
        ranks = {int(h) & low: int(h) for _, t in rows for h in next(ngram_join.shingle_sets([t], 4))}
        seen = 0
        for r in ngram_join._shared(signed, limit).collect():
            hashes = [ranks[s["shingle"] & low] for s in r.shared if s["part"] == 1]
            assert hashes == sorted(hashes) and all(h >= limit for h in hashes)
            assert all(ranks[s["shingle"] & low] < limit for s in r.shared if s["part"] == 0)
            seen += any(h < 2**63 for h in hashes) and any(h >= 2**63 for h in hashes)
        assert seen or percent == 85


def test_parity_bits_never_differ_in_more_places_than_sets_in_shingles():
    rng = np.random.default_rng(11)
    for size in (1, 7, 60, 700, 9_000):
        for changed in (0, 1, size // 9, size):
            one = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
            two = np.unique(np.append(one[changed:], rng.integers(0, 2**63, changed).astype(np.uint64)))
            bits = [np.unpackbits(ngram_join.parity_bits(s).view(np.uint8)) for s in (one, two)]
            assert len(bits[0]) == ngram_join.BITS
            assert (bits[0] != bits[1]).sum() <= len(np.setxor1d(one, two))
            if not changed:
                assert (bits[0] == bits[1]).all()


@pytest.mark.parametrize("pivots", [0, 4])
def test_a_group_whose_pairs_are_about_at_the_threshold(spark, monkeypatch, pivots):
    """Some pairs are links and some are not; further pivots leave fewer to compare, and the
    classes are the same with and without them."""
    monkeypatch.setattr(ngram_join, "PIVOTS", pivots)
    monkeypatch.setattr(ngram_join, "PAIRS_PER_ROW", 0)
    met = []
    apart = ngram_join._apart_pairs
    monkeypatch.setattr(ngram_join, "_apart_pairs", lambda *a: met.append(apart(*a)) or met[-1])
    rng, base, rows = np.random.default_rng(4), [f"w{i}" for i in range(110)], []
    for i in range(160):
        text = list(base)
        for place in rng.choice(len(text), int(rng.integers(1, 4)), replace=False):
            text[place] = f"new{i}-{place}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.near_copies(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _brute(rows, 4, 85)
    assert met[0].count() < 160 * 159 / 8


def test_keys_know_how_many_shingles_stand_before_them(spark):
    nodes = spark.createDataFrame(
        [(1, 20, 1, [(0, 2, 10), (0, 2, 11), (1, 0, 50)], 0.5)],
        "node long, n int, rare int, shared array<struct<part int, df int, shingle long>>, usual double",
    )
    got = ngram_join._keys(nodes, 85, 21).collect()
    assert sorted((r.key, r.place) for r in got if r.kind == 1) == [(10, 1), (11, 2), (50, 3)]
    assert sorted(r.place for r in got if r.kind == 2) == [1, 2, 2]


def test_boundary_is_the_cheapest():
    costs = [(5, 1.0, 9.0), (6, 2.0, 8.0), (7, 9.0, 3.0), (8, 20.0, 4.0)]
    assert ngram_join.choose_boundary(costs) == 7
    assert ngram_join.choose_boundary([(5, 1.0, 9.0)]) == 6
    assert ngram_join.choose_boundary([(5, 9.0, 1.0)]) == 5


def test_decoding_gives_the_nearest_lattice_point():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 3, (400, 8))
    own = lattice.decode(x)
    doubled = np.rint(2 * own).astype(int)
    assert (np.abs(2 * own - doubled) < 1e-9).all()
    parity = doubled % 2
    assert ((parity == parity[:, :1]).all(axis=1)).all()  # all whole or all half
    assert (np.rint(own.sum(axis=1)) % 2 == 0).all()
    distance = ((x - own) ** 2).sum(axis=1)
    assert distance.max() <= 1 + 1e-9  # the covering radius
    other = own[:, None] + lattice.NEIGHBOURS
    assert (distance <= ((x[:, None] - other) ** 2).sum(axis=2).min(axis=1) + 1e-9).all()
    assert len(np.unique(lattice.NEIGHBOURS, axis=0)) == 240


def _vectors(rng, dims):
    rows, labels = [], []
    for k in range(40):
        base = rng.normal(size=dims)
        for _ in range(int(rng.integers(1, 8))):
            rows.append(base + rng.normal(size=dims) * rng.choice([0.0, 0.02, 0.1, 0.2, 0.25]))
            labels.append(int(k % 3))
    dense = rng.normal(size=dims)
    rows += [dense + rng.normal(size=dims) * 0.05 for _ in range(700)] + [dense] * 300
    labels += [1] * 1000
    return np.array(rows), labels


def test_lattice_hashing_against_brute_force(spark):
    """A dense group of more than two blocks, exact copies, and pairs near the threshold."""
    x, labels = _vectors(np.random.default_rng(2), 64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.98) & (np.array(labels)[:, None] == np.array(labels)[None])
    np.fill_diagonal(linked, False)
    group = _classes(range(len(x)), zip(*np.nonzero(linked), strict=True))
    rows = [(i, v.tolist(), lab) for i, (v, lab) in enumerate(zip(x, labels, strict=True))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in lattice.near_duplicates(df.withColumn("cell", F.lit(1))).collect()}
    found = sum(r.n_links for r in got.values())
    assert all(got[i].n_links <= linked[i].sum() for i in got)
    assert found >= 0.999 * linked.sum()
    assert {i: r.component_id for i, r in got.items()} == group
    assert all(r.kept == (i == group[i]) for i, r in got.items())


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], 1), (2, [2.0, 4.0], 1), (3, [1.0, 2.0], None), (4, None, 1), (5, [0.0, 0.0], 1),
        (6, [1.0, None], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [], 1), (10, [1.0, 2.0, 0.0], 1),
        (None, [1.0, 2.0], 1), (11, [1.0, 2.0], 2), (2, [2.0, 4.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = lattice.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {(r.vec_id, r.n_links, r.component_id) for r in got if r.n_links} == {(1, 2, 1), (2, 2, 1)}
    assert all(r.component_id == r.vec_id for r in got if not r.n_links)
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_different_vectors_under_one_id(spark):
    rows = [(1, [1.0, 0.0, 0.0], 1), (1, [0.0, 1.0, 0.0], 1), (2, [1.0, 0.01, 0.0], 1), (3, [0.01, 1.0, 0.0], 1),
            (4, [0.0, 0.0, 1.0], 1), (5, [0.0, 1.0, 0.0], 2), (5, [0.0, 1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(df).collect())
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (4, 0, 4, True),
                   (5, 0, 5, True), (5, 2, 1, False)]


def test_registered_queries_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op3_jaccard_join(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _brute(rows, 4, 85)
