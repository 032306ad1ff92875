"""Decontamination, licences and the quality classifier."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.llm import common, decontaminate, licenses, quality, queries

SF = "/root/testdata/sf0.001"

QUESTION = (
    "Yesterday morning Anna bought 12 apples at the market and gave 5 of them to her friend "
    "while the other 12 stayed for 3 days in a basket of 40 cm by the kitchen door."
)
CHANGED = (
    "Yesterday morning Anna bought 31 apples at the market and gave 7 of them to her friend "
    "while the other 31 stayed for 9 weeks in a basket of 80 mm by the kitchen door."
)
MIXED = (
    "Yesterday morning Anna bought 31 apples at the market and gave 7 of them to her friend "
    "while the other 99 stayed for 9 weeks in a basket of 80 mm by the kitchen door."
)
PROSE = "Some quiet words about rivers, boats and the long way home through the hills. "


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [
        (1, QUESTION), (2, "Four words are enough"), (3, "too short here"), (4, None), (None, "no id at all in this"),
        (5, "1 2 3 4 5 6 7 8 9 10 11 12"), (1, QUESTION),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def _found(docs, benchmark, **options):
    return {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(docs, benchmark, **options).collect()}


def test_leaks_are_found_and_clean_rows_left_alone(spark, benchmark):
    rows = [
        (10, PROSE + QUESTION + " " + PROSE), (11, PROSE + CHANGED), (12, MIXED + " " + PROSE),
        (13, PROSE * 30), (14, None), (15, ""), (16, "1 2 3 4 5 6 7 8 9 10 11 12 13"),
        (17, "well, four words are enough, or so it seems"), (None, QUESTION),
        (18, QUESTION[: len(QUESTION) // 4]), (19, (PROSE * 800) + QUESTION.upper()), (10, "repeated id"),
        (20, QUESTION.replace(" ", "\n  ")), (21, "too short here"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(3))
    got = _found(docs, benchmark, conflicts=0.1)
    assert set(got) == {(10, 1), (11, 1), (17, 2), (19, 1), (20, 1), (21, 3)}
    assert got[10, 1].n_changed == 0 and got[10, 1].n_conflicts == 0
    # 12, 5, 12, 3, days, 40 and cm have other values, each always the same.
    assert got[11, 1].n_changed == 7 and got[11, 1].n_conflicts == 0
    assert got[10, 1].first_word == len(PROSE.split()) + 1
    # With more patience for conflicts the mixed one is found, too.
    assert (12, 1) in _found(docs, benchmark, conflicts=0.2)
    kept = decontaminate.drop_leaks(docs, decontaminate.find_leaks(docs, benchmark)).collect()
    # Of the two texts of document 10 the clean one stays.
    assert {r.doc_id for r in kept} == {10, 13, 14, 15, 16, 18, None}
    assert [r.text for r in kept if r.doc_id == 10] == ["repeated id"]
    assert kept[0].item_id == 3


NAMES = "Anna Berta, Clara Dora; Emil Fritz - Gustav Hans: Ida Jakob."
SUM = "Compute 12 5 3 7 2 99 14"


def test_leaks_in_other_case_and_without_signs_are_found(spark):
    """Names are told by case and full stops, which a copy need not have. Also items that are
    nearly all names or numbers are found."""
    german = "Gestern kaufte Frau Weiß im Süden. Die Straße war leer, und der Hund lief 3 km weit. Dann kam Regen."
    bare = "".join(c for c in QUESTION + " " + german if c.isalnum() or c == " ")
    rows = [
        (30, PROSE + QUESTION.title()), (31, german.title()), (32, german.upper() + PROSE),
        (33, PROSE + bare), (34, CHANGED.title()), (35, "see " + NAMES + " and so on"),
        (36, NAMES.lower()), (37, PROSE + SUM), (38, SUM.replace("12", "13")), (39, PROSE.title() * 5),
        (40, "Otto Paul, Quirin Rosa; Sven Theo - Udo Viktor: Willi Xaver."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, QUESTION), (2, german), (3, NAMES), (4, SUM)], "item_id long, text string")
    got = _found(docs, items)
    assert set(got) == {(30, 1), (31, 2), (32, 2), (33, 1), (33, 2), (34, 1), (35, 3), (36, 3), (37, 4)}
    assert got[30, 1].n_changed == 0 and got[30, 1].first_word == len(PROSE.split()) + 1
    assert got[34, 1].n_changed == 7


def test_short_items_are_found_word_for_word(spark):
    items = spark.createDataFrame([(1, "Who painted Guernica?"), (2, "Why?"), (3, "Is 7 prime")], "item_id long, text string")
    rows = [
        (1, PROSE + "who painted Guernica, he asked"), (2, "Who painted the Guernica?"), (3, "But why not"),
        (4, "Whyever"), (5, "is 7 prime?"), (6, "is 9 prime?"), (7, PROSE),
    ]
    got = _found(spark.createDataFrame(rows, "doc_id long, text string"), items)
    assert set(got) == {(1, 1), (3, 2), (5, 3)}


def test_texts_of_one_id_have_conflicts_of_their_own(spark, benchmark):
    """A document whose slots conflict stays let go when another text shares its id."""
    alone = spark.createDataFrame([(1, MIXED)], "doc_id long, text string")
    both = spark.createDataFrame([(1, MIXED), (1, "x"), (1, PROSE)], "doc_id long, text string")
    assert _found(alone, benchmark, conflicts=0.1) == _found(both, benchmark, conflicts=0.1) == {}
    leak = spark.createDataFrame([(1, MIXED), (1, CHANGED), (1, CHANGED)], "doc_id long, text string")
    assert len(decontaminate.find_leaks(leak, benchmark, conflicts=0.1).collect()) == 1


def test_windows_are_runs_of_words(spark):
    rows = spark.createDataFrame([(1, list(range(12))), (2, [5, 6, 7]), (3, [])], "id long, h array<long>")
    for n in range(1, 9):
        found = {r.id: r.w for r in decontaminate._with_windows(rows, n).collect()}
        assert {i: len(w) for i, w in found.items()} == {1: 13 - n, 2: max(0, 4 - n), 3: 0}
        assert len(set(found[1])) == 13 - n
        assert n > 3 or found[2][0] == found[1][5]


def test_leaks_of_empty_tables(spark, benchmark):
    docs = spark.createDataFrame([(1, QUESTION)], "doc_id long, text string")
    assert not _found(docs.limit(0), benchmark)
    assert not _found(docs, benchmark.limit(0))


def test_both_ways_to_join_agree(spark, benchmark, monkeypatch):
    docs = spark.createDataFrame([(10, PROSE + QUESTION), (11, CHANGED), (13, PROSE)], "doc_id long, text string")
    few = set(_found(docs, benchmark))
    monkeypatch.setattr(decontaminate, "small_table", lambda df: df)
    assert set(_found(docs, benchmark)) == few == {(10, 1), (11, 1)}


def test_leak_query_against_plain_windows(spark):
    """Every document that holds half of an item's runs of eight words, case and signs aside."""
    frame = queries.op2_template_leaks(spark, SF)
    assert "Python" not in frame._jdf.queryExecution().toString()
    strip = lambda w: w.strip(".,;:!?\"'()").lower()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    runs = lambda t: {tuple(w[i : i + 8]) for w in [[strip(x) for x in t.split()]] for i in range(len(w) - 7)}
    held = {r.doc_id: runs(r.text) for r in docs}
    want = {
        (d, r.item_id)
        for r in items
        for d, own in held.items()
        if (mine := runs(r.text)) and len(mine & own) >= 0.6 * len(mine)
    }
    got = {(r.doc_id, r.item_id) for r in frame.collect()}
    assert want <= got and want
    contained = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    assert contained <= got
    for doc_id, item_id in got - want:
        item = next(i for i in items if i.item_id == item_id)
        assert len(runs(item.text) & held[doc_id]) >= 0.3 * len(runs(item.text))


def test_windows_that_met_are_not_broadcast(spark, benchmark, monkeypatch):
    plans, saved = {}, decontaminate.saved

    def recorded(df, purpose):
        df.collect()  # adaptive execution has the last word
        plans[tuple(df.columns)] = df._jdf.queryExecution().executedPlan().toString()
        return saved(df, purpose)

    monkeypatch.setattr(decontaminate, "saved", recorded)
    docs = spark.createDataFrame([(k, QUESTION + PROSE * 3) for k in range(500)], "doc_id long, text string")
    assert {d for d, _ in _found(docs, benchmark)} == set(range(500))
    (aligned,) = (plan for columns, plan in plans.items() if "places" in columns)
    # Windows are on the left; the pairs that are likely, on the right, are counted before.
    assert "Join" in aligned and "BuildLeft" not in aligned
    assert "BuildLeft" not in plans[tuple(decontaminate.ROW)]


def test_rows_not_file_sizes_decide_on_broadcasts(spark):
    keys = common.saved(spark.range(2_000), "keys")
    left = spark.range(3_000)
    for rows, join in ((2_000, "BroadcastHashJoin"), (1_999, "SortMergeJoin")):
        joined = left.join(common.small_table(keys, rows), "id", "left_semi")
        assert join in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 2_000


MIT, APACHE = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."


def test_licences_are_inherited_from_the_nearest_directory(spark):
    rows = [
        (1, "a/LICENSE", MIT), (2, "a/b/c.txt", "some prose"), (3, "a/b/d/COPYING", APACHE),
        (4, "a/b/d/e/f.txt", "prose"), (5, "z/f.txt", "prose\n" + APACHE + "\n" + "prose " * 50),
        (6, "z/g.txt", "prose"), (7, "ab/h.txt", "prose"), (8, None, None), (9, "/a//b/i.txt", ""),
        (10, "a/b/d/j.txt", "my driving licence was lost\nand copyright is a long word"),
        (2, "a/b/c.txt", "some prose"), (None, "a/k.txt", "x"), (11, "q/short.txt", "hi\n" + MIT), (12, "q/r/s.txt", "y"),
    ]
    docs = spark.createDataFrame(rows, "id long, path string, body string").withColumn("license", F.lit("no"))
    frame = licenses.scan(docs, "id", "body", F.col("path"))
    got = sorted(((r.doc_id or 0, r.license, r.origin, r.from_path) for r in frame.collect()), key=str)
    assert got == sorted([
        (1, "MIT", "own", "a/LICENSE"), (2, "MIT", "inherited", "a/LICENSE"), (2, "MIT", "inherited", "a/LICENSE"),
        (3, "Apache-2.0", "own", "a/b/d/COPYING"), (4, "Apache-2.0", "inherited", "a/b/d/COPYING"),
        (5, "Apache-2.0", "own", "z/f.txt"), (6, None, "none", None), (7, None, "none", None), (8, None, "none", None),
        (9, "MIT", "inherited", "a/LICENSE"), (10, "Apache-2.0", "inherited", "a/b/d/COPYING"),
        (0, "MIT", "inherited", "a/LICENSE"), (11, "MIT", "own", "q/short.txt"), (12, "MIT", "inherited", "q/short.txt"),
    ], key=str)
    assert len(got) == len(rows)
    assert licenses.scan(docs.limit(0), "id", "body", F.col("path")).count() == 0


def test_notice_cosines_against_plain_python(spark):
    import regex

    counts = {MIT: 5, APACHE: 2, "the licence to drive": 1, "This work is licensed under CC BY-SA 4.0": 3,
              "Copyright 2020 by Anna. All rights reserved": 1, "licensed under the GPL, version 3": 1}
    notices = spark.createDataFrame(list(counts.items()), "notice string, n_docs long")
    got = {r.notice: (r.license, r.cosine) for r in licenses.match_notices(notices).collect()}

    def terms(text):
        words = (w.strip(".+-") for w in regex.split(r"[^\p{L}\p{N}.+-]+", text.lower()))
        return Counter(w for w in words if w)

    df = Counter()
    for text, n in [*counts.items(), *((t, 1) for _, t in licenses.TEMPLATES)]:
        for w in terms(text):
            df[w] += n
    total = sum(counts.values()) + len(licenses.TEMPLATES)

    def vector(text):
        v = {w: tf * (math.log((1 + total) / (1 + df[w])) + 1) for w, tf in terms(text).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    want = {}
    for text in counts:
        own = vector(text)
        scored = [
            (-round(sum(x * own.get(w, 0) for w, x in vector(t).items()), 9), k)
            for k, (_, t) in enumerate(licenses.TEMPLATES)
        ]
        cosine, k = min(scored)
        if -cosine >= licenses.COSINE:
            want[text] = (licenses.TEMPLATES[k][0], -cosine)
    assert got.keys() == want.keys()
    assert all(got[t][0] == want[t][0] and abs(got[t][1] - want[t][1]) < 1e-6 for t in want)
    assert "the licence to drive" not in got


def test_licence_query_is_native_and_whole(spark):
    frame = queries.op6_licenses(spark, SF)
    assert "Python" not in frame._jdf.queryExecution().toString()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in frame.collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        said = {name for name, t in licenses.TEMPLATES if t in text.split("\n")}
        if said:
            assert got[doc_id].origin == "own" and got[doc_id].license in said
        elif not any(sign in text.lower() for sign in licenses.SIGNS):
            assert got[doc_id].origin != "own"


def test_licence_query_inherits_nothing_from_documents_of_one_source(spark, tmp_path):
    rows = [(1, MIT, "en", "web"), (2, "some prose", "en", "web"), (3, "more prose", "en", "web")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.license, r.origin) for r in queries.op6_licenses(spark, str(tmp_path)).collect()}
    assert got == {1: ("MIT", "own"), 2: (None, "none"), 3: (None, "none")}


def test_licence_query_inherits_from_a_source_that_is_a_licence_file(spark, tmp_path):
    rows = [
        (1, MIT, "en", "lib/LICENSE"), (2, "some prose", "en", "lib"), (3, "prose", None, "lib/src/a.py"),
        (4, "prose\n" + APACHE, "en", "lib/src"), (5, "prose", "en", "other"), (6, "prose", "de", None),
        (7, APACHE, "en", "lib/src/COPYING.txt"), (8, "prose", "fr", "license"), (2, "some prose", "en", "lib"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.license, r.origin, r.from_path) for r in queries.op6_licenses(spark, str(tmp_path)).collect())
    mit, apache = ("MIT", "inherited", "lib/LICENSE"), ("Apache-2.0", "inherited", "lib/src/COPYING.txt")
    assert got == [
        (1, "MIT", "own", "lib/LICENSE"), (2, *mit), (2, *mit), (3, *apache),
        (4, "Apache-2.0", "own", "lib/src/en/4.txt"), (5, None, "none", None), (6, None, "none", None),
        (7, "Apache-2.0", "own", "lib/src/COPYING.txt"), (8, None, "none", None),
    ]


def test_page_query_inherits_from_the_nearest_directory_of_the_url(spark, tmp_path):
    shown = "<html><style>p{}</style><body><p>some words of prose</p><p>%s</p></body></html>"
    rows = [
        (1, "https://a.example.org/lib/LICENSE?x=1", MIT),
        (2, "http://a.example.org/lib/src/page#top", shown % "more prose"),
        (3, "https://a.example.org/lib/src/own", shown % APACHE),
        (4, "https://a.example.org/other", shown % "more prose"),
        (5, "https://b.example.org/lib/src/page", shown % "more prose"),
        (6, None, None),
    ]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    frame = queries.op6_page_licenses(spark, str(tmp_path))
    assert "Python" not in frame._jdf.queryExecution().toString()
    got = {r.doc_id: (r.license, r.origin, r.from_path) for r in frame.collect()}
    assert got[1][:2] == ("MIT", "own")
    assert got[2] == ("MIT", "inherited", "a.example.org/lib/LICENSE")
    assert got[3][:2] == ("Apache-2.0", "own")
    assert got[4] == got[5] == got[6] == (None, "none", None)


def _made_up(rng, n):
    words = ["river", "boat", "hill", "quiet", "long", "way", "home", "stone", "garden", "evening"]
    good, bad = [], []
    for _ in range(n):
        text = " ".join(rng.choice(words, int(rng.integers(20, 200)))).capitalize() + "."
        good.append(text)
        bad.append(
            [text.upper().replace(" ", "!! "), text.replace(" ", " | "), " ".join(w + "$$$" for w in text.split())][
                int(rng.integers(3))
            ]
        )
    return good, bad


def test_classifier_learns_from_positives_and_unlabelled_text():
    rng = np.random.default_rng(0)
    good, bad = _made_up(rng, 600)
    stats = lambda texts: np.array([quality.statistics(t) for t in texts])
    mixed = stats(good[300:500] + bad[:100])
    model = quality.fit_scorer(stats(good[:300]), mixed, prior=2 / 3)
    assert (model.score(stats(good[500:])) >= 0.5).mean() > 0.97
    assert (model.score(stats(bad[300:])) < 0.5).mean() > 0.97
    again = quality.fit_scorer(stats(good[:300]), mixed, prior=2 / 3)
    assert (again.weights == model.weights).all()
    alone = quality.fit_scorer(np.zeros((0, len(quality.STATISTICS))), mixed, prior=0.7)
    assert np.allclose(alone.score(mixed), 0.7)


@pytest.fixture(scope="module")
def labelled(spark):
    good, bad = _made_up(np.random.default_rng(4), 150)
    texts = [t for pair in zip(good, bad, strict=True) for t in pair]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    return docs.withColumn("score", F.lit("x")), labels


def test_held_out_labels_have_no_say(spark, labelled):
    docs, labels = labelled
    model = quality.fit(docs, labels)
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = quality.fit(docs, turned)
    assert (model.weights == other.weights).all() and model.bias == other.bias
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    out = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(scores[i] >= 0.5) == (i % 2 == 0) for i in out]) > 0.95


def test_classifier_on_odd_rows(spark, labelled):
    docs, labels = labelled
    model = quality.fit(docs, labels)
    odd = spark.createDataFrame(
        [(None, "x"), (1, None), (2, ""), (2, ""), (3, "a " * 60_000), (4, "\x00\n\n")], "doc_id long, text string"
    )
    scores = quality.score(odd.withColumn("role", F.lit(1)), model).collect()
    assert len(scores) == 6 and all(0 <= r.score <= 1 for r in scores)
    kept = quality.keep_good(odd.withColumn("stats", F.lit(7)), model)
    assert kept.columns == ["doc_id", "text", "stats"]
    assert kept.count() == sum(r.score >= 0.5 for r in scores)
    assert quality.score(odd.limit(0), model).count() == 0
    # Nothing to learn from: the prior stands in, and nobody is rejected.
    blank = quality.fit(docs, labels.limit(0))
    assert quality.keep_good(docs, blank).count() == docs.count()
    more = labels.unionAll(spark.createDataFrame([(None, 1, 0), (0, None, 0), (2, 0, 0)], labels.schema))
    assert quality.fit(docs, more).prior > 0


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op7_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
