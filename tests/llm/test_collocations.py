"""Count transducers and collocations against dictionaries."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lendscope.llm import collocations, queries
from lendscope.llm.transducer import Transducer, build, unite

SF = "/root/testdata/sf0.001"
word = st.sampled_from([b"a", b"b", b"ab", "é".encode(), b"\x01", b"zz"])
counts = st.dictionaries(st.lists(word, min_size=1, max_size=4).map(tuple), st.integers(1, 3), max_size=25)


@settings(max_examples=150, deadline=None)
@given(counts, counts)
def test_automata_hold_and_add_up_counts(left, right):
    one, two = (build(sorted(c.items())) for c in (left, right))
    assert list(one.items()) == sorted(left.items())
    assert list(Transducer.from_bytes(one.to_bytes()).items()) == sorted(left.items())
    both = unite([one, two, one])
    assert dict(both.items()) == dict(Counter(left) + Counter(right) + Counter(left))
    assert list(both.items()) == sorted(both.items())
    assert dict(one.compose(two)) == {phrase: left.get(phrase, 0) for phrase in right}


def test_equal_ends_are_stored_once():
    ends = [((bytes([97 + i]), b"x", b"y"), 1) for i in range(20)]
    assert len(build(ends).finals) == 4
    with pytest.raises(ValueError, match="after"):
        build([((b"b",), 1), ((b"a",), 1)])


PIECES, WORDS = re.compile(r"[.,;:!?\x0a-\x0d]"), re.compile(r"[^\x20\x09]+")


def grams(rows, longest=5):
    """Occurrences of all phrases by language."""
    found = defaultdict(Counter)
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in PIECES.split(low):
            words = WORDS.findall(piece)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    found[lang or "und" if lang is None else lang][tuple(words[i : i + k])] += 1
    return found


def brute(rows, least, first=2000, longest=5):
    want = []
    for lang, f in grams(rows, longest).items():
        n = sum(c for phrase, c in f.items() if len(phrase) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        absorbed = Counter()
        for longer, c in candidates.items():
            for k in range(2, len(longer)):
                for i in range(len(longer) - k + 1):
                    absorbed[longer[i : i + k]] = max(absorbed[longer[i : i + k]], c)
        kept = []
        for p, a in candidates.items():
            if 100 * absorbed[p] >= 100 * a:
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:first], 1):
            want.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(want)


def found(df):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.select(names).collect()))


ROWS = [
    ("New York is big. new york, NEW YORK! New\tYork  city", "en"),
    ("a a a a a a a a", "en"),
    ("the cat sat on the mat; the cat sat on the hat", "en"),
    ("the cat sat on the mat\rthe cat sat on the mat\x0bthe cat", "en"),
    ("the cat sat on the mat; the cat sat on the hat", "en"),
    ("É été\x00 été\x1cx é. İ new york new york", None),
    ("new york new york", "und"),
    ("new york new york", ""),
    (None, "en"),
    ("", "de"),
    (" . ,, ", "de"),
    ("one two three four five six " * 4000, "fr"),
    ("x" * 300_000 + " y", "fr"),
]


def test_collocations_of_a_few_texts(spark):
    # Columns whose names the operator uses itself.
    docs = spark.createDataFrame(
        [(i, *row, 1, "p") for i, row in enumerate(ROWS)], "doc_id long, text string, lang string, n long, phrase string"
    )
    for least, first in [(2, 2000), (3, 4)]:
        got = collocations.best(collocations.collocations(docs, least=least), first)
        assert found(got) == brute(ROWS, least, first)


def test_an_empty_table_has_no_collocations(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert collocations.best(collocations.collocations(docs)).collect() == []


def _batch(rows):
    return pa.RecordBatch.from_pydict(
        {"lang": [lang for _, lang in rows], "text": pa.array([t or "" for t, _ in rows], pa.string())}
    )


def test_shards_count_every_phrase_once(monkeypatch):
    """However small shards and slices are."""
    monkeypatch.setattr(collocations, "SHARD_WORDS", 7)
    monkeypatch.setattr(collocations, "SLICE_BYTES", 9)
    rows = [(t[:400] if t else t, lang or "und") for t, lang in ROWS]
    all_bits = np.full(collocations.LEAST_BITS // 8, 255, np.uint8)
    got, pairs = defaultdict(Counter), 0
    for lang, shard in collocations.shards(iter([_batch(rows[:5]), _batch(rows[5:])]), 4):
        items = collocations.phrase_counts(shard, lang, all_bits, all_bits, 5)
        assert items == sorted(items)
        for phrase, n in items:
            got[lang][tuple(w.decode() for w in phrase)] += n
    for lang, shard in collocations.shards(iter([_batch(rows)]), 1):
        pairs += int(collocations.pair_hash_counts(shard, lang, all_bits)[1].sum())
    assert pairs == sum(n for f in grams(rows).values() for p, n in f.items() if len(p) == 2)
    words = defaultdict(Counter)
    for lang, shard in collocations.shards(iter([_batch(rows)]), 0):
        for w, n in zip(*collocations.word_counts(shard), strict=True):
            words[lang][(w.decode(),)] += int(n)
    for lang, f in grams(rows).items():
        assert got[lang] == {p: n for p, n in f.items() if len(p) > 1}
        assert words[lang] == {p: n for p, n in f.items() if len(p) == 1}


def test_the_bitmap_marks_every_key(spark):
    keys = spark.createDataFrame([("en", f"w{i} é") for i in range(500)], "lang string, word string")
    bitmap = collocations.bitmap_of(keys.select(collocations.word_hash().alias("hash")))
    here = collocations._hashes("en", [f"w{i} é".encode() for i in range(500)])
    assert collocations._marked(bitmap, here).all()
    others = collocations._hashes("en", [f"other{i}".encode() for i in range(500)])
    assert collocations._marked(bitmap, others).mean() < 0.05
    # The order of a pair counts.
    assert (collocations._pair_hashes(here, others) != collocations._pair_hashes(others, here)).all()


def test_ranges_cut_a_word_that_is_more_than_one(spark):
    words = [("en", "the", 500), *[("en", f"w{i:02}", 10) for i in range(50)]]
    bounds = collocations.range_bounds(
        spark.createDataFrame(words, "lang string, word string, n long"), {"en": 1000}, 10
    )
    # The cuts at 100 to 400 lie in the mass of "the", at 200 to 800 of the words behind it.
    assert bounds["en"][:3] == [(b"the", b"the"), (b"the", b"w10"), (b"the", b"w30")]
    assert [first for first, _ in bounds["en"][3:]] == [b"w00", b"w10", b"w20", b"w30", b"w40"]
    assert collocations.bucket_of(bounds["en"], (b"the",)) == 0
    assert collocations.bucket_of(bounds["en"], (b"the", b"w10", b"x")) == 2


def test_the_query_covers_all_documents(spark):
    docs = queries.table(spark, SF, "documents")
    rows = [(r.text, r.lang) for r in docs.collect()]
    want = brute(rows, 100)
    assert want and found(queries.QUERIES["op12_collocations"](spark, SF)) == want


def test_phrases_of_rare_triples_are_not_counted_by_their_words():
    # All pairs are frequent, of the triples only those of the first text.
    texts = ["a b c d"] * 3 + ["b c a b", "c d a b", "d a b d", "a b d a"]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    ((lang, shard),) = collocations.shards(iter([batch]), 4)
    all_bits = np.full(1 << 10, 255, np.uint8)
    hashes, counts = collocations.triple_hash_counts(shard, lang, all_bits, all_bits)
    want = Counter(t[i : i + 3] for t in (tuple(x.split()) for x in texts) for i in range(len(t) - 2))
    assert sorted(counts.tolist()) == sorted(want.values())
    marked = np.zeros(1 << 10, np.uint8)
    for at in (hashes[counts >= 3] & np.uint64(8 * len(marked) - 1)).tolist():
        marked[at >> 3] |= 1 << (at & 7)
    got = dict(collocations.phrase_counts(shard, lang, all_bits, all_bits, 5, marked))
    long = {tuple(p.decode() for p in phrase): n for phrase, n in got.items() if len(phrase) > 2}
    assert long.items() >= {("a", "b", "c"): 3, ("b", "c", "d"): 3, ("a", "b", "c", "d"): 3}.items()
    assert long.keys() <= {("a", "b", "c"), ("b", "c", "d"), ("a", "b", "c", "d"), ("b", "c", "a"), ("d", "a", "b")} | {
        t for t, n in want.items() if n >= 3
    }
    # The pairs are counted whatever triples they lie in.
    assert got[b"a", b"b"] == 7 and got[b"d", b"a"] == 3
