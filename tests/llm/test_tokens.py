"""Word memo, token files, token counts and packing against plain Python."""

from __future__ import annotations

import itertools
import pathlib
import subprocess
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lendscope.llm import packing, queries, token_counts, token_files
from lendscope.llm.word_ids import WordEncoder, slices

PATH = queries.tokenizer_path()
SF = "/root/testdata/sf0.001"
TEXTS = [
    "Plain words, twice words,",
    None,
    "",
    "tab\tline\nno break\x1c<|endoftext|>x <|startoftext|>",
    "It's can't DON'T word$$$ !!",
    "Plain words, twice words,",
    "long " * 3000,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(10 - i, text, f"x{i}", i) for i, text in enumerate(TEXTS)]
    rows += [(None, "no id", "n", 1), (3, "again", "r", 2), (3, "again", "r", 2)]
    # Columns whose names the operators use themselves.
    return spark.createDataFrame(rows, "doc_id long, text string, part string, length long")


pieces = st.sampled_from(
    ["the", "Haus", "haus,", "été.", "ÉTÉ!!", "İ", "ΣΑΣ", "n't", "'s", "<|endoftext|>", "x²", "3.5",
     "　", "\x85", "é", "≠", "̸", "日本", "a-b", "..", "_", "ß"]
)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(pieces, st.sampled_from([" ", "\n", "", "\t", "  "])))))
def test_words_in_a_row_have_the_ids_of_the_text(library, parts):
    texts = ["".join(a + b for a, b in text) for text in parts]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    small = WordEncoder(PATH, memo_words=5)
    for _ in range(2):  # with an empty and with a full memo
        ids, counts = small.encode(texts)
        got = np.split(ids, np.cumsum(counts)[:-1]) if texts else []
        assert [x.tolist() for x in got] == want
        assert small.counts(texts).tolist() == [len(x) for x in want]


MEMORY = """
import resource
import numpy as np
from lendscope.llm.queries import tokenizer_path
from lendscope.llm.word_ids import WordEncoder, slices

most = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
coder = WordEncoder(tokenizer_path())
assert coder.counts(["a"]) == [1]
before, rng = most(), np.random.default_rng(0)
for _ in range(2):
    letters = rng.integers(97, 123, (560_000, 8), np.uint8)
    letters[:, 7] = 32
    text = letters.tobytes().decode()
    for _, some in slices([text[i : i + 8000] for i in range(0, len(text), 8000)]):
        coder.counts(some)
print(most() - before)
"""


def test_a_worker_that_meets_ever_new_words_stays_small():
    root = pathlib.Path(packing.__file__).parents[2]
    ran = subprocess.run([sys.executable, "-c", MEMORY], cwd=root, capture_output=True, text=True, check=True)
    assert float(ran.stdout) < 260  # MB; two workers share an executor with the JVM


def test_memo_holds_parts_of_words_only():
    forms = [w + s for w in ("word", "Word", "WORD") for s in ("", ",", "!")]
    encoder = WordEncoder(PATH)
    ids, counts = encoder.encode([" ".join(forms)])
    assert ids.tolist() == encoder.tokenizer.encode(" ".join(forms), add_special_tokens=False).ids
    assert counts.tolist() == [len(ids)]
    assert set(encoder.memo) == {"", "word", ",", "!"}


def test_slices_cover_all_texts():
    texts = ["a" * n for n in (3, 0, 9, 1, 1)] + [None]
    runs = list(slices(texts, most=4))
    assert [t for _, run in runs for t in run] == [t or "" for t in texts]
    assert [start for start, _ in runs] == [0, 3]
    assert list(slices([])) == []


def _key(row):
    return (row[0] is not None, row[0] or 0, row[1] is not None, row[1] or "")


def test_token_files_hold_every_document_in_order(spark, docs, library, tmp_path):
    token_files.write(docs, str(tmp_path / "t"), PATH, end_id=2)
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=_key)
    start, want = 0, []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, start, ids))
        start += len(ids)
    read = token_files.read_ids(spark, str(tmp_path / "t")).collect()
    got = sorted(((r.doc_id, r.start, list(r.ids)) for r in read), key=lambda r: r[1])
    assert got == want
    digests = {r.start: (r.n_tokens, r.ids_crc32) for r in token_files.read_digests(spark, str(tmp_path / "t")).collect()}
    for _, at, ids in want:
        assert digests[at] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    # Flat files: two bytes for each id, and nothing else.
    sizes = [f.stat().st_size for f in (tmp_path / "t").glob("*.ids")]
    assert sum(sizes) == 2 * start


def test_token_files_of_an_empty_table(spark, docs, tmp_path):
    token_files.write(docs.limit(0), str(tmp_path / "e"), PATH, end_id=2)
    assert token_files.read_digests(spark, str(tmp_path / "e")).count() == 0


def test_ids_that_do_not_fit_stop_the_job(docs, tmp_path):
    with pytest.raises(Exception, match="needs more than"):
        token_files.write(docs, str(tmp_path / "w"), PATH, end_id=70_000)


def test_context_table_against_sorting(spark, docs, library):
    lengths = [len(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]
    table = token_counts.context_table(token_counts.histogram(docs, PATH)).collect()
    assert sorted(r["length"] for r in table) == sorted(set(lengths))
    for r in table:
        limit = r["length"]
        assert r.n_docs == lengths.count(limit)
        assert r.docs_at_least == sum(n >= limit for n in lengths)
        assert r.tokens_at_least == sum(n for n in lengths if n >= limit)
        assert r.docs_within == sum(n <= limit for n in lengths)
        assert r.tokens_truncated == sum(min(n, limit) for n in lengths)
        assert (r.total_docs, r.total_tokens) == (len(lengths), sum(lengths))


def test_any_limit_and_quantile(spark, docs, library):
    lengths = sorted(
        len(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()
    )
    contexts = token_counts.context_table(token_counts.histogram(docs, PATH))
    for r in token_counts.at_limits(contexts, [0, 1, 5, 10**6]).collect():
        assert r.docs_over == sum(n > r.limit for n in lengths)
        assert r.tokens_truncated == sum(min(n, r.limit) for n in lengths)
    for r in token_counts.quantiles(contexts, [0.1, 0.5, 1.0]).collect():
        assert sum(n <= r["length"] for n in lengths) >= r.share * len(lengths)
        assert sum(n < r["length"] for n in lengths) < r.share * len(lengths)
    empty = token_counts.context_table(token_counts.histogram(docs.limit(0), PATH))
    assert empty.count() == 0


@settings(max_examples=80, deadline=None)
@given(
    st.dictionaries(st.integers(0, 40), st.integers(1, 9), min_size=1, max_size=8),
    st.integers(1, 5),
)
def test_boundaries_have_the_least_padding(hist, buckets):
    length, count = np.array(list(hist)), np.array(list(hist.values()))

    def padded(bounds):
        return sum(c * min(b for b in bounds if b >= n) for n, c in hist.items())

    got = packing.best_boundaries(length, count, buckets)
    assert len(got) <= buckets and got[-1] == max(hist)
    every = itertools.chain.from_iterable(
        itertools.combinations(sorted(hist), k) for k in range(1, buckets + 1)
    )
    assert padded(got) == min(padded(b) for b in every if b[-1] == max(hist))


def _check_packing(rows, lengths, context, budget):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.start, r["length"]))
    for doc_id, total in lengths.items():
        runs = sorted(by_doc[doc_id])
        assert sum(n for _, n in runs) == total
        assert runs[0][0] == 0 and all(a + n == b for (a, n), (b, _) in itertools.pairwise(runs))
    batches = {}
    for r in rows:
        assert 0 <= r["length"] <= min(r.padded_length, context)
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for members in batches.values():
        assert len({r.padded_length for r in members}) == 1
        assert members[0].padded_length * len(members) <= budget
        assert sorted(r.slot for r in members) == list(range(len(members)))
    for bucket in {b for b, _ in batches}:
        mine = sorted(k for b, k in batches if b == bucket)
        full = max(len(m) for (b, _), m in batches.items() if b == bucket)
        assert mine == list(range(len(mine)))
        assert all(len(batches[bucket, k]) == full for k in mine[:-1])


def test_packing_covers_every_token(spark):
    rng = np.random.default_rng(5)
    lengths = {i: int(n) for i, n in enumerate(rng.integers(0, 90, 300))}
    lengths.update({300: 0, 301: 1000, 302: 64, 303: 65})
    measured = spark.createDataFrame(list(lengths.items()), "doc_id long, length long")
    rows = packing.pack(measured, context=64, buckets=4, batch_tokens=256).collect()
    _check_packing(rows, lengths, 64, 256)
    assert packing.pack(measured.limit(0), 64, 4, 256).count() == 0
    with pytest.raises(ValueError):
        packing.pack(measured, context=64, batch_tokens=63)


def test_one_bucket_may_hold_most_rows(spark):
    lengths = {i: 7 for i in range(500)} | {500: 30}
    measured = spark.createDataFrame(list(lengths.items()), "doc_id long, length long")
    rows = packing.pack(measured, context=64, buckets=2, batch_tokens=64).collect()
    _check_packing(rows, lengths, 64, 64)


def test_registered_queries_against_plain_python(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    ids = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in docs}
    start = 0
    written = {r.doc_id: r for r in queries.op8_token_files(spark, SF).collect()}
    assert len(written) == len(docs)
    for r in docs:
        row, own = written[r.doc_id], [*ids[r.doc_id], 2]
        crc = zlib.crc32(np.array(own, "<u4").tobytes())
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(own), crc)
        start += len(own)
    lengths = {k: len(v) for k, v in ids.items()}
    contexts = queries.op9_token_counts(spark, SF).collect()
    assert sum(r.n_docs for r in contexts) == len(docs)
    for r in contexts:
        assert r.tokens_truncated == sum(min(n, r["length"]) for n in lengths.values())
    rows = queries.op1_length_buckets(spark, SF).collect()
    _check_packing(rows, lengths, packing.CONTEXT, packing.BATCH_TOKENS)
