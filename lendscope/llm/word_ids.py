"""Token ids of whole texts, for tokenizers that drop white space.

Such a tokenizer never joins what stands on both sides of a blank, so the ids of a text are
those of its words in a row. Words repeat: those of a run of texts are told apart by Arrow, and
parted into letters and signs; ids of the parts are looked up in a memo, and made by the library
once. The memo is bounded: beyond its limit it starts anew.
"""

from __future__ import annotations

import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Parts of words held in memory by one Python worker.
MEMO_WORDS = 400_000
#: Characters of text handled at once.
SLICE_CHARS = 2_000_000

#: Latin letters, and signs that no letter or digit pattern of a tokenizer takes in.
LETTERS = "".join(map(chr, itertools.chain(
    range(0x41, 0x5B), range(0x61, 0x7B), range(0xC0, 0xD7), range(0xD8, 0xF7), range(0xF8, 0x100)
)))
SIGNS = "!\"#$%&()*+,-./:;=?@[]^_`{|}~"


def _gather(starts: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the ids of numbered entries are, in a row, and where each entry's begin in that row."""
    sizes = sizes[numbers]
    running = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(running[-1]) + np.repeat(starts[numbers] - running[:-1], sizes), running


class WordEncoder:
    """Exact ids by the `tokenizers` library, with a bounded memo of parts of words.

    The memo gives the number of a part; `starts`, `sizes` and `flat` hold the ids by number.
    """

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A special token between two words keeps their ids apart in one call.
        self.mark_id, mark = min(self.tokenizer.get_added_tokens_decoder().items())
        self.mark = mark.content
        self.memo_words = memo_words
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {"": 0}
        self.starts, self.sizes = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.flat = np.zeros(0, "<u4")

    def _call(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, from the library."""
        found = {}
        plain = [w for w in words if self.mark not in w]
        for start in range(0, len(plain), 20_000):
            some = plain[start : start + 20_000]
            joined = self.tokenizer.encode_batch_fast([self.mark.join(some)], add_special_tokens=False)
            ids = np.array(joined[0].ids, dtype="<u4")
            cuts = 4 * np.flatnonzero(ids == self.mark_id)
            raw = ids.tobytes()
            begins, ends = [0, *(cuts + 4).tolist()], [*cuts.tolist(), len(raw)]
            found.update(zip(some, [raw[b:e] for b, e in zip(begins, ends)], strict=True))
        for word in words:
            if self.mark in word:
                ids = self.tokenizer.encode(word, add_special_tokens=False).ids
                found[word] = np.array(ids, dtype="<u4").tobytes()
        return found

    def _add(self, entries: dict[str, bytes]) -> None:
        sizes = np.fromiter(map(len, entries.values()), np.int64, len(entries)) // 4
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        self.memo.update(zip(entries, range(len(self.sizes), len(self.sizes) + len(entries))))
        self.starts = np.concatenate([self.starts, starts])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(entries.values()), "<u4")])

    def _parts(self, words: pa.Array) -> np.ndarray:
        """Numbers of the two parts of each word, which are taken into the memo.

        A word of Latin letters and signs behind them has the ids of the letters, in lower
        case, and then those of the signs: the tokenizer parts them there and lowers letters.
        So a word needs no call if it was seen in another case or before another sign. Any other
        word is its own first part, and its second is empty.
        """
        letters = pc.utf8_rtrim(words, characters=SIGNS)
        parted = pc.and_(
            pc.not_equal(letters, ""), pc.equal(pc.utf8_ltrim(letters, characters=LETTERS), "")
        )
        first = pc.if_else(parted, pc.utf8_lower(letters), words)
        second = pc.if_else(parted, pc.utf8_ltrim(words, characters=LETTERS), "")
        found = []
        for part in (first, second):
            coded = part.dictionary_encode()
            distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            missing = [p for p in distinct if p not in self.memo]
            if missing:
                self._add(self._call(missing))
            numbers = np.fromiter(map(self.memo.__getitem__, distinct), np.int64, len(distinct))
            found.append(numbers[coded.indices.to_numpy()])
        return np.stack(found, axis=1)

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the parts of every distinct word of the texts, the place among these of all
        words in a row, and where each text ends."""
        if len(self.memo) > self.memo_words:
            self._forget()
        # Arrow keeps what the run before has freed; workers share an executor's memory with the JVM.
        pa.default_memory_pool().release_unused()
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        return self._parts(words.dictionary), words.indices.to_numpy(), split.offsets.to_numpy()[1:]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each text."""
        if not texts:
            return np.zeros(0, np.int64)
        parts, places, ends = self._words(texts)
        running = np.concatenate([[0], np.cumsum(self.sizes[parts].sum(axis=1)[places])])
        return np.diff(running[np.concatenate([[0], ends])])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        if not texts:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        parts, places, ends = self._words(texts)
        at, cuts = _gather(self.starts, self.sizes, parts.ravel())
        ids, cuts = self.flat[at], cuts[::2]
        at, running = _gather(cuts[:-1], np.diff(cuts), places)
        return ids[at], np.diff(running[np.concatenate([[0], ends])])


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker, which keeps its memo from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def slices(texts: list[str | None], most: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Consecutive runs of texts of about so many characters, with their first position."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield start, [t or "" for t in texts[start : i + 1]]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, [t or "" for t in texts[start:]]
