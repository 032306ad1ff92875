"""Minimal acyclic automata over words whose accepted paths carry counts.

Built incrementally from phrases in ascending order: when a phrase parts from the one before it,
the states behind the parting point can no longer change and are looked up in a register, so
equal ends (same counts, same continuations) are stored once. States are numbered children first;
the last one is the root. Words are bytes, so their order is that of UTF-8.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import zstandard

Phrase = tuple[bytes, ...]


class Transducer:
    def __init__(self, finals: list[int], arcs: list[tuple[tuple[bytes, int], ...]]):
        self.finals = finals
        self.arcs = arcs

    @property
    def root(self) -> int:
        return len(self.finals) - 1

    def items(self) -> Iterator[tuple[Phrase, int]]:
        """Phrases and counts, ascending."""
        stack: list[tuple[int, Phrase]] = [(self.root, ())]
        while stack:
            state, phrase = stack.pop()
            if self.finals[state]:
                yield phrase, self.finals[state]
            stack.extend((target, (*phrase, word)) for word, target in reversed(self.arcs[state]))

    def compose(self, wanted: Transducer) -> Iterator[tuple[Phrase, int]]:
        """The phrases of `wanted` with their counts here (0 where they are missing).

        Both automata are walked at once, so a part that many phrases begin with is followed once.
        """
        stack: list[tuple[int | None, int, Phrase]] = [(self.root, wanted.root, ())]
        while stack:
            here, there, phrase = stack.pop()
            if wanted.finals[there]:
                yield phrase, 0 if here is None else self.finals[here]
            targets = {} if here is None else dict(self.arcs[here])
            stack.extend(
                (targets.get(word), target, (*phrase, word)) for word, target in reversed(wanted.arcs[there])
            )

    def to_bytes(self) -> bytes:
        words = sorted({word for arcs in self.arcs for word, _ in arcs})
        number = {word: i for i, word in enumerate(words)}
        flat = [arc for arcs in self.arcs for arc in arcs]
        parts = [
            np.array([len(self.finals), len(flat)], "<u8"),
            np.array(self.finals, "<u8"),
            np.fromiter((len(arcs) for arcs in self.arcs), "<u4", len(self.arcs)),
            np.fromiter((number[word] for word, _ in flat), "<u4", len(flat)),
            np.fromiter((target for _, target in flat), "<u4", len(flat)),
        ]
        # No word holds a blank.
        raw = b"".join(part.tobytes() for part in parts) + b" ".join(words)
        return zstandard.ZstdCompressor(level=3).compress(raw)

    @staticmethod
    def from_bytes(packed: bytes) -> Transducer:
        raw = zstandard.ZstdDecompressor().decompress(packed)
        n_states, n_arcs = np.frombuffer(raw, "<u8", 2).tolist()
        at = 16
        finals = np.frombuffer(raw, "<u8", n_states, at).tolist()
        at += 8 * n_states
        ends = np.cumsum(np.frombuffer(raw, "<u4", n_states, at)).tolist()
        at += 4 * n_states
        numbers = np.frombuffer(raw, "<u4", n_arcs, at).tolist()
        targets = np.frombuffer(raw, "<u4", n_arcs, at + 4 * n_arcs).tolist()
        words = raw[at + 8 * n_arcs :].split(b" ")
        flat = [(words[number], target) for number, target in zip(numbers, targets, strict=True)]
        starts = [0, *ends[:-1]]
        return Transducer(finals, [tuple(flat[b:e]) for b, e in zip(starts, ends, strict=True)])


class _States:
    """States with a register, so that equal ones are one."""

    def __init__(self) -> None:
        self.finals: list[int] = []
        self.arcs: list[tuple[tuple[bytes, int], ...]] = []
        self.register: dict[tuple, int] = {}

    def state(self, final: int, arcs: tuple[tuple[bytes, int], ...]) -> int:
        known = self.register.setdefault((final, arcs), len(self.finals))
        if known == len(self.finals):
            self.finals.append(final)
            self.arcs.append(arcs)
        return known

    def done(self, root: int) -> Transducer:
        if root != len(self.finals) - 1:  # an empty automaton's root equals a leaf
            self.finals.append(self.finals[root])
            self.arcs.append(self.arcs[root])
        return Transducer(self.finals, self.arcs)


def build(items: Iterable[tuple[Phrase, int]]) -> Transducer:
    """The automaton of phrases in ascending order, none twice, with counts above 0."""
    states = _States()
    before: Phrase = ()
    opened: list[tuple[int, list]] = [(0, [])]  # one for each word of the phrase before, and the root

    def close(depth: int) -> None:
        while len(opened) > depth + 1:
            final, arcs = opened.pop()
            opened[-1][1].append((before[len(opened) - 1], states.state(final, tuple(arcs))))

    for phrase, count in items:
        if before and phrase <= before:
            raise ValueError(f"{phrase} does not come after {before}")
        shared = 0
        for left, right in zip(phrase, before, strict=False):
            if left != right:
                break
            shared += 1
        close(shared)
        opened.extend((0, []) for _ in phrase[shared:-1])
        opened.append((count, []))
        before = phrase
    close(0)
    return states.done(states.state(opened[0][0], tuple(opened[0][1])))


def unite(parts: list[Transducer]) -> Transducer:
    """One automaton with the counts of all parts added up: their states are walked together, a
    word at a time."""
    states = _States()
    seen: dict[tuple, int] = {}

    def visit(group: tuple[tuple[int, int], ...]) -> int:
        if group in seen:
            return seen[group]
        onward: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        final = 0
        for part, state in group:
            final += parts[part].finals[state]
            for word, target in parts[part].arcs[state]:
                onward[word].append((part, target))
        arcs = tuple((word, visit(tuple(onward[word]))) for word in sorted(onward))
        seen[group] = states.state(final, arcs)
        return seen[group]

    return states.done(visit(tuple((i, part.root) for i, part in enumerate(parts))))
