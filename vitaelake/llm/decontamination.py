"""Removal of benchmark passages with a generalised suffix automaton.

All items of a benchmark go into one suffix automaton over words. A document's
words run through it; at each word the automaton knows the longest run of words
ending there that some item holds. A run of ``window`` words is a hit, as is a
whole item of fewer words. Hit words can be removed, or documents dropped by the
length or the coverage of what was hit.

The automaton is built on the driver from at most ``block_words`` item words; a
larger benchmark is taken in blocks, each broadcast and run over the documents in
turn, and the hits of all blocks are united. Documents are never shuffled.

Only stretches in which every pair of neighbouring words occurs in some item are
run through the automaton word by word: elsewhere no match of two words can be,
so the state is known without stepping. NULL texts have no words; NULL or empty
items have no windows; repeated items are reported under each of their ids, and
repeated documents get equal rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaelake.llm.arrays import ALPHANUMERIC, Words, constants, mixed, pieces, words_of

WINDOW = 10
BLOCK_WORDS = 2_000_000
SCREEN_BITS = 22

_U64 = np.uint64
_FIRST, _SECOND = constants(2, 211)


def _pairs(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mixed(before * _FIRST + after * _SECOND)


@dataclass
class SuffixAutomaton:
    """States of the automaton: longest length, suffix link, transitions by word."""

    window: int
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    #: Items by the state of a whole window, and of a whole shorter item.
    window_items: dict[int, set[str]] = field(default_factory=dict)
    short_items: dict[int, set[str]] = field(default_factory=dict)
    short_link: dict[int, int] = field(default_factory=dict)
    shortest: int = 1 << 30

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        return len(self.length) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = clone
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        q = self.step[last].get(word)
        if q is not None:  # an earlier item holds this prefix
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][word]
            fits = self.length[q] == self.length[p] + 1
            self.link[new] = q if fits else self._split(p, q, word)
        return new

    def add(self, words: Sequence[int]) -> None:
        state = 0
        for word in words:
            state = self._extend(state, word)

    def name(self, item: str, words: Sequence[int]) -> None:
        """Note the item at the states of its windows, once all items were added."""
        size = min(self.window, len(words))
        if not size:
            return
        self.shortest = min(self.shortest, size)
        state, length = 0, 0
        for word in words:
            state, length = self.after(state, length, word)
            if length >= self.window:
                self.window_items.setdefault(self._suffix(state, self.window), set()).add(item)
        if len(words) < self.window:
            self.short_items.setdefault(state, set()).add(item)

    def finish(self) -> None:
        """Nearest suffix of each state that is a whole short item."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            link = self.link[state]
            near = link if link in self.short_items else self.short_link.get(link)
            if near is not None:
                self.short_link[state] = near

    def after(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and match length after one more word."""
        while word not in self.step[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            length = self.length[state]
        return self.step[state][word], length + 1

    def _suffix(self, state: int, size: int) -> int:
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def hits(self, state: int, length: int) -> Iterator[tuple[int, set[str]]]:
        """(words, items) of every window that ends at this state."""
        if length >= self.window:
            yield self.window, self.window_items[self._suffix(state, self.window)]
        short = state if state in self.short_items else self.short_link.get(state)
        while short is not None:
            if self.length[short] <= length:
                yield self.length[short], self.short_items[short]
            short = self.short_link.get(short)


@dataclass
class _Block:
    automaton: SuffixAutomaton
    ids: dict[int, int]
    screen: np.ndarray

    def parts(self) -> tuple:
        """Plain containers: workers need no copy of the package to read the broadcast."""
        return vars(self.automaton), self.ids, self.screen

    @classmethod
    def of_parts(cls, parts: tuple) -> _Block:
        automaton = SuffixAutomaton.__new__(SuffixAutomaton)
        vars(automaton).update(parts[0])
        return cls(automaton, *parts[1:])


def _block(items: list[tuple[str, np.ndarray]], window: int) -> _Block:
    automaton, ids = SuffixAutomaton(window), {}
    screen = np.zeros(1 << SCREEN_BITS, dtype=bool)
    numbered = []
    for item, hashes in items:
        numbered.append((item, [ids.setdefault(int(h), len(ids)) for h in hashes]))
        automaton.add(numbered[-1][1])
        screen[_pairs(hashes[:-1], hashes[1:]) >> _U64(64 - SCREEN_BITS)] = True
    for item, words in numbered:
        automaton.name(item, words)
    automaton.finish()
    return _Block(automaton, ids, screen)


def _blocks(items: DataFrame, key: str, text: str, window: int, block_words: int) -> Iterator[_Block]:
    held: list[tuple[str, np.ndarray]] = []
    size = 0
    rows = items.select(F.col(key).cast("string"), F.col(text)).filter(F.col(key).isNotNull())
    for name, content in rows.toLocalIterator():
        words = next(words_of(pa.array([content or ""]), ALPHANUMERIC))[2].hashes.copy()
        if held and size + len(words) > block_words:
            yield _block(held, window)
            held, size = [], 0
        held.append((name, words))
        size += len(words)
    yield _block(held, window)


def _stretches(words: Words, block: _Block) -> Iterator[tuple[int, int]]:
    """Runs of words that can hold a window, as positions in the piece."""
    hashes, first = words.hashes, words.first
    shortest = block.automaton.shortest
    if shortest > len(hashes):
        return
    if shortest == 1:
        for a, b in zip(first[:-1], first[1:]):
            yield int(a), int(b)
        return
    known = block.screen[_pairs(hashes[:-1], hashes[1:]) >> _U64(64 - SCREEN_BITS)]
    cuts = first[1:-1]
    known[cuts[(cuts > 0) & (cuts < len(hashes))] - 1] = False  # no pair spans two texts
    edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2] + 1
    for a, b in zip(begins, ends):
        if b - a >= shortest:
            yield int(a), int(b)


def _found(words: Words, block: _Block) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
    """By text of the piece: hit spans as word positions in the text, and items."""
    automaton, ids = block.automaton, block.ids
    found: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
    for a, b in _stretches(words, block):
        state, length, own = 0, 0, None
        for at in range(a, b):
            number = ids.get(int(words.hashes[at]))
            if number is None:
                state, length = 0, 0
                continue
            state, length = automaton.after(state, length, number)
            for size, names in automaton.hits(state, length):
                if own is None:
                    text = int(np.searchsorted(words.first, at, side="right")) - 1
                    own = found.setdefault(text, ([], set()))
                    base = int(words.first[text])
                own[0].append((at - size + 1 - base, at + 1 - base))
                own[1].update(names)
    return found


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_NAMES = pa.list_(pa.string())
_ADDED = "n_words long, hit_spans array<struct<begin: bigint, end: bigint>>, items array<string>"


def _sliced(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about a megabyte of whole texts.

    What a task makes of a slice goes out before the next is taken, so it never holds
    the results of a whole batch beside the batch.
    """
    for batch in batches:
        for lo, hi, _, _ in pieces(batch.column(at)):
            yield batch.slice(lo, hi - lo)


def _searched(block, at: int, width: int, carried: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Block.of_parts(block.value)
        for batch in _sliced(batches, at):
            counts, spans, items = [], [], []
            for lo, hi, words in words_of(batch.column(at), ALPHANUMERIC):
                found = _found(words, own)
                counts.extend(words.counts.tolist())
                for i in range(hi - lo):
                    hit, names = found.get(i, ([], set()))
                    spans.append(_united(hit))
                    items.append(sorted(names))
            if carried:  # what earlier blocks found
                old = zip(batch.column(width + 1).to_pylist(), batch.column(width + 2).to_pylist())
                for i, (before, names) in enumerate(old):
                    if before:
                        spans[i] = _united(spans[i] + [(s["begin"], s["end"]) for s in before])
                        items[i] = sorted({*items[i], *names})
            rows = [[{"begin": a, "end": b} for a, b in s] for s in spans]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(width)), pa.array(counts, pa.int64()),
                 pa.array(rows, _SPANS), pa.array(items, _NAMES)],
                names=[*batch.schema.names[:width], "n_words", "hit_spans", "items"],
            )

    return run


def _searched_rows(
    docs: DataFrame,
    items: DataFrame,
    text: str,
    item_id: str,
    item_text: str,
    window: int,
    block_words: int,
    then: Callable | None = None,
) -> DataFrame:
    """The columns of docs as c0, c1, ..., whatever their names, and what was found.

    ``then`` takes the batches of the last block within the same task, and returns
    batches of the columns of docs alone.
    """
    context = docs.sparkSession.sparkContext
    current = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in current.schema)
    width, at = len(docs.columns), docs.columns.index(text)
    blocks = _blocks(items, item_id, item_text, window, block_words)
    block, number = next(blocks), 0
    while block is not None:
        run = _searched(context.broadcast(block.parts()), at, width, number > 0)
        block, number = next(blocks, None), number + 1
        if block is None and then is not None:
            return current.mapInArrow(_chained(run, then), fields)
        current = current.mapInArrow(run, f"{fields}, {_ADDED}")
    return current


def _chained(first: Callable, second: Callable) -> Callable:
    return lambda batches: second(first(batches))


_FOUND = ("n_words", "hit_spans", "items")


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """All columns of docs, and n_words, hit_spans (word positions), items (sorted ids).

    Columns of docs that have one of these three names are left out.
    """
    found = _searched_rows(docs, items, text, item_id, item_text, window, block_words)
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in _FOUND]
    return found.select(*own, *_FOUND)


def n_hit(spans: Column) -> Column:
    """Words in the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])


def _cut(at: int, width: int, max_coverage: float, max_words: int | None):
    """Batches of a search without the documents that are hit too much, and without the hits."""

    def too_much(n_words: int, spans: list[dict]) -> bool:
        sizes = [s["end"] - s["begin"] for s in spans]
        return sum(sizes) > n_words * max_coverage or (max_words is not None and max(sizes, default=0) > max_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str | None] = []
            keep: list[bool] = []
            column, counts, spans = batch.column(at), batch.column(width), batch.column(width + 1)
            for lo, hi, words in words_of(column, ALPHANUMERIC):
                for i in range(hi - lo):
                    hit = spans[lo + i].as_py()
                    content = column[lo + i].as_py()
                    keep.append(not too_much(counts[lo + i].as_py(), hit))
                    if not hit:
                        texts.append(content)
                        continue
                    raw, base, kept, last = content.encode(), int(words.bounds[i]), [], 0
                    first = int(words.first[i])
                    for s in hit:
                        kept.append(raw[last : int(words.starts[first + s["begin"]]) - base])
                        last = int(words.ends[first + s["end"] - 1]) - base
                    texts.append((b"".join(kept) + raw[last:]).decode())
            columns = [batch.column(i) for i in range(width)]
            columns[at] = pa.array(texts, pa.string())
            whole = pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:width])
            yield whole.filter(pa.array(keep, pa.bool_()))

    return run


def remove(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    max_coverage: float = 0.5,
    max_words: int | None = None,
    **parameters,
) -> DataFrame:
    """Cut hit passages out; drop documents of which too much was hit.

    A document goes when more than ``max_coverage`` of its words are hit, or a
    hit passage has more than ``max_words`` words. Others keep all but the passages.
    """
    given = {"item_id": "item_id", "item_text": "text", "window": WINDOW, "block_words": BLOCK_WORDS}
    cut = _cut(docs.columns.index(text), len(docs.columns), max_coverage, max_words)
    kept = _searched_rows(docs, items, text, **(given | parameters), then=cut)
    return kept.toDF(*docs.columns)
