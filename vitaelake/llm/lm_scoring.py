"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised on a log scale, and a pair of count
c is put into a Bloom filter once for each level up to its own. A count is read
back by probing levels until one is missing. The filter is built in segments of
the hash space, each in its own task, so no list of pairs is ever gathered; the
segments are broadcast in blocks of at most ``block_bytes``. A corpus that needs
several blocks is scored in as many passes, between which the counts read so far
travel with each text in a table of the shared folder. The answers are the same.

Words are identified by 64-bit hashes. The model interpolates pair and word
probabilities; being read from a filter, they sum to one only approximately.
NULL texts are empty and score one end token. Rows with NULL or repeated ids are
scored one by one; an empty training table gives the uniform estimate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.llm.arrays import Words, constants, mixed, words_of
from vitaelake.sources.staging import estimated_bytes, stage

BLOCK_BYTES = 96 << 20
SEGMENT_INPUT_BYTES = 8 << 20
FLUSH_WORDS = 2_000_000
LEVEL_BASE = 2.0
BITS_PER_ENTRY = 6
PROBES = 4
PAIR_SHARE = 0.6

_U64 = np.uint64
_BEGIN, _END = constants(2, 101)
_FIRST, _SECOND = constants(2, 103)
_LEVEL = constants(65, 105)  # one per level
_PROBE = constants(PROBES, 107)

_PARTS = "kind int, segment int, hashes binary, counts binary"
_SEGMENTS = "kind int, segment int, rows long, total long, size long, hashes binary, counts binary, bits binary"


@dataclass
class Model:
    segments: DataFrame
    shift: int
    train_tokens: int
    vocabulary: int
    pair_share: float = PAIR_SHARE
    block_bytes: int = BLOCK_BYTES


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Words and one end per text, and where each text's tokens begin."""
    tokens = np.insert(words.hashes, words.first[1:], _END)
    return tokens, words.first + np.arange(len(words) + 1)


def _pairs(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first[:-1]] = _BEGIN
    return mixed(before * _FIRST + tokens * _SECOND)


def _merged(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    joined, weights = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(joined, kind="stable")
    joined, weights = joined[order], weights[order]
    begins = np.flatnonzero(np.concatenate([[True], joined[1:] != joined[:-1]])[: len(joined)])
    if len(begins) == 0:
        return joined, weights
    return joined[begins], np.add.reduceat(weights, begins)


def _counted(shift: int):
    def flush(kept: list[tuple[list, list]]) -> Iterator[pa.RecordBatch]:
        for kind, (hashes, counts) in enumerate(kept, start=1):
            if not hashes:
                continue
            h, c = _merged(hashes, counts)
            cuts = np.searchsorted(h >> _U64(shift), np.arange((1 << (64 - shift)) + 1, dtype=_U64))
            rows = [
                (kind, s, h[a:b].tobytes(), c[a:b].tobytes())
                for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))
                if b > a
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[i] for r in rows], type)
                    for i, type in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))
                ],
                names=["kind", "segment", "hashes", "counts"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = [([], []), ([], [])], 0
        for batch in batches:
            for _, _, words in words_of(batch.column(0)):
                tokens, first = _tokens(words)
                for at, values in enumerate((tokens, _pairs(tokens, first))):
                    h, c = np.unique(values, return_counts=True)
                    kept[at][0].append(h)
                    kept[at][1].append(c.astype(np.int64))
                held += len(tokens)
                if held >= FLUSH_WORDS:
                    yield from flush(kept)
                    kept, held = [([], []), ([], [])], 0
        yield from flush(kept)

    return run


def _levels(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(LEVEL_BASE) + 1e-9).astype(np.int64)


_LEVEL_VALUE = np.array(
    [0.0] + [(LEVEL_BASE**q + LEVEL_BASE ** (q + 1) - 1) / 2 for q in range(64)]
)


def _bit(entries: np.ndarray, probe: np.uint64, size: np.ndarray | np.uint64) -> np.ndarray:
    return ((entries * probe >> _U64(32)) * size) >> _U64(32)


def _filled(hashes: np.ndarray, counts: np.ndarray) -> tuple[int, bytes]:
    levels = _levels(counts)
    size = max(64, -(-int(levels.sum()) * BITS_PER_ENTRY // 64) * 64)
    if size >= 1 << 32:
        raise ValueError("a segment is too large; lower SEGMENT_INPUT_BYTES")
    bits = np.zeros(size, dtype=bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        entries = mixed(hashes[levels >= level] + _LEVEL[level])
        for probe in _PROBE:
            bits[_bit(entries, probe, _U64(size))] = True
    return size, np.packbits(bits).tobytes()


def _built(table: pa.Table) -> pa.Table:
    """One segment of the filter from the parts of all tasks."""
    kind, segment = table.column("kind")[0].as_py(), table.column("segment")[0].as_py()
    parts = [
        [np.frombuffer(x.as_buffer(), dtype=t) for x in table.column(name)]
        for name, t in (("hashes", _U64), ("counts", np.int64))
    ]
    hashes, counts = _merged(*parts)
    size, bits = _filled(hashes, counts)
    exact = kind == 1  # single words are also kept as they are, for the exact base score
    return pa.table(
        {
            "kind": pa.array([kind], pa.int32()),
            "segment": pa.array([segment], pa.int32()),
            "rows": pa.array([len(hashes)], pa.int64()),
            "total": pa.array([int(counts.sum())], pa.int64()),
            "size": pa.array([size], pa.int64()),
            "hashes": pa.array([hashes.tobytes() if exact else b""], pa.binary()),
            "counts": pa.array([counts.tobytes() if exact else b""], pa.binary()),
            "bits": pa.array([bits], pa.binary()),
        }
    )


def fit(
    docs: DataFrame, text: str = "text", *, pair_share: float = PAIR_SHARE, block_bytes: int = BLOCK_BYTES
) -> Model:
    """Count all texts and build the filter, as a table of the shared folder."""
    wanted = estimated_bytes(docs) // SEGMENT_INPUT_BYTES
    shift = 64 - min(max(4, int(wanted).bit_length()), 20)
    parts = docs.select(F.col(text)).mapInArrow(_counted(shift), _PARTS)
    built = parts.groupBy("kind", "segment").applyInArrow(_built, _SEGMENTS)
    segments = stage(built, "lm-filter")
    totals = segments.filter("kind = 1").agg(F.sum("total"), F.sum("rows")).first()
    return Model(segments, shift, totals[0] or 0, totals[1] or 0, pair_share, block_bytes)


@dataclass
class _Block:
    """Some segments of each kind: exact words, and filters with their offsets."""

    shift: int
    owned: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray
    sizes: dict[int, np.ndarray]
    offsets: dict[int, np.ndarray]
    bits: dict[int, np.ndarray]

    def parts(self) -> tuple:
        """What ``_Block`` is made of again."""
        return tuple(getattr(self, f.name) for f in fields(self))

    def _segment(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> _U64(self.shift)).astype(np.int64)

    def exact(self, words: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(words), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words, self.counts[at], 0)

    def owns(self, words: np.ndarray) -> np.ndarray:
        return self.owned[self._segment(words)]

    def counted(self, kind: int, hashes: np.ndarray) -> np.ndarray:
        """Counts read back by probing levels upwards until one is missing."""
        found = np.zeros(len(hashes), dtype=np.int64)
        segment = self._segment(hashes)
        alive = np.flatnonzero(self.sizes[kind][segment])
        for level in range(1, len(_LEVEL_VALUE)):
            if not len(alive):
                break
            entries = mixed(hashes[alive] + _LEVEL[level])
            for probe in _PROBE:
                own = segment[alive]
                at = _bit(entries, probe, self.sizes[kind][own]) + self.offsets[kind][own]
                byte = self.bits[kind][(at >> _U64(3)).astype(np.int64)]
                kept = np.flatnonzero((byte >> (_U64(7) - (at & _U64(7))).astype(np.uint8)) & 1)
                alive, entries = alive[kept], entries[kept]
            found[alive] = level
        return _LEVEL_VALUE[found]


def _groups(model: Model) -> list[list[tuple[int, int]]]:
    """(kind, segment) of each block; a block has at most ``block_bytes``."""
    weight = F.length("hashes") + F.length("counts") + F.length("bits")
    sizes = model.segments.select("kind", "segment", weight.alias("bytes")).collect()
    groups: list[list[tuple[int, int]]] = [[]]
    held = 0
    for row in sorted(sizes, key=lambda r: (r.kind, r.segment)):
        if groups[-1] and held + row.bytes > model.block_bytes:
            groups, held = [*groups, []], 0
        groups[-1].append((row.kind, row.segment))
        held += row.bytes
    return groups


def _loaded(model: Model, group: list[tuple[int, int]], first: bool, known: set[int]) -> _Block:
    chosen = F.lit(False)
    for kind in (1, 2):
        own = [segment for k, segment in group if k == kind]
        if own:
            chosen = chosen | (
                (F.col("kind") == kind) & F.col("segment").between(min(own), max(own))
            )
    rows = sorted(model.segments.filter(chosen).collect(), key=lambda r: (r.kind, r.segment))
    segments = 1 << (64 - model.shift)
    # A word's base score is added in one pass; segments without words count in the first.
    owned = np.zeros(segments, dtype=bool)
    owned[[r.segment for r in rows if r.kind == 1]] = True
    if first:
        owned |= ~np.isin(np.arange(segments), list(known))
    sizes, offsets, bits = {}, {}, {}
    for kind in (1, 2):
        own = [r for r in rows if r.kind == kind]
        sizes[kind], offsets[kind] = np.zeros(segments, dtype=_U64), np.zeros(segments, dtype=_U64)
        at = 0
        for r in own:
            sizes[kind][r.segment], offsets[kind][r.segment] = r.size, at
            at += r.size
        bits[kind] = np.frombuffer(b"".join(r.bits for r in own), dtype=np.uint8)
    words = [r for r in rows if r.kind == 1]
    hashes = np.frombuffer(b"".join(r.hashes for r in words), dtype=_U64)
    counts = np.frombuffer(b"".join(r.counts for r in words), dtype=np.int64)
    return _Block(model.shift, owned, hashes, counts, sizes, offsets, bits)


_CARRIED = "n_known long, base_score double, word_counts binary, pair_counts binary"


def _joined(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32)


def _pass(block, model_size: tuple[int, int], share: float, keys: int, first: bool, last: bool):
    """Add what one block knows; the last pass turns counts into a score."""
    train_tokens, vocabulary = model_size
    scale = train_tokens + 0.5 * (vocabulary + 1)

    def scored(word: np.ndarray, pair: np.ndarray, begins: np.ndarray) -> np.ndarray:
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[begins[:-1]] = word[begins[1:] - 1]  # there are as many begins as ends
        paired = pair / np.maximum(np.maximum(before, pair), 1.0)
        single = np.minimum((word + 0.5) / scale, 1.0)
        return np.add.reduceat(np.log10(share * paired + (1 - share) * single), begins[:-1])

    def piece(words: Words, own: list[pa.Array] | None) -> list:
        known_block = _Block(*block.value)
        tokens, begins = _tokens(words)
        unique, where = np.unique(tokens, return_inverse=True)
        exact = known_block.exact(unique)
        base = np.where(known_block.owns(unique), np.log10((exact + 0.5) / scale), 0.0)
        base = np.add.reduceat(base[where], begins[:-1])
        known = np.add.reduceat((exact > 0)[where].astype(np.int64), begins[:-1])
        word = known_block.counted(1, unique)[where]
        pair = known_block.counted(2, _pairs(tokens, begins))
        if own is not None:
            known, base = known + own[0].to_numpy(), base + own[1].to_numpy()
            word, pair = word + _joined(own[2]), pair + _joined(own[3])
        if last:
            return [np.diff(begins), known, base, scored(word, pair, begins)]
        split = [np.split(x.astype(np.float32), begins[1:-1]) for x in (word, pair)]
        return [known, base, *([x.tobytes() for x in parts] for parts in split)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.float64(), pa.float64()] if last else [pa.int64(), pa.float64(), pa.binary(), pa.binary()]
        names = ["n_tokens", "n_known", "base_score", "score"] if last else ["n_known", "base_score", "word_counts", "pair_counts"]
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for lo, hi, words in words_of(batch.column(keys)):
                own = None if first else [batch.column(keys + 1 + i).slice(lo, hi - lo) for i in range(4)]
                for column, values in zip(out, piece(words, own)):
                    column.extend(values)
            kept = list(range(keys)) if last else list(range(keys + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept] + [pa.array(v, t) for v, t in zip(out, types)],
                names=[batch.schema.names[i] for i in kept] + names,
            )

    return run


def score(docs: DataFrame, model: Model, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and n_tokens, n_known, base_score, score (both log10) of every row."""
    context = docs.sparkSession.sparkContext
    current = docs.select(*keys, F.col(text))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in current.schema]
    groups = _groups(model)
    known = {segment for group in groups for kind, segment in group if kind == 1}
    for number, group in enumerate(groups):
        first, last = number == 0, number == len(groups) - 1
        # Plain arrays: workers need no copy of the package to read the broadcast.
        block = context.broadcast(_loaded(model, group, first, known).parts())
        size = (model.train_tokens, model.vocabulary)
        run = _pass(block, size, model.pair_share, len(keys), first, last)
        if last:
            shape = ", ".join([*fields[:-1], "n_tokens long, n_known long, base_score double, score double"])
            return current.mapInArrow(run, shape)
        current = stage(current.mapInArrow(run, ", ".join([*fields, _CARRIED])), "lm-pass")
    raise AssertionError("there is at least one block")
