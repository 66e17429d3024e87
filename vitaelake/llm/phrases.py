"""Phrases whose words occur together more than their parts do, per language.

A word that occurs at least ``min_count`` times in a language gets a number, and a run
of n words is the packed numbers of its words. An invertible permutation spreads the
packed numbers; the high bits, the quotient, name a bucket, and a counting quotient
filter keeps in order the remainders of a bucket, in as few bytes as they need, with
their counts. Nothing of a number is lost, so counts are exact and a remainder leads
back to its words. Tasks make filters of their texts, and sorted filters of the same
bucket are merged across tasks.

Runs of three and four words are counted only where both runs inside them that are
shorter by one word pass a bit map of the frequent ones, since no run is more frequent
than its parts. The maps have a fixed size and never miss a frequent run.

The words of a text are runs of bytes other than space and tab within pieces, which
end at . , ; : ! ? and line ends; A-Z are lower-cased. Words are found by 64-bit
hashes of language and word. Word numbers are looked up in blocks of ``WORD_BLOCK``
entries; with more frequent words, each further block is one more pass over the texts.

Odd rows: a NULL or empty text has no words; a NULL language is ``und``; repeated
rows count again; an empty table gives no phrases. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitaelake.llm.arrays import Words, mixed, raw_text, words_of
from vitaelake.llm.bitmaps import bit_map_of, may_hold
from vitaelake.operators.ranking import number_rows
from vitaelake.sources.staging import estimated_bytes, fits_broadcast, sized, stage

_U64 = np.uint64

MIN_COUNT = 30
LONGEST = 4
TOP = 2000
#: Per cent of a phrase's occurrences inside a longer one that make it a part of that.
INSIDE = 80
UNKNOWN = "und"
#: Word hashes that one broadcast holds, 8 bytes each.
WORD_BLOCK = 1 << 23
#: log2 of the bits in a map of frequent runs: 16 MB.
MAP_BITS = 27
#: Distinct words, runs, or entries of a filter that a task holds before it hands them on.
HELD_WORDS, HELD_RUNS, HELD_ENTRIES = 1 << 18, 1 << 21, 1 << 21
#: Entries that a bucket is meant to hold.
BUCKET_SIZE = 1 << 18
SALTS = 8
SLICES = 64

_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, *range(0x0A, 0x0E)]] = True
_WORD = ~_BREAKS
_WORD[[0x20, 0x09]] = False


# Words and their numbers


def _language_keys(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The languages of a batch, a hash of each, and which one each row has."""
    coded = column.dictionary_encode()
    names = coded.dictionary.to_pylist()
    digests = [hashlib.blake2b(n.encode(), digest_size=8).digest() for n in names]
    return names, np.frombuffer(b"".join(digests), dtype="<u8"), coded.indices.to_numpy()


def _word_hashes(words: Words, keys: np.ndarray) -> np.ndarray:
    return mixed(words.hashes ^ np.repeat(keys, words.counts)).view(np.int64)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Language, word, hash and count of the distinct words of a task."""
    known, counts = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    seen: dict[int, tuple[str, bytes]] = {}

    def rows() -> pa.RecordBatch:
        own = [seen[h] for h in known.tolist()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name for name, _ in own], pa.string()),
                pa.array([word.decode() for _, word in own], pa.string()),
                pa.array(known), pa.array(counts),
            ],
            names=["lang", "word", "hash", "f"],
        )

    for batch in batches:
        names, keys, code = _language_keys(batch.column(0))
        for lo, hi, words in words_of(batch.column(1), _WORD):
            hashes, at, own = np.unique(
                _word_hashes(words, keys[code[lo:hi]]), return_index=True, return_counts=True
            )
            place = np.searchsorted(known, hashes)
            place[place == len(known)] = 0
            old = known[place] == hashes if len(known) else np.zeros(len(hashes), dtype=bool)
            counts[place[old]] += own[old]
            new = ~old
            text = np.searchsorted(words.first, at[new], side="right") - 1
            for h, t, i in zip(hashes[new].tolist(), (text + lo).tolist(), at[new].tolist()):
                seen[h] = names[code[t]], words.data[words.starts[i] : words.ends[i]].tobytes()
            merged = np.concatenate([known, hashes[new]])
            order = np.argsort(merged, kind="stable")
            known, counts = merged[order], np.concatenate([counts, own[new]])[order]
            if len(known) > HELD_WORDS:
                yield rows()
                known, counts, seen = known[:0], counts[:0], {}
    if len(known):
        yield rows()


def _numbered(block, first_number: int, width: int, last: bool) -> Callable:
    """The numbers of a text's words, 0 where unknown and where a piece ends, as bytes.

    With a third column, numbers of earlier blocks, only its zeros can change. The
    ``last`` block needs no text any more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = block.value
        for batch in batches:
            _, keys, code = _language_keys(batch.column(0))
            done = []
            for lo, hi, words in words_of(batch.column(1), _WORD):
                own = _word_hashes(words, keys[code[lo:hi]])
                place = np.searchsorted(hashes, own)
                place[place == len(hashes)] = 0
                number = np.where(hashes[place] == own, place + first_number, 0)
                breaks = np.concatenate([[0], np.cumsum(_BREAKS[words.data])])
                ends = np.zeros(len(words.starts), dtype=bool)
                ends[:-1] = breaks[words.starts[1:]] > breaks[words.ends[:-1]]
                ends[words.first[1:][words.counts > 0] - 1] = True
                before = np.concatenate([[0], np.cumsum(ends)])
                out = np.zeros(len(own) + before[-1], dtype="<i4")
                out[np.arange(len(own)) + before[:-1]] = number
                edges = words.first + before[words.first]
                done.extend(out[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:]))
            numbers = pa.array(done, pa.binary())
            if width == 3:
                new, old = (raw_text(c)[0] for c in (numbers, batch.column(2)))
                _, bounds = raw_text(numbers)
                start = raw_text(batch.column(2))[1][0]
                both = new | old[start : start + len(new)]
                numbers = pa.array([both[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())
            others = [] if last else [batch.column(0), batch.column(1)]
            names = [] if last else ["lang", "text"]
            yield pa.RecordBatch.from_arrays([*others, numbers], names=[*names, "numbers"])

    return run


def _number_texts(texts: DataFrame, words: DataFrame, n_words: int, block: int) -> DataFrame:
    """``numbers`` of each text, staged."""
    context, current = texts.sparkSession.sparkContext, texts
    for begin in range(0, max(n_words, 1), block):
        wanted = words.filter((F.col("number") > begin) & (F.col("number") <= begin + block))
        hashes = np.sort(wanted.select("hash").toArrow().column(0).to_numpy())
        if not len(hashes):
            hashes = np.zeros(1, dtype=np.int64)
        last = begin + block >= n_words
        run = _numbered(context.broadcast(hashes), begin + 1, len(current.columns), last)
        kind = "numbers binary" if last else "lang string, text string, numbers binary"
        current = stage(current.mapInArrow(run, kind), "numbered-texts")
    return current


# Counting quotient filters


class Packing:
    """Runs of n word numbers of ``bits`` bits each, as a permuted high and low part.

    The high part holds two words, the low part the rest. Both steps of the
    permutation can be taken back, so a run is known by its place and its remainder.
    """

    _ODD = (_U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F))
    _UNDO = tuple(_U64(pow(int(x), -1, 1 << 64)) for x in _ODD)

    def __init__(self, n: int, bits: int, quotient_bits: int):
        self.n, self.bits = n, bits
        self.high_bits, self.low_bits = 2 * bits, (n - 2) * bits
        self.quotient_bits = min(quotient_bits, self.high_bits)
        self.rest_bits = self.high_bits - self.quotient_bits
        self._high = _U64((1 << self.high_bits) - 1)
        self._low = _U64((1 << self.low_bits) - 1)
        self._shift = _U64(bits)

    def permute(self, high: np.ndarray, low: np.ndarray | None):
        high = (high * self._ODD[0]) & self._high
        high = high ^ (high >> self._shift)
        high = (high * self._ODD[1]) & self._high
        if low is None:
            return high, None
        low = low ^ (mixed(high) & self._low)
        return high ^ (mixed(low) & self._high), low

    def invert(self, high: np.ndarray, low: np.ndarray | None):
        if low is not None:
            high = high ^ (mixed(low) & self._high)
            low = low ^ (mixed(high) & self._low)
        high = (high * self._UNDO[1]) & self._high
        high = high ^ (high >> self._shift)
        return (high * self._UNDO[0]) & self._high, low

    def words(self, high: np.ndarray, low: np.ndarray | None) -> np.ndarray:
        """Word numbers, one row per run."""
        one = _U64((1 << self.bits) - 1)
        columns = [high >> self._shift, high & one]
        if self.n == 3:
            columns.append(low)
        elif self.n == 4:
            columns += [low >> self._shift, low & one]
        return np.stack(columns, axis=1).astype(np.int32)


def _narrow(bits: int) -> np.dtype:
    size = next(s for s in (1, 2, 4, 8) if 8 * s >= bits)
    return np.dtype(f"<u{size}")


class QuotientFilter:
    """Sorted distinct permuted runs with their counts."""

    def __init__(self, packing: Packing, high: np.ndarray, low: np.ndarray | None, counts: np.ndarray | None):
        if low is None and counts is None:
            high = np.sort(high)
        else:
            order = np.argsort(high, kind="stable") if low is None else np.lexsort((low, high))
            high = high[order]
            low = None if low is None else low[order]
            counts = None if counts is None else counts[order]
        new = np.ones(len(high), dtype=bool)
        new[1:] = high[1:] != high[:-1]
        if low is not None:
            new[1:] |= low[1:] != low[:-1]
        heads = np.flatnonzero(new)
        self.packing, self.high = packing, high[heads]
        self.low = None if low is None else low[heads]
        sizes = np.diff(np.append(heads, len(high)))
        if counts is not None:
            sizes = np.add.reduceat(counts, heads) if len(heads) else counts
        self.counts = sizes.astype(np.int64)

    def __len__(self) -> int:
        return len(self.high)

    @classmethod
    def merged(cls, packing: Packing, filters: list[QuotientFilter]) -> QuotientFilter:
        low = None if packing.n == 2 else np.concatenate([f.low for f in filters])
        return cls(
            packing, np.concatenate([f.high for f in filters]), low,
            np.concatenate([f.counts for f in filters]),
        )

    def rows(self) -> pa.RecordBatch:
        """One row per bucket: remainders and counts in the fewest bytes that hold them."""
        packing = self.packing
        bucket = (self.high >> _U64(packing.rest_bits)).astype(np.int64)
        rest = (self.high & _U64((1 << packing.rest_bits) - 1)).astype(_narrow(packing.rest_bits))
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(cuts[1:], len(bucket))
        low = None if self.low is None else self.low.astype(_narrow(packing.low_bits))
        counts = []
        for a, b in zip(cuts, ends):
            own = self.counts[a:b]
            counts.append(own.astype(_narrow(int(own.max()).bit_length())).tobytes())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[cuts].astype(np.int32)),
                pa.array([rest[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                pa.array([b"" if low is None else low[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                pa.array(counts, pa.binary()),
            ],
            names=["bucket", "rest", "low", "counts"],
        )

    @classmethod
    def of_rows(cls, packing: Packing, table: pa.Table) -> QuotientFilter:
        """The merged filter of one bucket."""
        kind = _narrow(packing.rest_bits)
        rest = [np.frombuffer(x, dtype=kind) for x in table.column("rest").to_pylist()]
        counts = []
        for own, raw in zip(rest, table.column("counts").to_pylist()):
            counts.append(np.frombuffer(raw, dtype=f"<u{len(raw) // len(own)}").astype(np.int64))
        bucket = _U64(table.column("bucket")[0].as_py()) << _U64(packing.rest_bits)
        low = None
        if packing.n > 2:
            raw = b"".join(table.column("low").to_pylist())
            low = np.frombuffer(raw, dtype=_narrow(packing.low_bits)).astype(_U64)
        return cls(packing, np.concatenate(rest).astype(_U64) | bucket, low, np.concatenate(counts))


# Counts of runs


def _run_hash(high: np.ndarray, low: np.ndarray | None) -> np.ndarray:
    return mixed(high) if low is None else mixed(high ^ mixed(low + _U64(1)))


def _runs(numbers: np.ndarray, n: int, bits: int, maps: dict[int, np.ndarray]):
    """High and low part of every run of n numbered words that may be frequent."""
    numbers, shift = numbers.astype(_U64), _U64(bits)
    known = numbers > 0
    hit = known[1:] & known[:-1]
    pairs = (numbers[:-1] << shift) | numbers[1:]
    if n == 2:
        return pairs[hit], None
    at = np.flatnonzero(hit)
    frequent = np.zeros(len(hit), dtype=bool)
    frequent[at[may_hold(maps[2], _run_hash(pairs[at], None))]] = True
    at = np.flatnonzero(frequent[1:] & frequent[:-1])
    if n == 3:
        return pairs[at], numbers[at + 2]
    hit = may_hold(maps[3], _run_hash(pairs[at], numbers[at + 2]))
    frequent[:] = False
    frequent[at[hit]] = True
    at = np.flatnonzero(frequent[1:] & frequent[:-1])
    return pairs[at], pairs[at + 2]


def _counted(packing: Packing, maps) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {n: m.value for n, m in maps.items()}
        filters: list[QuotientFilter] = []
        held: list[tuple] = []

        def close() -> None:
            if held:
                low = None if packing.n == 2 else np.concatenate([h[1] for h in held])
                filters.append(QuotientFilter(packing, np.concatenate([h[0] for h in held]), low, None))
                held.clear()

        for batch in batches:
            content, bounds = raw_text(batch.column(0))
            numbers = content[bounds[0] : bounds[-1]].view("<i4")
            for a in range(0, len(numbers), HELD_RUNS):
                part = numbers[a : a + HELD_RUNS + packing.n - 1]
                if len(part) >= packing.n:
                    held.append(packing.permute(*_runs(part, packing.n, packing.bits, known)))
                if sum(len(h[0]) for h in held) >= HELD_RUNS:
                    close()
                if sum(map(len, filters)) >= HELD_ENTRIES:
                    filters = [QuotientFilter.merged(packing, filters)]
                    if 2 * len(filters[0]) >= HELD_ENTRIES:
                        yield filters[0].rows()
                        filters = []
        close()
        if filters:
            merged = QuotientFilter.merged(packing, filters)
            if len(merged):
                yield merged.rows()

    return run


def _frequent(packing: Packing, min_count: int) -> Callable[[pa.Table], pa.Table]:
    """Words, count and hash of a bucket's frequent runs."""

    def run(table: pa.Table) -> pa.Table:
        merged = QuotientFilter.of_rows(packing, table)
        keep = merged.counts >= min_count
        low = None if merged.low is None else merged.low[keep]
        high, low = packing.invert(merged.high[keep], low)
        words = packing.words(high, low)
        offsets = np.arange(len(words) + 1, dtype=np.int32) * packing.n
        return pa.table(
            {
                "words": pa.ListArray.from_arrays(offsets, words.reshape(-1)),
                "a": merged.counts[keep],
                "hash": _run_hash(high, low).view(np.int64),
            }
        )

    return run


def _hashes(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy().view(_U64)


def count_runs(numbers: DataFrame, n_words: int, min_count: int, longest: int) -> DataFrame:
    """``words`` (numbers) and count ``a`` of every frequent run of 2 to ``longest`` words."""
    context = numbers.sparkSession.sparkContext
    bits = max(n_words.bit_length(), 1)
    entries = max(estimated_bytes(numbers) / 4, 1)
    quotient_bits = int(np.clip(np.ceil(np.log2(entries / BUCKET_SIZE)), 8, 22))
    maps, levels = {}, []
    for n in range(2, longest + 1):
        packing = Packing(n, bits, quotient_bits)
        filters = numbers.mapInArrow(
            _counted(packing, maps), "bucket int, rest binary, low binary, counts binary"
        )
        merged = filters.groupBy("bucket").applyInArrow(
            _frequent(packing, min_count), "words array<int>, a long, hash long"
        )
        level = stage(merged, "frequent-runs")
        levels.append(level.select("words", "a"))
        if n < longest:
            maps[n] = context.broadcast(bit_map_of(level.select("hash"), _hashes, MAP_BITS))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


# Scores


def _with_counts(rows: DataFrame, counts: DataFrame, part: str, name: str) -> DataFrame:
    """Add to each row how often its words ``part`` occur."""
    named = counts.select(F.col("words").alias(part), F.col("a").alias(name))
    if fits_broadcast(counts):
        return rows.join(F.broadcast(named), part)
    # A frequent word is a part of very many phrases.
    salted = named.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    own = F.pmod(F.xxhash64("words", "k"), F.lit(SALTS)).cast("int")
    return rows.withColumn("salt", own).join(salted, [part, "salt"]).drop("salt")


def _wide(number: Column) -> Column:
    return number.cast("decimal(20,0)")


def _scored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each phrase: ``l``, ``r`` and ``score``."""
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select(
        "words", "a", "k",
        F.slice("words", 1, F.col("k")).alias("left"),
        F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("right"),
    )
    cuts = _with_counts(_with_counts(cuts, counts, "left", "l"), counts, "right", "r")
    cuts = cuts.select("words", "a", "k", _wide(F.col("a")).alias("x"), "l", "r",
                       (_wide(F.col("l")) + _wide(F.col("r"))).alias("y"))
    score = F.expr("CAST(2000000 AS DECIMAL(7,0)) * x div y").cast("long")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("words", "a").agg(lowest).select("words", "a", "cut.score", "cut.l", "cut.r")


def _parts(phrases: DataFrame) -> DataFrame:
    """For each run inside a longer phrase the count of the most frequent such phrase."""
    longer = phrases.filter(F.size("words") > 2)
    inside = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), "
        "m -> transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m))))"
    )
    return longer.select(F.explode(inside).alias("words"), "a").groupBy("words").agg(F.max("a").alias("longer"))


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """The best of each language, first within slices, so no task gets all phrases."""

    def cut(part: DataFrame, *group: str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"), "phrase")
        return part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    return cut(cut(sliced, "lang", "slice").drop("rank", "slice"), "lang")


def mine_phrases(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    top: int = TOP,
    inside: int = INSIDE,
    word_block: int = WORD_BLOCK,
) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases have 2 to ``longest`` words (4 at most) and occur a >= ``min_count`` times.
    Cut in two parts that occur l and r times a phrase scores floor(2000000 a / (l + r)),
    and the lowest cut counts. A phrase goes if a longer one that holds its words occurs
    at least ``inside`` per cent as often. ``n``: words of the language.
    """
    if not 2 <= longest <= 4:
        raise ValueError("phrases have two to four words")
    texts = docs.select(
        F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text")
    )
    tallied = texts.mapInArrow(_tally, "lang string, word string, hash long, f long")
    words = stage(
        tallied.groupBy("lang", "word", "hash").agg(F.sum("f").alias("f")), "word-counts"
    )
    totals = stage(words.groupBy("lang").agg(F.sum("f").alias("n")), "words-by-language")
    frequent = stage(words.filter(F.col("f") >= min_count), "frequent-words")
    n_words = frequent.count()
    numbered = stage(
        number_rows(frequent.withColumn("all", F.lit(0)), ["all"], ["hash"], "number", n_words).select(
            F.col("number").cast("int").alias("number"), "lang", "word", "hash", "f"
        ),
        "numbered-words",
    )
    numbers = _number_texts(texts, numbered, n_words, word_block)
    phrases = stage(count_runs(numbers, n_words, min_count, longest), "phrases")
    single = numbered.select(F.array("number").alias("words"), F.col("f").alias("a"))
    counts = stage(single.unionByName(phrases), "run-counts")

    parts = stage(_parts(phrases), "parts")
    is_part = F.lit(100) * _wide(F.col("longer")) >= F.lit(inside) * _wide(F.col("a"))
    kept = phrases.join(sized(parts), "words", "left").filter(F.col("longer").isNull() | ~is_part)
    scored = stage(_scored(kept.select("words", "a"), counts), "scored-phrases")

    names = numbered.select("number", "lang", "word")
    spelled = (
        scored.select("words", F.posexplode("words").alias("at", "number"))
        .join(sized(names, n_words), "number")
        .groupBy("words")
        .agg(
            F.first("lang").alias("lang"),
            F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled"),
        )
        .select("words", "lang", F.array_join(F.col("spelled.word"), " ").alias("phrase"))
    )
    rows = scored.join(spelled, "words").select("lang", "phrase", "a", "l", "r", "score")
    best = _ranked(rows, top)
    return best.join(sized(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
