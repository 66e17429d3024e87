"""Passages that a document repeats from documents with smaller ids, cut out exactly.

Suffixes are sorted only through their first ``WINDOW`` bytes, by passes over ever
longer prefixes, and a pass goes on with what still has a double:

Of equal texts only the one with the smallest id is sorted; the others are lost whole.

1. Of the suffixes only anchors are dealt: in each window of 50 bytes the run of
   ``GRAM`` bytes with the smallest hash. What a window's anchor is depends on the
   window alone, so equal windows have equal anchors at the same place. Digits of the
   anchors' hashes are sorted in buckets; a bit map tells which digits repeat.
2. Neighbouring windows with one anchor make a unit. Units whose anchor repeats are
   grouped by all their bytes: in a group, whoever has not the smallest id repeats
   all windows of the unit.
3. Where units of one anchor differ, one of each kind is sorted by its windows, the
   full 50 bytes; equal groups are exactly the repeated windows.

Nothing is shuffled for a text whose anchors occur once. Bit maps only save work:
they have a fixed size, never miss a repeat, and a false hit is sorted out by the
next pass. Groups are counted before they are shuffled. An anchor with very many
different units is dealt by its windows instead, of which a task sends the smallest id.

Bytes are compared by 64-bit hashes. Odd rows: a NULL text is empty. A row without
id neither loses bytes nor costs others theirs. Rows of one id cost one another
nothing; each is judged against smaller ids. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.llm.arrays import Sums, mixed, raw_text
from vitaelake.llm.bitmaps import bit_map_of, joined_parts, may_hold
from vitaelake.sources.staging import estimated_bytes, fits_broadcast, sized, stage

_U64 = np.uint64

WINDOW = 50
#: Bytes of an anchor. Shorter ones are fewer but repeat by chance.
GRAM = 24
#: log2 of the bits in a bit map: 32 MB at most.
MAP_BITS = 28
#: Anchors or kinds of units that a bucket is meant to hold.
BUCKET_SIZE = 1 << 17
#: Bytes that are hashed at a time, few enough to stay in a core's cache.
PIECE_BYTES = 1 << 18
#: Anchors that a task holds before it hands them on.
HELD = 1 << 19
#: An anchor with more kinds of units than this is dealt by windows; no more than
#: HOT_ANCHORS of them, as the limit grows with the kinds.
HOT_KINDS, HOT_ANCHORS = 1 << 16, 1 << 20
#: A unit with more copies than this is joined by broadcast.
HOT_COPIES = 1 << 16

_SPAN = "struct<begin: bigint, end: bigint>"
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_LENGTHS = _U64(0xD1342543DE82EF95)
_OFFSETS = _U64(0xA0761D6478BD642F)
_ANCHORS = _U64(0xE7037ED1A0B428DB)


@dataclass
class _Units:
    """Runs of windows with one anchor: rows of the batch, hashes, and their window starts."""

    row: np.ndarray
    gram: np.ndarray
    unit: np.ndarray
    begin: np.ndarray  # in the text
    at: np.ndarray  # in ``data``
    n: np.ndarray  # windows
    data: np.ndarray


def _chunks(column: pa.Array, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Bytes, bounds, first row and offset in it; a long text comes in overlapping parts."""
    content, bounds = raw_text(column)
    lo, rows = 0, len(bounds) - 1
    while lo < rows:
        hi = int(np.searchsorted(bounds, bounds[lo] + PIECE_BYTES, side="right")) - 1
        hi = min(max(hi, lo + 1), rows)
        begin, end = int(bounds[lo]), int(bounds[hi])
        if hi - lo > 1 or end - begin <= PIECE_BYTES:
            yield content[begin:end], bounds[lo : hi + 1] - begin, lo, 0
        else:
            for a in range(begin, end, PIECE_BYTES):
                part = content[a : min(a + PIECE_BYTES + window - 1, end)]
                yield part, np.array([0, len(part)]), lo, a - begin
        lo = hi


def _units(column: pa.Array, window: int, gram: int) -> Iterator[_Units]:
    low = _U64((1 << 21) - 1)  # positions within a chunk
    for data, bounds, row, offset in _chunks(column, window):
        if len(data) < window:
            continue
        sums = Sums(data)
        grams = mixed(sums.all_of(gram))
        least, width, span = grams & ~low, 1, window - gram + 1
        least |= np.arange(len(grams), dtype=_U64)
        while width < span:
            step = min(width, span - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        anchors = (least & low).astype(np.int64)
        inside = np.zeros(len(data) + 1, dtype=np.int64)
        full = np.diff(bounds) >= window
        np.add.at(inside, bounds[:-1][full], 1)
        np.add.at(inside, bounds[1:][full] - window + 1, -1)
        begins = np.flatnonzero(np.cumsum(inside[: len(anchors)]) > 0)
        if not len(begins):
            continue
        anchors = anchors[begins]
        heads = np.flatnonzero(np.diff(anchors, prepend=-1))
        at = begins[heads]
        n = np.concatenate([begins[heads[1:] - 1], begins[-1:]]) + 1 - at
        text = np.searchsorted(bounds, at, side="right") - 1
        shape = (n.astype(_U64) * _LENGTHS) ^ ((anchors[heads] - at).astype(_U64) * _OFFSETS)
        # Anchors are smallest hashes, so these crowd at the low end; mixed anew they are even.
        yield _Units(
            row + text, mixed(grams[anchors[heads]] ^ _ANCHORS), mixed(sums.between(at, at + n - 1 + window) ^ mixed(shape)),
            at - bounds[text] + offset, at, n, data,
        )


def _digits(window: int, gram: int, bucket_bits: int) -> Callable:
    """By bucket the anchors of a task: those of one row, and those of several."""

    def rows(grams: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes, owner = np.concatenate(grams), np.concatenate(owners)
        order = np.argsort(hashes)
        hashes, owner = hashes[order], owner[order]
        heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        several = np.minimum.reduceat(owner, heads) != np.maximum.reduceat(owner, heads)
        hashes = hashes[heads]
        bucket = hashes >> _U64(64 - bucket_bits)
        digits = ((hashes >> _U64(32 - bucket_bits)) & _U64(0xFFFFFFFF)).astype("<u4")
        cuts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] + _U64(1)))
        ends = np.append(cuts[1:], len(hashes))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[cuts].astype(np.int32)),
                pa.array([digits[a:b][~several[a:b]].tobytes() for a, b in zip(cuts, ends)]),
                pa.array([digits[a:b][several[a:b]].tobytes() for a, b in zip(cuts, ends)]),
            ],
            names=["bucket", "once", "often"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, owners, held, seen = [], [], 0, 0
        for batch in batches:
            for units in _units(batch.column(0), window, gram):
                grams.append(units.gram)
                owners.append(units.row + seen)
                held += len(units.gram)
                if held > HELD:
                    yield from rows(grams, owners)
                    grams, owners, held = [], [], 0
            seen += batch.num_rows
        if held:
            yield from rows(grams, owners)

    return run


def _repeated_digits(bucket_bits: int, map_bits: int) -> Callable[[pa.Table], pa.Table]:
    """The bucket's part of the bit map of repeated anchors."""

    def run(table: pa.Table) -> pa.Table:
        once, often = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), dtype="<u4") for c in ("once", "often")
        )
        every = np.sort(np.concatenate([once, often, often]))
        bits = np.zeros(1 << (map_bits - bucket_bits), dtype=bool)
        bits[every[1:][every[1:] == every[:-1]] >> np.uint32(32 - map_bits + bucket_bits)] = True
        return pa.table(
            {"bucket": table.column("bucket")[:1], "bits": pa.array([np.packbits(bits).tobytes()])}
        )

    return run


def _candidates(repeated, window: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for units in _units(batch.column(0), window, gram):
                hit = may_hold(repeated.value, units.gram)
                row = pa.array(units.row[hit])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(x[hit].view(np.int64)) for x in (units.gram, units.unit)),
                        batch.column(1).take(row), batch.column(2).take(row),
                        pa.array(units.begin[hit]), pa.array(units.n[hit], pa.int32()),
                    ],
                    names=["gram", "unit", "id", "content", "begin", "n"],
                )

    return run


def _kind_hash(unit: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return mixed(unit ^ mixed(owner.view(_U64)))


def _kind_hashes(batch: pa.RecordBatch) -> np.ndarray:
    unit, owner = (batch.column(i).to_numpy() for i in (0, 1))
    return _kind_hash(unit.view(_U64), owner)


def _kind_type(window: int, gram: int) -> np.dtype:
    width = 2 * window - gram
    return np.dtype([("unit", "<u8"), ("id", "<i8"), ("n", "u1"), ("bytes", "u1", (width,))])


_WINDOW_TYPE = np.dtype([("unit", "<u8"), ("id", "<i8"), ("at", "u1"), ("hash", "<u8")])


def _window_rows(kinds: np.ndarray, window: int) -> np.ndarray:
    """Every window of the kinds, with its hash."""
    out = []
    for i in range(0, len(kinds), 4096):
        part = kinds[i : i + 4096]
        width = part["bytes"].shape[1]
        sums = Sums(np.ascontiguousarray(part["bytes"]).reshape(-1))
        kind = np.repeat(np.arange(len(part)), part["n"])
        first = np.cumsum(part["n"], dtype=np.int64) - part["n"]
        at = np.arange(len(kind)) - np.repeat(first, part["n"])
        rows = np.empty(len(kind), dtype=_WINDOW_TYPE)
        rows["unit"], rows["id"], rows["at"] = part["unit"][kind], part["id"][kind], at
        rows["hash"] = mixed(sums.between(kind * width + at, kind * width + at + window))
        out.append(rows)
    return np.concatenate(out) if out else np.empty(0, dtype=_WINDOW_TYPE)


def _least(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows by hash, and for each the smallest id with its window."""
    rows = rows[np.argsort(rows["hash"], kind="stable")]
    heads = np.flatnonzero(np.concatenate([[True], rows["hash"][1:] != rows["hash"][:-1]]))
    sizes = np.diff(np.append(heads, len(rows)))
    return rows, np.repeat(np.minimum.reduceat(rows["id"], heads), sizes) if len(rows) else rows["id"]


def _losses(rows: np.ndarray) -> dict[str, np.ndarray]:
    """By unit and id the lost windows, as bits; a pair may come more than once."""
    return {
        "unit": rows["unit"].view(np.int64),
        "first": rows["id"],
        "lost": np.int64(1) << rows["at"].astype(np.int64),
    }


def _kinds(wanted, hot, window: int, gram: int, bucket_bits: int) -> Callable:
    """One unit of each kind by the anchor's bucket; those of hot anchors by windows.

    Column ``bucket`` is -1 for windows lost within the task, as (unit, id, bits).
    """

    def rows(name: str, bucket: np.ndarray, content: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(bucket, kind="stable")
        bucket, content = bucket[order], content[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-2))
        ends = np.append(cuts[1:], len(bucket))
        empty = [b""] * len(cuts)
        own = [content[a:b].tobytes() for a, b in zip(cuts, ends)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[cuts].astype(np.int32)),
                pa.array(own if name == "kinds" else empty, pa.binary()),
                pa.array(own if name == "windows" else empty, pa.binary()),
            ],
            names=["bucket", "kinds", "windows"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_type, hot_grams, shift = _kind_type(window, gram), hot.value, _U64(64 - bucket_bits)
        width = kind_type["bytes"].shape[0]
        for batch in batches:
            ids = batch.column(1).to_numpy()
            crowded = []
            for units in _units(batch.column(0), window, gram):
                owner = ids[units.row]
                hit = np.flatnonzero(may_hold(wanted.value, _kind_hash(units.unit, owner)))
                hit = hit[np.unique(np.stack([units.unit[hit], owner[hit].view(_U64)]), axis=1, return_index=True)[1]]
                kinds = np.zeros(len(hit), dtype=kind_type)
                kinds["unit"], kinds["id"], kinds["n"] = units.unit[hit], owner[hit], units.n[hit]
                padded = np.concatenate([units.data, np.zeros(width, dtype=np.uint8)])
                kinds["bytes"] = padded[units.at[hit][:, None] + np.arange(width)]
                is_hot = np.isin(units.gram[hit], hot_grams)
                yield from rows("kinds", (units.gram[hit][~is_hot] >> shift).astype(np.int64), kinds[~is_hot])
                if is_hot.any():
                    crowded.append(_window_rows(kinds[is_hot], window))
            if crowded:
                every, least = _least(np.concatenate(crowded))
                lost = every["id"] > least
                yield from rows("windows", np.full(lost.sum(), -1), every[lost])
                left = every[~lost]
                yield from rows("windows", (left["hash"] >> shift).astype(np.int64), left)

    return run


def _sorted_windows(window: int, gram: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        kinds = np.frombuffer(b"".join(table.column("kinds").to_pylist()), dtype=_kind_type(window, gram))
        windows = np.frombuffer(b"".join(table.column("windows").to_pylist()), dtype=_WINDOW_TYPE)
        every, least = _least(np.concatenate([_window_rows(np.unique(kinds), window), windows]))
        return pa.table(_losses(every[every["id"] > least]))

    return run


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows lost within a task, as rows."""
    for batch in batches:
        for content in batch.column("windows"):
            yield pa.RecordBatch.from_pydict(_losses(np.frombuffer(content.as_py(), dtype=_WINDOW_TYPE)))


def _buckets(n: float) -> int:
    """log2 of the number of buckets for ``n`` entries."""
    return int(np.clip(np.ceil(np.log2(max(n, 1) / BUCKET_SIZE)), 8, 22))


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of a text in order, those that touch made one."""
    for batch in batches:
        merged = []
        for spans in batch.column(2):
            begin, end = (spans.values.field(j).to_numpy() for j in (0, 1))
            order = np.argsort(begin, kind="stable")
            begin, reach = begin[order], np.maximum.accumulate(end[order])
            heads = np.flatnonzero(np.append(True, begin[1:] > reach[:-1]))
            tails = np.append(heads[1:], len(begin)) - 1
            merged.append([{"begin": a, "end": b} for a, b in zip(begin[heads].tolist(), reach[tails].tolist())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(merged, _SPANS)], names=["id", "content", "spans"]
        )


def _copies(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``content`` and ``n_bytes`` of texts that a smaller id has too."""
    texts = docs.select(
        F.col(key).cast("long").alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("content"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    texts = stage(texts.filter("id IS NOT NULL"), "texts")
    first = texts.groupBy("content").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    several = stage(first.filter("last > first").select("content", "first"), "copied-texts")
    return stage(
        texts.join(sized(several), "content").filter("id > first").select("id", "content", "n_bytes").distinct(),
        "copies",
    )


def repeated_spans(docs: DataFrame, key: str, text: str, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``id``, ``content`` (the text's hash) and ``spans``: runs of bytes covered by lost windows.

    Texts that lose nothing are left out. A whole text that a smaller id has too is lost
    at once, and only the first of such texts is sorted.
    """
    context = docs.sparkSession.sparkContext
    copies = _copies(docs, key, text)
    rows = docs.filter(F.col(key).isNotNull()).select(
        F.col(text).alias("text"),
        F.col(key).cast("long").alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("content"),
    )
    narrow = fits_broadcast(copies)
    rows = rows.join(F.broadcast(copies) if narrow else copies, ["id", "content"], "left_anti")
    rows = rows.select("text", "id", "content")
    if not narrow:  # the text is shuffled once, not for every pass
        rows = stage(rows, "first-texts")
    bucket_bits = _buckets(estimated_bytes(docs) / ((window - gram) / 2))
    map_bits = min(MAP_BITS, bucket_bits + 19)
    dealt = rows.mapInArrow(
        _digits(window, gram, bucket_bits), "bucket int, once binary, often binary"
    )
    bits = dealt.groupBy("bucket").applyInArrow(
        _repeated_digits(bucket_bits, map_bits), "bucket int, bits binary"
    )
    repeated = joined_parts(stage(bits, "repeated-anchors"), map_bits, map_bits - bucket_bits)
    units = stage(
        rows.mapInArrow(
            _candidates(context.broadcast(repeated), window, gram),
            "gram long, unit long, id long, content long, begin long, n int",
        ),
        "units",
    )
    kinds = stage(
        units.groupBy("unit").agg(
            F.min("id").alias("first"), F.max("id").alias("last"),
            F.min("gram").alias("gram"), F.count("*").alias("copies"),
        ),
        "kinds",
    )
    lost = stage(_lost_windows(rows, kinds, window, gram), "lost-windows")
    results = kinds.drop("gram").join(lost, ["unit", "first"], "left")
    results = results.filter("last > first OR lost IS NOT NULL").drop("last")
    results = stage(results, "kinds-with-losses")
    is_hot = F.col("copies") > HOT_COPIES
    many, few = stage(results.filter(is_hot), "hot-kinds"), results.filter(~is_hot)
    wide = ["id", "content", "begin", "n", "first", "lost"]
    own = units.drop("gram")
    if many.take(1):
        hot = own.join(sized(many), "unit").select(*wide)
        cold = own.join(sized(many), "unit", "left_anti").join(few, "unit").select(*wide)
        found = hot.unionByName(cold)
    else:
        found = own.join(few, "unit").select(*wide)
    whole = F.array(F.struct(F.col("begin"), (F.col("begin") + F.col("n") + window - 1).alias("end")))
    single = F.expr(
        f"transform(filter(sequence(0, n - 1), i -> (shiftrightunsigned(lost, i) & 1) = 1), "
        f"i -> struct(begin + i AS begin, begin + i + {window} AS end))"
    )
    spans = F.when(F.col("id") > F.col("first"), whole).when(F.col("lost").isNotNull(), single)
    lists = (
        found.filter("id > first OR lost IS NOT NULL")
        .select("id", "content", F.inline(spans.cast(f"array<{_SPAN}>")))
        .groupBy("id", "content")
        .agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    )
    united = lists.mapInArrow(_united, f"id long, content long, spans array<{_SPAN}>")
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    return united.unionByName(
        copies.filter(F.col("n_bytes") >= window).select("id", "content", all_of_it.alias("spans"))
    )


def _lost_windows(rows: DataFrame, kinds: DataFrame, window: int, gram: int) -> DataFrame:
    """By unit and its first holder the windows that this one repeats, as bits.

    Rows of other holders, which a bit map's false hits let in, are true but of no use.
    """
    spark = rows.sparkSession
    context = spark.sparkContext
    mixed_grams = stage(
        kinds.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "mixed-anchors"
    )
    total = mixed_grams.agg(F.sum("kinds")).first()[0] or 0
    if not total:
        return spark.createDataFrame([], "unit long, first long, lost long")
    limit = max(HOT_KINDS, total // HOT_ANCHORS)
    hot = [r["gram"] for r in mixed_grams.filter(F.col("kinds") > limit).select("gram").collect()]
    firsts = kinds.join(mixed_grams.select("gram"), "gram", "left_semi").select("unit", "first")
    bucket_bits = _buckets(total)
    wanted = context.broadcast(bit_map_of(firsts, _kind_hashes, min(MAP_BITS, bucket_bits + 19)))
    grams = context.broadcast(np.array(sorted(hot), dtype=np.int64).view(_U64))
    dealt = rows.mapInArrow(
        _kinds(wanted, grams, window, gram, bucket_bits), "bucket int, kinds binary, windows binary"
    )
    schema = "unit long, first long, lost long"
    if hot:
        dealt = stage(dealt, "dealt-kinds")
    lost = dealt.filter("bucket >= 0").groupBy("bucket").applyInArrow(_sorted_windows(window, gram), schema)
    if hot:
        lost = lost.unionByName(dealt.filter("bucket < 0").mapInArrow(_settled, schema))
    return lost.groupBy("unit", "first").agg(F.bit_or("lost").alias("lost"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        content, bounds = raw_text(batch.column(1))
        removed, kept = [], []
        for i, spans in enumerate(batch.column(2)):
            own = content[bounds[i] : bounds[i + 1]]
            if not spans.is_valid:
                removed.append([])
                kept.append(own.tobytes())
                continue
            begin, end = (spans.values.field(j).to_numpy() for j in (0, 1))
            edges = np.zeros(len(own) + 1, dtype=np.int64)
            np.add.at(edges, begin, 1)
            np.add.at(edges, end, -1)
            covered = np.cumsum(edges[:-1]) > 0
            turns = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
            removed.append([{"begin": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])])
            kept.append(own[~covered].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(bounds)), pa.array(removed, _SPANS), pa.array(kept, pa.binary())],
            names=["row", "n_bytes", "removed", "kept"],
        )


def remove_repeats(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Of every row: ``row`` (all columns but the text), ``n_bytes``, ``removed``, ``kept``.

    ``removed`` are the maximal runs of bytes that lie in a string of ``window`` bytes
    which also starts in a text with a smaller ``key`` (an integer); ``kept`` are the
    others, as bytes, since a cut may fall within a character.
    """
    spans = stage(repeated_spans(docs, key, text, window, gram), "repeated-spans")
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(
        F.struct(*others).alias("row"),
        F.col(text).alias("text"),
        F.col(key).cast("long").alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("content"),
    )
    small = F.broadcast(spans) if fits_broadcast(spans) else spans
    joined = rows.join(small, ["id", "content"], "left").select("row", "text", "spans")
    kind = docs.select(F.struct(*others).alias("row")).schema["row"].dataType.simpleString()
    return joined.mapInArrow(_cut, f"row {kind}, n_bytes long, removed array<{_SPAN}>, kept binary")
