"""Near-duplicate documents by SetSketch registers, confirmed on full shingle sets.

A register holds the smallest of the exponential values that the set's elements
draw for it, on a scale of powers of a base just above one and cut to 16 bits, so
the sketch of a union is the registers' maximum. Bands of registers give bucket
keys. In a bucket every set is paired with one pivot; a pair whose registers and
set sizes make the wanted similarity all but impossible (by the joint likelihood)
is put aside, the others are confirmed by the exact size of the intersection.
Where members of a pivot's buckets are then still in different components, those
outside the pivot's component meet the others in blocks of full sets, by matrix
products in tasks that return at most one link per member. So no chain of links in a
bucket is lost, no pairs are emitted, and a hot bucket is spread over many tasks.

Documents of equal sets are one node from the start. A NULL or wordless text has
an empty set and links with nothing; a row with NULL id links with nothing and has
a NULL component. A repeated id is one node with the links of all its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.llm.arrays import constants, mixed, windows, words_of
from vitaelake.llm.components import components
from vitaelake.sources.staging import sized, stage

#: Members of each side of a block of full sets, and shingles taken at once.
BLOCK = 128
BLOCK_COLUMNS = 8192

_U64 = np.uint64
_FINGER = constants(2, 307)


@dataclass(frozen=True)
class Settings:
    """Shingle length, similarity in percent, bands of registers, scale of registers.

    With 48 bands of 7 a pair at similarity 0.8 shares no bucket with a
    probability of 1e-5, a pair at 0.85 of 1e-8.
    """

    shingle_words: int = 5
    percent: int = 80
    bands: int = 48
    band_registers: int = 7
    base: float = 1.001
    rate: float = 20.0
    #: Twice the log-likelihood ratio beyond which a pair is put aside.
    certainty: float = 45.0

    @property
    def registers(self) -> int:
        return self.bands * self.band_registers


def _sketches(settings: Settings):
    draws = constants(settings.registers, 311)
    band_step = constants(settings.band_registers, 313)
    band_salt = constants(settings.bands, 317)
    top = float(1 << 16) - 1

    def registers(elements: np.ndarray, begins: np.ndarray) -> np.ndarray:
        out = np.empty((len(begins), settings.registers), dtype=_U64)
        value = np.empty_like(elements)
        for i, factor in enumerate(draws):
            np.multiply(elements, factor, out=value)
            out[:, i] = np.minimum.reduceat(value, begins)
        # The smallest of uniform values gives the smallest of exponential ones.
        uniform = (out.astype(np.float64) + 0.5) / 2.0**64
        smallest = -np.log1p(-uniform) / settings.rate
        level = np.floor(1.0 - np.log(smallest) / math.log(settings.base))
        return np.clip(level, 0.0, top).astype(np.uint16)

    def keys(table: np.ndarray) -> np.ndarray:
        grouped = table.astype(_U64).reshape(len(table), settings.bands, settings.band_registers)
        return mixed((grouped * band_step).sum(axis=2, dtype=_U64) ^ band_salt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words in words_of(batch.column(1)):
                elements, begins = windows(words.hashes, words.first, settings.shingle_words)
                full = np.flatnonzero(np.diff(begins))
                sizes = np.zeros(hi - lo, dtype=np.int64)
                prints = np.zeros((2, hi - lo), dtype=_U64)
                for i in full:
                    own = np.unique(elements[begins[i] : begins[i + 1]])
                    sizes[i] = len(own)
                    prints[0, i] = own.sum(dtype=_U64)
                    prints[1, i] = mixed(own ^ _FINGER[1]).sum(dtype=_U64)
                sketch: list[bytes | None] = [None] * (hi - lo)
                bands: list[np.ndarray | None] = [None] * (hi - lo)
                if len(full):
                    table = registers(elements, begins[full])
                    for i, row, key in zip(full, table, keys(table).view(np.int64)):
                        sketch[i], bands[i] = row.tobytes(), key
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(sizes),
                        pa.array(prints[0].view(np.int64)),
                        pa.array(prints[1].view(np.int64)),
                        pa.array(sketch, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["node", "size", "print_a", "print_b", "sketch", "bands"],
                )

    return run


_SKETCH = "size long, print_a long, print_b long, sketch binary, bands array<long>"


def log_likelihood(similarity: np.ndarray, larger, equal, smaller, u, base: float) -> np.ndarray:
    """Of register comparisons, for sets whose sizes have the shares u and 1 - u."""
    v = 1.0 - u

    def share(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0.0, 1.0) * (base - 1.0) / base) / math.log(base)

    up, down = share(u - v * similarity), share(v - u * similarity)
    tiny = 1e-12
    return (
        larger * np.log(np.maximum(up, tiny))
        + smaller * np.log(np.maximum(down, tiny))
        + equal * np.log(np.maximum(1.0 - up - down, tiny))
    )


def estimate(larger, equal, smaller, u, base: float) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of greatest joint likelihood on a grid, and that likelihood."""
    most = np.minimum(u / (1 - u), (1 - u) / u)
    grid = np.linspace(0.0, 1.0, 201)[None, :] * most[:, None]
    columns = [x[:, None] for x in (larger, equal, smaller, u)]
    values = log_likelihood(grid, *columns, base)
    best = values.argmax(axis=1)
    rows = np.arange(len(best))
    return grid[rows, best], values[rows, best]


def _plausible(settings: Settings):
    wanted = settings.percent / 100.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                size_a, size_b = (part.column(i).to_numpy() for i in (2, 3))
                a, b = (
                    np.frombuffer(b"".join(part.column(i).to_pylist()), dtype=np.uint16).reshape(
                        part.num_rows, -1
                    )
                    for i in (4, 5)
                )
                counts = [(a > b).sum(axis=1), (a == b).sum(axis=1), (a < b).sum(axis=1)]
                u = size_a / (size_a + size_b)
                found, best = estimate(*counts, u, settings.base)
                at_wanted = log_likelihood(np.full(len(u), wanted), *counts, u, settings.base)
                possible = np.minimum(size_a, size_b) * 100 >= settings.percent * np.maximum(size_a, size_b)
                likely = (found >= wanted) | (2 * (best - at_wanted) <= settings.certainty)
                kept.append(possible & likely)
            mask = pa.array(np.concatenate(kept) if kept else np.empty(0, dtype=bool))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(mask)

    return run


def _sets(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words in words_of(batch.column(1)):
                elements, begins = windows(words.hashes, words.first, shingle_words)
                sets = [np.unique(elements[a:b]).view(np.int64) for a, b in zip(begins[:-1], begins[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(sets, pa.list_(pa.int64()))],
                    names=["node", "shingles"],
                )

    return run


def _block_links(percent: int):
    """Links between the two sides of a block that join different components."""

    def run(table: pa.Table) -> pa.Table:
        outer = table.column("outer").to_numpy().astype(bool)
        label, node = table.column("label").to_pylist(), table.column("node").to_pylist()
        lists = table.column("shingles").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(len(sizes)), sizes)
        _, number, count = np.unique(
            lists.flatten().to_numpy(), return_inverse=True, return_counts=True
        )
        keep = count[number] > 1
        owner, number = owner[keep], number[keep]
        order = np.argsort(number, kind="stable")
        owner, number = owner[order], number[order]
        sides = [np.flatnonzero(outer), np.flatnonzero(~outer)]
        place = np.empty(len(sizes), dtype=np.int64)
        for side in sides:
            place[side] = np.arange(len(side))
        common = np.zeros((len(sides[0]), len(sides[1])), dtype=np.float64)
        top = int(number[-1]) + 1 if len(number) else 0
        for lo in range(0, top, BLOCK_COLUMNS):  # shingles in slices, so memory is bounded
            a, b = np.searchsorted(number, [lo, lo + BLOCK_COLUMNS])
            part, column = owner[a:b], number[a:b] - lo
            grids = []
            for side, own in zip(sides, (outer[part], ~outer[part])):
                grid = np.zeros((len(side), BLOCK_COLUMNS), dtype=np.float32)
                grid[place[part[own]], column[own]] = 1
                grids.append(grid)
            common += grids[0] @ grids[1].T
        union = sizes[sides[0]][:, None] + sizes[sides[1]][None, :] - common
        parent: dict = {}

        def root(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        out = []
        for i, j in np.argwhere(common * 100 >= union * percent):
            x, y = sides[0][i], sides[1][j]
            a, b = root(label[x]), root(label[y])
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((node[x], node[y]))
        kind = table.schema.field("node").type
        return pa.table({"a": pa.array([o[0] for o in out], kind), "b": pa.array([o[1] for o in out], kind)})

    return run


class _Search:
    """The tables of one run."""

    def __init__(self, docs: DataFrame, key: str, text: str, settings: Settings):
        self.settings = settings
        self.docs = docs.select(F.col(key).alias("node"), F.col(text).alias("text"))
        self.kind = self.docs.schema["node"].dataType.simpleString()
        self.sketches = stage(
            self.docs.mapInArrow(_sketches(settings), f"node {self.kind}, {_SKETCH}"), "sketches"
        )
        self.nodes = self.sketches.filter("size > 0 AND node IS NOT NULL")
        prints = ["size", "print_a", "print_b"]
        narrow = self.nodes.select("node", *prints)
        first = narrow.groupBy(*prints).agg(F.min("node").alias("first"), F.count("*").alias("rows"))
        repeated = first.filter("rows > 1").drop("rows")
        self.copies = stage(narrow.join(repeated, prints).filter("node <> first"), "copies")
        self.distinct = self.nodes.join(sized(self.copies), ["node", *prints], "left_anti")

    def buckets(self) -> DataFrame:
        """(key, node, pivot, rows) of each node in a bucket with others, but the pivot."""
        keyed = self.distinct.select("node", F.explode("bands").alias("key"))
        shared = keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("rows"))
        joined = keyed.join(shared.filter("rows > 1"), "key").filter("node <> pivot")
        return stage(joined.select("key", "node", "pivot", "rows"), "buckets")

    def _ids(self, pairs: DataFrame) -> DataFrame:
        both = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        return sized(stage(both, "pair-nodes"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """(a, b, similarity) of the pairs whose sketches do not rule them out."""
        pairs = stage(pairs, "pairs")
        own = self.distinct.join(self._ids(pairs), "node", "left_semi").select("node", "size", "sketch")
        sides = [own.select(*(F.col(c).alias(f"{c}_{s}") for c in own.columns)) for s in "ab"]
        sketched = pairs.join(sides[1], F.col("b") == F.col("node_b")).join(
            sides[0], F.col("a") == F.col("node_a")
        )
        likely = stage(
            sketched.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInArrow(
                _plausible(self.settings), f"a {self.kind}, b {self.kind}"
            ),
            "likely-pairs",
        )
        wanted = self.docs.join(self._ids(likely), "node", "left_semi")
        sets = stage(
            wanted.mapInArrow(
                _sets(self.settings.shingle_words), f"node {self.kind}, shingles array<long>"
            ),
            "shingles",
        )
        sides = [sets.select(F.col("node").alias(f"node_{s}"), F.col("shingles").alias(f"set_{s}")) for s in "ab"]
        joined = likely.join(sides[1], F.col("b") == F.col("node_b")).join(
            sides[0], F.col("a") == F.col("node_a")
        )
        common = F.size(F.array_intersect("set_a", "set_b"))
        counted = joined.select(
            "a", "b", common.alias("common"),
            (F.size("set_a") + F.size("set_b") - common).alias("union"),
        )
        enough = F.col("common") * 100 >= F.col("union") * self.settings.percent
        return stage(
            counted.select("a", "b", (F.col("common") / F.col("union")).alias("similarity"), enough.alias("linked")),
            "confirmed",
        )

    def rest(self, buckets: DataFrame, labels: DataFrame) -> DataFrame:
        """(a, b): links that join components within the buckets of one pivot.

        Members outside the pivot's component meet all members, in blocks of both,
        and a block returns no more links than it has members.
        """
        groups = buckets.groupBy("pivot", "node").agg(F.max("rows").alias("rows"))
        pivot_labels = labels.select(
            F.col("node").alias("pivot"), F.col("component").alias("pivot_component")
        )
        named = groups.join(labels, "node", "left").join(pivot_labels, "pivot", "left").select(
            "pivot", "node",
            F.coalesce("component", "node").alias("label"),
            F.coalesce("pivot_component", "pivot").alias("main"),
        )
        outside = F.sum((F.col("label") != F.col("main")).cast("long"))
        open_ = named.groupBy("pivot").agg(outside.alias("outside"), F.count("*").alias("all"))
        # The pivot itself has met everyone; one member alone has nobody left to meet.
        open_ = open_.filter("outside > 0 AND all > 1").select(
            "pivot",
            F.ceil(F.col("outside") / BLOCK).cast("int").alias("outside_blocks"),
            F.ceil(F.col("all") / BLOCK).cast("int").alias("all_blocks"),
        )
        members = stage(named.join(open_, "pivot"), "open-members")
        ids = sized(stage(members.select("node").distinct(), "open-nodes"))
        sets = self.docs.join(ids, "node", "left_semi").mapInArrow(
            _sets(self.settings.shingle_words), f"node {self.kind}, shingles array<long>"
        )

        def dealt(side: DataFrame, outer: bool) -> DataFrame:
            own, others = ("outside_blocks", "all_blocks") if outer else ("all_blocks", "outside_blocks")
            mine = F.pmod(F.xxhash64("node"), F.col(own)).cast("int")
            other = F.explode(F.sequence(F.lit(0), F.col(others) - 1))
            x, y = (mine, other) if outer else (other, mine)
            return side.select(
                "pivot", "node", "label", F.lit(outer).alias("outer"), x.alias("x"), y.alias("y")
            )

        both = dealt(members.filter("label <> main"), True).union(dealt(members, False))
        blocks = both.join(sets, "node")
        return stage(
            blocks.groupBy("pivot", "x", "y").applyInArrow(
                _block_links(self.settings.percent), f"a {self.kind}, b {self.kind}"
            ),
            "open-links",
        )


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """key, n_shingles, component_id and kept (the component's smallest id) of every row."""
    search = _Search(docs, key, text, settings)
    buckets = search.buckets()
    star = search.confirmed(
        buckets.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    )
    copies = search.copies.select(F.col("first").alias("a"), F.col("node").alias("b"))
    links = copies.union(star.filter("linked").select("a", "b"))
    labels = stage(components(links, "a", "b"), "components")
    more = search.rest(buckets, labels)
    if not more.isEmpty():
        whole = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
        labels = stage(components(whole.union(more), "a", "b"), "components")
    rows = search.sketches.select("node", "size").join(labels, "node", "left")
    component = F.coalesce("component", "node")
    return rows.select(
        F.col("node").alias(key),
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        (F.col("node").isNull() | (component == F.col("node"))).alias("kept"),
    )
