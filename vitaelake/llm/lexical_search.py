"""The best documents for each of many items, found in trees of document vectors.

Documents are reduced to the terms that occur in items, and a document's terms are
put in order of falling document frequency. Sorted by these vectors, documents that
begin alike share the paths of a trie. A node knows for every term of its subtree
the largest frequency, and the smallest ``m``; as a score grows with the frequency
and falls with ``m``, both bound every score below the node. An item descends from
the root, best bound first, and leaves out each subtree that cannot reach its k-th
best score so far. Paths are followed until at most ``LEAF`` documents are left.

Documents never leave their task: it holds one tree of a bounded number of vectors
at a time, carries the k best of every item from tree to tree, and hands on these.
Items are taken in blocks of ``block_terms`` terms, one pass over the documents each.

Terms are maximal runs of letters, digits and characters above ASCII, A-Z
lower-cased, and known by 64-bit hashes. With N documents that have a term, L terms
in all, n in the document, df documents with the term and tf occurrences there:
w = floor(1000 ln((2N+2)/(2df+1))), m = 10 + 90 n N div L, and a score is the sum of
w * (10^9 tf div (1000 tf + 8 m)) over the distinct terms of the item.

Odd rows: a NULL or empty text has no term, and an item without terms finds nothing.
Rows of one item id, NULL among them, are one item with the terms of all of them.
A document without id counts in N, L and df but is never listed; one that is there
twice is listed twice. Equal scores go by ascending id. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitaelake.llm.arrays import ALPHANUMERIC, words_of
from vitaelake.sources.staging import stage

TOP = 10
#: A leaf holds at most so many documents, or more if their vectors are equal.
LEAF = 32
#: A tree holds at most so many documents and term entries (but one document at least).
TREE_DOCS, TREE_ENTRIES = 4096, 1 << 20
#: Terms of items that one pass over the documents looks for, 8 bytes each.
BLOCK_TERMS = 1 << 20
#: Slices in which an item's candidates are ranked before the last ranking.
SLICES = 64

_VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"
_FOUND = "item int, doc_id long, score long"


def _item_blocks(items: DataFrame, key: str, text: str, size: int) -> Iterator[tuple[list, list]]:
    """Ids and distinct term hashes of the items, a bounded number of terms at a time."""
    texts = items.groupBy(F.col(key).alias("id")).agg(
        F.concat_ws(" ", F.collect_list(F.col(text))).alias("text")
    )
    ids: list = []
    terms: list[np.ndarray] = []
    held = 0
    for row in texts.toLocalIterator():
        words = next(words_of(pa.array([row["text"]]), ALPHANUMERIC))[2]
        own = np.unique(words.hashes)
        if held and held + len(own) > size:
            yield ids, terms
            ids, terms, held = [], [], 0
        if len(own):
            ids.append(row["id"])
            terms.append(own)
            held += len(own)
    if ids:
        yield ids, terms


def _vectors(known) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each document the number of terms, and the known ones with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = known.value
        for batch in batches:
            for lo, hi, words in words_of(batch.column(1), ALPHANUMERIC):
                at = np.searchsorted(hashes, words.hashes)
                at[at == len(hashes)] = 0
                hit = np.flatnonzero(hashes[at] == words.hashes)
                doc = np.searchsorted(words.first, hit, side="right") - 1
                pairs, counts = np.unique(doc * len(hashes) + at[hit], return_counts=True)
                begins = np.searchsorted(pairs, np.arange(hi - lo + 1) * len(hashes))
                offsets = pa.array(begins, pa.int32())
                terms = pa.array(pairs % len(hashes), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(words.counts, pa.int64()),
                        pa.ListArray.from_arrays(offsets, terms),
                        pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                    ],
                    names=["doc_id", "n", "terms", "counts"],
                )

    return run


def _gain(tf: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class _Tree:
    """A trie of vectors, documents numbered in the order of its paths."""

    def __init__(
        self, ids: np.ndarray, m: np.ndarray, first: np.ndarray, ranks: np.ndarray, tf: np.ndarray
    ):
        # Big-endian bytes compare like the sequences of numbers.
        raw = ranks.astype(">u4").tobytes()
        paths = [raw[4 * a : 4 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        order = np.array(sorted(range(len(ids)), key=paths.__getitem__), dtype=np.int64)
        sizes = np.diff(first)[order]
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        moved = np.repeat(first[:-1][order] - self.first[:-1], sizes) + np.arange(self.first[-1])
        self.ids, self.m = ids[order], m[order]
        self.ranks, self.tf = ranks[moved], tf[moved]
        self.gains = _gain(self.tf, np.repeat(self.m, sizes))
        self.spans: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self._branch()
        self._bounds()

    def _add(self, lo: int, hi: int) -> int:
        self.spans.append((lo, hi))
        self.children.append([])
        return len(self.spans) - 1

    def _branch(self) -> None:
        open_nodes = [(self._add(0, len(self.ids)), 0)]
        while open_nodes:
            node, depth = open_nodes.pop()
            lo, hi = self.spans[node]
            while hi - lo > LEAF:
                at = self.first[lo:hi] + depth
                ended = at >= self.first[lo + 1 : hi + 1]
                step = np.where(ended, -1, self.ranks[np.minimum(at, len(self.ranks) - 1)])
                cuts = np.flatnonzero(np.diff(step)) + 1
                if len(cuts):
                    self._split(node, depth, lo + np.concatenate([[0], cuts, [hi - lo]]), open_nodes)
                    break
                if ended[0]:  # all alike
                    break
                depth += 1

    def _split(self, node: int, depth: int, edges: np.ndarray, open_nodes: list) -> None:
        """Children of more than a leaf's documents by themselves, small neighbours together."""
        begin = int(edges[0])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b - a > LEAF or b - begin > LEAF:
                if begin < a:
                    self.children[node].append(self._add(begin, a))
                begin = a
            if b - a > LEAF:
                child = self._add(a, b)
                self.children[node].append(child)
                open_nodes.append((child, depth + 1))
                begin = b
        if begin < edges[-1]:
            self.children[node].append(self._add(begin, int(edges[-1])))

    def _bounds(self) -> None:
        """By node the ranks below it and the most that each can gain."""
        held: list = [None] * len(self.spans)
        self.below: list = [None] * len(self.spans)
        for node in range(len(self.spans) - 1, -1, -1):  # children come after their parent
            lo, hi = self.spans[node]
            if self.children[node]:
                parts = [held[c] for c in self.children[node]]
                ranks = np.concatenate([p[0] for p in parts])
                tf = np.concatenate([p[1] for p in parts])
                for c in self.children[node]:
                    held[c] = None
            else:
                a, b = self.first[lo], self.first[hi]
                ranks, tf = self.ranks[a:b], self.tf[a:b]
            order = np.argsort(ranks, kind="stable")
            ranks, tf = ranks[order], tf[order]
            heads = np.flatnonzero(np.diff(ranks, prepend=-1))
            held[node] = ranks[heads], np.maximum.reduceat(tf, heads)
            self.below[node] = held[node][0], _gain(held[node][1], self.m[lo:hi].min())

    def search(self, weights: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int):
        """The k best (scores, ids), ``weights`` by rank, of these documents and ``best``."""

        def bound(node: int) -> int:
            ranks, gains = self.below[node]
            return int(weights[ranks] @ gains)

        stack = [(bound(0), 0)]
        while stack:
            most, node = stack.pop()
            least = int(best[0][-1]) if len(best[0]) == k else 1
            if most < least:
                continue
            if self.children[node]:
                stack.extend(sorted((bound(c), c) for c in self.children[node]))
                continue
            lo, hi = self.spans[node]
            a, b = self.first[lo], self.first[hi]
            gained = weights[self.ranks[a:b]] * self.gains[a:b]
            scores = np.add.reduceat(gained, self.first[lo:hi] - a)
            reach = np.flatnonzero(scores >= least)
            if len(reach):
                scores = np.concatenate([best[0], scores[reach]])
                ids = np.concatenate([best[1], self.ids[lo:hi][reach]])
                order = np.lexsort((ids, -scores))[:k]
                best = scores[order], ids[order]
        return best


def _trees(batches: Iterator[pa.RecordBatch], rank_of: np.ndarray, n_docs: int, n_terms: int):
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        n = batch.column(1).to_numpy()
        first = batch.column(2).offsets.to_numpy().astype(np.int64)
        ranks = rank_of[batch.column(2).values.to_numpy()]
        tf = batch.column(3).values.to_numpy().astype(np.int64)
        offset = batch.column(3).offsets.to_numpy()[0] - first[0]
        m = 10 + 90 * n * n_docs // n_terms
        lo = 0
        while lo < len(ids):
            hi = int(np.searchsorted(first, first[lo] + TREE_ENTRIES, side="right")) - 1
            hi = min(max(hi, lo + 1), lo + TREE_DOCS, len(ids))
            a, b = first[lo], first[hi]
            doc = np.repeat(np.arange(hi - lo), np.diff(first[lo : hi + 1]))
            order = np.lexsort((ranks[a:b], doc))
            yield _Tree(
                ids[lo:hi], m[lo:hi], first[lo : hi + 1] - a,
                ranks[a:b][order], tf[a + offset : b + offset][order],
            )
            lo = hi


def _searched(model, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of, first, ranks, own, n_docs, n_terms = model.value
        none = np.empty(0, dtype=np.int64)
        best = [(none, none)] * (len(first) - 1)
        weights = np.zeros(len(rank_of), dtype=np.int64)
        for tree in _trees(batches, rank_of, n_docs, n_terms):
            for item in range(len(best)):
                a, b = first[item], first[item + 1]
                weights[ranks[a:b]] = own[a:b]
                best[item] = tree.search(weights, best[item], k)
                weights[ranks[a:b]] = 0
        for item, (scores, ids) in enumerate(best):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), item), pa.int32()), pa.array(ids), pa.array(scores)],
                    names=["item", "doc_id", "score"],
                )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item, first within slices, so no task gets all candidates."""

    def cut(rows: DataFrame, *group: str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc("score"), "doc_id")
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    sliced = found.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)))
    return cut(cut(sliced, "item", "slice").drop("rank", "slice"), "item")


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = TOP,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Of each item the k documents with the highest scores: item_id, rank, doc_id, score.

    ``key`` is an integer. Documents are read once per block of items; what is kept
    of them, the counts of item terms, is staged and read for statistics and search.
    """
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text))
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for ids, terms in _item_blocks(items, item_id, item_text, block_terms):
        known = np.unique(np.concatenate(terms))
        counted = rows.mapInArrow(_vectors(spark.sparkContext.broadcast(known)), _VECTORS)
        vectors = stage(counted.filter("n > 0"), "term-vectors")
        total = vectors.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not total["docs"]:
            return out
        held = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        df = np.zeros(len(known), dtype=np.int64)
        for row in held:
            df[row["term"]] = row["count"]
        rank_of = np.empty(len(known), dtype=np.int64)
        rank_of[np.argsort(-df, kind="stable")] = np.arange(len(known))
        weight = np.array(
            [math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * int(x) + 1))) for x in df]
        )
        own = [np.searchsorted(known, t) for t in terms]
        own = [t[df[t] > 0] for t in own]
        first = np.concatenate([[0], np.cumsum([len(t) for t in own])])
        flat = np.concatenate(own).astype(np.int64)
        model = (rank_of, first, rank_of[flat], weight[flat], total["docs"], total["terms"])
        usable = vectors.filter("doc_id IS NOT NULL AND size(terms) > 0")
        found = usable.mapInArrow(_searched(spark.sparkContext.broadcast(model), k), _FOUND)
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {kind}")
        best = stage(_ranked(found, k), "best-documents")
        out = out.unionByName(
            best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        )
    return out
