"""Nearest neighbours over an embedding column, exact and approximate."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitaelake.sources.staging import stage, stage_all

QUERY_BLOCK = 1024
#: Queries that one scan of the vectors answers, and a driver or task holds.
SCAN_QUERIES = 16_384
ROWS_PER_CELL_FILE = 100_000
#: Vectors and queries that are multiplied at a time, vectors of the first tile, pairs
#: that are made again at a time, and rows of a batch that a task hands on.
TILE_ROWS, TILE_QUERIES = 4096, 1024
TILE_FIRST = 64
TILE_ENTRIES = 65_536
OUT_ROWS = 65_536

# Cosines are compared at this precision, so that copies of a vector tie and
# fall back on the id whatever order their products were added in.
_DIGITS = 9


def score_of(cosine: Column) -> Column:
    """Cosine from -1..1 moved to 0..1, three decimals."""
    return F.round((cosine + 1) / 2, 3)


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        return matrix / norms


def _matrix(column: pa.Array) -> np.ndarray:
    offsets = column.offsets.to_numpy()
    widths = np.diff(offsets)
    if len(widths) and (widths != widths[0]).any():
        raise ValueError("vectors differ in length")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _best(
    at: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Top k of every query by score, then id; ``at`` is the query of an entry."""
    order = np.lexsort((ids, -scores, at))
    at, ids, scores = at[order], ids[order], scores[order]
    keep = np.arange(len(at)) - np.searchsorted(at, at) < k
    return at[keep], ids[keep], scores[keep]


def _scan(
    query_ids: list,
    queries: np.ndarray,
    k: int,
    skip_self: bool,
    block: int,
    probed: np.ndarray | None = None,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Running top k per query over id, vector and, if ``probed``, cell.

    ``probed[cell, query]`` tells which cells count for which query; a cell's vectors
    are multiplied with these queries only. The pairs that were compared come as a
    row per query without ``vec_id``. ``part`` is a query's block of ``block`` queries.

    Products are made in single precision, in tiles that stay in the processor's cache.
    Pairs that, by the bound of its error, may reach the k-th score of their query are
    made again in double precision, and only these are ranked.
    """
    units = _unit(queries)
    single = units.astype(np.float32)
    # Sums of n products of two unit vectors are off by less than n roundings.
    margin = (queries.shape[1] + 8) * 2.0**-23 + 10.0**-_DIGITS if queries.size else 0.0

    def parts(batch: pa.RecordBatch, every: np.ndarray) -> Iterator[tuple]:
        vectors = _unit(_matrix(batch.column(1)))
        if probed is None:
            yield np.arange(len(query_ids)), every, vectors
            return
        cells = batch.column(2).to_numpy()
        for cell in np.unique(cells):
            own = cells == cell
            yield np.flatnonzero(probed[cell]), every[own], vectors[own]

    class Held:
        """The best entries so far, in order of query, and the score that others must reach."""

        def __init__(self) -> None:
            self.at = np.empty(0, dtype=np.int64)
            self.ids = self.scores = None
            self.reach = np.full(len(query_ids), -np.inf)

        def add(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
            if self.ids is not None:
                at, ids = np.concatenate((self.at, at)), np.concatenate((self.ids, ids))
                scores = np.concatenate((self.scores, scores))
            self.at, self.ids, self.scores = _best(at, ids, scores, k)
            last = np.flatnonzero(np.diff(self.at, append=-1))
            full = last[np.bincount(self.at, minlength=len(query_ids))[self.at[last]] == k]
            self.reach[self.at[full]] = self.scores[full]

    def candidates(
        asking: np.ndarray, ids: np.ndarray, vectors: np.ndarray, reach: np.ndarray
    ) -> Iterator[tuple]:
        rough = vectors.astype(np.float32)
        for start in range(0, len(asking), TILE_QUERIES):
            some = asking[start : start + TILE_QUERIES]
            least = (reach[some] - margin).astype(np.float32)
            found = np.flatnonzero(rough @ single[some].T >= least)
            row, at = np.divmod(found, len(some))
            at = some[at]
            for first in range(0, len(row), TILE_ENTRIES):
                rows, queries_at = row[first : first + TILE_ENTRIES], at[first : first + TILE_ENTRIES]
                cosines = np.einsum("ij,ij->i", vectors[rows], units[queries_at])
                cosines = np.round(cosines, _DIGITS)
                keep = cosines >= reach[queries_at]
                if skip_self:
                    keep &= ids[rows] != own_ids[queries_at]
                yield queries_at[keep], ids[rows[keep]], cosines[keep]

    own_ids = np.array(query_ids, dtype=object) if None in query_ids else np.array(query_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pairs = Held(), np.zeros(len(query_ids), dtype=np.int64)
        waiting: list = []
        # Tiles grow with what has been seen, so few entries pass before the scores are high.
        seen = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            every = batch.column(0).to_numpy(zero_copy_only=False)
            for asking, ids, vectors in parts(batch, every):
                pairs[asking] += len(ids)
                start = 0
                while start < len(ids) and len(asking):
                    rows = min(max(seen, TILE_FIRST), TILE_ROWS)
                    tile = slice(start, start + rows)
                    waiting += candidates(asking, ids[tile], vectors[tile], held.reach)
                    # Few entries pass later on, and those wait till there are many.
                    if 2 * sum(len(found[0]) for found in waiting) >= len(held.at):
                        held.add(*map(np.concatenate, zip(*waiting)))
                        waiting = []
                    start += rows
                    seen += rows
        if waiting:
            held.add(*map(np.concatenate, zip(*waiting)))
        # One partition hands on at most k rows per query, and its number of pairs.
        ids, scores = (held.ids, held.scores) if held.ids is not None else (np.empty(0), np.empty(0))
        names, none = ["query_id", "vec_id", "cosine", "pairs", "part"], pa.nulls
        part_of = lambda at: pa.array((at // block).astype(np.int32))
        asked = pa.array(query_ids, kind)
        for start in range(0, len(ids), OUT_ROWS):
            part = slice(start, start + OUT_ROWS)
            columns = [
                asked.take(pa.array(held.at[part])), pa.array(ids[part].tolist(), kind),
                pa.array(scores[part]), none(len(ids[part]), pa.int64()),
                part_of(held.at[part]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        for start in range(0, len(pairs), OUT_ROWS):
            compared = start + np.flatnonzero(pairs[start : start + OUT_ROWS])
            columns = [
                asked.take(pa.array(compared)), none(len(compared), kind),
                none(len(compared), pa.float64()), pa.array(pairs[compared]),
                part_of(compared),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = pa.array(query_ids).type
    return run


def _top_k(pairs: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("part", "query_id").orderBy(F.desc("cosine"), "vec_id")
    return (
        pairs.filter("vec_id IS NOT NULL")
        .withColumn("rank", F.row_number().over(window))
        .filter(F.col("rank") <= k)
        .select("query_id", "vec_id", score_of(F.col("cosine")).alias("match_score"), "rank", "part")
    )


def _blocks(queries: DataFrame, block: int) -> Iterator[tuple[list, np.ndarray]]:
    """Ids and vectors of the queries, as many whole blocks at a time as a scan takes."""
    size = block * max(1, SCAN_QUERIES // block)
    rows = queries.select("vec_id", "embedding").filter("embedding IS NOT NULL")
    stream = stage(rows, "query-vectors").toLocalIterator()
    while taken := list(islice(stream, size)):
        matrix = np.array([r["embedding"] for r in taken], dtype=np.float64)
        yield [r["vec_id"] for r in taken], matrix


def _search(
    usable: DataFrame, scans: Iterator[tuple[DataFrame, Callable]], k: int, with_pairs: bool = False
) -> DataFrame:
    """Search block after block; the answers of all blocks are one staged table.

    Only one block of queries is alive at a time, and the plan of the result is a scan
    however many there were.
    """
    spark = usable.sparkSession
    kind = usable.schema["vec_id"].dataType.simpleString()
    schema = f"query_id {kind}, vec_id {kind}, cosine double, pairs long, part int"

    def answer(rows: DataFrame, scan: Callable) -> DataFrame:
        found = rows.mapInArrow(scan, schema)
        if not with_pairs:
            return _top_k(found, k).drop("part")
        found = stage(found, "best-of-tasks")
        compared = found.groupBy("part", "query_id").agg(F.sum("pairs").alias("pairs"))
        return compared.join(_top_k(found, k), ["part", "query_id"], "left").select(
            "query_id", "vec_id", "match_score", "rank", "pairs"
        )

    columns = f"query_id {kind}, vec_id {kind}, match_score double, rank int"
    columns += ", pairs long" if with_pairs else ""
    return stage_all(spark, (answer(*scan) for scan in scans), columns, "vector-matches")


def match_vectors(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    skip_self: bool = False,
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """Exact top k by cosine, for every query vector.

    Both inputs have ``vec_id`` and ``embedding``. The vectors are scanned in
    place: a task multiplies its Arrow batches with a block of query vectors,
    keeps a running top k per query and ships only that, so neither pairs nor
    vectors are shuffled. A scan takes as many blocks of ``block`` query vectors as fit
    ``SCAN_QUERIES``, one at least; a larger query set costs more scans, not more memory
    on the driver or in a task, and no larger plan. Rows of one block with the same id
    count as one query.
    """
    usable = vectors.select("vec_id", "embedding").filter("embedding IS NOT NULL")
    scans = (
        (usable, _scan(ids, matrix, k, skip_self, block)) for ids, matrix in _blocks(queries, block)
    )
    return _search(usable, scans, k)


@dataclass(frozen=True)
class VectorIndex:
    """Vectors stored by cell, and the centre of each cell."""

    rows: DataFrame
    centres: np.ndarray

    def probed(self, queries: np.ndarray, probes: int) -> np.ndarray:
        """``probed[cell, query]``: the cells with the nearest centres."""
        return _cheapest(-(_unit(self.centres) @ _unit(queries).T), probes)


@dataclass(frozen=True)
class HashIndex:
    """Vectors stored by the sides of fixed planes that they lie on.

    A cell is the number whose bit i tells whether a vector lies on the upper side of
    plane i, so nothing is trained and a new vector finds its cell by itself.
    """

    rows: DataFrame
    planes: np.ndarray

    def probed(self, queries: np.ndarray, probes: int) -> np.ndarray:
        """The cells that a query reaches over the smallest sum of plane distances."""
        distance = queries @ self.planes.T
        bits = np.arange(len(self.planes))
        upper = (np.arange(1 << len(bits))[:, None] >> bits) & 1
        # A bit that differs from the query's own costs the distance to its plane.
        cost = np.where(distance >= 0, -1, 1) * np.abs(distance)
        own = np.where(distance >= 0, np.abs(distance), 0).sum(axis=1)
        return _cheapest(upper @ cost.T + own, probes)


def _cheapest(cost: np.ndarray, probes: int) -> np.ndarray:
    """Per column the ``probes`` rows of the lowest cost, equal ones by row."""
    near = np.argsort(cost, axis=0, kind="stable")[:probes]
    probed = np.zeros(cost.shape, dtype=bool)
    np.put_along_axis(probed, near, True, axis=0)
    return probed


def hash_planes(dimensions: int, bits: int) -> np.ndarray:
    """The normals of ``bits`` planes: whole numbers of a multiplicative generator.

    Entry d of plane p (both from 0) is n % 2001 - 1000, n being p * dimensions + d + 1
    after three steps of n * 48271 % 2147483647.
    """
    n = np.arange(1, dimensions * bits + 1, dtype=np.int64).reshape(bits, dimensions)
    for _ in range(3):
        n = n * 48271 % 2147483647
    return (n % 2001 - 1000).astype(np.float64)


def _placed_by(planes: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                upper = _matrix(batch.column(1)) @ planes.T >= 0
                cells = upper @ (1 << np.arange(len(planes)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cells, pa.int32())], names=["vec_id", "embedding", "cell"]
                )

    return run


def build_hash_index(vectors: DataFrame, path: str, dimensions: int, bits: int = 8) -> HashIndex:
    """Store the vectors by their sides of ``bits`` planes, in one pass and without training.

    Vectors without an embedding are left out; others must have ``dimensions`` entries.
    A crowded cell is written and read by many tasks.
    """
    planes = hash_planes(dimensions, bits)
    rows = vectors.select("vec_id", "embedding").filter("embedding IS NOT NULL")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    placed = stage(rows.mapInArrow(_placed_by(planes), f"{fields}, cell int"), "hashed-vectors")
    return HashIndex(_stored_by_cell(placed, path), planes)


def build_vector_index(
    vectors: DataFrame, path: str, cells: int = 64, seed: int = 42
) -> VectorIndex:
    """Store the vectors by their nearest of ``cells`` k-means centres.

    All vectors train the centres and all are stored. A cell is a folder with a
    file for about every ``ROWS_PER_CELL_FILE`` rows, so a crowded one is written
    and read by many tasks.
    """
    spark = vectors.sparkSession
    dense = array_to_vector(F.col("embedding").cast("array<double>"))
    raw = vectors.filter("embedding IS NOT NULL").select(
        "vec_id", "embedding", dense.alias("raw")
    )
    units = Normalizer(inputCol="raw", outputCol="unit", p=2.0).transform(raw)
    training = stage(units.select("unit"), "training-vectors")
    trainer = KMeans(
        featuresCol="unit", predictionCol="cell", k=cells, seed=seed, maxIter=10
    )
    model = trainer.fit(training)
    placed = stage(
        model.transform(units).select("vec_id", "embedding", "cell"), "placed-vectors"
    )
    return VectorIndex(_stored_by_cell(placed, path), np.array(model.clusterCenters()))


def _stored_by_cell(placed: DataFrame, path: str) -> DataFrame:
    """A folder per cell, a file for about every ``ROWS_PER_CELL_FILE`` rows of it."""
    files = F.ceil(F.count("*") / ROWS_PER_CELL_FILE).alias("files")
    salted = placed.join(F.broadcast(placed.groupBy("cell").agg(files)), "cell")
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("vec_id"), "files"))
    salted.repartition("cell", "salt").drop("salt", "files").write.partitionBy(
        "cell"
    ).parquet(path)
    schema = placed.select("vec_id", "embedding").schema.add("cell", "integer")
    return placed.sparkSession.read.schema(schema).parquet(path)


def match_vectors_approx(
    index: VectorIndex | HashIndex,
    queries: DataFrame,
    k: int = 10,
    skip_self: bool = False,
    probes: int = 8,
    block: int = QUERY_BLOCK,
    with_pairs: bool = False,
) -> DataFrame:
    """Top k among the vectors in the ``probes`` cells that come first for a query.

    Only folders of probed cells are read, and a cell's vectors are compared with the
    queries that probe it. With all cells probed the answer is exact. ``with_pairs``
    adds ``pairs``, the vectors that the scans compared with the query; a query that
    finds nothing then has one row without ``vec_id``, unless its cells are empty.
    """

    def scans() -> Iterator[tuple[DataFrame, Callable]]:
        for ids, matrix in _blocks(queries, block):
            probed = index.probed(matrix, probes)
            cells = np.flatnonzero(probed.any(axis=1)).tolist()
            yield (
                index.rows.filter(F.col("cell").isin(cells)),
                _scan(ids, matrix, k, skip_self, block, probed),
            )

    return _search(index.rows, scans(), k, with_pairs)


def pairs_examined(
    index: VectorIndex | HashIndex, queries: DataFrame, probes: int = 8, block: int = QUERY_BLOCK
) -> int:
    """Query-vector pairs that ``match_vectors_approx`` is going to compare."""
    held = {row["cell"]: row["count"] for row in index.rows.groupBy("cell").count().collect()}
    total = 0
    for _, matrix in _blocks(queries, block):
        asking = index.probed(matrix, probes).sum(axis=1)
        total += sum(count * int(asking[cell]) for cell, count in held.items())
    return total
