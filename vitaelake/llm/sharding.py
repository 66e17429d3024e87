"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring; a row belongs to the first point at or
after its hash. A shard takes rows up to its capacity; rows that find it full go
on clockwise to the next point whose shard has room. Who goes on is settled on
the rows per point, a table as large as the ring whatever the input: first each
point's own rows are offered to its shard, then those left over to the next point,
and so on. A row's number among those of its point then tells its shard and slot.

Without slack the capacities add up to the rows, so shard sizes differ by at most
one row. All of it is DataFrame work on narrow rows; the numbering cuts points
with very many rows, or very many equal rows, into slices of their own.

A NULL text has no bytes, a NULL id is hashed as such, repeated rows get slots of
their own, and an empty table gives no rows. Which of several equal rows gets
which slot may differ between runs; nothing else does.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaelake.operators.ranking import number_rows
from vitaelake.sources.staging import stage

SHARDS = 16
VIRTUAL_NODES = 64
RING_BITS = 14


@dataclass(frozen=True)
class Ring:
    """Points of the ring in clockwise order, and the shard of each."""

    shards: int
    virtual_nodes: int = VIRTUAL_NODES

    def points(self) -> list[tuple[int, int]]:
        """(place, shard), sorted; a shard's places depend on its number only."""
        out = set()
        for shard in range(self.shards):
            for copy in range(self.virtual_nodes):
                digest = hashlib.blake2b(f"{shard}/{copy}".encode(), digest_size=8).digest()
                out.add((int.from_bytes(digest) >> (64 - RING_BITS), shard))
        return sorted(out)

    def owners(self) -> list[int]:
        """Number of the point that owns each place of the ring."""
        points, out, at = self.points(), [], 0
        for place in range(1 << RING_BITS):
            while at < len(points) and points[at][0] < place:
                at += 1
            out.append(at % len(points))
        return out


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows each shard may take; with no slack they add up to ``rows``."""
    if slack > 0:
        return [-int(-rows * (1 + slack) // shards)] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def flow(counts: dict[int, int], points: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(point, shard, first rank, last rank, first slot) of every run of rows.

    ``counts``: rows per point. Ranks and slots begin at 0. The work is bounded by
    the square of the ring's points.
    """
    room, filled = list(room), [0] * len(room)
    waiting = {point: (0, n) for point, n in sorted(counts.items()) if n}
    runs = []
    for steps in range(len(points)):
        for point, (rank, n) in list(waiting.items()):
            shard = points[(point + steps) % len(points)][1]
            taken = min(n, room[shard])
            if taken:
                runs.append((point, shard, rank, rank + taken - 1, filled[shard]))
                room[shard] -= taken
                filled[shard] += taken
                waiting[point] = (rank + taken, n - taken)
            if taken == n:
                del waiting[point]
        if not waiting:
            break
    return runs


def _constants(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def assign(
    docs: DataFrame,
    shards: int = SHARDS,
    key: str = "doc_id",
    text: str = "text",
    slack: float = 0.0,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """key, ``keep``, size, text_crc32, shard and slot of every row.

    ``size`` is the text's bytes plus one. ``keep`` names further columns to carry
    along; they are written and shuffled with the rows.
    """
    spark, ring = docs.sparkSession, Ring(shards)
    content = F.coalesce(F.col(text), F.lit(""))
    place = F.xxhash64(F.col(key), F.col(text))
    rows = stage(
        docs.select(
            F.col(key),
            *keep,
            (F.octet_length(content).cast("long") + 1).alias("size"),
            F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
            place.alias("__hash"),
        ),
        "ring-rows",
    )
    owner = F.get(_constants(ring.owners()), F.shiftrightunsigned("__hash", 64 - RING_BITS).cast("int"))
    pointed = rows.select(
        "*",
        owner.alias("__point"),
        F.col("_metadata.file_name").alias("__file"),
        F.col("_metadata.row_index").alias("__row"),
    )
    counts = {r[0]: r[1] for r in pointed.groupBy("__point").count().collect()}
    runs = flow(counts, ring.points(), capacities(sum(counts.values()), shards, slack))
    values = ", ".join(f"({p}, {s}, {a}L, {b}L, {f}L)" for p, s, a, b, f in runs) or "(-1, 0, 0L, 0L, 0L)"
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t(point, shard, low, high, first_slot)")
    ranked = number_rows(pointed, ["__point"], ["__hash", "__file", "__row"], "__rank")
    rank = F.col("__rank") - 1
    placed = ranked.join(
        F.broadcast(table), (F.col("__point") == F.col("point")) & rank.between(F.col("low"), F.col("high"))
    )
    return placed.select(
        key, *keep, "size", "text_crc32", "shard", (rank - F.col("low") + F.col("first_slot")).alias("slot")
    )
