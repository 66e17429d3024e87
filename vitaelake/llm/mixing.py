"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the number of copies each of its documents
should have. The whole part is taken outright; the fractions are rounded so that
their sum stays: two documents meet, mass moves at random from one to the other
until one of them is whole, and the other goes on to meet the next. Documents meet
in blocks of a bounded number, neighbours in size first, so a source's words stay
near its target. The one fraction a block may leave goes on into blocks of such
residuals, a tree whose depth is the logarithm of the number of blocks.

Equal rows are counted first and enter as one record, so a document that is a third
of the table is one record as well. Draws come from hashes of the rows, so reruns
agree, whatever the partitions.

NULL and wordless texts have size 0 and are taken as often as others of their
source; NULL sources are one source, the last. A source of size 0 has target 0. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaelake.operators.ranking import number_rows
from vitaelake.sources.staging import sized, stage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2.0
BLOCK_ROWS = 4096
MAX_SOURCES = 100_000
_WHOLE = 1e-9


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Target words per source: weights by code point order, NULL last.

    Where a share is more than ``MOST_COPIES`` times the source, the source stops
    there and what is left is shared again by weight among the others.
    """
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {name: WEIGHTS[i % len(WEIGHTS)] for i, name in enumerate(names)}
    out: dict[str | None, float] = {}
    left, open_ = SHARE * sum(sizes.values()), list(names)
    while open_:
        total = sum(weight[n] for n in open_)
        share = {n: left * weight[n] / total for n in open_}
        above = [n for n in open_ if share[n] > MOST_COPIES * sizes[n]]
        if not above:
            return out | share
        for name in above:
            out[name] = MOST_COPIES * sizes[name]
        left -= sum(out[n] for n in above)
        open_ = [n for n in open_ if n not in out]
    return out


def pivotal(records: pd.DataFrame) -> pd.DataFrame:
    """Round the ``mass`` of one block in the order of size; at most one stays open."""
    block = records.sort_values(["size", "id"], kind="stable").reset_index(drop=True)
    mass, draws = block["mass"].to_numpy().copy(), block["draw"].to_numpy()
    held = -1
    for i in range(len(mass)):
        if mass[i] <= _WHOLE or mass[i] >= 1 - _WHOLE:
            mass[i] = round(mass[i])
            continue
        if held < 0:
            held = i
            continue
        a, b = mass[held], mass[i]
        total = a + b
        if total < 1:  # one gets all, the other none
            mass[held], mass[i] = (total, 0.0) if draws[i] * total < a else (0.0, total)
        else:  # one gets a whole, the other the rest
            rest = total - 1
            mass[held], mass[i] = (1.0, rest) if draws[i] * (2 - total) < 1 - b else (rest, 1.0)
        held = next((x for x in (held, i) if _WHOLE < mass[x] < 1 - _WHOLE), -1)
        for x in {held, i} - {-1}:
            if not _WHOLE < mass[x] < 1 - _WHOLE:
                mass[x] = round(mass[x])
    return block.assign(mass=mass)


_RECORD = "number int, id long, size long, draw double, mass double"


def _rounded(batch: pd.DataFrame) -> pd.DataFrame:
    return pivotal(batch)[["number", "id", "size", "draw", "mass"]]


def _last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(mass=(batch["draw"] < batch["mass"]).astype(float))


def _draw(level: int) -> Column:
    bits = F.xxhash64("id", F.lit(level)).bitwiseAND(F.lit((1 << 52) - 1))
    return bits.cast("double") / float(1 << 52)


def _fraction(mass: Column) -> Column:
    return (mass > _WHOLE) & (mass < 1 - _WHOLE)


def round_fractions(records: DataFrame, counts: dict[int, int]) -> DataFrame:
    """(id, mass 0 or 1) of records (number, id, size, mass); ``counts`` by number.

    Every level rounds blocks of about ``BLOCK_ROWS``; those of the next level hold
    one residual a block.
    """
    spark = records.sparkSession
    current, blocks, level = records, counts, 0
    done: list[DataFrame] = []
    while True:
        blocks = {k: -(-n // BLOCK_ROWS) for k, n in blocks.items()}
        table = spark.createDataFrame(sorted(blocks.items()) or [(-1, 1)], "number int, blocks long")
        dealt = current.join(F.broadcast(table), "number").withColumns(
            {"draw": _draw(level), "block": F.pmod(F.xxhash64("id", F.lit(-1 - level)), "blocks")}
        )
        rounded = stage(dealt.groupBy("number", "block").applyInPandas(_rounded, _RECORD), "rounded")
        done.append(rounded.filter(~_fraction(F.col("mass"))).select("id", F.round("mass").alias("mass")))
        current = rounded.filter(_fraction(F.col("mass"))).select("number", "id", "size", "mass")
        level += 1
        if max(blocks.values(), default=1) <= 1:
            break
    # At most one record of a source is open now.
    final = current.withColumn("draw", _draw(level)).select("number", "id", "size", "draw", "mass")
    done.append(final.mapInPandas(_last, _RECORD).select("id", "mass"))
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


@dataclass
class Mix:
    """``records``: (id, rows, whole, extra): equal rows, the copies that each of
    them has, and how many of them have one more. ``sources``: source, number,
    source_size, target. ``rows``: what the caller's rows are joined by."""

    records: DataFrame
    sources: DataFrame
    rows: DataFrame


def words(text: Column) -> Column:
    """Number of runs of anything but ASCII whitespace."""
    content = F.trim(F.coalesce(F.regexp_replace(text, r"[ \t-\x0D]+", " "), F.lit("")))
    spaces = F.length(content) - F.length(F.replace(content, F.lit(" "), F.lit("")))
    return F.when(content == "", 0).otherwise(spaces + 1).cast("long")


def row_id(docs: DataFrame) -> Column:
    """Hash of all columns; equal rows share it."""
    return F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> Mix:
    """Decide how often each row of docs is taken."""
    rows = stage(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            words(F.col(text)).alias("size"),
            row_id(docs).alias("id"),
        ),
        "mix-rows",
    )
    found = rows.groupBy("source").agg(F.sum("size"), F.count("*")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {r[0]: r[1] for r in found}
    wanted = targets(sizes)
    numbered = list(enumerate(sorted(sizes, key=lambda s: (s is None, s or ""))))
    values = [
        (i, s, sizes[s], wanted[s], wanted[s] / sizes[s] if sizes[s] else 0.0) for i, s in numbered
    ]
    sources = docs.sparkSession.createDataFrame(
        values, "number int, source string, source_size long, target double, copies double"
    )
    small = F.broadcast(sources.withColumnRenamed("source", "__source"))
    known = rows.join(small, F.col("source").eqNullSafe(F.col("__source")))
    grouped = known.groupBy("number", "id", "size", "copies").agg(F.count("*").alias("rows"))
    # Equal rows share their mass: so many of them have one copy more than the rest.
    whole = F.floor("copies")
    mass = F.col("rows") * (F.col("copies") - whole)
    records = stage(
        grouped.select(
            "number", "id", "size", "rows", whole.cast("long").alias("whole"),
            F.floor(mass + _WHOLE).alias("sure"),
            F.greatest(mass - F.floor(mass + _WHOLE), F.lit(0.0)).alias("mass"),
        ),
        "mix-records",
    )
    open_ = records.filter(_fraction(F.col("mass"))).select("number", "id", "size", "mass")
    counts = {r[0]: r[1] for r in open_.groupBy("number").count().collect()}
    rounded = round_fractions(open_, counts).withColumnRenamed("mass", "rounded")
    decided = records.join(rounded, "id", "left").select(
        "id", "rows", "whole", (F.col("sure") + F.coalesce("rounded", F.lit(0.0))).cast("long").alias("extra")
    )
    return Mix(stage(decided, "mix-decided"), sources, rows)


def taken(mix: Mix) -> DataFrame:
    """key, size, source, source_size, target and copies of every row."""
    rows = mix.rows.select(
        "*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row")
    )
    joined = rows.join(mix.records, "id")
    single = joined.filter("rows = 1").withColumn("copies", F.col("whole") + F.col("extra"))
    several = number_rows(joined.filter("rows > 1"), ["id"], ["__file", "__row"], "__nth")
    more = (F.col("__nth") <= F.col("extra")).cast("long")
    several = several.withColumn("copies", F.col("whole") + more).drop("__nth")
    columns = ["key", "size", "source", "copies"]
    every = single.select(*columns).union(several.select(*columns))
    small = F.broadcast(mix.sources.select(F.col("source").alias("__source"), "source_size", "target"))
    return every.join(small, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of the mix, as often as they are taken; all columns of docs."""
    mix = plan(docs, key, text, source)
    decided = sized(
        mix.records.select(
            F.col("id").alias("__id"), F.col("rows").alias("__rows"),
            F.col("whole").alias("__whole"), F.col("extra").alias("__extra"),
        )
    )
    joined = docs.withColumn("__id", row_id(docs)).join(decided, "__id")
    single = joined.filter("__rows = 1").withColumn("__copies", F.col("__whole") + F.col("__extra"))
    # Equal rows stand for each other, so one of them is repeated for all.
    several = joined.filter("__rows > 1").dropDuplicates(["__id"])
    several = several.withColumn("__copies", F.col("__rows") * F.col("__whole") + F.col("__extra"))
    every = single.unionByName(several).filter("__copies > 0")
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))
    return every.withColumn("__time", times).select(*docs.columns)
