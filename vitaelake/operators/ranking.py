"""Ranks within groups of which one may hold a large share of all rows.

A plain window puts a whole group into one task. These operators rank the
counts of equal values instead, or number range-partitioned slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitaelake.sources.staging import sized, stage

WINDOW_MAX_ROWS = 1_000_000

_GROUP, _SLICE, _OFFSET = "__group", "__slice", "__offset"


def match_all(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Join condition in which NULL equals NULL."""
    return reduce(lambda x, y: x & y, (left[c].eqNullSafe(right[c]) for c in columns))


def counts_before(
    counted: DataFrame, group: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Add the rows that come ``before`` each value and ``total`` of its group.

    ``counted`` has one row per distinct value with its ``rows``, so the window
    holds as many rows as the group has values.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counted.withColumns(
        {
            "before": F.coalesce(F.sum("rows").over(earlier), F.lit(0)),
            "total": F.sum("rows").over(whole),
        }
    )


def top_ranked(
    df: DataFrame, group: str, score: str, limit: int, rank: str = "rank"
) -> DataFrame:
    """Rows whose ``rank()`` by falling score is at most ``limit``; ties all stay.

    At most ``limit`` distinct scores per group qualify. They are found on
    counts per score; a join on (group, score) then selects the rows, so they
    are neither shuffled nor sorted. Reads ``df`` twice: pass a table.
    """
    counted = df.groupBy(group, score).agg(F.count("*").alias("rows"))
    ranked = counts_before(counted, [group], [F.desc(score)])
    passing = stage(
        ranked.select(group, score, (F.col("before") + 1).cast("int").alias(rank)).filter(
            F.col(rank) <= limit
        ),
        "passing-scores",
    )
    small = sized(passing)
    joined = df.join(small, match_all(df, small, [group, score]))
    return joined.select(*(df[c] for c in df.columns), small[rank])


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str,
    largest: int | None = None,
) -> DataFrame:
    """Exact ``row_number()`` also for groups too large for one task.

    Range partitioning cuts a group into slices along the order; a row's number
    is its number within the slice plus the rows of the slices before it. A
    plain window does where ``largest``, the rows of the largest group, is
    known to fit into a task.
    """
    group, order = list(group), list(order)
    if largest is not None and largest <= WINDOW_MAX_ROWS:
        nth = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        return df.withColumn(name, nth.cast("bigint"))

    # Staged, so that all readers see the same slices. As a struct the group is
    # never NULL, and the join below can use the partitioning of the window.
    sliced = stage(
        df.repartitionByRange(*group, *order).withColumns(
            {_GROUP: F.struct(*group), _SLICE: F.spark_partition_id()}
        ),
        "slices",
    )
    keys = [_GROUP, _SLICE]
    counted = sliced.groupBy(*keys).agg(F.count("*").alias("rows"))
    offsets = counts_before(counted, [_GROUP], [F.col(_SLICE)]).select(
        *keys, F.col("before").alias(_OFFSET)
    )
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    joined = sliced.withColumn(name, nth).join(offsets, keys)
    return joined.select(*df.columns, (F.col(name) + F.col(_OFFSET)).alias(name))
