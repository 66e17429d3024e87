"""One row per key, the first by a given order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from vitaelake.sources.staging import sized, stage

#: Share of rows with a repeated key from which one pass with a window is taken.
WINDOW_SHARE = 0.5

_KEY, _FIRST, _COPIES, _NTH = "__key", "__first", "__copies", "__nth"


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    probe: DataFrame | None = None,
) -> DataFrame:
    """Keep per key the row that comes first by ``order``.

    Wide rows are not shuffled: the repeated keys are found on the key columns
    alone, with partial aggregation, and joined back by broadcast if their
    staged table is small. ``probe`` may name a narrow frame with the same keys
    and orders, such as a staged table. NULL keys count as equal. Order values
    are compared as Spark sorts them, NULL first.

    Where rows of repeated keys are more than ``WINDOW_SHARE`` of all, few rows
    stay, and one pass with a window is cheaper: of each key a task sends only its
    first row to the shuffle, so a key of very many rows is no hot spot either.
    """
    # Structs are never NULL and compare NULL fields as equal.
    key, position = F.struct(*keys), F.struct(*order)
    narrow = (probe if probe is not None else df).select(
        key.alias(_KEY), position.alias(_FIRST)
    )
    # How many rows share their key is observed while the repeated keys are written.
    counted = narrow.groupBy(_KEY).count()
    seen = Observation()
    several = F.col("count") > 1
    repeated = stage(
        counted.observe(
            seen,
            F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(several, F.col("count"))), F.lit(0)).alias("shared"),
            F.count(F.when(several, F.lit(1))).alias("repeated"),
        )
        .filter(several)
        .select(_KEY),
        "repeated-keys",
    )
    measured = seen.get
    n_repeated = measured["repeated"]
    if n_repeated == 0:
        return df
    if measured["shared"] > WINDOW_SHARE * measured["rows"]:
        return _first_by_window(df, keys, order)

    copies = F.count("*").alias(_COPIES)
    firsts = stage(
        narrow.join(sized(repeated, n_repeated), _KEY, "left_semi")
        .groupBy(_KEY, _FIRST)
        .agg(copies)
        .groupBy(_KEY)
        .agg(F.min(_FIRST).alias(_FIRST), F.min_by(_COPIES, _FIRST).alias(_COPIES)),
        "first-of-repeated-keys",
    )
    first = sized(firsts, n_repeated)
    same_key = key == first[_KEY]
    is_first = position == first[_FIRST]
    if firsts.agg(F.max(_COPIES)).first()[0] == 1:
        kept = df.join(first, same_key, "left").filter(first[_KEY].isNull() | is_first)
        return kept.select(*(df[c] for c in df.columns))

    # Rows alike in key and order: only these go through a window, and its
    # limit of one is applied before the shuffle.
    alone = df.join(first, same_key, "left_anti")
    chosen = df.join(first, same_key & is_first).select(*(df[c] for c in df.columns))
    return alone.unionByName(_first_by_window(chosen, keys, order))


def _first_by_window(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_NTH, nth).filter(F.col(_NTH) == 1).drop(_NTH)
