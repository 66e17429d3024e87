from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vitaelake.operators import ranking
from vitaelake.operators.dedupe import dedupe
from vitaelake.sources import staging


@pytest.fixture(params=["broadcast", "shuffle"])
def join_way(request, monkeypatch, spark):
    """Run with the small side broadcast, and with a limit it does not meet."""
    if request.param == "shuffle":
        monkeypatch.setattr(staging, "BROADCAST_MAX_ROWS", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        yield request.param
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    else:
        yield request.param


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def expected_first(rows):
    best = {}
    for row in rows:
        rank = (row[1] is not None, row[1] or 0)
        if row[0] not in best or rank < best[row[0]][0]:
            best[row[0]] = (rank, row)
    return sorted((row for _, row in best.values()), key=repr)


def test_first_row_per_key(spark, join_way):
    draw = random.Random(1)
    # One key holds a third of the rows; NULL is a key too.
    keys = ["hot"] * 300 + [f"k{i}" for i in range(500)] + ["pair", "pair", None, None]
    orders = list(range(len(keys)))
    draw.shuffle(orders)
    rows = [(k, o, f"text{o}") for k, o in zip(keys, orders)]
    rows.append(("pair", None, "null order is first"))
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o int, t string").repartition(5)
    assert rows_of(dedupe(df, ["k"], ["o"])) == expected_first(rows)


def test_rows_alike_in_key_and_order(spark, join_way):
    rows = [("a", 1, "x")] * 50 + [("b", 1, "y"), ("b", 2, "z"), ("c", 1, "w")]
    df = spark.createDataFrame(rows, "k string, o int, t string").repartition(4)
    got = rows_of(dedupe(df, ["k"], ["o"]))
    assert got == [("a", 1, "x"), ("b", 1, "y"), ("c", 1, "w")]


def test_no_repeated_key_leaves_the_plan_alone(spark):
    df = spark.range(10).withColumn("o", F.lit(1))
    assert dedupe(df, ["id"], ["o"]) is df


def test_two_keys_and_probe(spark, join_way):
    rows = [("a", 1, 5, "x"), ("a", 1, 4, "y"), ("a", 2, 9, "z"), ("b", 1, 1, "v")]
    df = spark.createDataFrame(rows, "k string, m int, o int, t string")
    got = dedupe(df, ["k", "m"], ["o"], probe=df.drop("t"))
    assert rows_of(got) == [("a", 1, 4, "y"), ("a", 2, 9, "z"), ("b", 1, 1, "v")]


def scored(spark):
    draw = random.Random(2)
    rows = [("hot", f"h{i}", draw.randint(0, 4)) for i in range(400)]
    rows += [("tied", f"t{i}", 7) for i in range(12)]
    rows += [("gap", f"g{i}", s) for i, s in enumerate([5, 5, 4])]
    rows += [(None, f"n{i}", i) for i in range(15)]
    rows += [(f"c{i % 9}", f"r{i}", draw.randint(-3, 60)) for i in range(300)]
    return spark.createDataFrame(rows, "g string, id string, s int").repartition(6)


def test_top_ranked_equals_rank(spark, join_way):
    df = scored(spark)
    window = Window.partitionBy("g").orderBy(F.desc("s"))
    expected = df.withColumn("rank", F.rank().over(window)).filter("rank <= 10")
    got = ranking.top_ranked(df, "g", "s", 10)
    assert rows_of(got) == rows_of(expected)
    ranks = {(r["g"], r["rank"]) for r in got.collect() if r["g"] in ("tied", "gap")}
    assert ranks == {("tied", 1), ("gap", 1), ("gap", 3)}


def test_number_rows_equals_row_number(spark):
    df = scored(spark)
    window = Window.partitionBy("g", "s").orderBy("id")
    expected = df.withColumn("n", F.row_number().over(window).cast("bigint"))
    assert rows_of(ranking.number_rows(df, ["g", "s"], ["id"], "n")) == rows_of(expected)


def test_staged_tables_lie_in_the_folder_the_session_names(spark, monkeypatch, tmp_path):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert staging.shared_dir(spark) == configured.rstrip("/")
    monkeypatch.setattr(staging, "shared_dir", lambda _: str(tmp_path))
    outside = staging.stage(spark.range(3), "t")
    with pytest.raises(ValueError), staging.scope(spark):
        assert staging.stage(spark.range(4), "t").count() == 4
        raise ValueError
    # The failed block took its own table with it, and no other.
    assert len(list((tmp_path / "stage").iterdir())) == 1
    assert outside.count() == 3


def test_large_inputs_are_not_spread(spark, monkeypatch):
    df = spark.range(10)
    assert staging.spread(df, "id") is not df
    monkeypatch.setattr(staging, "SPREAD_BYTES_PER_TASK", 1)
    assert staging.spread(df, "id") is df
