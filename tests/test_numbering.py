"""Positions are the same whether a group fits a task or is spread over many."""

import random

import pytest
from pyspark.sql import functions as F

from sigloom.operators.numbering import number_rows


def expected(rows):
    groups = {}
    for key, order in rows:
        groups.setdefault(key, []).append(order)
    return sorted(
        ((key, order, pos, len(orders)) for key, orders in groups.items() for pos, order in enumerate(sorted(orders))),
        key=str,
    )


def skewed_rows():
    random.seed(3)
    rows = [("hot", i) for i in range(400)] + [(f"k{i % 40}", i) for i in range(700)] + [(None, i) for i in range(120)]
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("max_rows", [10, 50, 300, 1_000_000])
def test_all_sizes_of_groups(spark, max_rows):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "key STRING, ord BIGINT").repartition(7)
    got = number_rows(df, ["key"], ["ord"], max_rows)
    assert got.columns == ["key", "ord", "pos", "n"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)


@pytest.mark.parametrize("max_rows", [9, 1_000])
def test_without_keys(spark, max_rows):
    df = spark.range(100).select((F.col("id") * 3).alias("id")).repartition(5)
    got = number_rows(df, [], ["id"], max_rows).collect()
    assert sorted((r.id, r.pos, r.n) for r in got) == [(3 * i, i, 100) for i in range(100)]


def test_ties_get_distinct_positions(spark):
    df = spark.range(60).select((F.col("id") % 2).alias("ord"), (F.col("id") % 3).alias("payload"))
    got = number_rows(df, [], ["ord"], 7).collect()
    assert sorted(r.pos for r in got) == list(range(60))
    assert all((r.pos >= 30) == (r.ord == 1) for r in got)


def test_several_order_columns(spark):
    df = spark.range(200).select((F.col("id") % 5).alias("a"), (F.col("id") * 7 % 200).alias("b"))
    got = number_rows(df, [], ["a", "b"], 13).orderBy("pos").collect()
    assert [(r.a, r.b) for r in got] == sorted((r.a, r.b) for r in got)


def test_empty_input(spark):
    df = spark.createDataFrame([], "key STRING, ord BIGINT")
    assert number_rows(df, ["key"], ["ord"]).count() == 0


def test_small_groups_take_one_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("key"), "id")
    plan = number_rows(df, ["key"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
