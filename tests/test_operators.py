"""Operators against brute force on small inputs, with limits set low enough to force every path."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.test_functions import python_ratio, random_name
from vinculo.operators import (
    add_missing,
    keep_present,
    match_names,
    nest,
    one_per_key,
    pick_columns,
    rename_headers,
    require_columns,
    target_keys,
    tiled_join,
    within_days,
)
from vinculo.operators.nesting import attach_lists


def test_conforming(spark):
    raw = spark.createDataFrame([("1", "2")], ["  Data Nascimento ", "Situacao-Curso"])
    assert rename_headers(raw, {"situacao_curso": "s"}).columns == ["data_nascimento", "s"]
    padded = add_missing(raw, {"x": "date"})
    assert dict(padded.dtypes)["x"] == "date"
    with pytest.raises(ValueError, match="missing columns y"):
        require_columns(raw, ["y"], "raw")
    assert keep_present(padded, ["x", "nope"]).columns == ["x"]


def test_pick_columns(spark):
    raw = spark.createDataFrame([("1", 2)], ["NOME", "doc"])
    choices = {"nome": ("nome_socio", "nome"), "doc": ("doc",), "extra": ("other",)}
    picked = pick_columns(raw, choices, optional=["extra"])
    assert picked.collect() == [("1", "2", None)]
    with pytest.raises(ValueError, match="no column for 'extra'"):
        pick_columns(raw, choices)


def test_target_keys(spark):
    frame = spark.createDataFrame([(["a", "b", "", None],), (["b"],), ([],), (None,)], "k array<string>")
    assert sorted(r["k"] for r in target_keys(frame, "k").collect()) == ["a", "b"]


def test_one_per_key_is_the_least_row(spark):
    frame = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q")], "k string, n int, s string")
    assert sorted(one_per_key(frame, ["k"]).collect()) == [("a", 1, "y"), ("b", None, "q")]
    newest = one_per_key(frame, ["k"], [-F.col("n")])
    assert sorted(newest.collect()) == [("a", 2, "x"), ("b", None, "q")]


@pytest.mark.parametrize("partitions", [1, 8])
def test_nest_has_one_row_per_key(spark, partitions):
    rng = random.Random(1)
    rows = [("hot", "same")] * 400 + [("hot", f"v{rng.randrange(200)}") for _ in range(300)]
    rows += [(f"k{rng.randrange(50)}", rng.choice(["a", "b", None])) for _ in range(200)]
    frame = spark.createDataFrame(rows, "k string, v string").repartition(partitions)
    lists = nest(frame, ["k"], F.col("v"), "vs", total_into="n").table.collect()
    expected = defaultdict(list)
    for k, v in rows:
        expected[k].append(v)
    assert len(lists) == len(expected)
    for row in lists:
        assert row["vs"] == sorted(expected[row["k"]], key=lambda v: (v is not None, v or ""))
        assert row["n"] == len(row["vs"])


def test_nest_with_copies(spark):
    frame = spark.createDataFrame([("a", 1, 250), ("a", 2, 1), ("b", 3, 2)], "k string, v int, c bigint")
    lists = nest(frame, ["k"], F.col("v"), "vs", copies=F.col("c"), total_into="n").table.collect()
    assert {row["k"]: (row["vs"], row["n"]) for row in lists} == {"a": ([1] * 250 + [2], 251), "b": ([3, 3], 2)}


def test_nest_moves_rows_once(spark):
    frame = spark.createDataFrame([("a", 1)], "k string, v int")
    plan = nest(frame, ["k"], F.col("v"), "vs").table._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange") == 1


def test_attach_lists_keeps_the_rows(spark):
    items = spark.createDataFrame([("a", i) for i in range(20)] + [("b", 1)], "k string, v int")
    rows = spark.createDataFrame([("a", "r1"), ("a", "r2"), ("b", "r3"), ("c", "r4"), (None, "r5")], "k string, r string")
    out = attach_lists(rows, [nest(items, ["k"], F.col("v"), "vs")]).collect()
    assert {row["r"]: row["vs"] for row in out} == {
        "r1": list(range(20)), "r2": list(range(20)), "r3": [1], "r4": None, "r5": None
    }
    assert len(out) == 5


def test_tiled_join_equals_join(spark):
    rng = random.Random(2)
    left = spark.createDataFrame([(rng.choice(["h", "h", "x", "y", "l"]), i) for i in range(300)], "k string, l int")
    right = spark.createDataFrame([(rng.choice(["h", "h", "x", "z"]), i) for i in range(200)], "k string, r int")
    plain = left.join(right, "k")
    for tile in (1, 7, 10_000):
        assert sorted(tiled_join(left, right, ["k"], tile).select(plain.columns).collect()) == sorted(plain.collect())


@pytest.mark.parametrize("threshold", [50, 70, 80, 90, 100])
@pytest.mark.parametrize("limit", [0, 10**9])
def test_match_names_against_all_pairs(spark, threshold, limit):
    rng = random.Random(threshold)
    left = list({(rng.choice("01"), random_name(rng)) for _ in range(150)}) + [("2", "ANA"), ("0", ""), ("1", None)]
    right = list({(rng.choice("01"), random_name(rng)) for _ in range(250)}) + [("3", "ANA"), ("0", None)]
    left += [("0", "ABCDEFGHIJ KLMNOPQRST"), ("0", "A"), ("1", "AB")]
    right += [("0", "KLMNOPQRST ABCDEFGHIX"), ("0", "A"), ("0", "A B"), ("1", "ABC"), ("0", "ABCDEFGHIJKLMNOPQRST")]
    frames = [spark.createDataFrame(rows * 2, f"b string, {n} string") for rows, n in ((left, "x"), (right, "y"))]
    found = match_names(*frames, "b", "x", "y", threshold, max_block_pairs=limit).collect()
    expected = {
        (b, x, y) for b, x in left for c, y in right if b == c and x and y and python_ratio(x, y) >= threshold
    }
    assert len(found) == len(expected)
    assert {tuple(row) for row in found} == expected
    assert len(expected) > 50


def test_a_hot_block_gives_the_same_matches(spark):
    """A third of all names in one block: signatures for it, plain pairing for the rest, nothing lost."""
    rng = random.Random(9)
    firsts = [random_name(rng) for _ in range(60)]

    def names(count):
        return [(rng.choice(["hot"] + [str(i) for i in range(40)] * 2) if rng.random() > 0.33 else "hot",
                 f"{rng.choice(firsts)} {rng.choice(firsts)}") for _ in range(count)]

    left = spark.createDataFrame(names(900), "b string, x string")
    right = spark.createDataFrame(names(2500), "b string, y string")
    paired = match_names(left, right, "b", "x", "y", max_block_pairs=10**9)
    mixed = match_names(left, right, "b", "x", "y", max_block_pairs=5_000)
    expected = sorted(tuple(row) for row in paired.collect())
    assert sorted(tuple(row) for row in mixed.collect()) == expected
    assert len([row for row in expected if row[0] == "hot"]) > 300


def test_match_names_rejects_impossible_thresholds(spark):
    frame = spark.createDataFrame([("a", "b")], "b string, x string")
    with pytest.raises(ValueError):
        match_names(frame, frame, "b", "x", "x", 101)


def test_within_days(spark):
    events = spark.createDataFrame(
        [("a", "2020-01-08"), ("a", "2020-01-09"), ("a", "2019-12-25"), ("b", "2020-01-01"), ("a", None)], "k string, d string"
    ).withColumn("d", F.to_date("d"))
    starts = spark.createDataFrame([("a", "2020-01-01"), ("b", None)], "k string, s string").withColumn("s", F.to_date("s"))
    found = within_days(events, starts, "k", "d", "s", 7).select("k", "diferenca_dias").collect()
    assert sorted(tuple(r) for r in found) == [("a", 7), ("a", 7)]
    with pytest.raises(ValueError):
        within_days(events, starts, "k", "d", "s", -1)
