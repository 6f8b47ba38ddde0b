"""Salted joins give the plain join's rows and spread hot keys."""

import pytest
from pyspark.sql import functions as F

from eventmart.operators import skew


@pytest.fixture(scope="module")
def sides(spark):
    many = [(1, i) for i in range(400)] + [(k, i) for k in range(2, 30) for i in range(5)]
    many += [(None, i) for i in range(300)]
    one = [(k, f"n{k}") for k in range(0, 20)] + [(1, "again"), (None, "nobody")]
    return (spark.createDataFrame(many, "k BIGINT, v BIGINT"),
            spark.createDataFrame(one, "k BIGINT, name STRING"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_the_plain_join(sides, rows, how):
    many, one = sides
    plain = many.join(one, ["k"], how)
    salted = skew.salted_join(many, one, ["k"], how, ["v"], buckets=16, rows_per_salt=10)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)
    assert rows(plain)


def test_only_hot_keys_get_salts(sides):
    many, _ = sides
    hot = {r["k"]: r["_salts"] for r in skew.hot_keys(many, ["k"], 4, 10).collect()}
    assert hot[1] == 40 and set(hot) <= {1, None}


def test_rows_of_the_hot_key_spread(sides):
    many, one = sides
    hot = F.broadcast(skew.hot_keys(many, ["k"], 16, 10))
    salted = many.join(hot, "k", "left").withColumn(
        "salt", F.pmod(F.xxhash64("v"), F.coalesce("_salts", F.lit(1))))
    counts = [r["count"] for r in salted.filter("k = 1").groupBy("salt").count().collect()]
    assert len(counts) > 20 and max(counts) < 40


def test_limit_does_not_grow_with_the_table(spark):
    """Ten keys with a tenth of the rows each are as hot in a long table as in a short one."""
    for copies in (20, 400):
        rows = spark.range(10 * copies).selectExpr("id % 10 AS k")
        found = [r["_salts"] for r in skew.hot_keys(rows, ["k"], 2, 10).collect()]
        assert found == [copies // 10] * 10


def test_small_data_needs_no_salts(sides):
    assert skew.hot_keys(sides[0], ["k"]).count() == 0


def test_counts_may_come_from_another_frame(sides, rows):
    many, one = sides
    other = many.unionByName(many)
    salted = skew.salted_join(many, one, ["k"], "inner", ["v"], count_on=other, buckets=16,
                              rows_per_salt=10)
    assert rows(salted) == rows(many.join(one, ["k"], "inner"))


def test_payload_bytes_counts_rows_and_texts(spark):
    small = spark.createDataFrame([("ab",), (None,)], "t STRING")
    assert skew.payload_bytes(small) == 2 * 24 + 2
    assert skew.payload_bytes(small.limit(0)) == 0
    nested = spark.createDataFrame([({"a": "x" * 1000},)], "m MAP<STRING,STRING>")
    assert skew.payload_bytes(nested) > 1000


def test_lookup_broadcasts_only_below_the_limit(sides, rows):
    many, one = sides
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()
    small = skew.lookup_join(many, one, ["k"], "left", ["v"])
    big = skew.lookup_join(many, one, ["k"], "left", ["v"], max_bytes=10)
    assert "_salt" not in plan(small) and "broadcast" in plan(small)
    assert "_salt" in plan(big)
    assert rows(small) == rows(big)
