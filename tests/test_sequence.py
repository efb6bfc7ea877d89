import random

from pyspark.sql import functions as F

from logweave import operators as op
from logweave.operators.scan import running_max
from logweave.operators import sequence
from logweave.functions import sequence_id

from conftest import rows


def test_running_max_across_blocks(spark):
    rng = random.Random(5)
    data = [(p, n, rng.choice([None, rng.randint(0, 1000)])) for p in range(2) for n in rng.sample(range(500), 90)]
    df = spark.createDataFrame(data, "p int, n long, v long")
    for inclusive in (True, False):
        out = running_max(df, ["p"], "n", F.col("v"), "top", bits=3, inclusive=inclusive)
        for p, n, _, top in out.collect():
            before = [v for q, m, v in data if q == p and v is not None and (m < n or inclusive and m == n)]
            assert top == max(before, default=None)


def test_dense_numbers_per_group(spark):
    rng = random.Random(1)
    groups = ["a"] * 400 + ["b"] * 90 + [None] * 10
    data = [(g, rng.random(), i) for i, g in enumerate(groups)]
    df = spark.createDataFrame(data, "g string, x double, i int").repartition(6)
    out = op.stamp_sequence(df, ["x", "i"], ["g"]).collect()
    for g in ("a", "b", None):
        mine = sorted((r for r in out if r["g"] == g), key=lambda r: r["x"])
        assert [r["seq"] for r in mine] == list(range(len(mine)))


def test_dense_numbers_overall_with_a_frequent_value(spark):
    """Two thirds of the rows share the leading order value; the next column splits them."""
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("a"), "id")
    out = op.stamp_sequence(df, ["a", "id"], start=5)
    assert rows(out.select(F.min("seq"), F.max("seq"), F.count_distinct("seq"))) == [(5, 3004, 3000)]
    assert out.filter(F.col("a") == 7).agg(F.max("seq")).first()[0] == 2004


def test_large_summary_is_joined_by_shuffle(spark, monkeypatch):
    """More groups than fit a small side take the other join and give the same numbers."""
    df = spark.range(600).select((F.col("id") % 200).alias("g"), "id")
    want = rows(op.stamp_sequence(df, ["id"], ["g"]))
    small = sequence.small_side
    monkeypatch.setattr(sequence, "small_side", lambda side: small(side, 10))
    assert rows(op.stamp_sequence(df, ["id"], ["g"])) == want


def test_numbered_messages(spark):
    df = spark.range(1001).withColumn("at", F.timestamp_micros(F.col("id") * 1_000_000 + 5))
    out = op.numbered_messages(df, ["id"], F.col("at")).withColumn("n", sequence_id()).orderBy("id").collect()
    assert [r["n"] for r in out] == list(range(1001))
    assert bytes(out[1000]["value"]) == b"Message #1000 at 1970-01-01T00:16:40.000005Z"


def test_chunks_lose_nothing(spark):
    df = spark.range(31)
    sizes = op.chunk(df, ["id"], 10).groupBy("chunk").count()
    assert rows(sizes) == [(0, 10), (1, 10), (2, 10), (3, 1)]
