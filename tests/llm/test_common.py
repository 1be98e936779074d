"""The bounded sample: full however often rows are repeated, and the rows of the least keys."""

from pyspark.sql import functions as F

from heliopanel.llm import permutation_index as A
from heliopanel.llm.common import bounded_sample


def sample(rows, wanted):
    return [r["x"] for r in bounded_sample(rows.select("x"), F.xxhash64("x"), wanted).collect()]


def test_sample_of_many_copies(spark):
    rows = spark.range(0, 60_000, 1, 8)
    for distinct in (1, 10, 300):
        copies = rows.select((F.col("id") % distinct).alias("x"))
        plain = [r["x"] for r in spark.range(distinct).select(F.col("id").alias("x"))
                 .orderBy(F.pmod(F.xxhash64("x"), F.lit(1 << 40))).collect()]
        for wanted in (5, 20, 512):
            assert sample(copies, wanted) == plain[:wanted]
    assert sample(rows.select(F.col("id").alias("x")).limit(0), 5) == []
    # one value holds nearly all rows
    hot = rows.select(F.when(F.col("id") < 50, F.col("id")).otherwise(F.lit(7)).alias("x"))
    assert sorted(sample(hot, 512)) == list(range(50))


def test_sample_is_filtered(spark):
    rows = spark.range(0, 50_000, 1, 8).select(F.col("id").alias("x"))
    want = rows.orderBy(F.pmod(F.xxhash64("x"), F.lit(1 << 40))).limit(64)
    got = bounded_sample(rows, F.xxhash64("x"), 64)
    assert [r["x"] for r in got.collect()] == [r["x"] for r in want.collect()]
    assert "Filter" in got._jdf.queryExecution().optimizedPlan().toString()


def test_pivots_of_many_copies(spark):
    rows = spark.range(0, 50_000, 1, 8).select("id", F.array(F.col("id") % 10 + 1.0, F.lit(1.0)).alias("vec"))
    assert len(A.choose_pivots(rows)) == 10
    assert len(A.choose_pivots(rows, 4)) == 4
