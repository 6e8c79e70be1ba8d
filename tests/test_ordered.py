from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.ordered import middle_values, ordered_index, rank_by, running_sum


def _frame(spark, n=20000):
    # a third of the rows share one value: the skewed case
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 101).cast("decimal(18,2)").alias("v"))


def test_ordered_index_is_dense_and_follows_order(spark):
    df = _frame(spark)
    got = ordered_index(df, [F.col("v").desc(), "id"], "i", partitions=6)
    ref = df.withColumn("r", F.row_number().over(Window.orderBy(F.col("v").desc(), "id")))
    assert got.join(ref, "id").where("i != r").count() == 0
    assert got.agg(F.min("i"), F.max("i"), F.count_distinct("i")).first() == (1, 20000, 20000)


def test_running_sum_matches_window(spark):
    df = _frame(spark)
    got = running_sum(df, [F.col("v").desc(), "id"], "v", "c", partitions=6)
    ref = df.withColumn("r", F.sum("v").over(
        Window.orderBy(F.col("v").desc(), "id").rowsBetween(Window.unboundedPreceding, 0)))
    assert got.join(ref, "id").where("c != r").count() == 0


def test_rank_and_dense_rank_match_window(spark):
    df = _frame(spark, 5000)
    got = rank_by(rank_by(df, "v", "rk"), "v", "drk", dense=True)
    ref = (df.withColumn("rk2", F.rank().over(Window.orderBy(F.col("v").desc())))
           .withColumn("drk2", F.dense_rank().over(Window.orderBy(F.col("v").desc()))))
    assert got.join(ref, "id").where("rk != rk2 or drk != drk2").count() == 0


def test_middle_values_give_exact_median(spark):
    odd = spark.createDataFrame([(i, v) for i, v in enumerate([5, 1, 9, 3, 7])], "k int, v int")
    assert middle_values(odd, "v", ["k"]).first() == (5, 5)
    even = spark.createDataFrame([(i, v) for i, v in enumerate([4, 1, 3, 2, None])], "k int, v int")
    assert middle_values(even, "v", ["k"]).first() == (2, 3)
