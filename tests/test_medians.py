import random
from decimal import Decimal
from statistics import median_high, median_low

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.medians import group_middles, with_middles


def brute(rows):
    by = {}
    for g, v in rows:
        if v is not None:
            by.setdefault(g, []).append(v)
    return {g: (median_low(v), median_high(v)) for g, v in by.items()}


def frame(spark, rows, path):
    spark.createDataFrame(rows, "g string, v decimal(38,8)").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("limit", [100_000, 20])
def test_middles_of_groups(spark, tmp_path, limit):
    rng = random.Random(1)
    rows = [(g, Decimal(rng.randrange(-10 ** 6, 10 ** 6)) / 1000) for g, n in (("a", 1), ("b", 2), ("c", 501), ("d", 800)) for _ in range(n)]
    rows += [("ties", Decimal(7))] * 300 + [("ties", Decimal(k)) for k in range(60)]          # one value holds most rows
    rows += [("two", Decimal(1))] * 100 + [("two", Decimal(2))] * 100                          # the middles differ
    rows += [(None, Decimal(5)), (None, Decimal(9)), ("nulls", None), ("big", Decimal("123456789012345678901234567890.12345678"))]
    df = frame(spark, rows, str(tmp_path / "t"))
    got = {r["g"]: (r["lo"], r["hi"]) for r in group_middles(df, "v", ["g"], limit).collect()}
    assert got == brute(rows)
    whole = group_middles(df, "v", limit=limit).first()
    assert (whole["lo"], whole["hi"]) == brute([(1, v) for _, v in rows])[1]


def test_no_values(spark, tmp_path):
    df = frame(spark, [("a", None)], str(tmp_path / "t"))
    assert group_middles(df, "v", ["g"]).collect() == []
    assert tuple(group_middles(df, "v").first() or (None, None)) == (None, None)


def test_nothing_but_sketches_and_few_values_is_exchanged(spark, tmp_path):
    """A hot group is not gathered: the rows ranked are those of the last bracket."""
    spark.range(50_000).select(F.lit("hot").alias("g"), (F.hash("id") % 100_000).cast("decimal(38,8)").alias("v")) \
        .write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = group_middles(df, "v", ["g"], limit=2_000)
    values = [r["v"] for r in df.select("v").collect()]
    assert tuple(got.first())[1:] == (median_low(values), median_high(values))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and "rangepartitioning" not in plan


def test_with_middles_joins_null_groups(spark, tmp_path):
    rows = [("a", Decimal(1)), ("a", Decimal(3)), (None, Decimal(4)), ("n", None)]
    out = with_middles(frame(spark, rows, str(tmp_path / "t")), {"m": "v"}, ["g"]).collect()
    assert sorted((str(r["g"]), r["m"] and (int(r["m"]["lo"]), int(r["m"]["hi"]))) for r in out) == [
        ("None", (4, 4)), ("a", (1, 3)), ("a", (1, 3)), ("n", None)]
