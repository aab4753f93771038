from pyspark.sql import Window
from pyspark.sql import functions as F

from ludolytics.operators.ranking import ranked_top_k, top_k_per_group


def skewed(spark):
    """A third of all rows in one group, many equal values."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 20).alias("v"),
        "id",
    )


def test_top_k_per_group_equals_plain_window(spark):
    df = skewed(spark)
    order = [F.col("v").desc_nulls_last(), F.col("id")]
    for k in (1, 5, 60):
        w = Window.partitionBy("g").orderBy(*order)
        expected = df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        rows = set(map(tuple, expected.collect()))
        for slices in (1, 7):
            got = top_k_per_group(df.repartition(5), ["g"], order, k, "rank", slices)
            assert set(map(tuple, got.collect())) == rows


def test_map_side_limit_is_planned(spark):
    """Both with and without slices the limit comes before the first shuffle of the rows."""
    order = [F.col("v").desc_nulls_last(), F.col("id")]
    for slices in (1, 7):
        df = top_k_per_group(skewed(spark), ["g"], order, 5, "rank", slices)
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        assert plan.count("Partial") == plan.count("Exchange") == (1 if slices == 1 else 2)


def test_ranks_have_no_gaps(spark):
    rows = ranked_top_k(skewed(spark), [F.col("v").desc_nulls_last(), F.col("id")], 17, "rank")
    assert sorted(r["rank"] for r in rows.collect()) == list(range(1, 18))
