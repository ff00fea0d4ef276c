"""Stored tables and what is observed while they are written."""

from pyspark.sql import functions as F

from boxframe.session import cut_lineage_counted, cut_lineage_observed


def jobs_of(spark, action):
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        out = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))


def test_rows_are_counted_as_they_are_written(spark):
    (stored, n), jobs = jobs_of(spark, lambda: cut_lineage_counted(spark.range(1000).where("id % 7 = 0")))
    assert n == 143 == stored.count()
    assert jobs <= 2  # the write, and reading the schema back


def test_empty_tables_count_nothing(spark):
    for df in (spark.range(10).where("id > 10"), spark.range(10).where("false"), spark.createDataFrame([], "a int"),
               spark.range(10).groupBy("id").count().where("count > 1")):
        stored, n = cut_lineage_counted(df)
        assert n == 0 and stored.count() == 0


def test_totals_are_those_of_the_stored_rows(spark):
    df = spark.range(500).selectExpr("id % 10 as a", "id as b").repartition(4, "a").groupBy("a").agg(F.max("b").alias("m"))
    stored, totals = cut_lineage_observed(df, "t", top=F.max("m"), total=F.sum(F.col("m").cast("decimal(38,0)")), none=F.max(F.lit(None).cast("int")))
    want = stored.agg(F.max("m").alias("top"), F.sum(F.col("m").cast("decimal(38,0)")).alias("total")).first()
    assert (totals["top"], totals["total"], totals["none"]) == (want.top, want.total, None)
