"""What a task holds as tables grow."""

from pyspark.sql import functions as F

from sigloom.operators.numbering import number_rows


def test_a_group_of_over_a_million_rows_is_no_single_task(spark):
    rows = spark.range(1_200_000).select(F.lit(1).alias("key"), "id")
    numbered = number_rows(rows, ["key"], ["id"])
    parts = numbered.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("rows"), F.count_if(F.col("pos") != F.col("id")).alias("wrong"))
    found = parts.collect()
    assert len(found) > 1 and sum(r.rows for r in found) == 1_200_000 and not any(r.wrong for r in found)
