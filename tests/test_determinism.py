import pytest
from pyspark.sql import functions as F

from regspark.operators.determinism import OTHER_WAYS, dealt, differing


def test_what_depends_on_partitions_is_found(spark):
    make = lambda: spark.range(100).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id").withColumn("p", F.spark_partition_id())
    assert differing(spark, make) == list(OTHER_WAYS)
    assert differing(spark, lambda: spark.range(100).groupBy((F.col("id") % 7).alias("k")).agg(F.sum(F.col("id") / 3).alias("s"))) == []


def test_settings_come_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ZeroDivisionError), dealt(spark, OTHER_WAYS[0]):
        1 / 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
