import pytest
from pyspark.sql import functions as F

from lexatlas.llm import common


def test_staged_tables_and_release(spark):
    df = common.staged(spark.range(5).select(F.col("id"), F.lit(None).cast("string").alias("x")), "t")
    assert df.count() == 5 and df.schema["x"].dataType.simpleString() == "string"
    assert common.staged(df.where("false"), "t").count() == 0
    path = common.scratch_path(spark, "t").rpartition("/")[0].removeprefix("file://")
    import os

    assert os.listdir(path)
    common.release(spark)
    assert not os.path.exists(path)


def test_own_names_avoid_those_of_the_input(spark):
    df = spark.createDataFrame([(1, 2)], "__lx_a int, `__LX__b.c` int")
    assert not any(c.lower().startswith(common.own(df)) for c in df.columns)
    assert df.select(*common.columns(df.columns)).columns == df.columns


@pytest.mark.parametrize("key", ["a", None])
def test_unit_numbers(spark, key):
    u = spark.range(1000).select(common.unit(F.lit(key), F.col("id")).alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= u[0] < 0.02 and 0.98 < u[1] < 1 and abs(u[2] - 0.5) < 0.05
