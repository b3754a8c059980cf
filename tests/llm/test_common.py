import glob
import time

from pyspark.sql import functions as F

from tradescope.llm import common


def test_cut_and_drop(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    out = common.cut(df)
    assert out.collect() == df.collect() and out.schema == df.schema
    assert common.cut(df.limit(0)).count() == 0
    common.drop_cuts(spark)
    assert common.CUTS == []


def test_cut_frees_its_shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}

    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    kept = files()
    out = common.cut(df, free=True)
    for _ in range(50):  # files are deleted in the background
        if files() <= kept:
            break
        time.sleep(0.1)
    assert files() <= kept and out.count() == 7
    assert spark.conf.get(common.FREE_SHUFFLES) == "false"
    common.cut(df)
    assert not files() <= kept
    assert sorted(df.collect()) == sorted(out.collect())
    common.drop_cuts(spark)
