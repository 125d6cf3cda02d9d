import time

from pyspark.sql import functions as F

from ludoshelf import schemas
from ludoshelf.sources.landing import read_landing, write_landing
from ludoshelf.sources.staging import CLEANUP_CONF, Staging


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return {name for name in (path.rpartition("/")[2] for path in files.split()) if name.startswith("shuffle_")}


def left(spark, before):
    for _ in range(20):  # files are removed a little later
        if not (more := shuffle_files(spark) - before):
            break
        time.sleep(0.5)
    return more


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP_CONF, None)
    rows = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("n"))
    joined = rows.join(rows.withColumnRenamed("n", "m").hint("merge"), "k")
    staged = Staging(spark)(joined, "joined")
    assert not left(spark, before)
    assert sorted(tuple(r) for r in staged.collect())[699] == (699, 7, 7)
    pages = spark.range(300).selectExpr("'reviews' request_kind", "id app_id", "'body' body")
    names = [part.split(" ")[0] for part in schemas.LANDING.split(", ")]
    landing = pages.select(*[c if c in pages.columns else F.lit(None).alias(c) for c in names]).to(spark.createDataFrame([], schemas.LANDING).schema)
    write_landing(landing, str(tmp_path / "landing"))
    assert not left(spark, before)
    assert read_landing(spark, str(tmp_path / "landing")).where("app_id is not null").collect()[0].body == "body"
    assert spark.conf.get(CLEANUP_CONF, None) == setting
