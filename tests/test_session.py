import time

import pytest
from pyspark.sql import functions as F

from harborline.session import SHUFFLE_CLEANUP_CONF, materialize, released_shuffles
from harborline.sources.published import Published


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def left_behind(spark, before: set[str]) -> set[str]:
    """New shuffle files, once those on their way out had time to go."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def joined(spark):
    rows = spark.range(5000).selectExpr("id", "id % 40 AS g", "DATE_ADD(DATE '2026-01-01', CAST(id % 3 AS INT)) AS day")
    return rows.repartition(3, "id").join(spark.range(0, 5000, 2).repartition(3, "id").hint("merge"), "id")


def test_a_written_cut_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    grouped = joined(spark).groupBy("g").count()
    stored = materialize(grouped)
    assert left_behind(spark, before) == set()
    assert sorted(stored.collect()) == sorted(grouped.collect()) == sorted(grouped.collect())


@pytest.mark.parametrize("by", [None, "day"])
def test_a_build_leaves_no_shuffle_files(spark, tmp_path, by):
    store = Published(spark, str(tmp_path))
    build, before = store.begin(), shuffle_files(spark)
    grouped = joined(spark).groupBy("g", "day").count()
    build.replace("t", grouped, by=by, metrics={"n": F.count(F.lit(1))})
    files = list(tmp_path.rglob("part-*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
    # counting the rows of the parts shuffles a row per part and task, which the driver's clean-up takes later
    left = left_behind(spark, before)
    assert len({n.split("_")[1] for n in left}) <= 1
    assert build.counted["t"]["n"] == build.table("t").count() == grouped.count()


@pytest.mark.parametrize("value", [None, "true", "false"])
def test_the_setting_is_put_back(spark, value):
    if value is not None:
        spark.conf.set(SHUFFLE_CLEANUP_CONF, value)
    try:
        with pytest.raises(ZeroDivisionError), released_shuffles(spark):
            assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == "true"
            1 / 0
        assert spark.conf.get(SHUFFLE_CLEANUP_CONF, None) == (value or None)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP_CONF)
