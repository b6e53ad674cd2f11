"""Versions and the manifest: all tables switch at once, or none."""

import pytest
from pyspark.sql import functions as F

from harborline.sources.published import PublishConflict, Published


@pytest.fixture
def store(spark, tmp_path):
    return Published(spark, str(tmp_path / "tables"))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_reader_keeps_the_build_it_began_with(spark, store):
    first = store.begin()
    first.replace("a", spark.range(3).toDF("x"))
    first.replace("b", spark.sql("SELECT 'old' AS v"))
    assert store.snapshot().number == 0 and not store.snapshot().tables
    before = first.publish(by="first")
    second = store.begin()
    second.replace("a", spark.range(5).toDF("x"))
    assert before.table("a").count() == store.snapshot().table("a").count() == 3, "not published yet"
    second.replace("b", spark.sql("SELECT 'new' AS v"))
    second.publish(other="second")
    assert (before.table("a").count(), rows(before.table("b"))) == (3, [("old",)])
    now = store.snapshot()
    assert (now.table("a").count(), rows(now.table("b"))) == (5, [("new",)])
    assert now.properties == {"by": "first", "other": "second"}
    assert rows(store.snapshot(1).table("b")) == [("old",)]


def test_a_build_that_fails_changes_nothing(spark, store):
    good = store.begin()
    good.replace("a", spark.range(3).toDF("x"))
    good.publish()
    bad = store.begin()
    bad.replace("a", spark.range(9).toDF("x"))
    with pytest.raises(Exception, match="planted"):
        bad.replace("b", spark.range(3).selectExpr("CASE WHEN id = 2 THEN raise_error('planted') END AS x"))
    assert store.snapshot().table("a").count() == 3 and "b" not in store.snapshot()


def test_of_two_builds_the_later_one_gives_way(spark, store):
    one, two = store.begin(), store.begin()
    for build in (one, two):
        build.replace("a", spark.range(1).toDF("x"))
    one.publish()
    with pytest.raises(PublishConflict):
        two.publish()
    assert store.snapshot().number == 1


def test_parts_that_are_not_touched_stay_in_their_folders(spark, store):
    build = store.begin()
    build.replace("t", spark.sql("SELECT * FROM VALUES (1, 'p'), (2, 'q'), (3, 'q'), (4, NULL) t(x, p)"), by="p")
    old = build.publish()
    assert {p: at.rows for p, at in old.tables["t"].parts.items()} == {"p": 1, "q": 2, "none": 1}
    build = store.begin()
    build.replace_parts("t", spark.sql("SELECT 9 AS x, 'q' AS p UNION ALL SELECT 8, 'r'"), "p", ["q", "r", "none"])
    new = build.publish()
    assert rows(new.table("t")) == [(1, "p"), (8, "r"), (9, "q")]
    assert rows(new.table("t", ["p", "absent"])) == [(1, "p")] and rows(new.table("t", [])) == []
    assert new.tables["t"].parts["p"] == old.tables["t"].parts["p"]
    assert len(rows(old.table("t"))) == 4
    with pytest.raises(ValueError, match="not touched"):
        store.begin().replace_parts("t", spark.sql("SELECT 1 AS x, 'z' AS p"), "p", ["q"])


def test_hidden_parts_metrics_and_empty_tables(spark, store):
    build = store.begin()
    stored = build.replace("t", spark.range(10).selectExpr("id", "id % 3 AS g"), by="g", hidden=True,
                           metrics={"not_null:id": F.expr("COUNT_IF(id IS NULL)"), "high": F.expr("COUNT_IF(id > 6)")})
    assert stored.columns == ["id"] and stored.count() == 10
    assert build.counted["t"] == {"not_null:id": 0, "high": 3}
    build.replace("empty", spark.range(0).toDF("x"), by="x")
    build.replace_parts("t", spark.range(0).selectExpr("id", "id AS g"), "g", ["0", "1", "2"], hidden=True)
    now = build.publish()
    assert now.table("empty").columns == ["x"] and now.table("empty").count() == now.table("t").count() == 0


def test_a_third_of_all_rows_in_one_part(spark, store):
    build = store.begin()
    build.replace("t", spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'p' || id % 7 END AS p"), by="p")
    assert {p: at.rows for p, at in build.publish().tables["t"].parts.items()}["hot"] == 1000


def test_parts_may_be_longer_than_a_value(spark, tmp_path):
    store = Published(spark, str(tmp_path / "monthly"), {"d": 7})
    build = store.begin()
    build.replace("t", spark.sql("SELECT id AS x, DATE_ADD(DATE'2031-01-30', CAST(id AS INT)) AS d FROM RANGE(5)"), by="d")
    assert {p: at.rows for p, at in build.publish().tables["t"].parts.items()} == {"2031-01": 2, "2031-02": 3}
