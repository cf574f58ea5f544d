import pytest
from pyspark.sql import functions as F

import sluice.session as S


def test_work_folders_are_new_and_shared(spark):
    one, two = S.work_folder(spark, "a"), S.work_folder(spark, "a")
    root = spark.conf.get(S.CHECKPOINT_SETTING, None)
    assert one != two and (root is None or one.startswith(root))


def test_written_keeps_rows_and_schema(spark):
    df = spark.range(10).select("id", F.create_map(F.lit("k"), F.col("id")).alias("m")).where("id > 3")
    stored = S.written(df, "t")
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert sorted(r["id"] for r in stored.collect()) == list(range(4, 10))
    assert S.written(df.where("id > 100"), "t").isEmpty()


def test_side_by_side(spark):
    assert S.side_by_side(spark, [lambda i=i: spark.range(i).count() for i in range(12)]) == list(range(12))
    with pytest.raises(ZeroDivisionError):
        S.side_by_side(spark, [lambda: 1, lambda: 1 // 0])


def test_scratch_tables_leave_nothing(spark):
    scratch = S.Scratch(spark)
    stored = scratch.written(spark.range(5), "t")
    names = list(scratch.names)
    assert stored.count() == 5 and spark.catalog.tableExists(names[0])
    scratch.drop()
    assert not spark.catalog.tableExists(names[0]) and scratch.names == []


def test_work_folder_needs_a_shared_one(spark):
    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("X", (), {"master": "local-cluster[2,1,1024]"})

    with pytest.raises(RuntimeError, match="must name a folder"):
        S.work_folder(Cluster, "x")


def test_scratch_tables_lie_in_the_shared_folder(spark):
    root = spark.conf.get(S.CHECKPOINT_SETTING).rstrip("/").split("://")[-1]
    scratch = S.Scratch(spark)
    stored = scratch.written(spark.range(5).withColumn("k", F.col("id") % 2), "t", ["k"])
    found, folder = [f.split("://")[-1] for f in stored.inputFiles()], scratch.folders[0]
    assert found and all(f"{root}/scratch_t_" in f for f in found) and stored.where("k = 1").count() == 2
    scratch.drop()
    assert S.folder_names(spark, folder) == []
