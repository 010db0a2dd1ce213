import os
import tempfile
import uuid

from shoplens.session import shared_dir
from shoplens.sources.sinks import write_table


def test_write_table_replaces_and_partitions(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="run-"), "t")
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "date string, v long")
    write_table(df, d, partition_by=["date"])
    write_table(df.where("v = 2"), d, partition_by=["date"])  # replace, not append
    assert "date=2024-01-01" not in os.listdir(d) and "date=2024-01-02" in os.listdir(d)
    back = spark.read.schema("v long, date string").parquet(d)
    assert [tuple(r) for r in back.collect()] == [(2, "2024-01-02")]


def test_write_table_replaces_a_catalog_table(spark):
    name = f"sink_{uuid.uuid4().hex[:8]}"
    write_table(spark.createDataFrame([(1, "old")], "v long, date string"), name, ["date"], as_path=False)
    write_table(spark.createDataFrame([(2, "new")], "v long, date string"), name, ["date"], as_path=False)
    assert [(r.v, r.date) for r in spark.table(name).collect()] == [(2, "new")]
    spark.sql(f"DROP TABLE {name}")


def test_shared_dir_from_checkpoint_setting(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(base)


def test_partitioned_write_is_rebalanced(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="run-"), "t")
    df = spark.range(3000).selectExpr("CAST(id % 3 AS STRING) AS date", "id AS v").repartition(8)
    write_table(df, d, partition_by=["date"])
    for folder in ("date=0", "date=1", "date=2"):
        files = [f for f in os.listdir(os.path.join(d, folder)) if f.endswith(".parquet")]
        assert len(files) == 1, folder  # not one small file per input task


def test_shared_dir_unset_is_an_error_off_local_masters(monkeypatch):
    from types import SimpleNamespace

    import pytest
    conf = SimpleNamespace(get=lambda *a: None)
    session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: conf))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session)
