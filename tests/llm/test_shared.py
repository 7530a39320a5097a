import pytest
from pyspark.sql import functions as F

from filingmill.llm import shared


def test_the_filter_loses_no_member(spark, monkeypatch):
    members = spark.range(0, 300, 3).select(F.xxhash64("id").alias("h"))
    for bits in (24, 8):
        monkeypatch.setattr(shared, "FILTER_BITS", bits)
        got = shared.possibly_in(spark.range(300), F.xxhash64("id"), members).collect()
        assert len(got) == 300 and got[0].asDict().keys() == {"id", "__hit"}
        assert all(r["__hit"] for r in got if r["id"] % 3 == 0)
        assert bits < 24 or sum(r["__hit"] for r in got) == 100
    assert not any(r["__hit"] for r in shared.possibly_in(spark.range(9), F.xxhash64("id"), members.limit(0)).collect())


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Session:
        class conf:
            @staticmethod
            def get(key, default):
                return default

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_root(Session)


def test_dropped_tables_are_gone(spark, tmp_path):
    scratch = []
    df = shared.staged(spark.range(5), "x", scratch)
    assert df.count() == 5 and len(scratch) == 1
    path = scratch[0]
    shared.drop_dirs(spark, scratch)
    assert not scratch and not spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(path))
