from __future__ import annotations

import pytest

from accountloom import settings as S
from tests.support import TESTDATA, settings


def test_bytes_are_the_file_sizes(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.bin").write_bytes(b"1" * 1000)
    (tmp_path / "y.bin").write_bytes(b"1" * 234)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert S.stored_bytes(spark, str(tmp_path)) == 1234
    assert S.stored_bytes(spark, f"{TESTDATA}/orders.parquet") > 0
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


@pytest.mark.parametrize(
    "size, partitions, split",
    [
        (0, 8, None),
        (3 * 1024 * S.MIB, 12, None),
        (100 * 1024**2 * S.MIB, 200_000, 524 * S.MIB),
        (10 * 1024**2 * S.MIB, 40_960, None),
        (1000 * 1024**2 * S.MIB, 200_000, 1024 * S.MIB),
    ],
)
def test_sizes_follow_the_input_and_are_never_lowered(spark, size, partitions, split):
    names = {
        "spark__sql__shuffle__partitions": "8",
        "spark__sql__files__maxPartitionBytes": str(128 * S.MIB),
    }
    with settings(spark, **names):
        S.size_for(spark, size)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == partitions
        chosen = int(spark.conf.get("spark.sql.files.maxPartitionBytes")) // S.MIB
        assert chosen == (128 if split is None else split // S.MIB)
        S.size_for(spark, 1)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == partitions


def test_scratch_lies_in_the_shared_folder_and_is_new_each_time(spark):
    with settings(spark, spark__sql__shuffle__partitions="8"):
        first, second = S.scratch_folder(spark, "x"), S.scratch_folder(spark, "x")
    assert first != second
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or first.startswith(shared)


class _Conf(dict):
    get = dict.get


class _Session:
    def __init__(self, **conf):
        self.conf = _Conf({n.replace("__", "."): v for n, v in conf.items()})


def test_a_cluster_must_name_its_shared_folder():
    named = _Session(spark__master="yarn", spark__checkpoint__dir="hdfs:///scratch/")
    assert S.scratch_folder(named, "x").startswith("hdfs:///scratch/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.scratch_folder(_Session(spark__master="yarn"), "x")
    assert S.scratch_folder(_Session(spark__master="local[2]"), "x")


def test_partitions_at_a_hundred_terabytes_fit_in_memory():
    assert 100 * 1024**2 * S.MIB / S.MAX_SHUFFLE_PARTITIONS < 600 * S.MIB


def test_sizing_runs_no_job(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a\n" * 100)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sizing", "sizing")
    assert S.stored_bytes(spark, str(tmp_path)) == 200
    assert list(tracker.getJobIdsForGroup("sizing")) == []
    spark.sparkContext.setJobGroup("", "")
