import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martkit.functions.times import local_hour
from martkit.session import (
    REMOVE_SHUFFLES,
    discard,
    materialize,
    require_utc,
    scratch_path,
    shared_dir,
    shuffles_removed,
    sizing,
)


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


UNSET = """
import sys
sys.path.insert(0, sys.argv[1])
from martkit.session import build_session, materialize, scratch_path, shared_dir
spark = build_session("unset", "local[1]", {"spark.ui.enabled": "false"})
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert shared_dir(spark) == shared_dir(spark)
assert scratch_path(spark, "x").startswith(shared_dir(spark))
assert materialize(spark.range(3), "x").count() == 3
"""


def test_local_session_without_a_shared_dir(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    environment = {**os.environ, "SPARK_CONF_DIR": str(tmp_path)}
    command = [sys.executable, "-c", UNSET, root]
    done = subprocess.run(command, env=environment, cwd=tmp_path, timeout=120, capture_output=True)
    assert done.returncode == 0, done.stderr[-2000:]


class Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)


def test_cluster_must_name_a_shared_dir():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster)


def test_materialize_cuts_the_lineage(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    stored = materialize(df, "numbers")
    assert stored.dtypes == df.dtypes
    assert sorted(stored.collect()) == sorted(df.collect())
    assert all(path.startswith("file:") for path in stored.inputFiles())


def test_t2_zone_must_be_utc(spark, set_conf):
    require_utc(spark)
    moment = spark.sql("SELECT timestamp'2024-06-12T19:45:30Z' AS time")
    assert moment.select(local_hour(F.col("time"))).first()[0] == "4"
    set_conf(spark__sql__session__timeZone="Asia/Tokyo")
    with pytest.raises(ValueError, match="UTC"):
        require_utc(spark)


def test_sizing_is_bounded():
    counts = [int(sizing(size)["spark.sql.shuffle.partitions"]) for size in (0, 1 << 40, 100 << 40)]
    assert counts == [200, 4096, 409_600]
    with pytest.raises(ValueError, match="split the job"):
        sizing(1 << 50)


def test_discard_deletes_stored_tables_only(spark, tmp_path):
    stored, other = materialize(spark.range(10), "gone"), materialize(spark.range(10), "kept")
    folder = Path(stored.inputFiles()[0].removeprefix("file:")).parent
    assert folder.exists()
    discard(stored)
    assert not folder.exists() and other.count() == 10
    spark.range(3).write.parquet(f"{tmp_path}/own")
    with pytest.raises(ValueError, match="own"):
        discard(spark.read.parquet(f"{tmp_path}/own"))


def test_shuffles_removed_ends_with_its_block(spark, set_conf):
    set_conf(**{REMOVE_SHUFFLES.replace(".", "__"): "false"})
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark):
        assert spark.conf.get(REMOVE_SHUFFLES) == "true"
        1 / 0
    assert spark.conf.get(REMOVE_SHUFFLES) == "false"
