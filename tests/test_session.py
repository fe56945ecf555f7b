from types import SimpleNamespace

import pytest

from titlemart.session import shared_dir, write_shared


def session(folder, master):
    context = SimpleNamespace(applicationId="app", master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)


def test_shared_folder_comes_from_the_session():
    assert shared_dir(session("hdfs://x/shared/", "yarn")) == "hdfs://x/shared/titlemart/app"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session(None, "yarn"))


def test_written_tables_have_a_known_size(spark):
    small = write_shared(spark.range(10), "small")
    big = spark.range(10_000_000).selectExpr("id", "id AS other")
    plan = big.join(small, "id", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
