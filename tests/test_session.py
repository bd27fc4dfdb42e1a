import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark import cloudpickle

from tillcast.operators import seasonal
from tillcast.plans.catalog import stub_answer
from tillcast.session import checkpoint_folder, cut_lineage, ensure_checkpoint_dir, shared_folder


def test_checkpoints_go_to_the_folder_of_the_session(spark):
    ensure_checkpoint_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir")
    assert named in spark.sparkContext.getCheckpointDir()
    assert shared_folder(spark, "x").startswith(named) and shared_folder(spark, "x") != shared_folder(spark, "x")
    cut = cut_lineage(spark.range(10).selectExpr("id * 2 as v"))
    assert cut.count() == 10
    assert "Scan ExistingRDD" in cut._jdf.queryExecution().executedPlan().toString()


class Session:
    """Enough of a session for the choice of the folder."""

    def __init__(self, master, **conf):
        self.conf, self.sparkContext, self.master, self.folder = conf, self, master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_cluster_needs_a_named_folder():
    for master in ("local-cluster[3,2,1024]", "yarn", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_folder(Session(master))
        named = Session(master, **{"spark.checkpoint.dir": "hdfs://shared"})
        assert checkpoint_folder(named) == "hdfs://shared"
        ensure_checkpoint_dir(named)
        assert named.folder == "hdfs://shared"


def test_a_local_session_gets_a_temporary_folder():
    session = Session("local[2]")
    folder = checkpoint_folder(session)
    assert Path(folder).is_dir() and checkpoint_folder(session) == folder == session.folder


def test_functions_reach_workers_that_lack_the_package(tmp_path):
    """What Spark sends to a worker must not import this package there."""
    (tmp_path / "fn.pickle").write_bytes(cloudpickle.dumps((seasonal._forecast_group, stub_answer)))
    script = """
        import importlib.util, pickle
        assert importlib.util.find_spec("tillcast") is None
        fit, answer = pickle.load(open("fn.pickle", "rb"))
        print(answer("abc"))
    """
    done = subprocess.run(
        [sys.executable, "-I", "-c", textwrap.dedent(script)], cwd=tmp_path, capture_output=True, text=True, timeout=60
    )
    assert done.stdout.strip() == "3 characters", done.stderr


def test_tasks_at_once_keep_settings_results_and_errors(spark):
    import threading

    from tillcast.session import at_once

    meet, pools = threading.Barrier(2, timeout=60), {}

    def task(name, n):
        meet.wait()  # both run at the same time
        pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        return spark.range(n).count()

    assert at_once(spark, one=lambda: task("one", 5), two=lambda: task("two", 7)) == {"one": 5, "two": 7}
    assert pools == {"one": "one", "two": "two"} and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None

    def fails():
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        at_once(spark, good=lambda: 1, bad=fails)
