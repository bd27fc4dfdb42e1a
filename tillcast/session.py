"""Session settings, the checkpoint folder and the folder for tables between two steps."""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning picks broadcast joins by measured size, splits skewed join partitions and
# sizes shuffle partitions; the fixed UTC zone keeps calendar days stable.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture on every column call makes building a plan take longer than small queries run.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(app_name: str, master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that the session names in `spark.checkpoint.dir`. A session inside one process
    (`local[...]`) that names none gets a temporary folder, removed at exit; on a cluster that would be lost
    with its machine, so there the setting is required."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder or context.getCheckpointDir():
        return folder or context.getCheckpointDir()
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="tillcast-checkpoint-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    folder = checkpoint_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Evaluates `df` once into the checkpoint folder, for frames that several branches read. Readers
    then survive lost executors without repeating the work behind it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the checkpoint folder, for tables that one step writes and the next reads."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def at_once(spark: SparkSession, **tasks: Callable[[], object]) -> dict[str, object]:
    """Results of `tasks`, each run in a driver thread that carries the session's settings, with a scheduler pool of
    its own. For work made of many small jobs, which alone leaves most cores idle. The first error is raised
    after all have ended."""
    results, errors = {}, []

    def run(name: str, task: Callable[[], object]) -> None:
        try:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            results[name] = task()
        except Exception as error:
            errors.append(error)

    threads = [InheritableThread(target=run, args=item, session=spark) for item in tasks.items()]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if errors:
        raise errors[0]
    return results
