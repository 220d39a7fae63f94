"""Where intermediate tables live.

Executors can be lost at any time and share no local disk, so everything that cuts lineage goes to the
folder that the cluster names in ``spark.checkpoint.dir``.  A folder of our own is made only where that
setting is empty, as in unit tests on one machine; off one machine that is an error.

Operators delete the tables that their results do not read any more.  What lazy results still read stays until
``release``, which deletes all of a session's tables.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables; ``RuntimeError`` if a cluster names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.sparkContext.master.startswith("local")
    if named:
        # local-cluster runs its executors beside the driver, where they may share a folder.
        if named.startswith("file:") and not local:
            raise RuntimeError(f"spark.checkpoint.dir is {named}: a folder of one machine is not shared")
        return named.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="acreflow-"))
    return f"file://{_own[0]}"


def shared_folder(spark: SparkSession) -> str:
    """A new path in the shared folder, which ``release`` deletes."""
    path = f"{shared_dir(spark)}/acreflow/{uuid.uuid4().hex}/files"
    _written.append(path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed now and kept as a reliable checkpoint, with no lineage."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back.

    Preferred over a checkpoint for wide tables: columnar, compressed and prunable.
    """
    path = f"{shared_dir(df.sparkSession)}/acreflow/{uuid.uuid4().hex}/{name}"
    _written.append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._acreflow_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path.rsplit("/", 1)[0])
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    if path in _written:
        _written.remove(path)


def forget(*tables: DataFrame) -> None:
    """Deletes tables that ``stored`` returned and that nothing reads any more."""
    for t in tables:
        _delete(t.sparkSession, t._acreflow_path)


def release(spark: SparkSession) -> None:
    """Deletes all tables that ``stored`` wrote and that are still there; results that read them are void then."""
    for path in list(_written):
        _delete(spark, path)


def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; it steers the number of blocks, never the result."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def rows_keep_order(df: DataFrame) -> bool:
    """Whether a plan reads files or literal rows and does no more than choose among them, so that each run of it, and
    each retry of a task, meets the same rows in the same order."""
    plan = str(df._jdf.queryExecution().optimizedPlan())
    nodes = re.findall(r"^[\s:+-]*(\w+)", plan, re.MULTILINE)
    return all(n in ("Project", "Filter", "Relation", "RelationV2", "LocalRelation", "LogicalRDD") for n in nodes)
