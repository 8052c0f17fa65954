"""Session settings and the few physical helpers that every operator shares."""

from __future__ import annotations

import os
import re
import sys
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest small side, in bytes by the optimizer's estimate, that is sent to all executors on purpose.
BROADCAST_LIMIT = 16 * 1024 * 1024


def get_spark(app: str = "bazaarlens", master: str = "local[8]", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings the session."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def share_package(spark: SparkSession) -> None:
    """Let Python workers that see this folder import the package from it, whatever their working folder is."""
    here, env = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if here not in known:
        env["PYTHONPATH"] = os.pathsep.join([here, *filter(None, known)])


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names; on one machine a temporary one where none is named; elsewhere that is an error."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc._jsc.sc().getCheckpointDir()
    if named:
        plain = re.sub(r"^file:/*", "/", named).rstrip("/")
        if current.isEmpty() or plain not in re.sub(r"^file:/*", "/", current.get()):
            sc.setCheckpointDir(named)
    elif current.isEmpty():
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="bazaarlens-checkpoint-"))


def work_path(spark: SparkSession, stem: str) -> str:
    """A path for a new table in the checkpoint folder, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip('/')}/{stem}-{uuid.uuid4().hex}"


def unused_view(spark: SparkSession, stem: str) -> str:
    """A name for a temporary view that clashes with none."""
    return f"{stem}_{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the checkpoint folder and read it back.

    Lost executors and loops then replay no plan, and the optimizer knows the real size of the rows
    that are left, where a checkpoint would keep the estimate of the plan that it cuts.
    """
    path = work_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of ``df``; estimates too long to be read count as endless."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except ValueError:
        return sys.maxsize


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``df`` with a broadcast hint if its estimated size is under ``limit``, else ``df`` as it is."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def unused_name(df: DataFrame, stem: str) -> str:
    """A column name that begins with ``stem`` and clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    name, k = stem, 0
    while name.lower() in taken:
        k += 1
        name = f"{stem}_{k}"
    return name
