"""What operators need from the session."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Texts of so many bytes are work enough for a task.
SPREAD_BYTES = 1 << 20

#: Workers give what a batch took back to the system instead of keeping it for the next one.
MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": str(4 << 20)}


def importable(spark: SparkSession | None = None) -> None:
    """Let Python workers that are started from now on find this package.

    A local session's workers find it where the driver has it. To a cluster's executors, whose disks don't have the driver's
    folders, it is sent as an archive, once a session.
    """
    spark = spark or SparkSession.active()
    context = spark.sparkContext
    root, known = str(Path(__file__).resolve().parents[1]), context.environment
    for name, value in MEMORY.items():
        known.setdefault(name, value)
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))
        if not context.master.startswith("local"):
            folder = tempfile.mkdtemp()
            context.addPyFile(shutil.make_archive(f"{folder}/{Path(__file__).parent.name}", "zip", root, Path(__file__).parent.name))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it. Only a local session may do without one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (named or tempfile.mkdtemp(prefix="shared-")).rstrip("/")


def spread(rows: DataFrame) -> DataFrame:
    """The rows over all cores if they come in fewer partitions of many bytes each: one file of long texts would otherwise be
    one task. What is shuffled is bounded by SPREAD_BYTES for each core and partition; larger inputs have small enough splits
    of their own and stay as they are read."""
    spark = rows.sparkSession
    cores, parts = spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()
    split = str(spark.conf.get("spark.sql.files.maxPartitionBytes")).rstrip("b")
    most = (int(split) if split.isdigit() else 128 << 20) * min(parts + 1, 8)
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows.repartition(cores) if 0 < parts < cores and SPREAD_BYTES < size <= most else rows
