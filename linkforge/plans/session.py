"""Sessions: the local one of tests and benchmarks, and shipping the package to executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("linkforge")
        .config("spark.sql.shuffle.partitions", str(partitions)).config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Make the package importable by Python workers wherever they run; once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = Path(__file__).resolve().parents[2]
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    work = tempfile.mkdtemp(prefix="linkforge-zip-")
    atexit.register(shutil.rmtree, work, True)
    sc.addPyFile(shutil.make_archive(f"{work}/linkforge", "zip", root, "linkforge"))
