"""What a session needs before Python workers start."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def make_importable(spark: SparkSession) -> None:
    """Lets Python workers that start from now on import this package from where the driver has it.

    On a cluster without a common path, ship the package with --py-files.
    """
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


#: The folder of local runs without the setting.
_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or for a local master one that goes with the process."""
    if base := spark.conf.get("spark.checkpoint.dir", None):
        return base.rstrip("/")
    if not _LOCAL:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        _LOCAL.append(tempfile.mkdtemp(prefix="topicloom-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]
