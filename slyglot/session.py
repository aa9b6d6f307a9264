"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "slyglot", cores: str = "*", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        here = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="slyglot-"), "slyglot")
        archive = shutil.make_archive(target, "zip", os.path.dirname(here), os.path.basename(here))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate.

    The cluster names its shared folder in ``spark.checkpoint.dir``; only where
    that is unset (local runs) is a temporary folder used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="slyglot-")
    return os.path.join(root, "slyglot", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex}")
