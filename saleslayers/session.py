"""Session settings the library relies on, the shared folder for written intermediates, and shipping the package."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: broadcast by measured size, coalesce small partitions,
    # split skewed ones (hot customers, suppliers or days).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name: str = "saleslayers", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


@functools.cache
def _package_archive() -> tuple[tempfile.TemporaryDirectory, str]:
    """This package as a ZIP file, for as long as the process lives."""
    folder = tempfile.TemporaryDirectory(prefix="saleslayers-package-")
    path, root = f"{folder.name}/saleslayers.zip", Path(__file__).parent
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    return folder, path


def ship_package(spark: SparkSession) -> SparkSession:
    """Lets the Python workers of a session import this package, wherever it was started from."""
    context = spark.sparkContext
    if not getattr(context, "_saleslayers_shipped", False):
        context.addPyFile(_package_archive()[1])
        context._saleslayers_shipped = True
    return spark


@functools.cache
def _local_folder() -> tempfile.TemporaryDirectory:
    """One folder for the process, removed when it ends."""
    return tempfile.TemporaryDirectory(prefix="saleslayers-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Without one, a machine-local folder does where driver and executors are one process; on a cluster
    each machine would write to its own disk, so that is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = _local_folder().name
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
