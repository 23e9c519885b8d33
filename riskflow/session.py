"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app_name: str = "riskflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time and adaptive execution; ``conf`` keys use ``__`` for dots.

    Shuffle width, memory and the checkpoint folder are left to the cluster's own configuration.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@functools.lru_cache(maxsize=1)
def _package_archive() -> str:
    base = f"{tempfile.mkdtemp(prefix='riskflow-code-')}/riskflow-code"
    return shutil.make_archive(base, "zip", Path(__file__).resolve().parents[1], "riskflow")


def ship_package(spark: SparkSession) -> None:
    """Give the code of this package to the Python workers, once, as ``--py-files`` would."""
    context = spark.sparkContext
    if not getattr(context, "_riskflow_shipped", False):
        context.addPyFile(_package_archive())
        context._riskflow_shipped = True


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder that the session names in spark.checkpoint.dir.

    What queries leave there may be removed when none of them runs. Only a local-mode session may
    do without that setting, and removes its own folder at its end; executors on other machines
    could not read a folder of the driver's own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="riskflow-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return f"{shared.rstrip('/')}/riskflow/{label}-{uuid.uuid4().hex}"
