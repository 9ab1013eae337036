"""Session defaults for tests and benchmarks; a cluster brings its own session."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run on workers are pickled by the name of their module, and
    a worker finds the package by itself only where it is installed or in the
    folder that Spark was started in.
    """
    context, package = spark.sparkContext, Path(__file__).parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    folder = tempfile.mkdtemp(prefix="tallyforge-")  # the driver serves it until it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "tallyforge_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, str(Path(package.name) / file.relative_to(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def local_session(cores: int | str = 8, app: str = "tallyforge") -> SparkSession:
    """A local session with the settings that results rely on (UTC, AQE)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TALLYFORGE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
