"""Getting this package to the executors when it is not installed there."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package along with the application, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="bootloom-"), "bootloom"), "zip",
        root_dir=os.path.dirname(package), base_dir=os.path.basename(package))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
