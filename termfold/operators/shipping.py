"""The package itself, for Python workers on other machines."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Lets Python workers import this package, wherever they run: Spark's file server hands it out."""
    sc = spark.sparkContext
    if getattr(sc, "_termfold_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="termfold-package-"), "termfold_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("termfold", os.path.relpath(full, top)))
    sc.addPyFile(path)
    sc._termfold_shipped = True
