"""Shipping this package to the executors.

Python workers unpickle our functions by reference and so must be able to
import ``statframe``.  ``ship`` zips the package and hands it to Spark once per
session; an installed package (see pyproject.toml) makes it superfluous but
does no harm.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def _zip_package() -> str:
    """The package's sources as a zip file that Spark serves from the driver."""
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="statframe-ship-"), "statframe.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    return path


def ship(spark: SparkSession) -> None:
    """Make the package importable on every executor of this session."""
    try:
        sc = spark.sparkContext
        key, add = sc.applicationId, sc.addPyFile
    except Exception:  # Spark Connect: no context on the client
        key = spark.session_id

        def add(path):
            spark.addArtifacts(path, pyfile=True)

    if key not in _shipped:
        add(_zip_package())
        _shipped.add(key)
