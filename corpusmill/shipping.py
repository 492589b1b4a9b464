"""Sends the package to the workers of a session, which see no folder of the driver."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: dict[str, str] = {}


@functools.lru_cache(maxsize=1)
def _archive() -> str:
    """A zip of the package and of the modules beside it."""
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="corpusmill-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/corpusmill.zip", "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted([*root.glob("corpusmill/**/*.py"), *root.glob("corpus_pipeline.py")]):
            out.write(file, file.relative_to(root))
    return f"{folder}/corpusmill.zip"


def ship(spark: SparkSession) -> SparkSession:
    """The session, to whose workers the package was sent; once for each application."""
    context = spark.sparkContext
    if _sent.get("to") != context.applicationId:
        context.addPyFile(_archive())
        _sent["to"] = context.applicationId
    return spark
