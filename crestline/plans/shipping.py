"""Makes the package importable in Python workers wherever they start."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hands the package's source to the session, once; the driver serves it to all executors, later ones too."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    folder = tempfile.mkdtemp(prefix="crestline-source-")
    path = os.path.join(folder, "crestline.zip")
    Path(path).write_bytes(held.getvalue())
    # the driver serves this file for as long as it runs
    atexit.register(shutil.rmtree, folder, True)
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
