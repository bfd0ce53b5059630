"""Makes this library importable where Spark runs Python for it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands the package to the executors' Python workers, once per application.

    The archive lies with the driver, which serves it to the executors until it ends.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    folder = Path(tempfile.mkdtemp(prefix="tablekit-package-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = folder / "tablekit-package.zip"
    with zipfile.ZipFile(path, "w") as archive:
        # Folders are entries too: a package without __init__.py is found by its folder.
        for item in [package, *sorted(package.rglob("*"))]:
            if item.suffix == ".py" or item.is_dir() and item.name != "__pycache__":
                archive.write(item, item.relative_to(package.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)
