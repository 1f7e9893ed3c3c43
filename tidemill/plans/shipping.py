"""Making this package importable on executors that don't have it on their path."""

from __future__ import annotations

import tempfile
import threading
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
_ONE_AT_A_TIME = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Gives the application's executors a zip of the package, once, from whichever thread asks first."""
    app = spark.sparkContext.applicationId
    with _ONE_AT_A_TIME:
        if app in _SHIPPED:
            return
        root = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="tidemill-ship-")) / "tidemill_package.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(app)
