"""The package on the executors: workers need not have it installed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_BATCH_BYTES, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 12 << 20
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the workers, once an application.

    Also bounds Arrow batches by bytes where the session does not: ten thousand
    rows, the default, have no bound if texts are long.
    """
    context = spark.sparkContext
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, str(BATCH))
    if context.applicationId in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="corpusflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # the driver serves it until then
    path = Path(folder) / "corpusflow.zip"
    with zipfile.ZipFile(path, "w") as out:
        for p in sorted(here.rglob("*.py")):
            out.write(p, f"corpusflow/{p.relative_to(here)}")
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)
