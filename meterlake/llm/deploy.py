"""Make this package importable in the Python workers of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent.parent
_SHIPPED: set[str] = set()
#: Rows of an Arrow batch where the session has Spark's default: a batch of
#: whole texts stays small on both sides of the Python worker's pipe.
_BATCH, _BATCH_ROWS, _DEFAULT_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "2000", "10000"


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application, and
    make the session's Arrow batches small.

    A deployment that installs the package on every machine, or passes it to
    ``spark-submit --py-files``, does not need this; it does no harm there.
    Spark serves the archive from the driver, so no shared folder is needed.
    """
    if spark.conf.get(_BATCH, _DEFAULT_ROWS) == _DEFAULT_ROWS:
        spark.conf.set(_BATCH, _BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="meterlake-src-")) / "meterlake-src.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(_PACKAGE.rglob("*.py")):
            z.write(source, source.relative_to(_PACKAGE.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
