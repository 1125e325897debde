"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def get_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC timestamps."""
    builder = (
        SparkSession.builder.appName("papertrove")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def arrow_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Run the actions inside the block with at most ``rows`` rows per Arrow batch.

    Wide binary rows want small batches (documents 100, images 10); the old value comes back afterwards.
    """
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python workers can import it.

    Not needed when it is installed there or named in ``--py-files``.
    """
    name = f"{PACKAGE.name}.zip"
    if any(Path(shipped).name == name for shipped in spark.sparkContext.listFiles):
        return
    # The driver's own copy; Spark hands it to the executors.
    archive = Path(tempfile.mkdtemp()) / name
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(archive))
