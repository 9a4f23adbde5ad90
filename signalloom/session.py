"""What a session needs before a query runs in it."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

#: Rows, and bytes of them, that Python functions get at once: texts are long.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}
PACKAGE = os.path.dirname(os.path.abspath(__file__))


#: Folders made for applications that name none, by application.
LOCAL: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share, as spark.checkpoint.dir names it. Without one, only a session on one machine gets a folder of that machine."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if context.applicationId not in LOCAL:
            LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="signalloom-")
        found = LOCAL[context.applicationId]
    return f"{found.rstrip('/')}/signalloom-{context.applicationId}/{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Give workers this package, so that Python functions run where it isn't installed (once per Spark application).

    Batches that go to Python are made smaller for the whole session, unless it asks for smaller ones still: a query runs after this returns.
    """
    for key, most in BATCHES.items():
        asked = spark.conf.get(key, None) or ""
        if not asked.isdigit() or not 0 < int(asked) <= most:
            spark.conf.set(key, str(most))
    context = spark.sparkContext
    if getattr(context, "_signalloom_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="signalloom-"), "signalloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), os.path.dirname(PACKAGE)))
    context.addPyFile(path)
    context._signalloom_shipped = True
