"""What the operators of this subpackage share: shared tables, id ranges, hashing and word splitting."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Folders made for applications that name none, by application.
LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it. Without one, only a session on one machine gets a folder of that machine."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if context.applicationId not in LOCAL:
            LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="signalloom-")
        found = LOCAL[context.applicationId]
    return f"{found.rstrip('/')}/signalloom-{context.applicationId}"


#: Whether Spark deletes the shuffle files of a query once it has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back, so that lost executors cost no recomputation of it. What was shuffled for it goes at once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._kept_at = path
    return kept


def discard(*kept: DataFrame) -> None:
    """Delete tables that keep() wrote; nothing that is still to be worked out may read them."""
    for df in kept:
        _delete(df.sparkSession, df._kept_at)


def discard_all(spark: SparkSession) -> None:
    """Delete all tables that keep() wrote in this application, once every result that reads them has been written elsewhere."""
    _delete(spark, shared_dir(spark))


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_MODEL: dict = {}


def one_model(make, *args):
    """make(*args), held until another model is asked for: workers outlive stages, and would pile up the models of all of them."""
    key = (make, *args)
    if key not in _MODEL:
        _MODEL.clear()
        give_back()
        _MODEL[key] = make(*args)
        gc.freeze()  # a model's many small objects stay, and needn't be looked through
    return _MODEL[key]


def give_back() -> None:
    """Return memory that is free, but kept for later, to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def tidy(f):
    """f, a function over a task's batches that needs no model of one_model's: the worker, which may hold one of an earlier stage, drops it, and gives memory back when the task has ended."""

    def run(batches):
        _MODEL.clear()
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def id_crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Remembered(dict):
    """Key -> work(key), worked out when first asked for. Of what it has worked out it keeps the most recent, from `most` to twice as many keys; long keys it does not keep."""

    def __init__(self, most: int, longest: int = 64):
        super().__init__()
        self.most, self.longest, self.older = most, longest, {}

    def work(self, key):
        raise NotImplementedError

    def make_room(self, n: int = 1) -> None:
        if len(self) + n > self.most:
            self.older = dict(self)
            self.clear()

    def __missing__(self, key):
        if (got := self.older.get(key)) is None:
            got = self.work(key)
        if len(key) <= self.longest:
            self.make_room()
            self[key] = got
        return got
