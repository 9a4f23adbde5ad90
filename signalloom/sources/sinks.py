"""Writers of items, dispatches, ledgers, stores and packages."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.operators.dedup import upsert
from signalloom.operators.ledger import check_ledger, streams
from signalloom.sources import readers
from signalloom.sources.readers import exists


def merge_into(new: DataFrame, path: str, keys: list[str], version: str) -> DataFrame:
    """Upsert into a table of versions under path: reads the latest, writes the next. Rerunning a version gives the same table."""
    spark, table = new.sparkSession, f"{path}/version={version}"
    old = latest(spark, path, before=version)
    (new if old is None else upsert(old, new, keys)).write.mode("overwrite").parquet(table)
    return spark.read.parquet(table)


def latest(spark: SparkSession, path: str, before: str | None = None) -> DataFrame | None:
    """The latest version (before one, if named) of a table written by merge_into; None if there is none."""
    if not exists(spark, path):
        return None
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = sorted(s.getPath().getName().removeprefix("version=") for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p))
    names = [n for n in names if before is None or n < before]
    return spark.read.parquet(f"{path}/version={names[-1]}") if names else None


def write_dispatches(records: DataFrame, path: str, version: str) -> DataFrame:
    """Dispatch records, one per item: those of an item that has one take its place."""
    return merge_into(records, path, ["item_id"], version)


def write_payloads(payloads: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    """Payloads (target, item_id, payload as JSON) as JSON lines by target; nothing in a dry run. The targets and items that are, or would be, written."""
    if not dry_run:
        payloads.select("target", "item_id", "payload").write.mode("overwrite").partitionBy("target").json(path)
    return payloads.select("target", "item_id")


def write_ledger(signals: DataFrame, path: str) -> None:
    """Signals as JSON lines with sorted fields; an empty ledger or a synthetic row is refused."""
    check_ledger(signals)
    signals.select(*sorted(signals.columns)).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_store(store: dict[str, DataFrame], path: str, version: str) -> None:
    """A snapshot of all tables of a store."""
    for name, df in store.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}/version={version}")


def read_store(spark: SparkSession, path: str, seed: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The latest snapshot of each table, or the seed's rows where there is none."""
    return seed | {name: df for name in seed if (df := latest(spark, f"{path}/{name}")) is not None}


def reset_store(spark: SparkSession, path: str) -> None:
    """Delete all snapshots, so that the seed's rows count again."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def digest_of(rows: DataFrame) -> tuple[int, str, int]:
    """How many rows (value, a JSON object) there are, a digest that doesn't depend on their order (the sums of eight parts of their hashes), and how many are synthetic. One row comes to the driver."""
    hashed = rows.select(F.sha2("value", 256).alias("h"), (F.get_json_object("value", "$.synthetic") == "true").alias("made_up"))
    part = lambda i: F.conv(F.substring("h", 1 + 8 * i, 8), 16, 10).cast("decimal(30,0)")
    one = hashed.agg(F.count(F.lit(1)).alias("n"), F.count_if("made_up").alias("made_up"), *(F.sum(part(i)).alias(f"s{i}") for i in range(8))).first()
    return one.n, "".join(f"{int(one[f's{i}'] or 0) % 2**32:08x}" for i in range(8)), one.made_up


def write_package(parts: dict[str, DataFrame], path: str, mode: str, now: str, producer: str) -> dict:
    """Streams that aren't empty as JSON lines, and beside them a manifest with their counts and digests, which is also returned.

    Neither a stream's digest nor the package's depends on how rows are spread over files. Each stream is worked out once: its lines are written to a folder aside, counted and digested as
    they stand there, and moved to their place once all streams are written and, for production, none has a synthetic row.
    """
    spark = next(iter(parts.values())).sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path
    system, aside = at(path).getFileSystem(spark._jsc.hadoopConfiguration()), f"{path}/_aside-{uuid.uuid4().hex}"
    files, synthetic = [], 0
    try:
        for name, df in parts.items():
            df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.text(f"{aside}/{name}")
            n, digest, made_up = digest_of(spark.read.text(f"{aside}/{name}"))
            synthetic += made_up
            if n:
                files.append({"filename": name, "stream": name, "record_count": n, "digest": digest})
        if mode == "production" and synthetic:
            raise ValueError(f"{synthetic} synthetic rows are not allowed in production")
        for f in files:
            system.delete(at(f"{path}/{f['stream']}"), True)
            if not system.rename(at(f"{aside}/{f['stream']}"), at(f"{path}/{f['stream']}")):
                raise OSError(f"{f['stream']} can't be moved to {path}")
    finally:
        system.delete(at(aside), True)
    identity = hashlib.blake2b(json.dumps([mode, producer, {f["stream"]: [f["record_count"], f["digest"]] for f in files}], sort_keys=True).encode(), digest_size=20).hexdigest()
    manifest = {"package_id": f"package-{identity}", "producer": producer, "mode": mode, "created_at": now, "files": files}
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return manifest


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/manifest").first().value)


def stream_counts(manifest: dict) -> dict[str, int]:
    return {f["stream"]: f["record_count"] for f in manifest["files"]}


def export(spark: SparkSession, ledgers: list[str], registry: str, path: str, now: str, producer: str, mode: str = "test") -> dict:
    """Read ledgers and the source registry, make the streams and write them as a package. Mode production refuses synthetic rows, test doesn't."""
    if mode not in ("test", "production"):
        raise ValueError(f"mode {mode}")
    signals = readers.ledgers(spark, ledgers)
    return write_package(streams(signals, readers.source_registry(spark, registry), F.lit(now).cast("timestamp")), path, mode, now, producer)


def write_findings(findings: DataFrame, path: str) -> None:
    findings.write.mode("overwrite").json(path)
