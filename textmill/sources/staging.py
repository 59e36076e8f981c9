"""Tables written once to the shared folder, to cut lineage or to be reused.

A staged table is parquet in the folder that ``spark.checkpoint.dir`` names, so it is columnar,
survives the loss of executors, and is read by every executor of the cluster.
"""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F


# A lookup table within both bounds may be sent whole to every task; a larger one is joined.
SHIP_ROWS = 1_000_000
SHIP_BYTES = 64 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a fresh temporary one only in local mode without a setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", None) or ""):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="textmill-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder name below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/textmill-{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def settings_key(settings: object) -> str:
    """A short name that changes whenever any setting does."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True, default=repr).encode()).hexdigest()[:16]


def fingerprint(df: DataFrame) -> str:
    """A name for the content of a table: its schema, its number of rows, and the sum of the rows' 128-bit digests.

    The sum does not depend on the order or the partitions of the rows, and equal rows count as often
    as they occur. One aggregate that combines before its shuffle; each half of a digest is summed by itself.
    """
    if not df.columns:
        return settings_key(["no columns", df.count()])
    # JSON with its nulls tells values in different columns apart, and lists that hold nulls.
    columns = [F.col(f"`{name}`").alias(f"c{place}") for place, name in enumerate(df.columns)]
    digest = F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    halves = [F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    count, *sums = df.agg(F.count(F.lit(1)), *(F.sum(h) for h in halves)).first()
    return settings_key([df.schema.json(), count, *(str(int(s or 0) % 2**128) for s in sums)])


def materialize(
    splits: Mapping[str, DataFrame], folder: str, settings: object, sources: Mapping[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Prepared splits as parquet under ``folder``, reused when the same settings were written before.

    Each split has its own folder below a hash of the settings, and of the content of its table in
    ``sources`` if that is given, so that changed data are never answered with old rows; this reads the
    source once. A folder counts as written only with its success marker, so a run that died half-way
    is not reused; its rest is overwritten.
    """
    out = {}
    for name, df in splits.items():
        spark = df.sparkSession
        key = settings if sources is None else [settings, fingerprint(sources[name])]
        path = f"{folder.rstrip('/')}/{settings_key(key)}/split={name}"
        if not path_exists(spark, f"{path}/_SUCCESS"):
            df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.schema(df.schema).parquet(path)
    return out
