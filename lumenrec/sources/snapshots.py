"""Versioned snapshots of result tables.

``<base>/<env>/<product>/<dataset>/`` holds one directory per version and a small
``current.json`` file naming the latest and the backup version. A reader never sees a
half-written version: the pointer is replaced only after the write has committed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

ENVIRONMENTS = ("pro", "pre", "test", "dev")
POINTER = "current.json"


def dataset_path(base: str, env: str, product: str, dataset: str) -> str:
    if env not in ENVIRONMENTS:
        raise ValueError(f"unknown environment {env!r}")
    return "/".join([base.rstrip("/"), env, product.lower(), dataset])


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return fs.exists(jpath)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = _hadoop(spark, path)
    fs.delete(jpath, True)


def read_pointer(spark: SparkSession, root: str) -> dict[str, str | None]:
    pointer = f"{root}/{POINTER}"
    if not path_exists(spark, pointer):
        return {"latest": None, "backup": None, "retired": None}
    return json.loads(spark.read.text(pointer, wholetext=True).first()[0])


def _write_pointer(spark: SparkSession, root: str, content: dict[str, str | None]) -> None:
    """Write the new pointer aside and rename it over the old one, which is atomic."""
    fs, aside = _hadoop(spark, f"{root}/.{POINTER}.{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(json.dumps(content), "utf-8"))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(aside), fs.makeQualified(hadoop.Path(f"{root}/{POINTER}")), options)


def write_snapshot(df: DataFrame, base: str, env: str, product: str, dataset: str) -> str:
    """Write a new version, then make it ``latest``; the previous one becomes ``backup``.

    The version before the backup is kept as ``retired`` until the next write, so a reader
    that has just resolved the backup still finds its files. One writer per dataset.
    """
    spark = df.sparkSession
    root = dataset_path(base, env, product, dataset)
    version = f"v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{root}/{version}")
    before = read_pointer(spark, root)
    if before["latest"] is not None and not path_exists(spark, f"{root}/{before['latest']}"):
        # The latest version was lost: the backup is still the best second copy.
        _write_pointer(spark, root, {**before, "latest": version})
        return f"{root}/{version}"
    _write_pointer(spark, root, {"latest": version, "backup": before["latest"], "retired": before["backup"]})
    if before.get("retired") is not None:
        delete_path(spark, f"{root}/{before['retired']}")
    return f"{root}/{version}"


def read_snapshot(
    spark: SparkSession, base: str, env: str, product: str, dataset: str, which: str = "latest"
) -> DataFrame:
    root = dataset_path(base, env, product, dataset)
    version = read_pointer(spark, root)[which]
    if version is None:
        raise FileNotFoundError(f"{root} has no {which} version")
    return spark.read.parquet(f"{root}/{version}")


def read_newest(spark: SparkSession, base: str, env: str, product: str, dataset: str) -> DataFrame:
    """Latest version, else the backup; an error when neither is there."""
    root = dataset_path(base, env, product, dataset)
    pointer = read_pointer(spark, root)
    for which in ("latest", "backup"):
        version = pointer[which]
        if version is not None and path_exists(spark, f"{root}/{version}"):
            return spark.read.parquet(f"{root}/{version}")
    raise FileNotFoundError(f"{root} has neither a latest nor a backup version")
