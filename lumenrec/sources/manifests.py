"""Numbered manifests: a dataset that several writers change at once.

``<root>/manifests/<n>.json`` describes version n. A writer reads the newest one, prepares its files beside
those of others, and creates number n + 1 *if it is absent*; whoever comes second reads again and tries with the
next number, so no change is lost. Files that a version no longer names stay for a lease, as a reader may just
have resolved the version before.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from lumenrec.sources.snapshots import _hadoop, dataset_path, delete_path

#: Manifests kept besides the newest; they hold no data.
KEPT = 20


class Conflict(RuntimeError):
    """Another writer changed what this change was made from."""


def _folder(root: str) -> str:
    return f"{root}/manifests"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the manifests that are there, in order."""
    fs, folder = _hadoop(spark, _folder(root))
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")


def latest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest manifest; ``(0, {})`` when there is none."""
    found = numbers(spark, root)
    if not found:
        return 0, {}
    text = spark.read.text(f"{_folder(root)}/{found[-1]}.json", wholetext=True).first()[0]
    return found[-1], json.loads(text)


def create(spark: SparkSession, root: str, number: int, content: dict) -> bool:
    """Create manifest ``number``; False if it is there already.

    The content is written aside and renamed without overwriting. The check and the rename are one step on
    HDFS; on a plain local disk they are two.
    """
    fs, aside = _hadoop(spark, f"{_folder(root)}/.{number}.{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(json.dumps(content), "utf-8"))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = fs.makeQualified(hadoop.Path(f"{_folder(root)}/{number}.json"))
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    context = hadoop.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(aside), target, options)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception.getClass().getName()):
            raise
        fs.delete(aside, False)
        return False


def change(spark: SparkSession, root: str, edit: Callable[[dict], dict], tries: int = 50) -> tuple[int, dict]:
    """Make ``edit(newest content)`` the next version; on a lost race read again and edit the winner's.

    ``edit`` raises ``Conflict`` when the newest content no longer allows the change.
    """
    for _ in range(tries):
        number, content = latest(spark, root)
        edited = edit(content)
        if edited is content:
            return number, content
        if create(spark, root, number + 1, edited):
            for old in numbers(spark, root)[: -KEPT - 1]:
                delete_path(spark, f"{_folder(root)}/{old}.json")
            return number + 1, edited
    raise Conflict(f"{root}: {tries} lost races")


def dropped(content: dict, paths: list[str]) -> list[dict]:
    """What a version's successor notes about files that it no longer names."""
    return [*content.get("dropped", []), *({"path": p, "at": time.time()} for p in paths)]


def sweep(spark: SparkSession, root: str, lease: float = 86400.0) -> int:
    """Delete files that were dropped more than ``lease`` seconds ago; how many there were."""
    due: list[str] = []

    def edit(content: dict) -> dict:
        due.clear()
        due.extend(d["path"] for d in content.get("dropped", []) if d["at"] + lease <= time.time())
        if not due:
            return content
        return {**content, "dropped": [d for d in content["dropped"] if d["path"] not in due]}

    change(spark, root, edit)
    for path in due:
        delete_path(spark, f"{root}/{path}")
    return len(due)


def publish_version(df: DataFrame, base: str, env: str, product: str, dataset: str, keep: int = 2) -> str:
    """Write a version of a dataset that several jobs publish; the newest ``keep`` are readable by name.

    Returns the version's name. A version that two writers race for is published by both, one after the other.
    """
    spark = df.sparkSession
    root = dataset_path(base, env, product, dataset)
    version = f"v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{root}/{version}")

    def edit(content: dict) -> dict:
        names = [version, *content.get("versions", [])]
        return {"versions": names[:keep], "dropped": dropped(content, names[keep:])}

    change(spark, root, edit)
    return version


def read_version(spark: SparkSession, base: str, env: str, product: str, dataset: str, back: int = 0) -> DataFrame:
    """The newest version of a dataset, or the one ``back`` publications before it."""
    root = dataset_path(base, env, product, dataset)
    versions = latest(spark, root)[1].get("versions", [])
    if back >= len(versions):
        raise FileNotFoundError(f"{root} has {len(versions)} versions")
    return spark.read.parquet(f"{root}/{versions[back]}")
