"""What the text operators share: prepared columns, byte-level tasks, training folds, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.session import materialize, new_scratch

__all__ = ["filter_by_text", "fold_of", "fresh", "materialize", "mix", "new_scratch", "read", "stream_groups", "text_rows", "width"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_rows(docs: DataFrame, *extra: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, text binary, extra …): null texts become empty, every other column is left behind."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
        *extra,
    )


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until the frame has no such column (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def width(df: DataFrame) -> int:
    """Partitions for a shuffle that an operator asks for by number: the session's setting."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def stream_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], handle: Callable[[pa.Table], pa.Table | None]
) -> Iterator[pa.RecordBatch]:
    """Pass each run of rows with equal ``keys`` to ``handle``, batch by batch.

    The partition must be sorted by ``keys``. Whole groups are handed over together, many small ones
    in one call; only the last group of a batch waits for the next batch.
    """
    import pyarrow.compute as pc

    waiting: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        table = pa.concat_tables([waiting, now]).combine_chunks() if waiting is not None else now
        same = None
        for k in keys:
            column = table[k].combine_chunks()
            hit = pc.equal(column, column[table.num_rows - 1])
            same = hit if same is None else pc.and_(same, hit)
        last = pc.sum(same).as_py()
        ready, waiting = table.slice(0, table.num_rows - last), table.slice(table.num_rows - last)
        if ready.num_rows and (out := handle(ready)) is not None:
            yield from out.to_batches()
    if waiting is not None and (out := handle(waiting)) is not None:
        yield from out.to_batches()


def filter_by_text(docs: DataFrame, prepare: Callable[[], Callable[[list[bytes]], np.ndarray]], rows: int = 2000) -> DataFrame:
    """The rows whose text passes a test, all columns as they are, in one pass without a shuffle.

    ``prepare`` runs once a task and returns the test: texts (UTF-8, null as empty) to booleans.
    """
    at = docs.columns.index(next(c for c in docs.columns if c.lower() == "text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = prepare()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                passed = test([(t or "").encode() for t in part.column(at).to_pylist()])
                yield part.filter(pa.array(passed, pa.bool_()))

    return docs.mapInArrow(task, docs.schema)
