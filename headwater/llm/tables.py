"""Small Spark helpers of the operators: reading, appending columns, folds and fits on bounded samples."""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headwater.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; null keys are in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts, F.lit(0))


def give_back() -> None:
    """Returns the memory that this process has freed, which its allocators keep else, to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for a Python worker that Spark keeps after the task: what the task has freed does not stay with the worker."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied


def append_columns(df: DataFrame, text: str, fields: str, compute: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """``df`` with the columns of ``fields`` (DDL) that ``compute`` makes of the column ``text``, batch by batch.

    Input columns whose names clash with new ones are replaced.
    """
    new = StructType.fromDDL(fields)
    names = {f.name.lower() for f in new.fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    carried = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = compute(batch.column(batch.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in carried), *made], [*carried, *new.names])

    return df.mapInArrow(tidy(run), StructType([*kept, *new.fields]))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, key: str, train: Column, rows: int) -> DataFrame:
    """(text, label) of about ``rows`` labelled training documents, chosen by a hash of the key.

    All labelled rows are taken if there are no more than ``rows``. The chosen keys and labels number
    ``rows`` on average whatever the input size, so they are broadcast and no text is shuffled.
    """
    known = labels.where(train & F.col(key).isNotNull() & F.col(label).isin(0, 1)).select(F.col(key).alias("__key"), F.col(label).cast("int").alias("label"))
    total = known.count()
    if total > rows:
        share = int(rows / total * (1 << 32))
        known = known.where(F.shiftrightunsigned(F.xxhash64("__key"), 32) < share)
    return docs.select(F.col(key).alias("__key"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "__key").select("__key", "text", "label")


def fit_in_one_task(sample: DataFrame, fit: Callable[[Iterator[pa.RecordBatch]], object]) -> object:
    """What ``fit`` makes of a bounded sample, gathered into one task; the model comes back pickled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(batches))], pa.binary())], ["model"])

    rows = sample.repartition(1).mapInArrow(tidy(run), "model binary").collect()
    return pickle.loads(rows[0].model) if rows else fit(iter(()))
