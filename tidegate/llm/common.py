"""What several operators share: words, Arrow mapping, written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidegate.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
#: Rows, and about as many bytes, that are Python objects at one time.
SLICE_ROWS, SLICE_BYTES = 256, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """Within, Arrow batches have at most so many rows: with whole texts in them, the usual ten thousand are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, so that later steps neither recompute nor re-randomise them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt_anew(key: Column) -> Column:
    """A long key for a join with an aggregate over that key, used on both sides.

    An aggregate is dealt out by its key already, and joining on the key itself would tie the other side to
    that. With the complement both sides are shuffled for the join, and adaptive execution can split the
    other side where a key is hot; the aggregate's rows, one per key, are few.
    """
    return F.bitwise_not(key)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``SLICE_ROWS`` rows, fewer where rows are large."""
    rows = max(1, min(SLICE_ROWS, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def add_columns(df: DataFrame, inputs: list[str], function: Callable[..., dict[str, list]], added: str) -> DataFrame:
    """Columns computed from lists of the inputs' values; a column that is there already is replaced.

    Only the inputs become Python objects, a slice at a time; all other columns stay as they are.
    """
    new = StructType.fromDDL(added)
    kept = [f for f in df.schema.fields if f.name not in new.fieldNames()]
    schema = StructType([*kept, *new.fields])
    target = to_arrow_schema(new)
    names = [f.name for f in kept]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for piece in slices(batch):
                values = function(*(piece.column(n).to_pylist() for n in inputs))
                computed = [pa.array(values[f.name], f.type) for f in target]
                yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in names), *computed], [*names, *target.names])

    return df.mapInArrow(batches, schema)
