"""Reading, staging and null handling shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.session import configure, scratch_folder, scratch_root

TOKENIZER_FILE = "byte_bpe_50k.json"


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: small Arrow batches, since texts may be long, and
    shuffle files that go once the statement that made them has ended."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    rows = prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.select(*columns) if columns else rows


def stage(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write `df` to the shared folder and read it back: lost executors re-read files.

    Within `session.scratch` the files go when it ends, but for those that the result is read
    from (`keep`).
    """
    spark = df.sparkSession
    path = scratch_folder(f"{scratch_root(spark)}/llm", label, keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(*columns: Column) -> list[Column]:
    """Two 64-bit hashes over the columns, never null: rows with equal keys are equal rows."""
    return [
        F.xxhash64(*columns).alias("row_a"),
        F.xxhash64(F.lit(1), *reversed(columns)).alias("row_b"),
    ]


def boxed(docs: DataFrame) -> Column:
    """All columns of `docs` as one struct `row`, so that helper columns clash with none."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def slices(values: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges (start, end) of texts of `most_bytes` together; a longer one stands alone."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(values):
        done = int(sizes[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + most_bytes, "right")))
        yield start, end
        start = end


def sampled(rows: DataFrame, order: Column, count: int) -> DataFrame:
    """The `count` rows of least `order`, a hash, or all rows if there are fewer.

    A first pass over the hashes alone finds the greatest one to take, so that the second one
    brings together hardly more rows than that, however many there are.
    """
    least = rows.select(order.alias("hash")).orderBy("hash").limit(count)
    last = least.agg(F.max("hash")).first()[0]
    return rows.filter(order <= F.lit(last)).orderBy(order).limit(count)


def in_split(column: str, parts: int, held: int) -> Column:
    """Whether crc32 of the id as text leaves another remainder than `held`; false for null."""
    rest = F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts))
    return F.coalesce(rest != held, F.lit(False))


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
