"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from rollbook.session import work_dir

#: A word is a run without the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later steps neither recompute it nor lose it
    with an executor."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str) -> Column:
    """The text column as a string; null counts as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def map_texts(df: DataFrame, judge, fields: Sequence[tuple[str, T.DataType]], text_col: str = "text") -> DataFrame:
    """``df`` with one column per field, as ``judge(text or None)`` gives them; columns of those names are replaced.

    Rows stream through Arrow batches and stay where they are: no shuffle, and no more than a batch in memory.
    """
    names = [name for name, _ in fields]
    kept = [field for field in df.schema.fields if field.name not in names]
    types = [to_arrow_type(kind) for _, kind in fields]
    df = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([f.name for f in kept])], text_of(text_col).alias("__text"), F.col(text_col).isNull().alias("__none"))

    def run(batches):
        for batch in batches:
            texts, none = batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist()
            found = [judge(None if gone else text) for text, gone in zip(texts, none, strict=True)]
            columns = list(zip(*found, strict=True)) if found else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], *(pa.array(c, kind) for c, kind in zip(columns, types, strict=True))],
                names=[*(f.name for f in kept), *names],
            )

    return df.mapInArrow(run, T.StructType([*kept, *(T.StructField(n, k) for n, k in fields)]))
