"""Token counts through a digest cache.

A text's count depends on its normalised content and on the tokenizer alone, so both are digested, and counts are kept by
the two digests. Contents that the cache lacks are encoded once each, however many rows have them, and
appended to it; all rows then take their count from the cache by a join.

One row per content crosses the first shuffle with its text (copies meet before it), and encoding runs where these
rows arrive. The last join carries digests only; a content that a third of all rows have is split there by
Spark's handling of skewed joins, as its other side has one row for it.

Defined results: null counts as the empty text, with 0 tokens; rows that repeat give repeated results; an empty table gives an
empty result. Input columns are passed on, those called like a result column are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import settle, text_of
from rollbook.session import work_dir

LIMIT = 4096
CACHE_SCHEMA = "version string, digest binary, n_tokens long"
#: Texts are encoded in groups of about so many characters, and longer ones in parts where that changes nothing.
PART = 1 << 17
_SAFE = re.compile(r"(?<=[a-z]) (?=[a-z])")


class PieceTokenizer:
    """A sentencepiece model that every machine has at ``public_tokenizers.path(name)``."""

    def __init__(self, name: str):
        import public_tokenizers
        import sentencepiece

        self.name = name
        with open(public_tokenizers.path(name), "rb") as file:
            self.version = hashlib.sha256(file.read() + sentencepiece.__version__.encode()).hexdigest()

    def counter(self) -> Callable[[list[str]], list[int]]:
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(self.name))
        # A piece has spaces at its front only: no piece then spans a single space between letters.
        splits = not any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size())) and model.encode("a b") == model.encode("a") + model.encode("b")

        def count(texts: list[str]) -> list[int]:
            return [sum(map(len, model.encode(parts(text) if splits else [text], num_threads=1))) for text in texts]

        return count


def parts(text: str, size: int = PART) -> list[str]:
    """``text`` cut at single spaces between small letters into parts of about ``size``; the spaces are left out."""
    out, start = [], 0
    while len(text) - start > size and (cut := _SAFE.search(text, start + size)):
        out.append(text[start : cut.start()])
        start = cut.end()
    return [*out, text[start:]]


def cached(spark, cache: str, version: str) -> DataFrame | None:
    """(digest, n_tokens) of what the cache has for a tokenizer; None if there is no cache yet."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException:
        return None
    rows = rows.filter(F.col("version") == version).select(F.col("digest").alias("_digest"), "n_tokens")
    # Only calls that run side by side store a digest twice. Without an aggregate, Spark can split a join's hot digest.
    if not rows.groupBy("_digest").count().filter("count > 1").isEmpty():
        rows = settle(rows.groupBy("_digest").agg(F.max("n_tokens").alias("n_tokens")), "token-cache-once")
    return rows


def count_tokens(docs: DataFrame, tokenizer, text_col: str = "text", cache: str | None = None, limit: int = LIMIT, normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """``docs`` without its text, with n_bytes, n_tokens and over_limit.

    ``tokenizer`` has a ``version`` and gives a function from texts to counts by ``counter()``. ``cache`` is a folder
    that all executors reach; without one, the counts of this call have a folder of their own. ``normalise`` must keep
    every count as it is; by default texts are left alone.
    """
    spark = docs.sparkSession
    cache = cache or work_dir(spark, "token-cache")
    version, result = tokenizer.version, ("n_bytes", "n_tokens", "over_limit")
    content = text_of(text_col) if normalise is None else normalise(text_of(text_col))
    digest = F.unhex(F.sha2(content, 256)).alias("_digest")

    contents = docs.select(digest, content.alias("_text")).dropDuplicates(["_digest"])
    known = cached(spark, cache, version)
    if known is not None:
        contents = contents.join(known, "_digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer.counter()
        for batch in batches:
            counts = []
            for start in range(0, batch.num_rows, 16):
                counts += count(batch.column(1).slice(start, 16).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([version] * batch.num_rows, pa.string()), batch.column(0), pa.array(counts, pa.int64())], names=["version", "digest", "n_tokens"])

    contents.select("_digest", "_text").mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in result and c != text_col]
    rows = docs.select(*kept, F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"), digest)
    counted = rows.join(cached(spark, cache, version), "_digest")
    return counted.select(*kept, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
