"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Every document gets an exponential key, ``-ln(u) / quality``, with ``u`` drawn from a digest of its id, so that
reruns agree. Within its source documents are taken in key order. A source whose target is n.f times its size
gives n whole epochs first; the fraction comes from the documents with the smallest keys, up to the word budget.

No source is ever sorted as a whole. Keys fall into ``BUCKETS`` ranges; the totals of (source, range) are summed
before the shuffle, their prefix sums name the one range in which a source's budget ends, and only that range
is sorted. A source with a third of all rows so costs a sort of about a 3000th of them.

Defined results: a null text has size 0; null is a source of its own, last in order; rows with a null id share
one key; rows that repeat an id are taken together; sources without words get target 0; an empty table gives an
empty result. Input columns are passed on, those called like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import WORD, settle, text_of

WEIGHTS = (5, 2, 1)
CAP = 3
BUCKETS = 1024
RESULT = ("size", "source_size", "target", "taken")
#: Characters that prose rarely has.
MARKS = "!|#*$%&<>{}[]^~_=0123456789"
_OWN = ("_source", "_key", "_bucket")


def quality_weight(text: str) -> Column:
    """Between 1 (plain prose) and about 0.05 (marks and digits only)."""
    body = text_of(text)
    marks = F.length(body) - F.length(F.translate(body, MARKS, ""))
    return 1 / (1 + 20 * marks / F.greatest(F.length(body), F.lit(1)))


def weigh(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", quality: Column | None = None, seed=7) -> DataFrame:
    """``docs`` with its size and its sampling key."""
    quality = quality_weight(text_col) if quality is None else quality
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 1) / F.lit(float(2**52))
    own = docs.select(
        *[F.col(c) for c in docs.columns if c not in RESULT and c not in _OWN],
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
        F.col(source_col).cast("string").alias("_source"),
        (-F.log(u) / F.greatest(quality, F.lit(1e-6))).alias("_key"),
    )
    # 1 - exp(-key) rises with the key, so the ranges keep the order of the keys.
    return own.withColumn("_bucket", F.least(F.lit(BUCKETS - 1), F.floor(BUCKETS * (1 - F.exp(-F.col("_key"))))).cast("int"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """(``_source``, ``source_size``) with ``target``: one row per source comes in and goes out.

    Sources share all words by weight; no target exceeds ``cap`` times its source's size, and the excess is
    shared again among the others. The fixed point is ``min(cap * size, level * weight)``: sources sorted by
    ``cap * size / weight`` are full up to some point, and the level follows from the sums before that point.
    """
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    everything = Window.partitionBy()
    before = Window.orderBy("_ratio", F.col("_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_at") % len(weights) + 1).cast("int"))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_most").over(before), F.lit(0.0))) / (
        F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    )
    return (
        sizes.withColumn("_at", F.row_number().over(order) - 1).withColumn("_weight", weight)
        .withColumn("_most", F.col("source_size") * float(cap)).withColumn("_ratio", F.col("_most") / F.col("_weight"))
        .withColumn("_level", level)
        .withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(everything))
        .select("_source", "source_size", F.least(F.col("_most"), F.coalesce(F.col("_level") * F.col("_weight"), F.col("_most"))).alias("target"))
    )


def plan(weighed: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per source: its target, its whole epochs, and where its fraction ends (range and key)."""
    parts = weighed.groupBy("_source", "_bucket").agg(F.sum("size").alias("_words"))
    sizes = parts.groupBy("_source").agg(F.sum("_words").alias("source_size"))
    share = targets(sizes, weights, cap).withColumn(
        "_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    ).withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
    below = F.coalesce(F.sum("_words").over(Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = (
        parts.withColumn("_below", below).withColumnRenamed("_source", "_of").join(share, F.col("_of").eqNullSafe(F.col("_source")))
        .filter(F.col("_below") <= F.col("_rest"))
        .groupBy("_source", "source_size", "target", "_epochs", "_rest")
        .agg(F.max("_bucket").alias("_end"), F.max_by("_below", "_bucket").alias("_below"))
    )
    ends = settle(ends, "mix-ends")  # one row per source, and Spark now knows its size: small ones reach the rows by broadcast
    last = weighed.select(F.col("_source").alias("_of"), F.col("_bucket").alias("_in"), "_key", "size").join(
        ends, F.col("_of").eqNullSafe(F.col("_source")) & (F.col("_in") == F.col("_end"))
    ).groupBy("_source", "_below", "_rest", "_key").agg(F.sum("size").alias("_words"))
    upto = F.col("_below") + F.sum("_words").over(Window.partitionBy("_source").orderBy("_key")) - F.col("_words") / 2
    cut = last.withColumn("_upto", upto).filter(F.col("_upto") <= F.col("_rest")).groupBy(F.col("_source").alias("_of")).agg(F.max("_key").alias("_cut"))
    planned = ends.join(cut, F.col("_of").eqNullSafe(F.col("_source")), "left")
    return settle(planned.select("_source", "source_size", "target", "_epochs", "_end", F.coalesce("_cut", F.lit(-1.0)).alias("_cut")), "mix-plan")


def take(weighed: DataFrame, planned: DataFrame) -> DataFrame:
    """``weighed`` with what the mix takes of each row: whole epochs, and once more if its key is within the cut."""
    planned = planned.withColumnRenamed("_source", "_of")
    chosen = (F.col("_bucket") < F.col("_end")) | ((F.col("_bucket") == F.col("_end")) & (F.col("_key") <= F.col("_cut")))
    return weighed.join(planned, F.col("_of").eqNullSafe(F.col("_source"))).withColumn(
        "taken", F.col("size") * (F.col("_epochs") + F.when(chosen, 1).otherwise(0))
    ).drop("_of", "_epochs", "_end", "_cut", *_OWN)


def mix(docs: DataFrame, columns: Sequence[str] = ("doc_id",), weights: Sequence[float] = WEIGHTS, cap: float = CAP, **how) -> DataFrame:
    """``columns`` of ``docs`` with size, source_size, target and taken. Sizes and keys are written once."""
    weighed = weigh(docs, **how)
    weighed = settle(weighed.select(*[c for c in columns if c not in RESULT], "size", *_OWN), "mix")
    return take(weighed, plan(weighed, weights, cap))


def mix_rows(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP, **how) -> DataFrame:
    """All columns of ``docs`` with size, source_size, target and taken. Texts are read twice, but never shuffled."""
    weighed = weigh(docs, **how)
    narrow = settle(weighed.select("size", *_OWN), "mix")
    return take(weighed, plan(narrow, weights, cap))
