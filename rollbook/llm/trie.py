r"""The prefix trie of conversations, with only those prefixes shuffled that two conversations may share.

A node is a distinct sequence of first turns; a conversation belongs to all nodes on its path. Turns become digests of role and text,
and prefixes exclusive-ors of digests that know their depth, 128 bits wide. A count-min sketch of all prefixes then tells, without a shuffle,
which of them can be shared: an estimate of one proves that a single conversation has the prefix, hence all longer
ones too, so that this tail's nodes are final where they are. Only prefixes that are possibly shared cross a shuffle
and are grouped exactly; a false estimate costs a row on the way, never a result.

No step walks the trie level by level. A conversation owns the nodes of which it is the smallest member, which are the lower end of its
path. With ``g`` the length of the part that it does not own, and ``before`` the length above a node, the tokens saved below the node are
the sum of ``max(g - before, 0)`` over its members, and its leaves are the members that own a leaf: two sums by
node, which combine before the shuffle.

Keys that many rows have: turns are dealt by ranges of (conversation, turn), so that one long conversation is spread over
tasks, its positions and prefixes being carried on by one row for each range; nodes whose estimate is at the counters' top are joined
through ``SALTS`` copies; ids that end at a node are joined to texts of at most 4,096 ids before they are hashed, as
a stream. The sketch has two rows of one-byte counters, at most 2 * 2 ** ``BITS`` bytes (32 MB), whatever the input; it is broadcast.
Beyond that size more prefixes are taken for shared and shuffled, and results stay the same.

Defined results: null roles and texts are empty; turns are ordered by turn, nulls first, then by digest; rows that
repeat are turns of their own; rows without conv_id belong to no conversation; ids are integers; a conversation without turns is a
member of the root only; without conversations there is no node. Columns beyond the four are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.common import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Counters in a row of the sketch: at least two for each prefix, at most 2 ** BITS. A counter stops at TOP.
BITS, TOP = 24, 255
#: Copies of the rows of a node whose estimate is TOP.
SALTS = 16
#: Binary digits of how many depths of a conversation are joined at once, and how many ids make one text.
STRETCH, IDS = 12, 12
_CHUNK = 1 << 16
RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NONE = hashlib.sha256(b"").hexdigest()


@dataclass
class Graft:
    """Conversation c begins with the first ``head`` (at most ``most``) turns of conversation ``base``, in place of as many of its
    own. Both are SQL expressions of conv_id; a base's base is itself."""

    base: str
    head: str
    most: int


def _terms(digest, depth) -> list[Column]:
    digest, depth = F.col(digest), F.col(depth).cast("long")
    return [F.xxhash64(digest, depth).alias("t1"), F.xxhash64(depth, digest).alias("t2")]


def _xor(a: str, *more: str) -> Column:
    out = F.col(a)
    for b in more:
        out = out.bitwiseXOR(F.coalesce(F.col(b), F.lit(0).cast("long")))
    return out


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("long"))


def placed(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns with their digest and place, runs): a run is what one range of the sorted turns has of a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.md5(F.concat(F.length(role), F.lit(":"), role, text))).alias("digest"),
        F.length(text).cast("long").alias("n"),
    )
    order = ["conv_id", "turn", "digest"]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "n", F.monotonically_increasing_id().alias("at"))
    turns = settle(turns, "turns").withColumn("run", F.shiftright("at", 33))
    runs = turns.groupBy("conv_id", "run").agg(F.min("at").alias("first"), F.count("*").alias("own"))
    whole = Window.partitionBy("conv_id")
    runs = runs.select(
        "conv_id", "run", "first", F.coalesce(F.sum("own").over(whole.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"),
        F.sum("own").over(whole).alias("total"), (F.count("*").over(whole) > 1).alias("several"),
    )
    return turns, settle(runs, "runs")


def prefixes(conversations: DataFrame, graft: Graft | None = None) -> tuple[DataFrame, DataFrame]:
    """(one row for each conversation and depth, one row for each conversation), written.

    Rows have the prefix as (k1, k2), the one before it as (p1, p2), the last turn's length ``n``, the length ``cum`` up to it and whether it is the
    conversation's ``last``; conversations have their ``size`` in turns.
    """
    turns, runs = placed(conversations)
    graft = graft or Graft("conv_id", "0", 0)
    runs = runs.withColumn("base", F.expr(graft.base).cast("long")).withColumn("head", F.expr(graft.head).cast("long"))
    has = runs.filter("earlier = 0").select(F.col("conv_id").alias("base"), F.col("total").alias("has"))
    runs = runs.join(has, "base", "left").withColumn("taken", F.least("head", _or_zero("has"))).drop("has")
    runs = settle(runs.withColumn("size", F.col("taken") + F.greatest(F.col("total") - F.col("head"), F.lit(0))), "grafts")

    # the first turns of bases: at most ``most`` for each
    at = turns.join(runs.drop("base"), ["conv_id", "run"]).withColumn("position", F.col("at") - F.col("first") + F.col("earlier") + 1)
    upto = Window.partitionBy("base").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heads = at.filter(F.col("conv_id") == F.expr(graft.base)).filter(F.col("position") <= graft.most).select(F.col("conv_id").alias("base"), F.col("position").alias("depth"), "digest", "n")
    heads = heads.select("*", *_terms("digest", "depth"))
    heads = heads.select("base", "depth", "n", "t1", "t2", F.bit_xor("t1").over(upto).alias("k1"), F.bit_xor("t2").over(upto).alias("k2"), F.sum("n").over(upto).alias("cum"))
    heads = settle(heads, "heads")

    conversation = runs.filter("earlier = 0").select("conv_id", "base", "taken", "size")
    taken = conversation.join(heads, "base").filter("depth <= taken")
    start = heads.select("base", F.col("depth").alias("taken"), F.col("k1").alias("s1"), F.col("k2").alias("s2"), F.col("cum").alias("s"))
    started = runs.join(start, ["base", "taken"], "left").drop("base", "total")

    own = turns.join(started, ["conv_id", "run"]).withColumn("position", F.col("at") - F.col("first") + F.col("earlier") + 1)
    own = own.filter("position > head").withColumn("depth", F.col("position") - F.col("head") + F.col("taken"))
    own = own.select("*", *_terms("digest", "depth"))
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    carried = own.filter("several").groupBy("conv_id", "run").agg(F.bit_xor("t1").alias("t1"), F.bit_xor("t2").alias("t2"), F.sum("n").alias("n"))
    carried = carried.select("conv_id", "run", F.bit_xor("t1").over(before).alias("c1"), F.bit_xor("t2").over(before).alias("c2"), F.sum("n").over(before).alias("c"))
    along = Window.partitionBy("conv_id", "run").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = own.withColumns({"x1": F.bit_xor("t1").over(along), "x2": F.bit_xor("t2").over(along), "x": F.sum("n").over(along)}).join(carried, ["conv_id", "run"], "left")
    own = own.withColumns({"k1": _xor("x1", "s1", "c1"), "k2": _xor("x2", "s2", "c2"), "cum": F.col("x") + _or_zero("s") + _or_zero("c")})

    columns = ["conv_id", "depth", "k1", "k2", _xor("k1", "t1").alias("p1"), _xor("k2", "t2").alias("p2"), "n", "cum", (F.col("depth") == F.col("size")).alias("last")]
    return settle(own.select(*columns).unionByName(taken.select(*columns)), "prefixes"), conversation


def sketched(rows: DataFrame, bits: int) -> np.ndarray:
    """Count-min counters of (k1, k2): two rows of 2 ** bits, each cell the count of prefixes that fall there, up to ``TOP``."""
    width, chunk = 1 << bits, min(1 << bits, _CHUNK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((2, width), np.uint8)
        for batch in batches:
            for row in (0, 1):
                found, n = np.unique(batch.column(row).to_numpy() & (width - 1), return_counts=True)
                cells[row, found] = np.minimum(TOP, cells[row, found].astype(np.int64) + n)
        parts = cells.reshape(-1, chunk)
        for k in range(len(parts)):
            if len(at := np.flatnonzero(parts[k])):
                yield pa.RecordBatch.from_pylist([{"chunk": k, "cells": at.astype("<u2").tobytes(), "counts": parts[k, at].tobytes()}], schema=pa.schema([("chunk", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary())]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, cells = None, np.zeros(chunk, np.int64)

        def done():
            return pa.RecordBatch.from_pylist([{"chunk": current, "counts": np.minimum(TOP, cells).astype(np.uint8).tobytes()}], schema=pa.schema([("chunk", pa.int32()), ("counts", pa.binary())]))

        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk"] != current:
                    if current is not None:
                        yield done()
                    current, cells = row["chunk"], np.zeros(chunk, np.int64)
                cells[np.frombuffer(row["cells"], "<u2")] += np.frombuffer(row["counts"], np.uint8)
        if current is not None:
            yield done()

    parts = rows.select("k1", "k2").mapInArrow(count, "chunk int, cells binary, counts binary").repartition("chunk").sortWithinPartitions("chunk")
    out = np.zeros((2 * width // chunk, chunk), np.uint8)
    for part in parts.mapInArrow(merge, "chunk int, counts binary").toLocalIterator():
        out[part.chunk] = np.frombuffer(part.counts, np.uint8)
    return out.reshape(2, width)


def estimated(rows: DataFrame, cells: np.ndarray) -> DataFrame:
    """``rows`` with the estimates ``e`` of their prefix and ``pe`` of the one before; the root's is ``TOP``."""
    shared = rows.sparkSession.sparkContext.broadcast(cells)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        mask = cells.shape[1] - 1
        for batch in batches:
            key = {n: batch.column(n).to_numpy() for n in ("k1", "k2", "p1", "p2", "depth")}
            e = np.minimum(cells[0, key["k1"] & mask], cells[1, key["k2"] & mask])
            pe = np.where(key["depth"] == 1, TOP, np.minimum(cells[0, key["p1"] & mask], cells[1, key["p2"] & mask]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(e.astype(np.int32)), pa.array(pe.astype(np.int32))], names=[*names, "e", "pe"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("e", T.IntegerType()), T.StructField("pe", T.IntegerType())]))


def _dealt(rows: DataFrame, estimate: str) -> DataFrame:
    return rows.withColumn("salt", F.when(F.col(estimate) == TOP, F.pmod(F.xxhash64("conv_id"), F.lit(SALTS))).otherwise(0).cast("int"))


def _copied(nodes: DataFrame, estimate: str) -> DataFrame:
    return nodes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(F.col(estimate) == TOP, SALTS - 1).otherwise(0))))


def ends_digest(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends): SHA-256 of the ids in (k1, k2, conv_id), ascending and joined by commas."""
    blocks = ends.groupBy("k1", "k2", F.shiftright("conv_id", IDS).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None

        def made(rows):
            return pa.RecordBatch.from_pylist([{"k1": k[0], "k2": k[1], "ends": h} for k, h in rows], schema=pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends", pa.string())]))

        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(batch.column(n).to_pylist() for n in ("k1", "k2", "ids")), strict=True):
                if (k1, k2) == current:
                    digest.update(b"," + ids.encode())
                    continue
                if current:
                    done.append((current, digest.hexdigest()))
                current, digest = (k1, k2), hashlib.sha256(ids.encode())
            yield made(done)
        if current:
            yield made([(current, digest.hexdigest())])

    return blocks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "block").mapInArrow(run, "k1 long, k2 long, ends string")


def trie(conversations: DataFrame, graft: Graft | None = None) -> DataFrame:
    """One row per node of the trie of ``conversations`` (conv_id, turn, role, text): see :data:`RESULT`.

    A node is named by its smallest member and its depth; ``n_leaves`` and ``saved_tokens`` are over its subtree, the latter
    the code points that storing each shared turn once would save.
    """
    spark = conversations.sparkSession
    rows, conversation = prefixes(conversations, graft)
    root, members = conversation.agg(F.min("conv_id"), F.count("*")).first()
    if not members:
        return spark.createDataFrame([], RESULT)
    bits = min(BITS, max(10, (2 * rows.count()).bit_length()))
    rows = settle(estimated(rows, sketched(rows, bits)), "estimated")
    alone, shared = rows.filter("e = 1 OR pe = 1"), rows.filter("e > 1 AND pe > 1")
    first = alone.filter("e = 1 AND pe > 1")  # their parents may be shared

    key = ["k1", "k2"]
    nodes = shared.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *(F.min(c).alias(c) for c in ("depth", "p1", "p2", "e", "pe")),
    )
    nodes = settle(nodes, "nodes")
    children = nodes.select("p1", "p2", "depth").unionByName(first.select("p1", "p2", "depth")).withColumn("top", F.col("depth") == 1)
    children = children.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "top").agg(F.count("*").alias("n_children"))
    children = settle(children, "children")
    nodes = settle(nodes.join(children.filter("NOT top").drop("top"), key, "left").withColumn("n_children", _or_zero("n_children")), "nodes")

    # for each conversation: the length it does not own, whether it owns a leaf, and its deepest row here
    owner = _copied(nodes.select(*key, F.col("conv_id").alias("owner"), "e"), "e").drop("e")
    owned = _dealt(shared, "e").join(owner, [*key, "salt"])
    zero = F.lit(0).cast("long")
    paths = owned.select("conv_id", F.when(F.col("owner") != F.col("conv_id"), F.col("cum")).otherwise(zero).alias("g"), zero.alias("leaf"), "depth")
    leaves = alone.filter("last").select("conv_id").unionByName(nodes.filter("n_children = 0").select("conv_id"))
    paths = paths.unionByName(leaves.select("conv_id", zero.alias("g"), F.lit(1).cast("long").alias("leaf"), zero.alias("depth")))
    paths = settle(paths.groupBy("conv_id").agg(F.max("g").alias("g"), F.max("leaf").alias("leaf"), F.max("depth").alias("depth")), "paths")

    stretch = F.shiftright("depth", STRETCH)  # a long conversation is joined by parts
    parts = paths.select("conv_id", "g", "leaf", F.explode(F.sequence(F.lit(0).cast("long"), stretch)).alias("stretch"))
    sums = shared.select(*key, "conv_id", (F.col("cum") - F.col("n")).alias("before"), stretch.alias("stretch")).join(parts, ["conv_id", "stretch"])
    sums = sums.groupBy(*key).agg(F.sum(F.greatest(F.col("g") - F.col("before"), zero)).alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))

    turnless = conversation.filter("size = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id")
    ends = ends_digest(shared.filter("last").select(*key, "conv_id"))
    root_ends = ends_digest(turnless).first()
    saved, n_leaves = paths.agg(_total("g"), _total("leaf")).first()
    n_children = children.filter("top").agg(_total("n_children")).first()[0]
    top = spark.range(1).select(
        F.lit(root).cast("long").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(members).cast("long").alias("n_convs"),
        F.lit(n_children).cast("long").alias("n_children"), F.lit(max(1, n_leaves)).cast("long").alias("n_leaves"), F.lit(saved).cast("long").alias("saved_tokens"),
        F.lit(root_ends.ends if root_ends else _NONE).alias("ends_sha256"),
    )

    columns = top.columns
    parent = _copied(nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"), "e"), "e").drop("e")

    def with_parent(found: DataFrame) -> DataFrame:
        below = _dealt(found.filter("depth > 1"), "pe").join(parent, ["p1", "p2", "salt"], "left").withColumn("parent_conv_id", F.coalesce("parent", "conv_id"))
        return found.filter("depth = 1").withColumn("parent_conv_id", F.lit(root).cast("long")).select(*columns).unionByName(below.select(*columns))

    def single(found: DataFrame) -> DataFrame:
        return found.withColumns({
            "n_convs": F.lit(1).cast("long"), "n_children": F.when(F.col("last"), 0).otherwise(1).cast("long"), "n_leaves": F.lit(1).cast("long"), "saved_tokens": zero,
            "ends_sha256": F.sha2(F.when(F.col("last"), F.col("conv_id").cast("string")).otherwise(""), 256),
        })

    grouped = nodes.join(sums, key, "left").join(ends, key, "left").withColumns(
        {"saved_tokens": _or_zero("saved_tokens"), "n_leaves": _or_zero("n_leaves"), "ends_sha256": F.coalesce("ends", F.lit(_NONE))}
    )
    tails = single(alone.filter("pe = 1")).withColumn("parent_conv_id", F.col("conv_id")).select(*columns)
    return top.unionByName(with_parent(grouped)).unionByName(with_parent(single(first))).unionByName(tails)


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0).cast("long"))
