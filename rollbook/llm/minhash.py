"""Near-duplicates by ProbMinHash, banding and verification.

A text is its shingles of ``SHINGLE`` words, weighted by how often it has them. Every shingle is a Poisson process whose
rate is its weight; its arrivals fall on random registers, each of which keeps the shingle that came first. Two texts agree in
a register with their probability Jaccard similarity. A shingle stops when it is later than the latest register, so
that a text costs about its shingles and its registers, not their product.

Equal texts are one node, however many rows have them. Texts that share a band are candidates; each is compared
with the first text of the band, and verified pairs make components. Where a band then still holds several components, the texts
of different ones are compared in blocks of bounded size. So a large group mostly costs one comparison for each member and
band, pairs are never listed, and no link is lost that a band can show: pairs within one component are
linked already. Similarities are computed from the texts themselves.

Defined results: null counts as the empty text; texts without words are near-duplicates of equal texts only; texts of fewer than
``SHINGLE`` words have one shingle, all their words; the class is named by its smallest doc id, null if all are
null; rows that repeat are in one class; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import settle, text_of
from rollbook.llm.graph import components
from rollbook.llm.words import RAW, mixed, pieces, shingles, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
#: Texts of a band that are compared with each other, or with another such block, in one group.
BLOCK = 512
_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def weighted_shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, how often) for consecutive texts, sorted."""
    words, _, bounds = word_hashes(data, offsets, RAW)
    counts = np.diff(bounds)
    every = shingles(words, size)
    text = np.repeat(np.arange(len(counts)), counts)[: len(every)]
    whole = np.arange(len(every)) + size <= bounds[1:][text]
    text, every = text[whole], every[whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        own = np.array([mixed(np.bitwise_xor.reduce(mixed(words[bounds[k] : bounds[k + 1]] + np.arange(1, counts[k] + 1, dtype=np.uint64) * _STEP))[None])[0] for k in short], np.uint64)
        text, every = np.concatenate([text, short]), np.concatenate([every, own])
    order = np.lexsort((every, text))
    text, every = text[order], every[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (every[1:] != every[:-1])
    at = np.flatnonzero(first)
    return text[at], every[at], np.diff(np.append(at, len(text)))


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_texts: int, registers: int = BANDS * ROWS) -> np.ndarray:
    """The registers of each text: (texts, registers) shingles; rows of texts without shingles are 0."""
    first = np.full(n_texts * registers, np.inf)
    holds = np.zeros(n_texts * registers, np.uint64)
    count = np.bincount(text, minlength=n_texts)
    alone = count[text] == 1  # one shingle holds all registers
    holds.reshape(n_texts, registers)[text[alone]] = shingle[alone][:, None]
    text, shingle, rate = text[~alone], shingle[~alone], weight[~alone].astype(float)
    time, turn = np.zeros(len(text)), 0
    while len(text):
        turn += 1
        random = mixed(shingle + np.uint64(turn * int(_STEP) % 2**64))
        time = time - np.log1p(-(random >> np.uint64(11)).astype(float) * 2.0**-53) / rate
        place = text * registers + (mixed(random ^ _OTHER) % np.uint64(registers)).astype(np.int64)
        early = np.flatnonzero(time < first[place])
        order = early[np.lexsort((shingle[early], time[early], place[early]))]
        order = order[np.append(True, place[order][1:] != place[order][:-1])] if len(order) else order
        first[place[order]], holds[place[order]] = time[order], shingle[order]
        going = time < first.reshape(n_texts, registers).max(axis=1)[text]
        text, shingle, rate, time = text[going], shingle[going], rate[going], time[going]
    return holds.reshape(n_texts, registers)


def similarity(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of (shingles, weights): the sum over common i of 1 / sum over j of max(x_j / x_i, y_j / y_i)."""
    common, a, b = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = one[1][a].astype(float), two[1][b].astype(float)
    ratio = x / y
    order = np.argsort(ratio)
    ratio, x, y = ratio[order], x[order], y[order]
    above = x.sum() - np.cumsum(x)[np.searchsorted(ratio, ratio, "right") - 1]  # of j whose x_j / y_j is larger
    upto = np.cumsum(y)[np.searchsorted(ratio, ratio, "right") - 1]
    only_x, only_y = one[1].sum() - x.sum(), two[1].sum() - y.sum()
    return float((1 / ((above + only_x) / x + (upto + only_y) / y)).sum())


def node_of(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _shingled(text: str | bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode() if isinstance(text, str) else text, np.uint8)
    return weighted_shingles(data, np.array([0, len(data)]))[1:]


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Of the pairs (u, v) those whose texts, (node, text), reach the threshold."""
    both = pairs.hint("shuffle_merge").join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u").join(
        texts.select(F.col("node").alias("v"), F.col("text").alias("text_v")), "v"
    )

    def run(batches):
        for batch in batches:
            last = (None, None)
            near = []
            for one, two in zip(batch.column(2), batch.column(3), strict=True):
                two = two.as_py()
                if last[0] != two:
                    last = (two, _shingled(two))
                near.append(similarity(_shingled(one.as_py()), last[1]) >= threshold)
            yield batch.select(["u", "v"]).filter(pa.array(near, pa.bool_()))

    return both.select("u", "v", "text_u", "text_v").mapInArrow(run, "u binary, v binary")


def band_rows(docs: DataFrame, text_col: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Distinct (band, node): the digests of each text's bands."""
    texts = docs.select(text_of(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for first, last, data, offsets in pieces(batch.column(1)):
                text, shingle, weight = weighted_shingles(data, offsets)
                held = signatures(text, shingle, weight, last - first, bands * rows).reshape(last - first, bands, rows)
                digest = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _OTHER, (last - first, bands))
                for k in range(rows):
                    digest = mixed((digest ^ held[:, :, k]) + _STEP)
                has = np.flatnonzero(np.bincount(text, minlength=last - first))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(has) * bands + 1, bands), pa.int32()), pa.array(digest[has].ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first).take(pa.array(has)), lists], names=["node", "bands"])

    made = texts.select(node_of(F.col("text")).alias("node"), "text").mapInArrow(run, "node binary, bands array<long>")
    return made.select(F.explode("bands").alias("band"), "node").distinct()


def near_links(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(verified links (u, v) between different texts, components of them)."""
    bands = settle(band_rows(docs, text_col), "bands-all")
    shared = settle(bands.groupBy("band").agg(F.min("node").alias("first"), F.count("*").alias("n")).filter("n > 1").select("band", "first"), "bands-shared")
    members = settle(bands.join(shared, "band"), "bands")  # each text of a shared band, with the band's first text
    pairs = settle(members.filter("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v")).distinct(), "pairs")
    asked = settle(members.select("node").distinct(), "nodes")
    texts = docs.select(text_of(text_col).alias("text")).select(node_of(F.col("text")).alias("node"), "text")
    # candidates grow with the documents: they are never broadcast, at any size
    texts = settle(texts.join(asked.hint("shuffle_merge"), "node", "left_semi").dropDuplicates(["node"]), "texts")
    links = settle(verified(pairs, texts, threshold), "links")
    groups = components(links)

    # What no comparison with a first text could show: members of one band that are still in different components.
    rooted = members.join(groups.withColumnRenamed("u", "node").withColumnRenamed("v", "root"), "node", "left")
    rooted = settle(rooted.filter("node <> first").select("band", "node", F.coalesce("root", "node").alias("root")), "rooted")
    split = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).filter("low <> high")
    split = settle(split.select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "bands-split")
    more = settle(between_components(rooted.join(split, "band"), texts, threshold), "links-rest")
    if not more.isEmpty():
        links = links.unionByName(more)
        groups = components(links)
    return links, groups


def between_components(rooted: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links that join components within a band; rows are (band, node, root, blocks).

    A band's texts are dealt into blocks, and every two blocks meet in one group of bounded size. There, products of
    the shingle matrices bound all similarities at once; what can reach the threshold is computed exactly, unless
    links found before have joined the two already. Pairs are never rows.
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least(own, other).alias("low"), F.greatest(own, other).alias("high")))
    dealt = rooted.join(texts, "node").select("band", "node", "root", "text", F.explode(others).alias("pair"))
    dealt = dealt.select("band", "pair.low", "pair.high", "node", "root", "text")

    def link(key, group):
        found = join_components(list(group.node), list(group.root), [_shingled(t) for t in group.text], threshold)
        return pd.DataFrame(found, columns=["u", "v"])

    return dealt.groupBy("band", "low", "high").applyInPandas(link, "u binary, v binary").distinct()


def join_components(nodes: list, roots: list, sets: list[tuple[np.ndarray, np.ndarray]], threshold: float = THRESHOLD) -> list[tuple]:
    """Pairs of nodes that reach the threshold and join all roots that pairs of these nodes can join."""
    above: dict = {root: root for root in roots}

    def top(root):
        while above[root] != root:
            above[root] = above[above[root]]
            root = above[root]
        return root

    _, at, counts = np.unique(np.concatenate([s[0] for s in sets]), return_inverse=True, return_counts=True)
    shared = counts > 1
    column = np.where(shared, np.cumsum(shared) - 1, -1)[at]
    row = np.repeat(np.arange(len(sets)), [len(s[0]) for s in sets])
    share = np.concatenate([s[1] / s[1].sum() for s in sets])
    has = column >= 0
    width, number = int(shared.sum()), np.unique(np.array(roots, object), return_inverse=True)[1]
    # the share of each text's weight that lies on shingles of the other; no similarity exceeds the lesser of both
    common = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, width, 4096):
        part = has & (column >= start) & (column < start + 4096)
        weights = np.zeros((len(sets), min(4096, width - start)), np.float32)
        weights[row[part], column[part] - start] = share[part]
        common += weights @ (weights > 0).astype(np.float32).T
    bound = np.minimum(common, common.T)
    bound[number[:, None] == number[None, :]] = 0
    one, two = np.nonzero(np.triu(bound >= threshold - 1e-4, 1))
    found = []
    for i, j in sorted(zip(one.tolist(), two.tolist(), strict=True), key=lambda pair: -bound[pair]):
        a, b = top(roots[i]), top(roots[j])
        if a != b and similarity(sets[i], sets[j]) >= threshold:
            above[a] = b
            found.append((max(nodes[i], nodes[j]), min(nodes[i], nodes[j])))
    return found


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(node, class_id, class_size, keeps): one row per distinct text.

    ``keeps`` names the text of the class's document with the smallest id.
    """
    _, groups = near_links(docs, text_col, threshold)
    nodes = docs.select(F.col(id_col).alias("id"), node_of(text_of(text_col)).alias("node")).groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    nodes = nodes.join(groups.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").withColumn("root", F.coalesce("root", "node"))
    nodes = settle(nodes, "texts-classed")
    # a class whose ids are all null is kept by its smallest node
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("node"))
    classes = settle(nodes.groupBy("root").agg(F.min("id").alias("class_id"), F.sum("n").alias("class_size"), F.min(order).alias("best")).select("root", "class_id", "class_size", F.col("best.node").alias("keeps")), "classes")
    return nodes.join(classes, "root").select("node", "class_id", "class_size", "keeps")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: its id, class_id, class_size, and whether it is the one that stays (of equal ids, all)."""
    classes = settle(near_classes(docs, id_col, text_col, threshold), "near-classes")
    rows = docs.select(F.col(id_col), node_of(text_of(text_col)).alias("node"))
    stays = F.col(id_col).eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("keeps"))
    return rows.join(classes, "node").select(id_col, "class_id", "class_size", stays.alias("stays"))


def near_deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: exactly one of each class."""
    classes = near_classes(docs, id_col, text_col, threshold).filter("node = keeps")
    classes = settle(classes.select(F.col("node").alias("_node"), F.col("class_id").alias("_id")), "near-kept")
    rows = docs.withColumn("_node", node_of(text_of(text_col))).withColumn("_id", F.col(id_col))
    kept = rows.join(classes, (rows._node == classes._node) & rows._id.eqNullSafe(classes._id), "left_semi")
    return kept.dropDuplicates(["_node", "_id"]).select(*[F.col(f"`{c}`") for c in docs.columns])
