"""Benchmark decontamination by greedy string tiling.

Words are compared without case and punctuation. Runs of ``MIN_MATCH`` words that a text shares with a benchmark item
are the seeds; from them follows how much of the item tiles could cover at most, and only pairs that can reach the
threshold are tiled. Tiling marks the longest common run of words that are still free, again and again, until no run of
``MIN_MATCH`` words is left, so a passage is found in any order of its parts. Runs of one length are found by running
Karp-Rabin hashes; lengths start high and are halved.

The benchmark is read in blocks of bounded size (``BLOCK_BYTES``), and each block is held against all texts where they
are: texts are never shuffled or joined, each is judged alone, and hot sources or copies do not matter.

Defined results: null and empty texts are clean; items with fewer than ``MIN_MATCH`` words fit nothing, null ones too;
items that repeat give repeated rows; empty tables give clean texts. ``decontaminated`` passes all columns on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rollbook.llm.common import text_of
from rollbook.llm.words import PLAIN, pieces, running, shingles, windows, word_hashes

MIN_MATCH = 5
#: Least share of an item's words that tiles cover in a contaminated text.
MIN_COVERAGE = 0.5
#: First length that is looked for.
FIRST_MATCH = 32
BLOCK_BYTES = 4_000_000


def _free_windows(free: np.ndarray, size: int) -> np.ndarray:
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(taken[size:] == taken[:-size]) if len(free) >= size else np.zeros(0, np.int64)


def _common_run(item, text, free_item, free_text, a, b) -> int:
    most = min(len(item) - a, len(text) - b)
    same = (item[a : a + most] == text[b : b + most]) & free_item[a : a + most] & free_text[b : b + most]
    return most if same.all() else int(np.argmin(same))


def tile(item: np.ndarray, text: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles (start in the item, start in the text, words): no word of either is in two of them."""
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    sums_item, sums_text = running(item), running(text)
    tiles: list[tuple[int, int, int]] = []
    size = max(min_match, min(FIRST_MATCH, len(item), len(text)))
    while True:
        at_item, at_text = _free_windows(free_item, size), _free_windows(free_text, size)
        of_item = windows(item, size, sums_item)[at_item]
        order = np.argsort(of_item, kind="stable")
        sorted_item = of_item[order]
        of_text = windows(text, size, sums_text)[at_text]
        low, high = np.searchsorted(sorted_item, of_text, "left"), np.searchsorted(sorted_item, of_text, "right")
        matches = []
        for k in np.flatnonzero(high > low):
            b = int(at_text[k])
            for a in at_item[order[low[k] : high[k]]]:
                a = int(a)
                if a and b and item[a - 1] == text[b - 1] and free_item[a - 1] and free_text[b - 1]:
                    continue  # part of the run that starts before
                n = _common_run(item, text, free_item, free_text, a, b)
                if n >= size:
                    matches.append((-n, a, b))
        again = False
        for n, a, b in sorted(matches):  # the longest first
            left = _common_run(item, text, free_item, free_text, a, b)
            if left < -n:
                again = True  # a longer tile has taken part of it; what is left may be found anew
            else:
                tiles.append((a, b, left))
                free_item[a : a + left] = free_text[b : b + left] = False
        if again:
            continue
        if size == min_match:
            return tiles
        size = max(min_match, size // 2)


class Benchmark:
    """A block of items, and which of them a text contains."""

    def __init__(self, ids: list, texts: list[str], min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE):
        self.min_match, self.min_coverage = min_match, min_coverage
        self.ids, self.items = [], []
        seeds, item_of, at = [], [], []
        for key, text in zip(ids, texts, strict=True):
            data = np.frombuffer((text or "").encode(), np.uint8)
            words, _, _ = word_hashes(data, np.array([0, len(data)]), PLAIN)
            if len(words) < min_match:
                continue
            seeds.append(shingles(words, min_match))
            item_of.append(np.full(len(seeds[-1]), len(self.items)))
            at.append(np.arange(len(seeds[-1])))
            self.ids.append(key)
            self.items.append(words)
        if self.items:
            every = np.concatenate(seeds)
            order = np.argsort(every, kind="stable")
            self.seeds, self.item_of, self.at = every[order], np.concatenate(item_of)[order], np.concatenate(at)[order]

    def contained(self, words: np.ndarray, hits: np.ndarray) -> list[tuple[int, float, int]]:
        """(item, coverage, tiles) for a text, ``hits`` being its seeds that items have."""
        low, high = np.searchsorted(self.seeds, hits, "left"), np.searchsorted(self.seeds, hits, "right")
        entries = np.concatenate([np.arange(a, b) for a, b in zip(low, high, strict=True)])
        out = []
        for item in np.unique(self.item_of[entries]):
            length = len(self.items[item])
            covered = np.zeros(length, bool)
            for at in self.at[entries[self.item_of[entries] == item]]:
                covered[at : at + self.min_match] = True
            if covered.sum() >= self.min_coverage * length:
                tiles = tile(self.items[item], words, self.min_match)
                words_tiled = sum(n for _, _, n in tiles)
                if words_tiled >= self.min_coverage * length:
                    out.append((int(item), words_tiled / length, len(tiles)))
        return out

    def search(self, column: pa.Array) -> list[tuple[int, int, float, int]]:
        """(row, item, coverage, tiles) over a column of texts."""
        out = []
        if not self.items:
            return out
        for first, _, data, offsets in pieces(column):
            words, _, bounds = word_hashes(data, offsets, PLAIN)
            found = shingles(words, self.min_match)
            if not len(found):
                continue
            place = np.minimum(np.searchsorted(self.seeds, found), len(self.seeds) - 1)
            hit = np.flatnonzero(self.seeds[place] == found)
            row = np.searchsorted(bounds, hit, "right") - 1
            inside = hit + self.min_match <= bounds[row + 1]
            hit, row = hit[inside], row[inside]
            for r in np.unique(row):
                seeds = np.unique(found[hit[row == r]] if len(hit) < 1000 else found[hit[np.searchsorted(row, r) : np.searchsorted(row, r, "right")]])
                out += [(first + int(r), *match) for match in self.contained(words[bounds[r] : bounds[r + 1]], seeds)]
        return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, **how) -> list[Benchmark]:
    rows = benchmark.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // BLOCK_BYTES + 1
    for k in range(n):
        part = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()  # a bounded share of the items
        yield Benchmark([r.id for r in part], [r.text for r in part], **how)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text", **how) -> DataFrame:
    """(``id_col``, ``item_col``, coverage, n_tiles) for each text and item whose tiles reach the threshold."""
    schema = T.StructType([
        docs.schema[id_col], benchmark.schema[item_col], T.StructField("coverage", T.DoubleType()), T.StructField("n_tiles", T.LongType())
    ])
    narrow, arrow, out = docs.select(F.col(id_col), text_of(text_col).alias("_text")), to_arrow_schema(schema), None
    for block in _blocks(benchmark, item_col, item_text_col, **how):

        def run(batches, block=block):
            for batch in batches:
                found = block.search(batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([f[0] for f in found], pa.int64())), pa.array([block.ids[f[1]] for f in found], arrow.field(1).type),
                        pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.int64()),
                    ],
                    names=schema.names,
                )

        part = narrow.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col="text", item_col="item_id", item_text_col="text", **how) -> DataFrame:
    """The rows of ``docs`` whose texts contain no item."""
    schema = docs.schema
    for block in _blocks(benchmark, item_col, item_text_col, **how):

        def run(batches, block=block):
            for batch in batches:
                found = {f[0] for f in block.search(batch.column(len(schema)))}
                stay = pa.array([k for k in range(batch.num_rows) if k not in found], pa.int64())
                yield pa.RecordBatch.from_arrays([c.take(stay) for c in batch.columns[: len(schema)]], names=schema.names)

        docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns], text_of(text_col).alias("__text")).mapInArrow(run, schema)
    return docs
