r"""Alignment of two tokenizers over the same texts, with corpus-wide counts of linked token pairs from inverted bitmaps.

Each text is encoded twice. Byte offsets at which a token of either side ends cut the tokens into groups; the two tokens that end
there are linked. How often the corpus links a pair of ids is counted by an inverted index: documents are numbered
in blocks of at most 65,536, a pair has for each block a compressed bitmap of the documents that link it (two-byte numbers, or bits from
4,096 documents on), and multiplicity planes that hold the binary digits of how much oftener than once each does. Bitmaps of
the batches of a block are OR-merged in the task that reads the block. Popcounts of a bitmap give document
counts, popcounts of planes weighted by powers of two the link counts; Spark sums them per pair. The counts are then joined to the
bitmaps, which are regrouped by block: as postings they return the scores to their documents.

Texts stay where they are read: they never cross a shuffle, nor do token lists. What is shuffled is about two bytes for each
different pair of a document. A pair that every document has is one row for each block. A task holds at most ``POSTINGS`` postings
(or those of one document) and the two sums of one block. Results are written to the shared folder between the steps, so
that a lost executor costs its tasks only; numbers of blocks and documents are stored with the postings and don't change when a
later task runs twice.

Defined results: null and empty texts have no tokens, zeros and an empty digest; so have texts that a tokenizer does not give back
byte by byte. Rows that repeat are documents of their own, also without an id; copies count as often as they
occur. Long texts are encoded in parts, cut at single spaces between small letters where neither tokenizer has a token across. An empty
table gives an empty result. Input columns are passed on, those called like a result column are replaced.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rollbook.llm.common import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Postings that a task gathers before it writes them, and bytes of text that it aligns at once.
POSTINGS, PIECE = 1 << 21, 1 << 20
#: Texts beyond so many characters are encoded in parts.
PART = 1 << 17
#: Documents of a block, and how many of them make a bitmap of bits shorter than one of numbers.
BLOCK, DENSE = 1 << 16, 1 << 12
_SAFE = re.compile(r"(?<=[a-z]) (?=[a-z])")
#: Letters, digits and marks that all regular expression engines class alike.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-©«-±´¶-¸»¿-ɏ‘-„†-…]*")
RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def parts(text: str, size: int) -> list[str]:
    """``text`` without the spaces at which it is cut into parts of about ``size``."""
    out, start = [], 0
    while len(text) - start > size and (cut := _SAFE.search(text, start + size)):
        out.append(text[start : cut.start()])
        start = cut.end()
    return [*out, text[start:]]


class ByteTokenizer:
    """A byte-level model of the tokenizers library at ``public_tokenizers.path(name)``; a text gets a space in front."""

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        path = public_tokenizers.path(name)
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # their strings in a text are plain text
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        self.pieces = [b""] * self.model.get_vocab_size(with_added_tokens=True)
        for piece, k in model["vocab"].items():
            self.pieces[k] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()
        self.fast = self._by_rank(model)

    def _by_rank(self, model):
        """The same merges by token rank, which is several times faster, where ids are in the order of the merges."""
        import public_tokenizers

        try:
            import tiktoken
        except ImportError:
            return None
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        ids = [model["vocab"].get(m, -1) for m in merged]
        singles = {bytes([b]) for b in range(256)}
        if any(a >= b for a, b in itertools.pairwise(ids)) or not singles <= set(self.pieces[: ids[0] if ids else 256]):
            return None
        known = {*ids, *(k for k, p in enumerate(self.pieces) if p in singles)}
        ranks = {self.pieces[k]: k for k in known}
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = [self.fast.encode_ordinary(" " + t) if self.fast and _PLAIN.fullmatch(t) else None for t in texts]
        return [self.model.encode(" " + t, add_special_tokens=False).ids if ids is None else ids for t, ids in zip(texts, out, strict=True)]


class PieceTokenizer:
    """A sentencepiece model at ``public_tokenizers.path(name)``, which puts the space in front by itself."""

    def __init__(self, name: str):
        import public_tokenizers
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        names = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        # A piece has spaces at its front only: no piece then spans a single space between letters.
        self.splits = not any("▁" in p.lstrip("▁") for p in names) and self.model.encode("a b") == self.model.encode("a") + self.model.encode("b")
        self.pieces = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(names)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Side:
    """A tokenizer with its pieces in flat arrays."""

    def __init__(self, tokenizer):
        self.encode, self.splits = tokenizer.encode, getattr(tokenizer, "splits", True)
        self.sizes = np.array([len(p) for p in tokenizer.pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pool = np.frombuffer(b"".join(tokenizer.pieces), np.uint8)

    def tokens(self, texts: list[str], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, document) of all tokens."""
        lists = self.encode(texts)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(sizes.sum())), np.repeat(doc, sizes)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        return self.pool[np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]


class Digits:
    """Decimal ids with a mark behind, for many ids at once."""

    def __init__(self, top: int):
        self.size = np.array([len(str(k)) for k in range(top)], np.int64)
        width = int(self.size.max()) + 1
        self.table = np.zeros((top, width), np.uint8)
        for k in range(top):
            self.table[k, : self.size[k]] = list(str(k).encode())
        self.column = np.arange(width)

    def written(self, ids: np.ndarray, marks: np.ndarray) -> np.ndarray:
        cells, sizes = self.table[ids], self.size[ids]
        cells[np.arange(len(ids)), sizes] = marks
        return cells[self.column <= sizes[:, None]]


def aligned(texts: list[str], a: Side, b: Side, digits: Digits):
    """(n_a, n_b, n_groups, digests) by text, and (text, A id, B id) of all links."""
    n = len(texts)
    splits = a.splits and b.splits
    cut = [(parts(t, PART) if splits else [t]) if t else [] for t in texts]
    flat, doc = [p for ps in cut for p in ps], np.repeat(np.arange(n), [len(ps) for ps in cut])
    (ids_a, doc_a), (ids_b, doc_b) = a.tokens(flat, doc), b.tokens(flat, doc)
    sources = [(" " + t).encode() if t else b"" for t in texts]
    sizes = np.fromiter(map(len, sources), np.int64, n)

    def within(keep):
        return ids_a[keep[doc_a]], doc_a[keep[doc_a]], ids_b[keep[doc_b]], doc_b[keep[doc_b]]

    fits = (np.bincount(doc_a, a.sizes[ids_a], n) == sizes) & (np.bincount(doc_b, b.sizes[ids_b], n) == sizes) & (sizes > 0)
    ids_a, doc_a, ids_b, doc_b = within(fits)
    source = np.frombuffer(b"".join(itertools.compress(sources, fits)), np.uint8)
    wrong = np.flatnonzero((a.joined(ids_a) != source) | (b.joined(ids_b) != source))
    if len(wrong):
        ends = np.cumsum(np.where(fits, sizes, 0))
        fits = fits.copy()
        fits[np.searchsorted(ends, wrong, "right")] = False
        ids_a, doc_a, ids_b, doc_b = within(fits)

    ends_a, ends_b = np.cumsum(a.sizes[ids_a]), np.cumsum(b.sizes[ids_b])
    mark = np.zeros(int(sizes.sum()) + 1, bool)
    mark[ends_b] = True
    last_a = mark[ends_a]
    mark[:] = False
    mark[ends_a] = True
    last_b = mark[ends_b]
    at_a, at_b = np.flatnonzero(last_a), np.flatnonzero(last_b)

    # a group's A tokens, then its B tokens
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    order[np.arange(len(ids_a)) + np.concatenate([[0], at_b + 1])[group_a]] = np.arange(len(ids_a))
    order[np.arange(len(ids_b)) + (at_a + 1)[group_b]] = np.arange(len(ids_b)) + len(ids_a)
    ids = np.concatenate([ids_a, ids_b])[order]
    marks = np.concatenate([np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))])[order].astype(np.uint8)
    written = memoryview(np.ascontiguousarray(digits.written(ids, marks)))
    until = np.cumsum(np.bincount(np.concatenate([doc_a, doc_b])[order], digits.size[ids] + 1, n).astype(np.int64))
    digests, start = [], 0
    for end in until.tolist():
        digests.append(hashlib.sha256(written[start : end - 1]).hexdigest() if end > start else "")
        start = end

    count = [np.bincount(d, minlength=n).astype(np.int64) for d in (doc_a, doc_b, doc_a[at_a])]
    return (*count, digests), (doc_a[at_a], ids_a[at_a], ids_b[at_b])


def packed(group: np.ndarray, number: np.ndarray, groups: int) -> pa.Array:
    """A bitmap for each of ``groups`` groups, of numbers below ``BLOCK`` that are sorted by (group, number)."""
    n = np.bincount(group, minlength=groups)
    dense = n >= DENSE
    sizes = np.where(dense, BLOCK // 16, n)
    starts = np.cumsum(sizes) - sizes
    first = np.cumsum(n) - n
    out = np.zeros(int(sizes.sum()), "<u2")
    sparse = ~dense[group]
    out[(starts[group] + np.arange(len(group)) - first[group])[sparse]] = number[sparse]
    for k in np.flatnonzero(dense):
        bits = np.zeros(BLOCK, bool)
        bits[number[first[k] : first[k] + n[k]]] = True
        out[starts[k] : starts[k] + BLOCK // 16] = np.packbits(bits, bitorder="little").view("<u2")
    offsets = np.concatenate([[0], 2 * np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), groups, [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def unpacked(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bitmap, number) of all numbers in an array of bitmaps."""
    n = len(bitmaps)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, offsets, data = bitmaps.buffers()
    offsets = np.frombuffer(offsets, np.int32)[bitmaps.offset : bitmaps.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    sizes, offsets = np.diff(offsets), offsets - offsets[0]
    dense = sizes == BLOCK // 8
    small = np.repeat(~dense, sizes // 2)
    of = [np.repeat(np.arange(n), np.where(dense, 0, sizes // 2))]
    number = [data.view("<u2")[small].astype(np.int64)]
    for k in np.flatnonzero(dense):
        found = np.flatnonzero(np.unpackbits(data[offsets[k] : offsets[k + 1]], bitorder="little"))
        of.append(np.full(len(found), k))
        number.append(found)
    return np.concatenate(of), np.concatenate(number)


class Block:
    """Postings of the documents of one block."""

    def __init__(self, vocabulary: int):
        self.vocabulary, self.gathered, self.n = vocabulary, [], 0

    def add(self, doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        keys, counts = np.unique((a * self.vocabulary + b) * BLOCK + doc, return_counts=True)
        self.gathered.append((keys, counts))
        self.n += len(keys)

    def bitmaps(self):
        """(a, b, bitmap, planes, documents, links) of each pair: the batches' postings in one."""
        keys, counts = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (list(zip(*self.gathered, strict=True)) or ((), ())))
        order = np.argsort(keys, kind="stable")
        keys, more = keys[order], counts[order] - 1
        pair, number = keys // BLOCK, keys % BLOCK
        starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
        n = len(starts)
        group = np.repeat(np.arange(n), np.diff(np.append(starts, len(pair))))
        docs = np.bincount(group, minlength=n)
        links = docs + np.bincount(group, more, n).astype(np.int64)
        # one plane for each binary digit of the largest count
        most = np.maximum.reduceat(more, starts) if n else more
        planes = np.zeros(n, np.int64)
        while (most >> planes).any():
            planes += (most >> planes) > 0
        first = np.cumsum(planes) - planes
        of, at = [], []
        for k in range(int(planes.max()) if n else 0):
            has = np.flatnonzero((more >> k) & 1)
            of.append(first[group[has]] + k)
            at.append(number[has])
        of, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (of, at))
        order = np.argsort(of, kind="stable")
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, planes.sum()), pa.int32()), packed(of[order], at[order], int(planes.sum())))
        return pair[starts] // self.vocabulary, pair[starts] % self.vocabulary, packed(group, number, n), lists, docs, links


_PAIR = T.StructType([T.StructField(n, k) for n, k in (
    ("a", T.IntegerType()), ("b", T.IntegerType()), ("docs", T.BinaryType()), ("planes", T.ArrayType(T.BinaryType())),
    ("n_docs", T.LongType()), ("pair_links", T.LongType()),
)])
_DOC = T.StructType([T.StructField("ordinal", T.IntegerType()), *(T.StructField(n, T.LongType()) for n in RESULT[:4]), T.StructField("groups_sha256", T.StringType())])


def indexed(docs: DataFrame, a_name: str, b_name: str, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """One row for each document (``a`` null) and one for each pair of a block, written; and the input columns kept."""
    kept = [c for c in docs.columns if c not in RESULT and c != text_col]
    inner = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), *(F.col(f"`{c}`").alias(f"in{k}") for k, c in enumerate(kept)))
    schema = T.StructType([T.StructField("block", T.LongType()), *_PAIR.fields, *_DOC.fields, *inner.schema.fields[1:]])
    arrow = to_arrow_schema(schema)

    def rows(n: int, **given) -> pa.RecordBatch:
        columns = [given.get(f.name) for f in arrow]
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, f.type) if c is None else c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer_a, tokenizer_b = ByteTokenizer(a_name), PieceTokenizer(b_name)
        a, b, vocabulary = Side(tokenizer_a), Side(tokenizer_b), len(tokenizer_b.pieces)
        digits = Digits(max(len(tokenizer_a.pieces), vocabulary))
        number, ordinal, block = TaskContext.get().partitionId() << 32, 0, Block(vocabulary)

        def close():
            found = block.bitmaps()
            for start in range(0, len(found[0]), 20_000):
                part = [x[start : start + 20_000] for x in found]
                n = len(part[0])
                yield rows(n, block=np.full(n, number), a=part[0], b=part[1], docs=part[2], planes=part[3], n_docs=part[4], pair_links=part[5])

        for batch in batches:
            start = 0
            while start < batch.num_rows:
                texts, size = [], 0
                while start + len(texts) < batch.num_rows and size < PIECE and ordinal + len(texts) < BLOCK:
                    texts.append(batch.column(0)[start + len(texts)].as_py())
                    size += len(texts[-1])
                (n_a, n_b, groups, digests), (doc, ids_a, ids_b) = aligned(texts, a, b, digits)
                block.add(doc + ordinal, ids_a, ids_b)
                n = len(texts)
                part = batch.slice(start, n)
                yield rows(
                    n, block=np.full(n, number), ordinal=np.arange(ordinal, ordinal + n), n_a=n_a, n_b=n_b, n_groups=groups, n_links=groups,
                    groups_sha256=digests, **{f"in{k}": part.column(k + 1) for k in range(len(kept))},
                )
                start, ordinal = start + n, ordinal + n
                if ordinal == BLOCK or block.n >= POSTINGS:
                    yield from close()
                    number, ordinal, block = number + 1, 0, Block(vocabulary)
        yield from close()

    return settle(inner.mapInArrow(run, schema), "alignment"), kept


def pair_counts(index: DataFrame) -> DataFrame:
    """(a, b, n_docs, pair_links, best): documents and links of each pair; whether none of its B id has more links."""
    counts = settle(index.filter("a IS NOT NULL").groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("pair_links").alias("pair_links")), "pair-counts")
    most = counts.groupBy("b").agg(F.max("pair_links").alias("most"))
    return counts.join(most, "b").select("a", "b", "n_docs", "pair_links", (F.col("pair_links") == F.col("most")).alias("best"))


def scores(index: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, ordinal, n_best, count_sum) of each document that links a pair: what its postings return."""
    postings = index.filter("a IS NOT NULL").select("a", "b", "block", "docs", "planes").join(counts.select("a", "b", "pair_links", "best"), ["a", "b"])
    postings = postings.select("block", "docs", "planes", "pair_links", "best").repartition("block").sortWithinPartitions("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sums = None, np.zeros((3, BLOCK), np.int64)

        def done():
            found = np.flatnonzero(sums[0])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), current, np.int64)), pa.array(found, pa.int32()), pa.array(sums[1, found]), pa.array(sums[2, found])],
                names=["block", "ordinal", "n_best", "count_sum"],
            )

        for batch in batches:
            block, count, best = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 3, 4))
            of, number = unpacked(batch.column(1))
            planes = batch.column(2)
            values = planes.flatten()
            sizes = planes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            parent = np.repeat(np.arange(len(sizes)), sizes)
            digit = np.arange(len(parent)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            plane, number_more = unpacked(values)
            of, number = np.concatenate([of, parent[plane]]), np.concatenate([number, number_more])
            times = np.concatenate([np.ones(len(of) - len(plane), np.int64), np.int64(1) << digit[plane]])
            edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else []
            for first, end in itertools.pairwise([*edges, len(block)]):
                if block[first] != current:
                    if current is not None:
                        yield done()
                    current = block[first]
                    sums[:] = 0
                own = slice(None) if len(edges) == 1 else (of >= first) & (of < end)
                at, m, row = number[own], times[own], of[own]
                np.add.at(sums[0], at, m)
                np.add.at(sums[1], at, m * best[row])
                np.add.at(sums[2], at, m * count[row])
        if current is not None:
            yield done()

    return postings.mapInArrow(run, "block long, ordinal int, n_best long, count_sum long")


def align(docs: DataFrame, a_name: str, b_name: str, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with their counts, all pairs of linked ids with theirs) under tokenizers A (byte-level) and B (pieces)."""
    index, kept = indexed(docs, a_name, b_name, text_col)
    counts = settle(pair_counts(index), "pair-scores")
    rows = index.filter("a IS NULL").join(scores(index, counts), ["block", "ordinal"], "left")
    zero = F.lit(0).cast("long")
    documents = rows.select(
        *(F.col(f"in{k}").alias(c) for k, c in enumerate(kept)), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
    return documents, counts
