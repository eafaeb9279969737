"""Substring dedup: a distributed merge sort of suffixes that never compares known prefixes again.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id. Only suffixes at
anchors are sorted: of every ``LENGTH - GRAM + 1`` neighbouring strings of ``GRAM`` bytes the one with the smallest hash is an
anchor, so equal strings of ``LENGTH`` bytes have an anchor at the same place. Steps:

1. Equal texts are one, with their smallest id; later rows of it go whole. Texts shared by a third of all rows meet before the shuffle.
2. Hashes of anchors are dealt into buckets, one for each hash and batch of texts, and anchors that two texts have are found.
3. Every batch sorts the strings around its shared anchors (``LENGTH`` bytes from the anchor, then those before it,
   backwards) and keeps one of each for its smallest id: the others are covered by it. Sorted runs are front-coded and
   cut at fixed strings, so that strings with equal anchors meet.
4. A loser tree merges the runs of a part by their common prefixes. The prefixes it yields, and those of the strings
   before the anchors, number the distinct strings of ``LENGTH`` bytes at each of the offsets; the smallest id of each
   says which documents lose it.

However often a line occurs, each batch sends its strings once. Nothing is compared pairwise, and all results are exact:
a wrong agreement of hashes only sorts a string in vain.

Defined results: null counts as the empty text; texts below ``LENGTH`` bytes lose nothing; a null id is larger than all others; rows that
repeat an id never cover each other; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import text_of
from rollbook.llm.words import mixed, pieces

LENGTH, GRAM = 50, 26
SPAN = LENGTH - GRAM + 1
#: Bytes of text whose anchors make one bucket, and anchors that are sorted in one run.
BUCKET_BYTES, RUN = 32_000_000, 200_000
#: Texts that the cuts between parts are taken from.
SAMPLE = 500
_WIDTH = LENGTH + SPAN - 1
_FULL = _WIDTH + 2  # with the number of bytes on either side
_LAST = 2**63 - 1


def _sliding(x: np.ndarray, size: int, best) -> np.ndarray:
    """``best`` of all windows of ``size``, by doubling."""
    out, have = x, 1
    while have < size:
        step = min(have, size - have)
        out = best(out[:-step], out[step:])
        have += step
    return out


def _powers(size: int) -> np.ndarray:
    return np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(size)], np.uint64)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the anchors of consecutive texts."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    base, hashes, size, n = _powers(GRAM + 1), (mixed(np.arange(1, 257, dtype=np.uint64)))[data], 1, len(data)
    parts = {1: hashes}
    while size * 2 <= GRAM:  # hashes of 2, 4, 8, ... bytes
        last = parts[size]
        parts[size * 2] = last[:-size] * base[size] + last[size:]
        size *= 2
    total, have = parts[size], size
    for extra in sorted((k for k in parts if (GRAM - size) & k), reverse=True):
        tail = parts[extra][have : n - extra + 1]
        total = total[: len(tail)] * base[extra] + tail
        have += extra
    hashes = mixed(total)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    starts = np.arange(n - LENGTH + 1)
    least = _sliding(hashes, SPAN, np.minimum)[: len(starts)]
    least[starts + LENGTH > ends[: len(starts)]] = 0  # strings that would leave their text
    around = np.concatenate([np.zeros(SPAN - 1, np.uint64), least, np.zeros(SPAN - 1, np.uint64)])
    chosen = np.flatnonzero(_sliding(around, SPAN, np.maximum)[: len(hashes)] == hashes)
    return chosen, hashes[chosen]


def _rows(owner: np.ndarray, *values: np.ndarray):
    """Groups of equal owners: (owner, values...) each."""
    if not len(owner):
        return
    order = np.argsort(owner, kind="stable")
    owner = owner[order]
    cuts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    for a, b in zip(cuts, np.append(cuts[1:], len(owner)), strict=True):
        yield (int(owner[a]), *(v[order[a:b]] for v in values))


#: Numbers go in planes, the high parts of places apart, which compress well.
BUCKETS = "bucket int, nodes array<binary>, owner binary, at binary, beyond binary, low binary, high binary, known boolean"
SHARED = "node binary, at binary"


def _deal_anchors(buckets: int):
    def run(batches):
        for batch in batches:
            nodes, owner, at, hashes = batch.column(0), [], [], []
            for first, last, data, offsets in pieces(batch.column(2)):
                place, value = anchors(data, offsets)
                text = np.searchsorted(offsets, place, "right") - 1
                owner.append(first + text)
                at.append(place - offsets[text])
                hashes.append(value)
            if not owner:
                continue
            owner, at, hashes = np.concatenate(owner), np.concatenate(at), np.concatenate(hashes)
            order = np.lexsort((owner, hashes))
            begins = np.append(True, hashes[order][1:] != hashes[order][:-1]) if len(order) else np.zeros(0, bool)
            group = np.cumsum(begins) - 1
            first = np.flatnonzero(begins)
            several = owner[order][first] != owner[order][np.append(first[1:], len(order)) - 1] if len(first) else np.zeros(0, bool)
            known = np.zeros(len(order), bool)
            known[order] = several[group]
            lead = np.zeros(len(order), bool)
            lead[order[first]] = True
            bucket = (hashes >> np.uint64(40)) % np.uint64(buckets)
            # anchors that several texts of the batch have are shared already; one of each stands for them
            for mark, part in ((True, known), (False, ~known | lead)):
                for b, rows in _rows(bucket[part].astype(np.int64), np.flatnonzero(part)):
                    rows = rows[np.lexsort((at[rows], owner[rows]))]
                    used, own = np.unique(owner[rows], return_inverse=True)
                    low, high = hashes[rows].astype(np.uint32), (hashes[rows] >> np.uint64(32)).astype(np.uint8)  # the rest chose the bucket
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([b], pa.int32()), pa.array([nodes.take(pa.array(used)).to_pylist()], pa.list_(pa.binary())),
                            pa.array([own.astype(np.uint16 if len(used) < 65536 else np.uint32).tobytes()], pa.binary()), pa.array([at[rows].astype(np.uint16).tobytes()], pa.binary()),
                            pa.array([(at[rows] >> 16).astype(np.uint16).tobytes()], pa.binary()),
                            pa.array([b"" if mark else low.tobytes()], pa.binary()), pa.array([b"" if mark else high.tobytes()], pa.binary()), pa.array([mark]),
                        ],
                        names=["bucket", "nodes", "owner", "at", "beyond", "low", "high", "known"],
                    )

    return run


def _numbers(row: dict) -> np.ndarray:
    return np.frombuffer(row["owner"], np.uint16 if len(row["nodes"]) < 65536 else np.uint32).astype(np.int32)


def _find_shared(table: pa.Table) -> pa.Table:
    nodes, lists, rows = [], [], []
    for k in range(table.num_rows):
        row = {name: table.column(name)[k].as_py() for name in table.column_names}
        at, own = np.frombuffer(row["at"], np.uint16).astype(np.uint32), _numbers(row)
        at |= np.frombuffer(row["beyond"], np.uint16).astype(np.uint32) << np.uint32(16)
        if row["known"]:
            for k, places in _rows(own, at):
                nodes.append(row["nodes"][k])
                lists.append(places.tobytes())
        else:
            rows.append((row["nodes"], own, at, np.frombuffer(row["low"], np.uint32).astype(np.uint64) | (np.frombuffer(row["high"], np.uint8).astype(np.uint64) << np.uint64(32))))
    if rows:
        values, inverse = np.unique(np.concatenate([r[3] for r in rows]), return_inverse=True)
        # a batch sends a hash once, or several times from one text: another batch must have it too
        batch = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[3]) for r in rows])
        low, high = np.full(len(values), len(rows), np.int32), np.full(len(values), -1, np.int32)
        np.minimum.at(low, inverse, batch)
        np.maximum.at(high, inverse, batch)
        both, start = (low < high)[inverse], 0
        for names, own, at, hashes in rows:
            keep = both[start : start + len(hashes)]
            start += len(hashes)
            for k, places in _rows(own[keep], at[keep]):
                nodes.append(names[k])
                lists.append(places.tobytes())
    return pa.table({"node": pa.array(nodes, pa.binary()), "at": pa.array(lists, pa.binary())})


def around(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each anchor a row of bytes: ``LENGTH`` from it on, those before it backwards, and how many there are of each."""
    out = np.zeros((len(at), _FULL), np.uint8)
    right, left = at[:, None] + np.arange(LENGTH), at[:, None] - 1 - np.arange(SPAN - 1)
    out[:, :LENGTH] = np.where(right < len(data), data[np.minimum(right, len(data) - 1)], 0)
    out[:, LENGTH:_WIDTH] = np.where(left >= 0, data[np.maximum(left, 0)], 0)
    out[:, _WIDTH] = np.minimum(LENGTH, len(data) - at)
    out[:, _WIDTH + 1] = np.minimum(SPAN - 1, at)
    return out


def offsets_within(strings: np.ndarray) -> np.ndarray:
    """Bit r of each: whether the string of ``LENGTH`` bytes that starts r bytes before the anchor is within the text."""
    right, left = strings[:, _WIDTH].astype(int)[:, None], strings[:, _WIDTH + 1].astype(int)[:, None]
    r = np.arange(SPAN)
    return (((r <= left) & (LENGTH - r <= right)) << r).sum(axis=1)


def _words(rows: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return wide.view(">u8").astype(np.uint64)


def sorted_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix with the row before) of rows of bytes."""
    words = _words(rows)
    order = np.lexsort(words.T[::-1])
    return order, common_prefixes(rows[order])


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    differs = rows[1:] != rows[:-1]
    return np.concatenate([[0], np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])])[: len(rows)].astype(np.int64)


RUNS = "part int, nodes array<binary>, ids array<long>, owner binary, at binary, prefix binary, tails binary, masks binary"


def _row_of_run(part: int, nodes: list, ids: list, owner, at, prefix=b"", tails=b"", masks=b"") -> pa.RecordBatch:
    used, own = np.unique(owner, return_inverse=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()), pa.array([[nodes[k] for k in used]], pa.list_(pa.binary())), pa.array([[ids[k] for k in used]], pa.list_(pa.int64())),
            *(pa.array([x], pa.binary()) for x in (own.astype(np.uint16 if len(used) < 65536 else np.uint32).tobytes(), at.astype(np.uint32).tobytes(), prefix, tails, masks)),
        ],
        names=["part", "nodes", "ids", "owner", "at", "prefix", "tails", "masks"],
    )


def _make_runs(cuts: list[bytes]):
    def emit(nodes, ids, owner, at, strings):
        owner, at, strings = np.concatenate(owner), np.concatenate(at), np.concatenate(strings)
        of = np.array(ids, np.int64)[owner]
        order, prefix = sorted_rows(strings)
        group = np.cumsum(prefix < _FULL) - 1
        least = np.full(group[-1] + 1, _LAST)
        np.minimum.at(least, group, of[order])
        covered = of[order] > least[group]
        done = order[covered]
        if len(done):
            yield _row_of_run(int(at[done[0]]) % (len(cuts) + 1), nodes, ids, owner[done], at[done], masks=offsets_within(strings[done]).astype(np.uint32).tobytes())
        order = order[~covered]
        strings, owner, at = strings[order], owner[order], at[order]
        prefix = common_prefixes(strings)
        places = [0, *(bisect.bisect_left(range(len(strings)), cut, key=lambda k: strings[k, : len(cut)].tobytes()) for cut in cuts), len(strings)]
        for part, (a, b) in enumerate(zip(places, places[1:], strict=False)):
            if a < b:
                known = prefix[a:b].copy()
                known[0] = 0
                tails = strings[a:b][np.arange(_FULL) >= known[:, None]]
                yield _row_of_run(part, nodes, ids, owner[a:b], at[a:b], known.astype(np.uint8).tobytes(), tails.tobytes())

    def run(batches):
        for batch in batches:
            nodes, ids, owner, at, strings, size = [], [], [], [], [], 0
            for node, doc, text, places in zip(*(batch.column(k) for k in range(4)), strict=True):
                data = np.frombuffer(text.as_py().encode(), np.uint8)
                places = np.unique(np.concatenate([np.frombuffer(p, np.uint32) for p in places.as_py()])).astype(np.int64)
                for start in range(0, len(places), RUN):
                    part = places[start : start + RUN]
                    owner.append(np.full(len(part), len(nodes)))
                    at.append(part)
                    strings.append(around(data, part))
                    size += len(part)
                nodes.append(node.as_py())
                ids.append(doc.as_py())
                if size >= RUN:
                    yield from emit(nodes, ids, owner, at, strings)
                    nodes, ids, owner, at, strings, size = [], [], [], [], [], 0
            if size:
                yield from emit(nodes, ids, owner, at, strings)

    return run


class LoserTree:
    """Merges sorted front-coded runs; each yields (common prefix with its own last string, string, payload).

    A contender knows its common prefix with the string that was put out last. The one with the longer prefix is
    smaller; only equal prefixes are looked beyond, from where they end. So no byte that is known to agree is read again.
    """

    def __init__(self, runs: list):
        self.runs = [iter(r) for r in runs]
        self.size = 1
        while self.size < max(1, len(runs)):
            self.size *= 2
        self.head = [next(self.runs[k], None) if k < len(runs) else None for k in range(self.size)]
        self.prefix = [0] * self.size  # with the last string put out; at first, with nothing
        self.loser = [0] * self.size
        self.winner = self._play(1)

    def _match(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser then knows its common prefix with the winner."""
        x, y = self.head[a], self.head[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        m, n = self.prefix[a], self.prefix[b]
        if m != n:
            return (a, b) if m > n else (b, a)
        s, t = x[1], y[1]
        while m < _FULL and s[m] == t[m]:
            m += 1
        if m == _FULL or s[m] < t[m]:
            self.prefix[b] = m
            return a, b
        self.prefix[a] = m
        return b, a

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, self.loser[node] = self._match(self._play(2 * node), self._play(2 * node + 1))
        return winner

    def __iter__(self):
        while (head := self.head[self.winner]) is not None:
            k = self.winner
            yield self.prefix[k], head[1], head[2]
            self.head[k] = follows = next(self.runs[k], None)
            self.prefix[k] = follows[0] if follows else 0
            node = (k + self.size) // 2
            while node:
                k, self.loser[node] = self._match(k, self.loser[node])
                node //= 2
            self.winner = k


def decoded(prefix: bytes, tails: bytes, first: int):
    """The strings of a front-coded run, numbered from ``first``."""
    last, at = b"", 0
    for k, known in enumerate(prefix):
        last = last[:known] + tails[at : at + _FULL - known]
        at += _FULL - known
        yield known, last, first + k


def covered_offsets(strings: np.ndarray, prefix: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Bits of the offsets at which a smaller id has the same ``LENGTH`` bytes; ``strings`` are sorted, with common prefixes."""
    left = strings[:, LENGTH:_WIDTH]
    order, left_prefix = sorted_rows(left)
    within, out = offsets_within(strings), np.zeros(len(strings), np.int64)
    for r in range(SPAN):
        right_number = np.cumsum(prefix < LENGTH - r)
        left_number = np.empty(len(strings), np.int64)
        left_number[order] = np.cumsum(left_prefix < r) if r else 0
        valid = np.flatnonzero((within >> r) & 1)
        if not len(valid):
            continue
        # numbers are below 2**31 each: a part has far fewer strings
        _, number = np.unique((right_number[valid] << 31) | left_number[valid], return_inverse=True)
        least = np.full(number.max() + 1, _LAST)
        np.minimum.at(least, number, ids[valid])
        out[valid] |= (ids[valid] > least[number]).astype(np.int64) << r
    return out


def _merge_runs(table: pa.Table) -> pa.Table:
    nodes, owners, ats, runs, ids, found, n = [], [], [], [], [], [], 0
    for row in table.to_pylist():
        own, at = _numbers(row).astype(np.int64), np.frombuffer(row["at"], np.uint32).astype(np.int64)
        if row["masks"]:
            found.append((own + len(nodes), at, np.frombuffer(row["masks"], np.uint32).astype(np.int64)))
        else:
            runs.append(decoded(row["prefix"], row["tails"], n))
            n += len(own)
            owners.append(own + len(nodes))
            ats.append(at)
        nodes += row["nodes"]
        ids += row["ids"]
    if runs:
        prefix, strings, payload = zip(*LoserTree(runs), strict=True)
        payload = np.array(payload)
        owner, at = np.concatenate(owners)[payload], np.concatenate(ats)[payload]
        matrix = np.frombuffer(b"".join(strings), np.uint8).reshape(-1, _FULL)
        mask = covered_offsets(matrix, np.array(prefix), np.array(ids, np.int64)[owner])
        hit = mask > 0
        found.append((owner[hit], at[hit], mask[hit]))
    out_nodes, out = [], []
    if found:
        owner, at, mask = (np.concatenate(x) for x in zip(*found, strict=True))
        for k, places, masks in _rows(owner, at, mask):
            out_nodes.append(nodes[k])
            out.append(np.stack([places, masks]).astype(np.uint32).tobytes())
    return pa.table({"node": pa.array(out_nodes, pa.binary()), "hits": pa.array(out, pa.binary())})


def removed(size: int, hits: list[bytes]) -> np.ndarray:
    """Which of a text's ``size`` bytes go; ``hits`` are (anchors, offsets) of covered strings."""
    change = np.zeros(size + 1, np.int64)
    for blob in hits:
        at, mask = np.frombuffer(blob, np.uint32).astype(np.int64).reshape(2, -1)
        row, r = np.nonzero((mask[:, None] >> np.arange(SPAN)) & 1)
        starts = np.unique(at[row] - r)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + LENGTH, -1)
    return np.cumsum(change)[:size] > 0


def _finish(batches):
    for batch in batches:
        out = []
        for node, text, hits in zip(batch.column(0), batch.column(2), batch.column(3), strict=True):
            data = text.as_py().encode()
            gone = removed(len(data), hits.as_py() or [])
            begins = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            out.append((node.as_py(), int(gone.sum()), begins, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string())
        names = ["node", "n_removed", "n_spans", "kept_sha256", "kept"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _cuts(texts: DataFrame, parts: int) -> list[bytes]:
    """Strings of ``GRAM`` bytes or fewer that cut the anchors of a sample of texts into about equal parts."""
    rows = texts.select(F.substring("text", 1, 4000).alias("text")).limit(SAMPLE).collect()
    found = []
    for row in rows:
        data = np.frombuffer(row.text.encode(), np.uint8)
        found += [data[a : a + GRAM - 2].tobytes() for a in anchors(data, np.array([0, len(data)]))[0]]
    found.sort()
    return sorted({found[len(found) * k // parts] for k in range(1, parts)}) if found else []


def _node(text: str):
    # never null, and declared so: all uses of the texts then are one and the same shuffle
    return F.coalesce(F.unhex(F.md5(text)), F.lit(b""))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept): one row per document; ``kept`` is the text that is left
    (bytes cut out of a character are replaced there, not in the digest)."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.select("id", F.coalesce(F.col("id").cast("long"), F.lit(_LAST)).alias("doc"), _node("text").alias("node"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, size // BUCKET_BYTES + 1)
    texts = rows.groupBy("node").agg(F.min("doc").alias("doc"), F.first("text").alias("text")).select("node", "doc", "text")

    shared = texts.mapInArrow(_deal_anchors(buckets), BUCKETS).groupBy("bucket").applyInArrow(_find_shared, SHARED)
    shared = shared.groupBy("node").agg(F.collect_list("at").alias("at"))
    runs = texts.join(shared, "node").select("node", "doc", "text", "at").mapInArrow(_make_runs(_cuts(rows, 2 * buckets)), RUNS)
    hits = runs.groupBy("part").applyInArrow(_merge_runs, "node binary, hits binary").groupBy("node").agg(F.collect_list("hits").alias("hits"))
    done = texts.join(hits, "node", "left").select("node", "doc", "text", "hits").mapInArrow(
        _finish, "node binary, n_removed long, n_spans long, kept_sha256 string, kept string"
    )
    first = rows.groupBy("node").agg(F.min("doc").alias("first"))
    n_bytes = rows.select("id", "doc", "node", F.octet_length("text").cast("long").alias("n_bytes"))
    joined = n_bytes.join(first, "node").join(done, "node")
    whole = (F.col("doc") > F.col("first")) & (F.col("n_bytes") >= LENGTH)
    return joined.select(
        F.col("id").alias(id_col), "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"), F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
