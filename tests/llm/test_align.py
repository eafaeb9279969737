"""Tokenizer alignment against a plain version that goes token by token."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from rollbook.llm import align
from rollbook.llm.queries import QUERIES

pytest.importorskip("sentencepiece")
pytest.importorskip("tokenizers")
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def brute(rows):
    """{row number: result} of (id, text) rows."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(public_tokenizers.path(A))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B))
    piece_a, piece_b = align.ByteTokenizer(A).pieces, align.PieceTokenizer(B).pieces
    found, total = [], Counter()
    for key, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        if not text or b"".join(piece_a[k] for k in a) != (" " + text).encode() or b"".join(piece_b[k] for k in b) != (" " + text).encode():
            found.append((key, 0, 0, [], ""))
            continue
        links, groups, i, j, end_a, end_b, own_a, own_b = [], [], 0, 0, 0, 0, [], []
        while i < len(a) or j < len(b):
            if end_a <= end_b and i < len(a):
                own_a.append(a[i])
                end_a, i = end_a + len(piece_a[a[i]]), i + 1
            else:
                own_b.append(b[j])
                end_b, j = end_b + len(piece_b[b[j]]), j + 1
            if end_a == end_b:
                links.append((own_a[-1], own_b[-1]))
                groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
                own_a, own_b = [], []
        total.update(links)
        found.append((key, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = Counter()
    for (_, b), n in total.items():
        most[b] = max(most[b], n)
    return sorted((
        (key, n_a, n_b, len(links), len(links), sum(total[x] == most[x[1]] for x in links), sum(total[x] for x in links), sha) for key, n_a, n_b, links, sha in found
    ), key=str)


def results(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=str)


TEXTS = [
    None, "", " ", "a", "a  b\n\tc", "ｄｏｕｂｌｅ　width", "<|endoftext|> and <s> </s> <unk>", "é€😀 ünï", "don't you'll 1234567 ...", "▁ marks ▁▁", "\x00\x01 \x85 ​  ",
    "same text here", "same text here", "same text here", "Привет, мир! 你好", "end ", "\n", "word " * 300, " ".join(f"long text {chr(97 + k % 26)}{'xyz'[k % 3]}" for k in range(40_000)),
]


def test_equals_brute_force_on_odd_texts(spark):
    rows = [(k if k % 5 else None, t) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([(k, t, 7, "x", "y") for k, t in rows], "doc_id long, text string, n_a int, block string, `a.b` string").repartition(3)
    found, pairs = align.align(docs, A, B)
    assert results(found) == brute(rows)
    assert found.columns.count("n_a") == 1 and {"block", "a.b"} <= set(found.columns)
    assert {r.n_docs for r in pairs.filter("pair_links < n_docs").collect()} == set()
    assert align.align(docs.limit(0), A, B)[0].count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert results(QUERIES["op13_tokenizer_alignment"](spark, sf_dir)) == brute(rows)


def test_small_blocks_give_the_same(spark, sf_dir, monkeypatch):
    rows = [(k, f"some words {k % 3} again again " * (1 + k % 7)) for k in range(60)]
    monkeypatch.setattr(align, "POSTINGS", 8)
    monkeypatch.setattr(align, "PIECE", 64)
    found, _ = align.align(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2), A, B)
    assert results(found) == brute(rows)


def test_bitmaps_round_trip():
    rng = np.random.default_rng(1)
    numbers = [np.sort(rng.choice(align.BLOCK, n, replace=False)) for n in (1, 0, 5, align.DENSE - 1, align.DENSE, 30_000, 2)]
    group = np.repeat(np.arange(len(numbers)), [len(x) for x in numbers])
    bitmaps = align.packed(group, np.concatenate(numbers), len(numbers))
    assert max(len(x.as_py()) for x in bitmaps) <= align.BLOCK // 8
    for part in (bitmaps, bitmaps.slice(2, 4)):
        of, number = align.unpacked(part)
        assert [sorted(number[of == k]) for k in range(len(part))] == [list(numbers[k + part.offset]) for k in range(len(part))]


def test_planes_count_links():
    block = align.Block(100)
    doc = np.array([0] * 9 + [1] * 2 + [2])
    block.add(doc, np.full(12, 4), np.full(12, 5))
    block.add(np.array([3]), np.array([4]), np.array([5]))
    a, b, bitmap, planes, n_docs, links = block.bitmaps()
    assert (a.tolist(), b.tolist(), n_docs.tolist(), links.tolist()) == ([4], [5], [4], [13])
    assert align.unpacked(bitmap)[1].tolist() == [0, 1, 2, 3] and [align.unpacked(planes.flatten().slice(k, 1))[1].tolist() for k in range(4)] == [[1], [], [], [0]]


def test_ranked_merges_equal_the_library():
    tokenizer = align.ByteTokenizer(A)
    assert tokenizer.fast is not None
    rng = np.random.default_rng(2)
    letters = [chr(c) for c in [*range(32, 127), 9, 10, 13, *range(0xA1, 0x250), 0x2018, 0x2026] if align._PLAIN.fullmatch(chr(c))]
    for _ in range(300):
        text = "".join(rng.choice(letters, rng.integers(1, 60)))
        assert tokenizer.encode([text])[0] == tokenizer.model.encode(" " + text, add_special_tokens=False).ids
