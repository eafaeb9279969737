"""Personal data: plain spans against the patterns as they stand, disguised ones by planted cases."""

import hashlib
import random
import re
import time

import pytest

from rollbook.llm import pii
from rollbook.llm.queries import QUERIES

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == 3 and not 8 <= len(digits) <= 15:
                continue
            found.append((kind, *m.span()))
    return found


def card(rng, size):
    body = [rng.randrange(10) for _ in range(size - 1)]
    return next(c for d in range(10) if luhn(c := "".join(map(str, [*body, d]))))


def test_plain_spans_equal_the_patterns():
    rng = random.Random(5)
    bits = ["a", "b.c", "@", "@", ".", "1", "25", "256", "0255", "-", " ", "_", "+", "+1", "(", ")", "é", "x@y.z", "1.2.3.4", "+34 600 12", card(rng, 16), card(rng, 19), "4111 1111-1111 1111", "\n"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        assert pii.plain(text) == brute(text), text


DISGUISED = [
    ("write to john (at) example (dot) org now", "email", "john (at) example (dot) org"),
    ("john dot smith at mail dot example dot com", "email", "john dot smith at mail dot example dot com"),
    ("j.doe[at]example.co.uk!", "email", "j.doe[at]example.co.uk"),
    ("ana arroba correo punto es", "email", "ana arroba correo punto es"),
    ("x john @ example.com", "email", "john @ example.com"),
    ("mail jоhn@exаmple.com", "email", "jоhn@exаmple.com"),  # two Cyrillic letters
    ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("jo​hn@example.com", "email", "jo​hn@example.com"),
    ("john@example[.]com", "email", "john@example[.]com"),
    ("host 10[.]0[.]0[.]7 up", "ip", "10[.]0[.]0[.]7"),
    ("host 10 dot 0 dot 0 dot 7 up", "ip", "10 dot 0 dot 0 dot 7"),
    ("ip one nine two dot one six eight dot one dot one ok", "ip", "one nine two dot one six eight dot one dot one"),
    ("call plus three four six zero zero one two three four five six please", "phone", "plus three four six zero zero one two three four five six"),
    ("tel +34 sechs null null eins zwei drei", "phone", "+34 sechs null null eins zwei drei"),
    ("tél +３３ ６１２ ３４５ ６７８", "phone", "+３３ ６１２ ３４５ ６７８"),
    ("tel +34 600 123 456", "phone", "+34 600 123 456"),
    ("carta 4111‑1111‑1111‑1111.", "card", "4111‑1111‑1111‑1111"),
    ("four one one one one one one one one one one one one one one one", "card", "four one one one one one one one one one one one one one one one"),
    ("four double one one one one one one one one one one one one one one", "card", "four double one one one one one one one one one one one one one one"),
]


@pytest.mark.parametrize(("text", "kind", "part"), DISGUISED)
def test_disguised_spans_lie_in_the_source(text, kind, part):
    for before in ("", "é😀 "):
        start = (before + text).index(part)
        base, more = pii.spans(before + text)
        assert (pii.KINDS.index(kind), start, start + len(part)) in more, (more, base)
        assert pii.masked(before + text) == (before + text).replace(part, f"<{kind}>")


@pytest.mark.parametrize("text", [
    "Look at example.com and dot the i's at home.", "We met at noon, one two three.", "a @ b", "5 @ 3.50 each", "Un deux trois, six et sept points.", "Привет, мир и всё", "v1.2.3 at 10.5",
    "see figure 1.2.3.4567", "plus one", "null null", "the point at issue is one of two",
])
def test_plain_prose_has_nothing(text):
    assert pii.spans(text) == ([], [])


def test_rewrites_map_back():
    step = pii.Rewrite("one two three", [(0, 4, "1"), (4, 7, "22"), (8, 8, "-")])
    assert step.text == "122 -three" and step.back(0, 1) == (0, 4, True) and step.back(1, 3) == (4, 7, True) and step.back(5, 10) == (8, 13, False)


def test_scans_are_linear():
    start = time.time()
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 300_000, "+1" * 150_000, "a@" * 150_000, "one " * 80_000, " at " * 80_000, "a dot " * 50_000 + "at b", "1 " * 150_000, "+" + "1(" * 99_999, "double " * 50_000, " (" * 99_999):
        pii.spans(text)
    assert time.time() - start < 30


def test_table(spark):
    texts = [None, "", "a@b.c and a@b.c", *(t for t, *_ in DISGUISED), "+34 600 123 456 " + "x " * 100_000]
    docs = spark.createDataFrame([(k, t, "n", 5, 1) for k, t in enumerate(texts * 2)], "doc_id long, text string, spans string, n_ip int, `a.b` int")
    found = pii.found(docs)
    rows = found.collect()
    assert found.columns.count("spans") == 1 and "a.b" in found.columns and len(rows) == 2 * len(texts)
    for row in rows:
        base = brute(row.text)
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(k == kind for k, *_ in base) for kind in range(4)]
        assert row.base_sha256 == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base} <= set(row.spans.split(","))
    assert {r.masked for r in pii.redacted(docs).filter("doc_id = 2").collect()} == {"<email> and <email>"}
    assert pii.found(docs.limit(0)).count() == 0


def test_query(spark, sf_dir):
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op11_personal_data"](spark, sf_dir).collect()
    assert len(rows) == len(given)
    for row in rows:
        assert row.base_sha256 == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in brute(given[row.doc_id])).encode()).hexdigest()
