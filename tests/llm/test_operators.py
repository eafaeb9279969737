"""Each operator against a brute-force version, and with nulls, empty and long texts, ties, repeats and odd columns."""

import hashlib
import pathlib
import re

import numpy as np
import pytest

from rollbook.llm import language, minhash, mixing, passages, quality, secrets, suffixes, tiling, tokens, urls
from rollbook.llm.words import PLAIN, word_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
RANDOM = np.random.default_rng(3)
VOCABULARY = ["".join(RANDOM.choice(list("abcdefghijklmnop"), RANDOM.integers(2, 9))) for _ in range(900)]


def prose(n):
    return " ".join(VOCABULARY[k] for k in RANDOM.integers(0, len(VOCABULARY), n)).capitalize() + "."


LONG = "\n".join(prose(12) for _ in range(2500))
BASE, SHARED = prose(150), prose(70)
WORDS = BASE.split()
NEAR = " ".join([*WORDS[:75], "changed", *WORDS[76:]])
ROWS = [
    (1, BASE, "en", "a", 1), (2, NEAR, "en", "a", 1), (3, BASE, "en", None, 1), (3, BASE, "en", None, 1),
    (4, prose(60) + "\n" + SHARED, "de", "b", 1), (5, prose(40) + "\n" + SHARED + "\n" + prose(50), "de", "c", 1),
    (6, None, None, None, None), (7, "", "fr", "b", 0), (8, " \n\t ", "fr", "b", 4), (9, LONG, "en", "a", 1),
    (None, BASE, "en", "a", 1), (10, "é" * 60 + "ü" * 70, None, "d", 1), (11, "ü" * 90, "de", "d", 1), (12, "one two", "en", "d", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_mix_keeps_targets_and_repeats(spark, docs, none):
    found = mixing.mix(docs).collect()
    again = mixing.mix(docs).collect()
    assert sorted(map(str, found)) == sorted(map(str, again)) and len(found) == len(ROWS)
    assert sorted(r.size for r in found) == sorted(len(words(r[1])) for r in ROWS)
    assert all(r.taken <= 3 * r.size for r in found)
    total = sum(r.size for r in found)
    of = {r[3]: sum(len(words(x[1])) for x in ROWS if x[3] == r[3]) for r in ROWS}
    want = dict.fromkeys(of, 0.0)
    order = sorted([s for s in of if s], key=str.encode) + [None]
    weight, left, open_ = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, float(total), set(order)
    while open_:  # share again until none is above
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * of[s]}
        if not full:
            want |= {s: level * weight[s] for s in open_}
            break
        want |= {s: 3.0 * of[s] for s in full}
        left, open_ = left - sum(3 * of[s] for s in full), open_ - full
    sizes = {(r.source_size, round(r.target, 6)) for r in found}
    assert sizes == {(of[s], round(want[s], 6)) for s in order}
    assert mixing.mix(none).count() == 0
    clashing = docs.withColumn("target", docs.doc_id).withColumn("taken", docs.doc_id)
    assert mixing.mix_rows(clashing).columns.count("target") == 1


def test_quality_counts_and_verdicts(docs, none):
    def brute(text):
        text = text or ""
        every = words(text)
        triples = [tuple(every[k : k + 3]) for k in range(len(every) - 2)]
        covered = {k + j for k, t in enumerate(triples) if triples.count(t) > 1 for j in range(3)}
        lines = [line for line in text.split("\n") if words(line)]
        return len(every), sum(map(len, every)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)

    texts = ["a b c a b c d", "x x x x", "a\n\na\nb #", "é ü\u00a0z", "p q", "| | |\u2003 $$", "the cat sat on the cat sat on", ""]
    assert [quality.judge(t)[:5] for t in [*texts, None]] == [brute(t) for t in [*texts, None]]
    good, menu = prose(80), " | ".join(VOCABULARY[:80])
    assert quality.judge(good)[6] and not quality.judge(good + "\n" + menu + "\n" + menu)[6] and not quality.judge("word " * 80)[6]
    found = quality.judged(docs.withColumnRenamed("source", "kept"), cleaned="cleaned")
    assert found.count() == len(ROWS) and found.columns.count("kept") == 1 and quality.judged(none).count() == 0


def test_secrets_as_by_hand(spark, docs, none):
    key = "AKIA" + "B2C3D4E5F6G7H8I9"
    texts = [
        f'é Token = "abcdefgh12" and {key}!', "password: token: abcdefgh", "secret=short", "0" * 31 + " " + "a1" * 16 + "x" + "b" * 40,
        "api_key='" + "k" * 3000 + "' APIKEY:zzzzzzzz", "q8Zr2Lx9Vt4Wn7Kd3Ms6 here", "", None,
    ]
    frame = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, spans int")
    model = secrets.train(
        spark.createDataFrame([("".join(RANDOM.choice(list(secrets.ALPHABET[:62]), 24)), True) for _ in range(300)] + [(w, False) for w in VOCABULARY], "token string, random boolean")
    )

    def brute(text):
        found = []
        for kind, (pattern, part, least) in enumerate(((secrets.ASSIGN, 2, 8), (secrets.ACCESS, 0, 16), ("[0-9a-f]+", 0, 32))):
            found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text or "", re.A) if len(m[part]) >= least]
        return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))

    for model_ in (None, model):
        for row in secrets.scan(frame, model_).collect():
            base = brute(texts[row.doc_id])
            assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
            assert set(filter(None, base.split(","))) <= set(row.spans.split(","))
    assert {r.doc_id: r.n_random for r in secrets.scan(frame, model).collect()}[5] == 1
    assert all(r.n_random == 0 for r in secrets.scan(docs, model).collect())
    clean = {r.doc_id: r.text for r in secrets.redacted(frame, model).collect()}
    assert clean[0] == 'é <secret>" and <secret>!' and clean[1] == texts[1] and clean[7] is None
    assert secrets.train(secrets.labelled_tokens(none)) is None and secrets.scan(none, None).count() == 0


def test_urls_as_by_hand(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    given = [
        "http://Blog.EXAMPLE.org/es/1?x=/en/", "http://example.org/en/12#a", "http://org/", "http://norg/x", "https://a.b.com/de/", "x://c.com/fr", "http://c.com/fr/", None, "nothing",
        "", "http://example.org", "http://xexample.org/es/", "p://q://example.org/es/", "http://a.org:80/es/", "http://É.org/\u2028z",
    ]

    def brute(url):
        host = path = ""
        if url and "://" in url:
            host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "allow" if host else "block"))
        return host, path, rule, verdict

    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(given * 2)], "page_id long, url string, rule string")
    for keys in (200_000, 3):  # one range, and ranges of three keys
        urls.KEYS_PER_RANGE, before = keys, urls.KEYS_PER_RANGE
        found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, rules).collect()}
        urls.KEYS_PER_RANGE = before
        assert found == {k: brute(u) for k, u in enumerate(given * 2)}
    assert urls.judge(pages.limit(0), rules).count() == 0


def test_tokens_equal_the_library(spark, docs, none, tmp_path):
    sentencepiece = pytest.importorskip("sentencepiece")
    import public_tokenizers

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    cache, tokenizer = str(tmp_path / "cache"), tokens.PieceTokenizer("piece_bpe_32k.model")
    for _ in range(2):  # the second time all counts come from the cache
        found = tokens.count_tokens(docs, tokenizer, cache=cache).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in found) == sorted(
            (str(r[0]), len((r[1] or "").encode()), n := len(model.encode(r[1] or "")), n > 4096) for r in ROWS
        )
    assert spark.read.parquet(cache).count() == len({r[1] or "" for r in ROWS})
    assert "".join(p + " " for p in tokens.parts(LONG, 500))[:-1] == LONG and len(tokens.parts(LONG, 500)) > 100
    assert tokens.count_tokens(none, tokenizer).count() == 0


def test_tiles_do_not_overlap_and_find_reordered_passages(spark, docs, none):
    item = prose(40).split()
    shuffled = " ".join([prose(30), *item[25:], prose(9), *item[:25], prose(20)])
    hashed = lambda t: word_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]), PLAIN)[0]
    tiles = tiling.tile(hashed(" ".join(item)), hashed(shuffled))
    assert sum(n for _, _, n in tiles) == 40
    assert len({k for a, _, n in tiles for k in range(a, a + n)}) == 40 == len({k for _, b, n in tiles for k in range(b, b + n)})
    given = docs.unionByName(spark.createDataFrame([(90, shuffled.upper(), "en", "a", 1), (91, " ".join(item[:15]), "en", "a", 1)], SCHEMA))
    benchmark = spark.createDataFrame([(5, " ".join(item)), (6, None), (7, "a b"), (5, " ".join(item))], "item_id long, text string")
    found = tiling.contaminated(given, benchmark).collect()
    assert [(r.doc_id, r.item_id, r.coverage) for r in found] == [(90, 5, 1.0)] * 2
    left = tiling.decontaminated(given, benchmark)
    assert left.count() == len(ROWS) + 1 and left.filter("doc_id = 90").count() == 0 and left.columns == given.columns
    assert tiling.contaminated(none, benchmark).count() == 0 and tiling.decontaminated(docs, benchmark.limit(0)).count() == len(ROWS)


def test_language_learns_and_handles_odd_texts(spark, docs, none):
    alphabets = {"aa": "abcdefg ", "bb": "nopqrst ", "cc": "uvwxyzé "}
    rows = [(k, "".join(RANDOM.choice(list(letters), RANDOM.integers(80, 400))), lang) for k, (lang, letters) in enumerate(list(alphabets.items()) * 60)]
    given = spark.createDataFrame([*rows, (900, None, "aa"), (901, "12 34!", None), (None, "abc abc", None)], "doc_id long, text string, lang string")
    network = language.learn(given.filter(~language.held_out("doc_id")), epochs=25)
    found = language.predict(given.withColumn("held_out", language.held_out("doc_id")), network).collect()
    held = [r for r in found if r.held_out and r.lang and r.text]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held) > 10
    odd = {r.doc_id: (r.lang_pred, r.score) for r in found if r.doc_id in (900, 901)}
    assert odd == {900: ("und", 0.0), 901: ("und", 0.0)} and all(0 <= r.score <= 1 for r in found)
    assert language.learn(none) is None and {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}


def test_gradients_are_those_of_the_loss():
    read, inside, label = RANDOM.integers(97, 105, (6, 5)), np.ones((6, 5), bool), RANDOM.integers(0, 2, 5)
    network = language.Network(["x", "y"], hidden=3)
    network.weights = {k: w.astype(np.float64) for k, w in network.weights.items()}

    def loss():
        odds = network.labelled(read).astype(np.float64)
        return -np.log(odds[label[None, :], np.arange(6)[:, None], np.arange(5)[None, :]]).mean()

    for name, gradient in network.gradients(read, inside, label).items():
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        network.weights[name][at] += 1e-2
        up = loss()
        network.weights[name][at] -= 2e-2
        assert (up - loss()) / 2e-2 == pytest.approx(gradient[at], rel=0.05)
        network.weights[name][at] += 1e-2


def test_near_duplicates_equal_brute_force(spark, docs, none):
    drifting, text = [], prose(120).split()
    for k in range(40):  # a chain of texts, each near the one before
        text = [*text]
        text[int(RANDOM.integers(0, len(text)))] = "new" + str(k)
        drifting.append((100 + k, " ".join(text), "en", "a", 1))
    rows = [*ROWS, *drifting]
    given = spark.createDataFrame(rows, SCHEMA)
    sets = [minhash._shingled(r[1] or "") for r in rows]
    parent = list(range(len(rows)))

    def top(k):
        return k if parent[k] == k else top(parent[k])

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or (len(sets[i][0]) and minhash.similarity(sets[i], sets[j]) >= 0.8):
                parent[top(i)] = top(j)
    ids = {k: min([r[0] for n, r in enumerate(rows) if top(n) == k and r[0] is not None], default=None) for k in {top(n) for n in range(len(rows))}}
    found = minhash.near_duplicates(given).collect()
    assert sorted(str((r.doc_id, r.class_id)) for r in found) == sorted(str((r[0], ids[top(n)])) for n, r in enumerate(rows))
    kept = minhash.near_deduplicated(given)
    assert kept.count() == len(ids) and kept.columns == given.columns and minhash.near_duplicates(none).count() == 0


def test_probability_jaccard_by_its_sum():
    one = (np.array([1, 2, 3, 5], np.uint64), np.array([4, 1, 2, 2]))
    two = (np.array([1, 2, 4, 5], np.uint64), np.array([1, 3, 2, 2]))
    x, y = dict(zip(one[0].tolist(), one[1], strict=True)), dict(zip(two[0].tolist(), two[1], strict=True))
    every = x.keys() | y.keys()
    want = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in x.keys() & y.keys())
    assert minhash.similarity(one, two) == pytest.approx(want)


def test_components_are_joined_as_by_all_pairs():
    texts = [prose(60) for _ in range(3)]
    sets = [minhash._shingled(t) for t in [texts[0], texts[0] + " more", texts[1], texts[1] + " more", texts[2]]]
    assert minhash.join_components(list(range(5)), list(range(5)), sets) in ([(1, 0), (3, 2)], [(3, 2), (1, 0)])
    assert minhash.join_components(list(range(5)), [0, 0, 1, 1, 2], sets) == []


def test_substring_dedup_equals_brute_force(spark, docs, none):
    rows = [*ROWS, (13, "ab" * 80, "en", "a", 1), (14, "ab" * 70 + BASE[40:200], "en", "a", 1), (20, BASE[:120] + SHARED[:60], "en", "a", 1), (20, BASE[100:170], "en", "a", 1)]
    first: dict[bytes, int] = {}
    of = lambda r: 2**63 - 1 if r[0] is None else r[0]
    for r in rows:
        data = (r[1] or "").encode()
        for k in range(len(data) - 49):
            first[data[k : k + 50]] = min(first.get(data[k : k + 50], of(r)), of(r))
    want = []
    for r in rows:
        data = (r[1] or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 49):
            if first[data[k : k + 50]] < of(r):
                gone[k : k + 50] = True
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        want.append(str((r[0], len(data), int(gone.sum()), int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum()), hashlib.sha256(kept).hexdigest())))
    found = suffixes.deduplicated(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("n_chars", "n_bytes")).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in found) == sorted(want)
    assert suffixes.deduplicated(none).count() == 0


def test_loser_tree_merges_by_common_prefixes():
    rows = RANDOM.integers(0, 3, (400, suffixes._FULL)).astype(np.uint8)
    rows[::4, 20:] = 1
    runs, n = [], 0
    for part in np.array_split(rows, 7):
        order, prefix = suffixes.sorted_rows(part)
        tails = part[order][np.arange(suffixes._FULL) >= prefix[:, None]].tobytes()
        runs.append(suffixes.decoded(prefix.astype(np.uint8).tobytes(), tails, n))
        n += len(part)
    prefix, strings, payload = zip(*suffixes.LoserTree(runs), strict=True)
    assert list(strings) == sorted(r.tobytes() for r in rows) and sorted(payload) == list(range(400))
    assert list(prefix) == suffixes.common_prefixes(np.frombuffer(b"".join(strings), np.uint8).reshape(-1, suffixes._FULL)).tolist()


def test_passages_are_found_with_edits(spark, docs, none):
    found = {(r.doc_id, r.other_id): r for r in passages.repeated_passages(docs).collect()}
    assert (2, 1) in found and (3, 1) in found and (5, 4) in found and (None, 1) in found
    shared = found[5, 4]
    assert (shared.start_word, shared.end_word, shared.identity) == (40, 110, 1.0)
    assert all(pair[0] not in (6, 7, 8, 9, 10, 11, 12) for pair in found)
    assert passages.repeated_passages(none).count() == 0

    def slow(one, two):
        row = list(range(len(two) + 1))
        for a in one:
            last, row[0] = row[0], row[0] + 1
            for k, b in enumerate(two):
                last, row[k + 1] = row[k + 1], min(row[k + 1] + 1, row[k] + 1, last + (a != b))
        return row[-1]

    for _ in range(60):
        one, two = (RANDOM.integers(0, 4, RANDOM.integers(0, 90)).tolist() for _ in range(2))
        assert passages.edit_distance(one, two) == slow(one, two)


def passages_of(spark, *rows):
    """The passages of (id, words) as tuples."""
    docs = spark.createDataFrame([(k, " ".join(w), None, None, None) for k, w in rows], SCHEMA)
    return sorted(map(tuple, passages.repeated_passages(docs).collect()), key=str)


def fresh(prefix, n):
    """Words that stand nowhere else."""
    return [f"{prefix}x{k}" for k in range(n)]


def test_passages_of_a_failed_chain_are_judged_by_themselves(spark):
    one, two = fresh("p", 60), fresh("q", 60)
    for gap in (40, 60, 80):
        first = [*fresh("a", 30), *one, *fresh("b", gap), *two, *fresh("c", 30)]
        second = [*fresh("d", 10), *one, *fresh("e", gap), *two, *fresh("f", 20)]
        assert passages_of(spark, (1, first), (2, second)) == [
            (2, 1, 10, 70, 30, 90, 1.0), (2, 1, 70 + gap, 130 + gap, 90 + gap, 150 + gap, 1.0)
        ]
    text = fresh("t", 240)
    assert passages_of(spark, (1, text), (2, [*text[:90], *fresh("u", 60), *text[150:]])) == [(2, 1, 0, 90, 0, 90, 1.0), (2, 1, 150, 240, 150, 240, 1.0)]


def test_runs_are_all_maximal_runs():
    for _ in range(40):
        mine, other = (RANDOM.integers(0, 3, RANDOM.integers(0, 40)).astype(np.uint32) for _ in range(2))
        want = []
        for a in range(len(mine)):
            for b in range(len(other)):
                n = passages.equal_words(mine[a:], other[b:])
                if n >= passages.SEED and not (a and b and mine[a - 1] == other[b - 1]):
                    want.append((a, b, n))
        assert passages.Pivot(other).runs(mine) == want


def test_passages_repeated_within_a_text_are_found_at_each_place(spark):
    text = fresh("t", 60)
    first = [*fresh("a", 20), *text, *fresh("b", 20)]
    twice = [*fresh("c", 20), *text, *fresh("d", 30), *text, *fresh("e", 20)]
    assert passages_of(spark, (1, first), (2, twice)) == [(2, 1, 110, 170, 20, 80, 1.0), (2, 1, 20, 80, 20, 80, 1.0)]
    half = [*fresh("c", 20), *text[:30], *fresh("d", 30), *text, *fresh("e", 20)]
    assert passages_of(spark, (1, first), (2, half)) == [(2, 1, 80, 140, 20, 80, 1.0)]
    # the seeds of the first 30 words would all go to the other quotation
    assert passages_of(spark, (1, [*fresh("f", 20), *text[:30], *fresh("g", 30), *text]), (2, half)) == [(2, 1, 80, 140, 80, 140, 1.0)]


def test_passages_are_found_through_edits(spark):
    rows, cases = [], {}
    for k in (5, 6, 7, 8, 10, 20):  # one word of k replaced, or left out
        for off in range(0, k, 3):
            for out in (False, True):
                n = 2 * len(cases)
                text = fresh(f"t{n}", 60)
                changed = [f"n{w}" if j % k == off else w for j, w in enumerate(text) if not (out and j % k == off and k > 5)]
                rows += [(n, [*fresh(f"a{n}", 30), *text, *fresh(f"b{n}", 30)]), (n + 1, [*fresh(f"c{n}", 40), *changed, *fresh(f"d{n}", 20)])]
                cases[n] = (k, len(changed))
    found = passages_of(spark, *rows)
    assert sorted(x[:2] for x in found) == [(n + 1, n) for n in cases]
    for doc, _, start, end, *_ in found:
        k, size = cases[doc - 1]
        assert 40 <= start < 40 + 2 * k and 40 + size - 2 * k < end <= 40 + size and end - start >= 40


def test_passages_are_found_though_their_parts_stand_elsewhere(spark):
    for size in (20, 8):
        parts = [fresh(f"t{k}", size) for k in range(-(-48 // size))]
        whole = sum(parts, [])
        rows = [(k + 1, [*fresh(f"a{k}", 30), *part, *fresh(f"b{k}", 30)]) for k, part in enumerate(parts)]
        rows += [(21, [*fresh("c", 30), *whole, *fresh("d", 30)]), (22, [*fresh("e", 20), *whole, *fresh("f", 30)])]
        assert passages_of(spark, *rows) == [(22, 21, 20, 20 + len(whole), 30, 30 + len(whole), 1.0)]


def test_equal_words_are_found_as_by_brute_force(spark):
    size = passages.MIN_WORDS
    blocks = [fresh(f"k{k}", int(n)) for k, n in enumerate(RANDOM.integers(10, 60, 12))]
    rows = [(k, sum((blocks[j] for j in RANDOM.integers(0, len(blocks), 6)), [])) for k in range(30)]
    covered = {}
    for doc, _, start, end, *_ in passages_of(spark, *rows):
        covered.setdefault(doc, set()).update(range(start, end))
    first = {}
    for doc, words_ in rows:
        for k in range(len(words_) - size + 1):
            if first.setdefault(tuple(words_[k : k + size]), doc) < doc:
                assert set(range(k, k + size)) <= covered.get(doc, set())


def test_rows_that_share_an_id_or_have_none_are_compared(spark):
    text, other = fresh("t", 60), fresh("o", 50)
    found = passages_of(spark, (None, text), (None, [*fresh("a", 30), *text]), (None, other), (None, other), (7, fresh("b", 90)), (7, other))
    assert [x[:2] for x in found] == [(None, 7), (None, 7), (None, None)]
    assert [x[3] - x[2] for x in found] == [50, 50, 60] and all(x[6] == 1.0 for x in found)


def test_passages_of_every_two_texts_are_found(spark):
    """Their seeds stand in earlier documents one by one, and their passage in a first document that has another link to each."""
    base = fresh("t", 60)
    two, three, four = ([f"e{k}" if j % 10 == k else w for j, w in enumerate(base)] for k in (1, 4, 7))
    texts = [base, two, three, four]
    rows = [(k + 1, [*fresh(f"a{k}", 30), *text, *fresh(f"b{k}", 30)]) for k, text in enumerate(texts)]
    assert {x[:2] for x in passages_of(spark, *rows)} == {(j, k) for j in range(1, 5) for k in range(1, j)}
    # each run of 9 equal words stands in an early document, no two of them in the same
    text = fresh("u", 60)
    changed = [f"n{j}" if j % 10 == 9 else w for j, w in enumerate(text)]
    parts = [(k, [*fresh(f"c{k}", 40), *text[10 * k : 10 * k + 9], *fresh(f"d{k}", 40)]) for k in range(6)]
    assert {x[:2] for x in passages_of(spark, *parts, (21, text), (22, [*fresh("e", 30), *changed, *fresh("f", 30)]))} == {(22, 21)}
    # a copy leads to the first of its kind, which has the other links
    assert {x[:2] for x in passages_of(spark, *rows, (9, rows[1][1]))} == {(j, k) for j in range(1, 5) for k in range(1, j)} | {(9, 2)}


def test_dense_seeds_hold_for_every_passage():
    for _ in range(300):
        n = int(RANDOM.integers(40, 120))
        edits = np.sort(RANDOM.choice(n, n // 5, replace=False))
        if RANDOM.random() < 0.5:
            edits = np.unique(np.clip(np.arange(n // 5) * 5 + RANDOM.integers(0, 5), 0, n - 1))
        at = np.array([a for a in range(n - 3) if not ((edits >= a) & (edits < a + 4)).any()], np.int64)
        assert passages.dense(at, np.zeros(len(at), np.int64)).any()
    for at in ([0, 1, 2, 60, 61, 62], [0, 1, 2, 3], []):
        assert not passages.dense(np.array(at, np.int64), np.zeros(len(at), np.int64)).any()


def test_passages_of_periodic_texts_are_not_given_for_every_shift(spark):
    found = passages_of(spark, (1, [*fresh("a", 30), *["the"] * 150, *fresh("b", 30)]), (2, [*fresh("c", 20), *["the"] * 400, *fresh("d", 20)]))
    assert set().union(*(range(x[2], x[3]) for x in found)) == set(range(20, 420)) and len(found) < 8


def test_shared_seeds_cross_their_shuffles_packed(spark, monkeypatch):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [pathlib.Path(str(f)) for f in manager.localDirs()]
    there = lambda: {f: f.stat().st_size for d in folders for f in d.glob("*/shuffle_*.data") if f.exists()}
    before, most, settle = there(), [], passages.settle

    def watched(df, purpose):
        out = settle(df, purpose)
        most.append(sum(size for f, size in there().items() if f not in before))
        return out

    monkeypatch.setattr(passages, "settle", watched)
    texts = [" ".join(VOCABULARY[k] for k in RANDOM.integers(0, len(VOCABULARY), 700)) for _ in range(300)]
    texts[200] = texts[3][:3000] + texts[200]
    found = passages.repeated_passages(spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate(texts)], SCHEMA)).collect()
    assert [(r.doc_id, r.other_id, r.start_word, r.other_start) for r in found] == [(200, 3, 0, 0)]
    assert max(most) < 1.7 * sum(map(len, texts))


def test_groups_beyond_a_block_give_the_same_pairs(spark, monkeypatch):
    base = fresh("t", 60)
    rows = [(k, [*fresh(f"a{k}", 30), *base[: 50 + k], f"e{k}", *fresh(f"b{k}", 30)]) for k in range(9)]
    want = passages_of(spark, *rows)
    monkeypatch.setattr(passages, "BLOCK", 2)
    monkeypatch.setattr(passages, "HOME", 2)
    assert passages_of(spark, *rows) == want and {x[:2] for x in want} == {(j, k) for j in range(9) for k in range(j)}


def test_no_pair_with_a_passage_is_lost_by_its_neighbours():
    """Words of a passage keep so many neighbours, and codes that many texts have are counted as others are."""
    for _ in range(400):
        n = int(RANDOM.integers(40, 130))
        text = RANDOM.integers(0, 1 << 30, n).astype(np.uint32)
        edits = np.sort(RANDOM.choice(n, n // 5, replace=False)) if RANDOM.random() < 0.5 else np.arange(n // 5) * 5 + 4
        other = text.copy()
        other[edits] += 1
        assert passages.alike(passages.Pivot(other).beside(text)[None]).all()
    import pyarrow as pa

    line, lists = RANDOM.integers(0, 1 << 16, 30), []
    for k in range(300):
        own = RANDOM.integers(0, 1 << 16, 60)
        lists.append(np.concatenate([own[:30], line[: 12 + k % 12], own[30:]]).astype(np.uint16))
    lists[250] = np.concatenate([lists[7][:20], lists[250][20:40], lists[7][20:]]).astype(np.uint16)

    def pairs():
        columns = [pa.array(np.full(300, v)) for v in (5, 0, 0, 0)] + [pa.array(np.arange(300)), pa.array([x.tobytes() for x in lists], pa.binary())]
        batch = pa.RecordBatch.from_arrays(columns, names=["first", "low", "high", "block", "doc", "codes"])
        return {(r["doc"], r["pivot"]) for b in passages._pair_rows([batch]) for r in b.to_pylist()}

    def brute():
        for i in range(300):
            for j in range(i):
                here = np.isin(lists[i], lists[j])
                if sum(int((lists[j] == c).sum()) for c in lists[i]) >= passages.MIN_PAIRS and passages.alike(here[None])[0]:
                    yield i, j

    want = set(brute())
    assert (250, 7) in want and pairs() == want
    heavy, passages.HEAVY = passages.HEAVY, 0
    try:
        assert pairs() == want
    finally:
        passages.HEAVY = heavy
