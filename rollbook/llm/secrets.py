"""Secret scans: fixed patterns, and random-looking strings by two character Markov models, in DataFrame functions only.

``train`` counts the character pairs of labelled tokens (random strings, ordinary identifiers) and returns the
logarithm of the ratio of both models' transition probabilities: at most one number per pair of the alphabet, so
the driver may hold it. ``scan`` scores every long token of every text by the sum of these numbers. Texts are
never shuffled, and each is scanned alone, so hot sources and copies do not matter.

Defined results: null and empty texts have no spans; rows that repeat give repeated results; without random
samples the models add nothing; an empty table gives an empty result. Input columns are passed on, those called like
a result column are replaced. Offsets count code points, the end is exclusive. Where kinds overlap, each is listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import text_of

# The patterns of known kinds and the least length of what they must hold.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
MIN_ASSIGN, MIN_ACCESS = 8, 16

KINDS = ("assign", "access", "hex", "random")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}"
#: Tokens of at least this length are scored.
MIN_TOKEN = 16
#: Least sum and least mean of the log ratios of a token that counts as random.
MIN_SUM, MIN_MEAN = 12.0, 0.4
#: Documents whose words are the samples of ordinary identifiers.
ORDINARY_DOCS = 1000
_BLOCK = 512
_OWN = ("_text", "_assign", "_access", "_hex", "_random", "_base", "_all")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda total, n: total + n)


def _found(text: Column, pattern: str, kind: int) -> Column:
    """Array of (start, kind, end, hit) of the leftmost non-overlapping matches, in linear time.

    What lies between the matches and the matches themselves alternate; starts are sums of their lengths, taken
    over whole blocks first.
    """

    def placed(s: Column) -> Column:
        def at(i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            start = _total(F.slice(s.blocks, 1, block)) + _total(F.slice(s.steps, block * _BLOCK + 1, i % _BLOCK)) + F.length(F.get(s.gaps, i))
            return _let(start, lambda b: F.struct(b.alias("start"), F.lit(kind).alias("kind"), (b + F.length(F.get(s.hits, i))).alias("end"), F.get(s.hits, i).alias("hit")))

        return F.transform(F.sequence(F.lit(0), F.size(s.hits) - 1), at)

    def blocks(s: Column) -> Column:
        last = F.floor((F.size(s.steps) - 1) / _BLOCK).cast("int")
        sums = F.transform(F.sequence(F.lit(0), last), lambda b: _total(F.slice(s.steps, b * _BLOCK + 1, F.lit(_BLOCK))))
        return _let(F.struct(s.gaps.alias("gaps"), s.hits.alias("hits"), s.steps.alias("steps"), sums.alias("blocks")), placed)

    def steps(s: Column) -> Column:
        lengths = F.zip_with(F.slice(s.gaps, F.lit(1), F.size(s.hits)), s.hits, lambda gap, hit: F.length(gap) + F.length(hit))
        return _let(F.struct(s.gaps.alias("gaps"), s.hits.alias("hits"), lengths.alias("steps")), blocks)

    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("hits"))
    none = F.lit(None).cast("array<struct<start:int,kind:int,end:int,hit:string>>")
    return F.coalesce(F.when(text.rlike(pattern), _let(both, steps)).otherwise(none), F.array().cast("array<struct<start:int,kind:int,end:int,hit:string>>"))


def _secret(hit: Column) -> Column:
    return F.regexp_extract(hit, ASSIGN, 2)


def _with_base(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds ``_text`` and one array of matches per fixed kind; matches that are too short are dropped."""
    docs = docs.withColumn("_text", text_of(text_col))
    docs = docs.withColumn("_assign", F.filter(_found(F.col("_text"), ASSIGN, 0), lambda m: F.length(_secret(m.hit)) >= MIN_ASSIGN))
    docs = docs.withColumn("_access", F.filter(_found(F.col("_text"), ACCESS, 1), lambda m: F.length(m.hit) >= MIN_ACCESS))
    return docs.withColumn("_hex", _found(F.col("_text"), HEX, 2))


def labelled_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ordinary_docs: int = ORDINARY_DOCS) -> DataFrame:
    """Samples (token, random) from the corpus itself: what the fixed patterns hold in all documents, and the
    other tokens of ``ordinary_docs`` documents, those with the smallest digests of their ids."""
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    bound = docs.select(digest.alias("d")).orderBy("d").limit(ordinary_docs).agg(F.max("d")).first()[0]
    based = _with_base(docs.select(F.col(text_col), digest.alias("_digest")), text_col)
    secrets = based.select(F.explode(F.concat(F.transform("_assign", lambda m: _secret(m.hit)), F.transform("_access", lambda m: m.hit), F.transform("_hex", lambda m: m.hit))).alias("token"))
    rest = text_of(text_col)
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    words = docs.filter(digest <= F.lit(bound)).select(F.explode(F.regexp_extract_all(rest, F.lit(TOKEN % 2), F.lit(0))).alias("token"))
    return secrets.withColumn("random", F.lit(True)).unionByName(words.withColumn("random", F.lit(False)))


def train(samples: DataFrame) -> list[float] | None:
    """Log ratios of the two models by (previous, next) character; the state before the first character and every
    character outside the alphabet is 0. Counts after a character are smoothed by how frequent each character is
    at all, so a rare one speaks against ordinary text. None if either label has no sample."""
    size = len(ALPHABET) + 1
    code = lambda c: F.instr(F.lit(ALPHABET), c)
    pairs = samples.select("random", F.split(F.concat(F.lit(" "), "token"), "").alias("c")).select(
        "random", F.explode(F.transform(F.sequence(F.lit(1), F.size("c") - 1), lambda i: code(F.get("c", i - 1)) * size + code(F.get("c", i)))).alias("pair")
    )
    counts = {(r.random, r.pair): r.n for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}
    if len({random for random, _ in counts}) < 2:
        return None
    from math import log

    def logs(random: bool) -> list[float]:
        every = [1 + sum(counts.get((random, a * size + b), 0) for a in range(size)) for b in range(size)]
        out = []
        for a in range(size):
            row = [counts.get((random, a * size + b), 0) + size * every[b] / sum(every) for b in range(size)]
            out += [log(n / sum(row)) for n in row]
        return out

    return [round(x - y, 4) for x, y in zip(logs(True), logs(False), strict=True)]


def log_ratio(token: Column, model: list[float]) -> Column:
    """The sum of the log ratios of a token's transitions."""
    size = len(ALPHABET) + 1
    ratios = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    code = lambda c: F.instr(F.lit(ALPHABET), c)
    states = F.transform(F.split(F.concat(F.lit(" "), token), ""), code)
    return _let(states, lambda c: F.aggregate(F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0), lambda total, i: total + F.get(ratios, F.get(c, i - 1) * size + F.get(c, i))))


def scan(docs: DataFrame, model: list[float] | None, text_col: str = "text", detail: bool = False) -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, n_random, base_sha256 and spans (``kind:start:end``, comma-joined).

    With ``detail`` also ``found``: the spans as an array of (start, kind, end).
    """
    result = ("n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans", "found")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in result and c not in _OWN]
    with_text = [] if text_col in [c for c in docs.columns if c not in result and c not in _OWN] else [F.col(text_col)]
    based = _with_base(docs.select(*kept, *with_text), text_col)
    based = based.withColumn("_base", F.concat("_assign", "_access", "_hex"))
    if model is None:
        random = F.array().cast("array<struct<start:int,kind:int,end:int,hit:string>>")
    else:
        tokens = _found(F.col("_text"), TOKEN % MIN_TOKEN, 3)

        def is_random(m: Column) -> Column:
            ratio = log_ratio(m.hit, model)
            free = ~F.exists("_base", lambda b: (b.start < m.end) & (m.start < b.end))
            return _let(ratio, lambda x: (x >= MIN_SUM) & (x >= MIN_MEAN * F.length(m.hit))) & free

        random = F.filter(tokens, is_random)
    bare = lambda spans: F.array_sort(F.transform(spans, lambda m: F.struct(m.start.alias("start"), m.kind.alias("kind"), m.end.alias("end"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda m: F.concat_ws(":", F.get(names, m.kind), m.start.cast("string"), m.end.cast("string"))))
    scanned = based.withColumn("_random", random).withColumn("_base", bare(F.col("_base"))).withColumn("_all", F.array_sort(F.concat("_base", bare(F.col("_random")))))
    return scanned.select(
        *kept, *[F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined(F.col("_base")), 256).alias("base_sha256"), joined(F.col("_all")).alias("spans"), *([F.col("_all").alias("found")] if detail else []),
    )


def redacted(docs: DataFrame, model: list[float] | None, text_col: str = "text", mark: str = "<secret>") -> DataFrame:
    """``docs`` with every span in its text replaced by ``mark``; overlapping spans become one."""

    def cut(done: Column, m: Column) -> Column:
        start = F.greatest(m.start, done.at)
        gap = F.substring(F.col(text_col), done.at + 1, start - done.at)
        return F.when(m.end <= done.at, done).otherwise(F.struct(m.end.alias("at"), F.concat(done.out, gap, F.when((m.start < done.at) & (done.at > 0), F.lit("")).otherwise(F.lit(mark))).alias("out")))

    scanned = scan(docs, model, text_col, detail=True)
    done = F.aggregate("found", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut, lambda s: F.concat(s.out, F.substring(F.col(text_col), s.at + 1, F.length(text_col))))
    return scanned.withColumn(text_col, F.when(F.size("found") > 0, done).otherwise(F.col(text_col))).select(*docs.columns)
