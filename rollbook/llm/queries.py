"""One query for each operator, over its whole tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import align, language, minhash, mixing, passages, pii, quality, secrets, suffixes, tiling, tokens, trie, urls
from rollbook.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
ORACLE["op3_source_mix"] = rf"""
WITH base AS (
  SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size,
         -ln((CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 1) / 4503599627370496.0::DOUBLE)
         / greatest(1 / (1 + 20.0::DOUBLE * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{mixing.MARKS}', '')))
                             / greatest(length(coalesce(text, '')), 1)), 1e-6) AS k
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS n FROM base GROUP BY source
), weighted AS (
  SELECT *, 3.0::DOUBLE * source_size AS most, CASE n % 3 WHEN 1 THEN 5.0::DOUBLE WHEN 2 THEN 2.0 ELSE 1.0 END AS w FROM sizes
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER p, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER p, 0)) AS level
  FROM weighted WINDOW p AS (ORDER BY most / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), target AS (
  SELECT source, source_size, least(most, coalesce(max(CASE WHEN level <= most / w THEN level END) OVER () * w, most)) AS target FROM levels
), units AS (
  SELECT source, k, sum(size)::BIGINT AS words FROM base GROUP BY source, k
), upto AS (
  SELECT u.source, u.k, t.source_size, t.target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs,
         sum(words) OVER (PARTITION BY u.source ORDER BY u.k) - words / 2 AS upto
  FROM units u JOIN target t ON u.source IS NOT DISTINCT FROM t.source
)
SELECT b.doc_id, b.size, u.source_size, u.target,
       (b.size * (u.epochs + CASE WHEN u.upto <= u.target - u.epochs * u.source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM base b JOIN upto u ON b.source IS NOT DISTINCT FROM u.source AND b.k = u.k
"""


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs, secrets.train(secrets.labelled_tokens(docs))).drop("text")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


#: Fixed rules: (verdict, host, path).
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).drop("url")


ORACLE["op10_url_filter"] = f"""
WITH parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(verdict, h, p) AS (
  VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}
), fit AS (
  SELECT host, path, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path
)
SELECT page_id, parts.host, parts.path, fit.rule, coalesce(fit.verdict, CASE WHEN parts.host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fit ON parts.host = fit.host AND parts.path = fit.path
"""


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), tokens.PieceTokenizer("piece_bpe_32k.model"))


@query
def op9_benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = language.learn(docs.filter(~language.held_out("doc_id")))
    return language.predict(docs.select("doc_id", language.held_out("doc_id").alias("held_out"), "text"), network).drop("text")


@query
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(table(spark, sf_dir, "documents")).drop("kept")


@query
def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents").select("doc_id", "text"), "byte_bpe_50k.json", "piece_bpe_32k.model")[0]


#: Every conversation begins with the first turns of the one whose id is the next lower multiple of 100.
GRAFT = trie.Graft("conv_id - conv_id % 100", "crc32(string(conv_id)) % 6", 5)


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"), GRAFT)


_CRC = """xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT))),
  lambda c, x: list_reduce(list_concat([xor(c, x)], list_transform(range(8), lambda k: 0::UBIGINT)), lambda d, z: CASE WHEN d % 2 = 1 THEN xor(d >> 1, 3988292384::UBIGINT) ELSE d >> 1 END)),
  4294967295::UBIGINT)"""
ORACLE["op12_conversation_trie"] = f"""
WITH turns AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, length(coalesce(text, '')) AS n,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base, CAST({_CRC} % 6 AS BIGINT) AS h FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.d, t.n FROM conv c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.d, t.n FROM conv c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), paths AS (
  SELECT conv_id, row_number() OVER w AS depth, n, string_agg(d, '') OVER w AS path FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM conv
), sizes AS (
  SELECT conv_id, max(depth) AS size FROM paths GROUP BY conv_id
), nodes AS (
  SELECT path, min(p.conv_id) AS conv_id, any_value(depth) AS depth, any_value(n) AS n, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (depth = size), '')) AS ends_sha256
  FROM paths p JOIN sizes s ON p.conv_id = s.conv_id GROUP BY path
), counted AS (
  SELECT v.*, (SELECT count(*) FROM nodes w WHERE w.depth = v.depth + 1 AND v.path = substr(w.path, 1, 32 * v.depth::INT)) AS n_children FROM nodes v
), below AS (
  SELECT substr(path, 1, 32 * k::INT) AS path, sum((n_convs - 1) * n) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS k FROM counted) GROUP BY ALL
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM counted v JOIN below b ON v.path = b.path LEFT JOIN nodes p ON v.depth > 0 AND p.path = substr(v.path, 1, 32 * (v.depth - 1)::INT)
"""


@query
def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
