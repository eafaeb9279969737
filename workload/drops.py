"""Drop listings, links, archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.functions import text as X
from rollbook.operators import drops as D
from rollbook.operators.ledger import outcome_counts
from rollbook.session import work_dir
from rollbook.sources import archives, listings
from workload import roles
from workload.catalog import query
from workload.oracle import sql
from workload.roles import table

_KEYWORDS = "(lower(name) LIKE '%empresas%' OR lower(name) LIKE '%socios%' OR lower(name) LIKE '%cnaes%')"
_PREFIXES = "(lower(name) LIKE 'empresas%' OR lower(name) LIKE 'socios%' OR lower(name) LIKE 'cnaes%')"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.files(table(spark, sf_dir, "documents"))


@query("wanted_files", sql("files", f"SELECT name, path, size FROM files WHERE NOT is_dir AND lower(name) LIKE '%.zip' "
                                    f"AND {_KEYWORDS}"))
def wanted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.wanted_files(_files(spark, sf_dir)).select("name", "path", "size")


@query("wanted_files_prefix", sql("files", f"SELECT name, path, size FROM files WHERE NOT is_dir AND lower(name) LIKE "
                                           f"'%.zip' AND {_PREFIXES}"))
def wanted_files_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.wanted_files(_files(spark, sf_dir), match="prefix").select("name", "path", "size")


@query("smallest_files", sql("files", "SELECT name, size FROM files WHERE NOT is_dir ORDER BY size, name LIMIT 7"))
def smallest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run takes the k smallest archives."""
    return D.smallest_files(_files(spark, sf_dir).filter("not is_dir"), 7).select("name", "size")


_OLD = "old_files AS (SELECT name, etag FROM files WHERE source <> 'src1')"
_NEW = (
    "new_files AS (SELECT name, CASE WHEN lang = 'es' THEN etag || '-2' ELSE etag END AS etag FROM files "
    "WHERE source <> 'src2')"
)


@query(
    "manifest_diff",
    sql("files", "") + f", {_OLD}, {_NEW} SELECT COALESCE(o.name, n.name) AS name, CASE WHEN o.name IS NULL THEN 'added' "
    "WHEN n.name IS NULL THEN 'removed' ELSE 'changed' END AS change, o.etag AS old_etag, n.etag AS new_etag "
    "FROM old_files o FULL JOIN new_files n ON o.name = n.name WHERE o.etag IS DISTINCT FROM n.etag",
)
def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.manifest_diff(*roles.listings(table(spark, sf_dir, "documents")))


_MONTH = "'20' || lpad(CAST(doc_id % 97 AS VARCHAR), 2, '0') || '-01'"
_NAME = "'f' || CAST(doc_id AS VARCHAR) || '.zip'"


def _month_files(docs: DataFrame, etag: str) -> DataFrame:
    return docs.select(
        F.format_string("20%02d-01", F.col("doc_id") % 97).alias("run_key"),
        F.format_string("f%d.zip", "doc_id").alias("name"), F.expr(etag).alias("etag"),
    )


_RUN_STATUS = "CASE doc_id % 97 % 4 WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'DEAD' END"
_NEW_TAG = "md5(concat(text, CASE WHEN doc_id % 97 % 7 = 0 THEN 'x' ELSE '' END))"


@query(
    "load_decisions",
    f"WITH old AS (SELECT {_MONTH} AS run_key, {_NAME} AS name, md5(text) AS etag FROM documents WHERE doc_id % 97 % 5 <> 0), "
    f"new AS (SELECT {_MONTH} AS run_key, {_NAME} AS name, {_NEW_TAG} AS etag FROM documents WHERE doc_id % 97 % 11 <> 1 "
    f"OR doc_id % 2 = 0), runs AS (SELECT DISTINCT {_MONTH} AS run_key, {_RUN_STATUS} AS status FROM documents WHERE "
    "doc_id % 97 % 4 <> 3), counted AS (SELECT run_key, count(new.name) AS files, count(*) FILTER (old.name IS NULL OR "
    "new.name IS NULL OR old.etag <> new.etag) AS changes FROM old FULL JOIN new USING (run_key, name) GROUP BY 1) "
    "SELECT run_key, files, changes, CASE WHEN status = 'SUCCESS' THEN 'done' WHEN changes > 0 OR status IS NULL THEN 'load' "
    "WHEN status = 'FAILED' THEN 'resume' ELSE 'unchanged' END AS decision FROM counted LEFT JOIN runs USING (run_key) "
    "WHERE files > 0",
)
def load_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a listing asks to be done, for every month in it."""
    docs = table(spark, sf_dir, "documents")
    old = _month_files(docs.filter("doc_id % 97 % 5 <> 0"), "md5(text)")
    new = _month_files(docs.filter("doc_id % 97 % 11 <> 1 or doc_id % 2 = 0"), _NEW_TAG)
    runs = docs.filter("doc_id % 97 % 4 <> 3").select(
        F.format_string("20%02d-01", F.col("doc_id") % 97).alias("run_key"), F.expr(_RUN_STATUS).alias("status")
    )
    return D.load_decisions(old, new, runs.distinct())


@query(
    "manifest_check",
    f"SELECT name, CASE WHEN f IS NULL THEN 'missing' WHEN e IS NULL THEN 'extra' ELSE 'size differs' END AS problem, "
    f"coalesce(listed_size, -1) AS listed_size, coalesce(found_size, -1) AS found_size FROM (SELECT {_NAME} AS name, n_chars AS listed_size, 1 AS e FROM documents WHERE doc_id % 7 <> 0) "
    f"FULL JOIN (SELECT {_NAME} AS name, n_chars + CASE WHEN lang = 'de' THEN 1 ELSE 0 END AS found_size, 1 AS f "
    "FROM documents WHERE doc_id % 5 <> 0) USING (name) WHERE e IS NULL OR f IS NULL OR listed_size <> found_size",
)
def manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files found against files listed."""
    name = F.format_string("f%d.zip", "doc_id").alias("name")
    docs = table(spark, sf_dir, "documents")
    listed = docs.filter("doc_id % 7 <> 0").select(name, F.col("n_chars").alias("size"))
    found = docs.filter("doc_id % 5 <> 0").select(name, F.expr("n_chars + CASE WHEN lang = 'de' THEN 1 ELSE 0 END").alias("size"))
    return D.manifest_check(listed, found).fillna(-1, ["listed_size", "found_size"])


@query(
    "manifest_roundtrip",
    sql("files", "SELECT '2026-03' AS run_key, name, path, is_dir, size, modified, etag FROM files"),
)
def manifest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "manifest")
    listings.write_manifest(_files(spark, sf_dir), "2026-03", path)
    return listings.read_manifest(spark, path, one_document=False)


def _month_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "'base_'yyyy-MM'.zip'"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "'Base'yyyyMMdd'.zip'"))
        .otherwise(F.date_format("o_orderdate", "'v1 'yyyy_MM"))
    )
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") == "5-LOW", "latest.zip").otherwise(pattern).alias("name"),
        F.date_format("o_orderdate", "yyyy-MM").alias("folder"),
    )


@query("months", "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders WHERE o_orderpriority <> '5-LOW'")
def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.months(_month_names(spark, sf_dir))


@query("latest_month", "SELECT max(strftime(o_orderdate, '%Y-%m')) AS run_key FROM orders WHERE o_orderpriority <> '5-LOW'")
def latest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.latest_month(_month_names(spark, sf_dir))


@query(
    "latest_month_folder",
    "SELECT max(strftime(o_orderdate, '%Y-%m')) AS run_key FROM orders WHERE o_orderstatus = 'F'",
)
def latest_month_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only names that are exactly a month count."""
    folders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM'x'")).alias("name")
    )
    return D.latest_month_folder(folders)


_ORIGIN = "regexp_extract(url, '^[a-z]+://[^/?#]*')"
_LINKS = (
    "WITH hrefs AS (SELECT page_id, url, regexp_extract_all(regexp_replace(html, "
    "'(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g'), "
    "'(?is)<a\\s(?:[^>]*?\\s)?href\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1) AS found FROM pages), "
    "links AS (SELECT page_id, url, unnest(found) AS href, unnest(range(len(found))) AS position FROM hrefs) "
)


@query(
    "link_extract",
    _LINKS + "SELECT page_id, CAST(position AS INTEGER) AS position, replace(href, '&amp;', '&') AS href, "
    f"CASE WHEN href LIKE '/%' THEN {_ORIGIN} || replace(href, '&amp;', '&') ELSE href END AS link FROM links",
)
def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.page_links(table(spark, sf_dir, "pages"))


@query(
    "link_entities",
    "SELECT page_id, k AS position, url AS href FROM pages, (SELECT unnest(range(2)) AS k) WHERE url IS NOT NULL AND NOT regexp_matches(url, '[\\s\"''<>`=]') AND url <> ''",
)
def link_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses written with entities of every kind, in quotes and without: each comes back as it was."""
    url = F.col("url")
    written = F.replace(F.replace(url, F.lit("&"), F.lit("&amp;")), F.lit("/"), F.lit("&#47;"))
    written = F.replace(F.replace(F.replace(written, F.lit(":"), F.lit("&colon;")), F.lit("."), F.lit("&#x2E;")), F.lit("?"), F.lit("&quest;"))
    pages = table(spark, sf_dir, "pages").filter(url.isNotNull() & ~url.rlike("[\\s\"'<>`=]") & (url != ""))
    html = F.concat(F.lit("<p><a class=x href="), written, F.lit(" id=y>a</a> <a href='"), written, F.lit("'>b</a>"))
    links = listings.page_links(pages.select("page_id", "url", html.alias("html")))
    return links.select("page_id", F.col("position").cast("bigint").alias("position"), "href")


@query("archive_links", _LINKS + "SELECT count(*) AS links, count(*) FILTER (lower(href) LIKE '%.zip%') AS archives FROM links")
def archive_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = listings.page_links(table(spark, sf_dir, "pages"))
    found = listings.archive_links(links).select("page_id", "position", F.lit(1).alias("hit"))
    return links.join(found, ["page_id", "position"], "left").agg(
        F.count("*").alias("links"), F.count("hit").alias("archives")
    )


_PATH = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"


@query(
    "url_parts",
    "SELECT page_id, regexp_extract(url, '^([a-z]+):', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, "
    f"{_PATH} AS path, regexp_extract(rtrim({_PATH}, '/'), '[^/]*$') AS token, "
    f"regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/public.php/webdav/' AS base, {_PATH} LIKE '%/' AS is_dir FROM pages",
)
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", X.url_scheme(url).alias("scheme"), X.url_host(url).alias("host"), X.url_path(url).alias("path"),
        X.share_token(url).alias("token"), X.dav_base(url).alias("base"), X.is_directory(X.url_path(url)).alias("is_dir"),
    )


@query(
    "url_and_defaults",
    "SELECT doc_id, source || ' 100% + ' || lang || '.zip' AS name, CASE WHEN lang = 'en' THEN 0 ELSE n_chars END AS size, "
    "CASE WHEN lang = 'fr' THEN '' ELSE md5(text) END AS etag, least(greatest(n_chars, 100), 1000) AS clamped FROM documents",
)
def url_and_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Escaped names, quoted tags, sizes that are missing."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars",
        F.concat(F.lit("a/b%2Fc/"), "source", F.lit("%20100%25%20+%20"), "lang", F.lit(".zip/")).alias("path"),
        F.when(F.col("lang") != "en", F.col("n_chars").cast("string")).alias("size"),
        F.when(F.col("lang") != "fr", F.concat(F.lit('"'), F.md5("text"), F.lit('"'))).alias("etag"),
    )
    return docs.select(
        "doc_id", X.last_segment(F.col("path")).alias("name"), X.long_or_zero(F.col("size")).alias("size"),
        X.bare_etag(F.col("etag")).alias("etag"), X.clamp(F.col("n_chars"), 100, 1000).alias("clamped"),
    )


@query(
    "listing_xml",
    sql("files", "SELECT CASE WHEN is_dir THEN source ELSE name END AS name, '2026-03/' || CASE WHEN is_dir THEN source "
                 "ELSE name END AS path, is_dir, CASE WHEN is_dir THEN 0 ELSE size END AS size, "
                 "'Sun, 01 Mar 2026 00:00:00 GMT' AS modified, etag FROM files"),
)
def listing_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved folder listing, one answer per file or folder."""
    path = work_dir(spark, "listing")
    leaf = F.when(F.col("is_dir"), F.concat("source", F.lit("/"))).otherwise(F.col("name"))
    size = F.when(F.col("is_dir"), "").otherwise(
        F.concat(F.lit("<d:getcontentlength>"), F.col("size").cast("string"), F.lit("</d:getcontentlength>"))
    )
    answer = F.concat(
        F.lit("<d:response><d:href>/public.php/webdav/2026-03/"), leaf, F.lit("</d:href><d:propstat><d:prop>"), size,
        F.lit("<d:getlastmodified>Sun, 01 Mar 2026 00:00:00 GMT</d:getlastmodified><d:getetag>&quot;"), "etag",
        F.lit("&quot;</d:getetag></d:prop><d:status>HTTP/1.1 200 OK</d:status></d:propstat></d:response>"),
    )
    def enclose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One listing document per part file."""
        yield pd.DataFrame({"value": ['<?xml version="1.0"?><d:multistatus xmlns:d="DAV:">']})
        yield from batches
        yield pd.DataFrame({"value": ["</d:multistatus>"]})

    answers = _files(spark, sf_dir).select(answer.alias("value")).mapInPandas(enclose, "value string")
    answers.write.mode("overwrite").text(path)
    return listings.read_listing(spark, path)


@query("listing_hrefs", "SELECT doc_id, '/public.php/webdav/' || source AS href FROM documents")
def listing_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses cut out of listing text; the root folder is not one of them."""
    text = F.concat(
        F.lit("<d:href>/public.php/webdav/</d:href>\n<d:href> /public.php/webdav/"), "source", F.lit("</d:href>")
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("xml"))
    return docs.select("doc_id", F.explode(listings.listing_hrefs(F.col("xml"))).alias("href"))


@query("text_checksum", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def text_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


_ZIP = "CAST(doc_id AS VARCHAR) || '.zip'"


@query(
    "archive_members",
    f"SELECT 'drop/' || {_ZIP} AS path, 'text.csv' AS member, strlen(text) AS size, sha256(text) AS sha256 FROM documents UNION ALL "
    f"SELECT 'drop/' || {_ZIP}, 'lang.csv', strlen(lang), sha256(lang) FROM documents",
)
def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members listed by archive, under their flat names; folders are left out, and of equal names in an archive the first is taken."""
    path = F.concat(F.lit("drop/"), F.col("doc_id").cast("string"), F.lit(".zip"))
    entries = [("inner/", F.lit("")), ("inner/text.csv", F.col("text")), ("lang.csv", F.col("lang")), ("later/lang.csv", F.col("text"))]
    rows = F.array(*[
        F.struct(F.lit(k).alias("position"), F.lit(m).alias("member"), F.octet_length(c).cast("bigint").alias("size"), F.sha2(c, 256).alias("sha256"))
        for k, (m, c) in enumerate(entries)
    ])
    listed = table(spark, sf_dir, "documents").select(path.alias("archive"), F.explode(rows).alias("e")).select("archive", "e.*")
    flat = archives.flat_members(listed)
    first = archives.first_of_name(flat.select(F.concat_ws("|", "archive", "name").alias("name"), F.col("archive").alias("path"), "position", "size"))
    return flat.join(first.select(F.col("path").alias("archive"), "position"), ["archive", "position"]).select(
        F.col("archive").alias("path"), F.col("name").alias("member"), "size", "sha256"
    )


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files found against a listing: those of one language are cut short, those of one source are empty, one source is not expected."""
    docs = table(spark, sf_dir, "documents")
    name, size = F.concat(F.col("doc_id").cast("string"), F.lit(".zip")).alias("name"), F.octet_length("text").cast("bigint")
    content = F.when(F.col("source") == "src3", "").when(F.col("lang") == "es", F.expr("substring(text, 2)")).when(F.col("lang") == "de", F.reverse("text")).otherwise(F.col("text"))
    found = docs.select(name, content.alias("content")).select("name", F.octet_length("content").cast("bigint").alias("size"), F.sha2("content", 256).alias("sha256"))
    listed = docs.filter("source <> 'src6'").select(name, size.alias("size"), F.sha2("text", 256).alias("sha256"))
    missing = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("missing"), F.col("item_id").cast("string"), F.lit(".zip")).alias("name"), F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("string").alias("sha256"))
    return archives.check_found(listed.unionByName(missing), found)


_CHECK = (
    f"WITH checked AS (SELECT {_ZIP} AS name, CASE WHEN source = 'src3' OR strlen(text) = 0 THEN 'no bytes' WHEN lang = 'es' AND strlen(substr(text, 2)) = 0 THEN 'no bytes' "
    "WHEN lang = 'es' THEN 'size differs' WHEN lang = 'de' AND reverse(text) <> text THEN 'checksum differs' END AS error FROM documents WHERE source <> 'src6' UNION ALL "
    "SELECT 'missing' || CAST(item_id AS VARCHAR) || '.zip', 'absent' FROM benchmark) "
)


def _zipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archive per document: its text in a folder, its language and a folder entry."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            contents = []
            for text, lang in zip(batch["text"], batch["lang"]):
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("inner/", b"")
                    archive.writestr("inner/text.csv", (text or "").encode())
                    archive.writestr("lang.csv", (lang or "").encode())
                contents.append(buffer.getvalue())
            yield pd.DataFrame({"path": batch["path"], "lang": batch["lang"], "source": batch["source"], "content": contents})

    path = F.concat(F.col("doc_id").cast("string"), F.lit(".zip")).alias("path")
    return table(spark, sf_dir, "documents").select(path, "text", "lang", "source").mapInPandas(pack, "path string, lang string, source string, content binary")


@query(
    "archive_check",
    f"WITH checked AS (SELECT {_ZIP} AS name, CASE WHEN source = 'src3' THEN 'no bytes' WHEN lang = 'es' THEN 'not readable' END AS error FROM documents "
    "WHERE source <> 'src6' UNION ALL SELECT 'missing' || CAST(item_id AS VARCHAR) || '.zip', 'absent' FROM benchmark) SELECT name, error IS NULL AS ok, error FROM checked",
)
def archive_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every archive is opened and its members read to the end: those of one language are cut short, those of one source are empty, and some are absent."""
    cut = F.when(F.col("source") == "src3", F.lit(b"")).when(F.col("lang") == "es", F.expr("substring(content, 1, length(content) - 30)"))
    read = archives.read_contents(_zipped(spark, sf_dir).select("path", cut.otherwise(F.col("content")).alias("content")))
    docs = table(spark, sf_dir, "documents").filter("source <> 'src6'").select(F.concat(F.col("doc_id").cast("string"), F.lit(".zip")).alias("name"))
    missing = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("missing"), F.col("item_id").cast("string"), F.lit(".zip")).alias("name"))
    found = read.select(F.col("path").alias("name"), "problem", F.lit(True).alias("there"))
    checked = docs.unionByName(missing).join(found, "name", "left")
    error = F.when(F.col("there").isNull(), archives.ABSENT).otherwise(F.col("problem"))
    return checked.select("name", error.isNull().alias("ok"), error.alias("error"))


@query("archive_outcomes", _CHECK + "SELECT count(*) FILTER (error IS NULL) AS ok, count(*) FILTER (error IS NOT NULL) AS "
                                    "failed FROM checked")
def archive_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_counts(_checked(spark, sf_dir).select(F.col("problem").isNull().alias("ok")), "ok")
