"""Saved listings: drop manifests (JSON), folder listings (XML), link pages (HTML)."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollbook.functions.text import bare_etag, is_directory, last_segment, long_or_zero, resolve_url, strip_whitespace

# Fields of a drop manifest, path prefix and element names of a folder listing.
LISTING_PREFIX = "/public.php/webdav/"
LISTING_SCHEMA = """
    `d:href` string,
    `d:propstat` array<struct<`d:prop`: struct<
        `d:getcontentlength`: string, `d:getlastmodified`: string, `d:getetag`: string>>>
"""
MANIFEST_SCHEMA = (
    "run_key string, files array<struct<name: string, path: string, is_dir: boolean, size: bigint, "
    "modified: string, etag: string>>"
)


def read_manifest(spark: SparkSession, path: str, one_document: bool = True) -> DataFrame:
    """One row per listed file; a manifest is one JSON document, or (ours) one record per line."""
    manifest = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", one_document).json(path)
    return manifest.select("run_key", F.explode("files").alias("file")).select("run_key", "file.*")


def write_manifest(files: DataFrame, run_key: str, path: str) -> None:
    """Manifest in line form, one record per file, so that no listing is gathered into one task."""
    record = F.struct("name", "path", "is_dir", "size", "modified", "etag")
    files.select(F.lit(run_key).alias("run_key"), F.array(record).alias("files")).write.mode("overwrite").json(path)


def read_listing(spark: SparkSession, path: str, prefix: str = LISTING_PREFIX) -> DataFrame:
    """Files and folders of a saved XML folder listing."""
    responses = (
        spark.read.format("xml").option("rowTag", "d:response").schema(LISTING_SCHEMA).load(path)
        .select(F.col("d:href").alias("href"), F.col("d:propstat").alias("propstat"))
    )
    rest = F.expr(f"substring(href, locate('{prefix}', href) + {len(prefix)})")
    rel = F.regexp_replace(rest, "^/+", "")
    prop = F.filter("propstat", lambda p: p["d:prop"].isNotNull())[0]["d:prop"]
    return (
        responses.filter(F.col("href").contains(prefix) & (rel != ""))
        .select(rel.alias("rel"), prop.alias("prop"))
        .filter(F.col("prop").isNotNull())
        .select(
            last_segment(F.col("rel")).alias("name"),
            F.regexp_replace("rel", "/+$", "").alias("path"),
            is_directory(F.col("rel")).alias("is_dir"),
            long_or_zero(F.col("prop")["d:getcontentlength"]).alias("size"),
            F.coalesce(F.col("prop")["d:getlastmodified"], F.lit("")).alias("modified"),
            bare_etag(F.col("prop")["d:getetag"]).alias("etag"),
        )
    )


def listing_hrefs(xml: Column, root: str = LISTING_PREFIX) -> Column:
    """Addresses in a listing's text, without the root folder itself."""
    hrefs = F.regexp_extract_all(xml, F.lit(r"<d:href>(.*?)</d:href>"), F.lit(1))
    bare = root.rstrip("/")
    return F.filter(
        F.transform(hrefs, lambda h: strip_whitespace(h)), lambda h: ~(h.endswith(bare + "/") | h.endswith(bare))
    )


# What a link looks like in a page, and the parts of a page that hold no links. A value may be in quotes of either
# kind, or in none.
NO_LINKS = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>=`][^\s>]*)"""
# Fixed value: what stands for characters in a page, by decimal or hexadecimal number or by name.
ENTITY = "(?s)^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);(.*)$"
_LAST_CHARACTER = 0x10FFFF


def _character(number: Column) -> Column:
    """The character of a number; the replacement character where there is none."""
    valid = (number > 0) & (number <= _LAST_CHARACTER) & ~number.between(0xD800, 0xDFFF)
    code = F.when(valid, number).otherwise(0xFFFD)
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _named_characters() -> Column:
    """All names that end in a semicolon, as a map that is made once for a plan."""
    names = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def decode_entities(text: Column) -> Column:
    """``text`` with its entities (``&amp;``, ``&#38;``, ``&#x26;``, any name with a semicolon) as characters; others stay."""
    names = _named_characters()

    def decoded(piece: Column) -> Column:
        what, rest = F.regexp_extract(piece, ENTITY, 1), F.regexp_extract(piece, ENTITY, 2)
        # Eight digits hold any character's number; a longer one is none.
        hexadecimal = F.regexp_extract(what, "^#[xX]0*([0-9a-fA-F]{1,8})$", 1)
        decimal = F.regexp_extract(what, "^#0*([0-9]{1,10})$", 1)
        number = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10).cast("bigint")).when(decimal != "", decimal.cast("bigint"))
        named = F.try_element_at(names, what)
        character = F.when(what == "", None).when(what.startswith("#"), _character(F.coalesce(number, F.lit(0).cast("bigint")))).otherwise(named)
        return F.coalesce(F.concat(character, rest), F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&", -1)
    more = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), decoded)
    return F.when(text.contains("&"), F.concat(F.element_at(pieces, 1), F.array_join(more, ""))).otherwise(text)


def page_hrefs(html: Column) -> Column:
    """Link targets of a page, without quotes, entities decoded."""
    body = F.regexp_replace(html, NO_LINKS, "")
    found = F.regexp_extract_all(body, F.lit(HREF), F.lit(1))
    quoted = "(?s)^([\"'])(.*)\\1$"
    return F.transform(found, lambda h: decode_entities(F.regexp_replace(h, quoted, "$2")))


def page_links(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per link: page, position on the page, absolute address."""
    return pages.select(key, url, F.posexplode(page_hrefs(F.col(html))).alias("position", "href")).select(
        key, "position", "href", resolve_url(F.col(url), F.col("href")).alias("link")
    )


def archive_links(links: DataFrame) -> DataFrame:
    """Links that point at a ZIP archive."""
    return links.filter(F.lower("href").contains(".zip"))
