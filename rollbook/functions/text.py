"""Text cleaning, name and URL parts."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The characters that count as surrounding white space (Unicode white space plus the
# four ASCII separators), and the cell values the open-data files use for "no value".
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NULL_SENTINELS = ("00000000", "0001-01-01", "N/A", "NA", "000")


def strip_whitespace(c: Column) -> Column:
    """Trim every kind of Unicode white space (plain ``trim`` removes spaces only)."""
    return F.trim(c, F.lit(WHITESPACE))


def null_if_marker(stripped: Column, sentinels: tuple[str, ...] = NULL_SENTINELS) -> Column:
    """Null where the stripped text is empty or a "no value" marker.

    The comparison is exact and case-sensitive, so ``na`` stays. A set lookup on one literal keeps the
    generated code of wide tables small; markers must not contain a comma.
    """
    if not sentinels:
        return F.nullif(stripped, F.lit(""))
    return F.when(F.find_in_set(stripped, F.lit(",".join(sentinels) + ",")) == 0, stripped)


def clean_cell(c: Column, sentinels: tuple[str, ...] = NULL_SENTINELS) -> Column:
    """Stripped text, or null where nothing or only a "no value" marker is left."""
    return null_if_marker(strip_whitespace(c), sentinels)


def null_if_blank(c: Column) -> Column:
    """Null for null, empty or spaces-only text; otherwise the text trimmed of spaces."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def is_present(c: Column) -> Column:
    return null_if_blank(c).isNotNull()


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def zero_pad(c: Column, width: int) -> Column:
    """Left-pad with zeros up to ``width``; longer text is kept whole (``lpad`` would cut it)."""
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def like_pattern(text: str) -> str:
    """``%text%`` for a substring match in which ``%``, ``_`` and ``\\`` keep their LIKE meaning.

    A backslash before an ordinary character stands for that character; Spark rejects such a pair,
    so it is reduced here.
    """
    wrapped = f"%{text}%"
    return re.sub(r"\\(.)", lambda m: m.group(0) if m.group(1) in "%_\\" else m.group(1), wrapped, flags=re.S)


def contains_ci(c: Column, text: str) -> Column:
    return c.ilike(like_pattern(text))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]+$", 0)


def percent_decode(c: Column) -> Column:
    """Decode ``%xx`` escapes. ``+`` stays a plus and a stray ``%`` stays a percent sign."""
    guarded = F.regexp_replace(F.regexp_replace(c, r"\+", "%2B"), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(guarded)


def last_segment(path: Column) -> Column:
    """Decoded last component of a ``/``-separated path; a trailing slash is ignored."""
    return percent_decode(F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1))


def is_directory(path: Column) -> Column:
    return path.endswith("/")


# How a month is spelt in file names, and how a month folder is named.
MONTH_IN_NAME = r"(\d{4})[-_]?(\d{2})"
MONTH_FOLDER = r"^\d{4}-\d{2}$"


def month_in_name(name: Column) -> Column:
    """First ``YYYYMM`` / ``YYYY-MM`` / ``YYYY_MM`` in the name as ``YYYY-MM``, else null."""
    return F.when(
        name.rlike(MONTH_IN_NAME),
        F.concat_ws("-", F.regexp_extract(name, MONTH_IN_NAME, 1), F.regexp_extract(name, MONTH_IN_NAME, 2)),
    )


def is_month_folder(name: Column) -> Column:
    return name.rlike(MONTH_FOLDER)


def bare_etag(c: Column) -> Column:
    """Entity tag without its surrounding quotes; missing becomes empty."""
    return F.trim(F.coalesce(c, F.lit("")), F.lit('"'))


def long_or_zero(c: Column) -> Column:
    """Whole number, 0 where the text is missing or empty."""
    return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))


def clamp(c: Column, low: int, high: int) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)"


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _URL, 1))


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 2)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 3)


def share_token(url: Column) -> Column:
    """Last path component of a share link."""
    return F.element_at(F.split(F.regexp_replace(url_path(url), "/+$", ""), "/"), -1)


def dav_base(url: Column, prefix: str = "/public.php/webdav/") -> Column:
    """Listing address that belongs to a share link."""
    return F.concat(url_scheme(url), F.lit("://"), url_host(url), F.lit(prefix))


def _without_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` components of an absolute path."""
    segments = F.split(F.regexp_replace(path, "^/", ""), "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(path.rlike(r"(^|/)\.{1,2}$") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), tail)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute address of a link found on the page ``base``."""
    origin = F.concat(url_scheme(base), F.lit("://"), url_host(base))
    no_fragment = F.regexp_replace(base, "#.*$", "")
    no_query = F.regexp_replace(base, "[?#].*$", "")
    suffix = F.regexp_extract(href, "[?#].*$", 0)
    href_path = F.regexp_replace(href, "[?#].*$", "")
    folder = F.coalesce(F.nullif(F.regexp_replace(url_path(base), "[^/]*$", ""), F.lit("")), F.lit("/"))
    full = F.when(href_path.startswith("/"), href_path).otherwise(F.concat(folder, href_path))
    resolved = F.when(full.rlike(r"(^|/)\.{1,2}(/|$)"), _without_dot_segments(full)).otherwise(full)
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(url_scheme(base), F.lit(":"), href))
        .when(href == "", base)
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .otherwise(F.concat(origin, resolved, suffix))
    )
