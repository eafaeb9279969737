r"""URL filters as a sort-merge range join: reversed hosts turn rules into intervals, and a sweep keeps the active ones.

A URL's host has one key per domain it lies in, the domain's labels reversed, followed by its path:
``blog.example.org/es/1`` has ``org/es/1``, ``org.example/es/1`` and ``org.example.blog/es/1``. The rule
``example.org/es/`` then is the interval of all keys that begin with ``org.example/es/``. Intervals of prefixes nest or
are disjoint, so that a sweep in key order needs a stack: rules are pushed where they begin and popped where they end.

Keys are cut into ranges at quantiles. A rule goes to every range that its interval meets (for each cut at
most the rules that nest around it), a key to its one range, and each range is swept on its own. Distinct (host, path)
are judged once, whatever number of pages has them; a host with a third of all pages spreads over ranges by its paths.

Defined results: a null URL, or one without ``://``, has an empty host and path and gets ``NO_HOST``; URLs that no
rule fits get ``DEFAULT``; of rules that fit, the longest wins (then the last in order); rows that repeat give
repeated results; an empty table gives an empty result. Input columns are passed on, those called like a result column
are replaced.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_HOST, DEFAULT = "block", "allow"
#: Keys for each range; the number of ranges follows from it, up to ``MAX_CUTS``.
KEYS_PER_RANGE, MAX_CUTS = 200_000, 2_000
_LAST = "\U0010ffff"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    # (?s): a line break is a character like any other
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: str) -> str:
    return ".".join(reversed(host.split(".")))


def _keys(host: Column, path: Column) -> Column:
    """Keys of a host's domains, each its reversed labels and then the path."""
    labels = F.reverse(F.split(host, r"\.", -1))
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), path))


def _cuts(keys: DataFrame) -> list[str]:
    """Keys that cut all keys into ranges of about ``KEYS_PER_RANGE``: the quantiles of a sample of bounded size."""
    n = keys.count()
    wanted = min(MAX_CUTS, n // KEYS_PER_RANGE)
    if wanted == 0:
        return []
    sample = keys.sample(min(1.0, 20 * wanted / n), seed=1).select("key").orderBy("key").collect()
    return sorted({sample[len(sample) * i // (wanted + 1)].key for i in range(1, wanted + 1)}) if sample else []


def sweep(events: Iterator[tuple]) -> Iterator[tuple]:
    """(host, path, level, rule) of keys for which a rule is active.

    ``events`` are (key, is_url, order, host, path), sorted; a rule has its text as host.
    """
    active: list[tuple[str, int, str]] = []
    for key, is_url, order, host, path in events:
        while active and not key.startswith(active[-1][0]):
            active.pop()
        if not is_url:
            active.append((key, order, host))
        elif active:
            # the last is the longest of this key; a key that is repeated as a rule keeps its last one on top
            yield host, path, len(active[-1][0]), active[-1][1], active[-1][2]


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (host and path of the rule that wins, else null) and verdict.

    ``rules`` are (verdict, host, path), the path with its leading slash.
    """
    spark = pages.sparkSession
    result = ("host", "path", "rule", "verdict")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in result]
    pages = pages.select(*kept, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    keys = pages.select("host", "path").distinct().select("host", "path", F.explode(_keys(F.col("host"), F.col("path"))).alias("key"))
    cuts = _cuts(keys)

    # Strings compare here by code point, as in Spark; a rule's last key is its prefix and the highest character.
    spans = []
    for order, (_, host, path) in enumerate(rules):
        first = reversed_host(host) + path
        spans += [(part, first, order, host + path) for part in range(bisect.bisect_right(cuts, first), bisect.bisect_right(cuts, first + _LAST) + 1)]
    starts = spark.createDataFrame(spans, "part int, key string, order int, host string")
    verdicts = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(rules)], "order int, rule_verdict string")

    part = _part_of(F.col("key"), cuts)
    events = keys.select(part.alias("part"), "key", F.lit(1).alias("is_url"), F.lit(0).alias("order"), "host", "path").unionByName(
        starts.select("part", "key", F.lit(0).alias("is_url"), "order", "host", F.lit("").alias("path"))
    )
    events = events.repartition(max(len(cuts) + 1, 1), "part").sortWithinPartitions("part", "key", "is_url", "order")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for batch in batches:
                yield from zip(batch.key, batch.is_url, batch.order, batch.host, batch.path, strict=True)

        out = []
        for found in sweep(rows()):
            out.append(found)
            if len(out) == 10_000:
                yield pd.DataFrame(out, columns=fields)
                out = []
        yield pd.DataFrame(out, columns=fields)

    fields = ["host", "path", "length", "order", "rule"]
    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("length", T.IntegerType()), T.StructField("order", T.IntegerType()), T.StructField("rule", T.StringType())])
    best = events.mapInPandas(run, schema).groupBy("host", "path").agg(F.max(F.struct("length", "order", "rule")).alias("best"))
    best = best.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("best.rule").alias("rule"), F.col("best.order").alias("_order"))
    best = best.join(verdicts, F.col("_order") == F.col("order")).drop("_order", "order")
    verdict = F.coalesce("rule_verdict", F.when(F.col("host") == "", F.lit(NO_HOST)).otherwise(F.lit(DEFAULT)))
    return pages.join(best, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left").select(
        *kept, "host", "path", "rule", verdict.alias("verdict")
    )


def _part_of(key: Column, cuts: list[str]) -> Column:
    """The number of cuts that are not above ``key``, by halving."""
    if not cuts:
        return F.lit(0)
    middle = len(cuts) // 2
    low, high = cuts[:middle], cuts[middle + 1 :]
    return F.when(key < cuts[middle], _part_of(key, low)).otherwise(F.lit(middle + 1) + _part_of(key, high))
