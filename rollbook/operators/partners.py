"""Partners and tax regimes of companies from tables that are bucketed alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rollbook.operators.joins import SALTS, join_unique
from rollbook.operators.search import BASE_LENGTH, InvalidKey
from rollbook.sources.tables import save_bucketed

KEY = "cnpj_basico"
#: Buckets of both tables. A company's rows lie in the bucket of its key in either.
BUCKETS = 64
REGIME = ("opcao_pelo_simples", "data_opcao_simples", "data_exclusao_simples", "opcao_pelo_mei", "data_opcao_mei", "data_exclusao_mei")


def save_by_company(df: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """``df`` as a table of the session's catalog, bucketed and sorted by company."""
    return save_bucketed(df, table, path, [KEY], buckets)


def with_regime(partners: DataFrame, regimes: DataFrame, salted: bool = False) -> DataFrame:
    """Every partner with the tax regime of its company, where there is one.

    Of tables saved by :func:`save_by_company` neither side is shuffled, as a bucket of one meets the same bucket of the other. Where
    one company may have a large share of all partners, ``salted`` shuffles and deals them instead.
    """
    return join_unique(partners, regimes.select(KEY, *REGIME), KEY, "left", salts=SALTS if salted else 1)


def partners_of(partners: DataFrame, regimes: DataFrame, base_keys: Sequence[str]) -> DataFrame:
    """The partners of a few companies with their tax regime: only the buckets of these companies are read."""
    keys = sorted(set(base_keys))
    wrong = [k for k in keys if len(k) != BASE_LENGTH or not k.isdecimal()]
    if wrong or not keys:
        raise InvalidKey(f"a company has {BASE_LENGTH} digits: {wrong[:5]}")
    # both sides get the condition, and with it the list of buckets
    return with_regime(partners.filter(F.col(KEY).isin(keys)), regimes.filter(F.col(KEY).isin(keys)))
