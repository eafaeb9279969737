"""Quality rules, line first: lines that fail a rule are removed, then documents that lost too much text are rejected.

Before that the whole text is held against the base rules (too short, or too much repetition). Each document is judged
alone, in the task that reads it: nothing is shuffled, so neither a frequent line nor a hot source matters.

Defined results: null and empty texts have no words and are rejected; lines without a word are neither judged nor
counted; rows that repeat are judged alike; an empty table gives an empty result. Input columns are passed on, those
called like a result column are replaced.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rollbook.llm.common import map_texts

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A document stays if lines with at least this share of its words pass.
MIN_KEPT_SHARE = 0.5
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Fixed phrases of page furniture, lower case.
BOILERPLATE = re.compile(
    r"accept (all )?cookies|cookie policy|we use cookies|enable javascript|javascript is disabled|all rights reserved"
    r"|terms of (use|service)|privacy policy|click here|sign up for|subscribe to our|share on (facebook|twitter)"
    r"|back to top|skip to (main )?content|lorem ipsum"
)
CLOSERS = "\"'”’»)]}*_"
ENDS = (".", "!", "?", "…", ":", ";", "。", "！", "？")
SEPARATORS = re.compile(r" [|»›•>·/] |\t")

FIELDS = (
    ("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()), ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType()), ("kept", T.BooleanType()),
    ("n_lines_removed", T.LongType()), ("n_words_kept", T.LongType()),
)


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """How many words lie in a window of ``size`` words that the text has twice or more."""
    if len(words) <= size:
        return 0
    ids: dict[bytes, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    windows, width = at[: len(at) - size + 1], len(ids)
    for k in range(1, size):
        if width > 2**62 // len(ids):  # number the windows so far anew, so that the next product fits
            _, windows = np.unique(windows, return_inverse=True)
            width = len(at)
        windows, width = windows * len(ids) + at[k : len(at) - size + 1 + k], width * len(ids)
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(len(at), bool)
    for k in range(size):
        covered[k : len(at) - size + 1 + k] |= twice
    return int(covered.sum())


def line_fails(line: str, n_words: int) -> str | None:
    """The rule that a line with words fails: navigation, boilerplate, shouting, symbols or punctuation."""
    if len(SEPARATORS.findall(line)) >= 3 and n_words <= 5 * len(SEPARATORS.split(line)):
        return "navigation"
    if BOILERPLATE.search(line.lower()):
        return "boilerplate"
    if n_words >= 4 and (2 * line.count("!") > n_words or line.isupper()):
        return "shouting"
    if 10 * sum(map(line.count, SYMBOLS)) > len(line):
        return "symbols"
    if not line.rstrip().rstrip(CLOSERS).endswith(ENDS):
        return "punctuation"
    return None


def judge(text: str | None) -> tuple:
    """The values of ``FIELDS`` and the text without the lines that fail."""
    text = text or ""
    words = text.encode().split()  # of bytes: splits at the six ASCII white-space characters only
    seen: set[str] = set()
    dup_lines = removed = kept_words = 0
    lines = []
    for line in text.split("\n"):
        n = len(line.encode().split())
        if n:
            dup_lines += line in seen
            seen.add(line)
            if line_fails(line, n):
                removed += 1
                continue
            kept_words += n
        lines.append(line)
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    kept = not failed and kept_words >= MIN_KEPT_SHARE * len(words)
    return (
        len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup_lines, repeats,
        failed, kept, removed, kept_words, "\n".join(lines),
    )


def judged(docs: DataFrame, text_col: str = "text", cleaned: str | None = None) -> DataFrame:
    """``docs`` with the columns of ``FIELDS``, and with ``cleaned`` the text that is left in a column of that name."""
    if cleaned is None:
        return map_texts(docs, lambda text: judge(text)[:-1], FIELDS, text_col)
    return map_texts(docs, judge, [*FIELDS, (cleaned, T.StringType())], text_col)
