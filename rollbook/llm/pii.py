r"""Personal data, disguised or not, by transducers that keep offsets.

Plain identifiers are found by fixed patterns. For disguised ones a text goes through three transducers, each a rule that rewrites parts
of its input and remembers where they came from:

* *characters*: look-alikes of other scripts, full-width and styled letters, digits of any script, dashes and spaces become
  ASCII; invisible characters go;
* *spelled digits*: four or more digit words in a row (English, Spanish, French, German), with "double", "plus" and "dot" among them;
* *at and dot*: ``(at)``, ``[dot]``, ``john at example dot com``, ``10[.]0[.]0[.]1``, and spaces around an ``@``.

The patterns then run over the normalised text, and what they find is mapped back through the rewrites to the characters of the source. A
span counts as disguised if it covers a rewritten part, if no letter or digit touches it, and if an address ends in
letters. A bare "at" is one only before a domain whose dots are disguised too, so "look at example.com" stays as it is.

Texts stay where they are read: one pass without a shuffle, every text by itself. All scans are linear in the text.

Defined results: null counts as the empty text, without spans; rows that repeat give repeated results; an empty table gives an empty
result. Input columns are passed on, those called like a result column are replaced.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.common import map_texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")

# ---- plain identifiers ----

#: Fixed patterns. An address is looked for at its "@"; of numbers with dots, four parts each make an address.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGITS = str.maketrans("", "", " ().-+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        parts, start = run[0].split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = len(".".join(four))
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, start + size
            start += size + 1


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        digits = found[0].translate(_NO_DIGITS)
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 8 <= len(found[0].translate(_NO_DIGITS)) <= 15:
            yield found.span()


FINDERS = (emails, addresses, cards, phones)


def plain(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all plain identifiers, by kind and start."""
    return [(kind, *span) for kind, find in enumerate(FINDERS) for span in find(text)]


# ---- transducers ----


class Rewrite:
    """A text with some parts replaced: (start, end, replacement), in order and apart."""

    def __init__(self, text: str, edits: Iterable[tuple[int, int, str]]):
        out, self.at, self.source, self.copied, size, last = [], [], [], [], 0, 0
        for start, end, new in edits:
            for piece, source, copied in ((text[last:start], (last, start), True), (new, (start, end), False)):
                if piece:
                    self.at.append(size)
                    self.source.append(source)
                    self.copied.append(copied)
                    out.append(piece)
                    size += len(piece)
            last = end
        if last < len(text):
            self.at.append(size)
            self.source.append((last, len(text)))
            self.copied.append(True)
            out.append(text[last:])
        self.text = "".join(out)

    def _place(self, k: int) -> int:
        return bisect.bisect_right(self.at, k) - 1

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """A span of the new text in the old one, and whether it covers a rewritten part."""
        i, j = self._place(start), self._place(end - 1)
        first = self.source[i][0] + (start - self.at[i] if self.copied[i] else 0)
        last = self.source[j][0] + end - self.at[j] if self.copied[j] else self.source[j][1]
        return first, last, i != j or not self.copied[i]


#: Letters of other scripts that look like Latin ones, and the Latin ones.
_ALIKE = str.maketrans(
    "АВЕЅІЈКМНОРСТУХаеѕіјорсухԁԛԝһɡɩѵ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοντ" "օսոհ",
    "ABESIJKMHOPCTYXaesijopcyxdqwhgiv" "ABEZHIKMNOPTYXovt" "ounh",
)
_DOTS = "。｡․"


def _folded(c: str) -> str | None:
    """The ASCII character that ``c`` stands for; "" for an invisible one, None for one that stands for itself."""
    if ord(c) in _ALIKE:
        return chr(_ALIKE[ord(c)])
    category, digit = unicodedata.category(c), unicodedata.decimal(c, None)
    if c in _DOTS:
        return "."
    if digit is not None:
        return str(digit)
    if category in ("Cf",) or "︀" <= c <= "️" or c == "͏":
        return ""
    if category == "Zs":
        return " "
    if category == "Pd" or c == "−":
        return "-"
    new = unicodedata.normalize("NFKC", c)
    return new if len(new) == 1 and new.isascii() and new.isprintable() else None


_FOLDED = {k: new for k in range(0x80, 0x20000) if (new := _folded(chr(k))) is not None}
_FOLDS = str.maketrans({k: new for k, new in _FOLDED.items() if new})
_GONE = re.compile("[" + "".join(map(chr, (k for k, new in _FOLDED.items() if not new))) + "]+")
_ODD = frozenset(map(chr, _FOLDED))

#: Digits spelled in four languages.
_SPELLED = {
    word: str(k)
    for words in (
        "zero one two three four five six seven eight nine", "cero uno dos tres cuatro cinco seis siete ocho nueve",
        "zéro un deux trois quatre cinq six sept huit neuf", "null eins zwei drei vier fünf sechs sieben acht neun",
    )
    for k, word in enumerate(words.split())
}
_WORD = "(?:" + "|".join(sorted(_SPELLED, key=len, reverse=True)) + ")"
_GAP = r"(?:[,;]?\x20|-)"
#: Four spelled digits in a row at least; dots and single numbers may stand between them.
_RUN = re.compile(
    rf"(?<!\w)(?:plus{_GAP}|\+\x20?)?(?:(?:[0-9]+{_GAP})?(?:(?:double|triple){_GAP})?{_WORD}(?:{_GAP}(?:dot|point|punto|punkt))?{_GAP}){{3,}}(?:[0-9]+{_GAP})*(?:(?:double|triple){_GAP})?{_WORD}(?!\w)", re.I
)
_PAIR = re.compile(rf"{_WORD}{_GAP}(?:[0-9]+{_GAP}|(?:double|triple|dot|point|punto|punkt){_GAP})*{_WORD}")
_ITEM = re.compile(rf"(?:(double|triple){_GAP})?({_WORD})(?!\w)|(plus|\+)|(dot|point|punto|punkt)|([0-9]+)|{_GAP}", re.I)

_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_DOT = rf"(?:\x20?{_OPEN}\x20?(?:dot|punto|punkt|point|\.)\x20?{_CLOSE}\x20?|\x20(?:dot|punto|punkt|point)\x20)"
_AT = re.compile(rf"\x20?{_OPEN}\x20?(?:at|arroba|arobase|chez|@)\x20?{_CLOSE}\x20?|\x20(?:at|arroba|arobase)\x20|\x20?@\x20?", re.I)
_BARE = re.compile(r"\x20(?:at|arroba|arobase)\x20", re.I)
_DOT_AT_END = re.compile(_DOT + r"\Z", re.I)
_LONGEST_DOT = len(" ( punto ) ")
_LABEL = "[A-Za-z0-9-]+"
_ANY_DOMAIN = re.compile(rf"{_LABEL}(?:(?:\.|{_DOT}){_LABEL})+", re.I)
_HIDDEN_DOMAIN = re.compile(rf"{_LABEL}(?:{_DOT}{_LABEL})+", re.I)
_DOT_IN = re.compile(_DOT, re.I)
_NUMBERS = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:(?:\.|{_DOT})[0-9]{{1,3}}){{3}}(?![0-9])", re.I)
_TOP = re.compile(r"[A-Za-z]{2,}")


def characters(text: str) -> tuple[str, Rewrite]:
    """Characters become ASCII one by one; then invisible ones go."""
    folded = text.translate(_FOLDS)
    return folded, Rewrite(folded, ((m.start(), m.end(), "") for m in _GONE.finditer(folded)))


def _may_spell(text: str) -> bool:
    """Whether two digit words are neighbours: a cheap test that most texts fail."""
    lower = text.lower()
    words = lower.replace("-", " ").replace(",", " ").replace(";", " ").split()
    return sum(map(_SPELLED.__contains__, words)) > 1 and _PAIR.search(lower) is not None


def spelled_digits(text: str) -> Iterator[tuple[int, int, str]]:
    if not _may_spell(text):
        return
    for run in _RUN.finditer(text):
        for item in _ITEM.finditer(text, run.start(), run.end()):
            many, word, plus, dot, number = item.groups()
            if word:
                yield item.start(), item.end(), _SPELLED[word.lower()] * {None: 1, "double": 2, "triple": 3}[many and many.lower()]
            elif not number and item[0]:
                yield item.start(), item.end(), "+" if plus else "." if dot else ""


def _back_over_local(text: str, at: int, floor: int) -> tuple[int, list[tuple[int, int]]]:
    """(start, disguised dots) of the local part that ends at ``at``."""
    dots, start = [], at
    while True:
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        dot = _DOT_AT_END.search(text, max(floor, start - _LONGEST_DOT), start)
        if not dot or start == at or dot.start() <= floor or text[dot.start() - 1] not in _LOCAL:
            return start, dots[::-1]
        dots.append(dot.span())
        start = dot.start()


def _may_hide(text: str) -> bool:
    """Whether there is an "@", a bracket before an "at", or a disguised dot at all."""
    lower = text.lower()
    return "@" in lower or any(f"{b}{gap}{word}" in lower for b in "[({<" for gap in ("", " ") for word in ("at", "ar", "ch", ".")) or any(w in lower for w in ("dot", "punto", "punkt", "point"))


def at_and_dot(text: str) -> Iterator[tuple[int, int, str]]:
    if not _may_hide(text):
        return
    found, end = [], 0
    for at in _AT.finditer(text):
        if at.start() < end or at[0] == "@":
            domain = _DOMAIN.match(text, at.end()) if at[0] == "@" else None
            rest = _ANY_DOMAIN.match(text, at.end()) if at[0] == "@" and not domain else None
            if not rest or at.start() < end:
                continue
            domain = rest
        else:
            domain = (_HIDDEN_DOMAIN if _BARE.fullmatch(at[0]) else _ANY_DOMAIN).match(text, at.end())
        if not domain:
            continue
        start, dots = _back_over_local(text, at.start(), end)
        if start == at.start():
            continue
        end = domain.end()
        found += [(*d, ".") for d in dots]
        found.append((at.start(), at.end(), "@"))
        found += [(*m.span(), ".") for m in _DOT_IN.finditer(text, domain.start(), domain.end())]
    numbers = [(*m.span(), ".") for run in _NUMBERS.finditer(text) for m in _DOT_IN.finditer(text, run.start(), run.end())]
    end = 0
    for edit in sorted({*found, *numbers}):
        if edit[0] >= end:
            end = edit[1]
            yield edit


def disguised(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of identifiers that show only after normalisation, in places of ``text``."""
    steps, now = [], text
    odd = not text.isascii() and not _ODD.isdisjoint(set(text))
    if odd:
        now, gone = characters(text)
        if gone.text != now:
            steps.append(gone)
            now = gone.text
    for rule in (spelled_digits, at_and_dot):
        edits = list(rule(now))
        if edits:
            steps.append(Rewrite(now, edits))
            now = steps[-1].text
    if not steps and not odd:
        return []
    out = []
    for kind, start, end in plain(now):
        if (start and now[start - 1].isalnum()) or (end < len(now) and now[end].isalnum()):
            continue
        if kind == 0 and not _TOP.fullmatch(now, now.rindex(".", start, end) + 1, end):
            continue
        first, last, changed = start, end, False
        for step in reversed(steps):
            first, last, here = step.back(first, last)
            changed = changed or here
        if changed or text[first:last] != now[start:end]:
            out.append((kind, first, last))
    return out


def spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(plain identifiers, disguised ones that no plain one of their kind covers)."""
    base, more = plain(text), []
    found = disguised(text)
    for kind in {k for k, *_ in found}:
        own = [s[1:] for s in base if s[0] == kind]
        starts = [s for s, _ in own]
        for _, start, end in sorted({s for s in found if s[0] == kind}):
            k = bisect.bisect_right(starts, start) - 1
            if k < 0 or own[k][1] < end:
                more.append((kind, start, end))
    return base, more


# ---- tables ----


def _written(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(found))


def judge(text: str | None) -> tuple:
    base, more = spans(text or "")
    counts = [sum(k == kind for k, *_ in base) for kind in range(len(KINDS))]
    return (*counts, hashlib.sha256(_written(base).encode()).hexdigest(), _written([*base, *more]), len(more))


def masked(text: str | None) -> str | None:
    """``text`` with every identifier, disguised or not, replaced by its kind; of those that overlap, by the first one's."""
    if text is None:
        return None
    out, last = [], 0
    base, more = spans(text)
    for start, end, kind in sorted((a, b, k) for k, a, b in [*base, *more]):
        if start >= last:
            out += [text[last:start], f"<{KINDS[kind]}>"]
        last = max(last, end)
    return "".join([*out, text[last:]])


_FIELDS = [*((f"n_{k}", T.LongType()) for k in KINDS), ("base_sha256", T.StringType()), ("spans", T.StringType()), ("n_disguised", T.LongType())]


def _mapped(docs: DataFrame, judge, fields: list, text_col: str) -> DataFrame:
    """:func:`map_texts` with the input columns under plain names meanwhile, whatever theirs are."""
    names, new = docs.columns, [n for n, _ in fields]
    plain_names = docs.select(*(F.col(f"`{c}`").alias(f"in{k}") for k, c in enumerate(names)))
    mapped = map_texts(plain_names, judge, [(f"out{k}", kind) for k, (_, kind) in enumerate(fields)], f"in{names.index(text_col)}")
    return mapped.select(*(F.col(f"in{k}").alias(c) for k, c in enumerate(names) if c not in new), *(F.col(f"out{k}").alias(n) for k, n in enumerate(new)))


def found(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of plain identifiers, the digest of their places, the places of all, and how many are disguised."""
    return _mapped(docs, judge, _FIELDS, text_col)


def redacted(docs: DataFrame, text_col: str = "text", into: str = "masked") -> DataFrame:
    """``docs`` with the text without personal data as ``into``."""
    return _mapped(docs, lambda text: (masked(text),), [(into, T.StringType())], text_col)
