"""Personal data in whole texts, also where it is disguised, with offsets into the source.

Two detectors of the same kinds run: one over the text as it is, one over the text as normalised
by transducers. The transducers rewrite look-alike letters and full-width forms, drop invisible
characters, and turn spelled digits and ``at``/``dot`` disguises into what they stand for; each
character they put out carries the stretch of source it came from, so what is found in the
normalised text maps back to code points of the source. A found stretch counts if it reads
otherwise than its source and does not overlap a plain one of its kind.

Cases: null text counts as empty; rows repeat as they come; an empty table gives an empty table;
``find`` reads no other columns and ``redact`` keeps all columns as they are but the text.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.session import id_and_text, importable

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# ---- plain detection; quantifiers are possessive where giving back cannot help ----

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NOT_DIGIT = re.compile(r"[^0-9]+")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[Span]:
    """Leftmost matches, found from their ``@``: the local part is the run before it."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        match = _DOMAIN.match(text, at)
        if match:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = match.end()
                found.append((start, end))
                at = text.find("@", end)
                continue
        at = text.find("@", at + 1)
    return found


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(map(_byte, m.group().split(".")))]


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    total = sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 16:
            digits = _NOT_DIGIT.sub("", match.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(match.span())
    return found


def phones(text: str) -> list[Span]:
    return [
        m.span()
        for m in _PHONE.finditer(text)
        if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15
    ]


def plain(text: str) -> dict[str, list[Span]]:
    digits = _DIGIT.search(text) is not None
    return {
        "email": emails(text) if "@" in text else [],
        "ip": ips(text) if digits else [],
        "card": cards(text) if digits else [],
        "phone": phones(text) if digits and "+" in text else [],
    }


# ---- normalising transducers ----

# Cyrillic and Greek letters drawn like Latin ones, in pairs.
LOOK_ALIKES = (
    "аa вb еe кk мm нh оo рp сc тt уy хx іi ѕs јj ԁd ԛq ԝw һh ӏl "
    "АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЅS ЈJ "
    "αa οo ρp νv ιi κk υu χx τt "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX"
)
# Characters that show nothing.
INVISIBLE = "­​‌‍⁠﻿"
# The digits in the four languages of the corpus.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "null": "0", "zéro": "0", "cero": "0",
    "one": "1", "eins": "1", "un": "1", "uno": "1",
    "two": "2", "zwei": "2", "zwo": "2", "deux": "2", "dos": "2",
    "three": "3", "drei": "3", "trois": "3", "tres": "3",
    "four": "4", "vier": "4", "quatre": "4", "cuatro": "4",
    "five": "5", "fünf": "5", "cinq": "5", "cinco": "5",
    "six": "6", "sechs": "6", "seis": "6",
    "seven": "7", "sieben": "7", "sept": "7", "siete": "7",
    "eight": "8", "acht": "8", "huit": "8", "ocho": "8",
    "nine": "9", "neun": "9", "neuf": "9", "nueve": "9",
}
# Words for the sign, and endings that make a bare "dot" credible.
AT_WORDS, DOT_WORDS, PLUS_WORDS = "at|arroba|arobase|ät", "dot|punkt|punto|point", "plus|más|mas"
ENDINGS = "com|org|net|edu|gov|info|biz|io|de|fr|es|eu|uk|us|ch|at|it|nl|example|test|invalid"

_single = {pair[0]: pair[1] for pair in LOOK_ALIKES.split()}


def _latin(char: str) -> str:
    """What a look-alike, full-width or mathematical character stands for."""
    if char in INVISIBLE:
        return ""
    return _single.get(char) or unicodedata.normalize("NFKC", char)


_ODD = re.compile(
    "[" + INVISIBLE + "".join(_single) + "！-～\U0001d400-\U0001d7ff]"
)
_OPEN, _CLOSE = r"[\[({<]\s{0,3}", r"\s{0,3}[\])}>]"
_digit = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_MAIL = (
    rf"(?<=[A-Za-z0-9])\s(?:{AT_WORDS})\s(?=[A-Za-z0-9-]{{1,63}}(?:\s(?:{DOT_WORDS})\s[A-Za-z0-9-]{{1,63}}){{0,5}}"
    rf"(?:\.|\s(?:{DOT_WORDS})\s)(?:{ENDINGS})\b)"
)
_SEP = rf"(?<=[A-Za-z0-9])\s(?:{DOT_WORDS})\s(?=[A-Za-z0-9])"
_SIGNS = re.compile(
    rf"(?P<at>\s{{0,3}}{_OPEN}(?:{AT_WORDS}|@){_CLOSE}\s{{0,3}})"
    rf"|(?P<dot>\s{{0,3}}{_OPEN}(?:{DOT_WORDS}|\.){_CLOSE}\s{{0,3}})"
    rf"|(?P<mail>{_MAIL})"
    rf"|(?P<sep>{_SEP})"
    rf"|(?P<plus>\b(?:{PLUS_WORDS})\s+(?=(?:{_digit})\b))"
    rf"|(?P<digit>\b(?:{_digit})\b)"
    rf"|(?P<gap>(?<=\w)(?:\s*,\s*|\s+)(?=(?:{_digit})\b))",
    re.IGNORECASE,
)
_BRACKETED = re.compile(rf"{_OPEN}(?:{AT_WORDS}|@|{DOT_WORDS}|\.){_CLOSE}", re.IGNORECASE)
_MAIL_ALONE, _SEP_ALONE = re.compile(_MAIL, re.IGNORECASE), re.compile(_SEP, re.IGNORECASE)
_WORD = re.compile(r"\w+")
_SIGN_WORDS = frozenset(f"{AT_WORDS}|{DOT_WORDS}".split("|"))
# Letters that a pattern without case takes for an ASCII one, but ``lower`` does not make one.
_CASE = str.maketrans({"ſ": "s", "ı": "i", "İ": "i"})


class Normalised:
    """A rewritten text and, for each of its characters, where it came from."""

    def __init__(self, text: str):
        self.text = text
        self.starts = list(range(len(text)))
        self.ends = list(range(1, len(text) + 1))

    def rewrite(self, pattern: re.Pattern, put: Callable[[re.Match], str]) -> None:
        text, at = [], 0
        starts, ends = [], []
        for match in pattern.finditer(self.text):
            a, b = match.span()
            out = put(match)
            if out == match.group():
                continue
            text += (self.text[at:a], out)
            starts += self.starts[at:a]
            ends += self.ends[at:a]
            starts += [self.starts[a]] * len(out)
            ends += [self.ends[b - 1]] * len(out)
            at = b
        if at:
            text.append(self.text[at:])
            self.text = "".join(text)
            self.starts = starts + self.starts[at:]
            self.ends = ends + self.ends[at:]

    def source(self, span: Span) -> Span:
        return self.starts[span[0]], self.ends[span[1] - 1]


def _sign(match: re.Match) -> str:
    kind = match.lastgroup
    if kind in ("at", "mail"):
        return "@"
    if kind in ("dot", "sep"):
        return "."
    if kind == "plus":
        return "+"
    if kind == "gap":
        return " "
    return DIGIT_WORDS[_lower(match.group())]


def _lower(text: str) -> str:
    return (text if text.isascii() else text.translate(_CASE)).lower()


def disguised(text: str) -> bool:
    """Whether the transducers might change anything but gaps; reads all of the text.

    True wherever one of them would; a gap matters only before a digit word. Whether what they put
    out is credible is for detection to say.
    """
    if not text.isascii() and _ODD.search(text):
        return True
    if _BRACKETED.search(text):
        return True
    words = set(_WORD.findall(_lower(text)))
    if not DIGIT_WORDS.keys().isdisjoint(words):
        return True
    # Both signs are words of their own, so most texts need no search.
    return not words.isdisjoint(_SIGN_WORDS) and bool(_MAIL_ALONE.search(text) or _SEP_ALONE.search(text))


def normalise(text: str) -> Normalised:
    found = Normalised(text)
    if not text.isascii():
        found.rewrite(_ODD, lambda m: _latin(m.group()))
    found.rewrite(_SIGNS, _sign)
    return found


def spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Plain spans by kind, and those that only the normalised text shows."""
    base = plain(text)
    added: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if disguised(text):
        clear = normalise(text)
        for kind, found in plain(clear.text).items():
            for span in found:
                start, end = clear.source(span)
                if text[start:end] != clear.text[span[0] : span[1]] and all(
                    end <= a or b <= start for a, b in base[kind]
                ):
                    added[kind].append((start, end))
    return base, added


def listed(found: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(found[kind]))


FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    "base_sha256 string, spans string, n_added long"
)


def find(docs: DataFrame) -> DataFrame:
    """Counts and digest of the plain spans, and all spans, of every document."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in FOUND.split(", ")]
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                base, added = spans(text.as_py())
                both = {kind: base[kind] + added[kind] for kind in KINDS}
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append(
                    (*[len(base[k]) for k in KINDS], digest, listed(both), sum(map(len, added.values())))
                )
            kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 7, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names=names)

    return id_and_text(docs).mapInArrow(run, FOUND)


def masked(text: str) -> str:
    """The text with every found stretch replaced by its kind; overlapping ones by the first's."""
    base, added = spans(text)
    found = sorted((a, b, kind) for kind in KINDS for a, b in base[kind] + added[kind])
    out, at = [], 0
    for start, end, kind in found:
        if start >= at:
            out += (text[at:start], f"[{kind.upper()}]")
        at = max(at, end)
    return "".join(out) + text[at:] if found else text


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns, ``text`` masked and ``n_chars``, where there is one, kept true."""
    importable(docs.sparkSession)
    mask = F.pandas_udf(lambda texts: texts.map(masked, na_action="ignore"), "string")
    changed = docs.withColumn("text", mask("text"))
    if "n_chars" in docs.columns:
        changed = changed.withColumn(
            "n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
        )
    return changed
