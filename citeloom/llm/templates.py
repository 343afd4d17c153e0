"""Benchmark decontamination by canonical templates.

Texts become template words: numbers, names and units turn into typed placeholders, a run of
names or a number with its unit into one; the rest is lower-cased and stripped of punctuation.
Windows of template words are hashed and the documents' windows joined to the benchmark's, beside
windows of the words as they are, lower-cased, which find verbatim copies whatever they consist of.
A capital word that begins a window is read both as a name and as a word.

Windows of one document and item that lie on nearby diagonals belong together. Where one value of
the item faces several values of the document, windows in which it faces another than itself
do not count. So a question asked again with other numbers or names is found, a chance run of
placeholders is not.

A document is contaminated by an item when matched windows cover at least ``share`` of the item's
words. Documents' windows are looked up in a bitmap of fixed size first, so that only likely
matches are joined; the join decides.

Cases: null and empty texts have no windows; items shorter than a window are compared as a whole;
items of fewer than ``SHORTEST`` words are too short to tell and match nothing; repeated items and
documents each give their rows; empty tables give empty tables; other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.pieces import Memo
from citeloom.llm.session import importable, in_worker, unused
from citeloom.operators.lookup import BROADCAST_KEYS, hot_keys, lookup
from citeloom.scratch import Scratch

# Words remembered by one Python worker.
WORDS_KEPT = 1_000_000
WINDOW = 8
SHORTEST = 5
# Words in a window that must not be placeholders, at least.
PLAIN_WORDS = 4
SHARE = 0.5
# The bitmap has 2 ** BITMAP_BITS bits (8 MB), whatever the benchmark's size.
BITMAP_BITS = 26

NUMBER, NAME, UNIT = 1, 2, 3
# What a written word's own type may be besides: a number with its unit, a word with digits in it.
_WITH_UNIT, _WITH_DIGITS = 2, 3
# Low bits of a template word's hash: its type, and facts about its writing.
_KIND, _CAPITAL, _STOP, _UNIT_WORD = 3, 4, 8, 16
_FLAGS, _SHIFT = np.uint64(31), np.uint64(5)

# Units of measure and money, written after (or before) a number.
UNITS = frozenset(
    "mm cm dm m km inch inches foot feet yard yards mile miles mg g kg ton tons tonne tonnes ounce "
    "ounces pound pounds ml cl l litre litres liter liters gallon gallons second seconds minute "
    "minutes hour hours day days week weeks month months year years percent % degree degrees "
    "dollar dollars cent cents euro euros $ € £ mph kmh km/h watt watts volt volts".split()
)
_MARKS = frozenset(",.;:!?")
_DIGITS = re.compile(r"\d+(?:[.,:/]\d+)*")
_EDGES = re.compile(r"^[^\w$€£%]+|[^\w$€£%]+$")
_MULTIPLIER = 0x9E3779B97F4A7C15  # fixed value: odd 64-bit constant for mixing


@cache
def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(_MULTIPLIER, exponent, 1 << 64))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) & ~31


def _core(word: str) -> str:
    return _EDGES.sub("", word)


def _word(word: str) -> int:
    """Hash and flags of one written word, apart from what stands around it."""
    marked = word[-1] in _MARKS
    letters = word[:-1] if marked else word
    if letters.isalpha():  # nothing else to strip and no digits
        lower = letters.lower()
        flags = _STOP if marked and word[-1] in ".!?:" else 0
        if lower in UNITS:
            flags |= _UNIT_WORD
        if letters[0].isupper() and letters[1:].islower():
            flags |= _CAPITAL
        return _hash(lower) | flags
    core = _core(word)
    flags = _STOP if word[-1] in ".!?:" or word[-1] in "\"')]»”" and word[-2:-1] in (".", "!", "?") else 0
    lower = core.lower()
    shape = _shape(lower)
    if lower in UNITS:
        flags |= _UNIT_WORD
    if shape != lower:
        rest = shape.replace("<n>", "")
        flags |= NUMBER if not rest else _WITH_UNIT if rest in UNITS else _WITH_DIGITS
    elif core[:1].isupper() and core[1:].islower():
        flags |= _CAPITAL
    return _hash(lower) | flags


def _shape(lower: str) -> str:
    return _DIGITS.sub("<n>", lower)


def _counting(words: list[str]) -> bool:
    """Whether words are numbers at equal steps, which any count or table may hold."""
    try:
        numbers = [int(_core(w)) for w in words]
    except ValueError:
        return False
    return len({b - a for a, b in zip(numbers, numbers[1:])}) <= 1


class Templates:
    """Template words of texts."""

    def __init__(self) -> None:
        self.words = Memo(_word, kept=WORDS_KEPT)
        self.shapes = Memo(lambda w: _hash(_shape(_core(w).lower())), kept=WORDS_KEPT // 8)
        self.name, self.unit = np.uint64(_hash("<name>")), np.uint64(_hash("<u>"))
        self.number, self.amount = np.uint64(_hash("<n>")), np.uint64(_hash("<n><u>"))

    def words_of(self, text: str) -> list[str]:
        return text.split()

    def written(self, words: list[str]) -> np.ndarray:
        """Hash of every word as it is, and its flags in the low bits."""
        return np.array(array("Q", map(self.words.__getitem__, words)), np.uint64)

    def canonical(self, words: list[str], raw: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hash and type (0 for a plain word) of every template word."""
        raw = self.written(words) if raw is None else raw
        flags = (raw & _FLAGS).astype(np.uint8)
        hashes = raw & ~_FLAGS
        own = flags & _KIND
        kinds = np.zeros(len(words), np.uint8)
        if not len(words):
            return hashes, kinds
        hashes[own == NUMBER], hashes[own == _WITH_UNIT] = self.number, self.amount
        kinds[(own == NUMBER) | (own == _WITH_UNIT)] = NUMBER
        for i in (own == _WITH_DIGITS).nonzero()[0].tolist():
            hashes[i] = self.shapes[words[i]]
        # A capital inside a sentence makes a name; at its beginning it may be any word.
        inside = np.empty(len(words), dtype=bool)
        inside[0] = False
        inside[1:] = (flags[:-1] & _STOP) == 0
        names = ((flags & _CAPITAL) != 0) & inside
        hashes[names], kinds[names] = self.name, NAME
        numbers = kinds == NUMBER
        near = np.zeros(len(words), dtype=bool)
        near[1:] |= numbers[:-1]
        near[:-1] |= numbers[1:]
        units = ((flags & _UNIT_WORD) != 0) & near
        hashes[units], kinds[units] = self.unit, UNIT
        return hashes, kinds

    def collapsed(self, hashes: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, type and first word of every placeholder or word, runs as one; the words' number
        ends the last column."""
        before, after = kinds[:-1], kinds[1:]
        joined = np.zeros(len(kinds), dtype=bool)
        joined[1:] = (
            (before == NAME) & (after == NAME)
            | (before == NUMBER) & (after == UNIT)
            | (before == UNIT) & (after == NUMBER)
        )
        starts = (~joined).nonzero()[0]
        edges = np.concatenate((starts, [len(kinds)]))
        hashes, kinds = hashes[starts], kinds[starts]
        amounts = (edges[1:] - starts > 1) & (kinds != NAME)
        hashes[amounts], kinds[amounts] = self.amount, NUMBER
        return hashes, kinds, edges

    def sums(self, words: np.ndarray, size: int) -> np.ndarray:
        """Sum over the words of every window, each times a power of the multiplier, the last as it is.

        Windows are put together of shorter ones, so that eight words cost three steps."""
        total, done = words, 1
        for bit in bin(size)[3:]:
            total, done = total[: len(total) - done] * _power(done) + total[done:], 2 * done
            if bit == "1":
                total, done = total[:-1] * _power(1) + words[done:], done + 1
        return total

    def mixed(self, sums: np.ndarray) -> np.ndarray:
        """Hashes of windows from their sums."""
        total = sums ^ sums >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)  # fixed value: a mixing constant
        total ^= total >> np.uint64(32)
        return total

    def found(self, words: list[str], size: int | None, wanted) -> Iterator[tuple[int, int, int, int, list[str]]]:
        """``window, size, first word, end, slots`` of the windows that ``wanted`` takes."""
        raw = self.written(words)
        words_alone = raw & ~_FLAGS
        own = size or min(WINDOW, len(words))
        n = len(words) - own + 1
        if n > 0:
            apart = words_alone ^ self.unit  # not to be taken for templates
            window = self.mixed(self.sums(apart >> _SHIFT, own))
            for i in wanted(window).nonzero()[0].tolist():
                if not _counting(words[i : i + own]):
                    yield int(window[i].view(np.int64)), own, i, i + own, []
        hashes, kinds, edges = self.collapsed(*self.canonical(words, raw))
        own = size or min(WINDOW, len(hashes))
        n = len(hashes) - own + 1
        if own < SHORTEST or n <= 0:
            return
        plain = np.zeros(len(kinds) + 1, np.int64)
        np.cumsum(kinds == 0, out=plain[1:])
        least = min(PLAIN_WORDS, own)
        starts = edges[:-1]
        many = edges[1:] - starts > 1

        def row(window, i, at, till, slots):
            inner = [(kinds[j], edges[j], edges[j + 1]) for j in range(i + 1, till) if kinds[j]]
            return int(window.view(np.int64)), own, int(at), int(edges[till]), [
                f"{kind}:{(' ' if kind == NAME else '').join(_core(w).lower() for w in words[a:b])}"
                for kind, a, b in slots + inner
            ]

        short = hashes >> _SHIFT
        rest = self.sums(short, own - 1)
        total, first = rest[:-1] * _power(1) + short[own - 1 :], _power(own - 1)
        window = self.mixed(total)
        for i in ((plain[own:] - plain[:-own] >= least) & wanted(window)).nonzero()[0].tolist():
            yield row(window[i], i, starts[i], i + own, [(kinds[i], starts[i], edges[i + 1])] if kinds[i] else [])
            if kinds[i] == NAME and many[i]:
                # The run's first word may only be a capital one in front of the name.
                yield row(window[i], i, starts[i] + 1, i + own, [(NAME, starts[i] + 1, edges[i + 1])])
        # The other reading of a capital word that begins a window: a name as a word, a word as a name.
        capital = (raw[starts] & np.uint64(_CAPITAL)) != 0
        at = (capital[:n] & ~many[:n] & ((kinds[:n] == NAME) | (kinds[:n] == 0))).nonzero()[0]
        named = kinds[at] == NAME
        other = np.where(named, words_alone[starts[at]], self.name) >> _SHIFT
        window = self.mixed(total[at] + (other - short[at]) * first)
        enough = plain[at + own] - plain[at] + np.where(named, 1, -1) >= least
        for k in (enough & wanted(window)).nonzero()[0].tolist():
            i = int(at[k])
            yield row(window[k], i, starts[i], i + own, [] if named[k] else [(NAME, starts[i], edges[i + 1])])
        # A capital word, and the rest of the run as a name.
        at = ((kinds[: n + 1] == NAME) & many[: n + 1]).nonzero()[0]
        window = self.mixed((words_alone[starts[at]] >> _SHIFT) * first + rest[at])
        enough = plain[at + own - 1] - plain[at] + 1 >= least
        for k in (enough & wanted(window)).nonzero()[0].tolist():
            i = int(at[k])
            yield row(window[k], i, starts[i], i + own - 1, [(NAME, starts[i] + 1, edges[i + 1])])


def templates() -> Templates:
    return in_worker("templates", make=Templates)


WINDOWS = "key string, window long, size int, at int, till int, slots array<string>"


def _rows(frame: DataFrame, key: str, text: str, sizes: list[int] | None, bitmap: Broadcast | None) -> DataFrame:
    """Window rows of a table; of given sizes, or of each text's own size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = templates()
        bits = np.frombuffer(bitmap.value, np.uint8) if bitmap is not None else None

        def wanted(found: np.ndarray) -> np.ndarray:
            if bits is None:
                return np.ones(len(found), bool)
            place = found.view(np.int64) & ((1 << BITMAP_BITS) - 1)
            return (bits.take(place >> 3) >> (place & 7).astype(np.uint8) & 1) == 1

        for batch in batches:
            rows = []
            for own, content in zip(batch.column("key").to_pylist(), batch.column("text")):
                words = maker.words_of(content.as_py() or "")
                if len(words) < SHORTEST:
                    continue
                for size in sizes or [None]:
                    rows += [(own, *row) for row in maker.found(words, size, wanted)]
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["key", "window", "size", "at", "till", "slots"],
            )

    narrow = frame.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, WINDOWS)


def _bitmap(windows: DataFrame) -> bytes:
    """Fixed-size bitmap of window hashes; put together by Spark, one row per byte in use."""
    place = F.col("window").bitwiseAND((1 << BITMAP_BITS) - 1)
    rows = windows.groupBy(F.shiftright(place, 3).alias("byte")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(window & 7 as int))")).alias("bits")
    )
    bits = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    # Packed into one row per 64 KB, so what reaches the driver is the bitmap and little more.
    packed = rows.groupBy(F.shiftright("byte", 16).alias("part")).agg(
        F.collect_list(F.struct("byte", "bits")).alias("bytes")
    )
    for row in packed.toLocalIterator():
        for byte, value in row["bytes"]:
            bits[byte] = value
    return bits.tobytes()


def text_key(column: str = "text"):
    """What stands for a text in joins: documents with one text share their verdict."""
    return F.md5(F.coalesce(F.col(column), F.lit("")).cast("binary"))


def matches(docs: DataFrame, benchmark: DataFrame, *, share: float = SHARE) -> DataFrame:
    """``key, item_id, covered, item_words, verbatim`` of contaminating items, by text key.

    ``verbatim`` says whether all slots hold the item's own values.
    """
    spark = docs.sparkSession
    importable(spark)
    numbered = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    items = numbered.select(
        F.concat_ws(":", F.col("item_id").cast("string"), text_key()).alias("item"), "item_id", "text"
    ).distinct()
    item_windows = _rows(items, "item", "text", None, None).cache()
    try:
        sizes = sorted(r["size"] for r in item_windows.select("size").distinct().collect())
        if not sizes:
            sizes = [WINDOW]
        bitmap = spark.sparkContext.broadcast(_bitmap(item_windows))
    finally:
        item_windows.unpersist()
    found = _rows(docs.select(text_key().alias("_key"), "text"), "_key", "text", sizes, bitmap)
    right = item_windows.select(
        F.col("key").alias("item"), "window", "size", F.col("at").alias("item_at"),
        F.col("till").alias("item_till"), F.col("slots").alias("item_slots"),
    )
    joined = found.join(right, ["window", "size"])
    # At most as many as the text's matched windows, whatever its copies.
    together = joined.groupBy("key", "item").agg(
        F.collect_set(F.struct("at", "item_at", "item_till", "slots", "item_slots")).alias("windows")
    )
    words = items.select(
        "item", "item_id", F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")).alias("item_words")
    )
    kept = words.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [
                judged([tuple(w.values()) for w in windows.as_py()], n)
                for windows, n in zip(batch.column("windows"), batch.column("item_words").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("item_id"),
                    pa.array([c for c, _ in best], pa.int32()),
                    batch.column("item_words"),
                    pa.array([v for _, v in best], pa.bool_()),
                ],
                names=["key", "item_id", "covered", "item_words", "verbatim"],
            )

    return (
        together.join(words, "item")
        .mapInArrow(run, f"key string, item_id {kept}, covered int, item_words int, verbatim boolean")
        .where(F.col("covered") >= F.ceil(F.col("item_words") * share))
        .groupBy("key", "item_id", "item_words")
        .agg(F.max(F.struct("covered", "verbatim")).alias("best"))
        .select("key", "item_id", "best.covered", "item_words", "best.verbatim")
    )


def judged(windows: list[tuple], item_words: int) -> tuple[int, bool]:
    """Most words of an item that consistent windows on nearby diagonals cover, and whether all of
    their slots hold the item's own values. ``windows`` has rows of place in the document, place
    and end in the item, slots of both."""
    near = max(WINDOW, item_words // 4)
    rows = sorted((at - a, a, b, tuple(zip(theirs, ours))) for at, a, b, theirs, ours in windows)
    best, end = (0, False), 0
    for i, row in enumerate(rows):
        if i and rows[i - 1][0] == row[0]:
            continue
        while end < len(rows) and rows[end][0] <= row[0] + near:
            end += 1
        alone = i
        while alone < end and rows[alone][0] == row[0]:
            alone += 1
        for some in (rows[i:alone], rows[i:end]) if alone < end else (rows[i:end],):
            best = max(best, _cover(some))
    return best


def _one(values: set[str]) -> bool:
    """Whether values are one, or the longest and its last words, as of ``Anna Lee`` and ``Lee``."""
    longest = max(values, key=len)
    return all(v == longest or longest.endswith(" " + v.partition(":")[2]) for v in values)


def _cover(rows: list[tuple]) -> tuple[int, bool]:
    faces: dict[str, set[str]] = {}
    for row in rows:
        for theirs, ours in row[3]:
            faces.setdefault(ours, set()).add(theirs)
    covered, verbatim = set(), True
    for _, a, b, pairs in rows:
        if all(theirs == ours or _one(faces[ours]) for theirs, ours in pairs):
            covered.update(range(a, b))
            verbatim &= all(theirs == ours for theirs, ours in pairs)
    return len(covered), verbatim


def contaminated(docs: DataFrame, benchmark: DataFrame, *, share: float = SHARE) -> DataFrame:
    """``doc_id, item_id, covered, item_words, verbatim``, one row per document and item."""
    ids = docs.select(text_key().alias("key"), "doc_id")
    return ids.join(matches(docs, benchmark, share=share), "key").drop("key")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    scratch: Scratch | None = None,
    *,
    share: float = SHARE,
) -> DataFrame:
    """The documents, with all their columns, that no item contaminates.

    The keys of contaminated texts are counted and broadcast if they are few; no document is then
    shuffled. Beyond that documents are joined by key, a text that fills the table over many tasks.
    """
    scratch = scratch or Scratch(docs.sparkSession, "templates")
    key = unused(docs, "_template_key")
    bad = scratch.keep(
        matches(docs, benchmark, share=share).select(F.col("key").alias(key)).distinct(), "bad"
    )
    keyed = docs.withColumn(key, text_key())
    if bad.count() <= BROADCAST_KEYS:
        return keyed.join(F.broadcast(bad), key, "left_anti").drop(key)
    hot = hot_keys(keyed.select(key), key)
    return lookup(keyed, bad, key, how="left_anti", hot=hot, null_keys=False).drop(key)
