"""What a chain of filters removes, in every order, from one pass over the documents.

Five filters make 32 subsets. A document becomes a 32-bit word: bit ``s`` says that it survives
the filters of subset ``s``, so the word follows from the filters it fails alone. How many
documents survive each subset is then a positional popcount of the words, and everything a report
on an order of filters asks for is a difference of two survivor counts: a step removes
``survivors(filters before) - survivors(filters before and this one)``.

Words are added up by carry-save adders: bit-sliced counters in which plane ``p`` holds bits worth
``2 ** p`` for all 32 positions at once, and three words of one plane become one of the same and
one of the next. Equal texts with the same part and labels share a word and are fed in once, into
the planes of their number's binary digits. A task returns 32 sums per part and label.

The last filter asks whether a smaller id has the same text. Equal texts fail the other filters
alike, so counts and smallest ids per text, part and labels settle it, combined map-side: however
often a text occurs, no task sees its rows one by one, and no join is made on it.

Cases: null text is the empty one, which fails only the filters it fails by their words (it has
under 200 words); null ids are never larger than another, and rows with one id and text are not
each other's smaller; a null part is the empty string; rows without labels are neither good nor
toxic, several rows of labels for one id count if any says 1; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from citeloom.functions.once import evaluated
from citeloom.llm.session import importable
from citeloom.operators.lookup import hot_keys, lookup
from citeloom.scratch import Scratch

LETTERS = "ABCDE"
SUBSETS = 1 << len(LETTERS)
_E = 1 << LETTERS.index("E")
# Classes of documents that are counted.
CLASSES = ("all", "good", "toxic")
# Counters a task holds before it passes its sums on; parts may be many.
COUNTERS_HELD = 4_096


def survival_word(failed: int) -> int:
    """The word of a document that fails the filters in the mask ``failed``."""
    return sum(1 << subset for subset in range(SUBSETS) if not subset & failed)


# -- counting -----------------------------------------------------------------------------


def _carry_save(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One layer of adders: ``3 n`` words of a plane as ``n`` of it and ``n`` of the next."""
    third = len(words) // 3
    a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
    both = a ^ b
    return np.concatenate([both ^ c, words[3 * third :]]), (a & b) | (both & c)


class Counter:
    """Positional popcounts of 32-bit words, held as bit planes."""

    def __init__(self):
        self.planes: list[list[np.ndarray]] = []

    def add(self, words: np.ndarray, times: np.ndarray) -> None:
        """Add every word as often as it is said to occur."""
        plane = 0
        while times.any():
            self._put(plane, words[(times & 1).astype(bool)])
            times = times >> 1
            plane += 1

    def _put(self, plane: int, words: np.ndarray) -> None:
        """Add words to a plane; sums of three leave two words there at most."""
        while len(words):
            while plane >= len(self.planes):
                self.planes.append(np.empty(0, np.uint32))
            words, carried = np.concatenate([self.planes[plane], words]), []
            while len(words) > 2:
                words, carry = _carry_save(words)
                carried.append(carry)
            self.planes[plane] = words
            words = np.concatenate(carried) if carried else np.empty(0, np.uint32)
            plane += 1

    def sums(self) -> list[int]:
        """How many of the added words have each bit."""
        bits = np.arange(SUBSETS, dtype=np.uint32)
        out = [0] * SUBSETS
        for plane, words in enumerate(self.planes):
            for word in words:
                for position in np.flatnonzero((word >> bits) & np.uint32(1)):
                    out[position] += 1 << plane
        return out


_COUNT_SCHEMA = "part string, class string, survivors array<bigint>"
_COUNT_ARROW = pa.schema(
    [("part", pa.string()), ("class", pa.string()), ("survivors", pa.list_(pa.int64()))]
)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counters: dict[tuple[str, str], Counter] = {}

    def passed_on() -> pa.RecordBatch:
        rows = [
            {"part": part, "class": name, "survivors": counter.sums()}
            for (part, name), counter in counters.items()
        ]
        counters.clear()
        return pa.RecordBatch.from_pylist(rows, _COUNT_ARROW)

    for batch in batches:
        words = batch.column("word").to_numpy(zero_copy_only=False).astype(np.uint32)
        times = batch.column("n").to_numpy(zero_copy_only=False)
        of_class = {
            "all": np.ones(len(words), bool),
            "good": batch.column("good").to_numpy(zero_copy_only=False).astype(bool),
            "toxic": batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool),
        }
        parts = batch.column("part").dictionary_encode()
        codes = parts.indices.to_numpy(zero_copy_only=False)
        for code, part in enumerate(parts.dictionary.to_pylist()):
            here = codes == code
            for name in CLASSES:
                chosen = here & of_class[name]
                if name == "all" or chosen.any():
                    counter = counters.setdefault((part, name), Counter())
                    counter.add(words[chosen], times[chosen])
        if len(counters) > COUNTERS_HELD:
            yield passed_on()
    yield passed_on()


# -- documents to words -------------------------------------------------------------------


def _features(docs: DataFrame) -> DataFrame:
    """``doc_id, id_key, part, digest, failed``: the filters that a text fails by itself."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    measured = evaluated(
        docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text")),
        "doc_id",
        "part",
        words.alias("words"),
        F.length("text").alias("n_chars"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("n_capitals"),
        F.col("text").rlike(r"[#$%&*|]").alias("marks"),
        F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"),
    )
    counted = evaluated(
        measured,
        "doc_id",
        "part",
        "digest",
        "n_chars",
        "n_capitals",
        "marks",
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
    )
    fails = {
        "A": F.col("n_words") < 200,
        "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
        "C": 100 * F.col("n_capitals").cast("long") > 3 * F.col("n_chars").cast("long"),
        "D": F.col("marks"),
    }
    failed = sum(
        (fails[letter].cast("int") * (1 << LETTERS.index(letter)) for letter in fails), F.lit(0)
    )
    return counted.select(
        "doc_id", F.col("doc_id").cast("string").alias("id_key"), "part", "digest", failed.alias("failed")
    )


def _labelled(features: DataFrame, labels: DataFrame) -> DataFrame:
    flags = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("string").alias("id_key"))
        .agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
    )
    joined = lookup(features, flags, "id_key", hot=hot_keys(features, "id_key"))
    return joined.select(
        "doc_id",
        "part",
        "digest",
        "failed",
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def _words(labelled: DataFrame) -> DataFrame:
    """``part, good, toxic, word, n``: survival words and how many documents have them."""
    key = ["digest", "part", "good", "toxic"]
    by_id = labelled.groupBy(*key, "failed", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    alike = by_id.groupBy(*key, "failed").agg(
        F.sum("n").alias("n"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("without_id"),
    )
    # One row per text, part and labels; the smallest id of a text may be in another part.
    least = F.min("least.doc_id").over(Window.partitionBy("digest"))
    settled = alike.withColumn("first", least).select(
        "part",
        "good",
        "toxic",
        "failed",
        "n",
        (
            F.col("without_id")
            + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
        ).alias("n_first"),
    )
    outcomes = F.array(
        F.struct(F.col("failed").alias("failed"), F.col("n_first").alias("n")),
        F.struct(
            F.col("failed").bitwiseOR(F.lit(_E)).alias("failed"),
            (F.col("n") - F.col("n_first")).alias("n"),
        ),
    )
    table = F.array(*[F.lit(survival_word(failed)).cast("long") for failed in range(SUBSETS)])
    return (
        settled.select("part", "good", "toxic", F.inline(outcomes))
        .where(F.col("n") > 0)
        .select("part", "good", "toxic", F.get(table, F.col("failed")).alias("word"), "n")
    )


def survivors(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """``part, all, good, toxic``: arrays of 32 counts, by the mask of a subset of filters."""
    importable(docs.sparkSession)
    features = scratch.keep(_features(docs), "features")
    sums = _words(_labelled(features, labels)).mapInArrow(_count, _COUNT_SCHEMA)
    added = [
        F.sum(F.when(F.col("class") == name, F.col("survivors")[subset])).alias(f"{name}{subset}")
        for name in CLASSES
        for subset in range(SUBSETS)
    ]
    return (
        sums.groupBy("part")
        .agg(*added)
        .select(
            "part",
            *[
                F.array(
                    *[F.coalesce(F.col(f"{name}{s}"), F.lit(0).cast("long")) for s in range(SUBSETS)]
                ).alias(name)
                for name in CLASSES
            ],
        )
    )


# -- the report ---------------------------------------------------------------------------


def _steps() -> list[tuple[int, int]]:
    """The filters before each step of each order, and the step's own filter, as masks."""
    out = []
    for order in itertools.permutations(range(len(LETTERS))):
        before = 0
        for letter in order:
            out.append((before, 1 << letter))
            before |= 1 << letter
    return out


def audit(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per part, order of the filters and step; ``filter`` names the step's own."""
    n = len(LETTERS)
    orders = ["".join(order) for order in itertools.permutations(LETTERS)]
    steps = _steps()
    counted = survivors(docs, labels, scratch)
    placed = counted.select(
        "*", F.posexplode(F.array(*[F.lit(order) for order in orders])).alias("_order", "filter_order")
    ).select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    place = F.col("_order") * n + F.col("step") - 1
    masked = placed.select(
        "part",
        *CLASSES,
        "filter_order",
        "step",
        F.get(F.array(*[F.lit(before) for before, _ in steps]), place).alias("before"),
        F.get(F.array(*[F.lit(own) for _, own in steps]), place).alias("own"),
    )

    def lost(counts: str) -> Column:
        after = F.col("before").bitwiseOR(F.col("own"))
        return F.get(counts, F.col("before")) - F.get(counts, after)

    every = SUBSETS - 1
    fails = F.get("all", F.lit(0)) - F.get("all", F.col("own"))
    # A filter's share in all orders: each set of others precedes it in so many of them.
    shares = [
        (s, math.factorial(s.bit_count()) * math.factorial(n - 1 - s.bit_count()))
        for s in range(every)
    ]
    shapley = F.aggregate(
        F.array(*[F.struct(F.lit(s).alias("s"), F.lit(w).cast("long").alias("w")) for s, w in shares]),
        F.lit(0).cast("long"),
        lambda total, x: total
        + F.when(x["s"].bitwiseAND(F.col("own")) != 0, F.lit(0).cast("long")).otherwise(
            x["w"] * (F.get("all", x["s"]) - F.get("all", x["s"].bitwiseOR(F.col("own"))))
        ),
    )
    return masked.select(
        "part",
        "filter_order",
        "step",
        F.substring("filter_order", F.col("step"), F.lit(1)).alias("filter"),
        F.get("all", F.col("before").bitwiseOR(F.col("own"))).alias("kept"),
        lost("all").alias("removed"),
        (fails - lost("all")).alias("redundant"),
        (F.get("all", F.lit(every) - F.col("own")) - F.get("all", F.lit(every))).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )
