"""Quality rules: fixed base rules, and robust multivariate outliers per language and source.

A document's statistics are transformed to a vector of six: mean word length, shares of symbols, of
capitals and of sentence marks on a logarithmic scale, and shares of duplicate lines and of repeated
words as they are, so that one line said twice in a short text stays near the rest. For each language and source the centre and spread of the vectors are the regularised
minimum-covariance-determinant estimate: of all weightings of the group by 0 to 1 that add up to
three quarters of its documents, the one whose covariance, with a floor added to each variance, has
the least determinant. A document whose Mahalanobis distance is beyond the cut is rejected. The
floors are what texts of fifty words vary by chance; statistics that hardly vary otherwise (most
texts have no symbols) would make every deviation an outlier.

The search has four deterministic starts per group: the diagonal of absolute deviations, the
correlation of hyperbolic tangents, the spatial signs, and the covariance of the half nearest to the
medians. Each takes concentration steps (refit to the three quarters nearest so far), which never
raise the determinant, until it no longer falls by more than ``SETTLED``; the start that ends lowest
is kept. A step is one aggregation: moments are summed per group, start and fine bin of distance,
then added up over the nearest bins, the last one in part, so that the weights are three quarters of
the documents exactly. Medians are approximate; they only place the starts.

Languages and sources with fewer documents than ``group_size`` are pooled, first by language, then
over all; where even that is few, the base rules alone decide. Everything is built-in expressions:
words and windows are arrays within their row, estimates are aggregates, and no text is shuffled.

Cases: null text counts as empty and fails for its few words; null languages and sources are
values of their own; rows repeat as they come; an empty table gives an empty table; ``judge``
keeps the columns it is told to, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.once import evaluated
from citeloom.scratch import Scratch

FEWEST_WORDS = 50
SPACE = r"[\x20\x09-\x0D]"
# The part of a group's documents an estimate rests on, and what a covariance over that part of
# six-dimensional normal data has to be multiplied by: 0.75 / P(chi2(8) <= 7.841).
PART, PART_FACTOR = 0.75, 1.3614
# The part of the documents nearest to the medians that the last start rests on.
START_PART = 0.5
# A start has settled once a step lowers the logarithm of its determinant by less than this.
SETTLED = 1e-4
# Bins of squared distance in each of its factors of e, from e^-16 on.
BINS, LEAST_LOG = 256, -16
# The chi-square quantile of six degrees of freedom that one clean document in 60 million passes.
CUT = 47.2
# Documents a group needs for an estimate of its own.
GROUP_SIZE = 100
# Chance variation of the six statistics at the least length.
FLOORS = (0.05, 0.25, 0.3, 0.25, 0.05, 0.1)
# Lines that a text is taken to have besides its own, so that one pair among few tells little.
MORE_LINES = 10
PERCENTILE_ACCURACY = 1000
D = range(6)
PAIRS = [(i, j) for j in D for i in range(j + 1)]
X = [f"_x{i}" for i in D]

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _share(part: Column, whole: Column) -> Column:
    return F.log1p(F.lit(100.0) * part / F.greatest(whole, F.lit(1)))


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, F.lit(pattern), F.lit("")))


def statistics(docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns, the base statistics, ``base_failed``, ``_g0`` (language and source),
    ``_g1`` (language) and the vector ``_x0`` to ``_x5``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = F.struct(*[F.col(f"`{c}`") for c in columns])
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{SPACE[1:-1]}]"))
    first = evaluated(
        docs,
        kept.alias("_row"),
        words.alias("_words"),
        lines.alias("_lines"),
        _without(text, r"[^#*$%&|<>]+").alias("_symbols"),
        _without(text, r"[^\p{Lu}]+").alias("_capitals"),
        _without(text, r"[^.,!?;:]+").alias("_marks"),
        F.concat(F.coalesce(F.col("lang"), F.lit("\0")), F.lit("\1"), F.coalesce(F.col("source"), F.lit("\0"))).alias("_g0"),
        F.concat(F.coalesce(F.col("lang"), F.lit("\0")), F.lit("\1\1")).alias("_g1"),
    )
    n = F.size("_words")
    # A window is known by a 64-bit hash of its three words.
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(
                F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    second = evaluated(
        first,
        "_row", "_symbols", "_capitals", "_marks", "_g0", "_g1",
        n.alias("_n"),
        F.length(F.array_join("_words", "")).alias("_chars"),
        F.size("_lines").alias("_all_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("_dup_lines"),
        windows.alias("_windows"),
    )
    # Only texts that repeat a window need to know where: sorted by hash, equal ones are adjacent.
    ordered = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    third = evaluated(
        second,
        *[c for c in second.columns if c != "_windows"],
        ordered.alias("_ordered"),
    )
    same = lambda a, b: F.coalesce(F.get("_ordered", a)["h"] == F.get("_ordered", b)["h"], F.lit(False))
    repeated = F.sort_array(
        F.transform(
            F.filter("_ordered", lambda w, k: same(k, k - 1) | same(k, k + 1)), lambda w: w["i"]
        )
    )
    fourth = evaluated(
        third, *[c for c in third.columns if c != "_ordered"], repeated.alias("_repeated")
    )
    # Each repeated window covers three words, less where the next begins earlier.
    covered = F.aggregate(
        F.transform(
            "_repeated",
            lambda at, k: F.least(F.lit(3), F.coalesce(F.get("_repeated", k + 1) - at, F.lit(3))),
        ),
        F.lit(0),
        lambda total, m: total + m,
    )
    fifth = evaluated(
        fourth, *[c for c in fourth.columns if c != "_repeated"], covered.alias("_covered")
    )
    words_, chars = F.col("_n"), F.col("_chars")
    return fifth.select(
        *[F.col("_row")[c].alias(c) for c in columns],
        words_.cast("long").alias("n_words"),
        chars.cast("long").alias("word_chars"),
        F.col("_symbols").cast("long").alias("n_symbols"),
        F.col("_dup_lines").cast("long").alias("n_dup_lines"),
        F.col("_covered").cast("long").alias("n_repeat_words"),
        ((words_ < FEWEST_WORDS) | (100 * F.col("_covered") > 50 * words_)).alias("base_failed"),
        "_g0",
        "_g1",
        F.log(F.greatest(chars, F.lit(1)) / F.greatest(words_, F.lit(1))).alias("_x0"),
        _share(F.col("_symbols"), chars).alias("_x1"),
        _share(F.col("_capitals"), chars).alias("_x2"),
        _share(F.col("_marks"), chars).alias("_x3"),
        (F.col("_dup_lines") / (F.col("_all_lines") + MORE_LINES)).alias("_x4"),
        (F.col("_covered") / F.greatest(words_, F.lit(1))).alias("_x5"),
    )


def _inverted(fits: DataFrame) -> DataFrame:
    """Centres with the covariances ``_c`` replaced by the inverse ``_p`` of their sum with the
    floors, and ``_logdet``, the logarithm of that sum's determinant."""
    kept = [c for c in fits.columns if not c.startswith("_c")]
    swept = fits.select(
        *kept,
        *[(F.col(f"_c{i}{j}") + (FLOORS[i] ** 2 if i == j else 0.0)).alias(f"_p{i}{j}") for i, j in PAIRS],
        F.lit(0.0).alias("_logdet"),
    )
    at = lambda i, j: F.col(f"_p{min(i, j)}{max(i, j)}")
    for k in D:
        # With the floor on the diagonal a pivot is below its floor by rounding only.
        pivot = F.greatest(at(k, k), F.lit(min(FLOORS) ** 2))

        def entry(i: int, j: int, k: int = k, pivot: Column = pivot) -> Column:
            if i == k and j == k:
                return -1.0 / pivot
            if i == k or j == k:
                return at(i, j) / pivot
            return at(i, j) - at(i, k) * at(j, k) / pivot

        swept = evaluated(
            swept,
            *kept,
            *[entry(i, j).alias(f"_p{i}{j}") for i, j in PAIRS],
            (F.col("_logdet") + F.log(pivot)).alias("_logdet"),
        )
    return swept.select(*kept, *[(-at(i, j)).alias(f"_p{i}{j}") for i, j in PAIRS], "_logdet")


def _distance() -> Column:
    """Squared Mahalanobis distance of ``_x`` from the centre ``_m`` under the inverse ``_p``."""
    off = [F.col(f"_x{i}") - F.col(f"_m{i}") for i in D]
    terms = [F.col(f"_p{i}{j}") * off[i] * off[j] * (1.0 if i == j else 2.0) for i, j in PAIRS]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


def _groups(rows: DataFrame, group_size: int) -> DataFrame:
    """Rows that take part, with the group ``_g`` whose estimate applies to them."""
    counts = rows.groupBy("_g0", "_g1").agg(F.count(F.lit(1)).alias("n"))
    small = counts.where(F.col("n") < group_size)
    pooled = small.groupBy("_g1").agg(F.sum("n").alias("pool"))
    return counts.join(pooled, "_g1", "left").select(
        "_g0",
        F.when(F.col("n") >= group_size, F.col("_g0"))
        .when(F.col("pool") >= group_size, F.col("_g1"))
        .otherwise(F.lit("\2"))
        .alias("_g"),
    )


def _starts(rows: DataFrame, group_size: int, scratch: Scratch) -> DataFrame:
    """The first fits of each group ``_g``, told apart by ``_start``."""
    middle = rows.groupBy("_g").agg(
        F.count(F.lit(1)).alias("_count"),
        *[F.percentile_approx(f"_x{i}", 0.5, PERCENTILE_ACCURACY).alias(f"_m{i}") for i in D],
    )
    middle = scratch.keep(middle.where(F.col("_count") >= group_size).drop("_count"), "medians")
    centre = [f"_m{i}" for i in D]
    spread = rows.join(middle, "_g").groupBy("_g").agg(
        *[F.first(m).alias(m) for m in centre],
        *[
            (F.percentile_approx(F.abs(F.col(f"_x{i}") - F.col(f"_m{i}")), 0.5, PERCENTILE_ACCURACY) * 1.4826).alias(f"_s{i}")
            for i in D
        ],
    )
    spread = scratch.keep(spread, "spreads")
    scale = [F.sqrt(F.col(f"_s{i}") * F.col(f"_s{i}") + FLOORS[i] ** 2) for i in D]
    scaled = evaluated(
        rows.join(spread, "_g"),
        "_g",
        *centre,
        *[s.alias(f"_s{i}") for i, s in enumerate(scale)],
        *[((F.col(f"_x{i}") - F.col(f"_m{i}")) / scale[i]).alias(f"_z{i}") for i in D],
    )
    length = sum((F.col(f"_z{i}") * F.col(f"_z{i}") for i in D), F.lit(0.0))
    bent = scaled.withColumn("_length", F.greatest(length, F.lit(1e-300)))
    moments = bent.groupBy("_g").agg(
        *[F.first(c).alias(c) for c in (*centre, *[f"_s{i}" for i in D])],
        *[F.avg(F.tanh(f"_z{i}") * F.tanh(f"_z{j}")).alias(f"_t{i}{j}") for i, j in PAIRS],
        *[F.avg(F.col(f"_z{i}") * F.col(f"_z{j}") / F.col("_length")).alias(f"_u{i}{j}") for i, j in PAIRS],
    )
    moments = scratch.keep(moments, "bent")
    both = lambda i, j: F.col(f"_s{i}") * F.col(f"_s{j}")
    alike = lambda i, j: F.coalesce(
        F.try_divide(F.col(f"_t{i}{j}"), F.sqrt(F.col(f"_t{i}{i}") * F.col(f"_t{j}{j}"))), F.lit(0.0)
    )
    deviations = spread.select(
        "_g", F.lit(0).alias("_start"), *centre,
        *[(both(i, j) if i == j else F.lit(0.0)).alias(f"_c{i}{j}") for i, j in PAIRS],
    )
    tangents = moments.select(
        "_g", F.lit(1).alias("_start"), *centre,
        *[(both(i, j) * (F.lit(1.0) if i == j else alike(i, j))).alias(f"_c{i}{j}") for i, j in PAIRS],
    )
    signs = moments.select(
        "_g", F.lit(2).alias("_start"), *centre,
        *[(both(i, j) * F.col(f"_u{i}{j}") * len(D)).alias(f"_c{i}{j}") for i, j in PAIRS],
    )
    half = _step(rows, scratch.keep(_inverted(deviations), "half"), START_PART)
    half = half.withColumn("_start", F.lit(3)).select(*deviations.columns)
    return deviations.unionByName(tangents).unionByName(signs).unionByName(half)


def _step(rows: DataFrame, fits: DataFrame, part: float) -> DataFrame:
    """The fits of the nearest ``part`` of each group under the given ones: one aggregation."""
    far = evaluated(
        rows.join(fits, "_g"),
        "_g",
        "_start",
        *[f"_m{i}" for i in D],
        *[(F.col(f"_x{i}") - F.col(f"_m{i}")).alias(f"_o{i}") for i in D],
        _distance().alias("_d"),
    )
    bin_ = F.greatest(F.floor((F.log(F.greatest("_d", F.lit(1e-300))) - LEAST_LOG) * BINS), F.lit(0))
    sums = [f"_a{i}" for i in D] + [f"_b{i}{j}" for i, j in PAIRS]
    # Moments about the last centre, so that nothing large is subtracted.
    binned = far.groupBy("_g", "_start", bin_.alias("_bin")).agg(
        *[F.first(f"_m{i}").alias(f"_m{i}") for i in D],
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(f"_o{i}").alias(f"_a{i}") for i in D],
        *[F.sum(F.col(f"_o{i}") * F.col(f"_o{j}")).alias(f"_b{i}{j}") for i, j in PAIRS],
    )
    # Bins of a group number a few thousand at most, whatever the number of its documents.
    one = Window.partitionBy("_g", "_start")
    taken = evaluated(
        binned.withColumn("_wanted", F.ceil(F.sum("_n").over(one) * part)).withColumn(
            "_before", F.sum("_n").over(one.orderBy("_bin")) - F.col("_n")
        ),
        "_g",
        "_start",
        *[f"_m{i}" for i in D],
        *sums,
        F.col("_wanted").cast("double").alias("_wanted"),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("_wanted") - F.col("_before")) / F.col("_n"))).alias("_weight"),
    ).where(F.col("_weight") > 0)
    means = taken.groupBy("_g", "_start").agg(
        *[F.first(f"_m{i}").alias(f"_m{i}") for i in D],
        *[(F.sum(F.col(c) * F.col("_weight")) / F.first("_wanted")).alias(c) for c in sums],
    )
    return means.select(
        "_g",
        "_start",
        *[(F.col(f"_m{i}") + F.col(f"_a{i}")).alias(f"_m{i}") for i in D],
        *[
            ((F.col(f"_b{i}{j}") - F.col(f"_a{i}") * F.col(f"_a{j}")) * PART_FACTOR).alias(f"_c{i}{j}")
            for i, j in PAIRS
        ],
    )


def estimates(rows: DataFrame, scratch: Scratch, group_size: int = GROUP_SIZE) -> DataFrame:
    """Centre, inverse spread and ``_logdet`` per group, one small row each, and the ``_start`` that
    led there. ``rows`` hold the group ``_g`` and the vector; groups below ``group_size`` have none."""
    first = scratch.keep(_starts(rows, group_size, scratch), "starts")
    # A start's own covariance is no candidate: only those of three quarters of the documents are.
    inverted = scratch.keep(_inverted(first), "start-fits")
    moving = scratch.keep(_inverted(_step(rows, inverted, PART)), "fits-0")
    settled = []
    while not moving.isEmpty():
        last = moving.select("_g", "_start", F.col("_logdet").alias("_last"))
        after = _inverted(_step(rows, moving, PART)).join(last, ["_g", "_start"])
        after = scratch.keep(after, f"fits-{len(settled) + 1}")
        falling = F.col("_last") - F.col("_logdet") >= SETTLED
        settled.append(after.where(~falling).drop("_last"))
        moving = after.where(falling).drop("_last")
    if not settled:
        return moving
    fits = reduce(DataFrame.unionByName, settled)
    columns = [c for c in fits.columns if c != "_g"]
    least = F.min_by(F.struct(*columns), F.struct("_logdet", "_start")).alias("_best")
    return scratch.keep(fits.groupBy("_g").agg(least).select("_g", "_best.*"), "estimate")


def judge(
    docs: DataFrame, columns: Sequence[str], scratch: Scratch, group_size: int = GROUP_SIZE
) -> DataFrame:
    """The given columns of all documents, the base statistics, ``base_failed``, ``kept`` and the
    squared ``distance`` (null where no estimate applies)."""
    scored = scratch.keep(statistics(docs, columns), "statistics", compression="zstd")
    passing = scored.where(~F.col("base_failed"))
    groups = scratch.keep(_groups(passing.select("_g0", "_g1"), group_size), "groups")
    vectors = scratch.keep(passing.join(groups, "_g0").select("_g", *X), "vectors")
    estimate = estimates(vectors, scratch, group_size)
    distance = F.when(~F.col("base_failed"), _distance())
    judged = evaluated(
        scored.join(groups, "_g0", "left").join(estimate, "_g", "left"),
        *[F.col(f"`{c}`") for c in columns],
        *BASE,
        "base_failed",
        F.when(F.col("_logdet").isNotNull(), distance).alias("distance"),
    )
    within = F.coalesce(F.col("distance"), F.lit(0.0)) <= CUT
    return judged.select(
        *[F.col(f"`{c}`") for c in columns],
        *BASE,
        "base_failed",
        (~F.col("base_failed") & within).alias("kept"),
        "distance",
    )
