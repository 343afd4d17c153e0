"""Secret scans by a trigram index.

From the regex of each rule follows which trigrams a matching text must hold: a Boolean query,
all of (any of (all of some trigrams)). The index holds, for the trigrams that queries ask for,
the documents that hold them (in lower case). Intersecting the postings gives each rule's
candidates, and only they are matched against the regex. Rules without a mandatory trigram are
matched against every text. The index only ever selects too much, so results do not depend on it.

Offsets come from built-in expressions as well: what lies between matches, and the matches
themselves, add up to where each begins.

Documents are known in the index by a hash of id and text, so that copies of one text do not
meet in one place; where two rows share a hash, both are candidates and the regex decides.

Cases: null text counts as empty; null ids and repeated rows are scanned like others; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re._parser as regex_parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.once import evaluated
from citeloom.scratch import Scratch

# Strings that a stretch of a regex may stand for, at most, before it is put to use.
MOST_STRINGS = 64
SPANS = "array<struct<start:int,number:int,end:int>>"
# Matches of a text whose places are counted in one go.
RUN = 256


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds the span; its group ``group`` must have at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules, then what other services' secrets look like.
BASE_RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]+", least=32),
)
MORE_RULES = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/@]{3,64}@"),
)

Query = list[list[frozenset[str]]]


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _demand(strings: set[str]) -> Query:
    """That a text holds one of the strings: any of (all of the string's trigrams)."""
    if min(map(len, strings)) < 3:
        return []
    return [_least({_trigrams(s) for s in strings})]


def _least(ways: set[frozenset[str]]) -> list[frozenset[str]]:
    """Ways that ask for no more than another does."""
    return sorted((w for w in ways if not any(other < w for other in ways)), key=sorted)


def _walk(parsed) -> tuple[set[str] | None, Query]:
    """The strings a regex stands for, if few, else None and what it demands of a text."""
    query: Query = []
    strings: set[str] = {""}
    exact = True

    def cut() -> None:
        nonlocal strings, exact
        query.extend(_demand(strings))
        strings, exact = {""}, False

    for op, args in parsed:
        op = str(op)
        options: set[str] | None = None
        inner: Query = []
        if op == "LITERAL":
            options = {chr(args).lower()}
        elif op == "IN" and all(str(o) == "LITERAL" for o, _ in args):
            options = {chr(a).lower() for _, a in args}
        elif op == "SUBPATTERN":
            options, inner = _walk(args[-1])
        elif op == "BRANCH":
            options, inner = _either([_walk(branch) for branch in args[1]])
        elif op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, body = args
            own, demanded = _walk(body)
            if own is not None and least == 0 and most == 1:
                options = own | {""}
            elif own is not None and least == most == 1:
                options = own
            elif least >= 1:
                inner = demanded or (_demand(own) if own else [])
        if options is not None and len(options) * len(strings) <= MOST_STRINGS:
            strings = {a + b for a, b in product(strings, options)}
        else:
            cut()
            query.extend(inner)
            if options is not None:
                query.extend(_demand(options))
    if exact:
        return strings, []
    cut()
    return None, query


def _either(branches: list[tuple[set[str] | None, Query]]) -> tuple[set[str] | None, Query]:
    """One of several: their strings together, or what all of their demands come to."""
    if all(own is not None for own, _ in branches):
        return set().union(*(own for own, _ in branches)), []
    demands = [_demand(own) if own is not None else q for own, q in branches]
    if not all(demands):
        return None, []
    return None, [_least({a for q in demands for a in q[0]})]


def trigram_query(pattern: str) -> Query:
    """What a text must hold, in lower case, to match: empty if nothing is mandatory."""
    strings, query = _walk(regex_parser.parse(pattern))
    return _demand(strings) if strings is not None else query


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def index(texts: DataFrame, rules: tuple[Rule, ...], scratch: Scratch) -> DataFrame:
    """Postings ``trigram, key`` for all trigrams the rules' queries ask for, kept as a table."""
    wanted = sorted({t for r in rules for part in trigram_query(r.pattern) for way in part for t in way})
    lower = evaluated(texts, _key().alias("key"), F.lower("text").alias("low"))
    held = F.filter(
        F.array(*[F.lit(t) for t in wanted]) if wanted else F.array().cast("array<string>"),
        lambda t: F.contains(F.col("low"), t),
    )
    return scratch.keep(lower.select("key", F.explode(held).alias("trigram")), "postings")


def candidates(postings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``key, kinds``: the documents in the intersections, and for which rules."""
    asked = [
        (r.kind, len(query), part, way, len(trigrams), trigram)
        for r in rules
        if (query := trigram_query(r.pattern))
        for part, ways in enumerate(query)
        for way, trigrams in enumerate(ways)
        for trigram in sorted(trigrams)
    ]
    # As long as the rules' trigrams are many, whatever the data.
    table = postings.sparkSession.createDataFrame(
        asked, "kind string, parts int, part int, way int, needed int, trigram string"
    )
    ways = (
        postings.distinct()
        .join(F.broadcast(table), "trigram")
        .groupBy("key", "kind", "parts", "part", "way", "needed")
        .count()
        .where(F.col("count") == F.col("needed"))
    )
    whole = (
        ways.groupBy("key", "kind", "parts")
        .agg(F.count_distinct("part").alias("met"))
        .where(F.col("met") == F.col("parts"))
    )
    return whole.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def _found(rule: Rule, number: int) -> Column:
    """Spans of one rule in ``text``: ``(start, number, end)`` in code points."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all("text", pattern, F.lit(0))
    part = F.regexp_extract_all("text", pattern, F.lit(rule.group))
    gaps = F.split("text", rule.pattern, -1)
    # The last gap follows the last match and is dropped by the shorter arrays.
    rows = F.arrays_zip(whole.alias("whole"), part.alias("part"), gaps.alias("gap"))
    # One element, so that the lambda's variable holds the matches and they are searched once.
    return F.flatten(F.transform(F.array(rows), lambda own: _spans(own, rule, number)))


def _spans(rows: Column, rule: Rule, number: int) -> Column:
    """Spans from matches and the gaps before them.

    An appended array is copied, so spans are appended within runs of matches, counted from the
    run's own start, and runs are moved to their places after.
    """
    empty = F.array().cast(SPANS)

    def step(seen: Column, row: Column) -> Column:
        start = seen["at"] + F.length(row["gap"])
        end = start + F.coalesce(F.length(row["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(number).alias("number"), end.alias("end"))
        counts = row["whole"].isNotNull() & (F.length(row["part"]) >= rule.least)
        spans = F.when(counts, F.concat(seen["spans"], F.array(span))).otherwise(seen["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    def move(seen: Column, run: Column) -> Column:
        moved = F.transform(
            run["spans"],
            lambda s: F.struct(
                (s["start"] + seen["at"]).alias("start"), s["number"].alias("number"), (s["end"] + seen["at"]).alias("end")
            ),
        )
        return F.struct(
            (seen["at"] + run["at"]).alias("at"), F.concat(seen["runs"], F.array(moved)).alias("runs")
        )

    last = F.greatest(F.size(rows) - 1, F.lit(0))
    runs = F.transform(
        F.sequence(F.lit(0), last, F.lit(RUN)),
        lambda at: F.aggregate(
            F.slice(rows, at + 1, RUN), F.struct(F.lit(0).alias("at"), empty.alias("spans")), step
        ),
    )
    no_runs = F.array().cast(f"array<{SPANS}>")
    placed = F.aggregate(runs, F.struct(F.lit(0).alias("at"), no_runs.alias("runs")), move)
    return F.flatten(placed["runs"])


def _full_scan(rule: Rule, number: int) -> Column:
    """Spans of a rule that is tried on every text; most texts are done after one match attempt."""
    # Runs of one class: those too short for the rule can be left out by the regex itself.
    long_only = Rule(rule.kind, rule.pattern.removesuffix("+") + f"{{{rule.least},}}", 0, rule.least)
    rule = long_only if _is_run(rule) else rule
    none = F.array().cast(SPANS)
    return F.when(F.col("text").rlike(rule.pattern), _found(rule, number)).otherwise(none)


def _is_run(rule: Rule) -> bool:
    parsed = list(regex_parser.parse(rule.pattern))
    return len(parsed) == 1 and rule.group == 0 and rule.pattern.endswith("]+")


def scan(docs: DataFrame, scratch: Scratch, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """``doc_id, spans``: ``array<struct<start, number, end>>`` in order, ``number`` the rule's."""
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    found = candidates(index(texts, indexed, scratch), indexed)
    none = F.array().cast(SPANS)
    numbers = {r.kind: i for i, r in enumerate(rules)}
    scanned = evaluated(
        texts,
        "doc_id",
        "text",
        _key().alias("key"),
        F.concat(none, *[_full_scan(r, numbers[r.kind]) for r in rules if r not in indexed]).alias("full"),
    )
    joined = scanned.join(found, "key", "left")
    verified = evaluated(
        joined,
        "doc_id",
        F.concat(
            F.col("full"),
            *[
                F.when(F.array_contains("kinds", r.kind), _found(r, numbers[r.kind])).otherwise(none)
                for r in indexed
            ],
        ).alias("spans"),
    )
    return verified.select("doc_id", F.array_sort("spans").alias("spans"))


def listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["number"]), s["start"], s["end"])), ","
    )


def report(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Counts and digest of the base rules' spans, and all spans, of every document."""
    rules = BASE_RULES + MORE_RULES
    scanned = scan(docs, scratch, rules)
    base = F.filter("spans", lambda s: s["number"] < len(BASE_RULES))
    counts = [
        F.size(F.filter("spans", (lambda i: lambda s: s["number"] == i)(i))).cast("long").alias(f"n_{r.kind}")
        for i, r in enumerate(BASE_RULES)
    ]
    return scanned.select(
        "doc_id",
        *counts,
        F.sha2(listed(base, rules), 256).alias("base_sha256"),
        listed(F.col("spans"), rules).alias("spans"),
    )
