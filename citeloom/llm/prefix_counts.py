"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

Of the byte-pair encodings of a piece's prefixes, each ends in one last token; without it stands
the encoding of a shorter prefix. So the count of a prefix is one more than that of the prefix
before its last token, and the last token is the one whose left neighbour there agrees
(:mod:`citeloom.llm.vocab`). One pass over a piece gives the counts of all its prefixes, and
counts add up over pieces. How many tokens a truncated text has, or how much of it fits a
budget, is then read off and never encoded again.

A prefix that ends in white space counts its whole run of white space as one piece, and one
that ends inside a contraction such as ``'re`` counts two, because that is how the cut text
would be split.

Cases: null text counts as empty; an empty text has no tokens and no prefixes; rows repeat as
they come; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from citeloom.llm.pieces import WORDS_KEPT, Memo, Pieces
from citeloom.llm.session import file_bytes, id_and_text, importable, in_worker
from citeloom.llm.vocab import Vocabulary

# The contractions of the split pattern that have two letters. Cut short by one,
# they are an apostrophe and a letter.
CONTRACTIONS = frozenset({"'re", "'ve", "'ll"})
# Words remembered with 16-bit counts; a text with a longer one is counted piece by piece.
WORD_LIMIT = 16_000


class PrefixCounter:
    """Counts for the prefixes of texts, in code points."""

    def __init__(self, vocab: Vocabulary, pattern: str):
        self.vocab = vocab
        self.pieces = Pieces(pattern, vocab.special)
        self._run = regex.compile(r"\s+")
        self._table = Memo(self._piece)
        self._first = Memo(self._word, WORDS_KEPT // 4)
        self._spaced = Memo(lambda word: self._word(" " + word))

    def last_tokens(self, piece: bytes) -> tuple[list[int], list[int]]:
        """For each length, the last token and the number of tokens of that beginning."""
        children, ends_at = self.vocab.tree
        child, verdict = children.get, self.vocab.verdicts.get
        neighbours, size = self.vocab.neighbours, len(piece)
        last, count = [-1] * (size + 1), [0] * (size + 1)
        for start in range(size):
            before, n, place = last[start], count[start] + 1, 0
            for end in range(start + 1, size + 1):
                place = child(place << 8 | piece[end - 1])
                if place is None:
                    break
                token = ends_at[place][0]
                if token >= 0 and last[end] < 0:
                    fits = True
                    if start:
                        fits = verdict(before << 20 | token)
                        if fits is None:
                            fits = neighbours(before, token)
                    if fits:
                        last[end], count[end] = token, n
        return last, count

    def _piece(self, piece: str) -> array:
        """Counts after each code point of one piece."""
        data = piece.encode()
        count = array("I", self.last_tokens(data)[1])
        if len(data) > len(piece):
            at = accumulate(len(c.encode()) for c in piece)
            count = array("I", [0, *[count[i] for i in at]])
        if piece in CONTRACTIONS:
            count[2] = 2
        return count[1:]

    def _word(self, text: str) -> bytes:
        """Counts after each code point of text whose only white space may be a leading space."""
        pieces = self.pieces.pattern.findall(text)
        if len(pieces) == 1:  # remembered as a word, not once more as a piece
            return array("H", self._piece(pieces[0])).tobytes()
        out, before = array("H"), 0
        for piece in pieces:
            counts = self._table[piece]
            out.extend([before + n for n in counts])
            before += counts[-1]
        return out.tobytes()

    def _chunk(self, text: str) -> np.ndarray:
        """Counts after each code point, split by the pattern; for text without specials."""
        out: list[int] = []
        before = 0
        run_from = before_run = None
        for match in self.pieces.pattern.finditer(text):
            piece = match.group()
            counts = [before + n for n in self._table[piece]]
            if piece.isspace():
                if run_from is None:
                    run_from, before_run = match.start(), before
                elif match.start() > run_from:
                    counts = self._in_run(text, run_from, before_run, match.start(), match.end())
            else:
                if run_from is not None and self._run.match(piece):
                    counts[:1] = self._in_run(
                        text, run_from, before_run, match.start(), match.start() + 1
                    )
                run_from = None
            before += self._table[piece][-1]
            out += counts
        return np.array(out, dtype=np.uint32)

    def _in_run(self, text: str, run_from: int, before: int, start: int, end: int) -> list[int]:
        """Counts of prefixes that end in a run of white space which the whole text divides."""
        counts = self._table[text[run_from:end]]
        return [before + n for n in counts[start - run_from :]]

    def counts(self, text: str) -> np.ndarray:
        """The number of tokens of ``text[:i]`` for i = 1, 2, …; of the whole text at the end."""
        lines = self.pieces.words(text)
        if lines is None or (self.pieces.special and self.pieces.special.search(text)):
            return self._general(text)
        if max(max(map(len, words)) for words in lines) > WORD_LIMIT:
            return self._general(text)
        feed = self._word("\n")
        tables = []
        for words in lines:
            tables.append(self._first[words[0]])
            tables += map(self._spaced.__getitem__, words[1:])
            tables.append(feed)
        tables.pop()
        within = np.frombuffer(b"".join(tables), dtype=np.uint16)
        lengths = np.fromiter(map(len, tables), dtype=np.int64, count=len(tables)) // 2
        totals = within[np.cumsum(lengths) - 1]
        before = np.cumsum(totals, dtype=np.uint32) - totals
        return within + np.repeat(before, lengths)

    def _general(self, text: str) -> np.ndarray:
        """Any white space, and strings that stand for a special token."""
        out, before, at = [np.zeros(0, np.uint32)], 0, 0
        for is_special, part in self.pieces.parts(text):
            inner = self._chunk(part)
            whole = 1 if is_special else int(inner[-1])
            if is_special:  # until it is complete, its characters are ordinary text
                start = max((m.end() for m in self.pieces.special.finditer(text, 0, at)), default=0)
                cut = self._chunk(text[start : at + len(part) - 1])[at - start :] if len(part) > 1 else []
                ahead = before - (self._total(text[start:at]) if at > start else 0)
                inner = np.append(np.asarray(cut, dtype=np.uint32) + np.uint32(ahead), np.uint32(before + 1))
                out.append(inner)
            else:
                out.append(inner + np.uint32(before))
            before += whole
            at += len(part)
        return np.concatenate(out)

    def _total(self, text: str) -> int:
        return int(self._chunk(text)[-1])


def longest_within(counts: np.ndarray, budget: int, longest: int) -> int:
    """Length of the longest prefix of at most ``budget`` tokens; 0 if there is none.

    No token has more than ``longest`` bytes, so a prefix beyond that many per token is too long.
    """
    if not len(counts) or counts[-1] <= budget:
        return len(counts)
    fitting = np.flatnonzero(counts[: longest * (budget + 1)] <= budget)
    return int(fitting[-1]) + 1 if len(fitting) else 0


def _counter(data: Broadcast, pattern: str) -> PrefixCounter:
    def make() -> PrefixCounter:
        return PrefixCounter(Vocabulary.from_json(data.value), pattern)

    return in_worker("prefix counter", hash(data.value), pattern, make=make)


def prefix_counts(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    *,
    budgets: Sequence[int] = (512, 2048, 8192),
    keep_counts: bool = False,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` and for each budget ``fits_<budget>``, the code points of the
    longest prefix within it. ``keep_counts`` adds ``counts``, the count of every prefix."""
    importable(docs.sparkSession)
    data = docs.sparkSession.sparkContext.broadcast(file_bytes(vocabulary_path))
    schema = "doc_id long, n_bytes long, n_tokens long"
    schema += "".join(f", fits_{b} long" for b in budgets)
    names = ["doc_id", "n_bytes", "n_tokens", *[f"fits_{b}" for b in budgets]]
    if keep_counts:
        schema += ", counts array<int>"
        names.append("counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(data, pattern)
        longest = max(counter.vocab.longest, *map(len, counter.vocab.special), 1)
        for batch in batches:
            rows: list[list] = [[] for _ in names[1:]]
            for text in batch.column("text"):
                text = text.as_py()
                counts = counter.counts(text)
                rows[0].append(len(text.encode()))
                rows[1].append(int(counts[-1]) if len(counts) else 0)
                for column, budget in zip(rows[2:], budgets):
                    column.append(longest_within(counts, budget, longest))
                if keep_counts:
                    rows[-1].append(counts.astype(np.int32))
            kinds = [pa.int64()] * (2 + len(budgets)) + [pa.list_(pa.int32())] * keep_counts
            columns = [pa.array(r, k) for r, k in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names=names)

    return id_and_text(docs).mapInArrow(run, schema)


# -- counts kept as a table ---------------------------------------------------------------

STORED = "doc_id long, n_bytes long, n_tokens long, steps binary"


def pack(counts: np.ndarray) -> bytes:
    """Counts as their differences, in the narrowest integers that hold them, compressed."""
    steps = np.diff(counts.astype(np.int64), prepend=0)
    most = int(np.abs(steps).max(initial=0))
    width = 1 if most < 1 << 7 else 2 if most < 1 << 15 else 8
    return bytes([width]) + zlib.compress(steps.astype(f"<i{width}").tobytes(), 1)


def unpack(steps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(steps[1:]), f"<i{steps[0]}").astype(np.int64))


def store_counts(docs: DataFrame, vocabulary_path: str, pattern: str, path: str) -> None:
    """Write the count of every prefix of every text, for :func:`answers` to read."""
    counted = prefix_counts(docs, vocabulary_path, pattern, budgets=(), keep_counts=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column("counts")
            offsets, values = counts.offsets.to_numpy(), counts.values.to_numpy()
            steps = [pack(values[a:b]) for a, b in zip(offsets, offsets[1:])]
            columns = [batch.column(c) for c in ("doc_id", "n_bytes", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(steps, pa.binary())], names=["doc_id", "n_bytes", "n_tokens", "steps"]
            )

    counted.mapInArrow(run, STORED).write.mode("overwrite").parquet(path)


def answers(
    stored: DataFrame, *, budgets: Sequence[int] = (), cuts: Sequence[int] = ()
) -> DataFrame:
    """Answer any question of stored counts without a text or a tokenizer.

    Adds ``fits_<budget>``, the code points of the longest prefix of at most so many tokens, and
    ``tokens_<cut>``, the tokens of the first so many code points (of the whole text, if shorter).
    """
    names = [*[f"fits_{b}" for b in budgets], *[f"tokens_{c}" for c in cuts]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list[int]] = [[] for _ in names]
            for steps in batch.column("steps"):
                counts = unpack(steps.as_py())
                for column, budget in zip(rows, budgets):
                    fitting = np.flatnonzero(counts <= budget)
                    column.append(int(fitting[-1]) + 1 if len(fitting) else 0)
                for column, cut in zip(rows[len(budgets) :], cuts):
                    at = min(cut, len(counts))
                    column.append(int(counts[at - 1]) if at > 0 else 0)
            columns = [batch.column(c) for c in ("doc_id", "n_bytes", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, *[pa.array(r, pa.int64()) for r in rows]],
                names=["doc_id", "n_bytes", "n_tokens", *names],
            )

    importable(stored.sparkSession)
    added = "".join(f", {name} long" for name in names)
    return stored.select("doc_id", "n_bytes", "n_tokens", "steps").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long" + added
    )
