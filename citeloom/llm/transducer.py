"""Byte-level BPE by a lazily determinised transducer, and streaming UTF-8 decoding.

The nondeterministic machine guesses where each token ends; a guess is right if the two tokens
at every border are neighbours (:mod:`citeloom.llm.vocab`). Of the tokenizations of a prefix
exactly one is right, so a deterministic state is what is not settled yet: the last token given
out, and for every border that a coming token may start from, the tokens that lead to it. Reading
a byte adds one border; the tokens that lead to all live borders are given out.
That happens after a bounded lookahead, as no token is longer than the longest. Transitions are
worked out when first met.

Words are remembered whole (:mod:`citeloom.llm.pieces`): a memo entry is one composed run of
transitions from the start state.

Cases: null text counts as empty; an empty text has no tokens; rows repeat as they come; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from citeloom.llm.pieces import Memo, Pieces
from citeloom.llm.session import file_bytes, id_and_text, importable, in_worker
from citeloom.llm.vocab import Vocabulary

# Transitions kept; past this many the machine forgets all but its start state.
TRANSITIONS_KEPT = 400_000
# Words and pieces remembered by one Python worker.
WORDS_KEPT = 600_000
KEPT = (WORDS_KEPT, TRANSITIONS_KEPT)
# No token.
NONE = -1
# Ids decoded at a time.
DECODE_STEP = 65_536


class Transducer:
    """Bytes of one piece in, token ids out."""

    def __init__(self, vocab: Vocabulary, kept: int = TRANSITIONS_KEPT):
        self.vocab = vocab
        self.kept = kept
        children, self._ends_at = vocab.tree
        self._child = children.get
        self._forget()

    def _forget(self) -> None:
        # A state: the last token given out, and every live border as the tokens leading to it
        # from there with the place in the vocabulary's tree reached since. The newest is last.
        start = (NONE, (((), 0),))
        self.states = [start]
        self.numbers = {start: 0}
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}

    def encode(self, piece: bytes) -> list[int]:
        out: list[int] = []
        state, moves = 0, self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self._move(state, byte)
                moves = self.moves
            state, given = move
            if given:
                out += given
        out += self.states[state][1][-1][0]
        return out

    def _move(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        if len(self.moves) >= self.kept:
            state = self.states[number]
            self._forget()
            number = self._number(state)
        last, borders = self.states[number]
        child, ends_at = self._child, self._ends_at
        verdict, neighbours = self.vocab.verdicts.get, self.vocab.neighbours
        live, newest = [], None
        for border in borders:
            path, place = border
            place = child(place << 8 | byte)
            if place is None:
                continue
            token, goes_on = ends_at[place]
            if newest is None and token >= 0:
                before = path[-1] if path else last
                if before < 0:
                    newest = (*path, token)
                else:
                    fits = verdict(before << 20 | token)
                    if fits is None:
                        fits = neighbours(before, token)
                    if fits:
                        newest = (*path, token)
            if goes_on:
                live.append((path, place))
        live.append((newest, 0))
        given = live[0][0]
        if given:
            given = self._shared(live)
        if given:
            last, n = given[-1], len(given)
            live = [(path[n:], place) for path, place in live]
        if live[0][0]:
            # The oldest border has the shortest path; unless it is empty, none is, and no coming
            # token stands next to the last one given out.
            last = NONE
        move = (self._number((last, tuple(live))), given)
        self.moves[number << 8 | byte] = move
        return move

    @staticmethod
    def _shared(live: list[tuple[tuple[int, ...], int]]) -> tuple[int, ...]:
        """The tokens all paths begin with."""
        if len(live) == 1:
            return live[0][0]
        low, high = min(live)[0], max(live)[0]
        n, most = 0, min(len(low), len(high))
        while n < most and low[n] == high[n]:
            n += 1
        return low[:n]

    def _number(self, state: tuple) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
        return number


class Utf8Stream:
    """Bytes in pieces of any size in, whole characters out.

    The state is the beginning of the character under way. Ill-formed bytes raise, as
    ``bytes.decode`` does.
    """

    def __init__(self) -> None:
        self.begun = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """How many bytes at the end belong to a character that is not whole yet."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:  # a continuation: look further back for the lead
                continue
            needs = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
            return back if needs > back else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.begun + data
        keep = self._unfinished(data)
        self.begun = data[len(data) - keep :]
        return data[: len(data) - keep].decode()

    def close(self) -> None:
        if self.begun:
            raise ValueError("the bytes end within a character")


class Codec:
    """Whole texts to ids and back."""

    def __init__(self, vocab: Vocabulary, pattern: str, kept: tuple[int, int] = KEPT):
        words_kept, transitions_kept = kept
        self.vocab = vocab
        self.pieces = Pieces(pattern)
        machine = Transducer(vocab, transitions_kept)
        findall = self.pieces.pattern.findall

        def ids(piece: str) -> bytes:
            return array("I", machine.encode(piece.encode())).tobytes()

        def spaced(word: str) -> bytes:
            """A word after a space; where they are one piece, the machine reads it."""
            pieces = findall(" " + word)
            if len(pieces) == 1:
                return ids(pieces[0])
            return b"".join(map(part, pieces))

        def part(piece: str) -> bytes:
            # A piece that begins with a space is itself a word after a space.
            return known[piece[1:]] if piece[0] == " " and len(piece) > 1 else bare[piece]

        known, bare = Memo(spaced, words_kept), Memo(ids, words_kept // 8)
        self._spaced = known
        self._whole = lambda text: b"".join(map(part, findall(text)))
        self._first = Memo(self._whole, words_kept // 8)

    def encode(self, text: str) -> bytes:
        """Ids as unsigned 32-bit integers, least byte first."""
        lines = self.pieces.words(text)
        if lines is None:
            return self._whole(text)
        feed = self._whole("\n")
        spaced = self._spaced.__getitem__
        return feed.join([self._first[w[0]] + b"".join(map(spaced, w[1:])) for w in lines])

    def decode(self, ids: bytes) -> Iterator[tuple[bytes, str]]:
        """Bytes and the characters they complete, step by step."""
        tokens, stream = self.vocab.tokens.__getitem__, Utf8Stream()
        ids = array("I", ids)
        for at in range(0, len(ids), DECODE_STEP):
            data = b"".join(map(tokens, ids[at : at + DECODE_STEP]))
            yield data, stream.feed(data)
        stream.close()


def _codec(data: Broadcast, pattern: str, kept: tuple[int, int] = KEPT) -> Codec:
    def make() -> Codec:
        return Codec(Vocabulary.from_ranks(data.value), pattern, kept)

    return in_worker("codec", hash(data.value), pattern, kept, make=make)


ENCODED = "doc_id long, text string, ids binary"
ROUND_TRIP = (
    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, same_text boolean"
)


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, text, ids`` (unsigned 32-bit integers, least byte first) of whole texts."""
    importable(docs.sparkSession)
    data = docs.sparkSession.sparkContext.broadcast(file_bytes(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data, pattern)
        for batch in batches:
            texts = batch.column("text")
            ids = [codec.encode(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), texts.cast(pa.string()), pa.array(ids, pa.binary())],
                names=["doc_id", "text", "ids"],
            )

    return id_and_text(docs).mapInArrow(run, ENCODED)


def round_trip(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    *,
    keep: bool = False,
    kept: tuple[int, int] = KEPT,
) -> DataFrame:
    """Digests of each text's ids and of what they decode to, and whether that is the text.

    ``keep`` adds the ids (unsigned 32-bit integers, least byte first) and the text itself.
    ``kept`` bounds the words and transitions that a worker remembers, which a worker that has to
    leave room for other operators may lower; results do not depend on it.
    """
    importable(docs.sparkSession)
    data = docs.sparkSession.sparkContext.broadcast(file_bytes(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data, pattern, kept)
        for batch in batches:
            n_tokens, id_digests, text_digests, same, all_ids = [], [], [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                ids = codec.encode(text)
                digest, characters = hashlib.sha256(), []
                for part, read in codec.decode(ids):
                    digest.update(part)
                    characters.append(read)
                n_tokens.append(len(ids) // 4)
                id_digests.append(hashlib.sha256(ids).hexdigest())
                text_digests.append(digest.hexdigest())
                same.append("".join(characters) == text)
                if keep:
                    all_ids.append(ids)
            columns = [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(n_tokens, pa.int64()),
                pa.array(id_digests, pa.string()),
                pa.array(text_digests, pa.string()),
                pa.array(same, pa.bool_()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same_text"]
            if keep:
                columns += [pa.array(all_ids, pa.binary()), batch.column("text").cast(pa.string())]
                names += ["ids", "text"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return id_and_text(docs).mapInArrow(run, ROUND_TRIP + ", ids binary, text string" * keep)
