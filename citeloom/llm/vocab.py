"""Byte-pair vocabularies and the rule for which tokens may stand side by side.

A list of tokens is the byte-pair encoding of its bytes exactly if each token encodes to itself
and each two neighbours encode to themselves. Whether two tokens are such neighbours is decided
from the merges along the boundary: pieces on the right edge of the first meet pieces on the left
edge of the second, and a merge across the boundary must not come before either is absorbed.
"""

from __future__ import annotations

import base64
import json
from functools import cached_property

NEVER = 1 << 40
# Neighbour verdicts kept; past this many the table starts again.
PAIRS_KEPT = 1_000_000


def byte_letters() -> dict[str, int]:
    """The printable stand-ins for bytes in JSON vocabularies: visible Latin-1 stands for itself,
    the other bytes follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens by rank; rank and id are the same. ``pairs`` limits merges to listed ones."""

    def __init__(self, tokens: dict[bytes, int], pairs: dict[tuple[int, int], int] | None = None,
                 special: dict[str, int] | None = None):
        self.ids = tokens
        self.tokens = {i: t for t, i in tokens.items()}
        self.special = special or {}
        self.longest = max(map(len, tokens))
        self._pairs = pairs
        self._halves: dict[int, tuple[int, int] | None] = {}
        if pairs is not None:
            self._halves = {merged: halves for halves, merged in pairs.items()}
        self.verdicts: dict[int, bool] = {}
        self._left: dict[int, list[tuple[int, int]]] = {}
        self._right: dict[int, list[tuple[int, int]]] = {}

    @classmethod
    def from_ranks(cls, data: bytes) -> Vocabulary:
        """A rank file: a base64 token and its rank per line; any two pieces may merge."""
        rows = (line.split() for line in data.splitlines() if line)
        return cls({base64.b64decode(token): int(rank) for token, rank in rows})

    @classmethod
    def from_json(cls, data: bytes) -> Vocabulary:
        """A tokenizer file: listed pairs merge, in their order."""
        parsed = json.loads(data)
        letters = byte_letters()

        def raw(text: str) -> bytes:
            return bytes(letters[c] for c in text)

        special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        tokens = {raw(t): i for t, i in parsed["model"]["vocab"].items() if t not in special}
        pairs = {}
        for a, b in parsed["model"]["merges"]:
            a, b = raw(a), raw(b)
            pairs[tokens[a], tokens[b]] = tokens[a + b]
        return cls(tokens, pairs, special)

    def merged(self, a: int, b: int) -> int:
        """The token two pieces merge into, or NEVER."""
        if self._pairs is not None:
            return self._pairs.get((a, b), NEVER)
        return self.ids.get(self.tokens[a] + self.tokens[b], NEVER)

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two pieces whose merge made a token; none for a byte."""
        if token not in self._halves:
            text = self.tokens[token]
            if self._pairs is not None or len(text) == 1:
                return None
            parts = self.merge(text, below=token)
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def merge(self, text: bytes, below: int = NEVER) -> list[int]:
        """Byte-pair encoding by its definition: the lowest rank first, leftmost first."""
        parts = [self.ids[text[i : i + 1]] for i in range(len(text))]
        while len(parts) > 1:
            rank, at = min((self.merged(a, b), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[at : at + 2] = [rank]
        return parts

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Pieces on one edge of a token, each with the rank at which it is absorbed."""
        known = self._right if side else self._left
        if token not in known:
            edge, piece, absorbed = [], token, NEVER
            while True:
                edge.append((piece, absorbed))
                halves = self.halves(piece)
                if halves is None:
                    break
                absorbed, piece = piece, halves[side]
            known[token] = edge
        return known[token]

    def neighbours(self, a: int, b: int) -> bool:
        """Whether ``a`` followed by ``b`` is the encoding of their bytes."""
        key = a << 20 | b
        verdict = self.verdicts.get(key)
        if verdict is None:
            if len(self.verdicts) >= PAIRS_KEPT:
                self.verdicts.clear()
            verdict = self.verdicts[key] = self._apart(a, b)
        return verdict

    def _apart(self, a: int, b: int) -> bool:
        """Whether no merge across the border comes before either of its pieces is absorbed."""
        right, left, merged = self._edge(a, 1), self._edge(b, 0), self.merged
        for x, x_gone in right:
            for y, y_gone in left:
                rank = merged(x, y)
                if rank < x_gone and rank <= y_gone and rank != NEVER:
                    return False
        return True

    @cached_property
    def tree(self) -> tuple[dict[int, int], list[tuple[int, bool]]]:
        """All tokens as a tree of bytes: children by ``place << 8 | byte``, and for each place the
        token that ends there (or -1) and whether any goes on."""
        children: dict[int, int] = {}
        tokens, inner = [-1], {0}
        for text, token in self.ids.items():
            place = 0
            for byte in text:
                inner.add(place)
                key = place << 8 | byte
                if key not in children:
                    children[key] = len(tokens)
                    tokens.append(-1)
                place = children[key]
            tokens[place] = token
        return children, [(token, place in inner) for place, token in enumerate(tokens)]
