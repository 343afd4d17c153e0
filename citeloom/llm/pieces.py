"""Splitting text into the pieces that byte-pair merges never cross, with a memo by word.

A lone space or line break between two words is always such a border, so a text is mostly a row
of words, and what a word encodes to can be remembered whole. Texts with other white space, or
with two white-space characters in a row, are split by the pattern from end to end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import regex

# Words remembered by one Python worker.
WORDS_KEPT = 1_000_000
# Longer words are not remembered.
WORD_LENGTH = 64


class Memo(dict):
    """Encoded words: a missing one is made by ``make`` and remembered within bounds.

    Words are kept in two generations of equal size. When the younger is full, the older is let go
    and the younger takes its place; a word met again moves back to the young. So a word in frequent
    use is never forgotten, whatever passes by that is met once.
    """

    def __init__(self, make: Callable[[str], object], kept: int = WORDS_KEPT):
        super().__init__()
        self.make = make
        self.half = max(1, kept // 2)
        self.old: dict = {}

    def __missing__(self, word: str):
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= WORD_LENGTH:
            if len(self) >= self.half:
                self.turn()
            self[word] = value
        return value

    def turn(self) -> None:
        """Let go of the older generation."""
        self.old = dict(self)
        self.clear()


class Pieces:
    """Cuts text by ``pattern``; ``special`` strings are kept whole."""

    def __init__(self, pattern: str, special: dict[str, int] | None = None):
        self.pattern = regex.compile(pattern)
        self.special = (
            regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)))
            if special
            else None
        )

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """``(is special, text)`` in order."""
        at = 0
        for match in self.special.finditer(text) if self.special else ():
            if match.start() > at:
                yield False, text[at : match.start()]
            yield True, match.group()
            at = match.end()
        if at < len(text):
            yield False, text[at:]

    def words(self, text: str) -> list[list[str]] | None:
        """Lines of words, where every border is a lone space or line break; else None."""
        lines = []
        for line in text.split("\n"):
            words = line.split(" ")
            if line.split() != words:
                return None
            lines.append(words)
        return lines
