"""Encode whole texts by way of a bounded cache of their parts.

Byte-pair encoders cut a text by a pattern and encode each match by itself. Natural text repeats its
words, so a worker keeps the ids of parts that it has met. A part ends before a space that stands
alone between two other characters: whatever follows, the pattern starts a match there. A part is
kept when it is met for the second time, so the many that occur once do not displace the others.

A worker process outlives its tasks, and while it waits, stages that need no Python run beside it. So a task ends with
`forget`, which gives up the cache; the next one fills it anew.
"""

import gc
import re
from collections.abc import Callable, Iterator

#: Entries of a worker's cache, marks for parts met before, and characters looked up at a time.
CACHE_ENTRIES, MARKS, SLICE_CHARS = 600_000, 1 << 22, 3_000_000
#: Entries of a generation of `PartCache`, and the characters of the longest part that is kept.
GENERATION, LONGEST = 300_000, 64


class PretokenCache:
    """`encode_words` turns matches of the pattern into their ids, as bytes."""

    def __init__(self, pattern: str, encode_words: Callable[[list[str]], list[bytes]]):
        import regex

        self.encode_words = encode_words
        self.split = regex.compile(pattern).findall
        # All that the pattern's white space holds, and a little more.
        self.space_run = re.compile(r"\s\s").search
        self.lone_space = regex.compile(r"(?<=\S) (?=\S)").split
        self.edge_space = regex.compile(r"^\s|\s\Z").search
        self.parts: dict[str, bytes] = {}  # by a part without the space before it
        self.marks = bytearray(MARKS)

    def forget(self) -> None:
        self.parts.clear()
        self.marks = bytearray(MARKS)

    def _cut(self, text: str) -> list[str]:
        if self.edge_space(text) or self.space_run(text):
            return self.lone_space(text)
        return text.split(" ")

    def _matches(self, part: str) -> list[str]:
        """The pattern's matches in a part and the space before it."""
        if part.isalpha():
            return [" " + part]
        if part[-1] in ".,;:" and part[:-1].isalpha():
            return [" " + part[:-1], part[-1]]
        return self.split(" " + part)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text; whole texts, in slices of a bounded size unless one is longer."""
        start = 0
        while start < len(texts):
            end, chars = start, 0
            while end < len(texts) and (end == start or chars + len(texts[end]) <= SLICE_CHARS):
                chars += len(texts[end])
                end += 1
            gc.disable()  # very many small lists, none of them in a cycle
            try:
                ids = self._slice(texts[start:end])
            finally:
                gc.enable()
            yield from ids
            start = end

    def _slice(self, texts: list[str]) -> list[bytes]:
        cut = [self._cut(t) for t in texts]
        first = [self.split(parts.pop(0)) for parts in cut]
        known, marks = self.parts, self.marks
        found = [list(map(known.get, parts)) for parts in cut]  # None for a part not met yet
        gaps = [[i for i, ids in enumerate(f) if ids is None] if None in f else () for f in found]
        missing = {parts[i] for parts, gap in zip(cut, gaps) for i in gap}
        matches = {p: self._matches(p) for p in missing}
        new = list({w for m in (*first, *matches.values()) for w in m})
        words = dict(zip(new, self.encode_words(new)))
        learned = {p: b"".join([words[w] for w in m]) for p, m in matches.items()}
        for parts, ids, gap in zip(cut, found, gaps):
            for i in gap:
                p = parts[i]
                ids[i] = learned[p]
                mark = hash(p) & (MARKS - 1)
                if marks[mark]:
                    known[p] = learned[p]
                else:
                    marks[mark] = 1
        result = [
            b"".join([words[w] for w in m]) + b"".join(ids) for m, ids in zip(first, found)
        ]
        # When full, keep what this slice used: the frequent parts are among it.
        if len(known) > CACHE_ENTRIES:
            self.parts = {p: known[p] for parts in cut for p in parts if p in known}
            self.marks = bytearray(MARKS)
        return result


class _Known(dict):
    """Values made when asked for, in two generations: what is used of the older one moves to the newer, and the rest goes
    when the newer one is full."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST:
            self[key] = value
        return value

    def bound(self, entries: int) -> None:
        if len(self) > entries:
            self.older = dict(self)
            self.clear()

    def forget(self) -> None:
        self.clear()
        self.older.clear()


class PartCache:
    """Ids of texts by way of their parts, each looked up once.

    `encode_word` gives the ids of a match of the pattern, `encode_letters` those of ASCII letters and the space before them.
    `entries`: those of a generation.
    """

    def __init__(
        self, pattern: str, encode_word: Callable[[str], bytes], encode_letters: Callable[[str], bytes], entries: int | None = None
    ):
        self.cutter, self.entries = PretokenCache(pattern, lambda words: []), entries or GENERATION
        self.encode_word, self.encode_letters = encode_word, encode_letters
        self.words, self.parts = _Known(encode_word), _Known(self._part)
        self.beside_space = re.compile(r" \s|\s ").search

    def forget(self) -> None:
        self.words.forget()
        self.parts.forget()

    def _cut(self, text: str) -> list[str]:
        """Cut before each space that stands alone between two other characters."""
        if text[:1] == " " or text[-1:] == " " or "  " in text:
            return self.cutter.lone_space(text)
        rare = "\n " in text or " \n" in text or "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text
        if (rare or not text.isascii()) and self.beside_space(text):
            return self.cutter.lone_space(text)
        return text.split(" ")

    def _part(self, part: str) -> bytes:
        """The ids of a part and the space before it."""
        if part.isalpha():
            return self.encode_letters(part) if part.isascii() else self.encode_word(" " + part)
        if part[-1] in ".,;:" and part[:-1].isalpha():
            return self.parts[part[:-1]] + self.words[part[-1]]
        return b"".join(map(self.words.__getitem__, self.cutter.split(" " + part)))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        word, part, split = self.words.__getitem__, self.parts.__getitem__, self.cutter.split
        for text in texts:
            parts = self._cut(text)
            first = split(parts.pop(0))
            yield b"".join(map(word, first)) + b"".join(map(part, parts))
            self.parts.bound(self.entries)
            self.words.bound(self.entries)
