"""Words and other units of whole texts; small helpers that run inside tasks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

GROUP_CHARS = 1 << 21  # of texts whose chunks are looked up together
# Of a generation, of which a worker remembers two.
KNOWN_CHUNKS, KNOWN_BYTES = 250_000, 64 << 20
LONGEST_KNOWN = 200  # characters of a remembered chunk
ENTRY_BYTES = 200  # of a remembered chunk, beside its characters and codes

# The white space that separates words, and the characters counted as symbols.
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"

# Where a text must not be cut: a space or line end beside other white space (by anyone's
# definition), and a stop or comma that does not follow a letter or digit.
_SPACE = "\\s\x85\u180e\u200b\ufeff"
_UNSAFE_SPACE = re.compile(f" (?:[{_SPACE}]|$)")
_UNSAFE_LINE = re.compile(f"\n(?:(?<=[{_SPACE}]\n)|(?=[{_SPACE}]|$))")
_UNSAFE_STOP = re.compile(r"[.,](?<![^\W_][.,])")
CUT = "\0"
_WORD = re.compile(f" ?[^{_SPACE}]+")


def words(text: str) -> list[bytes]:
    """The maximal runs without white space, as UTF-8."""
    return text.encode().split()


def is_word(chunk: str) -> bool:
    """Whether a chunk has no white space, but for one space before it."""
    return _WORD.fullmatch(chunk) is not None


def chunks(text: str) -> list[str]:
    """Cut a text into pieces that join to it and repeat from text to text, words for the most part.

    The tokenizers' splitting pattern gives the same pieces for a whole text as for these chunks one
    by one. It gives a space to the run after it, so a cut before a space is safe if no other white
    space is next to it; a single line end stands alone; and a run of letters or digits ends
    before a stop or comma. Texts in which one of these is not clear are not cut there.
    """
    return [text] if CUT in text else list(filter(None, marked(text).split(CUT)))


def marked(text: str) -> str:
    """A text without CUT, with CUT between its chunks (and in places twice, or at an edge)."""
    cut = text
    if "\n" in text and not _UNSAFE_LINE.search(text):
        cut = cut.replace("\n", "\0\n\0")
    if not _UNSAFE_STOP.search(text):
        cut = cut.replace(".", "\0.").replace(",", "\0,")
    if not _UNSAFE_SPACE.search(text):
        cut = cut.replace(" ", "\0 ")
    else:
        cut = _single_spaces(cut)
    return cut


def _single_spaces(text: str) -> str:
    """Mark cuts before the spaces that have none of the unsafe neighbours."""
    first, *rest = text.split(" ")
    marked = [first]
    for piece in rest:
        safe = not _UNSAFE_SPACE.match(" " + piece.lstrip(CUT)[:1])
        marked.append(("\0 " if safe else " ") + piece)
    return "".join(marked)


class ChunkMemory:
    """Encodes texts chunk by chunk and remembers what chunks encode to, within a bound of bytes.

    `learn` encodes distinct chunks, at most `at_once` in a call. Long chunks, such as texts without
    spaces, are encoded anew for each group of texts.
    """

    def __init__(self, learn: Callable[[list[str]], Iterable[bytes]], at_once: int,
                 known_bytes: int | None = None):
        self.learn, self.at_once, self.known_bytes = learn, at_once, known_bytes or KNOWN_BYTES
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """What each whole text encodes to; a null text is the empty one."""
        found: list[bytes] = []
        group: list[list[str]] = []
        size = 0
        for text in texts:
            group.append(chunks(text or ""))
            size += len(text or "")
            if size >= GROUP_CHARS:
                found += self._group(group)
                group, size = [], 0
        return found + self._group(group)

    def _forget(self) -> None:
        """What no text asks for again goes, once a generation is full."""
        if len(self.known) > KNOWN_CHUNKS or self.held > self.known_bytes:
            self.known, self.older, self.held = {}, self.known, 0

    def codes(self, chunks: list[str]) -> list[bytes]:
        """What each of some distinct chunks encodes to."""
        self._forget()
        known, older = self.known, self.older
        coded = list(map(known.get, chunks))
        asked = [at for at, code in enumerate(coded) if code is None]
        new = []
        for at in asked:
            code = coded[at] = older.get(chunks[at])
            if code is None:
                new.append(at)
        for low in range(0, len(new), self.at_once):
            some = new[low:low + self.at_once]
            for at, code in zip(some, self.learn([chunks[at] for at in some])):
                coded[at] = code
        for at in asked:
            chunk, code = chunks[at], coded[at]
            if len(chunk) <= LONGEST_KNOWN:
                known[chunk] = code
                self.held += 4 * len(chunk) + len(code) + ENTRY_BYTES
        return coded

    def _group(self, parts: list[list[str]]) -> list[bytes]:
        self._forget()
        known, older = self.known, self.older
        new = set().union(*parts).difference(known)
        found = {chunk: older[chunk] for chunk in filter(older.__contains__, new)}
        waiting = list(new.difference(found))
        for low in range(0, len(waiting), self.at_once):
            some = waiting[low:low + self.at_once]
            found.update(zip(some, self.learn(some)))
        known.update(found)
        coded = [b"".join(map(known.__getitem__, part)) for part in parts]
        for chunk in [chunk for chunk in found if len(chunk) > LONGEST_KNOWN]:
            del known[chunk], found[chunk]
        self.held += (4 * sum(map(len, found)) + sum(map(len, found.values()))
                      + ENTRY_BYTES * len(found))
        return coded
