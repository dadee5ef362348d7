"""Token ids of whole texts, by a public tokenizer and a bounded cache of encoded segments.

A byte-level or word-end vocabulary never merges across the space that starts
a new word, so a text can be cut there, each distinct segment encoded once by
the tokenizers library, and the ids put together again. Where a cut could
change the ids (two white-space characters side by side in a vocabulary that
keeps white space) the text is encoded in one piece. So is a text that holds a
special token literally: the library gives it the token's id.

A new segment of Latin letters, with or without punctuation behind them, is
looked up by its letters (in lower case where the vocabulary has no other), and
new letters go straight to the library's merge model, since its normalizing and
splitting would leave them as they are. Whether a vocabulary allows that is
tried out when it is loaded.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from weekloom.llm.bpe import byte_letters

# Distinct segments a task keeps, in each of two generations, where it is not told how many.
CACHE_SEGMENTS = 600_000
# Characters of the texts that are taken together.
BLOCK_CHARS = 1 << 20
# A mark or line break, letters that neither composition nor lower case changes into something else than one letter, ASCII punctuation.
PLAIN = re.compile(r"([\x00\n])?([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-&(-/:-@\[-`{-~]+)?")
WHITE_PAIR = re.compile(r"\s\s")
_ENCODERS: dict[tuple[str, bool], "Encoder"] = {}


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, special_as_text: bool = False) -> "Encoder":
    """One encoder per worker process and file."""
    if (path, special_as_text) not in _ENCODERS:
        _ENCODERS[path, special_as_text] = Encoder(path, special_as_text)
    return _ENCODERS[path, special_as_text]


@contextmanager
def encoding(path: str, special_as_text: bool = False, segments: int | None = None) -> Iterator["Encoder"]:
    """The worker's encoder for one task, which keeps so many ``segments`` in each generation.

    The segments it has seen go with the task: a worker lives on, and what it
    holds would be missing in the next stage, whatever that does.
    """
    found = encoder(path, special_as_text)
    found.segments = segments
    try:
        yield found
    finally:
        found.forget()


class Segments(dict):
    """Ids of the segments seen, and a way to those of a new one."""

    def __init__(self, learn: Callable[[str], bytes]):
        super().__init__()
        self.learn = learn

    def __missing__(self, segment: str) -> bytes:
        found = self[segment] = self.learn(segment)
        return found


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, as the library gives them.

    With ``special_as_text`` special tokens written in a text are ordinary text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [] if special_as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokenizer.encode_special_tokens = special_as_text
        self.merged = self.tokenizer.model.tokenize
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # A vocabulary that drops white space encodes "a" and " a" alike.
        self.drops_space = self._raw([" a"]) == self._raw(["a"])
        self.segments: int | None = None
        self.young, self.old = Segments(self._learn), {}
        self._try_out()

    def forget(self) -> None:
        """Let all segments go."""
        self.young, self.old = Segments(self._learn), {}

    def _raw(self, texts: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _try_out(self) -> None:
        """Whether letters may be looked up in lower case, and whether they may go to the merge model by themselves."""
        words, tails = ["a", "Tree", "qxzvkw", "\u00c9t\u00e9", "\u0178\u00df\u0131"], ["", ".", "?!", "(_", ">>|"]
        marks = [""] if self.drops_space else ["", "\x00", "\n"]
        self.folds = all(self._alone(w) == self._alone(w.lower()) for w in words)
        self.splits = True
        self.splits = all(self._learn(m + w + t) == self._alone(m + w + t) for m in marks for w in words for t in tails)
        self.young.clear()

    def _alone(self, segment: str) -> bytes:
        # A marked segment is the start of a text or line and has no space in front.
        return self._raw([segment if self.drops_space or segment[:1] == "\n" else segment[1:] if segment[:1] == "\x00" else " " + segment])[0]

    def _letters(self, word: str, space: bool) -> bytes:
        """Ids of letters alone or after a space, by the library's merge model."""
        written = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.merged("\u0120" + written if space else written)]).tobytes()

    def _learn(self, segment: str) -> bytes:
        """Ids of a segment that the young generation does not hold."""
        known = self.old.get(segment)
        if known is not None:
            return known
        if self.splits and segment.isascii() and segment.isalpha():
            # Most new segments: what follows would find the letters alone.
            key = segment.lower() if self.folds and self.drops_space else segment
            return self.young[key] if key != segment else self._letters(segment, not self.drops_space)
        found = PLAIN.fullmatch(segment) if self.splits else None
        if not found or (found[1] and self.drops_space):
            return self._alone(segment)
        mark, word, tail = found.groups()
        if self.drops_space:
            key = word.lower() if self.folds else word
            letters = self._letters(key, False) if key == segment else self.young[key]
            return letters + self.young[tail] if tail else letters
        if mark == "\n":
            return self.young["\n"] + self.young["\x00" + segment[1:]]
        if tail:
            return self.young[segment[:-len(tail)]] + self.young["\x00" + tail]
        return self._letters(word, not mark)

    def _segments(self, text: str) -> list[str] | None:
        if any(t in text for t in self.special):
            return None
        if self.drops_space:
            return text.replace("\n", " ").split(" ")
        if "\x00" in text or WHITE_PAIR.search(text):
            return None
        parts = text.replace("\n", " \n").split(" ")
        parts[0] = "\x00" + parts[0]
        if text[:1] == "\n":
            parts = parts[1:]  # the text starts with its line break, nothing stands before it
        return parts

    def each(self, texts: Sequence[str]) -> Iterator[bytes]:
        """Ids of each text in turn; a block of texts is cut at a time."""
        block: list[str] = []
        held = 0
        for k, text in enumerate(texts):
            block.append(text)
            held += len(text)
            if held >= BLOCK_CHARS or k == len(texts) - 1:
                cut = [self._segments(t) for t in block]
                whole = [t for t, c in zip(block, cut) if c is None]
                if len(self.young) > (self.segments or CACHE_SEGMENTS):
                    self.old, self.young = self.young, Segments(self._learn)
                of, others = self.young.__getitem__, iter(self._raw(whole) if whole else [])
                for c in cut:
                    yield next(others) if c is None else b"".join(map(of, c))
                block, held = [], 0

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text."""
        return list(self.each(texts))
