"""Whole texts to token ids through the tokenizers library, each distinct piece encoded once.

Both vocabularies in use split a text at white space before they merge, and
between a letter or digit and plain punctuation, so a text is cut there first
and the library sees a distinct piece once per Python worker. A single space
stays with the piece after it, as the byte-level split has it; a longer run
leaves its last space to the next piece. Where white space has no ids it is
left out.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np

# The White_Space characters of Unicode, and the form of a piece.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LATIN = "A-Za-z0-9\xc0-\xd6\xd8-\xf6\xf8-\u024f"
WORD = f"[{LATIN}]++(?=[.,;:!?{SPACES}]|\\Z)"  # letters and digits before plain punctuation end a piece in either vocabulary
PIECE = re.compile(f" ?{WORD}| ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
SOLID = re.compile(f"{WORD}|[^{SPACES}]+")  # where white space has no ids


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def lower_latin(text: str) -> str:
    """A Latin-1 text in lower case, any other as it is.

    Where a vocabulary lower-cases anyway, its pieces then recur more often;
    within Latin-1 there is only one way to lower-case.
    """
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


class PieceEncoder:
    """Encodes texts with one vocabulary file and remembers the ids of pieces.

    ``keep`` bounds how many pieces are remembered; past it the later half
    goes (frequent pieces are met early), which costs time only.
    ``PieceEncoder.of`` keeps one encoder per vocabulary in a Python worker,
    for all the tasks it runs. A text that holds the string of an added token
    is encoded by one plain call.
    """

    open: dict[str, PieceEncoder] = {}

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        if path not in cls.open:
            cls.open[path] = cls(path)
        return cls.open[path]

    def __init__(self, path: str, keep: int = 1_200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.pieces = (PIECE if self.plain(" ") else SOLID).findall
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added)).search if added else lambda text: None
        self.fold = self.folded if self.plain("A\xc9") == self.plain("a\xe9") else str
        self.keep, self.known = keep, {}

    def plain(self, text: str) -> list[int]:
        """The ids of a whole text by one call of the library."""
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, fresh: list[str]) -> None:
        """Remember the ids of new pieces, which hold no string of an added token."""
        code = self.dtype.char
        for k in range(0, len(fresh), 4096):
            part = fresh[k : k + 4096]
            for piece, got in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[piece] = array(code, got.ids).tobytes()

    def folded(self, text: str) -> str:
        """The text in lower case, unless that makes the string of an added token."""
        lower = lower_latin(text)
        return text if self.added(lower) else lower

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text in ``dtype``; a null text is empty."""
        known, dtype = self.known, self.dtype
        for at in range(0, len(texts), 64):
            some = texts[at : at + 64]
            whole = [t if t and self.added(t) else None for t in some]
            cut = [self.pieces(self.fold(t)) if t and not w else [] for t, w in zip(some, whole, strict=True)]
            if len(known) > self.keep:
                for piece in list(islice(reversed(known), self.keep // 2)):
                    del known[piece]
            fresh = {p for pieces in cut for p in pieces if p not in known}
            if fresh:
                self.learn(list(fresh))
            for text, pieces in zip(whole, cut, strict=True):
                yield np.array(self.plain(text), dtype) if text else np.frombuffer(b"".join(map(known.__getitem__, pieces)), dtype)


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
