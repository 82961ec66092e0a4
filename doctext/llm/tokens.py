"""Fast exact token ids of a byte-level vocabulary file.

Words repeat, so ids are looked up per space-separated word; the library's
own pre-tokeniser and model are asked only for words not seen yet.  A space
between two words always starts a new pre-token, so the parts join exactly;
texts where a space touches other white space take a slower exact split.
"""

from __future__ import annotations

import re
import sys
from array import array

import numpy as np

assert sys.byteorder == "little" and array("I").itemsize == 4

_WS = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
#: Words of one generation of the table.  A full table becomes the old one,
#: from which words still in use are taken over: memory stays bounded and
#: frequent words stay known.
MAX_WORDS = 400_000
#: Marks that make one pre-token when they end a word (no apostrophe, which
#: may start a contraction).
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class _Uneven(Exception):
    """A space touches other white space."""


class _Words(dict):
    """Ids (little-endian 32-bit) of a word after a single space."""

    def __init__(self, owner: "Encoder"):
        super().__init__()
        self.owner, self.old = owner, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            core = word.rstrip(_TAIL)
            if core.isalpha():
                if len(core) < len(word):
                    ids = self[core] + self.owner.tail(word[len(core):])
                elif core.isascii():
                    ids = self.owner.model_ids("Ġ" + core)
                else:
                    ids = self.owner.chunk(" " + word)
            else:
                parts = word.split()
                if len(parts) != 1 or parts[0] != word:
                    if not word or word[0].isspace() or word[-1].isspace():
                        raise _Uneven
                    if word.count("\n") == len(parts) - 1 and word.isascii():
                        # One line end between words: a pre-token by itself.
                        first, *rest = word.split("\n")
                        return self[first] + b"".join([self.owner.tail("\n") + self.owner.start(w) for w in rest])
                    return self.owner.chunk(" " + word)
                ids = self.owner.chunk(" " + word)
        if len(self) >= MAX_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.pre, self.model = self.tok.pre_tokenizer, self.tok.model
        self.plain = self.tok.normalizer is not None or type(self.pre).__name__ != "ByteLevel"
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.tails: dict[str, bytes] = {}
        self.words = _Words(self)

    def model_ids(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def chunk(self, text: str) -> bytes:
        return b"".join([self.model_ids(piece) for piece, _ in self.pre.pre_tokenize_str(text)])

    def tail(self, text: str) -> bytes:
        """Ids of a pre-token that follows a word without a space."""
        ids = self.tails.get(text)
        if ids is None:
            if len(self.tails) >= MAX_WORDS:
                self.tails.clear()
            ids = self.tails[text] = self.chunk(text)
        return ids

    def start(self, word: str) -> bytes:
        """Ids of a word that starts a line."""
        core = word.rstrip(_TAIL)
        if core.isalpha() and len(core) < len(word):
            return self.tail(core) + self.tail(word[len(core):])
        return self.tail(word)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if self.plain or any(a in text for a in self.added):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        first, *rest = text.split(" ")
        try:
            if not first or first[0].isspace() or first[-1].isspace():
                raise _Uneven
            return self.chunk(first) + b"".join(map(self.words.__getitem__, rest))
        except _Uneven:
            return b"".join(map(self.chunk, _CHUNK.findall(text)))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
