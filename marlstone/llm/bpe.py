"""Token ids of a public byte-level BPE vocabulary, by words and a bounded memory of words already encoded.

The vocabulary's pre-tokeniser never joins two words over a space: each piece takes at most one space, in front. So where
no two white-space characters stand side by side, encoding the stretches between spaces one by one, each with its
space, gives the ids of the whole text. Other texts are encoded whole.
"""

from __future__ import annotations

import base64
import re
from array import array

SPACES = re.compile(r"\s\s")
REMEMBERED = 120_000  # words; later ones are encoded each time
LONGEST = 64  # characters of a word that is remembered


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Place of a vocabulary file; only this looks for the package that holds them."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Words(dict):
    """word -> its ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(word)).tobytes()
        if len(self) < REMEMBERED and len(word) <= LONGEST:
            self[word] = ids
        return ids


class Encoder:
    """Ids of texts. ranks: the vocabulary as a file of ranks, the same ids as its JSON form gives."""

    def __init__(self, ranks: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.core = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.words = Words(self.core._core_bpe.encode_ordinary)
        self.byte_length = [0] * (max(table.values()) + 1)
        for token, rank in table.items():
            self.byte_length[rank] = len(token)

    def ids(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit numbers."""
        if SPACES.search(text) or "\x00" in text:
            return array("I", self.core.encode_ordinary(text)).tobytes()
        first, *rest = text.replace("\n", " \n").split(" ")
        # a stretch that begins with a line break has no space of its own in front
        rest = [x if x[:1] == "\n" else " " + x for x in rest]
        return self.words[first] + b"".join(map(self.words.__getitem__, rest))


_encoders: dict[str, Encoder] = {}


def encoder(ranks: str | None) -> Encoder:
    """One encoder for each worker process and vocabulary; without one named, the usual one, looked for where the worker runs."""
    ranks = ranks or vocabulary()
    if ranks not in _encoders:
        _encoders[ranks] = Encoder(ranks)
    return _encoders[ranks]
