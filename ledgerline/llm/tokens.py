"""Byte-level BPE token ids with a bounded word cache (used by packing).

The pre-tokenizer never joins a word with what follows a single space, so a
text may be cut before every space that stands between two non-space
characters, and each cut word has the same ids anywhere.  Words seen before
come from a cache of at most two generations; the cache changes the time
taken, never the ids.
"""

from __future__ import annotations

import base64
import re
from array import array

_WIDE = re.compile(r"\s\s|^\s|\s$")
_EDGE = re.compile(r"(?<=\S)(?= \S)")


#: The vocabulary's added token: its text inside a document is that one id, as the tokenizers library has it by default.
SPECIAL = ("<|endoftext|>", 50256)


class WordIds(dict):
    """Word (with its leading space) to its ids as little-endian unsigned 32-bit bytes.

    The text of ``special``, if given, is cut out before words are formed and stands for its id.
    """

    def __init__(self, encoding, limit: int = 250_000, special: tuple[str, int] | None = None):
        super().__init__()
        self.encoding, self.limit, self.old = encoding, limit, {}
        self.special = special and (special[0], array("I", [special[1]]).tobytes())

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = array("I", self.encoding.encode_ordinary(word)).tobytes()
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian unsigned 32-bit bytes."""
        if self.special and self.special[0] in text:
            return self.special[1].join(map(self._ordinary, text.split(self.special[0])))
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        if not text:
            return b""
        words = _EDGE.split(text) if "\0" in text or _WIDE.search(text) else text.replace(" ", "\0 ").split("\0")
        return b"".join(map(self.__getitem__, words))


def load(vocabulary: str | None = None, limit: int = 250_000) -> WordIds:
    """The vocabulary ``byte_bpe_50k`` from its rank file (``vocabulary``: another path), with its one special token."""
    import public_tokenizers as public
    import tiktoken

    path = vocabulary or public.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return WordIds(tiktoken.Encoding("words", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}), limit, SPECIAL)
