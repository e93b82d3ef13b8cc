"""Whole texts to token ids with a public tokenizer file.

Most words of a corpus are met again and again, so each Python worker keeps the ids of those it
has met. A text in plain Latin letters is cut at white space; a new word is cut by the tokenizer
file's own pattern and goes through the library's model. Any other text goes through the library
whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

CACHED_WORDS = 600_000

# The word pattern of the tokenizer file, for lower-case text in code page
# ISO 8859-1, and the characters for which its normaliser only lowers the case.
WORD = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z0-9\xdf-\xf6\xf8-\xff]+")
PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xC0, 0x100)])
TO_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A or 0xC0 <= c <= 0xDE and c != 0xD7 else c for c in range(256))
# How byte-level vocabularies write a byte as a character: printable ones as themselves.
_HIDDEN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE)]
AS_CHARACTER = {b: chr(256 + n) for n, b in enumerate(_HIDDEN)}


class Encoder:
    """Token ids of whole texts as little-endian bytes, 16 bits each if the vocabulary allows."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.width = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[bytes, bytes] = {}

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.width).tobytes()

    def whole(self, text: str) -> bytes:
        return self._packed(self.library.encode(text, add_special_tokens=False).ids)

    def _word(self, chunk: bytes) -> bytes:
        """Ids of lower-case text without white space."""
        ids = []
        for word in WORD.findall(chunk):
            text = word.decode("latin-1")
            if not word.isascii():
                text = text.encode().decode("latin-1").translate(AS_CHARACTER)
            ids += [token.id for token in self.model.tokenize(text)]
        return self._packed(ids)

    def encode(self, text: str) -> bytes:
        """The ids of one text, without special tokens."""
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return self.whole(text)
        if "<|" in text or raw.translate(None, PLAIN):
            return self.whole(text)
        chunks = raw.translate(TO_LOWER).split()
        known = self.known
        try:
            return b"".join(map(known.__getitem__, chunks))
        except KeyError:
            new = {c for c in chunks if c not in known}
        if len(known) + len(new) > CACHED_WORDS:
            known.clear()
            new = set(chunks)
        known.update((c, self._word(c)) for c in new)
        return b"".join(map(known.__getitem__, chunks))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, kept from task to task."""
    return Encoder(path)
