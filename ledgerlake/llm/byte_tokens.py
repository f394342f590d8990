"""The byte-level tokenizer of the ``tokenizers`` library over whole text columns."""

from __future__ import annotations

import os
import struct

import numpy as np

from .segments import PieceEncoder, spaced_words
from .word_tokens import _byte_letters

BYTE_TOKENIZER = "byte_bpe_50k.json"
_loaded: dict[str, "ByteTokens"] = {}


class ByteTokens:
    """Raw little-endian ids of texts; ``dtype`` is the narrowest that holds the vocabulary.

    Texts are cut before a lone space between two visible characters: the
    pre-tokenizer always starts a match there, and a special token's literal
    has no space, so the pieces' ids are the text's.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.space = _byte_letters()[32]
        self.encode_rows = PieceEncoder(spaced_words, self._pieces, self.dtype.itemsize)

    @staticmethod
    def load(path: str) -> "ByteTokens":
        """One per Python worker."""
        if path not in _loaded:
            _loaded[path] = ByteTokens(path)
        return _loaded[path]

    def _pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece; ASCII letters after at most one space are one pre-token, all else goes through the whole tokenizer."""
        out: list[bytes | None] = [None] * len(pieces)
        rest, tokenize, space = [], self.tokenizer.model.tokenize, self.space
        code = "H" if self.dtype.itemsize == 2 else "I"
        for i, piece in enumerate(pieces):
            word = piece[1:] if piece[:1] == b" " else piece
            if not (word.isascii() and word.isalpha()):
                rest.append(i)
                continue
            shown = word.decode() if word is piece else space + word.decode()
            ids = [t.id for t in tokenize(shown)]
            out[i] = struct.pack(f"<{len(ids)}{code}", *ids)
        coded = self.tokenizer.encode_batch([pieces[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False)
        for i, c in zip(rest, coded):
            out[i] = struct.pack(f"<{len(c.ids)}{code}", *c.ids)
        return out
