"""The word tokenizer of the ``tokenizers`` library over whole text columns."""

from __future__ import annotations

import os
import struct

import numpy as np

from .segments import PieceEncoder, word_pieces

WORD_VOCABULARY = "word_bpe_49k.json"
_JOINED_CHARS = 20_000
_loaded: dict[str, "WordTokens"] = {}


def vocabulary_path(name: str = WORD_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordTokens:
    """Raw little-endian ids of texts; ``dtype`` is the narrowest that holds the vocabulary."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.alphabet = _byte_letters()
        self.encode_rows = PieceEncoder(word_pieces(specials), self._pieces, self.dtype.itemsize)

    @staticmethod
    def load(path: str) -> "WordTokens":
        """One per Python worker."""
        if path not in _loaded:
            _loaded[path] = WordTokens(path)
        return _loaded[path]

    def _pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece.

        A piece of letters only, none beyond Latin Extended-B, is one
        pre-token whatever stands beside it and needs no normalisation but
        lower case: the library's model alone gives its ids.  All others go
        through the whole tokenizer.
        """
        out: list[bytes | None] = [None] * len(pieces)
        rest, tokenize, letters, dtype = [], self.model.tokenize, self.alphabet, self.dtype
        pack = struct.Struct
        code = "H" if dtype.itemsize == 2 else "I"
        for i, piece in enumerate(pieces):
            word = piece.strip(b" ").decode("utf-8", "replace")
            if word.isascii():
                if not word.isalpha():
                    rest.append(i)
                    continue
            elif word.isalpha() and max(word) < "\u0250" and "\u0130" not in word:
                word = word.lower().encode().decode("latin-1").translate(letters)
            else:
                rest.append(i)
                continue
            ids = [t.id for t in tokenize(word)]
            out[i] = pack(f"<{len(ids)}{code}").pack(*ids)
        for i, ids in zip(rest, self._whole([pieces[i] for i in rest])):
            out[i] = ids
        return out

    def _whole(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece: many pieces in one text, told apart by the tokens' places."""
        out: list[bytes] = []
        texts = [p.decode("utf-8", "replace") for p in pieces]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        begins = np.concatenate([[0], np.cumsum(sizes)])
        at = 0
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(begins, begins[at] + _JOINED_CHARS, "right")) - 1)
            coded = self.tokenizer.encode(" ".join(texts[at:upto]), add_special_tokens=False)
            ids = np.array(coded.ids, self.dtype)
            places = np.array([o[0] for o in coded.offsets], np.int64)
            cuts = np.searchsorted(places, begins[at : upto + 1] - begins[at])
            raw, width = ids.tobytes(), self.dtype.itemsize
            out += [raw[a * width : b * width] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            at = upto
        return out
