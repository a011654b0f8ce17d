"""Token ids of whole texts by a public tokenizer file, with a bounded cache of words."""

from __future__ import annotations

import json
import string
from array import array

import numpy as np

#: Words a worker remembers; beyond that it starts anew.
CACHED_WORDS = 600_000


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: bytes that print
    stand for themselves, the others for the letters from U+0100 on, in order."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [byte for byte in range(256) if byte not in prints]
    return {byte: 0x100 + n for n, byte in enumerate(hidden)}


_SHOWN = _byte_letters()


def _pieces(text: str) -> list[str]:
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


class WordTokenizer:
    """Encodes texts as the file's tokenizer does, white-space piece by piece.

    Only for a byte-level tokenizer that composes characters, lowers case, drops white
    space and never joins across it nor from letters to marks, so that a text's ids are
    those of its pieces one after the other.  A file whose steps are others is refused.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        steps = json.loads(self.whole.to_str())
        kinds = [s["type"] for s in (steps["normalizer"] or {}).get("normalizers", [])]
        cuts = [s["type"] for s in (steps["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or cuts != ["Split", "ByteLevel"]:
            raise ValueError(f"{path} prepares texts by {kinds} and {cuts}, which is not known here")
        self.added = [token["content"].lower() for token in steps["added_tokens"]]
        self.words: dict[str, bytes] = {"": b""}
        self.letters: dict[str, bytes] = {}

    def _letters(self, word: str) -> bytes:
        """The ids of a lower-case word of letters below U+0300, asked of the model alone."""
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(_SHOWN)
        ids = self.letters[word] = array("H", [token.id for token in self.model.tokenize(spelled)]).tobytes()
        return ids

    def _several(self, pieces: list[str]) -> list[bytes]:
        """The ids of any pieces, asked for in one call and told apart by their places."""
        encoded = self.whole.encode(" ".join(pieces), add_special_tokens=False)
        ids = np.array(encoded.ids, np.uint16)
        starts = np.array([o[0] for o in encoded.offsets], np.int64)
        cuts = np.searchsorted(starts, np.cumsum([len(p) + 1 for p in pieces])).tolist()
        return [ids[low:high].tobytes() for low, high in zip([0, *cuts], cuts)]

    def _learn(self, pieces: set[str], plain: bool) -> None:
        """Remember pieces; ``plain`` ones are of lower-case characters below U+0100."""
        others, words, known = [], self.words, self.letters.get
        for piece in pieces:
            word = piece.rstrip(string.punctuation)
            # Below U+0300 nothing is composed, and only one letter grows in lower case.
            if word.isalpha() and (
                    plain or word.isascii() or max(word) < "\u0300" and "\u0130" not in word):
                lower = word if plain else word.lower()
                ids = known(lower) or self._letters(lower)
                words[piece] = ids if len(word) == len(piece) else ids + self._marks(piece[len(word):])
            else:
                others.append(piece)
        for piece, ids in zip(others, self._several(others) if others else []):
            words[piece] = ids

    def _marks(self, marks: str) -> bytes:
        """The ids of a run of punctuation marks."""
        if marks not in self.words:
            self.words[marks] = self._several([marks])[0]
        return self.words[marks]

    def _plain(self, text: str) -> str | None:
        """The text in lower case if each letter stays one; a word is then remembered in one spelling."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        lower = text.lower()
        # Tokens that the file adds are found as they are written.
        return None if any(token in lower for token in self.added) else lower

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 16-bit numbers."""
        lower = self._plain(text)
        pieces = _pieces(text if lower is None else lower)
        new = set(pieces).difference(self.words)
        if new:
            if len(self.words) + len(new) > CACHED_WORDS:
                self.words, self.letters, new = {"": b""}, {}, {*pieces} - {""}
            self._learn(new, lower is not None)
        return b"".join(map(self.words.__getitem__, pieces))


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer of this file."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
