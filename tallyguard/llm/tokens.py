"""Ids of whole texts by the tokenizers library, words that come again looked up instead of encoded again."""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import regex

#: Pieces remembered by a worker before it starts anew, and their longest length. They bound memory only.
MEMORY_PIECES = 500_000
MEMORY_LENGTH = 40
#: The normalizer and splitter of the word-end tokenizer, under which blanks separate and vanish.
BLANKS_VANISH = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
PLAIN = regex.compile(r"[\x21-\x7e\xa1-\xff]+")


class Encoder:
    """Encodes a text to the bytes of its ids (little-endian, 32 bits).

    Under a tokenizer that lower-cases, splits at blanks and drops them, a Latin-1 text is the sequence of its
    blank-separated pieces, and each word of a piece goes through the library's model once. All other texts,
    tokenizers and texts that hold a special token's string are encoded whole by the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            text = file.read()
        self.library = Tokenizer.from_str(text)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.model = self.library.model
        self.pattern = regex.compile(BLANKS_VANISH["pattern"])
        self.by_piece = blanks_vanish(json.loads(text))
        split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_letters = str.maketrans({chr(i): split.pre_tokenize_str(chr(i))[0][0] for i in range(33, 256)})
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.id_bytes = [i.to_bytes(4, "little") for i in range(size)]
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {"": b""}

    def __call__(self, text: str) -> bytes:
        if not self.by_piece or not is_latin(text) or any(s in text for s in self.special):
            return self.whole(text)
        pieces = text.lower().replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ")
        known = self.pieces
        found = list(map(known.get, pieces))
        if None in found:
            for i in [i for i, ids in enumerate(found) if ids is None]:
                piece = pieces[i]
                found[i] = ids = known.get(piece) or self.piece(piece)
                if len(piece) <= MEMORY_LENGTH:
                    known[piece] = ids
        out = b"".join(found)
        self._forget()
        return out

    def _forget(self) -> None:
        if len(self.pieces) > MEMORY_PIECES:
            self.pieces = {"": b""}
        if len(self.words) > MEMORY_PIECES:
            self.words = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        if piece.isalpha():
            return self.word(piece)
        if piece[-1] in ".," and piece[:-1].isalpha():
            return self.word(piece[:-1]) + self.word(piece[-1])
        if PLAIN.fullmatch(piece):
            return b"".join([self.word(w) for w in self.pattern.findall(piece)])
        return self.whole(piece)

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            letters = word if word.isascii() else word.translate(self.byte_letters)
            found = b"".join([self.id_bytes[t.id] for t in self.model.tokenize(letters)])
            if len(word) <= MEMORY_LENGTH:
                self.words[word] = found
        return found


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def blanks_vanish(settings: dict) -> bool:
    """Whether the tokenizer is one whose blanks separate words and leave no ids."""
    normal = settings.get("normalizer") or {}
    split = ((settings.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    model = settings.get("model") or {}
    return (
        [n.get("type") for n in normal.get("normalizers", [])] == BLANKS_VANISH["normalizer"]
        and split.get("pattern", {}).get("Regex") == BLANKS_VANISH["pattern"]
        and split.get("behavior") == "Removed"
        and split.get("invert") is True
        and model.get("dropout") is None
        and all(not t.get("normalized") for t in settings.get("added_tokens", []))
    )


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder a worker and file; a worker that takes several tasks keeps what it has learnt."""
    return Encoder(path)
