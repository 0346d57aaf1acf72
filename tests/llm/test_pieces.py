import hashlib
import random

import pytest
import sentencepiece
from public_tokenizers import path

from llm_rows import LONG, ROWS, by
from tallyguard.llm import pieces
from tallyguard.llm.pieces import PieceModel, encode_pieces

FILE = path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return PieceModel(FILE)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


ODD = [
    "", " ", "  a  b", "\n\na\tb \n c", "中文字符 ñ é ﬁ ½ \x00 ▁x▁▁ y", "🙂🙃 a🙂b", "<s> </s> <unk> <0x0A>", "a" * 16, "x" * 500,
    " " * 40 + "x", "é", "　a", "a\r\nb", "﻿a", "​", "\x7f\x1c", "⁇ a", LONG,
]


def test_ids_and_texts_are_the_library_s(model, library):
    random.seed(1)
    texts = ODD + ["".join(random.choices("ab teins ▁.\n1é中", k=random.randint(1, 60))) for _ in range(3000)]
    for text in texts:
        ids = library.encode(text)
        assert model.encode(text) == ids, text[:80]
        assert model.decode(ids) == library.decode(ids)
        assert model.round_trip(text) == (",".join(map(str, ids)), library.decode(ids))


def test_any_ids_decode_as_the_library_does(model, library):
    random.seed(2)
    for _ in range(300):
        ids = [random.choice([*range(3, 259), *range(259, 2000)]) for _ in range(random.randint(1, 12))]
        assert model.decode(ids) == library.decode(ids), ids


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(pieces, "MEMORY_UNITS", 3)
    monkeypatch.setattr(pieces, "MEMORY_PAIRS", 3)
    small = PieceModel(FILE)
    for text in ["some words and some more words of some kind", "more of some"] * 3:
        assert small.round_trip(text)[0] == ",".join(map(str, library.encode(text)))


def test_rows(odd, none, library):
    def digest(text):
        ids = library.encode(text or "")
        codes = ",".join(map(str, ids))
        return len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in (codes, library.decode(ids))]

    wanted = sorted([(i, *digest(t)) for i, t, _ in ROWS], key=lambda t: tuple((x is None, str(x)) for x in t))
    assert by(encode_pieces(odd, FILE), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == wanted
    assert encode_pieces(none, FILE).count() == 0
    row = encode_pieces(odd, FILE, with_ids=True).where("doc_id = 1").first()
    assert row["ids"] == library.encode(ROWS[0][1]) and row["decoded"] == ROWS[0][1]
