"""SentencePiece BPE encoding by a table of each prefix's last token, and decoding."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.base import ship

SPACE = "▁"
#: Entries remembered by a worker before it starts anew, and the longest unit remembered; they bound memory only.
MEMORY_UNITS = 200_000
MEMORY_PAIRS = 400_000
MEMORY_LENGTH = 40


class PieceModel:
    """Encoder and decoder of one BPE model file with byte fallback.

    A prefix of a BPE encoding is the encoding of a prefix, so every prefix of a text has one last token. It is
    the one token, among those that an automaton finds ending there, that is compatible with the last token
    of the prefix before it: two tokens are compatible if merging their characters gives the two again.
    The ids are then read backwards from the end.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        special = {i for i in range(size) if self.library.is_control(i) or self.library.is_unknown(i)}
        self.bytes = {}
        self.pieces = [self.library.id_to_piece(i) for i in range(size)]
        self.lengths = [len(p) for p in self.pieces]
        self.ids, self.rank = {}, {}
        for i, piece in enumerate(self.pieces):
            if self.library.is_byte(i):
                self.bytes[i] = int(piece[3:5], 16)
            elif i not in special and not self.library.is_unused(i):
                self.ids[piece] = i
                self.rank[piece] = -self.library.get_score(i)
        self.byte_ids = {b: i for i, b in self.bytes.items()}
        self.unknown = self.library.unk_id()
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merged(piece) == [piece]:
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        single = {p for p in self.ids if len(p) == 1}
        self.known = single
        self.atoms = re.compile("[^" + "".join(re.escape(c) for c in sorted(single)) + "]")
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        joined = "\n" in "".join(self.ids)
        self.units = re.compile(r"(?s).+" if inner else r"▁+[^▁]*|[^▁]+" if joined else r"▁+[^▁\n]*|[^▁\n]+|\n")
        self.plain = not self.library.normalize("ﬁ½  Å\t　 a ") != SPACE + "ﬁ½  Å\t　 a ".replace(" ", SPACE)
        self.pairs: dict[int, bool] = {}
        self.memory: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces that merging gives: always the adjacent pair whose union ranks first, leftmost on a tie."""
        parts = list(text)
        while True:
            ranks = [self.rank.get(a + b) for a, b in zip(parts, parts[1:])]
            found = [r for r in ranks if r is not None]
            if not found:
                return parts
            at = ranks.index(min(found))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        a, b = self.pieces[left], self.pieces[right]
        if len(self.pairs) > MEMORY_PAIRS:
            self.pairs.clear()
        out = self.pairs[left << 32 | right] = self.merged(a + b) == [a, b]
        return out

    def segment(self, text: str) -> list[int]:
        """Ids of a text whose characters are all pieces."""
        last = [-1] * len(text)
        known = self.pairs.get
        for end, (token, length) in self.automaton.iter(text):
            if last[end] < 0:
                before = end - length
                if before < 0:
                    last[end] = token
                elif (left := last[before]) >= 0:
                    fits = known(left << 32 | token)
                    if self.compatible(left, token) if fits is None else fits:
                        last[end] = token
        ids, end = [], len(text) - 1
        lengths = self.lengths
        while end >= 0:
            ids.append(token := last[end])
            end -= lengths[token]
        return ids[::-1]

    def unit(self, unit: str) -> list[int]:
        """Ids of a unit; a character that is no piece stands for itself, as its bytes."""
        out, at = [], 0
        for atom in self.atoms.finditer(unit):
            out += self.segment(unit[at : atom.start()])
            codes = [self.byte_ids.get(b, self.unknown) for b in atom.group().encode()]
            out += [self.unknown] if self.unknown in codes else codes
            at = atom.end()
        return out + self.segment(unit[at:])

    def spelt(self, ids: list[int]) -> str:
        """The text of ids, word marks as spaces; bytes that are no UTF-8 become replacement characters."""
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i in self.bytes:
                run.append(self.bytes[i])
                continue
            if run:
                out.append(replaced(bytes(run)))
                run = bytearray()
            if i is not None:
                out.append(" ⁇ " if i == self.unknown else self.pieces[i].replace(SPACE, " "))
        return "".join(out)

    def remembered(self, unit: str) -> tuple[str, str]:
        """From memory, or encoded now. Units not used since memory was last full are forgotten first."""
        found = self.memory.get(unit) or self.older.get(unit)
        if found is None:
            if self.atoms.search(unit):
                ids = self.unit(unit)
                spelt = self.spelt(ids)
            else:
                ids = self.segment(unit)
                spelt = "".join([self.pieces[i] for i in ids]).replace(SPACE, " ")
            found = (",".join(map(str, ids)), spelt)
        if len(unit) <= MEMORY_LENGTH:
            if len(self.memory) > MEMORY_UNITS:
                self.memory, self.older = {}, self.memory
            self.memory[unit] = found
        return found

    def marked(self, text: str) -> str:
        """The text as the model sees it: one mark before it, marks for spaces."""
        if not self.plain:
            return self.library.normalize(text)
        return SPACE + text.replace(" ", SPACE) if text else ""

    def round_trip(self, text: str) -> tuple[str, str]:
        """(ids as decimal text joined by commas, the text decoded from them)."""
        units = self.units.findall(self.marked(text))
        found = list(map(self.memory.get, units))
        if None in found:
            found = [f or self.remembered(u) for f, u in zip(found, units)]
        decoded = "".join([f[1] for f in found])
        return ",".join([f[0] for f in found]), decoded[1:] if decoded.startswith(" ") else decoded

    def encode(self, text: str) -> list[int]:
        return [i for u in self.units.findall(self.marked(text)) for i in self.unit(u)]

    def decode(self, ids: list[int]) -> str:
        """The text of any ids; the mark that starts the first piece is the one put before every text."""
        text = self.spelt(ids)
        return text[1:] if ids and self.pieces[ids[0]].startswith(SPACE) else text


def replaced(data: bytes) -> str:
    """UTF-8 decoded, one replacement character for every byte that belongs to no character."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=4)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Every whole text encoded and decoded: ``id_col``, n_tokens, ids_sha256, decoded_sha256, and the ids
    and the decoded text where ``with_ids``.

    One pass without a shuffle, row by row: a lost executor repeats its tasks only. NULL and empty texts have
    no ids and an empty decoded text; repeated rows come out each; an empty table gives no rows; other
    columns are not read.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def encoded(batches):
        model = piece_model(path)
        for batch in batches:
            counts, ids, texts, more = [], [], [], []
            for text in batch.column(1):
                codes, decoded = model.round_trip(text.as_py())
                counts.append(codes.count(",") + 1 if codes else 0)
                ids.append(hashlib.sha256(codes.encode()).hexdigest())
                texts.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    more.append(([int(c) for c in codes.split(",")] if codes else [], decoded))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array([m[0] for m in more], pa.list_(pa.int32())), pa.array([m[1] for m in more], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    ddl = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    ddl += ", ids array<int>, decoded string" if with_ids else ""
    return source.mapInArrow(encoded, ddl).withColumnRenamed("id", id_col)
