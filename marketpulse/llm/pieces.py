"""Subword encoding and decoding with the pieces of a SentencePiece model.

An Aho-Corasick automaton over all pieces reads the text once. At each position
its output links give every piece that ends there, longest first; a piece
relaxes the best score at its end with the best score at its start plus its own
(a Viterbi pass). A later, shorter piece wins only with a strictly better score.
A character that no piece covers costs the lowest score less ten and becomes
its UTF-8 byte pieces.

Where no piece has a space mark after another character, no piece spans the
start of a word, so the best path of a text is the concatenation of those of
its words; each task remembers the words it has encoded, up to a fixed number.

Round trip: decoding returns every text exactly. A literal space mark (U+2581)
in a text is written as bytes, so that it does not decode to a space. NULL
text has NULL ids and zero tokens, the empty text no ids; repeated rows and
very long texts need no special care; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import id_text

SPACE = "▁"
#: Words that a task remembers; beyond it the memory starts anew.
MEMORY_WORDS = 300_000
#: Characters beyond which a word is not remembered.
MEMORY_LENGTH = 64
# Piece types of the model file that can stand for text, and for one byte.
_TEXT_TYPES, _BYTE_TYPE, _UNKNOWN_PENALTY = (1, 4), 6, 10.0


@dataclass(frozen=True)
class PieceTable:
    """What encoding needs from a model file: (piece, score, type) by id, and the dummy prefix."""
    pieces: tuple = field(repr=False)
    dummy_prefix: bool = True


def read_pieces(path: str) -> PieceTable:
    """Reads a model file; only models without text normalisation are taken."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm = model.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces:
        raise ValueError("the model changes texts before it encodes them: no exact round trip")
    if not model.trainer_spec.byte_fallback:
        raise ValueError("the model has no byte pieces: unknown characters would be lost")
    return PieceTable(tuple((p.piece, p.score, p.type) for p in model.pieces), norm.add_dummy_prefix)


class _Words(dict):
    """Word to its ids as bytes of int32, computed when first asked for."""

    def __init__(self, encode, limit):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        ids = np.array(self.encode(word), np.int32).tobytes()
        if len(word) <= MEMORY_LENGTH:
            self[word] = ids
        return ids


class Codec:
    """Encodes and decodes texts; built once in each task."""

    def __init__(self, table: PieceTable, memory_words: int = MEMORY_WORDS):
        import ahocorasick
        self.dummy = table.dummy_prefix
        self.auto = ahocorasick.Automaton()
        self.byte_ids = [0] * 256
        self.raw: list[bytes] = []
        inside, letters, lowest = False, set(), 0.0
        for i, (piece, score, kind) in enumerate(table.pieces):
            self.raw.append(b"")
            if kind == _BYTE_TYPE:
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.raw[i] = bytes([value])
            elif kind in _TEXT_TYPES and piece:
                self.auto.add_word(piece, (i, len(piece), score))
                self.raw[i] = piece.replace(SPACE, " ").encode()
                inside |= SPACE in piece.lstrip(SPACE)
                letters.update(piece)
                lowest = min(lowest, score)
        self.auto.make_automaton()
        self.unknown = lowest - _UNKNOWN_PENALTY
        stops = "".join(c for c in "\n\r\t" if c not in letters)
        if inside:
            self.cut = lambda s: [s]
        elif stops:
            self.cut = re.compile(f"{SPACE}+[^{SPACE}{stops}]*|[{stops}]+|[^{SPACE}{stops}]+").findall
        else:
            self.cut = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
        self.words = _Words(self.best_path, memory_words)
        self.mark = np.array([self.byte_ids[b] for b in SPACE.encode()], np.int32).tobytes()

    def best_path(self, s: str) -> list[int]:
        """Ids of the best segmentation of ``s``, in which spaces are already marks."""
        n = len(s)
        best, back = [0.0] * (n + 1), [None] * (n + 1)
        at = 0   # best[0..at] is final
        ends = self.auto.iter(s)
        hit = next(ends, None)
        while at < n:
            at += 1
            top, how, single = None, None, False
            while hit is not None and hit[0] == at - 1:
                _, (i, length, score) = hit
                value = best[at - length] + score
                if top is None or value > top:
                    top, how = value, (i, length)
                single |= length == 1
                hit = next(ends, None)
            if not single:
                value = best[at - 1] + self.unknown
                if top is None or value > top:
                    top, how = value, (-1, 1)
            best[at], back[at] = top, how
        ids = []
        while n:
            i, length = back[n]
            if i < 0:
                ids.extend(self.byte_ids[b] for b in reversed(s[n - 1].encode()))
            else:
                ids.append(i)
            n -= length
        ids.reverse()
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as bytes of int32."""
        if not text:
            return b""
        parts = text.split(SPACE)
        known, cut = self.words, self.cut
        out = []
        for k, part in enumerate(parts):
            if k:
                out.append(self.mark)
            s = part.replace(" ", SPACE)
            if k == 0 and self.dummy:
                s = SPACE + s
            out.extend([known[w] for w in cut(s)])
        return b"".join(out)

    def decode(self, ids) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy and text.startswith(" ") else text


def _lists(parts: list[bytes | None]) -> pa.Array:
    sizes = np.array([0 if p is None else len(p) // 4 for p in parts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(p for p in parts if p), np.int32))
    empty = pa.array([p is None for p in parts], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=empty)


def encode_column(docs: DataFrame, table: PieceTable, id_col: str = "doc_id", text_col: str = "text",
                  verify: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, exact): ``exact`` says whether decoding gives the text back."""
    src = id_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((table.pieces, table.dummy_prefix))   # bounded by the vocabulary

    def run(batches):
        codec = Codec(PieceTable(*shared.value))
        for b in batches:
            for at in range(0, b.num_rows, 256):   # a slice at a time bounds the lists in memory
                part = b.slice(at, 256)
                texts = part.column(1).to_pylist()
                ids = [None if t is None else codec.encode(t) for t in texts]
                sizes = [0 if x is None else len(x) // 4 for x in ids]
                same = [None if t is None or not verify else
                        codec.decode(np.frombuffer(x, np.int32).tolist()) == t for t, x in zip(texts, ids)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), _lists(ids), pa.array(same, pa.bool_())],
                    ["doc_id", "n_tokens", "ids", "exact"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>, exact boolean")


def decode_column(encoded: DataFrame, table: PieceTable, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the texts of a table of ids."""
    src = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    shared = encoded.sparkSession.sparkContext.broadcast((table.pieces, table.dummy_prefix))

    def run(batches):
        codec = Codec(PieceTable(*shared.value), 1)
        for b in batches:
            texts = [None if x is None else codec.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text string")


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")
