"""SentencePiece encoding and decoding with a given model file.

An Aho-Corasick automaton over all ordinary pieces reads a text once; at each end position its
output links give every piece that ends there, longest first, and each relaxes the best score
up to that position (Viterbi, sum of piece scores). A character that no piece covers costs less
than any piece and becomes its UTF-8 byte pieces. On a tie the longer last piece wins. The text gets
a space in front and spaces become U+2581, as the model's own (identity) normalisation says.

No piece has U+2581 after another character, so the best path of a text is that of its words,
each with its leading spaces; words are encoded once per task and kept in a bounded dictionary.
Line feeds are a boundary as well if no longer piece holds one. Both are checked when the model loads;
otherwise the text is one word. Memory does not depend on a text's length beyond its own arrays.

Decoding joins the pieces, byte pieces included, and takes the leading space away; U+2581 in a text
comes back as a space (so does it in the reference implementation). Null texts count as empty, with no pieces.
Repeated rows are encoded one by one; empty tables give empty results.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from medallion.llm.common import col, read_table, slices, text_or_empty
from medallion.llm.tokens import vocabulary_file

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
KEPT_WORDS = 500_000
ROWS_AT_ONCE = 256


class Pieces(dict):
    """Word (with its leading spaces as U+2581) -> ids as little-endian 32-bit numbers."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        super().__init__()
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(sp.get_piece_size())
        self.scores = np.array([sp.get_score(i) for i in ids])
        self.byte_ids = np.zeros(256, np.uint32)
        self.raw: list[bytes] = []
        self.automaton = ahocorasick.Automaton()
        ordinary = []
        for i in ids:
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.raw.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                ordinary.append((piece, i))
                self.raw.append(piece.encode())
        for piece, i in ordinary:
            self.automaton.add_word(piece, (len(piece), float(self.scores[i]), i))
        self.automaton.make_automaton()
        self.unknown = float(min(s for s in self.scores[[i for _, i in ordinary]])) - 10.0
        inner = any(SPACE in p.lstrip(SPACE) for p, _ in ordinary)
        feed = any("\n" in p and len(p) > 1 for p, _ in ordinary)
        self.words = re.compile(r"(?s).+" if inner else f"{SPACE}*[^{SPACE}]+|{SPACE}+" if feed else f"{SPACE}*[^{SPACE}\n]+|\n|{SPACE}+")

    def __missing__(self, word: str) -> bytes:
        if len(self) > KEPT_WORDS:
            self.clear()
        ids = np.array(self.best_path(word), "<u4").tobytes()
        if len(word) <= 64:
            self[word] = ids
        return ids

    def best_path(self, word: str) -> list[int]:
        n, low = len(word), float("-inf")
        best, length, piece = [0.0] + [low] * n, [0] * (n + 1), [0] * (n + 1)
        done = 0

        def settle(upto: int) -> None:
            # positions that no piece reaches, or reaches badly, go on from the one before by an uncovered character
            for k in range(done + 1, upto + 1):
                if best[k] < best[k - 1] + self.unknown:
                    best[k], length[k], piece[k] = best[k - 1] + self.unknown, 1, -1

        for end, (size, score, i) in self.automaton.iter(word):
            end += 1
            if end - 1 > done:
                settle(end - 1)
                done = end - 1
            s = best[end - size] + score
            if s > best[end]:
                best[end], length[end], piece[end] = s, size, i
        settle(n)
        out: list[int] = []
        k = n
        while k:
            if piece[k] < 0:
                out.extend(self.byte_ids[list(word[k - 1].encode())][::-1].tolist())
            else:
                out.append(piece[k])
            k -= length[k]
        return out[::-1]

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        words = self.words.findall(SPACE + text.replace(" ", SPACE))
        return np.frombuffer(b"".join(map(self.__getitem__, words)), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        joined = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(SPACE, " ")
        return joined[1:] if joined.startswith(" ") else joined


@functools.lru_cache(maxsize=2)
def model(path: str) -> Pieces:
    return Pieces(path)


def encode(df: DataFrame, text: str, id_col: str, model_file: str | None = None) -> DataFrame:
    """id and ids (array of int) of every whole text."""
    path = model_file or vocabulary_file(MODEL)
    src = df.select(col(id_col).alias(id_col), text_or_empty(text).alias("_t"))
    kind = dict(src.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in slices(batches, ROWS_AT_ONCE):
            ids = [m.encode(t).astype(np.int32) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"])

    return src.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(df: DataFrame, ids: str, id_col: str, model_file: str | None = None) -> DataFrame:
    """id and text of every list of ids (null: empty)."""
    path = model_file or vocabulary_file(MODEL)
    src = df.select(col(id_col).alias(id_col), col(ids).cast("array<int>").alias("_ids"))
    kind = dict(src.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in slices(batches, ROWS_AT_ONCE):
            texts = [m.decode(np.array(x or [], np.int64)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return src.mapInArrow(run, f"`{id_col}` {kind}, text string")


def round_trips(df: DataFrame, text: str, id_col: str, model_file: str | None = None) -> DataFrame:
    """id, ids, decoded (the ids' text), n_pieces, n_byte_pieces, score, ids_crc32 and round_trip (decoded is the text, U+2581 as a space)."""
    path = model_file or vocabulary_file(MODEL)
    src = df.select(col(id_col).alias(id_col), text_or_empty(text).alias("_t"))
    kind = dict(src.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        is_byte = np.zeros(len(m.scores), np.int64)
        is_byte[m.byte_ids] = 1
        for b in slices(batches, ROWS_AT_ONCE):
            rows = []
            for t in b.column("_t").to_pylist():
                ids = m.encode(t)
                back = m.decode(ids)
                rows.append((ids.astype(np.int32), back, len(ids), int(is_byte[ids].sum()), float(m.scores[ids].sum()), zlib.crc32(ids.tobytes()), back == t.replace(SPACE, " ")))
            c = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = [pa.list_(pa.int32()), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.bool_()]
            names = [id_col, "ids", "decoded", "n_pieces", "n_byte_pieces", "score", "ids_crc32", "round_trip"]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, k) for x, k in zip(c, kinds, strict=True)]], names)

    return src.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string, n_pieces long, n_byte_pieces long, score double, ids_crc32 long, round_trip boolean")


def op4_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(read_table(spark, sf_dir, "documents"), "text", "doc_id")
