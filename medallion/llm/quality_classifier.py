"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

1. Labels are averaged by document id; those of rows for training whose ids have the ``SAMPLE`` smallest hashes
   (a documented bound) are joined to the documents. Rows with one id count once.
2. The statistics of those texts, at most ``SAMPLE`` short rows, train the trees (see ``boosted_trees``).
3. One pass over all documents computes the same statistics and sends each batch of rows down the flat trees.

Only the text goes into a score. Null texts count as empty; empty ones have all statistics 0 and are scored like any
other. Null labels and labels of unknown documents are ignored; without labels every score is 0.5. Texts that are
equal have equal scores, repeated rows too; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.boosted_trees import Trees, fit
from medallion.llm.common import col, read_table, text_or_empty

#: Labelled documents at most that the trees are fitted on.
SAMPLE = 20_000
KEEP_FROM = 0.3
STATISTICS = [
    "log_words", "log_bytes", "word_length", "word_length_spread", "distinct_words", "top_word", "equal_neighbours", "repeated_triples", "repeated_lines",
    "words_per_line", "symbols", "words_ending_in_symbol", "words_without_letter", "exclamations", "sentence_marks", "commas", "upper", "digits", "non_ascii",
    "blanks", "byte_entropy", "packed_size",
]
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
_LETTER = np.array([chr(b).isalpha() and b < 128 or b >= 128 for b in range(256)])
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def statistics(text: str) -> np.ndarray:
    """The STATISTICS of one whole text; zeros for a text without words."""
    out = np.zeros(len(STATISTICS))
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return out
    raw = np.frombuffer(data, np.uint8)
    count = np.bincount(raw, minlength=256)
    size = len(raw)
    blank = _BLANK[raw]
    ends = np.flatnonzero(~blank & np.append(blank[1:], True))
    starts = np.flatnonzero(~blank & np.insert(blank[:-1], 0, True))
    lengths = ends - starts + 1
    lettered = np.concatenate([[0], np.cumsum(_LETTER[raw])])
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.uint64)
    triples = 0.0
    if n > 2:
        mixed = ids[:-2] * _ODD[0] + ids[1:-1] * _ODD[1] + ids[2:] * _ODD[2]
        mixed.sort()
        triples = 1 - (1 + np.count_nonzero(mixed[1:] != mixed[:-1])) / len(mixed)
    lines = [x for x in data.split(b"\n") if x.strip()]
    upper = count[65:91].sum()
    letters = upper + count[97:123].sum()
    p = count[count > 0] / size
    out[:] = (
        np.log1p(n), np.log1p(size), lengths.mean(), lengths.std(), len(known) / n, np.bincount(ids.astype(np.int64)).max() / n,
        np.count_nonzero(ids[1:] == ids[:-1]) / n, triples, 1 - len(set(lines)) / len(lines), n / len(lines), count[_SYMBOLS].sum() / n,
        np.count_nonzero(_SYMBOLS[raw[ends]]) / n, np.count_nonzero(lettered[ends + 1] == lettered[starts]) / n, count[33] / n, (count[46] + count[63]) / n,
        count[44] / n, upper / max(1, letters), count[48:58].sum() / size, count[128:].sum() / size, blank.sum() / size, -(p * np.log2(p)).sum(),
        len(zlib.compress(data, 1)) / size,
    )
    return out


def document_statistics(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, x: the statistics of each row's text."""
    src = df.select(col(id_col).alias("id"), text_or_empty(text).alias("t"))
    kind = dict(src.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t.as_py()) for t in b.column("t")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(x, pa.list_(pa.float64()))], ["id", "x"])

    return src.mapInArrow(run, f"id {kind}, x array<double>")


def training_rows(docs: DataFrame, labels: DataFrame, use: Column, label: str, text: str = "text", id_col: str = "doc_id", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``sample`` documents; ``use`` picks label rows by the column ``id``."""
    given = labels.select(col(id_col).alias("id"), col(label).cast("double").alias("y")).filter(use & F.col("id").isNotNull() & F.col("y").isNotNull())
    chosen = given.groupBy("id").agg(F.avg("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample)
    kept = docs.select(col(id_col).alias("doc"), col(text).alias("t")).join(F.broadcast(chosen), F.col("doc") == F.col("id")).select("id", "y", "t")
    both = F.struct(F.col("id"), F.col("y"))
    rows = document_statistics(kept.select(both.alias("key"), "t"), "t", "key").groupBy(F.col("id.id").alias("id"), F.col("id.y").alias("y")).agg(F.min("x").alias("x"))
    got = rows.orderBy("id").toPandas()  # at most ``sample`` rows
    return np.array(got["x"].tolist(), float).reshape(-1, len(STATISTICS)), got["y"].to_numpy(float)


def score_documents(df: DataFrame, trees: Trees, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, score: probability of label 1 for every row."""
    src = df.select(col(id_col).alias("id"), text_or_empty(text).alias("t"))
    kind = dict(src.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t.as_py()) for t in b.column("t")]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(trees.probability(x))], ["id", "score"])

    return src.mapInArrow(run, f"id {kind}, score double")


def held_out(id_: Column) -> Column:
    """crc32 of the id as text is a multiple of 5; a null id is not held out."""
    return F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))


def op12_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    x, y = training_rows(docs, read_table(spark, sf_dir, "labels"), ~held_out(F.col("id")), "quality")
    scored = score_documents(docs, fit(x, y))
    return scored.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))
