"""Language-model scoring: a causal self-attention model over subword ids, and a word unigram base.

Documents whose crc32(id as text) mod 7 is not 2 train; all are scored, whole. Null texts and null ids
count as empty texts.

1. One pass splits the texts into words (A-Z lower-cased, plus one end per document) and subword
   ids, in chunks of ``CHUNK_BYTES`` of text. A chunk has its own word list, so words travel once per
   chunk instead of once per document, and nothing the size of the vocabulary is broadcast: the chunk's
   counts come back to the chunk's documents (cogroup, bounded by the chunk).
2. Token counts and the counts of what stands before them over all training documents (tables bounded
   by the tokenizer's vocabulary) give classes: the most frequent tokens alone, the rest by k-means; and
   P(token | its class, the class before it), smoothed by P(token | its class).
3. The attention model reads token ids, a row of weights for each id beside its class's, and predicts the next
   token's class. It is trained in rounds: each task runs Adam over the share of its training documents that the
   row number's hash gives the round; Spark averages the weights (weighted by windows; a token's row by its uses).
   The rounds' shares are disjoint and together hold every training document. Which documents one task
   trains on follows the table's files, so scores differ a little when the same rows are stored in other files.
4. A token's probability is a softmax in two levels over all ids: P(its class | the ids before it) by the attention
   model, times the table's P(token | its class, the class before). Every token is scored once in overlapping
   windows with batched masked attention (``attention.py``).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm import attention, tokens
from medallion.llm.common import col, keyed, read_table, stage, text_or_empty

CHUNK_BYTES = 1 << 24
WORD_BITS = 27  # of a word's place: its number in its chunk (a single text may be longer than a chunk)
ALONE, CLUSTERS, CONTEXTS = 24, 40, 32
CLASSES = ALONE + CLUSTERS
ROUNDS, BATCH, RATE = 3, 32, 0.02
SCORE_BATCH = 48
ROWS = 256  # documents taken from an Arrow batch at once


def held_out(doc_id: object) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


class Numbers(dict):
    """Word -> number in the order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            yield b.slice(i, ROWS)


def split_texts(df: DataFrame, text: str, id_col: str, rid: str) -> DataFrame:
    """Document rows (chunk, rid, id, held_out, word numbers, token ids) and one word row per chunk (words, training counts)."""
    src = df.select(col(rid).alias("rid"), col(id_col).alias("id"), text_or_empty(text).alias("t"))
    kind = dict(src.dtypes)["id"]
    names = ["chunk", "rid", "id", "held_out", "words", "ids", "vocabulary", "counts", "token_counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        chunk = TaskContext.get().partitionId() << 16  # with WORD_BITS, room for 2**20 partitions
        rows: list[tuple] = []
        number = Numbers()
        train: list[np.ndarray] = []
        recent: list[np.ndarray] = []
        size, id_type = 0, None

        def close() -> Iterator[pa.RecordBatch]:
            if len(number) > 1 << WORD_BITS:
                raise ValueError(f"a text with over {1 << WORD_BITS} different words")
            counts = np.bincount(np.concatenate(train), minlength=len(number)) if train else np.zeros(len(number), np.int64)
            used = np.bincount(np.concatenate(recent), minlength=tokens.VOCABULARY) if recent else np.zeros(tokens.VOCABULARY, np.int64)
            n = len(rows)
            c = list(zip(*rows, strict=True))
            none = [None] * n
            arrays = [
                pa.array([chunk] * (n + 1), pa.int64()), pa.array([*c[0], None], pa.int64()), pa.array([*c[1], None], id_type), pa.array([*c[2], None], pa.bool_()),
                pa.array([*c[3], None], pa.binary()), pa.array([*c[4], None], pa.binary()),
                pa.array([*none, [w.decode() for w in number]], pa.list_(pa.string())), pa.array([*none, counts], pa.list_(pa.int64())),
                pa.array([*none, used], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

        for b in _slices(batches):
            id_type = b.column("id").type
            for rid_, id_, t in zip(b.column("rid").to_pylist(), b.column("id").to_pylist(), b.column("t").to_pylist(), strict=True):
                raw = t.encode()
                w = raw.lower().split()
                numbers = np.fromiter(map(number.__getitem__, w), np.int32, len(w))
                out = held_out(id_)
                ids = np.append(tokens.encode(t), np.uint32(tokens.END_ID)).astype("<u2")
                if not out:
                    train.append(numbers)
                    recent.append(ids)
                rows.append((rid_, id_, out, squeeze.compress(numbers.astype("<i4").tobytes()), ids.tobytes()))
                size += len(raw) + 64
                if size >= CHUNK_BYTES:
                    yield from close()
                    chunk += 1
                    rows, number, train, recent, size = [], Numbers(), [], [], 0
        if rows:
            yield from close()

    return src.mapInArrow(run, f"chunk long, rid long, id {kind}, held_out boolean, words binary, ids binary, vocabulary array<string>, counts array<long>, token_counts array<long>")


def base_scores(split: DataFrame) -> DataFrame:
    """rid, id, held_out, n_tokens, n_known, train_tokens, base_score of the word unigram model."""
    docs = split.filter("rid IS NOT NULL")
    words = split.filter("vocabulary IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("vocabulary", "counts")).alias("at", "x"))
    place = F.shiftleft(F.col("chunk"), WORD_BITS).bitwiseOR(F.col("at").cast("long"))
    words = words.select(place.alias("place"), F.col("x.vocabulary").alias("word"), F.col("x.counts").cast("int").alias("n"))
    same = Window.partitionBy("word")
    known = words.select("place", "n", F.sum("n").over(same).alias("c"), (F.col("place") == F.min("place").over(same)).alias("first"))
    known = stage(known, "word-counts")
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum((F.col("first") & (F.col("c") > 0)).cast("long")), F.lit(0)).alias("v")).first()
    ends = docs.filter("NOT held_out").count()
    n_all, v_all = int(total["n"]) + ends, int(total["v"]) + (ends > 0)
    kind = dict(docs.dtypes)["id"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        c = np.zeros(right.num_rows, np.int64)
        c[right.column("at").to_numpy()] = right.column("c").to_numpy()
        logs, seen = np.log10(c + 1.0), c > 0
        rows, expand = [], zstandard.ZstdDecompressor()
        for w in left.column("words"):
            ids = np.frombuffer(expand.decompress(w.as_buffer()), "<i4")
            n = len(ids) + 1
            base = float(logs[ids].sum()) + math.log10(ends + 1.0) - n * math.log10(n_all + v_all + 1.0)
            rows.append((n, int(seen[ids].sum()) + (ends > 0), base))
        x = list(zip(*rows, strict=True)) if rows else [[]] * 3
        return pa.table(
            [left.column("rid"), left.column("id"), left.column("held_out"), pa.array(x[0], pa.int64()), pa.array(x[1], pa.int64()), pa.array([n_all] * len(rows), pa.int64()), pa.array(x[2], pa.float64())],
            ["rid", "id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"],
        )

    left = docs.select("chunk", "rid", "id", "held_out", "words").groupBy("chunk")
    at = F.col("place").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    right = known.select(F.shiftright("place", WORD_BITS).alias("chunk"), at.alias("at"), "c").groupBy("chunk")
    return left.cogroup(right).applyInArrow(score, f"rid long, id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double")


def _ids(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token ids of a batch's documents in a row, the ids before them, and each document's first place and length."""
    c = b.column("ids")
    at = np.frombuffer(c.buffers()[1], "<i8" if pa.types.is_large_binary(c.type) else "<i4")[c.offset : c.offset + len(c) + 1] // 2
    ids = np.frombuffer(c.buffers()[2], "<u2")[at[0] : at[-1]].astype(np.int32)
    first = at[:-1] - at[0]
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[first] = tokens.END_ID
    return ids, before, first, np.diff(at)


def _table(df: DataFrame, size: int, number) -> np.ndarray:
    """Sum over all training tokens of the bin ``number(ids, ids before)``: an array of ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        held: list[np.ndarray] = []
        have = 0
        for b in _slices(batches):
            ids, before, *_ = _ids(b)
            held.append(number(ids, before))
            have += len(ids)
            if have > size:
                total += np.bincount(np.concatenate(held), minlength=size)
                held, have = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["at", "n"])

    out = np.zeros(size, np.int64)
    found = df.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def classes_of(counts: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Class of each token: the ``ALONE`` most frequent alone, the others by k-means on what stands before them."""
    order = np.argsort(-counts, kind="stable")
    out = np.zeros(len(counts), np.int64)
    out[order[:ALONE]] = np.arange(ALONE)
    rest = order[ALONE:]
    x = np.sqrt((before[rest] + 0.5) / (before[rest] + 0.5).sum(1, keepdims=True))
    weight = np.sqrt(counts[rest] + 1.0)
    centre = x[:CLUSTERS].copy()
    near = np.zeros(len(rest), np.int64)
    for _ in range(10):
        near = np.argmax(x @ centre.T - 0.5 * (centre**2).sum(1), 1)
        total = np.bincount(near, weight, CLUSTERS)
        for d in range(x.shape[1]):
            moved = np.bincount(near, weight * x[:, d], CLUSTERS)
            centre[:, d] = np.where(total > 0, moved / np.maximum(total, 1e-9), centre[:, d])
    out[rest] = ALONE + near
    return out


def initial_weights() -> np.ndarray:
    """Weights before training: the class model's, then a row of zeros for every id and for the place outside a text."""
    model = attention.flat(attention.initial(CLASSES))
    return np.concatenate([model, np.zeros((tokens.VOCABULARY + 1) * attention.WIDTH)])


def _parts(weights: np.ndarray, like: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The class model's weights and the rows of the ids."""
    model = sum(x.size for x in like.values())
    return weights[:model], weights[model:].reshape(-1, attention.WIDTH)


def train_round(df: DataFrame, class_of: np.ndarray, weights: np.ndarray, turn: int) -> np.ndarray:
    like = attention.initial(CLASSES)
    shared = df.sparkSession.sparkContext.broadcast((class_of, weights.astype(np.float32)))  # a row for each id: 3 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, weights = shared.value
        opt = attention.Adam(*_parts(weights, like), np.append(class_of, CLASSES), like, RATE / (turn + 1))
        held: list[tuple[np.ndarray, ...]] = []
        have = used = 0

        def learn() -> int:
            mixed = np.random.default_rng(used).permutation(have)
            x, y = np.concatenate([p[0] for p in held])[mixed], np.concatenate([p[1] for p in held])[mixed]
            for i in range(0, len(x), BATCH):
                opt.step(x[i : i + BATCH], y[i : i + BATCH])
            return len(x)

        for b in _slices(batches):
            ids, _, _, lengths = _ids(b)
            held.append(attention.windows(ids, lengths, tokens.END_ID, tokens.VOCABULARY, class_of[ids]))
            have += len(held[-1][0])
            if have >= 64 * BATCH:  # many documents at a time, mixed
                used += learn()
                held, have = [], 0
        if have:
            used += learn()
        if used:
            model = len(opt.values)
            seen = np.flatnonzero(opt.uses)
            at = np.concatenate([np.arange(model), (model + seen[:, None] * attention.WIDTH + np.arange(attention.WIDTH)).ravel()])
            n = np.concatenate([np.full(model, used), np.repeat(opt.uses[seen], attention.WIDTH)])
            values = np.concatenate([opt.values, opt.rows[seen].ravel()]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(values * n), pa.array(n, pa.int64())], ["at", "w", "n"])

    mine = F.pmod(F.xxhash64("rid"), F.lit(ROUNDS)) == turn  # a document is in one round, no document in none
    rows = df.filter(mine).select("ids").mapInArrow(run, "at int, w double, n long").groupBy("at").agg((F.sum("w") / F.sum("n")).alias("w")).toPandas()
    out = weights.astype(np.float64)  # a row no document of the round uses stays, as all do without documents
    out[rows["at"].to_numpy(np.int64)] = rows["w"].to_numpy(np.float64).round(5)  # sums in any order of the tasks give the same weights
    return out


def fit(split: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each token, log10 P(token | its class, class before), weights (see ``initial_weights``)."""
    train = split.filter("rid IS NOT NULL AND NOT held_out").select("rid", "ids")
    used = split.filter("token_counts IS NOT NULL").select(F.posexplode("token_counts").alias("at", "n")).filter("n > 0")
    used = used.groupBy("at").agg(F.sum("n").alias("n")).toPandas()  # at most the tokenizer's vocabulary
    counts = np.zeros(tokens.VOCABULARY, np.int64)
    counts[used["at"].to_numpy(np.int64)] = used["n"].to_numpy(np.int64)
    context = np.full(tokens.VOCABULARY, CONTEXTS - 1)
    context[np.argsort(-counts, kind="stable")[: CONTEXTS - 1]] = np.arange(CONTEXTS - 1)
    context = context.astype(np.int32)
    before = _table(train.select("ids"), tokens.VOCABULARY * CONTEXTS, lambda s, before: s * CONTEXTS + context[before]).reshape(-1, CONTEXTS)
    class_of = classes_of(counts, before).astype(np.int32)
    own = (counts + 0.5) / np.bincount(class_of, counts + 0.5, CLASSES)[class_of]
    after = _table(train.select("ids"), CLASSES * tokens.VOCABULARY, lambda s, before: class_of[before] * tokens.VOCABULARY + s).reshape(CLASSES, -1)
    inside = np.empty(after.shape, np.float32)
    for a in range(CLASSES):
        seen = np.bincount(class_of, after[a], CLASSES)
        kinds = np.maximum(np.bincount(class_of, after[a] > 0, CLASSES), 1.0)
        inside[a] = np.log10((after[a] + kinds[class_of] * own) / (seen + kinds)[class_of])
    weights = initial_weights()
    for turn in range(ROUNDS):
        weights = train_round(train, class_of, weights, turn)
    return class_of, inside, weights


def model_scores(split: DataFrame) -> DataFrame:
    """rid, score: log10 probability of each whole document under the attention model."""
    class_of, inside, weights = fit(split)
    model, rows = _parts(weights.astype(np.float32), attention.initial(CLASSES))
    w = attention.shaped(model, attention.initial(CLASSES))
    w["e"] = w["e"][np.append(class_of, CLASSES)] + rows
    shared = split.sparkSession.sparkContext.broadcast((class_of, inside, w))  # CLASSES by the tokenizer's vocabulary, and its rows: 16 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, table, w = shared.value
        w = attention.tables(w)
        table = table.ravel()
        for b in _slices(batches):
            ids, before, first, lengths = _ids(b)
            total = np.add.reduceat(np.take(table, classes[before] * tokens.VOCABULARY + ids), first, dtype=np.float64)
            x, y, owner = attention.windows(ids, lengths, tokens.END_ID, tokens.VOCABULARY, classes[ids])
            for i in range(0, len(x), SCORE_BATCH):
                got = attention.log_probs(w, x[i : i + SCORE_BATCH], y[i : i + SCORE_BATCH]).sum(1, dtype=np.float64) / math.log(10)
                total += np.bincount(owner[i : i + SCORE_BATCH], got, len(lengths))
            yield pa.RecordBatch.from_arrays([b.column("rid"), pa.array(total, pa.float64())], ["rid", "score"])

    return split.filter("rid IS NOT NULL").select("rid", "ids").mapInArrow(run, "rid long, score double")


def score_documents(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score. ``df`` must be a file scan (see ``keyed``)."""
    rows, rid = keyed(df)
    split = stage(split_texts(rows, text, id_col, rid), "split")
    scored = model_scores(split).withColumnRenamed("rid", "srid")
    base = base_scores(split)
    out = base.join(scored, base["rid"] == scored["srid"])
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))
