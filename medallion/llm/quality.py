"""Quality rules: hashed n-gram log-likelihood ratio of trusted against raw text. DataFrame functions only.

Words are the runs of characters outside [\\x20\\x09-\\x0D]. Base rules count words, symbols,
repeated lines and words in repeated 3-word windows. The verdict on the rest: every word and
word pair falls into one of 65,536 hash buckets; the raw multinomial counts all documents, the
target multinomial the trusted ones (labelled good and not toxic). A document's score is the
mean over its n-grams of log p_target - log p_raw, each n-gram counted without one occurrence
of its own document's (so a rare but clean word does not look bad because only this document has it,
and trusted documents get no advantage). Documents stay that score no less than the lowest trusted one
which passes the base rules; trusted ones over ``FENCE`` interquartile ranges below the lower quartile (mislabelled) don't set it.

The trusted documents are a bounded sample: the ``TRUSTED`` labelled ids with the smallest hash.
That bound and the number of buckets make both broadcast sides small whatever the data's size.
Counts of the raw corpus cover every document. Null and empty texts have no words and fail the
base rules; with no trusted document left the base rules alone decide. Rows are judged one by one, repeated rows too.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import BLANK_CLASS, BLANKS, col, keyed, read_table, stage, text_or_empty

BUCKETS = 1 << 16
TRUSTED = 20_000
FENCE = 6
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


def words_of(text: Column) -> Column:
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANK_CLASS + "+"))


def repeated_window_words(df: DataFrame, words: str, width: int, out: str) -> DataFrame:
    """Adds the number of words inside windows of ``width`` words that occur twice or more in the row.

    Windows are compared by a 64-bit hash of their words. Only rows that have a repeated window are sorted.
    """
    w = F.col(words)
    at = F.sequence(F.lit(0), F.size(w) - width)
    hashes = F.when(F.size(w) >= width, F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])))
    step = df.withColumn("_g", F.coalesce(hashes, F.array().cast("array<long>")))
    step = step.withColumn("_dup", F.size(F.array_distinct("_g")) < F.size("_g"))
    placed = F.transform(F.col("_g"), lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    step = step.withColumn("_s", F.when(F.col("_dup"), F.sort_array(placed)))
    same = lambda x, k: F.get(F.col("_s"), k)["g"].eqNullSafe(x["g"])
    step = step.withColumn("_p", F.when(F.col("_dup"), F.filter("_s", lambda x, k: same(x, k - 1) | same(x, k + 1))))
    covered = F.size(F.array_distinct(F.flatten(F.transform("_p", lambda x: F.array(*[x["i"] + k for k in range(width)])))))
    return step.withColumn(out, F.when(F.col("_dup"), covered).otherwise(0).cast("long")).drop("_g", "_dup", "_s", "_p")


def base_rules(df: DataFrame, text: str, rid: str) -> DataFrame:
    """rid, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    rows = df.select(col(rid).alias("rid"), text_or_empty(text).alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    rows = rows.select(
        "rid",
        words_of(F.col("t")).alias("w"),
        lines.alias("lines"),
        F.length(F.translate("t", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    rows = repeated_window_words(rows, "w", 3, "n_repeat_words")
    rows = rows.select(
        "rid",
        F.size("w").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)
    return rows.withColumn("base_failed", failed)


def ngrams(df: DataFrame, text: str, *keep: Column) -> DataFrame:
    """One row per word and per word pair: the kept columns and ``bucket``."""
    rows = df.select(*keep, words_of(text_or_empty(text)).alias("w"))
    ones = F.transform("w", lambda a: F.xxhash64(a))
    pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.size("w")), lambda a, b: F.xxhash64(a, b))
    names = [c for c in rows.columns if c != "w"]
    return rows.select(*names, F.explode(F.concat(ones, pairs)).alias("h")).select(*names, F.pmod("h", F.lit(BUCKETS)).cast("int").alias("bucket"))


def trusted_ids(labels: DataFrame, bound: int = TRUSTED) -> DataFrame:
    """At most ``bound`` ids of documents labelled good and not toxic (``id``)."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return good.select(F.col("doc_id").alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(bound)


def scores(df: DataFrame, text: str, id_col: str, rid: str, trusted: DataFrame) -> DataFrame:
    """rid, llr, mine: mean log-likelihood ratio of each document that has a word; whether it is trusted."""
    known = F.broadcast(trusted.withColumn("mine", F.lit(True)))  # at most TRUSTED rows
    marked = df.select(col(rid).alias("rid"), col(id_col).alias("id"), text_or_empty(text).alias("t")).join(known, "id", "left")
    marked = marked.withColumn("mine", F.coalesce("mine", F.lit(False)))
    counts = ngrams(marked, "t", F.col("mine")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.sum(F.col("mine").cast("long")).alias("target")
    )
    counts = stage(counts, "ngrams")  # at most BUCKETS rows
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).first()
    base = F.lit(math.log((total["raw"] + BUCKETS) / (total["target"] + BUCKETS))) - F.log("raw")
    weights = counts.select(
        "bucket", (base + F.log(F.col("target") + 1)).alias("out_"), (base + F.log(F.greatest("target", F.lit(1)))).alias("in_")
    )
    grams = ngrams(marked, "t", F.col("rid"), F.col("mine")).join(F.broadcast(weights), "bucket")  # at most BUCKETS rows
    llr = F.avg(F.when(F.col("mine"), F.col("in_")).otherwise(F.col("out_")))
    return grams.groupBy("rid").agg(llr.alias("llr"), F.max("mine").alias("mine"))


def threshold(llr: DataFrame) -> float | None:
    """The lowest of the scores (``llr``) that are not far below the others; none of no scores."""
    quarters = llr.agg(F.percentile("llr", F.array(F.lit(0.25), F.lit(0.75))).alias("q")).first()["q"]  # at most TRUSTED documents
    if quarters is None:
        return None
    low, high = quarters
    return llr.filter(F.col("llr") >= low - FENCE * (high - low)).agg(F.min("llr")).first()[0]


def judge(df: DataFrame, labels: DataFrame, text: str, id_col: str, rid: str) -> DataFrame:
    """rid, the base columns, llr and ``kept``."""
    found = scores(df, text, id_col, rid, trusted_ids(labels)).withColumnRenamed("rid", "srid")
    rows = base_rules(df, text, rid)
    rows = stage(rows.join(found, rows["rid"] == found["srid"], "left").drop("srid"), "judged")
    least = threshold(rows.filter("mine AND NOT base_failed"))
    good = F.lit(True) if least is None else F.coalesce(F.col("llr") >= least, F.lit(False))
    return rows.drop("mine").withColumn("kept", ~F.col("base_failed") & good)


def keep_good(df: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents that pass, all columns. ``df`` must be a file scan (see ``keyed``)."""
    rows, rid = keyed(df)
    bad = judge(rows, labels, text, id_col, rid).filter(~F.col("kept")).select(F.col("rid").alias(rid))
    return rows.join(bad, rid, "left_anti").select(*[col(c) for c in df.columns])


def op10_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, rid = keyed(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    verdicts = judge(docs, read_table(spark, sf_dir, "labels"), "text", "doc_id", rid)
    return docs.select("doc_id", F.col(rid).alias("rid")).join(verdicts, "rid").drop("rid")
