"""Periodic runs against a scan of every period, and op13's contract against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from medallion.llm import periodic_runs as P
from medallion.llm.common import read_table

SF = "/root/testdata/sf0.01"


def plain_runs(words, least=6, times=4):
    """Every period in turn: maximal stretches of words equal to the one a period on; the smallest period counts."""
    n, out = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            if length >= 2 * q and (s, length) not in out:  # larger periods of the same stretch are multiples
                out[s, length] = q
    return sorted(((s, m, q) for (s, m), q in out.items() if m >= max(least, times * q)), key=lambda r: (r[0], r[2]))


def plain_op13(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {t for s, m, q in runs for t in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for t, w in enumerate(words) if t not in gone)
    return (len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def numbers(words):
    known = {}
    return np.array([known.setdefault(w, len(known) + 1) for w in words], np.int64)


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_plain_scan(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(150):
        letters = "abcd"[: rng.randint(1, 4)]
        words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            unit = [rng.choice(letters) for _ in range(rng.randint(1, 6))]
            at = rng.randint(0, len(words))
            words[at:at] = (unit * rng.randint(2, 9))[: rng.randint(1, 50)]
        texts.append(words)
    assert P.runs_of([numbers(t) for t in texts]) == [plain_runs(t) for t in texts]


def test_runs_of_structured_words():
    fib = ["a"], ["a", "b"]
    for _ in range(10):
        fib = fib[1], fib[1] + fib[0]
    line = [f"w{k}" for k in range(40)]
    texts = [fib[1], ["x"] * 5, ["x"] * 6, ["x"] * 5000, ["x", "y"] * 3 + ["x"], ["x", "y"] * 4, line * 50, (line * 9 + ["z"]) * 5, ["a", "a", "b"] * 20 + ["a", "a"] * 30]
    assert P.runs_of([numbers(t) for t in texts]) == [plain_runs(t) for t in texts]


def test_whole_table_equals_plain_python(spark):
    rows = read_table(spark, SF, "documents").select("doc_id", "text").collect()
    got = {r[0]: tuple(r[1:]) for r in P.op13_query(spark, SF).collect()}
    assert got == {r[0]: plain_op13(*r) for r in rows}
    assert sum(v[0] for v in got.values()) > 50


def test_nulls_long_texts_repeats_and_clashing_names(spark, tmp_path):
    rng = random.Random(3)
    long_ = " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) + str(rng.randint(0, 300)) for _ in range(400_000)) + " tail of words" * 2000
    texts = [None, "", " \t\n", "x", "a b " * 30, "é è " * 9, "a\x0bb c\n" * 8, "same\n" * 700]
    rows = [(k, t, 1, "r") for k, t in enumerate(texts)] + [(4, texts[4], 2, "r"), (None, "q q q q q q q", 3, None), (None, None, None, None)]
    schema = "doc_id long, text string, id int, runs string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, P.op13_query(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(((r[0], *plain_op13(r[0], r[1])) for r in rows), key=repr)
    spark.createDataFrame([(1, long_)], "doc_id long, text string").write.parquet(str(tmp_path / "long" / "documents.parquet"))
    (one,) = P.periodic_runs(read_table(spark, str(tmp_path / "long"), "documents")).collect()
    assert one["n_words"] == 406_000 and [(r["length"], r["period"]) for r in one["runs"]] == [(6000, 3)] and one["collapsed"] == long_[: len(long_) - len(" tail of words") * 1999]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert P.op13_query(spark, str(tmp_path)).collect() == []
