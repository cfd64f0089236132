"""Boosted trees against a node-by-node version, and held-out accuracy of the classifier."""

import zlib

import numpy as np

from medallion.llm import boosted_trees as B
from medallion.llm import quality_classifier as Q
from medallion.llm.common import read_table

SF = "/root/testdata/sf0.1"


def test_traversal_equals_walk_by_node():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    x[:, 4] = np.round(x[:, 4])
    y = (x[:, 0] + x[:, 4] > 0.2).astype(float)
    trees = B.fit(x, y, rounds=30, depth=3)
    for row, got in zip(x, trees.raw(x), strict=True):
        total = trees.base
        for f, t, v in zip(trees.feature, trees.threshold, trees.value, strict=True):
            k = 0
            while k < len(f):
                k = 2 * k + 2 if row[f[k]] > t[k] else 2 * k + 1
            total += v[k - len(f)]
        assert abs(total - got) < 1e-9
    assert np.mean((trees.probability(x) > 0.5) == (y > 0.5)) > 0.95


def test_first_split_is_the_best_of_all():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 9, size=(200, 3)).astype(float)
    y = (x[:, 1] + rng.normal(size=200) > 4).astype(float)
    trees = B.fit(x, y, rounds=1, depth=1)
    p = (y.sum() + 0.5) / (len(y) + 1)
    g, h = p - y, np.full(len(y), p * (1 - p))

    def gain(mask):
        return sum(g[m].sum() ** 2 / (h[m].sum() + 1.0) for m in (mask, ~mask))

    options = {(f, t): gain(x[:, f] <= t) for f in range(3) for t in np.unique(x[:, f])[:-1] if min((x[:, f] <= t).sum(), (x[:, f] > t).sum()) * p * (1 - p) >= 1}
    assert (trees.feature[0, 0], trees.threshold[0, 0]) == max(options, key=options.get)


def test_no_rows_and_one_class():
    none = B.fit(np.zeros((0, 4)), np.zeros(0))
    assert none.probability(np.zeros((3, 4))).tolist() == [0.5] * 3
    same = B.fit(np.ones((10, 4)), np.ones(10))
    assert (same.probability(np.zeros((2, 4))) > 0.9).all()


def test_statistics_by_hand():
    s = dict(zip(Q.STATISTICS, Q.statistics("Ab cd cd### |\nAb cd cd### |\nx!"), strict=True))
    assert s["log_words"] == np.log1p(9) and s["distinct_words"] == 5 / 9 and s["top_word"] == 2 / 9 and s["equal_neighbours"] == 0
    assert s["repeated_lines"] == 1 - 2 / 3 and s["words_per_line"] == 3 and s["symbols"] == 8 / 9 and s["words_ending_in_symbol"] == 4 / 9
    assert s["words_without_letter"] == 2 / 9 and s["exclamations"] == 1 / 9 and s["repeated_triples"] == 1 - 5 / 7 and s["upper"] == 2 / 13
    assert not Q.statistics("").any() and not Q.statistics(" \n\x0b").any()


def test_held_out_documents(spark):
    scored = {r["doc_id"]: r for r in Q.op12_query(spark, SF).collect()}
    assert len(scored) == read_table(spark, SF, "documents").count()
    right = {0: [0, 0], 1: [0, 0]}
    for doc, quality in read_table(spark, SF, "labels").select("doc_id", "quality").collect():
        r = scored[doc]
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1
        if r["held_out"]:
            right[quality][r["predicted"] == quality] += 1
    wrong0, right0 = right[0]
    wrong1, right1 = right[1]
    assert right0 >= 0.97 * (wrong0 + right0) and right1 >= 0.99 * (wrong1 + right1)


def test_labels_of_held_out_rows_are_not_used(spark, tmp_path):
    docs = [(k, "good words in a sentence. " * (k % 7 + 1) if k % 2 else "bad### " * (k % 9 + 3)) for k in range(200)] + [(None, None), (None, "x"), (3, "good words."), (500, "word " * 400_000)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    results = []
    for flip in (0, 1):
        labels = [(k, (k % 2) ^ (flip and zlib.crc32(str(k).encode()) % 5 == 0), 0, 1.0) for k in range(200)] + [(None, 1, 0, 1.0), (7, None, 0, 1.0), (900, 1, 0, 1.0)]
        sf = tmp_path / f"flip{flip}"
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int, score double").write.parquet(str(sf / "labels.parquet"))
        spark.read.parquet(str(tmp_path / "documents.parquet")).write.parquet(str(sf / "documents.parquet"))
        results.append(sorted(map(tuple, Q.op12_query(spark, str(sf)).collect()), key=repr))
    assert results[0] == results[1] and len(results[0]) == len(docs)
    scores = {r[0]: r[2] for r in results[0]}
    assert all((scores[k] > 0.5) == bool(k % 2) for k in range(8, 200))


def test_no_labels_and_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(tuple, Q.op12_query(spark, str(tmp_path)).collect())) == [(1, False, 0.5, 1), (2, False, 0.5, 1)]
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "none" / "labels.parquet"))
    assert Q.op12_query(spark, str(tmp_path / "none")).collect() == []
