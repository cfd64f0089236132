"""Brute-force checks of the llm operators on small fixtures with nulls, empty, long and repeated texts and clashing columns."""

from __future__ import annotations

import hashlib
import importlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from medallion.llm import bwt, components, exact_dedup, lm_scoring, near_dedup, packing, pieces, pii, quality, queries, sharding, substring_dedup, tokens, url_filters
from medallion.llm.common import keyed, stage

SCHEMA = "doc_id long, text string, rid string, id string, n long, _rid long, t string, spans string"
BLANK = re.compile(r"[\x20\x09-\x0D]")


def fixture_rows() -> list[tuple]:
    r = random.Random(5)
    vocabulary = ["".join(r.choice(["th", "er", "on", "in", "é", "ß"]) for _ in range(r.randint(1, 4))) for _ in range(300)]

    def prose(n: int) -> str:
        return " ".join(r.choice(vocabulary) for _ in range(n))

    passage = prose(120)
    base = prose(150).split()
    texts = [None, "", " \n\t", "one", "a b c", prose(60), prose(400), prose(3000), passage, prose(30) + "\n" + passage + "\n" + prose(30), prose(20) + passage]
    texts += [texts[6], texts[6].replace(" ", "  "), texts[6].upper(), "\n".join(["same line of words"] * 40), "x" * 900, "ab" * 500, "   ▁ x"]
    for k in range(12):
        w = list(base)
        for _ in range(k):
            w[r.randrange(len(w))] = "new"
        texts.append(" ".join(w))
    texts += ["mail a@b.co, a@b.c..d@e.fr; 10.0.0.1 256.1.1.1 001.2.3.4 1.2.3.4.5", "card 4111 1111 1111 1111 and 4111-1111-1111-1112, +1 (555) 123-4567. +123", "<|endoftext|> <|endoftext|>x", "@@ 1..2 +1 . " * 30]
    rows = [(k, t, "x", "y", k, 7, "z", "w") for k, t in enumerate(texts)]
    return [*rows, rows[6], rows[8], (None, "lost words", "x", "y", 1, 7, "z", "w"), (None, None, None, None, None, None, None, None)]


ROWS = fixture_rows()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(5, 1, 0), (6, 1, None), (7, 1, 0), (14, 0, 0), (None, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    urls = ["http://a.example.com/x/y?q", "https://u@B.Example.com:80/x", None, "", "not a url", "http://example.com", "http://h0.org/a#b"] + [f"http://h{k}.org/s{k}/p" for k in range(60)]
    spark.createDataFrame([*enumerate(urls), (None, urls[0])], "page_id long, url string").write.parquet(f"{path}/pages.parquet")
    return path


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm-empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    spark.createDataFrame([], "page_id long, url string").write.parquet(f"{path}/pages.parquet")
    return path


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).collect() == []


def text_of(t):
    return t or ""


def key(x):
    return str(x)


def test_pii(spark, table):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def good(k, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.split(".")), "card": lambda: 13 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[k]()

    want = []
    for i, t, *_ in ROWS:
        found = [(k, m.start(), m.end()) for k, p in patterns.items() for m in re.finditer(p, text_of(t)) if good(k, m.group())]
        want.append((i, *[sum(f[0] == k for f in found) for k in patterns], hashlib.sha256(",".join("%s:%d:%d" % f for f in found).encode()).hexdigest()))
    got = [tuple(r)[:6] for r in pii.op1_query(spark, table).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_pii_terms_and_sanitise(spark, tmp_path):
    r = random.Random(3)
    filler = lambda: " ".join(r.choice(["the", "of", "and", "to"]) for _ in range(25))
    rows = [(k, f"{filler()} Zorblatt writes from z@corp.example to {filler()}") for k in range(8)] + [(100 + k, " ".join(filler() for _ in range(20))) for k in range(60)]
    spark.createDataFrame([*rows, (999, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert out[999] is None and out[100] == dict(rows)[100]
    for k in range(8):
        assert "<EMAIL>" in out[k] and "z@corp" not in out[k] and "Zorblatt" not in out[k]
        assert out[k].split()[:20] == dict(rows)[k].split()[:20]


def test_windows_score_every_class_once():
    from medallion.llm import attention

    r = np.random.default_rng(3)
    lengths = np.array([1, 15, 16, 17, 32, 33, 100, 1])
    classes = r.integers(0, 5, lengths.sum())
    x, y, owner = attention.windows(classes, lengths, 4, 5)
    at = 0
    for i, n in enumerate(lengths):
        own = classes[at : at + n]
        at += n
        assert y[owner == i].ravel()[:n].tolist() == own.tolist() and (y[owner == i].ravel()[n:] == -1).all()
        padded = [5] * 16 + [4, *own] + [5] * 32
        assert [w.tolist() for w in x[owner == i]] == [padded[j : j + 32] for j in range(0, n, 16)]


def test_lm(spark, table):
    rows = lm_scoring.op2_query(spark, table).collect()
    words = [(i, text_of(t).encode().lower().split()) for i, t, *_ in ROWS]
    count, ends = Counter(), 0
    for i, w in words:
        if not lm_scoring.held_out(i):
            count.update(w)
            ends += 1
    n, v = sum(count.values()) + ends, len(count) + 1
    want = sorted(((i, lm_scoring.held_out(i), len(w) + 1, sum(count[x] > 0 for x in w) + 1, n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1)), 6)) for i, w in words), key=key)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=key) == want
    assert all(r.score < 0 for r in rows)


def test_lm_learns(spark):
    rows = lm_scoring.score_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).filter("held_out").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    train = [np.append(tokens.encode(text_of(t)), tokens.END_ID).astype(np.int64) for i, t in docs.items() if not lm_scoring.held_out(i)]
    c = np.bincount(np.concatenate(train), minlength=tokens.VOCABULARY) + 0.5
    unigram = np.log10(c / c.sum())
    assert sum(r.score for r in rows) > sum(unigram[np.append(tokens.encode(text_of(docs[r.doc_id])), tokens.END_ID).astype(np.int64)].sum() for r in rows)


def test_lm_trains_on_every_document(spark):
    start = lm_scoring.initial_weights()
    class_of = (np.arange(tokens.VOCABULARY) % lm_scoring.CLASSES).astype(np.int32)
    ids = bytearray(np.arange(40, dtype="<u2").tobytes())
    for rid in range(6):
        alone = spark.createDataFrame([(rid, ids)], "rid long, ids binary")
        moved = [not np.allclose(lm_scoring.train_round(alone, class_of, start, turn), start) for turn in range(lm_scoring.ROUNDS)]
        assert sum(moved) == 1


def test_lm_score_equals_token_by_token(spark):
    """Every token's probability from its own context, one at a time, by the fitted weights."""
    from medallion.llm import attention

    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows, rid = keyed(df)
    split = stage(lm_scoring.split_texts(rows, "text", "doc_id", rid), "split")
    class_of, inside, weights = lm_scoring.fit(split)
    w = attention.shaped(weights, attention.initial(lm_scoring.CLASSES))
    own = weights[sum(x.size for x in w.values()) :].reshape(-1, attention.WIDTH)
    assert len(own) == tokens.VOCABULARY + 1 and np.abs(own).sum(1).astype(bool).sum() > 500  # ids have rows of their own
    e = w["e"][np.append(class_of, lm_scoring.CLASSES)] + own
    got = {r.rid: r.score for r in lm_scoring.model_scores(split).collect()}
    docs = split.filter("rid IS NOT NULL").select("rid", "ids").collect()
    for r in sorted(docs, key=lambda r: len(r.ids))[:: len(docs) // 8]:
        ids = np.frombuffer(r.ids, "<u2").astype(int)
        total = 0.0
        for t, goal in enumerate(ids):
            first = t // attention.HALF * attention.HALF - attention.HALF  # of the window that scores place t
            seen = [tokens.VOCABULARY if j < 0 else tokens.END_ID if j == 0 else ids[j - 1] for j in range(first, t + 1)]
            x = e[seen] + w["p"][: len(seen)]
            a = np.exp((x @ w["k"]) @ (x[-1] @ w["q"]) / attention.WIDTH**0.5)
            h = x[-1] + (a / a.sum()) @ (x @ w["v"])
            z = h @ w["o"] + w["b"]
            c = class_of[goal]
            before = class_of[tokens.END_ID if t == 0 else ids[t - 1]]
            total += (z[c] - np.log(np.exp(z).sum())) / np.log(10) + inside[before, goal]
        assert got[r.rid] == pytest.approx(total, rel=1e-4)
    assert np.allclose((10.0**inside).sum(1), lm_scoring.CLASSES, rtol=1e-3)  # within each class, probabilities add to 1


def test_attention_gradients():
    from medallion.llm import attention

    w = {k: v.astype(np.float64) for k, v in attention.initial(5).items()}
    x, y, _ = attention.windows(np.array(([4, 1, 2, 3, 0, 1, 2] * 5)[1:]), np.array([34]), 4, 5)
    g = attention.gradients(w, x, y)
    loss = lambda: -attention.log_probs(attention.tables(w), x, y).sum() / (y >= 0).sum()
    for name in ("e", "k", "q", "v", "o", "b", "p"):
        at = tuple(0 for _ in w[name].shape)
        before = w[name][at]
        w[name][at] = before + 1e-3
        up = loss()
        w[name][at] = before - 1e-3
        down = loss()
        w[name][at] = before
        assert g[name][at] == pytest.approx((up - down) / 2e-3, abs=1e-4)
    assert np.allclose(np.exp(attention.log_probs(attention.tables(w), np.repeat(x[:1], 5, 0), np.repeat(np.arange(5)[:, None], 16, 1))).sum(0), 1, atol=1e-5)


def test_adam_steps_as_dense():
    """Token rows, their moments and uses after some steps, by Adam over plain dictionaries of rows."""
    from medallion.llm import attention

    r = np.random.default_rng(8)
    classes, size = 5, 40
    class_of = np.append(r.integers(0, classes, size), classes)
    like = attention.initial(classes)
    values, rows = attention.flat(like), (r.standard_normal((size + 1, attention.WIDTH)) * 0.1).astype(np.float32)
    opt = attention.Adam(values, rows, class_of, like, 0.02)
    want, first, second = rows.astype(np.float64), np.zeros(rows.shape), np.zeros(rows.shape)
    uses = np.zeros(size + 1, np.int64)
    for n in range(1, 6):
        ids = r.integers(0, size // 2 if n % 2 else size, 90)  # some ids come back, some don't
        x, y, _ = attention.windows(ids, np.array([30, 60]), 7, size, class_of[ids])
        w = attention.shaped(opt.values.copy(), like)
        g = attention.gradients(w | {"e": w["e"][class_of] + opt.rows}, x, y)["e"].astype(np.float64)
        opt.step(x, y)
        for i in set(x.ravel().tolist()):
            uses[i] += int((x == i).sum())
            first[i] = 0.9 * first[i] + 0.1 * g[i]
            second[i] = 0.99 * second[i] + 0.01 * g[i] ** 2
            want[i] -= 0.02 * (first[i] / (1 - 0.9**n)) / (np.sqrt(second[i] / (1 - 0.99**n)) + 1e-8 / np.sqrt(1 - 0.99**n))
    assert opt.uses.tolist() == uses.tolist()
    assert np.allclose(opt.rows, want, atol=1e-4)
    assert (opt.rows[uses == 0] == rows[uses == 0]).all() and not np.allclose(opt.values, values)


def test_exact(spark, table):
    groups: dict[str, list] = {}
    for i, t, *_ in ROWS:
        groups.setdefault(BLANK.sub("", text_of(t)), []).append((-len(text_of(t)), i is None, i if i is not None else 0, i))
    want = []
    for n, g in groups.items():
        first = min(g)[3]
        want += [(x[3], first, len(g), hashlib.sha256(n.encode()).hexdigest()) for x in g]
    rows = exact_dedup.op3_query(spark, table).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=key) == sorted(want, key=key)
    assert sum(r.kept for r in rows) == len(groups)


def test_exact_with_colliding_fingerprints(spark, table, monkeypatch):
    plain = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.op3_query(spark, table).collect()}
    from medallion.llm.common import keyed

    monkeypatch.setattr(exact_dedup, "_fingerprints", lambda parts: [len(p) % 3 for p in parts])
    docs, rid = keyed(spark.read.parquet(f"{table}/documents.parquet").coalesce(1).select("doc_id", "text"))
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(exact_dedup)
    try:
        got = {(r.id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs, "text", rid, "doc_id").collect()}
    finally:
        cloudpickle.unregister_pickle_by_value(exact_dedup)
    assert {g[:3] for g in got} == {p[:3] for p in plain}


def test_pieces(spark, table):
    m = pieces.model(pieces.vocabulary_file(pieces.MODEL))
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.vocabulary_file(pieces.MODEL))
    score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    for _, t, *_ in ROWS:
        t = text_of(t)[:400]
        s = "▁" + t.replace(" ", "▁") if t else ""
        best = [0.0] * (len(s) + 1)
        for e in range(1, len(s) + 1):
            best[e] = max([best[e - 1] + m.unknown, *[best[k] + score[s[k:e]] for k in range(max(0, e - 16), e) if s[k:e] in score]])
        ids = m.encode(t).tolist()
        total, k = 0.0, 0
        while k < len(ids):
            if sp.is_byte(ids[k]):
                lead = m.raw[ids[k]][0]
                total, k = total + m.unknown, k + (1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4)
            else:
                total, k = total + m.scores[ids[k]], k + 1
        assert total == best[-1] and m.decode(np.array(ids, np.int64)) == t.replace("▁", " ")
    rows = pieces.op4_query(spark, table).collect()
    assert len(rows) == len(ROWS) and all(r.round_trip for r in rows)
    ids = pieces.encode(spark.read.parquet(f"{table}/documents.parquet"), "text", "doc_id")
    back = pieces.decode(ids, "ids", "doc_id")
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(i), text_of(t).replace("▁", " ")) for i, t, *_ in ROWS)


def test_sharding(spark, table):
    def one(k, n):
        b, j = -1, 0
        while j < n:
            b, k = j, (k * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * (2**31 / ((k >> 33) + 1)))
        return b

    rows = sharding.op5_query(spark, table).collect()
    want = []
    for i, t, *_ in ROWS:
        raw = text_of(t).encode()
        k = int(hashlib.sha256(b"" if i is None else str(i).encode()).hexdigest()[:16], 16)
        want.append((i, len(raw) + 1, zlib.crc32(raw), one(k, 16), one(k, 17)))
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in rows), key=key) == sorted(want, key=key)
    for s in range(16):
        here = sorted(r.slot for r in rows if r.shard == s)
        assert here == list(range(len(here)))
    assert all(r.grown_shard in (r.shard, 16) for r in rows)


def test_near_bucket_of_several_blocks(spark, tmp_path, monkeypatch):
    """Buckets that are dealt into many blocks give the links of whole ones."""
    r = random.Random(12)
    words = [f"w{k}" for k in range(400)]
    rows, base = [], [[r.choice(words) for _ in range(60)] for _ in range(6)]
    for k in range(240):
        w = list(base[k % 6])
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"n{r.randint(0, 9)}"
        rows.append((k, " ".join(w)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    whole = sorted((x.doc_id, x.component_id) for x in near_dedup.op7_query(spark, str(tmp_path)).collect())
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 3)
    monkeypatch.setattr(near_dedup, "EASY", 10**9)  # everything meets after the first round
    assert sorted((x.doc_id, x.component_id) for x in near_dedup.op7_query(spark, str(tmp_path)).collect()) == whole


def test_near(spark, table):
    sets = []
    for i, t, *_ in ROWS:
        w = text_of(t).encode().lower().split()
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= 75 * len(sets[a][1] | sets[b][1]):
                root[find(a)] = find(b)
    least: dict[int, tuple] = {}
    for a, (i, _) in enumerate(sets):
        least[find(a)] = min(least.get(find(a), (True, 0)), (i is None, i or 0))
    want = sorted(((i, len(s), None if least[find(a)][0] else least[find(a)][1]) for a, (i, s) in enumerate(sets)), key=key)
    rows = near_dedup.op7_query(spark, table).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=key) == want
    kept = near_dedup.drop_near_copies(spark.read.parquet(f"{table}/documents.parquet"))
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert kept.count() == len(least)


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 340)]
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {x.node: x.root for x in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: m for x, m in root.items() if x in got} and all(a == b for a, b in edges if a not in got)


def test_bwt():
    r = random.Random(2)
    for _ in range(150):
        n = r.choice([1, 2, 3, 5, 8, 13])
        strings = [bytes(r.choice(b"abc\x00\xff") for _ in range(r.randint(0, 40))) for _ in range(r.randint(1, 6))] + [b"ab" * 9]
        seen = Counter(s[i : i + n] for s in strings for i in range(len(s) - n + 1))
        for s, hit in zip(strings, bwt.repeated_starts(strings, n), strict=True):
            assert hit.tolist() == [seen[s[i : i + n]] > 1 for i in range(len(s) - n + 1)]


@pytest.mark.parametrize("many", [2048, 1])
def test_suffix(spark, table, monkeypatch, many):
    monkeypatch.setattr(substring_dedup, "MANY", many)
    data = [text_of(t).encode() for _, t, *_ in ROWS]
    seen = Counter(d[i : i + 400] for d in data for i in range(len(d) - 399))
    want = []
    for (doc, *_), d in zip(ROWS, data, strict=True):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - 399):
            if seen[d[i : i + 400]] > 1:
                gone[i : i + 400] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        want.append((doc, len(d), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(d, np.uint8)[~gone])).hexdigest()))
    assert sorted(map(tuple, substring_dedup.op8_query(spark, table).collect()), key=key) == sorted(want, key=key)


def test_suffix_stages_only_what_is_read_twice_or_dear(spark, table, monkeypatch):
    names, joins = [], {}

    def recorded(df, name):
        names.append(name)
        plan = df._jdf.queryExecution().executedPlan().toString()
        joins[name] = plan.count("SortMergeJoin") + plan.count("HashJoin")
        return stage(df, name)

    monkeypatch.setattr(substring_dedup, "stage", recorded)
    substring_dedup.op8_query(spark, table)
    assert sorted(names) == ["digests", "judged", "segments", "shared-segments", "texts", "windows"]
    assert joins["texts"] == 2  # digests with their minimiser's count, then with the documents: fetched texts aren't joined again


def test_tokens_equal_the_json_vocabulary():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary_file("byte_bpe_50k.json"))
    for _, text, *_ in ROWS:
        assert tokens.encode(text_of(text)).tolist() == t.encode(text_of(text), add_special_tokens=False).ids


def test_packing(spark, table):
    rows = packing.op9_query(spark, table).collect()
    whole = sorted(((i, len(tokens.encode(text_of(t))) + 1) for i, t, *_ in ROWS), key=key)
    total: Counter = Counter()
    for r in rows:
        total[r.doc_id] += r.length
    assert total == sum((Counter({i: n}) for i, n in whole), Counter())
    places: dict[int, list] = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for o, n in sorted(p):
            assert o == at
            at += n
        assert at <= 2048
    ids = {i: np.append(tokens.encode(text_of(t)), 0).astype("<u4") for i, t, *_ in ROWS if i is not None}
    for r in rows:
        if r.doc_id is not None:
            assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())


def test_packing_is_close_to_the_bound():
    r = np.random.default_rng(1)
    lengths = np.minimum(2048, r.lognormal(6, 1, 20000).astype(int) + 1)
    made = packing.plan({int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True), strict=True)})
    assert made.sequences <= 1.005 * math.ceil(lengths.sum() / 2048)


def test_quality(spark, table):
    rows = quality.op10_query(spark, table).collect()
    want = []
    for i, t, *_ in ROWS:
        t = text_of(t)
        w = [x for x in BLANK.split(t) if x]
        lines = [x for x in t.split("\n") if BLANK.sub("", x)]
        grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        inside = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside), len(w) < 50 or 100 * len(inside) > 50 * len(w)))
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows), key=key)
    assert got == sorted(want, key=key)
    assert all(not r.kept for r in rows if r.base_failed)


def test_quality_score(spark):
    """The log-likelihood ratio against a plain count of the same hashed n-grams, and labelled documents."""
    from pyspark.sql import functions as F

    from medallion.llm.common import keyed

    docs, rid = keyed(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = {r.id for r in quality.trusted_ids(labels).collect()}
    grams: dict[int, list] = {}
    for r in quality.ngrams(docs, "text", F.col("doc_id")).collect():
        grams.setdefault(r.doc_id, []).append(r.bucket)
    raw = Counter(b for g in grams.values() for b in g)
    target = Counter(b for i, g in grams.items() if i in good for b in g)
    shift = math.log((sum(raw.values()) + quality.BUCKETS) / (sum(target.values()) + quality.BUCKETS))
    score = {i: sum(shift + math.log((max(target[b], 1) if i in good else target[b] + 1) / raw[b]) for b in g) / len(g) for i, g in grams.items()}
    got = {r.doc_id: r for r in quality.op10_query(spark, "/root/testdata/sf0.01").collect()}
    assert all(got[i].llr == pytest.approx(s, abs=1e-9) for i, s in score.items())
    marks = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(got[i].kept, q) for i, q in marks.items() if not got[i].base_failed]
    assert sum(k for k, q in judged if q == 1) >= 0.97 * sum(q == 1 for _, q in judged)
    assert sum(not k for k, q in judged if q == 0) >= 0.8 * sum(q == 0 for _, q in judged)


def test_quality_drops_nearly_all_bad_documents(spark):
    got = {r.doc_id: r for r in quality.op10_query(spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    judged = [(got[r.doc_id].kept, r.quality) for r in labels if not got[r.doc_id].base_failed]
    assert sum(k for k, q in judged if q == 1) >= 0.99 * sum(q == 1 for _, q in judged)
    assert sum(not k for k, q in judged if q == 0) >= 0.99 * sum(q == 0 for _, q in judged)


def test_quality_threshold_follows_the_trusted_scores(spark):
    scores = lambda *x: spark.createDataFrame([(float(v),) for v in x], "llr double")
    assert quality.threshold(scores()) is None
    assert quality.threshold(scores(*range(10, 20))) == 10
    assert quality.threshold(scores(-1000, *range(10, 20))) == 10


def test_urls(spark, table):
    rows = {r.page_id: r for r in url_filters.op6_query(spark, table).collect()}
    assert len(rows) == 68 and all(rows[k].kept and rows[k].n_active == 0 for k in (2, 3, 4, None))
    entries = spark.createDataFrame([("example.com", "block", 1, "add"), ("example.com", "block", 5, "remove"), ("b.example.com/x", "allow", 2, "add"), ("example.com", "block", 9, "add"), ("example.com", "block", 9, "remove")], "pattern string, list string, listed_at long, action string")
    captures = spark.createDataFrame([(k, u, t) for k, (u, t) in enumerate([("http://a.example.com/x/y", 0), ("http://a.example.com/", 1), ("http://b.example.com:8/x/z", 3), ("http://b.example.com/y", 3), ("http://a.example.com/", 5), ("http://a.example.com/", 9), ("http://badexample.com/", 3), (None, 3), ("http://a.example.com/", None)])], "rid long, url string, at long")
    kept = {r.rid for r in captures.join(url_filters.judge(captures, entries, "url", "at", "rid").filter("list = 'block'").select("rid"), "rid", "left_anti").collect()}
    assert kept == {0, 2, 4, 5, 6, 7, 8}


def test_pipeline(spark, table, empty):
    pipeline = importlib.import_module("corpus_pipeline")
    assert pipeline.run(spark, empty).collect() == []
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = {r.doc_id for r in quality.op10_query(spark, "/root/testdata/sf0.001").collect() if r.kept}
    step = docs
    from medallion.llm.common import stage

    for name, f in pipeline.STAGES[:-1]:
        step = stage(f(spark, step, "/root/testdata/sf0.001"), name)
        assert step.columns == docs.columns
        rows = {r.doc_id: r.text for r in step.collect()}
        if name == "quality_rules":
            assert set(rows) == kept
        elif name == "exact_dedup":
            texts = [BLANK.sub("", text_of(t)) for t in rows.values()]
            assert len(texts) == len(set(texts)) and set(rows) <= kept
    last = pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in last} == set(rows)
    assert sum(r.length for r in last) == sum(len(tokens.encode(text_of(t))) + 1 for t in rows.values())
