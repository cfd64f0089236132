"""Every stage of the corpus pipeline against plain Python: which documents stay, with which texts, and what the packed ids say."""

from __future__ import annotations

import importlib
import re

import numpy as np
import pytest

from medallion.llm import pieces, pii, quality, sharding, tokens
from medallion.llm.common import keyed, stage

SF = "/root/testdata/sf0.001"
BLANK = re.compile(r"[\x20\x09-\x0D]")


def texts(df) -> dict:
    return {r.doc_id: r.text for r in df.collect()}


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of every stage, each written and read again."""
    pipeline = importlib.import_module("corpus_pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, step in pipeline.STAGES:
        made = stage(step(spark, docs, SF), name)
        out[name] = (docs, made)
        docs = made
    return out


def test_quality_stage(spark, steps):
    before, after = steps["quality_rules"]
    kept = {r.doc_id for r in quality.op10_query(spark, SF).collect() if r.kept}
    was = texts(before)
    assert texts(after) == {i: was[i] for i in kept} and after.columns == before.columns


def test_exact_stage(steps):
    before, after = steps["exact_dedup"]
    was, keep = texts(before), {}
    for i, t in sorted(was.items(), key=lambda x: (-len(x[1] or ""), x[0])):
        keep.setdefault(BLANK.sub("", t or ""), i)
    assert texts(after) == {i: was[i] for i in keep.values()} and after.columns == before.columns


def test_near_stage(steps):
    before, after = steps["near_dedup"]
    was = texts(before)
    sets = {}
    for i, t in was.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in was}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    ids = sorted(was)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                least[y] = x
    assert texts(after) == {i: was[i] for i in was if find(i) == i} and after.columns == before.columns


def cut(text, found):
    """``text`` with its spans replaced, one after the other."""
    if text is None:
        return None
    out, at = [], 0
    for start, end, kind in sorted(found, key=lambda x: (x[0], -x[1], x[2])):
        if start >= at:
            out += [text[at:start], {"remove": "", "generalise": "<TERM>"}.get(kind, f"<{kind.upper()}>")]
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_personal_data_stage(steps):
    before, after = steps["pii"]
    rows, rid = keyed(before)
    of = {r[rid]: r.doc_id for r in rows.collect()}
    found: dict = {}
    for r in pii.spans(rows, "text", rid).collect():
        found.setdefault(of[r.rid], []).append((r.start, r.end, r.kind))
    assert texts(after) == {i: cut(t, found.get(i, [])) for i, t in texts(before).items()} and after.columns == before.columns
    assert found and not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t or "") for t in texts(after).values())


def test_packing_stage(steps):
    before, after = steps["packing"]
    rows = after.collect()
    ids: dict = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        piece = np.frombuffer(r.ids, "<u4")
        assert len(piece) == r.length and sum(map(len, ids.get(r.doc_id, []))) == r.start
        ids.setdefault(r.doc_id, []).append(piece)
    assert {i: np.concatenate(p).tolist() for i, p in ids.items()} == {i: [*tokens.encode(t or "").tolist(), 0] for i, t in texts(before).items()}
    ends: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048 and len(ends) <= 1.05 * np.ceil(sum(ends.values()) / 2048)


def test_sanitise_overlaps_clashing_columns_and_repeated_rows(spark, tmp_path):
    one = "x a@b.co 10.0.0.1@c.org é +1 (555) 123-4567 end"
    rows = [(1, one, "u", 0), (1, one, "u", 0), (2, None, "v", 1), (3, "", "w", 2), (None, "1.2.3.4", "z", 3), (4, "; q@w.ee " * 20_000, "s", 4)]
    spark.createDataFrame(rows, "doc_id long, text string, _state string, rid long").write.parquet(f"{tmp_path}/d.parquet")
    df = spark.read.parquet(f"{tmp_path}/d.parquet")
    keys, rid = keyed(df)
    found: dict = {}
    numbers = {r[rid]: r.rid for r in keys.collect()}
    for r in pii.spans(keys, "text", rid).collect():
        found.setdefault(numbers[r.rid], set()).add((r.start, r.end, r.kind))
    got = sorted((tuple(r) for r in pii.sanitise(df).collect()), key=lambda r: r[3])
    assert got == [(i, cut(t, found.get(n, set())), s, n) for i, t, s, n in rows]
    assert got[4][1] == "<IP>" and got[5][1] == "; <EMAIL> " * 20_000
    assert "<EMAIL>" in got[0][1] and "<PHONE>" in got[0][1] and "@" not in got[0][1].replace("<IP>@c.org", "")


def test_sharding_of_one_hot_row(spark, tmp_path, monkeypatch):
    """A third of the rows are one row; its copies come back in short runs, with gapless places."""
    monkeypatch.setattr(sharding, "RUN", 7)
    rows = [(None, None)] * 500 + [(k, f"t{k % 9}") for k in range(1000)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = sharding.op5_query(spark, str(tmp_path)).collect()
    assert len(got) == 1500 and sum(r.doc_id is None for r in got) == 500
    for s in range(16):
        here = sorted(r.slot for r in got if r.shard == s)
        assert here == list(range(len(here)))


def test_pieces_give_ids_and_texts_back(spark, tmp_path):
    rows = [(1, "a  b\n c é 漢字"), (2, None), (None, ""), (1, "a  b\n c é 漢字"), (3, "long words " * 200_000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = pieces.op4_query(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in got) == sorted((str(i), t or "") for i, t in rows)
    m = pieces.model(pieces.vocabulary_file(pieces.MODEL))
    assert all(r.n_pieces == len(r.ids) and m.decode(np.array(r.ids, np.int64)) == r.decoded for r in got)
