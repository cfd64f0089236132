"""Maximal periodic runs of words by uniting suffix classes in order of decreasing common prefix.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends, of at least
``MIN_LENGTH`` words and ``MIN_EXPONENT`` periods. Texts are taken a batch at a time, whole:

1. Words become numbers; positions whose ``GRAM`` words come again in the same text are marked. Others share
   fewer words with any suffix than a run needs, so only marked suffixes are sorted, by doubling ranks.
2. Neighbours in that order are edges weighted by the words they share (LCP). Kruskal: edges are taken by
   decreasing LCP; union-find keeps each class as an ordered list of positions, the smaller list joins the larger.
3. After all edges of one LCP l, positions i < j that became neighbours in a class with j - i <= l are a seed:
   words i .. j+l-1 have period j - i and can't be extended to the right. Seeds that can't be extended to the
   left are the runs. Why each run comes once, with its smallest period: for a run of period q and start s the
   suffixes s and s+q meet at LCP length-q >= q; a position between them in that class would, by Fine and Wilf,
   give a period that divides q. Where j - i is no smallest period, the smallest one lies between them.

Classes never cross texts, so a batch may hold any number of them. Null and empty texts have no words and no
runs. Ties, repeated rows and clashing column names need no care: each row is judged by itself.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from medallion.llm.common import col, read_table, text_or_empty

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: A run of length n and period q has n - q >= GRAM words in common at distance q.
GRAM = 5
#: Words of a batch of texts; a longer text is a batch of its own.
BATCH_WORDS = 1 << 19
_ODD = np.random.default_rng(13).integers(1, 1 << 63, GRAM + 1, dtype=np.uint64) | np.uint64(1)

Run = tuple[int, int, int]  # start, length, period


def repeated_grams(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Positions whose GRAM words come again in the same text. ``words`` has numbers above 0."""
    n = len(words) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    mark = owner[:n].astype(np.uint64) * _ODD[GRAM]
    for k in range(GRAM):
        mark = (mark ^ words[k : k + n].astype(np.uint64)) * _ODD[k]
        mark ^= mark >> np.uint64(29)
    inside = np.flatnonzero(owner[:n] == owner[GRAM - 1 :])
    order = inside[np.argsort(mark[inside], kind="stable")]
    equal = mark[order[1:]] == mark[order[:-1]]
    return np.sort(order[np.concatenate([equal, [False]]) | np.concatenate([[False], equal])])


def sorted_suffixes(words: np.ndarray, owner: np.ndarray, end: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The marked suffixes in order (text, then words), and the words each shares with the one before it.

    ``end``: for each position the end of its text. Ranks of GRAM words come from the words themselves; ranks of
    twice as many from pairs of ranks, for the suffixes that are still equal. A rank is the place of the class's
    first suffix, so ranks of different rounds can be compared."""
    total = len(words)
    spots = np.unique(np.concatenate([marked, np.minimum(marked + GRAM, total)]))
    spots = spots[spots < total]  # a marked position and the one after its words
    keys = [np.where(spots + k < end[spots], words[np.minimum(spots + k, total - 1)], 0) for k in range(GRAM)]
    order = np.lexsort([*keys[::-1], owner[spots]])
    fresh = np.ones(len(spots), bool)
    if len(spots) > 1:
        fresh[1:] = owner[spots[order[1:]]] != owner[spots[order[:-1]]]
        for key in keys:
            fresh[1:] |= key[order[1:]] != key[order[:-1]]
    rank = np.empty(len(spots), np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(spots)), 0))
    levels = [(GRAM, rank)]

    def at(where: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Ranks of positions; -1 where the text has ended, below that (all different) where none is known."""
        i = np.minimum(np.searchsorted(spots, where), len(spots) - 1)
        return np.where(spots[i] == where, ranks[i], -2 - np.arange(len(where)))

    width = GRAM
    while True:
        sizes = np.bincount(rank, minlength=len(spots))
        open_ = np.flatnonzero(sizes[rank] > 1)
        if not len(open_):
            break
        ahead = spots[open_] + width
        second = np.where(ahead < end[spots[open_]], at(np.minimum(ahead, total - 1), rank), -1)
        by = np.lexsort([second, rank[open_]])
        first, second = rank[open_][by], second[by]
        head = np.concatenate([[True], first[1:] != first[:-1]])
        fresh = head.copy()
        fresh[1:] |= second[1:] != second[:-1]
        place = np.arange(len(by))
        new = first + np.maximum.accumulate(np.where(fresh, place, 0)) - np.maximum.accumulate(np.where(head, place, 0))
        rank = rank.copy()
        rank[open_[by]] = new
        width *= 2
        levels.append((width, rank))

    chosen = np.isin(spots, marked)
    suffixes = spots[chosen][np.argsort(rank[chosen], kind="stable")]
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    shared = np.zeros(len(a), np.int64)
    same = owner[a] == owner[b]
    for width, ranks in reversed(levels):
        live = np.flatnonzero(same & (a + width <= end[suffixes[:-1]]) & (b + width <= end[suffixes[1:]]))
        ra, rb = at(a[live], ranks), at(b[live], ranks)
        hit = live[(ra == rb) & (ra >= 0)]
        a[hit] += width
        b[hit] += width
        shared[hit] += width
    live = np.flatnonzero(same)
    for _ in range(GRAM - 1):
        live = live[(a[live] < end[suffixes[:-1][live]]) & (b[live] < end[suffixes[1:][live]])]
        live = live[words[a[live]] == words[b[live]]]
        a[live] += 1
        b[live] += 1
        shared[live] += 1
    return suffixes, shared


def seeds(suffixes: np.ndarray, shared: np.ndarray, starts: np.ndarray, words: np.ndarray) -> list[tuple[int, int, int]]:
    """(i, j, l) of positions that became neighbours in a class at LCP l >= MIN_EXPONENT - 1 times j - i, and that differ
    in the word before them (``starts``: first positions of texts)."""
    edges = np.flatnonzero(shared >= GRAM)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    first = set(starts.tolist())
    left, right, lcps = suffixes[edges].tolist(), suffixes[edges + 1].tolist(), shared[edges].tolist()
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    found: list[tuple[int, int, int]] = []
    waiting: list[tuple[int, int]] = []

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    def settle(level: int) -> None:
        """Seeds among the pairs of this level that are neighbours now that all its edges are in."""
        for i, j in waiting:
            if i not in first and words[i - 1] == words[j - 1]:
                continue
            same = members[root(i)]
            if same[bisect_left(same, i) + 1] == j:
                found.append((i, j, level))
        waiting.clear()

    level = lcps[0] if lcps else 0
    for a, b, lcp in zip(left, right, lcps, strict=True):
        if lcp != level:
            settle(level)
            level = lcp
        reach = lcp // (MIN_EXPONENT - 1)
        ra, rb = root(a), root(b)
        one, two = members.pop(ra, None) or [ra], members.pop(rb, None) or [rb]
        if len(one) < len(two):
            one, two, ra, rb = two, one, rb, ra
        parent[rb] = ra
        if len(two) * 8 < len(one):
            for x in two:
                insort(one, x)
        else:
            one = sorted(one + two)
        members[ra] = one
        for x, back, ahead in zip(two, [None, *two], [*two[1:], None], strict=False):  # a new pair has one side in the smaller list
            k = bisect_left(one, x)
            if k and one[k - 1] != back and x - one[k - 1] <= reach:
                waiting.append((one[k - 1], x))
            if k + 1 < len(one) and one[k + 1] != ahead and one[k + 1] - x <= reach:
                waiting.append((x, one[k + 1]))
    settle(level)
    return found


def runs_of(texts: list[np.ndarray]) -> list[list[Run]]:
    """The runs of each text (arrays of word numbers above 0), by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    stops = np.cumsum(sizes)
    starts = stops - sizes
    out: list[list[Run]] = [[] for _ in texts]
    words = np.concatenate([*texts, np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    marked = repeated_grams(words, owner)
    if not len(marked):
        return out
    suffixes, shared = sorted_suffixes(words, owner, np.repeat(stops, sizes), marked)
    for i, j, lcp in sorted(set(seeds(suffixes, shared, starts, words))):
        length, period = j - i + lcp, j - i
        if length >= max(MIN_LENGTH, MIN_EXPONENT * period):
            t = owner[i]
            out[t].append((int(i - starts[t]), length, period))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words no run contains after its first period."""
    keep = np.ones(n, bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return keep


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest exponent; of equal ones the one that starts first, then has the smallest period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def periodic_edit(n: int, h: int | None) -> tuple[int, int] | None:
    """Start and period of the repetition that op13 plants in a text of n words with id checksum h."""
    if h is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def batches_of_words(batches: Iterator[pa.RecordBatch], planted: bool) -> Iterator[tuple[pa.Array, list[list[bytes]], list[np.ndarray]]]:
    """Ids, words and word numbers of texts, up to about BATCH_WORDS words at a time."""
    for b in batches:
        ids, texts = b.column("id"), b.column("t")
        done, words, numbers, total, known = 0, [], [], 0, {}
        for k in range(len(texts)):
            w = texts[k].as_py().encode().split()
            if planted and ids[k].is_valid and (edit := periodic_edit(len(w), zlib.crc32(str(ids[k].as_py()).encode()))):
                a, p = edit
                w[a:] = [w[a + i % p] for i in range(len(w) - a)]
            words.append(w)
            numbers.append(np.array([known.setdefault(x, len(known) + 1) for x in w], np.int64))
            total += len(w)
            if total >= BATCH_WORDS or k == len(texts) - 1:
                yield ids.slice(done, k + 1 - done), words, numbers
                done, words, numbers, total, known = k + 1, [], [], 0, {}


def periodic_runs(df: DataFrame, text: str = "text", id_col: str = "doc_id", planted: bool = False) -> DataFrame:
    """Per row: id, n_words, runs (array of start, length, period), collapsed (the kept words joined by one space).

    ``planted`` first repeats part of some texts, as op13 asks; ids are read as their decimal text, and a null id
    plants nothing."""
    src = df.select(col(id_col).alias("id"), text_or_empty(text).alias("t"))
    kind = dict(src.dtypes)["id"]
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words, numbers in batches_of_words(batches, planted):
            found = runs_of(numbers)
            flat = np.array([r for rs in found for r in rs], np.int64).reshape(-1, 3)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(item))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in found])]), pa.int32())
            kept = [b" ".join([w[i] for i in np.flatnonzero(kept_words(len(w), rs))] if rs else w).decode() for w, rs in zip(words, found, strict=True)]
            arrays = [ids, pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(offsets, structs), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "runs", "collapsed"])

    return src.mapInArrow(run, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def summaries(found: DataFrame) -> DataFrame:
    """op13's columns of ``periodic_runs``' result, in one more pass over its rows."""
    kind = dict(found.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            per_row, best = b.column("runs").to_pylist(), []
            for rs in per_row:
                r = strongest([(x["start"], x["length"], x["period"]) for x in rs])
                best.append((*r, 1000 * r[1] // r[2]) if r else (None,) * 4)
            lines = ["".join(f"{x['start']},{x['length']},{x['period']}\n" for x in rs) for rs in per_row]
            columns = list(zip(*best, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id"), pa.array([len(rs) for rs in per_row], pa.int64()), *[pa.array(c, pa.int64()) for c in columns],
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in lines], pa.string()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in b.column("collapsed").to_pylist()], pa.string()),
                ],
                ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
            )

    return found.mapInArrow(run, f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def op13_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return summaries(periodic_runs(docs, planted=True))
