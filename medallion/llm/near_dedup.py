"""MinHash near-dedup: universal hash minima, banding, signature check, exact check, components.

A document's set holds the distinct windows of five words (A-Z lower-cased, words are runs
outside [\\x20\\x09-\\x0D]; a shorter text is one window, an empty one has no set and is linked
with nothing). Windows are 64-bit hashes.

1. One pass gives each document its word-sequence digest, set size, 48 band keys over 5 minima
   each (a pair at similarity 0.75 shares no band with probability 2e-6) and a sketch of one
   bit of each of the 240 minima. Documents with one digest are a class; classes are the nodes.
2. In each band bucket one class, another one each round, is paired with the members of
   other components. Pairs whose sketches and sizes allow 0.75 (six standard deviations below) are
   confirmed on the full sets, and large-star / small-star joins the components.
3. Buckets whose members are in one component are done: further links could not change the
   result. When the pairs between the components of the remaining buckets are no more than a few
   per member (or a round finds next to nothing), all of them are met: members outside a bucket's
   largest component with the members of other components, one pair of blocks at a time, on full
   sets. Only links leave a pair of blocks. So no link between components is lost, and a large group
   of copies never becomes all its pairs.

There are no caps on buckets, partners or candidates. Rows with a null id form classes too;
null sorts last when the smallest id is taken. Repeated rows share a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import col, keyed, read_table, slices, stage, text_or_empty
from medallion.llm.components import components

WORDS = 5
BANDS, ROWS = 48, 5
HASHES = BANDS * ROWS
#: 0.75 of the sets' sizes; bits in which two sketches may differ: 240 * 0.125 plus six standard deviations.
PERCENT = 75
MAX_BITS = 61
#: Members and bytes of sets of a block; a group holds two blocks.
BLOCK_MEMBERS, BLOCK_BYTES = 512, 1 << 25
_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(1, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_ODD = _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)
_BAND_SEED = _RNG.integers(1, 1 << 63, BANDS, dtype=np.uint64)
BLOCK = 1 << 13
#: Pairs for each member of a shared bucket up to which all pairs between components are met at once.
EASY = 4
#: Words whose hashes a worker keeps (a few MB), and rows that are worked on at a time.
CACHED_WORDS, ROWS_AT_ONCE = 50_000, 256
_CACHE: dict[bytes, int] = {}


def _word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_CACHE) > CACHED_WORDS:  # bounded memory; values do not depend on it
        _CACHE.clear()
    get, put = _CACHE.get, xxhash.xxh3_64_intdigest
    out = []
    for w in words:
        h = get(w)
        if h is None:
            h = _CACHE[w] = put(w)
        out.append(h)
    return np.array(out, np.uint64)


def shingle_set(text: str) -> tuple[np.ndarray, list[bytes]]:
    """Sorted distinct 64-bit hashes of the windows, and the words."""
    words = text.encode().lower().split()
    h = _word_hashes(words)
    if len(h) == 0:
        return h, words
    n = max(1, len(h) - WORDS + 1)
    s = np.zeros(n, np.uint64)
    for k in range(min(WORDS, len(h))):
        s += h[k : k + n] * _ODD[k]
    s += np.uint64(min(WORDS, len(h)))
    s ^= s >> np.uint64(29)
    s *= _ODD[6]
    s ^= s >> np.uint64(32)
    return np.unique(s), words


def minima(shingles: np.ndarray) -> np.ndarray:
    x = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), BLOCK):
        part = x[i : i + BLOCK]
        for j in range(0, HASHES, 16):
            np.minimum(best[j : j + 16], (_A[j : j + 16, None] * part + _B[j : j + 16, None]).min(1), out=best[j : j + 16])
    return best


def band_keys(best: np.ndarray) -> np.ndarray:
    b = best.reshape(BANDS, ROWS).astype(np.uint64)
    key = _BAND_SEED.copy()
    for k in range(ROWS):
        key = (key ^ b[:, k]) * _ODD[k]
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def sketch(best: np.ndarray) -> np.ndarray:
    """One bit of each minimum, as four longs."""
    bits = ((best * np.uint32(2654435761)) >> np.uint32(31)).astype(np.uint8)
    return np.packbits(np.concatenate([bits, np.zeros(256 - HASHES, np.uint8)])).view(np.int64)


def signatures(df: DataFrame, text: str, rid: str, id_col: str) -> DataFrame:
    """rid, id, n (set size), c0, c1 (digest of the word sequence), bands, s0 to s3 (sketch)."""
    src = df.select(col(rid).alias("rid"), col(id_col).alias("id"), text_or_empty(text).alias("t"))
    kind = dict(src.dtypes)["id"]
    marks = [f"s{k}" for k in range(4)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, ROWS_AT_ONCE):
            n, digests, bands, bits = [], [], [], []
            for t in b.column("t").to_pylist():
                s, words = shingle_set(t)
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
                best = minima(s)
                bands.append(band_keys(best) if len(s) else None)
                bits.append(sketch(best))
            two = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            all_ = np.array(bits, np.int64).reshape(-1, len(marks))
            arrays = [b.column("rid"), b.column("id"), pa.array(n, pa.int64()), *[pa.array(np.ascontiguousarray(two[:, k])) for k in (0, 1)]]
            arrays += [pa.array(bands, pa.list_(pa.int64())), *[pa.array(np.ascontiguousarray(all_[:, k])) for k in range(len(marks))]]
            yield pa.RecordBatch.from_arrays(arrays, ["rid", "id", "n", "c0", "c1", "bands", *marks])

    return src.mapInArrow(run, f"rid long, id {kind}, n long, c0 long, c1 long, bands array<long>, " + ", ".join(f"{m} long" for m in marks))


def _may_match(a: str, b: str) -> Column:
    """The sizes and sketches of two sides (struct columns) allow a similarity of 0.75."""
    differ = sum((F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))) for k in range(1, 4)), F.bit_count(F.col(f"{a}.s0").bitwiseXOR(F.col(f"{b}.s0"))))
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (small * 100 >= large * PERCENT) & (differ <= MAX_BITS)


def full_sets(nodes: DataFrame, docs: DataFrame, text: str, rid: str) -> DataFrame:
    """rid, shingles: the whole set of each row whose number is in ``nodes`` (column node)."""
    src = docs.select(col(rid).alias("rid"), text_or_empty(text).alias("t")).join(nodes, F.col("rid") == F.col("node"), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, ROWS_AT_ONCE):
            found = [shingle_set(t)[0].tobytes() for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("rid"), pa.array(found, pa.binary())], ["rid", "shingles"])

    return src.mapInArrow(sets, "rid long, shingles binary")


def confirm(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (u, v) of row numbers whose full sets have 100 * intersection >= 75 * union."""
    both = (
        pairs.join(known.select(F.col("rid").alias("u"), F.col("shingles").alias("a")), "u")
        .join(known.select(F.col("rid").alias("v"), F.col("shingles").alias("b")), "v")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            keep = []
            for x, y in zip(batch.column("a"), batch.column("b"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(p) + len(q) - len(np.union1d(p, q))
                keep.append(100 * common >= PERCENT * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return both.select("u", "v", "a", "b").mapInArrow(check, "u long, v long")


def meet(rest: DataFrame, known: DataFrame) -> DataFrame:
    """Links (u, v) between the components of each bucket, on full sets.

    ``rest``: key, x (class, size and sketch), root, top (root of the bucket's largest component), n and long_ (members
    and windows of the bucket). A bucket is dealt into blocks of about ``BLOCK_MEMBERS`` members or ``BLOCK_BYTES`` of
    sets; each pair of blocks is a group of its own, in which the members of the one outside the largest component
    meet those of the other. So a group holds two blocks at most, however large the bucket, and only links leave it."""
    k = F.greatest(F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("long_") * 8 / BLOCK_BYTES)).cast("long")
    rows = rest.select("key", "x", "root", "top", k.alias("k")).join(known, F.col("x.nid") == F.col("rid"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("x.nid"), F.col("k")))
    blocks = F.sequence(F.lit(0).cast("long"), F.col("k") - 1)
    data = ["x.nid", "x.n", "root", "top", *[f"x.s{j}" for j in range(4)], "shingles"]
    placed = rows.select("key", F.explode(blocks).alias("i"), F.col("own").alias("j"), *data, F.lit(False).alias("minor"))
    sent = rows.filter("root <> top").select("key", F.col("own").alias("i"), F.explode(blocks).alias("j"), *data, F.lit(True).alias("minor"))

    def check(t: pa.Table) -> pa.Table:
        nid, n, root, top = (t.column(c).to_numpy() for c in ("nid", "n", "root", "top"))
        bits = np.stack([t.column(f"s{j}").to_numpy() for j in range(4)], 1)
        minor = t.column("minor").to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("shingles")]
        here = np.flatnonzero(~minor)
        u, v = [], []
        for y in np.flatnonzero(minor):
            can = here[(root[here] != root[y]) & ((root[here] == top[here]) | (nid[here] < nid[y]))]
            can = can[100 * np.minimum(n[can], n[y]) >= PERCENT * np.maximum(n[can], n[y])]
            can = can[np.bitwise_count((bits[can] ^ bits[y]).view(np.uint64)).sum(1) <= MAX_BITS]
            if not len(can):
                continue
            ends = np.cumsum([len(sets[x]) for x in can])
            pool = np.concatenate([sets[x] for x in can])
            at = np.minimum(np.searchsorted(sets[y], pool), len(sets[y]) - 1)
            common = np.add.reduceat((sets[y][at] == pool).astype(np.int64), np.concatenate([[0], ends[:-1]]))
            for x in can[100 * common >= PERCENT * (n[can] + n[y] - common)]:
                u.append(min(nid[x], nid[y]))
                v.append(max(nid[x], nid[y]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return placed.union(sent).groupBy("key", "i", "j").applyInArrow(check, "u long, v long")


def link_classes(members: DataFrame, docs: DataFrame, text: str, rid: str) -> DataFrame:
    """(key, x) band buckets -> (node, root) of every class that is linked with another one."""
    spark = members.sparkSession
    crowded = stage(members.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key"), "crowded")
    shared = stage(members.join(crowded, "key"), "shared")  # members of buckets that have two at least
    known = stage(full_sets(shared.select(F.col("x.nid").alias("node")).distinct(), docs, text, rid), "sets")
    size = shared.count()
    roots = spark.createDataFrame([], "node long, root long")
    idle, turn = False, 0
    while True:
        placed = shared.join(roots, F.col("x.nid") == F.col("node"), "left").select("key", "x", F.coalesce("root", "x.nid").alias("root"))
        of_root = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"), F.sum("x.n").alias("long_"), F.min(F.struct(F.xxhash64("x.nid", F.lit(turn)).alias("h"), F.col("x"))).alias("p"))
        open_ = of_root.groupBy("key").agg(F.max(F.struct("m", "root")).alias("top"), F.sum("m").alias("n"), F.sum("long_").alias("long_"), F.count(F.lit(1)).alias("k"), F.min(F.struct("p", "root")).alias("pivot"))
        open_ = stage(open_.filter("k > 1").select("key", F.col("top.root").alias("top"), F.col("pivot.p.x").alias("y"), F.col("pivot.root").alias("root2"), "n", "long_", (F.col("n") * (F.col("n") - F.col("top.m"))).alias("cost")), "open")
        cost = open_.agg(F.sum(F.col("cost").cast("double"))).first()[0] or 0
        if not cost:
            return roots
        rest = placed.join(open_, "key")
        last = turn > 0 and (cost <= EASY * size or idle)
        if last:
            links = stage(meet(rest, known).distinct(), "links")
        else:
            met = rest.filter(F.col("root") != F.col("root2")).filter(_may_match("x", "y"))
            met = met.select(F.least("x.nid", "y.nid").alias("u"), F.greatest("x.nid", "y.nid").alias("v")).distinct()
            links = stage(confirm(stage(met, "pairs"), known), "links")
        found = links.count()
        idle = found * 1000 < size
        if found:
            star = roots.filter("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))
            roots = stage(components(star.union(links)), "roots")
        if last:
            return roots
        turn += 1


def near_groups(docs: DataFrame, text: str, rid: str, id_col: str) -> DataFrame:
    """rid, id, n_shingles, component_id (smallest id reachable), kept (one row of each component)."""
    rows = stage(signatures(docs, text, rid, id_col), "signatures")
    first = F.min(F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"), F.col("rid").alias("c")))
    classes = stage(rows.filter("n > 0").groupBy("c0", "c1").agg(F.min("rid").alias("nid"), first.alias("first")), "classes")
    side = F.struct(F.col("nid"), "n", "s0", "s1", "s2", "s3")
    nodes = rows.join(classes.select("nid"), F.col("rid") == F.col("nid")).select("bands", side.alias("x"))
    members = stage(nodes.select(F.explode("bands").alias("key"), "x"), "members")

    roots = link_classes(members, docs, text, rid)
    named = classes.join(roots, F.col("nid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "nid"))
    named = stage(named.select("c0", "c1", "root", "first"), "named")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    final = stage(named.join(least, "root").select("c0", "c1", "least"), "final")
    joined = rows.select("rid", "id", "n", "c0", "c1").join(final, ["c0", "c1"], "left")
    alone = F.col("n") == 0
    return joined.select(
        "rid", "id", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("least.b")).alias("component_id"),
        F.when(alone, F.lit(True)).otherwise(F.col("rid") == F.col("least.c")).alias("kept"),
    )


def drop_near_copies(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of each component, all columns. ``df`` must be a file scan (see ``keyed``)."""
    rows, rid = keyed(df)
    gone = near_groups(rows, text, rid, id_col).filter(~F.col("kept")).select(F.col("rid").alias(rid))
    return rows.join(gone, rid, "left_anti").select(*[col(c) for c in df.columns])


def op7_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, rid = keyed(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = near_groups(docs, "text", rid, "doc_id")
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
