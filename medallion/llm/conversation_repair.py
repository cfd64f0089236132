"""Repair of conversation structure: lightest derivations by Knuth's agenda (see ``agenda``).

Rows are dealt into ranges of (conversation, turn, row number) and sorted, so a conversation of any length is
spread over tasks and never gathered. Nulls sort first; rows with equal turns keep the order of the table.

1. One pass over the sorted ranges repairs every conversation that lies inside a range and has at most
   ``SHORT_ROWS`` rows and ``SHORT_CHARS`` characters. The others - the first and last of each range, and long
   ones - are passed on as rows, a block of ``BLOCK`` rows at a time.
2. Of those, duplicates are found by an aggregate over (conversation, role, digest of the text); each block
   becomes a matrix of lightest weights between places, in parallel; a conversation's matrices (one string of
   at most a byte or two a row for each of 16 pairs of places) meet in one group, where the agenda runs over
   blocks; each block then applies its part of the audit to its rows, again in parallel.

A row's first fault counts: blank (nothing outside [\\x20\\x09-\\x0D]), duplicate (role and text seen earlier in the
conversation), truncated (last such character is none of ``.!?``). Nulls in role or text count as one space, a null
conversation id is a conversation of its own, null turns come first and have no gaps. Repeated rows are duplicates.
A conversation without rows has cost 0 and an empty repair; an empty table gives an empty result. Other columns
of the input are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.agenda import GIVEN, NEXT, START, block_matrix, repair_blocks, repair_short
from medallion.llm.common import BLANKS, col, keyed, read_table, stage

BLOCK = 512
SHORT_ROWS = 512
SHORT_CHARS = 1 << 20
LEGAL = {"su", "ua", "au"}
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def code_of(role: str, text: str, repeated: bool) -> tuple[str, int]:
    """Code of a row for the agenda, and its fault (0 blank, 1 duplicate, 2 truncated, 3 none)."""
    body = text.rstrip(BLANKS)
    if not body:
        return "d", 0
    if repeated:
        return "d", 1
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return (initial, 3) if body[-1] in ".!?" else (initial.upper(), 2)


def apply_audit(rows: list[tuple[str, str]], place: int, audit: str) -> tuple[list[str], list[str], int]:
    """Roles, texts and last place of the repaired rows."""
    roles, texts, i = [], [], 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        role, text = ("", "") if edit == "I" else rows[i]
        if edit != "I":
            i += 1
        if edit != "K":
            role = GIVEN[place]
        place = NEXT[place][role[0]]
        roles.append(role)
        texts.append(text)
    return roles, texts, place


@dataclass
class Tally:
    """Counts of consecutive rows; two tallies of neighbours add up."""

    n: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0  # distinct, not null
    low: int | None = None
    high: int | None = None  # rows are sorted by turn, so these are the first and last one
    first: str = ""
    last: str = ""

    def __add__(self, other: Tally) -> Tally:
        if not self.n or not other.n:
            return self if self.n else other
        same = self.high is not None and self.high == other.low
        return Tally(
            self.n + other.n, self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated,
            self.illegal + other.illegal + (self.last + other.first not in LEGAL), self.turns + other.turns - same,
            self.low if self.low is not None else other.low, other.high if other.high is not None else self.high, self.first, other.last,
        )

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def tally(turns: list[int | None], roles: list[str], faults: list[int]) -> Tally:
    initials = [r[:1] for r in roles]
    known = [t for t in turns if t is not None]
    return Tally(
        len(roles), faults.count(0), faults.count(1), faults.count(2), sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        len(set(known)), known[0] if known else None, known[-1] if known else None, initials[0] if roles else "", initials[-1] if roles else "",
    )


def _turn_lists(per_row: list[tuple[list[str], list[str]] | None]) -> pa.Array:
    offsets, roles, texts = [0], [], []
    for x in per_row:
        if x is not None:
            roles += x[0]
            texts += x[1]
        offsets.append(len(roles))
    flat = pa.StructArray.from_arrays([pa.array(roles, pa.string()), pa.array(texts, pa.string())], ["role", "text"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)


def _first_pass(kind: str, short_rows: int):
    """Python side of step 1: (conv, turn, times, role, text) sorted -> repaired conversations and rows passed on."""
    names = ["conv", "open", *COUNTS, "audit", "turns", "part", "cid", "seq", "turn", "role", "text"]
    schema = f"conv {kind}, open boolean, " + ", ".join(f"{c} long" for c in COUNTS)
    schema += ", audit string, turns array<struct<role:string,text:string>>, part long, cid long, seq long, turn long, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[tuple[int | None, int, str, str]] = []  # rows of the conversation being read
        conv, cid, seq, chars, open_, type_ = None, -1, 0, 0, True, None
        done: list[tuple] = []
        passed: list[tuple] = []

        def close() -> None:
            turns, roles, codes, faults, rows, seen = [], [], [], [], [], set()
            for turn, times, role, text in held:
                for _ in range(times):
                    code, fault = code_of(role, text, (role, text) in seen)
                    seen.add((role, text))
                    turns.append(turn)
                    roles.append(role)
                    codes.append(code)
                    faults.append(fault)
                    rows.append((role, text))
            t = tally(turns, roles, faults)
            cost, audit = repair_short("".join(codes))
            roles, texts, _ = apply_audit(rows, START, audit)
            done.append((conv, t.gaps, t.blank, t.duplicate, t.truncated, t.illegal, cost, audit, (roles, texts)))

        def pass_on() -> None:
            nonlocal seq
            for turn, times, role, text in held:
                for _ in range(max(1, times)):
                    passed.append((conv, cid, seq, turn, role if times else None, text if times else None))
                    seq += 1
            held.clear()

        def flush() -> pa.RecordBatch:
            n, m = len(done), len(passed)
            a, b = list(zip(*done, strict=True)) or [()] * 9, list(zip(*passed, strict=True)) or [()] * 6
            columns = [pa.array(a[0] + b[0], type_), pa.array([False] * n + [True] * m, pa.bool_())]
            columns += [pa.array([*a[k], *[None] * m], pa.int64()) for k in range(1, 7)]
            columns += [pa.array([*a[7], *[None] * m], pa.string()), _turn_lists([*a[8], *[None] * m])]
            columns += [pa.array([part] * (n + m), pa.int64()), *[pa.array([None] * n + list(b[k]), pa.int64()) for k in (1, 2, 3)]]
            columns += [pa.array([None] * n + list(b[k]), pa.string()) for k in (4, 5)]
            done.clear()
            passed.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            type_ = batch.schema.field("conv").type
            for c, turn, times, role, text in zip(*[batch.column(k).to_pylist() for k in ("conv", "turn", "times", "role", "text")], strict=True):
                if c != conv or cid < 0:
                    if cid >= 0:
                        if open_:
                            pass_on()
                        else:
                            close()
                            held.clear()
                    open_, conv, cid, chars = cid < 0, c, cid + 1, 0
                held.append((turn, times, role, text))
                chars += len(text) * times
                if open_ or len(held) > short_rows or chars > SHORT_CHARS:
                    open_ = True
                    pass_on()
                if len(passed) >= 4096:
                    yield flush()
            if done or passed:
                yield flush()
        if cid >= 0:
            pass_on()  # the last conversation may go on in the next range
            if passed:
                yield flush()

    return run, schema


def _summaries(t: pa.Table) -> pa.Table:
    """One block of rows of one conversation -> tally and matrix."""
    t = t.sort_by("seq")
    rows = [r for r in zip(*[t.column(k).to_pylist() for k in ("turn", "role", "text", "again")], strict=True) if r[1] is not None]
    coded = [code_of(role, text, again) for _, role, text, again in rows]
    s = tally([r[0] for r in rows], [r[1] for r in rows], [f for _, f in coded])
    codes = "".join(c for c, _ in coded)
    matrix = block_matrix(codes) if rows else tuple(((p, 0, ""),) for p in range(4))
    flat = [(p, q, c, a) for p in range(4) for q, c, a in matrix[p]]
    data = {k: [t.column(k)[0].as_py()] for k in ("part", "cid", "block")}
    data |= {k: [getattr(s, k)] for k in ("n", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last")}
    data["matrix"] = [[{"p": p, "q": q, "c": c, "a": a} for p, q, c, a in flat]]
    out = pa.Table.from_pydict(data, _SUMMARY.remove(0))
    return out.add_column(0, "conv", t.column("conv").slice(0, 1))


_INT = ("n", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high")
_SUMMARY = pa.schema(
    [("conv", pa.null()), ("part", pa.int64()), ("cid", pa.int64()), ("block", pa.int64()), *[(k, pa.int64()) for k in _INT], ("first", pa.string()), ("last", pa.string())]
    + [("matrix", pa.list_(pa.struct([("p", pa.int64()), ("q", pa.int64()), ("c", pa.int64()), ("a", pa.string())])))]
)
_SUMMARY_SQL = "part long, cid long, block long, " + ", ".join(f"{k} long" for k in _INT) + ", first string, last string, matrix array<struct<p:long,q:long,c:long,a:string>>"


def _decide(t: pa.Table) -> pa.Table:
    """All blocks of a conversation -> its totals (part null) and, for each block, the place before it and its audit."""
    t = t.sort_by([("part", "ascending"), ("cid", "ascending"), ("block", "ascending")])
    total = Tally()
    blocks = []
    for r in t.drop_columns(["conv"]).to_pylist():
        total = total + Tally(**{k: r[k] for k in (*_INT, "first", "last")})
        m: list[list] = [[], [], [], []]
        for e in r["matrix"]:
            m[e["p"]].append((e["q"], e["c"], e["a"]))
        blocks.append(tuple(tuple(x) for x in m))
    cost, audit, places, audits = repair_blocks(blocks)
    k = len(blocks)
    none = [None] * k
    return pa.table(
        {
            "conv": pa.chunked_array([pa.concat_arrays([t.column("conv").combine_chunks(), t.column("conv").slice(0, 1).combine_chunks()])]),
            **{c: pa.array([*t.column(c).to_pylist(), None], pa.int64()) for c in ("part", "cid", "block")},
            "place": pa.array([*places, None], pa.int64()),
            **{c: pa.array([*none, v], pa.int64()) for c, v in zip(COUNTS, (total.gaps, total.blank, total.duplicate, total.truncated, total.illegal, cost), strict=True)},
            "audit": pa.array([*audits, audit], pa.string()),
        }
    )


def _apply(rows: pa.Table, choice: pa.Table) -> pa.Table:
    """Rows of a block and its choice -> the block's repaired turns."""
    rows = rows.sort_by("seq")
    data = [r for r in zip(rows.column("role").to_pylist(), rows.column("text").to_pylist(), strict=True) if r[0] is not None]
    roles, texts, _ = apply_audit(data, choice.column("place")[0].as_py(), choice.column("audit")[0].as_py())
    head = rows.select(["conv", "part", "cid", "block"]).slice(0, 1).combine_chunks()
    return head.append_column("turns", pa.chunked_array([_turn_lists([(roles, texts)])]))


def repair_conversations(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", times: Column | None = None, short_rows: int = SHORT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(report, repaired): per conversation its counts, cost and audit; and its repaired turns in blocks.

    ``report``: conv, gaps, blank, duplicate, truncated, illegal, cost, audit. ``repaired``: conv, part, cid, block (their
    order is that of the conversation; null for a conversation that is one block), turns (array of role and text).
    ``times`` says how often a row stands in the conversation (1 if not given; 0 keeps the conversation's id only).
    ``df`` must be a file scan or a staged table (see ``keyed``)."""
    source = df.select(
        col(conv).alias("conv"), col(turn).cast("long").alias("turn"), F.coalesce(col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(col(text).cast("string"), F.lit(" ")).alias("text"), (F.lit(1) if times is None else times).cast("int").alias("times"),
    )
    source, rid = keyed(source)
    return _repair(source, rid, short_rows)


def _repair(source: DataFrame, rid: str, short_rows: int) -> tuple[DataFrame, DataFrame]:
    kind = dict(source.dtypes)["conv"]
    ranged = source.repartitionByRange("conv", "turn", rid).sortWithinPartitions("conv", "turn", rid)
    run, schema = _first_pass(kind, short_rows)
    first = stage(ranged.select("conv", "turn", "times", "role", "text").mapInArrow(run, schema), "conversations")
    done, passed = first.filter(~F.col("open")), first.filter("open").select("conv", "part", "cid", "seq", "turn", "role", "text")

    digest = F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256)
    place = F.struct("part", "seq")
    earliest = passed.filter("role IS NOT NULL").groupBy("conv", digest.alias("d")).agg(F.min(place).alias("f")).select(F.col("f.part").alias("part"), F.col("f.seq").alias("seq"), F.lit(False).alias("again"))
    marked = passed.join(earliest, ["part", "seq"], "left").withColumn("again", F.coalesce("again", F.lit(True))).withColumn("block", F.floor(F.col("seq") / BLOCK))
    marked = stage(marked, "open-rows")
    keys = ["conv", "part", "cid", "block"]
    blocks = stage(marked.groupBy(*keys).applyInArrow(_summaries, f"conv {kind}, {_SUMMARY_SQL}"), "blocks")
    chosen = blocks.groupBy("conv").applyInArrow(_decide, f"conv {kind}, part long, cid long, block long, place long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string")
    chosen = stage(chosen, "choices")
    choice = chosen.filter("part IS NOT NULL").select("part", "cid", "block", "place", "audit")
    by = ["part", "cid", "block"]
    applied = marked.groupBy(*by).cogroup(choice.groupBy(*by)).applyInArrow(_apply, f"conv {kind}, part long, cid long, block long, turns array<struct<role:string,text:string>>")

    report = done.select("conv", *COUNTS, "audit").union(chosen.filter("part IS NULL").select("conv", *COUNTS, "audit"))
    nothing = F.lit(None).cast("long")
    repaired = done.select("conv", nothing.alias("part"), nothing.alias("cid"), nothing.alias("block"), "turns").union(stage(applied, "applied"))
    return report, repaired


def _spelled(turns: str) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")


def digests(report: DataFrame, repaired: DataFrame) -> DataFrame:
    """``report`` with repaired_sha256: the SHA-256 of the turns as ``role:text`` lines.

    A conversation in one block is hashed where it is. The blocks of another one are sorted and pass through one
    hash in order, a batch at a time, as SHA-256 can't be split; nothing is gathered."""
    kind = dict(report.dtypes)["conv"]
    whole = repaired.filter("part IS NULL").select("conv", F.sha2(_spelled("turns"), 256).alias("sha"))
    lines = repaired.filter("part IS NOT NULL").select("conv", "part", "cid", "block", F.size("turns").alias("k"), _spelled("turns").alias("t"))
    sorted_ = lines.repartition("conv").sortWithinPartitions("conv", "part", "cid", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, lines, type_ = None, None, 0, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv], type_), pa.array([digest.hexdigest()], pa.string())], ["conv", "sha"])

        for b in batches:
            type_ = b.schema.field("conv").type
            for c, k, t in zip(b.column("conv").to_pylist(), b.column("k").to_pylist(), b.column("t").to_pylist(), strict=True):
                if digest is None or c != conv:
                    if digest is not None:
                        yield out()
                    conv, digest, lines = c, hashlib.sha256(), 0
                if k:
                    digest.update(b"\n" * (lines > 0) + t.encode())
                    lines += k
        if digest is not None:
            yield out()

    parts = sorted_.select("conv", "k", "t").mapInArrow(run, f"conv {kind}, sha string")
    shas = whole.union(parts).select(F.col("conv").alias("conv2"), F.col("sha").alias("repaired_sha256"))
    return report.join(shas, F.col("conv").eqNullSafe(F.col("conv2"))).drop("conv2")


def damaged(df: DataFrame) -> tuple[DataFrame, Column]:
    """``conversations`` with op11's damage, and how often each row stands."""
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    hit = F.crc32(key) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = df.select(
        "conv_id", "turn", F.when(hit == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(hit == 1, F.lit("")).when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), hit.alias("hit"),
    )
    return rows, F.when(F.col("hit") == 0, 0).when(F.col("hit") == 3, 2).otherwise(1)


def op11_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, times = damaged(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    report, repaired = repair_conversations(rows, times=times)
    return digests(report, repaired).select(F.col("conv").alias("conv_id"), *COUNTS, "audit", "repaired_sha256")
