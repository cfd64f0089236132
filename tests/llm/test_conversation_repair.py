"""Conversation repair against enumeration and a plain dynamic program."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from medallion.llm import agenda
from medallion.llm import conversation_repair as C
from medallion.llm.common import read_table

SF = "/root/testdata/sf0.01"
BLANK = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def legal(initials: str) -> bool:
    rest = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (len(rest) >= 2 and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def plain_faults(rows):
    out, seen = [], []
    for _, role, text in rows:
        body = text.strip(BLANK)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.append((role, text))
    return out


def enumerated(rows, faults, most_inserts):
    """Least (cost, audit, repaired) of all edit strings with up to ``most_inserts`` inserts."""
    best = None

    def go(i, cost, audit, out, inserts):
        nonlocal best
        if i == len(rows) and legal("".join(r[:1] for r, _ in out)):
            found = (cost, audit, "\n".join(f"{r}:{t}" for r, t in out))
            best = found if best is None or found < best else best
        if inserts < most_inserts:
            for r in ("user", "assistant"):
                go(i, cost + 2, audit + "I", [*out, (r, "")], inserts + 1)
        if i < len(rows):
            _, role, text = rows[i]
            go(i + 1, cost + 3, audit + "D", out, inserts)
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                go(i + 1, cost + more, audit + "K", [*out, (role, text)], inserts)
                for r in ("user", "assistant"):
                    go(i + 1, cost + 2 + more, audit + "R", [*out, (r, text)], inserts)

    go(0, 0, "", [], 0)
    return best


def programmed(rows, faults):
    """The same by a table over rows and the repaired text's last initial, for any length."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def spread(state):
        for _ in range(3):
            for last, (c, a, out) in list(state.items()):
                for x in after[last].replace("s", ""):
                    new = (c + 2, a + "I", (out, f"{name[x]}:"))
                    if x not in state or new[:2] < state[x][:2]:
                        state[x] = new
        return state

    state = spread({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}

        def offer(x, c, a, out, new=new):
            if x not in new or (c, a) < new[x][:2]:
                new[x] = (c, a, out)

        for last, (c, a, out) in state.items():
            offer(last, c + 3, a + "D", out)
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] and role[0] in after[last]:
                    offer(role[0], c + more, a + "K", (out, f"{role}:{text}"))
                for x in after[last].replace("s", ""):
                    offer(x, c + 2 + more, a + "R", (out, f"{name[x]}:{text}"))
        state = spread(new)
    cost, audit, out = min((state[x] for x in ("", "a") if x in state), key=lambda s: s[:2])
    lines = []
    while out:
        out, line = out
        lines.append(line)
    return cost, audit, "\n".join(reversed(lines))


def expected(table, damage=True):
    """Contract columns by conversation; ``table``: rows in table order."""
    groups = {}
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        rows = groups.setdefault(conv, [])
        text = "" if hit == 1 else text.translate({ord(c): None for c in ".!?"}) if hit == 2 else text
        rows += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    out = {}
    for conv, rows in groups.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
        faults = plain_faults(rows)
        cost, audit, text = programmed(rows, faults)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        out[conv] = (gaps, *[faults.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def result(df):
    rows = df.select("conv", *C.COUNTS, "audit", "repaired_sha256").collect()
    got = {r[0]: tuple(r[1:]) for r in rows}
    assert len(got) == len(rows)
    return got


def staged(spark, rows, tmp_path, schema=SCHEMA, parts=1):
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, schema).coalesce(parts).write.parquet(path)
    return spark.read.parquet(path)


def run(df, **options):
    rows, times = C.damaged(df)
    return result(C.digests(*C.repair_conversations(rows, times=times, **options)))


def test_agenda_equals_enumeration():
    rng = random.Random(5)
    pool = [("user", "A."), ("assistant", "B."), ("system", "C."), ("user", "cut"), ("assistant", "cut"), ("user", ""), ("tool", "D!"), (" ", "E?"), ("system", "cut")]
    for n in range(6):
        for _ in range(12):
            rows = [(k, *rng.choice(pool)) for k in range(n)]
            faults = plain_faults(rows)
            want = enumerated(rows, faults, 3 if n < 5 else 2)
            codes = "".join(C.code_of(r, t, f == "duplicate")[0] for (_, r, t), f in zip(rows, faults, strict=True))
            assert agenda.repair_short(codes) == want[:2]
            roles, texts, _ = C.apply_audit([r[1:] for r in rows], agenda.START, want[1])
            assert "\n".join(f"{a}:{b}" for a, b in zip(roles, texts, strict=True)) == want[2]
            assert programmed(rows, faults) == want


def test_blocks_equal_one_agenda():
    rng = random.Random(6)
    for n in (1, 7, 40, 300):
        for size in (1, 3, 16):
            codes = "".join(rng.choice("suaxSUAXduauaua") for _ in range(n))
            blocks = [agenda.block_matrix(codes[i : i + size]) for i in range(0, n, size)]
            cost, audit, places, audits = agenda.repair_blocks(blocks, fan=4)
            assert (cost, audit) == agenda.repair_short(codes)
            assert len(places) == len(blocks) and "".join(audits) == audit


def test_whole_table_equals_brute_force(spark):
    table = [tuple(r) for r in read_table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r[1:]) for r in C.op11_query(spark, SF).collect()}
    assert got == expected(table)


def test_long_conversation_is_split(spark, tmp_path):
    rng = random.Random(7)
    words = ["Yes.", "No!", "and then", "", "Why?", "A longer answer.", "\n"]
    rows = [(1, k if k % 7 else None, rng.choice(["user", "assistant", "system"]), f"{rng.choice(words)}{rng.choice(['', k])}") for k in range(4000)]
    rows += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Hello."), (3, 5, "system", "Only.")]
    rows.sort(key=lambda r: (r[0], r[1] is not None, r[1] or 0))
    df = staged(spark, rows, tmp_path)
    assert run(df) == expected(rows)
    assert run(df, short_rows=0) == expected(rows)


def test_nulls_ties_repeats_and_long_texts(spark, tmp_path):
    big = "long text. " * 300_000
    rows = [
        (None, None, None, None), (None, None, "user", "x."), (None, 3, "user", "x."), (7, 1, "user", "a."), (7, 1, "user", "a."), (7, 1, "assistant", "b"),
        (7, None, "system", "s."), (8, 0, "user", big), (8, 1, "assistant", big), (8, 2, "assistant", big), (9, None, None, None), (10, 4, "", ""), (10, 9, "", "Q?"),
    ]
    df = staged(spark, rows, tmp_path)
    assert run(df) == expected(rows)
    got = result(C.digests(*C.repair_conversations(df.withColumn("part", F.lit("x")).withColumn("TIMES", F.lit(0)).withColumn("rid", F.lit(1)))))
    assert got == expected(rows, damage=False)


def test_empty_table(spark, tmp_path):
    assert run(staged(spark, [], tmp_path)) == {}


def test_repaired_rows_have_legal_roles(spark):
    df = read_table(spark, SF, "conversations")
    report, repaired = C.repair_conversations(df)
    assert report.count() == df.select("conv_id").distinct().count()
    turns = repaired.orderBy("conv", "part", "cid", "block").collect()
    for _, blocks in itertools.groupby(turns, key=lambda r: r["conv"]):
        assert legal("".join(t["role"][0] for b in blocks for t in b["turns"]))


@pytest.mark.parametrize("where", ["first", "middle", "last"])
def test_conversations_over_range_edges(spark, tmp_path, where):
    """Every range holds few rows, so most conversations cross an edge or touch one."""
    rng = random.Random(where)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "", "c!"])) for c in range(25) for t in range(rng.randint(1, 9))]
    df = staged(spark, rows, tmp_path)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(df) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
