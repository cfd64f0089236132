"""Lightest derivations of repaired role sequences by Knuth's agenda.

A repaired conversation reads ``(s?(ua)+)?`` in role initials, so a prefix of one is known by its last
initial: the places START, SYSTEM, USER, ASSISTANT. An item ``(i, place)`` says that the first ``i`` rows
can be turned into a prefix that ends there; its weight is (cost, audit), the audit being the initials of
the edits. Deductions are weighted hyperedges:

    (i, p) and row i              =>  (i + 1, q)   Delete (3), Keep (0) or Rerole (2); 1 more for a truncated row that stays
    (i, p)                        =>  (i, q)       Insert (2)
    (n, START) or (n, ASSISTANT)  =>  goal

Each adds to the cost and appends to the audit, so no conclusion is lighter than its premiss, and a lighter
premiss gives a lighter conclusion: of two audits of one item at one cost neither is a prefix of the other, as
both use all rows and the longer would cost its further inserts more. These are the superior functions of
Knuth's generalisation of Dijkstra's method: the lightest item on the agenda is final, and the first goal popped
is the least cost with, among its edits, the ASCII-least audit.

A long conversation is cut into blocks. ``block_matrix`` holds the lightest weight between every two places of
a block; it is the row of the next level, whose audits are strings. Concatenation keeps the order for the
reason above, so the agenda over blocks gives the same answer as one over rows.
"""

from __future__ import annotations

import functools
import heapq

START, SYSTEM, USER, ASSISTANT = range(4)
PLACES = range(4)
#: place -> initial of a row that may follow -> next place
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: What Rerole and Insert write at each place: the only initial out of "ua" that may follow.
GIVEN = tuple("assistant" if p == USER else "user" for p in PLACES)
GOALS = (START, ASSISTANT)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

Edge = tuple[int, int, str]  # next place, cost, audit
Row = tuple[tuple[Edge, ...], ...]  # edges by place


def _row(initial: str, deleted: bool, truncated: bool) -> Row:
    out = []
    for p in PLACES:
        edges: list[Edge] = [(p, DELETE, "D")]
        if not deleted:
            more = TRUNCATED * truncated
            if initial in NEXT[p]:
                edges.append((NEXT[p][initial], KEEP + more, "K"))
            edges.append((NEXT[p][GIVEN[p][0]], REROLE + more, "R"))
        out.append(tuple(edges))
    return tuple(out)


#: Rows by code: the initial (x: none of s, u, a), upper case where the row is truncated; d: has to be deleted.
ROWS: dict[str, Row] = {"d": _row("", True, False)}
for _c in "suax":
    ROWS[_c], ROWS[_c.upper()] = _row(_c, False, False), _row(_c, False, True)


def lightest(rows: list[Row], start: int, inserts: bool) -> dict[int, tuple[int, str]]:
    """(cost, audit) of every place that all ``rows`` can end in, from ``start``."""
    last = len(rows)
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: set[int] = set()
    found: dict[int, tuple[int, str]] = {}
    while agenda and len(found) < len(PLACES):
        cost, audit, i, p = heapq.heappop(agenda)
        if i * 4 + p in final:
            continue
        final.add(i * 4 + p)
        if inserts:
            q = NEXT[p][GIVEN[p][0]]
            if i * 4 + q not in final:
                heapq.heappush(agenda, (cost + INSERT, audit + "I", i, q))
        if i == last:
            found[p] = (cost, audit)
            continue
        for q, more, edit in rows[i][p]:
            if i * 4 + 4 + q not in final:
                heapq.heappush(agenda, (cost + more, audit + edit, i + 1, q))
    return found


def _goal(rows: list[Row], inserts: bool) -> tuple[int, str]:
    """The first goal popped from START."""
    last = len(rows)
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, START)]
    final: set[int] = set()
    while True:
        cost, audit, i, p = heapq.heappop(agenda)
        if i * 4 + p in final:
            continue
        final.add(i * 4 + p)
        if i == last and p in GOALS:
            return cost, audit
        if inserts:
            q = NEXT[p][GIVEN[p][0]]
            if i * 4 + q not in final:
                heapq.heappush(agenda, (cost + INSERT, audit + "I", i, q))
        if i < last:
            for q, more, edit in rows[i][p]:
                if i * 4 + 4 + q not in final:
                    heapq.heappush(agenda, (cost + more, audit + edit, i + 1, q))


@functools.lru_cache(maxsize=1 << 14)
def repair_short(codes: str) -> tuple[int, str]:
    """Cost and audit of a conversation given by its rows' codes."""
    return _goal([ROWS[c] for c in codes], True)


@functools.lru_cache(maxsize=1 << 10)
def block_matrix(codes: str) -> Row:
    """A block of rows as one row of the next level: the lightest weight between every two places."""
    rows = [ROWS[c] for c in codes]
    return tuple(tuple((q, c, a) for q, (c, a) in sorted(lightest(rows, p, True).items())) for p in PLACES)


def joined(blocks: list[Row]) -> Row:
    """Consecutive blocks as one."""
    return tuple(tuple((q, c, a) for q, (c, a) in sorted(lightest(blocks, p, False).items())) for p in PLACES)


def repair_blocks(blocks: list[Row], fan: int = 16) -> tuple[int, str, list[int], list[str]]:
    """Cost, audit, and for each block the place before it and its part of the audit, of the lightest repair.

    Blocks are joined ``fan`` at a time, level by level, so that an agenda never holds more than ``fan`` copies of
    a level's audits; the places are then read back from the top level down."""
    levels = [blocks]
    while len(levels[-1]) > fan:
        below = levels[-1]
        levels.append([joined(below[i : i + fan]) for i in range(0, len(below), fan)])
    cost, audit = _goal(levels[-1], False)
    spans = [(START, audit)]  # of the whole top level: place before, audit
    for k in range(len(levels) - 1, -1, -1):
        down = []
        for j, (place, text) in enumerate(spans):
            part = levels[k] if k == len(levels) - 1 else levels[k][j * fan : (j + 1) * fan]
            down += _along(part, place, text)
        spans = down
    return cost, audit, [p for p, _ in spans], [a for _, a in spans]


def _along(blocks: list[Row], place: int, audit: str) -> list[tuple[int, str]]:
    """Place before and audit of each block on a path from ``place`` that spells ``audit``."""
    # several paths may spell it (an insert can end one block or begin the next); search from the end for one
    ends: list[dict[tuple[int, int], tuple[int, int]]] = [{(place, 0): (-1, -1)}]
    for b in blocks:
        reach: dict[tuple[int, int], tuple[int, int]] = {}
        for p, at in ends[-1]:
            for q, _, a in b[p]:
                if audit.startswith(a, at):
                    reach.setdefault((q, at + len(a)), (p, at))
        ends.append(reach)
    here = next(x for x in ends[-1] if x[1] == len(audit))
    out = []
    for reach in reversed(ends[1:]):
        before = reach[here]
        out.append((before[0], audit[before[1] : here[1]]))
        here = before
    return out[::-1]
