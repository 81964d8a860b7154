"""Conversation repair against SQL, against a search over all edits and on odd rows."""

import hashlib
import re
import sys
import zlib
from heapq import heappop, heappush
from math import isqrt

import duckdb
import numpy as np
import pytest

sys.path.insert(0, __file__.rsplit("/llm/", 1)[0])
from compare import rows as comparable  # noqa: E402

from tallgrass.llm import conversation_repair as cr  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, seq string, code int, digest string"
WHITE = " \t\n\x0b\x0c\r"


def search(rows):
    """(cost, audit, lines) of the cheapest edits by a search in order of cost and letters; rows are (role, text, fault)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, lines = heappop(heap)
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", roles):
            return cost, audit, lines
        state = (i, roles[-1:])
        if state in done:
            continue
        done.add(state)
        want = "assistant" if roles.endswith("u") else "user"
        heappush(heap, (cost + 3, audit + "I", i, roles + want[0], (*lines, f"{want}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heappush(heap, (cost + 4, audit + "D", i + 1, roles, lines))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                heappush(heap, (cost + 3 + more, audit + "R", i + 1, roles + want[0], (*lines, f"{want}:{text}")))
                if role[:1] == want[0] or (role[:1] == "s" and not roles):
                    heappush(heap, (cost + more, audit + "K", i + 1, roles + role[0], (*lines, f"{role}:{text}")))


def brute(conv, original):
    rows = []
    for _, turn, role, text in original:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, flawed = set(), []
    for _, role, text in rows:
        end = text.rstrip(WHITE)[-1:]
        flawed.append((role, text, "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else ""))
        seen.add((role, text))
    turns = [t for t, *_ in rows if t is not None]
    cost, audit, lines = search(flawed)
    count = lambda fault: sum(f == fault for *_, f in flawed)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(flawed, flawed[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def generated(rng, many):
    texts = ["Yes.", "No!", "and so", "why?", " ", "", "\t\n", "Yes. \n", None, "é.", "..."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "unknown", "", None]
    for conv in range(many):
        for k in range(int(rng.integers(1, 9))):
            turn = None if rng.random() < 0.05 else k + int(rng.integers(0, 3))
            text = texts[rng.integers(len(texts))]
            yield (conv, turn, roles[rng.integers(len(roles))], f"{text}{k}." if text and rng.random() < 0.4 else text)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 0, "d") for r in rows], SCHEMA).repartition(3)


def result(spark, rows):
    df = frame(spark, rows)
    return {tuple(r) for r in cr.repair(cr.damage(df), df).collect()}


def test_against_search(spark):
    rows = list(generated(np.random.default_rng(3), 150))
    expected = {brute(conv, [r for r in rows if r[0] == conv]) for conv in {r[0] for r in rows}}
    assert result(spark, rows) == expected
    assert len({r[-2] for r in expected}) > 60


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hm."), (1, None, None, None), (2, 5, "user", "a."), (2, 5, "user", "a."), (2, 5, "user", "a."), (2, 5, "assistant", "b."), (3, -(2**40), "user", "x" * 200_000), (3, 2**40, "assistant", "y.")]
    assert result(spark, rows) == {brute(conv, [r for r in rows if r[0] == conv]) for conv in {r[0] for r in rows}}
    assert result(spark, []) == set()


def test_conversation_without_rows(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert result(spark, [(lost, 0, "user", "Gone.")]) == {(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_long_conversation(spark):
    """One conversation of many rows: the audit gives the role pattern at the cost that is stated, with few vectors held."""
    rng = np.random.default_rng(9)
    rows = [(1, k, ["user", "assistant", "system"][rng.integers(3)], f"t{k}" + "."[: rng.integers(2)]) for k in range(20_000)]
    (found,) = result(spark, rows)
    cost, audit = found[6], found[7]
    assert cost <= 4 * len(rows) and len(audit) >= found[1] and set(audit) <= set("DIKR")
    plain = [int(x) for x in rng.integers(0, 16, 3000)]
    assert cr.tight_edits(bytes(plain)) == whole_table(plain)


def whole_table(codes):
    """The same edits from a table of all cost vectors."""
    table = [cr.END]
    for code in reversed(codes):
        table.append(cr.before(table[-1], code))
    table.reverse()
    state, letters, i = 0, "", 0
    while i < len(codes) or table[i][state]:
        options = [("I", 3, i, cr.TURN[state])]
        if i < len(codes):
            fault, initial = divmod(codes[i], 4)
            options.append(("D", 4, i + 1, state))
            if fault in (cr.FINE, cr.TRUNCATED):
                more = 3 * (fault == cr.TRUNCATED)
                options.append(("R", 3 + more, i + 1, cr.TURN[state]))
                if state in cr.KEEP[initial]:
                    options.append(("K", more, i + 1, cr.KEEP[initial][state]))
        letter, _, i, state = min(o for o in options if o[1] + table[o[2]][o[3]] == table[i][state])
        letters += letter
    return table[0][0], letters


def test_vectors_held_at_once(monkeypatch):
    """Not more than about twice the square root of the rows."""
    calls = []
    monkeypatch.setattr(cr, "before", lambda costs, code, real=cr.before: calls.append(1) or real(costs, code))
    codes = bytes([1, 2] * 5000)
    assert cr.tight_edits(codes) == (0, "K" * 10_000)
    assert len(calls) == 2 * len(codes) and isqrt(len(codes)) + 1 == 101


@pytest.mark.parametrize("odd", [False, True])
def test_against_sql(spark, odd):
    con = duckdb.connect()
    if odd:
        df = frame(spark, list(generated(np.random.default_rng(11), 60)))
        con.register("conversations", df.toArrow())
        found = cr.repair(cr.damage(df), df).toPandas()
    else:
        sf = "/root/testdata/sf0.01"
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
        found = cr.op13_conversation_repair(spark, sf).toPandas()
    expected = con.sql(cr.OP13_SQL).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert comparable(found) == comparable(expected)
