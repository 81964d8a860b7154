"""Periodic runs against plain loops."""

import hashlib
import zlib

import numpy as np
import pytest

from tallgrass.llm import periodic_runs as pr


def brute_runs(words):
    """All runs by comparing each word with the one a period later."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        s = 0
        while s < n - q:
            e = s
            while e < n - q and words[e] == words[e + q]:
                e += 1
            if e - s + q >= max(24, 3 * q):
                found.setdefault((s, e - s + q), q)
            s = e + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def texts(rng, many):
    """Texts with nested, overlapping and touching repeats over small alphabets."""
    for k in range(many):
        words = [f"w{x}" for x in rng.integers(0, [2, 3, 50][k % 3], rng.integers(0, 120))]
        for _ in range(rng.integers(0, 4)):
            p, at = int(rng.integers(1, 14)), int(rng.integers(0, len(words) + 1))
            unit = [f"w{x}" for x in rng.integers(0, 3, p)]
            words[at:at] = (unit * int(rng.integers(3, 30)))[: int(rng.integers(20, 140))]
        yield " ".join(words)


@pytest.mark.parametrize("seed", range(4))
def test_extensions_are_exact(seed):
    rng = np.random.default_rng(seed)
    own = [rng.integers(0, 1 + seed, rng.integers(0, 90)) for _ in range(30)]
    words = np.concatenate([np.append(w, -1 - k) for k, w in enumerate(own)])
    i, j = np.sort(rng.integers(0, len(words), (2, 3000)), 0)
    i, j = i[i < j], j[i < j]
    grammar = pr.Grammar(words)

    def plain(a, b, step):
        n = 0
        while 0 <= a < len(words) and 0 <= b < len(words) and words[a] == words[b]:
            a, b, n = a + step, b + step, n + 1
        return n

    assert grammar.extend(i, j).tolist() == [plain(a, b, 1) for a, b in zip(i, j, strict=True)]
    assert grammar.extend(i, j, back=True).tolist() == [plain(a, b, -1) for a, b in zip(i, j, strict=True)]


def test_runs_against_loops(spark, docs):
    rows = list(enumerate(texts(np.random.default_rng(7), 240)))
    found = {tuple(r) for r in pr.run_digests(docs(rows), damaged=True).collect()}
    assert found == {brute_row(i, t) for i, t in rows}
    assert sum(r[1] > 0 for r in found) > 60
    words = dict(rows)
    for r in pr.periodic_runs(docs(rows)).collect():
        own = words[r.doc_id].split()
        runs = brute_runs(own)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        assert [tuple(x) for x in r.runs] == runs and bytes(r.collapsed).decode().split() == [w for i, w in enumerate(own) if i not in gone]


def test_odd_rows(spark, docs, odd):
    extra = [(90, "a " * 5000), (91, "a b " * 3000 + "c"), (100, "x y z " * 9), (100, "x y z " * 9)]
    found = sorted((tuple(r) for r in pr.run_digests(docs(odd + extra), damaged=True).collect()), key=str)
    assert [r for r in found if r[0] not in (8, 90, 91)] == sorted((brute_row(i, t) for i, t in odd + extra if i not in (8, 90, 91)), key=str)
    by_id = {r[0]: r for r in found}
    assert by_id[90][1:6] == (1, 0, 5000, 1, 5_000_000)
    assert by_id[91][1:6] == (1, 0, 6000, 2, 3_000_000)
    assert by_id[8][1:5] == (1, 1, 19 * 400 - 1, 19)  # the last word of each copy runs into the first of the next
    assert pr.periodic_runs(docs([]), damaged=True).collect() == []


def test_grid_in_pieces(monkeypatch):
    whole = [np.concatenate(x) for x in zip(*pr.grid(5000), strict=True)]
    monkeypatch.setattr(pr, "GRID", 300)
    pieces = list(pr.grid(5000))
    assert len(pieces) > 10
    assert all((a == np.concatenate(b)).all() for a, b in zip(whole, zip(*pieces, strict=True), strict=True))


def test_grammar_is_logarithmic():
    """Levels grow with the logarithm of a text, and the strings of all levels with the text."""
    rng = np.random.default_rng(1)
    for make in (lambda n: rng.integers(0, 5, n), lambda n: np.zeros(n, int), lambda n: np.arange(n) % 7):
        for n in (1000, 64000):
            grammar = pr.Grammar(np.append(make(n), -1))
            assert len(grammar.levels) < 12 * np.log2(n) and sum(len(x.symbols) for x in grammar.levels) < 12 * n


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("length(text) < 6000").collect()
    found = {r.doc_id: tuple(r) for r in pr.op12_periodic_runs(spark, sf).collect()}
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert {found[r.doc_id] for r in rows} == {brute_row(*r) for r in rows}
