"""Exact, near, line and substring deduplication against brute force."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallgrass.llm import exact_dedup, line_dedup, near_dedup, suffix_dedup
from tallgrass.llm.components import connected_components, joined
from tallgrass.llm.common import settle

DOCS = "/root/testdata/sf0.001/documents.parquet"


def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(DOCS).collect()}


# exact ------------------------------------------------------------------------------------------------------------


def exact_expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return Counter((i, keep[n], len(groups[n]), hashlib.sha256(n.encode()).hexdigest()) for i, t in rows for n in [re.sub(r"[\x20\x09-\x0D]+", " ", t or "")])


def test_exact_odd_rows(docs, odd):
    found = exact_dedup.exact_dedup(docs(odd)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == exact_expected(odd)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in found}) and all(r.doc_id == r.keep_id for r in kept)


def test_exact_several_batches_agree(spark, docs, odd):
    a = exact_dedup.exact_dedup(settle(docs(odd), "t"), max_files_per_batch=1).select("doc_id", "keep_id", "group_size").collect()
    assert Counter(map(tuple, a)) == Counter((i, k, n) for i, k, n, _ in exact_expected(odd).elements())


def test_exact_clashing_digests_are_told_apart_by_their_bytes(docs, odd):
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 1)
    found = exact_dedup.exact_dedup(docs(odd), digest=weak).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == exact_expected(odd)


def test_exact_empty(docs):
    assert exact_dedup.exact_dedup(docs([])).collect() == []


# near -------------------------------------------------------------------------------------------------------------


def near_expected(rows, n, percent):
    sets, parent = defaultdict(list), {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i].append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in parent}


def test_near_odd_rows(docs, odd):
    expected = near_expected([r for r in odd if r[0] is not None], 3, 85)
    found = near_dedup.near_components(docs(odd), 3, 85).collect()
    assert len(found) == len(odd)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == expected
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)


def test_near_sample_and_chains(spark, docs):
    words = [f"w{k}" for k in range(60)]
    chain = [(1000 + k, " ".join(words[: 60 - k] + [f"z{j}" for j in range(k)])) for k in range(12)]
    rows = list(texts(spark).items()) + chain
    found = near_dedup.near_components(docs(rows), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in found} == near_expected(rows, 3, 85)


def variants(rng, words, many, edits, vocabulary, first=0):
    """Texts of so many words, of which a random number are replaced."""
    base, rows = [f"b{k}" for k in range(words)], []
    for i in range(many):
        w = list(base)
        for k in rng.integers(0, words, rng.integers(0, edits + 1)):
            w[k] = f"e{rng.integers(0, vocabulary)}"
        rows.append((first + i, " ".join(w)))
    return rows


@pytest.mark.parametrize("words,edits,vocabulary", [(80, 6, 9), (80, 9, 400), (150, 14, 3)])
def test_near_families(docs, words, edits, vocabulary):
    """Families of which some members link with the pivot, some with each other alone and some with none."""
    rows = variants(np.random.default_rng(words + edits), words, 150, edits, vocabulary)
    assert {r.doc_id: r.component_id for r in near_dedup.near_components(docs(rows), 3, 85).collect()} == near_expected(rows, 3, 85)


def test_near_twins_in_crowded_buckets(docs):
    """Twins at the threshold among many texts that share their buckets but link with nothing."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(150):
        own = {int(k): f"o{i}" for k in rng.choice(200, 22, replace=False)}
        for half in range(2):
            edits = dict(own)
            while len(edits) < 33:
                edits.setdefault(int(rng.integers(0, 200)), f"t{i}x{half}")
            rows.append((2 * i + half, " ".join(f"{edits.get(k, 'b')}{k}" for k in range(200))))
    expected = near_expected(rows, 1, 80)
    assert sum(i != c for i, c in expected.items()) >= 100
    assert {r.doc_id: r.component_id for r in near_dedup.near_components(docs(rows), 1, 80).collect()} == expected


def test_near_differences_lose_no_link():
    """Whatever the pivot: two sets that link share a prefix element at a place that leaves enough behind it."""
    rng, percent = np.random.default_rng(4), 85
    for _ in range(300):
        base = rng.choice(400, rng.integers(12, 60), replace=False)
        kin = [np.unique(np.concatenate([rng.permutation(base)[rng.integers(0, 4) :], rng.choice(400, rng.integers(0, 4))])) for _ in range(6)]
        held = Counter(v for x in kin for v in x.tolist())
        ranked = [np.array(sorted((held[v], v) for v in x.tolist()), np.int64) for x in kin]
        batch = pa.RecordBatch.from_pydict({"id": range(1, 6), "pivot": [0] * 5, "rx": [x.tobytes() for x in ranked[1:]], "rp": [ranked[0].tobytes()] * 5})
        rows = [r for b in near_dedup._difference(percent)(iter([batch])) for r in b.to_pylist()]
        both = lambda a, b: len(np.intersect1d(kin[a], kin[b]))
        linked = lambda a, b: 100 * both(a, b) >= percent * (len(kin[a]) + len(kin[b]) - both(a, b))
        for x, y in itertools.combinations(range(1, 6), 2):
            if linked(x, y) and not (linked(x, 0) and linked(y, 0)) and set(kin[x]) != set(kin[y]) and all(set(kin[k]) != set(kin[0]) for k in (x, y)):
                n = len(kin[x]) + len(kin[y])
                most = n - 2 * -(-percent * n // (100 + percent))
                assert any(a["id"] == x and b["id"] == y and a["element"] == b["element"] and 2 * min(a["rest"], b["rest"]) >= a["size"] + b["size"] - most for a in rows for b in rows)


def test_near_empty(docs):
    assert near_dedup.near_components(docs([])).collect() == []


def test_components(spark):
    edges = [(a, a + 1) for a in range(30)] + [(100, 101), (101, 101), (50, 200), (7, None)]
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(31), 0), 100: 100, 101: 100, 50: 50, 200: 50}
    labels = spark.createDataFrame([(k, 0) for k in range(31)] + [(100, 100), (101, 100)], "id long, component long")
    more = spark.createDataFrame([(101, 20), (300, 301), (301, 5), (7, None)], "a long, b long")
    assert {r.id: r.component for r in joined(labels, more).collect()} == dict.fromkeys([*range(31), 100, 101, 300, 301], 0)


# lines ------------------------------------------------------------------------------------------------------------


def lines_expected(rows):
    """Of each row the lines that stay; rows of one id come in the order of their texts' hashes."""
    seen, kept = {}, {}
    for i, t in rows:
        kept[i, t] = []
        for k, line in enumerate((t or "").encode().lower().split(b"\n")):
            w = frozenset(line.split())
            if not w:
                continue
            later = w in seen or any(5 * len(w & s) >= 4 * len(w | s) for s in seen)
            seen.setdefault(w, (i, k))
            if not later:
                kept[i, t].append(k)
    return kept


def in_order(spark, rows):
    """The distinct rows with an id, as the operator orders them."""
    frame = spark.createDataFrame(sorted({r for r in rows if r[0] is not None}, key=str), "doc_id long, text string")
    return [(r.doc_id, r.text) for r in frame.orderBy("doc_id", F.xxhash64("text")).collect()]


def lines_found(frame):
    return Counter((r.doc_id, r.n_lines, r.n_removed, tuple(r.kept or ())) for r in line_dedup.line_numbers(frame).collect())


def lines_counted(spark, rows):
    kept = lines_expected(in_order(spark, rows))
    out = Counter()
    for i, t in rows:
        lines = (t or "").encode().split(b"\n")
        own = kept.get((i, t), [])
        out[i, len(lines), sum(bool(x.split()) for x in lines) - len(own) if i is not None else 0, tuple(own)] += 1
    return out


def test_lines_sample(spark, docs):
    rows = [(i, t) for i, t in texts(spark).items()][:150]
    assert lines_found(docs(rows)) == lines_counted(spark, rows)


def test_lines_of_families(spark, docs):
    """Many variants of a few lines, of which some are similar to the first one and some to others alone."""
    rng, rows = np.random.default_rng(6), []
    for i in range(250):
        lines = []
        for size in (6, 11, 24):
            w = [f"b{size}x{k}" for k in range(size)]
            for k in rng.integers(0, size, rng.integers(0, 1 + size // 4)):
                w[k] = f"e{rng.integers(0, 5)}"
            lines.append(" ".join(w[: size - rng.integers(0, 2)]))
        rows.append((i, "\n".join(lines)))
    assert lines_found(docs(rows)) == lines_counted(spark, rows)


def edited_lines(n_lines, plain):
    """Lines of one family: 30 words of which two or three are replaced at random, every fourth with words of its own;
    with plain, the unedited words as the third line."""
    rng = np.random.default_rng(17)
    base = [f"b{k}" for k in range(30)]
    lines = []
    for i in range(n_lines):
        w = list(base)
        for at in rng.choice(30, 2 + i % 2, replace=False):
            w[at] = f"n{rng.integers(0, 400)}"
        lines.append(" ".join(w + [f"own{i}x{k}" for k in range(rng.integers(1, 12) if i % 4 == 0 else 0)]))
    if plain:
        lines[2] = " ".join(base)
    return [(i, "\n".join(lines[k : k + 10])) for i, k in enumerate(range(0, n_lines, 10))]


def test_lines_of_one_large_family(spark, docs, monkeypatch):
    """Equal to brute force; where the family has a line that the others are near to, compared pairs grow about as it does."""
    compared = []
    monkeypatch.setattr(line_dedup, "_compared", lambda pairs, *rest, _run=line_dedup._compared, **how: compared.append(pairs.count()) or _run(pairs, *rest, **how))
    sums = []
    for n_lines in (300, 1500):
        compared.clear()
        rows = edited_lines(n_lines, True)
        assert lines_found(docs(rows)) == lines_counted(spark, rows)
        sums.append(sum(compared))
    assert sums[1] <= 12 * sums[0], sums
    rows = edited_lines(400, False)
    assert lines_found(docs(rows)) == lines_counted(spark, rows)


def test_lines_odd_rows(spark, docs, odd):
    rows = odd + [(20, "a b c d e\n\n  \na b c d f\nA B C D E"), (21, "e d c b a\nb c d e a x"), (30, "p q r s\nt u v w"), (30, "x y z w\np q r s"), (30, "x y z w\np q r s")]
    found = lines_found(docs(rows))
    assert found == lines_counted(spark, rows) and all(n >= 0 for _, _, n, _ in found)
    kept = lines_expected(in_order(spark, rows))
    for r in line_dedup.deduplicated(docs(rows)).where("doc_id in (20, 21, 30)").collect():
        whole = [t for i, t in rows if i == r.doc_id]
        cut = lambda t, i: "\n".join(x for k, x in enumerate(t.split("\n")) if not x.split() or k in kept[i, t])
        assert r.text in [cut(t, r.doc_id) for t in whole]
    assert line_dedup.line_numbers(docs([])).collect() == []


# substrings -------------------------------------------------------------------------------------------------------


def cut_expected(rows):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
    out = Counter()
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if i is not None and first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out[i, len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()] += 1
    return out


@pytest.mark.parametrize("sample", [False, True])
def test_substrings(spark, docs, odd, sample):
    rows = [(i, t) for i, t in texts(spark).items()][:120] if sample else odd + [(2, "other " * 30 + PASSAGE), (30, "pre " + PASSAGE + " post"), (31, PASSAGE[:49]), (32, "ab" * 300), (33, "b" + "ab" * 200)]
    found = suffix_dedup.suffix_dedup(docs(rows)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == cut_expected(rows)


PASSAGE = "a passage that stands in several documents, with more than fifty bytes of its own, word for word"


def test_substrings_of_one_id_on_two_texts(spark):
    """Both texts of an id in one partition lose what a smaller id in another partition holds."""
    rows = [[(1, "first " + PASSAGE + " one")], [(2, "second " + PASSAGE + " two"), (2, "third " + PASSAGE + " three"), (2, "third " + PASSAGE + " three")]]
    parts = [spark.createDataFrame(r, "doc_id long, text string").coalesce(1) for r in rows]
    found = suffix_dedup.suffix_dedup(parts[0].unionByName(parts[1])).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == cut_expected(rows[0] + rows[1])


def test_minima_of_one_id_on_two_texts_are_announced_for_both():
    send, told = suffix_dedup._minima_of([0]), {}
    tasks = [[(1, 11, PASSAGE, 0)], [(2, 22, PASSAGE, 0), (2, 33, PASSAGE, 0), (2, 33, PASSAGE, 0)]]
    sent = [b for rows in tasks for b in send(iter([pa.RecordBatch.from_pylist([dict(zip(("doc_id", "text_hash", "text", "home"), r)) for r in rows])]))]
    for batch in suffix_dedup._shared_minima([0], 1000)(iter(sent)):
        suffix_dedup._heard(batch, told, np.uint64)
    assert set(told[0]) == {(1, 11), (2, 22), (2, 33)}


def test_substrings_behind_one_heading(monkeypatch, spark):
    """A heading of thousands of documents, each with a text of its own behind it: its minima are hot, and no part gets
    a third of their windows."""
    monkeypatch.setattr(suffix_dedup, "LEAST_HOT", 50)
    rng = np.random.default_rng(8)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    tails = [letters(40) for _ in range(2000)]
    rows = [(k, f"{letters(30)} {PASSAGE[:60]}{tails[k % 1900]}") for k in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = suffix_dedup.suffix_dedup(frame).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == cut_expected(rows)


def test_substrings_empty(docs):
    assert suffix_dedup.suffix_dedup(docs([])).collect() == []


@pytest.mark.parametrize("n,letters", [(1, 2), (7, 1), (300, 2), (500, 3), (1000, 1), (2000, 26)])
def test_suffix_order(n, letters):
    t = (np.random.default_rng(n).integers(0, letters, n) + 97).astype(np.uint8)
    t[n // 2 : n // 2 + n // 4] = t[: n // 4]
    b, order = t.tobytes(), suffix_dedup.suffix_order(t, suffix_dedup.words_at(t)).tolist()
    assert sorted(order) == list(range(n))
    assert [b[i : i + 50] for i in order] == sorted(b[i : i + 50] for i in range(n))
    wanted = np.random.default_rng(n + 1).random(n) < 0.2
    some = suffix_dedup.suffix_order(t, suffix_dedup.words_at(t), wanted=wanted).tolist()
    assert len(set(some)) == len(some) and set(np.flatnonzero(wanted)) <= set(some)
    assert [b[i : i + 50] for i in some] == sorted(b[i : i + 50] for i in some)


def test_small_batches_end_with_their_block(spark):
    from tallgrass.llm.common import small_batches

    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(batch)
    with small_batches(spark):
        seen = spark.range(1200, numPartitions=1).mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long").collect()
        assert max(r.n for r in seen) <= 500
    assert spark.conf.get(batch) == usual


def test_lines_meet_through_few_tokens_of_the_smaller_set(spark):
    """Of 47 words a set meets larger ones through its 6 rarest, not all 10 of its prefix."""
    from tallgrass.llm.line_dedup import _short

    rows = spark.createDataFrame([(1, 47 * 2**32 + 2 * at, at) for at in range(10)], "k1 long, nad long, token long")
    assert sorted(r.token for r in _short(rows).collect()) == list(range(6))


def test_lines_and_blanks_are_counted(spark):
    from tallgrass.llm.line_dedup import line_numbers

    texts = {1: "a b\n \t\r\n\n\x0bc\x0c", 2: "", 3: "\n", 4: None, 5: "\u00a0\n\u00e9t\u00e9 ", 6: "x\n"}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_lines, r.n_blank) for r in line_numbers(rows).collect()}
    lines = {k: (t or "").split("\n") for k, t in texts.items()}
    assert found == {k: (len(x), sum(not y.strip(" \t\n\x0b\f\r") for y in x)) for k, x in lines.items()}
