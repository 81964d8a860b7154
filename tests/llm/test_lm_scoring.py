"""Language-model scores against plain dictionaries of counts."""

import math
import re
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest

from tallgrass.llm import lm_scoring as lm

SF = "/root/testdata/sf0.01"


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w] + ["</s>"]


def trains(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


class Plain:
    def __init__(self, rows):
        self.c = Counter()
        for i, text in rows:
            if trains(i):
                t = tokens(text)
                self.c[("<s>",)] += 1
                self.c.update((w,) for w in t)
                self.c.update(zip(["<s>", *t], t, strict=False))
                self.c.update(zip(["<s>", *t], t, t[1:], strict=False))
        words = [k for k in self.c if len(k) == 1 and k != ("<s>",)]
        self.n, self.v = sum(self.c[k] for k in words), len(words)

    def p(self, gram):
        if len(gram) == 1:
            return (self.c[gram] + 1) / (self.n + self.v + 1)
        held = self.c[gram[:-1]]
        m = lm.PRIOR[len(gram)]
        return (self.c[gram] + m * self.p(gram[1:])) / (held + m)

    def row(self, i, text):
        t = tokens(text)
        padded = ["<s>", *t]
        score = sum(math.log10(self.p(tuple(padded[max(0, k - 2) : k + 1]))) for k in range(1, len(padded)))
        base = sum(math.log10(self.p((w,))) for w in t)
        return (i, not trains(i), len(t), sum(self.c[(w,)] > 0 for w in t), self.n, base, score)


def same(found, rows):
    plain = Plain(rows)
    expected = sorted((plain.row(*r) for r in rows), key=str)
    found = sorted((tuple(r) for r in found.collect()), key=str)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in found], [r[5:] for r in expected], rtol=1e-9)


def generated(rng, many):
    for i in range(many):
        yield i, " ".join(rng.choice(["a", "B", "c.", "dd", "Ee", f"w{i}", "f"], int(rng.integers(0, 40))))


@pytest.mark.parametrize("size", [400, 12_000_000])
def test_against_dictionaries(spark, docs, monkeypatch, size):
    monkeypatch.setattr(lm, "SLICE", size)
    monkeypatch.setattr(lm, "BUCKET", size)
    rows = list(generated(np.random.default_rng(4), 200))
    same(lm.lm_scores(docs(rows)), rows)


def test_odd_rows(spark, docs, odd):
    same(lm.lm_scores(docs(odd)), odd)
    assert lm.lm_scores(docs([])).collect() == []
    alone = [(i, "never learnt") for i in range(100) if not trains(i)]
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in lm.lm_scores(docs(alone)).collect()} == {(0, 0, 0.0, 0.0)}


def test_distribution_sums_to_one():
    rows = list(generated(np.random.default_rng(8), 60))
    plain = Plain(rows)
    words = [k[0] for k in plain.c if len(k) == 1 and k != ("<s>",)] + ["<unknown>"]
    for context in [(), ("<s>",), ("<s>", "a"), ("a", "b"), ("b", "c."), ("f", "<unknown>")]:
        assert math.isclose(sum(plain.p((*context, w)) for w in words), 1)


def test_other_rows_on_the_second_read(spark, docs):
    """An error, not a wrong score."""
    rows = docs([(i, f"some words {i}") for i in range(50)])
    unsteady = rows.withColumn("text", lm.F.udf(lambda text: text + uuid.uuid4().hex)("text"))
    with pytest.raises(Exception, match="docs gave other rows"):
        lm.lm_scores(unsteady).collect()


def test_query(spark):
    found = lm.op11_lm_scoring(spark, SF).toPandas()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    plain = Plain(rows)
    by_id = {r[0]: r for r in found.itertuples(index=False)}
    assert len(by_id) == len(rows) == len(found)
    for i, text in rows[::7]:
        expected = plain.row(i, text)
        assert tuple(by_id[i])[:5] == expected[:5] and np.allclose(tuple(by_id[i])[5:], expected[5:], rtol=1e-9)
    held = found[found.held_out]
    assert held.score.sum() > held.base_score.sum()
