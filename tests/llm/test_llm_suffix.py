"""Repeated passages against a dictionary of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from shelfline.llm import suffix_dedup
from shelfline.llm.common import importable

SCHEMA = "doc_id long, text string"
G = suffix_dedup.GRAM


def brute(docs):
    least = {}
    for i, text in docs:
        raw = (text or "").encode()
        if i is not None:
            for p in range(len(raw) - G + 1):
                w = raw[p:p + G]
                least[w] = min(least.get(w, i), i)
    out = Counter()
    for i, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        if i is not None:
            for p in range(len(raw) - G + 1):
                if least[raw[p:p + G]] < i:
                    gone[p:p + G] = b"\1" * G
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(raw)))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def some_docs(seed, n=120):
    rng = random.Random(seed)
    letters = ["abcdefgh ", "ab", "a", "éü\0x\n", "the cat sat on"]
    passages = ["".join(rng.choice(rng.choice(letters)) for _ in range(rng.choice([20, 49, 50, 51, 80, 200]))) for _ in range(12)]
    docs = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 6)):
            text += rng.choice([rng.choice(passages), rng.choice(passages)[rng.randint(0, 9):], "".join(rng.choice("qrstuvw xyz") for _ in range(rng.randint(0, 90)))])
        docs.append((rng.randint(0, 2 * n), text))
    docs += [(500, docs[0][1]), (501, docs[1][1] + docs[2][1]), (None, docs[3][1]), (502, None), (503, ""), (1, docs[4][1]), (1, docs[4][1])]
    return docs + [(600, "a" * 300), (601, "a" * 49), (602, "a" * 50), (603, "ba" * 100), (604, "x" + "a" * 60 + "y"), (-5, "ba" * 30)]


@pytest.mark.parametrize("part,bucket,hot", [(1 << 22, 1 << 24, 1 << 16), (700, 900, 1 << 16), (700, 900, 3), (3000, 1 << 24, 1)])
def test_bytes_that_go_are_those_of_repeated_windows(spark, monkeypatch, part, bucket, hot):
    importable(spark)
    monkeypatch.setattr(suffix_dedup, "PART", part)
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    docs = some_docs(part + hot)
    frame = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 AS part", "'k' AS kept", "2 AS spans", "0 AS n_bytes")
    # workers import the module anew: what is set here goes with the parts they get
    pack = suffix_dedup._pack

    def small(batches):
        suffix_dedup.PART = part
        yield from pack(batches)
    monkeypatch.setattr(suffix_dedup, "_pack", small)
    got = Counter(tuple(r) for r in suffix_dedup.summarise(suffix_dedup.drop_repeats(frame.repartition(3))).collect())
    assert got == brute(docs)


def test_windows_of_blocks_are_those_of_the_whole():
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 100, 5000).astype(np.uint8)
    sizes = np.array([0, 30, 1200, 0, 50, 3000, 49, 671])
    ends = np.cumsum(sizes)
    named = {}
    for block in (1 << 22, 64, 333):
        at, lo, count, print_ = suffix_dedup.windows(raw, ends, ends - sizes, block)
        named[block] = {p: (a, h) for a, l, n, h in zip(at, lo, count, print_) for p in range(l, l + n)}
        assert ((lo <= at) & (at + suffix_dedup.Q <= lo + G) & (lo + count - 1 <= at)).all()
    assert named[64] == named[333] == named[1 << 22]
    assert sorted(named[64]) == [p for a, e in zip(ends - sizes, ends) for p in range(a, e - G + 1)]
    at, *_ = suffix_dedup.windows(rng.integers(0, 256, 100_000).astype(np.uint8), np.array([100_000]), np.array([0]))
    assert len(at) < 100_000 / 12


def test_ranks_are_those_of_sorting():
    rng = random.Random(3)
    rows = [bytes(rng.choice(b"ab\0") for _ in range(50)) for _ in range(300)]
    rows += rows[:50] + [r[:40] + bytes(10) for r in rows[:50]]
    text = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 50)
    order = {r: k for k, r in enumerate(sorted(set(rows)))}
    assert suffix_dedup.ranks(text).tolist() == [order[r] for r in rows]


def test_spans_and_empty_tables(spark):
    importable(spark)
    assert suffix_dedup.drop_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    passage = "0123456789" * 6
    rows = suffix_dedup.drop_repeats(spark.createDataFrame([(1, "x" + passage), (2, passage + "yy" + passage)], SCHEMA)).collect()
    second = next(r for r in rows if r.doc_id == 2)
    assert [tuple(s) for s in second.spans] == [(0, 60), (62, 122)] and bytes(second.kept) == b"yy"


def test_parts_are_not_shuffled_again(spark):
    importable(spark)
    docs = spark.createDataFrame(some_docs(9), SCHEMA)
    plan = suffix_dedup.drop_repeats(docs)._jdf.queryExecution().executedPlan().toString()
    # the answers alone go through an exchange
    assert plan.count("Exchange") - plan.count("AQEShuffleRead") <= 1
