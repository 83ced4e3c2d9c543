"""The prefix trie against dictionaries of whole sequences."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd

from shelfline.llm import prefix_trie
from shelfline.llm.common import importable

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -((-c) % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    members = defaultdict(list)
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append((c, len(turns)))
    below = defaultdict(lambda: [0, 0, 0])
    for node, held in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            sums = below[node[:d]]
            sums[0] += (len(held) - 1) * words
            sums[1] += all(n == len(node) for _, n in held)
            sums[2] += d == len(node) - 1
    out = []
    for node, held in members.items():
        ends = ",".join(map(str, sorted(c for c, n in held if n == len(node))))
        saved, leaves, children = below[node]
        out.append((min(c for c, _ in held), len(node), min(c for c, _ in members[node[:-1]]) if node else None, len(held),
                    children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def some_rows(seed, convs=90, longest=9):
    rng, rows = random.Random(seed), []
    for c in [*range(convs), -3, -20, 10**12]:
        if rng.random() < 0.1:
            continue
        n = rng.choice([0, 1, 2, 3, longest, rng.randint(1, longest)])
        copy = [(rng.choice(["user", "bot", None]), rng.choice(["", None, "yes", "a  b\tc", "x y z"])) for _ in range(n)]
        if rng.random() < 0.4:
            copy = [("user", "hello you"), ("bot", "hi"), ("user", "so")][:n] + copy[3:]
        rows += [(c, None if rng.random() < 0.05 else k, *turn) for k, turn in enumerate(copy)]
    return rows + [(None, 1, "user", "no one"), rows[0], rows[0]]


def nodes_of(frame):
    return sorted((tuple(r) for r in prefix_trie.build(frame).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


def test_nodes_are_those_of_whole_sequences(spark):
    importable(spark)
    for seed in (1, 2):
        rows = some_rows(seed)
        frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "2 AS w", "'f' AS f1", "3 AS pos", "0 AS len")
        assert nodes_of(frame.repartition(7)) == brute(rows)


def test_sql_agrees_with_whole_sequences():
    rows = some_rows(3)
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    found = duckdb.sql(prefix_trie.ORACLE_SQL).fetchall()
    assert sorted(found, key=repr) == brute(rows)


def test_one_conversation_of_most_turns_is_spread(spark):
    importable(spark)
    rng = random.Random(5)
    rows = [(7, k, "user", rng.choice(["a", "b c"])) for k in range(3000)] + [(3, 1, "bot", "again")] * 600 + some_rows(6, 40)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(9)
    # adaptive execution would join small partitions
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert nodes_of(frame) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_colliding_hashes_are_seen_and_hashed_anew(spark, monkeypatch):
    importable(spark)
    rows, real, seeds = some_rows(8, 30), prefix_trie.stored_turns, []

    def colliding(frame, seed):
        seeds.append(seed)
        turns = real(frame, seed)
        return turns.withColumns({"t1": turns["w"], "t2": turns["w"], "s1": turns["w"] * 0, "s2": turns["w"] * 0}) if len(seeds) == 1 else turns
    monkeypatch.setattr(prefix_trie, "stored_turns", colliding)
    assert nodes_of(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert len(seeds) == 2


def test_without_conversations(spark):
    importable(spark)
    assert nodes_of(spark.createDataFrame([], SCHEMA)) == []
    assert nodes_of(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)) == []
    assert nodes_of(spark.createDataFrame([(5, None, None, None)], SCHEMA)) == brute([(5, None, None, None)])


def test_powers_go_back_and_forth():
    for which in (0, 1):
        up, down = (prefix_trie.powers(which, s * np.arange(50)) for s in (1, -1))
        assert (up * down == 1).all() and (up[1:] == up[:-1] * up[1]).all()
