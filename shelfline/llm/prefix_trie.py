"""The prefix trie of conversations that may begin with a part of another one.

A conversation is rebuilt from the first turns (the head) of its base and its own turns after as many. The fingerprint of a run of
turns is the sum of hash(turn) * B**position modulo 2**64, twice; runs concatenate by multiplying the later one with a power of B, and a
beginning is taken away by subtraction. So all prefixes of a rebuilt conversation come from prefix sums of the stored turns, one
product with a power of B for the change of place: no rebuilt text is made. Rows of equal depth and fingerprint are a node.

That a node is one sequence is verified: of each node all parents have one fingerprint and all last turns one pair of hashes, so by induction
its members agree turn by turn in their hashes, and each pair of hashes belongs to one stored role and text. If either ever fails, all is
hashed anew with other seeds.

What a node sums over its subtree needs no walk. Each node has a representative, its smallest member, and a conversation represents the nodes from
some depth on. A sum over the nodes below is a sum over members, of what each conversation adds from a depth on, over
all its nodes or over those it represents: running sums of a conversation and one aggregation by node, which combines before it shuffles.

Turns are numbered over range partitions: a task numbers its rows, and how a conversation goes on in the next partition is handed over
by one row for each partition, so a conversation of any length is spread over tasks. A digest of conv_ids is a running one by nature: ids are
joined to pieces of text by range, and one task feeds the pieces of a node to it in order, holding one piece at a time.

Null conv_id: the row belongs to no conversation and is left out. Null role or text are empty. Turns go by turn (null first), role and
text; repeated rows are repeated turns. Empty tables have no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import staged

HEAD = 3  # most turns taken from a base
_BASE = (0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95)
_BACK = tuple(pow(b, -1, 2**64) for b in _BASE)
WORD = r"[^\x20\x09-\x0D]+"
NEVER = 2**31 - 1
NODE = ["depth", "f1", "f2"]

SCAN_SCHEMA = "part int, conv_id long, pos long, s1 long, s2 long, t1 long, t2 long, w long, wp long"
MEMBER_SCHEMA = "conv_id long, depth long, len long, f1 long, f2 long, p1 long, p2 long, t1 long, t2 long, w long, wp long"


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % 20


def head_of(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string")) % 4).cast("int")


def powers(which: int, exponents: np.ndarray) -> np.ndarray:
    """B ** exponent modulo 2**64; exponents may be negative."""
    out = np.ones(len(exponents), np.uint64)
    for base, left in ((_BASE[which], np.maximum(exponents, 0)), (_BACK[which], np.maximum(-exponents, 0))):
        left = left.copy()
        while left.any():
            out = np.where(left & 1, out * np.uint64(base), out)
            base, left = base * base % 2**64, left >> 1
    return out


def _longs(*columns: pa.Array) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in columns]


def _bits(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions and prefix sums of each conversation within the partition, from sorted rows."""
    part = TaskContext.get().partitionId()
    last, pos, words, sums = None, 0, 0, [0, 0]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv, w = _longs(batch.column("conv_id"), batch.column("w"))
        begin = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        run = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, n)))
        goes_on = conv[0] == last
        at = np.arange(n) - begin[run] + np.where(run == 0, pos if goes_on else 0, 0)
        total = np.cumsum(w)
        wp = total - (total - w)[begin][run] + np.where(run == 0, words if goes_on else 0, 0)
        out = []
        for k, name in enumerate(("t1", "t2")):
            part_sum = np.cumsum(_bits(batch.column(name)) * powers(k, at), dtype=np.uint64)
            before = np.concatenate([np.zeros(1, np.uint64), part_sum])[begin][run]
            out.append(part_sum - before + np.where(run == 0, np.uint64(sums[k] if goes_on else 0), np.uint64(0)))
        last, pos, words, sums = conv[-1], int(at[-1]) + 1, int(wp[-1]), [int(o[-1]) for o in out]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part, np.int32)), batch.column("conv_id"), pa.array(at), *[pa.array(o.view(np.int64)) for o in out],
             batch.column("t1"), batch.column("t2"), batch.column("w"), pa.array(wp)],
            ["part", "conv_id", "pos", "s1", "s2", "t1", "t2", "w", "wp"])


def _handed_over(scanned: DataFrame) -> dict[tuple[int, int], tuple[int, int, int, int]]:
    """What precedes a conversation's rows in a partition: turns, words and prefix sums, for those that begin in an earlier partition.

    At most one row for each partition, its last conversation, can go on in the next, so the driver gets no more than two rows for each.
    """
    pieces = scanned.groupBy("conv_id", "part").agg(F.max(F.struct("pos", "wp", "s1", "s2")).alias("end"))
    several = pieces.groupBy("conv_id").agg(F.max("part").alias("to"), F.min("part").alias("of")).where("of < to").select("conv_id")
    rows = pieces.join(several, "conv_id", "left_semi").orderBy("conv_id", "part").collect()
    carried, before = {}, None
    for r in rows:
        n, words, s1, s2 = before[1:] if before and before[0] == r.conv_id else (0, 0, 0, 0)
        if n:
            carried[r.conv_id, r.part] = (n, words, s1, s2)
        shift = [int(powers(k, np.array([n]))[0]) for k in (0, 1)]
        before = (r.conv_id, n + r.end.pos + 1, words + r.end.wp, (s1 + shift[0] * r.end.s1) % 2**64, (s2 + shift[1] * r.end.s2) % 2**64)
    return carried


def _place(batches: Iterator[pa.RecordBatch], carried: dict) -> Iterator[pa.RecordBatch]:
    """Positions and prefix sums over whole conversations."""
    names = ["conv_id", "pos", "s1", "s2", "t1", "t2", "w", "wp"]
    for batch in batches:
        part, conv, pos, wp = _longs(*[batch.column(c) for c in ("part", "conv_id", "pos", "wp")])
        pos, wp, s = pos.copy(), wp.copy(), [_bits(batch.column(c)).copy() for c in ("s1", "s2")]
        for p, c in set(zip(part.tolist(), conv.tolist())) if carried else ():
            if (c, p) in carried:
                n, words, *sums = carried[c, p]
                rows = (part == p) & (conv == c)
                pos[rows] += n
                wp[rows] += words
                for k in (0, 1):
                    s[k][rows] = np.uint64(sums[k]) + powers(k, np.array([n]))[0] * s[k][rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(pos), *[pa.array(x.view(np.int64)) for x in s],
             batch.column("t1"), batch.column("t2"), batch.column("w"), pa.array(wp)], names)


def stored_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """Each turn with its position, two hashes, its words and the prefix sums up to it."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    hashed = rows.select("*", F.xxhash64(F.lit(seed), "role", "text").alias("t1"), F.xxhash64("text", "role", F.lit(seed + 1)).alias("t2"))
    # two turns with one pair of hashes and other words or roles: to be hashed anew
    clash = hashed.groupBy("t1", "t2").agg(F.min("role").alias("r"), F.max("role").alias("rr"), F.min("text").alias("x"), F.max("text").alias("xx"))
    if not clash.where("r <> rr OR x <> xx").isEmpty():
        return stored_turns(conversations, seed + 2)
    # the last number parts equal rows, so that any number of them can be split
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "tie"]
    scanned = staged(hashed.withColumns({"w": F.regexp_count("text", F.lit(WORD)).cast("long"), "tie": F.monotonically_increasing_id()})
                     .repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "t1", "t2", "w")
                     .mapInArrow(_scan, SCAN_SCHEMA), "trie-scan")
    carried = _handed_over(scanned)
    schema = SCAN_SCHEMA.partition(", ")[2]
    return staged(scanned.mapInArrow(lambda b: _place(b, carried), schema), "trie-turns")


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fingerprints of the prefix that ends at each rebuilt turn, and of the one before."""
    for batch in batches:
        depth, shift = _longs(batch.column("depth"), batch.column("shift"))
        out = []
        for k in (0, 1):
            add, less, s, t = (_bits(batch.column(f"{c}{k + 1}")) for c in ("add", "less", "s", "t"))
            whole = add + powers(k, shift) * (s - less)
            out.append((whole, whole - t * powers(k, depth - 1)))
        column = lambda c: batch.column(c)
        yield pa.RecordBatch.from_arrays(
            [column("conv_id"), column("depth"), column("len"), *[pa.array(f.view(np.int64)) for f, _ in out],
             *[pa.array(p.view(np.int64)) for _, p in out], *map(column, ("t1", "t2", "w", "wp"))],
            ["conv_id", "depth", "len", "f1", "f2", "p1", "p2", "t1", "t2", "w", "wp"])


def members(turns: DataFrame, base: Callable[[Column], Column], head: Callable[[Column], Column]) -> DataFrame:
    """One row for each rebuilt conversation and depth, the root's 0 included."""
    beginning = F.when(F.col("pos") < HEAD, F.struct("pos", "s1", "s2", "t1", "t2", "w", "wp"))
    convs = staged(turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("n"), F.sort_array(F.collect_list(beginning)).alias("first")), "trie-convs")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("first").alias("taken"))
    c = F.col("conv_id")
    info = (convs.withColumns({"base": base(c), "h": F.least(F.lit(HEAD), head(c))}).join(bases, "base", "left")
            .withColumn("taken", F.slice(F.coalesce("taken", F.array().cast("array<struct<pos:bigint,s1:bigint,s2:bigint,t1:bigint,t2:bigint,w:bigint,wp:bigint>>")), F.lit(1), F.col("h")))
            .withColumn("got", F.size("taken"))
            .withColumn("len", F.col("got") + F.greatest(F.lit(0), F.col("n") - F.col("h"))))
    zero = F.lit(0).cast("long")
    of = lambda array, at, name: F.coalesce(F.get(F.col(array), at - 1)[name], zero)
    info = staged(info.select("conv_id", "h", "got", "len", "taken", *[
        x for k in ("s1", "s2", "wp") for x in (of("taken", F.col("got"), k).alias(f"add_{k}"), of("first", F.col("h"), k).alias(f"less_{k}"))]), "trie-info")
    own = turns.join(info.drop("taken"), "conv_id").where("pos >= h").select(
        "conv_id", (F.col("got") + F.col("pos") - F.col("h") + 1).alias("depth"), F.col("len").cast("long").alias("len"),
        (F.col("got") - F.col("h")).cast("long").alias("shift"), *[F.col(f"{x}_s{k}").alias(f"{x}{k}") for x in ("add", "less") for k in (1, 2)],
        "s1", "s2", "t1", "t2", "w", (F.col("add_wp") + F.col("wp") - F.col("less_wp")).alias("wp"))
    heads = info.select("conv_id", "len", F.explode("taken").alias("x")).select(
        "conv_id", (F.col("x.pos") + 1).alias("depth"), F.col("len").cast("long").alias("len"), zero.alias("shift"),
        *[zero.alias(f"{x}{k}") for x in ("add", "less") for k in (1, 2)], *[F.col(f"x.{k}").alias(k) for k in ("s1", "s2", "t1", "t2", "w", "wp")])
    roots = info.select("conv_id", zero.alias("depth"), F.col("len").cast("long").alias("len"),
                        *[zero.alias(x) for x in ("f1", "f2", "p1", "p2", "t1", "t2", "w", "wp")])
    return own.unionByName(heads).mapInArrow(_prints, MEMBER_SCHEMA).unionByName(roots)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node joined to text, from rows sorted by node and id."""
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, ids = _longs(*[batch.column(c) for c in NODE]), batch.column("conv_id").to_pylist()
        change = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        cut = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(k[cut[:-1]]) for k in keys], pa.array([part] * (len(cut) - 1), pa.int32()),
             pa.array(range(seq, seq + len(cut) - 1), pa.int64()), pa.array([",".join(map(str, ids[a:b])) for a, b in zip(cut, cut[1:])])],
            [*NODE, "part", "seq", "ids"])
        seq += len(cut) - 1


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's pieces, fed in order."""
    node, running = None, None

    def batch_of(done: list) -> pa.RecordBatch:
        columns = list(zip(*done)) or [[]] * 4
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], [*NODE, "ends_sha256"])
    for batch in batches:
        done = []
        for *key, ids in zip(*[batch.column(c).to_pylist() for c in [*NODE, "ids"]]):
            if key != node:
                if running is not None:
                    done.append([*node, running.hexdigest()])
                node, running = key, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        yield batch_of(done)
    if running is not None:
        yield batch_of([[*node, running.hexdigest()]])


def end_digests(rows: DataFrame) -> DataFrame:
    """depth, f1, f2 and ends_sha256 of the nodes where conversations end."""
    order = [*NODE, "conv_id"]
    pieces = (rows.where("depth = len").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(_pieces, "depth long, f1 long, f2 long, part int, seq long, ids string"))
    return (pieces.repartition(*NODE).sortWithinPartitions(*NODE, "part", "seq")
            .mapInArrow(_digests, "depth long, f1 long, f2 long, ends_sha256 string"))


def build(conversations: DataFrame, *, base: Callable[[Column], Column] = base_of, head: Callable[[Column], Column] = head_of,
          seed: int = 1) -> DataFrame:
    """The nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    ``base`` gives the conversation whose head is taken, ``head`` the number of its turns, at most HEAD.
    """
    rows = staged(members(stored_turns(conversations, seed), base, head), "trie-members")
    checked = ["p1", "p2", "t1", "t2"]
    nodes = staged(rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("rep"), F.count("*").alias("n_convs"), F.max("len").alias("most"), F.min("w").alias("w"), F.min("wp").alias("wp"),
        *[x for c in checked for x in (F.min(c).alias(c), F.max(c).alias(f"{c}_most"))]), "trie-nodes")
    if not nodes.where(" OR ".join(f"{c} <> {c}_most" for c in checked)).isEmpty():
        return build(conversations, base=base, head=head, seed=seed + 100)
    # from which depth on a conversation represents nodes, the words before that, and whether its end is a leaf
    reps = staged(nodes.groupBy(F.col("rep").alias("conv_id")).agg(
        F.min("depth").alias("own"), F.min_by(F.col("wp") - F.col("w"), "depth").alias("cap"),
        F.max((F.col("depth") == F.col("most")).cast("int")).alias("leaf")), "trie-reps")
    whole = rows.where("depth = len").select("conv_id", F.col("wp").alias("whole"))
    scalars = staged(whole.join(reps, "conv_id", "left").select(
        "conv_id", F.coalesce("own", F.lit(NEVER)).alias("own"), F.coalesce("cap", "whole").alias("cap"), F.coalesce("leaf", F.lit(0)).alias("leaf")),
        "trie-scalars")
    sums = rows.join(scalars, "conv_id").groupBy(*NODE).agg(
        F.sum(F.when((F.col("own") > F.col("depth")) & (F.col("depth") > 0), F.col("cap") - (F.col("wp") - F.col("w")))
              .when(F.col("own") > F.col("depth"), F.col("cap")).otherwise(0)).alias("saved_tokens"),
        F.sum("leaf").cast("long").alias("n_leaves"),
        F.count_if((F.col("len") > F.col("depth")) & (F.col("own") <= F.col("depth") + 1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("rep").alias("parent_conv_id"))
    return (nodes.select(*NODE, "p1", "p2", "rep", "n_convs").join(sums, NODE).join(end_digests(rows), NODE, "left")
            .join(parents, ["depth", "p1", "p2"], "left")
            .select(F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


#: Prefixes themselves as keys, and all pairs of a node and those above it, for tables as small as a test's.
ORACLE_SQL = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
steps AS (SELECT conv_id, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: [ord(ch), -1, -1, -1, -1, -1, -1, -1, -1])) AS b FROM own),
heads AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, CAST(b AS BIGINT[])),
            lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h FROM steps),
rebuilt AS (SELECT o.conv_id, list_concat(coalesce(b.s[1:h], []), o.s[h + 1:len(o.s)]) AS s
            FROM own o JOIN heads USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
spots AS (SELECT conv_id, s, len(s) AS n, unnest(range(0, len(s) + 1)) AS d FROM rebuilt),
mem AS (SELECT conv_id, d, n, min(conv_id) OVER w AS rep, count(*) OVER w AS n_convs, max(n) OVER w AS most,
               CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(s[d].t, '{WORD}')) END AS words
        FROM spots WINDOW w AS (PARTITION BY d, s[1:d])),
nodes AS (SELECT d, rep, max(n_convs) AS n_convs, max(words) AS words, max(most) AS most,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends FROM mem GROUP BY d, rep),
below AS (SELECT a.d, a.rep, sum((u.n_convs - 1) * u.words) AS saved, count(*) FILTER (u.most = u.d) AS leaves, count(*) FILTER (u.d = a.d + 1) AS children
          FROM nodes u JOIN mem a ON a.conv_id = u.rep AND a.d <= u.d GROUP BY a.d, a.rep)
SELECT x.rep AS conv_id, x.d AS depth, p.rep AS parent_conv_id, x.n_convs, children AS n_children, leaves AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
FROM nodes x JOIN below USING (d, rep) LEFT JOIN mem p ON p.conv_id = x.rep AND p.d = x.d - 1"""
