"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document's set holds the hashes of its distinct shingles of ``SIZE`` words (A-Z lower-cased; the whole sequence if it
is shorter). Its sketch has ``COORDINATES`` places, filled in rounds: in round i every shingle falls into one place
by hash and the place keeps the least value; from round COORDINATES on, all shingles go to place i - COORDINATES,
so no place stays empty after 2 * COORDINATES rounds, and large sets are done after one. Values of earlier rounds are
smaller than those of later ones. Two documents agree in a place with the probability of their similarity, and the
number of places that agree is at least as concentrated as with independent hashes.

``BANDS`` bands of ``ROWS`` places retrieve candidates: at a similarity of 0.85 a pair shares none with a probability
of (1 - 0.85**5)**28, under 8e-8, at 0.80 of 1.5e-5; at 0.3 one in 15 pairs shares one. Candidates are confirmed on the full sets, so no false link is made. Within a
bucket no pairs are listed. First its smallest class is compared with all others, which settles most buckets. Those
that still hold several groups are compared in blocks of ``BLOCK`` classes: a pair of blocks counts
the intersections of all its pairs by matrix products and returns, for each class, the least one it reaches over links
there. So every pair of a bucket is either compared or known to lie in one group, with rows in proportion to classes.

Null, empty and blank texts have an empty set and no links. Rows with one doc_id count as one document: what any of
them links to. Rows without doc_id link to nothing and are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import components, mix, shingles_of, sieved, staged, words_of

SIZE = 5
COORDINATES = 140
ROWS = 5
BANDS = COORDINATES // ROWS
PERCENT = 85       # links have 100 * intersection >= PERCENT * union
BLOCK = 256        # classes of a bucket compared at a time
COLUMNS = 1 << 13  # distinct shingles counted at a time: 16 MB for a pair of blocks
SLICE = 1 << 18    # shingles of a pair of blocks sorted at a time, about

PRINT_SCHEMA = "doc_id long, n_shingles long, class binary, bands array<long>"
SET_SCHEMA = "id long, set array<long>"
_SEED = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64))
_MASK = (np.uint64(1) << np.uint64(48)) - np.uint64(1)


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    return np.unique(shingles_of(words_of((text or "").encode())[0], size))


def sketch(elements: np.ndarray, places: int = COORDINATES) -> np.ndarray:
    """The least (round, hash) of each place, packed; elements must not be empty."""
    out = np.full(places, np.iinfo(np.uint64).max, np.uint64)
    missing = np.ones(places, bool)
    for i in range(2 * places):
        h = mix(elements ^ _SEED[i])
        if i < places:
            place = (h >> np.uint64(48)) % np.uint64(places)
            # one sort orders by place, then value
            key = np.sort((place << np.uint64(48)) | (h & _MASK))
            at = (key >> np.uint64(48)).astype(np.intp)
            first = np.flatnonzero(np.diff(at, prepend=-1))
            at, value = at[first], key[first] & _MASK
        else:
            at, value = np.array([i - places]), (h & _MASK).min(keepdims=True)
        new = missing[at]
        out[at[new]] = (np.uint64(i) << np.uint64(48)) | value[new]
        missing[at] = False
        if not missing.any():
            return out
    return out


def bands(places: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key for each band: its number and its places."""
    grouped = places.reshape(-1, rows)
    key = mix(np.arange(1, len(grouped) + 1, dtype=np.uint64))
    for k in range(rows):
        key = mix(key ^ grouped[:, k])
    return key.view(np.int64)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, classes, keys = [], [], []
        for text in batch.column("text"):
            words = words_of((text.as_py() or "").encode())[0]
            elements = np.unique(shingles_of(words, SIZE))
            n.append(len(elements))
            if len(words):
                # 128 bits of the whole sequence: two sums of words mixed with their places
                places = np.arange(1, len(words) + 1, dtype=np.uint64)
                sums = [int(mix(words ^ mix(places + np.uint64(s << 32))).sum(dtype=np.uint64)) for s in (1, 2)]
                classes.append(sums[0].to_bytes(8, "big") + sums[1].to_bytes(8, "big"))
                keys.append(bands(sketch(elements)))
            else:
                classes.append(None)
                keys.append(np.empty(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(classes, pa.binary()),
             pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "class", "bands"])


def prints(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class (a digest of the word sequence) and band keys of each row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_prints, PRINT_SCHEMA)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([shingle_set(t.as_py()).view(np.int64) for t in batch.column("text")],
                                          pa.list_(pa.int64()))], ["id", "set"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("set").alias(f"set_{x}"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    return (pairs.join(side("b"), "b").join(side("a"), "a")
            .where((both > 0) & (100 * both >= percent * union)).select("a", "b"))


def link_groups(docs: DataFrame, printed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, component) of the documents that are linked with others, from staged prints."""
    known = printed.where("doc_id IS NOT NULL AND class IS NOT NULL")
    # staged, so that a join with many rows of one class reads two plain shuffles, which Spark can split
    first = staged(known.groupBy("class").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "near-classes")
    same = known.join(first.where("n > 1"), "class").select("doc_id", "first")
    classes = (known.join(first.select("class", F.col("first").alias("doc_id")), ["class", "doc_id"])
               .select(F.col("doc_id").alias("id"), "n_shingles", "bands").dropDuplicates(["id", "n_shingles", "bands"]))
    spread = classes.select("id", "n_shingles", F.explode("bands").alias("band"))
    shared = staged(spread.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band"), "near-shared")
    bucket = staged(spread.join(shared, "band").select("band", "id", "n_shingles").distinct(), "near-buckets")
    wanted = staged(bucket.select("id").distinct(), "near-wanted")
    texts = sieved(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), "id", wanted)
    # one plan at every size, no broadcast of what is small today
    sets = staged(texts.join(wanted.hint("merge"), "id", "left_semi").mapInArrow(_sets, SET_SCHEMA), "near-sets")
    links = staged(same.where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
                   .distinct(), "near-links")
    # staged for the same reason: a band that many classes share
    hub = staged(bucket.groupBy("band").agg(F.min("id").alias("a")), "near-hubs")
    sizes = bucket.select("id", F.col("n_shingles").alias("n_a")).distinct()
    pairs = (bucket.join(hub, "band").where("id > a").select("a", "id", "n_shingles").distinct()
             .join(sizes.withColumnRenamed("id", "a"), "a")  # sets of too different sizes cannot be linked
             .where(F.least("n_shingles", "n_a") * 100 >= F.greatest("n_shingles", "n_a") * percent))
    links = links.union(staged(confirm(pairs.select("a", F.col("id").alias("b")).distinct(), sets, percent), "near-links"))
    grouped = components(links, "near-components")
    left = (bucket.join(hub, "band").where("id <> a").select("band", "id").distinct()
            .join(grouped, "id", "left").select("band", "id", F.coalesce("component", "id").alias("component")))
    # buckets with several groups, each set of classes once
    open_ = (left.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"),
                                      F.bit_xor(F.xxhash64("id")).alias("who")).where("lo <> hi")
             .groupBy("n", "who").agg(F.min("band").alias("band"))
             .select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    members = left.select("band", "id").join(open_, "band").withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    dealt = (members.join(sets, "id").withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "set"))
    found = dealt.groupBy("band", "i", "j").applyInPandas(lambda rows: _block_links(rows, percent), "a long, b long")
    return components(links.union(staged(found, "near-links")), "near-components")


def _count_shared(sets: list[np.ndarray], both: np.ndarray) -> None:
    """Adds the sizes of the intersections of all pairs to both."""
    who = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(often > 1) - 1  # only shingles of several sets count
    keep = often[place] > 1
    who, place = who[keep], shared[place[keep]]
    order = np.argsort(place, kind="stable")
    who, place = who[order], place[order]
    width = int(place[-1]) + 1 if len(place) else 0
    for low in range(0, width, COLUMNS):
        a, b = np.searchsorted(place, (low, low + COLUMNS))
        held = np.zeros((len(sets), min(COLUMNS, width - low)), np.float32)
        held[who[a:b], place[a:b] - low] = 1
        both += held @ held.T


def _block_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """(a, b): each class of a pair of blocks with the least one that it reaches over links within the pair."""
    ids, sets = rows["id"].to_numpy(), [np.asarray(s, np.int64).view(np.uint64) for s in rows["set"]]
    size = np.array([len(s) for s in sets])
    both = np.zeros((len(ids), len(ids)), np.float32)
    # sets ascend, so each range of hashes is a slice of every set; one range is worked on at a time
    parts = 1 + int(size.sum()) // SLICE
    edges = np.array([k * (2**64 // parts) for k in range(1, parts)], np.uint64)
    cuts = [np.concatenate([[0], np.searchsorted(s, edges), [len(s)]]) for s in sets]
    for k in range(parts):
        pieces = [s[c[k]:c[k + 1]] for s, c in zip(sets, cuts)]
        _count_shared(pieces, both)
    union = size[:, None] + size[None, :] - both
    linked = (both > 0) & (100.0 * both.astype(np.float64) >= percent * union.astype(np.float64))
    linked |= ids[:, None] == ids[None, :]  # texts of one id
    least, before = ids.copy(), None
    while before is None or not np.array_equal(before, least):
        before = least
        least = np.minimum(least, np.where(linked, least[None, :], np.iinfo(np.int64).max).min(1))
    moved = least != ids
    return pd.DataFrame({"a": ids[moved], "b": least[moved]})


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reached by links) and kept, for each row."""
    printed = staged(prints(docs), "near-prints")
    grouped = link_groups(docs, printed, percent)
    component = F.coalesce("component", "doc_id")
    return (printed.join(grouped, printed["doc_id"] == grouped["id"], "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, one document of each group; of rows with one doc_id the least; all rows without doc_id."""
    groups = staged(near_groups(docs, percent), "near-groups")
    dropped = groups.where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(F.struct("*").alias("row"))
    # dropped grows with the documents: one plan at every size, no broadcast of what is small today
    kept = rows.join(dropped.hint("merge"), rows["row.doc_id"] == dropped["gone"], "left_anti")
    again = groups.where("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("twice")).count().where("count > 1")
    if not again.take(1):
        return kept.select("row.*")
    twice = again.select("twice")
    once = kept.join(twice, kept["row.doc_id"] == twice["twice"], "left_anti")
    least = (kept.join(twice, kept["row.doc_id"] == twice["twice"], "left_semi")
             .groupBy("row.doc_id").agg(F.min("row").alias("row")).select("row"))
    return once.union(least).select("row.*")


#: All pairs that share a shingle, for tables as small as a test's.
ORACLE_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
spots AS (SELECT doc_id, w, unnest(range(0, greatest(1, len(w) - {SIZE - 1}))) AS i FROM words WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + {SIZE}], ' ') AS s FROM spots),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
          FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
          WHERE 100 * k >= {PERCENT} * (x.n + y.n - k)),
arcs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, other) AS (SELECT a, b FROM arcs UNION SELECT r.id, e.b FROM reach r JOIN arcs e ON r.other = e.a),
least_of AS (SELECT id, min(other) AS other FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(other, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN least_of l ON d.doc_id = l.id"""
