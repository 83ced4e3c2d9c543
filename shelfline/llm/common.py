"""What several operators share: reading tables, staging, word hashes, and linked groups."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import fresh_path


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS = 512  # texts handed to a Python worker at a time; 10,000 of them, Spark's own number, can be all the memory it has


def importable(spark: SparkSession) -> None:
    """Lets Python workers look for this package where the driver found it, beside where they look already.

    A session that does not say how many rows a worker gets at a time gives it ``ROWS``.
    """
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, ROWS)
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, root)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: lineage ends there, a lost executor costs a read."""
    spark = frame.sparkSession
    path = fresh_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


# ---------------------------------------------------------------- rows that a join would drop

SIEVE_BITS = 1 << 26  # 8 MB, whatever is sieved
_MAP_BITS = 1 << 15   # of one bitmap that Spark's functions build


def _places(id_: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), id_), F.lit(SIEVE_BITS)) for k in (11, 12)]


def sieved(rows: DataFrame, name: str, wanted: DataFrame) -> DataFrame:
    """The rows whose id is among those of ``wanted``, and a few others: a Bloom filter of fixed size, in front of a join's shuffle.

    It never drops a wanted row. The more ids there are for its bits, the more others it lets pass; the join behind it stays exact.
    """
    places = wanted.select(F.explode(F.array(*_places(F.col(name)))).alias("at"))
    # as many rows as the filter has bitmaps
    maps = (places.groupBy(F.floor(F.col("at") / _MAP_BITS).alias("k"))
            .agg(F.bitmap_construct_agg(F.col("at") % _MAP_BITS).alias("bits")).collect())
    whole = np.zeros((SIEVE_BITS // _MAP_BITS, _MAP_BITS // 8), np.uint8)
    for r in maps:
        whole[r["k"]] = np.frombuffer(r["bits"], np.uint8)
    known, columns = rows.sparkSession.sparkContext.broadcast(whole.ravel()), rows.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = np.ones(batch.num_rows, bool)
            for column in ("sieve_1", "sieve_2"):
                at = batch.column(column).to_numpy()
                fine &= (known.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            yield batch.filter(pa.array(fine)).select(columns)
    one, two = _places(F.col(name))
    return rows.withColumns({"sieve_1": one, "sieve_2": two}).mapInArrow(keep, rows.schema)


# ---------------------------------------------------------------- word hashes in numpy

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.Generator(np.random.PCG64(2024)).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of them."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def words_of(text: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a UTF-8 text, and the byte offsets where words start and end.

    Words are runs without space and \\x09-\\x0D. A hash is a polynomial of the word's bytes, read off
    prefix sums, so the cost is the same few passes over the bytes for any word length.
    """
    raw = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_SEPARATOR[raw]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power(len(raw) + 1)
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[raw] if lower else raw] * up[:len(raw)], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64)), start, end


def shingles_of(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence if it is shorter; none without words."""
    if not len(words):
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for k in range(size):
        total = mix(total * np.uint64(_BASE) + words[k:k + count])
    return total


# ---------------------------------------------------------------- linked groups

def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component): the smallest id that each id of ``edges`` (a, b) reaches.

    Contraction: every node joins the least of its neighbours and itself, edges are renamed and repeats
    dropped, until no edge is left. Least is by id in odd rounds, which ends stars around their smallest id at once,
    and by a hash that is new each time in even rounds, which shrinks any graph by a constant factor in
    expectation. A round costs two joins and one aggregation; no node's neighbours are ever gathered in one place.
    """
    edges = staged(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
                   .where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), name)
    members = (edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
               .withColumn("at", F.col("id")))
    seed = 0
    while edges.take(1):
        seed += 1
        by = F.xxhash64 if seed % 2 == 0 else lambda c, _: c
        rank = lambda c: F.struct(by(F.col(c), F.lit(seed)).alias("h"), F.col(c).alias("v"))
        arcs = edges.select("a", "b").union(edges.select("b", "a"))
        to = staged(arcs.groupBy("a").agg(F.min(rank("b")).alias("best"))
                    .select(F.col("a").alias("v"), F.least(F.col("best"), rank("a"))["v"].alias("to")), name)
        members = (members.join(to, members["at"] == to["v"], "left")
                   .select("id", F.coalesce("to", "at").alias("at")))
        a, b = (to.select(F.col("v").alias(x), F.col("to").alias("to_" + x)) for x in "ab")
        edges = staged(edges.join(a, "a").join(b, "b").where("to_a <> to_b")
                       .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
                       .distinct(), name)
    members = staged(members, name)
    least = members.groupBy("at").agg(F.min("id").alias("component"))
    return staged(members.join(least, "at").select("id", "component"), name)

