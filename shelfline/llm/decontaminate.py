"""Benchmark passages in documents, with edits, by the pigeonhole principle.

Texts are lower-cased and every run of other than letters and digits becomes one blank. An item of m characters may
be found with up to e = RATE * m edits. Cut into e + 1 pieces, at least one piece stands unchanged in any such place.
An automaton of all pieces finds their exact hits in one pass over a document; hits of an item that ask for
overlapping places are taken together, and Myers' bit-parallel algorithm gives the least edit distance there.

Items are a stated query set: they reach the tasks in blocks of about ``BLOCK`` characters, each block passing over all
documents, so any number of items fits. Documents are never shuffled.

Null and blank documents match nothing; items without letters or digits are found nowhere. Items with one text are
each reported. Every row of documents is judged on its own.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from uuid import uuid4

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE = 0.08        # edits for each character of an item
LEAST = 8          # characters of a piece: short items have fewer edits, the shortest none
BLOCK = 20_000_000
MATCH = "item_id long, distance int, start int, end int"
OTHER = re.compile(r"[\W_]+")

Item = tuple[int, str]
Match = tuple[int, int, int, int]  # item, distance, start and end in the normal form


def normalise(text: str | None) -> str:
    return OTHER.sub(" ", (text or "").lower()).strip()


def budget(length: int, rate: float = RATE) -> int:
    return max(0, min(int(rate * length), length // LEAST - 1))


def pieces(text: str, parts: int) -> list[tuple[int, str]]:
    """(offset, piece) of a text cut into so many parts of nearly one length."""
    cuts = [len(text) * k // parts for k in range(parts + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """An item, ready for Myers' search."""

    def __init__(self, item_id: int, text: str, rate: float):
        self.item_id, self.text, self.edits = item_id, text, budget(len(text), rate)
        self.masks: dict[str, int] = defaultdict(int)
        for k, c in enumerate(text):
            self.masks[c] |= 1 << k

    def search(self, text: str, limit: int | None = None) -> tuple[int, int]:
        """Least edit distance between the item and any part of text, and where the first such part ends."""
        m, masks = len(self.text), self.masks
        full, top = (1 << m) - 1, 1 << (m - 1)
        up, down, score, best, end = full, 0, m, m, 0
        for j, c in enumerate(text, 1):
            eq = masks.get(c, 0)
            vertical = eq | down
            across = (((eq & up) + up) ^ up) | eq
            rise = down | (full & ~(across | up))
            fall = up & across
            if rise & top:
                score += 1
            elif fall & top:
                score -= 1
            if score < best:
                best, end = score, j
            rise, fall = rise << 1 & full, fall << 1 & full
            up, down = fall | (full & ~(vertical | rise)), rise & vertical
        return best, end


    def nearest_prefix(self, text: str) -> int:
        """Length of the prefix of text that is nearest to the item, the longest of equals: Myers' steps with a fixed beginning."""
        m, masks = len(self.text), self.masks
        full, top = (1 << m) - 1, 1 << (m - 1)
        up, down, score, best, end = full, 0, m, m, 0
        for j, c in enumerate(text, 1):
            eq = masks.get(c, 0)
            vertical = eq | down
            across = (((eq & up) + up) ^ up) | eq
            rise = down | (full & ~(across | up))
            fall = up & across
            if rise & top:
                score += 1
            elif fall & top:
                score -= 1
            if score <= best:
                best, end = score, j
            # what is before the text may not be skipped: a longer prefix costs one more in the first row
            rise, fall = (rise << 1 | 1) & full, fall << 1 & full
            up, down = fall | (full & ~(vertical | rise)), rise & vertical
        return end


class Matcher:
    """All items of a block and the automaton of their pieces."""

    def __init__(self, items: list[Item], rate: float = RATE):
        self.patterns = [Pattern(i, t, rate) for i, t in ((i, normalise(t)) for i, t in items) if t]
        self.backward = {}
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, p in enumerate(self.patterns):
            for offset, piece in pieces(p.text, p.edits + 1):
                found[piece].append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()

    def _start(self, n: int, text: str, end: int, distance: int) -> int:
        """Where a part that ends at end starts: the same search, backwards."""
        if n not in self.backward:
            p = self.patterns[n]
            self.backward[n] = Pattern(p.item_id, p.text[::-1], 0)
        m = len(self.patterns[n].text)
        low = max(0, end - m - distance)
        # the end is fixed: what is behind it may not be skipped, so the distance of each prefix counts
        return end - self.backward[n].nearest_prefix(text[low:end][::-1])

    def matches(self, raw: str | None) -> list[Match]:
        """The best place of each item that the text holds."""
        text = normalise(raw)
        if not self.patterns or not text:
            return []
        starts: dict[int, list[int]] = defaultdict(list)
        for last, (length, places) in self.automaton.iter(text):
            for n, offset in places:
                starts[n].append(last + 1 - length - offset)
        out = []
        for n, at in starts.items():
            p = self.patterns[n]
            m, e = len(p.text), p.edits
            best = (e + 1, 0)
            at.sort()
            k = 0
            while k < len(at):
                low = high = at[k]
                while k < len(at) and at[k] <= high + m:  # overlapping places are searched as one
                    high = at[k]
                    k += 1
                a = max(0, low - e)
                distance, end = p.search(text[a:high + m + e])
                best = min(best, (distance, a + end))
            if best[0] <= e:
                out.append((p.item_id, best[0], self._start(n, text, best[1], best[0]), best[1]))
        return sorted(out)


_matchers: dict[tuple[str, float], Matcher] = {}


def _matcher(block: tuple[str, Broadcast], rate: float) -> Matcher:
    """The matcher of a block, built once in a worker process; the last one only."""
    name, items = block
    if (name, rate) not in _matchers:
        _matchers.clear()
        _matchers[name, rate] = Matcher(items.value, rate)
    return _matchers[name, rate]


def _blocks(benchmark: DataFrame) -> Iterator[tuple[str, Broadcast]]:
    """Each block of items, by a name of its own."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    count = -(-size // BLOCK)
    for k in range(count):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == k)
        rows = sorted(tuple(r) for r in block.distinct().collect())
        yield uuid4().hex, benchmark.sparkSession.sparkContext.broadcast(rows)


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, distance and place (start, end in the normal form) of each item that a row holds."""
    def run(items):
        def found(batches):
            matcher = _matcher(items, rate)
            for batch in batches:
                rows = [(i.as_py(), *m) for i, t in zip(batch.column("doc_id"), batch.column("text"))
                        for m in matcher.matches(t.as_py())]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                    ["doc_id", "item_id", "distance", "start", "end"])
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        return rows.mapInArrow(found, "doc_id long, " + MATCH)
    parts = [run(items) for items in _blocks(benchmark)]
    if not parts:
        return docs.sparkSession.createDataFrame([], "doc_id long, " + MATCH)
    return reduce(DataFrame.union, parts)


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of docs that hold no item."""
    def run(items):
        def kept(batches):
            matcher = _matcher(items, rate)
            for batch in batches:
                yield batch.filter(pa.array([not matcher.matches(t.as_py()) for t in batch.column("text")], pa.bool_()))
        return kept
    for items in _blocks(benchmark):
        docs = docs.mapInArrow(run(items), docs.schema)
    return docs
