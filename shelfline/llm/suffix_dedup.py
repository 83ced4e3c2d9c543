"""Passages that an earlier document holds too, found byte by byte: bucket-pointer refinement over sampled suffixes.

A byte goes if a string of ``GRAM`` bytes over it also starts in a document with a smaller doc_id. Every window of GRAM bytes names one suffix
within it, the one whose first ``Q`` bytes have the least hash (of equal ones the first), so equal windows name suffixes at equal
places, and about one position in 13 is named. Named suffixes are put in buckets by their first Q bytes; those whose bucket
lies in one document only are done. Each other one is sent, with the bytes of the windows that name it, to the task of its bucket,
once for each distinct content of a part and with the least doc_id that has it there. Buckets are refined there as in suffix sorting: strings of 8 bytes get their rank as
identifier, longer ones are ranked by the identifiers at their own and a later offset, again and again, to the right of
the suffix and to its left. Neighbours in these orders share so many bytes, which gives an identifier for any length, and
a window is the identifier of what it has right of the suffix beside the one left of it: exact, no text is judged by a hash. The least
doc_id of each identifier decides, and one bit for each window goes back.

Documents are packed in parts of about ``PART`` bytes, written once as a table bucketed by part, so that only answers are shuffled to them, never
the texts. What goes to a bucket is 6 bytes for a distinct named suffix of a part, and some 70 bytes for one shared between documents.
A suffix that more than ``HOT`` occurrences share is not refined in one task: each of its windows goes by its own content to
a bucket of its own.

Null doc_id: the row is left whole and takes nothing from others. Null text is empty. Rows with one doc_id are one document: they take nothing
from each other. Texts shorter than GRAM are left whole. Removal may cut a character; the kept bytes are returned as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import mix, staged
from shelfline.session import fresh_path

GRAM = 50
Q = 26
SPAN = GRAM - Q          # most bytes of a window left of the suffix that it names
PART = 4 << 20           # bytes of text handled at a time
BUCKET = 1 << 24         # bytes of text for each bucket
HOT = 1 << 16            # occurrences of a suffix from which its windows go by their own content
FP_BITS = 40             # of a suffix's hash within its bucket; equal ones are told apart by their bytes later

PART_SCHEMA = "part long, n_bytes long, docs array<long>, sizes array<long>, blob binary"
NAMED_SCHEMA = "bucket int, part long, prints binary, weights binary"
SENT_SCHEMA = "bucket int, part long, docs binary, shapes binary, content binary"
ANSWER_SCHEMA = "part long, kind int, bucket int, bits binary"
RESULT_SCHEMA = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = np.uint64(0xD1342543DE82EF95)


# ---------------------------------------------------------------- parts

def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs, texts, size, number = [], [], 0, 0
    first = TaskContext.get().partitionId() << 32

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([first + number]), pa.array([size]), pa.array([docs], pa.list_(pa.int64())),
             pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([b"".join(texts)], pa.binary())],
            ["part", "n_bytes", "docs", "sizes", "blob"])
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            docs.append(doc)
            texts.append(text or b"")
            size += len(texts[-1])
            if size >= PART or len(docs) >= 50_000:
                yield row()
                docs, texts, size, number = [], [], 0, number + 1
    if docs:
        yield row()


class Part:
    """Documents one after another, and the runs of windows that name the same suffix."""

    def __init__(self, row: pa.Table, buckets: int):
        self.docs = row.column("docs").combine_chunks()[0].values
        self.sizes = np.array(row.column("sizes").combine_chunks()[0].values, np.int64)
        self.raw = np.frombuffer(row.column("blob").combine_chunks()[0].as_py(), np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        at, lo, count, print_ = windows(self.raw, self.ends, self.starts)
        # nameless documents take part in nothing
        named = np.asarray(self.docs.is_valid())
        ids = np.asarray(self.docs.fill_null(0), np.int64)
        doc = np.searchsorted(self.ends, at, side="right")
        keep = named[doc]
        self.at, self.lo, self.count, self.doc_id = at[keep], lo[keep], count[keep], ids[doc[keep]]
        low = print_[keep] & np.uint64(buckets - 1)
        high = (print_[keep] >> np.uint64(buckets.bit_length() - 1)) & np.uint64((1 << FP_BITS) - 1)
        # distinct suffixes in the order of their buckets; which one each run names
        self.known, self.which = np.unique((low << np.uint64(FP_BITS)) | high, return_inverse=True)
        self.bucket = (self.known >> np.uint64(FP_BITS)).astype(np.int64)

    def answers(self, rows: pa.Table, kind: int, bucket: np.ndarray, kind_type: type) -> np.ndarray:
        """What came back for each entry of a list in the order of buckets; 0 for what did not."""
        out = np.zeros(len(bucket), kind_type)
        for k, b, bits in zip(*[rows.column(c).to_pylist() for c in ("kind", "bucket", "bits")]):
            if k == kind:
                got = np.frombuffer(bits, kind_type)
                low = np.searchsorted(bucket, b)
                out[low:low + len(got)] = got
        return out

    def sent(self, state: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
        """Contents of shared suffixes, distinct ones in the order of their buckets: (bucket, least doc_id, shape and
        bytes) of each, then (lo, content, doc_id) of every occurrence. state: 0 not shared, 1 shared, 2 hot."""
        of = state[self.which]
        run = np.flatnonzero(of == 1)
        hot = np.flatnonzero(of == 2)
        lo, left, count = self.lo[run], (self.at - self.lo)[run], self.count[run]
        # of hot suffixes each window by itself
        again = np.repeat(hot, self.count[hot])
        step = np.arange(len(again)) - np.repeat(np.cumsum(self.count[hot]) - self.count[hot], self.count[hot])
        lo = np.concatenate([lo, self.lo[again] + step])
        left = np.concatenate([left, self.at[again] - self.lo[again] - step])
        count = np.concatenate([count, np.ones(len(again), np.int64)])
        doc = np.concatenate([self.doc_id[run], self.doc_id[again]])
        size = count + GRAM - 1
        width = GRAM + SPAN
        spot = np.arange(width)
        content = np.zeros((len(lo), width + 2 + 4), np.uint8)
        for a in range(0, len(lo), 1 << 16):
            b = slice(a, a + (1 << 16))
            inside = spot < size[b, None]
            content[b, 6:] = np.where(inside, self.raw[np.minimum(lo[b, None] + spot, len(self.raw) - 1)], 0)
        content[:, 4], content[:, 5] = left, count
        home = np.concatenate([self.bucket[self.which[run]], np.zeros(len(again), np.int64)])
        if len(again):
            h = np.zeros(len(again), np.uint64)
            for k in range(GRAM):
                h = mix(h * _ODD + _BYTE[content[len(run):, 6 + k]])
            home[len(run):] = (h & np.uint64(buckets - 1)).astype(np.int64)
        content[:, :4] = home.astype(">u4").view(np.uint8).reshape(-1, 4)
        flat = np.ascontiguousarray(content).view(f"S{content.shape[1]}").ravel() if len(lo) else np.empty(0, "S1")
        # fixed width: bytes at the end that are 0 compare as if they were not there, which the shape tells apart
        distinct, first, which = np.unique(flat, return_index=True, return_inverse=True)
        least = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(least, which, doc)
        return home[first], least, content[first, 4:], lo, which, doc


def windows(raw: np.ndarray, ends: np.ndarray, starts: np.ndarray, block: int = 1 << 16) -> tuple[np.ndarray, ...]:
    """(place of the suffix, first window, windows, hash) of each run of windows that name one suffix, in blocks of positions that fit a processor's cache."""
    found = []
    for s in range(0, max(0, len(raw) - GRAM + 1), block):
        seg = raw[s:s + block + GRAM - 1]
        one = _BYTE[seg]
        gram, size = one, 1
        parts = {1: one}
        while size < 16:
            gram = mix(gram[:-size] * _ODD + gram[size:]) if size > 1 else gram[:-1] * _ODD + gram[1:]
            size *= 2
            parts[size] = gram
        n = len(seg) - Q + 1
        h = mix((parts[16][:n] * _ODD + parts[8][16:16 + n]) * _ODD + parts[2][24:24 + n])  # 16 + 8 + 2 bytes
        del parts, gram, one
        key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        size = 1
        while size < 16:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        rest = SPAN + 1 - 16
        key = np.minimum(key[:-rest], key[rest:])
        begins = np.arange(len(key))
        # windows that would reach into the next document
        here = (ends > s) & (starts < s + len(seg))
        edge = np.zeros(len(key) + 1, np.int32)
        np.add.at(edge, np.clip(np.maximum(ends[here] - GRAM + 1, starts[here]) - s, 0, len(key)), 1)
        np.add.at(edge, np.clip(ends[here] - s, 0, len(key)), -1)
        fine = np.cumsum(edge[:-1]) == 0
        at = (key[fine] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        begins = begins[fine]
        if len(at):
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            found.append((at[first] + s, begins[first] + s, np.diff(np.append(first, len(at))), mix(h[at[first]] ^ _ODD)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


# ---------------------------------------------------------------- named suffixes and their buckets

def _named(row: pa.Table, buckets: int) -> pa.Table:
    part = Part(row, buckets)
    order = np.lexsort((part.doc_id, part.which))
    which, doc = part.which[order], part.doc_id[order]
    first = np.flatnonzero(np.diff(which, prepend=-1))
    often = np.diff(np.append(first, len(which)))
    last = first + often - 1
    # 0: in one document; else one more than the logarithm of its occurrences
    weight = np.where(doc[first] != doc[last], 1 + np.log2(np.maximum(often, 1)).astype(np.int64), 0).astype(np.uint8)
    weight = np.where((weight == 0) & (often > 1), 128 + np.log2(np.maximum(often, 1)).astype(np.int64), weight).astype(np.uint8)
    prints = (part.known & np.uint64((1 << FP_BITS) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :FP_BITS // 8]
    cut = [*np.flatnonzero(np.diff(part.bucket, prepend=-1)).tolist(), len(part.bucket)]
    key = row.column("part")[0].as_py()
    return pa.table([pa.array(part.bucket[cut[:-1]], pa.int32()), pa.array([key] * (len(cut) - 1), pa.int64()),
                     pa.array([prints[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                     pa.array([weight[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())],
                    ["bucket", "part", "prints", "weights"])


def _shared(rows: pa.Table, hot: int) -> pa.Table:
    """For each part's suffixes of a bucket: 0 in one document, 1 shared, 2 shared by very many."""
    weights = [np.frombuffer(w, np.uint8) for w in rows.column("weights").to_pylist()]
    width = FP_BITS // 8
    prints = np.zeros((sum(map(len, weights)), 8), np.uint8)
    prints[:, :width] = np.frombuffer(b"".join(rows.column("prints").to_pylist()), np.uint8).reshape(-1, width)
    weight = np.concatenate(weights)
    _, which, held = np.unique(prints.view("<u8").ravel(), return_inverse=True, return_counts=True)
    several = held > 1
    several[which[(weight > 0) & (weight < 128)]] = True
    often = np.bincount(which, weights=np.where(weight == 0, 1.0, 2.0 ** np.where(weight >= 128, weight.astype(float) - 128, weight.astype(float) - 1)))
    state = (several.astype(np.uint8) + (several & (often > hot)))[which].astype(np.uint8)
    cut = np.cumsum([0, *map(len, weights)])
    out = [(p, b, state[x:y]) for p, b, x, y in zip(rows.column("part").to_pylist(), rows.column("bucket").to_pylist(), cut, cut[1:])]
    out = [o for o in out if o[2].any()]
    return _answer_table([o[0] for o in out], 1, [o[1] for o in out], [o[2].tobytes() for o in out])


def _answer_table(parts: list, kind: int, bucket: list, bits: list) -> pa.Table:
    return pa.table([pa.array(parts, pa.int64()), pa.array([kind] * len(parts), pa.int32()), pa.array(bucket, pa.int32()),
                     pa.array(bits, pa.binary())], ["part", "kind", "bucket", "bits"])


def _sent(row: pa.Table, answers: pa.Table, buckets: int) -> pa.Table:
    empty = pa.table([pa.array([], pa.int32()), pa.array([], pa.int64()), *[pa.array([], pa.binary())] * 3],
                     ["bucket", "part", "docs", "shapes", "content"])
    if not row.num_rows or not answers.num_rows:
        return empty
    part = Part(row, buckets)
    home, least, content, *_ = part.sent(part.answers(answers, 1, part.bucket, np.uint8), buckets)
    if not len(home):
        return empty
    size = content[:, 1].astype(np.int64) + GRAM - 1
    held = np.arange(content.shape[1] - 2) < size[:, None]
    cut = [*np.flatnonzero(np.diff(home, prepend=-1)).tolist(), len(home)]
    key = row.column("part")[0].as_py()
    spans = list(zip(cut, cut[1:]))
    return pa.table([pa.array(home[cut[:-1]], pa.int32()), pa.array([key] * len(spans), pa.int64()),
                     pa.array([least[a:b].astype("<i8").tobytes() for a, b in spans], pa.binary()),
                     pa.array([content[a:b, :2].tobytes() for a, b in spans], pa.binary()),
                     pa.array([content[a:b, 2:][held[a:b]].tobytes() for a, b in spans], pa.binary())],
                    ["bucket", "part", "docs", "shapes", "content"])


def ranks(text: np.ndarray) -> np.ndarray:
    """The rank of each row of bytes among them, equal rows alike: buckets of 8 bytes, refined by the identifiers of later offsets."""
    n, width = text.shape
    wide = np.zeros((n, -(-width // 8) * 8), np.uint8)
    wide[:, :width] = text
    ids = wide.view(">u8").astype(np.uint64)
    while True:
        _, found = np.unique(ids, return_inverse=True)
        ids = found.reshape(ids.shape).astype(np.uint64)
        if ids.shape[1] == 1:
            return ids[:, 0].astype(np.int64)
        if ids.shape[1] % 2:
            ids = np.hstack([ids, np.zeros((n, 1), np.uint64)])
        ids = (ids[:, 0::2] << np.uint64(32)) | ids[:, 1::2]


def prefix_classes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared): rows in their order, and how many bytes each shares with the one before; runs of at least k name prefixes of length k."""
    order = np.argsort(ranks(text), kind="stable")
    ordered = text[order]
    differ = ordered[1:] != ordered[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), text.shape[1])
    return order, np.concatenate([[-1], shared])


def _class_of(order: np.ndarray, shared: np.ndarray, length: int) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < length)
    return out


def judge(docs: np.ndarray, left: np.ndarray, count: np.ndarray, content: np.ndarray) -> np.ndarray:
    """For each content a bit for each of its windows: whether a smaller doc_id has that window too."""
    n = len(docs)
    size = count + GRAM - 1
    start = np.cumsum(size) - size + left
    right, back = np.zeros((n, GRAM), np.uint8), np.zeros((n, SPAN), np.uint8)
    for a in range(0, n, 1 << 16):
        b = slice(a, a + (1 << 16))
        for out, step, here in ((right, np.arange(GRAM), size - left), (back, -1 - np.arange(SPAN), left)):
            inside = np.arange(len(step)) < here[b, None]
            out[b] = np.where(inside, content[np.clip(start[b, None] + step, 0, len(content) - 1)], 0)
    by_right, by_left = prefix_classes(right), prefix_classes(back)
    bits = np.zeros(n, np.uint32)
    for o in range(SPAN + 1):
        some = np.flatnonzero((o <= left) & (o > left - count))
        if not len(some):
            continue
        key = (_class_of(*by_right, GRAM - o)[some] << 32) | _class_of(*by_left, o)[some]
        _, which = np.unique(key, return_inverse=True)
        least = np.full(which.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, which, docs[some])
        bits[some] |= (docs[some] > least[which]).astype(np.uint32) << (left[some] - o).astype(np.uint32)
    return bits


def _judged(rows: pa.Table) -> pa.Table:
    docs = [np.frombuffer(d, "<i8") for d in rows.column("docs").to_pylist()]
    shapes = np.frombuffer(b"".join(rows.column("shapes").to_pylist()), np.uint8).reshape(-1, 2).astype(np.int64)
    content = np.frombuffer(b"".join(rows.column("content").to_pylist()), np.uint8)
    bits = judge(np.concatenate(docs), shapes[:, 0], shapes[:, 1], content)
    cut = np.cumsum([0, *map(len, docs)])
    out = [(p, b, bits[x:y]) for p, b, x, y in zip(rows.column("part").to_pylist(), rows.column("bucket").to_pylist(), cut, cut[1:])]
    out = [o for o in out if o[2].any()]
    return _answer_table([o[0] for o in out], 2, [o[1] for o in out], [o[2].astype("<u4").tobytes() for o in out])


def _cleaned(row: pa.Table, answers: pa.Table, buckets: int) -> pa.Table:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
    if not row.num_rows:
        return schema.empty_table()
    part = Part(row, buckets)
    gone = np.zeros(len(part.raw), bool)
    if answers.num_rows:
        home, least, content, lo, which, doc = part.sent(part.answers(answers, 1, part.bucket, np.uint8), buckets)
        # an occurrence behind the first with its content in this part goes whole
        bits = np.where(doc > least[which], np.uint32(0xFFFFFFFF), part.answers(answers, 2, home, np.uint32)[which])
        count = content[which, 1]
        edge = np.zeros(len(part.raw) + 1, np.int32)
        for k in range(SPAN + 1):
            at = lo[((bits >> np.uint32(k)) & 1).astype(bool) & (k < count)] + k
            np.add.at(edge, at, 1)
            np.add.at(edge, at + GRAM, -1)
        gone = np.cumsum(edge[:-1]) > 0
    edges = np.zeros(len(gone) + 1, bool)  # spans end with their document
    edges[part.starts], edges[part.ends] = True, True
    near = np.concatenate([[False], gone, [False]])
    begin = np.flatnonzero(gone & (~near[:-2] | edges[:-1]))
    end = np.flatnonzero(gone & (~near[2:] | edges[1:])) + 1
    of = np.searchsorted(part.ends, begin, side="right")
    offsets = np.searchsorted(of, np.arange(len(part.sizes) + 1))
    spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(begin - part.starts[of]), pa.array(end - part.starts[of])], ["start", "end"]))
    kept = [part.raw[a:b][~gone[a:b]].tobytes() for a, b in zip(part.starts.tolist(), part.ends.tolist())]
    return pa.table([part.docs, pa.array(part.sizes), spans, pa.array(kept, pa.binary())], schema=schema)


def packed(docs: DataFrame) -> DataFrame:
    """The documents in parts, as a table in buckets: what is later joined to a part goes to it."""
    spark = docs.sparkSession
    name = f"suffix_parts_{uuid.uuid4().hex}"
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_pack, PART_SCHEMA)
     .write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "part").sortBy("part")
     .option("path", fresh_path(spark, name)).saveAsTable(name))
    return spark.table(name)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, the spans removed and the bytes kept of each row."""
    parts = packed(docs)
    total = parts.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = 1 << max(0, -(-total // BUCKET) - 1).bit_length()
    named = parts.groupBy("part").applyInArrow(lambda row: _named(row, buckets), NAMED_SCHEMA)
    shared = staged(named.groupBy("bucket").applyInArrow(lambda rows: _shared(rows, HOT), ANSWER_SCHEMA), "suffix-shared")
    sent = (parts.groupBy("part").cogroup(shared.groupBy("part"))
            .applyInArrow(lambda row, answers: _sent(row, answers, buckets), SENT_SCHEMA))
    judged = staged(sent.groupBy("bucket").applyInArrow(_judged, ANSWER_SCHEMA), "suffix-judged")
    return (parts.groupBy("part").cogroup(shared.unionByName(judged).groupBy("part"))
            .applyInArrow(lambda row, answers: _cleaned(row, answers, buckets), RESULT_SCHEMA))


def summarise(cleaned: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return cleaned.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))
