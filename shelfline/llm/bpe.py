"""BPE encoding and decoding; long texts by tree concatenation.

Texts of more than ``part`` characters are cut at fixed places, whatever stands there, so that parts encode in parallel
on any executor. A document's parts are then joined in pairs, pairs of pairs and so on. Around each join a window of
tokens on either side is encoded again as one text. If the window's first and last tokens are those that stood there
before, the window replaces them; if not, it doubles. A BPE encoding is right when each two neighbouring tokens
are encoded right, so agreement at both ends proves the whole. Words of short texts repeat, so their tokens are
kept in a table of bounded size in each task; blank space always separates words, which makes this exact. Words of letters a-z
and those of Latin-1, digits and ASCII marks are encoded by the model alone; the rest of the tokenizer would change nothing in them.

Null texts count as empty: no tokens. Repeated rows are encoded each on their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache, partial
from itertools import chain
from unicodedata import is_normalized

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

PART = 65_536      # characters encoded by one call
KEPT = 100_000     # words in each table of a worker
RUN = re.compile(r"[^ \t\n\r]+")
#: Runs, but a full stop or comma that ends one after a letter or digit stands alone, as the tokenizer has it.
WORD = re.compile(r"[^ \t\n\r]*[^\W_](?=[.,](?:[ \t\n\r]|\Z))|[^ \t\n\r]+")
#: Words that the tokenizer's normalizer leaves as they are and that hold none of its added tokens or contractions; what its pattern cuts them into.
PLAIN = re.compile(r"[a-zß-öø-ÿ0-9!-&(-/:;=-@\[-`{-~]+")
PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
AGREE = 4          # tokens that must agree at each end of a window
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@cache
def tokenizer(path: str) -> Tokenizer:
    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


Token = tuple[int, int, int]  # id, start, end


def encode_span(tok: Tokenizer, text: str, at: int = 0) -> list[Token]:
    """Tokens of a text whose first character is number ``at`` of the document."""
    got = tok.encode(text, add_special_tokens=False)
    return [(i, at + s, at + e) for i, (s, e) in zip(got.ids, got.offsets)]


def _clean(tokens: list[Token], i: int) -> bool:
    """Whether the text can be cut before token i: no character belongs to tokens on both sides."""
    return i <= 0 or i >= len(tokens) or tokens[i][1] >= tokens[i - 1][2]


def join(tok: Tokenizer, text: str, left: list[Token], right: list[Token], end: int, begin: int = 0) -> list[Token]:
    """The tokens of text[begin:end], from those of its two parts."""
    if not left or not right:
        cut = left[-1][2] if left else right[0][1] if right else begin
        if not left and not right or text[begin:cut if left else end].isspace():
            return left + right
    reach = 2 * AGREE
    while True:
        i, j = max(0, len(left) - reach), min(len(right), reach)
        while not _clean(left, i):
            i -= 1
        while not _clean(right, j):
            j += 1
        whole = i <= 0 and j >= len(right)
        start = left[i][1] if i > 0 else begin
        stop = right[j][1] if j < len(right) else end
        window = encode_span(tok, text[start:stop], start)
        if whole:
            return window
        same_left = i <= 0 or window[:AGREE] == left[i:i + AGREE]
        same_right = j >= len(right) or window[-AGREE:] == right[j - AGREE:j]
        if same_left and same_right and len(window) >= 2 * AGREE:
            return left[:i] + window + right[j:]
        reach *= 2


def join_tree(tok: Tokenizer, text: str, parts: list[list[Token]], cuts: list[int]) -> list[Token]:
    """Joins neighbours until one list is left; part k covers text[cuts[k]:cuts[k + 1]]."""
    while len(parts) > 1:
        joined = [join(tok, text, parts[k], parts[k + 1], cuts[k + 2], cuts[k])
                  for k in range(0, len(parts) - 1, 2)]
        if len(parts) % 2:
            joined.append(parts[-1])
        parts, cuts = joined, [*cuts[:-1:2], cuts[-1]]
    return parts[0] if parts else []


def encode(tok: Tokenizer, text: str, part: int = PART) -> list[int]:
    """Ids of a text of any length, by halves joined as a tree, in one process."""
    cuts = [*range(0, len(text), part), len(text)] if text else [0]
    parts = [encode_span(tok, text[a:b], a) for a, b in zip(cuts, cuts[1:])]
    return [t[0] for t in join_tree(tok, text, parts, cuts)]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def digest(tok: Tokenizer, ids: list[int]) -> tuple[int, str, str]:
    return len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))


class Words:
    """Ids of encoded words, looked up or encoded in batches.

    Two tables of at most ``KEPT`` words: when the newer is full it becomes the older one, and words still in use move
    back, so frequent words stay. A word costs its own text and a tuple; numbers and the texts of tokens are held once.
    """

    def __init__(self, tok: Tokenizer):
        self.tok, self.new, self.old = tok, {}, {}
        self.numbers = list(range(tok.get_vocab_size(with_added_tokens=True)))
        self.digits = [str(i) for i in self.numbers]
        self.tokens = [tok.id_to_token(i) or "" for i in self.numbers]
        self.model, as_bytes = tok.model, ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}

    def plain(self, word: str) -> tuple[int, ...]:
        """Ids of a plain word, by the tokenizer's model alone: its other steps change nothing and are most of a call's time."""
        return tuple([self.numbers[token.id] for piece in PIECES.findall(word)
                      for token in self.model.tokenize(piece if piece.isascii() else piece.translate(self.letters))])

    def learn(self, texts: list[list[str]]) -> None:
        if len(self.new) > KEPT:
            self.new, self.old = {}, self.new
        wanted = {w for words in texts for w in words if w not in self.new}
        self.new.update((w, self.old[w]) for w in wanted if w in self.old)
        unknown = []
        for word in wanted:
            if word not in self.new:
                if PLAIN.fullmatch(word):
                    self.new[word] = self.plain(word)
                else:
                    unknown.append(word)
        for a in range(0, len(unknown), 4096):
            some = unknown[a:a + 4096]
            for word, got in zip(some, self.tok.encode_batch_fast(some, add_special_tokens=False)):
                self.new[word] = tuple([self.numbers[i] for i in got.ids])

    def ids(self, words: list[str]) -> list[int]:
        return list(chain.from_iterable(map(self.new.__getitem__, words)))

    def digest(self, ids: list[int]) -> tuple[int, str, str]:
        if self.tok.decoder is not None:
            return digest(self.tok, ids)
        return (len(ids), sha(" ".join(map(self.digits.__getitem__, ids))),  # without a decoder, decoding joins tokens by blanks
                sha(" ".join(map(self.tokens.__getitem__, ids))))


def split_words(text: str) -> list[str]:
    """The words of a text, lower-cased and without the stop at their end where that changes no token."""
    if "<|" not in text and "Σ" not in text and is_normalized("NFC", text):
        return WORD.findall(text.lower())
    return RUN.findall(text)


@cache
def known_words(path: str) -> Words:
    """One table for all tasks of a worker process."""
    return Words(tokenizer(path))


def _short(batches: Iterator[pa.RecordBatch], path: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    words = known_words(path)
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            some = batch.slice(a, 256)
            split = [split_words(t) for t in some.column("text").to_pylist()]
            words.learn(split)
            ids = [words.ids(w) for w in split]
            digests = [words.digest(i) for i in ids]
            columns = [some.column("doc_id"), pa.array([d[0] for d in digests], pa.int64()),
                       *(pa.array([d[k] for d in digests], pa.string()) for k in (1, 2))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)


def _parts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tok = tokenizer(path)
    for batch in batches:
        for row in batch.to_pylist():
            tokens = encode_span(tok, row["piece"], row["at"])
            yield pa.RecordBatch.from_pylist([{"key": row["key"], "at": row["at"], "piece": row["piece"],
                                               "ids": [t[0] for t in tokens], "starts": [t[1] for t in tokens],
                                               "ends": [t[2] for t in tokens]}], PART_ARROW)


PART_SCHEMA = "key string, at long, piece string, ids array<int>, starts array<long>, ends array<long>"
PART_ARROW = pa.schema([("key", pa.string()), ("at", pa.int64()), ("piece", pa.string()), ("ids", pa.list_(pa.int32())),
                        ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])


def _joined(rows: pd.DataFrame, path: str, with_ids: bool) -> pd.DataFrame:
    tok = tokenizer(path)
    rows = rows.drop_duplicates("at").sort_values("at")
    text = "".join(rows["piece"])
    parts = [list(zip(*map(lambda c: [int(x) for x in r[c]], ("ids", "starts", "ends")))) for _, r in rows.iterrows()]
    ids = [t[0] for t in join_tree(tok, text, parts, [*map(int, rows["at"]), len(text)])]
    out = pd.DataFrame([(rows["key"].iloc[0], *digest(tok, ids))],
                       columns=["key", "n_tokens", "ids_sha256", "decoded_sha256"])
    if with_ids:
        out["ids"] = [ids]
    return out


def encode_documents(docs: DataFrame, path: str, part: int = PART, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and of the decoded text of each row; the ids too if asked for.

    Only texts of more than ``part`` characters are shuffled, in parts; equal long texts are encoded once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    long = F.char_length("text") > part
    extra = ", ids array<int>" if with_ids else ""
    short = rows.where(~long).mapInArrow(partial(_short, path=path, with_ids=with_ids), SCHEMA + extra)
    # two hashes tell texts apart
    keyed = rows.where(long).withColumn("key", F.concat_ws(":", F.xxhash64("text"), F.xxhash64(F.lit(1), "text")))
    at = F.explode(F.expr(f"sequence(0L, CAST((char_length(text) - 1) DIV {part} AS BIGINT))"))
    # a number, as parts are few bytes and much work: by bytes alone adaptive execution would give them to one task
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = (keyed.select("key", "text").dropDuplicates(["key"]).select("key", "text", at.alias("k"))
              .select("key", (F.col("k") * part).alias("at"),
                      F.substring("text", (F.col("k") * part + 1).cast("int"), F.lit(part)).alias("piece"))
              .repartition(tasks, "key", "at").mapInArrow(partial(_parts, path=path), PART_SCHEMA))
    whole = pieces.groupBy("key").applyInPandas(
        lambda parts: _joined(parts, path, with_ids),
        "key string, n_tokens long, ids_sha256 string, decoded_sha256 string" + extra)
    joined = keyed.select("doc_id", "key").join(whole, "key").drop("key")
    return short.unionByName(joined)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and decoded text from rows with ids."""
    def run(batches):
        tok = tokenizer(path)
        for batch in batches:
            texts = [tok.decode(i or [], skip_special_tokens=False) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        run, "doc_id long, text string")
