"""Deleting line runs that repeat earlier text, by winnowing over line hashes.

Documents are read in the order of their ids. Lines end at ``\\n``; lines without a word are passed over.
From each line on, the shortest run of lines with at least ``WORDS`` words is a window. A window's fingerprint is its
least line hash, so equal windows choose the same line, and neighbouring windows mostly share theirs.
Only windows whose fingerprint stands at two places or more can repeat; of these, two hashes of the whole window, each of its own line hashes, tell which
do. Every window but the first of its kind is a later copy. Copies extend both ways as long as neighbouring
windows are copies too: their union is deleted. So a line goes if and only if it lies in a run of WORDS words or more,
in whole lines, that stands somewhere before.

All steps are expressions, windows over one document's lines, and aggregations that combine before they shuffle;
no occurrences are paired. What a line or window weighs in a shuffle is a few numbers; the text itself is
shuffled once, to meet the list of lines that stay.

Null texts count as empty and stay as they are, like all texts without repeats. Rows with one doc_id and one text are one
document: each gets its result. Without doc_id a document comes last, in the order of its text's hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import staged

WORDS = 50


def _key(text: Column) -> list[Column]:
    """What tells documents apart and orders them: ids first, nulls last, then the text."""
    return [F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
            F.xxhash64(text).alias("text_hash")]


KEY = ["no_id", "id", "text_hash"]


def windows(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """KEY, first and last line number, window hash, fingerprint and its line of every full window."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = (docs.select(*_key(text), F.posexplode(F.split(text, "\n", -1)).alias("line", "content"))
             .select(*KEY, "line", F.xxhash64("content").alias("hash"), F.xxhash64(F.lit(1), "content").alias("other"),
                     F.size(F.split(F.trim(F.regexp_replace("content", r"\s+", " ")), " ")).alias("words"), "content")
             .where(F.col("content").rlike(r"\S")).drop("content")
             .dropDuplicates([*KEY, "line"]))
    own = Window.partitionBy(*KEY).orderBy("line")
    before = F.sum("words").over(own) - F.col("words")
    ahead = Window.partitionBy(*KEY).orderBy("before").rangeBetween(Window.currentRow, words - 1)
    run = F.collect_list(F.struct("hash", "line", "other")).over(ahead)
    return (lines.withColumn("before", before)
            .withColumns({"run": run, "total": F.sum("words").over(ahead), "last": F.max("line").over(ahead)})
            .where(F.col("total") >= words)
            .select(*KEY, F.col("line").alias("first"), "last", F.xxhash64("run.hash").alias("window"),
                    F.xxhash64(F.lit(1), "run.other").alias("window2"),
                    F.array_min("run").alias("mark")))


def repeated_windows(found: DataFrame) -> DataFrame:
    """KEY, first and last line of the windows that repeat an earlier one."""
    marks = found.select(*KEY, "mark").distinct()
    often = marks.groupBy(F.col("mark.hash").alias("hash")).agg(F.count("*").alias("n")).where("n > 1").select("hash")
    # staged, so that joins with many rows of one window read two plain shuffles, which Spark can split
    open_ = staged(found.join(staged(often, "line-marks"), F.col("mark.hash") == F.col("hash"), "left_semi").drop("mark"),
                   "line-candidates")
    place = F.struct(*KEY, "first")
    original = staged(open_.groupBy("window", "window2").agg(F.min(place).alias("at"), F.count("*").alias("n")).where("n > 1"),
                      "line-originals")
    return open_.join(original.select("window", "window2", "at"), ["window", "window2"]).where(place != F.col("at")).select(*KEY, "first", "last")


def kept_ranges(copies: DataFrame) -> DataFrame:
    """KEY and the (first, last) line ranges that stay, for documents with copies; last is -1 for the end."""
    own = Window.partitionBy(*KEY).orderBy("first", "last")
    reach = F.max("last").over(own.rowsBetween(Window.unboundedPreceding, -1))
    gaps = (copies.withColumn("from", F.coalesce(reach + 1, F.lit(0)))
            .groupBy(*KEY).agg(
                F.sort_array(F.collect_list(F.when(F.col("first") > F.col("from"),
                                                   F.struct(F.col("from"), (F.col("first") - 1).alias("to"))))).alias("gaps"),
                (F.max("last") + 1).alias("rest")))
    return gaps.select(*KEY, "gaps", "rest")


def drop_repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """row (all columns of docs), cleaned text, n_lines and n_removed of each row."""
    found = staged(windows(docs, words), "line-windows")
    ranges = kept_ranges(repeated_windows(found))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), *_key(F.coalesce(F.col("text"), F.lit(""))))
    # both sides grow with the documents: one plan at every size, no broadcast of a side that is small today
    joined = rows.join(ranges.hint("merge"), KEY, "left").withColumn("lines", F.split(text, "\n", -1))
    stay = F.concat(F.flatten(F.transform("gaps", lambda g: F.slice("lines", g["from"] + 1, g["to"] - g["from"] + 1))),
                    F.slice("lines", F.col("rest") + 1, F.greatest(F.size("lines") - F.col("rest"), F.lit(0))))
    return joined.withColumn("stay", F.when(F.col("rest").isNull(), F.col("lines")).otherwise(stay)).select(
        "row", F.when(F.col("rest").isNull(), F.col("row.text")).otherwise(F.array_join("stay", "\n")).alias("cleaned"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("stay")).cast("long").alias("n_removed"))


def clean(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The columns of docs with cleaned texts (and n_chars to match); rows that lose all their words go."""
    done = drop_repeats(docs, words).where((F.col("n_removed") == 0) | F.col("cleaned").rlike(r"\S"))
    new = {"text": F.col("cleaned")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(
            F.char_length("cleaned").cast(docs.schema["n_chars"].dataType))
    return done.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


ORACLE_SQL = f"""
WITH lines AS (
  SELECT doc_id, line - 1 AS line, content, len(regexp_extract_all(content, '\\S+')) AS words
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS content,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line FROM documents)),
full_lines AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY line) - words AS before
               FROM lines WHERE words > 0),
runs AS (SELECT doc_id, line AS first, max(line) OVER w AS last, string_agg(content, chr(10)) OVER w AS run,
                sum(words) OVER w AS total
         FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND {WORDS - 1} FOLLOWING)),
copies AS (SELECT * FROM runs WHERE total >= {WORDS}
           QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, first) > 1),
gone AS (SELECT DISTINCT l.doc_id, l.line FROM lines l JOIN copies c ON l.doc_id = c.doc_id AND l.line BETWEEN c.first AND c.last),
kept AS (SELECT l.doc_id, count(*) AS n_lines, count(g.line) AS n_removed,
                coalesce(string_agg(content, chr(10) ORDER BY l.line) FILTER (WHERE g.line IS NULL), '') AS cleaned
         FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.line = g.line GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_removed, sha256(cleaned) AS cleaned_sha256 FROM kept"""
