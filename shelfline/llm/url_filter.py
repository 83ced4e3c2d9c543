"""Judging URLs by rules and, where none fits, by character language models of accepted and rejected URLs.

The models are Markov models of variable order: P(c | h) of the last ``ORDER`` characters is the count of h and c,
smoothed towards P(c | h without its first character), down to a uniform base. Counts come from the distinct
URLs that a rule allows (one model) or blocks (the other), all of the table, but for one in ``FOLDS`` that is kept for
calibration. A URL's score is the difference of the two log-likelihoods divided by its length; calibration puts the
threshold where the two classes' scores on the URLs set aside are equally many deviations away.

Counts are kept for each string itself, so the model grows with the table, and no two strings share a count. They
are joined by string to the distinct windows of ``ORDER`` + 1 characters, and each window's ratio to the places it stands
at: shuffles that no size outgrows. Expressions only; each distinct URL is scored once, from its host to its end: path, query and
fragment. Rules see host and path alone.

Null URLs and URLs without ``://`` have an empty host and path and no rule; the models read the whole text of the latter, and of null the
empty string.
Without URLs of both classes every score is 0 and the verdict allow. Repeated rows each get their verdict.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import staged

ORDER = 4
FOLDS = 4
PRIOR = 2.0      # weight of the shorter context
ALPHABET = 256
START, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str]  # "allow" or "block", host/path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def tail(url: Column) -> Column:
    """All that follows the host: path, query and fragment; the whole text without ``://``."""
    rest = F.expr("substring(url, instr(url, '://') + 3)")
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_replace(rest, r"^[^/?#]*", "")).otherwise(url), F.lit(""))


def _fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    own = (F.col("host") == host) | F.col("host").endswith("." + host)
    return own & F.col("path").startswith(slash + path)


def apply_rules(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds rule and rule_verdict of the longest rule that fits; the first given of equally long ones."""
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    pick = lambda value: reduce(
        lambda case, r: case.when(_fits(r[1]), F.lit(value(r))), ordered, F.when(F.lit(False), F.lit(None)))
    return urls.withColumns({"rule": pick(lambda r: r[1]).cast("string"),
                             "rule_verdict": pick(lambda r: r[0]).cast("string")})


def _windows(urls: DataFrame, *keep: str) -> DataFrame:
    """s: each character of host, path and end mark with the ``ORDER`` before it; and once the start marks alone."""
    text = F.concat(F.lit(START * ORDER), F.col("host"), F.col("path"), F.lit(END))
    spots = (f"transform(sequence(0, char_length(text) - {ORDER}), "
             f"i -> substring(text, greatest(i, 1), {ORDER} + CAST(i > 0 AS INT)))")
    return urls.select(*keep, text.alias("text")).select(*keep, F.explode(F.expr(spots)).alias("s"))


def count_grams(labelled: DataFrame) -> DataFrame:
    """k, gram, allow, block: how often each string of k characters ends somewhere in URLs of each class."""
    allow, block = (F.sum((F.col("rule_verdict") == v).cast("long")).alias(v) for v in ("allow", "block"))
    windows = _windows(labelled, "rule_verdict").groupBy("s").agg(allow, block)
    grams = F.expr("transform(sequence(1, char_length(s)), k -> struct(k, right(s, k) AS gram))")
    return (windows.select("allow", "block", F.explode(grams).alias("g"))
            .groupBy("g.k", "g.gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")))


def _ratios(windows: DataFrame, counts: DataFrame, prior: float) -> DataFrame:
    """s and ratio, the log-likelihood ratio of its last character, of distinct windows s.

    P of a string needs its count, that of the string without its last character, and P of the string without its first.
    So lengths are worked out from 1 up, and a key of any join has no more rows than there are characters.
    """
    level = lambda k, name: (counts.where(F.col("k") == k).select(
        F.col("gram").alias(f"{name}_gram"), F.col("allow").alias(f"{name}_allow"), F.col("block").alias(f"{name}_block")))
    totals = counts.where("k = 1").agg(*(F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in ("allow", "block")))
    total = totals.first()  # one row of two sums
    if not total["allow"] or not total["block"]:
        return windows.select("s", F.lit(0.0).alias("ratio"))
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    shorter = None
    for k in range(1, ORDER + 2):
        asked = windows.select(F.expr(f"right(s, {k})").alias("gram")).distinct()
        asked = asked.join(level(k, "own"), F.col("gram") == F.col("own_gram"), "left")
        if shorter is None:
            before = {side: F.lit(float(total[side])) for side in ("allow", "block")}
            p = {side: F.lit(1.0 / ALPHABET) for side in ("allow", "block")}
        else:
            asked = (asked.join(level(k - 1, "before"), F.expr(f"left(gram, {k - 1})") == F.col("before_gram"), "left")
                     .join(shorter, F.expr(f"right(gram, {k - 1})") == F.col("shorter_gram")))
            before = {side: n(f"before_{side}") for side in ("allow", "block")}
            p = {side: F.col(f"shorter_{side}") for side in ("allow", "block")}
        shorter = asked.select(F.col("gram").alias("shorter_gram"), *(
            ((n(f"own_{side}") + prior * p[side]) / (before[side] + prior)).alias(f"shorter_{side}")
            for side in ("allow", "block")))
    return shorter.select(F.col("shorter_gram").alias("s"),
                          (F.log("shorter_allow") - F.log("shorter_block")).alias("ratio"))


def score(urls: DataFrame, counts: DataFrame, prior: float = PRIOR) -> DataFrame:
    """Distinct (host, path) of urls with the mean log-likelihood ratio of their characters."""
    # numbers stand for the URLs in the join, so long ones aren't carried by each of their characters
    numbered = staged(urls.select("host", "path").distinct().withColumn("id", F.monotonically_increasing_id()), "url-ids")
    spots = _windows(numbered, "id").where(F.char_length("s") > ORDER)
    windows = staged(spots.select("s").distinct(), "url-windows")
    ratios = staged(_ratios(windows, counts, prior), "url-ratios")
    # ratios grow with the URLs: one plan at every size, of two plain shuffles that can be split where a window is hot
    means = spots.join(ratios.hint("merge"), "s").groupBy("id").agg(F.avg("ratio").alias("score"))
    return numbered.join(means, "id").select("host", "path", "score")


def threshold(scores: DataFrame) -> float:
    """Where the scores of both classes are equally many deviations away; 0 without either class."""
    rows = {r["rule_verdict"]: r for r in scores.where("rule_verdict IS NOT NULL").groupBy("rule_verdict").agg(
        F.avg("score").alias("mean"), F.coalesce(F.stddev_pop("score"), F.lit(0.0)).alias("dev")).collect()}
    if len(rows) < 2:
        return 0.0
    allow, block = rows["allow"], rows["block"]
    spread = allow["dev"] + block["dev"]
    share = allow["dev"] / spread if spread else 0.5
    return allow["mean"] + (block["mean"] - allow["mean"]) * share


def judge_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict, score and threshold of each row of pages."""
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"), tail(F.col("url")).alias("tail"))
    whole = [F.col("host"), F.col("tail").alias("path")]  # what the models read
    distinct = apply_rules(rows.select("host", "path", "tail").distinct(), rules)
    aside = F.pmod(F.xxhash64("host", "tail"), F.lit(FOLDS)) == 0
    counts = staged(count_grams(distinct.where(F.col("rule_verdict").isNotNull() & ~aside).select(*whole, "rule_verdict")), "url-counts")
    scores = staged(score(distinct.select(*whole), counts).withColumnRenamed("path", "tail"), "url-scores")
    known = scores.where(aside & (F.col("host") != "")).withColumn("path", F.regexp_extract("tail", r"^[^?#]*", 0))
    cut = threshold(apply_rules(known, rules))
    judged = apply_rules(rows.join(scores, ["host", "tail"]), rules)
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") >= cut, "allow").otherwise("block"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score",
                         F.lit(cut).alias("threshold"))
