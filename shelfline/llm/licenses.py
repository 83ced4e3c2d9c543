"""Licence scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

Words are runs of a-z and 0-9 of the lower-cased text, shingles ``SIZE`` of them in a row. A template of m shingles is
looked for in windows of 2 * L shingles that start every L, with L at least 1.25 * m: whatever place of L
shingles matches lies whole in a window. Templates of similar length share their windows, so L is at most 1.9 * m. A
window that holds ``SHARE`` of the template has a Jaccard similarity of 0.2 or more with it, so at least
one of ``BANDS`` bands of one MinHash each agrees with a probability of 1 - 0.8**64 > 0.999999.
Retrieved windows are verified: the share of the template's shingles they contain must be SHARE or more, and at least half of
its marks against each rival must be among them. A rival is a template of another licence that has half of its shingles, marks are those that the rival
lacks. So a licence whose notice agrees with another's but for a version or a clause isn't taken for the other, and a text that holds
both has both. (Notices of two licences in one window can make up the marks of a third.)

Before that, texts without any anchor word are set aside, and so are windows without one in a longer text. Anchors are chosen such that fewer than SHARE of each
template's shingles are without one, so nothing that matches lacks them all. Each row is worked out alone, by
expressions only, without a shuffle. Templates are one constant array of the plan, and one set of all MinHash values of
templates of similar length tells whether a window has a candidate, so the list may grow.

Null, empty and short texts hold no template; repeated rows each get their result.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.license_texts import LICENSE_TEXTS

SIZE = 5
SHARE = 0.8
BANDS = 64
_WORD = re.compile(r"[a-z0-9]+")

Template = tuple[str, str]  # licence, wording


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingles_of(text: str) -> list[tuple[str, ...]]:
    words = words_of(text)
    return list(dict.fromkeys(tuple(words[k:k + SIZE]) for k in range(len(words) - SIZE + 1)))


def steps_of(sizes: list[int]) -> dict[int, int]:
    """L for each number of shingles: the longest of a group of which none is over half as long again as another."""
    steps, least, group = {}, 0, []
    for m in sorted(set(sizes) - {0}):
        if m > 1.5 * least:
            least, group = m, []
        group.append(m)
        steps.update({k: math.ceil(1.25 * m) for k in group})
    return steps


def anchors_of(templates: list[Template]) -> list[str]:
    """Long words of which every place that matches a template has one."""
    chosen: set[str] = set()
    for _, text in templates:
        shingles = shingles_of(text)
        own = sorted({w for s in shingles for w in s}, key=lambda w: (-len(w), w))
        while sum(not chosen & set(s) for s in shingles) >= SHARE * len(shingles):
            chosen.add(next(w for w in own if w not in chosen))
    return sorted(chosen)


def marks_of(templates: list[Template]) -> list[list[list[tuple[str, ...]]]]:
    """For each template and each of its rivals the shingles that the rival lacks."""
    sets = [(name, set(shingles_of(text))) for name, text in templates]
    return [[[s for s in shingles_of(text) if s not in other]
             for rival, other in sets if rival != name and own and 2 * len(own & other) >= len(own)]
            for (name, text), (_, own) in zip(templates, sets)]


_SHINGLES = ("CASE WHEN size(words) >= {n} THEN transform(sequence(0, size(words) - {n}), i -> xxhash64({words})) "
             "ELSE cast(array() AS array<bigint>) END").format(
                 n=SIZE, words=", ".join(f"words[i + {k}]" for k in range(SIZE)))


def _mins(shingles: str) -> str:
    """SQL: the least hash of an array of shingles under each of BANDS hash functions."""
    return f"transform(sequence(1, {BANDS}), c -> array_min(transform({shingles}, x -> xxhash64(x, c))))"


def _hashed(spark: SparkSession, templates: list[Template]) -> list[tuple[list[int], list[list[int]], list[int]]]:
    """Distinct shingle hashes of each template, those of its marks and its MinHashes, as Spark has them."""
    schema = "k int, words array<string>, marks array<array<array<string>>>"
    rows = (spark.createDataFrame([(k, words_of(t), m) for k, ((_, t), m) in enumerate(zip(templates, marks_of(templates)))], schema)
            .select("k", F.expr(f"array_distinct({_SHINGLES})").alias("s"),
                    F.expr(f"transform(marks, rival -> flatten(transform(rival, words -> {_SHINGLES})))").alias("marks"))
            .select("k", "s", "marks", F.expr(_mins("s")).alias("mins")))
    return [(r["s"], r["marks"], r["mins"]) for r in rows.orderBy("k").collect()]


def _numbers(values: list[int]) -> str:
    return f"array({', '.join(f'{x}L' for x in values)})" if values else "cast(array() AS array<bigint>)"


def _number_lists(values: list[list[int]]) -> str:
    return f"array({', '.join(map(_numbers, values))})" if values else "cast(array() AS array<array<bigint>>)"


def _windows(step: int) -> str:
    """SQL: array of (b, mins), windows near an anchor whose blocks b and b + 1 start every ``step`` shingles, with their MinHashes."""
    mins, near = f"mins_{step}", f"near_{step}"
    least = f"zip_with({mins}[b], coalesce(get({mins}, b + 1), {mins}[b]), (x, y) -> least(x, y))"
    return (f"transform(filter(sequence(0, size({near}) - 1), b -> {near}[b] OR coalesce(get({near}, b + 1), false)), "
            f"b -> struct(b AS b, {least} AS mins))")


def scan(docs: DataFrame, templates: list[Template] = LICENSE_TEXTS) -> DataFrame:
    """doc_id and matches of each row: array of (license, share, word), the best window for each licence."""
    hashed, anchors = _hashed(docs.sparkSession, templates), anchors_of(templates)
    anchor = r"(?<![a-z0-9])(?:" + "|".join(anchors) + r")(?![a-z0-9])"
    low = F.lower(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select("doc_id", F.when(low.rlike(anchor), F.regexp_extract_all(low, F.lit("([a-z0-9]+)"), F.lit(1)))
                       .otherwise(F.array().cast("array<string>")).alias("words"))
    by_step, steps = defaultdict(list), steps_of([len(s) for s, _, _ in hashed])
    for (name, _), (shingles, marks, mins) in zip(templates, hashed):
        if shingles:
            by_step[steps[len(shingles)]].append((name, shingles, marks, mins))
    known = ", ".join(f"'{w}'" for w in anchors)
    blocks = "sequence(0, (size(s) - 1) DIV {step})"
    rows = rows.select("doc_id", "words", F.expr(_SHINGLES).alias("s")).select("doc_id", "s", *(
        F.expr(f"CASE WHEN size(s) > 0 THEN transform({blocks.format(step=step)}, b -> "
               f"exists(slice(words, b * {step} + 1, {step + SIZE - 1}), w -> w IN ({known}))) END").alias(f"near_{step}")
        for step in by_step))
    # a block is in the window before it and in its own
    rows = rows.select("*", *(
        F.expr(f"CASE WHEN size(s) > 0 THEN transform({blocks.format(step=step)}, b -> "
               f"CASE WHEN near_{step}[b] OR coalesce(get(near_{step}, b - 1), false) OR coalesce(get(near_{step}, b + 1), false) "
               f"THEN {_mins(f'slice(s, b * {step} + 1, {step})')} END) END").alias(f"mins_{step}")
        for step in by_step))
    found = []
    for step, group in by_step.items():
        keys = ", ".join(f"{x}L" for x in sorted({x for *_, mins in group for x in mins}))
        own = ", ".join(f"struct('{name}' AS license, {_numbers(shingles)} AS s, {_number_lists(marks)} AS marks, {_numbers(mins)} AS mins)"
                        for name, shingles, marks, mins in group)
        retrieved = f"filter({_windows(step)}, w -> exists(w.mins, v -> v IN ({keys})))"
        held = f"slice(s, w.b * {step} + 1, {2 * step})"
        verified = (f"transform(filter(array({own}), t -> arrays_overlap(t.mins, w.mins)), t -> struct(t.license AS license, "
                    f"size(array_intersect(t.s, {held})) / cast(size(t.s) AS double) AS share, w.b * {step} AS word, "
                    f"forall(t.marks, k -> 2 * size(array_intersect(k, {held})) >= size(k)) AS marked))")
        found.append(f"CASE WHEN size(near_{step}) > 0 THEN filter(flatten(transform({retrieved}, w -> {verified})), "
                     f"m -> m.share >= {SHARE} AND m.marked) ELSE array() END")
    rows = rows.select("doc_id", F.expr(f"concat({', '.join(found)})").alias("all"))
    best = ("transform(array_sort(array_distinct(transform(all, m -> m.license))), n -> array_max(transform("
            "filter(all, m -> m.license = n), m -> struct(m.share AS share, -m.word AS back, m.license AS license))))")
    return rows.select("doc_id", F.expr(f"transform({best}, m -> struct(m.license AS license, m.share AS share, "
                                        "-m.back AS word))").alias("matches"))


def summarise(scanned: DataFrame) -> DataFrame:
    """doc_id, the licences joined by commas, their number and the largest share of a template held."""
    return scanned.select(
        "doc_id", F.array_join("matches.license", ",").alias("licenses"), F.size("matches").cast("long").alias("n_licenses"),
        F.round(F.coalesce(F.array_max("matches.share"), F.lit(0.0)), 6).alias("best_share"))


def _oracle() -> str:
    steps = steps_of([len(shingles_of(text)) for _, text in LICENSE_TEXTS])
    values = ", ".join(f"({k}, '{name}', {steps[len(s)]}, {len(s)}, '{' '.join(x)}')"
                       for k, (name, text) in enumerate(LICENSE_TEXTS) for s in [shingles_of(text)] for x in s)
    marks = ", ".join(f"({k}, {rival}, {len(own)}, '{' '.join(x)}')" for k, rivals in enumerate(marks_of(LICENSE_TEXTS))
                      for rival, own in enumerate(rivals) for x in own)
    return f"""
WITH template(t, license, step, m, shingle) AS (VALUES {values}),
mark(t, rival, n, shingle) AS (VALUES {marks}),
words AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM documents),
spots AS (SELECT doc_id, w, unnest(range(0, len(w) - {SIZE - 1})) AS i FROM words WHERE len(w) >= {SIZE}),
shingles AS (SELECT doc_id, i, array_to_string(w[i + 1:i + {SIZE}], ' ') AS shingle FROM spots),
hits AS (SELECT doc_id, t, license, m, s.shingle, unnest([i // step, i // step - 1]) AS block
         FROM shingles s JOIN template USING (shingle)),
likely AS (SELECT doc_id, t, block, license, count(DISTINCT shingle) / m AS share FROM hits
           WHERE block >= 0 GROUP BY doc_id, t, license, m, block HAVING count(DISTINCT shingle) >= {SHARE} * m),
marked AS (SELECT doc_id, t, block, rival, count(DISTINCT shingle) AS c FROM hits JOIN mark USING (t, shingle)
           GROUP BY doc_id, t, block, rival),
taken AS (SELECT DISTINCT l.doc_id, l.t, l.block FROM likely l JOIN (SELECT DISTINCT t, rival, n FROM mark) r USING (t)
          LEFT JOIN marked c ON c.doc_id = l.doc_id AND c.t = l.t AND c.block = l.block AND c.rival = r.rival
          WHERE 2 * coalesce(c.c, 0) < r.n),
held AS (SELECT * FROM likely l ANTI JOIN taken x ON l.doc_id = x.doc_id AND l.t = x.t AND l.block = x.block),
best AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
                count(DISTINCT license) AS n_licenses, round(max(share), 6) AS best_share FROM held GROUP BY doc_id)
SELECT d.doc_id, coalesce(licenses, '') AS licenses, coalesce(n_licenses, 0) AS n_licenses,
       coalesce(best_share, 0.0) AS best_share
FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id"""


ORACLE_SQL = _oracle()
