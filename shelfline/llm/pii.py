"""Personal data: patterns propose spans, checks confirm them, words nearby move the score.

Base kinds are email, ip, card and phone: leftmost matches that do not overlap within a kind, kept if their own check
holds (parts of at most 255; 14 to 19 digits that pass Luhn; 10 to 15 digits). Added kinds are iban (mod 97) and
ssn (needs a word such as ``ssn`` close before it). Every span carries a score: what its check is worth, and more if
one of the kind's words stands in the ``NEAR`` characters before it (back to the kind's last match); spans under ``LEAST`` are dropped, base spans never.

Patterns are written with possessive repeats and may start only where a run of their first characters starts or the
last match ended: the same matches, found in one pass over texts of any length. Each row is worked out alone, by
expressions only, without a shuffle. Null and empty texts have no spans; repeated rows each get theirs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEAR = 40
LEAST = 0.6
CONTEXT_BONUS = 0.3
CHUNK = 256  # matches whose positions are summed at a time


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str          # a text without a match of this has no span
    check: str          # SQL over m, the match
    score: float        # of a match that passes its check
    words: str = ""     # alternatives of the words that raise the score
    base: bool = True


def _digits(least: int, most: int) -> str:
    return f"length(regexp_replace(m, '[^0-9]', '')) BETWEEN {least} AND {most}"


#: Remainder of the IBAN by 97: its first four characters moved to the end, letters as 10 to 35.
_MOD97 = ("aggregate(transform(sequence(1, length(m)), i -> ascii(substring(concat(substring(m, 5), substring(m, 1, 4)), i, 1))), 0, "
          "(r, c) -> CASE WHEN c >= 65 THEN (r * 100 + c - 55) % 97 ELSE (r * 10 + c - 48) % 97 END) = 1")

KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", "true", 0.9, "mail|contact|write|reply"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]",
         "forall(split(m, '[.]'), p -> length(trim(LEADING '0' FROM p)) <= 3 AND "
         "cast(substring(concat('0', trim(LEADING '0' FROM p)), -4) AS INT) <= 255)", 0.6, "ip|host|server|address"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]", f"{_digits(14, 19)} AND luhn_check(regexp_replace(m, '[^0-9]', ''))",
         0.8, "card|visa|credit|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _digits(10, 15), 0.6, "phone|call|tel|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}[A-Z0-9]{11}",
         _MOD97, 0.9, "iban|account|bank", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-[0-9]{4}",
         "substring(m, 1, 3) NOT IN ('000', '666') AND substring(m, 1, 1) <> '9' AND substring(m, 5, 2) <> '00' "
         "AND substring(m, 8) <> '0000'", 0.4, "ssn|social security", base=False),
)


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(kind: Kind, text: str) -> str:
    """SQL: array of (gap, near, m), each match, the number of characters since the last one's end, the last of them."""
    p = _literal(kind.pattern)
    pairs = (f"filter(zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), "
             f"(g, m) -> struct(char_length(g) AS gap, substring(g, -{NEAR}) AS near, m AS m)), x -> x.m IS NOT NULL)")
    return f"CASE WHEN {text} RLIKE {_literal(kind.needs)} THEN {pairs} END"


def _starts(pairs: str) -> str:
    """SQL: array of (start, end, near, m) from (gap, near, m).

    A start is a sum of lengths. Sums run in chunks, so arrays that grow by one element stay short: first
    within each chunk, then over the chunks' totals.
    """
    chunk = (f"aggregate(slice({pairs}, k * {CHUNK} + 1, {CHUNK}), "
             "struct(0 AS at, cast(array() AS array<struct<start:int,end:int,near:string,m:string>>) AS got), "
             "(a, x) -> struct(a.at + x.gap + char_length(x.m) AS at, "
             "array_append(a.got, struct(a.at + x.gap AS start, a.at + x.gap + char_length(x.m) AS end, x.near AS near, x.m AS m)) AS got))")
    chunks = f"transform(sequence(0, (size({pairs}) - 1) DIV {CHUNK}), k -> {chunk})"
    joined = (f"aggregate({chunks}, struct(0 AS at, cast(array() AS array<array<struct<start:int,end:int,near:string,m:string>>>) AS got), "
              "(b, c) -> struct(b.at + c.at AS at, array_append(b.got, transform(c.got, "
              "x -> struct(x.start + b.at AS start, x.end + b.at AS end, x.near AS near, x.m AS m))) AS got), b -> flatten(b.got))")
    return f"CASE WHEN size({pairs}) > 0 THEN {joined} ELSE array() END"


def find_spans(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """doc_id and spans, an array of (kind, rank, base, start, end, score) by start, then kinds as listed."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", *(F.expr(_found(k, "text")).alias(f"pairs_{k.name}") for k in kinds))
    rows = rows.select("doc_id", "text", *(F.expr(_starts(f"pairs_{k.name}")).alias(f"at_{k.name}") for k in kinds))
    each = []
    for rank, kind in enumerate(kinds):
        bonus = f"CASE WHEN lower(x.near) RLIKE {_literal(kind.words)} THEN {CONTEXT_BONUS}D ELSE 0D END" if kind.words else "0D"
        passed = f"filter(at_{kind.name}, x -> exists(array(x.m), m -> {kind.check}))"
        spans = (f"transform({passed}, x -> struct(x.start AS start, {rank} AS rank, '{kind.name}' AS kind, "
                 f"x.end AS end, {str(kind.base).lower()} AS base, least(1D, {kind.score}D + {bonus}) AS score))")
        each.append(spans if kind.base else f"filter({spans}, s -> s.score >= {LEAST})")
    return rows.select("doc_id", F.expr(f"array_sort(concat({', '.join(each)}))").alias("spans"))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summarise(found: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """doc_id, the number of spans of each base kind, the digest of the base spans, and all spans as text."""
    count = lambda k: F.expr(f"size(filter(spans, s -> s.kind = '{k.name}'))").cast("long").alias(f"n_{k.name}")
    number, added = ([count(k) for k in kinds if k.base == base] for base in (True, False))
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *number, F.sha2(_text(base), 256).alias("base_sha256"),
                        _text(F.col("spans")).alias("spans"), *added)
