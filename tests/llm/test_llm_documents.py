"""The operators on documents against brute force, with awkward rows: null, empty, long, repeated, clashing columns."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfline.llm import bpe, common, decontaminate, licenses, line_dedup, near_dedup, pii, quality, token_counts
from shelfline.llm.common import components, importable
from shelfline.llm.queries import BPE_FILE, PIECE_FILE

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, class string, component string, row string, "
          "n long, spans string, hash string, bands string, key string, words string")


@pytest.fixture(scope="module")
def documents(spark):
    importable(spark)

    def make(*texts, first=0):
        rows = [t if isinstance(t, tuple) else (k + first, t) for k, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "c", "d", "r", 7, "z", "h", "b", "k", "w")
                                      for i, t in rows], SCHEMA)
    return make


def prose(rng, n, words=("ab", "cd", "Ef", "gh", "ij", "kl", "mn", "op", "qr", "st", "uv", "wx", "yz", "a", "be")):
    return " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))


# ---------------------------------------------------------------- 2: BPE

PIECES = ["a", "the", "S", "'s", "'", "!", "1", "é", "é", " ", "\n", " ", "日", "Σ", "İ", "<|endoftext|>",
          "<|ENDOFTEXT|>", "<|end", "ing", ".", ",", "²", "_", ")", "Ⅷ"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=120).map("".join), st.integers(1, 40))
def test_trees_and_tables_encode_as_the_whole(text, part):
    tok = bpe.tokenizer(BPE_FILE)
    expected = tok.encode(text, add_special_tokens=False).ids
    assert bpe.encode(tok, text, part) == expected
    table, words = bpe.Words(tok), bpe.split_words(text)
    table.learn([words])
    assert table.ids(words) == expected
    assert table.digest(table.ids(words)) == bpe.digest(tok, expected)


@settings(max_examples=300, deadline=None)
@given(st.text([chr(c) for c in range(0x21, 0x180) if bpe.PLAIN.fullmatch(chr(c))], min_size=1, max_size=30))
def test_plain_words_encode_as_by_the_whole_tokenizer(word):
    assert list(bpe.known_words(BPE_FILE).plain(word)) == bpe.tokenizer(BPE_FILE).encode(word, add_special_tokens=False).ids


def test_plain_words_are_not_handed_to_the_whole_tokenizer(monkeypatch):
    words, asked = bpe.Words(bpe.tokenizer(BPE_FILE)), []

    class Asked:
        def encode_batch_fast(self, some, **_):
            asked.extend(some)
            return bpe.tokenizer(BPE_FILE).encode_batch_fast(some, add_special_tokens=False)
    monkeypatch.setattr(words, "tok", Asked())
    words.learn([["thanea", "été,!!", "x1", "it's", "<|endoftext|>", "Σ", "ª", "日"]])
    assert sorted(asked) == sorted(["it's", "<|endoftext|>", "Σ", "ª", "日"])


def test_bpe_rows(documents):
    tok = bpe.tokenizer(BPE_FILE)
    rng = random.Random(1)
    unsplit = "".join(rng.choice("abcdefgh") for _ in range(3000))
    texts = [None, "", " \n", "The cat's hat.", "The cat's hat.", unsplit, prose(rng, 900), (3, "The cat's hat."), (None, "x")]
    docs = documents(*texts)
    got = bpe.encode_documents(docs, BPE_FILE, part=500, with_ids=True)
    expected = Counter((r.doc_id, *bpe.digest(tok, tok.encode(r.text or "", add_special_tokens=False).ids))
                       for r in docs.collect())
    rows = got.collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == expected
    texts = {r.doc_id: r.text for r in bpe.decode_documents(got, BPE_FILE).collect()}
    assert all(texts[r.doc_id] == tok.decode(r.ids, skip_special_tokens=False) for r in rows)
    assert bpe.encode_documents(docs.limit(0), BPE_FILE).count() == 0


# ---------------------------------------------------------------- 3: decontamination

def edit_distance(pattern, text):
    """Least edits between the pattern and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(last + (c != d), row[j] + 1, row[j - 1] + 1)
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("ab c", min_size=4, max_size=60), st.text("abc ", max_size=30), st.text("abc ", max_size=30),
       st.lists(st.tuples(st.integers(0, 59), st.sampled_from(["", "a", "b", "cc"])), max_size=6))
def test_every_place_within_the_budget_is_found(item, before, after, edits):
    inner = list(item)
    for at, new in edits:
        inner[at % len(inner)] = new
    text = before + "".join(inner) + after
    pattern, plain = decontaminate.normalise(item), decontaminate.normalise(text)
    if not pattern:
        return
    got = decontaminate.Matcher([(5, item)], 0.1).matches(text)
    least = edit_distance(pattern, plain)
    assert [m[:2] for m in got] == ([(5, least)] if least <= decontaminate.budget(len(pattern), 0.1) else [])
    for _, distance, start, end in got:
        assert edit_distance(plain[start:end], pattern) <= distance


def test_leaks_go(spark, documents):
    item = "Which of these seven rivers flows north through the old town, and why does it?"
    edited = item.upper().replace("SEVEN", "SEVERN").replace(",", " ;\n")
    items = spark.createDataFrame([(1, item), (2, item), (3, None), (4, "?!"), (None, "the old")], "item_id long, text string")
    docs = documents("x " * 50 + item + " y", edited, "nothing here", None, "", (1, edited), (None, item), "z" * 200_000)
    found = decontaminate.find_leaks(docs, items)
    assert Counter((r.doc_id, r.item_id, r.distance) for r in found.collect()) == Counter(
        {(0, 1, 0): 1, (0, 2, 0): 1, (1, 1, 1): 2, (1, 2, 1): 2, (None, 1, 0): 1, (None, 2, 0): 1})
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 7]
    assert decontaminate.clean(docs, items.limit(0)).count() == 8
    assert decontaminate.find_leaks(docs.limit(0), items).count() == decontaminate.find_leaks(docs, items.limit(0)).count() == 0


# ---------------------------------------------------------------- 4: near-duplicates

def brute_groups(rows, percent=85):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    least = {i: i for i, _ in rows}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(rows[a][0]), root(rows[b][0])
                least[max(x, y)] = min(x, y)
    return [(i, len(s), root(i), root(i) == i) for (i, _), s in zip(rows, sets)]


def test_near_groups_are_those_of_all_pairs(documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "COLUMNS", 64)
    monkeypatch.setattr(near_dedup, "SLICE", 200)
    rng = random.Random(4)
    texts = []
    for _ in range(6):
        base = prose(rng, 80).split()
        for _ in range(12):  # chains: each copy changes a little of the one before
            base = base[:]
            base[rng.randrange(len(base))] = "new" + str(rng.randrange(99))
            texts.append(" ".join(base))
    rng.shuffle(texts)
    texts += [texts[0], texts[0].upper(), texts[1] + "\n", None, "", " \t", "one two", "One  two", "é é", prose(rng, 20_000)]
    rows = list(enumerate(texts))
    got = sorted(tuple(r) for r in near_dedup.near_groups(documents(*texts)).collect())
    assert got == sorted(brute_groups(rows))
    assert len({r[2] for r in got}) < len(got) - 30


def test_one_of_each_group_stays(documents):
    docs = documents("a b c d e f g", "A b c d e f G", (1, "A b c d e f G"), (None, "a b c d e f g"), (5, "other text"),
                     (5, "other text"), "x y z", None, "")
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([0, None, 5, 6, 7, 8])
    assert near_dedup.keep_one(docs.limit(0)).count() == near_dedup.near_groups(docs.limit(0)).count() == 0


def test_texts_of_one_id_keep_their_links_in_open_buckets(documents, monkeypatch):
    a, b = list(range(100)), list(range(1000, 1100))
    for rows in ([(1, a), (2, a), (2, b)], [(1, a), (2, b), (2, a)], [(2, b), (1, a), (2, a), (3, b)]):
        links = near_dedup._block_links(pd.DataFrame(rows, columns=["id", "set"]), 85)
        assert {(r.a, r.b) for r in links.itertuples()} == ({(2, 1), (3, 1)} if len(rows) == 4 else {(2, 1)})
    # a bucket whose smallest class is foreign: every band equal
    prints = near_dedup._prints

    def same_bands(batches):
        before, near_dedup.bands = near_dedup.bands, lambda places: np.arange(3, dtype=np.int64)
        try:
            yield from prints(batches)
        finally:
            near_dedup.bands = before
    monkeypatch.setattr(near_dedup, "_prints", same_bands)
    rng = random.Random(12)
    one, two, foreign = (prose(rng, 60) for _ in range(3))
    near = lambda text: text + " more"
    rows = [(0, foreign), (7, one), (7, two), (8, near(two)), (9, near(one)), (12, prose(rng, 60))]
    got = sorted({tuple(r) for r in near_dedup.near_groups(documents(*rows)).select("doc_id", "component_id").collect()})
    assert got == [(0, 0), (7, 7), (8, 7), (9, 7), (12, 12)]


def test_sieve_lets_all_wanted_rows_pass(spark, monkeypatch):
    importable(spark)
    rows = spark.range(20_000).selectExpr("id", "concat('t', id) AS text")
    kept = {r.id for r in common.sieved(rows, "id", spark.range(0, 20_000, 7)).collect()}
    assert kept >= set(range(0, 20_000, 7)) and len(kept) < 3200
    assert common.sieved(rows, "id", spark.range(0)).count() == 0


def test_sketches_estimate_similarity():
    rng = random.Random(8)
    off = []
    for _ in range(40):
        a = prose(rng, 60).split()
        b = a[:]
        b[30] = "changed"
        x, y = (near_dedup.shingle_set(" ".join(t)) for t in (a, b))
        true = len(set(x) & set(y)) / len(set(x) | set(y))
        off.append((near_dedup.sketch(x) == near_dedup.sketch(y)).mean() - true)
    assert abs(sum(off) / len(off)) < 0.04
    assert (near_dedup.sketch(near_dedup.shingle_set("one word")) < 2 ** 63).all()


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 540)] + [(7, 7), (None, 1), (3, 2)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 500 for k in range(500, 540)}, 2: 2, 3: 2}


# ---------------------------------------------------------------- 5: lines

def brute_lines(rows, words=50):
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines = (text or "").split("\n")
        full = [k for k, x in enumerate(lines) if x.strip()]
        gone = set()
        for a in range(len(full)):
            total, b = 0, a
            while b < len(full) and total < words:
                total += len(lines[full[b]].split())
                b += 1
            if total >= words:
                run = tuple(lines[k] for k in full[a:b])
                if run in seen:
                    gone |= set(range(full[a], full[b - 1] + 1))
                seen.add(run)
        out[i] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_repeated_runs_go(documents):
    rng = random.Random(6)
    pool = [prose(rng, rng.choice([3, 8, 20, 45, 60])) for _ in range(25)]
    texts = []
    for _ in range(40):
        at = rng.randrange(len(pool) - 4)
        texts.append("\n".join([*pool[at:at + rng.randrange(1, 5)], rng.choice(["", "  "]), prose(rng, 12)] + rng.choices(pool, k=3)))
    texts += [None, "", "\n\n", pool[0], "same line here\n" * 100, "\n".join(pool * 20)]
    docs = documents(*texts)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.cleaned or "")
           for r in line_dedup.drop_repeats(docs).select("row.doc_id", "n_lines", "n_removed", "cleaned").collect()}
    assert got == brute_lines(list(enumerate(texts)))
    assert sum(v[1] for v in got.values()) > 50


def test_rows_without_anything_new_go(documents):
    long = " ".join(f"w{k}" for k in range(60))
    docs = documents(long, long, "own\n" + long, None, "", (0, long), (None, long))
    kept = line_dedup.clean(docs)
    assert kept.columns == docs.columns
    # rows 0 are one document and first; the others lose the line, and two of them all they have
    assert Counter((r.doc_id, r.text, r.n_chars) for r in kept.collect()) == Counter(
        [(0, long, len(long)), (0, long, len(long)), (2, "own", 3), (3, None, 0), (4, "", 0)])
    assert line_dedup.clean(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- 6: personal data

def luhn(digits):
    return sum(v - 9 if v > 9 else v for v in (int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits)))) % 10 == 0


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15)]


def base_spans(text):
    found = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, pattern, fine) in enumerate(BASE)
             for m in re.finditer(pattern, text or "") if fine(m.group())]
    return [x[2] for x in sorted(found)]


def test_base_spans(documents):
    rng = random.Random(3)
    parts = ["a@b.c", "_d@e.f", "1.2.3.4", ".5", "256.1.1.1", "001.02.3.4", "0000255.1.1.1", "4111 1111 1111 1111", "4111-1111",
             "+1 (415) 555-0100", "+44 20 7946 0958", " ", "x", "é", "😀", "-", "1", "@", ".", "\n", "+", "()", "0"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(400)]
    texts += [None, "", "1" * 5000, "a" * 60_000, "1.2.3.4 " * 1500, "a@b.c " * 3000]
    docs = documents(*texts, (0, texts[0]))
    rows = pii.summarise(pii.find_spans(docs)).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        spans = base_spans(texts[r.doc_id])
        kinds = Counter(s.split(":")[0] for s in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds[k] for k, *_ in BASE]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in dict((k, 0) for k, *_ in BASE)] == (spans or [])
    assert pii.find_spans(docs.limit(0)).count() == 0


def test_added_spans_and_scores(documents):
    docs = documents("Pay to GB82WEST12345698765432 now", "GB82WEST12345698765433", "ssn 123-45-6789", "no 123-45-6789",
                     "my server 10.0.0.1", "10.0.0.1")
    spans = {r.doc_id: [(s.kind, s.start, s.end, round(s.score, 2)) for s in r.spans] for r in pii.find_spans(docs).collect()}
    assert spans == {0: [("iban", 7, 29, 0.9)], 1: [], 2: [("ssn", 4, 15, 0.7)], 3: [], 4: [("ip", 10, 18, 0.9)],
                     5: [("ip", 0, 8, 0.6)]}


# ---------------------------------------------------------------- 8: token counts

@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcd", min_size=1, max_size=5), max_size=12), st.lists(st.text("abcd", max_size=3), max_size=4),
       st.text("abcde", min_size=1, max_size=30))
def test_the_automaton_is_greedy(inner, initial, word):
    vocabulary = set(inner) | {token_counts.MARK + x for x in initial}
    rest, count = token_counts.MARK + word, 0
    while rest and count is not None:
        size = next((n for n in range(len(rest), 0, -1) if rest[:n] in vocabulary), None)
        rest, count = (rest[size:], count + 1) if size else ("", None)
    assert token_counts.Automaton(vocabulary).count(word) == count


def test_token_count_rows(documents):
    docs = documents(None, "", "the cat 日本日本 the", "the " * 50_000, (3, "x" * 100_000), (None, "the"))
    rows = [tuple(r) for r in token_counts.count_tokens(docs, PIECE_FILE).collect()]
    assert rows[:2] == [(0, 0, 0, 0), (1, 0, 0, 0)]
    assert rows[3] == (3, 50_000, 50_000, 0) and rows[5] == (None, 1, 1, 0)
    assert token_counts.count_tokens(docs.limit(0), PIECE_FILE).count() == 0


# ---------------------------------------------------------------- 9: quality

def test_quality_is_learnt_and_kept_to_its_rows(spark, documents):
    rng = random.Random(9)
    texts = [prose(rng, 60) if k % 3 else " | ".join([prose(rng, 1)] * 40).upper() for k in range(300)]
    docs = documents(*texts, None, "", (5, texts[5]), (None, texts[1]), "word " * 50_000)
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(300)] + [(None, 1, 0), (4, None, 0), (7, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == 305 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    aside = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert len(aside) > 40 and sum(r.predicted == (r.doc_id % 3 > 0) for r in aside) >= 0.97 * len(aside)
    kept = quality.clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)


def test_quality_without_labels(spark, documents):
    docs = documents("a b", None)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.score(docs, quality.fit(docs, none)).collect()] == [0.5, 0.5]
    empty = docs.limit(0)
    assert quality.score(empty, quality.fit(empty, none)).count() == 0


# ---------------------------------------------------------------- 1: licences

def test_licences(documents):
    texts = dict(enumerate([None, "", "license", "x " * 3000 + "Released under the MIT License." + " y" * 3000,
                            licenses.LICENSE_TEXTS[2][1].replace("Software", "software,"),
                            "permission " * 500, licenses.LICENSE_TEXTS[7][1] + " " + licenses.LICENSE_TEXTS[5][1],
                            "Released under the BSD License"]))
    docs = documents(*texts.values(), (3, texts[3]))
    got = Counter((r.doc_id, r.licenses, r.n_licenses) for r in licenses.summarise(licenses.scan(docs)).collect())
    assert got == Counter([(0, "", 0), (1, "", 0), (2, "", 0), (3, "MIT", 1), (3, "MIT", 1), (4, "MIT", 1), (5, "", 0),
                           (6, "BSD-3-Clause,GPL-3.0", 2), (7, "", 0)])
    assert licenses.scan(docs.limit(0)).count() == 0


def test_partial_licences_count_by_share(documents):
    name, text = licenses.LICENSE_TEXTS[6]
    words = text.split()
    expected = {}
    texts = []
    for k, cut in enumerate((0, 3, 6, 9, 20)):
        part = " ".join(words[cut:])
        whole, held = set(licenses.shingles_of(text)), set(licenses.shingles_of(part))
        share, marks = len(whole & held) / len(whole), licenses.marks_of(licenses.LICENSE_TEXTS)[6]
        expected[k] = name if share >= licenses.SHARE and all(2 * len(held & set(m)) >= len(m) for m in marks) else ""
        texts.append(part)
    got = {r.doc_id: r.licenses for r in licenses.summarise(licenses.scan(documents(*texts))).collect()}
    assert got == expected and len(set(got.values())) == 2


def test_no_licence_is_named_as_another(documents):
    known, words = licenses.LICENSE_TEXTS, "some words of no licence stand here " * 40
    alone = [f"{words} {text} {words}" for _, text in known]
    changed = [f"Copyright 2020 {text} Enjoy." for _, text in known]
    gpl_2, gpl_3 = (next(t for n, t in known if n == name and len(t) > 150) for name in ("GPL-2.0", "GPL-3.0"))
    got = {r.doc_id: r.licenses for r in licenses.summarise(licenses.scan(documents(*alone, *changed, gpl_2 + " " + gpl_3))).collect()}
    assert [got[k] for k in range(len(got) - 1)] == [name for name, _ in known] * 2
    assert got[len(got) - 1] == "GPL-2.0,GPL-3.0"
    assert all(m for rivals in licenses.marks_of(known) for m in rivals)  # every wording can be told from every other


def test_the_nearest_prefix_is_that_of_a_full_table():
    def table(pattern, text):
        row = list(range(len(text) + 1))
        for i, c in enumerate(pattern, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(text, 1):
                last, row[j] = row[j], min(last + (c != d), row[j] + 1, row[j - 1] + 1)
        return max(j for j, d in enumerate(row) if d == min(row))
    rng = random.Random(21)
    for _ in range(400):
        pattern, text = ("".join(rng.choice("ab c") for _ in range(rng.randint(low, 30))) for low in (1, 0))
        assert decontaminate.Pattern(1, pattern, 0.1).nearest_prefix(text) == table(pattern, text)


def test_a_long_item_is_placed_in_a_moment():
    rng = random.Random(22)
    item = prose(rng, 1000)[:5000].strip()
    began = time.thread_time()
    assert decontaminate.Matcher([(1, item)]).matches("before " + item + " after")[0][1:] == (0, 7, 7 + len(decontaminate.normalise(item)))
    assert time.thread_time() - began < 2


def test_token_counts_of_whole_rows_are_greedy(documents):
    vocabulary = set(token_counts.pieces_of(PIECE_FILE))
    longest = max(map(len, vocabulary))

    def greedy(word):
        rest, count = token_counts.MARK + word, 0
        while rest:
            size = next((n for n in range(min(longest, len(rest)), 0, -1) if rest[:n] in vocabulary), 0)
            if not size:
                return 1, 1
            rest, count = rest[size:], count + 1
        return count, 0
    rng = random.Random(31)
    letters = "abcdeéß日本0 9.,\n\t😀ABC'-"
    texts = [prose(rng, 80) for _ in range(20)] + ["".join(rng.choice(letters) for _ in range(300)) for _ in range(20)]
    for (doc, n_words, n_tokens, n_unknown), text in zip(map(tuple, token_counts.count_tokens(documents(*texts), PIECE_FILE).collect()), texts):
        split = [greedy(w) for w in text.split()]
        assert (n_words, n_tokens, n_unknown) == (len(split), sum(n for n, _ in split), sum(u for _, u in split))


def brute_features(texts, text):
    """Vectors and features by dictionaries and loops."""
    index = lambda b: dict(zip(quality.PLACES[b].tolist(), quality.SIGNS[b].tolist()))
    vectors, count = {}, Counter()
    for t in texts:
        words = quality._bucket(t)[0].tolist()
        count.update(words)
        for i, w in enumerate(words):
            for j in range(max(0, i - quality.REACH), min(len(words), i + quality.REACH + 1)):
                if i != j:
                    for place, sign in index(words[j]).items():
                        vectors.setdefault(w, [0.0] * quality.WIDTH)[place] += sign
    total = sum(count.values())

    def vector(w):
        v = vectors.get(w, [0.0] * quality.WIDTH)
        norm = max(sum(x * x for x in v) ** 0.5, 1e-9)
        return [x / norm * quality.RARE / (quality.RARE + count[w] / total) for x in v]
    words, shapes = (x.tolist() for x in quality._bucket(text))
    n, width = len(words), quality.WIDTH
    out = [0.0] * quality.N_FEATURES
    if not n:
        return out
    pooled = [0.0] * width
    for w, s in zip(words, shapes):
        for k, x in enumerate(vector(w)):
            out[k] += x / n
        for place, sign in index(s).items():
            out[width + place] += sign / n
        for place, sign in index(w).items():
            pooled[place] += sign / n
    out[2 * width] = sum(x * x for x in pooled) ** 0.5
    for k in (1, 2, 3):
        out[2 * width + k] = sum(words[i] == words[i - k] for i in range(k, n)) / (n - k) if n > k else 0.0
    out[2 * width + 4], out[2 * width + 5] = len(set(words)) / n, np.log1p(n)
    return out


def test_vectors_features_and_scores_are_those_of_plain_loops(documents):
    rng = random.Random(17)
    texts = [prose(rng, rng.randint(0, 40)) for _ in range(30)] + [None, "", "one", "two two", "A-1 b!! " * 5]
    vectors = quality.word_vectors(documents(*texts).repartition(5))
    made = np.array([quality.features(t, vectors) for t in texts])
    assert np.allclose(made, [brute_features(texts, t) for t in texts], atol=1e-9)
    network = quality.Network(made, np.array([float(k % 2) for k in range(len(texts))]))
    w, b, v, c = network.parts
    for x, score in zip(made, network.score(made)):
        scaled = [min(6.0, max(-6.0, (a - m) / d)) for a, m, d in zip(x, network.mean, network.dev)]
        hidden = [np.tanh(sum(s * w[i][j] for i, s in enumerate(scaled)) + b[j]) for j in range(quality.HIDDEN)]
        z = sum(h * v[j] for j, h in enumerate(hidden)) + c[0]
        assert abs(score - 1 / (1 + np.exp(-z / network.temperature))) < 1e-9


def test_an_id_of_many_rows_is_learnt_from_once(spark, documents):
    rng = random.Random(18)
    docs = documents(*[(3, prose(rng, 20)) for _ in range(500)], *[(k, prose(rng, 20)) for k in range(10, 30)])
    labels = spark.createDataFrame([(3, 1)] + [(k, k % 2) for k in range(10, 30)], "doc_id long, quality int")
    seen = []

    class Spy(quality.Network):
        def __init__(self, x, y, seed=7):
            seen.append(len(x))
            super().__init__(x, y, seed)
    before, quality.Network = quality.Network, Spy
    try:
        context = spark.sparkContext
        quality.train(docs, labels, context.broadcast(quality.word_vectors(docs)))
    finally:
        quality.Network = before
    learnt = [k for k in [3, *range(10, 30)] if zlib.crc32(str(k).encode()) % 4 != 2]
    assert seen == [len(learnt)]


def test_scores_at_the_threshold_are_kept(spark, documents):
    docs = documents("a b", "c d")
    even = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))  # every score is 0.5
    assert {r.predicted for r in quality.score(docs, even, keep=0.5).collect()} == {1}
    assert quality.clean(docs, even, keep=0.5).count() == 2 and quality.clean(docs, even, keep=0.5000001).count() == 0
