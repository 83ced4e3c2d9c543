"""Embeddings, URLs and the pipeline against brute force; what is registered."""

import math
import pathlib
import random
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shelfline.llm import bpe, embed_dedup, url_filter
from shelfline.llm.common import importable
from shelfline.llm.queries import BPE_FILE, URL_RULES
from shelfline.session import shared_dir

SF_DIR = pathlib.Path("/root/testdata/sf0.001")


# ---------------------------------------------------------------- 7: embeddings

def brute_links(vectors, cosine=0.95):
    """{vec_id: (links, component)} of distinct ids."""
    fine = {i: np.array(v, float) for i, v in vectors if v is not None and len(v) and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float) != 0)}
    least = {i: i for i, _ in vectors}
    links = Counter()

    def root(x):
        while least[x] != x:
            x = least[x]
        return x
    for a, x in fine.items():
        for b, y in fine.items():
            if a < b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links[a] += 1
                links[b] += 1
                p, q = root(a), root(b)
                least[max(p, q)] = min(p, q)
    return {i: (links[i], root(i)) for i, _ in vectors}


@pytest.mark.parametrize("block", [8, 2048])
def test_links_are_those_of_all_pairs(spark, monkeypatch, block):
    importable(spark)
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    monkeypatch.setattr(embed_dedup, "CELL", 20)
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(20):
        base = rng.normal(size=16)
        rows += [(base + rng.normal(size=16) * s).tolist() for s in (0, 0.05, 0.2, 0.25, 0.3, 0.35)]
    rows += [rows[0], [x * 3 for x in rows[0]], [-x for x in rows[0]]] + [rows[6]] * 15
    rows += [None, [], [0.0] * 16, [float("nan")] * 16, [1.0] * 15 + [float("inf")], [None] + [1.0] * 15, [1.0, 0.0], [2.0, 0.01]]
    vectors = list(enumerate(rows, 10))
    frame = spark.createDataFrame([(i, v, 1, True, 2, "c") for i, v in vectors],
                                  "vec_id long, embedding array<float>, id int, home boolean, n int, cell string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_groups(frame).collect()}
    as_float = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]
    assert got == brute_links(as_float)
    assert any(n > 10 for n, _ in got.values())


def test_repeated_and_nameless_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.1])], schema)
    rows = Counter(tuple(r) for r in embed_dedup.near_groups(frame).collect())
    assert rows == Counter({(1, 1, 1, True): 2, (None, 0, None, True): 1, (2, 1, 1, False): 1})
    assert embed_dedup.near_groups(frame.limit(0)).count() == 0
    bad = spark.createDataFrame([(4, None)], schema)
    assert [tuple(r) for r in embed_dedup.near_groups(bad).collect()] == [(4, 0, 4, True)]


def test_cells_miss_nearly_nothing_at_the_threshold():
    rng = np.random.default_rng(11)
    x = embed_dedup.unit(list(rng.normal(size=(4000, 64))))
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    y = 0.9501 * x + math.sqrt(1 - 0.9501 ** 2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    centroids = embed_dedup.spherical_kmeans(x, 32)
    margin = embed_dedup.reach(0.95, 64)
    visits = defaultdict(set)
    for r, c, _ in zip(*embed_dedup.cells_of(y, centroids, margin)):
        visits[r].add(c)
    home = (x @ centroids.T).argmax(1)
    assert sum(home[k] in visits[k] for k in range(len(x))) >= 0.999 * len(x)
    assert np.mean([len(v) for v in visits.values()]) < 16


def test_no_link_of_vectors_of_low_rank_is_missed(spark, monkeypatch):
    importable(spark)
    monkeypatch.setattr(embed_dedup, "CELL", 20)
    rng = np.random.default_rng(4)
    plane = rng.normal(size=(6, 256))  # 256 dimensions, 6 of them in use
    base = embed_dedup.unit(list(rng.normal(size=(300, 6)) @ np.linalg.qr(plane.T)[0].T))
    noise = embed_dedup.unit(list(rng.normal(size=(300, 6)) @ np.linalg.qr(plane.T)[0].T))
    noise = embed_dedup.unit(list(noise - (noise * base).sum(1, keepdims=True) * base))
    near = 0.951 * base + math.sqrt(1 - 0.951 ** 2) * noise
    vectors = [(k, v.tolist()) for k, v in enumerate(np.concatenate([base, near]).astype(np.float32))]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_groups(frame).collect()}
    assert got == brute_links(vectors)


def test_vectors_are_stored_a_few_times_however_evenly_they_are_spread(spark, monkeypatch):
    importable(spark)
    monkeypatch.setattr(embed_dedup, "CELL", 20)
    x = np.random.default_rng(8).normal(size=(3000, 64)).astype(np.float32)
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    folder = pathlib.Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    assert embed_dedup.near_groups(frame).where("n_links = 0 AND kept").count() == len(x)
    staged = sum(f.stat().st_size for new in set(folder.iterdir()) - before for f in new.rglob("part-*"))
    assert staged < 2 * x.nbytes  # a vector was stored for each cell near it


def test_two_vectors_that_share_a_neighbour_of_another_cell_are_one_group(spark, monkeypatch):
    importable(spark)
    at = lambda turn, *side: (np.append(math.cos(math.radians(turn)), math.sin(math.radians(turn)) * np.array(side))).tolist()
    half = math.sqrt(0.5)
    monkeypatch.setattr(embed_dedup, "spherical_kmeans", lambda x, k: np.array([at(10, -half, -half), at(20, half, half)]))
    vectors = [(0, at(17, 1, 0)), (1, at(17, 0, 1)), (2, at(0, 0, 0))]  # 2 lives in the first cell, near the other
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_groups(frame).collect()}
    assert got == brute_links(vectors) == {0: (1, 0), 1: (1, 0), 2: (2, 0)}


def test_vectors_of_many_lengths_in_double_precision(spark, monkeypatch):
    importable(spark)
    monkeypatch.setattr(embed_dedup, "BLOCK", 40)
    rng = np.random.default_rng(13)
    vectors = []
    for size in (3, 3, 8, 40, 40, 40, 70):
        base = rng.normal(size=(30, size))
        vectors += [(len(vectors) + k, v.tolist()) for k, v in enumerate(np.concatenate([base, base + rng.normal(size=base.shape) * 0.25]))]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_groups(frame).collect()}
    assert got == brute_links(vectors)


@pytest.mark.parametrize("dimensions, cosine", [(3, 0.95), (24, 0.95), (24, 0.3)])
def test_a_pair_of_blocks_finds_each_link_once(monkeypatch, dimensions, cosine):
    for name, value in (("LEAF", 9), ("TOGETHER", 2), ("PAIRS", 50)):
        monkeypatch.setattr(embed_dedup, name, value)
    rng = np.random.default_rng(14)
    base = rng.normal(size=(60, dimensions))
    raw = np.concatenate([base, base + rng.normal(size=base.shape) * 0.2, base * 1e-20, base * 1e25]).astype(np.float32)
    x = embed_dedup.unit(raw)
    centroids = embed_dedup.spherical_kmeans(x, 9)
    cell, n = (x @ centroids.T).argmax(1), rng.integers(1, 4, len(x))
    near = (x * centroids[cell]).sum(1)
    lead = np.linalg.qr(rng.normal(size=(dimensions, dimensions)))[0][:, :embed_dedup.leading(dimensions)]
    model = SimpleNamespace(cosine=cosine, kind=np.float32, main=dimensions, centroids=centroids.astype(np.float32), lead=lead)
    blocks = []
    for no in (0, 1):
        at = np.flatnonzero(np.arange(len(x)) % 2 == no)
        at = at[np.lexsort((near[at], cell[at]))]
        blocks.append(embed_dedup._opened({
            "no": no, "d": dimensions, "ids": at.astype(np.int64).tobytes(), "ns": n[at].astype(np.int64).tobytes(),
            "cells": cell[at].astype(np.int32).tobytes(), "nears": near[at].astype(np.float32).tobytes(), "vectors": raw[at].tobytes()}, model))
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    for a, b in ((0, 0), (0, 1), (1, 1)):
        found = embed_dedup._compared(blocks[a], blocks[b], model).to_pydict()
        links = np.zeros(len(x), int)
        np.add.at(links, found["id"], found["links"])
        met = linked & (np.add.outer(np.arange(len(x)) % 2, np.arange(len(x)) % 2) == a + b)
        assert links.tolist() == (met @ n).tolist()
        group = list(range(len(x)))
        for i, j in zip(found["id"], found["label"]):
            group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
        assert all(group[i] == group[j] for i, j in zip(*np.nonzero(met)))


# ---------------------------------------------------------------- 10: URLs

def brute_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("#")[0].split("?")[0]
    fits = [(len(r), -k, r, v) for k, (v, r) in enumerate(URL_RULES)
            for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return (host, path, *max(fits)[2:]) if fits else (host, path, None, None)


def brute_scores(hosts, training):
    """Mean log-likelihood ratio by dictionaries, without hashing into cells."""
    order, counts = url_filter.ORDER, {"allow": Counter(), "block": Counter()}
    pad = url_filter.START * order

    def spots(host, path):
        text = pad + host + path + url_filter.END
        return [text[k - order:k + 1] for k in range(order, len(text))]
    for host, path, verdict in training:
        for k in range(1, order + 1):
            counts[verdict][pad[:k]] += 1
        for s in spots(host, path):
            for k in range(1, order + 2):
                counts[verdict][s[-k:]] += 1

    def chance(c, s):
        p = 1 / url_filter.ALPHABET
        for k in range(order + 1):
            before = sum(n for g, n in c.items() if len(g) == 1) if k == 0 else c[s[-k - 1:-1]]
            p = (c[s[-k - 1:]] + url_filter.PRIOR * p) / (before + url_filter.PRIOR)
        return p
    return {(h, p): np.mean([math.log(chance(counts["allow"], s) / chance(counts["block"], s)) for s in spots(h, p)])
            for h, p in hosts}


def test_urls(spark):
    rng = random.Random(2)
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(['', 'm.', 'Blog.'])}{rng.choice(['example', 'other'])}."
            f"{rng.choice(['net', 'org', 'com'])}/{rng.choice(['en', 'de', 'fr', 'EN'])}/{rng.randrange(40)}"
            f"{rng.choice(['', '?a=/x', '#t', '.html'])}" for _ in range(300)]
    urls += [None, "", "no scheme", "://", "http://net", "http://net/", "http://xnet/", "http://ÄB.Net/é", "a://b://c/d",
             "http://example.com?x=/de/", "http://example.com:80/de/", "http://u" + "v" * 20_000 + ".net/"]
    pages = spark.createDataFrame([(k, u, "h", 1.0, "x", 3) for k, u in enumerate(urls)] + [(0, urls[0], "", 0.0, "", 1)],
                                  "page_id long, url string, host string, score double, text string, i int")
    rows = url_filter.judge_urls(pages, URL_RULES).collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        host, path, rule, verdict = brute_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("allow" if r.score >= r.threshold else "block"))
    ruled = [r for r in rows if r.rule]
    assert sum((r.score >= r.threshold) == (r.verdict == "allow") for r in ruled) > 0.9 * len(ruled)


def test_url_scores(spark):
    training = [(f"h{k}.a", f"/x{k % 3}", "allow" if k % 2 else "block") for k in range(9)]
    labelled = spark.createDataFrame(training, "host string, path string, rule_verdict string")
    asked = [("h1.a", "/x1"), ("", ""), ("zz", "/ü/x2")]
    got = {(r.host, r.path): r.score for r in url_filter.score(
        spark.createDataFrame(asked, "host string, path string"), url_filter.count_grams(labelled)).collect()}
    expected = brute_scores(asked, training)
    assert got.keys() == expected.keys() and all(abs(got[k] - expected[k]) < 1e-9 for k in got)


def test_url_counts_are_those_of_each_string(spark):
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789-._~"
    training = [(f"h{k}.a", "/" + "".join(rng.choice(letters) for _ in range(60)), "allow" if k % 2 else "block")
                for k in range(4000)]
    labelled = spark.createDataFrame(training, "host string, path string, rule_verdict string")
    counts = url_filter.count_grams(labelled).cache()
    grams = {s[k:k + 5] for h, p, _ in training for s in ["\x02" * 4 + h + p + "\x03"] for k in range(len(s) - 4)}
    assert counts.where("k = 5").count() == len(grams) > 1 << 17
    asked = [t[:2] for t in training[:2]] + [("new.a", "/" + "".join(rng.choice(letters) for _ in range(60)))]
    got = {(r.host, r.path): r.score for r in url_filter.score(
        spark.createDataFrame(asked, "host string, path string"), counts).collect()}
    expected = brute_scores(asked, training)
    assert got.keys() == expected.keys() and all(abs(got[k] - expected[k]) < 1e-9 for k in got)


def test_urls_that_differ_behind_the_path_are_judged_apart(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(6))
    urls = [f"http://{word()}.{'net' if k % 2 else 'org'}/fr/{word()}?{'buy=viagra' if k % 2 else 'page=two'}#{word()}" for k in range(200)]
    urls += ["https://c.com/p?buy=viagra", "https://c.com/p?page=two", "https://c.com/p", "buy=viagra", "page=two", None, ""]
    rows = {r.page_id: r for r in url_filter.judge_urls(
        spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), URL_RULES).collect()}
    bad, good, bare, bad_text, good_text, null, empty = (rows[200 + k] for k in range(7))
    assert (bad.verdict, good.verdict, bad_text.verdict, good_text.verdict) == ("block", "allow", "block", "allow")
    assert bad.score < bare.score < good.score and null.score == empty.score
    assert {r.path for r in (bad, good, bare)} == {"/p"} and {r.path for r in (bad_text, good_text, null)} == {""}


def test_urls_without_models(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (2, "http://a.net/")], "page_id long, url string")
    assert {(r.page_id, r.verdict) for r in url_filter.judge_urls(pages, URL_RULES).collect()} == {(1, "allow"), (2, "block")}
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).count() == 0


# ---------------------------------------------------------------- pipeline and registry

def test_pipeline_stages_take_effect(spark):
    importable(spark)
    rng = random.Random(5)
    good = lambda n: " ".join(rng.choice("ab cd ef gh ij kl mn op qr st".split()) + rng.choice("uvwxyz") for _ in range(n)) + "."
    bench = spark.read.parquet(str(SF_DIR / "benchmark.parquet")).orderBy("item_id").first().text
    docs = spark.read.parquet(str(SF_DIR / "documents.parquet"))
    base = good(200).split()
    near = base[:]
    near[100] = "other"
    extra = [(900_000, " ".join(base)), (900_001, " ".join(near)), (900_002, good(30) + " " + bench + " " + good(30)), (900_003, good(80))]
    more = docs.unionByName(spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in extra], docs.schema))
    sizes, frame = [], more
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, str(SF_DIR)).cache()
        sizes.append(frame.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frame.columns == docs.columns
    ids = {r.doc_id for r in frame.collect()}
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0] < more.count()
    assert 900_001 not in ids and 900_002 not in ids and {900_000, 900_003} <= ids


def test_pipeline_drops_near_copies_from_a_similarity_of_080(spark):
    words = [f"w{k}" for k in range(204)]  # 200 shingles; each word changed far from the others takes 5 of them
    changed = lambda n: " ".join("new" + w if k % 20 == 10 and k < 20 * n else w for k, w in enumerate(words))
    similarity = lambda n: (200 - 5 * n) / (200 + 5 * n)
    assert 0.80 <= similarity(4) < 0.85 and similarity(5) < 0.80
    for n, stays in ((4, False), (5, True)):
        docs = spark.createDataFrame([(1, " ".join(words)), (2, changed(n))], "doc_id long, text string")
        ids = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
        assert ids == ({1, 2} if stays else {1})


def test_pipeline_run_is_its_stages(spark):
    rows = corpus_pipeline.run(spark, str(SF_DIR)).collect()
    tok = bpe.tokenizer(BPE_FILE)
    assert rows and all(bpe.digest(tok, r.ids)[:2] == (r.n_tokens, r.ids_sha256) for r in rows)


def test_pipeline_takes_an_empty_table(spark):
    frame = spark.read.parquet(str(SF_DIR / "documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, str(SF_DIR))
        assert frame.count() == 0


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
