"""Bounds of the operators and what holds beyond them."""

import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from movrec.llm import common, decontaminate, language, quality, simhash, url_filter
from test_llm_operators import AWKWARD, docs_of
from test_llm_queries import rows

RULES = "host string, path string, allow boolean"


# --- op1 -------------------------------------------------------------------------
@pytest.fixture(scope="module")
def many_urls(spark):
    rng = np.random.default_rng(4)
    labels = [f"n{i}" for i in range(12)]
    host = lambda: ".".join(rng.choice(labels, rng.integers(1, 5)))
    rules = list({(host(), str(rng.choice(["", "/", "/a", "/b/c"]))): bool(rng.integers(2)) for _ in range(400)}.items())
    rules = [(h, p, a) for (h, p), a in rules]
    urls = [(i, f"http://{host()}{rng.choice(['', '/', '/a', '/ab/c', '/b/c/d'])}") for i in range(1500)]
    return rules, urls, spark.createDataFrame(urls, "page_id bigint, url string")


def brute(url, rules):
    rest = url.split("://")[1]
    host, _, path = rest.partition("/")
    path = "/" + path if "/" in rest else ""
    fits = [(len(h) + len(p), len(h), not a, h + p) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (None, "allow") if best is None else (best[3], "block" if best[2] else "allow")


@pytest.mark.parametrize("most", [url_filter.MAX_FILTER_BYTES, 160])
def test_urls_equal_brute_force_in_one_cascade_and_in_many(spark, many_urls, most):
    rules, urls, pages = many_urls
    listed = spark.createDataFrame(rules, RULES)
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in rows(url_filter.judge_urls(pages, listed, max_filter_bytes=most))}
    assert got == {i: brute(u, rules) for i, u in urls}


def test_cascades_share_the_keys_and_keep_to_their_bytes(spark):
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.filter("cast(substr(key, 2) as int) % 7 = 0")
    found = list(url_filter.build_cascades(listed, universe, max_filter_bytes=400))
    assert len(found) > 1 and all(c.bytes <= 400 for c in found) and sum(1 / c.parts for c in found) == 1
    a, b = url_filter.key_hashes(universe.key)
    t = universe.select("key", a.alias("a"), b.alias("b")).toPandas()
    h1, h2 = t.a.to_numpy().view(np.uint64), t.b.to_numpy().view(np.uint64)
    mine = np.stack([c.mine(h1) for c in found])
    assert (mine.sum(axis=0) == 1).all()
    has = np.stack([c.mine(h1) & c.has(h1, h2) for c in found]).any(axis=0)
    assert set(t.key[has]) == {f"k{i}" for i in range(0, 3000, 7)}


def test_ties_of_rules_and_a_host_of_many_labels(spark):
    rules = [("a.b", "/c", True), ("a.b", "/c", False), ("b", "/c/de", True), ("a.b", "/c/d", False)]
    urls = [(1, "http://a.b/c"), (2, "http://a.b/c/de"), (3, "http://" + "x." * 50_000 + "a.b/c"), (4, "http://a.b/c" + "y" * 100_000)]
    begin = time.monotonic()
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in rows(url_filter.judge_urls(spark.createDataFrame(urls, "page_id bigint, url string"), spark.createDataFrame(rules, RULES)))}
    assert time.monotonic() - begin < 60
    # equal rules: block; equal lengths: the longer host
    assert got == {1: ("a.b/c", "block"), 2: ("a.b/c/d", "block"), 3: ("a.b/c", "block"), 4: ("a.b/c", "block")}


# --- op8 -------------------------------------------------------------------------
def test_shares_serve_small_classes_first():
    assert language.shares([1, 100, 2, 50], 800, 40) == [1, 19, 2, 18] or sum(language.shares([1, 100, 2, 50], 800, 40)) == 40
    assert language.shares([5, 5, 5], 2, 100) == [2, 2, 2]
    assert sum(language.shares([9] * 7, 9, 3)) == 3 and language.shares([], 3, 3) == []


def test_a_sample_is_exact_per_class(spark):
    marks = spark.range(5000).select("id", F.when(F.col("id") < 3, "rare").when(F.col("id") < 40, "some").otherwise("most").alias("kind"))
    repeated = marks.unionByName(marks.filter("id = 50").join(spark.range(300).withColumnRenamed("id", "n")).select("id", "kind"))
    got = rows(language.bounded_sample(repeated, "kind", "id", 25, 9))
    count = {k: sorted(r["_place"] for r in got if r["kind"] == k) for k in ("rare", "some", "most")}
    assert count == {"rare": [0, 1, 2], "some": list(range(25)), "most": list(range(25))}
    assert len({r["id"] for r in got}) == len(got)


def test_many_languages_and_a_rare_one(spark):
    texts = [(i, f"common words number {i} stand here", f"l{i % 2500}", None, None, "x", 7) for i in range(5000)]
    texts += [(10_000 + i, "äöü ßßß çéè ñandú", "rare", None, None, "x", 7) for i in range(4)]
    from test_llm_operators import DOCS

    docs = spark.createDataFrame(texts, DOCS + ", _text string, size int")
    few = docs.filter("lang in ('l1', 'l2', 'l3', 'l4', 'l5', 'l6', 'l7', 'rare')")
    model = language.fit_language_model(few, dims=256)
    assert "rare" in model.languages
    assert {r["lang_pred"] for r in rows(language.identify(docs.filter("lang = 'rare'"), model))} == {"rare"}
    wide = language.fit_language_model(docs, dims=64, max_languages=300)
    assert 250 <= len(wide.languages) <= 300
    assert {r["lang_pred"] for r in rows(language.identify(docs.limit(50), wide))} <= set(wide.languages)


# --- op4 -------------------------------------------------------------------------
def test_passages_of_the_fit_are_bounded(spark):
    assert quality.even_level([(10, 3), (2, 5)], 28) == 6 and quality.even_level([(10, 3)], 1) == 1 and quality.even_level([], 5) == 1
    x = np.arange(1000)[:, None]
    assert quality.spaced(x, 5)[:, 0].tolist() == [0, 250, 500, 749, 999] and len(quality.spaced(x, 2000)) == 1000
    docs = docs_of(spark, [(i, ("plain words here " if i % 2 else "BAD!! ###$ xx ") * (40_000 if i < 4 else 5)) for i in range(80)])
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    sizes = []
    fit, quality.train = quality.train, lambda x, *a, **k: sizes.append(len(x)) or fit(x, *a, **k)
    try:
        model = quality.fit_quality_model(docs, labels, max_passages=500)
    finally:
        quality.train = fit
    assert sizes[0] <= 500
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 2 == 1) for r in rows(quality.score_quality(docs, model)))


# --- rows that have no order -----------------------------------------------------
def test_repeated_rows_with_a_map(spark):
    docs = docs_of(spark, [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (3, "z")]).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    kept = rows(simhash.one_per_group(docs))
    assert sorted((r["doc_id"], r["m"]["k"]) for r in kept) == [(1, 1), (3, 3)] and set(kept[0]) == set(docs.columns)
    chosen = docs.select(F.col("doc_id").alias("_id"), common.text_key().alias("_text"), F.lit(2).alias("copies")).distinct()
    assert sorted((r["doc_id"], r["copies"]) for r in rows(common.keep_chosen(docs, chosen))) == [(1, 2), (2, 2), (3, 2)]


# --- op10 ------------------------------------------------------------------------
@pytest.mark.parametrize("piece", [decontaminate.PIECE_WINDOWS, 3])
def test_several_automata_give_what_one_gives(spark, monkeypatch, piece):
    monkeypatch.setattr(decontaminate, "PIECE_WINDOWS", piece)
    rng = np.random.default_rng(11)
    text = lambda n: " ".join(rng.choice(list("abc"), n))
    items = [(i, text(int(rng.integers(0, 14)))) for i in range(60)] + [(60, None), (None, "a A b"), (61, text(4000))]
    docs = docs_of(spark, [(i, text(int(rng.integers(0, 60)))) for i in range(150)] + [(200, items[62][1]), (200, items[62][1]), *AWKWARD])
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    plain = lambda df: sorted(map(repr, rows(df)))
    one = plain(decontaminate.find_contamination(docs, benchmark, 4))
    assert len(list(decontaminate.benchmark_parts(benchmark, 4, 3000))) > 2
    assert plain(decontaminate.find_contamination(docs, benchmark, 4, 3000)) == one
    # by brute force
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    keys = {}
    for i, t in items:
        w = words(t)
        for k in [tuple(w)] if 0 < len(w) < 4 else [tuple(w[j : j + 4]) for j in range(len(w) - 3)]:
            keys.setdefault(k, set()).add("" if i is None else str(i))
    for r, d in zip(rows(decontaminate.find_contamination(docs, benchmark, 4, 3000).orderBy("doc_id", "n_words", "n_hit")), rows(docs.orderBy("doc_id", F.length("text")))):
        if r["doc_id"] is None or r["doc_id"] in (1, 2, 3, 4, 5, 6, 7):  # ids of both kinds of rows
            continue
        w = words(d["text"])
        at = [(j, k) for n in (1, 2, 3, 4) for j in range(len(w) - n + 1) for k in [tuple(w[j : j + n])] if k in keys]
        hit = {x for j, k in at for x in range(j, j + len(k))}
        assert (r["n_words"], r["n_hit"], set(r["items"])) == (len(w), len(hit), {i for _, k in at for i in keys[k]})
    assert plain(decontaminate.clean(docs, benchmark, 4, 3000)) == plain(decontaminate.clean(docs, benchmark, 4))
