"""Ranked search, licence scan and periodic runs against brute force, and on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from movrec.llm import licenses, periodic, ranked_search
from movrec.llm.queries import QUERIES, planted_runs
from test_llm_operators import AWKWARD, docs_of
from test_llm_queries import lower, rows, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


# --- ranked search -------------------------------------------------------------------
def search_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))


def brute_search(docs, items, top=10):
    held = [(d, Counter(search_terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    count, total = len(held), sum(n for _, _, n in held)
    out = []
    for item, text in items:
        scores = []
        weights = {}
        for term in set(search_terms(text)):
            df = sum(term in c for _, c, _ in held)
            weights[term] = math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1)))
        for d, c, n in held:
            m = 100 - 90 + (90 * n * count) // total
            s = sum(w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, w in weights.items() if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scores)[:top])]
    return out


def ranked(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows(df))


@pytest.mark.parametrize("block, top, max_terms", [(3, 2, 10_000), (7, 10, 20), (1, 1, 10_000), (500, 10, 10_000)])
def test_search_equals_brute_force_in_any_blocks(spark, block, top, max_terms):
    rnd = random.Random(block)
    vocabulary = ["Alpha", "beta", "gamma", "delta", "é", "x1", "zeta", "eta", "theta", "iota"]
    text = lambda: " ".join(rnd.choices(vocabulary, weights=range(1, 11), k=rnd.randrange(1, 12)))
    docs = [(i, text()) for i in range(60)] + [(i, "beta gamma delta") for i in range(60, 80)] + [(5, "beta"), (5, "beta"), (None, "beta gamma")]
    items = [(i, text()) for i in range(8)] + [(8, "nothing here"), (9, None), (None, "theta iota"), (10, "beta gamma delta")]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    got = ranked(ranked_search.rank_documents(docs_of(spark, docs), frame, top, max_terms, block_docs=block))
    assert got == Counter(brute_search(docs, items, top))


def test_search_awkward_rows(spark):
    items = spark.createDataFrame([(1, "same text b c"), (1, "same text b c"), (2, "")], "item_id bigint, text string")
    got = ranked(ranked_search.rank_documents(docs_of(spark, AWKWARD), items))
    assert got == Counter(brute_search(AWKWARD, [(1, "same text b c")]))
    assert rows(ranked_search.rank_documents(docs_of(spark, []), items)) == []
    assert rows(ranked_search.rank_documents(docs_of(spark, AWKWARD), items.limit(0))) == []
    long = [(1, "word " * 300_000 + "rare"), (2, "rare word"), (3, "word")]
    wanted = [(7, "rare word")]
    got = ranked(ranked_search.rank_documents(docs_of(spark, long), spark.createDataFrame(wanted, "item_id bigint, text string")))
    assert got == Counter(brute_search(long, wanted))


def test_pair_bounds_are_tighter_than_single_ones_and_skip(spark):
    """Two terms that peak in different documents: the pair's bound is below the sum, so its documents are never candidates."""
    docs = [(1, "a a a a"), (2, "b b b b"), (3, "a b " + "c " * 30), (4, "q"), (5, "q r")]
    queries = ranked_search.Queries([(0, b"a b q")])
    blocks = ranked_search.postings(docs_of(spark, docs).coalesce(1), queries.numbers)
    n, length, df = ranked_search.corpus_counts(blocks, len(queries.numbers))
    batch = ranked_search.build_index(blocks, queries, n, length, queries.weigh(n, df)).toArrow().to_batches()[0]
    block = ranked_search.Block(batch, 0, len(queries.numbers))
    pairs = [(p, a, b) for (a, b), p in queries.pairs.items()]
    (bound, terms, pair), = [u for u in block.units(queries.terms[0], pairs) if u[2]]
    single = [int(block.best[block.here[t]]) for t in terms]
    assert max(single) <= bound < sum(single)
    both, _ = block.best_documents([(bound, terms, pair)], 10, sum(single))
    assert len(both) == 0


# --- licences -------------------------------------------------------------------------
def brute_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    hits = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    places = [i for i, _ in hits]
    return len(w), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits}))


def test_license_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    found = 0
    got = {r["doc_id"]: r for r in rows(QUERIES["op12_license_scan"](spark, sf))}
    for d, text in duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall():
        r = got.pop(d)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(text)
        labels = r["labels"].split(",") if r["labels"] else []
        assert set(filter(None, r["base_labels"].split(","))) <= set(labels) and labels == sorted(set(labels))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(labels)
        found += r["n_base"]
    assert not got and found > 20


@pytest.mark.parametrize(
    "text, labels, score",
    [
        ("SPDX-License-Identifier: MIT", "mit", 0.95),
        ("// spdx-license-identifier: (GPL-2.0-only OR MIT) AND Zlib\nOR agpl-3.0", "gpl,gpl-2.0-only,mit,zlib", 0.95),
        ("SPDX-License-Identifier: MIT OR Apache-2.0 AND GPL-3.0", "apache,apache-2.0,gpl,gpl-3.0,mit", 0.95),
        ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-3.0", "apache,apache-2.0,gpl,gpl-3.0,mit", 0.4),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "gpl,gpl-2.0-only with classpath-exception-2.0", 0.7),
        ("SPDX-License-Identifier: LicenseRef-Own", "licenseref-own", 0.5),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc,cc-by-nc-4.0", 0.2),
        ("Released under the terms of either the MIT License or the GNU General Public License, version 2 or later.", "gpl,gpl-2-or-later,mit", 0.95),
        ("licensed under ((MIT and", "mit", 0.95),
        ("licensed under ) MIT", "", 0.0),
        ("licensed under a rock", "", 0.0),
        ("SPDX-License-Identifier:\nMIT", "", 0.0),
        ("the mit, gpl and apache people", "", 0.0),
        ("All rights reserved. MIT License", "mit,proprietary", 0.05),
    ],
)
def test_license_expressions(text, labels, score):
    _, places, statements = licenses.Scanner().scan(text.encode())
    got, value = licenses.judge(places, statements)
    assert ",".join(got) == labels and value == pytest.approx(score)


def test_shunting_yard_equals_recursive_descent():
    rnd = random.Random(4)
    names = ["mit", "gpl-2.0", "agpl-3.0", "cc-by-4.0", "own"]

    def expression(depth):
        """Tokens and openness of a random expression, by the grammar's own rules."""
        if depth == 0 or rnd.random() < 0.3:
            name = rnd.choice(names)
            value = licenses.openness(name)
            if rnd.random() < 0.3:
                return [name, "with", "own"], value + (1 - value) / 2
            return [name], value
        kind = rnd.choice(["or", "and"])
        parts = [expression(depth - 1) for _ in range(rnd.randrange(2, 4))]
        tokens = []
        for t, _ in parts:
            tokens += ([kind] if tokens else []) + (["(", *t, ")"] if len(t) > 1 else t)
        return tokens, (max if kind == "or" else min)(v for _, v in parts)

    for _ in range(300):
        tokens, value = expression(3)
        text = ("spdx license identifier " + " ".join(tokens)).encode()
        (statement,) = licenses.Scanner().scan(text)[2]
        assert statement["openness"] == pytest.approx(value)
        assert not licenses.to_postfix([]) and licenses.evaluate([]) is None


def test_license_awkward_and_long_texts(spark):
    texts = AWKWARD + [(20, "mit license " * 100_000), (21, "licensed under " + "(" * 50_000 + "mit" + ")" * 50_000), (22, "licensed under mit" + " or gpl" * 50_000)]
    got = rows(licenses.scan_licenses(docs_of(spark, texts)))
    assert len(got) == len(texts) and set(got[0]) == {"doc_id", "n_words", "places", "statements", "labels", "score"}
    by = {r["doc_id"]: r for r in got}
    assert len(by[20]["places"]) == 100_000 and by[20]["score"] == 0.95
    assert by[21]["labels"] == ["mit"] and by[22]["labels"] == ["gpl", "mit"] and by[22]["score"] == 0.95
    assert by[1]["n_words"] == 0 and by[1]["labels"] == [] and by[1]["score"] == 0
    assert rows(licenses.scan_licenses(docs_of(spark, []))) == []


# --- periodic runs --------------------------------------------------------------------
def brute_runs(w):
    out = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def brute_planted(doc_id, text):
    w = words(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_runs_query_equals_brute_force(spark, documents):
    got = {r["doc_id"]: r for r in rows(QUERIES["op13_periodic_runs"](spark, SF))}
    some = 0
    for d, text in documents:
        w = brute_planted(d, text)
        runs = brute_runs(w)
        r = got.pop(d)
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *want)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        drop = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest()
        some += len(runs)
    assert not got and some > 5


def test_planted_texts(spark, documents):
    got = {r["doc_id"]: words(r["text"] or "") for r in rows(planted_runs(docs_of(spark, documents)))}
    assert got == {d: brute_planted(d, t) for d, t in documents}


def test_runs_of_random_words_equal_brute_force():
    rnd = random.Random(1)
    total = 0
    for _ in range(200):
        docs = []
        for _ in range(rnd.randrange(1, 5)):
            n, k = rnd.choice([0, 5, 24, 30, 80, 200]), rnd.choice([1, 2, 2, 3, 30])
            w = [rnd.randrange(k) for _ in range(n)]
            for _ in range(rnd.randrange(4) if n >= 30 else 0):
                p, a = rnd.randrange(1, n // 4), rnd.randrange(n)
                for i in range(a + p, rnd.randrange(a, n)):
                    w[i] = w[i - p]
            docs.append([b"%d" % x for x in w])
        for w, found in zip(docs, periodic.word_runs(docs)):
            assert found == brute_runs(w)
            total += len(found)
    assert total > 50


@pytest.mark.parametrize("name", ["fibonacci", "thue-morse"])
def test_runs_of_words_that_mislead_hashes(name):
    """Polynomial hashes modulo 2**64 collide on Thue-Morse words; the runs are compared word by word."""
    a, b = [0], [0, 1]
    while len(b) < 2500:
        a, b = b, (b + a if name == "fibonacci" else b + [1 - x for x in b])
    w = [b"%d" % x for x in b] + [b"7"] * 30 + [b"%d" % x for x in b[:1200]]
    assert periodic.word_runs([w])[0] == brute_runs(w)


def test_runs_awkward_and_long_texts(spark):
    texts = AWKWARD + [(20, "a b c " * 60_000), (21, " ".join(f"w{i % 5000}" for i in range(40_000))), (22, "z " * 24 + "y"), (23, "z " * 23 + "y")]
    got = rows(periodic.find_runs(docs_of(spark, texts)))
    assert len(got) == len(texts) and set(got[0]) == {"doc_id", "n_words", "runs", "collapsed"}
    by = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in got}
    assert by[20] == [(0, 180_000, 3)] and by[21] == [(0, 40_000, 5000)] and by[22] == [(0, 24, 1)] and by[23] == []
    short = {r["doc_id"]: r["collapsed"] for r in got}
    assert short[20] == "a b c" and short[22] == "z y" and short[1] == "" and short[7].split() == words(AWKWARD[-1][1])
    assert rows(periodic.find_runs(docs_of(spark, []))) == []


def test_repair_rounds_never_overlap():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        at = np.flatnonzero(rnd.random(60) < 0.8)
        number = rnd.integers(0, 4, len(at))
        won = at[periodic.Grammar._disjoint(at, number)]
        assert (np.diff(won) > 1).all()
        lost = [p for p, r in zip(at, number) if r and p not in won]
        assert all(p - 1 in won or p + 1 in won for p in lost)
