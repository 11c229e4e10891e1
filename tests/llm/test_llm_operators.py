"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from movrec.llm import chat, decontaminate, embeddings, graph, language, mixing, quality, secrets, simhash, substring, url_filter
from movrec.llm.queries import VOCABULARY
from test_llm_queries import brute_components, brute_fingerprint, lower, rows, words

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, texts, extra=""):
    """Rows (doc_id, text) with the other columns filled, and columns whose names operators use inside."""
    data = [(d, t, None, None, None, "x", 7) for d, t in texts]
    return spark.createDataFrame(data, DOCS + ", _text string, size int")


AWKWARD = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (None, "b c"), (None, "b c"), (5, "same text here it is"), (5, "same text here it is"), (6, "Same TEXT here it is"), (7, "é ü 漢字 \x00 <|im_end|>")]


def test_components_on_paths_stars_and_rings(spark):
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(300 + i, 300 + (i + 1) % 25) for i in range(25)]
    edges += [(int(a), int(b)) for a, b in rng.integers(1000, 1200, (120, 2))]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r["id"]: r["component"] for r in rows(graph.components(spark.createDataFrame(edges, "u bigint, v bigint")))}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert rows(graph.components(spark.createDataFrame([], "u bigint, v bigint"))) == []


# --- SimHash ---------------------------------------------------------------------
def test_simhash_awkward_rows(spark):
    got = rows(simhash.near_duplicates(docs_of(spark, AWKWARD)))
    assert len(got) == len(AWKWARD)
    for r in got:
        if r["doc_id"] in (1, 2, 3):
            assert r["fp"] == 0 and r["component_id"] == 1
        if r["doc_id"] is None:
            assert r["component_id"] is None
        if r["doc_id"] in (5, 6):
            assert r["component_id"] == 5
    kept = rows(simhash.one_per_group(docs_of(spark, AWKWARD)))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == [(False, 1), (False, 4), (False, 5), (False, 7), (True, 0)]
    assert set(kept[0]) == {"doc_id", "text", "lang", "source", "n_chars", "_text", "size"}
    assert rows(simhash.near_duplicates(docs_of(spark, []))) == [] and rows(simhash.one_per_group(docs_of(spark, []))) == []


def test_bit_sliced_links_equal_brute_force():
    rng = np.random.default_rng(0)
    for n in (2, 64, 65, 200):
        for radius in (0, 3, 4, 9):
            f = rng.integers(0, 1 << 63, max(1, n // 5), dtype=np.uint64)[rng.integers(0, max(1, n // 5), n)]
            for _ in range(radius + 2):
                f = f ^ np.where(rng.random(n) < 0.6, np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64), np.uint64(0))
            side = rng.integers(0, 2, n)
            for s in (None, side):
                a, b = simhash.sliced_links(f, radius, s, rows=50)
                want = {(i, j) for i in range(n) for j in range(i + 1, n) if (int(f[i]) ^ int(f[j])).bit_count() <= radius and (s is None or s[i] != s[j])}
                assert set(zip(a.tolist(), b.tolist())) == want


def test_simhash_blocks_of_a_large_band_value(spark):
    """Blocks of four fingerprints: every pair still meets."""
    rng = np.random.default_rng(1)
    prints = sorted({int(x) for x in (np.uint64(0xABCD) | (np.uint64(1) << rng.integers(16, 63, 60, dtype=np.uint64)))} | {0xABCD, 0xABCD | 0xFFFF << 40})
    want = brute_components({x: x for x in prints})
    for pieces in (None, 5, 6, 7):
        edges = simhash.near_links(spark.createDataFrame([(x,) for x in prints], "fp bigint"), block=4, pieces=pieces)
        got = {r["id"]: r["component"] for r in rows(graph.components(edges))}
        assert {x: got.get(x, x) for x in prints} == want


def test_longer_keys_lose_no_pair():
    rng = np.random.default_rng(7)
    for pieces in (5, 6, 7, 8):
        masks = simhash.band_masks(4, pieces)
        assert len(masks) == {5: 5, 6: 15, 7: 35, 8: 70}[pieces]
        for _ in range(200):
            flips = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(flips & m == 0 for m in masks)
    assert [simhash.pieces_for(n, 4, 4096) for n in (0, 10**6, 10**8, 10**11)] == [5, 5, 6, 7]


def test_fingerprint_of_long_text(spark):
    text = " ".join(f"W{i % 997}x{i % 13}" for i in range(60000))
    r = rows(simhash.near_duplicates(docs_of(spark, [(1, text), (2, "x")])))
    assert {x["fp"] & (1 << 64) - 1 for x in r if x["doc_id"] == 1} == {brute_fingerprint(text)}


# --- substring -------------------------------------------------------------------
def brute_substring(texts, length):
    seen, out = {}, {}
    windows = {}
    for d, t in sorted(texts):
        w = words(t or "")
        windows[d] = w
        for i in range(len(w) - length + 1):
            seen.setdefault(tuple(w[i : i + length]), (d, i))
    for d, w in windows.items():
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] != (d, i):
                gone |= set(range(i, i + length))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("length,seed", [(20, 8), (6, 3), (5, 5), (3, 1)])
def test_substring_equals_brute_force(spark, length, seed):
    rng = np.random.default_rng(length)
    vocabulary = ["a", "b", "c", "dé", "E"]
    base = [" ".join(rng.choice(vocabulary, 40)) for _ in range(4)]
    texts = []
    for d in range(40):
        t = " ".join(rng.choice(vocabulary, rng.integers(0, 60)))
        if d % 2:
            t += "  " + base[d % 4] + "\n" + " ".join(rng.choice(vocabulary, 5))
        texts.append((d, t if d else None))
    texts += [(90, "a " * 100), (91, "a " * 35), (92, base[0]), (93, base[0])]
    for crowded in (substring.CROWDED, 1):  # also with every anchor of two reaches in a task sent past the grouping
        found = rows(substring.remove_repeats(docs_of(spark, texts).repartition(3), length, seed, crowded))
        assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in found} == brute_substring(texts, length)


def test_substring_awkward_rows(spark, monkeypatch):
    got = rows(substring.remove_repeats(docs_of(spark, AWKWARD), 3, 2))
    assert len(got) == len(AWKWARD)
    assert all(r["n_removed"] == 0 for r in got if r["doc_id"] == 5)  # equal rows are one document
    assert rows(substring.remove_repeats(docs_of(spark, []), 3, 2)) == []
    with pytest.raises(ValueError):
        substring.remove_repeats(docs_of(spark, []), 3, 4)


def test_substring_stream_carries_one_row():
    """Groups cut anywhere between batches give the same findings."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    cols = [rng.integers(0, 4, 60), rng.integers(0, 3, 60), rng.integers(0, 9, 60), rng.integers(0, 5, 60)]
    order = np.lexsort(cols[::-1])
    table = pa.table([pa.array(c[order]) for c in cols] + [pa.array(np.ones(60, np.int32)), pa.array(np.zeros(60, np.int32))], ["ah", "rh", "id", "loc", "windows", "state"])
    found = []
    for size in (60, 7, 1):
        out = [r for b in substring._classify(True)(table.to_batches(max_chunksize=size)) for r in b.to_pylist()]
        found.append(sorted((r["kind"], r["id"], r["loc"]) for r in out))
    assert found[0] == found[1] == found[2] and found[0]


# --- decontamination -------------------------------------------------------------
def test_decontamination_offsets_and_short_items(spark):
    items = spark.createDataFrame(
        [(1, "One two three four five six seven eight nine ten eleven"), (2, "Short ITEM"), (2, "Short ITEM"), (None, "null id item"), (4, None), (5, "...")],
        "item_id int, text string",
    )
    texts = [(1, "Ünd one, TWO three four five six seven\neight nine ten! x"), (2, "short  item"), (3, "null-id item short"), (4, None), (5, ""), (6, "one two three four five six seven eight nine")]
    got = {r["doc_id"]: r for r in rows(decontaminate.find_contamination(docs_of(spark, texts), items))}
    assert got[1]["n_hit"] == 10 and got[1]["items"] == ["1"]
    span = got[1]["spans"][0]
    assert texts[0][1][span["start"] : span["end"]] == "one, TWO three four five six seven\neight nine ten"
    assert got[2]["items"] == ["2"] and got[3]["items"] == [""] and got[3]["n_hit"] == 3
    assert [got[d]["n_hit"] for d in (4, 5, 6)] == [0, 0, 0]
    assert sorted(r["doc_id"] for r in rows(decontaminate.clean(docs_of(spark, texts), items))) == [4, 5, 6]
    none = items.limit(0)
    assert len(rows(decontaminate.clean(docs_of(spark, AWKWARD), none))) == len(AWKWARD)
    # beyond the size of one automaton the results are the same
    assert {r["doc_id"]: r for r in rows(decontaminate.find_contamination(docs_of(spark, texts), items, max_chars=30))} == got


# --- secrets ---------------------------------------------------------------------
def test_secret_literals_through_constants():
    text = 'K = "s3cr3tV4lue-xyz"\ndb_password = K\nhost = "plain-Host-77"\n{"clientSecret": "abcD1234efgh"}\nexport AUTH_TOKEN=zzTop998877\n<dbPassword>pa55W0rd!x</dbPassword>\npassword: ${ENV}'
    found = [text[a:b] for k, a, b in secrets.find_spans(text) if k == "literal"]
    assert found == ["s3cr3tV4lue-xyz", "abcD1234efgh", "zzTop998877", "pa55W0rd!x"]
    clean = "The meeting: tomorrow. Results = good, and the note said it was fine. max_tokens = 4096"
    assert secrets.find_spans(clean) == []
    assert secrets.redact(None) is None and secrets.redact("") == "" and secrets.redact(clean) == clean
    masked = secrets.redact(text)
    assert "s3cr3tV4lue" not in masked and "plain-Host-77" in masked and "pa55W0rd" not in masked
    ring = "\n".join(f"a{i} = a{(i + 1) % 5000}" for i in range(5000)) + "\npassword = a0"
    assert isinstance(secrets.find_spans(ring), list)


@pytest.mark.parametrize("name", ["signing_key", "signingKey", "client_key", "api-key", "api.key", "access-key", "access.key", "salt", "to_ken", "private1key"])
def test_every_scored_name_is_lexed(name):
    value = "sK9xQ2mZ7vB4nL1pW8cT5rY3dF6gH0jA"
    for text in (f'{name}: "{value}"', f"export {name}='{value}'", f"run --{name} {value}", f"<{name}>{value}</{name}>"):
        spans = secrets.find_spans(text)
        assert spans == sorted(secrets.base_spans(text) + secrets.literal_spans(text), key=lambda x: (x[1], secrets.KINDS.index(x[0]), x[2]))
        assert secrets.name_score(name) < 0.5 or [text[a:b] for k, a, b in spans if k == "literal"] == [value]


def test_secret_rows(spark):
    texts = AWKWARD + [(20, 'é token = "abcdef0123456789abcdef0123456789"')]
    got = rows(secrets.scan_secrets(docs_of(spark, texts)))
    assert len(got) == len(texts) and [len(r["spans"]) for r in got[:-1]] == [0] * len(AWKWARD)
    assert [(s["kind"], s["start"]) for s in got[-1]["spans"]] == [("assign", 2), ("hex", 11), ("literal", 11)]
    out = rows(secrets.redact_documents(docs_of(spark, texts)))
    assert out[-1]["text"] == "é " + secrets.MASK + '"' and out[-1]["n_chars"] == len(out[-1]["text"])
    assert [r["text"] for r in out[:-1]] == [t for _, t in AWKWARD]


# --- mixing ----------------------------------------------------------------------
def test_mixing_targets_water_fill(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1000), (None, 50), ("z", 0)], "source string, size bigint")
    got = {r["source"]: r for r in rows(mixing.source_targets(sizes))}
    assert [got[s]["weight"] for s in ("a", "b", "c", "z", None)] == [1, 2, 3, 1, 2]
    assert got["b"]["target"] == 30 and got[None]["target"] == 150 and got["z"]["target"] == 0
    assert got["a"]["target"] == pytest.approx(245) and got["c"]["target"] == pytest.approx(735)
    assert rows(mixing.source_targets(sizes.limit(0))) == []


def test_mixing_awkward_rows(spark):
    got = rows(mixing.mix(docs_of(spark, AWKWARD)))
    assert len(got) == len(AWKWARD)
    assert all(r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3 for r in got)
    assert {r["size"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert rows(mixing.mix(docs_of(spark, []))) == []


# --- url filter ------------------------------------------------------------------
def test_cascade_is_exact_over_its_universe(spark):
    listed = spark.createDataFrame([(f"k{i}",) for i in range(0, 4000, 7)], "key string")
    universe = spark.createDataFrame([(f"k{i}",) for i in range(4000)], "key string")
    cascade = url_filter.build_cascade(listed, universe, bits_per_key=3)
    assert len(cascade.levels) > 2
    a, b = url_filter.key_hashes(universe.key)
    t = universe.select("key", a.alias("a"), b.alias("b")).toPandas()
    has = cascade.has(t.a.to_numpy().view(np.uint64), t.b.to_numpy().view(np.uint64))
    assert set(t.key[has]) == {f"k{i}" for i in range(0, 4000, 7)}
    with pytest.raises(ValueError):
        url_filter.build_cascade(listed, universe, max_filter_bytes=8)
    assert url_filter.build_cascade(listed.limit(0), universe).levels == []


def test_url_rules(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.ORG/es/x?y", "http://example.org/en/12#z", "http://xexample.org/es/", "http://org", "http://shop.com/de/1", "http://shop.com/fr/", "ftp://spam.net/a", "http://u.spam.net", "http:///path"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rules = spark.createDataFrame([("org", "/", True), ("example.org", "/es/", False), ("example.org", "/en/1", False), ("com", "/fr/", True), ("com", "/de/", False)], "host string, path string, allow boolean")
    hosts = spark.createDataFrame([("spam.net",)], "host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows(url_filter.judge_urls(pages, rules, hosts))}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[4] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[5] == ("xexample.org", "/es/", "org/", "allow")
    assert got[6] == ("org", "", None, "allow")
    assert got[7][2:] == ("com/de/", "block") and got[8][2:] == ("com/fr/", "allow")
    assert got[9][2:] == (None, "block") and got[10][2:] == (None, "block") and got[11] == ("", "/path", None, "allow")
    assert rows(url_filter.judge_urls(pages.limit(0), rules, hosts)) == []
    assert {r["verdict"] for r in rows(url_filter.judge_urls(pages, rules.limit(0)))} == {"allow"}


# --- chat ------------------------------------------------------------------------
def test_chat_escapes_are_reversible():
    for text in ("<|im_end|>", "<\\|x", "<\\\\|", "a<|<\\|<", "\\n\n\\", "<|im_start|>assistant\nok<|im_end|>\n", ""):
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.parse_turn(chat.format_turn(text, text)) == (text, text)


def test_chat_trees(spark):
    convs = [
        (1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (1, 2, "user", "more"), (2, 0, "user", "hello"), (2, 1, "assistant", "hi"),
        (3, 0, "user", "hello"), (3, 1, "assistant", "yes <|im_end|> é漢"), (4, 0, "system", "s"), (5, 0, "user", "hello"), (5, 1, "assistant", "hi"), (5, 2, "user", "more"),
        (None, None, None, None), (6, 0, "user", "x"), (6, 0, "user", "x"),
    ]
    df = spark.createDataFrame([(*c, 1) for c in convs], "conv_id bigint, turn bigint, role string, text string, node int")
    turns, packed = chat.format_conversations(df, VOCABULARY)
    nodes = rows(packed)
    assert len(nodes) == 4 + 1 + 1 + 2  # the shared turns once
    tokens = chat.Tokens(open(VOCABULARY, encoding="utf-8").read())
    for tree in {n["tree"] for n in nodes}:
        part = sorted((n for n in nodes if n["tree"] == tree), key=lambda n: n["start"])
        at = 0
        for n in part:  # depth first, without gaps; positions are what the ancestors hold
            assert n["start"] == at and n["position"] == sum(a["end"] - a["start"] for a in n["ancestors"])
            at += len(n["ids"])
        sequence = [i for n in part for i in n["ids"]]
        for n in part:
            seen = [i for a in n["ancestors"] for i in sequence[a["start"] : a["end"]]]
            turns_of = [chat.parse_turn(x + "<|im_end|>\n") for x in tokens.text(seen + list(n["ids"])).split("<|im_end|>\n")[:-1]]
            assert len(turns_of) == n["depth"] + 1
    got = {r["conv_id"]: r for r in rows(chat.read_back(turns, packed, VOCABULARY))}
    assert got[3]["loss_chars"] == len("yes <|im_end|> é漢") and got[None]["n_turns"] == 1 and got[6]["n_turns"] == 2
    assert got[1]["turns_sha256"] == got[5]["turns_sha256"]
    empty, none = chat.format_conversations(df.limit(0), VOCABULARY)
    assert rows(chat.read_back(empty, none, VOCABULARY)) == []


def test_chat_long_conversations_and_texts(spark):
    n = 20_000
    whole = spark.range(n).selectExpr("1L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('t', id) text")
    branch = whole.filter("turn < 15000").selectExpr("2L conv_id", "turn", "role", "if(turn = 14999, 'other', text) text")
    long = spark.createDataFrame([(3, 0, "assistant", "word " * 400_000)], whole.schema)
    turns, packed = chat.format_conversations(whole.union(branch).union(long), VOCABULARY)
    assert packed.count() == n + 1 + 1
    deepest = packed.orderBy(F.desc("depth")).first()
    # the chain's intervals are merged: one, or two where the branch lies between
    assert deepest["depth"] == n - 1 and len(deepest["ancestors"]) <= 2 and sum(a["end"] - a["start"] for a in deepest["ancestors"]) == deepest["position"]
    got = {r["conv_id"]: r for r in rows(chat.read_back(turns, packed, VOCABULARY))}
    learned = "".join(f"t{i}" for i in range(1, n, 2))
    assert got[1]["n_turns"] == n and got[1]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    assert got[2]["n_turns"] == 15_000 and got[2]["loss_chars"] == sum(len(f"t{i}") for i in range(1, 14_999, 2)) + len("other")
    assert got[3]["loss_chars"] == 2_000_000


# --- embeddings ------------------------------------------------------------------
def test_embeddings_awkward_rows(spark):
    nan = float("nan")
    data = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [0.0, 0.0], 1), (5, None, 1), (6, [nan, 1.0], 1), (7, [None, 1.0], 1), (8, [1.0, 0.0], None), (9, [], 1), (10, [1.0, 0.1], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    df = spark.createDataFrame([(*d, "x") for d in data], "vec_id bigint, embedding array<float>, label int, id string")
    got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in rows(embeddings.near_duplicates(df))]
    assert len(got) == len(data)
    assert [r for r in got if r[0] in (1, 2, 10)].count((2, 3, 1, False)) == 2
    assert (1, 3, 1, True) in got and (10, 3, 1, False) in got
    assert all(r[1:] == (0, r[0], True) for r in got if r[0] not in (1, 2, 10))
    assert rows(embeddings.near_duplicates(df.limit(0))) == []


def test_embeddings_dense_and_sparse_groups(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 16))
    x[100:220] = x[0] + rng.normal(scale=0.02, size=(120, 16))
    x[300:306] = x[1] + rng.normal(scale=0.25, size=(6, 16))
    labels = [i % 2 if i >= 306 else 0 for i in range(600)]
    df = spark.createDataFrame([(i, [float(v) for v in r], labels[i]) for i, r in enumerate(x)], "vec_id bigint, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    np.fill_diagonal(near, False)
    got = {r["vec_id"]: r["n_links"] for r in rows(embeddings.near_duplicates(df))}
    assert [got[i] for i in range(600)] == near.sum(axis=1).tolist()


def test_embeddings_tight_clusters_linked_across(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(280, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = x[1] - (x[1] @ x[0]) * x[0]
    centre = 0.965 * x[0] + np.sqrt(1 - 0.965**2) * side / np.linalg.norm(side)
    x[40:80] = centre * np.sqrt(0.98) + x[40:80] * np.sqrt(0.02)
    x[:40] = x[0] * np.sqrt(0.98) + x[80:120] * np.sqrt(0.02)
    df = spark.createDataFrame([(i, [float(v) for v in r], 0) for i, r in enumerate(x)], "vec_id bigint, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.93
    assert near[:40, 40:80].sum() > 400 and not near[:80, 80:].any()
    np.fill_diagonal(near, False)
    got = {r["vec_id"]: r for r in rows(embeddings.near_duplicates(df))}
    assert [got[i]["n_links"] for i in range(280)] == near.sum(axis=1).tolist()
    assert [got[i]["component_id"] for i in range(80)] == [0] * 80


def isolated_pairs(spark, n, pairs):
    """``n`` nodes of one label; node ``i`` below ``pairs`` is linked to ``pairs + i`` at 0.935 and to no other."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = x[pairs : 2 * pairs] - (x[pairs : 2 * pairs] * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    x[pairs : 2 * pairs] = 0.935 * x[:pairs] + np.sqrt(1 - 0.935**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    rows_ = [(i, 0, 512, bytearray(r.astype("<f8").tobytes())) for i, r in enumerate(x)]
    return spark.createDataFrame(rows_, "id bigint, label int, size int, v binary")


def test_embeddings_orders_follow_the_rows_of_a_label(spark):
    nodes = isolated_pairs(spark, 4000, 400)
    found = {(r["u"], r["v"]) for r in embeddings.first_graph(nodes, False, block=8).collect()}
    assert sum((i, 400 + i) in found for i in range(400)) >= 392


def test_embeddings_audit_sees_rare_links_and_is_binding(spark):
    nodes = isolated_pairs(spark, 4000, 20)
    none = spark.createDataFrame([], "u bigint, v bigint, sim double")
    placed = nodes.selectExpr("*", "cast(null as bigint) dense")
    assert embeddings.audit(placed, none, False, 0.93) == 0
    # passes of 50 nodes, going on past the stated query set until 20 pairs are seen from both sides
    pairs = spark.createDataFrame([(i, 20 + i, 1.0) for i in range(20)], "u bigint, v bigint, sim double")
    assert embeddings.audit(placed.filter("id < 400"), pairs, False, 0.93, batch=50) == 1
    assert embeddings.audit(placed.filter("id < 400"), pairs.filter("u < 10"), False, 0.93, batch=50) == 0.5
    # few links, and no leave to look further than some nodes: unmeasured, unless the graph has none either
    with pytest.raises(RuntimeError, match="unmeasured"):
        embeddings.audit(placed, pairs, False, 0.93, batch=50, most=50)
    assert embeddings.audit(placed.filter("id >= 40"), none, False, 0.93, batch=50, most=50) == 1
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1)], "vec_id bigint, embedding array<double>, label int")
    with pytest.raises(RuntimeError, match="audited links"):
        embeddings.near_duplicates(df, rounds=1, most_rounds=1, recall=1.5)


# --- classifiers -----------------------------------------------------------------
def test_quality_without_labels_and_awkward_rows(spark):
    labels = spark.createDataFrame([(1, None, 0)], "doc_id bigint, quality int, toxic int")
    docs = docs_of(spark, AWKWARD)
    model = quality.fit_quality_model(docs, labels)
    assert {r["score"] for r in rows(quality.score_quality(docs, model))} == {1.0}
    assert len(rows(quality.keep_good(docs, model))) == len(AWKWARD)
    many = docs_of(spark, [(i, ("plain words here " if i % 2 else "BAD!! BAD!! ###$ ") * (1 + i % 9)) for i in range(120)] + AWKWARD)
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(120)] + [(4, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.fit_quality_model(many, marks)
    scores = rows(quality.score_quality(many, model))
    assert len(scores) == 120 + len(AWKWARD) and all(0 <= r["score"] <= 1 for r in scores)
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 2 == 1) for r in scores[:120] if r["doc_id"] > 9)
    alone = {r["doc_id"]: r["score"] for r in rows(quality.score_quality(many.repartition(7), model)) if r["doc_id"]}
    assert all(abs(alone[r["doc_id"]] - r["score"]) < 1e-9 for r in scores[20:120])  # neighbours in a batch don't matter


def test_language_awkward_rows(spark):
    text = {"en": "the cat and the dog are here with them ", "fr": "le chat et les chiens sont dans la rue ", "de": "der hund und die katze sind nicht hier "}
    data = [(i, text[x] * (1 + i % 4), x, "s", 1) for i, x in enumerate(list(text) * 60)]
    data += [(500, None, "en", "s", 1), (501, "", "fr", "s", 1), (502, "123 !?", "de", "s", 1), (None, text["fr"], None, None, None)]
    docs = spark.createDataFrame(data, DOCS)
    model = language.fit_language_model(docs)
    assert model.languages == ["de", "en", "fr"] and model.sparsity > 0.1 and model.temperature > 0
    got = {r["doc_id"]: r for r in rows(language.identify(docs, model))}
    assert all(got[i]["lang_pred"] == x for i, _, x, _, _ in data[:180])
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert got[None]["lang_pred"] == "fr"
    nothing = language.fit_language_model(docs.limit(0))
    assert {r["lang_pred"] for r in rows(language.identify(docs, nothing))} == {"und"}


# --- pipeline --------------------------------------------------------------------
def test_pipeline_stages_on_awkward_and_empty_tables(spark, tmp_path):
    import corpus_pipeline

    labels = spark.createDataFrame([(5, 1, 0)], "doc_id bigint, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, None)], "item_id bigint, text string")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for texts in (AWKWARD, []):
        docs = docs_of(spark, texts)
        for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            assert set(docs.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
            assert len(rows(out)) <= len(texts)
            if n in (0, 2, 3):
                assert len(rows(out)) == len(texts)


def test_patterns_agree_with_their_plain_forms():
    rng = np.random.default_rng(9)
    for _ in range(300):
        t = "".join(rng.choice(list("abf09zG "), 60))
        plain = [(m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 24]
        assert [(m.start(), m.end()) for m in secrets.HEX.finditer(t)] == plain
    assert lower("ÀÉAZaz") == "ÀÉazaz"
