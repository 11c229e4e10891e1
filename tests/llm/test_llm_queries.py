"""The registered queries against SQL, and against brute force where SQL has no words for them."""

import hashlib
import math
import re
import zlib

import duckdb
import pytest
import xxhash

import corpus_pipeline
from movrec.llm.oracles import ORACLE_SQL
from movrec.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    show = lambda v: round(v, 6) if isinstance(v, float) else v
    want = sorted([tuple(show(v) for v in r) for r in cur.fetchall()], key=repr)
    got = sorted([tuple(show(r[c]) for c in names) for r in df.collect()], key=repr)
    assert got == want


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_fingerprint(text, shingle=4):
    w = words(lower(text or ""))
    if not w:
        return 0
    parts = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=4):
    """ids with their fingerprints to the least id reachable."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = list(prints)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_simhash_equals_brute_force(spark, documents):
    prints = {d: brute_fingerprint(t) for d, t, _, _ in documents}
    parts = brute_components(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(QUERIES["op5_simhash_near_dedup"](spark, SF))}
    assert got == {i: (f"{prints[i]:016x}", parts[i]) for i in prints}
    assert len(set(parts.values())) < len(parts)


def test_secret_scan_equals_base_patterns(spark, con):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in rows(QUERIES["op9_secret_scan"](spark, sf))}
    some = 0
    for d, text in con.execute(f"SELECT doc_id, coalesce(text, '') FROM '{sf}/documents.parquet'").fetchall():
        spans = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
        spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
        spans.sort(key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = got[d]
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        assert set(shown.split(",")) <= set(r["spans"].split(","))
        some += len(spans)
    assert some > 0


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_quality_on_held_out_documents(spark, con):
    got = {r["doc_id"]: r for r in rows(QUERIES["op4_quality_classifier"](spark, "/root/testdata/sf0.01"))}
    labels = con.execute("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    assert len(got) == 1000 and all(r["held_out"] == held_out(d) for d, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    test = [(got[d]["predicted"], q) for d, q in labels if held_out(d)]
    assert sum(a == b for a, b in test) / len(test) >= 0.95


def test_language_on_held_out_documents(spark, con):
    got = {r["doc_id"]: r for r in rows(QUERIES["op8_language_id"](spark, "/root/testdata/sf0.01"))}
    langs = con.execute("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    assert len(got) == len(langs)
    test = [(got[d]["lang_pred"], x) for d, x in langs if held_out(d) and x]
    assert sum(a == b for a, b in test) / len(test) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_pipeline_stages_equal_brute_force(spark, con, documents):
    from movrec.llm import decontaminate, quality, secrets
    from movrec.llm.common import table

    model = quality.fit_quality_model(table(spark, SF, "documents"), table(spark, SF, "labels"))
    scores = {r["doc_id"]: r["score"] for r in rows(quality.score_quality(table(spark, SF, "documents"), model))}
    left = {d: t for d, t, _, _ in documents if scores[d] >= 0.5}
    parts = brute_components({d: brute_fingerprint(t) for d, t in left.items()})
    left = {d: t for d, t in left.items() if parts[d] == d}
    items = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t)) for (t,) in con.execute("SELECT text FROM benchmark").fetchall()]
    keys = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}

    def leaked(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        return any(tuple(w[i : i + n]) in keys for n in {len(k) for k in keys} for i in range(len(w) - n + 1))

    left = {d: secrets.redact(t) for d, t in left.items() if not leaked(t)}
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r["doc_id"]: r["text"] for r in rows(docs)} == left
    assert decontaminate.WINDOW == 10
    mixed = {r["doc_id"]: r for r in rows(corpus_pipeline.run(spark, SF))}
    assert set(mixed) <= set(left) and all(mixed[d]["text"] == left[d] for d in mixed)
    assert all(r["size"] == len(words(r["text"])) and 1 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"] for r in mixed.values())


def test_mix_keeps_to_its_targets(spark):
    got = rows(QUERIES["op7_source_mixing"](spark, "/root/testdata/sf0.01"))
    total = sum(r["size"] for r in got)
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] + 1e-6
        by.setdefault((r["target"], r["source_size"]), []).append(r)
    for (target, _), part in by.items():
        assert abs(sum(r["taken"] for r in part) - target) <= max(r["size"] for r in part)
    assert math.isclose(sum(t for t, _ in by), total, rel_tol=1e-6)
    again = rows(QUERIES["op7_source_mixing"](spark.newSession(), "/root/testdata/sf0.01"))
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in got)
