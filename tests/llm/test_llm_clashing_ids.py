"""Texts and vectors that share an id: told apart exactly."""

import random

import numpy as np

from movrec.llm import embeddings, substring
from test_llm_operators import docs_of
from test_llm_queries import rows


def test_texts_with_equal_short_keys_and_no_id(spark):
    """Two texts whose 31-bit keys agree: what is cut from one never touches the other."""
    from pyspark.sql import functions as F

    words = F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.concat(F.lit("w"), F.pmod(F.xxhash64("id", i), F.lit(100_000)).cast("string")))
    texts = spark.range(200_000).select(F.array_join(words, " ").alias("t"))
    keyed = texts.withColumn("k", F.pmod(F.xxhash64("t"), F.lit(1 << 31)))
    (a, b) = keyed.groupBy("k").agg(F.collect_list("t").alias("ts"), F.count(F.lit(1)).alias("n")).filter("n > 1").first()["ts"][:2]
    docs = [(1, a), (None, a), (None, b), (None, "x " * 5), (7, b + " tail")]
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in rows(substring.remove_repeats(docs_of(spark, docs))))
    # null ids come last, so a repeats in the null row, and b in the null row too as document 7 is before it
    assert got == [(0, 5, 0), (0, 30, 30), (0, 30, 30), (1, 30, 0), (7, 31, 0)]
    docs = [(1, a), (None, a), (None, b)]
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in rows(substring.remove_repeats(docs_of(spark, docs))))
    assert got == [(0, 0), (0, 30), (1, 0)]


def test_one_id_with_many_texts_and_equal_rows(spark):
    rnd = random.Random(1)
    passage = [" ".join(f"p{i}x{j}" for j in range(25)) for i in range(3)]
    docs = [(5, f"{rnd.choice(passage)} own{i}") for i in range(40)] + [(5, passage[0])] * 3 + [(9, passage[1])]
    got = rows(substring.remove_repeats(docs_of(spark, docs).repartition(3)))
    first = {p: 0 for p in passage}
    for r in got:
        first_words = next(p for p in passage if (r["kept"] + " ").startswith(p + " ")) if r["n_removed"] == 0 else None
        if first_words:
            first[first_words] += 1
    assert len(got) == len(docs) and all(r["n_removed"] in (0, 25) for r in got)
    # each passage stays in one text of id 5 (equal rows are one document), never in the later id
    assert all(1 <= n <= 3 for n in first.values()) and [r["n_removed"] for r in got if r["doc_id"] == 9] == [25]


def test_vectors_that_share_an_id(spark):
    """One id with two far vectors does not tie their neighbours together."""
    rng = np.random.default_rng(0)
    u, w = np.eye(8)[0], np.eye(8)[1]
    near = lambda x: (x + rng.normal(0, 0.02, 8)).tolist()
    data = [(1, 0, u.tolist()), (1, 0, w.tolist()), (2, 0, near(u)), (3, 0, near(w)), (4, 1, near(u)), (4, 0, near(u)), (2, 0, near(w)), (9, 2, near(w))]
    got = rows(embeddings.near_duplicates(spark.createDataFrame(data, "vec_id bigint, label int, embedding array<double>")))
    assert len(got) == len(data)

    def brute():
        out = []
        unit = [np.array(v) / np.linalg.norm(v) for _, _, v in data]
        root = list(range(len(data)))
        find = lambda i: i if root[i] == i else find(root[i])
        links = [[j for j in range(len(data)) if j != i and data[i][1] == data[j][1] and unit[i] @ unit[j] >= 0.93] for i in range(len(data))]
        for i, js in enumerate(links):
            for j in js:
                root[find(i)] = find(j)
        for i, (v, _, _) in enumerate(data):
            c = min(data[j][0] for j in range(len(data)) if find(j) == find(i))
            out.append((v, len(links[i]), c, v == c))
        return sorted(out)

    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == brute()
