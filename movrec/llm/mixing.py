"""Mixing sources to target weights by Pareto order sampling.

Every source gets a share of all words by its weight, at most ``most`` times
its own words; what a capped source leaves is shared again by weight until none
is above its cap (water filling: one level for all sources that are not capped).

Inside a source a document is expected ``min(most, level * preference)`` times;
``preference`` rises with the document's length in five steps, so inclusion
is unequal, and ``level`` is solved so that the expected words equal the target.
The whole part of the expectation is allocated as certain copies.  The
fractional part is the inclusion probability of a fixed-size sample by Pareto
order sampling: documents are ranked by random odds divided by inclusion odds,
and taken in that order until the words still owed are reached (a document is
taken when its middle lies before that point).

The rank sum runs over range partitions, so a source of any size is split.

Defined results: null and empty texts have size 0 and are taken 0 words; a null
source is a source of its own, last in order; the random number comes from
``doc_id`` and the text's digest, so reruns agree, and rows equal in both are
ranked one after the other.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from movrec.llm.common import running_before, settle

WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3.0
#: preference steps: documents of at least so many words, and their preference
STEPS = ((0, 1.0), (64, 1.125), (256, 1.25), (1024, 1.375), (4096, 1.5))


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def preference(size: str = "size") -> Column:
    out = F.lit(STEPS[0][1])
    for least, value in STEPS[1:]:
        out = F.when(F.col(size) >= least, F.lit(value)).otherwise(out)
    return out


def uniform(doc_id: str, digest: str) -> Column:
    """A number strictly between 0 and 1 from 52 bits of an MD5."""
    key = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.col(digest))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``source, source_size, weight, target`` for every source in ``sizes`` (source, size).

    The rank of a source (by code point, null last) is counted over range
    partitions; the level is found from the sum and weight of capped sources,
    one small aggregate per round, until no other source is above its cap.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("one", F.lit(1)).withColumn("all", F.lit(1)).withColumn("last", F.col("source").isNull())
    ranked = running_before(per, "all", ["last", "source"], "one", "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = settle(ranked.select("source", "source_size", weight.alias("weight")))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * float(most)
    level, capped = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level >= cap
        row = ranked.agg(
            F.sum(F.when(above, cap)).alias("full"), F.sum(F.when(~above, F.col("weight"))).alias("w"), F.sum(above.cast("int")).alias("n")
        ).first()
        if row["w"] is None or row["n"] == capped:
            break
        capped, level = row["n"], (total - (row["full"] or 0.0)) / row["w"]
    target = F.least(cap, F.col("weight") * F.lit(float(level or 0.0)))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def expectation_levels(sizes: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """``source, source_size, target, level, certain`` for every source.

    ``level`` makes the expected words equal the target (null: every document
    is at the cap); ``certain`` is the words of the whole copies.  Solved from
    at most five sums per source, the preferences being steps.
    """
    classes = sizes.withColumn("p", preference()).groupBy("source", "p").agg(F.sum("size").alias("s"))
    above = Window.partitionBy("source").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy("source").orderBy(F.desc("p")).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy("source")
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    joined = classes.join(t, F.col("source").eqNullSafe(F.col("_s")))
    solved = (F.col("target") - most * F.coalesce(F.sum("s").over(above), F.lit(0))) / F.sum(F.col("p") * F.col("s")).over(below)
    # the first step, from the highest preference down, that its own level leaves below the cap
    level = F.max_by("level", F.when(F.col("level") * F.col("p") <= most, F.col("p"))).over(whole)
    out = joined.withColumn("level", solved).withColumn("level", level)
    copies = F.floor(expected("level", "p", most))
    return out.groupBy("source").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("level").alias("level"),
        F.sum(copies * F.col("s")).cast("bigint").alias("certain"),
    )


def expected(level: str, p: str, most: float) -> Column:
    """Expected copies of a document."""
    return F.greatest(F.lit(0.0), F.least(F.lit(float(most)), F.coalesce(F.col(level) * F.col(p), F.lit(float(most)))))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, extra: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, *extra, source, size, source_size, target, copies, taken`` for every row of ``docs``."""
    sizes = settle(docs.select("doc_id", "source", word_count().alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("_d"), *extra))
    targets = settle(source_targets(sizes.select("source", "size"), weights, most))
    facts = settle(expectation_levels(sizes.select("source", "size"), targets, most)).withColumnRenamed("source", "_s")
    rows = sizes.join(facts, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = rows.withColumn("_p", preference()).withColumn("_e", expected("level", "_p", most)).withColumn("_whole", F.floor("_e").cast("bigint"))
    odds = F.col("_u") / (1 - F.col("_u")) / (F.col("_f") / (1 - F.col("_f")))
    rows = (
        rows.withColumn("_f", F.col("_e") - F.col("_whole")).withColumn("_u", uniform("doc_id", "_d"))
        .withColumn("_q", F.when(F.col("_f") > 0, odds)).withColumn("_null", F.isnull("_q"))
        .withColumn("_fraction", F.when(F.col("_f") > 0, F.col("size")).otherwise(F.lit(0)))
    )
    ranked = running_before(rows, "source", ["_null", "_q", "doc_id", "_d"], "_fraction", "_before")
    chosen = (F.col("_f") > 0) & (F.col("_before") + F.col("size") / 2 <= F.col("target") - F.col("certain"))
    copies = F.col("_whole") + chosen.cast("bigint")
    return ranked.select("doc_id", *extra, "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
