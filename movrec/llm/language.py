"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; n-grams of 1 to 3 code points inside words (with one
space at each word end) are hashed to ``dims`` bins.  Inverse document
frequencies come from all learnable rows.  The weights are trained by
follow-the-regularised-leader (FTRL-proximal) with elastic-net penalties on a
bounded sample (``per_language`` rows of each language and ``max_sample`` in all,
rare languages first, the documents with the least hash of their id), so most
weights are exactly zero.  Every fifth sampled row of a language is kept from
training and fits one temperature for calibration.  Of more than
``max_languages`` values the most frequent ones are learned, and with more values
than ``max_sample`` rows one row each of as many.

Learnable rows have a text with a letter, a non-null language and a
``doc_id`` outside the held-out fold; ``lang``, ``source`` and ``doc_id`` are
never inputs of a prediction.

Defined results: a null text, or one without letters, is ``und`` with score 0;
so is every text if nothing can be learned (no rows, no languages); with one
language only, that one is predicted with score 1.  Very long texts are
counted whole, in parts.  Repeated rows are judged one by one.  Other columns
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from movrec.llm import words as W
from movrec.llm.common import arrow_map, held_out

DIMS = 4096
GRAMS = (1, 2, 3)
PER_LANGUAGE, MAX_SAMPLE = 800, 4000
MAX_LANGUAGES = 2048
#: code points of text that a task turns to counts at once
CHUNK_POINTS = 1 << 18
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_counts(texts: list[str], dims: int = DIMS) -> np.ndarray:
    """Counts of hashed n-grams, one row for each text."""
    out = np.zeros((len(texts), dims), np.float32)
    at = 0
    while at < len(texts):
        size, to = 0, at
        while to < len(texts) and (to == at or (size + len(texts[to]) <= CHUNK_POINTS and (to - at) < 256)):
            size += len(texts[to])
            to += 1
        out[at:to] = _count(texts[at:to], dims)
        at = to
    return out


def _count(texts: list[str], dims: int) -> np.ndarray:
    parts = [np.frombuffer(t.lower().encode("utf-32-le", "replace"), np.uint32) for t in texts]
    lens = np.array([len(p) + 1 for p in parts])
    points = np.full(int(lens.sum()), 0x20, np.uint64)
    begin = np.cumsum(lens) - lens
    for p, b in zip(parts, begin.tolist()):
        points[b + 1 : b + 1 + len(p)] = p
    # a text starts after one space and all white space is a space
    points[(points >= 0x09) & (points <= 0x0D)] = 0x20
    owner = np.repeat(np.arange(len(texts)), lens)
    space = points == 0x20
    total = np.zeros(len(texts) * dims)
    for n in GRAMS:
        m = len(points) - n + 1
        if m <= 0:
            continue
        code = np.full(m, n, np.uint64)
        ok = owner[:m] == owner[n - 1 :]
        for k in range(n):
            code = code * np.uint64(0x100000001B3) + points[k : k + m]
            if 0 < k < n - 1 or n == 1:
                ok &= ~space[k : k + m]
        bins = (W.mix(code[ok]) % np.uint64(dims)).astype(np.int64)
        total += np.bincount(owner[:m][ok] * dims + bins, minlength=len(texts) * dims)
    return total.reshape(len(texts), dims).astype(np.float32)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # dims + 1 rows (the last is the bias), one column for each language
    temperature: float = 1.0
    sparsity: float = 0.0

    def features(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts)
        x *= self.idf
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        x /= np.where(norm > 0, norm, 1)
        return x

    def logits(self, counts: np.ndarray) -> np.ndarray:
        return self.features(counts) @ self.weights[:-1] + self.weights[-1]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and calibrated probability of each whole text."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        for at in range(0, len(known), 512):
            part = known[at : at + 512]
            p = softmax(self.logits(gram_counts([texts[i] for i in part], len(self.idf))) / self.temperature)
            best = p.argmax(axis=1)
            for i, b, row in zip(part, best, p):
                names[i], scores[i] = self.languages[b], float(min(row[b], 1.0))
        return names, scores


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train_ftrl(
    x: np.ndarray, y: np.ndarray, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, epochs: int = 4, batch: int = 16, seed: int = 5
) -> np.ndarray:
    """FTRL-proximal with per-coordinate rates; coordinates below ``l1`` are exactly zero."""
    z = np.zeros((x.shape[1] + 1, classes))
    n = np.zeros_like(z)
    w = np.zeros_like(z)
    order = np.random.Generator(np.random.PCG64(seed))
    hot = np.eye(classes)[y]
    for _ in range(epochs):
        shuffled = order.permutation(len(x))
        for at in range(0, len(x), batch):
            part = shuffled[at : at + batch]
            rows = np.hstack([x[part], np.ones((len(part), 1), x.dtype)])
            g = rows.T @ (softmax(rows @ w) - hot[part]) / len(part)
            sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / alpha
            z += g - sigma * w
            n += g * g
            w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    return w


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least negative log likelihood, by golden section on its logarithm."""

    def loss(t):
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

    if not len(y):
        return 1.0
    lo, hi, r = np.log(0.05), np.log(10.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        if loss(a) <= loss(b):
            hi = b
        else:
            lo = a
    return float(np.exp((lo + hi) / 2))


def _learnable(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out())


def document_frequencies(texts: DataFrame, dims: int = DIMS) -> tuple[int, np.ndarray]:
    """Rows with a letter, and in how many of them each bin occurs, over all rows of ``texts``."""

    def run(batches):
        total, rows = np.zeros(dims, np.int64), 0
        for batch in batches:
            part = [t for t in batch.column(0).to_pylist() if has_letter(t)]
            for at in range(0, len(part), 512):
                total += (gram_counts(part[at : at + 512], dims) > 0).sum(axis=0)
            rows += len(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, dims), pa.int32()), pa.array(np.concatenate(([rows], total)))], ["bin", "n"]
        )

    found = arrow_map(texts.select("text"), run, "bin int, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    counts = {r["bin"]: r["n"] for r in found}
    return counts.get(-1, 0), np.array([counts.get(b, 0) for b in range(dims)], float)


def shares(counts: list[int], per_class: int, most: int) -> list[int]:
    """How many rows each class gives: at most ``per_class``, ``most`` in all, small classes first."""
    out, left = [0] * len(counts), most
    order = sorted(range(len(counts)), key=lambda i: counts[i])
    for place, i in enumerate(order):
        out[i] = min(counts[i], per_class, -(-left // (len(counts) - place)))
        left -= out[i]
    return out


def bounded_sample(rows: DataFrame, by: str, key: str, per_class: int, max_classes: int, most: int | None = None) -> DataFrame:
    """At most ``per_class`` rows of each class and ``most`` in all, with ``_place``, their place in the class from 0.

    Classes are counted over all rows and the ``max_classes`` most frequent ones
    (equal counts: in order of name) are sampled; only their counts reach the
    driver.  A class gives the rows with the least hashes of ``key``: those below
    a generous share of the class are ranked, so what is ranked is bounded, too.
    Rows equal in class and key are one row of the sample.
    """
    spark = rows.sparkSession
    counts = rows.groupBy(by).count().orderBy(F.desc("count"), by).limit(max_classes).collect()
    given = shares([r["count"] for r in counts], per_class, per_class * max_classes if most is None else most)
    facts = [(r[0], n, min(1.0, (2 * n + 16) / r["count"])) for r, n in zip(counts, given) if n]
    kind = rows.schema[by].dataType.simpleString()
    wanted = spark.createDataFrame(facts, f"_class {kind}, _rows int, _share double")  # at most max_classes rows
    point = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    near = rows.withColumn("_point", point).join(F.broadcast(wanted), F.col(by) == F.col("_class")).filter("_point < _share").distinct()
    place = F.row_number().over(Window.partitionBy(by).orderBy("_point", key)) - 1
    return near.withColumn("_place", place).filter("_place < _rows").select(*rows.columns, "_place")


def fit_language_model(docs: DataFrame, dims: int = DIMS, per_language: int = PER_LANGUAGE, max_sample: int = MAX_SAMPLE, max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Train on ``docs`` (doc_id, text, lang); the sample reaches the driver as n-gram counts."""
    rows = _learnable(docs)
    # one text for each id and language, however often the id is repeated
    lettered = rows.filter(F.col("text").rlike(r"\p{L}")).select("doc_id", "lang")
    picked = bounded_sample(lettered, "lang", "doc_id", per_language, max_languages, max_sample)
    wanted = picked.select(F.col("doc_id").alias("_i"), F.col("lang").alias("_l"), "_place")  # at most max_sample ids
    texts = rows.filter(F.col("text").rlike(r"\p{L}")).join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("lang") == F.col("_l")))
    picked = texts.groupBy("doc_id", "lang").agg(F.min("text").alias("text"), F.first("_place").alias("place")).select("place", "text", "lang")

    def counts(batches):
        for batch in batches:
            texts, langs = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            keep = [i for i, t in enumerate(texts) if has_letter(t)]
            for at in range(0, len(keep), 512):
                part = keep[at : at + 512]
                c = gram_counts([texts[i] for i in part], dims)
                bins = [np.flatnonzero(r).astype(np.int32) for r in c]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(part)), pa.array([langs[i] for i in part]), pa.array(bins, pa.list_(pa.int32())), pa.array([r[b] for r, b in zip(c, bins)], pa.list_(pa.float32()))],
                    ["place", "lang", "bins", "counts"],
                )

    table = arrow_map(picked, counts, "place int, lang string, bins array<int>, counts array<float>").toArrow().combine_chunks()
    # the same order in every run
    place, names = table.column("place").to_numpy(), np.array(table.column("lang").to_pylist(), dtype=object)
    order = np.lexsort((names.astype(str), place))
    table, place, names = table.take(pa.array(order)).combine_chunks(), place[order], names[order]
    total, df = document_frequencies(rows, dims)
    languages = sorted(set(names.tolist()))
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    model = LanguageModel(languages, idf, np.zeros((dims + 1, max(1, len(languages))), np.float32))
    if not languages:
        return model
    c = np.zeros((len(names), dims), np.float32)
    for r in range(len(names)):
        c[r, table.column("bins")[r].values.to_numpy()] = table.column("counts")[r].values.to_numpy()
    x, y = model.features(c), np.searchsorted(languages, names.astype(str))
    del c, table
    calibrate = place % 5 == 4  # so a rare language has all its rows in training
    w = train_ftrl(x[~calibrate], y[~calibrate], len(languages))
    model.weights = w.astype(np.float32)
    model.sparsity = float((w == 0).mean())
    model.temperature = fit_temperature(x[calibrate] @ w[:-1] + w[-1], y[calibrate])
    return model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names, scores = shared.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double")
