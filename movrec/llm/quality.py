"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``passage`` words.  Every passage of the
whole text is encoded by counts of hashed byte-class trigrams (letters by case,
digits, white space, each punctuation mark), by a few word statistics
(repeated neighbours, share of distinct words, lengths) and by counts of its
hashed words, ASCII letters lowered; a linear layer with tanh turns that into an embedding.  Gated attention, ``softmax(w . (tanh(V h) *
sigmoid(U h)))``, weights the passages, and a logistic layer scores the weighted
sum.  All layers are trained together from document labels by Adam.

Labels come from a bounded sample (``max_labelled`` rows, half of each class
where there are enough, those with the least hash of their id) of the rows outside
the held-out fold, and from at most about ``max_passages`` passages of them.  Labels, lang, source and doc_id are never inputs of a score.

Defined results: null and empty texts are one empty passage; of very long texts
all passages are scored; without labels of
both classes every score is the share of label 1 (1.0 without any label);
repeated rows are scored one by one; other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movrec.llm import words as W
from movrec.llm.common import arrow_map, held_out
from movrec.llm.language import bounded_sample
from movrec.llm.mixing import word_count

PASSAGE = 96
DIMS, WORDS = 512, 512
HIDDEN, ATTENTION = 24, 16
MAX_LABELLED = 4000
#: passages the driver trains on, 4 KB each
MAX_PASSAGES = 1 << 16
EPOCHS = 30

_CLASS = np.arange(256, dtype=np.int64)
_CLASS[0x61:0x7B] = 0x61
_CLASS[0x41:0x5B] = 0x41
_CLASS[0x30:0x3A] = 0x30
_CLASS[0x80:] = 0x80
_CLASS[[0x09, 0x0B, 0x0C, 0x0D]] = 0x20
_STATS = 8


def encode(data: np.ndarray, offsets: np.ndarray, passage: int = PASSAGE, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of a run of texts, and the text of each passage."""
    n = len(offsets) - 1
    starts, ends = W.word_bounds(data, offsets[:-1], W.SPACED)
    owner = W.owners(offsets, starts)
    border = W.per_text(owner, n)
    count = np.diff(border)
    parts = np.maximum(1, -(-count // passage))
    first_part = np.concatenate(([0], np.cumsum(parts)))
    bag = np.repeat(np.arange(n), parts)
    total = int(first_part[-1])
    out = np.zeros((total, dims + _STATS + WORDS), np.float32)
    if not len(starts):  # what the statistics below give for a passage without words
        out[:, dims + 4], out[:, dims + 6], out[:, dims + 7] = 1, np.log1p(1) / 5, float(1 < passage)
        return out, bag
    of_word = first_part[owner] + (np.arange(len(starts)) - border[owner]) // passage
    # byte trigrams of classes belong to the passage of the word they start in
    lens = ends - starts
    at_byte = np.full(len(data), -1, np.int64)
    inside = np.repeat(np.arange(len(lens)), lens)
    at_byte[np.arange(len(inside)) + np.repeat(starts - (np.cumsum(lens) - lens), lens)] = of_word[inside]
    kinds = _CLASS[data]
    if len(data) >= 3:
        code = (kinds[:-2] * 131 + kinds[1:-1]) * 131 + kinds[2:]
        text = np.repeat(np.arange(n), np.diff(offsets))
        ok = (at_byte[:-2] >= 0) & (text[:-2] == text[2:])
        bins = (W.mix(code[ok].astype(np.uint64)) % np.uint64(dims)).astype(np.int64)
        seen = np.bincount(at_byte[:-2][ok] * dims + bins, minlength=total * dims).reshape(total, dims)
        out[:, :dims] = _scaled(seen)
    sums = W.Sums(21)
    word = sums.slices(sums.over(sums.bytes[W.LOWER[data]]), starts, ends)
    words = np.maximum(1, np.bincount(of_word, minlength=total))
    same = np.concatenate(([False], (word[1:] == word[:-1]) & (of_word[1:] == of_word[:-1])))
    order = np.lexsort((word, of_word))
    new = np.concatenate(([True], (np.diff(word[order].view(np.int64)) != 0) | (np.diff(of_word[order]) != 0)))
    per = lambda v: np.bincount(of_word, weights=v, minlength=total) / words
    upper = np.cumsum(np.concatenate(([0], (data >= 0x41) & (data <= 0x5A))))
    plain = np.cumsum(np.concatenate(([0], W.ALNUM[W.LOWER[data]])))
    out[:, dims : dims + _STATS] = np.stack([
        per(same.astype(float)), np.bincount(of_word[order][new], minlength=total) / words, per(lens.astype(float)) / 10,
        per((upper[ends] - upper[starts]) / lens), 1 - per((plain[ends] - plain[starts]) / lens),
        per((lens == 1).astype(float)), np.log1p(words) / 5, (words < passage).astype(float),
    ], axis=1)
    bins = (W.mix(word.view(np.uint64)) % np.uint64(WORDS)).astype(np.int64)
    out[:, dims + _STATS :] = _scaled(np.bincount(of_word * WORDS + bins, minlength=total * WORDS).reshape(total, WORDS))
    return out, bag


def _scaled(seen: np.ndarray) -> np.ndarray:
    share = np.sqrt(seen)
    return share / np.maximum(1e-9, np.linalg.norm(share, axis=1, keepdims=True))


@dataclass
class AttentionModel:
    """Encoder, gated attention and classifier."""

    dims: int = DIMS
    passage: int = PASSAGE
    constant: float | None = 1.0
    p: dict = field(default_factory=dict)

    def forward(self, x: np.ndarray, bag: np.ndarray, bags: int):
        p = self.p
        h = np.tanh(x @ p["E"] + p["e"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        s = (v * u) @ p["w"]
        top = np.full(bags, -np.inf)
        np.maximum.at(top, bag, s)
        a = np.exp(s - top[bag])
        a /= np.bincount(bag, weights=a, minlength=bags)[bag]
        z = np.zeros((bags, h.shape[1]))
        np.add.at(z, bag, a[:, None] * h)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))
        return y, (h, v, u, a, z)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if self.constant is not None:
            return np.full(n, self.constant)
        x, bag = encode(data, offsets, self.passage, self.dims)
        return self.forward(x, bag, n)[0]


def train(x: np.ndarray, bag: np.ndarray, y: np.ndarray, dims: int = DIMS, epochs: int = EPOCHS, rate: float = 0.01, decay: float = 1e-4, batch: int = 64, seed: int = 3) -> dict:
    """All parameters by Adam on the mean cross entropy of the bags; classes weigh the same."""
    rng = np.random.Generator(np.random.PCG64(seed))
    f = x.shape[1]
    shapes = {"E": (f, HIDDEN), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION)}
    p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()}
    p |= {"e": np.zeros(HIDDEN), "w": rng.normal(0, 0.1, ATTENTION), "c": rng.normal(0, 0.1, HIDDEN), "b": np.zeros(1)}
    m, s = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    model = AttentionModel(dims, constant=None, p=p)
    border = np.searchsorted(bag, np.arange(len(y) + 1))
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            part = order[at : at + batch]
            rows = np.concatenate([np.arange(border[i], border[i + 1]) for i in part])
            own = np.repeat(np.arange(len(part)), border[part + 1] - border[part])
            xs = x[rows]
            out, (h, v, u, a, z) = model.forward(xs, own, len(part))
            d = (out - y[part]) * weight[part] / len(part)
            g = {"c": z.T @ d, "b": np.array([d.sum()])}
            dz = d[:, None] * p["c"]
            da = (dz[own] * h).sum(axis=1)
            ds = a * (da - np.bincount(own, weights=a * da, minlength=len(part))[own])
            g["w"] = (v * u).T @ ds
            dvu = ds[:, None] * p["w"]
            dv, du = dvu * u * (1 - v * v), dvu * v * u * (1 - u)
            g["V"], g["U"] = h.T @ dv, h.T @ du
            dh = (a[:, None] * dz[own] + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
            g["E"], g["e"] = xs.T @ dh, dh.sum(axis=0)
            t += 1
            for k in p:
                grad = g[k] + decay * p[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                s[k] = 0.999 * s[k] + 0.001 * grad * grad
                p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    return p


def even_level(sizes: list[tuple[int, int]], most: int) -> int:
    """The largest number of passages a document may give so that all give at most ``most`` (at least one each)."""
    low, high = 1, max([n for n, _ in sizes], default=1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if sum(min(n, middle) * times for n, times in sizes) <= most else (low, middle - 1)
    return low


def spaced(x: np.ndarray, most: int) -> np.ndarray:
    """All rows, or ``most`` evenly spaced ones."""
    return x if len(x) <= most else x[np.linspace(0, len(x) - 1, most).round().astype(int)]


def fit_quality_model(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, passage: int = PASSAGE, dims: int = DIMS, max_passages: int = MAX_PASSAGES) -> AttentionModel:
    """Train on the labelled rows of ``docs`` outside the held-out fold.

    Only ids are sampled and joined first; then the whole texts of at most
    ``max_labelled`` documents are encoded in tasks, and at most about
    ``max_passages`` of their passages reach the driver: documents with more than
    a common number of passages give that many, evenly spaced over the whole text.
    """
    marks = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()
    )
    # contradictory labels of one document say nothing; repeated ones count once
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).filter("quality = other").drop("other")
    picked = bounded_sample(marks, "quality", "doc_id", max_labelled // 2, 2).drop("_place")
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # about max_labelled ids
    # one text for each id, however often the id is repeated
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))
    sizes = texts.select(F.greatest(F.lit(1), F.ceil(word_count() / passage)).alias("n")).groupBy("n").count().collect()  # at most max_labelled rows
    most = even_level([(r["n"], r["count"]) for r in sizes], max_passages)

    def run(batches):
        for batch in batches:
            raw, offsets = W.buffers(batch.column(1))
            for i, j in W.runs(offsets):
                x, bag = encode(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], passage, dims)
                cells = [zlib.compress(spaced(x[bag == k], most).astype("<f4").tobytes(), 1) for k in range(j - i)]  # mostly zeros
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(cells, pa.binary())], ["doc_id", "quality", "x"])

    rows = arrow_map(texts, run, f"doc_id {kind}, quality int, x binary").withColumn("h", F.xxhash64(F.lit("order"), "doc_id")).toPandas()
    rows = rows.sort_values(["h", "x"]).groupby("quality").head(max_labelled // 2)
    y = rows["quality"].to_numpy(int)
    model = AttentionModel(dims, passage)
    if len(set(y)) < 2:
        model.constant = float(y[0]) if len(y) else 1.0
        return model
    cells, ends = bytearray(), [0]
    for b in rows["x"]:  # the driver holds one copy
        cells += zlib.decompress(b)
        ends.append(len(cells))
    x = np.frombuffer(cells, "<f4").reshape(-1, dims + _STATS + WORDS)
    bag = np.repeat(np.arange(len(rows)), np.diff(ends) // (4 * x.shape[1]))
    model.constant, model.p = None, train(x, bag, y, dims)
    return model


def score_quality(docs: DataFrame, model: AttentionModel) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``, from the whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(shared.value, batch.column(1)))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: AttentionModel, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_scores(shared.value, batch.column(at)) >= least))

    return arrow_map(docs, run, docs.schema)


def _scores(model: AttentionModel, texts: pa.Array) -> np.ndarray:
    raw, offsets = W.buffers(texts)
    parts = [model.score(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in W.runs(offsets)]
    return np.concatenate(parts) if parts else np.zeros(0)
