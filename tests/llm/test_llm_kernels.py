"""The numpy kernels against plain Python, without Spark."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from movrec.llm import decontaminate, language, quality, secrets, simhash, substring
from movrec.llm import words as W
from test_llm_queries import brute_fingerprint, lower

ALPHABET = st.sampled_from(list("aAbZ09 \t\n\r\x0b\x0c.-_é漢\x00\x1f~") + ["  ", "<|", "token=", "😀"])
TEXT = st.lists(ALPHABET, max_size=60).map("".join)
TEXTS = st.lists(TEXT, max_size=12)
FIXED = settings(max_examples=60, deadline=None, derandomize=True)


@FIXED
@given(TEXTS, st.integers(1, 40))
def test_words_of_runs(texts, most):
    raw, offsets = W.buffers(pa.array([*texts, None], pa.string()))
    found = []
    for i, j in W.runs(offsets, most):
        data, o = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends = W.word_bounds(data, o[:-1], W.SPACED)
        owner = W.owners(o, starts)
        border = W.per_text(owner, j - i)
        for k in range(j - i):
            part = slice(border[k], border[k + 1])
            found.append([data[a:b].tobytes().decode() for a, b in zip(starts[part], ends[part])])
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts] + [[]]


@FIXED
@given(TEXTS)
def test_fingerprints(texts):
    raw, offsets = W.buffers(pa.array(texts, pa.string()))
    parts = [simhash.fingerprints(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in W.runs(offsets, 50)]
    assert [int(x) for p in parts for x in p] == [brute_fingerprint(t) for t in texts]


def test_slice_hashes_depend_on_content_alone():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 3, 400).astype(np.uint64)
    sums = W.Sums(5)
    i = np.repeat(np.arange(380), 3)
    j = i + np.tile([1, 5, 20], 380)
    hashes = sums.slices(sums.over(values), i, j)
    by_content, by_hash = {}, {}
    for a, b, h in zip(i, j, hashes.tolist()):
        assert by_content.setdefault(values[a:b].tobytes(), h) == h
        assert by_hash.setdefault(h, values[a:b].tobytes()) == values[a:b].tobytes()


@FIXED
@given(st.lists(st.text(alphabet="ab .", max_size=30), max_size=5), st.text(alphabet="abAB ,.", max_size=120), st.integers(1, 4))
def test_automaton(items, text, window):
    found = decontaminate.Automaton([(str(n), t) for n, t in enumerate(items)], window)
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    w, want, hit = split(text), set(), set()
    for n, t in enumerate(items):
        seq = split(t)
        keys = [seq] if 0 < len(seq) < window else [seq[i : i + window] for i in range(len(seq) - window + 1)]
        for key in keys:
            for i in range(len(w) - len(key) + 1):
                if w[i : i + len(key)] == key:
                    want.add(str(n))
                    hit |= set(range(i, i + len(key)))
    count, keys, ranges = found.scan(text.encode())
    assert count == len(w)
    assert {x for k in keys for x in found.items[k]} == want
    assert {x for a, b in ranges for x in range(a, b)} == hit


@FIXED
@given(TEXT)
def test_redaction_keeps_everything_else(text):
    spans = secrets.find_spans(text)
    assert spans == sorted(spans, key=lambda s: (s[1], secrets.KINDS.index(s[0]), s[2]))
    covered = {i for _, a, b in spans for i in range(a, b)}
    kept = "".join(c for i, c in enumerate(text) if i not in covered)
    assert secrets.redact(text).replace(secrets.MASK, "") == kept.replace(secrets.MASK, "")


@FIXED
@given(TEXTS)
def test_features_depend_on_one_text_alone(texts):
    raw, offsets = W.buffers(pa.array(texts, pa.string()))
    x, bag = quality.encode(raw[offsets[0] : offsets[-1]], offsets - offsets[0], passage=4)
    counts = language.gram_counts(texts, 64)
    assert sorted(set(bag.tolist())) == list(range(len(texts)))
    for n, t in enumerate(texts):
        one, o = W.buffers(pa.array([t], pa.string()))
        alone, _ = quality.encode(one[o[0] : o[1]], o - o[0], passage=4)
        assert np.allclose(alone, x[bag == n], atol=1e-6)
        assert (language.gram_counts([t], 64)[0] == counts[n]).all()


def test_every_window_has_one_anchor_run():
    rng = np.random.default_rng(6)
    text = " ".join(rng.choice(["a", "b", "cc", "d"], 300)).encode()
    data = np.frombuffer(text, np.uint8)
    own, ah, rh, begin, windows, _, _, border = substring.anchors(substring._Hashes(), data, np.array([0, len(data)]), 20, 8)
    covered = [w for b, n in zip(begin, windows) for w in range(b, b + n)]
    assert covered == list(range(300 - 20 + 1)) and windows.max() <= 13
    assert len({(int(a), int(r)) for a, r in zip(ah, rh)}) <= len(own) == len(ah)


def test_ftrl_is_sparse_and_temperature_calibrates():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 40)).astype(np.float32)
    y = (x[:, 0] + 0.3 * rng.normal(size=600) > 0).astype(int)
    w = language.train_ftrl(x, y, 2, l1=3.0)
    assert (language.softmax(x @ w[:-1] + w[-1]).argmax(1) == y).mean() > 0.9
    assert (w[1:-1] == 0).mean() > 0.2 and (w[0] != 0).all()
    logits = np.array([[8.0, 0.0]] * 80 + [[0.0, 8.0]] * 20)
    hot = language.fit_temperature(logits, np.array([0] * 60 + [1] * 20 + [1] * 15 + [0] * 5))
    assert hot > 2  # a confident model that is often wrong is cooled


def test_attention_training_learns_from_one_bad_passage():
    good = "plain words stand here in a calm row of text "
    texts = [good * 12 + ("!!! $$$ BUY ### NOW *** " * 12 if n % 2 else "") + good * 6 for n in range(160)]
    raw, offsets = W.buffers(pa.array(texts))
    x, bag = quality.encode(raw, offsets, passage=24)
    y = np.array([1 - n % 2 for n in range(160)])
    p = quality.train(x[bag < 120], bag[bag < 120], y[:120])
    model = quality.AttentionModel(passage=24, constant=None, p=p)
    out, (_, _, _, weight, _) = model.forward(x[bag >= 120], bag[bag >= 120] - 120, 40)
    assert ((out >= 0.5) == (y[120:] == 1)).mean() >= 0.95
    assert weight.min() >= 0 and np.allclose(np.bincount(bag[bag >= 120] - 120, weights=weight), 1)


def test_attention_training_learns_from_wording_alone():
    rng = np.random.default_rng(11)
    good, bad = (["stone", "river", "cloud", "field", "plant"], ["lucky", "prize", "spins", "bonus", "wager"])
    texts = [" ".join(rng.choice(bad if n % 2 else good, 60)) for n in range(160)]
    x, bag = quality.encode(*W.buffers(pa.array(texts)), passage=24)
    y = np.array([1 - n % 2 for n in range(160)])
    p = quality.train(x[bag < 120], bag[bag < 120], y[:120])
    out = quality.AttentionModel(passage=24, constant=None, p=p).forward(x[bag >= 120], bag[bag >= 120] - 120, 40)[0]
    assert ((out >= 0.5) == (y[120:] == 1)).mean() >= 0.95


@pytest.mark.parametrize("dtype", ["<f4", "<f8"])
def test_unit_vectors_survive_extreme_sizes(dtype):
    from movrec.llm import embeddings

    v = np.array([[1e30, 1e30], [1e-30, 0], [3, 4]], dtype)
    u = embeddings._unit([r.tobytes() for r in v], dtype == "<f4")
    assert np.allclose(np.linalg.norm(u, axis=1), 1) and np.allclose(u[2], [0.6, 0.8])
