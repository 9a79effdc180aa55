"""The toxicity classifier against plain loops: features, log-count ratios, regression and scores."""

import math
import random
import zlib

from fundpanel.llm import toxicity
from fundpanel.llm.toxicity import _MULTIPLIERS, BITS, SIZES

MASK = (1 << 32) - 1


def features_by_hand(text):
    """The distinct feature numbers, one n-gram after the other."""
    letters = [ord(c) for c in " " + " ".join(text.lower().split()) + " "]
    found = set()
    for n in SIZES:
        for i in range(len(letters) - n + 1):
            run = 0
            for c in letters[i : i + n]:
                run = ((run * 0x01000193 & MASK) ^ c) * int(_MULTIPLIERS[0]) & MASK
            found.add(((run ^ (run >> 15)) * int(_MULTIPLIERS[n]) & MASK) >> (32 - BITS))
    return found


def fit_by_hand(rows, labels, smooth=1.0, l2=2e-4, rounds=100):
    """weight * ratio of each feature, and the bias: accelerated gradient steps, all in dictionaries."""
    n, toxic = len(rows), sum(labels)
    every = set().union(*rows)
    ratio = {f: math.log((smooth + sum(f in x for x, y in zip(rows, labels, strict=True) if y)) / (toxic + 2 * smooth)) - math.log((smooth + sum(f in x for x, y in zip(rows, labels, strict=True) if not y)) / (n - toxic + 2 * smooth)) for f in every}
    balance = [0.5 / (toxic / n) if y else 0.5 / (1 - toxic / n) for y in labels]

    def back(values):
        out = dict.fromkeys(every, 0.0)
        for x, v in zip(rows, values, strict=True):
            for f in x:
                out[f] += v
        return {f: s * ratio[f] / n for f, s in out.items()}

    # features that no text has don't take part, but have a share of the first vector of the power iteration
    v, elsewhere = dict.fromkeys(every, 1.0), (1 << BITS) - len(every)
    for _ in range(8):
        size = math.sqrt(sum(a * a for a in v.values()) + elsewhere)
        v = back([b * sum(v[f] / size * ratio[f] for f in x) for x, b in zip(rows, balance, strict=True)])
        elsewhere = 0
    step = 1 / (0.25 * 1.1 * math.sqrt(sum(a * a for a in v.values())) + l2)
    at, at_bias, last, last_bias = dict.fromkeys(every, 0.0), 0.0, dict.fromkeys(every, 0.0), 0.0
    for t in range(1, rounds + 1):
        error = [(1 / (1 + math.exp(-(sum(at[f] * ratio[f] for f in x) + at_bias))) - y) * b for x, y, b in zip(rows, labels, balance, strict=True)]
        slope = back(error)
        w = {f: at[f] - step * (slope[f] + l2 * at[f]) for f in every}
        bias = at_bias - 2 * sum(error) / n
        k = (t - 1) / (t + 2)
        at, at_bias = {f: w[f] + k * (w[f] - last[f]) for f in every}, bias + k * (bias - last_bias)
        last, last_bias = w, bias
    return {f: w[f] * ratio[f] for f in every}, bias


def some_texts(rng, n):
    out = []
    for i in range(n):
        words = [rng.choice(("the", "cat", "sat", "mat", "dog", "Ran", "far", "über", "zoo")) for _ in range(rng.randrange(1, 9))]
        if i % 3 == 0:
            words.insert(rng.randrange(len(words) + 1), rng.choice(("vile", "awful", "vilest")))
        out.append((" \n".join(words), int(i % 3 == 0) ^ int(i % 41 == 0)))
    return out


def test_scores_equal_plain_loops(spark):
    texts = some_texts(random.Random(3), 300)
    long = "the cat sat vile " * 8000  # beyond what takes part in the fit, but scored whole
    rows = [(i, t, "x") for i, (t, _) in enumerate(texts)] + [(1000, long, "x"), (1001, None, "x"), (1002, "", "x"), (None, "vile dog", "x"), (5, texts[5][0], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y, 0) for i, (_, y) in enumerate(texts)] + [(1000, 0, 0), (1001, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id long, toxic int, quality int")
    got = toxicity.classify(docs, labels).collect()
    learned = [(features_by_hand(t), y) for i, (t, y) in enumerate(texts) if zlib.crc32(str(i).encode()) % 5]
    weights, bias = fit_by_hand([x for x, _ in learned], [y for _, y in learned])
    assert len(got) == len(rows)
    text_of = {(i, t): t or "" for i, t, _ in rows}
    want = sorted((i if i is not None else -1, 1 / (1 + math.exp(-(sum(weights.get(f, 0.0) for f in features_by_hand(t)) + bias)))) for (i, _), t in text_of.items())
    found = sorted({(r.doc_id if r.doc_id is not None else -1, r.score) for r in got})
    assert [i for i, _ in found] == [i for i, _ in want]
    assert all(abs(a - b) < 2e-4 for (_, a), (_, b) in zip(found, want, strict=True))
    assert all(r.predicted == int(r.score >= 0.5) and r.held_out == (None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    clear = [(r.predicted, texts[r.doc_id][1]) for r in got if r.doc_id is not None and r.doc_id < 300 and r.held_out and r.doc_id % 41]
    assert sum(a == b for a, b in clear) / len(clear) > 0.9 and len(clear) > 30
    assert sum(r.doc_id == 5 for r in got) == 2


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.classify(docs, labels).collect()] == [0, 0]
    assert toxicity.classify(docs.limit(0), labels).count() == 0
