"""Byte contexts against a second, plain model, and the quota of each class."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from vatlens.llm import byte_context as bc
from vatlens.llm import language_id, url_filter


def plain_lengths(fold, order, least, learn, texts, rule):
    """Code lengths by dictionaries: one text, one class, one symbol at a time."""
    symbols, n = bc.FOLDS[fold]
    counts, total = defaultdict(Counter), Counter()

    def walk(text):
        s = [n] * order + symbols(np.frombuffer(text.encode(), np.uint8)).tolist()
        return [([tuple(s[i - d:i]) for d in range(order + 1)], s[i]) for i in range(order, len(s))]

    for label, text in learn:
        for contexts, symbol in walk(text):
            for c in contexts:
                counts[label, c][symbol] += 1
                total[c] += 1
    out = []
    for text in texts:
        bits = []
        for label in sorted({x for x, _ in learn}):
            length = 0.0
            for contexts, symbol in walk(text):
                p = [1 / n] * n
                for c in contexts:
                    if total[c] >= least:
                        p = rule(counts[label, c], p)
                length -= math.log2(p[symbol])
            bits.append(length)
        out.append(bits)
    return np.array(out)


def plain_escape(seen, shorter):
    total, distinct, n = sum(seen.values()), len(seen), len(shorter)
    left = sum(p for i, p in enumerate(shorter) if i not in seen)
    if not total:
        return shorter
    if left <= 0:
        return [seen[i] / total for i in range(n)]
    return [seen[i] / (total + distinct) if i in seen else distinct / (total + distinct) * shorter[i] / left for i in range(n)]


def plain_interpolation(seen, shorter):
    total, distinct = sum(seen.values()), len(seen)
    return [(seen[i] + distinct * p) / (total + distinct) for i, p in enumerate(shorter)] if total else shorter


def made(seed, letters, k, size):
    r = random.Random(seed)
    words = ["".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(12)]
    return [" ".join(r.choice(words) for _ in range(size)) for _ in range(k)]


def test_language_model_equals_a_plain_one(spark):
    learn = [(0, t) for t in made(1, "abcdé", 25, 12)] + [(1, t) for t in made(2, "abxyÉ7", 8, 10)]
    texts = [*made(3, "abcx", 5, 8), "", "Q9 ?", "é" * 5]
    counts = bc.levels(bc.count_contexts(spark.createDataFrame(learn, "label int, text string"), "text", 3), "text", 3, 6000, 4)
    got = bc.freeze("text", 3, 2, counts, bc.escape).lengths(pa.array(texts))
    assert got == pytest.approx(plain_lengths("text", 3, 4, learn, texts, plain_escape), rel=1e-5, abs=1e-4)


def test_identified_languages_equal_a_plain_model(spark):
    learn = [("aa", t) for t in made(4, "abcd", 30, 12)] + [("bb", t) for t in made(5, "abef", 10, 12)]
    langs, model = language_id.learn(spark.createDataFrame([(t, x) for x, t in learn], "text string, lang string"))
    texts = [*made(6, "abcdef", 12, 3), *(t for _, t in learn[::7])]
    bits = plain_lengths("text", language_id.ORDER, language_id.LEAST, learn, texts, plain_escape)
    rows = language_id.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), langs, model).collect()
    for r in rows:
        b = bits[r["doc_id"]]
        assert r["lang_pred"] == langs[b.argmin()]
        assert r["score"] == pytest.approx(1 / sum(2 ** min(0, b.min() - x) for x in b), rel=1e-3)


def test_url_model_equals_a_plain_one(spark):
    learn = [(0, f"site{i % 7}.org/fr/page{i}") for i in range(40)] + [(1, f"casino-{'win' * (i % 3)}.net/{i}") for i in range(12)]
    texts = ["site3.org/fr/x", "casino.net/", "", "unseen~host/é"]
    model = url_filter.learn(spark.createDataFrame(learn, "label int, text string"))
    want = plain_lengths("url", url_filter.ORDER, url_filter.LEAST, learn, texts, plain_interpolation)
    assert model.lengths(pa.array(texts)) == pytest.approx(want, rel=1e-5, abs=1e-4)


def test_contexts_of_a_rare_class_survive_many_of_a_large_one(spark):
    """A large class with more contexts than its quota takes none from a rare one."""
    r = random.Random(7)
    large = [(0, "".join(r.choice("abcdefghijklm") for _ in range(300))) for _ in range(60)]
    rare = [(1, "zyxw zyxw zyxw zyxw zyxw")]
    counts = bc.count_contexts(spark.createDataFrame(large + rare, "label int, text string"), "text", 3)
    deepest = bc.levels(counts, "text", 3, 50, 4)[3]
    own = {c for c, label in zip(deepest["context"].tolist(), deepest["label"].tolist()) if label == 1}
    assert len(own) == 6                                        # zyx yxw xw_ w_z _zy, and the start that both share
    assert len(set(deepest["context"].tolist())) == 55          # and 50 of the large class
    model = bc.freeze("text", 3, 2, bc.levels(counts, "text", 3, 50, 4), bc.escape)
    bits = model.lengths(pa.array(["zyxw zyxw"]))
    assert bits[0, 1] < bits[0, 0]


def test_url_contexts_beyond_the_quota_count_in_full(spark):
    """Scores do not depend on how many contexts fit into the table of every task; copies of a text are scored alike."""
    learn = [(0, f"{t.replace(' ', '.')}/fr") for t in made(8, "abcdef", 40, 4)] + [(1, f"{t.replace(' ', '-')}/win") for t in made(9, "abcxyz", 20, 4)]
    urls = spark.createDataFrame(learn, "label int, text string")
    want = plain_lengths("url", url_filter.ORDER, url_filter.LEAST, learn, texts := [*(t for _, t in learn[::5]), "abab.cdef/fr", "", "é", learn[0][1]], plain_interpolation)
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    model = url_filter.learn(urls, nodes=15)
    assert len(model.codes) <= 30 and model.rest.count() > 60
    whole = url_filter.learn(urls)
    assert whole.rest is None and len(whole.codes) == len(model.codes) + model.rest.count()
    for m in (model, whole):
        got = {r["i"]: r["_score"] for r in url_filter.scored(rows, m).collect()}
        assert [got[i] for i in range(len(texts))] == pytest.approx([(b[0] - b[1]) / max(1, len(t)) for t, b in zip(texts, want)], rel=1e-4, abs=1e-5)


def test_no_class_and_empty_table(spark):
    assert language_id.learn(spark.createDataFrame([], "text string, lang string")) == ([], None)
