"""The text operators against plain versions on a small fixture with nulls, empty and long texts, ties,
repeated rows and columns with clashing names; and on empty tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vatlens.llm import (byte_context, common, exact_dedup, language_id, line_dedup, lm_scoring, mixing, ngram_join,
                         packing, quality, toxicity, url_filter)

SPACE = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept int, _row string"


def lowered(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(t))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    vocab = {"en": ["the", "of", "and", "stone", "river", "walk", "light", "thing", "house", "window"],
             "de": ["der", "und", "nicht", "über", "schön", "zeit", "straße", "haus", "wald", "licht"]}
    out = []
    for i in range(120):
        lang = "en" if i % 3 else "de"
        n = int(rng.integers(25, 90))
        out.append((i, " ".join(rng.choice(vocab[lang], n)) + ".\nFooter line with more than twenty letters", lang, f"s{i % 2}"))
    base = " ".join(rng.choice(vocab["en"], 80))
    out += [(200, base, "en", "s0"), (201, base.upper(), "en", "s0"), (202, base + " window", "en", "s1"), (203, base, "en", None)]
    out += [(300, None, "en", "s0"), (301, "", None, "s0"), (302, "one", "en", "s0"), (303, "two words", "en", "s0"), (304, " \t\n", "en", "s1"),
            (305, "12 34 !!", "en", "s1"), (306, "%% " * 40, "en", "s1"), (307, "word " * 5000, "en", "s0"), (None, "a null id text", "en", "s0")]
    out += [(200, base, "en", "s0"), (400, "x" * 30000, "en", "s0")]
    return [(*r, len(r[1] or ""), 1, "own") for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3, "n_chars").cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_word_hashes_are_words():
    texts = ["Hello  World", "", None, " a b\tC\n", "x" * 1_500_000 + " yy", "a", "hello"]
    h, first = common.word_hashes(*common.text_bytes(pa.array(texts)))
    plain = [w for t in texts for w in words(t)]
    assert first.tolist() == np.cumsum([0] + [len(words(t)) for t in texts]).tolist()
    assert len(set(zip(plain, h.tolist()))) == len(set(plain)) == len(set(h.tolist()))


def test_exact_dedup(docs, rows, empty):
    got = sorted(map(tuple, exact_dedup.exact_dedup(docs).collect()), key=str)
    groups = collections.defaultdict(list)
    for r in rows:
        groups[lowered(r[1])].append(r[0])
    plain = []
    for t, ids in groups.items():
        keep = max(ids, key=lambda x: -1 if x is None else x)
        left = 1
        for i in ids:
            kept = i == keep and left == 1
            left -= kept
            plain.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    assert got == sorted(plain, key=str)
    assert exact_dedup.drop_copies(docs).count() == len(groups)
    assert exact_dedup.drop_copies(docs).columns == docs.columns
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_heavy_and_rest_agree(docs):
    a, b = (exact_dedup.exact_dedup(docs, heavy, 64).groupBy("doc_id", "keep_id", "group_size", "kept").count().exceptAll(
        exact_dedup.exact_dedup(docs).groupBy("doc_id", "keep_id", "group_size", "kept").count()).count() for heavy in (1, 8))
    assert (a, b) == (0, 0)


def test_line_dedup(docs, rows, empty):
    def key(line):
        return lowered(line.strip(SPACE))
    held = collections.defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            held[key(line)].add(-1 if r[0] is None else r[0])
    bad = {k: max(v) for k, v in held.items() if len(k) >= 20 and len(v) >= 3}
    plain = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if bad.get(key(x), r[0]) == r[0]]
        plain.append((r[0], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    assert sorted(map(tuple, line_dedup.line_dedup(docs).collect()), key=str) == sorted(plain, key=str)
    assert sum(p[2] for p in plain) > 100
    assert line_dedup.line_dedup(empty).count() == 0


def test_ngram_join(docs, rows, empty):
    def shingles(t):
        w = words(t)
        return frozenset(tuple(w[i:i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = collections.defaultdict(lambda: None)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = r[0] if least[find(i)] is None else min(least[find(i)], r[0])
    plain = sorted([(r[0], len(sets[i]), least[find(i)]) for i, r in enumerate(rows)], key=str)
    assert sorted(map(tuple, ngram_join.ngram_join(docs).collect()), key=str) == plain
    kept = ngram_join.drop_near_copies(docs)
    groups = len({find(i) for i in range(len(rows)) if sets[i]}) + sum(not s for s in sets)
    assert kept.count() == groups and kept.columns == docs.columns
    assert ngram_join.ngram_join(empty).count() == 0


def test_ngram_join_chain_and_hub(spark):
    """Near copies that meet only through a hub, and a chain without one, end in the right groups."""
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(200)]
    made = [(0, " ".join(base))]
    for i in range(1, 40):
        t = list(base)
        for k in rng.choice(200, 2, replace=False):
            t[k] = f"n{i}x{k}"
        made.append((i, " ".join(t)))
    chain = [f"c{i}" for i in range(100)]
    made += [(100 + i, " ".join(chain[i * 3:] + [f"d{j}" for j in range(i * 3)])) for i in range(6)]
    got = dict((r.doc_id, r.component_id) for r in ngram_join.ngram_join(spark.createDataFrame(made, "doc_id long, text string")).collect())
    assert {got[i] for i in range(40)} == {0}
    assert {got[100 + i] for i in range(6)} == {100}


def test_near_copies_of_the_pipeline(spark):
    """The pipeline's stage against all pairs: five-word shingles, similarity 0.8, which op9's 3 and 0.9 would leave."""
    import corpus_pipeline

    rng = np.random.default_rng(8)
    made = []
    for i in range(25):
        w = [f"a{i}w{k}" for k in range(int(rng.integers(60, 160)))]
        made.append(w)
        for gap in range(3):
            t = list(w)
            for k in rng.choice(len(w), 1 + gap, replace=False):
                t[k] = f"b{i}g{gap}k{k}"
            made.append(t)
    made += [["one"], ["one"], ["one", "two", "three", "four"], ["one", "two", "three", "four"], ["one", "two", "three", "five"], [], []]

    def groups(size, percent):
        sets = [frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []) for w in made]
        root, between = list(range(len(made))), 0
        for i in range(len(made)):
            for j in range(i):
                same, every = len(sets[i] & sets[j]), len(sets[i] | sets[j])
                between += every and 80 * every <= 100 * same < 90 * every
                if every and 100 * same >= percent * every:
                    a, b = root[i], root[j]
                    root = [min(a, b) if x in (a, b) else x for x in root]
        return {i for i, r in enumerate(root) if r == i or not sets[i]}, between
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(made)], "doc_id long, text string")
    plain, between = groups(5, 80)
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"]
    assert between > 20 and plain != groups(3, 90)[0]
    assert {r.doc_id for r in stage(spark, docs, "").collect()} == plain
    for size, percent in ((3, 90), (2, 73), (1, 100)):
        assert {r.doc_id for r in ngram_join.drop_near_copies(docs, size, percent).collect()} == groups(size, percent)[0]


def test_packing_round_trip(docs, rows, empty):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(packing.vocabulary()[0])
    got = packing.pack(docs).toPandas()
    plain = collections.Counter()
    for r in rows:
        ids = np.array(exact.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        start = 0
        for k, n in enumerate(packing.piece_lengths(len(ids))):
            plain[(-1 if r[0] is None else r[0], k, start, n, zlib.crc32(ids[start:start + n].tobytes()))] += 1
            start += n
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert collections.Counter(map(tuple, got[cols].fillna(-1).astype("int64").to_numpy().tolist())) == plain
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.offset == got.groupby("sequence_id").length.cumsum() - got.length).all()
    assert got.groupby("sequence_id").length.sum().max() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 1
    assert packing.pack(empty).count() == 0


def test_packing_special_string_and_waste():
    from tokenizers import Tokenizer

    exact, text = Tokenizer.from_file(packing.vocabulary()[0]), "a<|endoftext|>b é\n\n  ça"
    assert packing.encoder(packing.vocabulary())(text).tolist() == exact.encode(text, add_special_tokens=False).ids
    x = np.random.default_rng(0).integers(1, 2049, 5000)
    where, offset = packing.pack_shard(x)
    assert np.bincount(where, weights=x).max() <= 2048
    tight, _ = packing.place(np.sort(x)[::-1], tightest=True)
    assert where.max() + 1 <= 1.02 * (tight.max() + 1)
    assert packing.piece_lengths(4097) == [1, 2048, 2048] and packing.piece_lengths(2048) == [2048]


def test_language_id(docs, rows, empty):
    got = {r.doc_id: r for r in language_id.held_out_languages(docs).collect()}
    for i in (300, 301, 304, 305):
        assert got[i].lang_pred == "und" and got[i].score == 0
    out = [r for r in rows if r[0] is not None and r[0] < 120 and zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert out and all(got[r[0]].held_out and got[r[0]].lang_pred == r[2] and 0 <= got[r[0]].score <= 1 for r in out)
    assert language_id.held_out_languages(empty).count() == 0


def test_context_rules_are_distributions():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 3, (5, 7, 2)).astype(float)
    counts[0] = 0
    counts[1] = 4
    parent = rng.random((5, 7, 2))
    parent /= parent.sum(1, keepdims=True)
    for rule in (byte_context.escape, byte_context.interpolate):
        p = rule(counts, parent)
        assert np.allclose(p.sum(1), 1) and (p > 0).all()


def test_code_lengths_do_not_depend_on_chunks(spark, monkeypatch):
    texts = [(0, "Das ist ein Test, Äpfel."), (1, "this is a test " * 50), (0, ""), (1, "é")]
    learn = spark.createDataFrame(texts, "label int, text string")
    model = byte_context.freeze("text", 3, 2, byte_context.levels(byte_context.count_contexts(learn, "text", 3), "text", 3, 100, 1), byte_context.escape)
    column = pa.array([t for _, t in texts] + [None])
    whole = model.lengths(column)
    cut = byte_context.streams
    monkeypatch.setattr(byte_context, "streams", lambda c, f, o: cut(c, f, o, 40))
    assert np.allclose(whole, model.lengths(column)) and not whole[2].any() and not whole[4].any()


def test_url_filter(spark):
    urls = [None, "", "no scheme", "https://A.Example.NET/en/x?y#z", "http://net", "http://net/", "http://x.net?q=/", "http://fr.org/fr/a", "http://xorg/fr/",
            "ftp://m.example.com/de/1", "http://m.example.com/de"] + [f"https://site{i}.example.com/en/{i}" for i in range(150)] + [f"http://casino-win{i % 7}.example.com/en/{i}" for i in range(60)] \
        + [f"http://free-casino.example.com/en/{i}" for i in range(60)]
    got = {r.page_id: r for r in url_filter.url_filter(spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(urls)], "page_id long, url string, html string")).collect()}
    expected = [("", "", None, "allow")] * 3 + [("a.example.net", "/en/x", "example.net/en/", "allow"), ("net", "", None, None), ("net", "/", "net/", "block"),
                ("x.net", "", None, None), ("fr.org", "/fr/a", "org/fr/", "allow"), ("xorg", "/fr/", None, None), ("m.example.com", "/de/1", "example.com/de/", "block"),
                ("m.example.com", "/de", None, None)]
    for i, (host, path, rule, verdict) in enumerate(expected):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule) and verdict in (None, got[i].verdict)
    assert sum(got[i].verdict == "allow" for i in range(11, 161)) >= 148
    assert all(got[i].verdict == "block" for i in range(221, 281))
    assert url_filter.url_filter(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_labels_follow_the_rule_before_the_words(spark):
    made = ["http://casino.org/fr/x", "http://casino.org/en/x", "http://plain.net/", "http://a.casino.net/", "http://casino.example.com/de/", "http://plain.org/fr/"]
    sites = url_filter.parsed(spark.createDataFrame(list(enumerate(made)), "page_id long, url string"))
    got = {r.text: r.label for r in url_filter.labelled(sites, ["casino"]).collect()}
    assert got == {"casino.org/fr/x": 0, "casino.org/en/x": 1, "plain.net/": 1, "a.casino.net/": 1, "casino.example.com/de/": 1, "plain.org/fr/": 0}


def test_toxicity(spark):
    rng = np.random.default_rng(3)
    plain, made = ["walk", "house", "river", "stone", "light"], []
    for i in range(600):
        w = list(rng.choice(plain, 12))
        toxic = i % 4 == 0
        if toxic:
            w += ["scumbag"] if i % 8 else ["vermin"]
            w += ["muslims"] * (i % 3 > 0)
        made.append((i, " ".join(w), int(toxic)))
    made += [(600 + i, t, None) for i, t in enumerate([None, "", "muslims walk by the river", "christians walk by the river", "you scumbag"])]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in made], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in made if y is not None] + [(None, 1, 1), (0, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.held_out_toxicity(docs, labels).collect()}
    assert all(got[i].predicted == y for i, _, y in made if y is not None)
    assert got[602].predicted == 0 and abs(got[602].score - got[603].score) < 0.15      # a neutral mention of a group
    assert got[604].predicted == 1 and 0 <= got[600].score == got[601].score <= 0.5
    assert toxicity.held_out_toxicity(docs, labels.limit(0)).where("predicted = 0").count() == len(made)


def test_toxicity_features_of_all_labels(spark):
    """A toxic word of texts outside the fitted sample is still counted as a feature; the sample is bounded."""
    made = [(i, f"walk river {'scumbag' if i % 5 == 0 else 'stone'} " + ("vermin" if i % 40 == 0 else ""), int(i % 5 == 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in made], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in made], "doc_id long, toxic int")
    picked = {r.doc_id for r in toxicity.sampled(docs, labels, 60).collect()}
    assert toxicity.labelled_words(docs, labels).count() == 400 and len(picked) == 60
    assert sum(i % 40 == 0 for i in picked) < toxicity.LEAST
    model = toxicity.learn(docs, labels, sample=60)
    assert "vermin" in model.index and "scumbag" in model.index
    assert toxicity.SAMPLE == 40_000


def test_lm_scores(docs, rows, empty):
    got = lm_scoring.held_out_scores(docs).toPandas()
    tokens = [words(r[1]) + ["</s>"] for r in rows]
    train = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 != 1 for r in rows]
    c = collections.Counter(w for t, k in zip(tokens, train) if k for w in t)
    n, v = sum(c.values()), len(c)
    plain = sorted((-1 if r[0] is None else r[0], not k, len(t), sum(w in c for w in t), n,
                    round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)) for r, t, k in zip(rows, tokens, train))
    mine = sorted(zip(got.doc_id.fillna(-1).astype(int), got.held_out, got.n_tokens, got.n_known, got.train_tokens, got.base_score.round(6)))
    assert mine == plain
    assert got.score.sum() > got.base_score.sum()
    assert lm_scoring.held_out_scores(empty).count() == 0


def test_texts_are_scored_in_parts(spark, monkeypatch):
    """Every row is scored once, in one of the parts, with the score it has without parts; copies and empty texts too."""
    docs = spark.createDataFrame([(i % 9, t) for i, t in enumerate(["a b c a b", "b c d", "", None, "a b c a b", "x y"] * 4)], "doc_id long, text string")
    total, weights, model = lm_scoring.train_automaton(docs.select("text"), common=0.3, arcs=0.3)
    seen, one = [], lm_scoring.score_part
    monkeypatch.setattr(lm_scoring, "score_part", lambda part, *a: seen.append(part.count()) or one(part, *a))
    rows = sorted((r.doc_id, r.n_tokens, round(r.score, 9)) for r in lm_scoring.score(docs, total, weights, model).collect())
    assert sum(seen) == len(rows) == 24 and len(seen) == lm_scoring.PARTS and min(seen) > 0
    whole = one(docs, total, weights, model.unseen, spark.sparkContext.broadcast(model), 1)
    assert rows == sorted((r.doc_id, r.n_tokens, round(r.score, 9)) for r in whole.collect())


def test_questions_are_sent_in_bounded_blocks(spark, monkeypatch):
    """A task does not hold the questions of all its texts, and the blocks change no score."""
    docs = spark.createDataFrame([(i, f"a b c a b w{i} c a v{i} b") for i in range(64)] + [(64, ""), (65, None)], "doc_id long, text string").coalesce(1)
    total, weights, model = lm_scoring.train_automaton(docs.select("text"), common=1.0, arcs=1.0)

    def scores():
        out = lm_scoring.score_part(docs, total, weights, model.unseen, spark.sparkContext.broadcast(model), 3)
        return sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 9), round(r.score, 9)) for r in out.collect())
    whole, bucket_of = scores(), lm_scoring.bucket_of

    def bounded(grams, buckets):
        assert len(grams) <= 2 * (40 + 4 * 11), "a block of some 40 tokens and one batch"
        return bucket_of(grams, buckets)
    monkeypatch.setattr(lm_scoring, "bucket_of", bounded)
    monkeypatch.setattr(lm_scoring, "ASK_TOKENS", 40, raising=False)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        assert scores() == whole and len(whole) == 66
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_ngrams_are_counted_a_length_at_a_time(spark, monkeypatch):
    """One shuffle does not hold the n-grams of all lengths, and the counts are those of one that does."""
    train = spark.createDataFrame([("a b c a b c d",), ("a b c",), ("",), (None,)], "text string")
    twice = spark.sparkContext.broadcast(lm_scoring.seen_twice(train, 4, lm_scoring.BITS))
    rows = {k: sorted(map(tuple, lm_scoring.gather(train, b, 3, twice, a).collect())) for k, (a, b) in {"all": (1, 4), "short": (1, 2), "3": (3, 3), "4": (4, 4)}.items()}
    assert rows["all"] == sorted(rows["short"] + rows["3"] + rows["4"]) and {r[0] for r in rows["3"]} == {3}
    counted, gather = [], lm_scoring.gather
    monkeypatch.setattr(lm_scoring, "gather", lambda *a: counted.append((a[4], a[1])) or gather(*a))
    lm_scoring.train_automaton(train, order=4)
    assert counted == [(1, 2), (3, 3), (4, 4)]


def test_lm_automaton_against_recursion(spark):
    """Array passes equal a token-by-token walk, and a state's distribution sums to one."""
    texts = ["a b a b c", "a b c", "b c a", "a b a b a", "c c c a b"]
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    total, _, model = lm_scoring.train_automaton(train, order=3, common=0.0, arcs=1e-9)
    uni, grams = collections.Counter(), {2: collections.Counter(), 3: collections.Counter()}
    for t in texts:
        w = t.split() + ["$"]
        uni.update(w)
        for k in (2, 3):
            grams[k].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    kept = {k: {g: m for g, m in grams[k].items() if m >= 2} for k in (2, 3)}
    counts = {1: {(w,): m for w, m in uni.items()}, **kept}

    def p(context, w):
        if not context:
            return (uni[w] - total.discount) / total.tokens if uni[w] else total.discount * total.types / total.tokens
        arcs = {g: m for g, m in kept[len(context) + 1].items() if g[:-1] == context} if len(context) < 3 else {}
        low = p(context[1:], w)
        if not arcs:
            return low
        seen = counts[len(context)][context]
        left = 1 - sum(m - lm_scoring.DISCOUNT for m in arcs.values()) / seen
        return (arcs[context + (w,)] - lm_scoring.DISCOUNT if context + (w,) in arcs else 0) / seen + left * low
    assert sum(p(("a", "b"), w) for w in [*uni, "?"]) == pytest.approx(1)
    for t in texts:
        w = t.split() + ["$"]
        _, _, tokens, starts = next(lm_scoring.token_runs(pa.array([t])))
        logs, _, rare = model.walk(tokens, starts)
        assert not rare.any()
        assert logs.sum() == pytest.approx(sum(math.log10(p(tuple(w[max(0, i - 2):i]), x)) for i, x in enumerate(w)))


def test_lm_rare_ngrams_stay_in_the_model(spark):
    """Scores do not depend on how much is broadcast: n-grams below that share are looked up."""
    rng = np.random.default_rng(6)
    made = [(i, " ".join(f"w{int(k)}" for k in rng.zipf(1.3, 60) % 400)) for i in range(80)] + [(80, None), (81, "never seen"), (82, "w1")]
    train = spark.createDataFrame([(t,) for _, t in made[:60]], "text string").repartition(3).cache()
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(3).cache()

    def scores(common, arcs, bits=lm_scoring.BITS):
        total, rest, model = lm_scoring.train_automaton(train, common=common, arcs=arcs, bits=bits)
        return {r.doc_id: r for r in lm_scoring.score(docs, total, rest, model).collect()}
    whole = scores(0.0, 1e-9)
    # the smallest filter has false hits, which must not change a score either
    for setting in ((0.0, 0.01), (0.01, 0.01), (1.0, 1.0), (1.0, 1.0, 1 << 16)):
        got = scores(*setting)
        assert len(got) == len(made)
        for i, r in whole.items():
            assert (got[i].n_tokens, got[i].n_known) == (r.n_tokens, r.n_known)
            assert got[i].score == pytest.approx(r.score) and got[i].base_score == pytest.approx(r.base_score)


def test_quality_statistics(docs, rows, empty):
    def plain(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        count = collections.Counter(windows)
        covered = {j for i, x in enumerate(windows) if count[x] > 1 for j in range(i, i + 8)}
        lines = [x for x in (t or "").split("\n") if x.strip(SPACE)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)
    got = quality.quality_rules(docs).collect()
    key = lambda x: str(x)
    assert sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got], key=key) == \
        sorted([(r[0], *plain(r[1])) for r in rows], key=key)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.kept and r.base_failed)
    by = {r.doc_id: r for r in got}
    assert all(by[i].kept for i in range(120)) and not by[306].kept
    left = quality.drop_rejected(docs)
    assert left.count() == sum(r.kept for r in got) and left.columns == docs.columns
    assert quality.quality_rules(empty).count() == 0


def test_quality_distance(spark):
    """The distance is that of the regularised estimate of the core."""
    rng = np.random.default_rng(4)
    made = [(i, " ".join("x" * int(k) for k in rng.integers(2, 8, 60)), "en", "s") for i in range(200)] + [(900 + i, "|$% " * 60 + f"{i}", "en", "s") for i in range(20)]
    got = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(made, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i].kept for i in range(200)) and not any(got[900 + i].kept for i in range(20))
    stats = quality.statistics(spark.createDataFrame(made, "doc_id long, text string, lang string, source string")).toPandas().set_index("doc_id")
    x = stats[quality.NAMES].to_numpy() / quality.SCALE
    d = np.array([got[i].distance for i in stats.index])
    core = x[np.argsort(d, kind="stable")[:int(np.ceil(quality.CORE * len(x)))]]
    floor = np.diag(np.square(list(quality.FLOORS.values())))
    gap = x - core.mean(0)
    again = np.einsum("ij,jk,ik->i", gap, np.linalg.inv(quality.consistency(quality.CORE) * np.cov(core.T, bias=True) + floor), gap)
    assert np.allclose(d, again, rtol=0.15, atol=0.1)


def test_consistency_factor():
    """The inner half of a normal sample has the factor's inverse as variance (one dimension: a known value)."""
    x = np.sort(np.abs(np.random.default_rng(0).normal(size=400_000)))
    assert 1 / quality.consistency(0.5, 1) == pytest.approx(np.mean(x[:200_000] ** 2), rel=1e-2)
    assert quality.chi_square(3.841458820694124, 1) == pytest.approx(0.95) and quality.chi_square(14.067140449340169, 7) == pytest.approx(0.95)


def plain_mcd(x, floor, starts=60):
    """(mean, inverse covariance, log determinant): the best of many random starts, steps on exactly the core's rows."""
    rng, h, factor = np.random.default_rng(1), int(np.ceil(quality.CORE * len(x))), quality.consistency(quality.CORE)
    best = None
    for _ in range(starts):
        core = x[rng.choice(len(x), x.shape[1] + 1, replace=False)]
        before = np.inf
        while True:
            mean, cov = core.mean(0), factor * np.cov(core.T, bias=True) + floor
            size, p = np.linalg.slogdet(cov)[1], np.linalg.inv(cov)
            if size >= before - 1e-9 and len(core) == h:
                break
            before = size if len(core) == h else np.inf
            d = np.einsum("ij,jk,ik->i", x - mean, p, x - mean)
            core = x[np.argsort(d, kind="stable")[:h]]
        if best is None or size < best[2]:
            best = (mean, p, size)
    return best


def test_quality_against_plain_mcd(spark):
    """Determinants and verdicts against a plain minimum-covariance-determinant estimate of many random starts, with a
    quarter of one group's rows far off, a group too small for its own estimate, and equal rows. Cores of nearly the same
    determinant differ in where they lie among clean rows, so distances there agree only roughly."""
    rng = np.random.default_rng(8)

    def text(far):
        words = ["x" * int(k) for k in rng.integers(2, 9, 70)]
        for at in rng.choice(70, int(rng.integers(30, 45) if far else rng.integers(0, 6)), replace=False):
            words[at] = "|$%" if far else rng.choice(["Cap!", "a;b", "UP"])
        return " ".join(words)
    made = [(i, text(i % 4 == 3), "en", "s") for i in range(400)] + [(1000 + i, text(False), "de", f"t{i % 2}") for i in range(300)] + [(2000 + i, text(i < 2), "de", "few") for i in range(10)]
    made += [(3000 + i, made[0][1], "en", "s") for i in range(20)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, source string").repartition(3)
    got = quality.quality_rules(docs).toPandas().set_index("doc_id")
    stats = quality.statistics(docs).toPandas().set_index("doc_id").loc[got.index]
    x, floor = stats[quality.NAMES].to_numpy() / quality.SCALE, np.diag(np.square(list(quality.FLOORS.values())))
    lang, source = stats.lang.to_numpy(), stats.source.to_numpy()
    found = {(r["_level"], r["_lang"], r["_source"]): r["_logdet"] for r in quality.cores(quality.statistics(docs)).collect()}
    size_of = {"en s": found[0, "=en", "=s"], "t0": found[0, "=de", "=t0"], "few": found[1, "=de", ""]}
    for name, rows, base in (("en s", (source == "s"), (source == "s")), ("t0", source == "t0", source == "t0"), ("few", source == "few", lang == "de")):
        mean, p, size = plain_mcd(x[base], floor)
        plain = np.einsum("ij,jk,ik->i", x[rows] - mean, p, x[rows] - mean)
        mine = got.distance.to_numpy()[rows]
        assert size - 0.02 <= size_of[name] <= size + 0.4, name
        assert np.allclose(mine, plain, rtol=0.35, atol=1.5), name
        clear = np.abs(plain - quality.CUTOFF) > 4
        assert ((mine > quality.CUTOFF) == (plain > quality.CUTOFF))[clear].all() and clear.mean() > 0.9, name
    assert got.kept[[i for i in range(400) if i % 4 != 3]].all() and not got.kept[[i for i in range(400) if i % 4 == 3]].any()


def test_mixing(docs, empty, spark):
    got = mixing.mix(docs).toPandas()
    assert len(got) == docs.count() and got.probability.between(0, 1).all()
    kept = mixing.sample(docs)
    assert kept.count() == got.sampled.sum() and kept.columns == docs.columns
    assert mixing.mix(empty).count() == 0
    cells = spark.createDataFrame([("=a", "=en", "=t", 1000), ("=b", "=en", "=t", 3000), ("=a", "=de", "=t", 500), ("=b", "=de", "=t", 500)],
                                  "_source string, _lang string, _topic string, _tokens long")
    p = mixing.rake(cells, {"source": {"a": 1, "b": 1}, "lang": {"en": 3, "de": 1}}, rate=0.4, tolerance=1e-9).join(cells, ["_source", "_lang", "_topic"]).toPandas()
    p["w"] = p.probability * p._tokens
    assert p.groupby("_source").w.sum().to_dict() == pytest.approx({"=a": 1000, "=b": 1000}, rel=1e-3)
    assert p.groupby("_lang").w.sum().to_dict() == pytest.approx({"=en": 1500, "=de": 500}, rel=1e-3)
    weights = np.array([[1000.0, 500.0], [3000.0, 500.0]])          # the same by plain raking
    for _ in range(200):
        weights *= (np.array([1000, 1000]) / weights.sum(1))[:, None]
        weights *= np.array([1500, 500]) / weights.sum(0)
    mine = p.set_index(["_source", "_lang"]).w
    assert mine[("=a", "=en")] == pytest.approx(weights[0, 0], rel=1e-3) and mine[("=b", "=de")] == pytest.approx(weights[1, 1], rel=1e-3)


def test_pipeline_stages(docs, spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "ngram_jaccard_join", "mixing", "best_fit_packing"]
    now, before = docs, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = common.materialise(stage(spark, now, ""), "stage")
        assert now.columns == docs.columns and now.count() <= before
        before = now.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, now, "")
    assert packed.select(F.countDistinct("doc_id")).first()[0] == now.select(F.countDistinct("doc_id")).first()[0]


def test_pipeline_against_plain_stages(spark, rows, tmp_path):
    """The rows that run() packs, against plain versions of four stages; of the quality stage the base rules are
    counted here, its robust verdict is taken from op8 (see the quality tests)."""
    from tokenizers import Tokenizer

    import corpus_pipeline

    spark.createDataFrame(rows, DOCS).repartition(3, "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    # quality: the base rules
    def base_failed(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        count = collections.Counter(windows)
        covered = {j for i, x in enumerate(windows) if count[x] > 1 for j in range(i, i + 8)}
        return len(w) < 20 or 100 * len(covered) > 30 * len(w)
    # a row is known by its id and text; equal rows are judged alike
    judged = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols): r.kept for r in quality.quality_rules(docs).collect()}

    def fate(r):
        w = re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        return judged[(r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r[1] or "")))]
    left = [r for r in rows if fate(r)]
    assert not any(base_failed(r[1]) for r in left) and len(left) > 100

    # exact copies: the largest id of equal lower-cased texts stays
    best = {}
    for r in left:
        key = lowered(r[1])
        if key not in best or (best[key][0] is None or (r[0] is not None and r[0] > best[key][0])):
            best[key] = r
    left = list(best.values())

    # near copies: the smallest id of each component of five-word shingles at 0.8
    def shingles(t):
        w = words(t)
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    sets, root = [shingles(r[1]) for r in left], list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    groups = collections.defaultdict(list)
    for i, r in enumerate(left):
        groups[root[i] if sets[i] else -1 - i].append(r)
    left = [min(g, key=lambda r: (r[0] is not None, r[0] or 0)) for g in groups.values()]

    # mixing: plain raking of the cells; the draw is the hash of the id
    def cell(r):
        t, n = r[1] or "", len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
        marks = t.count("|") + t.count("\t")
        topic = "empty" if n == 0 else "table" if marks * 5 > n else "note" if n < 100 else "article" if n < 1000 else "book"
        return (r[3], r[2], topic), n
    tokens = collections.Counter()
    for r in left:
        tokens[cell(r)[0]] += cell(r)[1]
    total, p = sum(tokens.values()), dict.fromkeys(tokens, mixing.RATE)
    for _ in range(mixing.ROUNDS):
        before = dict(p)
        for m in range(3):
            sums, now = collections.Counter(), collections.Counter()
            for c, n in tokens.items():
                sums[c[m]] += n
                now[c[m]] += p[c] * n
            whole = sum(v ** mixing.TEMPER for v in sums.values())
            p = {c: min(1.0, x * sums[c[m]] ** mixing.TEMPER / whole * mixing.RATE * total / now[c[m]]) if now[c[m]] > 0 else x for c, x in p.items()}
        if max(abs(p[c] - before[c]) for c in p) < mixing.TOLERANCE:
            break
    ids = spark.createDataFrame([(r[0],) for r in left], "doc_id long")
    number = {r[0]: r[1] for r in ids.select("doc_id", mixing.draw(mixing.SEED)).collect()}
    assert all(abs(number[r[0]] - p[cell(r)[0]]) > 1e-6 for r in left)
    sampled = [r for r in left if number[r[0]] < p[cell(r)[0]]]
    assert 0 < len(sampled) < len(left) < len(rows)

    # packing: the pieces as a set, the sequences by validity
    exact = Tokenizer.from_file(packing.vocabulary()[0])
    plain = collections.Counter()
    for r in sampled:
        ids = np.array(exact.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        start = 0
        for k, n in enumerate(packing.piece_lengths(len(ids))):
            plain[(-1 if r[0] is None else r[0], k, start, n, zlib.crc32(ids[start:start + n].tobytes()))] += 1
            start += n
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert collections.Counter(map(tuple, got[cols].fillna(-1).astype("int64").to_numpy().tolist())) == plain
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.offset == got.groupby("sequence_id").length.cumsum() - got.length).all()
    assert got.groupby("sequence_id").length.sum().max() <= 2048
