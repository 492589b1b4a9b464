import math
import re
import zlib
from collections import Counter

import numpy as np
from corpusmill.llm import quality
from corpusmill.llm.queries import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy_on_given_labels(spark):
    """Trained on four fifths of the labels, tested on the rest."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored = quality.score_documents(docs, labels.filter("doc_id % 5 <> 0")).join(labels.filter("doc_id % 5 = 0"), "doc_id").collect()
    good = [r for r in scored if r.quality == 1]
    bad = [r for r in scored if r.quality == 0]
    kept, dropped = np.mean([r.keep for r in good]), np.mean([not r.keep for r in bad])
    print("kept", kept, "dropped", dropped, len(good), len(bad), [r.doc_id for r in scored if r.keep != (r.quality == 1)][:20])
    assert kept >= 0.98 and dropped >= 0.9
    probability = np.array([r.score for r in scored])
    assert abs(probability.mean() - np.mean([r.quality for r in scored])) < 0.03  # calibrated


def test_views_exchange_labels():
    """The metadata view, useless on few labels, learns from the text view's pseudo-labels."""
    rnd = np.random.default_rng(0)
    n = 3_000
    truth = rnd.integers(0, 2, n)
    features = rnd.normal(size=(n, quality.TEXT_FEATURES))
    features[:, 0] += 6 * truth
    slots = quality.meta_features(["en"] * n, [f"s{2 * int(rnd.integers(0, 30)) + y}" for y in truth], [0] * n)
    label = np.where(np.arange(n) < 150, truth, -1)
    order = np.arange(n) * 37 % 1000
    model = quality.cotrain(features, slots, label, order)
    _, meta, score = model.scores(features, slots)
    rest = label < 0
    assert ((score > 0.5) == truth)[rest].mean() > 0.95
    assert np.corrcoef(meta[rest], truth[rest])[0, 1] > 0.4


def test_edges(spark):
    rows = [(1, None, None, None, None, 1), (2, "", "en", "s", 0, 2), (3, " \n ", "en", "s", 3, 3), (4, "word " * 40_000, "en", "s", 200_000, 4), (4, "word " * 40_000, "en", "s", 200_000, 4), (None, "a b", "en", "s", 3, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score long")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.keep_good(docs, none).count() == len(rows)  # nothing to learn from: all stay
    assert quality.fit(docs.limit(0), none) is None
    good = "The cat sat on the mat, and then it went away. "
    more = spark.createDataFrame([(10 + i, (good * (3 + i % 4)) if i % 2 else "$$$ ### " * (5 + i % 7), "en", f"s{i % 3}", 10, 0) for i in range(120)], docs.schema)
    labels = spark.createDataFrame([(10 + i, i % 2) for i in range(120)] + [(10, 1), (10, None), (None, 1), (11, 7)], "doc_id long, quality int")
    every = docs.unionByName(more)
    out = quality.keep_good(every, labels)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert {11, 13, 15} <= set(ids) and not {12, 14, 16} & set(ids)
    scored = quality.score_documents(every, labels)
    assert scored.count() == every.count() and scored.filter("score is null or isnan(score)").count() == 0


def test_every_unlabelled_document_takes_part(spark):
    """A source that only the last of 11,000 documents by hash have is learnt from the text view's labels."""
    from pyspark.sql import functions as F

    n = 11_000
    by_hash = [r.id for r in spark.range(n).orderBy(F.xxhash64("id", F.lit("cotrain"))).collect()]
    rare = {i for i in by_hash[-200:] if i % 2 and i >= 300}
    rows = [(i, "$$$ ### " * (18 + i % 7) if i % 2 else "The cat sat on the mat, and then it went away. " * (3 + i % 3), "en", "rare" if i in rare else f"s{i % 3}", 10) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(300)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    slot = quality.meta_features(["en"], ["rare"], [10])[0, 1]
    assert len(rare) > 50 and model.meta[slot] < -0.2  # 0 where none of them takes part


GROUPS = [rb"a-z", rb"A-Z", rb"0-9", rb"\x80-\xff", rb".,;:'\"?-", rb"!", rb"#$%&*|<>{}\[\]=+@/\\^~`_", rb"\n", rb" "]


def plain_text_view(text):
    """The text view of one document, from its definition."""
    raw = text.encode()
    if not raw:
        return [0.0] * quality.TEXT_FEATURES
    out = [len(re.findall(b"[" + g + b"]", raw)) / len(raw) for g in GROUPS]
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw.lower())
    if not words:
        return out + [0.0] * 13
    m, lines = len(words), text.split("\n")
    sizes, counts = [len(w) for w in words], Counter(words)
    mean = sum(sizes) / m
    shares = [c / m for c in counts.values()]
    out += [mean, math.sqrt(sum((x - mean) ** 2 for x in sizes) / m), len(counts) / m, len(counts) / math.sqrt(m), max(shares), -sum(x * math.log(x) for x in shares)]
    out += [sum(a == b for a, b in zip(words, words[1:])) / m, sum(bool(re.search(b"[" + GROUPS[6] + b"]", w)) for w in words) / m, sum(x <= 3 for x in sizes) / m]
    return out + [1 - len(set(lines)) / len(lines), m / len(lines), math.log2(len(lines)), len(text) / len(lines)]


def plain_meta_view(lang, source, n):
    a = 16 if lang is None else zlib.crc32(lang.encode()) % 16
    b = 64 if source is None else zlib.crc32(source.encode()) % 64
    return [a, 17 + b, 82 + (33 if n is None else min(32, n.bit_length()))]


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def newton(rows, penalty=1.0, steps=25, start=None, limit=None, stop=1e-6):
    """Penalised logistic regression over rows (features, label, weight), the last feature being 1; one pass of Newton's method a step."""
    w = np.zeros(len(rows[0][0])) if start is None else start
    for _ in range(steps):
        g, h = np.zeros(len(w)), np.diag([penalty] * (len(w) - 1) + [1e-6])
        for x, y, share in rows:
            p = sigmoid(float(x @ w))
            g += share * (y - p) * x
            h += share * p * (1 - p) * np.outer(x, x)
        g -= np.array([penalty] * (len(w) - 1) + [1e-6]) * w
        step = np.linalg.solve(h, g)
        if limit:
            step *= min(1.0, limit / max(limit, np.abs(step).max()))
        w = w + step
        if np.abs(step).max() < stop:
            break
    return w


def plain_cotrain(rows, labels, order):
    """Scores of rows (text, lang, source, n_chars) by co-training, document by document: labels is {row: 0 or 1}, order {row: number}."""
    held = [i for i in labels if order[i] % 1000 < 300]
    train = [i for i in labels if i not in held]
    free = [i for i in range(len(rows)) if i not in labels]
    text = np.array([plain_text_view(r[0] or "") for r in rows])
    edges = [np.quantile(text[train, k], quality.QUANTILES) for k in range(text.shape[1])]
    views = [np.zeros((len(rows), text.shape[1] * quality.BINS + 1)), np.zeros((len(rows), 117))]
    for i, r in enumerate(rows):
        for k, e in enumerate(edges):
            views[0][i, k * quality.BINS + sum(text[i, k] >= x for x in e)] = 1
        views[1][i, plain_meta_view(*r[1:])] = 1
        views[0][i, -1] = views[1][i, -1] = 1
    line = lambda xs, w: np.array([float(x @ w) for x in xs])
    scale = lambda v, w: newton([(np.array([float(v[i] @ w), 1.0]), labels[i], 1.0) for i in held], penalty=1e-3)
    weights = [newton([(v[i], labels[i], 1.0) for i in train]) for v in views]
    for _ in range(quality.ROUNDS):
        sure = []
        for k in (0, 1):  # what the other view is sure of
            v, w = views[1 - k], weights[1 - k]
            a, b = scale(v, w)
            sure.append([(i, int(p >= 0.5)) for i in free for p in [sigmoid(float(v[i] @ w) * a + b)] if max(p, 1 - p) >= quality.CONFIDENT])
        for _ in range(25):
            most = 0.0
            for k in (0, 1):
                of = Counter(y for _, y in sure[k])
                known = [(views[k][i], labels[i], 1.0) for i in train]
                taught = [(views[k][i], y, min(1.0, sum(labels[j] == y for j in train) / of[y])) for i, y in sure[k]]
                before = weights[k]
                weights[k] = newton(known + taught, steps=1, start=before, limit=quality.LONGEST)
                most = max(most, np.abs(weights[k] - before).max())
            if most < 1e-3:
                break
    scales = [scale(v, w) for v, w in zip(views, weights)]
    odds = np.stack([line(v, w) * a + b for v, w, (a, b) in zip(views, weights, scales)], 1)
    last = newton([(np.array([*odds[i], 1.0]), labels[i], 1.0) for i in held], penalty=1e-3)
    return odds, [sigmoid(float(o @ last[:2]) + last[2]) for o in odds]


def test_scores_match_a_plain_version(spark):
    """Features, exchange of labels, calibration and combination against a version that goes document by document."""
    rnd = np.random.default_rng(5)
    some = "the cat sat on a mat and then it went far away to see its old friend".split()
    rows = []
    for i in range(260):
        bad = rnd.random() < 0.4
        words = [("$#%" if bad and rnd.random() < 0.5 else str(rnd.choice(some))) + ("!" if rnd.random() < 0.1 else "") for _ in range(int(rnd.integers(3, 40)))]
        text = "".join(w + str(rnd.choice([" ", " ", " ", "\n"])) for w in words)
        rows.append((text, ["en", "de", None][i % 3], f"s{(2 if bad else 0) + int(rnd.integers(0, 4))}", len(text)))
    rows += [(None, "en", "s1", None), ("", "de", None, 0), ("É 7\n\n!", "en", "s1", 6)]
    truth = [int("$" not in (r[0] or "$")) for r in rows]
    labels = {i: truth[i] for i in range(0, 260, 2)}
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    given = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score_documents(docs, given).collect()}
    order = {r.doc_id: r.o for r in docs.selectExpr("doc_id", "pmod(xxhash64(doc_id), 1000000) AS o").collect()}
    odds, scores = plain_cotrain(rows, labels, order)
    assert 0.2 < np.mean([s >= 0.5 for s in scores]) < 0.9
    for i in range(len(rows)):
        assert np.allclose([got[i].text_score, got[i].meta_score, got[i].score], [*odds[i], scores[i]], atol=2e-3), i
        assert got[i].keep == (got[i].score >= quality.KEEP)


def test_repeats_of_a_labelled_document_come_to_the_driver_once(spark, monkeypatch):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    first = labels.filter("quality is not null").orderBy("doc_id").first().doc_id
    many = docs.unionByName(docs.filter(F.col("doc_id") == first).crossJoin(spark.range(3000)).drop("id"))
    seen = []
    learn = quality.cotrain
    monkeypatch.setattr(quality, "cotrain", lambda text, *rest: seen.append(len(text)) or learn(text, *rest))
    quality.fit(many, labels)
    quality.fit(docs, labels)
    assert seen[0] == seen[1] <= labels.count()


def test_columns_of_clashing_names_pass_through(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    clash = ["own_label", "chosen_id", "own_order", "views", "view_text", "c0", "keep", "score", "vote", "codes", "quality"]
    more = docs.select("*", *[F.lit(f"<{c}>").alias(c) for c in clash])
    kept = quality.keep_good(more, labels)
    assert kept.columns == more.columns
    assert {tuple(r) for r in kept.select("doc_id", *clash).collect()} == {(r.doc_id, *[f"<{c}>" for c in clash]) for r in quality.keep_good(docs, labels).collect()}
