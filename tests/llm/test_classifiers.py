import math
import random
import zlib

import numpy as np

from millrace.llm import catalogue, quality, textnum, toxicity

SF = "/root/testdata/sf0.1"


def labels_of(spark, name):
    return {r.doc_id: r[name] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_toxicity_on_held_out_rows(spark):
    rows = catalogue.op10_toxicity_ftrl(spark, SF).collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    y = labels_of(spark, "toxic")
    held = [(r.score, y[r.doc_id]) for r in rows if r.held_out and r.doc_id in y]
    right = sum((s >= 0.5) == t for s, t in held) / len(held)
    pos, neg = [s for s, t in held if t], [s for s, t in held if not t]
    auc = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    print("toxicity accuracy", right, "auc", auc, len(held))
    assert right > 0.97 and auc > 0.98


def test_quality_on_held_out_rows(spark):
    y = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    feats = quality.features(docs, y.where("doc_id % 3 <> 0"))
    model = quality.train(feats)
    truth = labels_of(spark, "quality")
    rows = quality.score(feats, model).collect()
    held = [(r, truth[r.doc_id]) for r in rows if r.doc_id in truth and r.doc_id % 3 == 0]
    for view in ("content_score", "metadata_score", "score"):
        print(view, sum((r[view] >= 0.5) == t for r, t in held) / len(held))
    assert sum((r.score >= 0.5) == t for r, t in held) / len(held) > 0.98
    kept = quality.keep(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, 1.0), (None, "", "en", "s", 0, 2.0), (2, "idiot " * 30_000, "en", "s", -5, 3.0), (2, "x", "en", None, 1, 3.0)], "doc_id long, text string, lang string, source string, n_chars long, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    feats = quality.features(docs, none)
    model = quality.train(feats)
    assert [r.score for r in quality.score(feats, model).collect()] == [0.5] * 4 and quality.keep(docs, model).count() == 4
    assert toxicity.train(docs, none).count() == 0
    assert [r.score for r in toxicity.score(docs, []).collect()] == [0.0] * 4
    some = spark.createDataFrame([(1, 0, 0), (2, 1, 1), (2, 0, None), (9, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert len(toxicity.score(docs, [tuple(r) for r in toxicity.train(docs, some).collect()]).collect()) == 4
    feats = quality.features(docs, some)
    assert quality.score(feats, quality.train(feats)).count() == 4
    empty = docs.where("false")
    assert quality.score(quality.features(empty, some), model).count() == 0 and toxicity.score(empty, []).count() == 0


def ftrl(rows, rule):
    """FTRL-proximal as its update equations say, coordinate by coordinate; rows: (label, features)."""
    z, n = {}, {}

    def weight(i):
        if i == "bias":
            return -z.get(i, 0.0) / ((rule.beta + math.sqrt(n.get(i, 0.0))) / rule.alpha)
        if abs(z.get(i, 0.0)) <= rule.l1:
            return 0.0
        return -(z[i] - math.copysign(rule.l1, z[i])) / ((rule.beta + math.sqrt(n[i])) / rule.alpha + rule.l2)

    for _ in range(rule.epochs):
        for y, x in rows:
            w = {i: weight(i) for i in [*x, "bias"]}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in w:
                s = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / rule.alpha
                z[i] = z.get(i, 0.0) + g - s * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_ftrl_equals_its_update_equations(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(("bad", "worse", "awful") if i % 2 and rng.random() < 0.6 else ("fine", "good", "nice", "day", "Bad")) for _ in range(rng.randint(0, 9)))) for i in range(80)]
    rows += [(80, None), (81, rows[1][1]), (81, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(82)], "doc_id long, toxic int")
    rule = toxicity.FtrlRule(bits=12, l1=0.4, epochs=3, l2=0.1)
    model = dict(tuple(r) for r in toxicity.train(docs, labels, rule).collect())
    order = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "xxhash64(doc_id, 7) AS h").collect()}
    x = {}
    for i, t in rows:
        h, _ = textnum.stem_hashes([(t or "").encode()], textnum.NOT_WORD, rule.stems)
        x.setdefault(i, []).append(np.unique(toxicity._buckets(h, rule.bits)).tolist())
    want = ftrl([(i % 2, f) for i in sorted(x, key=order.get) for f in x[i]], rule)
    want[1 << rule.bits] = want.pop("bias")
    assert model.keys() == want.keys() and all(math.isclose(model[k], want[k], rel_tol=1e-9) for k in want)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, list(model.items()), rule).collect()}
    for i, fs in x.items():
        assert math.isclose(scores[i], 1 / (1 + math.exp(-sum(want.get(k, 0.0) for k in fs[0]) - want[1 << rule.bits])), rel_tol=1e-9)
    # A budget of features ends the sample in hash order.
    few = toxicity.FtrlRule(bits=12, l1=0.4, epochs=3, l2=0.1, sample_bytes=4 * sum(len(x[i][0]) for i in sorted(x, key=order.get)[:20]))
    small = dict(tuple(r) for r in toxicity.train(docs.where("doc_id < 80"), labels, few).collect())
    first = [i for i in sorted(x, key=order.get) if i < 80]
    part, left = [], few.sample_bytes
    for i in first:
        left -= 4 * len(x[i][0])
        if left < 0:
            break
        part.append((i % 2, x[i][0]))
    again = ftrl(part, few)
    again[1 << few.bits] = again.pop("bias")
    assert small.keys() == again.keys() and all(math.isclose(small[k], again[k], rel_tol=1e-9) for k in again)


def plain_cotraining(c, m, y, fold, rule):
    """Co-training over whole matrices: Newton steps for both views, pseudo-labels of the sure one for the other."""
    views, sigmoid = [c, m], lambda v: 1 / (1 + np.exp(-np.clip(v, -30, 30)))

    def steps(models, frozen, times):
        for _ in range(times):
            out = []
            for k in (0, 1):
                weight, target = ((fold > 0) & ~np.isnan(y)) * 1.0, np.nan_to_num(y)
                if frozen:
                    p = sigmoid(views[1 - k] @ frozen[1 - k])
                    sure = np.isnan(y) & ((p >= rule.sure) | (p <= 1 - rule.sure))
                    weight, target = np.where(sure, rule.pseudo_weight, weight), np.where(sure, p >= 0.5, target)
                p = sigmoid(views[k] @ models[k])
                g = views[k].T @ (weight * (p - target)) + rule.ridge * models[k]
                h = (views[k] * (weight * p * (1 - p))[:, None]).T @ views[k] + rule.ridge * np.eye(len(models[k]))
                step = np.linalg.solve(h, g)
                out.append(models[k] - step * min(1.0, 8.0 / max(1e-12, np.abs(step).max())))
            models = out
        return models

    models = steps([np.zeros(c.shape[1]), np.zeros(m.shape[1])], None, rule.first_steps)
    for _ in range(rule.rounds):
        models = steps(models, models, rule.steps)
    return models


def test_cotraining_equals_whole_matrices(spark):
    rng = random.Random(4)
    good, bad = "the quick brown fox jumps over lazy dogs near rivers".split(), "zz xx qq BUY BUY now !!! $$$".split()
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad if rng.random() < 0.7 else good) for _ in range(rng.randint(3, 40))), "en", "s" if i % 2 else "t", rng.randint(1, 99)) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 120)], "doc_id long, quality int")
    rule = quality.CoRule(content=32, sure=0.9)
    feats = quality.features(docs, labels, rule).orderBy("doc_id")
    model = quality.train(feats, rule)
    all_ = feats.toPandas()
    c, m = (np.stack([np.frombuffer(b, np.float16).astype(float) for b in all_[k]]) for k in ("c", "m"))
    y, fold = all_["y"].to_numpy(float), all_["fold"].to_numpy()
    want = plain_cotraining(c, m, y, fold, rule)
    alone = plain_cotraining(c, m, y, fold, quality.CoRule(content=32, sure=0.9, rounds=0))
    for a, b, first in zip(model.weights, want, alone):
        assert np.allclose(a, b, rtol=1e-6, atol=1e-8) and not np.allclose(a, first, atol=1e-3)  # the other view's labels did act
    got = {r.doc_id: r for r in quality.score(feats, model, rule).collect()}
    odds = [a * np.clip(x @ w, -30, 30) + b for x, w, (a, b) in zip((c, m), want, model.scales)]
    for i, r in enumerate(all_["doc_id"]):
        assert math.isclose(got[r].score, 1 / (1 + math.exp(-(odds[0][i] + odds[1][i]) / 2)), rel_tol=1e-5)
        assert got[r].kept == (got[r].score >= rule.threshold)


def test_ties_clashing_names_and_long_texts(spark):
    rows = [(i, "same words here", "en", "s", 3, "q", b"c", b"m", 1, 2) for i in range(6)] + [(9, "word " * 200_000, "en", "s", 1, "q", b"c", b"m", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, quality string, c binary, m binary, y int, fold int")
    labels = spark.createDataFrame([(i, i % 2, i % 2, "z") for i in range(6)], "doc_id long, quality int, toxic int, text string")
    feats = quality.features(docs, labels)
    model = quality.train(feats)
    rows = quality.score(feats, model).collect()
    assert len({r.score for r in rows if r.doc_id < 6}) == 1 and len(rows) == 7
    assert quality.keep(docs, model).columns == docs.columns
    scores = toxicity.score(docs, [tuple(r) for r in toxicity.train(docs, labels).collect()]).collect()
    assert len({r.score for r in scores if r.doc_id < 6}) == 1 and len(scores) == 7
