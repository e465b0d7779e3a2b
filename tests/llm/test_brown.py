import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from millrace.llm import brown, catalogue

SF = "/root/testdata/sf0.01"


def base_scores(rows):
    low = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter()
    for i, t in rows:
        if not out(i):
            c.update([*low(t), None])
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        tokens = [*low(t), None]
        yield i, out(i), len(tokens), sum(c[w] > 0 for w in tokens), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens)


def test_real_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in catalogue.op1_brown_lm(spark, SF).collect()}
    assert len(got) == len(rows)
    better = tokens = ours = theirs = 0
    for i, held, n, known, total, base in base_scores(rows):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.perplexity, 10 ** (-r.score / n), rel_tol=1e-9)
        if held:
            better += r.score > base
            tokens, ours, theirs = tokens + n, ours + r.score, theirs + base
    print("held-out perplexity", 10 ** (-ours / tokens), "base", 10 ** (-theirs / tokens))
    assert ours > theirs


def test_tail_words_and_edges(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "a b"), (3, rows[3][1]), (102, "zz " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS h", "2 AS row", "3 AS c")
    rule = brown.BrownRule(items=6, groups=4, classes=5, head=12, flush=50)
    train = df.where(~brown.held_out(df.doc_id)).select("text")
    got = brown.score(df, brown.fit(train, rule), rule).collect()
    want = sorted((str(i), n, known, total, round(base, 6)) for i, _, n, known, total, base in base_scores(rows))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    none = df.where("false")
    assert brown.score(none, brown.fit(none.select("text"), rule), rule).count() == 0
    assert all(math.isfinite(r.score) for r in brown.score(df, brown.fit(none.select("text"), rule), rule).collect())


def test_exchange_raises_mutual_information_and_finds_planted_classes():
    rng = np.random.default_rng(1)
    rule = brown.BrownRule(items=12, groups=0, classes=4)
    of = np.array([0, 1, 2] * 4 + [3])
    follow = {0: 1, 1: 2, 2: 0}
    pairs, last = np.zeros((13, 13)), 12
    for _ in range(20_000):
        c = follow[of[last]] if last != 12 else 0
        w = 12 if rng.random() < 0.05 else rng.choice(np.flatnonzero(of == c))
        pairs[last, w] += 1
        last = w
    cls = brown.exchange(pairs, rule)
    assert cls[12] == 3 and all(len({cls[i] for i in range(12) if of[i] == c}) == 1 for c in range(3)) and len(set(cls[:12])) == 3


def test_words_below_the_head_get_classes_from_their_neighbours(spark):
    # Words in -xx come after "the" or after "we", equally often; rank, counts and last bytes don't tell the two kinds apart.
    rng = random.Random(8)
    nouns, verbs = [f"n{i}xx" for i in range(30)], [f"v{i}xx" for i in range(30)]
    texts = [" ".join(f"the {n} we {v}" for n, v in zip(rng.sample(nouns, 30), rng.sample(verbs, 30), strict=True)) for _ in range(12)]
    texts += ["the hat we run the cup we sit the bed we eat"] * 30
    texts += ["we " + t.split(" we ", 1)[1] + " the hat" for t in texts]  # ends after both kinds
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    pairs = list(zip(nouns, verbs, strict=True))
    docs = spark.createDataFrame([(i, f"{a} {p[k]}") for i, (a, p, k) in enumerate((a, p, k) for p in pairs for a in ("the", "we") for k in (0, 1))], "doc_id long, text string")
    # With head=20, most of the words are beyond what is broadcast; with 1,000, none.
    for head in (20, 1000):
        rule = brown.BrownRule(items=8, groups=4, classes=6, head=head)
        words, _, tables = model = brown.fit(train, rule)
        got = {r.doc_id: r.score for r in brown.score(docs, model, rule).collect()}
        right = sum((got[4 * i] > got[4 * i + 1] + 0.3) + (got[4 * i + 3] > got[4 * i + 2] + 0.3) for i in range(30))
        assert right == 60, (head, right)
        # The emissions of each class that has members sum to 1.
        mass = Counter()
        for r in words.collect():
            if r.cls >= 0:
                mass[r.cls] += (r.c + 1) / 10 ** tables.class_size[r.cls]
        for g, c in enumerate(tables.group_class):
            mass[int(c)] += 10 ** tables.emission[g]
        assert all(math.isclose(m, 1) for m in mass.values())


def test_model_and_scores_equal_plain_sums(spark):
    """Transitions from counts over the training texts, and each text's log probability, token by token."""
    rng = random.Random(12)
    vocabulary = [f"w{i}{'ab'[i % 2]}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary[: 5 + 11 * (k % 6)]) for _ in range(rng.randint(0, 25))) for k in range(150)]
    train = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    rows = [(i, t) for i, t in enumerate(texts[:40])] + [(100, None), (101, "W3b never seen w1B"), (102, "zz " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for head in (15, 1000):
        rule = brown.BrownRule(items=8, groups=4, classes=6, head=head, least=3, passes=1)
        words, top, t = model = brown.fit(train, rule)
        table = {r.h: r for r in words.collect()}

        def tokens(text):
            out = []
            for w in (text or "").split():
                h, g, _ = brown._hashed(rule, pa.array([w]))
                k, known = top.find(h)
                row, g = table.get(int(h.view(np.int64)[0])), int(g[0])
                cls = row.cls if row is not None and row.cls >= 0 else int(t.group_class[g])
                context = int(t.context[k[0]]) if known[0] else int(t.group_class[g])
                out.append((cls, context, g, row))
            return out

        end, n = rule.classes - 1, np.zeros((rule.classes, rule.classes))
        for text in texts:
            before = end
            for cls, context, _, _ in tokens(text):
                n[before, cls] += 1
                before = context
            n[before, end] += 1
        kinds, unigram = (n > 0).sum(axis=1), (n.sum(axis=0) + 1) / (n.sum() + rule.classes)
        smooth = (n + (kinds + 1)[:, None] * unigram) / (n.sum(axis=1) + kinds + 1)[:, None]
        assert np.allclose(10**t.transition, smooth) and np.allclose(smooth.sum(axis=1), 1)
        got = {r.doc_id: r.score for r in brown.score(docs, model, rule).collect()}
        for i, text in rows:
            before, total = end, 0.0
            for cls, context, g, row in tokens(text):
                c = row.c if row is not None else 0
                own = row is not None and row.cls >= 0
                total += math.log10(smooth[before, cls]) + math.log10(c + 1) - (t.class_size[cls] if own else t.group[g] - t.emission[g])
                before = context
            total += math.log10(smooth[before, end]) + math.log10(t.ends + 1) - t.class_size[end]
            assert math.isclose(got[i], total, rel_tol=1e-9), (i, head)
