import random
import re
from collections import defaultdict

import numpy as np

from millrace.llm import catalogue, minhash, textnum

from .helpers import assert_same

SF = "/root/testdata/sf0.01"


def sets_of(rows):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        out.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    return out


def brute(rows):
    """Components of every pair at 75 % or more, found through an index of shingles."""
    sets = sets_of(rows)
    up = {i: i for i, _ in sets if i is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    by, known = defaultdict(list), {i: s for i, s in sets}
    for i, s in known.items():
        for x in s:
            by[x].append(i)
    for i, s in known.items():
        common = defaultdict(int)
        for x in s:
            for j in by[x]:
                if j < i:
                    common[j] += 1
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(known[j]) - n):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: (len(s), root(i)) for i, s in known.items()}


def test_real_table_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(rows)
    got = catalogue.op4_minhash_dedup(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_large_near_group_and_common_passage(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base, passage, rows = [word() for _ in range(120)], [word() for _ in range(60)], []
    for i in range(300):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join([word() for _ in range(rng.randint(10, 60))] + passage)) for i in range(200)]
    rows += [(2000 + i, rows[5][1].upper() if i % 2 else rows[5][1] + "\n") for i in range(40)]
    chain = [word() for _ in range(200)]
    rows += [(3000 + i, " ".join(chain[i * 8 : i * 8 + 100])) for i in range(10)]
    rows += [(4000, ""), (4001, None), (4002, " \t\n"), (4003, "one two"), (4004, "One  TWO"), (4005, "w " * 40_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1L AS rep", "2L AS key").repartition(7)
    for rule in (minhash.NearRule(), minhash.NearRule(few_pairs=1)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_components(df, rule).collect()}
        assert got == brute(rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "x")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.component_id, r.kept) for r in minhash.near_components(df).collect())
    assert got == [("1", 1, True), ("1", 1, True), ("2", 2, True), ("None", 1, False)]
    assert minhash.near_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_word_hashes_do_not_depend_on_place_or_piece():
    words = ["Alpha", "é", "x" * 9000, "beta"] * 2000
    text = " \n".join(words).encode()
    h, n = textnum.word_hashes([b"", text, b"alpha", memoryview(b"  BETA\t")])
    assert n.tolist() == [0, 8000, 1, 1]
    assert len(set(h.tolist())) == 4 and h[-2] == h[0] and h[-1] == h[3] and (h[:8000].reshape(-1, 4) == h[:4]).all()
    assert isinstance(h, np.ndarray)


def test_query_equals_sql(spark):
    assert_same(catalogue.op4_minhash_dedup(spark, SF), catalogue.OP4_SQL, SF)


def test_recall_of_links_about_the_threshold(spark):
    """Pairs of all sizes at 75 % and just above or below, against their exact similarity."""
    rng = random.Random(17)
    rows, want = [], {}
    for k in range(2000):
        n = rng.choice([4, 7, 8, 12, 20, 40, 80, 160, 320])
        # Shingles of one text are its runs of five words: changing the last c words changes c of them.
        words = [f"{k}x{j}" for j in range(n + 4)]
        c = max(0, round(n / 7) + rng.choice([-1, 0, 0, 0, 1]))
        other = words[: len(words) - c] + [f"{k}y{j}" for j in range(c)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        both = n - c
        want[2 * k + 1] = 2 * k if 100 * both >= 75 * (2 * n - both) else 2 * k + 1
    got = {r.doc_id: r.component_id for r in minhash.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    linked = [i for i, c in want.items() if c != i]
    missed = sum(got[i] != want[i] for i in linked)
    print("links", len(linked), "missed", missed)
    assert missed <= 1 and all(got[i] == i for i, c in want.items() if c == i) and len(linked) > 600


def test_long_lists_are_compared_in_cells(spark):
    """Many texts that share a part but are too different to link, beside pairs of them that do link."""
    rng = random.Random(23)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    shared, rows = [word() for _ in range(100)], []
    for i in range(150):
        own = [word() for _ in range(30)]
        rows += [(2 * i, " ".join(own + shared)), (2 * i + 1, " ".join(own[:-1] + [word()] + shared))]
    rule = minhash.NearRule(star_rounds=0, few_pairs=0, part=16)
    for r in (rule, minhash.NearRule()):
        got = {x.doc_id: (x.n_shingles, x.component_id) for x in minhash.near_components(spark.createDataFrame(rows, "doc_id long, text string"), r).collect()}
        assert got == brute(rows)
