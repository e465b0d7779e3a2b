import random
import re

import numpy as np

from millrace.llm import catalogue, decontaminate

SF = "/root/testdata/sf0.01"
RULE = decontaminate.LeakRule()


def plain(text):
    return re.sub(r"[^0-9a-z\u0080-\U0010ffff]+", " ", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in text or "")).encode()


def within(unit, text, k):
    """Least edits of unit anywhere in text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(unit):
        new = [i + 1]
        for j, y in enumerate(text):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row) <= k


def brute(doc, item):
    v, t = plain(item).strip(b" "), plain(doc)
    if len(v) < RULE.least:
        few = len(v.split()) < RULE.words or len(v) + 2 < RULE.q
        return bool(v) and (t.strip(b" ") == v if few else b" " + v + b" " in b" " + t + b" ")
    spans = {(a, a + size) for size in (RULE.unit, RULE.long) for a in {*range(0, max(1, len(v) - size + 1), size // 2), max(0, len(v) - size)}}
    t = b" " + t.strip(b" ") + b" "  # a text stands between spaces
    return any(within(v[a:b], t, RULE.budget(len(v[a:b]))) for a, b in spans)


def test_edited_passages_equal_brute_force(spark):
    rng = random.Random(5)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:6] + [(90, "short one"), (91, None), (92, "")]
    docs, i = [], 0
    for item, text in items[:6]:
        for edits in (0, 4, 9, 12, 16, 22, 40):
            w = list(text)
            for _ in range(edits):
                k = rng.randrange(len(w))
                w[k] = rng.choice(["", "x", w[k] + "y"])
            docs.append((i, "start of a text " * 3 + "".join(w).replace(" ", rng.choice([" ", " \n", ", "])) + " and the end" * 2))
            i += 1
        docs.append((i, text[: len(text) // 3]))
        docs.append((i + 1, text.upper()))
        i += 2
    docs += [(1000, None), (1001, ""), (1002, "x" * 300_000 + " " + items[0][1] + "\0" + "y " * 10), (1002, "clean"), (None, items[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "'z' AS edits")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()}
    want = {(d, it) for d, t in docs for it, x in items if len(t or "") < 5000 and brute(t, x)} | {(1002, items[0][0])}
    assert got == want and len(want) > 30
    few = decontaminate.LeakRule(block_bytes=700)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench, few).collect()} == want
    kept = decontaminate.clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, t in docs if not any(x[0] == d for x in want) or t == "clean")


def test_spans_point_at_the_passage(spark):
    text = "é😀 intro. " + "The quick brown foxes jumped over the lazy dogs near the old river bank yesterday" + " outro"
    bench = spark.createDataFrame([(1, "the quick brown foxes jumped over the lazy dogs, near the old river bank yesterday!")], "item_id long, text string")
    r = decontaminate.leaks(spark.createDataFrame([(7, text)], "doc_id long, text string"), bench).first()
    assert text[r.start : r.end].startswith("The quick") and text[r.start : r.end].endswith("yesterday") and r.edits == 0


def test_real_table(spark):
    docs = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: plain(r.text).strip(b" ") for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in catalogue.op8_benchmark_leaks(spark, SF).collect()}
    want = {(d, i) for d, t in docs.items() for i, v in items.items() if v in t}
    assert want <= got and len(got) <= len(want) + 5, got - want


def test_empty_tables(spark):
    empty, none = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "abc " * 50)], "doc_id long, text string")
    assert decontaminate.leaks(empty, none).count() == 0 and decontaminate.leaks(one, none).count() == 0 and decontaminate.clean(one, none).count() == 1
    assert decontaminate.align(np.frombuffer(b"abcd", np.uint8), np.frombuffer(b"xxabxcdyy", np.uint8), 1) == (2, 7, 1)


def test_excerpts_cut_from_long_items(spark):
    rng = random.Random(11)
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect() if len(plain(r.text)) >= 240][:12]
    clean = "nothing of the kind stands here, only plain words about weather and bread " * 3
    docs, want = [], set()
    for item, text in items:
        v = plain(text).strip(b" ").decode()
        for size in (80, 100, 125, 145, 160, 180):
            at = rng.randrange(len(v) - size + 1)
            want.add((len(docs), item))
            docs.append((len(docs), clean + v[at : at + size] + " " + clean))
    df = spark.createDataFrame([*docs, (-1, clean)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()}
    assert len(items) == 12 and want <= got and -1 not in {d for d, _ in got}
    assert {r.doc_id for r in decontaminate.clean(df, bench).collect()} == {-1}


def test_long_units_carry_edits_that_no_short_unit_does():
    rng = np.random.default_rng(3)
    item = bytes(rng.choice(list(b"abcdefghijklmnopqrstuvwxyz"), 160).astype(np.uint8))
    doc = bytearray(item)
    # Four edits in every 53 bytes, twelve in all, leave runs of many q-grams between them.
    for start in (2, 42, 82, 122):
        for at in (start, start + 2, start + 4):
            doc[at] = ord("0")
    doc = bytes(doc)
    found = list(decontaminate.Index([(1, item.decode())], RULE).search([doc]))
    assert [x[1] for x in found] == [1]


def test_texts_about_as_long_as_their_item():
    """A text may be as short as a unit less its edits; every length around the bound, by the full table."""
    rng = random.Random(7)
    for size in (50, 51, 52, 53, 54, 60):
        item = "".join(rng.choice("abcdefghijklmnop") for _ in range(size))
        index = decontaminate.Index([(1, item)], RULE)
        for gone in range(0, 9):
            for _ in range(6):
                cut = list(item)
                for _ in range(gone):
                    del cut[rng.randrange(len(cut))]
                doc = "".join(cut)
                assert bool(list(index.search([doc.encode()]))) == brute(doc, item), (size, gone, doc)
            for doc in (item[gone:], item[: size - gone], item[gone // 2 : size - gone + gone // 2]):
                assert bool(list(index.search([doc.encode()]))) == brute(doc, item), (size, gone, doc)


def test_short_items_are_found_unchanged_between_word_bounds(spark):
    items = [(1, "What is six times seven?"), (2, "Yes"), (3, "of the sea"), (4, "a b c"), (5, "??")]
    docs = [(0, "so what is SIX  times seven"), (1, "what is six times seventy"), (2, "yes"), (3, "yes indeed"), (4, " Yes. "), (5, "out of the sea."), (6, "of the sea"), (7, "of the seas"), (8, "a b c"), (9, "so a b c d"), (10, ""), (11, "?"), (12, "x" * 70_000 + " of the sea"), (13, "é of the sea é")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(0, 1), (2, 2), (4, 2), (5, 3), (6, 3), (8, 4), (12, 3), (13, 3)}
    for rule in (RULE, decontaminate.LeakRule(block_bytes=8)):
        rows = decontaminate.leaks(df, bench, rule).collect()
        assert {(r.doc_id, r.item_id) for r in rows} == want
        assert {r.doc_id for r in decontaminate.clean(df, bench, rule).collect()} == {d for d, _ in docs} - {d for d, _ in want}
    at = {(r.doc_id, r.item_id): docs[r.doc_id][1][r.start : r.end] for r in rows}
    assert at[0, 1] == "what is SIX  times seven" and at[5, 3] == at[12, 3] == at[13, 3] == at[6, 3] == "of the sea" and at[4, 2] == "Yes"


def test_ties_repeated_items_and_rows(spark):
    text = "the quick brown foxes jumped over the lazy dogs near the old river bank"
    bench = spark.createDataFrame([(1, text), (1, text), (2, text)], "item_id long, text string")
    rows = decontaminate.leaks(spark.createDataFrame([(7, text), (7, text), (8, text + " " + text)], "doc_id long, text string"), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(7, 1), (7, 1), (7, 2), (7, 2), (8, 1), (8, 2)]
