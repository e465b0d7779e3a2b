import hashlib
import tracemalloc

import urllib.parse

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import canonical, pii, simhash, text

NASTY = ["  abc \n\t def   ", "a b c　d é\x85x", "\x00\x08a\x0b\x1f\x7f\rb", "", "x y\tz", "'''T''' [[A|B]] [[C]] [[A|[[B]]]] [[A|]] {{a{{b}}c}} {| t |} <i>x</i> [12] [x]", "٣٤٥٦٧٨٩٠ 1999-2004"]


def column(spark, values, c):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, t string").orderBy("i").select(c).collect()]


def test_normalise(spark):
    want = ["abc def", "a b c d é x", "a b", "", "x y z", "'''T''' [[A|B]] [[C]] [[A|[[B]]]] [[A|]] {{a{{b}}c}} {| t |} <i>x</i> [12] [x]", "٣٤٥٦٧٨٩٠ 1999-2004"]
    assert column(spark, NASTY, text.normalize_text("t")) == want
    assert column(spark, [" \n a \t b "], text.normalize_text("t", collapse=False)) == ["a \t b"]


def test_wiki_markup(spark):
    assert column(spark, NASTY[5:], text.wikitext_to_text("t")) == ["T B C [[B]] [[A|]] {{a c}} x [x]", "٣٤٥٦٧٨٩٠ 1999-2004"]
    assert column(spark, ["a[1]b<ref name=x>c</ref> ''d''"], text.wikitext_to_text("t")) == ["a b c d"]


def test_parser_modes(spark):
    assert column(spark, ["[[A|b]]"], text.parsed_wikitext("t", parser="library")) == ["b"]
    with pytest.raises(ImportError):
        text.parsed_wikitext("t", parser="library", required=True)
    with pytest.raises(ValueError):
        text.parsed_wikitext("t", parser="other")


def test_wiki_url(spark):
    titles = ["A b", "C++ & more?", "100%", "é/ü*~", "a:b=c#d%20", "(x) 'y' \"z\""]
    want = [text.WIKI_URL + urllib.parse.quote(t.replace(" ", "_"), safe=":/?&=%#") for t in titles]
    assert column(spark, titles, text.wiki_url("t")) == want


def test_pii(spark):
    got = column(spark, ["mail a.b@c.org or +1 650 555 1000 at 10.0.0.1", "years 1999-2004", "no data", "x٠٩@a.bc", "tel (030) 123-4567."], pii.redact(F.col("t")))
    assert got[0] == "mail <EMAIL_ADDRESS> or +<PHONE_NUMBER> at <IP_ADDRESS>" and got[1] == "years <PHONE_NUMBER>" and got[2] == "no data"
    assert column(spark, ["a@b.cd", "1.2.3.4", "plain 12"], pii.contains(F.col("t"))) == [True, True, False]


def test_canonical(spark):
    df = spark.createDataFrame([("A  B", "x"), ("A \n\t B", "x "), (None, "x")], "title string, body string")
    c = canonical.canonical_text([F.col("title"), F.col("body")])
    rows = df.select(c.alias("c"), canonical.canonical_hash(c).alias("h")).collect()
    assert [r.c for r in rows] == ["A B\nx", "A B\nx", "x"] and rows[0].h == rows[1].h == hashlib.sha256(b"A B\nx").hexdigest()


def slow_simhash(t, digest):
    votes = [0] * 64
    tokens = t.split()
    for x in tokens:
        h = int.from_bytes(digest(x.encode())[:8], "big")
        for i in range(64):
            votes[i] += 1 if h >> i & 1 else -1
    return sum(1 << i for i in range(64) if votes[i] >= 0) if tokens else 0


@pytest.mark.parametrize("kind", ["blake2b", "md5"])
def test_simhash(spark, kind):
    texts = ["", "one", "a b c d a", "the quick brown fox " * 5, "Ω é"]
    c = simhash.simhash(F.col("t"), kind)
    digest = (lambda b: hashlib.blake2b(b, digest_size=8).digest()) if kind == "blake2b" else (lambda b: hashlib.md5(b).digest())
    assert [x & (2**64 - 1) for x in column(spark, texts, c)] == [slow_simhash(t, digest) for t in texts]
    assert column(spark, ["x"], F.size(simhash.bands(F.lit(-1).cast("long")))) == [4]
    assert column(spark, ["x"], simhash.hamming(F.lit(7).cast("long"), F.lit(0).cast("long"))) == [3]
    assert np.int64(simhash.simhash_of("one"))


def test_simhash_holds_few_tokens():
    tracemalloc.start()
    try:
        for k in range(60):
            simhash.simhash_of(" ".join(f"{k}x{i}" for i in range(2000)), "md5")
        assert tracemalloc.get_traced_memory()[0] < 12e6
    finally:
        tracemalloc.stop()
    long = " ".join(f"{i:040d}" for i in range(100))
    assert simhash.simhash_of(long, "md5") & (2**64 - 1) == slow_simhash(long, lambda b: hashlib.md5(b).digest())
