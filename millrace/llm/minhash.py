"""MinHash near-dedup by a signature-coordinate inverted join.

1. Every text becomes its set of distinct word shingles (64-bit hashes) and a MinHash signature; texts
   with equal sets form a class and only the class representative (smallest doc_id) goes on.
2. Representatives are posted under each coordinate-value pair. A pair of sets at the similarity
   threshold agrees in far more than ``matches`` coordinates, and two signatures that agree in that many must
   share a posting among the first ``coordinates - matches + 1`` of each, in any fixed order of postings. Taking
   the rarest first (prefix filter) leaves postings of frequent passages unread, and values
   that occur once are never posted at all.
3. Lists are merged without emitting all pairs of a group: members are first compared with one hub of
   their list. Lists whose members are in one component already are skipped. Members of the others are posted
   anew under the rarest shingles of their full sets (an exact prefix filter at the similarity threshold) and get
   other hubs; once few pairs across components are left, or hubs stop helping, all of these are compared, long lists
   in cells of two bounded parts each.
4. A candidate counts its agreeing coordinates; those with ``matches`` or more are confirmed on
   the full shingle sets. Components of confirmed links give the result.

A link decides nothing inside a component, so leaving out pairs within one loses no component.

Defined results: a null, empty or blank text has no shingles and its own component; a text of fewer than
``width`` words is one shingle; repeated rows and repeated doc_ids are copies of each other where their sets
are equal; a null doc_id belongs to its set's component but is not kept; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import textnum
from millrace.llm.common import cut, staged
from millrace.llm.components import components


@dataclass(frozen=True)
class NearRule:
    """percent: least similarity; coordinates and matches: signature length and least agreement of a candidate.

    With 64 coordinates, a pair at similarity 0.75 agrees in 48 on average; fewer than 34 has a chance of
    about 4 in 100,000 for a pair exactly at the threshold, and far less for any above it.
    """

    width: int = 5
    percent: int = 75
    coordinates: int = 64
    matches: int = 34
    star_rounds: int = 12
    few_pairs: int = 20_000
    part: int = 2048
    bitmap_longs: int = 16
    filter_longs: int = 1 << 18

    @property
    def prefix(self) -> int:
        return self.coordinates - self.matches + 1


def _signed_texts(rule: NearRule):
    a, b = textnum.constants(101, rule.coordinates)[:, None], textnum.constants(211, rule.coordinates)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textnum.small(batches):
            words, counts = textnum.word_hashes(textnum.views(batch.column(1)))
            at, sizes, sets, signatures = 0, [], [], []
            for n in counts.tolist():
                s = textnum.shingles(words[at : at + n], rule.width)
                at += n
                sizes.append(len(s))
                if not len(s):
                    sets.append(None)
                    signatures.append(None)
                    continue
                least = np.full(rule.coordinates, np.iinfo(np.uint64).max, np.uint64)
                for k in range(0, len(s), 2048):
                    np.minimum(least, (s[None, k : k + 2048] * a + b).min(axis=1), out=least)
                sets.append(int((textnum.mix(s * textnum.U(3) + textnum.U(len(s))).sum(dtype=np.uint64)).view(np.int64)))
                signatures.append((least >> textnum.U(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sets, pa.int64()), pa.array(signatures, pa.list_(pa.int32()))], ["doc_id", "n", "set", "sig"]
            )

    return run


def _confirmed(rule: NearRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textnum.small(batches):
            hubs = batch.column(0).to_pylist()
            order = sorted(range(len(hubs)), key=lambda i: hubs[i])
            left, right = textnum.views(batch.column(2)), textnum.views(batch.column(3))
            keep, last, own = [], None, None
            for i in order:
                if hubs[i] != last:
                    last, own = hubs[i], textnum.shingles(textnum.word_hashes([left[i]])[0], rule.width)
                other = textnum.shingles(textnum.word_hashes([right[i]])[0], rule.width)
                both = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * both >= rule.percent * (len(own) + len(other) - both):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return run


def signatures(docs: DataFrame, rule: NearRule = NearRule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (set size), set (hash of the set), sig for every row."""
    d = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return d.mapInArrow(_signed_texts(rule), "doc_id long, n long, set long, sig array<int>")


def near_components(docs: DataFrame, rule: NearRule = NearRule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, class_id (smallest doc_id of the equal sets), component_id, kept, for every row."""
    signed = staged(signatures(docs, rule, key, text), "near-signed")
    classes = signed.where("n > 0").groupBy("set", "n").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    reps = staged(classes.where("rep IS NOT NULL"), "near-reps")
    links = _links(docs, reps, rule, key, text)

    classed = reps.select(F.col("set").alias("s"), F.col("n").alias("m"), "rep")
    comp = reps.select("rep").distinct().join(links.withColumnRenamed("id", "rep"), "rep", "left").select("rep", F.coalesce("comp", "rep").alias("component_id"))
    classed = classed.join(comp, "rep")
    out = signed.select("doc_id", "n", "set").join(classed, (F.col("set") == F.col("s")) & (F.col("n") == F.col("m")), "left")
    own = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("class_id"), own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept"))


def _perhaps(docs: DataFrame, ids: DataFrame, rule: NearRule) -> DataFrame:
    """The rows whose id falls on a bit that some id in ids sets: all that ids holds and few others, so that a join with ids
    shuffles few texts. The bitmap has a fixed size; where ids are so many that it fills up, the join does the work alone."""
    size = rule.filter_longs * 64
    bit = F.pmod(F.xxhash64("rep", F.lit(5)), F.lit(size))
    word = ids.groupBy((F.floor(bit / 64)).cast("int").alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))).alias("v")).toArrow()
    longs = np.zeros(rule.filter_longs, np.int64)
    longs[word["w"].to_numpy()] = word["v"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(longs.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sent.value, np.uint8)
        for batch in textnum.small(batches):
            at = batch.column(2).to_numpy(zero_copy_only=False)
            yield batch.select([0, 1]).filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))

    return docs.where("rep IS NOT NULL").withColumn("bit", bit).mapInArrow(run, "rep long, text string")


def _bits(rule: NearRule) -> list[str]:
    return [f"bits{i}" for i in range(rule.bitmap_longs)]


def _may_link(p: str, q: str, rule: NearRule) -> Column:
    """False only for pairs that can't be similar enough: neither set shares more than it shares with any other,
    and a pair at the threshold shares percent / (100 + percent) of its summed sizes."""
    return (100 + rule.percent) * F.least(F.col(f"{p}.most"), F.col(f"{q}.most")) >= rule.percent * (F.col(f"{p}.n") + F.col(f"{q}.n"))


def _bits_allow(p: str, q: str, rule: NearRule) -> Column:
    """As _may_link, by bitmaps in which each shingle flips one bit: they differ in no more bits than the sets in shingles."""
    sizes = F.col(f"{p}.n") + F.col(f"{q}.n")
    differ = sum((F.bit_count(F.col(f"{p}.{b}").bitwiseXOR(F.col(f"{q}.{b}"))) for b in _bits(rule)), F.lit(0))
    return (100 + rule.percent) * (sizes - differ) >= 2 * rule.percent * sizes


def _links(docs: DataFrame, reps: DataFrame, rule: NearRule, key: str, text: str) -> DataFrame:
    """id, comp for the representatives that have a confirmed link."""
    posted = reps.select("rep", "n", F.posexplode("sig").alias("pos", "value"))
    posted = posted.select("rep", "n", F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(0xFFFFFFFF)).alias("key"))
    shared = posted.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    by_rep = Window.partitionBy("rep", "n")
    # Postings that occur once come first in the order of rarity, and need no list.
    lists = posted.join(shared, "key").withColumn("r", F.row_number().over(by_rep.orderBy("df", "key"))).withColumn("many", F.count(F.lit(1)).over(by_rep))
    lists = staged(lists.where(F.col("r") <= F.col("many") - F.lit(rule.matches - 1)).select("key", "rep", "n", F.col("n").alias("most"), (F.col("many") / rule.coordinates).alias("central")), "near-lists")

    ids = lists.select("rep").distinct()
    d = docs.select(F.col(f"`{key}`").cast("long").alias("rep"), F.col(f"`{text}`").cast("string").alias("text"))
    texts = staged(_perhaps(d, ids, rule).join(ids, "rep", "left_semi").dropDuplicates(["rep", "text"]), "near-texts")
    # Written once: each turn joins it, and a join of its own below that one would keep the engine from splitting a hub's rows.
    sigs = staged(reps.join(ids, "rep", "left_semi").select("rep", "n", "sig"), "near-sigs")

    comp, edges, bits, before = None, None, None, float("inf")
    for turn in range(rule.star_rounds + 1):
        if turn == 1:
            lists, bits = _rarer(lists, open_, texts, rule)
        m = lists.withColumn("comp", F.col("rep")) if comp is None else lists.join(comp.withColumnRenamed("id", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
        # Two hubs: the set with the largest shared part, as copies with few changes of their own are near to most others, and a varying one.
        rank = F.xxhash64("rep", F.lit(turn)).alias("h")
        central, other = F.max(F.struct("central", rank, "rep", "n", "most")), F.min(F.struct(rank, "rep", "n", "most"))
        per_comp = m.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("k"), central.alias("middle"), other.alias("other"))
        hub = lambda c: F.struct(*[F.col(f"{c}.{x}").alias(x) for x in ("rep", "n", "most")], "comp")
        per_key = per_comp.groupBy("key").agg(
            F.count(F.lit(1)).alias("comps"), F.sum("k").alias("all"), F.sum(F.col("k") * F.col("k")).alias("inside"),
            # The hubs come from the list's largest component.
            F.max_by(F.array(hub("middle"), hub("other")), F.struct(F.col("k"), F.xxhash64("comp", F.lit(turn)))).alias("hubs"),
        ).where("comps > 1")
        open_ = cut(per_key)
        if turn:
            # Components only merge, so a closed list stays closed.
            lists = staged(lists.join(open_.select("key"), "key", "left_semi"), "near-open")
            m = lists.join(comp.withColumnRenamed("id", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
        left, size = open_.select(F.sum((F.col("all") * F.col("all") - F.col("inside")) / 2), F.sum("all")).first()
        if not left:
            break
        last = turn == rule.star_rounds or left <= max(rule.few_pairs, 2 * size) or turn > 1 and left > 0.9 * before
        before = left
        if last:
            few = _cells(m, open_, rule)
            if bits is not None:
                few = few.join(bits, ["rep", "n"])
            x, y = few.alias("x"), few.alias("y")
            allowed = _may_link("x", "y", rule) if bits is None else _may_link("x", "y", rule) & _bits_allow("x", "y", rule)
            one_cell = (F.col("x.key") == F.col("y.key")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
            across = (F.col("x.i") == F.col("x.j")) | (F.col("x.part") != F.col("y.part"))
            pairs = x.join(y, one_cell & across & (F.col("x.comp") < F.col("y.comp")) & allowed).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
        else:
            pairs = m.alias("m").join(open_.select("key", F.explode(F.array_distinct("hubs")).alias("hub")), "key").where((F.col("comp") != F.col("hub.comp")) & _may_link("m", "hub", rule)).select(F.col("hub.rep").alias("a"), F.col("rep").alias("b"))
        found = _confirm(pairs.distinct(), sigs, texts, rule)
        edges = found if edges is None else cut(edges.unionByName(found))
        comp = components(edges)
        if last:
            break
    return comp if comp is not None else ids.where("false").select(F.col("rep").alias("id"), F.col("rep").alias("comp"))


def _cells(members: DataFrame, open_: DataFrame, rule: NearRule) -> DataFrame:
    """The members of open lists, dealt to cells (key, i, j): a list is cut into parts of about ``part`` members by a hash, and a cell holds
    two of its parts (or one, i = j), so that the comparisons of a long list are the work of many tasks."""
    parts = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("all") / rule.part))
    m = members.join(open_.select("key", "all"), "key").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("rep", F.lit(9)), F.col("parts")))
    cell = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda q: F.struct(F.least(F.col("part"), q).alias("i"), F.greatest(F.col("part"), q).alias("j")))
    return m.select("key", "rep", "n", "most", "comp", "part", F.inline(cell))


def _rarer(lists: DataFrame, open_: DataFrame, texts: DataFrame, rule: NearRule) -> tuple[DataFrame, DataFrame]:
    """Lists of rarer keys for the members of lists that are still open: their full sets' rarest shingles.

    A partner shares at least the threshold's part of a set, so one of the first n - needed + 1 shingles in order
    of rarity among these sets; those no other set holds come first and need no list. ``most`` is how many of a
    set's shingles any other set holds; a set that shares less than needed has no partner left and goes. Also returns
    the sets' bitmaps (rep, n, bits0, ...).
    """

    longs = rule.bitmap_longs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textnum.small(batches):
            words, counts = textnum.word_hashes(textnum.views(batch.column(1)))
            at, sets, bits = 0, [], []
            for n in counts.tolist():
                s = textnum.shingles(words[at : at + n], rule.width)
                at += n
                sets.append(textnum.signed(s))
                flips = np.bincount((textnum.mix(s) % textnum.U(64 * longs)).astype(np.int64), minlength=64 * longs) & 1
                bits.append(np.packbits(flips.astype(np.uint8)).view(np.int64))
            columns = [batch.column(0), pa.array(sets, pa.list_(pa.int64())), *(pa.array([b[i] for b in bits], pa.int64()) for i in range(longs))]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "set", *_bits(rule)])

    left = lists.join(open_.select("key"), "key", "left_semi").select("rep").distinct()
    schema = "rep long, set array<long>, " + ", ".join(f"{b} long" for b in _bits(rule))
    sets = staged(texts.join(left, "rep", "left_semi").mapInArrow(run, schema), "near-sets").withColumn("n", F.size("set").cast("long"))
    held = sets.select("rep", "n", F.explode("set").alias("s"))
    # A repeated doc_id with other texts may hold a shingle twice; a pair of one rep is no pair.
    shared = held.groupBy("s").agg(F.count(F.lit(1)).alias("df"), F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi").select("s", "df")
    by_rep = Window.partitionBy("rep", "n")
    ranked = held.join(shared, "s").withColumn("r", F.row_number().over(by_rep.orderBy("df", "s"))).withColumn("most", F.count(F.lit(1)).over(by_rep))
    needed = F.ceil(F.col("n") * rule.percent / 100)
    ranked = ranked.where(F.col("r") <= F.col("most") - needed + 1).select(F.col("s").alias("key"), "rep", "n", "most", (F.col("most") / F.col("n")).alias("central"))
    return staged(ranked, "near-open"), sets.drop("set")


def _confirm(pairs: DataFrame, sigs: DataFrame, texts: DataFrame, rule: NearRule) -> DataFrame:
    """The pairs whose signatures agree often enough and whose full sets are similar enough."""
    one = sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sb"))
    two = sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sa"))
    agree = F.aggregate(F.zip_with("sa", "sb", lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, x: s + x)
    # Written before the texts come in: two joins by "a" on top of each other would keep a hub's rows in one task, and stop the engine from
    # splitting them.
    c = cut(pairs.join(one, "b").join(two, "a").where(agree >= rule.matches).select("a", "b"))
    t = c.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a")
    return cut(t.select("a", "b", "ta", "tb").mapInArrow(_confirmed(rule), "a long, b long"))
