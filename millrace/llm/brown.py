"""Class-based bigram language model with classes from exchange clustering.

Counts cover all training texts. A word is known by a 64-bit hash. Clustering starts from the ``items`` most frequent words and
``groups`` items for all others by their last bytes: exchange moves these between classes as long as the mutual information of
neighbouring classes rises. Then every word that occurs ``least`` times or more gets a class of its own: each of ``passes`` reads
of the texts makes a table of all words' neighbours by class, and ``rounds`` times all words go to the class where their neighbours
are most likely and the classes' statistics are summed again. Groups are left to rarer and unseen words. A token's probability is

    P(class | context) * P(word or group | class) * P(word | group's words)

with Witten-Bell smoothed transitions and add-one smoothing inside a class and a group (unknown words share one slot more). The
context is the class, as the last read of the texts has it, of the token before: a word of the head has its own, any other its
group's.

Word counts of the whole corpus are a table. The most frequent words, at most ``head`` of them, are sent to the
scoring tasks; the rest of a text's words meet their counts in a shuffled join, where no word is
frequent enough to make a hot key.

Defined results: a null or empty text is one end token; a null doc_id counts as empty text for the fold; repeated rows
count and score one by one; without training rows all probabilities of unseen events are uniform; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import textnum
from millrace.llm.common import staged


@dataclass(frozen=True)
class BrownRule:
    items: int = 1024
    groups: int = 128
    suffix: int = 2
    classes: int = 48
    sweeps: int = 8
    least: int = 5
    passes: int = 2
    rounds: int = 3
    head: int = 1 << 18
    flush: int = 1 << 20

    @property
    def end(self) -> int:
        """The end token's item."""
        return self.items + self.groups


def _hashed(rule: BrownRule, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, their groups, and the number of words of each text."""
    h, counts = textnum.stem_hashes(textnum.views(column), textnum.SEPARATOR, (-rule.suffix,))
    return h[:, 0], (h[:, 1] % textnum.U(rule.groups)).astype(np.int32), counts


def word_counts(texts: DataFrame, rule: BrownRule) -> DataFrame:
    """h, g (group), c (count) of every word; texts has one column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, groups, counts, size = [], [], [], 0

        def merged():
            h, first, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
            return [h], [np.concatenate(groups)[first]], [np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)]

        for batch in textnum.small(batches):
            h, g, _ = _hashed(rule, batch.column(0))
            hashes.append(h)
            groups.append(g)
            counts.append(np.ones(len(h), np.int64))
            size += len(h)
            if size > rule.flush:
                hashes, groups, counts = merged()
                # What is left are distinct words; many of them go on to the shuffle, so memory stays bounded.
                size = len(hashes[0]) // 2
                if len(hashes[0]) > rule.flush:
                    yield pa.RecordBatch.from_arrays([pa.array(textnum.signed(hashes[0])), pa.array(groups[0]), pa.array(counts[0])], ["h", "g", "c"])
                    hashes, groups, counts, size = [], [], [], 0
        if hashes:
            hashes, groups, counts = merged()
            yield pa.RecordBatch.from_arrays([pa.array(textnum.signed(hashes[0])), pa.array(groups[0]), pa.array(counts[0])], ["h", "g", "c"])

    return texts.mapInArrow(run, "h long, g int, c long").groupBy("h").agg(F.first("g").alias("g"), F.sum("c").alias("c"))


class Head:
    """The most frequent words: sorted hashes with count, group and item."""

    def __init__(self, table: pa.Table, rule: BrownRule):
        h = table["h"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        self.h, self.c, self.g = h[order], table["c"].to_numpy()[order], table["g"].to_numpy()[order]
        self.item = rule.items + self.g
        top = np.lexsort((self.h, -self.c))[: rule.items]
        self.item[top] = np.arange(len(top))

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.h):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        k = np.searchsorted(self.h, h)
        k[k == len(self.h)] = 0
        return k, self.h[k] == h

    def only_items(self, rule: BrownRule) -> Head:
        small = object.__new__(Head)
        on = self.item < rule.items
        small.h, small.c, small.g, small.item = self.h[on], self.c[on], self.g[on], self.item[on]
        return small

    def items(self, h: np.ndarray, g: np.ndarray, rule: BrownRule) -> np.ndarray:
        k, known = self.find(h)
        return np.where(known, self.item[k], rule.items + g) if len(self.h) else (rule.items + g)


def head_of(counts: DataFrame, rule: BrownRule) -> Head:
    """Words from a count on, so that there are at most rule.head of them; the bins' number doesn't grow with the corpus."""
    b = F.floor(F.log2(F.col("c").cast("double")) * 64)
    bins = sorted(((r.b, r.n) for r in counts.groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    total, least = 0, None
    for k, n in bins:
        if total + n > rule.head:
            break
        total, least = total + n, k
    chosen = counts.where(b >= least) if least is not None else counts.where("false")
    return Head(chosen.select("h", "g", "c").toArrow(), rule)


def _with_ends(items: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    """All texts' items with an end item after each text."""
    return np.insert(items, np.cumsum(counts), end)


def pair_counts(texts: DataFrame, head: Head, rule: BrownRule) -> np.ndarray:
    """Counts of neighbouring items over all training texts; each text starts after an end."""
    n = rule.end + 1
    sent = texts.sparkSession.sparkContext.broadcast(head.only_items(rule))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, keys, size = np.zeros(n * n, np.int64), [], 0
        for batch in textnum.small(batches):
            h, g, counts = _hashed(rule, batch.column(0))
            x = _with_ends(sent.value.items(h, g, rule), counts, rule.end).astype(np.int64)
            if len(x):
                keys.append(np.concatenate(([rule.end], x[:-1])) * n + x)
                size += len(x)
            if size > rule.flush:
                total += np.bincount(np.concatenate(keys), minlength=n * n)
                keys, size = [], 0
        if keys:
            total += np.bincount(np.concatenate(keys), minlength=n * n)
        at = np.flatnonzero(total)
        for s in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[s : s + 100_000], pa.int32()), pa.array(total[at[s : s + 100_000]])], ["k", "n"])

    table = texts.mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n * n)
    out[table["k"].to_numpy()] = table["n"].to_numpy()
    return out.reshape(n, n)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(pairs: np.ndarray, rule: BrownRule) -> np.ndarray:
    """The class of every item; the end item keeps the last class to itself.

    Items are visited in order of frequency, again and again, and each goes to the class where the
    classes' mutual information, sum n(c,d) log n(c,d) - sum n(c) log n(c) over left and right sides, is largest.
    """
    items, k = len(pairs), rule.classes
    end = items - 1
    freq = pairs.sum(axis=1)
    order = np.argsort(-freq[:end], kind="stable")
    cls = np.zeros(items, np.int64)
    cls[order] = np.minimum(np.arange(end), k - 2) if end < k else np.arange(end) % (k - 1)
    cls[end] = k - 1
    one = np.eye(k)[cls]
    right, left = pairs @ one, pairs.T @ one  # counts of an item before, and after, each class
    n = one.T @ right
    loops = np.diag(pairs).copy()
    for _ in range(rule.sweeps):
        moved = 0
        for w in order.tolist():
            a = int(cls[w])
            r, l, d = right[w], left[w], loops[w]
            if r.sum() + l.sum() == 0:
                continue
            # The table without w; a move to b adds r to row b, l to column b and w's own pair to the corner.
            r0, l0 = r.copy(), l.copy()
            r0[a] -= d
            l0[a] -= d
            m = n.copy()
            m[a] -= r0
            m[:, a] -= l0
            m[a, a] -= d
            rows, cols = m.sum(axis=1), m.sum(axis=0)
            log = _xlogx(m)
            row, col = _xlogx(m + r0[None, :]) - log, _xlogx(m + l0[:, None]) - log
            corner = np.diag(m)
            gain = row.sum(axis=1) - np.diag(row) + col.sum(axis=0) - np.diag(col) + _xlogx(corner + r0 + l0 + d) - np.diag(log)
            gain -= _xlogx(rows + r0.sum() + d) - _xlogx(rows) + _xlogx(cols + l0.sum() + d) - _xlogx(cols)
            gain[k - 1] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                continue
            m[b] += r0
            m[:, b] += l0
            m[b, b] += d
            n = m
            cls[w] = b
            right[:, a] -= pairs[:, w]
            right[:, b] += pairs[:, w]
            left[:, a] -= pairs[w]
            left[:, b] += pairs[w]
            moved += 1
        if not moved:
            break
    return cls


def _contexts(head: Head, cls: np.ndarray, group: np.ndarray, h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each word's context class, and its place in the head and whether it is there."""
    k, known = head.find(h)
    return (np.where(known, cls[k], group[g]) if len(head.h) else group[g]), k, known


#: A class of neighbours and its count, as bytes: a row's pairs are one binary value, which the engine copies as it is.
_PAIR = np.dtype([("k", "<u2"), ("n", "<i8")])


def _packed(cuts: np.ndarray, ks: np.ndarray, ns: np.ndarray) -> pa.Array:
    """A binary value of pairs for each row; cuts: where rows begin, and the end."""
    pairs = np.empty(len(ks), _PAIR)
    pairs["k"], pairs["n"] = ks, ns
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * _PAIR.itemsize).astype(np.int32)), pa.py_buffer(pairs.tobytes())])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of pairs of each row, and all rows' pairs."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, kind)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return np.diff(at) // _PAIR.itemsize, raw.view(_PAIR)


def neighbour_table(texts: DataFrame, head: Head, cls: np.ndarray, group: np.ndarray, rule: BrownRule) -> DataFrame:
    """h, g, v: for every word (for the end: 0 and rule.groups) pairs of the context classes k before it with their counts n, and of those
    after it as k + classes. A word has one row from each task or flush; all its rows are in one partition."""
    sent = texts.sparkSession.sparkContext.broadcast((head, cls, group))
    sides = 2 * rule.classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, cls, group = sent.value
        ws, ks, size = [], [], 0

        def rows(words, groups, ks, ns):
            # All four are sorted by word, then key.
            first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
            for at in range(0, len(first), 20_000):
                f = first[at : at + 20_000]
                stop = first[at + 20_000] if at + 20_000 < len(first) else len(words)
                v = _packed(np.append(f, stop) - f[0], ks[f[0] : stop], ns[f[0] : stop])
                yield pa.RecordBatch.from_arrays([pa.array(textnum.signed(words[f])), pa.array(groups[f].astype(np.int32)), v], ["h", "g", "v"])

        def flushed():
            h, g = np.concatenate([x[0] for x in ws]), np.concatenate([x[1] for x in ws])
            word, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            before, after = (np.concatenate([x[j] for x in ks]) for j in (0, 1))
            key = np.concatenate((inverse * sides + before, inverse * sides + rule.classes + after))
            if len(word) * sides <= 8 * len(key):
                n = np.bincount(key, minlength=len(word) * sides)
                key = np.flatnonzero(n)
                n = n[key]
            else:
                key, n = np.unique(key, return_counts=True)
            of = key // sides
            yield from rows(word[of], g[first][of], key % sides, n)

        for batch in textnum.small(batches):
            h, g, counts = _hashed(rule, batch.column(0))
            c, _, _ = _contexts(head, cls, group, h, g)
            c, h, g = (_with_ends(x, counts, e) for x, e in ((c, rule.classes - 1), (h, 0), (g, rule.groups)))
            if len(h):
                ws.append((h, g))
                ks.append((np.concatenate(([rule.classes - 1], c[:-1])), np.append(c[1:], rule.classes - 1)))
                # A text's end is followed by nothing; the class after it counts for the end alone.
                size += len(h)
            if size > rule.flush:
                yield from flushed()
                ws, ks, size = [], [], 0
        if size:
            yield from flushed()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        h, g = (np.concatenate([p.column(i).to_numpy() for p in parts]) for i in (0, 1))
        lengths, pairs = zip(*(_unpacked(p.column(2)) for p in parts))
        length, pairs = np.concatenate(lengths), np.concatenate(pairs)
        k, n, start = pairs["k"], pairs["n"], np.cumsum(length) - length
        order = np.argsort(h, kind="stable")
        word = np.cumsum(np.concatenate(([False], h[order][1:] != h[order][:-1])))
        cuts = np.searchsorted(word, np.arange(0, int(word[-1]) + 5001, 5000))
        for a, b in zip(cuts, cuts[1:]):
            o, w = order[a:b], word[a:b] - word[a]
            m, first = int(w[-1]) + 1, np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
            per = length[o]
            flat = np.repeat(start[o] - (np.cumsum(per) - per), per) + np.arange(per.sum())
            v = np.bincount(np.repeat(w, per) * sides + k[flat].astype(np.int64), weights=n[flat], minlength=m * sides).astype(np.int64)
            at = np.flatnonzero(v)
            ends = np.searchsorted(at, np.arange(m + 1) * sides)
            yield pa.RecordBatch.from_arrays([pa.array(h[o[first]]), pa.array(g[o[first]]), _packed(ends, at % sides, v[at])], ["h", "g", "v"])

    schema = "h long, g int, v binary"
    return staged(texts.mapInArrow(run, schema).repartition("h").mapInArrow(merged, schema), "brown-neighbours")


def _assign(batch: pa.RecordBatch, logs: np.ndarray, rule: BrownRule) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups, counts, best classes (-1 below rule.least) and neighbour counts of a neighbour table's rows."""
    width, (length, pairs) = 2 * rule.classes, _unpacked(batch.column(2))
    at = np.repeat(np.arange(batch.num_rows), length) * width + pairs["k"]
    v = np.bincount(at, weights=pairs["n"], minlength=batch.num_rows * width).reshape(-1, width)
    g, c = batch.column(1).to_numpy(), v[:, : rule.classes].sum(axis=1)
    cls = (v @ logs)[:, : rule.classes - 1].argmax(axis=1)
    return g, c, np.where(g == rule.groups, rule.classes - 1, np.where(c < rule.least, -1, cls)), v


def class_sums(table: DataFrame, logs: np.ndarray, group: np.ndarray, rule: BrownRule) -> np.ndarray:
    """Neighbour counts of each class, summed over all its words."""
    k = rule.classes
    classes = np.append(group, k - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, 2 * k))
        for batch in textnum.small(batches, 5000):
            g, _, cls, v = _assign(batch, logs, rule)
            total += np.eye(k)[np.where(cls < 0, classes[g], cls)].T @ v
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total.ravel()[at].astype(np.int64))], ["k", "n"])

    found = table.mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(2 * k * k)
    out[found["k"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(k, 2 * k)


def class_logs(sums: np.ndarray, rule: BrownRule) -> np.ndarray:
    """log P(neighbour's class | class) for each side, a column for each class."""
    sides = sums.reshape(rule.classes, 2, rule.classes) + 0.5
    return np.log(sides / sides.sum(axis=2, keepdims=True)).reshape(rule.classes, -1).T.copy()


def word_classes(table: DataFrame, logs: np.ndarray, rule: BrownRule) -> DataFrame:
    """h, g, c, cls of all words, without the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textnum.small(batches, 5000):
            g, c, cls, _ = _assign(batch, logs, rule)
            out = [batch.column(0), batch.column(1), pa.array(c.astype(np.int64)), pa.array(cls.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, ["h", "g", "c", "cls"]).filter(pa.array(g < rule.groups))

    return staged(table.mapInArrow(run, "h long, g int, c long, cls int"), "brown-classes")


@dataclass
class Tables:
    """What scoring needs: context and class (-1: its group's) of the head's words, the groups' class, log10 of transitions and of
    classes' and groups' smoothing denominators, and of groups' emissions."""

    context: np.ndarray
    classes: np.ndarray
    group_class: np.ndarray
    transition: np.ndarray
    class_size: np.ndarray
    emission: np.ndarray
    group: np.ndarray
    tokens: int
    distinct: int
    ends: int


def fit(train: DataFrame, rule: BrownRule = BrownRule()) -> tuple[DataFrame, Head, Tables]:
    """Words with counts and classes, head and model tables; train has one column, the training texts."""
    counts = staged(word_counts(train, rule), "brown-counts")
    head = head_of(counts, rule)
    pairs = pair_counts(train, head, rule)
    items, k = exchange(pairs, rule), rule.classes
    one = np.eye(k)[items]
    n = one.T @ pairs @ one
    logs = class_logs(np.concatenate((n.T, n), axis=1), rule)
    group_class, classes = items[rule.items : rule.end], items[head.item]
    for _ in range(rule.passes):
        context = classes
        table = neighbour_table(train, head, context, group_class, rule)
        for _ in range(rule.rounds):
            logs = class_logs(class_sums(table, logs, group_class, rule), rule)
        words = word_classes(table, logs, rule)
        found = words.where(F.col("c") >= int(head.c.min()) if len(head.c) else F.lit(False)).select("h", "cls").toArrow()
        at, known = head.find(found["h"].to_numpy().view(np.uint64))
        own = np.full(len(head.h), -1)
        own[at[known]] = found["cls"].to_numpy()[known]
        classes = np.where(own >= 0, own, group_class[head.g])
    n = class_sums(table, logs, group_class, rule)[:, :k].T
    before, after, total = n.sum(axis=1), n.sum(axis=0), n.sum()
    kinds = (n > 0).sum(axis=1)
    unigram = (after + 1) / (total + k)
    smooth = (n + (kinds + 1)[:, None] * unigram[None, :]) / (before + kinds + 1)[:, None]
    members = np.bincount(group_class, minlength=k) + np.eye(k)[k - 1]
    rare, tokens, distinct = np.zeros((rule.groups, 2)), 0, 0
    for r in words.groupBy("g", F.when(F.col("cls") >= 0, F.col("cls")).otherwise(-1).alias("cls")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        tokens, distinct = tokens + r.c, distinct + r.v
        if r.cls < 0:
            rare[r.g] += r.c, r.v
        else:
            members[r.cls] += r.v
    size = np.log10(np.maximum(after + members, 1))
    emission = np.log10(rare[:, 0] + 1) - size[group_class]
    ends = int(pairs.sum(axis=0)[rule.end])
    return words, head, Tables(context, own, group_class, np.log10(smooth), size, emission, np.log10(rare.sum(axis=1) + 1), int(tokens) + ends, int(distinct) + (ends > 0), ends)


def score(docs: DataFrame, model: tuple[DataFrame, Head, Tables], rule: BrownRule = BrownRule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity for every row."""
    words, head, tables = model
    sent = docs.sparkSession.sparkContext.broadcast((head, tables))
    floor = float(np.log10(tables.tokens + tables.distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, t = sent.value
        logs = np.log10(head.c + 1)
        own = t.classes >= 0
        cls = np.where(own, t.classes, t.group_class[head.g])
        word = logs + np.where(own, -t.class_size[cls], t.emission[head.g] - t.group[head.g])
        unseen = t.emission - t.group
        stop = np.log10(t.ends + 1) - t.class_size[rule.classes - 1]
        for batch in textnum.small(batches):
            h, g, n = _hashed(rule, batch.column(1))
            context, k, known = _contexts(head, t.context, t.group_class, h, g)
            if len(head.h):
                c = np.where(known, cls[k], t.group_class[g])
                base, inside = np.where(known, logs[k], 0.0), np.where(known, word[k], unseen[g])
            else:
                c, base, inside = t.group_class[g], np.zeros(len(h)), unseen[g]
            doc, end = np.repeat(np.arange(len(n)), n), rule.classes - 1
            context, c, inside = _with_ends(context, n, end), _with_ends(c, n, end), _with_ends(inside, n, stop)
            whose = np.repeat(np.arange(len(n)), n + 1)
            before = np.concatenate(([end], context[:-1])) if len(c) else context
            value = t.transition[before, c] + inside
            add = lambda v, at: np.bincount(at, weights=v, minlength=len(n))
            rest = np.flatnonzero(~known)
            at = rest + doc[rest]
            cuts = pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc[rest], minlength=len(n))))), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, x) for x in (pa.array(textnum.signed(h[rest])), pa.array(before[at], pa.int16()), pa.array(value[at]))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n + 1), pa.array(np.bincount(doc[known], minlength=len(n)) + int(t.ends > 0)),
                    pa.array(add(base, doc) + np.log10(t.ends + 1) - (n + 1) * floor), pa.array(add(value, whose)), *lists,
                ],
                ["doc_id", "n_tokens", "known", "base", "model", "rest", "before", "value"],
            )

    d = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    part = d.mapInArrow(run, "doc_id long, n_tokens long, known long, base double, model double, rest array<long>, before array<short>, value array<double>")
    part = staged(part.withColumn("row", F.monotonically_increasing_id()), "brown-parts")
    # What a word beyond the head adds to its unseen value: its count inside the group, or all of its own class.
    x = part.select("row", F.explode(F.arrays_zip("rest", "before", "value")).alias("x"))
    seen = x.select("row", F.col("x.rest").alias("h"), F.col("x.before").alias("b"), F.col("x.value").alias("value")).join(words.select("h", "c", "cls"), "h")
    log = F.log10(F.col("c") + 1)
    transition, size = F.lit(np.ascontiguousarray(tables.transition.ravel())), F.lit(tables.class_size)
    classed = F.get(transition, F.col("b") * rule.classes + F.col("cls")) - F.get(size, F.col("cls")) - F.col("value")
    more = F.when(F.col("cls") >= 0, log + classed).otherwise(log)
    met = seen.groupBy("row").agg(F.sum(log).alias("logs"), F.sum(more).alias("gain"), F.count(F.lit(1)).alias("more"))
    out = part.drop("rest", "before", "value").join(met, "row", "left")
    total = F.col("model") + F.coalesce("gain", F.lit(0.0))
    return out.select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"), F.lit(tables.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", F.lit(0.0))).alias("base_score"), total.alias("score"), F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"),
    )


def held_out(key: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == fold
