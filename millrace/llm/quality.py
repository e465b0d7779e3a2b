"""Quality classifier by co-training two views: text content and page metadata.

The content view is the text's character trigrams (bytes, hashed to ``content`` buckets, square roots of
shares) and its shares of repeated words, word pairs and lines. The metadata view is language, source, sizes, line
layout and shares of character classes.
Each view has a ridge-penalised logistic regression, fitted by Newton steps whose gradient and Hessian
are summed over all rows of the corpus. After a first fit on the labels, each round freezes both models;
unlabelled documents of which one view is sure become pseudo-labelled rows, at a lower weight, of
the other view. Labelled rows of one fold are kept out of the fits and calibrate each view (Platt
scaling on a histogram of scores); the mean of the calibrated log-odds is the score of a document.

Only the two parameter vectors and their Hessians, whose sizes are set by the rule, reach the driver.
Features of all documents are staged once in the shared folder as half-precision vectors.

Defined results: a null or empty text has an empty content view; null language, source and size are values of
their own; null labels don't count, and a doc_id with several labels takes the smallest; without labels of both
kinds every score is 0.5 and every document is kept; repeated rows score alike; an empty table gives an empty
result; extra columns are ignored by ``score`` and carried by ``keep``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import settle, staged
from millrace.llm.textnum import LINE_END, PIECE, small, views, word_hashes


@dataclass(frozen=True)
class CoRule:
    content: int = 128
    rounds: int = 2
    first_steps: int = 7
    steps: int = 3
    sure: float = 0.98
    pseudo_weight: float = 0.2
    ridge: float = 0.1
    folds: int = 10
    threshold: float = 0.5


_LANGS, _SOURCES = 8, 16
_CLASSES = [range(65, 91), range(97, 123), range(48, 58), (32,), (9, 10, 11, 12, 13), b".,;:?", b"!", b"'\"()-", b"#$%&*@^~", b"|<>{}[]/\\=_+", range(128, 256)]
REPEATS = 4
META = 9 + len(_CLASSES) + _LANGS + _SOURCES
_CLASS_OF = np.zeros((256, len(_CLASSES)))
for _k, _c in enumerate(_CLASSES):
    _CLASS_OF[list(_c), _k] = 1


def _slot(value, n: int) -> int:
    return 0 if value is None else 1 + zlib.crc32(str(value).encode()) % (n - 1)


def content_view(text: bytes | memoryview, n: int) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    counts = np.zeros(n)
    for s in range(0, max(0, len(raw) - 2), PIECE):
        b = raw[s : s + PIECE + 2].astype(np.uint32)
        h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        counts += np.bincount((h >> np.uint32(12)) % np.uint32(n), minlength=n)
    return np.sqrt(counts / max(1.0, counts.sum()))


def repeats(words: np.ndarray, lines: np.ndarray) -> tuple[float, float, float, float]:
    """Shares of words like the one before, and of repeated words, word pairs and lines. Few words say little and count for less."""
    n = len(words)
    if n < 2:
        return 0.0, 0.0, 0.0, 0.0
    pairs = words[:-1] * np.uint64(3) + words[1:]
    trust = n / (n + 5)
    full = len(lines) / (len(lines) + 2)
    return trust * float((words[1:] == words[:-1]).mean()), trust * (1 - len(np.unique(words)) / n), trust * (1 - len(np.unique(pairs)) / (n - 1)), full * (1 - len(np.unique(lines)) / max(1, len(lines)))


def metadata_view(text: bytes | memoryview, lang, source, n_chars) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    freq = np.bincount(raw, minlength=256)
    size = max(1, len(raw))
    lines = freq[10] + 1
    words = freq[32] + freq[9] + lines
    out = np.zeros(META)
    capital = (raw >= 65) & (raw <= 90)
    out[:9] = 1.0, np.log1p(max(0, n_chars or 0)), n_chars is None, np.log1p(lines), np.log1p(size / lines), np.log1p(words), np.log1p(size / words), len(raw) == 0, 3 * np.sqrt((capital[1:] & capital[:-1]).sum() / size)
    out[9 : 9 + len(_CLASSES)] = np.sqrt(freq @ _CLASS_OF / size) * 3
    at = 9 + len(_CLASSES)
    out[at + _slot(lang, _LANGS)] = 1
    out[at + _LANGS + _slot(source, _SOURCES)] = 1
    return out


def _viewed(batch: pa.RecordBatch, at: list[int], rule: CoRule) -> tuple[np.ndarray, np.ndarray]:
    """Both views of all rows; at: columns of text, lang, source and n_chars, -1 where there is none."""
    texts = views(batch.column(at[0]))
    lang, source, size = (batch.column(k).to_pylist() if k >= 0 else [None] * len(texts) for k in at[1:])
    c, m = np.zeros((len(texts), rule.content + REPEATS + 1), np.float16), np.zeros((len(texts), META), np.float16)
    words, n_words = word_hashes(texts)
    lines, n_lines = word_hashes(texts, LINE_END)
    word_at, line_at = np.concatenate(([0], np.cumsum(n_words))), np.concatenate(([0], np.cumsum(n_lines)))
    for i, t in enumerate(texts):
        c[i, : rule.content], c[i, -1] = content_view(t, rule.content) * 4, 1
        c[i, rule.content : -1] = np.array(repeats(words[word_at[i] : word_at[i + 1]], lines[line_at[i] : line_at[i + 1]])) * 4
        m[i] = metadata_view(t, lang[i], source[i], size[i])
    return c, m


def _places(df: DataFrame) -> list[int]:
    return [df.columns.index(c) if c in df.columns else -1 for c in ("text", "lang", "source", "n_chars")]


def features(docs: DataFrame, labels: DataFrame, rule: CoRule = CoRule(), label: str = "quality") -> DataFrame:
    """doc_id, y (null where unlabelled), fold, c and m (views as bytes) for every row; staged."""
    have = [c for c in ("text", "lang", "source", "n_chars") if c in docs.columns]
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("long" if c == "n_chars" else "string").alias(c) for c in have])
    at = _places(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            c, m = _viewed(batch, at, rule)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in c], pa.binary()), pa.array([r.tobytes() for r in m], pa.binary())], ["doc_id", "c", "m"])

    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
    # Rows without an id are spread over all tasks: a left join would deal their one null key to a single one.
    rows = d.mapInArrow(run, "doc_id long, c binary, m binary")
    keyed = rows.withColumns({"__none": F.col("doc_id").isNull(), "__key": F.coalesce("doc_id", F.monotonically_increasing_id())})
    rows = keyed.join(known.select(F.lit(False).alias("__none"), F.col("doc_id").alias("__key"), "y"), ["__none", "__key"], "left").drop("__none", "__key")
    return staged(rows.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(rule.folds)).cast("int")), "quality-views")


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float16).reshape(len(rows), -1).astype(np.float64) if rows else np.zeros((0, 1))


def _odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w, -30, 30)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


def _sums(feats: DataFrame, models: list[np.ndarray], frozen: list[np.ndarray] | None, rule: CoRule) -> list[tuple[np.ndarray, np.ndarray]]:
    """Gradient and Hessian of both views at ``models``, over labelled rows and, with frozen models, the pseudo-labelled ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [(np.zeros(len(w)), np.zeros((len(w), len(w)))) for w in models]
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                part = batch.slice(s, 2000)
                y, fold = (np.array(part.column(k).to_pylist(), float) for k in (0, 1))
                use = (fold > 0) & ~np.isnan(y)
                x = [_matrix(part.column(2)), _matrix(part.column(3))]
                weight, target = [use * 1.0, use * 1.0], [np.nan_to_num(y), np.nan_to_num(y)]
                if frozen:
                    for k in (0, 1):
                        p = _sigmoid(_odds(x[k], frozen[k]))
                        sure = np.isnan(y) & ((p >= rule.sure) | (p <= 1 - rule.sure))
                        weight[1 - k] = np.where(sure, rule.pseudo_weight, weight[1 - k])
                        target[1 - k] = np.where(sure, p >= 0.5, target[1 - k])
                for k in (0, 1):
                    on = weight[k] > 0
                    xs, ws = x[k][on], weight[k][on]
                    p = _sigmoid(_odds(xs, models[k]))
                    total[k] = (total[k][0] + xs.T @ (ws * (p - target[k][on])), total[k][1] + (xs * (ws * p * (1 - p))[:, None]).T @ xs)
        flat = np.concatenate([np.concatenate([g, h.ravel()]) for g, h in total])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat, pa.float64())], ["i", "v"])

    rows = feats.select("y", "fold", "c", "m").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    flat = np.zeros(sum(len(w) * (len(w) + 1) for w in models))
    flat[rows["i"].to_numpy()] = rows["v"].to_numpy()
    out, at = [], 0
    for w in models:
        n = len(w)
        out.append((flat[at : at + n], flat[at + n : at + n + n * n].reshape(n, n)))
        at += n * (n + 1)
    return out


def _steps(feats: DataFrame, models: list[np.ndarray], frozen, steps: int, rule: CoRule) -> list[np.ndarray]:
    for _ in range(steps):
        moved = []
        for w, (g, h) in zip(models, _sums(feats, models, frozen, rule)):
            step = np.linalg.solve(h + rule.ridge * np.eye(len(w)), g + rule.ridge * w)
            moved.append(w - step * min(1.0, 8.0 / max(1e-12, np.abs(step).max())))
        models = moved
        settle(feats.sparkSession)
    return models


def _calibrated(feats: DataFrame, models: list[np.ndarray], rule: CoRule) -> list[tuple[float, float]]:
    """Platt's slope and offset of each view, from a histogram of the held-out labelled rows' log-odds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for k in (0, 1):
                    bins = np.round(_odds(_matrix(batch.column(2 + k)), models[k]) * 4).astype(int)
                    yield pa.RecordBatch.from_arrays([pa.array([k] * batch.num_rows, pa.int32()), pa.array(bins, pa.int32()), batch.column(0)], ["k", "bin", "y"])

    rows = feats.where("y IS NOT NULL AND fold = 0").select("y", "fold", "c", "m").mapInArrow(run, "k int, bin int, y int").groupBy("k", "bin", "y").count().collect()
    out = []
    for k in (0, 1):
        cells = [(r.bin / 4, r.y, r["count"]) for r in rows if r.k == k]
        a = np.array([1.0, 0.0])
        pos, neg = sum(c for _, y, c in cells if y), sum(c for _, y, c in cells if not y)
        if pos and neg:
            x = np.array([[s, 1.0] for s, _, _ in cells])
            # Platt's smoothed targets keep the slope finite where a view separates the classes.
            t = np.array([(pos + 1) / (pos + 2) if y else 1 / (neg + 2) for _, y, _ in cells])
            n = np.array([c for _, _, c in cells], float)
            for _ in range(50):
                p = _sigmoid(np.clip(x @ a, -30, 30))
                step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (n * (p - t)))
                a = a - step * min(1.0, 1.0 / max(1e-12, np.abs(step).max()))
        out.append((float(a[0]), float(a[1])))
    return out


@dataclass(frozen=True)
class Model:
    """Both views' weights and calibrations; None stands for a corpus without labels of both kinds."""

    weights: list[np.ndarray] | None
    scales: list[tuple[float, float]]

    def scores(self, c: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.weights is None:
            half = np.full(len(c), 0.5)
            return half, half, half
        odds = [a * _odds(x, w) + b for x, w, (a, b) in zip((c, m), self.weights, self.scales)]
        return _sigmoid(odds[0]), _sigmoid(odds[1]), _sigmoid((odds[0] + odds[1]) / 2)


def train(feats: DataFrame, rule: CoRule = CoRule()) -> Model:
    kinds = feats.where("y IS NOT NULL AND fold > 0").agg(F.min("y"), F.max("y")).first()
    if kinds[0] is None or kinds[0] == kinds[1]:
        return Model(None, [])
    models = _steps(feats, [np.zeros(rule.content + REPEATS + 1), np.zeros(META)], None, rule.first_steps, rule)
    for _ in range(rule.rounds):
        models = _steps(feats, models, models, rule.steps, rule)
    return Model(models, _calibrated(feats, models, rule))


def score(feats: DataFrame, model: Model, rule: CoRule = CoRule()) -> DataFrame:
    """doc_id, content_score, metadata_score, score, kept for every row of the features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, m, p = model.scores(_matrix(batch.column(1)), _matrix(batch.column(2))) if batch.num_rows else ([], [], np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(c, pa.float64()), pa.array(m, pa.float64()), pa.array(p, pa.float64()), pa.array(np.asarray(p) >= rule.threshold)], ["doc_id", "content_score", "metadata_score", "score", "kept"])

    return feats.select("doc_id", "c", "m").mapInArrow(run, "doc_id long, content_score double, metadata_score double, score double, kept boolean")


def keep(docs: DataFrame, model: Model, rule: CoRule = CoRule()) -> DataFrame:
    """The documents, with all their columns, that the model doesn't reject: views are made anew, so texts aren't shuffled."""
    at = _places(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            c, m = _viewed(batch, at, rule)
            yield batch.filter(pa.array(model.scores(c.astype(float), m.astype(float))[2] >= rule.threshold))

    return docs.mapInArrow(run, docs.schema)
