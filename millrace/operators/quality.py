"""Quality scoring: pluggable models, threshold calibration and score statistics."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.filtering import settled
from millrace.operators.staging import exists, read_text, staged, write_text
from millrace.plans.config import QualityConfig

GRID = range(5, 96)


class QualityModel(Protocol):
    def score(self, df: DataFrame, text: str, out: str) -> DataFrame: ...


class HeuristicModel:
    """Mean of four shares: letters, words of ordinary length, distinct words, and size against 50 words."""

    def score(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """Text, words and score are settled one after the other: predicates on the score, and the words' four readers, would otherwise each
        bring the whole chain of expressions below them once more."""
        words, n, chars = F.col("__words"), F.size("__words").cast("double"), F.col("__chars").cast("double")
        ordinary = F.size(F.filter(words, lambda w: F.length(w).between(2, 12))).cast("double")
        distinct = F.size(F.array_distinct(words)).cast("double")
        mean = F.when(n == 0, 0.0).otherwise((F.col("__letters").cast("double") / chars + ordinary / n + distinct / n + F.least(n / 50, F.lit(1.0))) / 4)
        plain, columns = F.col("__plain"), tuple(c for c in df.columns if c != out)
        df = settled(df.select(*columns, F.replace(F.col(text), F.lit("\n"), F.lit(" ")).alias("__plain")), columns)
        parts = (F.array_remove(F.split(plain, " "), "").alias("__words"), F.length(plain).alias("__chars"), F.length(F.regexp_replace(plain, "[^A-Za-z]", "")).alias("__letters"))
        return settled(settled(df.select(*columns, *parts), columns).select(*columns, mean.alias(out)), columns)


class LinearModel:
    """Hashed words and word pairs with logistic regression, trained and applied by pyspark.ml."""

    def __init__(self, model, trained: str | None = None, asked: str | None = None):
        """trained: the label that the model gives probabilities of; asked: the one that scores are wanted of."""
        self.model, self.trained, self.asked = model, trained, asked or trained

    @staticmethod
    def _stages(features: int):
        from pyspark.ml.feature import SQLTransformer, HashingTF, NGram, RegexTokenizer

        words = RegexTokenizer(inputCol="__text", outputCol="__words", pattern=r"\s+", minTokenLength=1)
        pairs = NGram(n=2, inputCol="__words", outputCol="__pairs")
        both = SQLTransformer(statement="SELECT *, concat(__words, __pairs) AS __grams FROM __THIS__")
        return [words, pairs, both, HashingTF(numFeatures=features, inputCol="__grams", outputCol="__features")]

    @classmethod
    def train(cls, samples: DataFrame, epochs: int = 10, features: int = 1 << 16, reg: float = 1e-4, positive_label: str | None = None) -> LinearModel:
        """samples: text and label (1.0 is the positive class, which may have a name)."""
        from pyspark.ml import Pipeline
        from pyspark.ml.classification import LogisticRegression

        data = samples.select(F.trim(F.translate("text", "\n", " ")).alias("__text"), F.col("label").cast("double").alias("label"))
        lr = LogisticRegression(featuresCol="__features", labelCol="label", probabilityCol="__p", rawPredictionCol="__raw", predictionCol="__label", maxIter=epochs, regParam=reg)
        return cls(Pipeline(stages=[*cls._stages(features), lr]).fit(data), positive_label)

    @classmethod
    def load(cls, path: str, asked: str | None = None) -> LinearModel:
        from pyspark.ml import PipelineModel

        label = read_text(SparkSession.getActiveSession(), f"{path}/label.txt")
        return cls(PipelineModel.load(path), label, asked)

    def save(self, path: str, overwrite: bool = False) -> None:
        writer = self.model.write()
        (writer.overwrite() if overwrite else writer).save(path)
        if self.trained is not None:
            write_text(SparkSession.getActiveSession(), f"{path}/label.txt", self.trained)

    def score(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """The asked label's probability; 0 for a label that the model doesn't know."""
        from pyspark.ml.functions import vector_to_array

        if self.trained is not None and self.asked != self.trained:
            return df.withColumn(out, F.lit(0.0))

        columns = df.columns
        scored = self.model.transform(df.withColumn("__text", F.trim(F.translate(F.col(text), "\n", " "))))
        return scored.select(*columns, vector_to_array("__p")[1].alias(out))


def model_for(config: QualityConfig, override: QualityModel | None = None) -> QualityModel | None:
    """None where scoring is off (every score is 1.0); ValueError where it is on without a model."""
    if not config.enabled:
        return None
    if override is not None:
        return override
    if not config.model_path:
        raise ValueError("quality.model_path is needed where quality is enabled")
    if not exists(SparkSession.getActiveSession(), config.model_path):
        raise ValueError(f"there is no quality model at {config.model_path}")
    return LinearModel.load(config.model_path, config.positive_label)


def scored(df: DataFrame, config: QualityConfig = QualityConfig(), model: QualityModel | None = None, text: str = "canonical_text", out: str = "quality_score") -> DataFrame:
    found = model_for(config, model)
    return df.withColumn(out, F.lit(1.0)) if found is None else found.score(df, text, out)


def calibrate(scores: DataFrame) -> DataFrame:
    """threshold, precision, recall, f1 of the grid 0.05..0.95 with the largest F1, the lowest on ties; scores: score, label.

    One pass counts rows by grid cell and label; the running sums over at most 92 cells need no grid join.
    """
    cell = F.least(F.lit(96), F.greatest(F.lit(4), F.floor(F.col("score") * 100 + 1e-9).cast("int")))
    cells = scores.groupBy(cell.alias("cell")).agg(F.sum((F.col("label") == 1).cast("long")).alias("pos"), F.sum((F.col("label") != 1).cast("long")).alias("neg"))
    # At threshold t a score in cell c is positive where c >= t, as floor(100 s) >= 100 t.
    folded = cells.agg(F.collect_list(F.struct("cell", "pos", "neg")).alias("cells"))
    grid = folded.select("cells", F.explode(F.sequence(F.lit(GRID.start), F.lit(GRID.stop - 1))).alias("t"))
    total = lambda test, what: F.coalesce(F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + F.when(test(c), c[what]).otherwise(F.lit(0).cast("long"))), F.lit(0))
    g = grid.select("t", total(lambda c: c["cell"] >= F.col("t"), "pos").alias("tp"), total(lambda c: c["cell"] >= F.col("t"), "neg").alias("fp"), total(lambda c: c["cell"] < F.col("t"), "pos").alias("fn"))
    ratio = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    g = g.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    g = g.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    best = g.orderBy(F.col("f1").desc(), "t").limit(1)
    none = F.col("tp") + F.col("fp") + F.col("fn") == 0
    return best.select(F.when(none, 0.5).otherwise(F.col("t") / 100).alias("threshold"), "precision", "recall", "f1")


def score_stats(df: DataFrame, score: str = "quality_score", order: str = "_ord", sample: int = 50_000) -> DataFrame:
    """count, sum, mean, min and max of all scores; p10, p50 and p90 of the first ``sample`` in input order.

    Scores are written once, as a narrow table: each aggregate would compute the model's expression anew.
    """
    df = staged(df.select(order, score), "scores")
    totals = df.agg(F.count(score).alias("count"), F.coalesce(F.sum(score), F.lit(0.0)).alias("sum"), F.coalesce(F.avg(score), F.lit(0.0)).alias("mean"), F.min(score).alias("min"), F.max(score).alias("max"))
    first = df.where(F.col(score).isNotNull()).select(order, score).orderBy(order).limit(sample)
    q = first.agg(F.percentile(score, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("q"))
    return totals.join(q).select("count", "sum", "mean", "min", "max", F.col("q")[0].alias("p10"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p90"))


@dataclass
class ScoreStats:
    """Count, sum, range and first scores, in input order, of any number of runs; ``limit`` bounds what reaches the driver."""

    count: int = 0
    total: float = 0.0
    least: float | None = None
    most: float | None = None
    first: list[float] = field(default_factory=list)

    @classmethod
    def of(cls, df: DataFrame, score: str = "quality_score", order: str = "_ord", limit: int = 50_000) -> ScoreStats:
        s = df.agg(F.count(score).alias("n"), F.sum(score).alias("sum"), F.min(score).alias("min"), F.max(score).alias("max")).first()
        first = [r[0] for r in df.where(F.col(score).isNotNull()).orderBy(order).limit(limit).select(score).collect()]
        return cls(s.n, s["sum"] or 0.0, s["min"], s["max"], first)

    def merged(self, later: ScoreStats, limit: int = 50_000) -> ScoreStats:
        ends = lambda f, *x: f((v for v in x if v is not None), default=None)
        return ScoreStats(self.count + later.count, self.total + later.total, ends(min, self.least, later.least), ends(max, self.most, later.most), (self.first + later.first)[:limit])

    def quantile(self, share: float) -> float:
        values = sorted(self.first)
        at = (len(values) - 1) * share
        low = math.floor(at)
        high = min(low + 1, len(values) - 1)
        return values[low] + (values[high] - values[low]) * (at - low)

    def summary(self) -> dict[str, Any]:
        marks = {f"p{p}": self.quantile(p / 100) for p in (10, 50, 90)} if self.first else {}
        return {"count": self.count, "sum": self.total, "mean": self.total / self.count if self.count else 0.0, "min": self.least, "max": self.most, "quantiles": marks}

    def state(self) -> dict[str, Any]:
        return {"count": self.count, "sum": self.total, "min": self.least, "max": self.most, "first": self.first}

    @classmethod
    def from_state(cls, state: dict[str, Any]) -> ScoreStats:
        return cls(int(state.get("count") or 0), float(state.get("sum") or 0.0), state.get("min"), state.get("max"), list(state.get("first") or []))
