"""Boosted trees, calibration and their selection, all with pyspark.ml."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretide import fixed
from foretide.functions import pricing as P
from foretide.functions import scalars as S
from foretide.operators import metrics as M
from foretide.operators import quality as Q
from foretide.operators.isotonic import fitted, pooled_blocks
from foretide.operators.medians import exact_medians
from foretide.operators.ordered import find_hot, rank_rows
from foretide.session import stable, written


# Training rows of one partition: a pass over fewer takes less time than the start of a task.
PARTITION_ROWS = 50_000


def feature_matrix(df: DataFrame, features, fills: dict | None = None, medians_of: DataFrame | None = None) -> DataFrame:
    """Features as doubles without infinities.

    Trees in pyspark.ml have no branch for missing values: a missing value gets its fill (or the
    median of the training rows), and every such column also gets a 0/1 column saying so.
    """
    fills = dict(fills or {})
    out = df.withColumns({c: S.real(F.col(c).cast("double")) for c in features})
    open_ = [c for c in features if c not in fills]
    if medians_of is not None and open_:
        trained = medians_of.withColumns({c: S.real(F.col(c).cast("double")) for c in open_})
        fills |= exact_medians(trained, open_)
    flags = {f"{c}__missing": F.col(c).isNull().cast("double") for c in features}
    return out.withColumns(flags).fillna({c: float(fills.get(c) or 0.0) for c in features})


@dataclass
class PointModel:
    features: list[str]
    inputs: list[str]
    fills: dict
    model: object

    def score(self, df: DataFrame, name: str = "proba_point_1p_raw") -> DataFrame:
        ready = feature_matrix(df, self.features, self.fills)
        scored = self.model.transform(ready).withColumn(name, vector_to_array("probability")[1])
        gone = [c for c in scored.columns if c.endswith("__missing")]
        return scored.drop("__features", "rawPrediction", "probability", "prediction", *gone)


def fit_trees(train: DataFrame, features, target: str = fixed.TARGET, weighted: bool = True, rounds: int = 300,
              depth: int = 6, least_rows: int = 50, rate: float = 0.05, seed: int = 42, at_least: int = 5) -> PointModel:
    """Gradient-boosted trees on the features that vary in the training rows: `at_least` so many, and two classes."""
    Q.require_at_least(train, target, 2, "training rows")
    kept = Q.useful_features(train.withColumns({c: S.real(F.col(c).cast("double")) for c in features}), list(features), at_least)
    clean = train.withColumns({c: S.real(F.col(c).cast("double")) for c in kept})
    fills = exact_medians(clean, kept)
    ready = feature_matrix(train, kept, fills).withColumn("__label", F.col(target).cast("double"))
    inputs = kept + Q.useful_features(ready, [f"{c}__missing" for c in kept], at_least=0)
    if weighted:
        ready = M.class_weights(ready, "__label", "__weight")
    # The training rows are read several times per boosting round: write them once instead of recomputing, in no more
    # partitions than they fill.
    ready = stable(ready.select("__label", *inputs, *(["__weight"] if weighted else [])))
    ready = ready.coalesce(ready.count() // PARTITION_ROWS + 1)
    trees = GBTClassifier(
        featuresCol="__features", labelCol="__label", maxIter=rounds, maxDepth=depth, stepSize=rate,
        minInstancesPerNode=least_rows, seed=seed, checkpointInterval=10,
        **({"weightCol": "__weight"} if weighted else {}),
    )
    stages = [VectorAssembler(inputCols=inputs, outputCol="__features"), trees]
    return PointModel(kept, inputs, fills, Pipeline(stages=stages).fit(ready))


# ------------------------------------------------------------------ calibration


@dataclass
class Calibrator:
    """A fitted map from raw to calibrated probability."""

    method: str
    on_logit: bool = True
    model: object = None

    def apply(self, df: DataFrame, raw: str, name: str) -> DataFrame:
        if self.method == "raw":
            return df.withColumn(name, P.clip_probability(raw))
        if self.method == "sigmoid":
            x = P.logit(raw) if self.on_logit else F.col(raw)
            line = F.lit(self.model.coefficients[0]) * x + F.lit(self.model.intercept)
            return df.withColumn(name, P.clip_probability(1.0 / (1.0 + F.exp(-line))))
        out = fitted(self.model, df, raw, "__fitted")
        return out.withColumn(name, P.clip_probability(S.clip("__fitted", 0.0, 1.0))).drop("__fitted")


def _per_score(df: DataFrame, raw: str, target: str) -> DataFrame:
    """Rows with equal score and outcome collapse to one weighted row; the fit is the same."""
    return df.groupBy(F.col(raw).alias("__raw"), F.col(target).cast("double").alias("__label")).agg(
        F.count(F.lit(1)).cast("double").alias("__weight")
    )


def fit_sigmoid(df: DataFrame, raw: str, target: str, on_logit: bool = True) -> Calibrator:
    """Logistic curve through the scores (on their logit, or on the scores themselves)."""
    x = P.logit("__raw") if on_logit else F.col("__raw")
    rows = _per_score(df, raw, target).withColumn("__x", x)
    vectors = VectorAssembler(inputCols=["__x"], outputCol="__features").transform(rows)
    curve = LogisticRegression(featuresCol="__features", labelCol="__label", weightCol="__weight", regParam=0.0,
                               maxIter=2000, tol=1e-10, standardization=False)
    return Calibrator("sigmoid", on_logit, curve.fit(vectors))


def fit_isotonic(df: DataFrame, raw: str, target: str) -> Calibrator:
    """Non-decreasing step curve through the scores; flat beyond the fitted range. The model is a table of blocks."""
    return Calibrator("isotonic", model=pooled_blocks(df, raw, target))


def fit_calibrator(method: str, df: DataFrame, raw: str, target: str) -> Calibrator:
    if method == "sigmoid":
        return fit_sigmoid(df, raw, target)
    return fit_isotonic(df, raw, target) if method == "isotonic" else Calibrator("raw")


def compare_calibrators(fit: DataFrame, held_out: DataFrame, raw: str, target: str) -> DataFrame:
    """Metrics of raw, sigmoid and isotonic on the held-out part, best (log-loss, Brier) first."""
    tables = []
    for method in ("raw", "sigmoid", "isotonic"):
        scored = fit_calibrator(method, fit, raw, target).apply(held_out, raw, "__p")
        tables.append(M.evaluate(scored, target, "__p").withColumn("method", F.lit(method)))
    both = tables[0].unionByName(tables[1]).unionByName(tables[2])
    return both.orderBy("logloss", "brier", "method")


def choose_calibrator(valid: DataFrame, raw: str, target: str, date: str) -> tuple[str, Calibrator, DataFrame]:
    """Pick the method on the later half of the validation days, then refit it on all of them."""
    from foretide.operators.splits import halves

    parts = halves(valid, date, 0.50)
    table = compare_calibrators(parts.filter("split = 'fit'"), parts.filter("split = 'eval'"), raw, target)
    best = table.select("method").first()[0]
    return best, fit_calibrator(best, valid, raw, target), table


def standard_predictions(df: DataFrame, targets, scores, dates) -> tuple[DataFrame, str, str, str]:
    """Find target, score and date columns by their known names; drop incomplete rows, clip the score."""
    target, score, date = (Q.first_existing(df, names) for names in (targets, scores, dates))
    out = df.withColumns({date: S.day(date), target: S.numeric(df, target), score: S.numeric(df, score)})
    out = Q.require_binary(out.dropna(subset=[date, target, score]), target)
    return out.withColumns({target: F.col(target).cast("int"), score: P.clip_probability(score)}), target, score, date


def ranked_predictions(scored: DataFrame, probability: str = "proba_point_1p_calibree") -> DataFrame:
    """Fair odds and the rank inside the day and inside the match, best first, ids breaking ties."""
    order = [F.col(probability).desc(), F.col("id_match"), F.col("id_joueur")]
    # A match lies on one day, so the days with too many rows for one task cover the matches as well.
    hot = find_hot(scored, ["date_match"])
    out = rank_rows(scored, ["date_match"], order, "rank_proba_sur_date", hot)
    out = rank_rows(out, ["date_match", "id_match"], order, "rank_proba_sur_match", hot)
    return out.withColumn("cote_juste", P.fair_odds(probability))


def model_universe(features: DataFrame) -> DataFrame:
    """Rows with enough history to be modelled."""
    return features.filter((F.col("hist_ok_5") == 1) & (F.col("toi_moy_5") >= 10.0))


def ablation_matrix(features: DataFrame, date: str, families=None, target: str = fixed.TARGET) -> tuple[DataFrame, dict[str, list[str]]]:
    """(split, label, every feature of any family) of the modelled rows, and each family's features that the table has.

    Missing values get their fill, or the training rows' median where there is none; a missing target counts as 0. The
    matrix is written once: all families read it.
    """
    from foretide.operators.splits import nested

    parts = nested(model_universe(features), date)
    usable = {n: Q.resolve_features(parts, c, [target])[0] for n, c in (families or fixed.FEATURE_FAMILIES).items()}
    if empty := [n for n, columns in usable.items() if not columns]:
        raise Q.DataProblem(f"families without a feature: {empty}")
    every = list(dict.fromkeys(c for columns in usable.values() for c in columns))
    label = F.coalesce(F.col(target).cast("double"), F.lit(0.0)).alias("__label")
    real = written(parts.where("split IS NOT NULL").select("split", label, *[S.real(F.col(c).cast("double")).alias(c) for c in every]))
    fills = {c: float(fixed.ABLATION_FILLS[c]) for c in every if c in fixed.ABLATION_FILLS}
    if open_ := [c for c in every if c not in fills]:
        medians = exact_medians(real.filter("split = 'train'"), open_)
        fills |= {c: medians.get(c, 0.0) for c in open_}
    return real.fillna(fills), usable


def _fit_family(matrix: DataFrame, name: str, inputs: list[str], rounds: int, depth: int, least_rows: int) -> list[dict]:
    """Metrics per split of one family's model."""
    train = matrix.filter("split = 'train'").select("__label", *inputs)
    Q.require_at_least(train, "__label", 2, f"{name}: training rows")
    train = train.coalesce(train.count() // PARTITION_ROWS + 1)
    trees = GBTClassifier(
        featuresCol="__features", labelCol="__label", maxIter=rounds, maxDepth=depth, stepSize=0.05, minInstancesPerNode=least_rows,
        seed=42, checkpointInterval=10,
    )
    model = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="__features"), trees]).fit(train)
    scored = model.transform(matrix.filter("split <> 'train'")).withColumn("__p", P.clip_probability(vector_to_array("probability")[1]))
    scored = stable(scored.select("split", F.col("__label").cast("int").alias("__y"), "__p"))
    found = M.evaluate(scored, "__y", "__p", ["split"]).collect()  # a row for each split
    return [{"family": name, "n_features": len(inputs), "features": " | ".join(inputs)} | r.asDict() for r in found]


def ablation(features: DataFrame, date: str, families=None, target: str = fixed.TARGET, rounds: int = 400,
             depth: int = 4, least_rows: int = 50) -> DataFrame:
    """Metrics of one unweighted model per feature family on validation and test, best first within a split.

    `best_on_validation` marks the family of least log-loss, then Brier score, there. All families read one matrix. Each
    boosting round is a few short jobs, so the families' models are fitted side by side and share the cluster.
    """
    matrix, usable = ablation_matrix(features, date, families, target)
    spark = matrix.sparkSession
    fit = inheritable_thread_target(spark)(lambda item: _fit_family(matrix, *item, rounds, depth, least_rows))
    with ThreadPool(len(usable)) as pool:
        rows = [r for found in pool.map(fit, usable.items()) for r in found]
    table = spark.createDataFrame(
        [tuple(r[c] for c in _ABLATION) for r in rows],
        "family string, split string, n_features int, features string, rows long, positive_rate double, mean_predicted_proba double, "
        "logloss double, brier double, auc double, avg_precision double",
    )
    best = table.where("split = 'validation'").orderBy("logloss", "brier", "family").select("family").first()
    marked = table.withColumn("best_on_validation", (F.col("family") == F.lit(best and best.family)).cast("int"))
    return marked.orderBy("split", "logloss", "brier")


_ABLATION = ("family", "split", "n_features", "features", "rows", "positive_rate", "mean_predicted_proba", "logloss", "brier", "auc", "avg_precision")


def train_variants(features: DataFrame, date: str, variants=None, target: str = fixed.TARGET, **params):
    """Baseline and enriched models on one three-way split: (metrics, scored validation and test rows per variant).

    The variants are fitted side by side, as the families of `ablation`.
    """
    from foretide.operators.splits import three_way

    parts = three_way(features, date)
    features_of, tables, scored = {}, [], {}
    for name, wanted in (variants or {"baseline": fixed.BASELINE_FEATURES, "enrichi": fixed.ENRICHED_FEATURES}).items():
        usable, _, _ = Q.resolve_features(parts, wanted, fixed.FORBIDDEN_FEATURES)
        Q.require_no_leak(usable, fixed.FORBIDDEN_FEATURES, target, date)
        if len(usable) < fixed.LEAST_FEATURES.get(name, 0):
            raise Q.DataProblem(f"{name}: {len(usable)} features, need {fixed.LEAST_FEATURES[name]}")
        features_of[name] = usable
    train = parts.filter("split = 'train'")
    fit = inheritable_thread_target(parts.sparkSession)(lambda usable: fit_trees(train, usable, target, True, **params))
    with ThreadPool(len(features_of)) as pool:
        models = pool.map(fit, features_of.values())
    for name, model in zip(features_of, models, strict=True):
        rows = model.score(parts.filter("split <> 'train'"))
        scored[name] = rows
        tables.append(M.evaluate(rows, target, "proba_point_1p_raw", ["split"], ["id_match", "id_joueur"]).withColumn("model_variant", F.lit(name)))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out, scored
