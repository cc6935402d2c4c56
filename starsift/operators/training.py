"""Sentiment and fraud classifiers with Spark ML.

The reference objective is summed loss with penalty C; Spark's is mean loss with
``regParam``. With balanced weights, which sum to n, regParam = 1 / (C * n).
Feature vectors are computed once and staged, because every solver iteration and
every further candidate would otherwise run the text stages again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.operators import metrics, naive_bayes, thresholds, trees
from starsift.operators.calibration import tag_and_union
from starsift.operators.preparation import majority_class, scale_by_deviation, with_class_weight
from starsift.operators.serving import prediction_columns, serving_features
from starsift.operators.text_features import WeightLists, gram_index, vocabulary
from starsift.operators.vectors import GramWeightsModel, PopulationScaler
from starsift.schemas import FRAUD_TARGET, MODEL_NUMERIC_FEATURES, NUMERIC_FEATURES, SENTIMENT_TARGET, TEXT_COLUMN
from starsift.staging import stage

SEED = 42
SETTING_FEATURES = {thresholds.FULL: NUMERIC_FEATURES, thresholds.REDUCED: MODEL_NUMERIC_FEATURES}


@dataclass(frozen=True)
class TextSettings:
    """Vocabulary limits of each model family are the class's instances below."""

    min_df: int
    max_df: float
    max_features: int | None
    sublinear: bool = True


SENTIMENT_TEXT = TextSettings(10, 0.9, 50_000)
FRAUD_TEXT = TextSettings(10, 0.95, 15_000)
ABLATION_TEXT = TextSettings(3, 0.95, 20_000)
# The baselines' vocabularies have no cap; they are tables throughout.
BASELINE_SENTIMENT_TEXT = TextSettings(3, 0.9, None, sublinear=False)
BASELINE_FRAUD_TEXT = TextSettings(3, 0.95, None, sublinear=False)


def text_stages(train: DataFrame, settings: TextSettings, out: str = "text_vector") -> list:
    """The fitted stage of a saved pipeline that makes TF-IDF vectors of texts.

    It rests on the table ``vocabulary`` gives. A saved pipeline carries its grams, so
    they reach the driver; only settings with a cap can be fitted this way.
    """
    if settings.max_features is None:
        raise ValueError("a saved pipeline needs a capped vocabulary")
    index = gram_index(vocabulary(train, settings.min_df, settings.max_df, settings.max_features, TEXT_COLUMN))
    grams = sorted((r["idx"], r["gram"], r["idf"]) for r in index.select("idx", "gram", "idf").collect())
    names, idf = [g for _, g, _ in grams] or [""], [float(w) for _, _, w in grams] or [1.0]
    return [GramWeightsModel(inputCol=TEXT_COLUMN, outputCol=out, sublinear=settings.sublinear, grams=names, idf=idf)]


def numeric_stages(columns: Sequence[str], out: str = "numeric_vector") -> list:
    return [
        VectorAssembler(inputCols=list(columns), outputCol="_numbers", handleInvalid="keep"),
        PopulationScaler(inputCol="_numbers", outputCol=out),
    ]


def hybrid_stages(train: DataFrame, settings: TextSettings, columns: Sequence[str]) -> list:
    join = VectorAssembler(inputCols=["text_vector", "numeric_vector"], outputCol="features")
    return [*text_stages(train, settings), *numeric_stages(columns), join]


@dataclass
class Prepared:
    """Fitted feature stages, where there are any, the rows of both parts and what makes vectors of them.

    ``train`` and ``test`` are the vectors, written when they are first asked for where ``written`` says so.
    """

    features: PipelineModel | None
    rows: tuple[DataFrame, DataFrame]
    vectors: Callable[[DataFrame], DataFrame]
    written: bool = True

    def __post_init__(self):
        self.n_train, self.n_test = (part.count() for part in self.rows)

    @cached_property
    def train(self) -> DataFrame:
        return self._part(with_class_weight(self.rows[0], "label"), "train-vectors")

    @cached_property
    def test(self) -> DataFrame:
        return self._part(self.rows[1], "test-vectors")

    def _part(self, rows: DataFrame, name: str) -> DataFrame:
        vectors = self.vectors(rows)
        return stage(vectors, name) if self.written else vectors


def prepare(stages: list, train: DataFrame, test: DataFrame, target: str) -> Prepared:
    fitted = Pipeline(stages=stages).fit(train)
    rows = tuple(part.withColumn("label", F.col(target).cast("double")) for part in (train, test))

    def vectors(part: DataFrame) -> DataFrame:
        weight = [c for c in ("class_weight",) if c in part.columns]
        return fitted.transform(part).select("review_id", "label", "features", *weight)

    return Prepared(fitted, rows, vectors)


@dataclass
class TextTables:
    """The numbered vocabulary of the training part, and both parts with their texts, which are weighed where they are read."""

    grams: WeightLists
    train: DataFrame
    test: DataFrame

    @property
    def n_grams(self) -> int:
        return self.grams.n_grams

    def lists(self, part: DataFrame, *columns, once: bool = False) -> DataFrame:
        """(review_id, columns, idx, weight) of a part's rows, or once for each key of them."""
        return self.grams.of_rows(part.select("review_id", *columns, TEXT_COLUMN), text=TEXT_COLUMN, once=once)


def text_tables(train: DataFrame, test: DataFrame, settings: TextSettings) -> TextTables:
    index = gram_index(vocabulary(train, settings.min_df, settings.max_df, settings.max_features, TEXT_COLUMN))
    return TextTables(WeightLists.of(index, settings.sublinear), train, test)


def prepare_tables(text: TextTables, target: str, numbers: Sequence[str] = ()) -> Prepared:
    """Vectors from texts, whatever the size of the vocabulary; numbers are scaled by their deviation in the training part.

    They are made where they are read and not written: a solver holds them itself.
    """
    scaled = [scale_by_deviation(part, numbers, text.train) if numbers else part for part in (text.train, text.test)]
    rows = tuple(part.select("review_id", F.col(target).cast("double").alias("label"), *numbers, TEXT_COLUMN) for part in scaled)
    return Prepared(None, rows, lambda part: text.grams.vectors_of(part, numbers, text=TEXT_COLUMN), written=False)


def entries_of(rows: DataFrame, text: TextTables, numbers: Sequence[str]) -> DataFrame:
    """(review_id, idx, value): the weights, and the numbers that are not 0 after them."""
    pairs = F.array(*[F.struct(F.lit(text.n_grams + i).alias("idx"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("value")) for i, c in enumerate(numbers)])
    own = rows.select("review_id", F.inline(pairs)).where("value <> 0")
    weights = naive_bayes.pairs_of(text.lists(rows, once=True), "review_id")
    return weights.select("review_id", "idx", F.col("weight").alias("value")).unionByName(own)


def logistic(n: int, c: float, max_iter: int, balanced: bool = True) -> LogisticRegression:
    """Logistic regression with penalty C on n rows."""
    clf = LogisticRegression(maxIter=max_iter, regParam=1.0 / (c * max(n, 1)), standardization=False)
    return clf.setWeightCol("class_weight") if balanced else clf


def log_loss_descent(alpha: float = 1e-5, max_iter: int = 20) -> LogisticRegression:
    """The stochastic-descent candidate: same loss and penalty, Spark's solver."""
    clf = LogisticRegression(maxIter=max_iter, regParam=alpha, standardization=False)
    return clf.setWeightCol("class_weight")


def predictions(model: Transformer, vectors: DataFrame) -> DataFrame:
    """(review_id, label, pred, score); the score is the probability of class 1, null without one."""
    out = model.transform(vectors)
    score = F.get(vector_to_array("probability"), 1) if "probability" in out.columns else F.lit(None).cast("double")
    return out.select(
        "review_id",
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("pred"),
        score.alias("score"),
    )


@dataclass
class Regression:
    """A fitted regression, the feature stages before it, and the vectors it was fitted to and is tested on."""

    model: Transformer
    features: PipelineModel
    rows: DataFrame
    test: DataFrame
    n_test: int


def sentiment_regression(train: DataFrame, test: DataFrame, settings: TextSettings = SENTIMENT_TEXT, max_iter: int = 100) -> tuple[Regression, int]:
    """(multinomial regression on the text, training rows)."""
    ready = prepare(text_stages(train, settings, out="features"), train, test, SENTIMENT_TARGET)
    model = logistic(ready.n_train, 2.0, max_iter).setFamily("multinomial").fit(ready.train)
    return Regression(model, ready.features, ready.train, ready.test, ready.n_test), ready.n_train


def train_sentiment(
    train: DataFrame, test: DataFrame, settings: TextSettings = SENTIMENT_TEXT, max_iter: int = 100
) -> tuple[PipelineModel, DataFrame]:
    """(pipeline, one-row summary with macro and weighted F1)."""
    found, n = sentiment_regression(train, test, settings, max_iter)
    summary = metrics.multiclass_summary(predictions(found.model, found.test)).withColumns(
        {"model_name": F.lit("logreg+tfidf"), "n_train": F.lit(n), "n_test": F.lit(found.n_test)}
    )
    return PipelineModel([*found.features.stages, found.model]), summary


def fraud_regression(train: DataFrame, test: DataFrame, settings: TextSettings = FRAUD_TEXT, max_iter: int = 80) -> tuple[Regression, int]:
    """(binary regression on text and behaviour, training rows)."""
    ready = prepare(hybrid_stages(train, settings, MODEL_NUMERIC_FEATURES), train, test, FRAUD_TARGET)
    model = logistic(ready.n_train, 1.0, max_iter).fit(ready.train)
    return Regression(model, ready.features, ready.train, ready.test, ready.n_test), ready.n_train


def train_fraud(
    train: DataFrame,
    test: DataFrame,
    settings: TextSettings = FRAUD_TEXT,
    max_iter: int = 80,
    descent_iter: int = 20,
) -> tuple[PipelineModel, DataFrame]:
    """(chosen pipeline, summary with one row per candidate).

    The descent candidate is chosen only with a strictly higher F1.
    """
    found, n = fraud_regression(train, test, settings, max_iter)
    fitted = {
        "logreg+tfidf+behavior": found.model,
        "sgd+tfidf+behavior": log_loss_descent(max_iter=descent_iter).fit(found.rows),
    }
    scored = tag_and_union({n: predictions(m, found.test) for n, m in fitted.items()}, "model_name")
    report = stage(metrics.fraud_evaluation(scored, ["model_name"]), "fraud-candidates")
    f1 = {row["model_name"]: row["f1"] for row in report.select("model_name", "f1").collect()}
    first, second = fitted
    chosen = second if f1[second] > f1[first] else first
    share = found.rows.agg(F.avg("label")).first()[0]
    summary = report.withColumns(
        {
            "selected": F.col("model_name") == chosen,
            "fraud_share_train": F.lit(share),
            "n_train": F.lit(n),
            "n_test": F.lit(found.n_test),
        }
    )
    return PipelineModel([*found.features.stages, fitted[chosen]]), summary


def constant_predictions(majority: DataFrame, vectors: DataFrame) -> DataFrame:
    """Every row predicted as the majority class."""
    label = majority.first()["label"]
    return vectors.select(
        "review_id",
        F.col("label").cast("int").alias("label"),
        F.lit(int(label)).alias("pred"),
        F.lit(float(label)).alias("score"),
    )


class SentimentBaselines:
    """The sentiment baselines; vectors and weights are made once, each model is a method that returns its predictions."""

    def __init__(self, train: DataFrame, test: DataFrame, settings: TextSettings = BASELINE_SENTIMENT_TEXT, max_iter: int = 400):
        self.text, self.max_iter = text_tables(train, test, settings), max_iter
        self.rows = [part.select("review_id", F.col(SENTIMENT_TARGET).cast("int").alias("label")) for part in (train, test)]
        self.ready = prepare_tables(self.text, SENTIMENT_TARGET)

    def majority_baseline(self) -> DataFrame:
        return constant_predictions(majority_class(self.rows[0], "label"), self.rows[1])

    def tfidf_naive_bayes(self) -> DataFrame:
        train, test = self.text.train, self.text.test
        model = naive_bayes.fit(self.text.lists(train, F.col(SENTIMENT_TARGET).cast("int").alias("label")), self.rows[0], self.text.grams.index)
        rows = naive_bayes.predict(model, self.text.lists(test, once=True), self.rows[1])
        return rows.select("review_id", "label", "pred", F.lit(None).cast("double").alias("score"))

    def tfidf_logistic_regression(self) -> DataFrame:
        clf = logistic(self.ready.n_train, 1.0, self.max_iter).setFamily("multinomial")
        return predictions(clf.fit(self.ready.train), self.ready.test)

    def tfidf_linear_svm(self) -> DataFrame:
        # The tolerance is that of the surveyed solver; the classes are fitted side by side.
        svm = LinearSVC(maxIter=self.max_iter, tol=1e-4, regParam=1.0 / max(self.ready.n_train, 1), standardization=False)
        return predictions(OneVsRest(classifier=svm, parallelism=3).fit(self.ready.train), self.ready.test)


class FraudBaselines:
    """The fraud baselines, likewise."""

    def __init__(self, train: DataFrame, test: DataFrame, settings: TextSettings = BASELINE_FRAUD_TEXT, max_iter: int = 400, n_trees: int = 120):
        self.rows, self.max_iter, self.n_trees = (train, test), max_iter, n_trees
        self.text = text_tables(train, test, settings)
        self.ready = prepare_tables(self.text, FRAUD_TARGET, MODEL_NUMERIC_FEATURES)

    def majority_baseline(self) -> DataFrame:
        train, test = (part.select("review_id", F.col(FRAUD_TARGET).cast("int").alias("label")) for part in self.rows)
        return constant_predictions(majority_class(train, "label"), test)

    def numeric_logistic_regression(self) -> DataFrame:
        numbers = prepare([*numeric_stages(MODEL_NUMERIC_FEATURES, out="features")], *self.rows, FRAUD_TARGET)
        return predictions(logistic(numbers.n_train, 1.0, self.max_iter).fit(numbers.train), numbers.test)

    def hybrid_logistic_regression(self) -> DataFrame:
        return predictions(logistic(self.ready.n_train, 1.0, self.max_iter).fit(self.ready.train), self.ready.test)

    def hybrid_random_forest(self) -> DataFrame:
        coded = coded_parts(*self.rows, self.text, MODEL_NUMERIC_FEATURES)
        forest = trees.fit_forest(coded.blocks, self.text.n_grams + len(MODEL_NUMERIC_FEATURES), coded.zero_bins, self.n_trees, seed=SEED)
        shared = trees.forest_scores(forest, coded.zero_bins)
        scored = trees.scored_rows(coded.test, coded.test_codes, shared, ["score"])
        return scored.select("review_id", "label", (F.col("score") >= 0.5).cast("int").alias("pred"), "score")


SENTIMENT_BASELINES = ("majority_baseline", "tfidf_naive_bayes", "tfidf_logistic_regression", "tfidf_linear_svm")
FRAUD_BASELINES = ("majority_baseline", "numeric_logistic_regression", "hybrid_logistic_regression", "hybrid_random_forest")


def sentiment_baselines(models: SentimentBaselines, names: Sequence[str] = SENTIMENT_BASELINES) -> DataFrame:
    """(task, model_name, f1_macro, f1_weighted) of the named models."""
    outcomes = {name: getattr(models, name)() for name in names}
    report = metrics.multiclass_summary(tag_and_union(outcomes, "model_name"), ["model_name"])
    return report.select(F.lit("sentiment").alias("task"), "model_name", "f1_macro", "f1_weighted")


def fraud_baselines(models: FraudBaselines, names: Sequence[str] = FRAUD_BASELINES) -> DataFrame:
    """(task, model_name, precision, recall, f1, roc_auc) of the named models."""
    outcomes = {name: stage(getattr(models, name)(), "baseline") for name in names}
    report = metrics.fraud_evaluation(tag_and_union(outcomes, "model_name"), ["model_name"])
    return report.select(F.lit("fraud").alias("task"), "model_name", "precision", "recall", "f1", "roc_auc")


def baseline_report(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both tasks' baselines in one table."""
    first, second = sentiment_baselines(SentimentBaselines(train, test)), fraud_baselines(FraudBaselines(train, test))
    return first.unionByName(second, allowMissingColumns=True)


@dataclass
class Coded:
    """Binned training rows as blocks, and the test rows with their codes."""

    blocks: DataFrame
    test: DataFrame
    test_codes: DataFrame
    zero_bins: dict[int, int]


def coded_parts(train: DataFrame, test: DataFrame, text: TextTables, numbers: Sequence[str]) -> Coded:
    """Both parts as trees read them; numbers need no scaling, as their order is all that counts."""
    own, held = (entries_of(part, text, numbers) for part in (train, test))
    edges = stage(trees.bin_edges(own), "bin-edges")
    label = F.col(FRAUD_TARGET).cast("int").alias("label")
    blocks = trees.blocks_of(train.select("review_id", label), trees.coded(own, edges))
    return Coded(blocks, test.select("review_id", label), trees.coded(held, edges), trees.zero_bins_of(edges))


def ablation_scores(train: DataFrame, test: DataFrame, settings: TextSettings = ABLATION_TEXT, rounds: int = 120, depth: int = 3) -> DataFrame:
    """(setting, review_id, label, pred, score) of boosted trees with all numeric features and with the reduced set.

    One text table, one set of bins and one set of blocks serve both; a setting is a
    list of features its trees leave out, and both grow in the same jobs.
    """
    text = text_tables(train, test, settings)
    coded = coded_parts(train, test, text, NUMERIC_FEATURES)
    left_out = [[text.n_grams + i for i, c in enumerate(NUMERIC_FEATURES) if c not in columns] for columns in SETTING_FEATURES.values()]
    models = trees.fit_boosted(coded.blocks, text.n_grams + len(NUMERIC_FEATURES), left_out, coded.zero_bins, rounds, depth)
    names = list(SETTING_FEATURES)
    scored = trees.scored_rows(coded.test, coded.test_codes, trees.boosted_scores(models, coded.zero_bins), names)
    each = F.array(*[F.struct(F.lit(n).alias("setting"), F.col(n).alias("score")) for n in names])
    flat = scored.select("review_id", "label", F.inline(each))
    return flat.select("setting", "review_id", "label", (F.col("score") >= 0.5).cast("int").alias("pred"), "score")


def ablation(scores: DataFrame, grid: Sequence[float] = tuple(thresholds.ABLATION_GRID)) -> tuple[DataFrame, DataFrame]:
    """(row per setting, sweep per setting) of the scores of all numeric features and of the reduced set."""
    by = ["setting"]
    sweep = stage(thresholds.threshold_sweep(scores, grid, by), "ablation-sweep")
    # The earliest grid row wins ties: smaller positions compare larger when negated.
    best = sweep.groupBy(*by).agg(
        F.max_by(F.struct("threshold", "precision", "recall", "f1", "errors", "n"), F.struct("f1", -F.col("grid_pos"))).alias("b")
    )
    sizes = reduce(lambda other, s: F.when(F.col("setting") == s, len(SETTING_FEATURES[s])).otherwise(other), SETTING_FEATURES, F.lit(None).cast("int"))
    rows = metrics.fraud_evaluation(scores, by).join(best, by).select(
        "setting",
        sizes.alias("n_numeric_features"),
        F.col("precision").alias("precision_at_half"),
        F.col("recall").alias("recall_at_half"),
        F.col("f1").alias("f1_at_half"),
        "roc_auc",
        F.col("b.threshold").alias("best_f1_threshold"),
        F.col("b.f1").alias("best_f1"),
        F.col("b.precision").alias("precision_at_best_f1"),
        F.col("b.recall").alias("recall_at_best_f1"),
        F.col("b.errors").alias("errors"),
        F.col("b.n").alias("n_test"),
    )
    return rows, sweep


def model_scorer(sentiment: Transformer, fraud: Transformer) -> Callable[[DataFrame], DataFrame]:
    """Function that adds ``sentiment_label`` and ``fraud_proba`` to a frame with the serving features."""

    def score(featured: DataFrame) -> DataFrame:
        columns = featured.columns
        felt = sentiment.transform(featured).select(*columns, F.col("prediction").cast("int").alias("sentiment_label"))
        judged = fraud.transform(felt)
        proba = F.get(vector_to_array("probability"), 1).alias("fraud_proba")
        return judged.select(*columns, "sentiment_label", proba)

    return score


def score_reviews(reviews: DataFrame, scorer: Callable[[DataFrame], DataFrame], threshold: float = 0.5) -> DataFrame:
    """Raw reviews -> serving features, sentiment, fraud probability and flag."""
    features = serving_features(reviews)
    if SENTIMENT_TARGET in features.columns:
        features = features.drop(SENTIMENT_TARGET)
    return prediction_columns(scorer(features), threshold)


def model_metadata(
    spark: SparkSession, sentiment: DataFrame, fraud: DataFrame, choice: DataFrame | None = None
) -> DataFrame:
    """One row that describes a training run, for a JSON file next to the models."""
    chosen = fraud.where("selected")
    one = spark.range(1).select(
        F.array(*map(F.lit, MODEL_NUMERIC_FEATURES)).alias("numeric_fraud_features"),
        F.array(*map(F.lit, sorted(set(NUMERIC_FEATURES) - set(MODEL_NUMERIC_FEATURES)))).alias(
            "numeric_fraud_features_excluded_from_model"
        ),
    )
    parts = {"sentiment": sentiment, "fraud": chosen, "thresholds": choice}
    for name, part in parts.items():
        if part is not None:
            one = one.withColumn(name, part.select(F.struct(*part.columns).alias("s")).scalar())
    return one
