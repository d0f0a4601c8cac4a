"""Model jobs on Spark ML: selection, comparison, search, scoring, reports."""

from __future__ import annotations

import math
import random
from heapq import heappop, heappush
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GeneralizedLinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.scalars import score_points, tie_jitter
from scoreloom.operators import levelwise, metrics
from scoreloom.operators.banding import quantile_bands
from scoreloom.operators.boosting import ForestModel, Leafwise, LeafwiseModel, bin_edges, counted_bins, fit_binned, fit_leafwise
from scoreloom.operators.ordered import running_totals, shuffled_rank
from scoreloom.operators.prep import Prep
from scoreloom.operators.profile import target_distribution
from scoreloom.operators.sampling import stratified_folds
from scoreloom.session import written

FEATURES, PROBABILITY = "features", "p"
# Settings of the selection forest and the compared algorithms, F-beta, folds, trials.
SELECTION_DEPTH, SELECTION_LEAF = 5, 2
BAKEOFF_DEPTH, BAKEOFF_LEAF = 7, 3
BETA, FOLDS, TRIALS, SEED = 1.3, 5, 100, 42
# Training partitions at least, their rows at most, and the copies of a row that travel together.
PARTITIONS, ROWS_PER_PARTITION, BLOCK = 16, 250_000, 4_096
CELLS_PER_PARTITION = 50_000
COPIES = "_copies"


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep")


def cells(df: DataFrame) -> DataFrame:
    """The distinct rows and how often each occurs, written once. Rows of equal content combine before any shuffle."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return written(df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias(COPIES)), "cells")


def partitions_of(rows: int) -> int:
    """Partitions for a training table: as many for the same number of rows, and of bounded size."""
    return max(PARTITIONS, math.ceil(rows / ROWS_PER_PARTITION))


def laid_out(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Training rows dealt to partitions by their content, sorted within each.

    The learners draw their samples partition by partition, so a fit depends on the rows alone and not on the
    cluster or on how the table was read. Rows of equal content are shuffled as blocks of up to ``BLOCK`` copies and
    become rows again where they arrive, so neither a frequent row nor a large table makes a large task.
    """
    return _dealt(cells(df), partitions)


def _dealt(counted: DataFrame, partitions: int | None = None) -> DataFrame:
    """The rows of a table of ``cells``, laid out."""
    columns = [F.col(f"`{c}`") for c in counted.columns if c != COPIES]
    copies, block = F.col(COPIES).cast("long"), F.col("_block")
    if partitions is None:
        partitions = partitions_of(counted.agg(F.sum(copies)).first()[0] or 0)
    blocks = counted.select(
        *columns, copies.alias(COPIES), F.explode(F.sequence(F.lit(0), F.floor((copies - 1) / BLOCK))).alias("_block")
    )
    placed = blocks.repartition(partitions, F.xxhash64(*columns, block)).sortWithinPartitions(*columns, block)
    own = F.least(F.lit(BLOCK), copies - block * BLOCK).cast("int")
    return placed.select(*columns, F.explode(F.array_repeat(F.lit(0), own)).alias("_copy")).drop("_copy")


def takes_weights(classifier: Estimator) -> bool:
    """Whether a row of weight n does to the learner what n equal rows do: it draws no rows. Trees that count the rows
    of a leaf are asked for their weight instead (``fit_cells``)."""
    if classifier.hasParam("weightCol") and classifier.isSet("weightCol"):
        return False
    if isinstance(classifier, LogisticRegression):
        return True
    return isinstance(classifier, DecisionTreeClassifier) or (
        isinstance(classifier, GBTClassifier) and classifier.getSubsamplingRate() == 1.0
    )


def by_rates(classifier: Estimator) -> tuple[Estimator, list[Transformer]]:
    """A learner whose leaves keep their event rates, and the stages that make class and probability of them.

    Spark's single tree and forest for classes merge neighbouring leaves that say the same class, so rows of rate 0.1
    and 0.4 get one probability. The regression tree over the 0/1 target makes the same splits, its variance being
    half the Gini impurity, and merges leaves of equal rates only.
    """
    same = ("maxDepth", "maxBins", "minInstancesPerNode", "minWeightFractionPerNode", "minInfoGain", "maxMemoryInMB", "cacheNodeIds",
            "checkpointInterval", "labelCol", "seed")
    if not isinstance(classifier, (DecisionTreeClassifier, RandomForestClassifier)) or classifier.getImpurity() != "gini":
        return classifier, []
    if isinstance(classifier, RandomForestClassifier):
        same += ("numTrees", "subsamplingRate", "bootstrap", "featureSubsetStrategy")
    learner = RandomForestRegressor() if isinstance(classifier, RandomForestClassifier) else DecisionTreeRegressor()
    known = {p: classifier.getOrDefault(p) for p in same}
    if known.get("featureSubsetStrategy") == "auto":
        known["featureSubsetStrategy"] = "sqrt" if known["numTrees"] > 1 else "all"  # as for classes
    known["minInfoGain"] /= 2
    learner = learner._set(**known, predictionCol="_rate")
    if classifier.isSet("weightCol"):
        learner = learner.setWeightCol(classifier.getWeightCol())
    classes = SQLTransformer(
        statement="SELECT *, 1 - _rate AS _other, CASE WHEN _rate > 0.5 THEN 1.0D ELSE 0.0D END AS prediction FROM __THIS__"
    )
    return learner, [classes, VectorAssembler(inputCols=["_other", "_rate"], outputCol="probability")]


def cut_up(df: DataFrame, features: Sequence[str], most_bins: int) -> tuple[list[Transformer], list[str], DataFrame]:
    """Features as numbers of bins, at most ``most_bins`` and one for missing values: the stages that cut any table
    by the edges found in ``df``, the names of the bins, and the cut table. The cuts are those a tree learner chooses
    among, from all rows instead of its sample."""
    stage = bucketizer(bin_edges(df, features, most_bins), features)
    return [stage], list(stage.getOutputCols()), stage.transform(df)


def bucketizer(edges: Sequence[Sequence[float]], features: Sequence[str]) -> Bucketizer:
    """The stage that cuts features by upper edges."""
    return Bucketizer(
        # a bin holds its upper edge; the last split keeps two bins where a column has a single value
        splitsArray=[[-math.inf, *(math.nextafter(x, math.inf) for x in e), math.inf] if e else [-math.inf, 0.0, math.inf] for e in edges],
        inputCols=list(features), outputCols=[f"_bin_{f}" for f in features], handleInvalid="keep",
    )


def fit_cells(
    counted: DataFrame, stages: Sequence[Transformer], names: Sequence[str], classifier: Estimator, target: str
) -> PipelineModel:
    """Fit on a table of ``cells``, weighted by their copies; ``stages`` make the columns ``names`` of raw rows.

    Bins lose the attributes that the bucketizer gave them: with these, Spark's trees would take them for names without
    an order. The least number of rows in a leaf becomes their least weight, half a row less against rounding.
    """
    columns = [*names, target]
    keys = [F.col(f"`{c}`") for c in columns]
    plain = [F.col(f"`{c}`").alias(c, metadata={}) for c in columns]
    once = written(counted.select(*plain, COPIES).groupBy(*keys).agg(F.sum(COPIES).alias(COPIES)), "weighted")
    partitions = max(1, math.ceil(once.count() / CELLS_PER_PARTITION))  # few cells make few tasks a step
    rows = once.repartition(partitions, F.xxhash64(*keys)).sortWithinPartitions(*keys)
    classifier = classifier.copy().setLabelCol(target)
    if not isinstance(classifier, LogisticRegression) and classifier.getMinInstancesPerNode() > 1:
        least, all_rows = classifier.getMinInstancesPerNode(), once.agg(F.sum(COPIES)).first()[0] or 0.0
        classifier = classifier.setMinInstancesPerNode(1)
        if all_rows < 2 * least:
            classifier = classifier.setMaxDepth(0)
        else:
            share = min((least - 0.5) / all_rows, 0.499999)
            classifier = classifier.setMinWeightFractionPerNode(max(share, classifier.getMinWeightFractionPerNode()))
    learner, after = by_rates(classifier)
    learner = learner.setFeaturesCol(FEATURES).setWeightCol(COPIES)
    if not isinstance(learner, LogisticRegression):
        learner = learner.setMaxBins(learner.getMaxBins() + 1)  # one more for missing values
    fitted = Pipeline(stages=[assembler(names), learner, *after]).fit(rows)
    return PipelineModel([*stages, *fitted.stages])


def fit_classifier(
    df: DataFrame, features: Sequence[str], classifier: Estimator, target: str, partitions: int | None = None
) -> PipelineModel:
    """Fit on the features and target only.

    A learner that draws no rows of its own gets each distinct row once, with its number of copies as weight; for
    trees the rows are those of the binned features, so their number is bounded whatever the table's.
    """
    rows = df.select(*[F.col(f"`{c}`") for c in (*features, target)])
    if partitions is None and takes_weights(classifier):
        stages, names = [], list(features)
        if not isinstance(classifier, LogisticRegression):
            stages, names, rows = cut_up(rows, features, classifier.getMaxBins())
        counted = cells(rows.select(*[F.col(f"`{c}`") for c in (*names, target)]))
        return fit_cells(counted, stages, names, classifier, target)
    learner, after = by_rates(classifier.setLabelCol(target))
    return Pipeline(stages=[assembler(features), learner.setFeaturesCol(FEATURES), *after]).fit(laid_out(rows, partitions))


def scored(model: Transformer, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Kept columns, probability of class 1 as ``p``, predicted class."""
    out = model.transform(df)
    return out.select(
        *keep, vector_to_array("probability")[1].alias(PROBABILITY), F.col("prediction").cast("int").alias("prediction")
    )


# --- supervised bins and scorecard ------------------------------------------------------------------

def tree_bins(df: DataFrame, column: str, target: str, most: int = 5) -> DataFrame:
    """Bins of one numeric column by a decision tree: event rate, volume, bounds from -inf to inf.

    The tree grows best split first until it has ``most`` leaves, or no split lowers the Gini impurity. Every cut
    between two values is tried: running sums over the distinct values give the gain of each, and an aggregate over
    them the best one of a leaf. Bounds lie half-way between neighbouring values.
    """
    rows = df.select(F.col(column).cast("double").alias("x"), F.col(target).cast("double").alias("y")).dropna()
    totals = written(running_totals(rows, "x", {"n": F.lit(1), "pos": F.col("y")}), "running")
    schema = "bin int, event_rate double, volume bigint, lower_bound double, upper_bound double"
    whole = totals.select("all_n", "all_pos").first()
    if whole is None:
        return df.sparkSession.createDataFrame([], schema)

    def impurity(n: Column, pos: Column) -> Column:
        return F.coalesce(F.try_divide(2 * pos * (n - pos), n.cast("double")), F.lit(0.0))

    def looked_at(*spans: tuple) -> list[tuple]:
        """For each span of values (above, up to, rows and events before and with it): the largest gain, negated,
        the first cut that has it, the sums up to the cut, the span, its least and largest value."""
        picks, x = [], F.col("x")
        for k, (above, up_to, n0, pos0, n1, pos1) in enumerate(spans):
            inside = (F.lit(True) if above is None else x > above) & (F.lit(True) if up_to is None else x <= up_to)
            gain = (
                impurity(F.col("cum_n") - n0, F.col("cum_pos") - pos0) + impurity(n1 - F.col("cum_n"), pos1 - F.col("cum_pos"))
                - impurity(F.lit(n1 - n0), F.lit(pos1 - pos0))
            )
            cut = F.struct(gain.alias("gain"), "x", "cum_n", "cum_pos")
            picks += [F.min(F.when(inside, cut)).alias(f"cut{k}"), F.min(F.when(inside, x)).alias(f"low{k}"),
                      F.max(F.when(inside, x)).alias(f"high{k}")]
        row = totals.agg(*picks).first()
        return [(*row[f"cut{k}"], span, row[f"low{k}"], row[f"high{k}"]) for k, span in enumerate(spans)]

    leaves, done = looked_at((None, None, 0, 0.0, whole["all_n"], whole["all_pos"])), []
    while leaves and len(leaves) + len(done) < most:
        leaf = heappop(leaves)
        gain, x, n, pos, (above, up_to, n0, pos0, n1, pos1), _, _ = leaf
        if gain < -1e-9:
            for part in looked_at((above, x, n0, pos0, n, pos), (x, up_to, n, pos, n1, pos1)):
                heappush(leaves, part)
        else:
            done.append(leaf)
    bins = sorted([*leaves, *done], key=lambda leaf: leaf[4][2])
    cut = [float("-inf"), *((a[6] + b[5]) / 2 for a, b in zip(bins, bins[1:])), float("inf")]
    table = [
        (b, (pos1 - pos0) / (n1 - n0), n1 - n0, cut[b], cut[b + 1])
        for b, (*_, (_, _, n0, pos0, n1, pos1), _, _) in enumerate(bins)
    ]
    return df.sparkSession.createDataFrame(table, schema)


def logistic_scorecard(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Beta, p-value and Wald statistic of intercept and features, strongest first."""
    features = [f for f in features if f != target]
    # Every iteration reads the rows again, so they are written: distinct ones, with their number as weight and their
    # event rate as target. That is the likelihood of the rows; weights on 0 and 1 apart would start far from it.
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in (*features, target)]).dropna()
    shares = rows.groupBy(*features).agg(F.avg(target).alias(target), F.count(F.lit(1)).cast("double").alias(COPIES))
    fit = GeneralizedLinearRegression(
        family="binomial", link="logit", featuresCol=FEATURES, labelCol=target, weightCol=COPIES
    ).fit(assembler(features).transform(written(shares, "shares")))
    summary = fit.summary
    # The summary lists the features and then the intercept; one row per feature.
    table = [
        (name, float(beta), float(p), float(z) ** 2)
        for name, beta, p, z in zip(
            [*features, "const"], [*fit.coefficients, fit.intercept], summary.pValues, summary.tValues
        )
    ]
    out = df.sparkSession.createDataFrame(table, "variable string, beta double, p_value double, wald double")
    return out.orderBy(F.desc("wald"))


# --- selection and comparison -----------------------------------------------------------------------

def learned(model: PipelineModel) -> list[float]:
    """The importances that the pipeline's trees give to their features, by place."""
    return [float(x) for x in next(s for s in model.stages if hasattr(s, "featureImportances")).featureImportances.toArray()]


def importances(model: PipelineModel | LeafwiseModel, features: Sequence[str], df: DataFrame) -> DataFrame:
    if isinstance(model, LeafwiseModel):
        values = model.importances()
    else:
        values = learned(model)
    return df.sparkSession.createDataFrame(list(zip(features, values)), "feature string, importance double")


def importance_selection(
    df: DataFrame, features: Sequence[str], target: str, cutoff: float = 0.1
) -> tuple[list[str], DataFrame]:
    """Features whose forest importance exceeds ``cutoff`` times the largest, and all importances."""
    forest = RandomForestClassifier(maxDepth=SELECTION_DEPTH, minInstancesPerNode=SELECTION_LEAF, numTrees=100, seed=0)
    model = fit_classifier(df, features, forest, target)
    values = learned(model)
    limit = cutoff * max(values)
    chosen = [f for f, v in zip(features, values) if v > limit]
    table = importances(model, features, df).withColumn("selected", F.when(F.col("importance") > limit, 1).otherwise(0))
    return chosen, table.orderBy(F.desc("importance"))


def bakeoff_algorithms(leafwise: bool = False) -> dict[str, Estimator | Leafwise]:
    shared = {"maxDepth": BAKEOFF_DEPTH, "minInstancesPerNode": BAKEOFF_LEAF, "seed": SEED}
    found: dict[str, Estimator | Leafwise] = {
        "decision_tree": DecisionTreeClassifier(**shared),
        "random_forest": RandomForestClassifier(**shared),
        "boosted_trees": GBTClassifier(**shared),
    }
    if leafwise:
        found["leaf_wise_trees"] = Leafwise(n_estimators=20, max_depth=BAKEOFF_DEPTH, min_child_samples=BAKEOFF_LEAF, seed=SEED)
    return found


def set_metrics(predictions: DataFrame, target: str, copies: str | None = None) -> DataFrame:
    """Accuracy, precision, recall, F1, F-beta, AUC, Gini and KS per set."""
    return metrics.classification_metrics(predictions, target, F.col("prediction"), PROBABILITY, ["set"], BETA, copies)


def both_sets(model: Transformer, train: DataFrame, test: DataFrame, target: str) -> DataFrame:
    """Predictions of both sets in one written table."""
    parts = [scored(model, d, [target]).withColumn("set", F.lit(s)) for s, d in (("Treino", train), ("Teste", test))]
    return written(parts[0].unionByName(parts[1]), "predictions")


def fit_forest(counted: DataFrame, names: Sequence[str], sizes: Sequence[int], forest: RandomForestClassifier, target: str) -> ForestModel:
    """A forest over a table of ``cells``: its trees side by side, each on as many copies as chance draws of every row."""
    share = {"auto": "sqrt" if forest.getNumTrees() > 1 else "all"}.get(forest.getFeatureSubsetStrategy(), forest.getFeatureSubsetStrategy())
    count = len(names)
    tried = {"all": count, "sqrt": math.ceil(math.sqrt(count)), "onethird": math.ceil(count / 3), "log2": max(1, math.ceil(math.log2(count)))}
    number = tried.get(share) or (min(int(share), count) if share.isdigit() else math.ceil(float(share) * count))
    points = [
        levelwise.Settings(
            1, 1.0, forest.getMaxDepth(), forest.getSubsamplingRate(), number / count, 1.0, forest.getSeed() + i,
            forest.getMinInstancesPerNode(), forest.getBootstrap(),
        )
        for i in range(forest.getNumTrees())
    ]
    blocks = levelwise.packed(counted.withColumn("_fold", F.lit(0)), names, sizes, target, COPIES, "_fold", 1)
    cuts = [[float(b) for b in range(s)] for s in sizes]
    trees = [levelwise.node_of(t, cuts, 0.5 / len(points)) for (t,) in levelwise.fitted(blocks, sizes, [(p, None) for p in points], trees=True)]
    return ForestModel(list(names), 0.5, trees)  # labels of -1 and 1: half the mean and a half is the rate


def plain_forest(classifier: Estimator) -> bool:
    """Whether ``fit_forest`` does all that the classifier is set to."""
    return (
        isinstance(classifier, RandomForestClassifier) and classifier.getImpurity() == "gini" and not classifier.isSet("weightCol")
        and classifier.getMinInfoGain() == classifier.getMinWeightFractionPerNode() == 0.0 and not classifier.isSet("thresholds")
    )


def algorithm_bakeoff(
    train: DataFrame, test: DataFrame, features: Sequence[str], target: str,
    algorithms: Mapping[str, Estimator | Leafwise] | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    """Metrics of every algorithm on both sets. One model is fitted after the other; ``keys`` identify a row for
    leaf-wise trees that see a share of the rows.

    Both sets are cut by the edges of the training rows and equal rows counted, once for each number of bins. Learners
    that need no single rows are fitted on the counted ones; all that know bins only score them as well.
    """
    columns = [*[F.col(f"`{f}`").cast("double").alias(f) for f in features], F.col(f"`{target}`").alias(target)]
    parts = [d.select(*columns, F.lit(s).alias("_set")) for s, d in (("Treino", train), ("Teste", test))]
    both, mine = parts[0].unionByName(parts[1]), F.col("_set") == "Treino"
    known: dict[int, tuple] = {}

    def counted(most_bins: int) -> tuple[list, list[str], DataFrame]:
        if most_bins not in known:
            edges = bin_edges(train, features, most_bins)
            stage = bucketizer(edges, features)
            names = list(stage.getOutputCols())
            # a null has no bin yet: it gets that of missing numbers, the last
            bins = [F.coalesce(F.col(f"`{n}`"), F.lit(max(len(e), 1) + 1.0)).alias(n) for n, e in zip(names, edges)]
            known[most_bins] = edges, names, cells(stage.transform(both).select(*bins, f"`{target}`", "_set"))
        return known[most_bins]

    out = None
    for name, algorithm in (algorithms or bakeoff_algorithms()).items():
        if isinstance(algorithm, Leafwise):
            edges, names, table = counted(algorithm.most_bins)
            rows = written(counted_bins(table, names, edges, target, COPIES, ["_set"]), "binned")
            if algorithm.subsample < 1:
                model = fit_leafwise(train, features, target, keys, algorithm)
            else:
                model = fit_binned(rows.where(mine & F.col("y").isNotNull()), edges, features, algorithm)
            predictions = model.of_bins(rows).select(F.col("_set").alias("set"), F.col("y").alias(target), PROBABILITY, "prediction", F.col("n").alias(COPIES))
        elif takes_weights(algorithm) and not isinstance(algorithm, LogisticRegression) or plain_forest(algorithm):
            edges, names, table = counted(algorithm.getMaxBins())
            own = table.where(mine).drop("_set")
            sizes = [max(len(e), 1) + 2 for e in edges]
            if plain_forest(algorithm):
                model = fit_forest(own, names, sizes, algorithm, target)
            else:
                model = fit_cells(own, [], names, algorithm, target)
            predictions = scored(model, table, [target, "_set", COPIES]).withColumnRenamed("_set", "set")
        else:
            model = fit_classifier(train, features, algorithm, target)
            predictions = both_sets(model, train, test, target).withColumn(COPIES, F.lit(1))
        found = set_metrics(written(predictions, "predictions"), target, COPIES).withColumn("algorithm", F.lit(name))
        out = found if out is None else out.unionByName(found)
    return out


# --- search -----------------------------------------------------------------------------------------

def random_settings(trials: int, seed: int = SEED) -> list[dict[str, float]]:
    """Random points of the search space."""
    rng = random.Random(seed)
    return [
        {
            "maxIter": rng.randint(5, 50),
            "stepSize": math.exp(rng.uniform(math.log(0.01), math.log(0.5))),
            "maxDepth": rng.randint(3, 10),
            "subsamplingRate": rng.uniform(0.5, 1.0),
            "featureShare": rng.uniform(0.5, 1.0),
            "positiveWeight": rng.uniform(1, 30),
        }
        for _ in range(trials)
    ]


@dataclass(frozen=True)
class Search:
    """Result of ``hyperparameter_search``."""

    model: LeafwiseModel
    settings: dict[str, float]
    table: DataFrame


def hyperparameter_search(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    keys: Sequence[str],
    trials: int = TRIALS,
    folds: int = FOLDS,
    settings: Sequence[dict[str, float]] | None = None,
) -> Search:
    """Random search over boosted trees with class weights, by F-beta over stratified folds.

    The folds are a column of the training table, so every trial sees the same folds. Features are cut and equal rows
    counted once for all fits. The models of all trials and folds are fitted side by side, each in one task that goes
    through the counted cells block by block (``levelwise``); the best settings are fitted again on all folds.
    """
    settings = list(settings or random_settings(trials))
    bins = GBTClassifier().getMaxBins()
    folded = stratified_folds(df.select(*dict.fromkeys([*keys, *features, target])), target, keys, folds)
    stages, names, cut = cut_up(written(folded, "folds"), features, bins)
    counted = cells(cut.select(*names, target, "fold"))
    splits = [s[1:-1] for s in stages[0].getSplitsArray()]
    sizes = [len(s) + 2 for s in splits]  # one more for missing values
    blocks = levelwise.packed(counted, names, sizes, target, COPIES, "fold", folds)
    points = [levelwise.Settings.of(s, SEED) for s in settings]
    found = levelwise.fitted(blocks, sizes, [(p, fold) for p in points for fold in range(folds)])

    def fbeta(tp: int, fp: int, fn: int) -> float:
        return (1 + BETA**2) * tp / ((1 + BETA**2) * tp + BETA**2 * fn + fp) if tp else 0.0

    scores = [sum(fbeta(*c) for c in found[i * folds:(i + 1) * folds]) / folds for i in range(len(settings))]
    table = df.sparkSession.createDataFrame(
        [(i, *[float(s[k]) for k in s], score) for i, (s, score) in enumerate(zip(settings, scores))],
        "trial int, " + ", ".join(f"{k} double" for k in settings[0]) + ", fbeta double",
    )
    best = max(range(len(scores)), key=scores.__getitem__)
    (trees,) = levelwise.fitted(blocks, sizes, [(points[best], None)], trees=True)
    # a bin ends just below its split; Spark's log loss has twice the score in the exponent
    cuts = [[math.nextafter(x, -math.inf) for x in s] for s in splits]
    model = LeafwiseModel(list(features), 0.0, [levelwise.node_of(t, cuts, 2.0) for t in trees])
    return Search(model, settings[best], table.orderBy(F.desc("fbeta"), "trial"))


# --- scoring ----------------------------------------------------------------------------------------

def score_population(
    model: Transformer, df: DataFrame, keys: Sequence[str], keep: Sequence[str] = (), bands: int = 10
) -> DataFrame:
    """Probability, points with repeatable noise against ties, and quantile band of each row."""
    rows = scored(model, df, [*keys, *keep])
    points = tie_jitter(score_points(F.col(PROBABILITY)), *[F.col(k) for k in keys])
    return quantile_bands(written(rows.withColumn("points", points), "scores"), "points", bands, "band")


def batch_score(
    model_path: str, populations: Mapping[str, DataFrame], keys: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Score each population with a stored model; bands are cut within each population."""
    model, out = PipelineModel.load(model_path), None
    for name, df in populations.items():
        part = score_population(model, df, keys, keep).withColumn("population", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@dataclass(frozen=True)
class Scorer:
    """A preparation and the model fitted on its features, stored and loaded as one."""

    prep: Prep
    model: Transformer

    def save(self, path: str) -> None:
        """Store under ``path``; the preparation comes last, so a part of it is not taken for the whole."""
        self.model.write().overwrite().save(f"{path}/model")
        self.prep.save(f"{path}/prep")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Scorer:
        prep = Prep.load(spark, f"{path}/prep")
        kind = LeafwiseModel if LeafwiseModel.is_stored(spark, f"{path}/model") else PipelineModel
        return Scorer(prep, kind.load(f"{path}/model"))

    def score(self, df: DataFrame, keys: Sequence[str], keep: Sequence[str] = (), bands: int = 10) -> DataFrame:
        """From raw columns to probability, points and bands. Prepared columns can be named in ``keep`` too."""
        prepared = self.prep.apply(df, [*keys, *(c for c in keep if c in df.columns and c not in self.prep.features)])
        return score_population(self.model, prepared, keys, keep, bands)


def batch_score_raw(
    spark: SparkSession, path: str, populations: Mapping[str, DataFrame], keys: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Score raw populations with a stored preparation and model; bands are cut within each population."""
    scorer, out = Scorer.load(spark, path), None
    for name, df in populations.items():
        part = scorer.score(df, keys, keep).withColumn("population", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def permutation_importance(
    model: Transformer, df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], repeats: int = 5,
    seed: int = SEED,
) -> DataFrame:
    """Mean loss of average precision when one feature is shuffled.

    Each repeat pairs every row with another one by joining two random numberings of the rows; all
    features are then shuffled in turn from the same pairs. ``keys`` should identify a row.
    """

    def precision(rows: DataFrame) -> float:
        return metrics.ranking_metrics(scored(model, rows, [target]), PROBABILITY, target).first()["average_precision"]

    base = precision(df)
    losses: dict[str, list[float]] = {f: [] for f in features}
    own = written(shuffled_rank(df.select(*keys, *features, target), keys, seed=seed), "ranked")
    for repeat in range(1, repeats + 1):
        other = shuffled_rank(df.select(*keys, *features), keys, seed=seed + repeat)
        other = other.select("rank", *[F.col(f).alias(f"_s_{f}") for f in features])
        pairs = written(own.join(other, "rank"), "pairs")
        for f in features:
            losses[f].append(base - precision(pairs.withColumn(f, F.col(f"_s_{f}"))))
    table = [(f, sum(x) / len(x)) for f, x in losses.items()]
    return df.sparkSession.createDataFrame(table, "feature string, importance double").orderBy(F.desc("importance"))


# --- comparison of feature sets and report ------------------------------------------------------------

def nested_model_comparison(
    train: DataFrame, test: DataFrame, feature_sets: Mapping[str, Sequence[str]], target: str, settings: Mapping | None = None
) -> DataFrame:
    """The same boosted trees on growing feature sets; metrics of each on both sets."""
    out, counted = None, None
    gbt = GBTClassifier(seed=SEED, **(settings or {"maxIter": 20, "maxDepth": 5}))
    if takes_weights(gbt):  # the rows are cut and counted once for all sets
        every = list(dict.fromkeys(f for features in feature_sets.values() for f in features))
        (stage,), names, cut = cut_up(train.select(*every, target), every, gbt.getMaxBins())
        counted, splits = cells(cut.select(*names, target)), dict(zip(every, stage.getSplitsArray()))
    for name, features in feature_sets.items():
        if counted is None:
            model = fit_classifier(train, features, gbt, target)
        else:
            own = Bucketizer(
                splitsArray=[splits[f] for f in features], inputCols=list(features),
                outputCols=[f"_bin_{f}" for f in features], handleInvalid="keep",
            )
            model = fit_cells(counted, [own], own.getOutputCols(), gbt, target)
        found = set_metrics(both_sets(model, train, test, target), target).select(
            F.lit(name).alias("model"), F.lit(len(features)).alias("n_features"), "*"
        )
        out = found if out is None else out.unionByName(found)
    return out


def model_report(
    model: PipelineModel, train: DataFrame, test: DataFrame, features: Sequence[str], target: str
) -> DataFrame:
    """Everything a model report draws, in long form: ``set, metric, item, x, y``."""
    predictions = both_sets(model, train, test, target)

    def rows(df: DataFrame, metric: str, item: Column, x: Column, y: Column, name: Column) -> DataFrame:
        none = F.lit(None).cast("double")
        return df.select(
            name.alias("set"), F.lit(metric).alias("metric"), item.cast("string").alias("item"),
            F.coalesce(x.cast("double"), none).alias("x"), y.cast("double").alias("y"),
        )

    none, parts = F.lit(None).cast("double"), []
    parts.append(rows(importances(model, features, train), "importance", F.col("feature"), none, F.col("importance"), F.lit("Treino")))
    for name in ("Treino", "Teste"):
        s, p = F.lit(name), predictions.where(F.col("set") == name)
        parts.append(rows(target_distribution(p, target), "target_pct", F.col(target), none, F.col("pct"), s))
        cells = metrics.confusion_matrix(p, target, F.col("prediction"))
        parts.append(rows(cells, "confusion", F.concat_ws("->", "actual", "predicted"), none, F.col("n"), s))
        roc = metrics.roc_curve(p, PROBABILITY, target)
        parts.append(rows(roc, "roc", F.col("threshold"), F.col("fpr"), F.col("tpr"), s))
        pr = metrics.pr_curve(p, PROBABILITY, target)
        parts.append(rows(pr, "precision_recall", F.col("threshold"), F.col("recall"), F.col("precision"), s))
        ranking = metrics.ranking_metrics(p, PROBABILITY, target)
        for m in ("auc", "gini", "ks"):
            parts.append(rows(ranking, m, F.lit(m), none, F.col(m), s))
        deciles = metrics.decile_table(p, PROBABILITY, target)
        parts.append(rows(deciles, "decile_event_rate", F.col("band"), F.col("band"), F.col("event_rate"), s))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
