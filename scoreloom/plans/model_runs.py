"""The six nested model runs: from silver tables and books to a fitted, reported, stored model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.cleaning import shifted
from scoreloom.operators import modelling, policy
from scoreloom.operators.boosting import LeafwiseModel
from scoreloom.operators.assemble import KEYS, cohort_range, control_group, out_of_time, population, star_join, union_populations
from scoreloom.operators.dedup import duplicate_key_count
from scoreloom.operators.ordered import null_safe_join
from scoreloom.operators.prep import Prep, fit_prep
from scoreloom.operators.profile import drop_high_null_columns
from scoreloom.operators.sampling import stratified_sample
from scoreloom.operators.scorecard import psi
from scoreloom.operators.search import parzen_search
from scoreloom.session import written

# Identifiers, target, cohorts, and the settings of the six runs.
IDS = ("NUM_CPF", "SAFRA", "FLAG_INSTALACAO", "PROD", "flag_mig2")
TARGET = "FPD"
REPEATED = ("rn", "DATPROC", "FLAG_INSTALACAO", "FPD", "PROD", "flag_mig2")
SCORES = ("SCORE_01", "SCORE_02")
LAST_COHORT, MONTHS_BACK = 202503, 5
TRAIN, TEST = (202410, 202501), (202502, 202503)


@dataclass(frozen=True)
class ModelRun:
    name: str
    tables: tuple[str, ...]
    importance_cutoff: float
    without: tuple[str, ...] = ()
    sample_by: str | None = None
    fractions: Mapping[int, float] = field(default_factory=dict)
    most_nulls: float = 0.7


RUNS = (
    ModelRun("score_1", (), 0.11, without=("SCORE_02",)),
    ModelRun("scores", (), 0.11),
    ModelRun("scores_telco", ("telco",), 0.05, (), "FPD", {0: 0.3, 1: 0.3}),
    ModelRun("scores_telco_registration", ("telco", "registration"), 0.02, (), "FPD", {0: 0.3, 1: 0.3}),
    ModelRun(
        "scores_telco_registration_recharge", ("telco", "registration", "recharge"), 0.04, (), "FPD", {0: 0.3, 1: 0.3}
    ),
    ModelRun(
        "scores_telco_registration_recharge_late_payment",
        ("telco", "registration", "recharge", "late", "payment"), 0.1, (), "FLAG_INSTALACAO", {1: 0.1}, 0.8,
    ),
)


def analysis_table(bureau: DataFrame, tables: Mapping[str, DataFrame], run: ModelRun) -> DataFrame:
    """Bureau rows of the run's cohorts with the columns of its tables."""
    first = shifted(LAST_COHORT, -MONTHS_BACK)
    base = cohort_range(bureau, first, LAST_COHORT).drop("rn", "DATPROC")
    others = [cohort_range(tables[t], first, LAST_COHORT).drop(*REPEATED) for t in run.tables]
    return star_join(base, others, KEYS).drop(*run.without)


@dataclass(frozen=True)
class Fitted:
    run: ModelRun
    prep: Prep
    selected: list[str]
    bakeoff: DataFrame | None
    model: PipelineModel | LeafwiseModel
    train: DataFrame
    test: DataFrame

    def save(self, path: str) -> None:
        """Store preparation and model for ``score_stored``."""
        modelling.Scorer(self.prep, self.model).save(path)

    def metrics(self) -> DataFrame:
        return modelling.set_metrics(modelling.both_sets(self.model, self.train, self.test, TARGET), TARGET)

    def report(self) -> DataFrame:
        return modelling.model_report(self.model, self.train, self.test, self.selected, TARGET)

    def stability(self) -> DataFrame:
        """Population stability of the probability between both sets."""
        both = modelling.both_sets(self.model, self.train, self.test, TARGET)
        return psi(both, modelling.PROBABILITY, "set", "Treino", "Teste")


def fit_run(
    bureau: DataFrame, tables: Mapping[str, DataFrame], run: ModelRun, trials: int = modelling.TRIALS,
    folds: int = modelling.FOLDS, settings: Sequence[dict[str, float]] | None = None, compare: bool = True,
    leafwise: bool = False, **search,
) -> Fitted:
    """Assemble, split out of time, sample, prepare on the training part, select features, compare three
    algorithms (unless ``compare`` is off), search, fit. ``leafwise`` searches leaf-wise trees by ``parzen_search``,
    which takes ``search`` (time limit, patience, ...) and tries ``settings`` first."""
    rows = population(analysis_table(bureau, tables, run))
    if run.sample_by:
        rows = stratified_sample(rows, run.sample_by, run.fractions, KEYS)
    train, test = out_of_time(written(rows, "abt"), TRAIN, TEST)
    train, dropped = drop_high_null_columns(train, run.most_nulls)
    prep = fit_prep(train, TARGET, [c for c in IDS if c in train.columns])
    train = written(prep.apply(train), "train")
    test = written(prep.apply(test.drop(*dropped)), "test")
    selected, _ = modelling.importance_selection(train, prep.features, TARGET, run.importance_cutoff)
    bakeoff = modelling.algorithm_bakeoff(train, test, selected, TARGET, modelling.bakeoff_algorithms(leafwise), KEYS) if compare else None
    if leafwise:
        found = parzen_search(train, selected, TARGET, KEYS, trials, folds, modelling.BETA, first=settings or (), **search)
    else:
        found = modelling.hyperparameter_search(train, selected, TARGET, KEYS, trials, folds, settings)
    return Fitted(run, prep, selected, bakeoff, found.model, train, test)


def score_all(bureau: DataFrame, tables: Mapping[str, DataFrame], fitted: Fitted) -> DataFrame:
    """Points and bands of approved and rejected customers alike, observed default only where installed."""
    everyone = analysis_table(bureau, tables, fitted.run)
    parts = []
    for flag in (1, 0):
        rows = everyone.where(F.col("FLAG_INSTALACAO") == flag)
        keep = ["FLAG_INSTALACAO", *([TARGET] if flag else [])]
        found = modelling.score_population(fitted.model, fitted.prep.apply(rows), KEYS, keep)
        # The bureau scores as they came, not as they were prepared for the model.
        raw = [F.col(c).cast("double").alias(c) for c in SCORES if c in rows.columns]
        parts.append(null_safe_join(found, rows.select(*KEYS, *raw), KEYS, "left"))
    columns = [*KEYS, "FLAG_INSTALACAO", TARGET, *[c for c in SCORES if c in everyone.columns], modelling.PROBABILITY, "points", "band"]
    return union_populations(parts, columns)


def score_stored(
    path: str, bureau: DataFrame, tables: Mapping[str, DataFrame], run: ModelRun, keep: Sequence[str] = ("FLAG_INSTALACAO",)
) -> DataFrame:
    """Score the run's population, approved and rejected, with what ``Fitted.save`` stored, on another day."""
    everyone = analysis_table(bureau, tables, run)
    populations = {name: everyone.where(F.col("FLAG_INSTALACAO") == flag) for name, flag in (("approved", 1), ("rejected", 0))}
    return modelling.batch_score_raw(bureau.sparkSession, path, populations, KEYS, keep)


@dataclass(frozen=True)
class SwapReport:
    approvals: DataFrame
    default_rates: DataFrame
    groups: DataFrame
    risk: DataFrame
    volumes: DataFrame
    install_rates: DataFrame
    bands: DataFrame
    duplicates: DataFrame


def swap_report(scored: DataFrame, bureau: DataFrame, threshold: float = policy.APPROVAL_POINTS) -> SwapReport:
    """What changes if the model's points decide instead of the current policy."""
    swapped = written(policy.with_swap(scored, "points", threshold), "swapped")
    control = control_group(cohort_range(bureau, shifted(LAST_COHORT, -MONTHS_BACK), LAST_COHORT))
    return SwapReport(
        policy.estimated_approvals(swapped, control),
        policy.policy_default_rates(swapped),
        policy.swap_table(swapped),
        policy.risk_by_group(swapped, modelling.PROBABILITY),
        policy.swap_volume(swapped),
        policy.install_rates(control),
        score_bands(swapped),
        duplicate_key_count(swapped, KEYS),
    )


def score_bands(scored: DataFrame) -> DataFrame:
    """Means of the bureau scores, the model's points and the default per band of approved and rejected customers."""
    means = [c for c in (*SCORES, "points", TARGET) if c in scored.columns]
    return scored.groupBy("FLAG_INSTALACAO", "band").agg(
        F.count("*").alias("volume"), *[F.avg(c).alias(f"mean_{c}") for c in means]
    )
