"""The whole analysis of one training and one test table, as a set of result tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cache, partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError, Outcome
from outcome_lens.functions.profiles import Profile, profile
from outcome_lens.functions.sizes import settled
from outcome_lens.operators.caveats import level_purity, topcode_profile
from outcome_lens.operators.describe import correlation, describe_all, describe_numeric, top_bottom
from outcome_lens.operators.design import design_metadata, fit_scaler
from outcome_lens.operators.distributions import box_stats, histogram, shape_profile
from outcome_lens.operators.hypothesis import chi_square, welch_t
from outcome_lens.operators.levels import crosstab, level_counts, reference_levels
from outcome_lens.operators.logistic import (
    annotate_coefficients,
    coefficient_stats,
    compare_strategies,
    fit_score,
    sensitivity,
    stratified_folds,
    threshold_analysis,
)
from outcome_lens.operators.quality import DROP, UNKNOWN, clean, cleaning_summary
from outcome_lens.operators.rates import fold_rare, outcome_rate, rank_levels
from outcome_lens.operators.splits import split_overlap, unseen_levels
from outcome_lens.plans.conclusions import conclusions, strategy_verdict
from outcome_lens.session import stored
from outcome_lens.sources.models import save_and_verify

PLACES = 8  # coefficients shown at each end of the table


@dataclass(frozen=True)
class ReportSpec:
    """What to analyse. ``compared`` is the number tested between ``outcome`` and ``negative``."""

    outcome: Outcome
    negative: str | int
    numeric: tuple[str, ...]  # model features
    categorical: tuple[str, ...]
    compared: str
    factor: str  # tested against the outcome, and the focus of the model
    excluded: str  # left out in the sensitivity refit
    fold: Column | None = field(default=None, repr=False)
    fold_keys: tuple[str, ...] = ()  # without ``fold``: columns that tell rows apart, over which folds are stratified
    folds: int = 5
    described_numeric: tuple[str, ...] = ()  # profiled; the model features if empty
    described_categorical: tuple[str, ...] = ()
    caps: Mapping[str, float] = field(default_factory=dict)
    pure_levels: tuple[str, ...] | None = None  # levels of ``excluded`` whose purity in ``factor`` is shown
    companions: Mapping[str, str] = field(default_factory=dict)  # category -> number that orders its levels


def outcome_report(
    train: DataFrame,
    test: DataFrame,
    spec: ReportSpec,
    model_path: str | None = None,
    tables: Sequence[str] | None = None,
    readers: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Result tables by name: all of them, or the chosen ``tables`` and only the work these need.

    The cleaned splits are stored once, and every step reads them. With ``model_path`` the model is
    saved there, and must predict the same after loading. ``readers`` holds ``reader_equality`` rows of the files.
    """
    outcome = spec.outcome
    numeric = list(spec.described_numeric or spec.numeric)
    categorical = list(spec.described_categorical or spec.categorical)
    if spec.factor not in spec.categorical or spec.excluded not in [*spec.categorical, *spec.numeric]:
        raise AnalysisError("the factor and the excluded column must be model features")
    if spec.fold is None and not spec.fold_keys:
        raise AnalysisError("a report needs folds, or the columns to deal them by")
    model = (list(spec.numeric), list(spec.categorical), outcome)

    kept = stored(clean(train), "train")
    held = stored(clean(test), "test")
    build: dict[str, Callable[[], DataFrame]] = {}

    def table(step: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        """Register a step under its name; it runs at most once."""
        build[step.__name__] = cache(step)
        return build[step.__name__]

    @cache
    def fit():
        return fit_score(kept, held, *model)

    @cache
    def coefs() -> DataFrame:
        return coefficient_stats(fit()[0], kept)

    @cache
    def profiled() -> Profile:
        return profile(kept, numeric)

    @cache
    def level_rates() -> DataFrame:
        return stored(outcome_rate(kept, categorical, outcome), "level-rates")

    build["cleaning"] = lambda: cleaning_summary({"train": train, "test": test}, outcome)
    build["describe"] = lambda: describe_numeric(kept, numeric, known=profiled())
    build["describe_all"] = lambda: describe_all(kept)
    build["correlation"] = lambda: correlation(kept, numeric)
    build["shapes"] = lambda: shape_profile(kept, numeric, known=profiled())
    build["box"] = lambda: box_stats(kept, spec.compared, outcome.column)
    build["rates"] = lambda: level_rates()
    build["folded_rates"] = lambda: fold_rare(level_rates())
    build["ranked_rates"] = lambda: rank_levels(level_rates())
    build["histogram"] = lambda: histogram(kept, spec.compared, outcome.column)
    @cache
    def references() -> DataFrame:
        return settled(reference_levels(kept, list(spec.categorical)))

    build["references"] = references
    build["scales"] = lambda: fit_scaler(kept, list(spec.numeric))
    build["design"] = lambda: design_metadata(kept, fit()[0].design)
    build["crosstab"] = lambda: crosstab(kept, spec.factor, outcome.column)
    build["overlap"] = lambda: split_overlap(kept, held)
    build["unseen"] = lambda: unseen_levels(kept, held, categorical)
    for name, cap in spec.caps.items():
        build[f"topcode_{name}"] = partial(topcode_profile, kept, name, cap, outcome)
    for name, companion in spec.companions.items():
        build[f"rates_{name}"] = partial(outcome_rate, kept, [name], outcome, order_by=companion)
    if spec.excluded in spec.categorical and spec.excluded != spec.factor:
        build["purity"] = lambda: level_purity(kept, spec.factor, spec.excluded, spec.pure_levels)

    @table
    def chi_square_test():
        return chi_square(kept, spec.factor, outcome.column)

    @table
    def welch_test():
        return welch_t(kept, spec.compared, outcome.column, outcome.positive, spec.negative)

    @table
    def metrics():
        return fit()[1]

    @table
    def coefficients():
        names = list(spec.categorical)
        return annotate_coefficients(coefs(), level_counts(kept, names), reference_levels(kept, names), fit()[0].design.rows)

    @table
    def strongest_coefficients():
        return top_bottom(coefficients(), "coef", PLACES, ["name"])

    @table
    def thresholds():
        if spec.fold is not None:
            return threshold_analysis(fit()[0], kept, held, spec.fold, spec.folds)
        dealt = stored(stratified_folds(kept, outcome, spec.fold_keys, spec.folds), "stratified")
        return threshold_analysis(fit()[0], dealt, held, F.col("fold"), spec.folds)

    @table
    def strategies():
        # the model of the drop strategy is fitted already: only the other one is fitted here
        unknown = stored(clean(train, UNKNOWN, categorical), "train-unknown")
        other = compare_strategies({UNKNOWN: unknown}, held, *model)
        return metrics().select(F.lit(DROP).alias("strategy"), "*").unionByName(other)

    @table
    def strategy_choice():
        return strategy_verdict(strategies())

    @table
    def sensitivity_refit():
        return sensitivity(kept, held, *model, excluded=spec.excluded, focus=spec.factor)

    if model_path is not None:
        build["saved_model"] = lambda: save_and_verify(fit()[0].model, held, model_path)

    @table
    def facts():
        return conclusions(
            chi_square=chi_square_test(),
            welch=welch_test(),
            rates=outcome_rate(kept, [spec.factor], outcome),
            coefs=coefs(),
            focus=spec.factor,
            sensitivity=sensitivity_refit(),
            thresholds=thresholds(),
            strategies=strategies(),
            readers=readers,
            references=references(),
        )

    unknown_names = set(tables or ()) - set(build)
    if unknown_names:
        raise AnalysisError(f"no result table named {', '.join(sorted(unknown_names))}")
    return {name: build[name]() for name in (build if tables is None else tables)}
