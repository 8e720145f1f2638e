"""The exploratory report: every section as a result table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from retentia.operators import association as a
from retentia.operators import clustering, hypothesis as h
from retentia.operators import profile as p
from retentia.operators.quality import suggest, tolerances
from retentia.operators.ranks import quantiles
from retentia.sources.tables import write_report

PERCENTILES = [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]


def report(
    df: DataFrame, target: str, key: str, ids: Sequence[str], numeric: Sequence[str], binary: Sequence[str],
    categorical: Sequence[str], groupings: Sequence[str], interactions: Sequence[tuple[str, str]] = (),
    rate_columns: Sequence[str] | None = None, clusters: bool = True,
) -> dict[str, DataFrame]:
    """{section: result table}, lazily but for the interaction edges and the clustering.

    Sections read df many times; persist it first when it is expensive.
    """
    features = [c for c in [*numeric, *binary] if c != target]
    everything = [*numeric, *binary]
    described = p.describe(df, numeric)
    sections = {
        "overview": p.overview(df, {"id": ids, "numeric": numeric, "binary": binary, "categorical": categorical}),
        "missing": p.missing_profile(df),
        "missing_total": p.missing_total(df),
        "duplicates": p.duplicates(df, ids, key),
        "numeric": described,
        "percentiles": quantiles(df, numeric, PERCENTILES),
        "iqr_outliers": p.iqr_outliers(df, numeric),
        "zscore_outliers": p.zscore_outliers(df, numeric),
        "normality": h.normality(df, numeric),
        "ks_normal": h.ks_normal(df, numeric),
        "categorical": p.value_counts(df, [*categorical, *binary]),
        "entropy": p.entropy(df, [*categorical, *binary]),
        "target": p.target_summary(df, target),
        "target_by_group": p.target_rate_by_group(df, rate_columns or groupings, target),
        "pearson": a.pearson(df, everything),
        "spearman": a.spearman(df, everything, key),
        "target_correlation": a.with_correlation_p(a.target_correlation(df, features, target)),
        "chi_square_target": a.with_chi_square_p(a.chi_square(df, [(c, target) for c in categorical])),
        "chi_square_pairs": a.with_chi_square_p(a.chi_square(df, a.all_pairs([*categorical, *binary]))),
        "mann_whitney": h.with_p(h.mann_whitney(df, numeric, target), "mann_whitney"),
        "group_comparison": h.with_p(h.group_comparison(df, numeric, target), "welch"),
        "anova": h.with_p(h.anova(df, numeric, groupings), "anova"),
        "kruskal": h.with_p(h.kruskal(df, numeric, groupings), "kruskal"),
        "tukey": h.with_p(h.tukey(df, numeric, groupings), "tukey"),
        "levene": h.with_p(h.levene(df, numeric, target), "levene"),
        "variance_ratio": p.variance_ratio(df, numeric, target),
        "eta_squared": h.eta_squared(df, numeric, groupings),
        "suggested_rules": suggest(df, numeric, [*categorical, *binary]),
        "tolerances": tolerances(described),
    }
    for left, right in interactions:
        sections[f"rate_{left}_{right}"] = p.rate_matrix(df, left, right, target, numeric)
    if clusters:
        elbow, best, profile = clustering.segment(df, numeric, target)
        sections["cluster_elbow"], sections["cluster_profile"] = elbow, profile
    return sections


def save(sections: dict[str, DataFrame], root: str, fmt: str = "json") -> dict[str, str]:
    """Write every section below root; returns the paths."""
    return {name: write_report(table, root, name, fmt) for name, table in sections.items()}
