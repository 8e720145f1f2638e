"""Column expressions shared by the operators. All stay inside code generation."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPARISONS = {
    "==": lambda c, v: c == v,
    ">=": lambda c, v: c >= v,
    "<=": lambda c, v: c <= v,
}


def named(name: str) -> Column:
    """Column by name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def flag(column: str, operator: str, value) -> Column | None:
    """0/1 flag; null compares to 0. An operator outside the known ones gives None."""
    compare = COMPARISONS.get(operator)
    if compare is None:
        return None
    return F.coalesce(compare(named(column), F.lit(value)), F.lit(False)).cast("int")


def finite(x: Column) -> Column:
    """NaN and the infinities become null."""
    x = x.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def ratio(numerator: str, denominator: str, offset: float = 0.0) -> Column:
    """numerator / (denominator + offset); a zero denominator gives null."""
    den = named(denominator).cast("double") + F.lit(float(offset))
    return finite(F.try_divide(named(numerator).cast("double"), den))


def cut(x: Column, edges: list[float], labels: list, lowest: bool = False) -> Column:
    """Label of the bin (lo, hi] that holds x; outside all bins null. `lowest` closes the first."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per bin is needed")
    first = x >= edges[0] if lowest else x > edges[0]
    out = F.when(~first, F.lit(None))
    for hi, label in zip(edges[1:], labels):
        out = out.when(x <= hi, F.lit(label))
    return out


def map_codes(column: str, mapping: dict) -> Column:
    """Code of a category; null where the mapping has none."""
    pairs = [F.lit(v) for v in chain.from_iterable(mapping.items())]
    return F.try_element_at(F.create_map(*pairs), named(column))


def banded(x: Column, bands: list[tuple[str, float]], otherwise: str, strict: bool) -> Column:
    """First label whose bound x reaches (`strict`: exceeds)."""
    out = None
    for label, bound in bands:
        test = x > bound if strict else x >= bound
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(otherwise)


# Effect sizes, drift alerts, risk bands.
EFFECT_BANDS = [("large", 0.14), ("medium", 0.06), ("small", 0.01)]
PSI_BANDS = [("severe", 0.20), ("moderate", 0.10)]
AUC_DROP_ALERT = 0.03
RECALL_DROP_ALERT = 0.05
KS_P_ALERT = 0.05
RISK_EDGES = [-0.001, 0.30, 0.55, 1.001]
RISK_LABELS = ["low", "medium", "high"]


def effect_label(eta_squared: Column) -> Column:
    return F.when(eta_squared.isNotNull(), banded(eta_squared, EFFECT_BANDS, "negligible", strict=False))


def psi_label(psi: Column) -> Column:
    return F.when(psi.isNotNull(), banded(psi, PSI_BANDS, "stable", strict=True))


def risk_level(probability: Column) -> Column:
    return cut(probability, RISK_EDGES, RISK_LABELS)
