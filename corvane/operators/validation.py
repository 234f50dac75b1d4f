"""Rank correlation of an index with crashes, and its largest residuals."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators import scoring

GEOMETRY = ("crossing_length", "n_branches", "acute_angle", "roadway_width", "no_refuge", "speed_limit")


def spearman(df: DataFrame, a: str, b: str) -> tuple[float | None, float | None, int]:
    """(rho, two-sided p-value, n) over rows that have both."""
    both = df.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null")
    ranked = scoring.normalise_all(both, [("a", "rank_a", "rank", None), ("b", "rank_b", "rank", None)])
    rho, n = ranked.agg(F.corr("rank_a", "rank_b"), F.count("*")).first()
    return rho, p_value(rho, n), n


def p_value(rho: float | None, n: int) -> float | None:
    """Of Student's t with n - 2 degrees of freedom."""
    if rho is None or math.isnan(rho) or n < 3:
        return None
    return 0.0 if abs(rho) >= 1 else incomplete_beta((n - 2) / 2, 0.5, 1 - rho * rho)


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d, f = 1e-300, 1.0, 0.0, 1.0
    for i in range(2000):
        m = i // 2
        term = 1.0 if i == 0 else m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if i % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 + term * d
        d = 1 / (d if abs(d) > tiny else tiny)
        c = 1 + term / c
        c = c if abs(c) > tiny else tiny
        f *= c * d
        if abs(1 - c * d) < 1e-14:
            break
    return front * (f - 1)


def extremes(df: DataFrame, value: str, key: str, n: int = 10) -> tuple[list, list]:
    """Keys of the ``n`` lowest and the ``n`` highest values, both from low to high."""
    known = df.filter(F.col(value).isNotNull())
    low = [r[0] for r in known.orderBy(value, key).limit(n).select(key).collect()]
    high = [r[0] for r in known.orderBy(F.desc(value), F.desc(key)).limit(n).select(key).collect()]
    return low, high[::-1]


def geometric_index(df: DataFrame, weights: dict[str, float], method: str, overrides: dict[str, str]) -> DataFrame | None:
    """``df`` with ``geometric_index`` from the <axis>_raw columns of the geometry axes alone; None if none has values."""
    raw = [f"{a}_raw" for a in weights if a in GEOMETRY]
    facts = scoring.axis_facts(df, raw)
    used = [a for a in raw if facts[a][0]]
    if not used:
        return None
    axes = [a.removesuffix("_raw") for a in used]
    rows = df.select("corner_id", "crash_history_raw", *used) if "corner_id" in df.columns and "crash_history_raw" in df.columns else df
    out, total = scoring.normalise_all(rows, [(f"{a}_raw", f"{a}_geometric", scoring.method_of(a, facts[f"{a}_raw"][1], overrides, method), None) for a in axes]), F.lit(0.0)
    for a in axes:
        total = total + F.coalesce(F.col(f"{a}_geometric"), F.lit(0.0)) * F.lit(float(weights[a]))
    out = scoring.normalise(out.withColumn("geometric_risk", total), "geometric_risk", "geometric_index", method)
    return out.drop("geometric_risk", *(f"{a}_geometric" for a in axes))


def validate(scores: DataFrame, available: bool, reason: str | None, weights: dict[str, float], method: str, overrides: dict[str, str], included: list[str]) -> dict:
    if not available:
        return {"status": "skipped", "reason": reason or "no hay dataset de siniestros viales en data/raw/ para este scope", "axes_used_in_composite": included}
    if "crash_history_raw" not in scores.columns or scores.filter("crash_history_raw is not null").isEmpty():
        return {"status": "skipped", "reason": "crash_history no pudo calcularse para ninguna esquina de este scope"}
    rho, p, n = spearman(scores, "indice", "crash_history_raw")
    report = {"status": "ok", "n_corners": n, "spearman_indice_compuesto_vs_siniestros": {"rho": rho, "p_value": p}, "spearman_indice_geometrico_vs_siniestros": {"rho": None, "p_value": None}}
    geometric, low, high = geometric_index(scores, weights, method, overrides), [], []
    if geometric is not None:
        rho, p, _ = spearman(geometric, "geometric_index", "crash_history_raw")
        report["spearman_indice_geometrico_vs_siniestros"] = {"rho": rho, "p_value": p}
        left = scoring.normalise(geometric, "crash_history_raw", "crashes", method).withColumn("residual", F.col("geometric_index") - F.col("crashes"))
        low, high = extremes(left, "residual", "corner_id")
    #: Fixed value: the note that goes with the residuals.
    note = "geometria_alta_pocos_siniestros: ¿mitigación efectiva o poco flujo? geometria_baja_muchos_siniestros: ¿falta un eje geométrico relevante?"
    return report | {"residuos": {"nota": note, "geometria_alta_pocos_siniestros": high, "geometria_baja_muchos_siniestros": low}}
