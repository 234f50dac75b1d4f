"""Normalising axes to [0, 1] and combining them into an index."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.storage import materialise

#: Axes that lower the risk.
MITIGATION = ("has_ped_signal", "traffic_calming", "crossing_marked")
RANGES = 64


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def normalise_all(df: DataFrame, specs: list[tuple[str, str, str, str | None]], row: str | None = None) -> DataFrame:
    """``df`` with a column ``out`` on [0, 1] for each (value, out, method, group); nulls stay null.

    Methods are percentile (average rank over number of values), minmax, both 0.5 where all values are equal, binary,
    zero_inflated (percentile among positive values, else 0) and rank (percentile without the 0.5). With a group each group is taken for itself, and rows of none get null.

    All columns go together: values are stacked to (column, group, value), distinct ones counted once, and cut into ranges of about equal
    size whose totals give each range's first rank, so no partition holds all of a column or group. One join takes the
    results back to the rows. Rows that are stored already, with a column ``row`` that tells them apart, are not stored again.
    """
    if unknown := {m for _, _, m, _ in specs} - {"percentile", "minmax", "binary", "zero_inflated", "rank"}:
        raise ValueError(f"unknown normalisation: {sorted(unknown)}")
    rows = df
    if row is None:
        row = _free(df, "row_id")
        rows = materialise(df.withColumn(row, F.monotonically_increasing_id()), drop_shuffles=True)
    double = lambda c: F.col(f"`{c}`").cast("double")
    ranked = [(i, *spec) for i, spec in enumerate(specs) if spec[2] != "binary"]
    out = rows
    if ranked:
        cells = [F.struct(F.lit(i).alias("i"), (F.lit("") if group is None else F.col(f"`{group}`").cast("string")).alias("g"), (F.when(double(value) > 0, double(value)) if method == "zero_inflated" else double(value)).alias("v")) for i, value, _, method, group in ranked]
        long = rows.select(F.col(row).alias("row"), F.inline(F.array(*cells))).filter("g is not null and v is not null")
        scores = _scores(materialise(long.groupBy("i", "g", "v").agg(F.count("*").alias("n")), drop_shuffles=True), {i: method for i, _, _, method, _ in ranked})
        wide = long.join(scores, ["i", "g", "v"]).groupBy("row").agg(*(F.max(F.when(F.col("i") == i, F.col("score"))).alias(f"s{i}") for i, *_ in ranked)).withColumnRenamed("row", row)
        out = rows.join(wide, row, "left")
    found = {}
    for i, (value, name, method, _) in enumerate(specs):
        score = double(value) if method == "binary" else F.col(f"s{i}")
        found[name] = F.when(double(value) <= 0, 0.0).otherwise(score) if method == "zero_inflated" else score
    kept = [F.col(f"`{c}`") for c in df.columns if c not in found]
    return out.select(*kept, *(c.alias(name) for name, c in found.items()))


def _scores(counts: DataFrame, methods: dict[int, str]) -> DataFrame:
    """(i, g, v, score) for the distinct values (i, g, v) that come ``n`` times."""
    parts = [k / RANGES for k in range(1, RANGES)]
    edges = {r[0]: sorted(set(r[1])) for r in counts.groupBy("i").agg(F.percentile_approx("v", parts, 1000)).collect()}  # one row a column
    place = F.lit(0)
    for i, found in edges.items():
        place = F.when(F.col("i") == i, F.size(F.filter(F.array(*map(F.lit, found)), lambda e: F.col("v") > e))).otherwise(place)
    counts = counts.withColumn("r", place)
    whole = Window.partitionBy("i", "g")
    totals = counts.groupBy("i", "g", "r").agg(F.sum("n").alias("t"), F.min("v").alias("low"), F.max("v").alias("high"))
    totals = totals.select("i", "g", "r", (F.sum("t").over(whole.orderBy("r")) - F.col("t")).alias("before"), F.sum("t").over(whole).alias("all"), F.min("low").over(whole).alias("low"), F.max("high").over(whole).alias("high"))
    within = F.sum("n").over(Window.partitionBy("i", "g", "r").orderBy("v")) - F.col("n")
    both = counts.withColumn("within", within).join(totals, ["i", "g", "r"])
    score = (F.col("before") + F.col("within") + (F.col("n") + 1) / F.lit(2.0)) / F.col("all")
    kind = lambda *names: F.col("i").isin([i for i, m in methods.items() if m in names])
    score = F.when(kind("minmax"), (F.col("v") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))).otherwise(score)
    return both.select("i", "g", "v", F.when(kind("percentile", "minmax") & (F.col("low") == F.col("high")), 0.5).otherwise(score).alias("score"))


def normalise(df: DataFrame, value: str, out: str, method: str, group: str | None = None) -> DataFrame:
    """One column of ``normalise_all``."""
    return normalise_all(df, [(value, out, method, group)])


@dataclass
class Weighted:
    """A scored table and how it came about."""

    scores: DataFrame
    included: dict[str, float]
    excluded: dict[str, str] = field(default_factory=dict)
    methods: dict[str, str] = field(default_factory=dict)


def axis_facts(df: DataFrame, axes: list[str]) -> dict[str, tuple[int, bool]]:
    """For each axis its number of values, and whether all of them are 0 or 1; one pass over the table for all."""
    known = [a for a in axes if a in df.columns]
    row = df.agg(*(x for a in known for x in (F.count(a).alias(f"{a}__n"), F.coalesce(F.bool_and(F.when(F.col(a).isNotNull(), F.col(a).cast("double").isin(0.0, 1.0))), F.lit(False)).alias(f"{a}__b")))).first() if known else {}
    return {a: (row[f"{a}__n"], row[f"{a}__b"]) if a in known else (0, False) for a in axes}


def method_of(axis: str, only_binary: bool, overrides: dict[str, str], default: str) -> str:
    return overrides.get(axis) or ("binary" if only_binary else default)


def weigh(axes: DataFrame, weights: dict[str, float], method: str = "percentile", overrides: dict[str, str] | None = None, reasons: dict[str, str] | None = None, mitigation: tuple[str, ...] = MITIGATION, row: str | None = None) -> Weighted:
    """Columns <axis>_raw, <axis>_norm and riesgo_bruto beside those of ``axes``; ``row`` as in ``normalise_all``.

    Axes without any value are left out and the weights of the others scaled up to the same
    total; a null of an axis that has values adds nothing to its row.
    """
    facts = axis_facts(axes, list(weights))
    used = [a for a in weights if facts[a][0]]
    have = sum(weights[a] for a in used)
    scale = sum(weights.values()) / have if have > 0 else 0.0
    result = Weighted(axes, {a: weights[a] * scale for a in used}, {a: (reasons or {}).get(a, "eje sin valores en el scope actual") for a in weights if a not in used})
    raw = axes.withColumns({f"{a}_raw": F.col(a).cast("double") if a in axes.columns else F.lit(None).cast("double") for a in weights})
    raw = raw.withColumns({f"{a}_norm": F.lit(None).cast("double") for a in weights if a not in used})
    result.methods = {a: method_of(a, facts[a][1], overrides or {}, method) for a in used}
    out, risk = normalise_all(raw, [(f"{a}_raw", f"{a}_norm", result.methods[a], None) for a in used], row), F.lit(0.0)
    for a in used:  # in the order of the weights, as sums of doubles depend on it
        risk = risk + F.coalesce(F.col(f"{a}_norm"), F.lit(0.0)) * F.lit(-1.0 if a in mitigation else 1.0) * F.lit(result.included[a])
    result.scores = out.withColumn("riesgo_bruto", risk)
    return result


def compute_index(axes: DataFrame, weights: dict[str, float], method: str = "percentile", overrides: dict[str, str] | None = None, group: str | None = None, reasons: dict[str, str] | None = None, mitigation: tuple[str, ...] = MITIGATION) -> Weighted:
    """``weigh``, and the risk on [0, 1] as indice and, within ``group``, as indice_comuna."""
    result = weigh(axes, weights, method, overrides, reasons, mitigation)
    result.scores = normalise_all(result.scores, [("riesgo_bruto", "indice", method, None), ("riesgo_bruto", "indice_comuna", method, group)])
    return result
