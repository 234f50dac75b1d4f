"""What the report page asks of the documents."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The colour ramp's places and colours.
RAMP = ((0.0, (0x2E, 0xCC, 0x71)), (0.25, (0xF1, 0xC4, 0x0F)), (0.5, (0xE6, 0x7E, 0x22)), (0.75, (0xE7, 0x4C, 0x3C)), (1.0, (0x7B, 0x00, 0x00)))
GREY = "#bbb"


def keep(df: DataFrame, comuna: int | None = None, kind: str | None = None) -> DataFrame:
    """Corners of a district, and with an intervention of a kind; ``None`` asks for nothing."""
    if comuna is not None:
        df = df.filter(F.col("comuna") == comuna)
    return df if kind is None else df.filter(F.exists("intervenciones", lambda i: i["tipo"] == kind))


def top(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` corners of highest index with ``rank``, their place among all of these, which filters leave as it is."""
    best = df.orderBy(F.desc_nulls_last("indice"), "corner_ord").limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("indice"), "corner_ord")))


def districts(df: DataFrame) -> DataFrame:
    """The districts that corners are in."""
    return df.select("comuna").filter("comuna is not null").distinct()


#: What the page calls the mitigation axes.
MITIGATION = {"has_ped_signal": "Semáforo peatonal", "traffic_calming": "Reductor de velocidad", "crossing_marked": "Senda demarcada"}


def mitigation(excluded: list[str] | dict[str, str] = ()) -> Column:
    """array<struct<nombre, presente>>: the mitigation axes that have a value and were not left out, in their fixed order."""
    each = (F.when(F.col(f"{a}_raw").isNotNull(), F.struct(F.lit(name).alias("nombre"), (F.col(f"{a}_raw") >= 1).alias("presente"))) for a, name in MITIGATION.items() if a not in excluded)
    return F.array_compact(F.array(*each))


def kinds(df: DataFrame) -> DataFrame:
    return df.select(F.explode("intervenciones.tipo").alias("tipo")).distinct()


def ramp(v: Column, stops=RAMP) -> Column:
    """A colour between the stops around a value, as rgb(r,g,b); values beyond are clamped, nulls grey."""
    x = F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))
    out = F.lit(None).cast("string")
    for (a, low), (b, high) in reversed(list(zip(stops, stops[1:]))):
        part = [F.floor(F.lit(float(p)) + (x - a) / (b - a) * float(q - p) + 0.5).cast("string") for p, q in zip(low, high)]
        out = F.when(x <= b, F.concat(F.lit("rgb("), part[0], F.lit(","), part[1], F.lit(","), part[2], F.lit(")"))).otherwise(out)
    return F.when(v.isNull(), F.lit(GREY)).otherwise(out)


def tile(lon: Column, lat: Column, zoom: int = 19) -> tuple[Column, Column]:
    """Web-Mercator tile column and row."""
    n, s = float(2**zoom), F.sin(F.radians(lat))
    return F.floor((lon + 180.0) / 360.0 * n), F.floor((F.lit(0.5) - F.log((F.lit(1.0) + s) / (F.lit(1.0) - s)) / F.lit(4 * math.pi)) * n)


def shown(axis: str, raw: Column) -> Column:
    """An axis value as the page shows it."""
    text = F.format_string("%.0f", raw)
    unit = {"crossing_length": " m", "roadway_width": " m", "acute_angle": "°", "crash_history": " pts"}.get(axis, "")
    if axis in ("near_school", "heavy_traffic", "no_refuge"):
        text = F.when(raw >= 1, F.lit("sí")).otherwise("no")
    return F.when(raw.isNull(), F.lit("—")).otherwise(F.concat(text, F.lit(unit)))


def ranked_axes(df: DataFrame, axes: list[str]) -> DataFrame:
    """``df`` with ``ejes``: the axes that have a normalised value, highest first."""
    each = F.array(*(F.struct((-F.col(f"{a}_norm")).alias("low"), F.lit(a).alias("eje"), F.col(f"{a}_norm").alias("normalizado")) for a in axes))
    return df.withColumn("ejes", F.transform(F.array_sort(F.filter(each, lambda e: e["normalizado"].isNotNull())), lambda e: F.struct(e["eje"].alias("eje"), e["normalizado"].alias("normalizado"))))
