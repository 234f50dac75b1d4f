"""Risk axes of corners from the layers at hand; a missing layer leaves its axis null, never 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.text import number
from corvane.operators import proximity
from corvane.operators.transects import crossing_metrics

#: Why an axis has no values.
REASONS = {
    "no_refuge": "requiere geometría de refugios/canteros centrales (ej. OSM crossing:island; no presente en data/raw/)",
    "speed_limit": "requiere velocidad máxima por tramo (no está en callejero.geojson ni en otra fuente de data/raw/)",
    "crossing_length": "requiere veredas-2019.geojson para medir el hueco de calzada entre veredas",
    "roadway_width": "requiere veredas-2019.geojson para medir el hueco de calzada entre veredas",
    "has_ped_signal": "fuente cruces_semaforizados no disponible",
    "traffic_calming": "fuente ampliaciones_veredas no disponible",
    "crossing_marked": "requiere dataset de sendas peatonales pintadas/demarcadas (no presente en data/raw/)",
    "near_school": "requiere padrón de escuelas/jardines (no presente en data/raw/)",
    "crash_history": "requiere siniestros viales georreferenciados (no presente en data/raw/)",
    "ped_flow_proxy": "requiere paradas de colectivo / estaciones de subte o tren (no presente en data/raw/)",
    "heavy_traffic": "requiere red de tránsito pesado (no presente en data/raw/)",
}
#: axis, layer, name of the radius in the configuration
PRESENCE = (("has_ped_signal", "cruces_semaforizados", "ped_signal_radius_m"), ("traffic_calming", "ampliaciones_veredas", "traffic_calming_radius_m"), ("near_school", "escuelas", "school_radius_m"), ("heavy_traffic", "transito_pesado", "heavy_traffic_radius_m"))
CONTEXT = (("on_sendero_escolar", "senderos_escolares", "sendero_escolar_radius_m", 20.0), ("near_ciclovia", "ciclovias", "ciclovia_radius_m", 15.0))


def severity(column: Column) -> Column:
    return F.regexp_replace(F.upper(column), r"^\s+|\s+$", "")


def severity_weight(column: Column, weights: dict[str, float]) -> Column:
    """A crash's weight by its severity; unknown or none weighs 1."""
    chosen = F.lit(1.0)
    for name, weight in weights.items():
        chosen = F.when(severity(column) == name, F.lit(float(weight))).otherwise(chosen)
    return chosen


def crash_facts(weights: dict[str, float], early: tuple[int, int], late: tuple[int, int]) -> dict[str, Column]:
    """All that is asked of the crashes in reach, for one join."""
    level, year = severity(F.col("gravedad_siniestro")), number(F.col("anio_siniestro"))
    return {
        "crash_history": F.sum(severity_weight(F.col("gravedad_siniestro"), weights)),
        "crash_count": F.count("*"),
        "crash_grave_count": F.count_if(level == "GRAVE"),
        "crash_mortal_count": F.count_if(level == "MORTAL"),
        "crash_early_count": F.count_if(year.between(*early)),
        "crash_late_count": F.count_if(year.between(*late)),
    }


def compute(corners: DataFrame, layers: dict[str, DataFrame], cfg) -> tuple[DataFrame, dict[str, str]]:
    """Axes, context flags and crash details of corners (key, x, y, branches ...), and reasons for axes without values."""
    sites, out, reasons, null = corners.select("key", "x", "y"), corners, dict(REASONS), F.lit(None).cast("double")
    out = out.withColumn("acute_angle", F.col("acute_angle_raw")).withColumn("n_branches", F.col("n_branches").cast("double")).drop("acute_angle_raw")
    for axis in ("no_refuge", "speed_limit", "crossing_marked"):
        out = out.withColumn(axis, null)
    if "veredas" in layers:
        widths = crossing_metrics(corners, layers["veredas"], offset_m=cfg.crossing["offset_m"], max_width_m=cfg.crossing["max_width_m"], search_m=cfg.crossing["sidewalk_search_radius_m"])
        out = out.join(widths, "key", "left")
    else:
        out = out.withColumns({"crossing_length": null, "roadway_width": null})
    flags = [(axis, layer, cfg.radii[radius]) for axis, layer, radius in PRESENCE if layer in layers]
    flags += [(axis, layer, cfg.radii.get(radius, usual)) for axis, layer, radius, usual in CONTEXT if layer in layers]
    for axis, layer, radius in flags:
        found = proximity.nearby_bool(sites, layers[layer], radius, axis)
        out = out.join(found.withColumn(axis, F.col(axis).cast("double")), "key", "left")
    for axis, *_ in (*PRESENCE, *CONTEXT):
        if axis not in out.columns:
            out = out.withColumn(axis, null)
    facts = crash_facts(cfg.severity_weights, cfg.crash_early, cfg.crash_late)
    if "siniestros" in layers:
        found = proximity.measure(sites, layers["siniestros"], cfg.radii["crash_radius_m"], once=False, **facts)
        out = out.join(found.select("key", *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in facts)), "key", "left")
    else:
        out = out.withColumns({c: null for c in facts})
    # The parts of a layer's feature are one stop.
    own = lambda df, name: [F.concat(F.lit(f"{name} "), F.col("ord").cast("string")).alias("ord")] if "ord" in df.columns else [F.concat(F.lit(f"{name} row "), F.monotonically_increasing_id().cast("string")).alias("ord")]
    flow = [layers[name].select("shape", F.lit(float(w)).alias("weight"), *own(layers[name], name)) for name, w in cfg.flow_weights.items() if name in layers]
    if flow:
        stops = flow[0]
        for more in flow[1:]:
            stops = stops.unionByName(more)
        out = out.join(proximity.nearby_sum(sites, stops, cfg.radii["ped_flow_radius_m"], F.col("weight"), "ped_flow_proxy"), "key", "left")
    else:
        out = out.withColumn("ped_flow_proxy", null)
    return out, reasons
