"""The whole run: layers to corners, axes, index, validation and documents."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators import axes, network, rules, scoring, validation
from corvane.plans.config import Config
from corvane.sources import geojson, geopackage
from corvane.sources.layers import Layers, load
from corvane.storage import materialise


@dataclass
class Run:
    corners: DataFrame
    table: DataFrame
    weighted: scoring.Weighted
    layers: Layers
    report: dict


def run(spark: SparkSession, config: Config, folder: str) -> Run:
    layers = load(spark, folder, config.scope)
    streets = layers.tables["callejero"].withColumnRenamed("ord", "seg_id")
    net = config.network
    corners = materialise(network.build_corners(streets, config.merge_m, int(net["min_branches"]), net["bearing_sample_m"], net["branch_dedupe_bucket_deg"], config.normal, config.corner_definition))
    measured, reasons = axes.compute(corners.withColumn("key", F.col("corner_ord")), layers.usable(), config)
    reasons |= {axis: layers.unavailable[layer] for axis, layer, _ in axes.PRESENCE if layer in layers.unavailable}
    reasons |= {axis: layers.unavailable[layer] for axis, layer in (("crossing_length", "veredas"), ("roadway_width", "veredas"), ("crash_history", "siniestros")) if layer in layers.unavailable}
    weighted = scoring.compute_index(materialise(measured), config.flat_weights(), config.method, config.overrides, "comuna", reasons)
    table = materialise(weighted.scores.withColumn("calles", rules.street_names(F.col("branches"))))
    weighted.scores = table
    usable = "siniestros" in layers.usable()
    report = validation.validate(table, usable, layers.unavailable.get("siniestros"), config.flat_weights(), config.method, config.overrides, list(weighted.included))
    return Run(corners, table, weighted, layers, report)


def _documents(r: Run, config: Config, top: int | None) -> DataFrame:
    return rules.fichas(r.table, list(config.flat_weights()), r.weighted.excluded, config.threshold, config.radii["school_radius_m"], config.radii["crash_radius_m"], top)


def metadata(r: Run, config: Config) -> dict:
    scope = {k: config.scope[k] for k in ("mode", "comuna", "barrio", "bbox")}
    return {
        "generado_en": datetime.now(timezone.utc).isoformat(), "scope": scope, "corner_definition": config.corner_definition, "node_merge_threshold_m": config.merge_m, "angle_normal_range": list(config.normal), "radii": config.radii,
        "normalization": config.method, "n_corners": r.table.count(), "fuentes_disponibles": sorted(r.layers.tables), "fuentes_no_disponibles": r.layers.unavailable, "crash_trend": {"early": list(config.crash_early), "late": list(config.crash_late)},
        "pesos_configurados": config.flat_weights(), "pesos_aplicados_esta_corrida": r.weighted.included, "ejes_excluidos": r.weighted.excluded, "metodos_normalizacion_por_eje": r.weighted.methods,
    }


def _put(path: Path, value: dict) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(value, ensure_ascii=False, indent=2, default=str), encoding="utf-8")


def save_documents(r: Run, config: Config, folder: Path) -> int:
    """One file per corner, written by the tasks into a folder that all of them share; earlier files go."""
    folder.mkdir(parents=True, exist_ok=True)
    for old in folder.glob("*.json"):
        old.unlink()
    made = materialise(_documents(r, config, config.fichas_top_n).select("corner_id", "ficha"))

    def put(rows) -> None:
        for row in rows:
            _put(folder / f"{row['corner_id']}.json", json.loads(row["ficha"]))

    made.foreachPartition(put)
    return made.count()


def save_report(r: Run, config: Config, path: Path) -> int:
    rows = sorted(_documents(r, config, config.report_top_n).collect(), key=lambda x: (-(x["indice"] if x["indice"] is not None else -1), x["corner_ord"]))
    found, ok = [json.loads(x["ficha"]) for x in rows], r.report.get("status") == "ok"
    rho = lambda kind: r.report[f"spearman_indice_{kind}_vs_siniestros"]["rho"] if ok else None
    _put(path, {
        "generado_en": datetime.now(timezone.utc).isoformat(), "scope": {k: config.scope[k] for k in ("mode", "comuna")}, "top_n": len(found), "n_corners_total": r.table.count(),
        "validacion": {"status": r.report.get("status"), "spearman_geometrico": rho("geometrico"), "spearman_compuesto": rho("compuesto")}, "ejes_excluidos": sorted(r.weighted.excluded), "esquinas": found,
    })
    return len(found)


def features(table: DataFrame, order: str | None = None) -> DataFrame:
    """GeoJSON features, one a row, with their order as ``place`` if one is named: numbers rounded to 4 decimals, the place as it is."""
    drop = {"n_merged_nodes", "branches", "lon", "lat", "x", "y", "key", "corner_ord"}
    cols = [(F.bround(c, 4).alias(c) if t == "double" else F.col(c)) for c, t in table.dtypes if c not in drop]
    place = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    return table.select(*([F.col(order).alias("place")] if order else []), F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*cols).alias("properties"), place.alias("geometry")), {"ignoreNullFields": "false"}).alias("value"))


def save_features(table: DataFrame, path: str) -> None:
    """A folder of files with one feature a line, written by the tasks."""
    features(table).write.mode("overwrite").text(path)


def save_geojson(table: DataFrame, path: str) -> None:
    """One feature collection in one file, for the report page."""
    geojson.write(features(table, "corner_ord"), path)


def save_geopackage(table: DataFrame, path: str, layer: str) -> None:
    """A layer of the corners' points with all their columns, branches as JSON."""
    geopackage.write(table.withColumnRenamed("branches", "branches_json"), path, layer, order="corner_ord", leave=("x", "y", "key", "corner_ord"))


def export(r: Run, config: Config, out: str, collection: bool = True) -> None:
    """All sinks; the feature collection in one file only where ``collection`` asks for it."""
    folder = Path(out)
    r.corners.write.mode("overwrite").parquet(f"{out}/corners.parquet")
    r.table.write.mode("overwrite").parquet(f"{out}/esquinas.parquet")
    save_geopackage(r.corners, f"{out}/corners.gpkg", "corners")
    save_geopackage(r.table, f"{out}/esquinas.gpkg", "esquinas")
    save_features(r.table, f"{out}/esquinas_por_linea")
    if collection:
        save_geojson(r.table, f"{out}/esquinas.geojson")
    save_documents(r, config, folder / "fichas")
    save_report(r, config, folder / "reporte.json")
    _put(folder / "run_metadata.json", metadata(r, config))
    _put(folder / "validation_report.json", r.report)


def main(argv: list[str] | None = None) -> None:
    import argparse

    from corvane.plans.config import load as load_config

    args = argparse.ArgumentParser(description="Score how dangerous street corners are for pedestrians.")
    args.add_argument("--config", default="config.yaml")
    args.add_argument("--raw", default="data/raw")
    args.add_argument("--out", default="data/processed")
    args.add_argument("--top", type=int, default=10)
    args.add_argument("--no-collection", action="store_true", help="keep features in parts only")
    a = args.parse_args(argv)
    began, spark, config = time.time(), SparkSession.builder.appName("corvane").config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate(), load_config(a.config)
    r = run(spark, config, a.raw)
    export(r, config, a.out, not a.no_collection)
    for row in r.table.orderBy(F.desc_nulls_last("indice"), "corner_ord").limit(a.top).select("corner_id", "calles", "comuna", "indice").collect():
        print(*row)
    print(f"{time.time() - began:.1f} s")


if __name__ == "__main__":
    main()
