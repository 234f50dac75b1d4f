"""Interventions, street names, explanations and documents as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.text import whole

#: Each intervention's name, detail and priority.
INTERVENTIONS = {
    "shorten": ("Acortar el cruce", "Orejas de vereda (bulb-out) y/o isla de refugio para reducir los metros expuestos.", 3),
    "straighten": ("Enderezar el cruce", "Redemarcar sendas perpendiculares y ampliar la ochava para acortar y ordenar el paso.", 2),
    "signal": ("Instalar semáforo peatonal", "Semáforo con fase peatonal (idealmente con conteo regresivo).", 3),
    "calm": ("Calmar el tránsito", "Lomo de burro / reductor de velocidad o elevación del cruce.", 1),
}
NOTE = "Sin MAPBOX_TOKEN/STREETVIEW_API_KEY en .env todavía (ver .env.example); se completa en un build futuro."


def _is(name: str, value: float) -> Column:
    return F.coalesce(F.col(name) == value, F.lit(False))


def _some(name: str) -> Column:
    return F.coalesce(F.col(name) > 0, F.lit(False))


def high(axis: str, threshold: float) -> Column:
    return F.coalesce(F.col(f"{axis}_norm") >= threshold, F.lit(False))


def interventions(threshold: float = 0.75) -> Column:
    """array<struct<tipo, detalle, motivo, prioridad>>, most urgent first, from the raw and normalised axes."""
    school, crashes, flow = _is("near_school_raw", 1.0), _some("crash_history_raw"), high("ped_flow_proxy", threshold)
    boost = F.when(school | crashes, 2).otherwise(0)

    def proposal(key: str, when: Column, why: Column, order: int) -> Column:
        name, detail, priority = INTERVENTIONS[key]
        return F.when(when, F.struct((-(F.lit(priority) + boost)).alias("_p"), F.lit(order).alias("_o"), F.lit(name).alias("tipo"), F.lit(detail).alias("detalle"), why.alias("motivo"), (F.lit(priority) + boost).alias("prioridad")))

    length, angle = F.col("crossing_length_raw"), F.col("acute_angle_raw")
    reasons = F.array_join(F.array_compact(F.array(F.when(school, F.lit("a metros de una escuela")), F.when(crashes, F.concat(whole(F.col("crash_history_raw")), F.lit(" pts de siniestros"))), F.when(flow, F.lit("alto flujo peatonal")))), ", ")
    found = F.array(
        proposal("shorten", high("crossing_length", threshold) | high("roadway_width", threshold), F.when(length.isNotNull(), F.concat(F.lit("cruce peatonal de "), whole(length), F.lit(" m"))).otherwise("calzada ancha para cruzar"), 0),
        proposal("straighten", F.coalesce("is_diagonal", F.lit(False)) | high("acute_angle", threshold), F.when(angle.isNotNull(), F.concat(F.lit("cruce diagonal (desvío de "), whole(angle), F.lit("° respecto de 90°)"))).otherwise("cruce en ángulo agudo"), 1),
        proposal("signal", _is("has_ped_signal_raw", 0.0) & (school | crashes | flow), F.concat(F.lit("sin semáforo peatonal y "), reasons), 2),
        proposal("calm", _is("traffic_calming_raw", 0.0) & (school | _is("heavy_traffic_raw", 1.0)), F.when(school, F.lit("entorno escolar sin reductor")).otherwise("ruta de tránsito pesado sin reductor"), 3),
    )
    return F.transform(F.array_sort(F.array_compact(found)), lambda r: F.struct(r["tipo"].alias("tipo"), r["detalle"].alias("detalle"), r["motivo"].alias("motivo"), r["prioridad"].alias("prioridad")))


def street_names(branches: Column) -> Column:
    names = F.filter(F.transform(branches, lambda b: b["nomoficial"]), lambda n: F.coalesce(n != "", F.lit(False)))
    return F.array_join(F.array_distinct(names), ", ")


def explanation(excluded: list[str] | dict[str, str], school_m: float = 150, crash_m: float = 30) -> Column:
    """One sentence on a corner, clause by clause, and one on the axes without data."""
    some = lambda name: F.coalesce(F.col(name) == 1.0, F.lit(False))
    angle, length, crash, signal = (F.col(f"{c}_raw") for c in ("acute_angle", "crossing_length", "crash_history", "has_ped_signal"))
    clauses = F.array(
        F.concat(F.lit("Esquina de "), F.col("n_branches").cast("int").cast("string"), F.lit(" ramales"), F.when(F.coalesce("calles", F.lit("")) != "", F.concat(F.lit(" ("), F.col("calles"), F.lit(")"))).otherwise("")),
        F.when(F.coalesce("is_diagonal", F.lit(False)), F.when(angle.isNotNull(), F.concat(F.lit("con cruce en ángulo agudo (desvío de "), whole(angle), F.lit("° respecto de 90°)"))).otherwise("con cruce en ángulo diagonal")),
        F.when(length.isNotNull(), F.concat(F.lit("con un cruce peatonal más largo de "), whole(length), F.lit(" m"))),
        F.when(some("near_school_raw"), F.lit(f"a menos de {int(school_m)} m de un establecimiento educativo")),
        F.when(_some("crash_history_raw"), F.concat(F.lit(f"con historial de siniestros con víctimas en un radio de {int(crash_m)} m (score de gravedad "), whole(crash), F.lit(")"))),
        F.when(some("heavy_traffic_raw"), F.lit("sobre la red de tránsito pesado (camiones)")),
        F.when(signal.isNotNull(), F.when(signal == 1.0, F.lit("con semáforo peatonal cercano")).otherwise("sin semáforo peatonal cercano")),
        F.when(some("traffic_calming_raw"), F.lit("con reductor de velocidad/oreja de vereda cercano")),
        F.when(some("on_sendero_escolar"), F.lit("sobre un sendero escolar")),
        F.when(some("near_ciclovia"), F.lit("con ciclovía en la esquina")),
    )
    tail = f" Ejes sin datos todavía en este scope: {', '.join(sorted(excluded))}." if excluded else ""
    return F.concat(F.array_join(F.array_compact(clauses), ", "), F.lit("." + tail))


def ficha(axes: list[str], excluded: dict[str, str] | list[str], threshold: float, school_m: float, crash_m: float) -> Column:
    """The nested document of one corner."""
    part = lambda a: F.struct(F.col(f"{a}_raw").alias("raw"), F.col(f"{a}_norm").alias("normalizado"), F.lit(a not in excluded).alias("disponible")).alias(a)
    flag = lambda c: (F.col(c) != 0.0).alias(c)
    null = F.lit(None).cast("string")
    return F.struct(
        "corner_id", F.col("comuna").cast("int").alias("comuna"), "barrio", F.struct("lat", "lon").alias("ubicacion"), F.coalesce("calles", F.lit("")).alias("calles"), F.col("n_branches").cast("int").alias("n_branches"), "is_diagonal",
        F.col("indice").alias("indice_compuesto"), "indice_comuna", "riesgo_bruto", F.struct(*map(part, sorted(axes))).alias("desglose_por_eje"), F.struct(flag("on_sendero_escolar"), flag("near_ciclovia")).alias("contexto"),
        interventions(threshold).alias("intervenciones"), explanation(excluded, school_m, crash_m).alias("texto_explicativo"), F.struct(null.alias("satelital"), null.alias("street_view"), F.lit(NOTE).alias("nota")).alias("imagenes"),
    )


def fichas(table: DataFrame, axes: list[str], excluded: dict[str, str], threshold: float, school_m: float, crash_m: float, top_n: int | None) -> DataFrame:
    """(place, corner_id, ficha as JSON); only the best ``top_n`` are cut out before any document is made."""
    best = table.orderBy(F.desc_nulls_last("indice"), "corner_ord").limit(top_n) if top_n else table
    return best.select("indice", "corner_ord", "corner_id", F.to_json(ficha(axes, excluded, threshold, school_m, crash_m), {"ignoreNullFields": "false"}).alias("ficha"))
