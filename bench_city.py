"""Times the whole run on a made city: layers as files, read, cropped, scored, validated and exported. One JSON line; the city is synthetic.

CITY_SIDE is the number of streets each way (124 gives some 15,200 corners), BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import math
import os
import random
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

LON, LAT = -58.53, -34.70
CONFIG = {
    "scope": {"mode": "all"}, "corner_definition": "all_intersections", "node_merge_threshold_m": 25, "angle_normal_range": [70, 110], "normalization": "percentile",
    "radii": {"school_radius_m": 150, "crash_radius_m": 30, "ped_flow_radius_m": 100, "ped_signal_radius_m": 30, "traffic_calming_radius_m": 40, "heavy_traffic_radius_m": 20},
    "weights": {"geometry": {"crossing_length": 1.0, "n_branches": 0.8, "acute_angle": 0.7, "roadway_width": 0.9, "no_refuge": 1.0, "speed_limit": 1.0}, "mitigation": {"has_ped_signal": 0.6, "traffic_calming": 0.5, "crossing_marked": 0.4}, "exposure": {"near_school": 1.0, "crash_history": 1.5, "ped_flow_proxy": 0.7, "heavy_traffic": 0.5}},
    "axis_normalization": {"crash_history": "zero_inflated", "ped_flow_proxy": "zero_inflated"}, "report": {"top_n": 100, "fichas_top_n": 200},
}


def write_city(folder: Path, side: int, block: float = 110.0) -> None:
    """A grid of streets with sidewalks about the blocks; as many crashes, schools, stops and so on as the real city has."""
    draw, folder = random.Random(7), Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    place = lambda x, y: [LON + x / (111320 * math.cos(math.radians(LAT))), LAT + y / 110940]
    jitter = [[(i * block + draw.uniform(-8, 8), j * block + draw.uniform(-8, 8)) for j in range(side)] for i in range(side)]
    feature = lambda kind, at, **p: {"type": "Feature", "properties": p, "geometry": {"type": kind, "coordinates": at}}

    def put(name: str, features: list) -> None:
        (folder / name).write_text(json.dumps({"type": "FeatureCollection", "features": features}), encoding="utf-8")

    streets = []
    for i in range(side):
        for j in range(side):
            for a, b, name in ((i + 1, j, f"H{j}"), (i, j + 1, f"V{i}")):
                if a < side and b < side:
                    streets.append(feature("LineString", [place(*jitter[i][j]), place(*jitter[a][b])], nomoficial=name, tipo_c="AVENIDA" if (i if name[0] == "V" else j) % 8 == 0 else "CALLE", comuna=float(1 + i * 15 // side), barrio=f"B{j * 48 // side}"))
    put("callejero.geojson", streets)
    inset = lambda p, dx, dy: place(p[0] + dx, p[1] + dy)
    walks = []
    for i in range(side - 1):
        for j in range(side - 1):
            w = draw.choice((4, 5, 6, 9))
            ring = [inset(jitter[i][j], w, w), inset(jitter[i + 1][j], -w, w), inset(jitter[i + 1][j + 1], -w, -w), inset(jitter[i][j + 1], w, -w)]
            walks.append(feature("Polygon", [[*ring, ring[0]]], COMUNA=1 + i * 15 // side))
    put("veredas-2019.geojson", walks)
    length = side * block
    anywhere = lambda: place(draw.uniform(0, length), draw.uniform(0, length))
    at_corner = lambda: (lambda p: place(p[0] + draw.gauss(0, 12), p[1] + draw.gauss(0, 12)))(draw.choice(draw.choice(jitter)))
    for name, n in (("establecimientos_educativos.geojson", 2767), ("colectivos_caba_paradas.json", 6951), ("estaciones_de_subte.json", 90), ("estaciones_ferroviarias.json", 43), ("cruces-semaforizados.geojson", 4000), ("ampliaciones_de_veredas.geojson", 21)):
        put(name, [feature("Point", at_corner()) for _ in range(n)])
    for name, n in (("red_de_transito_pesado.json", 2009), ("senderos_escolares.json", 392), ("ciclovias.json", 2764)):
        lines = []
        for _ in range(n):
            i, j = draw.randrange(side - 1), draw.randrange(side)
            lines.append(feature("LineString", [place(*jitter[i][j]), place(*jitter[i + 1][j])]))
        put(name, lines)
    rows = ["longitud_siniestro;latitud_siniestro;gravedad_siniestro;anio_siniestro"]
    for k in range(65818):
        lon, lat = at_corner() if k % 3 else anywhere()
        rows.append(f"{lon};{lat};{draw.choice(('LEVE', 'LEVE', 'GRAVE', 'MORTAL'))};{2019 + k % 7}")
    (folder / "siniestros_viales_hechos.csv").write_text("\n".join(rows) + "\n", encoding="utf-8")


def measure(spark: SparkSession, side: int) -> dict:
    """Seconds of the whole run on a city of so many streets each way; writing the city's files is not counted."""
    from corvane.plans import config, risk

    with tempfile.TemporaryDirectory() as folder:
        write_city(Path(folder) / "raw", side)
        settings = config.parse(CONFIG)
        began = time.time()
        r = risk.run(spark, settings, f"{folder}/raw")
        scored = time.time()
        risk.export(r, settings, f"{folder}/out")
        ended, corners = time.time(), r.table.count()
        rho = r.report["spearman_indice_compuesto_vs_siniestros"]["rho"]
    return {"seconds": round(ended - began, 1), "scored_after": round(scored - began, 1), "corners": corners, "corners_per_sec": round(corners / (ended - began), 1), "rho": rho, "synthetic": True}


def main() -> None:
    cpus, side = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("CITY_SIDE", "124"))
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    print(json.dumps({"metric": "whole_run", "cpus": cpus} | measure(spark, side)))


if __name__ == "__main__":
    main()
