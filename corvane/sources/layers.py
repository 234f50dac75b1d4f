"""Open-data layers as DataFrames: GeoJSON and CSV points, reprojected, with shapes in metres."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import crs, projections
from corvane.functions import geometry as g
from corvane.functions.text import folded_equal, number, repair
from corvane.operators import outline
from corvane.operators.proximity import crossing, intersects_box, near_any, within
from corvane.sources import geojson, shapefile
from corvane.storage import materialise

_STREET = {k: "string" for k in ("nomoficial", "tipo_c", "sentido", "bicisenda", "red_jerarq", "barrio", "barrio_par", "barrio_imp")} | {k: "double" for k in ("comuna", "com_par", "com_impar")}
#: Each layer's file, kind and properties.
CATALOG: dict[str, dict] = {
    "callejero": {"file": "callejero.geojson", "kind": "latin1", "properties": _STREET},
    "cruces_semaforizados": {"file": "cruces-semaforizados.geojson", "kind": "latin1"},
    "semaforos": {"file": "semaforos.csv", "kind": "csv"},
    "ampliaciones_veredas": {"file": "ampliaciones_de_veredas.geojson", "kind": "latin1"},
    "veredas": {"file": "veredas-2019.geojson", "kind": "utf8", "properties": {"COMUNA": "int"}},
    "escuelas": {"file": "establecimientos_educativos.geojson", "kind": "latin1"},
    "siniestros": {"file": "siniestros_viales_hechos.csv", "kind": "csv", "sep": ";", "lon": "longitud_siniestro", "lat": "latitud_siniestro"},
    "paradas": {"file": "colectivos_caba_paradas.json", "kind": "latin1"},
    "subte": {"file": "estaciones_de_subte.json", "kind": "latin1"},
    "ferrocarril": {"file": "estaciones_ferroviarias.json", "kind": "latin1"},
    "transito_pesado": {"file": "red_de_transito_pesado.json", "kind": "latin1"},
    "senderos_escolares": {"file": "senderos_escolares.json", "kind": "latin1"},
    "ciclovias": {"file": "ciclovias.json", "kind": "latin1"},
    "censo": {"file": "censo.shp", "kind": "shapefile"},
    "sendas_peatonales": {"file": "sendas_peatonales.geojson", "kind": "latin1"},
}


@dataclass
class Layers:
    """Layers at hand, and why others are not."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    unavailable: dict[str, str] = field(default_factory=dict)

    def usable(self) -> dict[str, DataFrame]:
        """Layers with at least one row."""
        return {k: df for k, df in self.tables.items() if not df.isEmpty()}


def _systems(codes: set[int | None]) -> dict[int, projections.System]:
    found = {c: projections.system(c) for c in codes}
    if unknown := sorted(str(c) for c, s in found.items() if s is None):
        raise ValueError(f"unknown coordinate system: {unknown}")
    return found


def _lonlat(p: Column, epsg: Column, systems: dict[int, projections.System]) -> Column:
    """A coordinate pair as degrees, whatever of the layer's systems it was given in."""
    out = F.when(F.lit(False), F.struct(p[0].alias("lon"), p[1].alias("lat")))
    for code, system in systems.items():
        out = out.when(epsg == code, projections.to_degrees(p[0], p[1], system))
    return out


def _metric(p: Column) -> Column:
    return crs.projected(p["lon"], p["lat"])


def read_geojson(spark: SparkSession, path: str, latin1: bool = True, properties: dict[str, str] | None = None) -> DataFrame:
    """(ord, part, geom_type, rings in degrees, points and shape in metres, area, epsg, properties); a part per polygon of a multipolygon."""
    kinds = {k: T._parse_datatype_string(v) for k, v in (properties or {}).items()}
    feature = T.StructType([T.StructField("geometry", T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])), T.StructField("properties", T.StructType([T.StructField(k, v) for k, v in kinds.items()] or [T.StructField("_none", T.StringType())]))])
    found, ranges, named = geojson.read(spark, path)
    systems = _systems({crs.code_of(x) for x in named})
    # All tasks parse, however few ranges the file has.
    tasks = spark.sparkContext.defaultParallelism
    found = found if ranges >= tasks else found.repartition(tasks, "ord")
    text = F.decode("text", "ISO-8859-1" if latin1 else "UTF-8")
    rows = found.select("ord", crs.epsg_of(F.col("system")).alias("epsg"), F.from_json(text, feature, {"mode": "FAILFAST"}).alias("f"))
    kind, raw = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    line, polygon = "array<array<double>>", "array<array<array<double>>>"
    parts = (
        F.when(kind == "Point", F.array(F.array(F.array(F.from_json(raw, "array<double>")))))
        .when(kind == "MultiPoint", F.array(F.transform(F.from_json(raw, line), lambda p: F.array(p))))
        .when(kind == "LineString", F.array(F.array(F.from_json(raw, line))))
        .when(kind.isin("MultiLineString", "Polygon"), F.array(F.from_json(raw, polygon)))
        .when(kind == "MultiPolygon", F.from_json(raw, "array<array<array<array<double>>>>"))
    )
    out = rows.select("ord", "epsg", kind.alias("geom_type"), F.posexplode_outer(parts).alias("part", "rings"), *(F.col(f"f.properties.{k}").alias(k) for k in kinds))
    if latin1:
        out = out.withColumns({k: repair(F.col(k)) for k, v in kinds.items() if isinstance(v, T.StringType)})
    return _measured(out, list(kinds), systems)


def _measured(rows: DataFrame, properties: list[str], systems: dict[int, projections.System]) -> DataFrame:
    """A layer of rows (ord, part, geom_type, epsg, rings as given, and properties): rings in degrees and metres, and their segments."""
    out = rows.withColumn("rings", F.transform("rings", lambda ring: F.transform(ring, lambda p: _lonlat(p, F.col("epsg"), systems))))
    metric = out.withColumn("m", F.transform("rings", lambda ring: F.transform(ring, _metric)))
    shape = F.flatten(F.transform("m", g.path))
    outline = F.flatten(F.transform("rings", lambda ring: g.path(F.transform(ring, lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y"))))))
    return metric.select(F.col("ord").cast("long").alias("ord"), "part", "geom_type", F.col("rings")[0].alias("lonlat"), F.col("m")[0].alias("points"), shape.alias("shape"), outline.alias("outline"), F.coalesce(F.col("geom_type").isin("Polygon", "MultiPolygon"), F.lit(False)).alias("area"), "epsg", *(F.col(f"`{c}`") for c in properties))


def read_shapefile(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_geojson``, with the attributes of the table beside the file."""
    rows, attributes = shapefile.read(spark, path)
    code = shapefile.epsg(spark, path)
    return _measured(rows.withColumn("epsg", F.lit(code).cast("int")), attributes, _systems({code}))


def read_csv_points(spark: SparkSession, path: str, lon: str = "long", lat: str = "lat", sep: str = ",") -> DataFrame:
    """All columns as text, with ``shape`` in metres; rows without numbers for a place go.

    One pass over the file's ranges tells its encoding, as a character is never cut by the end of a line, and whether line breaks
    stand in quotes. Only then a file is read by one task, as such a break looks like the end of a row.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    utf8, within = spark.read.text(path).select(F.bool_and(F.is_valid_utf8("value")), F.bool_or(quotes % 2 == 1)).first()
    raw = spark.read.csv(path, header=True, sep=sep, encoding="UTF-8" if utf8 in (True, None) else "ISO-8859-1", multiLine=bool(within), quote='"', escape='"')
    x, y = number(F.col(f"`{lon}`")), number(F.col(f"`{lat}`"))
    mx, my = crs.project(x, y)
    return raw.filter(x.isNotNull() & y.isNotNull()).withColumns({"geom_type": F.lit("Point"), "lonlat": F.array(F.struct(x.alias("lon"), y.alias("lat"))), "shape": g.point(mx, my), "area": F.lit(False)})


def read_layer(spark: SparkSession, path: str, spec: dict) -> DataFrame:
    if spec["kind"] == "csv":
        return read_csv_points(spark, path, spec.get("lon", "long"), spec.get("lat", "lat"), spec.get("sep", ","))
    if spec["kind"] in ("latin1", "utf8", "shapefile"):
        return materialise(read_shapefile(spark, path) if spec["kind"] == "shapefile" else read_geojson(spark, path, spec["kind"] == "latin1", spec.get("properties")))
    raise ValueError(f"no reader for {spec['kind']}")


def load_all(spark: SparkSession, folder: str, catalog: dict[str, dict] | None = None) -> Layers:
    """Every layer that can be read; a missing or broken file only marks its own layer."""
    found = Layers()
    for name, spec in (catalog or CATALOG).items():
        path = f"{folder}/{spec['file']}"
        try:
            # Readers are lazy; broken files are to show here, and each file is parsed once.
            df = read_layer(spark, path, spec)
            found.tables[name] = df if spec["kind"] != "csv" else materialise(df)
        except Exception as e:
            absent = "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e)
            found.unavailable[name] = f"archivo no encontrado: {spec['file']}" if absent else f"error al cargar {spec['file']}: {str(e).splitlines()[0]}"
    return found


def crop_streets(streets: DataFrame, scope: dict) -> DataFrame:
    mode = scope["mode"]
    if mode == "all":
        return streets
    if mode == "comuna":
        same = [F.coalesce(F.col(c) == float(scope["comuna"]), F.lit(False)) for c in ("comuna", "com_par", "com_impar")]
    elif mode == "barrio":
        same = [folded_equal(F.col(c), scope["barrio"]) for c in ("barrio", "barrio_par", "barrio_imp")]
    elif mode == "bbox":
        return crop_box(streets, scope["bbox"])
    else:
        raise ValueError(f"unknown scope mode: {mode!r}")
    return streets.filter(same[0] | same[1] | same[2])


def scope_outline(streets: DataFrame | None, scope: dict, degrees: float = 1.0) -> DataFrame | None:
    """The scope's border as edges (x1, y1, x2, y2) in metres with their ends in degrees (lon1, lat1, lon2, lat2): the box, or all within ``buffer_m`` of its streets; none if all is in scope or it has no streets.

    Inside is what the even-odd rule says. Edges are rows; ``outline.rings`` ties them where rings are wanted.
    """
    if scope["mode"] == "all":
        return None
    if scope["mode"] == "bbox":
        w, s, e, n = map(float, scope["bbox"])
        ends = streets.sparkSession.createDataFrame([(w, s, e, s), (e, s, e, n), (e, n, w, n), (w, n, w, s)], "lon1 double, lat1 double, lon2 double, lat2 double")
        both = ends.withColumn("a", crs.projected(F.col("lon1"), F.col("lat1"))).withColumn("b", crs.projected(F.col("lon2"), F.col("lat2")))
        return both.select(F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"), "lon1", "lat1", "lon2", "lat2")
    if streets is None or streets.isEmpty():
        return None
    border = outline.edges(outline.pieces(streets.select(F.inline("shape")), scope["buffer_m"]), scope["buffer_m"], degrees)
    both = border.withColumn("a", crs.unprojected(F.col("x1"), F.col("y1"))).withColumn("b", crs.unprojected(F.col("x2"), F.col("y2")))
    return both.select("x1", "y1", "x2", "y2", F.col("a.lon").alias("lon1"), F.col("a.lat").alias("lat1"), F.col("b.lon").alias("lon2"), F.col("b.lat").alias("lat2"))


def crop_near(layer: DataFrame, streets: DataFrame, buffer_m: float) -> DataFrame:
    """Rows of a layer within ``buffer_m`` of any street of the scope.

    Two segments that meet have no distance; that of others is the distance of an end of one to the other.
    """
    if "area" not in layer.columns:
        return near_any(layer, streets, buffer_m)
    areas = layer.filter("area")
    rest = near_any(layer.filter(~F.coalesce("area", F.lit(False))), streets, buffer_m)
    return rest if areas.isEmpty() else rest.unionAll(_areas_near(areas, streets, buffer_m))


def _areas_near(layer: DataFrame, streets: DataFrame, buffer_m: float) -> DataFrame:
    """Areas that a street is in or near, by a semi-join of their segments on the grid."""
    rows = layer.withColumn("_row", F.xxhash64(F.to_json(F.struct(*[c for c in layer.columns if c != "shape"])), F.to_json("shape")))
    corners = lambda s: F.array(F.struct(s["x1"].alias("x"), s["y1"].alias("y")), F.struct(s["x2"].alias("x"), s["y2"].alias("y")))
    ends = rows.select(F.col("_row").alias("key"), F.explode(F.array_distinct(F.flatten(F.transform("shape", corners)))).alias("p")).select("key", "p.x", "p.y")
    near = within(ends, streets.select("shape"), buffer_m).select("key")
    street_ends = streets.select(F.explode(F.array_distinct(F.flatten(F.transform("shape", corners)))).alias("p")).select(F.lit(0).alias("key"), "p.x", "p.y").distinct()
    back = within(street_ends, rows.select("_row", "shape", "area"), buffer_m).select(F.col("_row").alias("key"))
    through = crossing(rows.select(F.col("_row").alias("key"), F.inline("shape")), streets.select(F.inline("shape")), max(float(buffer_m), 1.0))
    hit = near.unionAll(back).unionAll(through).select(F.col("key").alias("_row")).distinct()
    return rows.join(hit, "_row", "left_semi").drop("_row")


def crop_box(layer: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows of a layer that touch a box of degrees: all lines of a part count, and areas that hold the box."""
    outline = F.col("outline") if "outline" in layer.columns else g.path(F.transform("lonlat", lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y"))))
    return layer.filter(intersects_box(outline, box, F.col("area") if "area" in layer.columns else None))


def load(spark: SparkSession, folder: str, scope: dict) -> Layers:
    """All layers, cropped to the scope. Streets must be there."""
    found = load_all(spark, folder)
    if "callejero" not in found.tables:
        raise FileNotFoundError(found.unavailable["callejero"])
    streets = found.tables["callejero"] = crop_streets(found.tables["callejero"], scope)
    if scope["mode"] == "all":
        return found
    for name, df in found.tables.items():
        if name == "callejero":
            continue
        if name == "veredas" and scope["mode"] == "comuna":
            found.tables[name] = df.filter(F.col("COMUNA") == int(scope["comuna"]))
        elif scope["mode"] == "bbox":
            found.tables[name] = crop_box(df, scope["bbox"])
        else:
            found.tables[name] = crop_near(df, streets, scope["buffer_m"])
    return found
