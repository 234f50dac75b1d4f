"""Mixing sources to target weights by Pareto order sampling.

Every source gets a share of all words by its weight, at most ``most_copies`` times its own
words; what that cuts off is shared again among the others. Inside a source documents have unequal chances: the
expected number of copies of one with n words grows with ``(1 + floor(log2 n)) ** length_power``, up to ``most_copies``, at the
level that meets the source's target. The whole part of that number is allotted for
certain; for the rest, its chance p, documents are ranked by random odds over inclusion odds,
u (1 - p) / ((1 - u) p), and the first in that order are taken up to the place where their words come
nearest to what is missing, so the sample has a fixed size in words.

No source is sorted as a whole: ranks are summed up in buckets first, and only the one bucket
in which a source's cut falls is ordered row by row. Texts are never shuffled: what they need is a table of at most
64 rows a source, which is broadcast if it is small, and else joined with every row's salt, so that no source is a join key of its own.

Defined results: null texts count as no words; null sources form the last source; a document
of no words and sources of no words take part with nothing taken; rows with equal id and text share their
random number and so their fate; an empty table gives an empty result; other columns are
carried along untouched by ``apply_mix`` whatever their names and are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm._storage import materialise

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 1 << 14
#: Rows of a table that is broadcast, at most; they are of some hundred bytes.
BROADCAST_ROWS = 20_000
SALTS = 64


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, their number from 0 in the order of code points, null last; ranges are counted, so no task sees all of them."""
    ranged = sources.withColumn("none", F.col("source").isNull()).repartitionByRange("none", "source").withColumn("part", F.spark_partition_id())
    ranged = materialise(ranged.withColumn("within", F.row_number().over(Window.partitionBy("part").orderBy("none", "source"))))
    sizes = {r[0]: r[1] for r in ranged.groupBy("part").count().collect()}  # one row a partition
    before, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        before.append(F.lit(total))
        total += sizes.get(part, 0)
    return ranged.withColumn("place", F.get(F.array(*before), F.col("part")) + F.col("within") - 1 if before else F.lit(0)).drop("none", "part", "within")


def targets(by_source: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most_copies: int = 3) -> DataFrame:
    """``by_source`` (source, source_size) with its ``target``."""
    w = _numbered(by_source)
    w = w.withColumn("weight", F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.col("place") % len(weights) + 1).cast("int"))).withColumn("bound", (F.lit(most_copies) * F.col("source_size")).cast("double"))
    w = materialise(w.drop("place"))
    level, last = 0.0, -1.0
    # Sources that are above their bound at a level give the rest to the others, which raises the level.
    while level > last:
        last = level
        over = F.col("bound") <= F.lit(level) * F.col("weight")
        total, taken, free = w.agg(F.sum("source_size"), F.sum(F.when(over, F.col("bound"))), F.sum(F.when(~over, F.col("weight")))).first()
        level = ((total or 0) - (taken or 0.0)) / free if free else last
    return w.select("source", "source_size", F.least(F.col("bound"), F.lit(level) * F.col("weight")).alias("target"))


def chances(by_class: DataFrame, by_source: DataFrame, most_copies: int, length_power: float) -> DataFrame:
    """(source, class, source_size, target, copies, p) for the words of each class of lengths (source, class, words); a source has at most 64."""
    c = by_class.join(by_source.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    c = c.withColumn("appeal", F.when(F.col("class") >= 0, F.pow(1.0 + F.col("class"), F.lit(float(length_power)))).otherwise(0.0))
    of = Window.partitionBy("source")
    rest, before = of.orderBy(F.desc("appeal"), "class").rowsBetween(0, Window.unboundedFollowing), of.orderBy(F.desc("appeal"), "class").rowsBetween(Window.unboundedPreceding, -1)
    # The level if all classes of more appeal are at the bound; the first that is not beyond it sets the level for all.
    level = (F.col("target") - most_copies * F.coalesce(F.sum("words").over(before), F.lit(0))) / F.nullif(F.sum(F.col("words") * F.col("appeal")).over(rest), F.lit(0.0))
    c = c.withColumn("level", level).withColumn("free", F.coalesce(F.col("level") * F.col("appeal") <= most_copies, F.lit(False)))
    c = c.withColumn("level", F.max(F.when(F.col("free"), F.struct("appeal", -F.col("class"), "level"))).over(of)["level"])
    expected = F.when(F.col("words") > 0, F.least(F.lit(float(most_copies)), F.coalesce(F.col("level") * F.col("appeal"), F.lit(float(most_copies))))).otherwise(0.0)
    c = c.withColumn("expected", F.when(F.abs(expected - F.round(expected)) < 1e-9, F.round(expected)).otherwise(expected))
    return c.select("source", "class", "words", "source_size", "target", F.floor("expected").alias("copies"), (F.col("expected") - F.floor("expected")).alias("p"))


def _uniform(seed: int) -> Column:
    """In (0, 1), from the seed, id and text alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col("text"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def _attach(rows: DataFrame, table: DataFrame, n: int) -> DataFrame:
    """Rows with what the table of ``n`` rows says of their source and class."""
    keys = [c for c in ("source", "class") if c in table.columns]
    other = table.toDF(*(f"of_{c}" if c in keys else c for c in table.columns))
    on = F.lit(True)
    for c in keys:
        on = on & rows[c].eqNullSafe(F.col(f"of_{c}"))
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(other), on).drop(*(f"of_{c}" for c in keys))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("u"), F.lit(SALTS)))
    spread = other.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, on & (F.col("salt") == F.col("of_salt"))).drop("salt", "of_salt", *(f"of_{c}" for c in keys))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), most_copies: int = 3, seed: int = 17, length_power: float = 0.5) -> DataFrame:
    """(row, size, source, source_size, target, n_copies, taken) for each document; ``row`` is the whole input row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row")[text_col].cast("string")
    sized = rows.select("row", F.col("row")[source_col].alias("source"), F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long").alias("size"), F.col("row")[id_col].alias("id"), text.alias("text"))
    drawn = sized.withColumn("u", _uniform(seed)).drop("id", "text").withColumn("class", F.when(F.col("size") > 0, F.floor(F.log2("size"))).otherwise(-1).cast("int"))
    light = materialise(drawn.select("source", "class", "size", "u"))
    by_class = materialise(light.groupBy("source", "class").agg(F.sum("size").alias("words")))
    goals = targets(by_class.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most_copies)
    bins = materialise(chances(by_class, goals, most_copies, length_power))
    n_bins = bins.count()
    missing = bins.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("words"))).alias("missing"))
    n_sources = missing.count()
    ranked = _rank(_attach(light, bins.select("source", "class", "p").filter("p > 0"), n_bins))
    # Rows of a source are added up bucket by bucket, so this stays small for any number of documents.
    sums = _attach(ranked.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.min("u").alias("u")), missing, n_sources)
    upto = Window.partitionBy("source").orderBy("bucket")
    sums = sums.withColumn("upto", F.sum("words").over(upto)).withColumn("base", F.col("upto") - F.col("words"))
    cut = sums.filter((F.col("base") < F.col("missing")) & (F.col("upto") >= F.col("missing"))).groupBy("source").agg(F.min_by(F.struct(F.col("bucket").alias("cut_bucket"), "base", "missing"), "bucket").alias("c")).select("source", "c.*")
    cut = materialise(cut)
    inside = _attach(ranked, cut, n_sources).filter("bucket = cut_bucket")
    run = Window.partitionBy("source").orderBy("rank").rangeBetween(Window.unboundedPreceding, 0)
    gap = F.abs(F.col("base") + F.sum("size").over(run) - F.col("missing"))
    best = inside.withColumn("gap", gap).groupBy("source").agg(F.min(F.struct("gap", "rank")).alias("b"), F.first(F.abs(F.col("base") - F.col("missing"))).alias("none"))
    best = best.select(F.col("source").alias("t"), F.when(F.col("b.gap") < F.col("none"), F.col("b.rank")).otherwise(-1.0).alias("last"))
    cut = cut.select(F.col("source").alias("s"), "cut_bucket").join(best, F.col("s").eqNullSafe(F.col("t"))).drop("t")
    fates = missing.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select(F.col("source").alias("s"), "missing", "cut_bucket", "last")
    fates = materialise(bins.join(fates, F.col("source").eqNullSafe(F.col("s"))).select("source", "class", "source_size", "target", "copies", "p", "missing", "cut_bucket", "last"))
    out = _rank(_attach(drawn, fates, n_bins))
    # A source without a cut misses nothing beyond its whole copies, or all that it has.
    more = F.when(F.col("cut_bucket").isNull(), F.col("missing") > 0).otherwise((F.col("bucket") < F.col("cut_bucket")) | (F.col("bucket") == F.col("cut_bucket")) & (F.col("rank") <= F.col("last")))
    n = F.col("copies") + F.when((F.col("p") > 0) & more, 1).otherwise(0)
    return out.withColumn("n_copies", n).select("row", "size", "source", "source_size", "target", "n_copies", (F.col("size") * F.col("n_copies")).alias("taken"))


def _rank(rows: DataFrame) -> DataFrame:
    """Pareto ranks: odds of the random number over odds of inclusion, and the bucket in their order."""
    rank = F.when(F.col("p") > 0, (F.col("u") / (1.0 - F.col("u"))) * ((1.0 - F.col("p")) / F.col("p"))).otherwise(F.col("u") / (1.0 - F.col("u")))
    return rows.withColumn("rank", rank).withColumn("bucket", F.floor(F.col("rank") / (1.0 + F.col("rank")) * BUCKETS).cast("int"))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each input row as often as the mix takes it."""
    taken = mix(docs, **options).filter(F.col("n_copies") > 0)
    return taken.select(F.explode(F.array_repeat("row", F.col("n_copies").cast("int"))).alias("row")).select("row.*")


def digest(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "text", "source")).select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "n_copies")
