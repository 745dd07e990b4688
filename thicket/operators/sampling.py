"""Spatially thinned samples: newest in each cell, and weighted cell quotas with a reservoir."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thicket.functions import scalars as fn
from thicket.operators.aggregate import with_cell
from thicket.sources.files import checkpoint

#: Rows of a cell that are ranked together, at most.
PIECE = 250_000


def newest() -> list[Column]:
    """Year, then month as it stands, newest first, missing last; ties by identifier."""
    return [F.col("y").desc_nulls_last(), F.col("m").desc_nulls_last(), F.col("gbifID").asc()]


def newest_per_cell(df: DataFrame, precision: int = 5, k: int = 6) -> DataFrame:
    """The k newest rows of each species and cell. Spark drops ranks above k before the shuffle too."""
    cell = Window.partitionBy("sci", "cell").orderBy(*newest())
    return with_cell(df, precision).withColumn("cell_rank", F.row_number().over(cell)).filter(F.col("cell_rank") <= max(1, k))


def cap_per_species(df: DataFrame, most: int = 700) -> DataFrame:
    """The newest rows of each species, most at most, with their rank. The input has a few rows for each cell only."""
    species = Window.partitionBy("sci").orderBy(*newest())
    return df.withColumn("rank", F.row_number().over(species)).filter(F.col("rank") <= max(1, most))


def sparse_sample(df: DataFrame, precision: int = 5, k: int = 6, most: int = 700) -> DataFrame:
    return cap_per_species(newest_per_cell(df, precision, k), most)


def weights(cells: DataFrame) -> DataFrame:
    """The square root of each cell's count in whole billionths, so that sums don't depend on their order."""
    return cells.withColumn("w", F.floor(F.sqrt(F.col("n").cast("double")) * 1e9).cast("bigint"))


def cell_quotas(cells: DataFrame, target: int = 900, least: int = 1, most: int = 30) -> DataFrame:
    """cells with w and q: the rounded share of the target (half to even), between least (if not 0) and most."""
    share = F.rint(F.lit(float(target)) * F.col("w") / F.sum("w").over(Window.partitionBy("sci"))).cast("bigint")
    q = F.least(F.when(share > 0, F.greatest(share, F.lit(max(0, least)))).otherwise(share), F.lit(max(1, most)))
    return weights(cells).withColumn("q", q.cast("bigint"))


def balanced_quotas(quotas: DataFrame, target: int = 900, least: int = 1, most: int = 30) -> DataFrame:
    """Quotas changed by one in rounds over cells, heaviest first, until they add up to the target.

    In closed form: the most whole rounds r that don't pass the target, for sums of quotas
    moved by r toward their floor or ceiling, and one step more for the first cells that
    can still move. Quotas are at most most, so that sums are taken over counts of equal
    quotas, most + 1 of a species at the outside, and cells are touched once. An unreachable
    target stops at the ceiling or floor of all cells.
    """
    least, most = max(0, least), max(1, most)
    long = lambda x: F.lit(x).cast("bigint")

    def moved(q: Column, r: Column, over: Column) -> Column:
        return F.when(over, F.greatest(q - r, F.least(q, long(least)))).otherwise(F.least(q + r, F.greatest(q, long(most))))

    equal = quotas.groupBy("sci", "q").agg(F.count(F.lit(1)).alias("c")).groupBy("sci").agg(F.collect_list(F.struct("q", "c")).alias("h"), (F.sum(F.col("q") * F.col("c")) > target).alias("over"))
    after = lambda r: F.aggregate("h", long(0), lambda a, x: a + x["c"] * moved(x["q"], r, F.col("over")))
    rounds = F.transform(F.sequence(long(0), long(most)), lambda r: F.struct(r.alias("r"), after(r).alias("s")))
    # downward the largest round that still reaches the target, upward the largest that doesn't pass it
    fits = F.filter(rounds, lambda x: F.when(F.col("over"), x["s"] >= target).otherwise(x["s"] <= target))
    chosen = equal.select(F.col("sci").alias("_sci"), "over", F.array_max(fits).alias("last")).select("_sci", "over", "last.r", "last.s")
    f = moved(F.col("q"), F.col("r"), F.col("over"))
    both = quotas.join(chosen, F.col("sci").eqNullSafe(F.col("_sci"))).withColumn("f", f)
    can = F.when(F.col("over"), F.col("f") > least).otherwise(F.col("f") < most)
    nth = F.sum(can.cast("int")).over(Window.partitionBy("sci").orderBy(F.desc("w"), "cell").rowsBetween(Window.unboundedPreceding, 0))
    step = (can & (nth <= F.abs(F.col("s") - target))).cast("int")
    return both.withColumn("_step", step).withColumn("quota", F.when(F.col("over"), F.col("f") - F.col("_step")).otherwise(F.col("f") + F.col("_step"))).select(*quotas.columns, "quota")


def cut_cells(rows: DataFrame, piece: int) -> tuple[DataFrame, DataFrame]:
    """rows with _cut, and _before, the number of a cell's rows in smaller cuts: sci, cell, _cut, _before.

    rows have sci, cell, gbifID and, of their cell, n, lo and hi (the range of its identifiers' places). Cells of more than
    piece rows are cut into equal ranges of identifiers, about a quarter of piece on average; ranges that still have more
    are cut again, until none has (identifiers that share a place stay together). Ranges are data, so that all reads of
    the rows agree. Only the rows of such cells are read for it, once for each level.
    """
    keys, depth = ["sci", "cell"], 1
    width = lambda n, lo, hi: F.expr(f"({hi} - {lo}) div cast(ceil(4 * {n} / {piece}) as bigint) + 1")
    rows = rows.withColumn("_place", fn.place_of(F.col("gbifID")))
    rows = rows.withColumn("_width", width("n", "lo", "hi"))
    rows = rows.withColumn("_cut", F.when(F.col("n") > piece, F.array(F.expr("(_place - lo) div _width"))).otherwise(F.array().cast("array<bigint>"))).drop("_width")
    counts = None
    while True:
        deep = rows.filter(F.size("_cut") == depth).groupBy(*keys, "_cut")
        found = checkpoint(deep.agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_lo"), F.max("_place").alias("_hi")))
        large = (F.col("_n") > piece) & (F.col("_hi") > F.col("_lo"))
        light = found.filter(~large).select(*keys, "_cut", "_n")
        counts = light if counts is None else counts.unionByName(light)
        again = found.filter(large)
        if again.isEmpty():
            break
        edges = again.select(*keys, "_cut", "_lo", width("_n", "_lo", "_hi").alias("_width"))
        rows = rows.join(edges, [*keys, "_cut"], "left").withColumn("_cut", F.when(F.col("_width").isNull(), F.col("_cut")).otherwise(F.concat("_cut", F.array(F.expr("(_place - _lo) div _width"))))).drop("_lo", "_width")
        depth += 1
    smaller = Window.partitionBy(*keys).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    return rows.drop("_place"), counts.select(*keys, "_cut", F.coalesce(F.sum("_n").over(smaller), F.lit(0)).alias("_before"))


def reservoir(df: DataFrame, quotas: DataFrame, piece: int = PIECE) -> DataFrame:
    """A deterministic reservoir sample of quota rows in each species and cell; df has cells.

    The nth row of a cell, by identifier, takes slot n - 1 while there are free ones, then a
    slot by hash modulo n if that is one; a slot keeps the last row it was given. No more than
    piece rows are ranked together: larger cells are cut by identifier, and ranks go on where
    the cut before ends. quotas may have lo and hi (cell_spans), else they are taken from df.
    """
    wanted = quotas.filter("quota > 0")
    if "lo" not in quotas.columns:
        wanted = wanted.select("sci", "cell", "w", "quota").join(cell_spans(df), ["sci", "cell"])
    wanted = checkpoint(wanted.select("sci", "cell", "w", "quota", "n", "lo", "hi"))
    rows = df.join(wanted, ["sci", "cell"])
    if wanted.filter(F.col("n") > piece).isEmpty():
        rows = rows.withColumn("seen", F.row_number().over(Window.partitionBy("sci", "cell").orderBy("gbifID")).cast("bigint"))
    else:
        rows, starts = cut_cells(rows, piece)
        within = F.row_number().over(Window.partitionBy("sci", "cell", "_cut").orderBy("gbifID"))
        rows = rows.join(starts, ["sci", "cell", "_cut"], "left").withColumn("seen", within + F.coalesce("_before", F.lit(0)))
    drawn = F.pmod(fn.stable_hash(F.col("sci"), F.col("cell"), F.col("seen"), F.col("gbifID")), F.col("seen"))
    rows = rows.withColumn("slot", F.when(F.col("seen") <= F.col("quota"), F.col("seen") - 1).otherwise(drawn).cast("bigint")).filter("slot < quota")
    point = F.struct("gbifID", "lat", "lon", "y", "m")
    return rows.groupBy("sci", "cell", "slot").agg(F.max_by(point, "seen").alias("p"), F.first("w").alias("w")).select("sci", "cell", "slot", "w", "p.*")


def cell_spans(celled: DataFrame) -> DataFrame:
    """sci, cell, n, lo, hi: the rows of each cell and the range of their identifiers' places."""
    place = fn.place_of(F.col("gbifID"))
    return celled.groupBy("sci", "cell").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("lo"), F.max(place).alias("hi"))


def quota_sample(celled: DataFrame, cells: DataFrame, target: int = 900, least: int = 1, most: int = 30, piece: int = PIECE) -> DataFrame:
    """The reservoir of all cells, by balanced quotas. cells: sci, cell, n, lo, hi; rows of species that have none are left out."""
    return reservoir(celled, balanced_quotas(cell_quotas(cells, target, least, most), target, least, most), piece)


def cut_to_target(sample: DataFrame, target: int = 900) -> DataFrame:
    """The reservoir, heaviest cells first, cut to the target, with ranks. It has some hundred rows a species."""
    species = Window.partitionBy("sci").orderBy(F.desc("w"), "cell", "slot")
    return sample.withColumn("rank", F.row_number().over(species)).filter(F.col("rank") <= target)


def stratified_sample(df: DataFrame, precision: int = 5, target: int = 900, least: int = 1, most: int = 30, piece: int = PIECE) -> DataFrame:
    """The reservoir of all cells, heaviest first, cut to the target, with ranks. df is read once for cells and once for rows."""
    celled = with_cell(df, precision)
    return cut_to_target(quota_sample(celled, checkpoint(cell_spans(celled)), target, least, most, piece), target)
