"""Rasters as cell tables: (raster_id, r, c, value) with one header row per raster.

Headers have ``left_x, top_y, cell_width, cell_height (negative), n_rows, n_cols, nodata``.
Work is keyed by cell or by bin, never gathered per raster: a raster may hold most of the cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.functions.columns import nearly_equal

NODATA_TOLERANCE = 0.001
# more bins than this come from a fill value that was not masked
MOST_BINS = 10_000_000


def mask_nodata(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """Cells that hold a value. A raster minimum within 0.1 % of the declared nodata counts as nodata."""
    lowest = cells.filter(~F.isnan("value")).groupBy("raster_id").agg(F.min("value").alias("lowest"))
    declared = headers.select("raster_id", "nodata").join(lowest, "raster_id")
    close = nearly_equal(F.col("lowest"), F.col("nodata"), rel=NODATA_TOLERANCE)
    marks = declared.select("raster_id", F.when(close, F.col("lowest")).otherwise(F.col("nodata")).alias("mark"))
    valid = F.col("value").isNotNull() & ~F.isnan("value") & ~F.col("value").eqNullSafe(F.col("mark"))
    return cells.join(marks, "raster_id").filter(valid).drop("mark")


def bin_continuous(cells: DataFrame, width: float = 100, float32: bool = False) -> DataFrame:
    """Fixed-width histogram of each raster, empty bins included, with min, max and value count.

    Edges run from ``floor(min/width)*width`` to ``ceil(max/width)*width``; the last bin includes its
    upper edge. A raster whose only value is a multiple of the width has no bins (``bin`` is NULL)
    but a value count. Rasters without values give no row; NULL and NaN are no values. A range of more
    than ``MOST_BINS`` bins is an error.

    Cells are counted per bin first, min and max included, so the second step sees bins only.
    """
    value = F.col("value").cast("float").cast("double") if float32 else F.col("value")
    counted = (
        cells.withColumn("value", value)
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("raster_id", F.floor(F.col("value") / width).alias("i"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    )
    heads = counted.groupBy("raster_id").agg(F.min("lo").alias("min"), F.max("hi").alias("max"), F.sum("n").alias("value_count"))
    first, last = F.floor(F.col("min") / width), F.ceil(F.col("max") / width) - 1
    dense = heads.withColumn("last", last).withColumn("i", F.explode_outer(F.when(last - first >= MOST_BINS, F.raise_error(F.lit("the range of a raster has too many bins; is a fill value left?"))).when(last >= first, F.sequence(first, last))))
    # a maximum on the top edge belongs to the bin below it
    placed = counted.join(heads.select("raster_id", last.alias("last")), "raster_id").groupBy("raster_id", F.least("i", "last").alias("i")).agg(F.sum("n").alias("cell_count"))
    return dense.join(placed, ["raster_id", "i"], "left").select(
        "raster_id",
        "min",
        "max",
        "value_count",
        F.lit(width).alias("bin_size"),
        F.lit("continuous").alias("hist_type"),
        (F.col("i") * width).alias("bin"),
        F.when(F.col("i").isNotNull(), F.coalesce("cell_count", F.lit(0))).alias("cell_count"),
    )


def bin_categorical(cells: DataFrame) -> DataFrame:
    """Cell counts per whole-number category (values cut toward zero) with the raster's min, max and count.

    NULL and NaN are no values.
    """
    cells = cells.filter(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")))
    counted = cells.groupBy("raster_id", F.col("value").cast("bigint").alias("category")).agg(
        F.count(F.lit(1)).alias("cell_count"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    heads = counted.groupBy("raster_id").agg(F.min("lo").alias("min"), F.max("hi").alias("max"), F.sum("cell_count").alias("value_count"))
    return counted.join(heads, "raster_id").select("raster_id", "min", "max", "value_count", F.lit("categorical").alias("hist_type"), "category", "cell_count")


def nest_bins(binned: DataFrame, label: str) -> DataFrame:
    """One row per raster with its bins as an ordered list, as the context document stores them."""
    entry = F.when(F.col(label).isNotNull(), F.struct(F.col(label).alias("bin"), "cell_count"))
    heads = [F.first(c).alias(c) for c in ("min", "max", "value_count", "hist_type")]
    return binned.groupBy("raster_id").agg(*heads, F.array_sort(F.collect_list(entry)).alias("bins"))


def context_summary(docs: DataFrame, elevation: DataFrame, vegetation: DataFrame) -> DataFrame:
    """Documents (one per watershed, ``raster_id``) with both histograms attached as structs.

    ``project_id`` and ``model_version`` (as text) say where a document comes from; ``docs`` have to have them.
    """
    docs = docs.withColumn("project_id", F.col("project_id")).withColumn("model_version", F.col("model_version").cast("string"))

    def nested(binned: DataFrame, label: str, name: str) -> DataFrame:
        rows = nest_bins(binned, label)
        return rows.select("raster_id", F.struct("min", "max", "value_count", "hist_type", "bins").alias(name))

    return docs.join(nested(elevation, "bin", "dem_bins"), "raster_id", "left").join(nested(vegetation, "category", "existing_veg_bins"), "raster_id", "left")


def extent(headers: DataFrame) -> DataFrame:
    """Size, right and bottom edge and the closed boundary ring of each raster."""
    left, top = F.col("left_x"), F.col("top_y")
    right, bottom = left + F.col("cell_width") * F.col("n_cols"), top + F.col("cell_height") * F.col("n_rows")
    ring = [(left, top), (right, top), (right, bottom), (left, bottom), (left, top)]
    return headers.select(
        "*",
        right.alias("right_x"),
        bottom.alias("bottom_y"),
        (right - left).alias("width"),
        F.abs(top - bottom).alias("height"),
        F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ring]).alias("ring"),
    )


def sample(cells: DataFrame, headers: DataFrame, points: DataFrame) -> DataFrame:
    """Value of the cell under each point (``raster_id, x, y``); NULL outside the raster or on nodata."""
    placed = points.join(headers, "raster_id", "left").withColumns({
        "c": F.floor((F.col("x") - F.col("left_x")) / F.col("cell_width")).cast("bigint"),
        "r": F.floor((F.col("y") - F.col("top_y")) / F.col("cell_height")).cast("bigint"),
    })
    inside = (F.col("c") >= 0) & (F.col("c") < F.col("n_cols")) & (F.col("r") >= 0) & (F.col("r") < F.col("n_rows"))
    keyed = placed.select(*points.columns, "nodata", F.when(inside, F.col("r")).alias("r"), F.when(inside, F.col("c")).alias("c"))
    found = keyed.join(cells.select("raster_id", "r", "c", "value"), ["raster_id", "r", "c"], "left")
    return found.withColumn("value", F.when(~F.col("value").eqNullSafe(F.col("nodata")) & ~F.isnan("value"), F.col("value"))).drop("nodata", "r", "c")


def mosaic(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """Rasters of one dataset on their common grid; where several have a value the last wins.

    Headers carry ``dataset`` and ``priority`` (later input = larger). Cells must be masked before.
    Rasters of a dataset with other cell sizes, or off the common grid by over a hundredth of a cell, are an error.
    """
    grid = headers.groupBy("dataset").agg(*[F.min_by(c, "raster_id").alias(f"__{c}") for c in ("left_x", "top_y", "cell_width", "cell_height")])

    def off(edge: str, size: str) -> Column:
        steps = (F.col(edge) - F.col(f"__{edge}")) / F.col(f"__{size}")
        return (F.abs(steps - F.round(steps)) > 0.01) | ~nearly_equal(F.col(size), F.col(f"__{size}"), rel=1e-6)

    fits = F.when(off("left_x", "cell_width") | off("top_y", "cell_height"), F.raise_error(F.concat(F.lit("not on the grid of its dataset: raster "), F.col("raster_id").cast("string"))))
    headers = headers.join(grid, "dataset").withColumn("priority", F.coalesce(fits.cast(headers.schema["priority"].dataType), "priority"))
    merged = cells.join(headers.select("raster_id", "dataset", "priority", "left_x", "top_y", "cell_width", "cell_height"), "raster_id")
    column = F.round(F.col("left_x") / F.col("cell_width")).cast("bigint") + F.col("c")
    row = F.round(F.col("top_y") / F.col("cell_height")).cast("bigint") + F.col("r")
    return merged.groupBy("dataset", row.alias("gr"), column.alias("gc")).agg(F.max_by("value", "priority").alias("value"))


def overview_levels(n_rows: int, n_cols: int, blocksize: int) -> list[int]:
    """Reduction factors 2, 4, 8 … while the smaller side, reduced, exceeds the block size."""
    factors, factor = [], 2
    while min(n_rows, n_cols) // factor > blocksize:
        factors.append(factor)
        factor *= 2
    return factors


def overviews(cells: DataFrame, headers: DataFrame, blocksize: int, how: str = "NEAREST") -> DataFrame:
    """Reduced levels of every raster as (raster_id, factor, r, c, value).

    NEAREST keeps the first cell of each block and needs no shuffle; AVERAGE takes the mean of the
    block's valid cells. The factors of a raster follow from its own size.

    For AVERAGE cells are dealt once, by the blocks of their raster's largest factor. Blocks of smaller factors lie inside these, so
    sums and counts of factor 2 are made where the cells are, and those of all other factors from these, without another exchange.
    """
    side = F.least("n_rows", "n_cols")
    steps = F.filter(F.transform(F.sequence(F.lit(1), F.lit(30)), lambda k: F.pow(F.lit(2), k).cast("int")), lambda f: F.floor(side / f) > blocksize)
    sized = cells.join(headers.select("raster_id", steps.alias("factors")).filter(F.size("factors") > 0), "raster_id")
    up = lambda c, f: F.floor(F.col(c) / f).cast("bigint")
    factor = F.col("factor")
    if how == "NEAREST":
        leveled = sized.withColumn("factor", F.explode("factors")).filter((F.col("r") % factor == 0) & (F.col("c") % factor == 0))
        return leveled.select("raster_id", "factor", up("r", factor).alias("r"), up("c", factor).alias("c"), "value")
    if how == "AVERAGE":
        largest = F.array_max("factors")
        dealt = sized.withColumn("block_r", up("r", largest)).withColumn("block_c", up("c", largest)).repartition("raster_id", "block_r", "block_c")
        block = ["raster_id", "block_r", "block_c"]
        halves = dealt.groupBy(*block, "factors", up("r", 2).alias("r"), up("c", 2).alias("c")).agg(F.sum("value").alias("total"), F.count("value").alias("n"))
        leveled = halves.withColumn("factor", F.explode("factors"))
        sums = leveled.groupBy(*block, "factor", up("r", factor / 2).alias("r"), up("c", factor / 2).alias("c")).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        return sums.select("raster_id", "factor", "r", "c", F.try_divide("total", "n").alias("value"))
    raise ValueError(f"unknown resampling: {how}")


# Attribute field kinds and their Spark types.
RAT_TYPES = {"INTEGER": "bigint", "REAL": "double", "STRING": "string"}


def attr_join(binned: DataFrame, attributes: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Category counts with their attribute columns, typed by field kind; unknown categories get NULL."""
    typed = [F.col("VALUE").try_cast("bigint").alias("category")]
    for name, kind in kinds.items():
        target = RAT_TYPES[kind]
        typed.append((F.col(name).cast("string") if target == "string" else F.col(name).try_cast(target)).alias(name))
    return binned.join(attributes.select(*typed), "category", "left")
