"""Roll-ups, counts and report aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwater.functions.columns import day_floor, is_blank, ms_text
from headwater.session import cut_lineage

STATE_METRIC = 2
OWNER_METRIC = 1

# Metric id, summary method and output name of each watershed statistic.
HUC_METRICS = [
    (4, "length_weighted", "channel_gradient"),
    (5, "length_weighted", "valley_gradient"),
    (16, "sum", "channel_length"),
    (19, "sum", "low_lying_area"),
    (20, "sum", "elevated_area"),
    (21, "sum", "channel_area"),
    (23, "length_weighted", "valley_width"),
    (35, "times_length", "road_length"),
    (36, "times_length", "rail_length"),
    (37, "area_weighted", "land_use_intensity"),
    (38, "times_area", "accessible_floodplain_area"),
    (39, "times_area", "riparian_area"),
    (40, "area_weighted", "riparian_departure"),
    (41, "times_area", "riparian_ag_conv_area"),
    (42, "times_area", "riparian_developed_area"),
    (37, "zero_area", "lui_zero_area"),
]
METRES_TO_MILES = 0.000621371
SQUARE_METRES_TO_ACRES = 0.000247105


def _method(method: str, total: Column, rows: Column, zeros: Column, length: Column, area: Column, weight: Column) -> Column:
    """One summary method over rows that each stand for ``rows`` metric rows adding up to ``total``."""
    if method == "length_weighted":
        return F.try_divide(F.sum(weight * total * length), F.sum(weight * rows * length))
    if method == "area_weighted":
        return F.try_divide(F.sum(weight * total * area), F.sum(weight * rows * area))
    if method == "sum":
        return F.sum(weight * total)
    if method == "times_length":
        return F.sum(weight * total * length)
    if method == "times_area":
        return F.sum(weight * total * area)
    if method == "zero_area":
        return F.coalesce(F.sum(weight * zeros * area), F.lit(0.0))
    raise ValueError(f"unknown summary method: {method}")


def _codes(lookup: DataFrame) -> DataFrame:
    return lookup.select(F.col("id").cast("int").alias("code_id"), F.explode(F.split("where_clause", ",")).alias("code"))


def _per_segment(values: DataFrame, states: DataFrame, owners: DataFrame, ids: list[int]) -> DataFrame:
    """One row per segment: sums, row counts and zero counts of every metric, and how often its
    state and owner codes fall in each lookup id (lists no longer than the lookups)."""
    if {STATE_METRIC, OWNER_METRIC} & set(ids):
        raise ValueError("the state and owner codes cannot be summarised as metrics")
    codes = (
        _codes(states).withColumn("metric_id", F.lit(STATE_METRIC))
        .unionByName(_codes(owners).withColumn("metric_id", F.lit(OWNER_METRIC)))
        .select("metric_id", "code_id", F.col("code").try_cast("double").alias("metric_value"))
    )
    value = F.col("metric_value")
    tall = (
        values.join(codes, ["metric_id", "metric_value"], "left")
        .filter(F.col("metric_id").isin(ids) | F.col("code_id").isNotNull())
        .groupBy("dgo_id", "metric_id", "code_id")
        .agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"), F.count_if(value == 0).alias("zeros"))
    )

    def of(metric_id: int, name: str):
        return F.when(F.col("metric_id") == metric_id, F.col(name))

    entry = F.struct(F.col("code_id").alias("id"), "n")
    return tall.groupBy("dgo_id").agg(
        *[F.sum(of(i, "total")).alias(f"total_{i}") for i in ids],
        *[F.sum(of(i, "n")).alias(f"rows_{i}") for i in ids],
        *[F.sum(of(i, "zeros")).alias(f"zeros_{i}") for i in ids],
        F.collect_list(F.when(F.col("metric_id") == STATE_METRIC, entry)).alias("states"),
        F.collect_list(F.when(F.col("metric_id") == OWNER_METRIC, entry)).alias("owners"),
    )


def huc_statistics(dgos: DataFrame, values: DataFrame, states: DataFrame, flows: DataFrame, owners: DataFrame, metrics=HUC_METRICS) -> DataFrame:
    """Segment statistics per watershed, state and flow, with and without the owner dimension.

    Lookup rows hold comma separated codes and one code may be listed under several ids, so a
    segment counts once for each id it falls in. Weighted averages divide by the weight of *all*
    metric rows, NULL values included. ``owner_id`` is NULL on rows over all owners.

    The metric rows are read once and reduced to one row per segment, with map-side partial sums,
    so the fan-out over states, flows and owners multiplies counts and not metric rows, and the
    last group-by shuffles only per-group partial sums.
    """
    ids = sorted({m[0] for m in metrics})
    per_segment = _per_segment(values, states, owners, ids).filter(F.size("states") > 0)
    flow_codes = _codes(flows).select(F.col("code_id").alias("flow_id"), F.col("code").alias("fcode"))
    all_owners = F.array(F.struct(F.lit(None).cast("int").alias("id"), F.lit(1).cast("bigint").alias("n")))
    fanned = (
        dgos.withColumnRenamed("dgoid", "dgo_id")
        .join(flow_codes, "fcode")
        .join(per_segment, "dgo_id")
        .withColumn("state", F.explode("states"))
        .withColumn("owner", F.explode(F.concat(all_owners, "owners")))
        .withColumn("weight", F.col("state.n") * F.col("owner.n"))
    )
    length, area, weight = F.col("centerline_length"), F.col("segment_area"), F.col("weight")
    return (
        fanned.groupBy(F.col("huc10"), F.col("state.id").alias("state_id"), F.col("flow_id"), F.col("owner.id").alias("owner_id"))
        .agg(
            F.sum(weight).alias("dgo_count"),
            F.coalesce(F.sum(weight * length), F.lit(0.0)).alias("total_length"),
            F.coalesce(F.sum(weight * area), F.lit(0.0)).alias("total_area"),
            *[_method(how, F.col(f"total_{i}"), F.col(f"rows_{i}"), F.col(f"zeros_{i}"), length, area, weight).alias(name) for i, how, name in metrics],
        )
        .filter(F.col("dgo_count") > 0)
    )


def metric_summary(dgos: DataFrame, values: DataFrame, metric_id: int, by: Sequence[str]) -> DataFrame:
    """All six summary methods of one metric per group of segments."""
    rows = values.filter(F.col("metric_id") == metric_id).join(dgos.withColumnRenamed("dgoid", "dgo_id"), "dgo_id")
    value = F.col("metric_value")
    zeros = F.when(value == 0, 1)
    length, area, one = F.col("centerline_length"), F.col("segment_area"), F.lit(1)
    methods = ["length_weighted", "area_weighted", "sum", "times_length", "times_area", "zero_area"]
    return rows.groupBy(*by).agg(*[_method(m, value, one, zeros, length, area, one).alias(m) for m in methods])


def secondary_metrics(stats: DataFrame) -> DataFrame:
    """Seven ratios of the watershed statistics; a zero divisor gives NULL."""
    col = F.col
    ratios = {
        "hist_riparian_area": (col("riparian_area"), 1 - col("riparian_departure")),
        "relative_flow_length": (col("channel_length"), col("total_length")),
        "acres_vb_per_mile": (col("total_area") * SQUARE_METRES_TO_ACRES, col("total_length") * METRES_TO_MILES),
        "road_density": (col("road_length"), col("total_length")),
        "rail_density": (col("rail_length"), col("total_length")),
        "riparian_ag_conversion_proportion": (col("riparian_ag_conv_area"), col("total_area")),
        "riparian_developed_proportion": (col("riparian_developed_area"), col("total_area")),
    }
    return stats.withColumns({name: F.try_divide(a, b) for name, (a, b) in ratios.items()})


def huc4_status(projects: DataFrame, hucs: DataFrame) -> DataFrame:
    """Projects against watershed count per HUC4, type and version, as a whole percent."""
    huc4 = F.substring("huc10", 1, 4).alias("huc4")
    wanted = hucs.select("huc10").distinct().groupBy(huc4).agg(F.count(F.lit(1)).alias("huc10_count"))
    found = projects.join(hucs.select("huc10").distinct(), "huc10", "left_semi").groupBy(huc4, "project_type_id", "model_version").agg(F.count(F.lit(1)).alias("project_count"))
    percent = F.call_function("div", 100 * F.coalesce("project_count", F.lit(0)), F.col("huc10_count")).cast("double")
    return wanted.join(found, "huc4", "left").withColumn("project_pc", percent)


def percent_complete(projects: DataFrame, hucs: DataFrame, tag: str | None = None) -> DataFrame:
    """Share of all watersheds that have a project, per project type."""
    total = hucs.select(F.countDistinct("huc10").alias("n")).scalar()
    if tag is not None:
        projects = projects.filter(F.array_contains(F.split("tags", r"\|"), tag))
    return (
        projects.groupBy("project_type_id")
        .agg(F.countDistinct("huc10").alias("huc_count"))
        .withColumn("huc_total", total)
        .withColumn("percent", F.coalesce(F.try_divide(F.col("huc_count") * 100.0, F.col("huc_total")), F.lit(0.0)))
    )


def meta_stats(projects: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """Max, min and mean of a numeric metadata value, in sixtieths, per owner and type."""
    value = F.col("value").try_cast("double") / 60
    return (
        projects.join(meta.filter(F.col("key") == key).select("project_id", "value"), "project_id")
        .groupBy("owner_name", "project_type_id")
        .agg(
            F.round(F.max(value), 1).alias("max_minutes"),
            F.round(F.min(value), 1).alias("min_minutes"),
            F.round(F.avg(value), 1).alias("avg_minutes"),
        )
    )


# fixed values: the price list of the task service
CPU_PRICE = 0.04048  # per 1024 units and hour
MEMORY_PRICE = 0.004445  # per 1000 MB and hour


def task_cost(jobs: DataFrame, tasks: DataFrame, script_id: str, def_id: str | None = None) -> DataFrame:
    """Seconds and price of every task of the jobs of one script, of one task definition if given."""
    wanted = F.col("script_id") == script_id
    if def_id is not None:
        wanted &= F.col("task_def_id") == def_id
    millis = F.col("ended_on") - F.col("started_on")
    rate = F.col("cpu") / 1024.0 * CPU_PRICE + F.col("memory") / 1000.0 * MEMORY_PRICE
    return (
        tasks.join(jobs.filter(wanted).select("jid", "job_name"), "jid")
        .withColumn("duration_s", F.round(millis / 1000.0, 0))
        .withColumn("estimated_cost", F.round(rate * (millis / 3600000.0), 2))
    )


def size_stats(projects: DataFrame) -> DataFrame:
    """Total, mean, largest and smallest non-empty size, over all and per owner (NULL = all).

    Sizes are first added up per owner, so the grouping-sets expansion sees a handful of rows.
    """
    size = F.col("total_size")
    per_owner = projects.groupBy("owner_id").agg(
        F.sum(size).alias("bytes"),
        F.count(F.lit(1)).alias("n"),
        F.count(size).alias("n_sized"),
        F.max(size).alias("largest"),
        F.min(F.nullif(size, F.lit(0))).alias("smallest"),
    )
    both = per_owner.rollup("owner_id").agg(
        F.grouping("owner_id").alias("all_owners"),
        F.sum("bytes").alias("bytes"),
        F.sum("n").alias("n"),
        F.sum("n_sized").alias("n_sized"),
        F.max("largest").alias("largest"),
        F.min("smallest").alias("smallest"),
    )
    return both.withColumn("mean_bytes", F.try_divide("bytes", "n_sized")).drop("n_sized")


def group_counts(df: DataFrame, dims: dict[str, int | None], unknown: dict[str, str] | None = None) -> DataFrame:
    """Counts per value of several dimensions, the ``k`` largest of each (``None`` = all).

    ``unknown`` names what NULL and blank values of a dimension count as; elsewhere NULL is a value of its own. One scan: every row is
    expanded to its (dimension, value) pairs and map-side combined, and the counts are written before the longest are picked.
    """
    unknown = unknown or {}
    value = lambda d: F.when(is_blank(F.col(d)), unknown[d]).otherwise(F.col(d)) if d in unknown else F.col(d)
    pairs = F.array(*[F.struct(F.lit(d).alias("dim"), value(d).cast("string").alias("value")) for d in dims])
    counts = cut_lineage(df.select(F.explode(pairs).alias("p")).groupBy("p.dim", "p.value").agg(F.count(F.lit(1)).alias("n")), "counts")
    limits = {dim: k for dim, k in dims.items() if k is not None}
    unlimited = counts.filter(F.col("dim").isin([d for d in dims if d not in limits]))
    if not limits:
        return unlimited
    # the row-number limit is applied before the shuffle too, so a dimension with many values
    # sends a few rows per task
    place = F.row_number().over(Window.partitionBy("dim").orderBy(F.desc("n"), F.asc_nulls_first("value")))
    longest = counts.filter(F.col("dim").isin(list(limits))).withColumn("place", place).filter(F.col("place") <= max(limits.values()))
    allowed = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    return longest.filter(F.col("place") <= F.element_at(allowed, F.col("dim"))).drop("place").unionByName(unlimited)


def missing_totals(df: DataFrame, is_missing: Column) -> DataFrame:
    """How many rows there are, how many are missing, and the percentage."""
    total, missing = F.count(F.lit(1)), F.count_if(is_missing)
    return df.agg(
        total.alias("total"),
        missing.alias("missing"),
        F.coalesce(F.try_divide(missing * 100.0, total), F.lit(0.0)).alias("missing_pc"),
    )


def upload_status(df: DataFrame) -> DataFrame:
    """One row of upload progress from per-watershed flags.

    Needs ``has_match, uploaded, uploaded_at (ISO text), has_xml, has_bounds, xml_size, bounds_size``.
    """
    waiting = ~F.coalesce("uploaded", F.lit(False))
    ready = waiting & F.col("has_xml") & F.col("has_bounds")
    sent_at = F.try_to_timestamp("uploaded_at")
    total, uploaded = F.count(F.lit(1)), F.count_if(~waiting)
    return df.agg(
        total.alias("total"),
        F.count_if("has_match").alias("with_match"),
        F.count_if(~F.col("has_match")).alias("missing_match"),
        uploaded.alias("uploaded"),
        F.coalesce(F.try_divide(uploaded * 100.0, total), F.lit(0.0)).alias("uploaded_pc"),
        F.count_if(waiting).alias("not_uploaded"),
        F.count_if(ready).alias("ready"),
        F.count_if(waiting & ~F.col("has_xml") & F.col("has_bounds")).alias("missing_xml"),
        F.count_if(waiting & F.col("has_xml") & ~F.col("has_bounds")).alias("missing_bounds"),
        F.count_if(waiting & ~F.col("has_xml") & ~F.col("has_bounds")).alias("missing_both"),
        F.coalesce(F.sum(F.when(ready, F.col("xml_size"))), F.lit(0)).alias("xml_bytes"),
        F.avg(F.when(ready, F.col("xml_size"))).alias("xml_mean"),
        F.coalesce(F.sum(F.when(ready, F.col("bounds_size"))), F.lit(0)).alias("bounds_bytes"),
        F.avg(F.when(ready, F.col("bounds_size"))).alias("bounds_mean"),
        F.min(sent_at).alias("earliest"),
        F.max(sent_at).alias("latest"),
    )


def table_cardinality(tables: dict[str, DataFrame], by: str) -> DataFrame:
    """Row count of every table per source and whether all of them agree."""
    counts = reduce(
        DataFrame.unionByName,
        [df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).withColumn("t", F.lit(name)) for name, df in tables.items()],
    )
    wide = counts.groupBy(by).pivot("t", list(tables)).agg(F.sum("n")).fillna(0, subset=list(tables))
    first = next(iter(tables))
    same = reduce(lambda a, b: a & b, [F.col(name) == F.col(first) for name in tables])
    return wide.withColumn("all_equal", same)


def duplicate_keys(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Number of key groups with more than one row (rows with a NULL key left out)."""
    repeated = df.dropna(subset=list(keys)).groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return repeated.groupBy(*by).agg(F.count(F.lit(1)).alias("duplicate_groups")).withColumn("has_duplicates", F.col("duplicate_groups") > 0)


def load_units(projects: DataFrame) -> DataFrame:
    """Distinct (type, version, UTC day) batches a catalogue load consists of."""
    day = day_floor(F.col("created_on"))
    return projects.select("project_type_id", "model_version", day.alias("day_ms")).distinct().withColumn("day", F.substring(ms_text(F.col("day_ms")), 1, 10))


def multirow(tables: dict[str, DataFrame], visit: str = "visit_id") -> DataFrame:
    """Per measurement table the largest number of rows of one visit, and whether it exceeds one."""
    counts = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("table_name"), F.col(visit).alias("visit")) for name, df in tables.items()],
    )
    per_visit = counts.groupBy("table_name", "visit").agg(F.count(F.lit(1)).alias("n"))
    return per_visit.groupBy("table_name").agg(F.max("n").alias("max_rows")).withColumn("multirow", F.col("max_rows") > 1)


def synthesis_summary(projects: DataFrame) -> DataFrame:
    """Counts of rows, watersheds and projects with the extent, its centre and its outline."""
    x0, y0, x1, y1 = (F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
    ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    corners = F.concat_ws(", ", *[F.concat_ws(" ", x.cast("string"), y.cast("string")) for x, y in ring])
    return (
        projects.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct("huc10").alias("huc_count"),
            F.countDistinct("project_id").alias("project_count"),
            F.min("xmin").alias("xmin"),
            F.min("ymin").alias("ymin"),
            F.max("xmax").alias("xmax"),
            F.max("ymax").alias("ymax"),
        )
        .withColumn("center_x", (x0 + x1) / 2)
        .withColumn("center_y", (y0 + y1) / 2)
        .withColumn("outline", F.concat(F.lit("POLYGON (("), corners, F.lit("))")))
    )


def count_histogram(df: DataFrame, count_col: str) -> DataFrame:
    """How many rows had 0, 1, 2 … of something."""
    return df.groupBy(count_col).agg(F.count(F.lit(1)).alias("rows"))


