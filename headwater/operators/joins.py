"""Loaded / missing comparisons, matching by watershed, label and report joins.

No join hints: side sizes are not known here, so Spark picks broadcast or sort-merge from the
sizes it measures and splits skewed partitions. Per-group answers (newest, first, how many) come
from combinable aggregates that are joined back; lists of a whole group are never built.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.functions import columns as C


# --- wide tables ------------------------------------------------------------------------------

def drop_repeated(df: DataFrame, other: DataFrame) -> DataFrame:
    """``other`` without the columns ``df`` already has, ignoring case."""
    have = {c.lower() for c in df.columns}
    return other.drop(*[c for c in other.columns if c.lower() in have])


def rme_wide(dgos: DataFrame, sides: Sequence[DataFrame], key: str = "dgoid", constants: dict[str, Column] | None = None) -> DataFrame:
    """Segments with all their 1:1 side tables in one row; each repeated column is kept once."""
    wide = dgos
    for side in sides:
        side = side.withColumnsRenamed({c: key for c in side.columns if c.lower() == key.lower()})
        extra = drop_repeated(wide, side.drop(key)).columns
        wide = wide.join(side.select(key, *extra), key)
    return wide.withColumns(constants) if constants else wide


LOCATION = ("huc10", "level_path", "seg_distance")


def dgo_igo_view(dgos: DataFrame, igos: DataFrame, side: DataFrame, keys: Sequence[str] = LOCATION) -> DataFrame:
    """Metrics of a side table with the segment attributes and the point of the same location."""
    segments = dgos.join(igos, list(keys))
    return side.join(segments, "dgoid").drop("dgoid")


def projects_with_huc(projects: DataFrame, hucs: DataFrame) -> DataFrame:
    """Projects of known watersheds with the watershed name, states and readable date."""
    return projects.join(hucs, "huc10").withColumn("created_on_dt", C.ms_text(F.col("created_on")))


# --- what is missing --------------------------------------------------------------------------

def missing_or_stale(catalogue: DataFrame, loaded: DataFrame, since_ms: int | None = None) -> DataFrame:
    """Projects whose watershed is not loaded, or has a loaded row older than the project.

    Moments are compared with the project's cut to the second, as loaders store them. With several
    loaded rows of one watershed any older one triggers a reload, so the oldest is compared.
    """
    if since_ms is not None:
        catalogue = catalogue.filter(F.col("created_on") >= since_ms)
    oldest = loaded.groupBy("huc").agg(F.min("loaded_ts").alias("loaded_ts"))
    stale = F.col("loaded_ts").isNull() | (F.col("loaded_ts") < C.whole_seconds(F.col("created_on")))
    return catalogue.select("project_id", "huc", "created_on").join(oldest, "huc", "left").filter(stale).distinct()


def missing_or_stale_semi(catalogue: DataFrame, loaded: DataFrame, metrics: DataFrame) -> DataFrame:
    """As :func:`missing_or_stale`, counting a watershed as loaded only if metric rows exist for it."""
    return missing_or_stale(catalogue, loaded.join(metrics.select("project_id"), "project_id", "left_semi"))


def missing_or_newer(projects: DataFrame, loaded: DataFrame, type_id: str | None = None) -> DataFrame:
    """Projects whose watershed is not loaded, or was loaded from an older project.

    With ``type_id`` only projects of that type with a known watershed are looked at; a load may come from any type.
    """
    ours = projects if type_id is None else projects.filter((F.col("project_type_id") == type_id) & F.col("huc").isNotNull())
    ours = ours.select("project_id", "huc", "created_on")
    theirs = loaded.select("huc", F.col("project_id").alias("loaded_project_id"))
    origin = projects.select(F.col("project_id").alias("loaded_project_id"), F.col("created_on").alias("loaded_created_on"))
    dated = theirs.join(origin, "loaded_project_id", "left").withColumn("loaded_huc", F.col("huc"))
    joined = ours.join(dated, "huc", "left")
    return joined.filter(F.col("loaded_huc").isNull() | (F.col("loaded_created_on") < F.col("created_on")))


def skip_loaded(df: DataFrame, ledger: DataFrame, key: str = "huc10") -> tuple[DataFrame, DataFrame]:
    """(rows whose key is not in the ledger, the ledger entries to append for them)."""
    fresh = df.filter(F.col(key).isNotNull()).join(ledger.select(key), key, "left_anti")
    return fresh, fresh.select(key).distinct()


def skip_existing(df: DataFrame, outputs: DataFrame, key: Column, path: str = "local_path") -> DataFrame:
    """Rows whose output path is not in the listing of existing outputs."""
    listed = outputs.select(F.col(path).alias("__path")).filter(F.col("__path").isNotNull())
    keyed = df.withColumn("__path", key)
    return keyed.join(listed, "__path", "left_anti").drop("__path")


# --- matching campaigns by watershed ----------------------------------------------------------

def match_by_huc(source: DataFrame, target: DataFrame, huc: str = "huc10") -> DataFrame:
    """Every source project with the number of targets of its watershed and the first of them.

    A project without watershed has no match. The targets themselves stay a table of their own,
    see :func:`match_lists`: a list per source would repeat a watershed's targets once per source.
    """
    per_huc = target.filter(~C.is_blank(F.col(huc))).groupBy(huc).agg(
        F.count(F.lit(1)).alias("match_count"), F.min(F.struct("project_id", "bounds_id")).alias("first")
    )
    return (
        source.select("project_id", huc, "bounds_id", "project_type_id", "owner_name")
        .join(per_huc, huc, "left")
        .withColumn("match_count", F.coalesce("match_count", F.lit(0)))
        .withColumn("first_match_id", F.col("first.project_id"))
        .withColumn("first_match_bounds", F.col("first.bounds_id"))
        .drop("first")
    )


def chunked_lists(df: DataFrame, keys: Sequence[str], unique: str, fields: Sequence[str], name: str, chunk: int = 1000) -> DataFrame:
    """Lists of a group's rows in parts of about ``chunk`` entries, so no group is held in one row.

    Every row is in exactly one part; parts are numbered from 0 and ``part_count`` is on each row.
    Rows are dealt to parts by a hash of a unique column, so a retried task deals them alike.
    """
    sizes = df.groupBy(*keys).agg(F.greatest(F.ceil(F.count(F.lit(1)) / chunk), F.lit(1)).alias("part_count"))
    dealt = df.join(sizes, list(keys)).withColumn("part", F.pmod(F.xxhash64(unique), F.col("part_count")))
    entries = F.array_sort(F.collect_list(F.struct(unique, *[f for f in fields if f != unique])))
    return dealt.groupBy(*keys, "part", "part_count").agg(entries.alias(name))


def match_lists(target: DataFrame, huc: str = "huc10", chunk: int = 1000) -> DataFrame:
    """The target projects of each watershed as lists in bounded parts, once per watershed."""
    return chunked_lists(target.filter(~C.is_blank(F.col(huc))), [huc], "project_id", ["name", "bounds_id", "created_on", "updated_on"], "matches", chunk)


def match_summary(matches: DataFrame, target: DataFrame, huc: str = "huc10") -> DataFrame:
    """Totals of a match run: of the sources, of their watersheds, and of the targets looked at and matched."""
    count = F.col("match_count")
    needed = matches.filter(~C.is_blank(F.col(huc))).select(huc).distinct()
    totals = matches.agg(
        F.count(F.lit(1)).alias("sources"),
        F.count_if(F.col("huc10").isNull()).alias("without_huc"),
        F.count_if(count > 0).alias("matched"),
        F.count_if(count == 0).alias("unmatched"),
        F.count_if(count > 1).alias("multiple"),
        F.sum("match_count").alias("pairs"),
        F.max("match_count").alias("max_matches"),
    )
    rows = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return totals.withColumns({"unique_hucs": rows(needed), "targets_scanned": rows(target), "targets_matched": rows(target.join(needed, huc, "left_semi"))})


def with_matches(matches: DataFrame) -> DataFrame:
    return matches.filter(F.col("match_count") > 0)


def match_latest(source: DataFrame, target: DataFrame, huc: str = "huc10", how: str = "inner") -> DataFrame:
    """The one newest target of the same digits-only watershed code: last update, else creation.

    Sources without a match are dropped; ``how='left'`` keeps them for a report of the unmatched.
    """
    code = C.digits_only(F.col(huc)).alias("huc")
    moment = F.coalesce("updated_on", "created_on")
    newest = target.select(code, "project_id", moment.alias("moment")).filter(F.col("huc").isNotNull()).groupBy("huc").agg(
        F.max(F.struct("moment", "project_id")).alias("best")
    )
    joined = source.withColumn("huc", code).join(newest, "huc", how)
    return joined.withColumn("match_id", F.col("best.project_id")).withColumn("match_moment", F.col("best.moment")).drop("best")


def bounds_mismatch(matches: DataFrame) -> DataFrame:
    """Matched projects whose bounds differ from the first match's (NULL counts as a value)."""
    differs = ~F.col("bounds_id").eqNullSafe(F.col("first_match_bounds"))
    return with_matches(matches).filter(differs).withColumn("several", F.col("match_count") > 1)


def unmatched(source: DataFrame, matches: DataFrame) -> DataFrame:
    """Details of projects that have no match, with UNKNOWN_* for what is not known or blank."""
    known = lambda c, unknown: F.when(C.is_blank(F.col(c)), unknown).otherwise(F.col(c))
    alone = source.join(matches.select("project_id"), "project_id", "left_anti")
    return alone.select(
        known("project_id", "UNKNOWN_ID").alias("project_id"),
        "name",
        known("owner_name", "UNKNOWN_OWNER").alias("owner"),
        known("project_type_id", "UNKNOWN_TYPE").alias("project_type"),
        known("huc10", "UNKNOWN_HUC").alias("huc"),
        *(["tags"] if "tags" in source.columns else []),
        "created_on",
        "updated_on",
    )


# --- selections -------------------------------------------------------------------------------

def hucs_with_types(projects: DataFrame, first: str, second: str, tag: str | None = None, like: str | None = None) -> DataFrame:
    """Watersheds that have projects of both types, with the smallest project id of each."""
    if tag is not None:
        projects = projects.filter(F.array_contains(F.split("tags", r"\|"), tag))
    if like is not None:
        projects = projects.filter(F.col("huc10").like(like))
    kind = F.col("project_type_id")
    return (
        projects.filter(kind.isin(first, second) & F.col("huc10").isNotNull())
        .groupBy("huc10")
        .agg(F.min(F.when(kind == first, F.col("project_id"))).alias("first_id"), F.min(F.when(kind == second, F.col("project_id"))).alias("second_id"))
        .filter(F.col("first_id").isNotNull() & F.col("second_id").isNotNull())
    )


def batch_projects(projects: DataFrame, type_id: str, batch_hucs: DataFrame | None = None, batch_id: int | None = None, tags: Sequence[str] = (), hucs: Sequence[str] = ()) -> DataFrame:
    """Projects of a type in a batch of watersheds whose tag text contains all ``tags``, or in a list of watersheds."""
    found = projects.filter(F.col("project_type_id") == type_id)
    if batch_hucs is None:
        return found.filter(F.col("huc10").isin(list(hucs)))
    for tag in tags:
        found = found.filter(F.col("tags").contains(tag))
    return batch_hucs.filter(F.col("batch_id") == batch_id).join(found, "huc10")


def batch_sizes(batches: DataFrame, batch_hucs: DataFrame) -> DataFrame:
    """Number of watersheds of each batch."""
    return batch_hucs.groupBy("batch_id").agg(F.count(F.lit(1)).alias("hucs")).join(batches, "batch_id")


def huc_has_project(hucs: DataFrame, meta: DataFrame, projects: DataFrame, key: str | None = None, type_id: str | None = None) -> DataFrame:
    """Watersheds with the metadata values and projects naming them, flagged 1 when there is one."""
    if key is not None:
        meta = meta.filter(F.col("key") == key)
    wanted = hucs.select("huc10").distinct()
    # matched and unmatched apart: a watershed with very many projects can be split in an inner
    # join, but not on the inner side of a left join
    named = meta.select("project_id", "key", F.col("value").alias("huc10")).join(wanted, "huc10")
    alone = wanted.join(named.select("huc10").distinct(), "huc10", "left_anti")
    joined = named.unionByName(alone, allowMissingColumns=True).join(projects.select("project_id", "project_type_id", "owner_name"), "project_id", "left")
    if type_id is not None:
        joined = joined.filter(F.col("project_type_id") == type_id)
    return joined.withColumn("has_project", F.col("key").isNotNull().cast("int"))


def lookup_labels(df: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """Add ``<column>_label`` from a (code, label) table per coded column; unknown codes get NULL."""
    for column, lookup in lookups.items():
        labels = lookup.select(F.col("code").alias(column), F.col("label").alias(f"{column}_label"))
        df = df.join(labels, column, "left")
    return df


def visits_to_load(visits: DataFrame, sites: DataFrame, watersheds: DataFrame, projects: DataFrame, *, program: int = 1, project_type: int = 1,
                   visit: int | None = None, watershed: str | None = None, year: int | None = None) -> DataFrame:
    """Visits with a project whose measurements are not loaded yet; each filter is optional.

    Each table is narrowed by the filters that concern it before the tables meet.
    """

    def narrowed(table: DataFrame, **wanted: object) -> DataFrame:
        for column, value in wanted.items():
            table = table if value is None else table.filter(F.col(column) == value)
        return table

    todo = narrowed(visits, program_id=program, visit_id=visit, visit_year=year).filter(F.col("aux_uploaded").isNull())
    loaded = narrowed(projects, project_type=project_type, visit_id=visit).filter(F.col("guid").isNotNull())
    places = sites.select("site_id", "watershed_id", "site_name").join(narrowed(watersheds, watershed_name=watershed).select("watershed_id", "watershed_name"), "watershed_id")
    found = todo.select("visit_id", "site_id", "visit_year").join(places, "site_id").join(loaded.select("visit_id", "guid"), "visit_id")
    place = ["watershed_name", "site_name", "visit_year", "visit_id"]
    return found.select("visit_id", "site_name", "watershed_name", "visit_year", "guid").orderBy(*place)


def within_bounds(points: DataFrame, boxes: DataFrame, cell: float, x: str = "x", y: str = "y") -> DataFrame:
    """(point, box) pairs with the point strictly inside the box.

    A bucketed equi-join by size class: a box is listed under the at most four cells it reaches on the
    grid of its class, whose cells are ``cell`` times a power of two and no smaller than the box. Points
    are listed under their own cell of every class that has boxes.
    """
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"), F.lit(cell))
    boxes = boxes.withColumn("__class", F.ceil(F.log2(side / cell)).cast("int"))
    # one entry for each size class, of which there are as many as powers of two between the sizes
    classes = sorted(r[0] for r in boxes.select("__class").distinct().collect() if r[0] is not None)
    at = lambda c: F.floor(c / (cell * F.pow(F.lit(2.0), F.col("__class")))).cast("bigint")
    reach = boxes.withColumn("__gx", F.explode(F.sequence(at(F.col("xmin")), at(F.col("xmax"))))).withColumn(
        "__gy", F.explode(F.sequence(at(F.col("ymin")), at(F.col("ymax"))))
    )
    listed = points.withColumn("__class", F.explode(F.array(*map(F.lit, classes)).cast("array<int>")))
    placed = listed.withColumn("__gx", at(F.col(x))).withColumn("__gy", at(F.col(y)))
    inside = (F.col(x) > F.col("xmin")) & (F.col(x) < F.col("xmax")) & (F.col(y) > F.col("ymin")) & (F.col(y) < F.col("ymax"))
    return placed.join(reach, ["__class", "__gx", "__gy"]).filter(inside).drop("__class", "__gx", "__gy")


# --- merging and syncing ----------------------------------------------------------------------

def merge_remap(parents: DataFrame, children: dict[str, DataFrame], key: str, huc: str = "huc10") -> tuple[DataFrame, dict[str, DataFrame]]:
    """Parents of many sources under new ids, and child tables pointing at the new ids.

    ``parents`` and ``children`` carry the source watershed next to their old key. New ids follow
    (watershed, old id) order, without gaps. Child rows without a parent are dropped.
    """
    from headwater.operators.ranking import with_row_number

    numbered = with_row_number(parents, [huc, key], "__new")
    mapping = numbered.select(huc, key, "__new")
    renewed = numbered.withColumn(key, F.col("__new")).drop("__new")
    moved = {name: child.join(mapping, [huc, key]).withColumn(key, F.col("__new")).drop("__new") for name, child in children.items()}
    return renewed, moved


def orphan_counts(parents: DataFrame, children: dict[str, DataFrame], key: str, huc: str = "huc10") -> DataFrame:
    """(child, ``huc``, orphans): rows of child tables that :func:`merge_remap` drops, as their source has no such parent."""
    known = parents.select(huc, key).distinct()
    counts = [child.join(known, [huc, key], "left_anti").groupBy(huc).agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(name).alias("child"), huc, "orphans") for name, child in sorted(children.items())]
    return reduce(lambda a, b: a.unionByName(b), counts)


def sync_compare(local: DataFrame, remote: DataFrame, key: str, fields: Sequence[str], meta: str = "meta") -> DataFrame:
    """Per key: same, update (a text field or the metadata differs), create, or remote_only.

    Metadata maps are compared as JSON with sorted keys.
    """

    def side(df: DataFrame, prefix: str) -> DataFrame:
        canonical = F.to_json(F.array_sort(F.map_entries(meta)))
        return df.select(key, *[F.col(f).alias(f"{prefix}_{f}") for f in fields], canonical.alias(f"{prefix}_{meta}"), F.lit(True).alias(f"in_{prefix}"))

    both = side(local, "local").join(side(remote, "remote"), key, "full")
    compared = [*fields, meta]
    changed = [F.when(~F.col(f"local_{f}").eqNullSafe(F.col(f"remote_{f}")), F.lit(f)) for f in compared]
    first_change = F.coalesce(*changed)
    status = (
        F.when(F.col("in_local").isNull(), "remote_only")
        .when(F.col("in_remote").isNull(), "create")
        .when(first_change.isNotNull(), "update")
        .otherwise("same")
    )
    return both.select(key, status.alias("status"), F.when(status == "update", first_change).alias("first_change"))
