"""Project catalogue: normalise, index, filter, search."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from headwater.functions import columns as C


def normalize_projects(docs: DataFrame) -> DataFrame:
    """Catalogue documents as flat typed rows with a metadata map and the parsed version."""
    normal = C.normal_meta_map(F.col("meta"))
    return (
        docs.withColumn("meta_map", C.meta_map(F.col("meta")))
        .withColumn("meta_normal", normal)
        .withColumn("version", C.version_clean(F.try_element_at("meta_normal", F.lit("modelversion"))))
        .withColumn("parts", C.version_parts(F.col("version")))
        .select(
            F.col("id").alias("project_id"),
            "name",
            F.try_to_timestamp("createdOn").alias("created_at"),
            F.try_to_timestamp("updatedOn").alias("updated_at"),
            "visibility",
            F.coalesce("archived", F.lit(False)).alias("archived"),
            F.col("ownedBy.id").alias("owner_id"),
            F.col("ownedBy.name").alias("owner_name"),
            F.col("ownedBy.__typename").alias("owner_type"),
            "tags",
            F.col("projectType.id").alias("project_type_id"),
            F.col("totalSize").alias("total_size"),
            F.col("bounds.id").alias("bounds_id"),
            "meta",
            "meta_map",
            "meta_normal",
            F.try_element_at("meta_normal", F.lit("huc")).alias("huc"),
            F.col("version").alias("model_version"),
            *[F.col("parts")[i].cast("int").alias(name) for i, name in enumerate(("major", "minor", "patch"))],
            C.parts_int(F.col("parts")).alias("model_version_int"),
        )
    )


def index_projects(docs: DataFrame) -> DataFrame:
    """Catalogue documents as loadable rows; those without a watershed code or version are left out."""
    values = C.meta_map(F.col("meta"))

    def first_of(keys: Sequence[str]) -> Column:
        return F.coalesce(*[F.try_element_at("values", F.lit(k)) for k in keys])

    created = F.unix_millis(F.try_to_timestamp("createdOn"))
    return (
        docs.withColumn("values", values)
        .select(
            F.col("id").alias("project_id"),
            F.translate("name", ",", " ").alias("name"),
            F.when(F.size("tags") > 0, F.array_join("tags", "|")).alias("tags"),
            first_of(C.HUC_INDEX_KEYS).alias("huc10"),
            first_of(C.VERSION_INDEX_KEYS).alias("model_version"),
            F.coalesce("archived", F.lit(False)).alias("archived"),
            created.alias("created_on"),
            C.ms_text(created).alias("created_on_date"),
            F.col("ownedBy.id").alias("owned_by_id"),
            F.regexp_replace("ownedBy.name", ",", "").alias("owned_by_name"),
            F.col("ownedBy.__typename").alias("owned_by_type"),
            F.col("projectType.id").alias("project_type_id"),
        )
        .filter(F.col("huc10").isNotNull() & F.col("model_version").isNotNull())
        .withColumn("model_version_int", C.version_int(F.col("model_version")))
    )


def project_meta_long(catalogue: DataFrame) -> DataFrame:
    """One row per metadata entry of the last-wins map."""
    return catalogue.select("project_id", F.explode("meta_map").alias("key", "value"))


def meta_first(catalogue: DataFrame, keys: Sequence[str], length: int | None = None, name: str = "value") -> DataFrame:
    """Add the value of the first key that is present, or present with ``length`` characters."""
    rule = "ordered" if length is None else "length"
    return catalogue.withColumn(name, C.huc_of(F.col("meta"), rule, keys, length or 0))


def meta_extract(catalogue: DataFrame, keys: dict[str, str], required: str, tag: str | None = None) -> DataFrame:
    """Metadata keys as columns (``{key: column}``), for rows that carry the required key."""
    if tag is not None:
        catalogue = catalogue.filter(F.array_contains("tags", tag))
    picked = [F.try_element_at("meta_map", F.lit(k)).alias(c) for k, c in keys.items()]
    return catalogue.select("project_id", *picked).filter(F.col(keys[required]).isNotNull())


# --- search -----------------------------------------------------------------------------------

DAY = 86_400_000
# Named periods of a created-within search, in days.
PERIOD_DAYS = {"ONE_DAY": 1, "ONE_WEEK": 7, "ONE_MONTH": 30, "SIX_MONTHS": 182}
OWNER_TYPES = ("USER", "ORGANIZATION")
VISIBILITIES = ("PUBLIC", "PRIVATE", "SECRET")
_GUID = re.compile(r"[a-f0-9-]{36}")


def _moment(value) -> int | None:
    """Milliseconds of a date, a date and time or their ISO text (UTC unless it says otherwise); None if it is none."""
    try:
        moment = value if isinstance(value, datetime) else datetime.fromisoformat(str(value))
    except ValueError:
        return None
    return int((moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)).timestamp() * 1000)


def _text(value) -> bool:
    return isinstance(value, str)


def _flag(value) -> bool:
    return isinstance(value, bool)


def _guid(value) -> bool:
    return _text(value) and bool(_GUID.fullmatch(value))


def _period(value) -> bool:
    ends = [_moment(value[e]) for e in ("from", "to") if e in value] if isinstance(value, dict) else []
    return bool(ends) and len(ends) == len(value) and None not in ends and ends == sorted(ends)


def _texts(value) -> bool:
    return isinstance(value, list) and all(map(_text, value))


def _text_map(value) -> bool:
    return isinstance(value, dict) and all(map(_text, [*value, *value.values()]))


def _owner(value) -> bool:
    return isinstance(value, dict) and _guid(value.get("id")) and value.get("type") in OWNER_TYPES


def _box(value) -> bool:
    numbers = isinstance(value, list) and len(value) == 4 and all(isinstance(x, (int, float)) for x in value)
    return numbers and value[0] < value[2] and value[1] < value[3]


#: What each search field takes: a test, and the words for it.
SEARCH_FIELDS = {
    "attributedOrgId": (_text, "text"),
    "bbox": (_box, "west, south, east and north with west < east and south < north"),
    "boundsId": (_text, "text"),
    "collection": (_guid, "a GUID"),
    "createdOn": (_period, "dates under 'from' and 'to', or one of them, in order"),
    "createdWithin": (PERIOD_DAYS.__contains__, f"one of {', '.join(PERIOD_DAYS)}"),
    "editableOnly": (_flag, "true or false"),
    "excludeArchived": (_flag, "true or false"),
    "keywords": (_text, "text"),
    "meta": (_text_map, "texts under text keys"),
    "name": (_text, "text"),
    "ownedBy": (_owner, f"a GUID under 'id' and one of {', '.join(OWNER_TYPES)} under 'type'"),
    "projectTypeId": (_text, "text"),
    "tags": (_texts, "a list of texts"),
    "updatedOn": (_period, "dates under 'from' and 'to', or one of them, in order"),
    "visibility": (VISIBILITIES.__contains__, f"one of {', '.join(VISIBILITIES)}"),
}


def check_search(params: dict) -> dict:
    """The fields that are given, with periods as milliseconds. All that is wrong with them is raised at once."""
    if not isinstance(params, dict):
        raise ValueError(f"a search is a dict of fields, not {type(params).__name__}")
    given = {k: v for k, v in params.items() if v is not None}
    wrong = [f"no field {k!r}" for k in params if k not in SEARCH_FIELDS]
    for field, value in given.items():
        test, wanted = SEARCH_FIELDS.get(field, (lambda _: True, ""))
        try:
            fits = test(value)
        except TypeError:  # a value that cannot be looked up
            fits = False
        if not fits:
            wrong.append(f"{field} takes {wanted}, got {value!r}")
    if "createdOn" in given and "createdWithin" in given:
        wrong.append("createdOn and createdWithin exclude each other")
    if wrong:
        raise ValueError("; ".join(wrong))
    return {k: {end: _moment(v) for end, v in value.items()} if SEARCH_FIELDS[k][0] is _period else value for k, value in given.items()}


def search_condition(params: dict, now_ms: int | None = None, me: str | None = None) -> Column:
    """All conditions of a search as one predicate; simple comparisons reach the Parquet scan.

    ``editableOnly`` needs ``me``: what a user may edit is what the user owns.
    """
    p = check_search(params)
    tests: list[Column] = []
    if p.get("editableOnly"):
        if me is None:
            raise ValueError("without a user nothing is editable: give me")
        tests.append(F.col("owner_id") == me)
    if p.get("excludeArchived", True):
        tests.append(~F.col("archived"))
    if "projectTypeId" in p:
        tests.append(F.lower("project_type_id") == p["projectTypeId"].lower())
    for tag in p.get("tags", []):
        tests.append(F.array_contains("tags", tag))
    for key, value in p.get("meta", {}).items():
        tests.append(F.try_element_at("meta_map", F.lit(key)) == value)
    for key, column in (("createdOn", "created_on"), ("updatedOn", "updated_on")):
        if "from" in p.get(key, {}):
            tests.append(F.col(column) >= p[key]["from"])
        if "to" in p.get(key, {}):
            tests.append(F.col(column) <= p[key]["to"])
    if "createdWithin" in p:
        if now_ms is None:
            now_ms = int(datetime.now(timezone.utc).timestamp() * 1000)
        tests.append(F.col("created_on") >= now_ms - PERIOD_DAYS[p["createdWithin"]] * DAY)
    if "bbox" in p:
        x0, y0, x1, y1 = map(float, p["bbox"])
        tests += [F.col("xmin") <= x1, F.col("xmax") >= x0, F.col("ymin") <= y1, F.col("ymax") >= y0]
    for key, column in (("collection", "collection_id"), ("boundsId", "bounds_id"), ("visibility", "visibility"), ("attributedOrgId", "attributed_org_id")):
        if key in p:
            tests.append(F.col(column) == p[key])
    if "ownedBy" in p:
        tests += [F.col("owner_id") == p["ownedBy"]["id"], F.col("owner_type") == p["ownedBy"]["type"]]
    if "name" in p:
        tests.append(F.lower("name").contains(p["name"].lower()))
    for word in p.get("keywords", "").lower().split():
        text = F.lower(F.concat_ws(" ", F.col("name"), F.col("tags"), F.map_values("meta_map")))
        tests.append(text.contains(word))
    condition = F.lit(True)
    for test in tests:
        condition = condition & test
    return condition


def search_projects(index: DataFrame, params: dict, now_ms: int | None = None, me: str | None = None) -> DataFrame:
    """Projects that meet every given condition; archived ones only when asked for."""
    return index.filter(search_condition(params, now_ms, me))


# sort name -> (column, descending); every order ends with the project id
SORTS = {
    "AREA_DESC": ("area", True),
    "DATE_CREATED_ASC": ("created_on", False),
    "DATE_CREATED_DESC": ("created_on", True),
    "DATE_UPDATED_ASC": ("updated_on", False),
    "DATE_UPDATED_DESC": ("updated_on", True),
    "MINE": ("mine", True),
    "MODEL_VERSION_ASC": ("model_version_int", False),
    "MODEL_VERSION_DESC": ("model_version_int", True),
    "NAME_ASC": ("name", False),
    "NAME_DESC": ("name", True),
}


def search_page(index: DataFrame, sort: str = "DATE_CREATED_DESC", after: tuple | None = None, limit: int | None = None, me: str | None = None) -> DataFrame:
    """One page of results. ``after`` is (sort value, project id) of the last row seen.

    The page key includes the id, so rows sharing a sort value at a page edge are not lost.
    NULL sort values come last.
    """
    if sort not in SORTS:
        raise ValueError(f"unknown sort order: {sort}")
    column, descending = SORTS[sort]
    if column == "area":
        index = index.withColumn("area", (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")))
    if column == "mine":
        index = index.withColumn("mine", (F.col("owner_id") == F.lit(me)).cast("int"))
    key, pid = F.col(column), F.col("project_id")
    if after is not None:
        value, last_id = after
        if value is None:
            index = index.filter(key.isNull() & (pid > last_id))
        else:
            beyond = key < F.lit(value) if descending else key > F.lit(value)
            index = index.filter(beyond | ((key == F.lit(value)) & (pid > last_id)) | key.isNull())
    page = index.orderBy(key.desc_nulls_last() if descending else key.asc_nulls_last(), pid.asc())
    return page if limit is None else page.limit(limit)


def search_facets(index: DataFrame, params: dict, meta_keys: Sequence[str] = ()) -> DataFrame:
    """Counts per project type and per metadata key/value with the extent and summed area of each.

    The row of facet ``total`` covers everything found. One scan, one shuffle of partial counts.
    """
    found = search_projects(index, params)
    entry = "struct<facet:string,key:string,value:string>"

    def facet(name: str, key: Column, value: Column) -> Column:
        return F.struct(F.lit(name).alias("facet"), key.cast("string").alias("key"), value.cast("string").alias("value")).cast(entry)

    entries = F.map_entries("meta_map")
    if meta_keys:
        entries = F.filter(entries, lambda e: e["key"].isin(list(meta_keys)))
    listed = F.concat(
        F.array(facet("total", F.lit(None), F.lit(None)), facet("type", F.lit("project_type_id"), F.col("project_type_id"))),
        F.transform(entries, lambda e: facet("meta", e["key"], e["value"])),
    )
    area = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    return (
        found.select(F.explode(listed).alias("f"), "xmin", "ymin", "xmax", "ymax", area.alias("area"))
        .groupBy("f.facet", "f.key", "f.value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("xmin").alias("xmin"),
            F.min("ymin").alias("ymin"),
            F.max("xmax").alias("xmax"),
            F.max("ymax").alias("ymax"),
            F.sum("area").alias("area"),
        )
    )


# Fixed value: the geohash alphabet.
GEOHASH_DIGITS = "0123456789bcdefghjkmnpqrstuvwxyz"


def _cell(value: Column, low: float, span: float, bits: int) -> Column:
    """Index of the half interval a coordinate falls in after ``bits`` halvings."""
    top = 2**bits - 1
    return F.least(F.greatest(F.floor((value - low) / span * 2**bits).cast("bigint"), F.lit(0)), F.lit(top))


def _geohash(ix: Column, iy: Column, precision: int) -> Column:
    """Interleave the two indexes, longitude bit first, five bits to a digit."""
    bits = 5 * precision
    x_bits, y_bits = (bits + 1) // 2, bits // 2
    digits = []
    for start in range(0, bits, 5):
        value = F.lit(0).cast("bigint")
        for b in range(start, start + 5):
            source, width = (ix, x_bits) if b % 2 == 0 else (iy, y_bits)
            bit = F.shiftright(source, width - 1 - b // 2).bitwiseAND(F.lit(1))
            value = value * 2 + bit
        digits.append(F.substring(F.lit(GEOHASH_DIGITS), (value + 1).cast("int"), F.lit(1)))
    return F.concat(*digits)


def map_clusters(index: DataFrame, precision: int, limit: int) -> DataFrame:
    """Project counts per geohash cell: the ``limit`` fullest cells and one row for the rest.

    The row without a geohash carries the number of projects outside the listed cells.
    """
    if not 1 <= precision <= 12:
        raise ValueError("precision must be between 1 and 12")
    x_bits, y_bits = (5 * precision + 1) // 2, 5 * precision // 2
    lon, lat = (F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2
    counts = (
        index.filter(lon.isNotNull() & lat.isNotNull())
        .groupBy(_cell(lon, -180.0, 360.0, x_bits).alias("ix"), _cell(lat, -90.0, 180.0, y_bits).alias("iy"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cells = counts.select(
        _geohash(F.col("ix"), F.col("iy"), precision).alias("geohash"),
        (-180.0 + (F.col("ix") + 0.5) * (360.0 / 2**x_bits)).alias("lon"),
        (-90.0 + (F.col("iy") + 0.5) * (180.0 / 2**y_bits)).alias("lat"),
        "n",
    )
    kept = cells.orderBy(F.desc("n"), "geohash").limit(limit)
    rest = cells.join(kept.select("geohash"), "geohash", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return kept.unionByName(rest, allowMissingColumns=True)


# --- simple filters ---------------------------------------------------------------------------

def filter_type(docs: DataFrame, type_id: str, observation: Observation | None = None) -> DataFrame:
    """Documents of one project type; an observation, if given, gets the scanned and kept counts."""
    hit = F.coalesce(F.lower(F.trim("projectType.id")) == type_id.strip().lower(), F.lit(False))
    if observation is not None:
        docs = docs.observe(observation, F.count(F.lit(1)).alias("scanned"), F.count_if(hit).alias("kept"))
    return docs.filter(hit)


def missing_bounds(docs: DataFrame) -> DataFrame:
    """Documents without a usable bounds id."""
    return docs.filter(C.is_blank(F.col("bounds.id")))


def match_files(manifest: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Files whose path starts with a match of any pattern, ignoring case; NULL paths never match."""
    return manifest.filter(F.col("local_path").rlike(C.any_of(patterns)))


def first_match(manifest: DataFrame, pattern: str, by: str = "huc") -> DataFrame:
    """The first matching path of every watershed, in path order."""
    return match_files(manifest, [pattern]).groupBy(by).agg(F.min("local_path").alias("local_path"))


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """What to do with each path: create, update (etag differs), unchanged or delete."""
    before = old.filter(F.col("local_path").isNotNull()).select("local_path", F.col("etag").alias("old_etag"), F.lit(True).alias("in_old"))
    after = new.filter(F.col("local_path").isNotNull()).select("local_path", F.col("etag").alias("new_etag"), "size", F.lit(True).alias("in_new"))
    action = (
        F.when(F.col("in_old").isNull(), "create")
        .when(F.col("in_new").isNull(), "delete")
        .when(F.col("old_etag").eqNullSafe(F.col("new_etag")), "unchanged")
        .otherwise("update")
    )
    return before.join(after, "local_path", "full").select("local_path", action.alias("action"), "old_etag", "new_etag", "size")


def with_huc_levels(df: DataFrame, column: str = "huc10", levels: Sequence[int] = (2, 4, 6, 8, 10)) -> DataFrame:
    """Parent watershed codes as prefixes; a code shorter than a level has no such parent."""
    code = F.col(column)
    return df.withColumns({f"huc{n}": F.when(F.length(code) >= n, F.substring(code, 1, n)) for n in levels if f"huc{n}" != column})
