"""Tag lists, attributions and planned field changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.functions.columns import bind


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def tags_missing_any(df: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Projects lacking at least one of the tags."""
    return df.filter(F.size(F.array_except(_texts(tags), F.coalesce("tags", _texts([])))) > 0)


def tags_add(df: DataFrame, tags: Sequence[str], mode: str = "add") -> DataFrame:
    """Projects whose tags change, with ``new_tags``.

    add      append what is missing, keeping the order
    merge    the set of old and new tags
    replace  the given tags
    A project whose tags already equal the result as multisets is left out.
    """
    given, old = _texts(tags), F.coalesce("tags", _texts([]))
    if mode == "add":
        new = F.concat(old, F.array_except(given, old))
    elif mode == "merge":
        new = F.array_union(old, given)
    elif mode == "replace":
        new = given
    else:
        raise ValueError(f"unknown tag mode: {mode}")
    changed = df.withColumn("new_tags", new)
    return changed.filter(F.array_sort("new_tags") != F.array_sort(old))


def tags_remove(df: DataFrame, tag: str) -> DataFrame:
    """Projects that carry the tag, with ``new_tags`` lacking it."""
    return df.filter(F.array_contains("tags", tag)).withColumn("new_tags", F.array_remove("tags", tag))


# Tag kinds required per project type, watershed spellings, and tag prefixes.
REQUIRED_KINDS = {
    "champphotos": ["year", "watershed"],
    "cad_export": ["site", "visit", "year", "watershed"],
    "topo": ["visit", "year", "site", "watershed"],
    "fhm": ["site", "watershed"],
    "hydro": ["site", "visit", "year", "watershed"],
}
WATERSHED_NAMES = {
    "SouthForkSalmon": "South Fork Salmon",
    "JohnDay": "John Day",
    "UpperGrandeRonde": "Upper Grande Ronde",
    "YankeeFork": "Yankee Fork",
    "WallaWalla": "Walla Walla",
}
TAG_PREFIX = "CHAMP_"
OWN_PREFIXES = ("CHAMP_", "CHaMP_")
KINDS = ["watershed", "site", "year", "visit"]


def _facts(meta: Column) -> dict[str, Column]:
    """The four tag facts of a metadata map; a number of zero counts as not given."""

    def first_text(*keys: str) -> Column:
        return F.coalesce(*[F.nullif(F.try_element_at(meta, F.lit(k)), F.lit("")) for k in keys])

    def number(text: Column) -> Column:
        return F.nullif(text.try_cast("bigint"), F.lit(0)).cast("string")

    names = F.create_map(*[F.lit(x) for pair in WATERSHED_NAMES.items() for x in pair])
    watershed = F.try_element_at(meta, F.lit("Watershed"))
    return {
        "watershed": F.coalesce(F.try_element_at(names, watershed), watershed),
        "site": first_text("Site", "SiteName"),
        "year": number(first_text("Year", "FieldSeason")),
        "visit": number(first_text("Visit", "VisitNumber", "VisitID")),
    }


def _required(rules: dict[str, Sequence[str]], kind: str) -> Column:
    return F.col("project_type_id").isin([t for t, kinds in rules.items() if kind in kinds])


def required_meta(df: DataFrame, rules: dict[str, Sequence[str]] = REQUIRED_KINDS) -> DataFrame:
    """Projects of the ruled types with the required metadata kinds they lack (``missing``)."""

    def lacking(meta: Column) -> Column:
        facts = _facts(meta)
        return F.array_compact(F.array(*[F.when(_required(rules, k) & facts[k].isNull(), k) for k in KINDS]))

    return df.filter(F.col("project_type_id").isin(list(rules))).withColumn("missing", bind(F.col("meta_map"), lacking))


def pad4(text: Column) -> Column:
    """Left pad with zeros to four digits, never cutting longer numbers."""
    return F.when(F.length(text) < 4, F.lpad(text, 4, "0")).otherwise(text)


def tags_canonical(df: DataFrame, rules: dict[str, Sequence[str]] = REQUIRED_KINDS, prefix: str = TAG_PREFIX, own: Sequence[str] = OWN_PREFIXES) -> DataFrame:
    """The canonical tags of projects that have all required metadata.

    Foreign tags are kept, own tags rebuilt from the metadata; ``added_<kind>`` is 1 where a
    kind's tag was not there yet, ``changed`` whether any was added.
    """
    def texts(meta: Column) -> Column:
        facts = _facts(meta)
        texts = {
            "watershed": F.concat(F.lit(f"{prefix}Watershed_"), F.translate(facts["watershed"], " ()", "_")),
            "site": F.concat(F.lit(f"{prefix}Site_"), F.translate(facts["site"], " ", "_")),
            "year": F.concat(F.lit(f"{prefix}Year_"), facts["year"]),
            "visit": F.concat(F.lit(f"{prefix}Visit_"), pad4(facts["visit"])),
        }
        return F.struct(*[F.when(_required(rules, k), texts[k]).alias(k) for k in KINDS])

    complete = required_meta(df, rules).filter(F.size("missing") == 0).drop("missing")
    tagged = complete.withColumn("__new", bind(F.col("meta_map"), texts))
    foreign = F.filter("tags", lambda t: ~F.coalesce(*[F.when(t.startswith(p), True) for p in own], F.lit(False)))
    added = {f"added_{k}": F.coalesce((~F.array_contains("tags", F.col(f"__new.{k}"))).cast("int"), F.lit(0)) for k in KINDS}
    out = tagged.withColumn("new_tags", F.concat(foreign, F.array_compact(F.array(*[F.col(f"__new.{k}") for k in KINDS])))).withColumns(added)
    changed = F.greatest(*[F.col(f"added_{k}") for k in KINDS]) > 0
    return out.withColumn("changed", changed).drop("__new")


def tag_additions(canonical: DataFrame) -> DataFrame:
    """How many projects change and how many tags of each kind are added."""
    return canonical.agg(F.count_if("changed").alias("projects"), *[F.sum(f"added_{k}").alias(f"added_{k}") for k in KINDS])


ATTRIBUTION = "array<struct<organizationId:string,roles:array<string>>>"


def attribution_resolve(df: DataFrame, org: str, roles: Sequence[str], mode: str, column: str = "attribution") -> DataFrame:
    """Projects whose attribution list changes, with the resolved list in ``new_attribution``.

    ADD      merge the roles into the organisation's first entry, or append an entry
    REPLACE  only the given entry
    REMOVE   drop all entries of the organisation
    Entries without organisation are malformed and dropped first. Two lists are equal when they
    name the same organisations in the same order with the same set of roles.
    """
    entry = F.struct(F.lit(org).alias("organizationId"), _texts(roles).alias("roles"))
    target = F.array(entry).cast(ATTRIBUTION)
    well_formed = F.filter(F.coalesce(column, F.array().cast(ATTRIBUTION)), lambda x: x["organizationId"].isNotNull() & (x["organizationId"] != ""))
    base = df.withColumn("__current", F.transform(well_formed, lambda x: F.struct(x["organizationId"].alias("organizationId"), F.coalesce(x["roles"], _texts([])).alias("roles"))))
    current = F.col("__current")
    if mode == "REPLACE":
        new = target
    elif mode == "REMOVE":
        new = F.filter(current, lambda x: x["organizationId"] != org)
    elif mode == "ADD":
        at = F.array_position(F.transform(current, lambda x: x["organizationId"]), F.lit(org))
        merged = F.transform(
            current,
            lambda x, i: F.struct(
                x["organizationId"].alias("organizationId"),
                F.when(i + 1 == at, F.array_union(x["roles"], _texts(roles))).otherwise(x["roles"]).alias("roles"),
            ),
        )
        new = F.when(at > 0, merged).otherwise(F.concat(current, target))
    else:
        raise ValueError(f"unknown attribution mode: {mode}")

    def canonical(c: Column) -> Column:
        return F.transform(c, lambda x: F.struct(x["organizationId"].alias("o"), F.array_sort(F.array_distinct(x["roles"])).alias("r")))

    return base.withColumn("new_attribution", new).filter(canonical(F.col("new_attribution")) != canonical(current)).drop("__current")


def field_changes(df: DataFrame, column: str, value: str) -> DataFrame:
    """Projects whose field would change to ``value`` (NULL counts as different)."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value))).withColumn("new_value", F.lit(value))


