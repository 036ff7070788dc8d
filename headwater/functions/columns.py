"""Scalar column expressions. Everything here stays inside Catalyst."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000


# --- versions ---------------------------------------------------------------------------------

def version_clean(version: Column) -> Column:
    """Drop blanks around and leading zeros of each number: `` 03.01.05 `` becomes ``3.1.5``."""
    return F.regexp_replace(F.trim(version), r"\b0+([0-9])", "$1")


SEMVER = r"^\d+\.\d+\.\d+(?:-[0-9A-Za-z.-]+)?(?:\+[0-9A-Za-z.-]+)?$"


def version_parts(version: Column) -> Column:
    """``[major, minor, patch]`` of a version text, NULL when the text is not a version."""
    clean = version_clean(version)
    return F.when(clean.rlike(SEMVER), F.transform(F.slice(F.split(clean, "[.+-]"), 1, 3), lambda x: x.try_cast("bigint")))


def parts_int(parts: Column) -> Column:
    """Sortable number ``major*1e6 + minor*1e3 + patch``.

    Versions with a minor or patch of 1000 and more collide, and pre-release tags are ignored:
    kept on purpose, stored tables use this coding.
    """
    return parts[0] * 1_000_000 + parts[1] * 1_000 + parts[2]


def version_int(version: Column) -> Column:
    """:func:`parts_int` of a version text, NULL when the text is not a version."""
    return bind(version_parts(version), parts_int)


# --- metadata lists ---------------------------------------------------------------------------

META = "array<struct<key:string,value:string>>"


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def last_value(meta: Column, key: str) -> Column:
    hits = F.filter(meta, lambda x: x["key"] == key)
    return F.try_element_at(hits, F.lit(-1))["value"]


def meta_map(meta: Column) -> Column:
    """``array<struct<key,value>>`` to a map where the *last* entry of a repeated key wins."""

    def build(listed: Column) -> Column:
        keys = F.array_distinct(F.transform(listed, lambda x: x["key"]))
        picked = F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(listed, lambda x: x["key"] == k), -1)["value"]))
        # few rows repeat a key, only those pay for the lookups
        return F.when(F.size(keys) == F.size(listed), F.map_from_entries(listed)).otherwise(picked)

    keyed = F.filter(F.coalesce(meta, F.array().cast(META)), lambda x: x["key"].isNotNull())
    return bind(keyed, build)


def normal_key(key: Column) -> Column:
    """Lower case without blanks, dashes and underscores."""
    return F.translate(F.lower(key), " -_", "")


def normal_meta_map(meta: Column) -> Column:
    """Like :func:`meta_map`, keyed by the normalised key."""
    return meta_map(F.transform(meta, lambda x: F.struct(normal_key(x["key"]).alias("key"), x["value"].alias("value"))))


def first_entry(meta: Column, keys: Sequence[str]) -> Column:
    """Value of the *first* list entry whose key is one of ``keys``."""
    hits = F.filter(meta, lambda x: x["key"].isin(list(keys)))
    return F.get(hits, F.lit(0))["value"]


# Key names under which projects carry their watershed code and model version.
HUC_SCAN_KEYS = ["HUC", "Hydrologic Unit Code", "HUV"]
HUC_INDEX_KEYS = ["HUC10", "huc10", "HUC", "huc"]
VERSION_INDEX_KEYS = ["modelVersion", "model_version", "Model Version"]


def huc_of(meta: Column, rule: str, keys: Sequence[str] = ("HUC10", "huc10", "HUC", "huc"), length: int = 10) -> Column:
    """The watershed code by one of the five rules in use; the rules differ on purpose.

    normal   value of the normalised key ``huc`` (last entry wins)
    ordered  first key of ``keys`` that is present
    length   first key of ``keys`` whose value has ``length`` characters
    scan     first list entry whose key is HUC, Hydrologic Unit Code or HUV
    digits   as ``scan``, keeping digits only; NULL when none are left
    """
    if rule == "normal":
        return F.try_element_at(normal_meta_map(meta), F.lit("huc"))
    if rule in ("ordered", "length"):

        def pick(listed: Column) -> Column:
            last = [last_value(listed, k) for k in keys]
            return F.coalesce(*([F.when(F.length(v) == length, v) for v in last] if rule == "length" else last))

        return bind(meta, pick)
    if rule == "scan":
        return first_entry(meta, HUC_SCAN_KEYS)
    if rule == "digits":
        return digits_only(first_entry(meta, HUC_SCAN_KEYS))
    raise ValueError(f"unknown watershed code rule: {rule}")


def digits_only(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, "[^0-9]", ""), F.lit(""))


# --- time -------------------------------------------------------------------------------------

def to_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def whole_seconds(ms: Column) -> Column:
    """Milliseconds cut to the second."""
    return F.floor(ms / 1000).cast("bigint") * 1000


def day_floor(ms: Column) -> Column:
    """Milliseconds of the UTC midnight before."""
    return F.floor(ms / DAY_MS).cast("bigint") * DAY_MS


def ms_text(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")


# --- text and numbers -------------------------------------------------------------------------

def is_guid(text: Column) -> Column:
    return text.rlike("^[a-f0-9-]{36}$")


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def any_of(patterns: Sequence[str]) -> str:
    """One pattern, anchored at the start and ignoring case, for 'any of these match'."""
    return "(?i)^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")"


def human_size(n_bytes: Column) -> Column:
    """Bytes as ``12.3 KB`` in steps of 1024."""
    units = ["B", "KB", "MB", "GB", "TB"]
    size = n_bytes.cast("double")
    text = F.format_string("%.1f %s", size / 1024 ** (len(units) - 1), F.lit(units[-1]))
    for power in range(len(units) - 2, -1, -1):
        text = F.when(size < 1024 ** (power + 1), F.format_string("%.1f %s", size / 1024**power, F.lit(units[power]))).otherwise(text)
    return text


def fixed4(number: Column) -> Column:
    """Four decimals, rounded as the binary value is (``format_number``, not ``format_string``)."""
    return F.call_function("format_number", number, F.lit("0.0000"))


def tsv_safe(text: Column) -> Column:
    """Commas become ``|`` and NULL the empty string."""
    return F.coalesce(F.translate(text, ",", "|"), F.lit(""))


def nearly_equal(a: Column, b: Column, rel: float = 1e-9, abs_tol: float = 0.0) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_tol))


def object_uri(uri: Column) -> Column:
    """Repair ``s3:`` addresses written with backslashes or a wrong number of slashes."""
    return F.regexp_replace(F.translate(uri, "\\", "/"), "^s3:/+", "s3://")
