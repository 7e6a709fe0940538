"""Row and map helpers: key lists, ordinals, zips, flags over a group, pages with totals, costs, redacted addresses, JSON schemas, ordering times."""

from __future__ import annotations

import json
import re
from urllib.parse import parse_qsl, quote, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..storage import cut
from .temporal import ZONE, day_start


def keep_keys(values: Column, keys: list[str]) -> Column:
    """The entries of a map whose key is listed."""
    return F.map_filter(values, lambda k, v: k.isin(*keys) if keys else F.lit(False))


def drop_keys(values: Column, keys: list[str]) -> Column:
    """The entries of a map whose key isn't listed."""
    return F.map_filter(values, lambda k, v: ~k.isin(*keys) if keys else F.lit(True))


def strip_nulls(values: Column) -> Column:
    return F.map_filter(values, lambda k, v: v.isNotNull())


def merged(left: Column, right: Column) -> Column:
    """The right map's entries that aren't null over the left's."""
    own = strip_nulls(right)
    return F.map_concat(F.map_filter(left, lambda k, v: ~F.array_contains(F.map_keys(own), k)), own)


def newer(left: list[Column], right: list[Column]) -> Column:
    """Whether a row of values is greater than another, from the first on; nulls are the least."""
    names = [f"c{i}" for i in range(len(left))]
    return F.struct(*[c.alias(n) for c, n in zip(left, names, strict=True)]) > F.struct(*[c.alias(n) for c, n in zip(right, names, strict=True)])


def has_prefix(code: Column, prefix: str | None) -> Column:
    return F.lit(True) if not prefix else F.coalesce(code.startswith(prefix), F.lit(False))


def ordinals(df: DataFrame, order: list[str], name: str = "ordinal", start: int = 1) -> DataFrame:
    """``df`` with the number of each row in the order of unique columns, by a range sort and the sizes of its partitions: no task has all rows."""
    d = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id() % (1 << 33)))
    sizes = sorted((r["_part"], r["count"]) for r in d.groupBy("_part").count().collect())  # a number for each partition
    total, before = start, []
    for part, n in sizes:
        before += [F.lit(part), F.lit(total)]
        total += n
    offset = F.try_element_at(F.create_map(*before), F.col("_part")) if before else F.lit(start)
    return d.withColumn(name, (offset + F.col("_at")).cast("long")).drop("_part", "_at")


def zip_rows(left: DataFrame, left_order: list[str], right: DataFrame, right_order: list[str]) -> DataFrame:
    """First with first, second with second, as far as both go; columns are ``ordinal``, the left's and the right's."""
    return ordinals(left, left_order).join(ordinals(right, right_order), "ordinal")


def any_in_group(condition: Column, keys: list[str]) -> Column:
    """Whether a condition holds on any row of the group."""
    return F.max(F.coalesce(condition, F.lit(False))).over(Window.partitionBy(*keys))


def is_least(value: str, keys: list[str]) -> Column:
    """Whether a row has its group's least value; ties all have."""
    return F.col(value) == F.min(value).over(Window.partitionBy(*keys))


def section_number(name: Column, pattern: str) -> Column:
    """The number in a part's name, for sorting: group 1 of the pattern; names without one come last."""
    return F.coalesce(F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).try_cast("long"), F.lit(2**62))


def page(df: DataFrame, order: list[Column], size: int, offset: int = 0) -> tuple[DataFrame, DataFrame]:
    """(rows of a page, (total)): the total is of all rows, also for a page beyond the end."""
    return df.orderBy(*order).offset(offset).limit(size), df.agg(F.count("*").alias("total"))


def priority(column: Column, order: list[str]) -> Column:
    """A sort key: the place in a list, values that it lacks last."""
    place = F.array_position(F.array(*map(F.lit, order)), column)
    return F.when(place > 0, place).otherwise(len(order) + 1)


def response_cost(usage: Column) -> Column:
    """What a paid answer cost, of a JSON text {is_byok, cost, cost_details: {upstream_inference_cost}}: null where it isn't told, so that a reservation stands.

    With an own key the upstream charge and the router's fee are both due.
    """
    v = F.try_parse_json(usage)
    number = lambda p: F.when(F.schema_of_variant(F.try_variant_get(v, p, "variant")).rlike("^(BIGINT|DOUBLE|DECIMAL)"), F.try_variant_get(v, p, "decimal(20,8)"))
    own = F.coalesce(F.try_variant_get(v, "$.is_byok", "boolean"), F.lit(False)) & (F.schema_of_variant(F.try_variant_get(v, "$.is_byok", "variant")) == "BOOLEAN")
    fee, up = number("$.cost"), number("$.cost_details.upstream_inference_cost")
    return F.when(own, F.when((fee >= 0) & (up >= 0), fee + up)).otherwise(F.when(fee >= 0, fee))


def spent(requests: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """(key, used, requests) of the last hours for requests (key, at, cost, reserved, state): the cost where it is known, else the reservation; cancelled ones are free.

    The window is exact to the microsecond: a request of the moment ``hours`` before now is out, one just after it is in.
    """
    recent = requests.where((F.unix_micros(now) - F.unix_micros(F.col("at").cast("timestamp")) < hours * 3_600_000_000) & (F.col("at") <= now))
    due = F.when(F.col("state") == "CANCELLED", F.lit(0)).otherwise(F.coalesce("cost", "reserved"))
    return recent.groupBy("key").agg(F.sum(due).alias("used"), F.count("*").alias("requests"))


def admitted(requests: DataFrame, limit: float) -> DataFrame:
    """Requests (key, ordinal, reserved) with ``admitted``: as long as the key's reservations up to this one stay within the limit."""
    w = Window.partitionBy("key").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    return requests.withColumn("admitted", F.sum("reserved").over(w) <= limit)


@F.pandas_udf(StringType())
def redacted_url(urls: pd.Series) -> pd.Series:
    """An address without user, password and fragment, values of secret parameters replaced, parameters sorted; null for what is no http address."""
    secret = re.compile(r"key|token|secret|passw|auth|signature|sig$|credential", re.I)

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            u = urlsplit(text)
            host, port = u.hostname, u.port
        except ValueError:
            return None
        if u.scheme not in ("http", "https") or not host:
            return None
        pairs = sorted((k, "REDACTED" if secret.search(k) else v) for k, v in parse_qsl(u.query, keep_blank_values=True))
        query = "&".join(f"{quote(k, safe='')}={quote(v, safe='')}" for k, v in pairs)
        return f"{u.scheme}://{host}{f':{port}' if port else ''}{u.path}{'?' + query if query else ''}"

    return urls.map(one)


def request_fingerprint(url: Column) -> Column:
    """Hash of the redacted address: equal for requests that differ in credentials only."""
    return F.sha2(redacted_url(url), 256)


# --- JSON schemas ---

DEEPEST = 64


def schema_issues(value, schema: dict, root: dict | None = None, path: str = "", depth: int = 0) -> list[str]:
    """Codes ``path:CODE`` of what a JSON value breaks, in order: type, enum, required and extra properties, lengths, patterns, ranges; ``$ref`` to ``#/$defs``, ``anyOf``."""
    root = root or schema
    if depth > DEEPEST:
        return [f"{path}:SCHEMA_DEPTH_LIMIT"]
    if "$ref" in schema:
        name = schema["$ref"].removeprefix("#/$defs/")
        if set(schema) - {"$ref", "description"} or name not in root.get("$defs", {}) or not schema["$ref"].startswith("#/$defs/"):
            return [f"{path}:INVALID_REFERENCE"]
        return schema_issues(value, root["$defs"][name], root, path, depth + 1)
    if "anyOf" in schema:
        return [] if any(not schema_issues(value, s, root, path, depth + 1) for s in schema["anyOf"]) else [f"{path}:ANY_OF"]
    kinds = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
    kind = schema.get("type")
    if kind in kinds and not isinstance(value, kinds[kind]) or kind == "integer" and (isinstance(value, bool) or not isinstance(value, int)) or kind == "number" and (isinstance(value, bool) or not isinstance(value, (int, float))):
        return [f"{path}:TYPE"]
    out = [f"{path}:ENUM"] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}/{k}:REQUIRED" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{path}/{k}:EXTRA_PROPERTY" for k in value if k not in known]
        for k, s in known.items():
            if k in value:
                out += schema_issues(value[k], s, root, f"{path}/{k}", depth + 1)
    elif isinstance(value, list):
        out += [f"{path}:TOO_FEW_ITEMS"] if len(value) < schema.get("minItems", 0) else []
        out += [f"{path}:TOO_MANY_ITEMS"] if len(value) > schema.get("maxItems", len(value)) else []
        for i, x in enumerate(value if "items" in schema else []):
            out += schema_issues(x, schema["items"], root, f"{path}/{i}", depth + 1)
    elif isinstance(value, str):
        out += [f"{path}:PATTERN"] if "pattern" in schema and not re.search(schema["pattern"], value) else []
        out += [f"{path}:STRING_LENGTH"] if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)) else []
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        out += [f"{path}:NUMBER_RANGE"] if not schema.get("minimum", value) <= value <= schema.get("maximum", value) else []
    return out


def schema_validator(schema: dict):
    """A function of a JSON text column: the codes that a document breaks, INVALID_JSON for a text that is none; null for null."""

    @F.pandas_udf(ArrayType(StringType()))
    def validate(values: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[str] | None:
            if text is None:
                return None
            try:
                return schema_issues(json.loads(text), schema)
            except ValueError:
                return [":INVALID_JSON"]

        return values.map(one)

    return validate


# --- ordering times ---


def ordering_time(posted: Column, modified: Column, published: Column, retrieved: Column, zone: str = ZONE) -> Column:
    """struct<published_on, date_issue, field, at, issue>: the time by which a record is ordered, of the first field that is given.

    modified, published (full times with an offset), the posted day (its start in the zone), retrieved. A field that is given but no time is an issue, and no later field counts.
    """
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    stamp = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
    day = F.when(text(posted).rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.to_date(F.try_to_timestamp(text(posted), F.lit("yyyy-MM-dd"))))
    date_issue = F.when(text(posted).isNull(), "POSTING_DATE_UNKNOWN").when(day.isNull(), "POSTING_DATE_INVALID")
    field = F.when(text(modified).isNotNull(), "modified").when(text(published).isNotNull(), "published").when(day.isNotNull(), "posted").otherwise("retrieved")
    instant = lambda c: F.when(c.rlike(stamp), F.try_to_timestamp(c))
    at = F.when(field == "modified", instant(modified)).when(field == "published", instant(published)).when(field == "posted", day_start(day, zone)).otherwise(retrieved)
    issue = F.when(at.isNull() & field.isin("modified", "published"), "ORDERING_TIMESTAMP_INVALID").when(at.isNull(), "ORDERING_TIMESTAMP_UNKNOWN")
    return F.struct(day.alias("published_on"), date_issue.alias("date_issue"), field.alias("field"), at.alias("at"), issue.alias("issue"))
