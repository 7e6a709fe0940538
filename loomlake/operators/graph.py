"""Property graph projection: nodes, edges, flat properties, taxonomies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import cut, discard


def nodes(df: DataFrame, label: str, key: Column, properties: list[str]) -> DataFrame:
    """(node_id, label, properties json, content_hash)."""
    p = F.to_json(F.struct(*sorted(properties)), {"ignoreNullFields": "true"})
    node = F.concat(F.lit(label.lower() + "/"), key.cast("string"))
    return df.select(node.alias("node_id"), F.lit(label).alias("label"), p.alias("properties"), F.sha2(F.concat(node, F.lit("\n"), p), 256).alias("content_hash"))


def edges(df: DataFrame, subject: Column, predicate: str, target: Column) -> DataFrame:
    """(edge_id, subject_id, predicate, object_id), each once; the id is a hash of the three."""
    e = df.select(subject.cast("string").alias("subject_id"), F.lit(predicate).alias("predicate"), target.cast("string").alias("object_id")).where("subject_id IS NOT NULL AND object_id IS NOT NULL").distinct()
    return e.select(F.sha2(F.concat_ws("\n", "subject_id", "predicate", "object_id"), 256).alias("edge_id"), "*")


def dangling(edges_: DataFrame, nodes_: DataFrame) -> DataFrame:
    """Edges with an end that is no node."""
    ids = nodes_.select("node_id")
    ends = [edges_.join(ids, edges_[c] == ids["node_id"], "left_anti").withColumn("missing", F.lit(c)) for c in ("subject_id", "object_id")]
    return reduce(DataFrame.unionByName, ends)


def collapse(edges_: DataFrame, binding: DataFrame, dropped: tuple[str, ...] = ("HAS_REVISION",)) -> DataFrame:
    """Edges of revision nodes moved to their entity (binding: revision_id, entity_id); loops and ``dropped`` predicates go."""
    b = binding.select(F.col("revision_id").alias("_r"), F.col("entity_id").alias("_e"))
    e = edges_.where(~F.col("predicate").isin(*dropped))
    for c in ("subject_id", "object_id"):
        e = e.join(b, F.col(c) == F.col("_r"), "left").withColumn(c, F.coalesce("_e", c)).drop("_r", "_e")
    return e.where("subject_id <> object_id").select("subject_id", "predicate", "object_id").distinct()


def flat_properties(df: DataFrame, key: str, json_column: str) -> DataFrame:
    """(key, path, kind, value): leaves of JSON objects of any depth, names joined by dots (in a name ``~`` is ``~0``, ``.`` is ``~2``).

    Values keep their JSON kind (``string``, ``number``, ``boolean``, ``array``); nulls are left out, and so is text that is no object. An array must be of plain
    values of one kind: others have the kind ``invalid``. One round for each level of the deepest object.
    """
    inner = "map<string,variant>"
    level = df.select(F.col(key).alias("_key"), F.lit("").alias("_path"), F.try_parse_json(json_column).alias("_v")).where("schema_of_variant(_v) LIKE 'OBJECT%'")
    found = None
    while True:
        each = level.select("_key", "_path", F.explode(F.try_variant_get("_v", "$", inner)).alias("_name", "_v")).where("_v IS NOT NULL AND NOT is_variant_null(_v)")
        name = F.replace(F.replace("_name", F.lit("~"), F.lit("~0")), F.lit("."), F.lit("~2"))
        each = cut(each.select("_key", F.concat("_path", F.when(F.col("_path") != "", ".").otherwise(""), name).alias("_path"), "_v", F.expr("schema_of_variant(_v)").alias("_kind")))
        leaves = each.where("_kind NOT LIKE 'OBJECT%'")
        found = leaves if found is None else found.unionByName(leaves)
        level = each.where("_kind LIKE 'OBJECT%'")
        if level.isEmpty():
            break
    plain = F.col("_kind").rlike("^ARRAY<(STRING|BIGINT|DOUBLE|DECIMAL.*|BOOLEAN|VOID)>$")
    kind = F.when(F.col("_kind") == "STRING", "string").when(F.col("_kind") == "BOOLEAN", "boolean").when(plain, "array").when(F.col("_kind").startswith("ARRAY"), "invalid").otherwise("number")
    text = F.when(F.col("_kind") == "STRING", F.try_variant_get("_v", "$", "string")).otherwise(F.to_json("_v"))
    return found.select(F.col("_key").alias(key), F.col("_path").alias("path"), kind.alias("kind"), text.alias("value"))


def typed_properties(flat: DataFrame, key: str) -> DataFrame:
    """``flat`` with the value as long, double, boolean or text."""
    v = F.col("value")
    return flat.withColumn("type", F.when(v.rlike("^-?[0-9]{1,18}$"), "LONG").when(v.rlike("^-?[0-9]+\\.[0-9]+$"), "DOUBLE").when(v.isin("true", "false"), "BOOLEAN").otherwise("TEXT")).withColumns(
        {"long_value": F.when(F.col("type") == "LONG", F.expr("try_cast(value AS bigint)")), "double_value": F.when(F.col("type") == "DOUBLE", F.expr("try_cast(value AS double)"))}
    )


def ancestors(links: DataFrame, child: str, parent: str) -> DataFrame:
    """(node, ancestor, steps) by path doubling, until a round adds no pair; the nodes of a cycle are their own ancestors."""
    a = links.select(F.col(child).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("steps"))
    a, n, before = cut(a), -1, -2
    while n != before:
        b = a.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("_up"), F.col("steps").alias("_s"))
        last, a = a, cut(a.unionByName(a.join(b, "ancestor").select("node", F.col("_up").alias("ancestor"), (F.col("steps") + F.col("_s")).alias("steps"))).groupBy("node", "ancestor").agg(F.min("steps").alias("steps")))
        discard(last)
        before, n = n, a.count()
    return a


def taxonomy_issues(items: DataFrame, links: DataFrame) -> DataFrame:
    """(code, issue) for items (code, level) and links (child, parent): LEVEL, SEVERAL_PARENTS, NO_PARENT, CYCLE."""
    p = items.select(F.col("code").alias("parent"), F.col("level").alias("_pl"))
    j = links.join(items.select(F.col("code").alias("child"), "level"), "child").join(p, "parent", "left")
    level = j.where("_pl IS NULL OR level <> _pl + 1").select(F.col("child").alias("code"), F.lit("LEVEL").alias("issue"))
    several = links.groupBy("child").agg(F.count_distinct("parent").alias("n")).where("n > 1").select(F.col("child").alias("code"), F.lit("SEVERAL_PARENTS").alias("issue"))
    orphan = items.where("level > 1").join(links.select(F.col("child").alias("code")), "code", "left_anti").select("code", F.lit("NO_PARENT").alias("issue"))
    cycle = ancestors(links, "child", "parent").where("node = ancestor").select(F.col("node").alias("code"), F.lit("CYCLE").alias("issue"))
    return reduce(DataFrame.unionByName, [level, several, orphan, cycle]).distinct()


def taxonomy_validity(items: DataFrame, links: DataFrame, pattern: str) -> DataFrame:
    """(code, issue) of a coded taxonomy: items (code, level), links (child, parent).

    CODE_PATTERN, LEVEL (a child is one below its parent, which exists), MAJOR (the first two characters of both are equal), SEVERAL_PARENTS, NO_PARENT (below level 1), ROOT_WITH_PARENT, CYCLE.
    """
    j = links.join(items.select(F.col("code").alias("child"), "level"), "child").join(items.select(F.col("code").alias("parent"), F.col("level").alias("_pl")), "parent")
    code = items.select("code", F.lit("CODE_PATTERN").alias("issue")).where(~F.coalesce(F.col("code").rlike(pattern), F.lit(False)))
    major = j.where(F.substring("child", 1, 2) != F.substring("parent", 1, 2)).select(F.col("child").alias("code"), F.lit("MAJOR").alias("issue"))
    root = links.join(items.where("level = 1").select(F.col("code").alias("child")), "child").select(F.col("child").alias("code"), F.lit("ROOT_WITH_PARENT").alias("issue"))
    return reduce(DataFrame.unionByName, [taxonomy_issues(items, links), code, major, root]).distinct()


def degree_summary(edges_: DataFrame) -> DataFrame:
    return edges_.groupBy("predicate").agg(F.count("*").alias("edges"), F.count_distinct("subject_id").alias("subjects"), F.count_distinct("object_id").alias("objects"))
