"""Strict reading of semi-structured values."""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewise.sources.scratch import materialise


def at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def kind(v: Column) -> Column:
    """STRING, BOOLEAN, VOID for JSON null, OBJECT<...>, ARRAY<...> and so on; null where nothing is."""
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    return F.coalesce(kind(v).startswith("OBJECT"), F.lit(False))


def is_array(v: Column) -> Column:
    return F.coalesce(kind(v).startswith("ARRAY"), F.lit(False))


def string(v: Column, path: str) -> Column:
    """The string at a path; null for a missing key and any other type: numbers are not turned into text."""
    return F.when(kind(at(v, path)) == "STRING", F.try_variant_get(v, path, "string"))


def boolean(v: Column, path: str) -> Column:
    return F.when(kind(at(v, path)) == "BOOLEAN", F.try_variant_get(v, path, "boolean"))


def absent(v: Column, path: str) -> Column:
    """Missing or JSON null."""
    return F.coalesce(kind(at(v, path)) == "VOID", F.lit(True))


def items(v: Column, path: str) -> Column:
    """Elements of the array at a path as JSON texts; an empty array for anything else."""
    found = F.when(is_array(at(v, path)), F.from_json(F.to_json(at(v, path)), "array<string>"))
    return F.coalesce(found, F.array().cast("array<string>"))


def keys(v: Column) -> Column:
    """Number of keys of an object; null for anything else."""
    return F.when(is_object(v), F.size(F.json_object_keys(F.to_json(v))))


def _walk(value: object) -> list[tuple[str, str, str | None]]:
    """(path, type, scalar JSON) of every node, from a stack, so that depth does not matter."""
    out, stack = [], [("$", value)]
    while stack:
        path, at = stack.pop()
        if isinstance(at, dict):
            out.append((path, "OBJECT", None))
            stack += [(f"{path}.{k}", v) for k, v in at.items()]
        elif isinstance(at, list):
            out.append((path, "ARRAY", None))
            stack += [(f"{path}[{i}]", v) for i, v in enumerate(at)]
        else:
            name = {bool: "BOOLEAN", str: "STRING", type(None): "NULL"}.get(type(at), "NUMBER")
            out.append((path, name, json.dumps(at, ensure_ascii=False)))
    return out


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def canonical_nodes(texts: pd.Series) -> pd.Series:
    """Sorted [path, type, scalar JSON] of every node of a JSON text, the root included; key order is no matter, and an
    empty object differs from an empty array. Null and malformed texts give null, and so do texts that are nested deeper
    than Python's JSON reader goes (some thousands of levels). Paths grow with the depth, so nodes cost depth times size.
    The plain form of `flattened`, for a column at hand; no query runs it."""

    def nodes(text: str | None) -> list[list[str | None]] | None:
        try:
            value = json.loads(text) if text is not None else None
        except (ValueError, RecursionError):
            return None
        return None if text is None else [list(x) for x in sorted(_walk(value), key=lambda x: (x[0], x[1], x[2] or ""))]

    return texts.map(nodes)


def flattened(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, path, type, value) of every node of JSON texts, the root ($) included: OBJECT, ARRAY, STRING, NUMBER, BOOLEAN or
    NULL; value: the JSON of a node without children of its own kind, null for objects and arrays.

    A frontier of containers is opened level by level, as many nodes at once as a level has, until none is left; each level
    is written once. Paths are $.key and $[place]. Malformed texts, null ones, those with a key twice in an object or with
    more levels than variants go (a thousand) give no nodes.
    """
    spark = rows.sparkSession

    def level(nodes: DataFrame) -> DataFrame:
        k, v = F.split_part(kind(F.col("v")), F.lit("<"), F.lit(1)), F.col("v")
        type_ = F.when(k.isin("OBJECT", "ARRAY", "STRING", "BOOLEAN"), k).when(k == "VOID", "NULL").otherwise("NUMBER")
        is_container = type_.isin("OBJECT", "ARRAY")
        return materialise(nodes.select(key, "path", type_.alias("type"), F.when(~is_container, F.to_json(v)).alias("value"), F.when(is_container, v).alias("v")), "nodes")

    found = [level(rows.select(key, F.lit("$").alias("path"), F.try_parse_json(F.col(text)).alias("v")).where("v is not null"))]
    while not (open_ := found[-1].where("v is not null")).isEmpty():
        inside = open_.select(key, F.col("path").alias("at"), "v").lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).toDF("place", "name", "inner"))
        step = F.when(F.col("name").isNotNull(), F.concat(F.lit("."), "name")).otherwise(F.concat(F.lit("["), F.col("place").cast("string"), F.lit("]")))
        found.append(level(inside.select(key, F.concat("at", step).alias("path"), F.col("inner").alias("v"))))
    return reduce(DataFrame.unionByName, found).drop("v")


def with_canonical_hash(rows: DataFrame, text: str, name: str) -> DataFrame:
    """rows with the identity of the JSON in `text` apart from key order and spacing, for objects and arrays of any shape; null
    where there are no nodes. Equal texts are walked once. An empty object differs from an empty array."""
    keyed = rows.withColumn("_text", F.sha2(F.col(text), 256))
    texts = keyed.where("_text is not null").select("_text", F.col(text).alias("json")).dropDuplicates(["_text"])
    node = F.array("path", "type", "value")
    hashes = flattened(texts, "_text", "json").groupBy("_text").agg(F.sha2(F.to_json(F.array_sort(F.collect_list(node))), 256).alias(name))
    return keyed.join(hashes, "_text", "left").drop("_text")
