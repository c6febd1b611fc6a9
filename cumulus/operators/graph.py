"""Property-graph tables: vertices(identifier, type, properties) and
edges(subject_identifier, subject_type, object_identifier, object_type,
edge_type, properties), with ``map<string,string>`` properties, or with
VARIANT ones that keep numbers as numbers (``typed_*``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulus.functions.columns import string_map
from cumulus.operators.dedupe import deduplicate

VERTEX_COLS = ["identifier", "type", "properties"]
EDGE_COLS = ["subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type", "properties"]


def vertices_from_rows(df: DataFrame, id_col: str, vtype: str, props: Sequence[tuple[str, Column]]) -> DataFrame:
    """One vertex per row (the rows are already unique per id)."""
    return df.select(F.col(id_col).cast("string").alias("identifier"), F.lit(vtype).alias("type"),
                     string_map(*props).alias("properties"))


def typed_vertices(df: DataFrame, id_col: str, vtype: str, props: Sequence[tuple[str, Column]]) -> DataFrame:
    """``vertices_from_rows`` with VARIANT properties: every value keeps its type, NULLs are kept as such."""
    return df.select(F.col(id_col).cast("string").alias("identifier"), F.lit(vtype).alias("type"),
                     F.to_variant_object(F.struct(*[c.alias(k) for k, c in props])).alias("properties"))


def json_properties(df: DataFrame, json_col: str, name: str = "properties") -> DataFrame:
    """``json_col`` as VARIANT properties; text that is not JSON gives NULL and ``is_malformed``."""
    v = F.try_parse_json(F.col(json_col))
    return df.withColumn(name, v).withColumn("is_malformed", F.col(json_col).isNotNull() & v.isNull())


def typed_properties(df: DataFrame, fields: dict[str, str], name: str = "properties") -> DataFrame:
    """The properties named in ``fields`` (name: type) as columns; a missing one, or one of another type, is NULL."""
    return df.select(*[c for c in df.columns if c != name],
                     *[F.try_variant_get(name, f"$['{k}']", kind).alias(k) for k, kind in fields.items()])


def vertices_deduped(df: DataFrame, id_col: str, vtype: str, props: Sequence[tuple[str, str]],
                     order: Sequence[str] | None = None, descending: bool = False) -> DataFrame:
    """Deduplicate rows per id, then build the property map."""
    d = deduplicate(df, [id_col], order, descending)
    return vertices_from_rows(d, id_col, vtype, [(k, F.col(c)) for k, c in props])


def vertices_from_aggregate(df: DataFrame, id_col: str, vtype: str, name_col: str, count_col: str,
                            sum_col: str, set_col: str) -> DataFrame:
    """Aggregate rows per id: count, sum, a name and the sorted distinct set.

    The distinct set is reduced map-side (collect_set is a partial
    aggregate) and is bounded by the distinct values, not by the rows.
    """
    g = df.groupBy(id_col).agg(
        F.max(name_col).alias("_name"), F.count(F.lit(1)).alias("_n"), F.sum(sum_col).alias("_sum"),
        F.array_join(F.sort_array(F.collect_set(F.col(set_col).cast("string"))), ",").alias("_set"))
    return g.select(F.col(id_col).cast("string").alias("identifier"), F.lit(vtype).alias("type"),
                    F.create_map(F.lit("name"), F.col("_name").cast("string"),
                                 F.lit(count_col), F.col("_n").cast("string"),
                                 F.lit(sum_col), F.col("_sum").cast("string"),
                                 F.lit(set_col), F.col("_set")).alias("properties"))


def edges_direct(df: DataFrame, subject_col: str, subject_type: str, object_col: str, object_type: str,
                 edge_type: str, props: Sequence[tuple[str, str]], dedupe_keys: Sequence[str] | None = None,
                 order: Sequence[str] | None = None) -> DataFrame:
    """Each (deduplicated) row becomes one edge."""
    if dedupe_keys:
        df = deduplicate(df, dedupe_keys, order)
    return df.select(F.col(subject_col).cast("string").alias("subject_identifier"),
                     F.lit(subject_type).alias("subject_type"),
                     F.col(object_col).cast("string").alias("object_identifier"),
                     F.lit(object_type).alias("object_type"),
                     F.lit(edge_type).alias("edge_type"),
                     string_map(*[(k, F.col(c)) for k, c in props]).alias("properties"))


def max_edge_property(vertices: DataFrame, edges: DataFrame, prop: str, name_prop: str = "name") -> DataFrame:
    """Per subject vertex: MAX of an integer edge property."""
    v = vertices.select(F.col("identifier").alias("subject_identifier"), F.col("type").alias("subject_type"),
                        F.col("properties")[name_prop].alias("name"))
    j = v.join(edges, ["subject_identifier", "subject_type"])
    return j.groupBy("subject_identifier", "name").agg(
        F.max(F.col("properties")[prop].try_cast("bigint")).alias(f"max_{prop}"))


def vertex_edge_profile(vertices: DataFrame, edges: DataFrame, num_prop: str, den_prop: str,
                        edge_prop: str, object_type: str | None = None) -> DataFrame:
    """Join vertices to their edges: a ratio of two vertex properties (zero
    denominator -> 1) next to an edge property."""
    v = vertices.select(F.col("identifier").alias("subject_identifier"), F.col("type").alias("subject_type"),
                        F.col("properties").alias("_vp"))
    e = edges if object_type is None else edges.filter(F.col("object_type") == object_type)
    j = v.join(e, ["subject_identifier", "subject_type"])
    num = F.col("_vp")[num_prop].try_cast("double")
    den = F.col("_vp")[den_prop].try_cast("double")
    return j.select("subject_identifier", "object_identifier",
                    F.col("properties")[edge_prop].try_cast("bigint").alias(edge_prop),
                    (num / F.when(den == 0, F.lit(1.0)).otherwise(den)).alias(f"{num_prop}_per_{den_prop}"))
