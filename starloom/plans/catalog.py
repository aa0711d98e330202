"""A loaded star in the session catalog: namespaces, declared tables, the star view."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from starloom.plans.loads import Layout
from starloom.sources.catalog import create_namespace, refresh_table, reset_bucketed, reset_table
from starloom.sources.commits import BUCKET
from starloom.specs import Layer, Star


LAYERS = {
    "bronze": Layer("Raw rows as delivered, all text", {"layer": "bronze"}),
    "silver": Layer("Clean typed rows", {"layer": "silver"}),
    "gold": Layer("Dimensions, fact and star view", {"layer": "gold"}),
}


def star_view_sql(star: Star, namespace: str) -> str:
    """The star view as SELECT text over the catalog's fact and dimension tables."""
    owner = {c: star.dimension_of(c) for c in star.view_columns}
    columns = ", ".join(f"{dim.name if dim else 'f'}.`{c}`" for c, dim in owner.items())
    joins = " ".join(f"LEFT JOIN {namespace}.{d.name} ON f.`{d.sk}` = {d.name}.`{d.sk}`" for d in star.dimensions)
    return f"SELECT {columns} FROM {namespace}.{star.fact_table} f {joins}"


def publish_catalog(
    spark: SparkSession, layout: Layout, prefix: str = "", layers: Mapping[str, Layer] = LAYERS
) -> None:
    """Register the star's tables over the files it was loaded into.

    Tables are dropped from the catalog and declared again, which leaves their files
    alone; a dimension is declared over its current version. Publish again after a load
    to show new partitions and dimension versions.
    """
    star, source = layout.star, layout.star.source
    for name, layer in layers.items():
        create_namespace(spark, prefix + name, f"{layout.root}/{name}", layer.comment, layer.properties)
    store = layout.dimensions(spark)
    partitioned = {
        f"{prefix}bronze.{source.raw_table}": (source.raw_schema, layout.raw, source.raw_comment),
        f"{prefix}silver.{source.clean_table}": (source.clean_schema, layout.clean, source.clean_comment),
        f"{prefix}gold.{star.fact_table}": (star.fact_schema, layout.fact, star.fact_comment),
    }
    for name, (schema, path, comment) in partitioned.items():
        reset_table(spark, name, schema, path, star.partition_by, comment, layout.fmt)
        refresh_table(spark, name, partitioned=layout.fmt == "parquet")
    for dim in star.dimensions:
        name = f"{prefix}gold.{dim.name}"
        folders = store.locations(dim)
        if len(folders) == 1:
            reset_table(spark, name, dim.schema, folders[0], comment=dim.comment, fmt=layout.fmt)
        else:
            reset_bucketed(spark, name, dim.schema, f"{layout.root}/gold/{dim.name}", folders, BUCKET, dim.comment)
    spark.sql(f"CREATE OR REPLACE VIEW {prefix}gold.{star.view} AS {star_view_sql(star, prefix + 'gold')}")
