"""The models by name: schemas raw, staging, intermediate and marts, and session views.

``register_views`` puts a temporary view over every model (``stg_pac_contributions``,
``mart_candidate_funding_summary``, ...): lazy, and as narrow as the query that reads it.  ``publish``
makes the names of the layers usable in SQL text as they stand: the table layers become external
tables over the Parquet that the model build wrote, not copied; the other models are written once and become
external tables too, since a stored view can hold SQL text only.  ``named_in`` says which of them a text needs.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..sources.layouts import columns_of, raw_schema
from .pipeline import Models, _at_once, write_tables

# name of the model in its layer -> attribute of ``Models``
STAGING = {
    "stg_candidates": "candidates",
    "stg_committees": "committees",
    "stg_individual_contributions": "individual",
    "stg_pac_contributions": "pac",
    "stg_candidate_committee_linkage": "linkage",
    "stg_candidate_financial_summary": "financials",
}
INTERMEDIATE = {
    "int_committee_industry_tags": "committee_tags",
    "int_individual_donor_industry": "donor_industry",
    "int_contributions_to_candidates": "flow",
}
MARTS = {
    "mart_candidate_funding_summary": "funding",
    "mart_candidate_corruption_score": "score",
    "mart_candidate_funding_by_cycle": "funding_by_cycle",
    "mart_candidate_score_by_cycle": "score_by_cycle",
}
LAYERS = {"staging": STAGING, "intermediate": INTERMEDIATE, "marts": MARTS}

# Models that the build already keeps as a table, of these columns and perhaps more: published where they are.
BUILT = {"committee_tags": "committee_tags", "flow": "flow_by_cycle", "funding": "funding_extras",
         "score": "score", "funding_by_cycle": "funding_by_cycle"}


def register_views(models: Models) -> list[str]:
    """Create or replace a temporary view per model; their names."""
    names = []
    for layer in LAYERS.values():
        for name, attribute in layer.items():
            getattr(models, attribute).createOrReplaceTempView(name)
            names.append(name)
    for table, df in models.raw.items():
        df.createOrReplaceTempView(f"raw_{table}")
        names.append(f"raw_{table}")
    return names


def publish(models: Models, schemas: dict[str, str] | None = None,
            only: set[str] | None = None) -> dict[str, str]:
    """Create the schemas and external tables over ``models.warehouse``; name in SQL -> folder.

    ``schemas`` renames layers, for a catalog that several inputs share.  ``only`` are the names
    (``layer.model``, as not renamed) to publish; other models are then not built.  Published tables are
    replaced, so the names always mean this build.
    """
    if models.warehouse is None:
        raise ValueError("models need a warehouse to be published")
    spark, home = models.spark, models.warehouse
    schemas = {layer: layer for layer in ("raw", *LAYERS)} | (schemas or {})
    for layer in schemas.values():
        _checked(layer)

    def wanted(layer: str, names) -> list[str]:
        return [n for n in names if only is None or f"{layer}.{n}" in only]

    placed: dict[str, tuple[str, DataFrame]] = {}
    unwritten = {}
    for layer, names in LAYERS.items():
        for name in wanted(layer, names):
            df = getattr(models, names[name])          # builds its table if need be
            built = BUILT.get(names[name], f"{layer}/{name}")
            placed[f"{schemas[layer]}.{name}"] = f"{home}/{built}", df
            if names[name] not in BUILT:
                unwritten[built] = df
    _at_once(lambda t: models.layer(f"published/{t[0]}", lambda: write_tables(dict([t]), home)), unwritten.items())
    raw = wanted("raw", models.sources)
    _at_once(models.raw_table, raw)
    for layer in schemas.values():
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{layer}` LOCATION '{home}/schemas/{layer}'")
    for name, (folder, df) in placed.items():
        spark.sql(f"DROP TABLE IF EXISTS {name}")       # external: its files stay
        spark.catalog.createTable(name, path=folder, source="parquet", schema=df.schema)
    for table in raw:
        _external_raw(spark, f"{schemas['raw']}.{table}", f"{home}/raw/{table}", columns_of(table))
    return {name: folder for name, (folder, _) in placed.items()} \
        | {f"{schemas['raw']}.{table}": f"{home}/raw/{table}" for table in raw}


def _checked(name: str) -> None:
    if not re.fullmatch(r"\w+", name):
        raise ValueError(f"not a schema name: {name!r}")


def _external_raw(spark: SparkSession, name: str, folder: str, columns: list[str]) -> None:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw_schema(columns))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY (cycle_year, source_file) "
              f"LOCATION '{folder}'")
    try:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    except AnalysisException as exc:            # a catalog that lists the folders itself
        if "partition" not in str(exc).lower():
            raise


def run_report(spark: SparkSession, text: str, **parameters) -> DataFrame:
    """A report's SQL text over the published names; ``:name`` parameters are bound, never pasted."""
    return spark.sql(text, args=parameters or None)


def named_in(text: str) -> set[str]:
    """The published names (``layer.model``) that a report's text reads."""
    return {f"{layer}.{name}" for layer, names in LAYERS.items() for name in names
            if re.search(rf"\b{layer}\.{name}\b", text)}
