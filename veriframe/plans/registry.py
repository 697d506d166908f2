"""All registered queries of the quality-control engine, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veriframe.plans import filename_queries, geometry_queries, metadata_queries, modality_queries, pixel_queries, report_queries, sequence_queries, service_queries

MODULES = [report_queries, filename_queries, metadata_queries, sequence_queries, geometry_queries, service_queries, pixel_queries, modality_queries]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modality_queries.summary(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
