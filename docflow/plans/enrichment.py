"""Entity enrichment job (R6): tag words, pivot classes, merge back by key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.predicates import field_exists
from docflow.operators.enrich import (BROADCAST_MAX_BYTES, ENTITY_FIELDS, entity_columns,
                                     read_gazetteer, tag_entities, tokenize)
from docflow.operators.upsert import atomic_add
from docflow.sinks.collection import atomic_add_path
from docflow.sources.collection import flatten_arrays


def entity_rows(docs: DataFrame, gaz: DataFrame, *, id_col: str = "id", text_col: str = "body_t",
                max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """S2(P2) -> E3 -> E4 -> J3 -> A6/V1/V2 on a document DataFrame.

    Rows without text are skipped; an array text field is space-joined.
    Output: location_ss, organization_ss, person_ss (sorted arrays), id. Each
    document's distinct words are looked up; only those with a class are
    shuffled, with one id row per document from an id-only pass.
    """
    docs = docs.filter(field_exists(docs, text_col)).select(
        F.col(id_col).cast("string").alias(id_col), F.col(text_col))
    docs = flatten_arrays(docs)
    words = docs.select(F.col(id_col), F.explode(F.array_distinct(tokenize(text_col))).alias("token"))
    return entity_columns(tag_entities(words, gaz, max_broadcast_bytes), docs.select(id_col), id_col)


def run_enrichment(spark: SparkSession, docs: DataFrame, entries: DataFrame | str | Iterable[tuple[str, str]],
                   destination: DataFrame, *, id_col: str = "id", text_col: str = "body_t",
                   distinct: bool = True) -> DataFrame:
    """Tag ``docs`` and add the entity words to ``destination`` by id.

    ``entries`` is the gazetteer: a table (token, entity_class), the path of a
    Parquet one, or a list of pairs.
    """
    found = entity_rows(docs, read_gazetteer(spark, entries), id_col=id_col, text_col=text_col)
    return atomic_add(destination, found, id_col, [name for _, name in ENTITY_FIELDS], distinct=distinct)


def run_enrichment_at(spark: SparkSession, docs: DataFrame, entries: DataFrame | str | Iterable[tuple[str, str]],
                      path: str, *, batch_id: str, id_col: str = "id", text_col: str = "body_t") -> bool:
    """R6 into the stored collection at ``path``: the words found are sent as adds, once per ``batch_id``.

    Documents without an entity add nothing; those that are not stored become rows.
    """
    found = entity_rows(docs, read_gazetteer(spark, entries), id_col=id_col, text_col=text_col)
    return atomic_add_path(spark, path, found, [name for _, name in ENTITY_FIELDS], batch_id=batch_id, distinct=True)
