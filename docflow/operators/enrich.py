"""Entity enrichment.

The default path never leaves the JVM: tokens come from a regular
expression, classes from a join with a gazetteer (word -> class), and the
per-class word sets from one aggregation. ``map_tagger`` runs any Python
tagger over Arrow batches for taggers that are not a lookup table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from docflow.session import ship_package

# Word pattern (letters and digits of any script), the class
# meaning "no entity", and the classes kept with their output field names.
TOKEN_PATTERN = r"([\p{L}\p{N}]+)"
OTHER_CLASS = "O"
ENTITY_FIELDS = (
    ("LOCATION", "location_ss"),
    ("ORGANIZATION", "organization_ss"),
    ("PERSON", "person_ss"),
)

# A gazetteer of up to so many bytes (text of words and classes, plus row
# overhead) is a broadcast join side; a larger one joins through a shuffle.
# Either way the rows are the same: the gazetteer is normalised before the choice.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 48


def tokenize(text_col: str) -> "F.Column":
    """The words of a text, in order, as array<string>."""
    return F.regexp_extract_all(F.col(text_col), F.lit(TOKEN_PATTERN), 1)


def tokens(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per word occurrence: id, pos (from 0), token."""
    return df.select(F.col(id_col), F.posexplode(tokenize(text_col)).alias("pos", "token"))


def gazetteer(spark: SparkSession, entries: Iterable[tuple[str, str]]) -> DataFrame:
    """A word -> class table (token, entity_class); a repeated word keeps its last class."""
    schema = StructType([StructField("token", StringType(), False),
                         StructField("entity_class", StringType(), False)])
    return spark.createDataFrame(list(dict(entries).items()), schema)


def read_gazetteer(spark: SparkSession, source: DataFrame | str | Iterable[tuple[str, str]]) -> DataFrame:
    """A gazetteer from a table (token, entity_class), the path of a Parquet one, or a list of pairs."""
    if isinstance(source, DataFrame):
        return source
    return spark.read.parquet(source) if isinstance(source, str) else gazetteer(spark, source)


def normalised(gaz: DataFrame) -> DataFrame:
    """One class for each word (the greatest of several); words or classes that are null drop out."""
    return (gaz.where("token IS NOT NULL AND entity_class IS NOT NULL")
            .groupBy("token").agg(F.max("entity_class").alias("entity_class")))


def fits_broadcast(gaz: DataFrame, max_bytes: int) -> bool:
    """Whether the table's text and row overhead stay within ``max_bytes`` (one small aggregate)."""
    size = F.sum(F.octet_length("token") + F.octet_length("entity_class") + F.lit(ROW_OVERHEAD_BYTES))
    return (gaz.agg(size).first()[0] or 0) <= max_bytes


def tag_entities(tok: DataFrame, gaz: DataFrame, max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Tag each token with its class; tokens without a class drop out.

    The gazetteer is broadcast if its bytes fit ``max_broadcast_bytes``, so the
    tokens are not shuffled and each lookup is a hash probe; beyond that the
    join shuffles both sides (AQE splits a hot word). One class per token.
    """
    g = normalised(gaz)
    if fits_broadcast(g, max_broadcast_bytes):
        g = F.broadcast(g)
    return tok.join(g, "token", "inner")


def entity_sets(tags: DataFrame, id_col: str) -> DataFrame:
    """A6 + V1: per id and class, the sorted distinct words; class O dropped.

    Each set holds gazetteer words only, so its size is bounded by the
    gazetteer, however many tokens a document has.
    """
    return (tags.filter(F.col("entity_class") != OTHER_CLASS)
            .groupBy(id_col, "entity_class")
            .agg(F.array_sort(F.collect_set("token")).alias("words")))


def entity_columns(tags: DataFrame, ids: DataFrame | None, id_col: str,
                   fields: Sequence[tuple[str, str]] = ENTITY_FIELDS) -> DataFrame:
    """V2: one row per id with one sorted word array per class.

    An absent class gives an empty array and ids without any entity are kept:
    either ``tags`` already holds a row for every id (e.g. from a left join,
    class null), or ``ids`` lists them and is unioned in. One aggregation,
    no join: ``collect_set`` skips the null-class rows.
    """
    both = tags.select(id_col, "entity_class", "token")
    if ids is not None:
        base = ids.select(F.col(id_col), F.lit(None).cast("string").alias("entity_class"),
                          F.lit(None).cast("string").alias("token"))
        both = base.unionByName(both)
    aggs = [F.array_sort(F.collect_set(F.when(F.col("entity_class") == cls, F.col("token")))).alias(name)
            for cls, name in fields]
    return both.groupBy(id_col).agg(*aggs).select(*[name for _, name in fields], id_col)


def entity_sets_of_docs(docs: DataFrame, gaz: DataFrame, id_col: str, text_col: str,
                        max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """A6 + V1 straight from documents: id, entity_class, sorted distinct words.

    Each row's distinct words are taken in place, so a word is looked up once
    per document; only words with a class reach the aggregation's shuffle.
    """
    words = docs.select(F.col(id_col), F.explode(F.array_distinct(tokenize(text_col))).alias("token"))
    return entity_sets(tag_entities(words, gaz, max_broadcast_bytes), id_col)


def entity_schema(id_col: str = "id", fields: Sequence[tuple[str, str]] = ENTITY_FIELDS) -> StructType:
    """The declared output schema: three array<string> fields and the id."""
    return StructType([StructField(name, ArrayType(StringType())) for _, name in fields]
                      + [StructField(id_col, StringType())])


Tagger = Callable[[list[str]], Iterable[tuple[str, str]]]


def map_tagger(df: DataFrame, tagger_factory: Callable[[dict[str, str]], Tagger], *,
               id_col: str = "id", text_col: str = "text",
               side_files: Sequence[str] = (),
               fields: Sequence[tuple[str, str]] = ENTITY_FIELDS) -> DataFrame:
    r"""Run a Python tagger ``list[str] -> [(word, class)]`` per row.

    Rows move to Python in Arrow batches (``mapInPandas``). The factory is
    called once per task with ``{file name: local path}`` of ``side_files``
    (shipped with ``addFile``), so a model is loaded once per task, not per
    row. Text is tokenized with the same pattern as :func:`tokenize`, which
    needs the ``regex`` package on the executors (for ``\p{L}``).
    """
    spark = df.sparkSession
    ship_package(spark)
    names = []
    for path in side_files:
        spark.sparkContext.addFile(path)
        names.append(path.rstrip("/").split("/")[-1])
    schema = entity_schema(id_col, fields)
    field_map = list(fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import regex
        from pyspark import SparkFiles

        tagger = tagger_factory({n: SparkFiles.get(n) for n in names})
        word = regex.compile(TOKEN_PATTERN[1:-1])
        for pdf in batches:
            rows = []
            for rid, text in zip(pdf[id_col], pdf[text_col]):
                if isinstance(text, (list, tuple)) or hasattr(text, "tolist"):
                    text = " ".join(text)
                found: dict[str, set[str]] = {}
                for w, cls in tagger(word.findall(text or "")):
                    found.setdefault(cls, set()).add(w)
                found.pop(OTHER_CLASS, None)
                rows.append([sorted(found.get(cls, ())) for cls, _ in field_map]
                            + [None if rid is None else str(rid)])
            yield pd.DataFrame(rows, columns=[n for _, n in field_map] + [id_col])

    return df.select(F.col(id_col), F.col(text_col)).mapInPandas(run, schema)


class GazetteerTagger:
    """A small lookup tagger for :func:`map_tagger`.

    Unknown words are class O, which the pivot drops anyway, so only words
    found in the lookup are returned.
    """

    def __init__(self, entries: Iterable[tuple[str, str]]):
        self.lookup = dict(entries)

    def __call__(self, words: list[str]) -> list[tuple[str, str]]:
        get = self.lookup.get
        return [(w, c) for w in words if (c := get(w)) is not None]
