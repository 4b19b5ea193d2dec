"""Collection scans.

A collection is a DataFrame: Parquet at a path, any Spark source, or a
catalog table. Projection and predicates are applied lazily on the scan so
Catalyst prunes columns (``ReadSchema``) and pushes filters (``PushedFilters``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from docflow.functions.predicates import all_of, as_predicate


def parse_fields(fields: str | Sequence[str] | None) -> list[str] | None:
    """``"id, body_t"`` or a list; blanks around names are dropped."""
    if fields is None:
        return None
    if isinstance(fields, str):
        return [f.strip() for f in fields.split(",") if f.strip()]
    return list(fields)


def read_collection(spark: SparkSession, source: str, *, format: str = "parquet",
                    where: str | Column | None = None,
                    fields: str | Sequence[str] | None = None,
                    max_rows: int | None = None,
                    order_by: str | Sequence[str] | None = None,
                    splits: int | None = None,
                    flatten_multivalued: bool = False,
                    options: dict[str, str] | None = None) -> DataFrame:
    """Scan a collection with an optional predicate, projection and cap.

    ``format="table"`` reads a catalog table named ``source``. ``max_rows``
    keeps the first rows by ``order_by`` (default: the first field), so the
    result is deterministic. ``splits`` asks for at least so many scan tasks.
    """
    if format == "table":
        df = spark.table(source)
        if splits and not df.isStreaming:
            df = df.repartition(int(splits))                # a table's scan is planned by its own session
    else:
        session = _splitting(spark, int(splits)) if splits else spark
        df = session.read.format(format).options(**(options or {})).load(source)
    return shape_collection(df, where=where, fields=fields, max_rows=max_rows,
                            order_by=order_by, flatten_multivalued=flatten_multivalued)


MIN_SPLITS, OPEN_COST = "spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes"


def _splitting(spark: SparkSession, splits: int) -> SparkSession:
    """A session with this one's settings whose file scans are cut into at least ``splits`` tasks.

    A file scan keeps the settings of the session that made it, so no rows are
    moved and the caller's session and its other reads stay as they are. Small
    files and a Parquet file's row groups bound how finely a scan can be cut.
    """
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k) and own.conf.get(k, None) != v:
            own.conf.set(k, v)
    own.conf.set(MIN_SPLITS, str(splits))
    own.conf.set(OPEN_COST, "1")                            # else no split is smaller than 4 MB
    return own


# Option names of the source jobs' reader and the keyword each maps to.
OPTION_NAMES = {
    "query": "where",
    "fields": "fields",
    "max_rows": "max_rows",
    "splits_per_shard": "splits",
    "flatten_multivalued": "flatten_multivalued",
    "fq": "fq",
    "solr.params": "fq",
}
# Where the rows come from is the ``source`` argument; these names are accepted and not used.
SOURCE_NAMES = ("collection", "zkhost")
MATCH_ALL_QUERY = "*:*"


def read_with_options(spark: SparkSession, source: str, opts: dict[str, str], *,
                      format: str = "parquet") -> DataFrame:
    """Read with an option map as the source jobs wrote it.

    ``query`` and the extra filter are SQL boolean expressions (``*:*`` = all
    rows; no index query-string parser is built). The extra filter is ``fq``,
    or ``solr.params`` with ``fq=`` parts joined by ``&``; all of them hold.
    ``max_rows`` and ``splits_per_shard`` are numbers, ``flatten_multivalued``
    is ``"true"``/``"false"``. ``collection`` and ``zkhost`` are accepted (the
    source is the path); any other name is an error, so no filter is lost.
    """
    kw: dict = {}
    filters: list[str] = []
    for name, value in opts.items():
        target = OPTION_NAMES.get(name)
        if target is None:
            if name in SOURCE_NAMES:
                continue
            raise ValueError(f"unknown reader option: {name}")
        if target == "fq":
            parts = value.split("&fq=") if name == "fq" else _fq_parts(value)
            filters += [p for p in parts if p.strip() not in ("", MATCH_ALL_QUERY)]
        elif target == "where":
            kw[target] = None if value.strip() in ("", MATCH_ALL_QUERY) else value
        elif target in ("max_rows", "splits"):
            kw[target] = int(value)
        elif target == "flatten_multivalued":
            kw[target] = str(value).lower() == "true"
        else:
            kw[target] = value
    if filters:
        kw["where"] = all_of(kw.get("where"), *filters)
    return read_collection(spark, source, format=format, **kw)


def _fq_parts(params: str) -> list[str]:
    """The filters of ``fq=a&fq=b``; a parameter of another name is an error."""
    if not params.startswith("fq="):
        raise ValueError(f"unknown query parameter in: {params}")
    return params[len("fq="):].split("&fq=")


def shape_collection(df: DataFrame, *, where=None, fields=None, max_rows=None,
                     order_by=None, flatten_multivalued=False) -> DataFrame:
    """The option handling of :func:`read_collection` on any DataFrame."""
    if where is not None:
        df = df.filter(as_predicate(where))
    names = parse_fields(fields)
    if names:
        df = df.select(*names)
    if max_rows is not None:
        keys = [order_by] if isinstance(order_by, str) else list(order_by or df.columns[:1])
        df = df.orderBy(*keys).limit(int(max_rows))
    if flatten_multivalued:
        df = flatten_arrays(df)
    return df


def flatten_arrays(df: DataFrame, sep: str = " ") -> DataFrame:
    """Every array<string> field becomes one ``sep``-joined string."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType):
            out.append(F.array_join(F.col(f.name), sep).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def top_k(df: DataFrame, by: str, k: int = 1, fields: Sequence[str] | None = None,
          tiebreak: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest ``by`` (nulls last), projected.

    Planned as ``TakeOrderedAndProject``: each task keeps only its own top k,
    so the driver merges k rows per task, never the whole input.
    """
    order = [F.col(by).desc_nulls_last()] + [F.col(t).desc_nulls_last() for t in tiebreak]
    out = df.orderBy(*order).limit(int(k))
    return out.select(*fields) if fields else out
