"""URL building for delivery requests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The request path of the indexing endpoint, its query
# parameter for the content source, and the flag that turns off echoing.
INDEX_PATH_TEMPLATE = "api/apollo/index-pipelines/{pipeline}/collections/{collection}/index?parserId={parser}"
CONTENT_SOURCE_PARAM = "contentSourceName"
ECHO_OFF = "echo=false"
DEFAULT_SCHEME = "http"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def form_encode(c: str | Column) -> Column:
    """E5: HTML-form encoding in UTF-8 (space as ``+``, ``*`` kept, ``~`` escaped)."""
    return F.url_encode(_col(c))


def with_query_flag(target: Column, flag: str = ECHO_OFF) -> Column:
    """Append ``flag`` with ``&`` when the target has a query part, else ``?``."""
    return F.when(F.instr(target, "?") > 0, F.concat(target, F.lit("&" + flag))) \
        .otherwise(F.concat(target, F.lit("?" + flag)))


def index_path(pipeline: str, collection: str, parser: str, template: str = INDEX_PATH_TEMPLATE) -> str:
    path = template.format(pipeline=pipeline, collection=collection, parser=parser)
    return path if path.startswith("/") else "/" + path


def request_target(path_col: str | Column, pipeline: str, collection: str,
                   parser: str | None = None) -> Column:
    """Endpoint path with the encoded content source and ``echo=false``."""
    base = index_path(pipeline, collection, parser or collection)
    target = F.concat(F.lit(f"{base}&{CONTENT_SOURCE_PARAM}="), form_encode(path_col))
    return with_query_flag(target)


# scheme, optional user info, host (a bracketed IPv6 address is one), optional port
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^@/?#]*@)?(\[[0-9A-Fa-f:.]*\]|[^:/?#]*)(?::([0-9]*))?"


def url_origin(c: str | Column) -> Column:
    """``scheme://host[:port]``; ``http://`` is put in front when missing.

    The scheme is lower-cased, the host kept as written. An absent port is
    left out (the source client printed ``:-1``). No host gives null. Only
    the prefix is read, so a path with blanks or odd characters is fine.
    """
    raw = _col(c)
    url = F.when(F.lower(raw).startswith("http://") | F.lower(raw).startswith("https://"), raw) \
        .otherwise(F.concat(F.lit(DEFAULT_SCHEME + "://"), raw))
    proto = F.lower(F.regexp_extract(url, _ORIGIN, 1))
    host = F.regexp_extract(url, _ORIGIN, 2)
    port = F.regexp_extract(url, _ORIGIN, 3)
    return F.when(host == "", F.lit(None).cast("string")).otherwise(
        F.concat(proto, F.lit("://"), host,
                 F.when(port == "", F.lit("")).otherwise(F.concat(F.lit(":"), port))))
