"""docflow: move, deliver and enrich tables of documents and events with PySpark.

Every job is a plain function from DataFrames to DataFrames; the session is an
argument. Sub-packages:

- ``sources``   collection scans, file listings
- ``functions`` Column builders: predicates, keys, URLs, JSON
- ``operators`` DataFrame operators: counts, watermark, latest-per-key,
                upsert, atomic add, entity tagging, numbering, delivery
- ``sinks``     writes, bucketed upsert at rest, compaction
- ``plans``     composed jobs: transfer, delivery, enrichment; query catalog
- ``streaming`` incremental transfer and dedupe as Structured Streaming
"""

from docflow.session import get_session, shared_dir, table

__all__ = ["get_session", "shared_dir", "table"]
