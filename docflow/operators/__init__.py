from docflow.operators.counts import count_collection, count_new, new_rows_filter, newest, newest_mark
from docflow.operators.deliver import (assign_host, batch_body, deliver, json_batches,
                                      meter_by_host, send_with_failover, write_batches_by_host)
from docflow.operators.enrich import (GazetteerTagger, entity_columns, entity_sets, entity_sets_of_docs,
                                     fits_broadcast, gazetteer, map_tagger, read_gazetteer, tag_entities,
                                     tokenize, tokens)
from docflow.operators.latest import latest_per_key
from docflow.operators.numbering import batch_ids, ordinal_within
from docflow.operators.transports import HttpTransport
from docflow.operators.upsert import atomic_add, upsert

__all__ = [
    "GazetteerTagger", "HttpTransport", "assign_host",
    "atomic_add", "batch_body", "batch_ids", "count_collection", "count_new",
    "deliver", "entity_columns", "entity_sets",
    "entity_sets_of_docs", "fits_broadcast", "gazetteer", "json_batches",
    "latest_per_key", "map_tagger", "meter_by_host", "new_rows_filter", "newest", "newest_mark",
    "ordinal_within", "read_gazetteer", "send_with_failover", "tag_entities", "tokenize", "tokens", "upsert",
    "write_batches_by_host",
]
