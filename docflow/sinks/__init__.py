from docflow.sinks.collection import (BUCKET_COL, atomic_add_path, collection_exists, compact, file_count, fold_adds,
                                     read_bucketed, stored_count, stored_newest, upsert_path, write_collection)
from docflow.sinks.manifest import Conflict, LostRows, snapshot, vacuum

__all__ = ["BUCKET_COL", "Conflict", "LostRows", "atomic_add_path", "collection_exists", "compact", "file_count",
           "fold_adds", "read_bucketed", "snapshot", "stored_count", "stored_newest", "upsert_path", "vacuum",
           "write_collection"]
