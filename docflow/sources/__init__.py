from docflow.sources.collection import (flatten_arrays, parse_fields, read_collection,
                                       read_with_options, shape_collection, top_k)
from docflow.sources.files import file_manifest, read_files

__all__ = ["file_manifest", "flatten_arrays", "parse_fields", "read_collection",
           "read_files", "read_with_options", "shape_collection", "top_k"]
