from docflow.functions.jsonrows import parse_json, row_json
from docflow.functions.keys import natural_key, split_key_fields, with_natural_key
from docflow.functions.predicates import (all_of, as_predicate, exists, field_exists,
                                          match_all, range_, term)
from docflow.functions.urls import form_encode, request_target, url_origin

__all__ = [
    "all_of", "as_predicate", "exists", "field_exists", "form_encode", "match_all",
    "natural_key", "parse_json", "range_", "request_target", "row_json",
    "split_key_fields", "term", "url_origin", "with_natural_key",
]
