from lakewarden.functions.labels import bucket, first_present
from lakewarden.functions.text import (
    comment_json,
    error_class,
    join_texts,
    json_field,
    part_texts,
    query_tag,
    unit_hash,
)
from lakewarden.functions.times import ago, at, seconds_between, since, trunc

__all__ = [
    "ago", "at", "bucket", "comment_json", "error_class", "first_present", "join_texts",
    "json_field", "part_texts", "query_tag", "seconds_between", "since", "trunc", "unit_hash",
]
