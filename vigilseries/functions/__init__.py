from vigilseries.functions.scalars import (
    binarize_score, category_map, cyclic, day_name, hour_of, log_line_format, log_line_parse, round4, sigmoid,
    stable_hash, truncate_doc, weekday_of,
)

__all__ = [
    "binarize_score", "category_map", "cyclic", "day_name", "hour_of", "log_line_format", "log_line_parse",
    "round4", "sigmoid", "stable_hash", "truncate_doc", "weekday_of",
]
