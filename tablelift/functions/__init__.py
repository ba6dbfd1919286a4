"""Column functions: labels, JSON scalars, paths, patterns."""

from tablelift.functions.text import (
    all_matches,
    any_like,
    build_label,
    counter_name,
    is_true,
    json_localised,
    json_scalar,
    numeric_text,
    path_without_root,
    shorten,
)

__all__ = [
    "all_matches",
    "any_like",
    "build_label",
    "counter_name",
    "is_true",
    "json_localised",
    "json_scalar",
    "numeric_text",
    "path_without_root",
    "shorten",
]
