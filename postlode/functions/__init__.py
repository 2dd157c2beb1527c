from postlode.functions.numbers import active_since, duration_seconds, percentage
from postlode.functions.text import (
    blank_to_null,
    clean_text,
    clean_tags,
    contains_any,
    is_mojibake,
    is_non_latin,
    label_with_fallback,
    null_if_mojibake,
    repair_mojibake,
    strip_trailing_separators,
    surrogate_key,
    title_case,
    unescape_html,
)

__all__ = [
    "active_since", "blank_to_null", "clean_tags", "clean_text", "contains_any",
    "duration_seconds", "is_mojibake", "is_non_latin", "label_with_fallback",
    "null_if_mojibake", "percentage", "repair_mojibake", "strip_trailing_separators",
    "surrogate_key", "title_case", "unescape_html",
]
