"""Column expressions shared by the operators (all JVM-side built-ins)."""

from feedloom.functions.encode import form_encode, path_quote, param_text, query_string
from feedloom.functions.safe import (
    safe_double, safe_double_or_zero, safe_int, truthy, iso_text,
)
from feedloom.functions.jsonx import (
    as_json_array, vget, vget_default, parse_variant, variant_items,
)

__all__ = [
    "form_encode", "path_quote", "param_text", "query_string",
    "safe_double", "safe_double_or_zero", "safe_int", "truthy", "iso_text",
    "as_json_array", "vget", "vget_default", "parse_variant",
    "variant_items",
]
