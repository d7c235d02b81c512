"""Column expressions. Every function maps Column(s) to a Column and stays JVM-side
(no Python UDF), so it runs inside whole-stage codegen or, for the higher-order array
functions, at least inside the JVM."""

from .text import blank_to_null, initcap_words, int_to_bool, strip_nul, strip_nul_strings, zero_to_null
from .predicates import EXCLUDED_PLATFORMS, has_json, platform_ok
from .posts import clean_post_type, post_type, reactions_total, REACTION_COLUMNS
from .jsontext import (json_entries, json_fields, locale_braces, simple_braces, to_int)

__all__ = [
    "blank_to_null", "initcap_words", "int_to_bool", "strip_nul", "strip_nul_strings", "zero_to_null",
    "EXCLUDED_PLATFORMS", "has_json", "platform_ok",
    "clean_post_type", "post_type", "reactions_total", "REACTION_COLUMNS",
    "json_entries", "json_fields", "locale_braces", "simple_braces", "to_int",
]
