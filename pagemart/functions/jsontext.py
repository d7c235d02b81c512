"""JSON-as-text helpers: brace repair, object entries, typed field access.

The source keeps JSON payloads as text and some are cut (missing braces). Repair is plain
string arithmetic on the trimmed text; parsing uses ``from_json`` / ``get_json_object``, both
JVM-side. ``from_json`` returns NULL on text it cannot parse, which the quality checks report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

OPEN, CLOSE = "{", "}"
# the parser's own bound on one string (20M characters) is lifted: such texts would turn NULL
JSON_OPTIONS = {"maxStringLen": str(2**31 - 1)}


def simple_braces(c: Column) -> Column:
    """Wrap in braces when the text is non-empty and its first non-blank character is not
    ``{``; otherwise keep it unchanged (surrounding blanks included)."""
    needs_wrap = c.isNotNull() & (c != F.lit("")) & (F.left(F.trim(c), F.lit(1)) != F.lit(OPEN))
    return F.when(needs_wrap, F.concat(F.lit(OPEN), c, F.lit(CLOSE))).otherwise(c)


def locale_braces(c: Column) -> Column:
    """Six-way repair on the trimmed text ``t`` (first match wins):
    blank -> NULL; ``{..}}`` -> drop the last char; ``{..}`` -> t; ``..}`` -> ``{`` + t;
    ``{..`` -> t + ``}``; anything else -> ``{`` + t + ``}``."""
    t = F.trim(c)
    starts = F.left(t, F.lit(1)) == F.lit(OPEN)
    ends = F.right(t, F.lit(1)) == F.lit(CLOSE)
    ends_twice = F.right(t, F.lit(2)) == F.lit(CLOSE + CLOSE)
    return (F.when(c.isNull() | (t == F.lit("")), F.lit(None).cast("string"))
             .when(starts & ends_twice, F.substr(t, F.lit(1), F.length(t) - 1))
             .when(starts & ends, t)
             .when(~starts & ends, F.concat(F.lit(OPEN), t))
             .when(starts & ~ends, F.concat(t, F.lit(CLOSE)))
             .otherwise(F.concat(F.lit(OPEN), t, F.lit(CLOSE))))


def _as_objects(c: Column) -> Column:
    """The text as the items of an array: exactly one non-NULL item when it is one JSON object and nothing
    else (``{..} x``, ``{..}}``, two objects and a cut object are not)."""
    return F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<map<string,string>>", JSON_OPTIONS)


def json_entries(c: Column) -> Column:
    """``array<struct<key,value>>`` of a JSON object's members in document order, values as
    text (objects/arrays as their JSON text, JSON null as NULL). Repeated keys are all kept. NULL
    for a text that is not exactly one object."""
    items = _as_objects(c)
    return F.map_entries(F.when(F.size(items) == 1, items[0]))


def is_one_object(c: Column) -> Column:
    """Whether the text is one JSON object and nothing else; NULL for NULL."""
    items = _as_objects(c)
    return F.when(c.isNotNull(), F.coalesce((F.size(items) == 1) & items[0].isNotNull(), F.lit(False)))


def to_int(c: Column, strict: bool = False) -> Column:
    """Text to INT. Blanks around digits are allowed; ``'12.0'`` or ``'x'`` is an error in strict
    mode (ANSI cast raises, as the database would) and NULL otherwise."""
    return c.cast("int") if strict else c.try_cast("int")


def json_fields(c: Column, fields, under: str | None = None) -> Column:
    """Parse the JSON object text once and return a struct of the named members as text
    (optionally of the object nested under key ``under``). Missing members, JSON null, a
    non-object at either level and unparsable text all give NULL fields. Names may contain
    blanks (``'photo view'``)."""
    inner = StructType([StructField(f, StringType()) for f in fields])
    schema = StructType([StructField(under, inner)]) if under else inner
    parsed = F.from_json(c, schema, JSON_OPTIONS)
    return parsed[under] if under else parsed
