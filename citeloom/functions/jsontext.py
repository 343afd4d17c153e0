"""JSON helpers shared by the line sources and the landed-response flatteners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.once import evaluated

# Single-quoted JSON is invalid here, although Spark reads it by default.
OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}

CORRUPT = "_corrupt"

# Ways to write zero.
_ZERO = "^-?0(\\.0+)?([eE][+-]?[0-9]+)?$"


def parse_object(text: Column, schema: str) -> Column:
    """Struct of the given DDL fields plus a corrupt-text field; unknown keys are skipped."""
    options = {**OPTIONS, "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(text, f"{schema}, {CORRUPT} STRING", options)


def is_single_value(text: Column) -> Column:
    """True when the text is exactly one JSON value.

    JSON functions ignore whatever follows the first value they can close. Put in an array before
    a number that the text cannot know of, the text is whole if the array has two elements and the
    second is that number.
    """
    mark = F.xxhash64(text).cast("string")
    array = F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]"))
    whole = (F.json_array_length(array) == 2) & (F.get_json_object(array, "$[1]") == mark)
    return F.coalesce(whole, F.lit(False))


def truthy(value: Column, document: Column, key: str) -> Column:
    """Whether a top-level JSON value counts as present.

    ``value`` is the field parsed as text, so the string ``"0"`` and the number ``0`` look the
    same. Only texts that are open to both readings are parsed again to learn their type.
    """
    open_to_doubt = value.isin("false", "[]", "{}") | value.rlike(_ZERO)
    variant = F.variant_get(F.try_parse_json(document), f"$.{key}", "variant")
    is_string = F.coalesce(F.schema_of_variant(variant) == "STRING", F.lit(False))
    present = F.when(open_to_doubt, is_string).otherwise(value != "")
    return F.coalesce(present, F.lit(False))


# -- bodies parsed once -------------------------------------------------------------------


def parsed_json(df: DataFrame, text: str, name: str = "json") -> DataFrame:
    """Add the text as a VARIANT, null unless it is exactly one JSON value.

    One parse gives both the value and the verdict: the text is put in an array before a number
    that it cannot know of, and is whole if the array's second element is that number. An object
    that repeats a key is not valid here.
    """
    mark = F.xxhash64(text)
    array = F.concat(F.lit("["), F.col(text), F.lit(","), mark.cast("string"), F.lit("]"))
    tried = evaluated(df, *df.columns, F.try_parse_json(array).alias(name), mark.alias("_mark"))
    alone = F.try_variant_get(name, "$[1]", "bigint") == F.col("_mark")
    value = F.when(alone, F.try_variant_get(name, "$[0]", "variant"))
    return evaluated(tried, *df.columns, value.alias(name))


def text_at(value: Column, path: str) -> Column:
    """The text of what stands at a path of a VARIANT; JSON text for lists and objects."""
    return F.try_variant_get(value, path, "string")


def list_at(value: Column, path: str) -> Column:
    """The elements of a list at a path, null if there is no list."""
    return F.try_variant_get(value, path, "array<variant>")


def object_at(value: Column, path: str) -> Column:
    """The members of an object at a path, null if there is no object."""
    return F.try_variant_get(value, path, "map<string,variant>")


def present_at(value: Column, path: str) -> Column:
    """The text of what stands at a path, null if it does not count as present: no value, null,
    empty text, zero, false, an empty list or object."""
    text = text_at(value, path)
    open_to_doubt = text.isin("false", "[]", "{}") | text.rlike(_ZERO)
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    return F.when(F.when(open_to_doubt, kind == "STRING").otherwise(text != ""), text)
