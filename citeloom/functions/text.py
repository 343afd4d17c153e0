"""Text columns: HTML to plain text and record slugs."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from citeloom.functions.identifiers import strip
from citeloom.functions.once import evaluated

# Comments and elements whose text is not shown. One alternation in one pass: whichever opens
# first wins, so a comment inside a script and a script inside a comment both come out right.
# An element that never closes runs to the end of the document.
_HIDDEN = "(?is)" + "|".join(
    ["<!--.*?(?:-->|\\z)"]
    + [
        f"<{tag}(?=[\\s/>])[^>]*+>.*?(?:</{tag}\\s*+>|\\z)"
        for tag in ("script", "style", "template", "rp")
    ]
    + ["<rt(?=[\\s/>])[^>]*+>.*?(?:</rt\\s*+>|(?=</ruby)|\\z)"]
)

# A tag, declaration or processing instruction; quoted attribute values may hold '>'.
# Possessive throughout, so the match is linear and needs no recursion.
_TAG = "<[!?/a-zA-Z][^>=]*+(?:=\\s*+(?:\"[^\"]*+\"|'[^']*+')?+[^>=]*+)*+>"

# The entities decoded with plain replacements. '&amp;' must come last.
_COMMON_ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&#39;": "'",
    "&nbsp;": "\u00a0",
    "&copy;": "\u00a9",
    "&middot;": "\u00b7",
    "&amp;": "&",
}
_OTHER_ENTITY = "&(?!(?:lt|gt|quot|apos|#39|nbsp|copy|middot|amp);)[#a-zA-Z]"

# Every character that ends a line of text.
_LINE_BREAK = "[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"


def _decode_all_entities(text: Column) -> Column:
    # A local function travels to executors by value; they need not have this package.
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return F.pandas_udf(decode, StringType())(text)


def _common_entities(text: Column) -> Column:
    for entity, character in _COMMON_ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def join_lines(text: Column) -> Column:
    """Strip every line, drop blank ones, join by a line feed; null when nothing is left."""
    lines = F.transform(F.split(text, _LINE_BREAK), strip)
    return F.nullif(F.array_join(F.filter(lines, lambda s: s != ""), "\n"), F.lit(""))


def html_to_text(df: DataFrame, document: str = "html", name: str = "text") -> DataFrame:
    """Replace the HTML column by its visible text, one text node per line.

    Rows with only the common entities stay in the JVM. The Python decoder sees the text of the
    other rows alone; for the rest it is sent nulls.
    """
    others = [c for c in df.columns if c not in (document, name)]
    shown = F.regexp_replace(F.regexp_replace(document, _HIDDEN, "\n"), _TAG, "\n")
    stripped = evaluated(df, *others, shown.alias("_shown"))
    rare = F.when(F.col("_shown").rlike(_OTHER_ENTITY), F.col("_shown"))
    decoded = stripped.select("*", _decode_all_entities(rare).alias("_rare"))
    plain = F.coalesce("_rare", _common_entities(F.col("_shown")))
    return evaluated(decoded, *others, join_lines(plain).alias(name))


def record_slug(
    pmid: Column, pmcid: Column, doi: Column, index: Column
) -> Column:
    """``0007_10_1000_x``: zero-padded index and the first identifier in file-name form."""
    empty_to_null = [F.nullif(c, F.lit("")) for c in (pmid, pmcid, doi)]
    name = F.lower(F.coalesce(*empty_to_null, F.concat(F.lit("record-"), index.cast("string"))))
    cleaned = F.btrim(F.regexp_replace(name, "[^a-z0-9_-]+", "_"), F.lit("_"))
    return F.format_string(
        "%04d_%s", index, F.when(cleaned == "", F.lit("record")).otherwise(cleaned)
    )
