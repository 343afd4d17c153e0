"""Bibliographic metadata columns: year, authors, journal, and the assembled struct."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.functions.jsontext import text_at

METADATA_TYPE = (
    "struct<title:string,abstract:string,authors:array<string>,"
    "journal:string,year:int,source:string>"
)


def year_from_text(text: Column) -> Column:
    """First 19xx or 20xx anywhere in the text; null when there is none."""
    found = F.regexp_extract(text, "(19|20)[0-9]{2}", 0)
    return F.nullif(found, F.lit("")).try_cast("int")


def year_at(value: Column, path: str) -> Column:
    """Year at a path of a VARIANT: a whole number stands for itself, text is searched."""
    text = text_at(value, path)
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    numeric = text.rlike("^[-+.0-9eE]+\\z")
    whole = F.when(kind == "BIGINT", text.try_cast("int"))
    # Only where a number and a string would give different years does the type matter.
    return (
        F.when(text.rlike("^(19|20)[0-9]{2}\\z"), text.try_cast("int"))
        .when(numeric & (kind != "STRING"), whole)
        .otherwise(year_from_text(text))
    )


def author_names(raw: Column) -> Column:
    """``array<string>`` from the raw JSON of an author field.

    Strings are kept, objects give their ``name``, other values their text. An object of
    authors gives its values; anything else gives an empty array.
    """
    listed = F.when(raw.startswith("["), F.from_json(raw, "array<string>"))
    keyed = F.when(raw.startswith("{"), F.map_values(F.from_json(raw, "map<string,string>")))

    def one(author: Column) -> Column:
        named = F.nullif(F.get_json_object(author, "$.name"), F.lit(""))
        return F.coalesce(F.when(author.startswith("{"), named), author, F.lit("None"))

    return F.coalesce(F.transform(F.coalesce(listed, keyed), one), F.array().cast("array<string>"))


def journal_name(journal: Column, venue: Column) -> Column:
    """Name of a journal given as text or as an object; the venue when it is absent or empty."""
    named = F.when(journal.startswith("{"), F.get_json_object(journal, "$.name")).otherwise(journal)
    return F.coalesce(F.nullif(named, F.lit("")), venue)


def metadata_struct(
    title: Column,
    abstract: Column,
    authors: Column,
    journal: Column,
    year_col: Column,
    source: Column,
) -> Column:
    return F.struct(
        title.cast("string").alias("title"),
        abstract.cast("string").alias("abstract"),
        F.coalesce(authors, F.array().cast("array<string>")).alias("authors"),
        journal.cast("string").alias("journal"),
        year_col.cast("int").alias("year"),
        source.alias("source"),
    )
