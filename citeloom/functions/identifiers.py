"""Identifier columns: cleaning, classification and keys for PMID, PMCID and DOI values.

Every function takes and returns Columns built from JVM expressions, so they stay inside
whole-stage code generation. Bad values never raise: they come back as a null value plus an
error text, and callers split them off by filter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifier kinds in their rank order (used for tie-breaks and sort tokens).
KINDS = ("pmid", "pmcid", "doi")

# Every character Unicode treats as white space, plus the four ASCII separators
# 0x1C-0x1F. SQL trim() removes only U+0020.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# ASCII digits only: superscripts and other scripts' digits are not identifiers.
_DIGITS = "^[0-9]+\\z"


def strip(value: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(value, F.lit(WHITESPACE))


def _all_digits(value: Column) -> Column:
    return value.rlike(_DIGITS)


def pmid(value: Column) -> Column:
    """Digits after stripping, leading zeros kept; null when invalid."""
    return F.when(_all_digits(strip(value)), strip(value))


def pmcid(value: Column) -> Column:
    """``PMC`` plus digits; accepts a ``PMCID:`` prefix and bare digits; null when invalid.

    Nothing is stripped again after the prefix, so ``PMCID: PMC1`` is invalid.
    """
    bare = F.regexp_replace(F.upper(strip(value)), "^PMCID:", "")
    number = F.regexp_replace(bare, "^PMC", "")
    return F.when(_all_digits(number), F.concat(F.lit("PMC"), number))


def doi(value: Column) -> Column:
    """Lower case without a ``doi:`` prefix; must hold a slash; URLs are kept whole."""
    bare = F.regexp_replace(strip(value), "(?i)^doi:", "")
    return F.when(bare.contains("/"), F.lower(bare))


def normalize_as(kind: Column | str, value: Column) -> Column:
    """Normalize a value whose kind is already known (a literal kind or a kind column)."""
    by_kind = {"pmid": pmid, "pmcid": pmcid, "doi": doi}
    if isinstance(kind, str):
        return by_kind[kind](value)
    return (
        F.when(kind == "pmid", pmid(value))
        .when(kind == "pmcid", pmcid(value))
        .when(kind == "doi", doi(value))
    )


# Either prefix that settles the kind before the rest is looked at.
_PM_PREFIX = "^(?i)pm(?:id:|c)"
_AS_PMID = f"^(?:(?i)pmid:[{WHITESPACE}]*)?([0-9]+)\\z"
_AS_PMCID = "^(?i)(?:pmcid:(?:pmc)?|pmc)([0-9]+)\\z"


def identifier_key(value: Column) -> Column:
    """``kind:value`` for a raw identifier of unknown kind; null for a bad or blank one.

    The value decides the kind, not the place it came from. Rules in order: ``pmid:`` prefix;
    ``pmcid:`` or ``pmc`` prefix; all digits is a PMID; a slash makes a DOI.
    """
    raw = strip(value)
    as_pmid = F.regexp_extract(raw, _AS_PMID, 1)
    as_pmcid = F.regexp_extract(raw, _AS_PMCID, 1)
    return (
        F.when(as_pmid != "", F.concat(F.lit("pmid:"), as_pmid))
        .when(as_pmcid != "", F.concat(F.lit("pmcid:PMC"), as_pmcid))
        .when(
            raw.contains("/") & ~raw.rlike(_PM_PREFIX),
            F.concat(F.lit("doi:"), F.lower(F.regexp_replace(raw, "(?i)^doi:", ""))),
        )
    )


def identifier_error(value: Column) -> Column:
    """Why a raw identifier without a key is bad. Meant for values whose key is null."""
    raw = strip(value)
    after_prefix = F.substring(raw, 6, 2**31 - 1)
    return (
        F.when(value.isNull() | (raw == ""), F.lit("Identifier cannot be blank"))
        .when(
            raw.rlike("^(?i)pmid:"),
            F.when(strip(after_prefix) == "", F.lit("Empty PMID provided")).otherwise(
                F.concat(F.lit("Invalid PMID: "), after_prefix)
            ),
        )
        .when(raw.rlike("^(?i)pmc"), F.concat(F.lit("Invalid PMCID: "), raw))
        .otherwise(F.concat(F.lit("Unrecognized identifier: "), value))
    )


def key_kind(key: Column) -> Column:
    return F.substring_index(key, ":", 1)


def key_value(key: Column) -> Column:
    return F.substring(key, F.instr(key, ":") + 1, F.lit(2**31 - 1))


def classify(value: Column) -> Column:
    """``struct<kind,value,original,error>``; exactly one of ``value`` and ``error`` is set."""
    key = identifier_key(value)
    return F.struct(
        key_kind(key).alias("kind"),
        key_value(key).alias("value"),
        value.alias("original"),
        F.when(key.isNull(), identifier_error(value)).alias("error"),
    )


def require_key(value: Column) -> Column:
    """Strict mode: the key, failing the job on the first bad identifier."""
    return F.coalesce(identifier_key(value), F.raise_error(identifier_error(value)))


def compact(*values: Column) -> Column:
    """Array of the string values that are not null, each once, in order.

    Unlike a lambda over an array this keeps the values inside generated code.
    """
    return F.array_except(F.array(*values), F.array(F.lit(None).cast("string")))


def find_pmcid(value: Column) -> Column:
    """Lenient PMCID from service text such as ``pmc-id: PMC123;``.

    The first ``PMC`` + digits anywhere, else the text itself when it begins with ``PMC``.
    """
    text = F.upper(strip(value))
    return F.coalesce(
        F.nullif(F.regexp_extract(text, "PMC[0-9]+", 0), F.lit("")),
        F.when(text.startswith("PMC"), text),
    )


def id_key(kind: Column, value: Column) -> Column:
    """``kind:value``; null when either part is null."""
    return F.concat(kind, F.lit(":"), value)


def sort_token(pmid_col: Column, pmcid_col: Column, doi_col: Column) -> Column:
    """Key of the first identifier present, in kind order; orders merged records."""
    present = zip(KINDS, (pmid_col, pmcid_col, doi_col))
    return F.coalesce(*[F.concat(F.lit(f"{k}:"), c) for k, c in present])


def kind_value(kind: Column, value: Column, wanted: str) -> Column:
    """The value when the row is of the wanted kind, else null (for conditional aggregates)."""
    return F.when(kind == wanted, value)
