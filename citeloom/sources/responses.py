"""Landed service responses: one row per response, flattened to crosswalks and metadata.

A response row is ``(source, request_key, status, body)``; search pages also carry
``retstart``. Flatteners read good responses; :func:`response_errors` reports the rest. Every body is
parsed once, to a VARIANT that all fields are taken from; :func:`parsed` does so ahead, for responses
that several flatteners read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.identifiers import find_pmcid, identifier_key, key_kind, key_value
from citeloom.functions.jsontext import list_at, object_at, parsed_json, present_at, text_at
from citeloom.functions.metadata import journal_name, metadata_struct, year_at, year_from_text
from citeloom.functions.once import evaluated
from citeloom.operators.lookup import HotKeys, hot_keys, lookup
from citeloom.operators.ordering import dense_index, with_previous
from citeloom.scratch import Scratch

RESPONSE_SCHEMA = "source STRING, request_key STRING, status INT, body STRING"

# Source names as they appear in results and messages.
IDCONV, ESUMMARY, GRAPH, ESEARCH = "pmc", "entrez", "semantic-scholar", "pubmed"


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a landed-response table (parquet or JSON) with its fixed schema."""
    return spark.read.schema(RESPONSE_SCHEMA).format(fmt).load(path)


def parsed(responses: DataFrame) -> DataFrame:
    """Responses with their bodies as VARIANTs in ``json``; null for those not to be read."""
    if "json" in responses.columns:
        return responses
    read = responses.withColumn("_read", F.when(F.col("status") < 400, F.col("body")))
    return parsed_json(read, "_read").drop("_read")


def _error_text() -> Column:
    """Null for a usable or simply absent response, else the error message."""
    source, status = F.col("source"), F.col("status")
    status_text = F.concat(source, F.lit(": error "), status.cast("string"))
    unreadable = F.when(F.col("json").isNull(), F.concat(source, F.lit(": invalid JSON response")))
    return (
        F.when(status < 400, unreadable)
        .when((source == GRAPH) & (status == 404), F.lit(None).cast("string"))
        .when(source == GRAPH, F.concat(status_text, F.lit(" for "), F.col("request_key")))
        .otherwise(status_text)
    )


def response_errors(responses: DataFrame) -> DataFrame:
    """``source, request_key, message`` for every failed response."""
    read = parsed(responses)
    judged = evaluated(read, "source", "request_key", _error_text().alias("message"))
    return judged.where(F.col("message").isNotNull())


def usable(responses: DataFrame) -> DataFrame:
    """Responses with a body to read, parsed: no error and not a 404 miss."""
    return parsed(responses).where((F.col("status") < 400) & F.col("json").isNotNull())


def _of(responses: DataFrame, source: str) -> DataFrame:
    return usable(responses.where(F.col("source") == source)).drop("body")


# -- search pages -------------------------------------------------------------------------

# Error texts of searches; the last three are for pages that were never landed.
SEARCH_FAILED = "Failed to query PubMed"
SEARCH_STRUCTURE = "Unexpected PubMed response structure"
SEARCH_COUNT = "Invalid count in PubMed response"
SEARCH_LATE = "Search pages do not begin at the start"
SEARCH_GAP = "Search pages leave a gap or overlap"
SEARCH_SHORT = "Search pages end before the total"


def _search_pages(pages: DataFrame) -> DataFrame:
    json = F.col("json")
    parsed_pages = evaluated(
        parsed(pages),
        "search_hash",
        F.col("retstart").cast("bigint").alias("retstart"),
        ((F.col("status") >= 400) | json.isNull()).alias("failed"),
        object_at(json, "$.esearchresult").isNull().alias("unknown"),
        F.try_variant_get(json, "$.esearchresult.idlist", "array<string>").alias("idlist"),
        text_at(json, "$.esearchresult.count").alias("count"),
    )
    ids = F.coalesce("idlist", F.array().cast("array<string>"))
    count = F.col("count").try_cast("bigint")
    error = F.when(F.col("failed"), F.lit(SEARCH_FAILED)).when(
        F.col("unknown"), F.lit(SEARCH_STRUCTURE)
    )
    return parsed_pages.select(
        "search_hash",
        "retstart",
        ids.alias("ids"),
        (F.col("retstart") + F.size(ids)).alias("end"),
        F.coalesce(count, F.size(ids).cast("bigint")).alias("count"),
        (error.isNull() & F.col("count").isNotNull() & count.isNull()).alias("bad_count"),
        error.alias("error"),
    )


def _search_starts(pages: DataFrame) -> DataFrame:
    """What a search's first page says: one small row per search."""
    said = F.struct("retstart", (-F.col("end")).alias("least"), "count", "bad_count")
    first = pages.groupBy("search_hash").agg(F.min(said).alias("s"))
    return first.select(
        "search_hash",
        F.col("s.retstart").alias("first"),
        F.col("s.count").alias("total"),
        F.col("s.bad_count").alias("bad_count"),
    )


def _search_verdicts(pages: DataFrame, hot: HotKeys, scratch: Scratch) -> DataFrame:
    """``search_hash, total, last, message``: a small row per search; a complete one has no message.

    The paging loop asks for pages below the total and ends at the first empty one of these;
    ``last`` is where the last page that it can read begins. Pages cover a search if each begins
    where the one before it ends, which is compared over a global order: neither a long search nor
    one landed many times is a task of its own.
    """
    asked = lookup(
        pages.select("search_hash", "retstart", "end", "error"),
        _search_starts(pages),
        "search_hash",
        how="inner",
        hot=hot,
        null_keys=False,
    ).where((F.col("retstart") == F.col("first")) | (F.col("retstart") < F.col("total")))
    # Of pages that begin alike the longest comes first, so that the others overlap it.
    order = ["search_hash", "retstart", F.col("end").desc(), "error"]
    ordered = dense_index(asked, order, "place", scratch)
    compared = with_previous(ordered, ["search_hash", "end"], "place")
    follows = F.col("previous_search_hash") == F.col("search_hash")
    torn = follows & (F.col("previous_end") != F.col("retstart"))
    bad, empty = F.col("error").isNotNull(), F.col("error").isNull() & (F.col("end") == F.col("retstart"))

    def where_first(condition: Column) -> Column:
        return F.min(F.when(condition, F.col("retstart")))

    found = compared.groupBy("search_hash").agg(
        F.min("first").alias("first"),
        F.min("total").alias("total"),
        F.bool_or("bad_count").alias("bad_count"),
        where_first(empty).alias("first_empty"),
        where_first(bad).alias("first_bad"),
        F.min_by("error", F.when(bad, F.struct("retstart", "error"))).alias("why"),
        where_first(torn).alias("first_torn"),
        F.max("end").alias("end"),
    )
    ends = F.coalesce("first_empty", F.lit((1 << 63) - 1))
    return found.select(
        "search_hash",
        "total",
        ends.alias("last"),
        F.when(F.col("first") > 0, F.lit(SEARCH_LATE))
        .when(F.col("first_bad") <= ends, F.col("why"))
        .when(F.col("bad_count"), F.lit(SEARCH_COUNT))
        .when(F.col("first_torn") <= ends, F.lit(SEARCH_GAP))
        .when(
            F.col("first_empty").isNull() & (F.col("end") < F.col("total")), F.lit(SEARCH_SHORT)
        )
        .alias("message"),
    )


def _read_searches(
    pages: DataFrame, hot: HotKeys | None, scratch: Scratch | None
) -> tuple[DataFrame, DataFrame, HotKeys]:
    """Pages parsed once and kept, the verdicts on their searches, and the hot searches."""
    scratch = scratch or Scratch(pages.sparkSession, "searches")
    read = scratch.keep(_search_pages(pages), "pages")
    hot = hot_keys(read, "search_hash") if hot is None else hot
    return read, _search_verdicts(read, hot, scratch), hot


def esearch_ids(
    pages: DataFrame, hot: HotKeys | None = None, scratch: Scratch | None = None
) -> DataFrame:
    """``search_hash, position, pmid`` of landed search pages, in service order, no dedup.

    A search's pages count up to the first empty one or the total named on its first page;
    whatever was landed beyond is not looked at. A search whose loop would have met a failed page,
    or whose pages do not follow each other, gives no ids (see :func:`esearch_errors`). Where they
    do, an id's position is its page's start plus its place there.
    """
    read, verdicts, hot = _read_searches(pages, hot, scratch)
    complete = verdicts.where(F.col("message").isNull()).select("search_hash", "last", "total")
    kept = lookup(
        read.select("search_hash", "retstart", "ids"),
        complete,
        "search_hash",
        how="inner",
        hot=hot,
        null_keys=False,
    ).where(
        ((F.col("retstart") == 0) | (F.col("retstart") < F.col("total")))
        & (F.col("retstart") <= F.col("last"))
    )
    return kept.select("search_hash", "retstart", F.posexplode("ids").alias("pos", "pmid")).select(
        "search_hash", (F.col("retstart") + F.col("pos")).alias("position"), "pmid"
    )


def esearch_errors(
    pages: DataFrame, hot: HotKeys | None = None, scratch: Scratch | None = None
) -> DataFrame:
    """``source, request_key, message`` for every search that failed or is incomplete."""
    _, verdicts, _ = _read_searches(pages, hot, scratch)
    return verdicts.where(F.col("message").isNotNull()).select(
        F.lit(ESEARCH).alias("source"), F.col("search_hash").alias("request_key"), "message"
    )


# -- crosswalks ---------------------------------------------------------------------------


def idconv_crosswalk(responses: DataFrame) -> DataFrame:
    """``pmcid, pmid, doi`` of id-conversion responses; later rows of a PMCID win."""
    rows = _of(responses, IDCONV).select(
        "request_key", F.posexplode(list_at(F.col("json"), "$.records")).alias("pos", "r")
    )

    def present(kind: str) -> Column:
        return present_at(F.col("r"), f"$.{kind}")

    named = evaluated(
        rows,
        present("pmcid").alias("pmcid"),
        F.struct(
            F.col("request_key"),
            F.col("pos"),
            present("pmid").alias("pmid"),
            present("doi").alias("doi"),
        ).alias("entry"),
    ).where(F.col("pmcid").isNotNull())
    last = named.groupBy("pmcid").agg(F.max("entry").alias("entry"))
    return last.select("pmcid", "entry.pmid", "entry.doi")


def _summary_entries(responses: DataFrame, requested: DataFrame | None) -> DataFrame:
    """``pmid, entry`` of summary responses."""
    listed = _of(responses, ESUMMARY).select(
        F.explode(object_at(F.col("json"), "$.result")).alias("pmid", "entry")
    )
    if requested is not None:
        listed = restrict_to_requested(listed, requested)
    # The list of ids beside the entries is no object.
    return listed.where(F.col("pmid") != "uids")


def restrict_to_requested(entries: DataFrame, requested: DataFrame) -> DataFrame:
    """Service answers for keys that were asked for (``requested`` has column ``pmid``)."""
    return entries.join(requested.select("pmid").distinct(), "pmid", "left_semi")


def esummary_crosswalk(responses: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """``pmid, pmcid, doi`` of summary responses; the last usable id of a kind wins."""
    ids = F.transform(
        list_at(F.col("entry"), "$.articleids"),
        lambda r: F.struct(
            F.lower(text_at(r, "$.idtype")).alias("idtype"), present_at(r, "$.value").alias("value")
        ),
    )

    def last(kinds: tuple[str, ...], read) -> Column:
        wanted = F.filter("ids", lambda i: i["idtype"].isin(*kinds) & i["value"].isNotNull())
        values = F.transform(wanted, lambda i: read(i["value"]))
        return F.try_element_at(F.filter(values, lambda v: v.isNotNull()), F.lit(-1))

    listed = evaluated(_summary_entries(responses, requested), "pmid", ids.alias("ids"))
    picked = evaluated(
        listed,
        "pmid",
        last(("pmc", "pmcid"), find_pmcid).alias("pmcid"),
        last(("doi",), lambda v: v).alias("doi"),
    )
    return picked.where(F.col("pmcid").isNotNull() | F.col("doi").isNotNull())


def external_ids(responses: DataFrame, extra_keys: bool = False) -> DataFrame:
    """``kind, value, pmid, pmcid, doi`` of paper-graph responses.

    The looked-up key is the request key, classified. ``extra_keys`` also reads the names the
    service uses today.
    """
    # Payload keys in order of preference.
    names = {"pmid": ["PMID", "pmid"], "pmcid": ["PMCID", "pmcid"], "doi": ["DOI", "doi"]}
    if extra_keys:
        names["pmid"].append("PubMed")
        names["pmcid"].append("PubMedCentral")
    rows = evaluated(
        _of(responses, GRAPH),
        identifier_key(F.col("request_key")).alias("key"),
        F.try_variant_get("json", "$.externalIds", "variant").alias("ids"),
    )
    picked = evaluated(
        rows,
        key_kind(F.col("key")).alias("kind"),
        key_value(F.col("key")).alias("value"),
        *[
            F.coalesce(*[present_at(F.col("ids"), f"$.{n}") for n in keys]).alias(kind)
            for kind, keys in names.items()
        ],
    )
    return picked.where(F.coalesce("pmid", "pmcid", "doi").isNotNull())


# -- metadata -----------------------------------------------------------------------------


def _names(authors: Column) -> Column:
    """Names that are given, of a list of authors."""
    return F.filter(F.transform(authors, lambda a: text_at(a, "$.name")), lambda n: n != "")


def graph_metadata(responses: DataFrame) -> DataFrame:
    """``key, metadata`` of paper-graph responses; the key is the request key as asked."""
    json = F.col("json")
    known = ["title", "abstract", "venue", "journal", "year"]
    # A member that is null is there all the same.
    has_any = F.coalesce(*[F.try_variant_get(json, f"$.{k}", "variant") for k in known]).isNotNull()
    authors = list_at(json, "$.authors")
    rows = _of(responses, GRAPH).where(has_any | authors.isNotNull())
    meta = metadata_struct(
        text_at(json, "$.title"),
        text_at(json, "$.abstract"),
        _names(authors),
        journal_name(text_at(json, "$.journal"), text_at(json, "$.venue")),
        year_at(json, "$.year"),
        F.lit(GRAPH),
    )
    return rows.select(F.col("request_key").alias("key"), meta.alias("metadata"))


def summary_metadata(
    responses: DataFrame, requested: DataFrame | None = None, strict_abstract: bool = False
) -> DataFrame:
    """``key, metadata`` of summary responses.

    Summaries carry no abstract; by default the field holds the electronic location id, as
    existing results do. ``strict_abstract`` leaves it null.
    """
    entry = F.col("entry")
    date_text = F.coalesce(
        F.nullif(text_at(entry, "$.pubdate"), F.lit("")), text_at(entry, "$.sortpubdate")
    )
    meta = metadata_struct(
        text_at(entry, "$.title"),
        F.lit(None) if strict_abstract else text_at(entry, "$.elocationid"),
        _names(list_at(entry, "$.authors")),
        text_at(entry, "$.fulljournalname"),
        year_from_text(date_text),
        F.lit(ESUMMARY),
    )
    filled = F.cardinality(object_at(entry, "$")) > 0
    return _summary_entries(responses, requested).where(filled).select(
        F.col("pmid").alias("key"), meta.alias("metadata")
    )
