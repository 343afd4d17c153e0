"""The same queries in DuckDB SQL, written from the semantics and not from the Spark plans."""

from __future__ import annotations

from citeloom.checks.views import with_views
from citeloom.functions.identifiers import WHITESPACE

_W = "'" + WHITESPACE + "'"


# -- SQL fragments ------------------------------------------------------------------------


def _strip(x: str) -> str:
    return f"trim({x}, {_W})"


def _digits(x: str) -> str:
    return f"regexp_full_match({x}, '[0-9]+')"


def _pmid(x: str) -> str:
    return f"CASE WHEN {_digits(_strip(x))} THEN {_strip(x)} END"


def _pmc_number(x: str) -> str:
    return f"regexp_replace(regexp_replace(upper({_strip(x)}), '^PMCID:', ''), '^PMC', '')"


def _pmcid(x: str) -> str:
    return f"CASE WHEN {_digits(_pmc_number(x))} THEN 'PMC' || {_pmc_number(x)} END"


def _doi(x: str) -> str:
    bare = f"regexp_replace({_strip(x)}, '^doi:', '', 'i')"
    return f"CASE WHEN contains({bare}, '/') THEN lower({bare}) END"


def _kind(x: str) -> str:
    s = _strip(x)
    return f"""CASE WHEN {x} IS NULL OR {s} = '' THEN NULL
      WHEN lower({s}) LIKE 'pmid:%' THEN CASE WHEN ({_pmid(f'substr({s}, 6)')}) IS NOT NULL THEN 'pmid' END
      WHEN lower({s}) LIKE 'pmc%' THEN CASE WHEN ({_pmcid(x)}) IS NOT NULL THEN 'pmcid' END
      WHEN {_digits(s)} THEN 'pmid' WHEN contains({s}, '/') THEN 'doi' END"""


def _value(x: str) -> str:
    s = _strip(x)
    return f"""CASE WHEN {x} IS NULL OR {s} = '' THEN NULL
      WHEN lower({s}) LIKE 'pmid:%' THEN {_pmid(f'substr({s}, 6)')}
      WHEN lower({s}) LIKE 'pmc%' THEN {_pmcid(x)}
      WHEN {_digits(s)} THEN {s} ELSE {_doi(x)} END"""


def _error(x: str) -> str:
    s = _strip(x)
    rest = f"substr({s}, 6)"
    return f"""CASE WHEN {x} IS NULL OR {s} = '' THEN 'Identifier cannot be blank'
      WHEN lower({s}) LIKE 'pmid:%' THEN CASE WHEN {_strip(rest)} = '' THEN 'Empty PMID provided'
        WHEN ({_pmid(rest)}) IS NULL THEN 'Invalid PMID: ' || {rest} END
      WHEN lower({s}) LIKE 'pmc%' THEN CASE WHEN ({_pmcid(x)}) IS NULL THEN 'Invalid PMCID: ' || {s} END
      WHEN NOT {_digits(s)} AND NOT contains({s}, '/') THEN 'Unrecognized identifier: ' || {x} END"""


def _present(document: str, key: str) -> str:
    value = f"json_extract({document}, '$.{key}')"
    return f"CASE WHEN {_TRUTHY.format(v=value)} THEN {document} ->> '$.{key}' END"


_LONG = """SELECT k, path, kv.key AS from_key, kv.raw AS raw FROM {view},
  unnest([{{'key': 'pmid', 'raw': pmid}}, {{'key': 'pmcid', 'raw': pmcid}}, {{'key': 'doi', 'raw': doi}}]) AS u(kv)
  WHERE kv.raw IS NOT NULL AND {blank} <> ''"""


def _long(view: str) -> str:
    return _LONG.format(view=view, blank=_strip("kv.raw"))


def _graph(view: str, path: str = "path") -> str:
    """CTEs ids(k, id, kind, value), reach(id, other), comp(id, component) by transitive closure.

    Each id is linked to its records' smallest record number and back, so the closure runs over
    (id, record) pairs.
    """
    source = f"SELECT k, {path} AS path, pmid, pmcid, doi FROM {view}"
    return f"""src AS ({source}),
long AS ({_long('src')}),
ids AS (SELECT DISTINCT k, ({_kind('raw')}) AS kind, ({_value('raw')}) AS value FROM long
        WHERE ({_kind('raw')}) IS NOT NULL),
named AS (SELECT k, kind, value, kind || ':' || value AS id FROM ids),
links AS (SELECT DISTINCT a.id AS a, b.id AS b FROM named a JOIN named b USING (k)),
reach AS (SELECT a AS id, a AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT id, min(other) AS component FROM reach GROUP BY id),
members AS (SELECT DISTINCT n.id, n.kind, n.value, c.component FROM named n JOIN comp c USING (id))"""


# Closure by all pairs would be quadratic on a hub, so components of the hub view come from
# spreading the smallest label: with one hub, every member is within a few hops of it.
_HUB = f"""src AS (SELECT k, '' AS path, pmid, pmcid, doi FROM hub_recs),
long AS ({_long('src')}),
named AS (SELECT DISTINCT k, ({_kind('raw')}) AS kind, ({_value('raw')}) AS value,
          ({_kind('raw')}) || ':' || ({_value('raw')}) AS id FROM long WHERE ({_kind('raw')}) IS NOT NULL),
touched AS (SELECT DISTINCT b.id FROM named a JOIN named b USING (k)
            WHERE a.id = 'doi:10.1000/hub'
               OR a.id IN (SELECT y.id FROM named x JOIN named y USING (k) WHERE x.id = 'doi:10.1000/hub')),
rest AS (SELECT * FROM named WHERE id NOT IN (SELECT id FROM touched)),
links AS (SELECT DISTINCT a.id AS a, b.id AS b FROM rest a JOIN rest b USING (k)),
reach AS (SELECT a AS id, a AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT id, min(other) AS component FROM reach GROUP BY id
         UNION ALL SELECT id, (SELECT min(id) FROM touched) FROM touched),
members AS (SELECT DISTINCT n.id, n.kind, n.value, c.component FROM named n JOIN comp c USING (id))"""

_LEVEL = """l{up} AS (SELECT path, cast(floor(place / 1024) AS BIGINT) AS place,
  sha256(string_agg(digest, chr(10) ORDER BY place)) AS digest FROM l{low} GROUP BY 1, 2)"""

_CONFLICTS = """SELECT component, kind,
  'Conflicting ' || kind || ' values encountered: [''' || least || ''', ''' || value || ''']' AS message
FROM (SELECT *, min(value) OVER (PARTITION BY component, kind) AS least FROM members) WHERE value <> least"""

_WIDE = """min(CASE WHEN kind = 'pmid' THEN value END) AS pmid,
  min(CASE WHEN kind = 'pmcid' THEN value END) AS pmcid,
  min(CASE WHEN kind = 'doi' THEN value END) AS doi"""

# A JSON value counts unless it is null, empty text, zero, false or empty.
_TRUTHY = """coalesce(CASE json_type({v}) WHEN 'NULL' THEN false WHEN 'VARCHAR' THEN ({v} ->> '$') <> ''
  WHEN 'BOOLEAN' THEN ({v} ->> '$') = 'true' WHEN 'ARRAY' THEN json_array_length({v}) > 0
  WHEN 'OBJECT' THEN len(json_keys({v})) > 0 ELSE ({v} ->> '$')::double <> 0 END, false)"""


def _parsed(missing: str, view: str = "raw_lines", path: str = "path") -> str:
    def field(k):
        return f"CASE WHEN ok THEN json_extract(t, '$.{k}') END"

    any_true = " OR ".join(_TRUTHY.format(v=f"j_{k}") for k in ("pmid", "pmcid", "doi"))
    return f"""lines AS (SELECT *, {_strip('value')} AS t FROM {view} WHERE {_strip('value')} <> ''),
checked AS (SELECT *, json_valid(t) AS valid,
            CASE WHEN json_valid(t) THEN json_type(t) = 'OBJECT' ELSE false END AS ok FROM lines),
fields AS (SELECT *, {field('pmid')} AS j_pmid, {field('pmcid')} AS j_pmcid, {field('doi')} AS j_doi FROM checked),
parsed AS (SELECT {path}, line_no, CASE WHEN NOT valid THEN 'invalid JSON'
  WHEN NOT ok THEN 'expected JSON object per line' WHEN NOT ({any_true}) THEN '{missing}' END AS error,
  j_pmid ->> '$' AS pmid, j_pmcid ->> '$' AS pmcid, j_doi ->> '$' AS doi FROM fields)"""


_MERGE_LINES = _parsed("row has no recognizable identifiers")
_ARTICLE_LINES = _parsed("record missing identifiers", "article_lines", "file")


def _bad_of(view: str) -> str:
    """Error rows (k, path, message) of a record view."""
    long = _long(view)
    return f"""long AS ({long}),
per_value AS (SELECT k, path, ({_error('raw')}) AS message FROM long WHERE ({_error('raw')}) IS NOT NULL),
good AS (SELECT DISTINCT k FROM long WHERE ({_error('raw')}) IS NULL),
bad AS (SELECT * FROM per_value UNION ALL
  SELECT k, path, 'record discarded after normalization due to missing identifiers' FROM {view}
  WHERE k NOT IN (SELECT k FROM good))"""


_RESPONSE_ERROR = """CASE
  WHEN source = 'semantic-scholar' AND status = 404 THEN NULL
  WHEN status >= 400 THEN source || ': error ' || status || CASE WHEN source = 'semantic-scholar' THEN ' for ' || request_key ELSE '' END
  WHEN NOT json_valid(body) THEN source || ': invalid JSON response' END"""

_OK = f"good AS (SELECT * FROM responses WHERE status < 400 AND ({_RESPONSE_ERROR}) IS NULL)"

_SEARCH = """p AS (SELECT *, status >= 400 OR NOT json_exists(body, '$.esearchresult') AS bad,
  CASE WHEN status >= 400 THEN 'Failed to query PubMed' ELSE 'Unexpected PubMed response structure' END AS why,
  coalesce(CAST(json_extract(body, '$.esearchresult.idlist') AS VARCHAR[]), []) AS ids,
  json_extract_string(body, '$.esearchresult.count') AS cnt FROM search_pages),
walk AS (SELECT *, first_value(coalesce(try_cast(cnt AS BIGINT), len(ids))) OVER w AS total, first_value(retstart) OVER w AS start,
  first_value(NOT bad AND cnt IS NOT NULL AND try_cast(cnt AS BIGINT) IS NULL) OVER w AS bad_count,
  coalesce(sum(CASE WHEN NOT bad AND len(ids) = 0 THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS empties
  FROM p WINDOW w AS (PARTITION BY search_hash ORDER BY retstart)),
reached AS (SELECT *, lag(retstart + len(ids), 1, 0::BIGINT) OVER (PARTITION BY search_hash ORDER BY retstart) AS due
  FROM walk WHERE empties = 0 AND (retstart = start OR retstart < total)),
failed AS (SELECT search_hash, CASE WHEN min(start) > 0 THEN 'Search pages do not begin at the start'
  WHEN bool_or(bad) THEN arg_min(why, retstart) FILTER (WHERE bad)
  WHEN bool_or(bad_count) THEN 'Invalid count in PubMed response'
  WHEN bool_or(retstart <> due) THEN 'Search pages leave a gap or overlap'
  WHEN max(retstart + len(ids)) < min(total) AND NOT bool_or(len(ids) = 0) THEN 'Search pages end before the total' END AS message
  FROM reached GROUP BY search_hash HAVING message IS NOT NULL)"""

_ENTRIES = f"""{_OK},
entries AS (SELECT request_key AS pmid, json_extract(body, '$.result."' || request_key || '"') AS e
            FROM good WHERE source = 'entrez')"""

_SUMMARY_IDS = f"""{_ENTRIES},
items AS (SELECT pmid, i.ordinality AS n, lower(i.a ->> '$.idtype') AS idtype, {_present('i.a', 'value')} AS v
  FROM entries, unnest(CAST(json_extract(e, '$.articleids') AS JSON[])) WITH ORDINALITY AS i(a, ordinality)),
kinds AS (SELECT pmid, n, CASE WHEN idtype IN ('pmc', 'pmcid') THEN 'pmcid' ELSE idtype END AS kind,
  CASE WHEN idtype = 'doi' THEN v ELSE coalesce(nullif(regexp_extract(upper({_strip('v')}), 'PMC[0-9]+'), ''),
    CASE WHEN upper({_strip('v')}) LIKE 'PMC%' THEN upper({_strip('v')}) END) END AS v
  FROM items WHERE idtype IN ('pmc', 'pmcid', 'doi')),
xw AS (SELECT pmid, arg_max(v, n) FILTER (WHERE kind = 'pmcid' AND v IS NOT NULL) AS pmcid,
  arg_max(v, n) FILTER (WHERE kind = 'doi' AND v IS NOT NULL) AS doi
  FROM kinds GROUP BY pmid HAVING pmcid IS NOT NULL OR doi IS NOT NULL)"""

# -- resolve: stage by stage --------------------------------------------------------------

_STAGES = f"""seeds AS (SELECT pos, ({_kind('raw')}) AS kind, ({_value('raw')}) AS value FROM inputs),
s1 AS (SELECT DISTINCT 'pmcid:' || x.pmcid AS id, u.kind, u.value FROM seeds s JOIN xw_idconv x
  ON s.kind = 'pmcid' AND s.value = x.pmcid,
  unnest([{{'kind': 'pmid', 'value': x.pmid}}, {{'kind': 'doi', 'value': x.doi}}]) AS t(u) WHERE u.value IS NOT NULL),
known1 AS (SELECT kind, value FROM seeds UNION SELECT kind, value FROM s1),
s2 AS (SELECT DISTINCT 'pmid:' || x.pmid AS id, u.kind, lower(u.value) AS low, u.value AS value FROM known1 n JOIN xw_esummary x
  ON n.kind = 'pmid' AND n.value = x.pmid,
  unnest([{{'kind': 'pmcid', 'value': x.pmcid}}, {{'kind': 'doi', 'value': x.doi}}]) AS t(u) WHERE u.value IS NOT NULL),
known2 AS (SELECT * FROM known1 UNION SELECT kind, value FROM s2),
s3raw AS (SELECT DISTINCT x.kind || ':' || x.value AS id, u.kind, u.value FROM known2 n JOIN xw_graph x
  ON n.kind IN ('pmid', 'doi') AND n.kind = x.kind AND n.value = x.value,
  unnest([{{'kind': 'pmid', 'value': x.pmid}}, {{'kind': 'pmcid', 'value': x.pmcid}}, {{'kind': 'doi', 'value': x.doi}}]) AS t(u)
  WHERE u.value IS NOT NULL),
s3 AS (SELECT * FROM s3raw WHERE value <> 'bad')"""

_RESOLVE_VIEWS = ("inputs", "xw_idconv", "xw_esummary", "xw_graph")

_RESOLVED = f"""{_STAGES},
one_way AS (SELECT id AS a, kind || ':' || value AS b FROM s1 UNION SELECT id, kind || ':' || value FROM s2
  UNION SELECT id, kind || ':' || value FROM s3),
links AS (SELECT a, b FROM one_way UNION SELECT b, a FROM one_way
  UNION SELECT kind || ':' || value, kind || ':' || value FROM seeds),
reach AS (SELECT a AS id, a AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT id, min(other) AS component FROM reach GROUP BY id),
parts AS (SELECT c.component, split_part(c.id, ':', 1) AS kind, substr(c.id, instr(c.id, ':') + 1) AS value, s.pos
  FROM comp c LEFT JOIN seeds s ON c.id = s.kind || ':' || s.value)"""

# The latest stage that first names a value wins; of its values the largest.
_DISPUTED = f"""seeds AS (SELECT pos, ({_kind('raw')}) AS kind, ({_value('raw')}) AS value FROM disputed_inputs),
d1 AS (SELECT DISTINCT 'pmid:' || x.pmid AS id, u.kind, u.value FROM seeds s JOIN disputed_summaries x
  ON s.kind = 'pmid' AND s.value = x.pmid,
  unnest([{{'kind': 'pmcid', 'value': x.pmcid}}, {{'kind': 'doi', 'value': x.doi}}]) AS t(u)),
known AS (SELECT kind, value FROM seeds UNION SELECT kind, value FROM d1),
d2 AS (SELECT DISTINCT 'doi:' || x.value AS id, u.kind, u.value FROM known n JOIN disputed_graph x
  ON n.kind = 'doi' AND n.value = x.value,
  unnest([{{'kind': 'pmid', 'value': x.pmid}}, {{'kind': 'pmcid', 'value': x.pmcid}}, {{'kind': 'doi', 'value': x.doi}}]) AS t(u)
  WHERE u.value IS NOT NULL),
named AS (SELECT kind, value, 0 AS stage, pos FROM seeds UNION ALL SELECT kind, value, 1, NULL FROM d1
  UNION ALL SELECT kind, value, 2, NULL FROM d2),
values_ AS (SELECT kind || ':' || value AS id, kind, value, min(stage) AS stage, min(pos) AS pos FROM named GROUP BY ALL),
one_way AS (SELECT id AS a, kind || ':' || value AS b FROM d1 UNION SELECT id, kind || ':' || value FROM d2),
links AS (SELECT a, b FROM one_way UNION SELECT b, a FROM one_way UNION SELECT id, id FROM values_),
reach AS (SELECT a AS id, a AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT id, min(other) AS component FROM reach GROUP BY id),
judged AS (SELECT *, first_value(value) OVER (PARTITION BY component, kind ORDER BY stage DESC, value DESC) AS kept
  FROM values_ JOIN comp USING (id))"""

_DISPUTED_VIEWS = ("disputed_inputs", "disputed_summaries", "disputed_graph")

# -- HTML and full text -------------------------------------------------------------------

_HIDDEN = (
    "(?is)<!--.*?(?:-->|\\z)|<script[\\s>/].*?(?:</script\\s*>|\\z)|<style[\\s>/].*?(?:</style\\s*>|\\z)"
    "|<template[\\s>/].*?(?:</template\\s*>|\\z)"
)


def _html_text(x: str) -> str:
    shown = f"regexp_replace({x}, '{_HIDDEN}', chr(10), 'g')"
    shown = f"regexp_replace({shown}, '<[!?/a-zA-Z][^>]*>', chr(10), 'g')"
    for entity, char in (
        ("lt", "'<'"),
        ("gt", "'>'"),
        ("quot", "chr(34)"),
        ("nbsp", "chr(160)"),
        ("copy", "chr(169)"),
        ("middot", "chr(183)"),
        ("amp", "'&'"),
    ):
        shown = f"regexp_replace({shown}, '&{entity};?', {char}, 'g')"
    lines = f"list_transform(regexp_split_to_array({shown}, '[\\n\\r]'), lambda s: {_strip('s')})"
    return f"nullif(array_to_string(list_filter({lines}, lambda s: s <> ''), chr(10)), '')"


_TEXTS = f"""a AS (SELECT key, ({_html_text('html')}) AS text FROM text_a),
b AS (SELECT key, {_strip('text')} AS text FROM text_b)"""

def _served(records: str) -> str:
    """Records with the text and the misses of both providers."""
    return f"""{_TEXTS},
chosen AS (SELECT r.*, CASE WHEN a.text <> '' THEN 'pubget' WHEN b.text <> '' THEN 'ace' END AS text_source,
  CASE WHEN a.text <> '' THEN a.text WHEN b.text <> '' THEN b.text END AS text,
  CASE WHEN r.pmcid IS NOT NULL AND coalesce(a.text, '') = '' THEN 'PubGet returned no text for ' || r.pmcid END AS miss_a,
  CASE WHEN coalesce(a.text, '') = '' AND r.pmid IS NOT NULL AND coalesce(b.text, '') = ''
    THEN 'ACE returned no text for PMID ' || r.pmid END AS miss_b
  FROM {records} r LEFT JOIN a ON r.pmcid = a.key LEFT JOIN b ON r.pmid = b.key)"""


_CHOSEN = _served("article_recs")

_TEXT_VIEWS = ("article_recs", "text_a", "text_b")

_PICKED = """g AS (SELECT request_key AS key, body FROM article_responses WHERE source = 'semantic-scholar'),
e AS (SELECT request_key AS key, json_extract(body, '$.result."' || request_key || '"') AS body FROM article_responses WHERE source = 'entrez'),
picked AS (SELECT c.*, coalesce(g1.body, g2.body, e.body) AS body,
  CASE WHEN g1.key IS NOT NULL OR g2.key IS NOT NULL THEN 'semantic-scholar' WHEN e.key IS NOT NULL THEN 'entrez' END AS source
  FROM chosen c LEFT JOIN g g1 ON c.pmid = g1.key AND c.text_source IS NOT NULL
  LEFT JOIN g g2 ON c.doi = g2.key AND c.text_source IS NOT NULL LEFT JOIN e ON c.pmid = e.key AND c.text_source IS NOT NULL)"""

_DESCRIBED = """body ->> '$.title' AS title,
  CASE WHEN source IS NOT NULL THEN coalesce(body ->> '$.authors[0].name', '') END AS authors,
  CASE WHEN source = 'entrez' THEN body ->> '$.fulljournalname' ELSE coalesce(body ->> '$.journal.name', body ->> '$.venue') END AS journal,
  try_cast(nullif(regexp_extract(coalesce(body ->> '$.year', body ->> '$.pubdate'), '(19|20)[0-9]{2}'), '') AS INT) AS year, source"""

_GRAPH_AUTHORS = """array_to_string(list_filter(list_transform(CAST(json_extract(body, '$.authors') AS JSON[]),
  lambda a: CASE WHEN json_type(a) = 'OBJECT' THEN a ->> '$.name' END), lambda n: n <> ''), '|')"""


ORACLES: dict[str, str] = {
    "q_strip": f"{with_views('raw_ids')} SELECT k, {_strip('raw')} AS stripped FROM raw_ids",
    "q_normalize_ids": f"""{with_views('raw_ids')},
n AS (SELECT k, ({_kind('raw')}) AS kind, ({_value('raw')}) AS value FROM raw_ids)
SELECT k, kind, value, kind || ':' || value AS id_key FROM n WHERE kind IS NOT NULL""",
    "q_normalize_errors": f"""{with_views('raw_ids')},
n AS (SELECT k, ({_error('raw')}) AS error FROM raw_ids) SELECT k, error FROM n WHERE error IS NOT NULL""",
    "q_kind_directed": f"""{with_views('raw_ids')},
n AS (SELECT k, ({_pmid('raw')}) AS as_pmid, ({_pmcid('raw')}) AS as_pmcid, ({_doi('raw')}) AS as_doi FROM raw_ids)
SELECT *, CASE k % 3 WHEN 0 THEN as_pmid WHEN 1 THEN as_pmcid ELSE as_doi END AS by_kind FROM n""",
    "q_pmcid_extract": f"""{with_views('service_ids')}
SELECT k, coalesce(nullif(regexp_extract(upper(raw), 'PMC[0-9]+'), ''),
  CASE WHEN upper({_strip('raw')}) LIKE 'PMC%' THEN upper({_strip('raw')}) END) AS pmcid FROM service_ids""",
    "q_explode_ids": f"""{with_views('mixed_recs')}, long AS ({_long('mixed_recs')})
SELECT k, ({_kind('raw')}) AS kind, ({_value('raw')}) AS value FROM long WHERE ({_kind('raw')}) IS NOT NULL""",
    "q_identifier_errors": f"{with_views('mixed_recs')}, {_bad_of('mixed_recs')} SELECT k, message FROM bad",
    "q_discarded": f"""{with_views('mixed_recs')}, {_bad_of('mixed_recs')}
SELECT k, path FROM bad WHERE message LIKE 'record discarded%'""",
    "q_components": f"{with_views('recs', recursive=True)}, {_graph('recs')} SELECT id, component FROM members",
    "q_components_hub": f"{with_views('hub_recs', recursive=True)}, {_HUB} SELECT id, component FROM members",
    "q_components_chain": f"""{with_views('chain_recs')},
ids AS (SELECT path_no, 'pmid:' || pmid AS id FROM chain_recs UNION SELECT path_no, 'doi:' || doi FROM chain_recs)
SELECT id, min(id) OVER (PARTITION BY path_no) AS component FROM ids""",
    "q_merge": f"""{with_views('recs', recursive=True)}, {_graph('recs')}
SELECT {_WIDE} FROM members GROUP BY component
ORDER BY coalesce('pmid:' || pmid, 'pmcid:' || pmcid, 'doi:' || doi)""",
    "q_merge_hub": f"""{with_views('hub_recs', recursive=True)}, {_HUB}
SELECT {_WIDE} FROM members GROUP BY component""",
    "q_conflicts": f"""{with_views('recs', recursive=True)}, {_graph('recs')}
{_CONFLICTS}""",
    "q_conflicts_hub": f"""{with_views('hub_recs', recursive=True)}, {_HUB}
{_CONFLICTS}""",
    "q_conflict_counts": f"""{with_views('hub_recs', recursive=True)}, {_HUB}
SELECT component, kind, count(*) AS n FROM members GROUP BY component, kind HAVING count(*) > 1""",
    "q_jsonl_records": f"""{with_views('raw_lines')}, {_MERGE_LINES}
SELECT path, line_no, pmid, pmcid, doi FROM parsed WHERE error IS NULL""",
    "q_jsonl_errors": f"""{with_views('raw_lines')}, {_MERGE_LINES}
SELECT path || ':' || line_no || ': ' || error AS message FROM parsed WHERE error IS NOT NULL""",
    "q_line_errors": f"""{with_views('file_lines')}, {_parsed('row has no recognizable identifiers', 'file_lines', 'file')}
SELECT file, line_no, line_no || ': ' || error AS message FROM parsed WHERE error IS NOT NULL""",
    "q_dedup_triples": f"""{with_views('recs')},
n AS (SELECT *, row_number() OVER (PARTITION BY pmid, pmcid, doi ORDER BY path, k) AS rn FROM recs)
SELECT path, k, pmid, pmcid, doi FROM n WHERE rn = 1""",
    "q_dedup_ids": f"""{with_views('recs')}, long AS ({_long('recs')})
SELECT ({_kind('raw')}) AS kind, ({_value('raw')}) AS value, min(k) AS pos FROM long
WHERE ({_kind('raw')}) IS NOT NULL GROUP BY 1, 2""",
    "q_hash_ids": f"""{with_views('raw_ids')},
items AS (SELECT {_strip('raw')} AS x, count(*) AS n FROM raw_ids WHERE {_strip('raw')} <> '' GROUP BY 1),
leaves AS (SELECT cast('0x' || substr(sha256(x), 1, 5) AS INT) AS leaf,
  sha256(string_agg(sha256(x) || ':' || n, chr(10) ORDER BY sha256(x) || ':' || n)) AS digest, sum(n) AS n FROM items GROUP BY 1),
branches AS (SELECT cast(floor(leaf / 1024) AS INT) AS leaf, sum(n) AS n,
  sha256(string_agg(lpad(cast(leaf AS string), 7, '0') || ':' || digest, chr(10) ORDER BY leaf)) AS digest FROM leaves GROUP BY 1)
SELECT substr(sha256(string_agg(lpad(cast(leaf AS string), 7, '0') || ':' || digest, chr(10) ORDER BY leaf)), 1, 16) AS hash,
  cast(sum(n) AS BIGINT) AS n FROM branches""",
    "q_hash_files": f"""{with_views('raw_lines')},
l0 AS (SELECT path, line_no - 1 AS place, sha256(value) AS digest FROM raw_lines),
{_LEVEL.format(up=1, low=0)}, {_LEVEL.format(up=2, low=1)}, {_LEVEL.format(up=3, low=2)}
SELECT path, sha256(string_agg(digest, chr(10) ORDER BY place)) AS digest FROM l3 GROUP BY path""",
    "q_hash_bytes": f"""{with_views('file_lines')},
files AS (SELECT file, string_agg(value || chr(10), '' ORDER BY line_no) AS bytes FROM file_lines GROUP BY file),
l0 AS (SELECT file AS path, p AS place, sha256(substr(bytes, p * 512 + 1, 512)) AS digest
  FROM files, unnest(range(0, cast(floor((length(bytes) - 1) / 512) AS BIGINT) + 1)) AS t(p)),
{_LEVEL.format(up=1, low=0)}, {_LEVEL.format(up=2, low=1)}, {_LEVEL.format(up=3, low=2)}
SELECT path AS file, sha256(string_agg(digest, chr(10) ORDER BY place)) AS digest FROM l3 GROUP BY path""",
    "q_merge_paths": f"""{with_views('recs', recursive=True)}, {_graph('recs')}
SELECT {_WIDE} FROM members GROUP BY component""",
    "q_identifier_list": f"{with_views('inputs')} SELECT raw FROM inputs",
    "q_id_list": f"{with_views('corpus')} SELECT cast(doc_id AS string) AS pmid FROM corpus",
    "q_landed": f"{with_views('responses')} SELECT source, request_key, cast(status AS INT) AS status, body FROM responses",
    "q_search": f"""{with_views('corpus')} SELECT doc_id, strftime(pub_date, '%Y-%m-%d') AS pub_date FROM corpus
WHERE contains(text, 'URGENT') AND pub_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""",
    "q_search_open_end": f"""{with_views('corpus')} SELECT doc_id FROM corpus
WHERE contains(text, 'HIGH') AND pub_date >= DATE '1999-06-01'""",
    "q_search_documents": f"""{with_views('dated_documents')}
SELECT doc_id, strftime(pub_date, '%Y-%m-%d') AS pub_date FROM dated_documents
WHERE contains(text, ' an') AND pub_date BETWEEN DATE '1992-03-15' AND DATE '1997-10-01'""",
    "q_search_pages": f"""{with_views('corpus')},
n AS (SELECT doc_id, row_number() OVER (ORDER BY pub_date, doc_id) - 1 AS position FROM corpus WHERE contains(text, 'LOW'))
SELECT doc_id, position, cast(floor(position / 100) AS bigint) AS page FROM n""",
    "q_page_slice": f"""{with_views('corpus')},
n AS (SELECT doc_id, row_number() OVER (ORDER BY pub_date, doc_id) - 1 AS position FROM corpus)
SELECT doc_id, position FROM n ORDER BY position LIMIT 500 OFFSET 1000""",
    "q_dates": f"""{with_views('date_texts')},
n AS (SELECT k, raw, CASE WHEN regexp_full_match(raw, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN strftime(try_cast(raw AS DATE), '%Y-%m-%d') END AS day FROM date_texts)
SELECT k, day, CASE WHEN raw IS NOT NULL AND day IS NULL THEN 'Invalid date for start-date: ' || raw END AS error FROM n""",
    "q_esearch_pages": f"""{with_views('search_pages')}, {_SEARCH}
SELECT search_hash, retstart + i.n - 1 AS position, i.id AS pmid
FROM reached, unnest(ids) WITH ORDINALITY AS i(id, n) WHERE search_hash NOT IN (SELECT search_hash FROM failed)""",
    "q_esearch_errors": f"""{with_views('search_pages')}, {_SEARCH}
SELECT 'pubmed' AS source, search_hash AS request_key, message FROM failed""",
    "q_status_routing": f"""{with_views('responses')}, e AS (SELECT source, request_key, {_RESPONSE_ERROR} AS message FROM responses)
SELECT * FROM e WHERE message IS NOT NULL""",
    "q_idconv": f"""{with_views('responses')}, {_OK},
items AS (SELECT request_key, i.n, {_present('i.r', 'pmcid')} AS pmcid, {_present('i.r', 'pmid')} AS pmid, {_present('i.r', 'doi')} AS doi
  FROM good, unnest(CAST(json_extract(body, '$.records') AS JSON[])) WITH ORDINALITY AS i(r, n) WHERE source = 'pmc'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY pmcid ORDER BY request_key DESC, n DESC) AS rn FROM items WHERE pmcid IS NOT NULL)
SELECT pmcid, pmid, doi FROM ranked WHERE rn = 1""",
    "q_esummary_ids": f"{with_views('responses')}, {_SUMMARY_IDS} SELECT pmid, pmcid, doi FROM xw",
    "q_semi_requested": f"""{with_views('responses', 'article_recs')}, {_SUMMARY_IDS}
SELECT pmid, pmcid, doi FROM xw WHERE pmid IN (SELECT pmid FROM article_recs WHERE pmid IS NOT NULL)""",
    "q_external_ids": f"""{with_views('responses')}, {_OK},
e AS (SELECT request_key, json_extract(body, '$.externalIds') AS x FROM good WHERE source = 'semantic-scholar'),
n AS (SELECT ({_kind('request_key')}) AS kind, ({_value('request_key')}) AS value,
  coalesce({_present('x', 'PMID')}, {_present('x', 'pmid')}) AS pmid,
  coalesce({_present('x', 'PMCID')}, {_present('x', 'pmcid')}) AS pmcid,
  coalesce({_present('x', 'DOI')}, {_present('x', 'doi')}) AS doi FROM e)
SELECT * FROM n WHERE coalesce(pmid, pmcid, doi) IS NOT NULL""",
    "q_meta_graph": f"""{with_views('responses')}, {_OK}
SELECT request_key AS key, body ->> '$.title' AS title, body ->> '$.abstract' AS abstract,
  {_GRAPH_AUTHORS} AS authors,
  coalesce(nullif(CASE WHEN json_type(body, '$.journal') = 'OBJECT' THEN body ->> '$.journal.name' ELSE body ->> '$.journal' END, ''), body ->> '$.venue') AS journal,
  CASE WHEN json_type(body, '$.year') = 'VARCHAR' THEN try_cast(nullif(regexp_extract(body ->> '$.year', '(19|20)[0-9]{{2}}'), '') AS INT)
    ELSE try_cast(body ->> '$.year' AS INT) END AS year, source
FROM good WHERE source = 'semantic-scholar'""",
    "q_meta_summary": f"""{with_views('responses')}, {_ENTRIES}
SELECT pmid AS key, e ->> '$.title' AS title, e ->> '$.elocationid' AS abstract,
  array_to_string(list_filter(list_transform(CAST(json_extract(e, '$.authors') AS JSON[]), lambda a: a ->> '$.name'), lambda n: n <> ''), '|') AS authors,
  e ->> '$.fulljournalname' AS journal,
  try_cast(nullif(regexp_extract(coalesce(nullif(e ->> '$.pubdate', ''), e ->> '$.sortpubdate'), '(19|20)[0-9]{{2}}'), '') AS INT) AS year,
  'entrez' AS source FROM entries""",
    "q_authors": f"""{with_views('responses')}
SELECT request_key, array_to_string(list_transform(CAST(json_extract(body, '$.authors') AS JSON[]),
  lambda a: CASE WHEN json_type(a) = 'OBJECT' THEN coalesce(nullif(a ->> '$.name', ''), CAST(a AS VARCHAR)) ELSE a ->> '$' END), '|') AS authors
FROM responses WHERE source = 'semantic-scholar'""",
    "q_years": f"""{with_views('responses')}
SELECT request_key, try_cast(nullif(regexp_extract(body, '(19|20)[0-9]{{2}}'), '') AS INT) AS year
FROM responses WHERE source = 'entrez'""",
    "q_resolve_stage1": f"{with_views(*_RESOLVE_VIEWS)}, {_STAGES} SELECT id, kind, value FROM s1",
    "q_resolve_stage2": f"{with_views(*_RESOLVE_VIEWS)}, {_STAGES} SELECT id, kind, value FROM s2",
    "q_resolve_stage3": f"{with_views(*_RESOLVE_VIEWS)}, {_STAGES} SELECT id, kind, value FROM s3",
    "q_resolve": f"""{with_views(*_RESOLVE_VIEWS, recursive=True)}, {_RESOLVED}
SELECT {_WIDE}, min(pos) AS pos FROM parts GROUP BY component ORDER BY pos""",
    "q_resolve_latest": f"""{with_views(*_DISPUTED_VIEWS, recursive=True)}, {_DISPUTED}
SELECT min(CASE WHEN kind = 'pmid' THEN kept END) AS pmid, min(CASE WHEN kind = 'pmcid' THEN kept END) AS pmcid,
  min(CASE WHEN kind = 'doi' THEN kept END) AS doi, min(pos) AS pos FROM judged GROUP BY component""",
    "q_resolve_conflicts": f"""{with_views(*_DISPUTED_VIEWS, recursive=True)}, {_DISPUTED}
SELECT component, kind, value, kept FROM judged WHERE value <> kept""",
    "q_sources_used": f"""{with_views(*_RESOLVE_VIEWS)}, {_STAGES}
SELECT 'pmc' AS source WHERE EXISTS (SELECT 1 FROM s1) UNION ALL SELECT 'entrez' WHERE EXISTS (SELECT 1 FROM s2)
UNION ALL SELECT 'semantic-scholar' WHERE EXISTS (SELECT 1 FROM s3)""",
    "q_resolve_errors": f"""{with_views(*_RESOLVE_VIEWS)}, {_STAGES}
SELECT 'semantic-scholar' AS stage, 'Invalid PMCID: bad' AS message FROM s3raw WHERE value = 'bad'""",
    "q_html_text": f"{with_views('text_a')} SELECT key, ({_html_text('html')}) AS text FROM text_a",
    "q_text_fallback": f"{with_views(*_TEXT_VIEWS)}, {_CHOSEN} SELECT doc_id, text_source, text FROM chosen",
    "q_text_errors": f"""{with_views(*_TEXT_VIEWS)}, {_CHOSEN}
SELECT doc_id, miss_a AS message FROM chosen WHERE miss_a IS NOT NULL
UNION ALL SELECT doc_id, miss_b FROM chosen WHERE miss_b IS NOT NULL""",
    "q_no_text": f"{with_views(*_TEXT_VIEWS)}, {_CHOSEN} SELECT doc_id FROM chosen WHERE text_source IS NULL",
    "q_metadata_fallback": f"""{with_views(*_TEXT_VIEWS, 'article_responses')}, {_CHOSEN},
{_PICKED}
SELECT doc_id, {_DESCRIBED}
FROM picked""",
    "q_fulltext_errors": f"""{with_views('article_lines')}, {_ARTICLE_LINES}
SELECT file, line_no, line_no || ': ' || error AS message FROM parsed WHERE error IS NOT NULL""",
    "q_fulltext_records": f"""{with_views('article_lines', 'text_a', 'text_b', 'article_responses')}, {_ARTICLE_LINES},
first AS (SELECT *, row_number() OVER (PARTITION BY pmid, pmcid, doi ORDER BY file, line_no) AS n FROM parsed WHERE error IS NULL),
recs AS (SELECT row_number() OVER (ORDER BY file, line_no) - 1 AS i, pmid, pmcid, doi FROM first WHERE n = 1),
{_served('recs')},
{_PICKED}
SELECT CASE WHEN i < 10000 THEN lpad(cast(i AS VARCHAR), 4, '0') ELSE cast(i AS VARCHAR) END || '_' ||
  trim(regexp_replace(lower(coalesce(pmid, pmcid, doi)), '[^a-z0-9_-]+', '_', 'g'), '_') AS slug,
  pmid, pmcid, doi, text, text_source, {_DESCRIBED}
FROM picked""",
    "q_slug": f"""{with_views('article_recs')}
SELECT doc_id, CASE WHEN doc_id < 10000 THEN lpad(cast(doc_id AS VARCHAR), 4, '0') ELSE cast(doc_id AS VARCHAR) END || '_' ||
  trim(regexp_replace(lower(coalesce(pmid, pmcid, doi)), '[^a-z0-9_-]+', '_', 'g'), '_') AS slug FROM article_recs""",
    "q_run_counts": f"""{with_views(*_TEXT_VIEWS)}, {_CHOSEN}
SELECT count(*) AS record_count, count(text_source) AS records_with_text, count(*) - count(text_source) AS records_without_text FROM chosen""",
    "q_input_counts": f"""{with_views('recs')}, long AS ({_long('recs')})
SELECT count(*) AS input_count, count(DISTINCT ({_kind('raw')}) || ':' || ({_value('raw')})) AS unique_inputs
FROM long WHERE ({_kind('raw')}) IS NOT NULL""",
    "q_error_log": f"""{with_views('raw_lines', 'responses')}, {_MERGE_LINES},
recs2 AS (SELECT row_number() OVER () AS k, path, pmid, pmcid, doi FROM parsed WHERE error IS NULL),
{_bad_of('recs2')},
r AS (SELECT source, {_RESPONSE_ERROR} AS message FROM responses)
SELECT 'read' AS stage, path, line_no, error AS message FROM parsed WHERE error IS NOT NULL
UNION ALL SELECT 'normalize', path, NULL, message FROM bad
UNION ALL SELECT source, NULL, NULL, message FROM r WHERE message IS NOT NULL""",
}
