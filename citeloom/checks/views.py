"""Views derived from the given tables, in SQL that Spark and DuckDB both read.

Each covers its whole source table, so the work of every query grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("orders", "documents", "pages", "labels")


def _div(n: int) -> str:
    return f"cast(floor(o_orderkey / {n}) AS bigint)"


_K = "cast(o_orderkey AS string)"

# One line of a record file, good or bad in many ways.
_LINE = f"""CASE o_orderkey % 23
         WHEN 0 THEN '{{"pmid":"' || {_K} || '","pmcid":null,"doi":"10.1000/D' || {_K} || '"}}'
         WHEN 1 THEN '  {{"pmid":' || {_K} || '}}  '
         WHEN 2 THEN '{{bad'
         WHEN 3 THEN '[1,2]'
         WHEN 4 THEN '{{"title":"No identifiers"}}'
         WHEN 5 THEN ''
         WHEN 6 THEN '{{"pmcid":"' || {_K} || '"}}'
         WHEN 7 THEN '{{"pmid":"x y","doi":"10.1000/Q' || {_K} || '"}}'
         WHEN 8 THEN '{{"pmid":0}}'
         WHEN 9 THEN '{{"pmid":"0"}}'
         WHEN 10 THEN '{{"pmid":0,"doi":"10.1000/Z' || {_K} || '"}}'
         WHEN 11 THEN '{{"pmid":"' || {_K} || '"}} tail'
         WHEN 12 THEN '{{"pmid":"","doi":false,"pmcid":[]}}'
         WHEN 13 THEN '"' || {_K} || '"'
         WHEN 14 THEN '{{"pmid":"false"}}'
         WHEN 15 THEN '{{"doi":["10.1000/L' || {_K} || '"]}}'
         WHEN 16 THEN '{{"pmid":"   "}}'
         WHEN 17 THEN '{{"pmid":"' || {_K} || '"}}{{"pmid":"2"}}'
         WHEN 18 THEN '{{"pmid":"' || {_K} || '"}}] junk'
         WHEN 19 THEN '{{"pmid":"' || {_K} || '"}}],[{{'
         WHEN 20 THEN '{{"pmid":"' || {_K} || '"}} ] }}'
         WHEN 21 THEN '[1] ] x'
         ELSE '{{"pmid":true,"extra":{{"a":[1,2]}}}}' END"""

VIEWS = {
    # Records in blocks of 12 that form one component two hops wide.
    "recs": f"""
SELECT o_orderkey AS k, 'f' || cast(o_orderkey % 3 AS string) AS path,
       cast({_div(4)} AS string) AS pmid,
       CASE WHEN o_orderkey % 12 IN (3, 4) THEN 'PMC' || cast({_div(12)} AS string) END AS pmcid,
       CASE WHEN o_orderkey % 12 IN (7, 8) THEN '10.1000/' || cast({_div(12)} AS string) END AS doi
FROM orders""",
    # A third of all records share one DOI: a hub and one giant component.
    "hub_recs": f"""
SELECT o_orderkey AS k, {_K} AS pmid,
       CASE WHEN o_orderkey % 2 = 0 THEN 'PMC' || cast({_div(4)} AS string) END AS pmcid,
       CASE WHEN o_orderkey % 3 = 0 THEN '10.1000/HUB' ELSE '10.1000/' || {_K} END AS doi
FROM orders""",
    # Three paths through all records, whose keys do not follow the path: each DOI joins a PMID
    # to the next one, so the longest path grows with the table.
    "chain_recs": f"""
SELECT o_orderkey AS k, o_orderkey % 3 AS path_no, reverse(cast(o_orderkey AS string)) AS pmid,
       cast(NULL AS string) AS pmcid, '10.1000/' || reverse(cast(o_orderkey AS string)) AS doi
FROM orders
UNION ALL
SELECT o_orderkey, o_orderkey % 3, reverse(cast(o_orderkey + 3 AS string)),
       cast(NULL AS string), '10.1000/' || reverse(cast(o_orderkey AS string))
FROM orders WHERE o_orderkey + 3 <= (SELECT max(o_orderkey) FROM orders)""",
    "raw_ids": f"""
SELECT o_orderkey AS k,
       CASE o_orderkey % 15
         WHEN 0 THEN '  ' || {_K} || ' '
         WHEN 1 THEN 'pmid:' || {_K}
         WHEN 2 THEN 'PMID: ' || {_K}
         WHEN 3 THEN 'pmc' || {_K}
         WHEN 4 THEN 'PMCID:PMC' || {_K}
         WHEN 5 THEN 'DOI:10.1000/ABC.' || {_K}
         WHEN 6 THEN '10.1000/Xyz-' || {_K}
         WHEN 7 THEN 'bad id ' || {_K}
         WHEN 8 THEN 'PMCID: PMC' || {_K}
         WHEN 9 THEN chr(9) || chr(160) || '00' || {_K} || chr(28) || chr(10)
         WHEN 10 THEN 'https://doi.org/10.1000/U' || {_K}
         WHEN 11 THEN 'pmid:10.1/x' || {_K}
         WHEN 12 THEN 'pmid: '
         WHEN 13 THEN 'doi:' || {_K}
         ELSE '   ' END AS raw
FROM orders""",
    "service_ids": f"""
SELECT o_orderkey AS k,
       CASE o_orderkey % 6
         WHEN 0 THEN 'pmc-id: PMC' || {_K} || ';'
         WHEN 1 THEN ' pmc' || {_K} || ' and PMC9'
         WHEN 2 THEN 'PMC-' || {_K}
         WHEN 3 THEN 'id ' || {_K}
         WHEN 4 THEN '  '
         ELSE 'xpmc' || {_K} END AS raw
FROM orders""",
    # Records whose values are partly or wholly unusable.
    "mixed_recs": f"""
SELECT o_orderkey AS k, 'f' || cast(o_orderkey % 3 AS string) AS path,
       CASE o_orderkey % 5 WHEN 0 THEN 'x y' WHEN 1 THEN ' ' WHEN 2 THEN {_K} END AS pmid,
       CASE o_orderkey % 4 WHEN 0 THEN {_K} WHEN 1 THEN 'PMCID: PMC1' END AS pmcid,
       CASE o_orderkey % 3 WHEN 0 THEN '10.1000/' || {_K} WHEN 1 THEN 'doi:101' END AS doi
FROM orders""",
    "raw_lines": f"""
SELECT 'f' || cast(o_orderkey % 3 AS string) || '.jsonl' AS path, {_div(3)} + 1 AS line_no,
       {_LINE} AS value
FROM orders""",
    # The same lines as files of up to 1,000 lines, numbered as they stand there.
    "file_lines": f"""
SELECT file, cast(row_number() OVER (PARTITION BY file ORDER BY k) AS bigint) AS line_no, value
FROM (SELECT {_div(1000)} AS file, o_orderkey AS k, {_LINE} AS value FROM orders) lines""",
    "inputs": f"""
SELECT o_orderkey AS pos,
       CASE o_orderkey % 3 WHEN 0 THEN 'PMC' || {_K} WHEN 1 THEN {_K} ELSE '10.1000/' || {_K} END AS raw
FROM orders""",
    "xw_idconv": f"""
SELECT 'PMC' || {_K} AS pmcid, {_K} AS pmid, cast(NULL AS string) AS doi
FROM orders WHERE o_orderkey % 6 = 0""",
    "xw_esummary": f"""
SELECT {_K} AS pmid, 'PMC' || {_K} AS pmcid, '10.1000/' || {_K} AS doi
FROM orders WHERE o_orderkey % 4 <> 3""",
    "xw_graph": f"""
SELECT 'doi' AS kind, '10.1000/' || {_K} AS value, {_K} AS pmid,
       CASE WHEN o_orderkey % 7 = 0 THEN 'bad' END AS pmcid, '10.1000/' || {_K} AS doi
FROM orders WHERE o_orderkey % 5 <> 0""",
    # Landed responses of three lookup services, good and bad.
    "responses": f"""
SELECT 'entrez' AS source, {_K} AS request_key,
       CASE WHEN o_orderkey % 11 = 0 THEN 500 WHEN o_orderkey % 7 = 0 THEN 404 ELSE 200 END AS status,
       CASE WHEN o_orderkey % 13 = 0 THEN '<html>busy</html>' WHEN o_orderkey % 13 = 1 THEN '{{"result":{{}}}} ] junk' ELSE
       '{{"result":{{"uids":["' || {_K} || '"],"' || {_K} ||
       '":{{"pubdate":"' || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE cast(1890 + o_orderkey % 130 AS string) || ' Mar 11' END ||
       '","sortpubdate":"2001/03/11 00:00","title":"T' || {_K} ||
       '","elocationid":"doi: 10.1000/' || {_K} || '","fulljournalname":"J' || cast(o_orderkey % 9 AS string) ||
       '","authors":[{{"name":"A ' || {_K} || '"}},{{"name":""}},{{"authtype":"x"}},{{"name":"B"}}]' ||
       ',"articleids":[{{"idtype":"pubmed","value":"' || {_K} || '"}},{{"idtype":"pmc","value":"' ||
       CASE WHEN o_orderkey % 3 = 0 THEN 'none' ELSE 'PMC' || {_K} END ||
       '"}},{{"idtype":"PMCID","value":"' || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'pmc-id: PMC' || {_K} || ';' END ||
       '"}}' || CASE WHEN o_orderkey % 18 = 0 THEN ',{{"idtype":"doi","value":"0"}}'
         WHEN o_orderkey % 18 = 2 THEN ',{{"idtype":"doi","value":0}}'
         WHEN o_orderkey % 2 = 0 THEN ',{{"idtype":"doi","value":"10.1000/' || {_K} || '"}}' ELSE '' END ||
       ']}}}}}}' END AS body
FROM orders
UNION ALL
SELECT 'pmc' AS source, {_K} AS request_key,
       CASE WHEN o_orderkey % 11 = 0 THEN 429 ELSE 200 END AS status,
       '{{"status":"ok","records":[{{"pmcid":"PMC' || cast({_div(2)} AS string) || '","pmid":' || {_K} ||
       ',"doi":"10.1000/' || {_K} || '"}},{{"requested-id":"x"}},{{"pmcid":"PMCX' || {_K} || '","pmid":' ||
       CASE o_orderkey % 3 WHEN 0 THEN 'null' WHEN 1 THEN '"0"' ELSE '0' END || '}}]}}' AS body
FROM orders
UNION ALL
SELECT 'semantic-scholar' AS source,
       CASE WHEN o_orderkey % 2 = 0 THEN {_K} ELSE '10.1000/S' || {_K} END AS request_key,
       CASE WHEN o_orderkey % 11 = 0 THEN 429 WHEN o_orderkey % 7 = 0 THEN 404 ELSE 200 END AS status,
       '{{"paperId":"p","title":"G' || {_K} || '","abstract":' || CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE '"abs"' END ||
       ',"venue":"V","year":' || CASE o_orderkey % 4 WHEN 0 THEN '2019' WHEN 1 THEN '"c. 1987"' WHEN 2 THEN '1850' ELSE 'null' END ||
       ',"journal":' || CASE o_orderkey % 3 WHEN 0 THEN '{{"name":"JN' || {_K} || '","volume":"3"}}' WHEN 1 THEN 'null' ELSE '"Plain"' END ||
       ',"authors":[{{"authorId":"1","name":"N ' || {_K} || '"}},{{"name":null}},"text",{{"name":"M"}}]' ||
       ',"externalIds":' || CASE WHEN o_orderkey % 5 = 0 THEN '{{"MAG":"1"}}' ELSE
       '{{"' || CASE WHEN o_orderkey % 2 = 0 THEN 'DOI' ELSE 'doi' END || '":"10.1000/S' || {_K} || '","PMID":' ||
       CASE o_orderkey % 17 WHEN 0 THEN '"0"' WHEN 1 THEN '0' ELSE {_K} END || ',"CorpusId":7}}' END ||
       '}}' AS body
FROM orders""",
    # Search pages of three ids, up to 20 landed pages per search; totals, empty,
    # failed and missing pages vary.
    "search_pages": f"""
SELECT 's' || cast({_div(20)} AS string) AS search_hash, (o_orderkey % 20) * 3 AS retstart,
       CASE WHEN {_div(20)} % 5 = 1 AND o_orderkey % 20 = 7 THEN 400 ELSE 200 END AS status,
       CASE WHEN {_div(20)} % 5 = 2 AND o_orderkey % 20 = 4 THEN '{{"other":1}}' ELSE
       '{{"esearchresult":{{"count":"' || CASE WHEN {_div(20)} % 11 = 5 THEN 'abc' ELSE '' END || cast(CASE {_div(20)} % 3 WHEN 0 THEN 60 WHEN 1 THEN 31 ELSE 12 END AS string) ||
       '","idlist":[' || CASE WHEN {_div(20)} % 5 = 3 AND o_orderkey % 20 >= 9 THEN ''
         ELSE '"' || {_K} || '","' || {_K} || '",' || cast(o_orderkey + 1 AS string) END || ']}}}}' END AS body
FROM orders
WHERE NOT ({_div(20)} % 7 = 3 AND o_orderkey % 20 = 3) AND NOT ({_div(20)} % 7 = 4 AND o_orderkey % 20 = 0)
  AND NOT ({_div(20)} % 7 = 5 AND o_orderkey % 20 >= 10)""",
    "corpus": """
SELECT o_orderkey AS doc_id, o_orderpriority AS text, cast(o_orderdate AS date) AS pub_date
FROM orders""",
    "dated_documents": """
SELECT doc_id, text, DATE '1990-01-01' + cast(doc_id % 4000 AS int) AS pub_date FROM documents
WHERE doc_id % 50 <> 7 UNION ALL
SELECT doc_id, text, cast(NULL AS date) AS pub_date FROM documents WHERE doc_id % 50 = 7""",
    # Inputs whose services contradict each other: the graph knows other ids than the summaries.
    "disputed_inputs": f"""
SELECT o_orderkey AS pos, CASE WHEN o_orderkey % 2 = 0 THEN {_K} ELSE '10.1000/' || {_K} END AS raw
FROM orders""",
    "disputed_summaries": f"""
SELECT {_K} AS pmid, 'PMC' || {_K} AS pmcid, '10.1000/' || {_K} AS doi FROM orders""",
    "disputed_graph": f"""
SELECT 'doi' AS kind, '10.1000/' || {_K} AS value,
       CASE WHEN o_orderkey % 3 = 0 THEN cast(10000000 + {_div(9)} AS string) ELSE {_K} END AS pmid,
       CASE WHEN o_orderkey % 5 = 0 THEN 'PMC9' || {_K} END AS pmcid,
       CASE WHEN o_orderkey % 7 = 0 THEN '10.2000/' || {_K} ELSE '10.1000/' || {_K} END AS doi
FROM orders WHERE o_orderkey % 11 <> 0""",
    "date_texts": f"""
SELECT o_orderkey AS k,
       CASE o_orderkey % 6
         WHEN 0 THEN substr(cast(cast(o_orderdate AS date) AS string), 1, 10)
         WHEN 1 THEN replace(substr(cast(cast(o_orderdate AS date) AS string), 1, 10), '-', '')
         WHEN 2 THEN '2024-1-5'
         WHEN 3 THEN '2023-02-30'
         WHEN 4 THEN substr(cast(cast(o_orderdate AS date) AS string), 1, 4) END AS raw
FROM orders""",
    "article_recs": """
SELECT doc_id,
       CASE WHEN doc_id % 3 <> 0 THEN cast(doc_id AS string) END AS pmid,
       CASE WHEN doc_id % 2 = 0 THEN 'PMC' || cast(doc_id AS string) END AS pmcid,
       '10.1000/' || cast(doc_id AS string) AS doi
FROM documents""",
    # Articles as lines of record files: values as they come, repeated and unusable records.
    "article_lines": """
SELECT cast(floor(doc_id / 500) AS bigint) AS file, 3 * (doc_id % 500) + place AS line_no,
       CASE WHEN place = 1 THEN CASE doc_id % 7
         WHEN 0 THEN '' WHEN 1 THEN '{"title":"none"}' WHEN 2 THEN '{bad' WHEN 3 THEN '[1]'
         WHEN 4 THEN '{"pmid":"","doi":false}' ELSE '   ' END
       ELSE '{"pmid":' || CASE WHEN doc_id % 3 = 0 THEN 'null' WHEN doc_id % 5 = 0 THEN cast(doc_id AS string)
           ELSE '"' || cast(doc_id AS string) || '"' END ||
         ',"pmcid":' || CASE WHEN doc_id % 2 = 0 THEN '"PMC' || cast(doc_id AS string) || '"' ELSE 'null' END ||
         ',"doi":"10.1000/' || CASE WHEN place = 3 AND doc_id % 4 = 0 THEN 'X' ELSE '' END || cast(doc_id AS string) || '"}'
       END AS value
FROM (SELECT doc_id, 1 AS place FROM documents UNION ALL SELECT doc_id, 2 FROM documents
      UNION ALL SELECT doc_id, 3 FROM documents) lines""",
    "text_a": "SELECT 'PMC' || cast(page_id AS string) AS key, html FROM pages",
    "text_b": "SELECT cast(doc_id AS string) AS key, text FROM documents WHERE lang <> 'fr'",
    # Metadata responses: graph by PMID for labelled documents and by DOI for Spanish ones,
    # summaries for all that are not German.
    "article_responses": """
SELECT 'semantic-scholar' AS source, cast(l.doc_id AS string) AS request_key, 200 AS status,
       '{"title":"P' || cast(l.doc_id AS string) || '","year":' || cast(2000 + l.quality AS string) ||
       ',"venue":"V","authors":[{"name":"N"}]}' AS body
FROM labels l
UNION ALL
SELECT 'semantic-scholar' AS source, '10.1000/' || cast(doc_id AS string) AS request_key, 200 AS status,
       '{"title":"D' || cast(doc_id AS string) || '","year":"in 1999","journal":{"name":"J"}}' AS body
FROM documents WHERE lang = 'es'
UNION ALL
SELECT 'entrez' AS source, cast(doc_id AS string) AS request_key, 200 AS status,
       '{"result":{"uids":[],"' || cast(doc_id AS string) || '":{"title":"E' || cast(doc_id AS string) ||
       '","pubdate":"2010 Jan","fulljournalname":"F ' || lang || '"}}}' AS body
FROM documents WHERE lang <> 'de'""",
}


# Scans with fewer splits than this are spread; the given files hold one row group each, so all
# that follows would run as one task. Larger inputs have more splits and are read as they are.
_MIN_SPLITS = 16


def _scan(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.parquet(path)
    wanted = min(_MIN_SPLITS, spark.sparkContext.defaultParallelism)
    if table.rdd.getNumPartitions() >= wanted:
        return table
    return table.repartition(wanted, table.columns[0])


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for table in TABLES:
        if table in VIEWS[name]:
            _scan(spark, f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(VIEWS[name])


def with_views(*names: str, recursive: bool = False) -> str:
    """``WITH`` clause naming the given views."""
    parts = ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
    return f"WITH {'RECURSIVE ' if recursive else ''}{parts}"
