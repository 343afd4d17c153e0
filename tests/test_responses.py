import json

from citeloom.sources import responses as resp

# Payload shapes as the services send them.
SUMMARY = {
    "result": {
        "uids": ["70010020"],
        "70010020": {
            "uid": "70010020",
            "pubdate": "2021",
            "sortpubdate": "2021/06/05 00:00",
            "title": "A title",
            "authors": [{"name": "Okafor TN", "authtype": "Author"}, {"name": ""}],
            "fulljournalname": "A journal",
            "elocationid": "doi: 10.5555/lit.2021.77",
            "articleids": [
                {"idtype": "pubmed", "value": "70010020"},
                {"idtype": "pmc", "value": "PMC8800113"},
                {"idtype": "pmcid", "value": "pmc-id: PMC8800113;"},
                {"idtype": "doi", "value": "10.5555/lit.2021.77"},
            ],
        },
    }
}
IDCONV = {
    "status": "ok",
    "records": [{"doi": "10.5555/lit.2021.77", "pmcid": "PMC8800113", "pmid": 70010020}],
}
GRAPH_IDS = {
    "paperId": "p",
    "externalIds": {"PubMedCentral": "8800113", "DOI": "10.5555/lit.2021.77", "CorpusId": 99120034, "PubMed": "70010020"},
}


def landed(spark, *rows):
    data = [(s, k, st, b if isinstance(b, str) else json.dumps(b)) for s, k, st, b in rows]
    return spark.createDataFrame(data, resp.RESPONSE_SCHEMA)


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_summaries(spark):
    df = landed(spark, ("entrez", "70010020", 200, SUMMARY))
    assert _rows(resp.esummary_crosswalk(df)) == [("70010020", "PMC8800113", "10.5555/lit.2021.77")]
    wanted = spark.createDataFrame([("1",)], "pmid string")
    assert _rows(resp.esummary_crosswalk(df, wanted)) == []
    key, meta = resp.summary_metadata(df).first()
    assert key == "70010020"
    assert meta.asDict() == {
        "title": "A title", "abstract": "doi: 10.5555/lit.2021.77", "authors": ["Okafor TN"],
        "journal": "A journal", "year": 2021, "source": "entrez",
    }
    assert resp.summary_metadata(df, strict_abstract=True).first()["metadata"]["abstract"] is None


def test_id_conversion_takes_numbers_and_the_last_row(spark):
    later = {"records": [{"pmcid": "PMC8800113", "pmid": "9"}, {"pmid": "5"}, {"pmcid": "PMC1"}]}
    df = landed(spark, ("pmc", "a", 200, IDCONV), ("pmc", "b", 200, later))
    assert sorted(_rows(resp.idconv_crosswalk(df))) == [("PMC1", None, None), ("PMC8800113", "9", None)]


def test_external_ids_and_the_extra_keys(spark):
    df = landed(
        spark,
        ("semantic-scholar", "10.5555/lit.2021.77", 200, GRAPH_IDS),
        ("semantic-scholar", "5", 200, {"externalIds": {"PMID": "", "pmid": 5, "pmcid": "PMC5"}}),
        ("semantic-scholar", "6", 200, {"externalIds": {"MAG": "1"}}),
    )
    assert sorted(_rows(resp.external_ids(df))) == [
        ("doi", "10.5555/lit.2021.77", None, None, "10.5555/lit.2021.77"),
        ("pmid", "5", "5", "PMC5", None),
    ]
    assert ("doi", "10.5555/lit.2021.77", "70010020", "8800113", "10.5555/lit.2021.77") in _rows(
        resp.external_ids(df, extra_keys=True)
    )


def test_graph_metadata(spark):
    full = {
        "title": "T", "venue": "V", "year": 2019, "journal": {"name": "J", "volume": "1"},
        "authors": [{"authorId": "1", "name": "Ann"}, {"name": None}], "abstract": None,
    }
    df = landed(
        spark,
        ("semantic-scholar", "1", 200, full),
        ("semantic-scholar", "2", 200, {"paperId": "p"}),
        ("semantic-scholar", "3", 200, {"venue": "V", "journal": None, "year": 1850}),
        ("semantic-scholar", "4", 200, {"year": "1850", "journal": ""}),
        ("semantic-scholar", "5", 404, {"error": "not found"}),
    )
    got = {k: m.asDict() for k, m in _rows(resp.graph_metadata(df))}
    assert set(got) == {"1", "3", "4"}
    assert got["1"] == {"title": "T", "abstract": None, "authors": ["Ann"], "journal": "J", "year": 2019, "source": "semantic-scholar"}
    assert (got["3"]["journal"], got["3"]["year"], got["3"]["authors"]) == ("V", 1850, [])
    assert (got["4"]["journal"], got["4"]["year"]) == (None, None)


def test_status_routing(spark):
    df = landed(
        spark,
        ("entrez", "1", 500, "x"),
        ("pmc", "2", 200, "<html>"),
        ("semantic-scholar", "3", 404, "{}"),
        ("semantic-scholar", "4", 429, {"code": "429"}),
        ("entrez", "5", 200, "{}"),
        ("pmc", "6", 404, "{}"),
    )
    assert sorted(r["message"] for r in resp.response_errors(df).collect()) == [
        "entrez: error 500",
        "pmc: error 404",
        "pmc: invalid JSON response",
        "semantic-scholar: error 429 for 4",
    ]
    assert [r["request_key"] for r in resp.usable(df).collect()] == ["5"]


def _page(count, ids):
    return json.dumps({"esearchresult": {"count": count, "idlist": ids}})


def test_search_pages(spark):
    pages = spark.createDataFrame(
        [
            ("two", 0, 200, _page("3", ["9", "9"])),
            ("two", 2, 200, _page("3", ["4"])),
            ("two", 3, 200, _page("3", ["8"])),
            ("stops", 0, 200, _page("9", ["1"])),
            ("stops", 1, 200, _page("9", [])),
            ("stops", 2, 200, _page("9", ["2"])),
            ("fails", 0, 200, _page("9", ["1"])),
            ("fails", 1, 400, '{"error":"Invalid eutil name"}'),
            ("late", 0, 200, _page("1", ["7"])),
            ("late", 1, 500, "x"),
            ("odd", 0, 200, '{"other":1}'),
        ],
        "search_hash string, retstart bigint, status int, body string",
    )
    assert sorted(_rows(resp.esearch_ids(pages))) == [
        ("late", 0, "7"), ("stops", 0, "1"), ("two", 0, "9"), ("two", 1, "9"), ("two", 2, "4"),
    ]
    assert sorted(_rows(resp.esearch_ids(pages, hot=[("two", 3)]))) == sorted(_rows(resp.esearch_ids(pages)))
    assert sorted(_rows(resp.esearch_errors(pages))) == [
        ("pubmed", "fails", "Failed to query PubMed"),
        ("pubmed", "odd", "Unexpected PubMed response structure"),
    ]


def _searched(spark, searches):
    """``{name: [(retstart, ids), ...]}`` with a total each, as ids by search and messages."""
    rows = [
        (name, start, 200, body if isinstance(body, str) else _page(str(total), [str(start + i) for i in range(body)]))
        for name, (total, pages) in searches.items()
        for start, body in pages
    ]
    pages = spark.createDataFrame(rows, "search_hash string, retstart bigint, status int, body string")
    ids = {}
    for name, position, pmid in _rows(resp.esearch_ids(pages)):
        ids.setdefault(name, []).append((position, pmid))
    assert all(sorted(v) == [(i, str(i)) for i in range(len(v))] for v in ids.values())
    messages = {r["request_key"]: r["message"] for r in resp.esearch_errors(pages).collect()}
    assert not set(ids) & set(messages)
    return {k: len(v) for k, v in ids.items()}, messages


def test_incomplete_searches(spark):
    counts, messages = _searched(
        spark,
        {
            "late": (9, [(3, 3), (6, 3)]),
            "gap": (12, [(0, 3), (3, 3), (9, 3)]),
            "short": (12, [(0, 3), (3, 3)]),
            "short, empty page beyond": (12, [(0, 3), (3, 3), (6, 3), (27, 0)]),
            "bad count": ("abc", [(0, 3), (3, 0)]),
            "twice": (6, [(0, 3), (3, 3), (3, 3)]),
            "three times": (6, [(0, 3), (3, 3), (3, 3), (3, 3)]),
            "nested": (9, [(0, 9), (3, 3), (3, 3)]),
            "overlap": (9, [(0, 4), (3, 3), (6, 3)]),
            "empty beside full": (9, [(0, 3), (3, 0), (3, 3), (6, 3)]),
            "whole": (9, [(0, 3), (3, 3), (6, 3)]),
            "torn beyond the end": (6, [(0, 3), (3, 0), (5, 1), (9, 3), (9, 3)]),
            "torn beyond the total": (6, [(0, 3), (3, 3), (7, 1), (9, 3)]),
            "long last page": (4, [(0, 3), (3, 3)]),
            "nothing found": (0, [(0, 0)]),
            "failed beyond the total": (3, [(0, 3), (3, "x")]),
            "failed within": (6, [(0, 3), (3, "x")]),
        },
    )
    assert counts == {"whole": 9, "torn beyond the end": 3, "torn beyond the total": 6, "long last page": 6, "failed beyond the total": 3}
    assert messages == {
        "late": resp.SEARCH_LATE,
        "gap": resp.SEARCH_GAP,
        "short": resp.SEARCH_SHORT,
        "short, empty page beyond": resp.SEARCH_SHORT,
        "bad count": resp.SEARCH_COUNT,
        "twice": resp.SEARCH_GAP,
        "three times": resp.SEARCH_GAP,
        "nested": resp.SEARCH_GAP,
        "overlap": resp.SEARCH_GAP,
        "empty beside full": resp.SEARCH_GAP,
        "failed within": resp.SEARCH_FAILED,
    }


def test_landed_tables_are_read_with_a_fixed_schema(spark, tmp_path):
    landed(spark, ("pmc", "a", 200, IDCONV)).write.parquet(str(tmp_path / "p"))
    assert resp.read_responses(spark, str(tmp_path / "p")).count() == 1
