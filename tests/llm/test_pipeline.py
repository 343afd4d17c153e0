import corpus_pipeline
from citeloom.llm import minhash, pii, quality, templates
from citeloom.llm.queries import ORACLES, QUERIES
from citeloom.scratch import Scratch
from tests.llm.conftest import CLASHES

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "minhash near-dedup", "benchmark decontamination", "pii", "byte-level bpe"
    ]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_every_stage_decides_on_what_was_kept(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = lambda d: sorted(r["doc_id"] for r in d.select("doc_id").collect())
    stages = [f for _, f in corpus_pipeline.STAGES]

    passed = scratch.keep(stages[0](spark, docs, SF), "s0")
    judged = quality.judge(docs, ["doc_id"], Scratch(spark, "q"))
    assert ids(passed) == ids(judged.where("kept")) and passed.columns == docs.columns

    single = scratch.keep(stages[1](spark, passed, SF), "s1")
    classes = minhash.classes(passed, Scratch(spark, "m")).collect()
    assert ids(single) == sorted({r["class_id"] for r in classes}) and single.columns == docs.columns

    clean = scratch.keep(stages[2](spark, single, SF), "s2")
    hit = {r["doc_id"] for r in templates.contaminated(single, benchmark).collect()}
    assert ids(clean) == [i for i in ids(single) if i not in hit] and clean.columns == docs.columns

    masked = scratch.keep(stages[3](spark, clean, SF), "s3")
    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert {r["doc_id"]: r["text"] for r in masked.collect()} == {i: pii.masked(t) for i, t in before.items()}

    encoded = stages[4](spark, masked, SF).collect()
    assert sorted(r["doc_id"] for r in encoded) == ids(masked) and all(r["same_text"] for r in encoded)
    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert all(r["text"] == texts[r["doc_id"]] and len(r["ids"]) == 4 * r["n_tokens"] for r in encoded)
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, encoded))


def test_odd_documents_pass_all_stages(odd, none, spark, scratch):
    for docs in (odd, none):
        given = docs
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            got = stage(spark, docs, SF)
            assert got.columns == given.columns and CLASHES[0] in got.columns
            docs = scratch.keep(got, f"{number}-{given is odd}")
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
