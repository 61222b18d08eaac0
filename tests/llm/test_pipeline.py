from collections import defaultdict

import corpus_pipeline
from formtide.llm.common import read_table
from tests.llm.cases import awkward_docs
from tests.llm.test_jaccard import brute
from tests.llm.test_repeats import brute_bytes

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns, name
        if name != "repeated_strings":
            assert kept.exceptAll(docs).count() == 0, name
    groups = defaultdict(list)
    for doc_id, _, class_id, stays in brute(rows):
        groups[class_id].append((doc_id, stays))
    stays = {d for g in groups.values() for d, s in g if s}
    got = {r.doc_id for r in corpus_pipeline.one_of_near_copies(spark, docs, FOLDER).collect()}
    assert got == stays | {None}
    left = corpus_pipeline.without_repeated_strings(spark, docs, FOLDER).collect()
    nothing_left = sum(1 for r in brute_bytes(rows, 50) if r[1] and r[1] == r[2])
    assert len(left) == len(rows) - nothing_left


def test_run_gives_whole_sequences(spark):
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    ids = {r.doc_id for r in pieces}
    assert ids <= {r.doc_id for r in read_table(spark, FOLDER, "documents").select("doc_id").collect()}
    ends = defaultdict(int)
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start)):
        assert r.start == ends[r.doc_id]
        ends[r.doc_id] += r.length
    assert all(ends[r.doc_id] == r.doc_tokens for r in pieces) and len(ids) > 100


def test_stages_on_an_empty_table(spark):
    docs = read_table(spark, FOLDER, "documents").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
