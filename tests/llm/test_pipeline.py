import corpus_pipeline
import public_tokenizers as vocabulary
import tiktoken

from fieldbook.llm import decontaminate, jaccard_join, language, secret_scan
from fieldbook.llm.common import rank_file
from tests.llm.conftest import ODD, SMALL
from tests.llm.test_jaccard_join import brute as groups_of


def test_stages_keep_what_they_should(spark, table):
    docs = table("documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, docs = docs, stage(spark, docs, SMALL).cache()
        assert docs.columns == columns
        kept[name] = (before, docs)
    ids = lambda frame: {r.doc_id for r in frame.select("doc_id").collect()}

    before, after = kept["language ID"]
    told = language.predict(before, language.fit(before))
    assert ids(after) == ids(told.where("not rejected"))

    before, after = kept["near duplicates"]
    assert ids(after) == {group for _, group, _, _ in groups_of([(r.doc_id, r.text) for r in before.collect()])}

    before, after = kept["decontamination"]
    assert ids(before) - ids(after) == ids(decontaminate.overlaps(before, table("benchmark")))

    before, after = kept["secrets"]
    assert ids(before) == ids(after)
    assert secret_scan.scan(after).where("is_secret").count() == 0

    oracle = tiktoken.Encoding("o", pat_str=vocabulary.PATTERN, mergeable_ranks=rank_file(vocabulary.path("byte_bpe_50k.tiktoken")), special_tokens={})
    coded = {r.doc_id: r for r in corpus_pipeline.STAGES[4][1](spark, after, SMALL).collect()}
    for row in after.collect():
        assert coded[row.doc_id].ids == oracle.encode_ordinary(row.text)
        assert coded[row.doc_id].n_bytes == len(row.text.encode())


def test_run_applies_all_stages(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.columns == ["doc_id", "n_tokens", "ids", "n_bytes"] and 0 < rows.count() <= 200


def test_odd_documents_pass_every_stage(spark, docs):
    frame = docs(ODD + [(30 + i, f"word{i} and a few others in a text") for i in range(20)])
    for _, stage in corpus_pipeline.STAGES:
        before = frame.count()
        frame = stage(spark, frame, SMALL)
        assert frame.count() <= before


def test_empty_documents(spark, docs):
    frame = docs(ODD).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SMALL)
    assert frame.count() == 0


def test_unlinked_documents_are_all_kept(docs):
    frame = docs([(i, f"entirely different words number {i} for row {i * 7} " * 3) for i in range(30)])
    assert jaccard_join.one_of_each(frame).count() == 30
