import corpus_pipeline
from tickwise.llm import decontamination, simhash_dedup
from tickwise.llm.common import cut

from .test_quality_rules import measure
from .test_secret_scan import base
from .test_simhash_dedup import grouped

SF = "/root/testdata/sf0.001"


def test_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "simhash_dedup", "decontamination", "secret_scan", "bpe_codec"]
    rows = {r.doc_id: r.text for r in docs.collect()}

    docs1 = cut(stages["quality_rules"](spark, docs, SF), "t")
    kept = {d: t for d, t in rows.items() if measure(t)[-1]}
    assert {r.doc_id: r.text for r in docs1.collect()} == kept and docs1.columns == docs.columns

    docs2 = cut(stages["simhash_dedup"](spark, docs1, SF), "t")
    kept = {d: kept[d] for d, _, c in grouped(sorted(kept.items())) if d == c}
    assert {r.doc_id: r.text for r in docs2.collect()} == kept and docs2.columns == docs.columns

    docs3 = cut(stages["decontamination"](spark, docs2, SF), "t")
    index = decontamination.Index.build([tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    kept = {d: t for d, t in kept.items() if not index.search(t)}
    assert {r.doc_id: r.text for r in docs3.collect()} == kept and docs3.columns == docs.columns

    docs4 = cut(stages["secret_scan"](spark, docs3, SF), "t")
    after = {r.doc_id: r for r in docs4.collect()}
    assert after.keys() == kept.keys() and docs4.columns == docs.columns
    for d, t in kept.items():
        assert base(after[d].text)[0][:3] == (0, 0, 0) and after[d].n_chars == len(after[d].text)
        if not base(t)[1]:
            assert after[d].text == t

    assert {r.doc_id for r in stages["bpe_codec"](spark, docs4, SF).collect()} == after.keys()
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == after.keys()


def test_stages_take_empty_and_odd_documents(spark):
    rows = [(1, None, None, None, None), (None, "x", "en", "s", 1), (None, None, None, None, None), (2, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0), docs.unionByName(docs)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, SF).count() <= frame.count()
    assert simhash_dedup.keep_one(docs.unionByName(docs)).where("doc_id = 1").count() == 1
