"""The pipeline's stages on planted documents, and its registration."""

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__
from bundleflow.llm import langid, queries


def test_stages_take_effect(llm, tmp):
    src = "/root/testdata/sf0.001"
    docs = llm.read.parquet(f"{src}/documents.parquet")
    item = llm.read.parquet(f"{src}/benchmark.parquet").filter("text IS NOT NULL").orderBy("item_id").first()
    base = docs.filter("lang = 'en' AND length(text) BETWEEN 1500 AND 4000").orderBy("doc_id").first()
    words = base.text.split(" ")
    planted = [
        (900001, base.text, "en", "p", len(base.text)),
        (900002, " ".join(words[:40] + ["changed"] + words[41:]), "en", "p", len(base.text)),
        (900003, "Before it " + item.text + " and after it", "en", "p", 0),
        (900004, " ".join(reversed(words)) + " mail some.one@mail.example.com", "en", "p", 0),
        (900005, None, "en", "p", None), (900006, "12 34 !!", "en", "p", 8), (900007, "", "en", "p", 0)]
    extra = llm.createDataFrame(planted, docs.schema)
    docs.unionByName(extra).write.parquet(f"{tmp}/documents.parquet")
    llm.read.parquet(f"{src}/benchmark.parquet").write.parquet(f"{tmp}/benchmark.parquet")
    out = corpus_pipeline.run(llm, tmp)
    kept = {r.doc_id: r for r in out.collect()}
    assert not {900001, 900002, 900003, 900005, 900006, 900007} & set(kept)
    assert all(r.exact and r.n_tokens == len(r.token_ids) // 4 for r in kept.values())
    from bundleflow.llm import bpe
    ids = kept[900004].token_ids
    assert "[EMAIL]" in bpe.tokenizer(bpe.RANKS, None).decode(bytes(ids)).decode()


def test_stages_keep_columns(llm, odd_docs, no_docs, tmp):
    llm.createDataFrame([(1, "some item of the benchmark that nobody holds at all")], "item_id long, text string") \
        .write.parquet(f"{tmp}/benchmark.parquet")
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(llm, docs, tmp).columns == docs.columns, name
        last = corpus_pipeline.STAGES[-1][1](llm, docs, tmp)
        assert last.count() == docs.count() and last.filter(~F.col("exact")).count() == 0


def test_language_stage_keeps_clean_documents(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = corpus_pipeline.language_id(llm, docs, "").count()
    assert kept == docs.filter(F.col("text").rlike(r"\p{L}")).count()
    assert langid.UNKNOWN == "und"


def test_language_stage_rejects_a_foreign_language(llm):
    """Two learned languages: texts of a third script or spelling go, mixtures stay."""
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("lang IN ('en', 'es')")
    foreign = ["Съешь же ещё этих мягких французских булок да выпей чаю " * 3, "这是一种没有人学过的语言所以应该被拒绝" * 4,
               "zażółć gęślą jaźń źdźbło chrząszcz brzmi w trzcinie wszczebrzeszynie " * 3]
    mixed = [" ".join(r.text.split(" ")[:30]) for r in docs.filter("length(text) > 900").orderBy("lang", "doc_id").collect()]
    mixed = [mixed[0] + " " + mixed[-1]]
    planted = llm.createDataFrame([(-1 - i, t, None, "p", len(t)) for i, t in enumerate(foreign + mixed)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language_id(llm, docs.unionByName(planted), "").collect()}
    assert {i for i in kept if i < 0} == {-4}
    assert len(kept) == docs.filter(F.col("text").rlike(r"\p{L}")).count() + 1


def test_language_stage_labels_what_follows(llm):
    """A text without a label gets the found language, a wrong label is put right, a right one stays."""
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) > 900")
    en = docs.filter("lang = 'en'").orderBy("doc_id").first().text
    planted = [(-1, en, None, "p", len(en)), (-2, en, "de", "p", len(en)), (-3, en, "en", "p", len(en))]
    rows = docs.unionByName(llm.createDataFrame(planted, docs.schema))
    labelled = corpus_pipeline.language_id(llm, rows, "").filter("doc_id < 0")
    assert {r.doc_id: r.lang for r in labelled.collect()} == {-1: "en", -2: "en", -3: "en"}


def test_dedup_stage_keeps_one_of_a_group_without_ids(llm):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(None, text), (None, text + " end"), (None, text), (7, text.replace("60", "61") + " x"), (7, text + " y"),
            (None, "another text of its own that nobody else has")]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    for some, want in ((docs, 2), (docs.filter("doc_id IS NULL"), 2), (docs.filter("doc_id = 7"), 1)):
        assert corpus_pipeline.near_dedup(llm, some, "").count() == want


def test_registration():
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op")}
    assert "pipeline" in names and set(queries.ORACLES) <= set(names)
