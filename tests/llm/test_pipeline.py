import corpus_pipeline
from rollweave.llm import decontaminate as dc, line_dedup, near_dedup, toxicity
from rollweave.llm.queries import CATEGORIES

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    docs = read("documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "near dedup", "decontamination", "mixing"]
    now, outs = docs, []
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF).cache()
        outs.append(now)
    assert all(o.columns == docs.columns for o in outs[:-1])
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    chain = toxicity.train(docs, read("labels"), CATEGORIES)
    assert ids(outs[0]) == ids(toxicity.score(docs, chain).where(f"p_toxic < {toxicity.THRESHOLD}"))
    lines = line_dedup.line_dedup(outs[0]).collect()
    assert ids(outs[1]) == sorted(r["doc_id"] for r in lines if not r["n_removed"] or r["kept"].strip())
    assert ids(outs[2]) == ids(near_dedup.near_duplicates(outs[1]).where("kept"))
    assert ids(outs[3]) == ids(dc.contamination(outs[2], read("benchmark")).where("not contaminated"))
    assert set(ids(outs[4])) <= set(ids(outs[3]))
    assert ids(corpus_pipeline.run(spark, SF)) == ids(outs[4])


def test_later_copies_leave_no_fragments(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first, copies = {}, set()
    for r in docs.orderBy("doc_id").collect():
        if "\n" in (r["text"] or "") and first.setdefault(r["text"], r["doc_id"]) != r["doc_id"]:
            copies.add(r["doc_id"])
    assert len(copies) >= 10
    out = dict(corpus_pipeline.STAGES)["line dedup"](spark, docs, SF)
    assert not [r["doc_id"] for r in out.collect() if r["doc_id"] in copies and r["text"].strip()]
    mixed = dict(corpus_pipeline.STAGES)["mixing"](spark, out, SF)
    assert not copies & {r["doc_id"] for r in mixed.collect()}


def test_stages_on_odd_tables(spark, edge_docs, edge_rows, no_docs):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns; then no rows at all. Stages but the last return the columns of their input."""
    for docs in (edge_docs, no_docs):
        now = docs
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF)
            assert now.columns == [*docs.columns, *(["copies", "expected"] if name == "mixing" else [])]
            now = now.cache()
            assert now.count() <= docs.count()
            left = {r["doc_id"] for r in now.collect()}
            # The long text is clean, so it stays until mixing, which draws; texts without tokens go there.
            assert name == "mixing" or (22 in left) == (docs is edge_docs)
        assert not {2, 3, 4} & left


def test_scratch_tables_go(spark):
    from pathlib import Path

    from rollweave.llm.common import shared_dir

    before = set(Path(f"{shared_dir(spark)}/rollweave").glob("*"))
    assert corpus_pipeline.run(spark, SF).count()
    left = [p.name for p in set(Path(f"{shared_dir(spark)}/rollweave").glob("*")) - before]
    assert len(left) == 1 and left[0].startswith("pipeline-")
