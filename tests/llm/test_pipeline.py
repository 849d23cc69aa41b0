import corpus_pipeline
from tests.llm.conftest import prose
from tests.llm.test_dedup import slow_components, words_covered
from tests.llm.test_layout_and_shards import check_packing
from tiermill.llm import decontamination


def test_stages_against_brute_force(spark, scratch):
    """A corpus with planted copies, passages and benchmark items, stage by stage."""
    passage, item = prose(800, 80), prose(801, 40)
    rows = [(i, prose(2000 + i, 60 + i), "en") for i in range(1, 41)]
    rows += [(50, rows[0][1], "en"), (51, rows[1][1] + " extra", "en"), (52, None, "en"), (53, "123 ... 456", "en")]
    rows += [(60 + i, prose(3000 + i, 30) + " " + passage + " " + prose(3100 + i, 30), "en") for i in range(4)]
    rows += [(70, prose(3200, 50) + " " + item + " " + prose(3201, 50), "en"), (71, item, "en")]
    docs = spark.createDataFrame([(i, t, g, "src", len(t) if t else None) for i, t, g in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    texts = {i: t for i, t, _ in rows}
    stages = dict(corpus_pipeline.STAGES)
    read = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}

    kept = stages["language_id"](spark, docs, scratch)
    assert kept.columns == docs.columns
    assert read(kept) == {i: t for i, t in texts.items() if i not in (52, 53)}

    kept = stages["ngram_jaccard"](spark, kept, scratch)
    component = slow_components({i: t for i, t in texts.items() if i not in (52, 53)}, 5, 80)
    want = {i: texts[i] for i, (_, c) in component.items() if c == i}
    assert read(kept) == want and 50 not in want and 51 not in want

    kept = stages["suffix_array"](spark, kept, scratch)
    order = sorted(want)
    gone = words_covered([want[i] for i in order], 51, "first")
    left = {i: [w for k, w in enumerate(want[i].split()) if k not in flags] for i, flags in zip(order, gone, strict=True)}
    want = read(kept)
    assert {i: t.split() for i, t in want.items()} == left and passage in want[60] and passage not in want[61]
    assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())

    bench = spark.read.parquet(f"{scratch}/benchmark.parquet")
    bad = {r["doc_id"] for r in decontamination.leaks(kept, bench).collect()}
    kept = stages["decontamination"](spark, kept, scratch)
    want = {i: t for i, t in want.items() if i not in bad}
    assert bad and read(kept) == want and kept.columns == docs.columns

    check_packing(corpus_pipeline.run(spark, scratch).collect(), list(want.items()), 4096)


def test_empty_documents(spark, scratch, empty):
    empty.write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    assert corpus_pipeline.run(spark, scratch).collect() == []


def test_text_goes_to_python_in_batches_of_bounded_bytes(spark):
    from tiermill.llm import langid

    corpus_pipeline._small_batches(spark)
    try:
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "4m"
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert langid.SCORED_BYTES <= 1 << 18
