"""Every stage of the pipeline against brute force on what its predecessor kept."""

import corpus_pipeline
from freightlens.llm.common import components, stage
from freightlens.llm.queries import table
from freightlens.llm.toxicity import toxicity_scores
from tests.llm.test_dedup import brute_classes
from tests.llm.test_text import brute_contamination, check_packing
from tests.llm.test_text import table as rows_of

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark):
    docs = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]

    clean = stage(stages["toxicity"](spark, docs, SF), "test")
    scores = toxicity_scores(docs.select("doc_id", "text"), table(spark, SF, "labels"))
    assert ids(clean) == ids(scores.where("score < 0.3")) and clean.columns == docs.columns

    unique = stage(stages["exact_dedup"](spark, clean, SF), "test")
    last = {t or "": max(i for i, x in texts(clean) if (x or "") == (t or "")) for _, t in texts(clean)}
    assert ids(unique) == sorted(last.values()) and unique.columns == docs.columns

    apart = stage(stages["near_dedup"](spark, unique, SF), "test")
    assert ids(apart) == sorted({c for c, _ in brute_classes(texts(unique)).values()}) and apart.columns == docs.columns

    held = stage(stages["decontamination"](spark, apart, SF), "test")
    bad = {i for i, n, hit, _ in brute_contamination(texts(apart), rows_of("benchmark", "item_id, text")) if hit and 20 * hit >= n}
    assert ids(held) == sorted(set(ids(apart)) - bad) and held.columns == docs.columns

    packed = stages["packing"](spark, held, SF).collect()
    used, bound = check_packing(packed, texts(held), 2048)
    assert used <= bound * 1.01 + 1


def test_run_of_nothing(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_texts_come_to_workers_two_megabytes_at_a_time(spark):
    """The batches that an executor's JVM and both its workers hold are small in the stages that gain nothing from larger ones."""
    docs, stages = table(spark, SF, "documents"), dict(corpus_pipeline.STAGES)
    for name in ("toxicity", "exact_dedup", "near_dedup"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
        stages[name](spark, docs.limit(20), SF)
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "2m", name


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 120)] + [(7, 7)]
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 120), 100)}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0
    apart = {r.v: r.root for r in components(spark.createDataFrame(edges, "a int, b int"), share=10).collect()}
    assert apart == got  # forests of several tasks
