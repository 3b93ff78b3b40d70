"""Each stage of the pipeline keeps what it must, on its own input."""

import corpus_pipeline
from cohortloom.llm import language
from cohortloom.llm.neardup import near_duplicates
from cohortloom.llm.queries import ORACLES, QUERIES
from cohortloom.llm.text import stored
from cases import FOLDER, no_docs, odd_docs


def test_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, before, FOLDER), "test-stage")
        sizes.append(docs.count())
        assert docs.columns == columns
        if name == "near_dedup":
            kept = {r["doc_id"] for r in near_duplicates(before.select("doc_id", "text")).where("kept").collect()}
            assert {r["doc_id"] for r in docs.select("doc_id").collect()} == kept
        if name in ("language", "personal_data"):
            assert docs.count() >= 0.9 * before.count()
    assert sizes[0] >= sizes[1] >= sizes[2] == sizes[3]
    assert docs.groupBy("doc_id").count().where("count > 2").isEmpty()


def test_run_is_the_registered_query(spark):
    assert QUERIES["pipeline"] is corpus_pipeline.run and "pipeline" not in ORACLES
    assert [n for n in QUERIES if n.startswith("op")] and {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in QUERIES if n.startswith("op")}


def test_odd_rows_go_through_all_stages(spark):
    docs = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), "odd-stage")
    assert docs.columns == odd_docs(spark).columns


def test_an_empty_table_goes_through_all_stages(spark):
    docs = no_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), "empty-stage")
        assert docs.count() == 0 and docs.columns == no_docs(spark).columns


FOREIGN = {
    "hu": "A kormány szerdai ülésén döntött arról hogy a következő évben emelik a nyugdíjakat és a családi pótlékot is növelik amit a gyermekes családok már régóta vártak",
    "ja": "東京都は水曜日に新しい政策を発表しました。来年から公共交通機関の料金が引き下げられる予定です。多くの市民が歓迎しています",
    "ru": "Правительство в среду приняло решение о повышении пенсий и детских пособий в следующем году чего семьи с детьми ждали уже давно",
    "junk": "xqvzk wjqhx pzzkr vxwqj kqzxv jwhqz zkxvr qwpzx hvkqj xzwrq kvjxz qphzw zxkvq wjrqx vzkhp qxjwz",
}


def test_what_no_label_teaches_is_rejected_and_clean_texts_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(-1 - i, text, None, "odd", len(text)) for i, text in enumerate(FOREIGN.values())], docs.schema)
    kept = corpus_pipeline.language(spark, docs.unionByName(odd), "").select("doc_id")
    assert kept.where("doc_id < 0").isEmpty()
    lettered = docs.where(docs["text"].rlike(r"\p{L}{2,}.*\p{L}{2,}") & docs["lang"].isNotNull())
    lost = lettered.join(kept, "doc_id", "left_anti").count()
    assert lost <= 0.005 * lettered.count()


def test_a_worker_of_the_language_stage_holds_few_texts_at_a_time(spark, monkeypatch):
    docs, size, seen = spark.createDataFrame([(i, "the quick brown fox", "en") for i in range(3000)], "doc_id long, Text string, lang string").coalesce(1), "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(size)
    keep = language.stored
    monkeypatch.setattr(language, "stored", lambda df, name: seen.append((spark.conf.get(size), df.count())) or keep(df, name))
    assert language.known_languages(docs, language.read_vocabulary(corpus_pipeline.VOCABULARY)).count() == 3000
    assert seen == [("1024", 3000)] and spark.conf.get(size) == before
    for rows, held in (("100", "100"), ("0", "1024")):
        spark.conf.set(size, rows)
        with language.batches_of(spark, 1024):
            assert spark.conf.get(size) == held
        assert spark.conf.get(size) == rows
        spark.conf.unset(size)
    model = language.LanguageModel(["en"], ["a"], language.np.ones((1, 2)))
    plan = language.predict_language(docs.limit(1), model)._jdf.queryExecution().analyzed().toString()
    assert plan.count("CASE WHEN") == 0  # each text goes to the worker once
