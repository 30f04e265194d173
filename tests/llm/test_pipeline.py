import corpus_pipeline as C
from eventloom.llm import decontaminate, jaccard_join, token_files, toxicity
from eventloom.llm.common import table, written
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    assert [name for name, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_ids"]
    docs = table(spark, SF, "documents").withColumn("score", F.lit(1)).withColumn("dup", F.lit("x"))
    columns, made = docs.columns, {}
    for name, stage in C.STAGES:
        before = docs
        docs = written(stage(spark, docs, SF), "test")
        made[name] = before, docs
        if name != "token_ids":
            assert docs.columns == columns, name
    before, after = made["toxicity"]
    scores = toxicity.scored(before.drop("score"), toxicity.learn(before, table(spark, SF, "labels")))
    assert sorted(r[0] for r in scores.where("score < 0.7").select("doc_id").collect()) == sorted(r[0] for r in after.select("doc_id").collect())
    before, after = made["near_duplicates"]
    classes = jaccard_join.joined(before)
    assert {r[0] for r in classes.where("doc_id = component_id").select("doc_id").collect()} == {r[0] for r in after.select("doc_id").collect()}
    assert after.count() == classes.select("component_id").distinct().count()
    before, after = made["decontamination"]
    assert before.count() == after.count()
    assert decontaminate.contamination(after, table(spark, SF, "benchmark")).where("n_hit > 0").count() == 0
    same = before.join(after, ["doc_id", "text"]).count()
    assert same == decontaminate.contamination(before, table(spark, SF, "benchmark")).where("n_hit = 0").count()
    before, after = made["mixing"]
    assert after.select("doc_id").distinct().join(before, "doc_id", "left_anti").count() == 0
    before, after = made["token_ids"]
    assert sorted(r[0] for r in before.select("doc_id").collect()) == sorted(r[0] for r in after.select("doc_id").collect())
    assert after.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert token_files.END_ID == 2


def test_run(spark):
    assert C.ORACLE_SQL is None
    assert C.run(spark, SF).count() > 100


def test_empty_and_null_rows(spark, odd_docs, no_docs):
    odd = odd_docs.withColumn("n_chars", F.length("text").cast("long"))
    for docs in (odd, odd.limit(0)):
        columns = docs.columns
        for name, stage in C.STAGES:
            docs = written(stage(spark, docs, SF), "test")
            assert name == "token_ids" or docs.columns == columns
