import pytest
from pyspark.sql import functions as F

from inkgauge import schema, session
from inkgauge.plans.corpus import clean_corpus, corpus_subset, prepare_corpus
from inkgauge.plans.models import lsh_run, mlp_run, model_rows
from inkgauge.plans.statistics import corpus_statistics
from inkgauge.sources import corpus as S

ODD = ['say "hi", ok', "line one\nline two", "  outer spaces  ", "back\\slash", "comma, and\ttab", "é😀", "'q'"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(t, 1, i) for i, t in enumerate(ODD)], schema.CLEANED_SCHEMA)
    S.write_cleaned(df, str(tmp_path / "c"))
    back = S.scan_csv(spark, str(tmp_path / "c"), schema.CLEANED_SCHEMA)
    assert back.orderBy("id").collect() == df.orderBy("id").collect()


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('other,label,text_content\n1,1.0,"a\nb"\n2,0,""\n')
    df = S.scan_csv(spark, str(tmp_path / "odd.csv"), "text_content string, label string")
    merged = S.merge_corpora([S.Corpus("c", df, text="text_content", label="label")])
    assert {(r.text, r.generated) for r in merged.collect()} == {("a\nb", 1), ("", 0)}


def test_merge(spark):
    a = spark.createDataFrame([("x", "1.0"), ("y", "0")], "text string, generated string")
    b = spark.createDataFrame([("z", 1, 9, 5)], "text_content string, label int, other int, k long")
    merged = S.merge_corpora(
        [S.Corpus("a", a), S.Corpus("b", b, text="text_content", label="label", key="k")]
    )
    rows = {(r.text, r.generated, r.source, r.source_pos) for r in merged.collect()}
    assert rows == {("x", 1, "a", 0), ("y", 0, "a", 0), ("z", 1, "b", 1)}
    assert dict(merged.dtypes)["generated"] == "tinyint"
    assert merged.select("source_pos", "row_key").distinct().count() == 3


def make_corpora(spark):
    vocabulary = [f"word{i} " for i in range(50)]
    texts = ["".join(vocabulary[(i * j) % 50] for j in range(60 + 13 * i)) + "end." for i in range(60)]
    a = spark.createDataFrame(
        [(i, t, i % 2) for i, t in enumerate(texts)], "k long, text string, generated int"
    )
    b = spark.createDataFrame(
        [(i, t, 1) for i, t in enumerate(texts[:20])], "k long, text string, generated int"
    )
    return [S.Corpus("a", a, key="k"), S.Corpus("b", b, key="k")]


def test_prepare_and_models(spark, tmp_path):
    corpora = make_corpora(spark)
    cleaned = clean_corpus(corpora)
    ids = sorted(r.id for r in cleaned.select("id").collect())
    assert ids == list(range(len(ids)))
    # copies in b lose against a
    assert [r.source for r in cleaned.select("source").distinct().collect()] == ["a"]
    done = prepare_corpus(corpora, str(tmp_path / "p"), str(tmp_path / "c"))
    assert done.columns[:3] == ["generated", "id", "chunk_idx"] and "text" not in done.columns
    assert dict(done.dtypes)["embedding"] == "array<float>"
    before, after = S.load_before_after(spark, str(tmp_path / "c"), str(tmp_path / "p"))
    counts = {r.stage: r.n for r in S.stage_counts(before, after).collect()}
    assert counts["before"] == len(ids) and counts["after"] == done.count() > len(ids)
    assert S.scan_processed(spark, str(tmp_path / "p")).columns == [
        "id", *schema.NUMERIC_COLS, "embedding", "generated"
    ]
    tables = corpus_statistics(before, after)
    assert sum(r.n for r in tables["length_histogram"].collect()) == len(ids)
    assert tables["pca_variance"].count() == 5
    assert tables["describe_after"].count() == 16
    rows = model_rows(done)
    assert rows.select("id").distinct().count() == done.count()
    assert len(rows.first()["features"]) == 392
    _, best, results, predictions = lsh_run(rows, str(tmp_path / "lsh"), [2, 3], [4, 6], [3])
    assert results.count() == 4 and set(best) >= {"num_hash_tables", "num_hash_bits", "top_k"}
    assert predictions.where(F.col("predicted").isin(0, 1)).count() == predictions.count() > 0
    model, scored, matrix = mlp_run(rows, epochs=2, standardize=True)
    assert model.history.count() == 2
    assert sum(r.n for r in matrix.collect()) == scored.count()


def test_sampled_mode_samples_before_filtering(spark):
    corpora = make_corpora(spark)
    assert clean_corpus(corpora, sample=30).count() < 30
    with pytest.raises(Exception, match="cannot sample 81"):
        clean_corpus(corpora, sample=81).collect()


def test_corpus_subset(spark, tmp_path):
    df = spark.range(150).selectExpr("'t' AS text", "cast(1 AS tinyint) AS generated", "id")
    S.write_cleaned(df, str(tmp_path / "all.csv"))
    path = corpus_subset(spark, str(tmp_path / "all.csv"))
    assert path == str(tmp_path / "all_subset.csv")
    assert S.scan_csv(spark, path, schema.CLEANED_SCHEMA).count() == 100
    few = corpus_subset(spark, str(tmp_path / "all.csv"), n=1000)
    assert S.scan_csv(spark, few, schema.CLEANED_SCHEMA).count() == 150


def test_written_uses_the_shared_folder(spark):
    df = session.written(spark.range(5), "t")
    assert df.count() == 5
    assert session.shared_dir(spark) in df.inputFiles()[0]


def test_spread_leaves_wide_inputs_alone(spark, tmp_path):
    spark.range(100).repartition(16).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    assert session.spread(many) is many
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    assert session.spread(spark.read.parquet(str(tmp_path / "one"))).rdd.getNumPartitions() == 4


def test_words_are_counted_once(spark, capsys):
    df = spark.range(40).select("id", F.expr("repeat(concat('w', id % 30, ' '), 100 + int(id % 3))").alias("text"), F.lit(1).alias("generated"))
    cleaned = clean_corpus([S.Corpus("c", df, key="id")])
    capsys.readouterr()
    cleaned.explain()
    assert "regexp_extract_all" not in capsys.readouterr().out  # was in it twice
    assert sorted(r.id for r in cleaned.collect()) == list(range(30))
