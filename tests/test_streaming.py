"""Streams of files against the same work on tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.streaming.corpus import prepare_available, scan_stream, score_available, stream_features

COLUMNS = "doc_id bigint, text string"


def words(i, n):
    return " ".join(f"w{i}x{j}" for j in range(n))


def documents(spark):
    rows = [(i, words(i % 30, 100 + 37 * (i % 30))) for i in range(80)]  # copies in many files
    rows += [(200, None), (201, ""), (202, "   "), (203, words(1, 99)), (204, words(2, 1001)), (None, words(99, 150))]
    return spark.createDataFrame(rows, COLUMNS)


def measured(rows):
    return Counter(tuple(r) for r in rows.select("chunk_idx", "text", *schema.NUMERIC_COLS).collect())


def test_streamed_rows_equal_the_table_and_restarts_repeat_nothing(spark, tmp_path):
    df = documents(spark)
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "state"))
    for part in range(3):
        df.where(F.coalesce("doc_id", F.lit(0)) % 3 == part).repartition(4).write.mode("append").parquet(source)
        rows = scan_stream(spark, source, df.schema, files_per_batch=3)
        found = prepare_available(stream_features(rows), out, checkpoint)
    expected = measured(stream_features(df))
    assert measured(found) == expected and max(expected.values()) == 1
    again = prepare_available(stream_features(scan_stream(spark, source, df.schema)), out, checkpoint)
    assert measured(again) == expected  # nothing new, nothing twice


def test_a_batch_that_fails_is_scored_again_once(spark, tmp_path):
    df = spark.range(40).select("id", (F.col("id") * 2).alias("x"))
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "state"))
    df.repartition(6).write.parquet(source)
    labels = spark.createDataFrame([(i, i % 3) for i in range(40)], "id bigint, cls int")
    calls = []

    def score(batch):
        calls.append(1)
        scored = batch.join(labels, "id")
        if len(calls) == 2:  # leaves half of its rows behind, then stops
            scored.where("id % 2 = 0").write.mode("overwrite").parquet(f"{out}/batch=1")
            raise RuntimeError("stopped")
        return scored

    rows = scan_stream(spark, source, df.schema, files_per_batch=2)
    with pytest.raises(Exception, match="stopped"):
        score_available(rows, score, out, checkpoint)
    found = score_available(scan_stream(spark, source, df.schema, files_per_batch=2), score, out, checkpoint)
    assert sorted(map(tuple, found.select("id", "x", "cls").collect())) == [(i, 2 * i, i % 3) for i in range(40)]
