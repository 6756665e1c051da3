import hashlib

import pytest
from pyspark.sql import functions as F

from inkgauge.operators import cleaning as C
from inkgauge.operators.chunking import chunk_by_tokens


def words(n):
    return " ".join(f"w{i}" for i in range(n))


def test_filter_word_count_bounds(spark):
    rows = [(n, words(n)) for n in (0, 99, 100, 1000, 1001)] + [(-1, None)]
    df = spark.createDataFrame(rows, "n int, text string")
    kept = C.filter_word_count(df)
    assert sorted(r.n for r in kept.collect()) == [100, 1000]
    none = C.filter_word_count(df, 5000, 6000)
    assert none.count() == 0 and none.schema == df.schema
    short = C.filter_word_count(df, 0, 0)
    assert [r.n for r in short.collect()] == [0]


def test_filter_blank(spark):
    df = spark.createDataFrame([(None,), ("",), (" \t ",), (" x ",)], "text string")
    assert [r.text for r in C.filter_blank(df).collect()] == [" x "]


def test_length_outliers(spark):
    df = spark.createDataFrame([("é" * 50,), ("é" * 49,), ("x" * 5001,), ("x" * 5000,)], "text string")
    row = C.length_outliers(df).first()
    assert (row.too_short, row.too_long, row.removed, row.pct_removed) == (1, 1, 2, 50.0)
    assert C.length_outliers(df.where("false")).first().pct_removed is None


@pytest.mark.parametrize("unique_key", ["k", None])
def test_distinct_texts(spark, unique_key):
    rows = [(3, "a", "x"), (1, "a", "y"), (2, "a ", "z"), (9, None, "n"), (8, None, "m")]
    # a text that makes up a third of the table
    rows += [(100 + i, "hot", "h") for i in range(200)] + [(1000 + i, f"t{i}", "c") for i in range(400)]
    df = spark.createDataFrame(rows, "k long, text string, source string")
    got = C.distinct_texts(df, order_by="k", unique_key=unique_key)
    assert got.columns == df.columns
    found = {r.text: (r.k, r.source) for r in got.collect()}
    assert len(found) == 404 and got.count() == 404
    assert found["a"] == (1, "y") and found["hot"] == (100, "h") and found[None] == (8, "m")
    assert C.any_distinct_text(df).count() == 404


def test_sample_n(spark):
    df = spark.range(1000).repartition(7)
    order = sorted(range(1000), key=lambda i: hashlib.md5(f"{i}:42".encode()).hexdigest())
    for n in (0, 1, 137, 1000):
        assert sorted(r.id for r in C.sample_n(df, n, "id").collect()) == sorted(order[:n])
    with pytest.raises(Exception, match="cannot sample 1001"):
        C.sample_n(df, 1001, "id").collect()
    assert C.sample_n(df, 1001, "id", clamp=True).count() == 1000
    assert C.sample_n(df.where("false"), 5, "id", clamp=True).count() == 0


def test_dense_ids_by_value(spark):
    # clustered and far apart values
    keys = [i * 3 for i in range(500)] + [10**12 + i for i in range(500)] + [-5]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(9)
    got = {r.k: r.n for r in C.add_unique_id(df, order_by="k", column_name="n").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}
    assert C.add_unique_id(df.where("false"), order_by="k").count() == 0


def test_dense_ids_by_hash(spark):
    df = spark.range(777).withColumn("h", F.md5(F.col("id").cast("string")))
    got = C.add_unique_id(df, column_name="n", order_hash_hex=F.col("h")).orderBy("n").collect()
    assert [r.n for r in got] == list(range(777))
    assert [r.h for r in got] == sorted(r.h for r in got)


def py_chunks(n, limit, least):
    count = max(1, -(-n // limit))
    base, extra = divmod(n, count)
    sizes = [base + (i < extra) for i in range(count)]
    return [(i, s) for i, s in enumerate(sizes) if s >= least or count == 1]


@pytest.mark.parametrize(("limit", "least"), [(250, 100), (100, 80)])
def test_chunks(spark, limit, least):
    sizes = [0, 1, 99, 250, 251, 500, 501, 749, 101, 150, 2000]
    rows = [(n, f" {words(n)} \n", "keep") for n in sizes] + [(-1, None, "keep")]
    df = spark.createDataFrame(rows, "n int, text string, other string")
    got = chunk_by_tokens(df, limit, least)
    assert got.columns == ["n", "text", "other", "chunk_idx"]
    by_doc = {}
    for r in got.orderBy("n", "chunk_idx").collect():
        by_doc.setdefault(r.n, []).append((r.chunk_idx, r.text))
    assert -1 not in by_doc and 0 not in by_doc
    for n in sizes[1:]:
        chunks = by_doc.get(n, [])
        assert [(i, len(t.split(" "))) for i, t in chunks] == py_chunks(n, limit, least)
        if len(chunks) == max(1, -(-n // limit)):
            assert " ".join(t for _, t in chunks) == words(n)


def test_chunking_is_narrow(spark):
    df = spark.range(2).select(F.col("id").cast("string").alias("text"))
    plan = chunk_by_tokens(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
