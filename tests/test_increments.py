"""A corpus that grows by calls: equal to one call over all rows, whole after failures."""

import pytest
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.plans import increments as I
from inkgauge.sources.corpus import Corpus

ROWS = "k long, text string, generated int"


def texts(n, first=0):
    return [" ".join(f"w{(i * j) % 97}" for j in range(90 + i)) for i in range(first, first + n)]


def corpus(spark, rows, key="k"):
    return [Corpus("c", spark.createDataFrame(rows, ROWS).repartition(3), key=key)]


def held(spark, store):
    cleaned = I.stored(spark, store, "cleaned")
    assert cleaned.columns == schema.RAW_COLS
    rows = cleaned.collect()
    assert sorted(r.id for r in rows) == list(range(len(rows)))
    digests = {(r.digest, r.id) for r in I.stored(spark, store, "digests").collect()}
    assert digests == {(r.d, r.id) for r in cleaned.select(F.sha2("text", 256).alias("d"), "id").collect()}
    assert {r.id for r in I.stored(spark, store, "processed").select("id").collect()} == {r.id for r in rows}
    return {r.text: r for r in rows}


@pytest.mark.parametrize("few", [I.FEW_DIGESTS, 0])
def test_parts_equal_the_whole(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(I, "FEW_DIGESTS", few)
    rows = [(i, t, i % 2) for i, t in enumerate(texts(40) + texts(25, 20) + texts(3))]
    rows += [(100, None, 1), (101, "", 0), (102, "too short", 1), (103, "w " * 5000, 1)]
    parts, whole = str(tmp_path / "parts"), str(tmp_path / "whole")
    first = I.add_to_corpus(corpus(spark, rows[:30]), parts)
    assert first.count() == I.stored(spark, parts, "processed").count()
    I.add_to_corpus(corpus(spark, rows[30:]), parts)
    I.add_to_corpus(corpus(spark, rows), whole)
    a, b = held(spark, parts), held(spark, whole)
    assert a.keys() == b.keys() == {t for _, t, _ in rows if t and 100 <= len(t.split(" ")) <= 1000}
    assert {t: r.generated for t, r in a.items()} == {t: r.generated for t, r in b.items()}
    assert all(a[t].id < 20 for t in texts(30) if t in a)


def test_nothing_new_and_failures(spark, tmp_path):
    store = str(tmp_path / "store")
    with pytest.raises(ValueError):
        I.stored(spark, store, "cleaned")
    rows = [(i, t, 1) for i, t in enumerate(texts(20, 10))]
    I.add_to_corpus(corpus(spark, rows[:0]), store)  # an empty table is a part without rows
    I.add_to_corpus(corpus(spark, rows[:12]), store)
    before = held(spark, store)
    assert I.add_to_corpus(corpus(spark, rows[:12], key=None), store).count() == 0
    assert held(spark, store) == before

    class Broken:
        def column(self, text, batch_size):
            return F.raise_error(F.lit("lost")).cast("array<float>")

    with pytest.raises(Exception, match="lost"):
        I.add_to_corpus(corpus(spark, rows[4:]), store, encoder=Broken())
    assert held(spark, store) == before  # what the failed call left does not count
    I.add_to_corpus(corpus(spark, rows[6:]), store)
    after = held(spark, store)
    assert len(after) == 20 and all(after[t] == r for t, r in before.items())
