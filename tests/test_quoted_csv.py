"""Quoted CSV read in ranges, against Spark's own reading in one task."""

import random

import pytest
from pyspark.sql import functions as F

from inkgauge.sources.corpus import CSV_OPTIONS, scan_csv
from inkgauge.sources.quoted_csv import inside_after, quoted_records

ONE_TASK = {**CSV_OPTIONS, "multiLine": "true", "nullValue": "\0"}


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))

    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


def field(rng):
    parts = ["a", "é😀", "\n", "\r\n", '"', '""', ",", " ", "1.0", "", "x" * rng.randrange(1, 60), "\n\n", '",\n"']
    return "".join(rng.choice(parts) for _ in range(rng.randrange(0, 9)))


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def table(rng, n, end):
    lines = ["text,generated,other"]
    for i in range(n):
        text = field(rng)
        kind = rng.random()
        if kind < 0.7:
            text = quoted(text)
        else:  # unquoted, maybe with a quote inside
            text = text.translate({ord(c): None for c in ',\n\r'})
            text = "t" + text if text.startswith('"') else text
        lines.append(f"{text},{i % 2},{quoted(str(i)) if rng.random() < 0.5 else i}")
        if rng.random() < 0.1:
            lines.append("")
    return end.join(lines) + (end if rng.random() < 0.5 else "")


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


def one_task(spark, path):
    return spark.read.options(**ONE_TASK).csv(path).select("generated", "text", "other")


@pytest.mark.parametrize("size, end", [(97, "\n"), (250, "\r\n"), (1 << 20, "\n")])
def test_ranges_equal_one_task(spark, tmp_path, small_ranges, size, end):
    rng = random.Random(size)
    for i in range(2):
        (tmp_path / f"{i}.csv").write_bytes(table(rng, 40, end).encode())
    small_ranges(size)
    got = scan_csv(spark, str(tmp_path), "generated string, text string, other string")
    if size < 1000:
        assert got.rdd.getNumPartitions() > 5
    expected = rows(one_task(spark, str(tmp_path)))
    if end == "\r\n":
        # where records end with CRLF the one task turns those inside texts into LF; here texts stay as they are
        texts = {r["text"] for r in got.collect()}
        assert any("\r\n" in t for t in texts if t)
        got = got.withColumn("text", F.replace("text", F.lit("\r\n"), F.lit("\n")))
    assert rows(got) == expected


def test_a_record_over_many_ranges_and_a_long_header(spark, tmp_path, small_ranges):
    text = "text,generated," + quoted("o\n" * 200) + '\n"' + "line, with\n" * 300 + '",1,2\n\n,0,\nz,1,"3"\n'
    (tmp_path / "a.csv").write_text(text)
    small_ranges(64)
    got = quoted_records(spark, str(tmp_path)).collect()
    assert sorted(r[0] for r in got) == sorted(['"' + "line, with\n" * 300 + '",1,2', ",0,", 'z,1,"3"'])


def test_only_a_header_or_nothing(spark, tmp_path):
    for i, text in enumerate(("text,generated\n", "\n\ntext,generated")):
        (tmp_path / f"{i}").mkdir()
        (tmp_path / f"{i}" / "a.csv").write_text(text)
        assert quoted_records(spark, str(tmp_path / f"{i}")).collect() == []


def test_columns_by_name_and_missing_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,text,generated\n1,"",x\n2,,1\n,"a ""b""\nc",0\n')
    got = scan_csv(spark, str(tmp_path / "a.csv"), "text string, n int")
    assert rows(got) == rows(spark.createDataFrame([("", 1), (None, 2), ('a "b"\nc', None)], "text string, n int"))


@pytest.mark.parametrize(
    "line, out",
    [
        ("", False), ("a,b", False), ('"a', True), ('"a"', False), ('a",', False), ('a"b,c"d', False), ('x,"', True),
        ('x,"""', True), ('""', False), ('"""', True), ('"a"b,"c', True), ('"a" ,b', False), (',,"', True), ('a","b', True),
    ],
)
def test_state_after_a_line(line, out):
    def plain(text, inside):  # letter by letter
        start, i = not inside, 0
        while i < len(text):
            if inside:
                if text[i] == '"':
                    if text[i + 1 : i + 2] == '"':
                        i += 1
                    else:
                        inside = start = False
            elif start and text[i] == '"':
                inside, start = True, False
            else:
                start = text[i] == ","
            i += 1
        return inside

    assert plain(line, False) == out == inside_after(line.encode(), False)
    assert plain(line, True) == inside_after(line.encode(), True)
