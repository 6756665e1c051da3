"""The driver contract, and a share of the queries against their SQL on the smallest data."""

import subprocess
import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from inkgauge import schema
from inkgauge.functions.vectors import assemble_features
from inkgauge.registry import base
from tools.check_oracle import SAME_TYPE, TABLES, sort_key

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "scan_csv",
    "merge_corpora",
    "filter_word_count",
    "distinct_texts",
    "distinct_texts_carried",
    "add_unique_id",
    "sample_n",
    "chunk_by_tokens_dropping",
    "text_features",
    "style_vector",
    "embed_text",
    "prepare_corpus",
    "describe_by_label",
    "text_length_histogram",
    "text_length_kde",
    "split_stratified",
    "standardize",
    "confusion_matrix",
    "lsh_candidates",
    "candidate_union",
    "lsh_query",
    "lsh_predict_probability_sparse",
    "lsh_grid_search",
]


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r.quality for r in rows} == {0, 1} and all(r.chunks > 0 for r in rows)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 95


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    result = duck.execute(f"SELECT * FROM ({entry.oracle_sql()[name]})")
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert {c: SAME_TYPE[t] for c, t in df.dtypes} == kinds
    order = [list(kinds).index(c) for c in cols]
    want = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=sort_key)
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=sort_key)
    assert got == want


def test_whole_lsh_run(spark):
    """The job's grid, and test figures that count every row of the test part."""
    test_query_equals_sql(spark, "lsh_run_full")
    row = entry.queries()["lsh_run_full"](spark, SF).first().asDict()
    tables, bits, ks = schema.TABLES_GRID, schema.BITS_GRID, schema.TOP_K_GRID
    grid = [(t, b, k) for t in tables for b in bits for k in ks]
    assert len(grid) == 12
    assert grid[row["grid_pos"]] == (row["num_hash_tables"], row["num_hash_bits"], row["top_k"])
    cells = {k: v for k, v in row.items() if k.startswith("actual_")}
    assert len(cells) == 4 and sum(cells.values()) == row["total"] > 0
    assert cells["actual_0_predicted_0"] + cells["actual_1_predicted_1"] == row["correct"]


def test_whole_statistics_report(spark):
    """All nine tables together: seven against SQL, the two of the PCA against numpy."""
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    sql = entry.oracle_sql()
    duck.execute(f"CREATE TABLE cleaned AS {base.SQL_CLEANED}")
    want = {}

    def expect(report, keys, found):
        names = [d[0] for d in found.description]
        for row in found.fetchall():
            row = dict(zip(names, row, strict=True))
            name = row.pop("report") if report is None else report
            key = "|".join(str(row.pop(k)) for k in keys)
            want.update({(name, key, c): v for c, v in row.items()})

    single = {"length_histogram": ("text_length_histogram", "bin"), "length_density": ("text_length_kde", "point")}
    single["length_cutoffs"] = ("length_cutoff_counts", "zone")
    for report, (name, key) in single.items():
        assert "FROM documents" in sql[name]
        expect(report, [key], duck.execute(sql[name].replace("FROM documents", "FROM cleaned")))
    expect("describe_before", ["column"], duck.execute(sql["describe_raw"]))
    expect("describe_after", ["generated", "column"], duck.execute(sql["describe_by_label"]))
    expect(None, ["label"], duck.execute(sql["corpus_statistics"]))

    rows = entry.queries()["corpus_statistics_full"](spark, SF).collect()
    got = {(r.report, r.row_key, r.column): r.string if r.number is None else r.number for r in rows}
    assert len(got) == len(rows) and len({r.report for r in rows}) == 9
    assert {k for k in got if not k[0].startswith("pca_")} == set(want)
    for key, value in want.items():
        # the processed table keeps its measures as 32-bit floats
        rel, least = 1e-6 if key[0] == "describe_after" else 0, 2e-10 if key[2] == "density" else 2e-6
        near = value if value is None or isinstance(value, str) else pytest.approx(value, rel=rel, abs=least)
        assert got[key] == near, key

    after = base.processed(spark, SF).withColumn("id", F.concat_ws(":", "id", "chunk_idx"))
    vectors = assemble_features(after).collect()
    x = np.array([r.features for r in vectors])
    std = x.std(0)
    z = (x - x.mean(0)) / np.where(std > 0, std, 1)
    _, scale, axes = np.linalg.svd(z, full_matrices=False)
    shares = 100 * scale**2 / (scale**2).sum()
    for i in range(5):
        assert got["pca_variance", f"PC{i + 1}", "explained_variance_pct"] == pytest.approx(shares[i], abs=0.006)
        assert got["pca_variance", f"PC{i + 1}", "cumulative_variance_pct"] == pytest.approx(shares[: i + 1].sum(), abs=0.006)
    assert sum(k[0] == "pca_projection" for k in got) == 3 * len(vectors)
    pc1 = np.array([got["pca_projection", r.id, "pc1"] for r in vectors])
    assert np.abs(pc1) == pytest.approx(np.abs(z @ axes[0]), abs=1e-4)


def test_a_missing_library_of_the_optional_part_leaves_the_rest():
    program = (
        "import sys, warnings\n"
        "sys.modules['public_tokenizers'] = None\n"
        "with warnings.catch_warnings(record=True) as said:\n"
        "    warnings.simplefilter('always')\n"
        "    import __spark_entry__ as e\n"
        "assert any('public_tokenizers' in str(w.message) for w in said)\n"
        "names = set(e.queries())\n"
        "assert 'text_features' in names and not any(n.startswith('op') for n in names) and 'pipeline' not in names\n"
    )
    root = Path(entry.__file__).parent
    subprocess.run([sys.executable, "-c", program], cwd=root, check=True, timeout=120)
