"""The statistics report over the cleaned and the processed table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.functions.vectors import assemble_features
from inkgauge.operators import stats
from inkgauge.operators.pca import PcaReport


def corpus_statistics(
    before: DataFrame, after: DataFrame, components: int = 5
) -> dict[str, DataFrame]:
    """Every table of the report by name; nothing but the PCA is computed until asked for."""
    vectors = assemble_features(after)
    pca = PcaReport(components).fit(vectors)
    return {
        "length_histogram": stats.text_length_histogram(before),
        "length_density": stats.text_length_kde(before),
        "length_cutoffs": stats.length_cutoff_counts(before),
        "describe_before": stats.describe(before, schema.RAW_COLS),
        "labels_before": stats.label_distribution(before),
        "pca_variance": pca.variance_table(after.sparkSession),
        "pca_projection": pca.projection(vectors),
        "describe_after": stats.describe(after, schema.NUMERIC_COLS, by="generated"),
        "labels_after": stats.label_distribution(after),
    }


# The columns that tell the rows of a table apart.
REPORT_KEYS = {
    "length_histogram": ["bin"],
    "length_density": ["point"],
    "length_cutoffs": ["zone"],
    "describe_before": ["column"],
    "labels_before": ["label"],
    "pca_variance": ["pc"],
    "pca_projection": ["id"],
    "describe_after": ["generated", "column"],
    "labels_after": ["label"],
}


def long_form(tables: dict[str, DataFrame]) -> DataFrame:
    """(report, row_key, column, number, string): every cell of all tables of the report.

    A cell is a number or a string; both are null for a null cell.
    """
    parts = []
    for name, df in tables.items():
        keys = REPORT_KEYS[name]
        cells = [
            F.struct(
                F.lit(c).alias("column"),
                (F.lit(None) if kind == "string" else F.col(f"`{c}`")).cast("double").alias("number"),
                (F.col(f"`{c}`") if kind == "string" else F.lit(None)).cast("string").alias("string"),
            )
            for c, kind in df.dtypes
            if c not in keys
        ]
        # a null key (rows without a label) is a row of its own
        key = F.concat_ws("|", *(F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("null")) for k in keys))
        parts.append(df.select(F.lit(name).alias("report"), key.alias("row_key"), F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)
