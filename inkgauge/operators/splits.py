"""Train / validation / test splits with exact sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.operators.ranking import PREFIX, hash_cutoffs, order_hash, with_cutoffs
from inkgauge.session import written


def _two_step_rules(held_out: float, test_of_held_out: float):
    """Row counts up to the end of train and of validation; held-out sizes are rounded up."""

    def held(total: Column) -> Column:
        return F.ceil(F.lit(held_out) * total)

    def train(total: Column) -> Column:
        return total - held(total)

    def train_val(total: Column) -> Column:
        return total - F.ceil(F.lit(test_of_held_out) * held(total))

    return {"train": train, "val": train_val}


def _labelled(df: DataFrame, order: Column, cut: Column, out: str) -> DataFrame:
    part = (
        F.when(order <= cut["train"], "train").when(order <= cut["val"], "val").otherwise("test")
    )
    return df.withColumn(out, part)


def split_random(
    df: DataFrame,
    key: str = "id",
    test_size: float = 0.2,
    val_size: float = 0.5,
    seed: int = schema.SEED,
    group_col: str | None = None,
    out: str = "split",
) -> DataFrame:
    """Add a column naming each row's part: ``test_size`` is held out, then divided.

    ``key`` is unique per row. With ``group_col`` whole groups are assigned, so the
    chunks of one document stay together and the sizes count groups.
    """
    unit = group_col or key
    order = order_hash(unit, seed=seed)
    units = df.select(unit).distinct() if group_col else df
    cutoffs = hash_cutoffs(units, order, _two_step_rules(test_size, val_size))
    return _labelled(df, order, cutoffs.select(F.struct("train", "val")).scalar(), out)


def split_stratified(
    df: DataFrame,
    label: str,
    key: str = "id",
    shares: tuple[float, float, float] = schema.SHARES,
    seed: int = schema.SEED,
    out: str = "split",
    group_col: str | None = None,
) -> DataFrame:
    """As ``split_random``, with the shares met within every label.

    With ``group_col`` groups stay whole and the shares are met among the groups that
    have the same number of rows of every label (``split_groups``).
    """
    train, val, test = shares
    if abs(train + val + test - 1.0) >= 1e-6:
        raise ValueError("the shares of train, validation and test must sum to 1")
    if group_col:
        return split_groups(df, label, group_col, val, test, seed, out)
    order = order_hash(key, seed=seed)
    cls = F.coalesce(F.col(label).cast("string"), F.lit(""))
    # 1 - 0.8 is a hair under 0.2; rounding keeps exact multiples exact
    rules = _two_step_rules(round(1 - train, 12), round(test / (test + val), 12))
    rows = with_cutoffs(df, hash_cutoffs(df, order, rules, by=cls), cls, "_cuts")
    return _labelled(rows, order, F.col("_cuts"), out).drop("_cuts")


PARTS_OF = 1_000_000  # shares of groups are whole millionths


def split_groups(
    df: DataFrame,
    label: str,
    group_col: str,
    val: float = 0.1,
    test: float = 0.1,
    seed: int = schema.SEED,
    out: str = "split",
) -> DataFrame:
    """Name each row's part so that no group is in two of them and labels keep their shares.

    Groups with equal label counts are interchangeable; such classes follow one another,
    in each the order is a hash. Along that order parts are dealt out evenly: of any run
    of m groups, a class for one, m x (val + test) are held out, and of h held-out ones
    h x test / (val + test) are for testing, to within one group. A part's share of a
    label thus misses its target by less than the rows of one group of each class.

    Rows without a group are one group. Only one row per group is sorted, by class and
    hash prefix; sizes of classes and prefixes are counters.
    """
    held, tested = (round(x * PARTS_OF) for x in (val + test, test))
    of = F.coalesce(F.col(label).cast("string"), F.lit(""))
    counts = df.groupBy(F.col(group_col).alias("_group"), of.alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    vector = F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "_label", "_n"))), ",")
    groups = counts.groupBy("_group").agg(vector.alias("_class"))
    order = order_hash(F.coalesce(F.col("_group").cast("string"), F.lit("")), seed=seed)
    groups = groups.withColumn("_order", order).withColumn("_prefix", F.substring("_order", 1, PREFIX))
    groups = written(groups, "groups")
    # one counter for each class and prefix that occurs
    sizes = groups.groupBy("_class", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    in_class = Window.partitionBy("_class").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(in_class), F.lit(0)))
    classes = groups.groupBy("_class").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select("_class", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_class", "_prefix").orderBy("_order", "_group")) - 1
    ranked = groups.withColumn("_within", within).join(sizes.drop("_n"), ["_class", "_prefix"]).join(classes, "_class")
    rank = F.col("_offset") + F.col("_before") + F.col("_within")
    parts = ranked.select("_group", rank.alias("_rank")).withColumn("_nth", F.expr(f"_rank * {held} div {PARTS_OF}"))
    is_held = F.expr(f"(_rank + 1) * {held} div {PARTS_OF} > _nth")
    is_test = F.expr(f"(_nth + 1) * {tested} div {held} > _nth * {tested} div {held}") if held else F.lit(False)
    part = F.when(~is_held, "train").when(is_test, "test").otherwise("val")
    parts = written(parts.select("_group", part.alias(out)), "parts")
    return df.join(parts, df[group_col].eqNullSafe(parts["_group"])).drop("_group")
