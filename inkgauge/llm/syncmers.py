"""Document fingerprints of closed syncmers, in Spark's own functions only.

A text is cut into units: visible runs, cut again after each byte of CUTS. Where a
unit ends depends on the bytes at hand alone, also in long runs without a space. A
run of K units is an anchor when the least hash among its inner runs of S units
stands at its first or last place. So an edit moves no anchor outside the runs it
touches. In any K - S + 1 neighbouring runs one is an anchor, some 2 in 5 of all.

Two texts are matched by position: the nth anchor of a value in one belongs to the
nth of that value in the other, and of these pairs the longest chain counts that is
in order in both texts (to a GRIDth of the longer one).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkgauge.operators.ranking import range_bucket

K, S = 6, 2
INNER = K - S + 1
BITS = 24  # of an anchor's hash: four characters of a fingerprint
GRID = 32
SPACES = b"\t\n\x0b\f\r "
CUTS = bytes(b for b in range(256) if b % 8 == 5 and b not in SPACES)


def _escaped(these: bytes) -> str:
    return "".join(f"\\x{b:02x}" for b in these)


# single characters only: Java then tests a class by one bit set
UNIT = "[^{0}{1}]*+[{1}]|[^{0}{1}]++".format(_escaped(SPACES), _escaped(CUTS))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _zip(columns: list[Column], fn: Callable[[Column, Column], Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = F.zip_with(out, c, fn)
    return out


def _short(h: Column) -> Column:
    return h.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")


def anchors(text: Column) -> Column:
    """Hashes of the closed syncmers of ``text`` in order (array<int>).

    A text without a syncmer (fewer than K units, or none among a few) is one
    anchor as a whole; a text without visible characters, or null, has none.
    """
    # one character for each byte
    data = F.decode(F.coalesce(text, F.lit("")).cast("binary"), "ISO-8859-1")
    units = F.regexp_extract_all(data, F.lit(UNIT), F.lit(0))

    def runs(h: Column) -> Column:
        n = F.size(h)
        inner = _zip(
            [F.slice(h, F.lit(1 + i), F.greatest(n - (S - 1), F.lit(0))) for i in range(S)], lambda a, b: F.xxhash64(a, b)
        )
        return _let(inner, lambda g: select(g, n))

    def select(g: Column, n: Column) -> Column:
        count = F.greatest(n - (K - 1), F.lit(0))
        at = [F.slice(g, F.lit(1 + i), count) for i in range(INNER)]
        edges = _zip([at[0], at[-1]], lambda a, b: F.least(a, b))
        middle = _zip(at[1:-1], lambda a, b: F.least(a, b))
        # the inner runs 0, S, 2S, ... and the last one cover all K units
        whole = F.transform(_zip([*at[:-1:S], at[-1]], lambda a, b: F.xxhash64(a, b)), _short)
        closed = F.zip_with(edges, middle, lambda e, m: e <= m)
        return F.filter(F.zip_with(closed, whole, lambda c, w: F.when(c, w)), lambda x: x.isNotNull())

    def found(h: Column) -> Column:
        return _let(
            runs(h),
            lambda a: F.when(F.size(a) > 0, a)
            .when(F.size(h) > 0, F.array(_short(F.xxhash64(h))))
            .otherwise(F.array().cast("array<int>")),
        )

    return _let(F.transform(units, lambda u: F.xxhash64(u)), found)


def fingerprint(found: Column) -> Column:
    """Anchors in order, four base64 characters each."""
    digits = F.transform(found, lambda x: F.lpad(F.hex(x), BITS // 4, "0"))
    # Spark breaks base64 into lines, depending on a setting
    return F.translate(F.base64(F.unhex(F.array_join(digits, ""))), "\r\n", "")


def _run_starts(values: Column, shift: int) -> Column:
    """Where, in a sorted non-empty array, values begin that differ above ``shift`` bits."""
    rest = F.size(values) - 1
    pairs = F.zip_with(
        F.slice(values, F.lit(2), rest),
        F.slice(values, F.lit(1), rest),
        lambda x, before: F.shiftright(x, shift) != F.shiftright(before, shift),
    )
    at = F.filter(F.transform(pairs, lambda new, i: F.when(new, i + 1)), lambda i: i.isNotNull())
    return F.concat(F.array(F.lit(0)), at)


def _run_lengths(starts: Column, total: Column) -> Column:
    return F.zip_with(F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(total)), starts, lambda b, a: b - a)


def numbered(found: Column) -> Column:
    """(key, at) per anchor: its hash with its number among equal ones, and its place."""

    def number(p: Column) -> Column:
        lengths = _let(_run_starts(p, 32), lambda starts: _run_lengths(starts, F.size(p)))
        nth = F.flatten(F.transform(lengths, lambda n: F.sequence(F.lit(0), n - 1)))
        return F.zip_with(
            p,
            nth,
            lambda x, i: F.struct(
                F.shiftleft(F.shiftright(x, 32), 32).bitwiseOR(i.cast("bigint")).alias("key"),
                x.bitwiseAND(F.lit((1 << 32) - 1)).alias("at"),
            ),
        )

    placed = F.transform(found, lambda x, i: F.shiftleft(x.cast("bigint"), 32).bitwiseOR(i.cast("bigint")))
    none = F.array().cast("array<struct<key:bigint,at:bigint>>")
    return F.when(F.size(found) > 0, _let(F.sort_array(placed), number)).otherwise(none)


def chain(a: Column, b: Column) -> Column:
    """Length of the longest chain of matches in order of two numbered anchor arrays.

    Matches are sorted by the cells of a GRID x GRID table of places; the chain is the
    longest sequence of them whose places in ``b`` never fall. Equal cells are taken
    together, so there are at most GRID * GRID steps however long the texts are.
    """
    longer = F.greatest(F.size(a), F.size(b))
    low = GRID.bit_length() - 1

    def side(found: Column, bit: int) -> Column:
        def packed(s: Column) -> Column:
            cell = F.floor(s["at"] * GRID / longer).bitwiseOR(F.lit(bit * GRID).cast("bigint"))
            return F.shiftleft(s["key"], low + 1).bitwiseOR(cell)

        return F.transform(found, packed)

    def matches(both: Column) -> Column:
        rest = F.greatest(F.size(both) - 1, F.lit(0))
        cells = F.zip_with(
            F.slice(both, F.lit(1), rest),
            F.slice(both, F.lit(2), rest),
            lambda x, y: F.when(
                F.shiftright(x, low + 1) == F.shiftright(y, low + 1),
                x.bitwiseAND(F.lit(GRID - 1)) * GRID + y.bitwiseAND(F.lit(GRID - 1)),
            ),
        )
        return F.sort_array(F.filter(cells, lambda c: c.isNotNull()))

    def step(best: Column, run: Column) -> Column:
        j = run["column"]
        ended = F.array_max(F.slice(best, F.lit(1), j + 1)) + run["n"]
        return F.concat(F.slice(best, F.lit(1), j), F.array(ended), F.slice(best, j + 2, F.lit(GRID)))

    def longest(cells: Column) -> Column:
        def runs(starts: Column) -> Column:
            return F.zip_with(
                starts,
                _run_lengths(starts, F.size(cells)),
                lambda i, n: F.struct(
                    F.element_at(cells, i + 1).bitwiseAND(F.lit(GRID - 1)).cast("int").alias("column"), n.alias("n")
                ),
            )

        found = _let(_run_starts(cells, 0), runs)
        return F.when(F.size(cells) == 0, F.lit(0)).otherwise(
            F.array_max(F.aggregate(found, F.array_repeat(F.lit(0), GRID), step))
        )

    return _let(_let(F.sort_array(F.concat(side(a, 0), side(b, 1))), matches), longest)


def likeness(a: Column, b: Column) -> Column:
    """Share of the anchors of both that are in their longest common chain, repeats counted.

    Takes numbered anchors. Two texts without anchors are alike.
    """

    def share(a: Column, b: Column) -> Column:
        total = F.size(a) + F.size(b)
        return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * chain(a, b) / total)

    # bound once: the lambdas inside ask for sizes at every element
    return _let(F.struct(a.alias("a"), b.alias("b")), lambda both: share(both["a"], both["b"]))


def with_next(docs: DataFrame, id_col: str, text_col: str, buckets: int) -> tuple[DataFrame, Window]:
    """(id, text, guest) with a window in which the next row by descending id follows.

    Rows are dealt out by ranges of ids, so the text moves once and no task sees
    them all. The first row of each range is also sent, as a guest, to the end of
    the range before it, and the very first to the end of the last.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    bounds = rows.agg(F.percentile_approx("id", shares, 20 * buckets)).first()[0] or []
    bounds = sorted(set(bounds))
    place = range_bucket(F.col("id"), bounds, fan=32) if bounds else F.lit(0)
    # null ids come last, in ranges of the hash that orders them
    text_hash = F.xxhash64("text")
    among_nulls = F.floor((F.shiftright(text_hash, 56) + 128) * buckets / 256).cast("int")
    rows = rows.withColumn("range", F.when(F.col("id").isNull(), -1 - among_nulls).otherwise(place))
    # one row per range: safe to sort and to broadcast
    firsts = rows.groupBy("range").agg(F.max(F.struct("id", F.bitwise_not(text_hash).alias("h"))).alias("first"))
    down, every = Window.orderBy(F.desc("range")), Window.partitionBy()
    firsts = firsts.select(
        F.col("range").alias("of"),
        "first",
        F.coalesce(F.lag("range").over(down), F.min("range").over(every)).alias("before"),
    )
    rows = rows.join(
        F.broadcast(firsts),
        (F.col("range") == F.col("of"))
        & F.col("id").eqNullSafe(F.col("first.id"))
        & (F.bitwise_not(text_hash) == F.col("first.h")),
        "left",
    )
    homes = F.array(F.struct(F.col("range").alias("at"), F.lit(False).alias("guest")))
    both = F.concat(homes, F.array(F.struct(F.col("before").alias("at"), F.lit(True).alias("guest"))))
    rows = rows.select("id", "text", F.explode(F.when(F.col("before").isNull(), homes).otherwise(both)).alias("p"))
    rows = rows.select("id", "text", "p.at", "p.guest")
    order = Window.partitionBy("at").orderBy("guest", F.desc_nulls_last("id"), F.xxhash64("text"), "text")
    return rows, order


def fingerprint_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses.

    Edited: the last third of the code points (rounded down) gives way to the first
    as many, or all, of the next document by descending id (after the last: the
    first). Returns (id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_anchors) per row. Null texts are empty. Null ids come
    last; rows of equal ids follow by a hash of their texts. A single document is
    its own next. An empty table gives an empty result, other columns are ignored.
    """
    if buckets is None:
        buckets = max(64, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows, order = with_next(docs, id_col, text_col, buckets)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    kept = F.substring("text", F.lit(1), n - cut)
    rows = rows.withColumn("next", F.lead("text").over(order))
    rows = rows.withColumn("edited", F.concat(kept, F.substring(F.coalesce("next", F.lit("")), F.lit(1), cut)))
    rows = rows.drop("next").withColumn("own", anchors(F.col("text")))
    rows = rows.withColumn("following", F.lead("own").over(order)).where(~F.col("guest"))
    rows = rows.withColumn("changed", anchors(F.col("edited")))
    near = _let(
        numbered(F.col("own")),
        lambda own: F.struct(
            likeness(own, numbered(F.col("changed"))).alias("edited"),
            likeness(own, numbered(F.col("following"))).alias("next"),
        ),
    )
    rows = rows.withColumn("near", near)
    return rows.select(
        F.col("id").alias(id_col),
        n.cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        F.col("near.edited").alias("near_edited"),
        F.col("near.next").alias("near_next"),
        F.size("own").alias("n_anchors"),
    )
