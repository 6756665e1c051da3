"""N-gram Jaccard join by PartEnum signatures.

Two shingle sets with Jaccard similarity of at least p/100 differ in at most
k = (100 - p)(|a| + |b|) / (100 + p) elements. Sets are put into bands of sizes
[l, 100 l / p], so partners share a band or lie in neighbouring ones. For a band
the domain of elements is hashed into n1 first-level parts, each into N2 = 3
second-level parts, with n1 > k / 2: some first-level part then holds at most one
difference, and two of its three second-level parts hold none. One signature for
each pair of second-level parts (a hash of the elements that fall into them)
therefore meets in both sets. n1 is a function of the band alone, so partners on
either side of a band's edge cut it alike, and nothing is lost, whatever the sizes.

Signatures of no element would meet in all sets that leave a part empty. With t
first-level parts more than needed, t of them agree; a set in which fewer than t
have an empty pair leaves those out. Any other refines such a signature by each
element of its prefix: of two partners, the (100 - p)/100 |a| + 1 least elements
have one in common.

Sets that share a signature are compared in two steps. The sum of differences of
two sets' counts over SKETCH hashed parts never exceeds the number of elements in
which they differ, so pairs beyond k are no partners; for the others the sets
themselves are intersected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkgauge.llm.frames import components, map_batches, map_groups, written
from inkgauge.llm.shingles import mix, shingle_set

N2 = 3
SKETCH = 128
BLOCK_SETS = 512  # sets of a cell whose sketches are compared as one block
BLOCK_ELEMENTS = 1 << 16  # elements of a cell that are compared as one block
MARKS = 1 << 20  # id hashes that tell which texts may be needed
_ODD = np.uint64(0x9E3779B97F4A7C15)
_WRAP = (1 << 64) - 1
_LOW = np.uint64(0xFFFFFFFF)


def band_limits(percent: int, most: int) -> list[int]:
    """Largest size of each band; a partner of a set lies in its band or a neighbouring one."""
    limits = [1]
    while limits[-1] < most:
        limits.append(max(limits[-1] + 1, limits[-1] * 100 // percent))
    return limits


def set_id(found: np.ndarray) -> int:
    """64-bit name of a set."""
    if not len(found):
        return 0
    total = np.array([np.add.reduce(mix(found * _ODD), dtype=np.uint64)], np.uint64)
    return int(mix(total + np.uint64(len(found))).view(np.int64)[0])


def band_parts(band: int, percent: int, limits: list[int]) -> tuple[int, int]:
    """First-level parts of a band and how many of them are spare: the same for all sets that sign it.

    ``limits`` reach the band at least. (0, 0): only equal sets can be partners there.
    """
    k = (100 - percent) * 2 * limits[band] // (100 + percent)
    if k == 0:
        return 0, 0
    # the smallest set that signs the band, as the smaller partner of one just above the edge
    least = max(1, -(-(limits[band - 1] + 1) * percent // 100)) if band else 1
    void = math.exp(-least * (N2 - 1) / (N2 * (k / 2 + 1)))  # share of empty pairs, about
    spare = 1 + int(2 * N2 * void * (k // 2 + 1))
    return k // 2 + spare, spare


def signatures(found: np.ndarray, percent: int) -> np.ndarray:
    """PartEnum signatures of a sorted set, over its own band and, as the smaller partner, the next."""
    size = len(found)
    limits = band_limits(percent, size + 1)
    own = int(np.searchsorted(limits, size))
    bands = [own]
    if size * 100 // percent > limits[own]:
        limits = band_limits(percent, limits[own] + 1)
        bands.append(own + 1)
    out = []
    for band in bands:
        n1, spare = band_parts(band, percent, limits)
        if n1 == 0:
            continue  # such sets are one class already
        spot = mix(found + np.uint64((band + 1) * int(_ODD) & _WRAP))
        first = ((spot >> np.uint64(33)) * np.uint64(n1)) >> np.uint64(31)
        part = (first * np.uint64(N2) + (spot & _LOW) % np.uint64(N2)).astype(np.int64)
        n = n1 * N2
        low = np.bincount(part, (found & _LOW).astype(np.float64), n).astype(np.uint64)
        high = np.bincount(part, (found >> np.uint64(32)).astype(np.float64), n).astype(np.uint64)
        sums = low + (high << np.uint64(32))
        counts = np.bincount(part, minlength=n)
        # all but one second-level part
        rest = np.repeat(sums.reshape(n1, N2).sum(1, dtype=np.uint64), N2) - sums
        empty = np.repeat(counts.reshape(n1, N2).sum(1), N2) == counts
        place = mix(np.arange(n, dtype=np.uint64) + np.uint64(band) * np.uint64(1 << 40))
        signs = mix(rest * _ODD + place)
        out.append(signs[~empty])
        if empty.reshape(n1, N2).any(1).sum() >= spare:
            prefix = found[: size - (size * percent + 99) // 100 + 1]
            out.append(mix(signs[empty][:, None] + prefix[None, :] * _ODD).ravel())
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def sketch(found: np.ndarray) -> np.ndarray:
    return np.bincount((found >> np.uint64(57)).astype(np.int64), minlength=SKETCH).astype(np.int32)


def _classes(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingle_set(t, width) for t in pdf["text"]]
            yield pd.DataFrame(
                {"id": pdf["id"], "n_shingles": [len(s) for s in sets], "cls": [set_id(s) for s in sets]}
            )

    return run


def _signed(width: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # copies in one task sign once
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                found = shingle_set(text, width)
                cls = set_id(found)
                if len(found) and cls not in seen:
                    seen.add(cls)
                    rows.append((cls, signatures(found, percent).view(np.int64)))
            yield pd.DataFrame(rows, columns=["cls", "signs"])

    return run


def _sketches(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                found = shingle_set(text, width)
                cls = set_id(found)
                if cls not in seen:
                    seen.add(cls)
                    rows.append((cls, sketch(found).tobytes()))
            yield pd.DataFrame(rows, columns=["cls", "sketch"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [shingle_set(t, width) for t in pdf.pop("text")]
            # an id may be repeated with other texts
            same = np.array([set_id(s) for s in found], np.int64) == pdf["cls"].to_numpy()
            yield pdf.assign(elements=[s.tobytes() for s in found])[same]

    return run


def _promising(percent: int):
    def run(key: tuple, group: dict[str, np.ndarray]) -> list[tuple]:
        """Members of a cell with a partner, going by sizes and sketches, that they meet here first."""
        order = np.lexsort((group["cls"], group["size"]))
        cls = group["cls"][order]
        order = order[np.concatenate([[True], cls[1:] != cls[:-1]])]
        if len(order) < 2:
            return []
        cls, sizes, blocks = (group[c][order] for c in ("cls", "size", "block"))
        counts = np.frombuffer(b"".join(group["sketch"][order]), np.int32).reshape(len(order), SKETCH)
        cells = group["cells"][order]
        cross = key[1] != key[2]
        kept = np.zeros(len(order), bool)
        for i in range(len(order) - 1):
            upto = int(np.searchsorted(sizes, sizes[i] * 100 // percent, side="right"))
            apart = np.abs(counts[i + 1 : upto] - counts[i]).sum(1)
            near = apart * (100 + percent) <= (100 - percent) * (sizes[i] + sizes[i + 1 : upto])
            if cross:
                near &= blocks[i + 1 : upto] != blocks[i]
            for j in np.flatnonzero(near) + i + 1:
                if not (kept[i] and kept[j]) and np.intersect1d(cells[i], cells[j])[0] == key[0]:
                    kept[i] = kept[j] = True
        return [(key[0], int(c)) for c in cls[kept]]

    return run


def linked_pairs(ids: list[int], sets: list[np.ndarray], sides: np.ndarray, percent: int) -> list[tuple]:
    """Spanning links between sets of different sides (of any, if there is one side).

    A set is compared, as a whole and exactly, with all sets of admissible size
    that no earlier link has joined to it.
    """
    order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
    ids = [ids[i] for i in order]
    sides = np.asarray(sides)[order]
    sets = [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(values), bool)
    label = np.arange(len(ids))
    cross = len(set(sides.tolist())) > 1
    links = []
    for i in range(len(ids) - 1):
        upto = int(np.searchsorted(sizes, sizes[i] * 100 // percent, side="right"))
        wanted = label[i + 1 : upto] != label[i]
        if cross:
            wanted &= sides[i + 1 : upto] != sides[i]
        if not wanted.any():
            continue
        own = codes[offsets[i] : offsets[i + 1]]
        mark[own] = True
        hits = mark[codes[offsets[i + 1] : offsets[upto]]]
        common = np.add.reduceat(hits, offsets[i + 1 : upto] - offsets[i + 1], dtype=np.int64)
        mark[own] = False
        union = sizes[i] + sizes[i + 1 : upto] - common
        for j in np.flatnonzero(wanted & (100 * common >= percent * union)) + i + 1:
            links.append((ids[i], ids[j]))
            label[label == label[j]] = label[i]
    return links


def _verify(percent: int):
    def run(key: tuple, group: dict[str, np.ndarray]) -> list[tuple]:
        cls, first = np.unique(group["cls"], return_index=True)
        if len(cls) < 2:
            return []
        sets = [np.frombuffer(b, np.uint64) for b in group["elements"][first]]
        return linked_pairs(cls.tolist(), sets, group["block"][first], percent)

    return run


def _in_blocks(members: DataFrame, blocks: Column) -> DataFrame:
    """Cut each cell into blocks; a row goes to all pairs (i, j), i <= j, of its block with another."""
    sizes = members.groupBy("cell").agg(F.ceil(blocks).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    rows = members.join(sizes, "cell").withColumn("block", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("blocks", "other")


def ngram_jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85
) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``: groups linked by 100 |a & b| >= percent |a | b|.

    Rows with the same set are one class from the start and travel as one. Classes
    that share a signature are gathered under the smallest of them; these cells
    are cut into blocks of bounded size, and every pair of blocks is compared by
    exact intersection in its own task, so no cell is too large and no pair is
    written out but spanning links.

    Null or empty texts (and texts of spaces) have no shingles and link with
    nothing; a text of fewer words than ``width`` is one shingle. ``component_id``
    is the smallest id in reach; rows without an id get that of their class, but a
    class of such rows alone connects nothing and stays null. Repeated rows,
    also of one id, are kept and linked by their texts. Other columns are ignored.
    An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    rows = written(map_batches(docs, _classes(width), "id bigint, n_shingles bigint, cls bigint"), "classes")
    reps = rows.where("n_shingles > 0").groupBy("cls").agg(F.min("id").alias("rep"), F.max("n_shingles").alias("size"))
    reps = written(reps.where("rep IS NOT NULL"), "reps")

    signed = map_batches(docs.select("text"), _signed(width, percent), "cls bigint, signs array<bigint>")
    by_sign = Window.partitionBy("sign")
    cells = (
        signed.select("cls", F.explode("signs").alias("sign"))
        .select("cls", F.min("cls").over(by_sign).alias("cell"), F.max("cls").over(by_sign).alias("last"))
        .where("cell < last")
        .select("cell", "cls")
        .distinct()
    )
    # a set meets no more cells than it has signatures
    members = cells.groupBy("cls").agg(F.collect_list("cell").alias("cells")).join(reps, "cls")
    members = written(members, "members")
    mark = F.pmod(F.xxhash64("id"), F.lit(MARKS)).alias("mark")
    marked = docs.withColumn("mark", mark)
    # at most MARKS rows: safe to broadcast; the texts of others are passed over where they are read
    marks = F.broadcast(members.select(F.col("rep").alias("id")).select(mark).distinct())
    sketches = map_batches(
        marked.join(marks, "mark", "left_semi").select("text"), _sketches(width), "cls bigint, sketch binary"
    )
    placed = members.join(sketches, "cls").withColumn("cell", F.explode("cells"))
    met = map_groups(
        _in_blocks(placed, F.count(F.lit(1)) / BLOCK_SETS).drop("rep"),
        ["cell", "i", "j"], _promising(percent), "cell bigint, cls bigint",
    )
    met = written(met.distinct().join(reps, "cls"), "promising")
    marks = F.broadcast(met.select(F.col("rep").alias("id")).select(mark).distinct())
    placed = _in_blocks(met, F.sum("size") / BLOCK_ELEMENTS)
    placed = placed.select(F.col("rep").alias("id"), "cls", "cell", "i", "j", "block")
    texts = marked.join(marks, "mark", "left_semi").select("id", "text").join(placed, "id").drop("id")
    sets = map_batches(
        texts, _sets(width), "cls bigint, cell bigint, i int, j int, block int, elements binary"
    )
    edges = map_groups(sets, ["cell", "i", "j"], _verify(percent), "a bigint, b bigint")
    ids = reps.select("cls", "rep")
    edges = (
        edges.join(ids.select(F.col("cls").alias("a"), F.col("rep").alias("x")), "a")
        .join(ids.select(F.col("cls").alias("b"), F.col("rep").alias("y")), "b")
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    found = components(edges)
    named = reps.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select("cls", F.coalesce("component", "rep").alias("component"))
    alone = F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component"))
    return rows.join(named, "cls", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce(alone, F.col("id")).alias("component_id")
    )
