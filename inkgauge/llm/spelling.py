"""Spelling variants: words one edit apart, found by PartEnum signatures of their letters.

A word is the multiset of its letters, that is the binary vector over (letter, how
many of it came before). One inserted or deleted code point changes one element of
it, one replaced code point two, so near words lie within Hamming distance 2. The
domain of elements is hashed into PARTS parts; two differences touch at most two of
them, so the words agree on all elements of some PARTS - 2 parts. For each choice of
so many parts a word has one signature, its letters there, and near words share at
least one: nothing is lost.

Words of one signature meet in a group and are verified there by equi-joins too: a
replaced letter leaves equal words once its place is masked, a deleted one leaves
the shorter word. A pair that shares several signatures counts under the first one.
Groups of more than CROWDED words are split by the masked and shortened words
themselves, so no task holds them whole. Only counts and the best partner of a word
leave a group, never its pairs.

Rows without text have no words. A null id counts as an empty one in the hash that
picks deletions. Repeated rows count as often as they occur. An empty table gives no
rows; columns other than the two named ones are not read.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgauge.llm.frames import map_groups, written
from inkgauge.session import ship_package

PARTS = 4
CHOICES = list(itertools.combinations(range(PARTS), PARTS - 2))
CROWDED = 20_000  # words of a signature that one task compares
HELD = 400_000  # words a task counts before it passes them on
MASK = "*"  # no word holds it
# a run of A-Z, a-z, U+00C0-U+00FF in UTF-8, of which A-Z are folded before
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_place: dict[tuple[str, int], int] = {}


def counted_words(docs: DataFrame, text: str, id_col: str, deletions: int, least_length: int, least_n: int) -> DataFrame:
    """(word, n): words of at least ``least_length`` code points with ``n`` >= ``least_n`` occurrences.

    One occurrence in ``deletions``, picked by the CRC-32 of id and word, loses a letter.
    """

    def runs(raw: bytes, seed: int, held: Counter) -> None:
        found = _RUN.findall(raw.translate(_LOWER))
        held.update(found)
        hashes = [zlib.crc32(w, seed) for w in found]
        for i in np.flatnonzero(np.array(hashes, np.int64) % deletions == 0).tolist():
            word = found[i].decode()
            at = hashes[i] % len(word)
            held[found[i]] -= 1
            held[(word[:at] + word[at + 1 :]).encode()] += 1

    def passed(held: Counter) -> pa.RecordBatch:
        kept = [(w, n) for w, n in ((w.decode(), n) for w, n in held.items() if n) if len(w) >= least_length]
        held.clear()
        names, counts = zip(*kept, strict=True) if kept else ((), ())
        return pa.record_batch([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for i in range(len(batch)):  # one text at a time leaves the Arrow batch
                raw = batch.column(1)[i].as_py()
                if raw:
                    runs(raw, zlib.crc32(f"{batch.column(0)[i].as_py() or ''}:".encode()), held)
                    if len(held) > HELD:
                        yield passed(held)
        yield passed(held)

    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text).cast("binary").alias("text"))
    parts = rows.where("text IS NOT NULL").mapInArrow(count, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def _part(element: tuple[str, int]) -> int:
    found = _place.get(element)
    if found is None:
        found = zlib.crc32(f"{element[0]}{element[1]}".encode()) % PARTS
        if element[1] < 64:
            _place[element] = found
    return found


def projections(word: str) -> tuple[str, ...]:
    """The word's elements in each part: equal strings for equal sets of elements."""
    out = [""] * PARTS
    letters = sorted(word)
    nth = 0
    for i, c in enumerate(letters):
        nth = nth + 1 if i and c == letters[i - 1] else 0
        out[_part((c, nth))] += c
    return tuple(out)


def signatures(parts: tuple[str, ...]) -> list[int]:
    """One 64-bit signature for each choice of parts."""
    return [xxhash.xxh3_64_intdigest("\x00".join([parts[p] for p in choice]), seed=i) for i, choice in enumerate(CHOICES)]


def masked(word: str) -> list[str]:
    return [word[:i] + MASK + word[i + 1 :] for i in range(len(word))]


def shortened(word: str) -> set[str]:
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


class _Group:
    """Words that share a signature, and what is known of each word's partners."""

    def __init__(self, choice: int, words: list[str], counts: list[int]):
        self.choice, self.words, self.counts = choice, words, counts
        self.parts: dict[int, tuple[str, ...]] = {}
        self.found: dict[int, list] = {}

    def _projected(self, i: int) -> tuple[str, ...]:
        if i not in self.parts:
            self.parts[i] = projections(self.words[i])
        return self.parts[i]

    def meet(self, i: int, j: int) -> None:
        """Count a near pair if this is the first signature it shares."""
        a, b = self._projected(i), self._projected(j)
        first = next(k for k, choice in enumerate(CHOICES) if all(a[p] == b[p] for p in choice))
        if first != self.choice:
            return
        for x, y in ((i, j), (j, i)):
            best = (-self.counts[y], self.words[y])
            mine = self.found.setdefault(x, [0, best])
            mine[0] += 1
            mine[1] = min(mine[1], best)

    def rows(self) -> list[tuple[str, int, int, str]]:
        return [(self.words[i], near, -best[0], best[1]) for i, (near, best) in self.found.items()]


def near_in_group(choice: int, words: list[str], counts: list[int]) -> list[tuple[str, int, int, str]]:
    """(word, n_near, best_n, best): verified partners within a signature's group."""
    group = _Group(choice, words, counts)
    place = {w: i for i, w in enumerate(words)}
    alike: dict[str, list[int]] = {}
    for i, word in enumerate(words):
        for form in masked(word):
            alike.setdefault(form, []).append(i)
        for form in shortened(word):
            if form in place:
                group.meet(i, place[form])
    for same in alike.values():
        # one per letter of the alphabet at most
        for i, j in itertools.combinations(same, 2):
            group.meet(i, j)
    return group.rows()


def _near_in_cell(key: tuple, columns: dict[str, np.ndarray]) -> list[tuple[str, int, int, str]]:
    """The same within one masked or shortened form of a crowded signature."""
    words, counts, whole = columns["word"].tolist(), columns["n"].tolist(), columns["whole"].tolist()
    group = _Group(key[1], words, counts)
    if columns["mask"][0]:
        for i, j in itertools.combinations(range(len(words)), 2):
            group.meet(i, j)
    else:
        for i in (x for x, w in enumerate(whole) if w):
            for j in (x for x, w in enumerate(whole) if not w):
                group.meet(i, j)
    return group.rows()


def _near_in_signature(key: tuple, columns: dict[str, np.ndarray]) -> list[tuple[str, int, int, str]]:
    return near_in_group(key[1], columns["word"].tolist(), columns["n"].tolist())


def _signed(words: DataFrame) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            signs = np.array([signatures(projections(w)) for w in names], np.uint64).reshape(len(names), len(CHOICES))
            each = pa.array(np.repeat(np.arange(len(names)), len(CHOICES)))
            yield pa.record_batch(
                [
                    pa.array(signs.ravel().view(np.int64)),
                    pa.array(np.tile(np.arange(len(CHOICES), dtype=np.int32), len(names))),
                    batch.column(0).take(each),
                    batch.column(1).take(each),
                ],
                ["sign", "choice", "word", "n"],
            )

    return words.mapInArrow(sign, "sign bigint, choice int, word string, n bigint")


def _forms(signed: DataFrame) -> DataFrame:
    """Rows of crowded signatures, once for each form a partner may share; ``form`` is its hash."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                word = row["word"]
                forms = [(f, True, False) for f in masked(word)] + [(word, False, True)]
                forms += [(f, False, False) for f in shortened(word)]
                out = [
                    row | {"form": xxhash.xxh3_64_intdigest(f) - (1 << 63), "mask": m, "whole": w} for f, m, w in forms
                ]
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema(
        [("sign", pa.int64()), ("choice", pa.int32()), ("word", pa.string()), ("n", pa.int64())]
        + [("form", pa.int64()), ("mask", pa.bool_()), ("whole", pa.bool_())]
    )
    return signed.mapInArrow(
        spread, "sign bigint, choice int, word string, n bigint, form bigint, mask boolean, whole boolean"
    )


def near_words(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(word, n_near, best_n, best) of every word of (word, n) that has near words.

    ``best`` is the near word of largest ``n``, the first in code-point order among equals.
    """
    schema = "word string, n_near bigint, best_n bigint, best string"
    signed = written(_signed(words), "signed")
    sizes = signed.groupBy("sign", "choice").agg(F.count(F.lit(1)).alias("size"))
    hot = written(sizes.where(F.col("size") > crowded).drop("size"), "crowded")
    cold, cells = signed, None
    if not hot.isEmpty():
        cold = signed.join(hot, ["sign", "choice"], "left_anti")
        cells = _forms(signed.join(hot, ["sign", "choice"], "left_semi"))
    found = map_groups(cold, ["sign", "choice"], _near_in_signature, schema)
    if cells is not None:
        found = found.unionAll(map_groups(cells, ["sign", "choice", "form"], _near_in_cell, schema))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top"))
    return found.select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, root) of one step: each round doubles the steps taken.

    A form occurs at least twice as often as its word, so chains are short and end.
    """
    while True:
        up = forms.select(F.col("word").alias("root"), F.col("root").alias("above"))
        further = forms.join(up, "root", "left").select(
            "word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")
        )
        further = written(further, "roots")
        forms = further.select("word", "root")
        if further.where("moved").isEmpty():
            return forms


def spelling_variants(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    deletions: int = 199,
    least_length: int = 6,
    least_n: int = 5,
    factor: int = 5,
    crowded: int = CROWDED,
) -> DataFrame:
    """Words with their form: the most frequent near word, if at least ``factor`` times as frequent.

    Returns (word, form, root, n, n_near, form_n); ``root`` is where following forms ends.
    """
    if factor < 2:
        raise ValueError("a form is at least twice as frequent as its word")
    words = written(counted_words(docs, text, id_col, deletions, least_length, least_n), "words")
    best = near_words(words, crowded)
    taken = F.col("best_n") >= factor * F.col("n")
    rows = words.join(best, "word", "left").select(
        "word",
        F.when(taken, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("best_n")).alias("form_n"),
    )
    rows = written(rows, "forms")
    roots = _roots(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
