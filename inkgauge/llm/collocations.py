"""Phrase collocations: phrases counted in HAT-tries and scored by their weakest cut.

Texts are lower-cased (A-Z only), split at sentence marks and line ends into pieces,
these at spaces and tabs into words. Each task counts phrases in a HAT-trie over word
ids: FAN hash containers share the first words among them; one that grows beyond BURST
phrases bursts into a trie node with a container for each first word, which may burst
in turn, so only the crowded top is a trie. When a task holds more than ENTRIES
phrases, its largest subtrees are passed on whole until half is free: as runs, sorted,
packed and compressed, one for each prefix partition, that is for a hash of language
and first two words (salted by the rest, since some prefixes are very frequent). The
runs of a prefix partition meet in one task, which merges them partition by partition.

A phrase of at least ``least`` occurrences consists of parts that occur as often. So
words are counted first, then pairs of frequent words, then longer phrases all of
whose pairs are frequent. Frequent words and pairs are told to the tasks by a filter
of FILTER_BITS hashed bits, a size that does not grow; where the filter errs, a phrase
too many is counted, never one too few. Rows with null text hold no words; a null
language is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkgauge.llm.frames import written
from inkgauge.llm.shingles import mix
from inkgauge.session import ship_package

FAN = 256  # containers a trie begins with
BURST = 4096  # phrases of a container
ENTRIES = 500_000  # phrases a task holds, over all languages, before subtrees leave it
WORDS = 500_000  # word ids a task holds, likewise, before it starts a language anew
MERGED = 1_000_000  # rows of runs a task holds before it sums them up
FILTER_BITS = 1 << 26
CHUNK = 1 << 22  # bytes of text split into words at once
SALTS = 16
LONGEST = 4
_ID = 4  # bytes of a word id in a key
_MARK = b"."  # every mark and line end becomes this one
_FOLD = bytes(46 if c in b".,;:!?\x0a\x0b\x0c\x0d" else c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Node:
    """A burst container: counts of the phrases that end at each next word, and what is below."""

    __slots__ = ("ends", "below")

    def __init__(self, container: dict[bytes, int]) -> None:
        self.ends: dict[bytes, int] = {}
        self.below: dict[bytes, Node | dict[bytes, int]] = {}
        for key, n in container.items():
            if len(key) == _ID:
                self.ends[key] = n
            else:
                self.below.setdefault(key[:_ID], {})[key[_ID:]] = n

    def add(self, key: bytes, n: int, burst: int) -> bool:
        """Count a phrase; whether it is new."""
        node, at = self, 0
        while True:
            step, at = key[at : at + _ID], at + _ID
            if at == len(key):
                known = node.ends.get(step)
                node.ends[step] = n if known is None else known + n
                return known is None
            below = node.below.setdefault(step, {})
            if type(below) is Node:
                node = below
                continue
            rest = key[at:]
            known = below.get(rest)
            below[rest] = n if known is None else known + n
            if len(below) > burst:
                node.below[step] = Node(below)
            return known is None


def entries(node: Node | dict[bytes, int]) -> tuple[list[bytes], list[int]]:
    """All phrases below a node and their counts."""
    keys, counts, stack = [], [], [(node, b"")]
    while stack:
        node, prefix = stack.pop()
        if type(node) is Node:
            stack += [(below, prefix + step) for step, below in node.below.items()]
            node = node.ends
        keys += [prefix + k for k in node] if prefix else node
        counts += node.values()
    return keys, counts


class HatTrie:
    """Counts of word-id sequences, packed with _ID big-endian bytes a word."""

    def __init__(self, burst: int = BURST):
        self.burst, self.size = burst, 0
        self.root: list[Node | dict[bytes, int]] = [{} for _ in range(FAN)]
        self.held = [0] * FAN  # phrases below each of them

    def add(self, keys: list[bytes], counts: list[int]) -> None:
        root, held, burst = self.root, self.held, self.burst
        last = _ID - 1
        for key, n in zip(keys, counts, strict=True):
            slot = key[last]
            node = root[slot]
            if type(node) is dict:
                known = node.get(key)
                if known is not None:
                    node[key] = known + n
                    continue
                node[key] = n
                held[slot] += 1
                if len(node) > burst:
                    root[slot] = Node(node)
            else:
                held[slot] += node.add(key, n, burst)
        self.size = sum(held)

    def spill(self, rest: int) -> Iterator[tuple[list[bytes], list[int]]]:
        """Hand over whole subtrees, the largest first, until at most ``rest`` phrases are left."""
        for slot in sorted(range(FAN), key=self.held.__getitem__, reverse=True):
            if self.size <= rest:
                return
            node, self.root[slot] = self.root[slot], {}
            self.size -= self.held[slot]
            self.held[slot] = 0
            yield entries(node)


class _Ids(dict):
    """Word ids from 1 in order of appearance; 0 stands for the end of a piece."""

    def __init__(self, seed: int):
        super().__init__({_MARK: 0})
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found

    def hashes(self, known: np.ndarray) -> np.ndarray:
        """64-bit hashes of all words by id; ``known`` are those of the first ids."""
        if len(known) == len(self):
            return known
        words = list(self)[len(known) :]
        fresh = [xxhash.xxh3_64_intdigest(w, self.seed) for w in words]
        return np.concatenate([known, np.array(fresh, np.uint64)])


def lang_seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def filter_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """Bits of phrases given by the hashes of their words, place by place."""
    found = hashes[0]
    for h in hashes[1:]:
        found = mix(found * _STEP + h)
    return mix(found) % np.uint64(FILTER_BITS)


def chunks(raw: bytes) -> Iterator[bytes]:
    """A text in parts of about CHUNK bytes, cut between words only."""
    at = 0
    while len(raw) - at > CHUNK:
        cut = at + CHUNK
        while cut < len(raw) and raw[cut] not in b" \t" + _MARK:
            cut += 1
        yield raw[at:cut]
        at = cut
    yield raw[at:]


class PhraseCounter:
    """Counts of the phrases of one task, of one language."""

    def __init__(self, lang: str, lengths: tuple[int, ...], passes: np.ndarray | None, partitions: int):
        self.lang, self.lengths, self.passes, self.partitions = lang, lengths, passes, partitions
        self.trie = HatTrie()
        self.packer = zstandard.ZstdCompressor(level=1)
        self._anew()

    def _anew(self) -> None:
        self.ids = _Ids(lang_seed(self.lang))
        self.hashes = np.empty(0, np.uint64)

    def _allowed(self, ids: np.ndarray, length: int) -> np.ndarray:
        """Whether the word or pair that starts at each place is known as frequent."""
        self.hashes = self.ids.hashes(self.hashes)
        bits = filter_bits([self.hashes[ids[i : len(ids) - length + 1 + i]] for i in range(length)])
        return (self.passes[bits >> np.uint64(6)] >> (bits & np.uint64(63))) & np.uint64(1) > 0

    def count(self, raw: bytes, before: np.ndarray) -> np.ndarray:
        """Count phrases that end in ``raw``, ``before`` being the ids just before it.

        ``raw`` is folded. Returns the last ids, for the part of the text that follows.
        """
        words = raw.replace(_MARK, b" . ").split()
        ids = np.concatenate([before, np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))])
        old = len(before)
        if self.lengths == (1,):
            found = np.bincount(ids[old:], minlength=1)
            at = np.flatnonzero(found)
            self._add(at[at > 0][:, None], found[at[at > 0]])
            return ids[len(ids) :]
        if len(ids) >= 2:
            self._longer(ids, old)
        return ids[-(LONGEST - 1) :]

    def _longer(self, ids: np.ndarray, old: int) -> None:
        inside = ids > 0
        runs = inside[:-1] & inside[1:]
        if self.lengths == (2,):
            frequent = self._allowed(ids, 1)
            runs &= frequent[:-1] & frequent[1:]
        else:
            runs &= self._allowed(ids, 2)
        width = np.int64(len(self.ids) + 1)
        at = np.flatnonzero(runs)  # places where a phrase of the present length starts
        keys, code = np.unique(ids[at] * width + ids[at + 1], return_inverse=True)
        table = np.column_stack([keys // width, keys % width])
        for length in range(2, max(self.lengths) + 1):
            if length > 2:
                # a phrase goes on where the next pair is a run too
                on = np.flatnonzero(runs[np.minimum(at + length - 2, len(runs) - 1)] & (at + length - 1 < len(ids)))
                keys, again = np.unique(code[on] * width + ids[at[on] + length - 1], return_inverse=True)
                table = np.column_stack([table[keys // width], keys % width])
                at, code = at[on], again
            if length in self.lengths and len(at):
                fresh = at + length - 1 >= old
                n = np.bincount(code[fresh], minlength=len(table))
                self._add(table[n > 0], n[n > 0])

    def _add(self, table: np.ndarray, counts: np.ndarray) -> None:
        keys = np.ascontiguousarray(table.astype(">u4")).view(f"V{table.shape[1] * _ID}").ravel().tolist()
        self.trie.add(keys, counts.tolist())

    def anew(self) -> Iterator[pa.RecordBatch]:
        """Hand over everything and forget the words."""
        yield from self.runs(0)
        self._anew()

    def _prefix_partition(self, table: np.ndarray) -> np.ndarray:
        found = self.hashes[table[:, 0]]
        if table.shape[1] > 1:
            found = mix(found * _STEP + self.hashes[table[:, 1]])
        if table.shape[1] > 2:
            rest = self.hashes[table[:, 2]]
            for k in range(3, table.shape[1]):
                rest = mix(rest * _STEP + self.hashes[table[:, k]])
            found = found * _STEP + mix(rest) % np.uint64(SALTS)
        return (mix(found) % np.uint64(self.partitions)).astype(np.int32)

    def runs(self, rest: int) -> Iterator[pa.RecordBatch]:
        """Runs of the subtrees that leave the trie: sorted phrases by prefix partition and length."""
        by_length: dict[int, tuple[list[bytes], list[int]]] = {}
        for keys, counts in self.trie.spill(rest):
            if len(self.lengths) == 1:
                parts = {self.lengths[0]: (keys, counts)}
            else:
                parts = {}
                for key, n in zip(keys, counts, strict=True):
                    found = parts.setdefault(len(key) // _ID, ([], []))
                    found[0].append(key)
                    found[1].append(n)
            for length, found in parts.items():
                held = by_length.setdefault(length, ([], []))
                held[0].extend(found[0])
                held[1].extend(found[1])
        if not any(keys for keys, _ in by_length.values()):
            return
        self.hashes = self.ids.hashes(self.hashes)
        words = pa.array(list(self.ids), pa.binary())
        rank = np.empty(len(words), np.int64)
        rank[pc.array_sort_indices(words).to_numpy()] = np.arange(len(words))
        for length, (keys, counts) in by_length.items():
            if keys:
                table = np.frombuffer(b"".join(keys), ">u4").reshape(-1, length).astype(np.int64)
                yield from self._packed(table, np.array(counts, np.int64), words, rank)

    def _packed(self, table: np.ndarray, counts: np.ndarray, words: pa.Array, rank: np.ndarray) -> Iterator[pa.RecordBatch]:
        length = table.shape[1]
        part = self._prefix_partition(table)
        order = np.lexsort([*(rank[table[:, k]] for k in reversed(range(length))), part])
        table, counts, part = table[order], counts[order], part[order]
        phrases = pc.binary_join_element_wise(*(words.take(pa.array(table[:, k])) for k in range(length)), b" ")
        offsets = np.frombuffer(phrases.buffers()[1], np.int32, len(phrases) + 1)
        values = memoryview(phrases.buffers()[2]) if phrases.buffers()[2] else b""
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        runs = []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)], strict=True):
            sizes = np.diff(offsets[a : b + 1])
            raw = b"".join([(b - a).to_bytes(4, "little"), sizes.tobytes(), counts[a:b].tobytes(), values[offsets[a] : offsets[b]]])
            runs.append(self.packer.compress(raw))
        n = len(runs)
        columns = [pa.array(part[starts]), pa.array([self.lang] * n, pa.string()), pa.array([length] * n, pa.int32())]
        yield pa.record_batch([*columns, pa.array(runs, pa.binary())], RUN_COLUMNS)


RUN_COLUMNS = ["part", "lang", "words", "run"]


def unpacked(run: bytes) -> pa.Table:
    """(phrase, n) of a run."""
    raw = zstandard.decompress(run)
    n = int.from_bytes(raw[:4], "little")
    offsets = np.zeros(n + 1, np.int32)
    np.cumsum(np.frombuffer(raw, np.int32, n, 4), out=offsets[1:])
    counts = np.frombuffer(raw, np.int64, n, 4 + 4 * n)
    phrases = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw[4 + 12 * n :])])
    return pa.table([phrases, pa.array(counts)], ["phrase", "n"])


def merged(rows: Iterator[tuple[int, str, int, bytes]], least: int) -> Iterator[pa.RecordBatch]:
    """Phrases with f >= ``least`` of runs in order of (part, lang, words).

    Where words are counted, a row of length 0 adds the occurrences of all of them.
    """

    def summed(tables: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(tables).group_by("phrase", use_threads=False).aggregate([("n", "sum")])
        return found.select(["phrase", "n_sum"]).rename_columns(["phrase", "n"])

    def batch(lang: str, words: int, phrases: pa.Array, counts: pa.Array) -> pa.RecordBatch:
        n = len(phrases)
        columns = [pa.array([lang] * n, pa.string()), phrases, pa.array([words] * n, pa.int32()), counts]
        return pa.record_batch(columns, ["lang", "phrase", "words", "f"])

    def finished(lang: str, words: int, tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        found = summed(tables).combine_chunks()
        if words == 1:
            yield batch(lang, 0, pa.array([""]), pa.array([pc.sum(found["n"]).as_py()], pa.int64()))
        kept = found.filter(pc.greater_equal(found["n"], least)).combine_chunks()
        for part in kept.to_batches():
            yield batch(lang, words, part.column(0), part.column(1))

    at, held = None, []
    for part, lang, words, run in rows:
        if (part, lang, words) != at:
            if held:
                yield from finished(at[1], at[2], held)
            at, held = (part, lang, words), []
        held.append(unpacked(run))
        if sum(map(len, held)) > MERGED and len(held) > 1:
            held = [summed(held)]
    if held:
        yield from finished(at[1], at[2], held)


def relieve(counters: dict[str, PhraseCounter], forget: bool) -> Iterator[pa.RecordBatch]:
    """Runs that leave because the languages of a task hold too much."""
    while sum(c.trie.size for c in counters.values()) > ENTRIES:
        largest = max(counters.values(), key=lambda c: c.trie.size)
        yield from largest.runs(largest.trie.size // 2)
    while forget and sum(len(c.ids) - 1 for c in counters.values()) > WORDS:
        yield from max(counters.values(), key=lambda c: len(c.ids)).anew()


def count_phrases(docs: DataFrame, lengths: tuple[int, ...], least: int, passes: np.ndarray | None = None) -> DataFrame:
    """(lang, phrase, words, f): phrases of ``lengths`` words in (lang, text) with f >= ``least``.

    ``passes``: the filter of frequent words (lengths 2) or frequent pairs (above).
    Where words are counted, rows of length 0 hold the occurrences of all words.
    """
    spark = docs.sparkSession
    ship_package(spark)
    told = spark.sparkContext.broadcast(passes)  # FILTER_BITS / 8 bytes
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, PhraseCounter] = {}
        none = np.empty(0, np.int64)
        for batch in batches:
            texts: dict[str, list[bytes]] = {}
            sizes: dict[str, int] = {}
            for i in range(len(batch)):  # texts leave the Arrow batch one by one
                lang, raw = batch.column(0)[i].as_py(), batch.column(1)[i].as_py().translate(_FOLD)
                if lang not in counters:
                    counters[lang] = PhraseCounter(lang, lengths, told.value, 2 * tasks)
                if len(raw) > CHUNK:
                    before = none
                    for part in chunks(raw):
                        before = counters[lang].count(part, before)
                        yield from relieve(counters, forget=False)  # the next part needs the ids
                    yield from relieve(counters, forget=True)
                    continue
                texts.setdefault(lang, []).append(raw)
                sizes[lang] = sizes.get(lang, 0) + len(raw)
                if sizes[lang] > CHUNK:
                    counters[lang].count(_MARK.join(texts.pop(lang)), none)
                    sizes[lang] = 0
                    yield from relieve(counters, forget=True)
            for lang, rest in texts.items():
                counters[lang].count(_MARK.join(rest), none)
                yield from relieve(counters, forget=True)
        for counter in counters.values():
            yield from counter.runs(0)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = (batch.columns for batch in batches)
        rows = (tuple(c[i].as_py() for c in found) for found in columns for i in range(len(found[0])))
        return merged(rows, least)

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    runs = rows.where("text IS NOT NULL").mapInArrow(run, "part int, lang string, words int, run binary")
    dealt = runs.repartition("part").sortWithinPartitions("part", "lang", "words")
    return dealt.mapInArrow(merge, "lang string, phrase string, words int, f bigint")


def frequent_filter(frequent: DataFrame) -> np.ndarray:
    """The filter of (lang, phrase): FILTER_BITS bits, whatever the number of phrases."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, phrases = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            seeds = {lang: lang_seed(lang) for lang in set(langs)}
            split = [p.split(b" ") for p in phrases]
            hashes = [
                np.array([xxhash.xxh3_64_intdigest(w[k], seeds[lang]) for lang, w in zip(langs, split, strict=True)], np.uint64)
                for k in range(len(split[0]) if split else 0)
            ]
            at = filter_bits(hashes) if hashes else np.empty(0, np.uint64)
            slots = (at >> np.uint64(6)).astype(np.int32)
            set_bits = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            yield pa.record_batch([pa.array(slots), pa.array(set_bits)], ["slot", "bits"])

    found = frequent.select("lang", "phrase").mapInArrow(bits, "slot int, bits bigint")
    slots = found.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()  # FILTER_BITS / 64 rows at most
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[slots["slot"].to_numpy()] = slots["bits"].to_numpy().view(np.uint64)
    return out


def frequent_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to 4 words with f >= ``least`` as (lang, phrase, words, f), and (lang, n) over all words."""
    words = written(count_phrases(docs, (1,), least), "frequent")
    totals = words.where("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    levels = [words.where("words = 1")]
    for lengths in ((2,), (3, 4)):
        passes = frequent_filter(levels[-1])
        levels.append(written(count_phrases(docs, lengths, least, passes), "frequent"))
    return levels[0].unionAll(levels[1]).unionAll(levels[2]), totals


def _scored(phrases: DataFrame, scale: int) -> DataFrame:
    """Candidates with the cut that scores lowest: (lang, phrase, words, a, l, r, score)."""
    count = phrases.select("lang", F.col("phrase").alias("part"), "f")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = phrases.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), cut)
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("right", F.expr("substring_index(phrase, ' ', k - words)"))
    for side, name in (("left", "l"), ("right", "r")):
        parts = count.select("lang", F.col("part").alias(side), F.col("f").alias(name))
        cuts = cuts.join(parts, ["lang", side])
    # decimals: the product may pass 64 bits
    score = F.expr(f"CAST(a AS DECIMAL(20, 0)) * {scale}BD div (CAST(l AS DECIMAL(20, 0)) + r)").cast("bigint")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low")
    return cuts.groupBy("lang", "phrase", "words", "a").agg(lowest).select("lang", "phrase", "words", "a", "low.*").drop("k")


def _covering(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the largest f of the longer candidates that hold a phrase."""
    parts = F.split("phrase", " ")
    spans = F.expr(
        "flatten(transform(sequence(2, words - 1), n -> "
        "transform(sequence(1, words - n + 1), i -> array_join(slice(parts, i, n), ' '))))"
    )
    inner = phrases.where("words > 2").select("lang", "words", "f", parts.alias("parts"))
    inner = inner.select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "f")
    return inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, least: int = 30, scale: int = 2_000_000, covered: int = 80, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    A phrase scores ``scale * a / (l + r)``, rounded down, at its lowest cut. One that
    a longer candidate holds with at least ``covered`` percent of its count is left out.
    """
    phrases, totals = frequent_phrases(docs.select("lang", "text"), least)
    scored = _scored(phrases, scale)
    kept = scored.join(_covering(phrases), ["lang", "phrase"], "left")
    wide = "DECIMAL(20, 0)"
    kept = kept.where(
        F.col("longer").isNull() | F.expr(f"CAST(longer AS {wide}) * 100BD < CAST(a AS {wide}) * {covered}BD")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint"), "phrase", "a", "l", "r", "n", "score"
    )
