"""Language identification by compression.

Each language gets a zstandard dictionary of raw content, made of text sampled
from its documents. A text is encoded with every dictionary; the language whose
dictionary gives the fewest bytes is the answer, and it is rejected when the
runner-up is almost as small.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgauge.llm.frames import filter_rows, map_batches, sample_per_class

SAMPLES = 256  # documents a language is learned from, at most
SAMPLE_CHARS = 512  # from each, at a place given by its hash
BLOCK_CHARS = 1024  # encoded apart, so that a long text cannot become its own dictionary
LEVEL = 5
FRAME = " " * 64  # around each block: without it a short text would be stored as it is, by any dictionary
MIN_MARGIN = 0.002  # of the runner-up's bytes
UNDECIDED = "und"
_OTHER = re.compile(r"[\W\d_]+")


def letters_of(text: str | None) -> str:
    """What is encoded: lower-case letters (category L), all else as single spaces."""
    found = _OTHER.sub(" ", (text or "").lower())
    if not found.replace(" ", "a").isalpha():  # numerals that are no decimal digits, as in one half
        found = " ".join("".join(c if c.isalpha() else " " for c in found).split())
    return found.strip()


def learn_dictionaries(docs: DataFrame, text_col: str, lang_col: str, order_col: str) -> dict[str, bytes]:
    """Raw content per language from a bounded sample: SAMPLES x SAMPLE_CHARS code points each."""
    # the language is a key here, so its nulls are not looked at
    named = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(order_col).alias("key"))
    named = named.where("lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0")
    picked = sample_per_class(named, "lang", F.xxhash64("key"), SAMPLES)
    room = F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS + 1)
    place = (F.pmod(F.xxhash64("_order", F.lit(1)), room.cast("bigint")) + 1).cast("int")
    picked = picked.select("lang", "_order", F.substring("text", place, F.lit(SAMPLE_CHARS)).alias("text"))
    picked = picked.dropDuplicates(["lang", "_order"])
    parts: dict[str, list] = {}
    for row in picked.collect():
        parts.setdefault(row.lang, []).append((row["_order"], row.text))
    content = {lang: " ".join(letters_of(t) for _, t in sorted(rows)) for lang, rows in sorted(parts.items())}
    return {lang: text.encode() for lang, text in content.items() if len(text.encode()) >= 8}


class Encoders:
    """One compressor per language."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.compressors = []
        for lang in self.langs:
            raw = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False)
            )

    def sizes(self, letters: str) -> list[int]:
        blocks = [f"{FRAME}{letters[i : i + BLOCK_CHARS]}{FRAME}".encode() for i in range(0, len(letters), BLOCK_CHARS)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.compressors]

    def predict(self, text: str | None, min_margin: float) -> tuple[str, float, float, bool]:
        """(language, score, margin, rejected)."""
        letters = letters_of(text)
        if not letters or not self.langs:
            return UNDECIDED, 0.0, 0.0, True
        sizes = self.sizes(letters)
        best = min(range(len(sizes)), key=lambda i: (sizes[i], self.langs[i]))
        others = [s for i, s in enumerate(sizes) if i != best]
        margin = 1.0 - sizes[best] / min(others) if others else 1.0
        score = 1.0 / (1.0 + sum(math.exp((sizes[best] - s) / 4.0) for s in others))
        return self.langs[best], score, margin, margin < min_margin


def _predict(dictionaries: dict[str, bytes], min_margin: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoders = Encoders(dictionaries)
        for pdf in batches:
            found = [encoders.predict(t, min_margin) for t in pdf.pop("text")]
            yield pdf.assign(
                lang_pred=[f[0] for f in found],
                score=[f[1] for f in found],
                margin=[f[2] for f in found],
                rejected=[f[3] for f in found],
            )

    return run


def identify_language(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    id_col: str = "doc_id",
    text_col: str = "text",
    min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """(id, lang_pred, score, margin, rejected) per row, from the whole text alone.

    ``score`` weighs the code lengths of all languages (0 to 1), ``margin`` is the
    share of bytes saved against the runner-up; below ``min_margin`` the row is
    rejected, though its language is still named. A text that is null or has no
    letter is ``und`` with score 0 and rejected, as is everything when nothing was
    learned. Of equal sizes the first language in code-point order wins. Rows are
    kept as they come, repeated ones too; null ids stay null; an empty table gives
    an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    schema = "id bigint, lang_pred string, score double, margin double, rejected boolean"
    return map_batches(rows, _predict(dictionaries, min_margin), schema).withColumnRenamed("id", id_col)


def keep_identified(
    docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", min_margin: float = MIN_MARGIN
) -> DataFrame:
    """The rows that ``identify_language`` does not reject, with all their columns."""

    def start():
        encoders = Encoders(dictionaries)
        return lambda texts: [not encoders.predict(t, min_margin)[3] for t in texts]

    return filter_rows(docs, [text_col], start)
