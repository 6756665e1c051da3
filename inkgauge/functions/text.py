"""Text measures as column expressions (evaluated in the JVM, no Python per row).

Two kinds of word are kept apart: *space words* are runs of non-whitespace,
*regex words* are runs of letters, numerals and underscore. "don't" is one space
word and two regex words.

Every measure is null for null text. Counting is done by scanning for the
counted thing itself (one linear regex pass) rather than by splitting and
filtering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkgauge.schema import NUMERIC_COLS

# Character classes. Letters, all numerals and underscore make a
# word; whitespace is every Unicode space, which is more than Java's own \s.
# Control characters are listed singly and the rest is one category: the regex
# engine then tests a bit set and a category per character, instead of a chain
# of ranges (ten times slower).
WORD_CLASS = r"\p{L}\p{N}_"
SPACE_CLASS = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\p{Z}"

SPACE_WORD = f"[^{SPACE_CLASS}]+"
REGEX_WORD = f"[{WORD_CLASS}]+"
NOT_BLANK = f"[^{SPACE_CLASS}]"
# A sentence starts at its first visible character and runs to the next
# terminator, so the number of matches is the number of non-blank pieces.
SENTENCE = f"[^.!?{SPACE_CLASS}][^.!?]*"
PARAGRAPH_BREAK = f"\\n[{SPACE_CLASS}]*\\n"
# A final e after a consonant other than l is silent. Looking for the e first is
# faster than looking behind at every position.
SILENT_E = f"e(?![{WORD_CLASS}])(?<=[{WORD_CLASS}&&[^aeiouyl]]e)"
SYLLABLE = f"[aeiouy]+[{WORD_CLASS}&&[^aeiouy]]*"


def _col(text: str | Column) -> Column:
    return F.col(text) if isinstance(text, str) else text


def _matches(text: Column, pattern: str) -> Column:
    return F.array_size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def _ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 where whole is 0, null where the text was null."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.try_divide(part, whole))


def space_words(text: str | Column) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(SPACE_WORD), F.lit(0))


def regex_words(text: str | Column) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(REGEX_WORD), F.lit(0))


def has_content(text: str | Column) -> Column:
    """Text is neither null nor whitespace only."""
    return F.coalesce(F.rlike(_col(text), F.lit(NOT_BLANK)), F.lit(False))


def ws_word_count(text: str | Column) -> Column:
    return _matches(_col(text), SPACE_WORD)


def word_count(text: str | Column) -> Column:
    return _matches(_col(text), REGEX_WORD)


def character_count(text: str | Column) -> Column:
    return F.length(_col(text))


def byte_length(text: str | Column) -> Column:
    return F.octet_length(_col(text))


def sentence_count(text: str | Column) -> Column:
    return _matches(_col(text), SENTENCE)


def paragraph_count(text: str | Column) -> Column:
    """Non-blank pieces between blank lines. Only telling before chunking, which joins lines."""
    pieces = F.split(_col(text), PARAGRAPH_BREAK)
    return F.array_size(F.filter(pieces, has_content)).cast("double")


def words_per_sentence(text: str | Column) -> Column:
    """Null where there is no sentence."""
    return F.try_divide(word_count(text), sentence_count(text))


def words_per_paragraph(text: str | Column) -> Column:
    """Null where there is no paragraph."""
    return F.try_divide(word_count(text), paragraph_count(text))


def _syllable_marks(lowered: Column) -> Column:
    """Lower-cased text with one ``a`` per spoken vowel group and no other vowel.

    Dropping silent e first makes the vowel groups left in a word its syllables.
    """
    return F.regexp_replace(F.regexp_replace(lowered, SILENT_E, ""), SYLLABLE, "a")


def _syllables(marks: Column, lowered_words: Column) -> Column:
    """Marks plus one for every word without a mark (a word has a syllable at least)."""
    total = F.length(marks) - F.length(F.replace(marks, F.lit("a"), F.lit("")))
    return total + lowered_words - _matches(marks, "a+")


def _complex_words(marks: Column) -> Column:
    return _matches(marks, "a{3,}")


def syllable_count(text: str | Column) -> Column:
    lowered = F.lower(_col(text))
    return _syllables(_syllable_marks(lowered), word_count(lowered)).cast("double")


def syllables_per_word(text: str | Column) -> Column:
    """Null where there is no word."""
    return F.try_divide(syllable_count(text), word_count(text))


def lexical_diversity(text: str | Column) -> Column:
    words = regex_words(F.lower(_col(text)))
    return _ratio(F.array_size(F.array_distinct(words)), F.array_size(words))


def avg_sentence_length(text: str | Column) -> Column:
    return _ratio(word_count(text), sentence_count(text))


def avg_word_length(text: str | Column) -> Column:
    letters = F.length(F.regexp_replace(_col(text), f"[^{WORD_CLASS}]+", ""))
    return _ratio(letters, word_count(text))


def _fog(words: Column, sentences: Column, complex_words: Column) -> Column:
    """Gunning (1952)."""
    score = 0.4 * (
        F.try_divide(words, sentences) + 100.0 * F.try_divide(complex_words, words)
    )
    return F.when(words == 0, F.lit(0.0)).otherwise(score)


def _flesch(words: Column, sentences: Column, syllables: Column) -> Column:
    """Flesch (1948)."""
    score = (
        206.835 - 1.015 * F.try_divide(words, sentences) - 84.6 * F.try_divide(syllables, words)
    )
    return F.when(words == 0, F.lit(0.0)).otherwise(score)


def gunning_fog(text: str | Column) -> Column:
    marks = _syllable_marks(F.lower(_col(text)))
    return _fog(word_count(text), sentence_count(text), _complex_words(marks))


def flesch_reading_ease(text: str | Column) -> Column:
    return _flesch(word_count(text), sentence_count(text), syllable_count(text))


def punctuation_ratio(text: str | Column) -> Column:
    marks = F.regexp_replace(_col(text), f"[{WORD_CLASS}{SPACE_CLASS}]+", "")
    return _ratio(F.length(marks), F.length(_col(text)))


def _measured(df: DataFrame, text: str) -> DataFrame:
    """Add the counts all measures derive from, each from one pass over the text."""
    return (
        df.withColumns(
            {
                "_words": word_count(text),
                "_sentences": sentence_count(text),
                # what is left between words: punctuation and whitespace
                "_between": F.regexp_replace(F.col(text), REGEX_WORD, ""),
                "_lowered_words": regex_words(F.lower(F.col(text))),
                "_marks": _syllable_marks(F.lower(F.col(text))),
            }
        )
        .withColumns(
            {
                "_chars": F.length(text),
                "_letters": F.length(text) - F.length("_between"),
                "_puncts": F.length(F.regexp_replace("_between", f"[{SPACE_CLASS}]+", "")),
                "_lowered": F.array_size("_lowered_words"),
                "_distinct": F.array_size(F.array_distinct("_lowered_words")),
                "_complex": _complex_words(F.col("_marks")),
            }
        )
        .withColumn("_syllables", _syllables(F.col("_marks"), F.col("_lowered")).cast("double"))
    )


def _bundle() -> dict[str, Column]:
    c = F.col
    return {
        "word_count": c("_words"),
        "character_count": c("_chars"),
        "lexical_diversity": _ratio(c("_distinct"), c("_lowered")),
        "avg_sentence_length": _ratio(c("_words"), c("_sentences")),
        "avg_word_length": _ratio(c("_letters"), c("_words")),
        "flesch_reading_ease": _flesch(c("_words"), c("_sentences"), c("_syllables")),
        "gunning_fog_index": _fog(c("_words"), c("_sentences"), c("_complex")),
        "punctuation_ratio": _ratio(c("_puncts"), c("_chars")),
    }


def text_features(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus the eight numeric features, in their fixed order."""
    bundle = _bundle()
    return _measured(df, text).select(
        *df.columns, *(bundle[name].alias(name) for name in NUMERIC_COLS)
    )


def style_vector(df: DataFrame, text: str = "text", out: str = "style") -> DataFrame:
    """``df`` plus the alternative vector of eight style measures."""
    c = F.col
    bundle = _bundle()
    vector = F.array(
        F.try_divide(c("_words"), c("_sentences")),
        F.try_divide(c("_words"), paragraph_count(text)),
        F.try_divide(c("_syllables"), c("_words")),
        bundle["lexical_diversity"],
        bundle["avg_sentence_length"],
        bundle["avg_word_length"],
        bundle["flesch_reading_ease"],
        bundle["gunning_fog_index"],
    )
    return _measured(df, text).select(*df.columns, vector.alias(out))


def compact_types(df: DataFrame) -> DataFrame:
    """Narrow the feature columns to the types the processed table stores."""
    narrow = {
        name: "int" if name in ("word_count", "character_count") else "float"
        for name in NUMERIC_COLS
    }
    narrow.update(generated="boolean", id="bigint")
    return df.withColumns({c: F.col(c).cast(t) for c, t in narrow.items() if c in df.columns})
