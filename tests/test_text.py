"""Text measures against plain Python definitions."""

import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.functions import text as X

SAMPLES = [
    None,
    "",
    "   ",
    "...",
    "don't",
    "½ ٣ 你好 😀",
    "a\x1fb",
    " ",
    "A.\n\nB.",
    "no terminator",
    "One. Two!  Three?? Four",
    "the table made some apples. Extraordinary readability, really!",
    "İstanbul e le the",
    "tail \n \n\n next part",
]


class Scan:
    """Counts of a text by walking over its characters once, keeping a little state."""

    def __init__(self, text):
        self.words, self.marks, self.runs = [], 0, 0
        self.sentences = self.paragraphs = 0
        word, run, sentence, block, breaks = [], False, False, False, 0
        for c in [*text, None]:
            inside = c is not None and (c == "_" or c.isalnum())
            if inside:
                word.append(c)
            elif word:
                self.words.append("".join(word))
                word = []
            blank = c is None or c.isspace()
            if not inside and not blank:
                self.marks += 1
            self.runs += not blank and not run
            run = not blank
            # a sentence ends at a terminator and counts if anything visible came before
            if c is None or c in ".!?":
                self.sentences += sentence
                sentence = False
            elif not blank:
                sentence = True
            # two line ends with only blanks between them close a paragraph
            if not blank:
                block, breaks = True, 0
            elif c is None or c == "\n":
                breaks += 1
                if c is None or breaks == 2:
                    self.paragraphs += block
                    block = False


VOWELS = frozenset("aeiouy")


def beats(word):
    """Vowel groups, without a silent e; at least one."""
    groups, before, two_before = 0, "", ""
    for c in word:
        groups += c in VOWELS and before not in VOWELS
        two_before, before = before, c
    silent = before == "e" and two_before != "" and two_before not in VOWELS and two_before != "l"
    return max(1, groups - silent)


def expected(text):
    seen, small = Scan(text), Scan(text.lower()).words
    n, s, p = len(seen.words), seen.sentences, seen.paragraphs
    letters = sum(len(w) for w in seen.words)
    by_word = [beats(w) for w in small]
    hard = len([x for x in by_word if x > 2])
    if n:
        fog = (n / s + hard * 100 / n) * 2 / 5
        ease = 206.835 - n / s * 1.015 - sum(by_word) / n * 84.6
    else:
        fog = ease = 0.0
    return {
        "ws": seen.runs,
        "words": n,
        "chars": len(text),
        "bytes": sum(1 + (c > "\x7f") + (c > "\u07ff") + (c > "\uffff") for c in text),
        "sentences": s,
        "paragraphs": float(p),
        "syllables": float(sum(by_word)),
        "diversity": len(dict.fromkeys(small)) / max(1, len(small)),
        "sentence_length": n / s if s else 0.0,
        "word_length": letters / max(1, n),
        "punctuation": seen.marks / max(1, len(text)),
        "fog": fog,
        "flesch": ease,
        "per_sentence": n / s if s else None,
        "per_paragraph": n / p if p else None,
    }


# counted by hand
BY_HAND = [
    ("A.\n\nB.", {"words": 2, "sentences": 2, "paragraphs": 2.0, "ws": 2, "bytes": 6, "punctuation": 2 / 6}),
    ("no terminator", {"words": 2, "sentences": 1, "paragraphs": 1.0, "syllables": 5.0, "word_length": 6.0}),
    ("One. Two!  Three?? Four", {"words": 4, "sentences": 4, "syllables": 4.0, "punctuation": 4 / 23, "diversity": 1.0}),
    ("don't", {"words": 2, "ws": 1, "punctuation": 0.2, "sentence_length": 2.0}),
    ("tail \n \n\n next part", {"words": 3, "paragraphs": 2.0, "ws": 3, "per_paragraph": 1.5}),
    ("the table the", {"diversity": 2 / 3, "syllables": 4.0, "words": 3}),
    ("...", {"words": 0, "sentences": 0, "punctuation": 1.0, "fog": 0.0, "paragraphs": 1.0}),
]


MEASURES = {
    "ws": X.ws_word_count,
    "words": X.word_count,
    "chars": X.character_count,
    "bytes": X.byte_length,
    "sentences": X.sentence_count,
    "paragraphs": X.paragraph_count,
    "syllables": X.syllable_count,
    "diversity": X.lexical_diversity,
    "sentence_length": X.avg_sentence_length,
    "word_length": X.avg_word_length,
    "punctuation": X.punctuation_ratio,
    "fog": X.gunning_fog,
    "flesch": X.flesch_reading_ease,
    "per_sentence": X.words_per_sentence,
    "per_paragraph": X.words_per_paragraph,
}


def measured(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = df.select("i", *(f("text").alias(n) for n, f in MEASURES.items())).orderBy("i").collect()
    return [r.asDict() for r in rows]


def check(spark, texts):
    for text, row in zip(texts, measured(spark, texts)):
        row.pop("i")
        if text is None:
            assert all(v is None for v in row.values())
        else:
            assert row == pytest.approx(expected(text), abs=1e-9), repr(text)


def test_samples(spark):
    check(spark, SAMPLES)


def test_values_counted_by_hand(spark):
    for (text, want), row in zip(BY_HAND, measured(spark, [t for t, _ in BY_HAND])):
        assert {k: row[k] for k in want} == pytest.approx(want), text


# characters newer than the JVM's Unicode tables would be classified differently
ALPHABET = st.sampled_from(
    list("abcdelyE13_'.,!?-\n\t \x1c\x85") + ["é", "ß", "你", "½", "٣", " ", " ", "😀", "́"]
)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60), min_size=40, max_size=40))
def test_random_texts(spark, texts):
    check(spark, texts)


def test_whitespace_matches_python_on_every_character(spark):
    chars = [
        chr(c) for c in range(1, 0x20000) if not 0xD800 <= c <= 0xDFFF
    ]
    df = spark.createDataFrame([(c,) for c in chars], "text string")
    blank = {r[0] for r in df.where(~X.has_content("text")).collect()}
    assert blank == {c for c in chars if c.isspace()}
    assert sys.maxunicode >= 0x1FFFF


def test_text_features_equals_single_measures(spark):
    df = spark.createDataFrame([(t,) for t in SAMPLES], "text string")
    single = [
        X.word_count("text"),
        X.character_count("text"),
        X.lexical_diversity("text"),
        X.avg_sentence_length("text"),
        X.avg_word_length("text"),
        X.flesch_reading_ease("text"),
        X.gunning_fog("text"),
        X.punctuation_ratio("text"),
    ]
    both = X.text_features(df).select(
        F.array(*(F.col(c).cast("double") for c in schema.NUMERIC_COLS)).alias("a"),
        F.array(*(c.cast("double") for c in single)).alias("b"),
    )
    for row in both.collect():
        assert row["a"] == pytest.approx(row["b"])


def test_style_vector(spark):
    df = spark.createDataFrame([("The cat sat. It was happy!\n\nNew part here.",)], "text string")
    e = expected(df.first()["text"])
    vector = X.style_vector(df).first()["style"]
    assert vector == pytest.approx(
        [
            e["per_sentence"],
            e["per_paragraph"],
            e["syllables"] / e["words"],
            e["diversity"],
            e["sentence_length"],
            e["word_length"],
            e["flesch"],
            e["fog"],
        ]
    )


def test_compact_types(spark):
    df = spark.createDataFrame([("a b", 1, 7)], "text string, generated int, id int")
    types = dict(X.compact_types(X.text_features(df)).dtypes)
    assert types["generated"] == "boolean" and types["id"] == "bigint"
    assert types["word_count"] == "int" and types["punctuation_ratio"] == "float"


def test_no_python_and_no_shuffle_in_the_plan(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("text"))
    plan = X.text_features(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
