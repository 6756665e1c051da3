"""Column names, schemas and default parameters."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the processed table and the default parameters
# of the five jobs. They must stay as they are for results to be comparable.
NUMERIC_COLS = [
    "word_count",
    "character_count",
    "lexical_diversity",
    "avg_sentence_length",
    "avg_word_length",
    "flesch_reading_ease",
    "gunning_fog_index",
    "punctuation_ratio",
]
RAW_COLS = ["text", "generated", "id"]
MIN_WORDS, MAX_WORDS = 100, 1000
MIN_BYTES, MAX_BYTES = 100, 5000
TOKEN_LIMIT, MIN_TOKENS = 250, 100
EMBEDDING_DIM = 384
BATCH_SIZE = 64
SEED = 42
SHARES = (0.8, 0.1, 0.1)
CLUSTER_GRID = [2, 30, 100]
TABLES_GRID = [16, 24, 32]
BITS_GRID = [16, 18]
TOP_K_GRID = [10, 15]
LAYERS = [392, 128, 64, 32, 1]
EPOCHS = 25
LEARNING_RATE = 1e-3

RAW_SCHEMA = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("generated", T.StringType())]
)
CLEANED_SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("generated", T.ByteType()),
        T.StructField("id", T.LongType()),
    ]
)
SHARDS = 8  # parallel replicas of the perceptron
