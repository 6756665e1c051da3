"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

    z(x) = w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]

The second sum holds all pairwise interactions of rank ``RANK`` and costs no more
than the features that a text has. Word counts are hashed into ``WORDS`` buckets;
every structure statistic and every metadata column is one of ``BINS`` indicators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgauge.llm.frames import filter_rows, map_batches, sample_per_class
from inkgauge.llm.shingles import mix, word_hashes

WORDS = 1 << 13
BINS = 16
RANK = 8
SAMPLE = 4096  # labelled rows that are learned from, per class and at most
EPOCHS = 12
BATCH = 128
RATE = 0.05
DECAY = 1e-4
_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
STATISTICS = 14


def _log_bin(x: float) -> int:
    return int(min(BINS - 1, np.log2(1.0 + x)))


def _share_bin(x: float) -> int:
    return int(min(BINS - 1, BINS * np.sqrt(min(max(x, 0.0), 1.0))))


def structure(raw: np.ndarray, words: np.ndarray) -> list[int]:
    """Bins of the structure statistics of a text."""
    seen = np.bincount(raw, minlength=256)
    n, n_words = len(raw), len(words)
    marks = int(seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum())
    plain = int(seen[[33, 39, 44, 45, 46, 58, 59, 63]].sum())
    spaces = int(seen[9:14].sum() + seen[32])
    counts = np.unique(words, return_counts=True)[1] if n_words else np.zeros(0, int)
    runs = words[:-4] + mix(words[1:-3]) * np.uint64(3) + mix(words[2:-2]) * np.uint64(5) if n_words > 4 else words
    part = lambda k, of: k / of if of else 0.0
    return [
        _log_bin(n),
        _log_bin(n_words),
        _log_bin(2.0 * part(n - spaces, n_words)),
        _share_bin(part(int(seen[_UPPER].sum()), n)),
        _share_bin(part(int(seen[_LOWER].sum()), n)),
        _share_bin(part(int(seen[_DIGIT].sum()), n)),
        _share_bin(part(marks, n)),
        _share_bin(part(marks - plain, n)),
        _share_bin(part(int(seen[124]), n)),
        _share_bin(part(int(seen[10]), n)),
        _share_bin(part(int(seen[128:].sum()), n)),
        _share_bin(part(int(seen[46]), n_words)),
        _share_bin(part(len(counts), n_words)),
        _share_bin(1.0 - part(len(np.unique(runs)), len(runs))),
    ]


def features(text: str | None, metadata: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Sparse (index, value) of one document; words and indicators have length 1 each."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    words = word_hashes(text)
    buckets = np.bincount((words % np.uint64(WORDS)).astype(np.int64), minlength=WORDS)
    index = np.flatnonzero(buckets)
    value = np.sqrt(buckets[index])
    if len(value):
        value = value / np.sqrt((value**2).sum())
    bins = structure(raw, words) if len(raw) else [0] * STATISTICS
    for x in metadata:
        known = x is not None and np.isfinite(x)
        # the last bin is for what is not known
        bins.append(min(BINS - 2, _log_bin(abs(float(x)))) if known else BINS - 1)
    extra = WORDS + BINS * np.arange(len(bins)) + np.array(bins)
    return np.concatenate([index, extra]), np.concatenate([value, np.full(len(bins), len(bins) ** -0.5)])


class FactorisationMachine:
    def __init__(self, n_features: int):
        start = np.random.default_rng(7)
        self.bias = 0.0
        self.linear = np.zeros(n_features)
        self.factors = start.normal(0.0, 0.05, (n_features, RANK))

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        vx = self.factors[index] * value[:, None]
        pairs = 0.5 * float((vx.sum(0) ** 2 - (vx**2).sum(0)).sum())
        z = self.bias + float(self.linear[index] @ value) + pairs
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, weight: np.ndarray) -> None:
        """Adagrad on weighted log loss, in mini-batches of a fixed order."""
        shuffle = np.random.default_rng(11)
        sums = [1e-8, np.full_like(self.linear, 1e-8), np.full_like(self.factors, 1e-8)]
        for _ in range(EPOCHS):
            order = shuffle.permutation(len(rows))
            for at in range(0, len(rows), BATCH):
                batch = order[at : at + BATCH]
                x = np.zeros((len(batch), len(self.linear)))
                for i, r in enumerate(batch):
                    x[i, rows[r][0]] = rows[r][1]
                vx = x @ self.factors
                squares = x * x
                z = self.bias + x @ self.linear + 0.5 * (vx**2 - squares @ self.factors**2).sum(1)
                g = (1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - target[batch]) * weight[batch] / len(batch)
                steps = [
                    g.sum(),
                    x.T @ g + DECAY * self.linear,
                    x.T @ (g[:, None] * vx) - (squares.T @ g)[:, None] * self.factors + DECAY * self.factors,
                ]
                sums = [s + d * d for s, d in zip(sums, steps, strict=True)]
                scaled = [RATE * d / np.sqrt(s) for s, d in zip(sums, steps, strict=True)]
                self.bias -= scaled[0]
                self.linear -= scaled[1]
                self.factors -= scaled[2]


def _fit(n_metadata: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True)
        model = FactorisationMachine(WORDS + BINS * (STATISTICS + n_metadata))
        if len(pdf):
            pdf = pdf.sort_values(["order", "label"], ignore_index=True)
            rows = [features(t, m) for t, m in zip(pdf["text"], _metadata(pdf, n_metadata), strict=True)]
            model.fit(rows, pdf["label"].to_numpy(float), pdf["weight"].to_numpy(float))
        table = np.column_stack([model.linear, model.factors]).astype(np.float32)
        yield pd.DataFrame({"bias": [model.bias], "table": [table.tobytes()]})

    return run


def _metadata(pdf: pd.DataFrame, n: int) -> list[tuple]:
    columns = [pdf[f"m{i}"].tolist() for i in range(n)]
    return list(zip(*columns, strict=True)) if columns else [()] * len(pdf)


def learn_quality(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, metadata: tuple[str, ...]
) -> tuple[float, bytes]:
    """Fit on at most SAMPLE labelled rows per class, weighted to the classes' true shares.

    The rows of a class are those of the least id hash in each of SAMPLE hash
    buckets; a bounded number of rows is fitted by one task. Labels other than 0
    and 1 and labels of unknown documents are ignored. Without labelled rows every
    score is 0.5.
    """
    labelled = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = docs.select(F.col(id_col).alias("id")).distinct()
    labelled = labelled.where("label IN (0, 1)").distinct().join(known, "id", "left_semi")
    picked = sample_per_class(labelled, "label", F.xxhash64("id"), SAMPLE)
    share = {r.label: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = {r.label: r["n"] for r in picked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = {k: share[k] / taken[k] * sum(taken.values()) / sum(share.values()) for k in taken}
    picked = picked.withColumn(
        "weight", F.when(F.col("label") == 0, F.lit(weight.get(0, 1.0))).otherwise(F.lit(weight.get(1, 1.0)))
    )
    meta = [F.col(c).cast("double").alias(f"m{i}") for i, c in enumerate(metadata)]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *meta)
    # at most 2 x SAMPLE rows: safe to broadcast
    rows = rows.join(F.broadcast(picked), "id").withColumnRenamed("_order", "order")
    rows = rows.dropDuplicates(["id", "label"]).drop("id").coalesce(1)
    model = map_batches(rows, _fit(len(metadata)), "bias double, table binary").first()
    return (model.bias, bytes(model.table)) if model else (0.0, b"")


def load(model: tuple[float, bytes]) -> FactorisationMachine:
    machine = FactorisationMachine(0)
    machine.bias = model[0]
    table = np.frombuffer(model[1], np.float32).reshape(-1, RANK + 1).astype(float)
    machine.linear, machine.factors = table[:, 0].copy(), table[:, 1:].copy()
    return machine


def score_text(machine: FactorisationMachine, text: str | None, metadata: tuple) -> float:
    return machine.score(*features(text, metadata)) if len(machine.linear) else 0.5


def _score(model: tuple[float, bytes], n_metadata: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = load(model)
        for pdf in batches:
            rows = zip(pdf["text"], _metadata(pdf, n_metadata), strict=True)
            yield pd.DataFrame({"id": pdf["id"], "score": [score_text(machine, t, m) for t, m in rows]})

    return run


def score_quality(
    docs: DataFrame,
    model: tuple[float, bytes],
    id_col: str = "doc_id",
    text_col: str = "text",
    metadata: tuple[str, ...] = ("n_chars",),
    threshold: float = 0.3,
) -> DataFrame:
    """(id, score, predicted) per row, from its whole text and the named numeric columns.

    Null and empty texts share one set of structure indicators; null or non-finite
    metadata has an indicator of its own. Equal rows get equal scores. Rows are
    kept as they come, null ids too; an empty table gives an empty result; columns
    that are not named are ignored.
    """
    meta = [F.col(c).cast("double").alias(f"m{i}") for i, c in enumerate(metadata)]
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), *meta)
    scored = map_batches(rows, _score(model, len(metadata)), "id bigint, score double")
    return scored.select(
        F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(
    docs: DataFrame,
    model: tuple[float, bytes],
    text_col: str = "text",
    metadata: tuple[str, ...] = ("n_chars",),
    threshold: float = 0.3,
) -> DataFrame:
    """The rows whose score is at least ``threshold``, with all their columns."""

    def start():
        machine = load(model)
        return lambda texts, *meta: [
            score_text(machine, t, m) >= threshold
            for t, m in zip(texts, zip(*meta, strict=True) if meta else [()] * len(texts), strict=True)
        ]

    return filter_rows(docs, [text_col, *metadata], start)
