"""A quality classifier of supervised subword embeddings.

Words and their character n-grams are hashed to 2^BITS buckets; a word that repeats the
one before is one feature more. An n-gram is of n characters of a word and the white space
before or after it, and never of two words. Each bucket has a vector. A document is the
mean of the vectors of all its words and n-grams, and a softmax layer over that mean gives
the class. Vectors and layer are learnt together by stochastic gradient descent in numpy.

Training takes a bounded sample: ``SAMPLE_ROWS`` labelled documents that are in the table,
with the least hashes of their ids (then their labels), and of those, in that order, each that still fits into
``SAMPLE_CHARS`` characters. They are chosen by hash and length alone, before any text is
moved. Their features are counted by Spark; the driver gets the counts only. To
score, layer and vectors fold into one number for each bucket (1 MB), which is
broadcast, and all documents are read whole in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from logweir.llm.frames import map_texts
from logweir.llm.labelled import fold, with_labels
from logweir.llm.textbatch import NON_SPACE, bucket, chunks, find_words, hash_spans

BITS = 18
DIMENSIONS = 8
NGRAMS = (2, 4)
EPOCHS = 8
RATE = 0.6
SAMPLE_ROWS = 6_000
SAMPLE_CHARS = 32_000_000

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5

_REPETITION = (1 << BITS) - 1
_SPACES = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D], dtype=np.uint32)
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)


def _spread(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint32(15))
    x = x * np.uint32(0x2C1B3C6D)
    x = x ^ (x >> np.uint32(12))
    return (x * np.uint32(0x297A2D39)) >> np.uint32(32 - BITS)


def _features(texts: pa.Array) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
    """For each chunk: first row, rows, and lists of buckets with borders of rows.

    Case is kept; all white space counts as a blank. The line end after a text is the
    blank behind its last word, and nothing of a row depends on the rows beside it.
    """
    for chunk in chunks(texts):
        words = find_words(chunk, NON_SPACE)
        whole = bucket(hash_spans(chunk.data, words.start, words.end), BITS)
        # A word that repeats the one before also counts as the feature "repetition".
        repeats = np.flatnonzero((whole[1:] == whole[:-1]) & (np.diff(words.text) == 0)) + 1
        lists = [
            (whole, words.first),
            (np.full(len(repeats), _REPETITION), np.searchsorted(repeats, words.first)),
        ]
        points = np.frombuffer(chunk.data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        begins = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])
        offsets = begins[chunk.offsets]  # of texts, in characters
        blank = (points <= 0x20) & np.isin(points, _SPACES)
        values = np.where(blank, np.uint32(0x20), points) * np.uint32(0x9E3779B1)
        values ^= values >> np.uint32(15)
        ended = np.zeros(len(points), dtype=bool)
        ended[offsets[1:] - 1] = True
        for n in NGRAMS:
            size = max(0, len(values) - n + 1)
            total = np.full(size, n, dtype=np.uint32)
            own = ~ended[:size]
            for k in range(n):
                total += values[k : k + size] * _FACTORS[k]
                if 0 < k < n - 1:
                    own &= ~blank[k : k + size]
            at = np.flatnonzero(own)
            lists.append((_spread(total[at]), np.searchsorted(at, offsets)))
        yield chunk.first, chunk.rows, lists


def _counts(texts: pa.Array) -> list[pa.Array]:
    """Distinct buckets of each text, and how often each occurs."""
    keys: list = [None] * len(texts)
    times: list = [None] * len(texts)
    for first, rows, lists in _features(texts):
        for r in range(rows):
            own = np.concatenate([x[b[r] : b[r + 1]] for x, b in lists])
            keys[first + r], times[first + r] = np.unique(own.astype(np.int32), return_counts=True)
    return [
        pa.array(keys, pa.list_(pa.int32())),
        pa.array([t.astype(np.int32) for t in times], pa.list_(pa.int32())),
    ]


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> np.ndarray:
    """Logit of class 1 over class 0 for each bucket, and the constant last (float32).

    ``samples``: buckets, counts and class of each document.
    """
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1, 1, (1 << BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = np.zeros((2, DIMENSIONS), dtype=np.float32)
    constant = np.zeros(2, dtype=np.float32)
    steps = max(1, EPOCHS * len(samples))
    done = 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(samples)):
            keys, times, label = samples[i]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            share = (times / max(1, times.sum())).astype(np.float32)
            mean = share @ vectors[keys]
            logits = layer @ mean + constant
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = layer.T @ p
            layer -= rate * np.outer(p, mean)
            constant -= rate * p
            # Shares are small: without the factor, vectors would hardly move.
            vectors[keys] -= rate * np.float32(20) * share[:, None] * back
    logit = vectors @ (layer[1] - layer[0])
    return np.append(logit, constant[1] - constant[0]).astype(np.float32)


def _scores(texts: pa.Array, logits: np.ndarray) -> list[pa.Array]:
    out = np.zeros(len(texts))
    for first, rows, lists in _features(texts):
        total, size = np.zeros(rows), np.zeros(rows)
        for keys, borders in lists:
            sums = np.concatenate([[0.0], np.cumsum(logits[keys], dtype=np.float64)])
            total += sums[borders[1:]] - sums[borders[:-1]]
            size += np.diff(borders)
        out[first : first + rows] = total / np.maximum(size, 1) + logits[-1]
    return [pa.array(1 / (1 + np.exp(-out)))]


def _fitting(rows: Sequence[Row]) -> dict[tuple[int, int], int]:
    """Of rows (draw, label, chars, n), in their order: how many of each fit the sample."""
    out = {}
    left, room = SAMPLE_ROWS, SAMPLE_CHARS
    for draw, label, chars, n in rows:
        fits = min(n, left, room // chars if chars else n)
        if fits:
            out[draw, label] = fits
            left, room = left - fits, room - fits * chars
    return out


def quality(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    ident: str = "doc_id",
    label: str = "quality",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every row as struct ``row``, with ``held_out``, ``score`` and ``predicted``.

    Only labels of rows whose crc32(id) mod 3 is not 1 are learnt from. ``score`` is in
    0 to 1, ``predicted`` is 1 from 0.5. Null and empty texts have the features of an
    empty line. Labels that are null or neither 0 nor 1, and labels of unknown ids, are
    ignored and take no place in the sample; without any label all scores are 0.5. Repeated
    rows each count. Very long texts are read whole. Of equal hashes of ids the lesser label
    is sampled first. An empty table gives an empty result, and columns of the input stay
    inside ``row``.
    """
    spark = docs.sparkSession
    marks = labels.where(fold(labels[ident], FOLDS) != HELD_OUT)
    # Labels of documents that are here, by ids alone: others do not use up the sample.
    present = with_labels(docs, marks, label, ident, ident).select("ident", "label").distinct()
    chosen = (
        present.orderBy(F.xxhash64("ident"), "label")
        .limit(SAMPLE_ROWS)
        .select(F.col("ident").alias(ident), F.col("label").alias(label))
    )
    marked = with_labels(docs, chosen, label, ident, text).select(
        "label", "text", F.xxhash64("ident", "text").alias("draw")
    )
    # Rows repeated with equal id, text and label are one row here.
    sizes = marked.groupBy("draw", "label").agg(
        F.max(F.length(F.coalesce("text", F.lit("")))).alias("chars"), F.count("*").alias("n")
    )
    few = _fitting(sizes.orderBy("draw", "label").limit(SAMPLE_ROWS).collect())
    picked = spark.createDataFrame(list(few), "of_draw bigint, of_label int")
    same = (F.col("draw") == F.col("of_draw")) & (F.col("label") == F.col("of_label"))
    texts = (
        marked.join(F.broadcast(picked), same)
        .groupBy("draw", "label")
        .agg(F.first("text").alias("text"))
    )
    counted = map_texts(
        texts, "text", "keys array<int>, times array<int>", _counts, ["draw", "label"]
    )
    table = counted.select("row.draw", "row.label", "keys", "times").toArrow()
    columns = (table[c] for c in ("draw", "label", "keys", "times"))
    found = {
        (d.as_py(), y.as_py()): (k.values.to_numpy(), t.values.to_numpy(), y.as_py())
        for d, y, k, t in zip(*columns, strict=True)
    }
    samples = [found[key] for key, n in few.items() for _ in range(n)]
    logits = spark.sparkContext.broadcast(train(samples))
    columns = list(dict.fromkeys([*(docs.columns if keep is None else keep), ident]))
    found = map_texts(
        docs, text, "score double", lambda texts: _scores(texts, logits.value), columns
    )
    return found.select(
        "row", (fold(F.col("row")[ident], FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
