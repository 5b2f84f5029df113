"""Toxicity by two class-conditional Kneser-Ney language models.

One model is made of the toxic documents and one of the ordinary ones. Its word
probabilities are Kneser-Ney continuation counts: in how many different contexts
(previous words) the class has the word, less a discount by count. So a word that many
toxic documents use counts for much, and one that copies of a single document repeat
counts as seen once. What is discounted goes to continuation counts shared by both
classes, which makes a rare expression likely or unlikely in both alike.

On these stands a model of word pairs: p(word | previous word) is the share of texts with
the pair, less a discount, and for the rest the word's own probability times what is left
for it, the previous word's backoff weight. Pairs that fewer than LEAST_TEXTS texts of a class
have are left to backoff, as is usual of such models. So words that are common in both classes
are evidence where they stand side by side.

A document is described by the log-likelihood ratio of the models, normalised by
length: over the whole text, and over the passages of ``PASSAGES`` words where it is
greatest, by words alone and with pairs. A logistic curve makes that a probability. It is fitted to a fold of the
labelled documents by models counted on the others; documents are scored by models
counted on all of them.

A word is its 64-bit hash, so different words do not share counts. Spark counts the
different (word, context) pairs of all labelled documents, and from them makes the model: a
table of a row for each word, and one of a row for each pair that several texts have and for
each of their contexts. Both are tables that grow with the labelled texts. The words with the
most contexts, BROADCAST_WORDS at most, and the pairs and contexts of the most texts, are
broadcast, and where that is all, documents are scored in one pass without a shuffle. Else the
other words, pairs and contexts of documents, each once a text with its places, are joined
with the rest of the model, and the values found are joined to the texts. A bitmap of the rest
keeps back most of what is not in it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logweir.llm.frames import give_back, map_texts, small_batches, stored
from logweir.llm.labelled import fold, with_labels
from logweir.llm.textbatch import ALPHANUMERIC, chunks, find_words, hash_spans, mix, seeded

#: So many words of the model are broadcast (16 bytes each); others are joined.
BROADCAST_WORDS = 4_000_000
#: So many pairs of the model and as many contexts are broadcast (16 bytes each); others are joined.
BROADCAST_PAIRS = 1_000_000
#: So many (word, context) rows of a task are merged at once, and the pairs of a word are dealt
#: to so many partitions, of which all have its rows together.
MERGE_ROWS = 1 << 20
WORD_PARTS = 16
#: Bits of the bitmap of what is joined: the power of two, at most (32 MB).
BITMAP_POWER = 28
#: Texts of a class that a pair is in, at least, and what is taken off its count.
LEAST_TEXTS = 4
PAIR_DISCOUNT = 0.75
#: Backoff weight of a context, at least.
LEAST_LEFT = 1e-9
PASSAGES = (1, 16)
#: Labelled documents that the logistic curve is fitted to, at most; one in so many is
#: kept from the counts that describe them, though not from those of the final models.
FIT_ROWS = 20_000
FIT_SHARE = 5
#: Weight of the mean ratio where the fold has too few labels to fit a curve.
FEW_SLOPE = 4.0

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3

#: Kinds of labelled rows: ordinary and toxic, then the same of the fold for the curve.
_KINDS = range(4)
#: Ordinary, toxic and either as sets of kinds: without that fold, and with it.
_SEEN = (0b0001, 0b0010, 0b0011, 0b0101, 0b1010, 0b1111)
_PACKED = ["x0", "x1", "x2"]
#: Of a context, by kind: how many texts have it before a word, summed over words.
_AFTER = [f"after_{k}" for k in _KINDS]
#: Of the words by themselves, and then of the words with what pairs add to them.
_NUMBERS = ["length", *(f"{of}_{x}" for of in ("word", "pair")
                        for x in ("mean", *(f"best_{n}" for n in PASSAGES)))]


def _words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each chunk: first row, hashes of words, row borders."""
    for chunk in chunks(texts):
        words = find_words(chunk, ALPHANUMERIC)
        yield chunk.first, hash_spans(chunk.data, words.start, words.end), words.first


def _contexts(words: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """The word before each word of its text (0: start of a text)."""
    context = np.zeros(len(words), dtype=np.uint64)
    context[1:] = words[:-1]
    context[borders[:-1][np.diff(borders) > 0]] = 0
    return context


def _pairs(texts: pa.Array, kinds: np.ndarray) -> np.ndarray:
    """Different (word, context), and how many texts of each kind have them.

    Two 32-bit counts share a number: kinds 0 and 1, kinds 2 and 3.
    """
    found = [np.zeros((4, 0), dtype=np.int64)]
    for first, words, borders in _words(texts):
        context = _contexts(words, borders)
        size = np.diff(borders)
        text = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((text, context, words))
        words, context, text = words[order], context[order], text[order]
        pair = np.append(True, (words[1:] != words[:-1]) | (context[1:] != context[:-1]))[: len(words)]
        once = pair | np.append(True, text[1:] != text[:-1])[: len(words)]
        kind = kinds[first + text].astype(np.int64)
        one = np.where(once, np.int64(1) << (32 * (kind & 1)), 0)
        at = np.flatnonzero(pair)
        if len(at):
            counts = [np.add.reduceat(np.where(kind >> 1 == k, one, 0), at) for k in (0, 1)]
            found.append(np.stack([words[at].view(np.int64), context[at].view(np.int64), *counts]))
    return np.concatenate(found, axis=1)


def _merged(found: list[np.ndarray]) -> np.ndarray:
    """Rows of ``_pairs`` with those of equal pairs added up, in order of words."""
    word, context, *counts = np.concatenate(found, axis=1)
    order = np.lexsort((context, word))
    word, context = word[order], context[order]
    at = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (context[1:] != context[:-1]))[: len(word)])
    if not len(at):
        return found[0][:, :0]
    return np.stack([word[at], context[at], *(np.add.reduceat(n[order], at) for n in counts)])


def _halves(x) -> list:
    """The two 32-bit counts in a number, of an array or a column of Spark."""
    half = (1 << 32) - 1
    if isinstance(x, np.ndarray):
        return [x & half, x >> 32]
    return [x.bitwiseAND(F.lit(half)), F.shiftright(x, 32)]


def _by_kind(low, high) -> list:
    return [*_halves(low), *_halves(high)]


def pair_counts(labelled: DataFrame) -> DataFrame:
    """Counts of words, of contexts and of pairs, from one shuffle of the different pairs.

    ``word``, ``context`` (null in a row for a word by itself and as a context) and numbers:
    see ``words_of``, ``contexts_of`` and ``pairs_of``.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "context", "low", "high"]

        def out(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            for i in range(0, rows.shape[1], 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows[:, i : i + 100_000]], names)

        found, size = [], 0
        for batch in batches:
            found.append(_pairs(batch.column(1), batch.column(0).to_numpy(zero_copy_only=False)))
            size += found[-1].shape[1]
            if size >= MERGE_ROWS:
                found = [_merged(found)]
                size = found[0].shape[1]
                if size >= MERGE_ROWS // 2:
                    yield from out(found[0])
                    found, size = [], 0
        if found:
            yield from out(_merged(found))
        give_back()

    # Rows of a word come together and in its order: that packs well, and few tasks have it.
    part = F.pmod("context", F.lit(WORD_PARTS))
    pairs = (
        _with_kind(labelled)
        .mapInArrow(count, "word bigint, context bigint, low bigint, high bigint")
        .repartition("word", part)
        .groupBy("word", part.alias("part"), "context")
        .agg(F.sum("low").alias("low"), F.sum("high").alias("high"))
    )
    n = _by_kind(F.col("low"), F.col("high"))

    def seen(kinds: int) -> Column:
        some = [n[k] > 0 for k in _KINDS if kinds >> k & 1]
        return reduce(lambda a, b: a | b, some).cast("bigint")

    none, zero = (F.lit(x).cast("bigint") for x in (None, 0))
    by_set = [seen(k) for k in _SEEN]
    packed = [a + F.shiftleft(b, 32) for a, b in zip(by_set[::2], by_set[1::2], strict=True)]
    numbers = [F.col("low"), F.col("high"), zero]
    names = [*_PACKED, *_AFTER]
    word, after, pair = (
        F.struct(
            key.alias("word"), of.alias("context"), *[x.alias(c) for x, c in zip(own, names, strict=True)]
        )
        for key, of, own in (
            (F.col("word"), none, packed + [zero] * len(_AFTER)),
            (F.col("context"), none, [zero] * len(_PACKED) + n),
            (F.col("word"), F.col("context"), numbers + [zero] * len(_AFTER)),
        )
    )
    several = (n[0] + n[2] >= LEAST_TEXTS) | (n[1] + n[3] >= LEAST_TEXTS)
    made = F.when(several, F.array(word, after, pair)).otherwise(F.array(word, after))
    rows = pairs.select(F.explode(made).alias("r"))
    return rows.select("r.*").groupBy("word", "context").agg(*[F.sum(c).alias(c) for c in names])


def words_of(counts: DataFrame) -> DataFrame:
    """``word``, and in how many contexts it is seen, by sets of kinds as in ``_SEEN``."""
    halves = [x for c in _PACKED for x in _halves(F.col(c))]
    seen = [x.alias(f"seen_{k}") for x, k in zip(halves, _SEEN, strict=True)]
    # The start of a text is a context and no word.
    return counts.where("context IS NULL").select("word", *seen).where(f"seen_{_SEEN[-1]} > 0")


def contexts_of(counts: DataFrame) -> DataFrame:
    """``context``, and by kind the sum over words of the texts that have it before them."""
    return counts.where("context IS NULL").select(F.col("word").alias("context"), *_AFTER)


def pairs_of(counts: DataFrame) -> DataFrame:
    """Pairs that LEAST_TEXTS texts of a class have: ``word``, ``context`` and the packed
    counts ``low`` and ``high`` of texts by kind."""
    packed = [F.col(c).alias(n) for c, n in zip(_PACKED, ("low", "high"), strict=False)]
    return counts.where("context IS NOT NULL").select("word", "context", *packed)


def _with_kind(labelled: DataFrame) -> DataFrame:
    small_batches(labelled.sparkSession)
    kind = F.col("label") + F.when(F.col("for_fit"), 2).otherwise(0)
    return labelled.select(kind.alias("kind"), "text")


class Totals(NamedTuple):
    """Of the counts of one class: their sum, how many are 1, 2, 3, 4, and above 0."""

    sum: float
    ones: int
    twos: int
    threes: int
    fours: int
    words: int

    @classmethod
    def of(cls, counts: np.ndarray) -> Totals:
        by_count = [int(np.count_nonzero(counts == k)) for k in (1, 2, 3, 4)]
        return cls(float(counts.sum()), *by_count, int(np.count_nonzero(counts)))


def _totals(counts: DataFrame) -> list[Totals]:
    """Totals of each of _SEEN."""
    columns = []
    for k in _SEEN:
        c = F.col(f"seen_{k}")
        columns += [F.coalesce(F.sum(c), F.lit(0)), *(F.count_if(c == n) for n in (1, 2, 3, 4)),
                    F.count_if(c > 0)]
    row = counts.agg(*columns).collect()[0]
    size = len(Totals._fields)
    return [Totals(*row[i : i + size]) for i in range(0, len(row), size)]


def _discounts(n: Totals) -> np.ndarray:
    """How much to take off counts of 0, 1, 2, and 3 or more (Chen and Goodman)."""
    by = [0, n.ones, n.twos, n.threes, n.fours]
    if not all(by[1:]):
        return np.array([0, 0.5, 0.5, 0.5])
    y = by[1] / (by[1] + 2 * by[2])
    return np.array([0] + [max(0.0, k - (k + 1) * y * by[k + 1] / by[k]) for k in (1, 2, 3)])


def kneser_ney(
    counts: np.ndarray, shared: np.ndarray, own: Totals | None = None, total: float | None = None,
    words: int | None = None,
) -> np.ndarray:
    """log p(word) of one class by its continuation counts, backed off to shared ones.

    ``own`` are the totals of the class, ``total`` the sum of the shared counts and
    ``words`` the size of the vocabulary, where the arrays are a part of it.
    """
    own = own or Totals.of(counts)
    base = (shared + 1.0) / ((shared.sum() if total is None else total) + (words or len(shared)))
    if not own.sum:
        return np.log(base)
    off = _discounts(own)
    left = off[1] * own.ones + off[2] * own.twos + off[3] * (own.words - own.ones - own.twos)
    taken = off[np.minimum(counts, 3).astype(np.int64)]
    return np.log((counts - taken) / own.sum + left / own.sum * base)


def log_ratios(counts: np.ndarray, totals: Sequence[Totals]) -> np.ndarray:
    """log p(word | toxic) - log p(word | ordinary) for counts: ordinary, toxic, either.

    A word that no text of either class has is no evidence: 0. One such word is part of
    the vocabulary.
    """
    ordinary, toxic = (
        kneser_ney(own, counts[2], n, totals[2].sum, totals[2].words + 1)
        for own, n in zip(counts[:2], totals[:2], strict=True)
    )
    return np.where(counts[2] > 0, toxic - ordinary, 0.0)


class Rest(NamedTuple):
    """Rows of a model that are joined, and a bitmap of their words by the first bits."""

    table: DataFrame
    bitmap: np.ndarray


class Model(NamedTuple):
    """Log-ratios of words, for the fit (0) and for scores (1). Unseen words have 0.

    ``words`` and ``values`` (2 x words) are those to broadcast, by word; ``rest`` has all
    others as ``word``, ``value_0`` and ``value_1``, or is None. ``pairs`` are keys of pairs
    and of contexts to broadcast, in order, with what they add to a word (``pair_values``,
    2 x pairs); ``pair_rest`` has all others, as ``rest`` has words.
    """

    words: np.ndarray
    values: np.ndarray
    rest: Rest | None
    pairs: np.ndarray
    pair_values: np.ndarray
    pair_rest: Rest | None


def _pair_key(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix(seeded(context, 5) + word)


def _context_key(context: np.ndarray) -> np.ndarray:
    return seeded(context, 6)


def _added(own: np.ndarray, left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """log p(word | context) less log of backoff weight times p(word), toxic over ordinary."""
    p = np.log(own + left * np.exp(word)) - np.log(left) - word
    return np.where((own > 0).any(axis=0), p[1] - p[0], 0.0)


def pair_ratios(
    count: np.ndarray, of: np.ndarray, total: np.ndarray, word: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """What pairs and what contexts add to the log-ratio of a word, toxic over ordinary.

    By class (ordinary, toxic): ``count`` of each pair, ``total`` of each context and log p
    of each pair's ``word`` by itself; ``of`` is the context of each pair. With a pair it is
    log p(word | context), without it log of the context's backoff weight times p(word).
    ``pair_table`` does the same for tables.
    """
    own = np.maximum(count - PAIR_DISCOUNT, 0) / np.maximum(total[:, of], 1)
    left = np.ones(total.shape)
    for k in range(len(count)):
        np.subtract.at(left[k], of, own[k])
    left = np.maximum(left, LEAST_LEFT)
    return _added(own, left[:, of], word), np.log(left[1]) - np.log(left[0])


def pair_table(counts: DataFrame, totals: Sequence[Totals]) -> DataFrame:
    """What all pairs and all their contexts add to a word, a row for each of them.

    ``word`` is the key of the pair or context, ``power`` the power of two of its texts, and
    ``value_0`` and ``value_1`` are for the fit and for scores.
    """
    sides = [(side, k) for side in (0, 1) for k in (0, 1)]
    n = _by_kind(F.col("low"), F.col("high"))
    after = [F.col(c) for c in _AFTER]

    def share(side: int, k: int) -> Column:
        count, total = (x[k] + x[k + 2] if side else x[k] for x in (n, after))
        return F.greatest(count - F.lit(PAIR_DISCOUNT), F.lit(0.0)) / F.greatest(total, F.lit(1))

    own, left = ([f"{name}_{side}{k}" for side, k in sides] for name in ("own", "left"))
    pairs = pairs_of(counts).join(contexts_of(counts), "context").select(
        "word", "context", (n[0] + n[1] + n[2] + n[3]).alias("texts"),
        *[share(*x).alias(c) for x, c in zip(sides, own, strict=True)],
    )
    contexts = pairs.groupBy("context").agg(
        F.sum("texts").alias("texts"),
        *[F.greatest(1 - F.sum(o), F.lit(LEAST_LEFT)).alias(x) for o, x in zip(own, left, strict=True)],
    )
    power = F.floor(F.log2("texts")).cast("int").alias("power")
    seen = [f"seen_{k}" for k in _SEEN]
    with_words = pairs.join(contexts.drop("texts"), "context").join(words_of(counts), "word")

    def keyed(key: Callable, value: Callable, source: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["word", "power", "value_0", "value_1"]
            for batch in batches:
                ids = [batch[c].to_numpy().view(np.uint64) for c in ("word", "context")]
                by = {c: batch[c].to_numpy() for c in batch.schema.names}
                values = [value(by, side).astype(np.float32) for side in (0, 1)]
                found = [key(*ids).view(np.int64), by["power"], *values]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names)

        return source.mapInArrow(run, "word bigint, power int, value_0 float, value_1 float")

    def lefts(by: dict, side: int) -> np.ndarray:
        return np.array([by[f"left_{side}{k}"] for k in (0, 1)])

    def of_pair(by: dict, side: int) -> np.ndarray:
        ordinary, toxic, shared = (by[c].astype(float) for c in seen[3 * side : 3 * side + 3])
        sums = totals[3 * side : 3 * side + 3]
        alone = np.array(
            [kneser_ney(x, shared, t, sums[2].sum, sums[2].words + 1)
             for x, t in zip((ordinary, toxic), sums, strict=False)]
        )
        return _added(np.array([by[f"own_{side}{k}"] for k in (0, 1)]), lefts(by, side), alone)

    def of_context(by: dict, side: int) -> np.ndarray:
        x = lefts(by, side)
        return np.log(x[1]) - np.log(x[0])

    none = F.lit(0).cast("bigint").alias("word")
    return keyed(
        _pair_key, of_pair, with_words.select("word", "context", power, *own, *left, *seen)
    ).union(
        keyed(lambda _, of: _context_key(of), of_context, contexts.select(none, "context", power, *left))
    )


def _bitmap(table: DataFrame, rows: int) -> np.ndarray:
    """A bit for the first bits of each word of the table: 16 times as many as rows, or fewer."""
    bits = min(BITMAP_POWER, max(12, rows.bit_length() + 4))
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(word, {64 - bits}) & 63L as int))")
    slot = F.expr(f"shiftrightunsigned(word, {64 - bits + 6})").alias("slot")
    found = table.groupBy(slot).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _may_have(bitmap: np.ndarray, words: np.ndarray) -> np.ndarray:
    at = words >> np.uint64(64 - 6 - (len(bitmap).bit_length() - 1))
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _most(table: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, Rest | None]:
    """The rows of the highest powers, ``most`` at most: words in order and values (2 x words);
    and all others, if there are any."""
    sizes = sorted(table.groupBy("power").count().collect(), reverse=True)
    least, known = 64, 0
    for power, size in sizes:
        if known + size > most:
            break
        least, known = power, known + size
    few = table.where(F.col("power") >= least).drop("power").toArrow()
    words = few["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    values = np.stack([few[f"value_{k}"].to_numpy()[order] for k in (0, 1)])
    others = sum(size for _, size in sizes) - known
    if not others:
        return words[order], values, None
    rest = table.where(F.col("power") < least).drop("power")
    return words[order], values, Rest(rest, _bitmap(rest, others))


def word_model(all_counts: DataFrame, totals: Sequence[Totals]) -> Model:
    counts = words_of(all_counts)
    sides = totals[:3], totals[3:]

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by = np.array([x.to_numpy(zero_copy_only=False) for x in batch.columns[2:]], dtype=float)
            both = (log_ratios(by[:3], sides[0]), log_ratios(by[3:], sides[1]))
            found = [pa.array(x.astype(np.float32)) for x in both]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], names)

    names = ["word", "power", "value_0", "value_1"]
    # Words by the power of two of their contexts: 64 groups at most.
    power = F.floor(F.log2(f"seen_{_SEEN[-1]}")).cast("int").alias("power")
    table = counts.select("word", power, *[f"seen_{k}" for k in _SEEN]).mapInArrow(
        values, "word bigint, power int, value_0 float, value_1 float"
    )
    pairs = stored(pair_table(all_counts, totals), used_once=True)
    return Model(*_most(table, BROADCAST_WORDS), *_most(pairs, 2 * BROADCAST_PAIRS))


def _find(words: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word is among the known ones (in order), and whether it is."""
    if not len(known):
        return np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=bool)
    once, back = np.unique(words, return_inverse=True)
    at = np.minimum(np.searchsorted(known, once), len(known) - 1)
    return at[back], (known[at] == once)[back]


def _describe(
    texts: pa.Array, known: np.ndarray, values: np.ndarray, pairs: np.ndarray, pair_values: np.ndarray,
    found: pa.Array | None = None,
) -> list[pa.Array]:
    """_NUMBERS of each text: log of the words, mean ratio, greatest means of passages.

    A text shorter than a passage is one passage, and divided as if it were full.
    ``found`` has values of what is not among the known ones: the low half of a number is the
    32-bit float, the high one three times the place of a word, one more for what its pair adds
    and two more for what its context does.
    """
    out = np.zeros((len(_NUMBERS), len(texts)))
    for first, words, borders in _words(texts):
        at, hit = _find(words, known)
        ratios = np.zeros(len(words))
        ratios[hit] = values[at[hit]]
        size = np.diff(borders)
        rows = slice(first, first + len(size))
        added = np.zeros(len(words))
        if found is not None:
            own = found[rows].fill_null([])
            packed = own.flatten().to_numpy().view(np.uint64)
            place = (packed >> np.uint64(32)).astype(np.int64)
            value = packed.astype(np.uint32).view(np.float32)
            where = np.repeat(borders[:-1], own.value_lengths().to_numpy()) + place // 3
            alone = place % 3 == 0
            for to, of in ((ratios, alone), (added, ~alone)):
                np.add.at(to, where[of], value[of])
        context = _contexts(words, borders)
        for keys in (_pair_key(words, context), _context_key(context)):
            at, hit = _find(keys, pairs)
            added[hit] += pair_values[at[hit]]
        out[0, rows] = np.log1p(size)
        row_of = np.repeat(np.arange(len(size)), size)
        for k, values_of in enumerate((ratios, ratios + added)):
            own = 1 + k * (1 + len(PASSAGES))
            total = np.concatenate([[0.0], np.cumsum(values_of)])
            sums = total[borders[1:]] - total[borders[:-1]]
            out[own, rows] = sums / np.maximum(size, 1)
            for j, n in enumerate(PASSAGES):
                best = sums / n
                start = np.flatnonzero(np.arange(len(words)) + n <= borders[1:][row_of])
                if len(start):
                    passage = (total[start + n] - total[start]) / n
                    row = row_of[start]
                    at = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                    best[row[at]] = np.maximum.reduceat(passage, at)
                out[own + 1 + j, rows] = best
    return [pa.array(x) for x in out]


def _lookups(
    texts: pa.Array, keys: pa.Array, known: Sequence[np.ndarray], bitmaps: Sequence[np.ndarray | None]
) -> Iterator[pa.RecordBatch]:
    """The text's key, 0 for a word or 1 for a pair or context, that, and its places in the
    text as ``_describe`` takes them, for all that are not among the known ones but may be in
    the rest (of words, and of pairs; None: there is no rest)."""
    for first, words, borders in _words(texts):
        size = np.diff(borders)
        row_of = np.repeat(np.arange(len(size)), size)
        place_of = np.arange(len(words)) - borders[:-1][row_of]
        context = _contexts(words, borders)
        for kind, ids in enumerate((words, _pair_key(words, context), _context_key(context))):
            pair = min(kind, 1)
            if bitmaps[pair] is None:
                continue
            other = np.flatnonzero(_may_have(bitmaps[pair], ids))
            other = other[~_find(ids[other], known[pair])[1]]
            row, place, ids = row_of[other], 3 * place_of[other] + kind, ids[other].view(np.int64)
            order = np.lexsort((place, ids, row))
            row, place, ids = row[order], place[order], ids[order]
            new = np.append(True, (row[1:] != row[:-1]) | (ids[1:] != ids[:-1]))[: len(row)]
            at = np.flatnonzero(new)
            ends = np.append(at, len(row))
            for i in range(0, len(at), 100_000):
                some, border = at[i : i + 100_000], ends[i : i + 100_001]
                lists = pa.ListArray.from_arrays(
                    pa.array((border - border[0]).astype(np.int32)), pa.array(place[border[0] : border[-1]])
                )
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(first + row[some])), pa.array(np.full(len(some), pair, np.int32)),
                     pa.array(ids[some]), lists], ["key", "pair", "word", "places"])


def described(docs: DataFrame, text: str, keep: Sequence[str], model: Model, side: int) -> DataFrame:
    """Every row as struct ``row`` of the columns ``keep``, with _NUMBERS by the model."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.words, model.values[side], model.pairs, model.pair_values[side])
    )
    rests = (model.rest, model.pair_rest)
    fields = ", ".join(f"{name} double" for name in _NUMBERS)
    if not any(rests):
        return map_texts(
            docs, text, fields, lambda texts: _describe(texts, *shared.value), keep
        )

    bitmaps = docs.sparkSession.sparkContext.broadcast([rest and rest.bitmap for rest in rests])

    def other(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = shared.value[0], shared.value[2]
            code = batch.column(0).dictionary_encode().indices.to_numpy()
            once = batch.take(pa.array(np.unique(code, return_index=True)[1]))
            yield from _lookups(once.column(1), once.column(0), known, bitmaps.value)
        give_back()

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(2).to_numpy().view(np.uint32).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(own)], ["pair", "word", "bits"])

    value = F.col(f"value_{side}")
    tables = [
        rest.table.select(F.lit(k).alias("pair"), "word", value) for k, rest in enumerate(rests) if rest
    ]
    # Copies of a text have equal words: one of a batch is looked up, and of equal values that
    # copies elsewhere have found one is kept. What this shuffles goes before the texts do.
    key = F.unhex(F.md5(F.coalesce(docs[text], F.lit("")))).alias("key")
    rest = reduce(DataFrame.union, tables).mapInArrow(bits, "pair int, word bigint, bits bigint")
    rare = stored(
        docs.select(key, docs[text].alias("text"))
        .mapInArrow(other, "key binary, pair int, word bigint, places array<bigint>")
        .join(rest, ["pair", "word"])
        .select("key", F.explode("places").alias("place"), "bits")
        .groupBy("key")
        .agg(F.collect_set(F.shiftleft("place", 32).bitwiseOR(F.col("bits"))).alias("found")),
        used_once=True,
    )
    inside = list(keep).index(text) if list(keep).count(text) == 1 else None
    own = [docs[text].alias("text")] if inside is None else []
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), key, *own)
    joined = rows.join(rare, "key", "left").select("row", "found", *["text"] * len(own))
    schema = StructType([joined.schema["row"], *StructType.fromDDL(fields)])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                row, found = batch.columns[:2]
                texts = batch.column(2) if inside is None else row.field(inside)
                out = _describe(texts, *shared.value, found)
                yield pa.RecordBatch.from_arrays([row, *out], names=schema.names)

    return joined.mapInArrow(describe, schema)


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic curve (the last is the constant), by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty @ w
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty
        w -= np.linalg.solve(curve, slope)
    return w


def few_weights(ordinary: int, toxic: int) -> np.ndarray:
    """Weights for labels too few to fit a curve to: those of ``fit_curve``.

    A text without evidence has the share of toxic labels.
    """
    prior = np.log((toxic + 0.5) / (ordinary + 0.5))
    return np.array([FEW_SLOPE * (name == "word_mean") for name in _NUMBERS] + [prior])


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    ident: str = "doc_id",
    label: str = "toxic",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every row as struct ``row``, with ``held_out``, ``score`` and ``predicted``.

    Only labels of rows whose crc32(id) mod 4 is not 2 are learnt from. ``score`` is in
    0 to 1, ``predicted`` is 1 from 0.3. Null and wordless texts get the score of a text
    without evidence. Labels that are null or neither 0 nor 1, and labels of unknown
    ids, are ignored; without any label all scores are 0. Repeated rows each count. Very
    long texts are read whole. Of equal hashes of ids, which choose the sample for the
    curve, the lesser label comes first. An empty table gives an empty result, and columns
    of the input stay inside ``row``.
    """
    marked = with_labels(docs, labels, label, ident, text).where(
        fold(F.col("ident"), FOLDS) != HELD_OUT
    )
    for_fit = F.pmod(F.xxhash64("ident"), F.lit(FIT_SHARE)) == 0
    marked = marked.withColumn("for_fit", for_fit)
    counts = stored(pair_counts(marked), used_once=True)
    totals = _totals(words_of(counts))
    model = word_model(counts, totals)
    for_curve = marked.where("for_fit").withColumn("draw", F.xxhash64("ident", F.lit(3)))
    fit = described(for_curve, "text", ["label", "draw"], model, 0)
    sample = fit.select("row.label", "row.draw", *_NUMBERS)
    sample = sample.orderBy("draw", "label").limit(FIT_ROWS).toPandas()
    if sample["label"].nunique() == 2:
        weights = fit_curve(sample[_NUMBERS].to_numpy(float), sample["label"].to_numpy(float))
    else:
        labels_of = dict(marked.groupBy("label").count().collect())
        weights = few_weights(labels_of.get(0, 0), labels_of.get(1, 0))
    found = described(docs, text, _and(docs, keep, ident), model, 1)
    line = F.lit(float(weights[-1]))
    for name, weight in zip(_NUMBERS, weights[:-1].tolist(), strict=True):
        line = line + F.col(name) * weight
    score = 1 / (1 + F.exp(-line)) if totals[-1].sum else F.lit(0.0)
    return found.select(
        "row", (fold(F.col("row")[ident], FOLDS) == HELD_OUT).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def _and(docs: DataFrame, keep: Sequence[str] | None, ident: str) -> list[str]:
    return list(dict.fromkeys([*(docs.columns if keep is None else keep), ident]))
