"""Mixing sources to target weights by Poisson replication.

A source of weight w gets the mean repetition rate r = w / sum of weights * total size
/ size of the source. Each document's count is drawn from Poisson(r) by inverting its
distribution at a uniform number that is a hash of the seed and the document. A rate
above MOST_REPEATS is cut into equal parts, each with a number of its own; their counts
add up to one of Poisson(r), so a source of any size reaches its weight. The document is
repeated that often, and all copies are dealt to random partitions and put
into random order there: a global shuffle, without a sort of everything.

Counts depend on the seed, the id and the rate alone, so a lost executor's rows come
out the same again. Rates are one row for each source; documents are joined with them
by Catalyst's choice (a broadcast only if small by Spark's own threshold), and a hot
source is split by adaptive execution or not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.frames import lanes

#: So many sources are broadcast with their rates; more are joined by a shuffle.
BROADCAST_SOURCES = 10_000
#: The greatest rate at which exp(-rate) is a normal double: above it, counts are summed.
MOST_REPEATS = 700.0
#: Copies of a document that are made from one array at most.
COPY_BLOCK = 10_000
#: Hexadecimal digits of the hash that make a uniform number: 52 bits.
_DIGITS = 13


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) by MD5 of the seed and the parts (null: as the text '')."""
    texts = [F.coalesce(x.cast("string"), F.lit("")) for x in parts]
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *texts)), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(16**_DIGITS))


def poisson_inverse(u: Column, rate: Column) -> Column:
    """The least k with P(X <= k) > u for X of Poisson(rate).

    Terms are added until they are too small to matter: to k = rate + 12 sqrt(rate) + 24,
    beyond which less than 2^-52 of the distribution is left.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    state = F.struct(
        F.exp(-rate).alias("term"), F.lit(0.0).alias("below"), F.lit(0).alias("count")
    )

    def step(a: Column, k: Column) -> Column:
        below = a["below"] + a["term"]
        return F.struct(
            (a["term"] * rate / (k + 1)).alias("term"),
            below.alias("below"),
            (a["count"] + F.when(u >= below, 1).otherwise(0)).alias("count"),
        )

    return F.aggregate(F.sequence(F.lit(0), last), state, step)["count"]


def poisson_count(seed: int, ident: Column, u: Column, rate: Column) -> Column:
    """A count of Poisson(rate) for any rate; ``u`` alone decides up to MOST_REPEATS.

    Beyond, it is the sum of ceil(rate / MOST_REPEATS) counts of equal rates.
    """
    parts = F.ceil(rate / MOST_REPEATS).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(1), parts),
        F.lit(0),
        lambda a, part: a + poisson_inverse(uniform(seed, ident, part), rate / parts),
    )
    return F.when(rate <= MOST_REPEATS, poisson_inverse(u, rate)).otherwise(total)


def repetition_rates(
    docs: DataFrame, weights: Mapping[str | None, float], other: float, source: str, text: str
) -> DataFrame:
    """``of_source`` and ``rate`` for each source of the corpus, by characters of text.

    A source without any text has rate 0, as nothing of it can add to its share.
    """
    sizes = docs.groupBy(docs[source].alias("of_source")).agg(
        F.sum(F.coalesce(F.length(docs[text]), F.lit(0))).alias("chars")
    )
    weight = F.lit(float(other))
    for name, value in weights.items():
        weight = F.when(F.col("of_source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(
            weight
        )
    weighed = sizes.withColumn("weight", weight)
    totals = weighed.where("chars > 0").agg(
        F.sum("weight").alias("all_weight"), F.sum("chars").alias("all_chars")
    )
    share = F.col("weight") / F.col("all_weight") * F.col("all_chars") / F.col("chars")
    # One row of totals: joining it is no product of tables.
    rate = F.when(F.col("chars") > 0, share).otherwise(F.lit(0.0)).alias("rate")
    rates = weighed.join(F.broadcast(totals)).select("of_source", rate)
    few = rates.limit(BROADCAST_SOURCES + 1).collect()
    if len(few) > BROADCAST_SOURCES:
        return rates
    return F.broadcast(docs.sparkSession.createDataFrame(few, rates.schema))


def mixed(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    other: float = 1.0,
    epochs: float = 1.0,
    seed: int = 17,
    source: str = "source",
    ident: str = "doc_id",
    text: str = "text",
    shuffle: bool = True,
) -> DataFrame:
    """Every kept copy as struct ``row``, with ``copy`` (from 0) and ``copies``.

    ``weights`` gives target weights of sources, ``other`` that of all the rest (null
    is a source of its own). ``epochs`` scales all rates, and no rate is too high. Null and empty texts have no
    size but are repeated like others of their source. Rows repeated with one id have
    equal counts. An empty table gives an empty result; a total weight of 0 is an error.
    """
    rates = repetition_rates(docs, weights or {}, other, source, text)
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[source].alias("of_source"),
        uniform(seed, docs[ident]).alias("u"),
        F.xxhash64(F.lit(seed), docs[ident]).alias("draw"),
    )
    rated = rows.alias("d").join(
        rates.alias("r"), F.col("d.of_source").eqNullSafe(F.col("r.of_source"))
    )
    mean = F.col("rate") * epochs
    count = poisson_count(seed, F.col("row")[ident], F.col("u"), mean)
    counted = rated.select("row", "draw", count.alias("copies")).where("copies > 0")
    last = F.col("copies") - 1
    blocks = counted.select(
        "row", "draw", "copies",
        F.explode(F.sequence(F.lit(0), last, F.lit(COPY_BLOCK))).alias("block"),
    )
    end = F.least(F.col("block") + (COPY_BLOCK - 1), last)
    copies = blocks.select(
        "row", "draw", "copies", F.explode(F.sequence("block", end)).alias("copy")
    )
    if shuffle:
        place = copies.withColumn("place", F.xxhash64("draw", "copy"))
        copies = place.repartition(
            lanes(docs.sparkSession), "place"
        ).sortWithinPartitions("place")
    return copies.select("row", "copy", "copies")
