"""Quality rules: counts of a text, and its distance from its language.

Each document gets counts (words, symbols, repeated lines and word windows) and two
histograms, of character classes and of common words. The mean of those of a language's
documents is its reference. It is made twice, the second time from the half that is
nearer to the first, so that junk does not bend it. A document is kept if it passes the
base rules and is near its reference: the Jensen-Shannon distance (base 2, 0 to 1) of each
histogram is at most a limit. A histogram with too few entries says nothing and is not
judged: that is the minimum-length guard.

Histograms are written as one narrow row for each document to the shared scratch
folder, so texts are read once, for the references and the verdicts alike. References
are one row for each language: up to BROADCAST_LANGUAGES are broadcast, more are
joined by a shuffle.

Native: DataFrame functions only. Values used more than once are put behind an explode
of one element, which keeps Catalyst from copying their expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.frames import stored

# Common words of the four languages of the corpus.
COMMON_WORDS = (
    "the", "and", "of", "to", "in", "is", "that", "was", "for", "with",
    "der", "die", "und", "das", "ist", "ein", "nicht", "mit", "von", "zu",
    "le", "la", "les", "de", "des", "et", "en", "que", "dans", "pour",
    "el", "los", "las", "del", "y", "es", "por", "con", "un", "una",
)

#: Greatest Jensen-Shannon distances of documents that are kept. Words drawn from the
#: reference itself are off by about 1 / sqrt(words), so that much more is allowed, and
#: characters, which come in words, by somewhat less.
CLASS_LIMIT = 0.18
CLASS_NOISE = 0.7
WORD_LIMIT = 0.2
WORD_NOISE = 1.0
#: Entries that a histogram needs to be judged.
LEAST_CHARS = 200
LEAST_WORDS = 50
BROADCAST_LANGUAGES = 10_000
#: Distances are told apart in so many steps from 0 to 1 where their middle is looked for.
STEPS = 1_000_000

_SPACE = r"[\x20\x09-\x0D]+"
CLASSES = ("space", "lower", "upper", "digit", "symbol", "punctuation", "other")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _fenced(frame: DataFrame, **values: Column) -> DataFrame:
    """Adds columns whose expressions are computed once."""
    packed = F.struct(*[v.alias(k) for k, v in values.items()])
    held = frame.select("*", F.explode(F.array(packed)).alias("_"))
    return held.select(*frame.columns, *[F.col(f"_.{k}").alias(k) for k in values])


def _without(text: Column, chars: str) -> Column:
    return F.regexp_replace(text, chars, "")


def _repeated_windows(windows: Column, repeated: Column) -> Column:
    """Positions of windows that occur twice or more, in order.

    A few repeated values are looked for in place. Where there are many, windows are
    sorted with their positions, so that the work stays in proportion to n log n.
    """
    none = F.array().cast("array<int>")
    few = F.filter(
        F.sequence(F.lit(0), F.size(windows) - 1),
        lambda i: F.array_contains(repeated, F.get(windows, i)),
    )
    placed = F.array(
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    )

    def equal_to_neighbour(placed: Column) -> Column:
        same = F.filter(
            placed,
            lambda x, k: (F.get(placed, k - 1)["h"] == x["h"])
            | F.coalesce(F.get(placed, k + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    many = F.get(F.transform(placed, equal_to_neighbour), F.lit(0))
    return F.when(F.size(repeated) == 0, none).when(F.size(repeated) <= 64, few).otherwise(many)


def text_counts(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (struct of ``keep``), the COUNTS, and the arrays ``classes`` and ``common``."""
    columns = docs.columns if keep is None else list(keep)
    frame = docs.select(
        F.struct(*[docs[c] for c in columns]).alias("row"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
    )
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    frame = _fenced(
        frame,
        words=F.array_remove(F.split("text", _SPACE, -1), ""),
        lines=lines,
        solid=_without(F.col("text"), _SPACE),
    )
    frame = _fenced(
        frame.withColumn("length", F.length("text")).drop("text"),
        n=F.size("words"),
        rest=_without(F.col("solid"), "[a-z]+"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
    )
    windows = F.transform(
        F.slice("words", 1, F.greatest(F.col("n") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
    )
    bins = F.transform(
        F.filter("words", lambda w: w.isin(*COMMON_WORDS)),
        lambda w: F.array_position(F.lit(list(COMMON_WORDS)), w),
    )
    word_chars = F.length("solid")
    beyond_ascii = F.length(_without(F.col("rest"), r"[\x00-\x7F]+"))
    upper = F.length(_without(F.col("rest"), "[^A-Z]+"))
    digit = F.length(_without(F.col("rest"), "[^0-9]+"))
    symbol = F.length(_without(F.col("rest"), "[^#*$%&|<>]+"))
    frame = _fenced(
        frame, windows=windows, bins=bins, upper=upper, digit=digit, symbol=symbol,
        beyond=beyond_ascii, word_chars=word_chars, n_rest=F.length("rest"),
    ).drop("words", "lines", "solid", "rest")
    frame = _fenced(frame, ordered=F.sort_array("windows"))
    same = F.filter("ordered", lambda x, i: (i > 0) & (F.get("ordered", i - 1) == x))
    frame = _fenced(frame, repeated=F.array_distinct(same)).drop("ordered")
    frame = _fenced(
        frame, at=_repeated_windows(F.col("windows"), F.col("repeated"))
    ).drop("windows", "repeated")
    # Words of the first window, then of each next those that are not in the one before.
    covered = F.aggregate(
        "at",
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(i - a["last"], F.lit(3))).alias("n")
        ),
    )["n"]
    long = [
        F.col("length") - F.col("word_chars"),
        F.col("word_chars") - F.col("n_rest"),
        F.col("upper"),
        F.col("digit"),
        F.col("symbol"),
        F.col("n_rest") - F.col("upper") - F.col("digit") - F.col("symbol") - F.col("beyond"),
        F.col("beyond"),
    ]
    common = [
        F.size("bins") - F.size(F.array_remove("bins", F.lit(k + 1).cast("bigint")))
        for k in range(len(COMMON_WORDS))
    ]
    listed = F.size("bins")
    return frame.select(
        "row",
        F.col("n").cast("bigint").alias("n_words"),
        F.col("word_chars").cast("bigint").alias("word_chars"),
        F.col("symbol").cast("bigint").alias("n_symbols"),
        "n_dup_lines",
        covered.cast("bigint").alias("n_repeat_words"),
        F.array(*long).cast("array<bigint>").alias("classes"),
        F.array(*common, F.col("n") - listed).cast("array<bigint>").alias("common"),
    )


def base_failed() -> Column:
    """Under 50 words, or over half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.transform(counts, lambda x: x / F.greatest(total, F.lit(1)))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence, base 2, of two lists of shares."""
    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    parts = F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2)
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def _few(table: DataFrame) -> DataFrame:
    """A table by language: broadcast if its rows are few."""
    rows = table.limit(BROADCAST_LANGUAGES + 1).collect()
    if len(rows) > BROADCAST_LANGUAGES:
        return table
    return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema))


def references(counts: DataFrame) -> DataFrame:
    """``of_lang`` and the mean shares ``class_ref`` and ``word_ref`` of its documents.

    Each document with words weighs the same, so that no long one decides. Those count
    that ``trusted`` marks, or all where it marks none. Shares are added up as whole
    millionths, so the sums do not depend on their order.
    """

    def sums(name: str, size: int, only: Column) -> Column:
        share = _shares(F.col(name))
        whole = F.transform(share, lambda x: F.round(x * 1_000_000).cast("bigint"))
        return F.array(
            *[F.sum(F.when(only, F.get(whole, F.lit(i))).otherwise(0)) for i in range(size)]
        )

    worded = counts.where("n_words > 0")
    some = F.bool_or("trusted")

    def best(name: str, size: int) -> Column:
        return _shares(
            F.when(some, sums(name, size, F.col("trusted"))).otherwise(
                sums(name, size, F.lit(True))
            )
        )

    shares = worded.groupBy(F.col("lang").alias("of_lang")).agg(
        best("classes", len(CLASSES)).alias("class_ref"),
        best("common", len(COMMON_WORDS) + 1).alias("word_ref"),
    )
    return _few(shares)


def _measured(counts: DataFrame) -> DataFrame:
    """With distances from the references; null for a language without words."""
    near = counts.join(references(counts), F.col("lang").eqNullSafe(F.col("of_lang")), "left")
    return near.select(
        *counts.columns,
        js_distance(_shares(F.col("classes")), F.col("class_ref")).alias("class_distance"),
        js_distance(_shares(F.col("common")), F.col("word_ref")).alias("word_distance"),
    )


def _is_near() -> Column:
    total = F.aggregate("classes", F.lit(0).cast("bigint"), lambda a, x: a + x)
    word_limit = WORD_LIMIT + WORD_NOISE / F.sqrt("n_words")
    class_limit = CLASS_LIMIT + CLASS_NOISE / F.sqrt(F.greatest(total, F.lit(1)))
    odd_chars = (total >= LEAST_CHARS) & (F.col("class_distance") > class_limit)
    odd_words = (F.col("n_words") >= LEAST_WORDS) & (F.col("word_distance") > word_limit)
    return ~F.coalesce(odd_chars, F.lit(False)) & ~F.coalesce(odd_words, F.lit(False))


def _middle(rows: DataFrame) -> DataFrame:
    """``of_lang`` and ``middle``: the least step that at least half of the rows do not pass.

    Exact and of any order of rows: steps are counted by language, STEPS rows at most.
    """
    counted = rows.groupBy(F.col("lang").alias("of_lang"), "step").agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("of_lang").orderBy("step"))
    in_all = F.sum("n").over(Window.partitionBy("of_lang"))
    return (
        counted.withColumn("so_far", so_far).withColumn("in_all", in_all)
        .where("2 * so_far >= in_all")
        .groupBy("of_lang").agg(F.min("step").alias("middle"))
    )


def judged(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every row as struct ``row``, with the COUNTS, distances and ``kept``.

    ``class_distance`` and ``word_distance`` are from the reference of the row's
    language (null is a language of its own). ``base_failed`` are the base rules;
    ``kept`` needs them passed and each distance within its limit, or its histogram
    too small. Null, empty and wordless texts have counts of 0 and fail the base
    rules. Repeated rows each count. An empty table gives an empty result.
    """
    columns = list(dict.fromkeys([*(docs.columns if keep is None else keep), lang]))
    counts = stored(text_counts(docs, text, columns).withColumn("lang", F.col("row")[lang]))
    first = _measured(counts.withColumn("trusted", ~base_failed()))
    first = first.withColumn("step", F.floor(F.col("class_distance") * STEPS).cast("int"))
    middle = _middle(first.where("trusted AND step IS NOT NULL"))
    halved = first.join(_few(middle), F.col("lang").eqNullSafe(F.col("of_lang")), "left")
    trusted = F.coalesce(
        F.col("trusted") & (F.col("step") <= F.col("middle")), F.lit(False)
    )
    again = _measured(halved.select(*counts.columns, trusted.alias("trusted")))
    return again.select(
        "row", *COUNTS,
        base_failed().alias("base_failed"), "class_distance", "word_distance",
        (~base_failed() & _is_near()).alias("kept"),
    )
