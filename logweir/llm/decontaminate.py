"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item; an item of fewer words
is one window. From every text the least hash of its K-word grams in each run of
``WINDOW - K + 1`` grams is kept, so any ``WINDOW`` words shared by a document and an
item share a kept gram. The kept grams of documents are looked up among those of the
benchmark, and only around a hit are whole windows compared. An item shorter than
``WINDOW`` has no winnowing guarantee and is looked up by all grams of its length.

A benchmark of up to ``BROADCAST_WORDS`` words is sent to all tasks as sorted arrays, and
documents are searched in one pass without a shuffle. A larger one stays a table: documents
send their distinct kept grams to be joined with those of the benchmark, only texts that
have a gram in common send the windows around it, and these are joined with the benchmark's
windows. A document's text is looked up once however often it is repeated, and the grams
that very many documents share are spread by a salt. Either way is one pass of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logweir.llm.frames import map_texts, small_batches, stored
from logweir.llm.textbatch import ALPHANUMERIC, chunks, find_words, hash_spans, ngram_hashes

WINDOW = 13
K = 5
#: Words of a benchmark that is sent to the executors; a larger one is joined.
BROADCAST_WORDS = 1_000_000
#: Tasks that the documents with one gram or window are spread over in a join.
SALTS = 16

_FOUND = "n_words bigint, spans array<struct<start:bigint,stop:bigint>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _running(values: np.ndarray, n: int, of=np.minimum) -> np.ndarray:
    """The least (or greatest) of every n consecutive values."""
    width = 1
    while width * 2 <= n:
        values = of(values[:-width], values[width:])
        width *= 2
    rest = n - width
    return of(values[:-rest], values[rest:]) if rest else values


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions of grams that are least in some run of ``width``; all of equal ones."""
    if len(grams) < width:
        return np.arange(len(grams))
    least = _running(grams, width)
    edge = np.zeros(width - 1, dtype=np.uint64)
    reached = _running(np.concatenate([edge, least, edge]), width, np.maximum)
    return np.flatnonzero(reached == grams)


def _by_hash(hashes: list, owners: list) -> tuple[np.ndarray, np.ndarray]:
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, owners = np.concatenate(hashes), np.concatenate(owners).astype(np.int64)
    order = np.lexsort((owners, hashes))
    return hashes[order], owners[order]


class Index:
    """Fingerprints and windows of one block of the benchmark."""

    def __init__(self, ids: list[str], texts: list[str]):
        self.ids = ids
        prints: list = []
        windows: dict[int, tuple[list, list]] = {WINDOW: ([], [])}
        row = 0
        for chunk in chunks(pa.array(texts, pa.large_string())):
            words = find_words(chunk, ALPHANUMERIC)
            hashes = hash_spans(chunk.data, words.start, words.end)
            for first, last in zip(words.first[:-1], words.first[1:], strict=True):
                own = hashes[first:last]
                n = min(len(own), WINDOW)
                if n:
                    whole = np.unique(ngram_hashes(own, n))
                    of_length = windows.setdefault(n, ([], []))
                    of_length[0].append(whole)
                    of_length[1].append(np.full(len(whole), row))
                if n == WINDOW:
                    grams = ngram_hashes(own, K)
                    prints.append(grams[winnow(grams, WINDOW - K + 1)])
                row += 1
        self.prints = np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint64)
        self.windows = {n: _by_hash(*found) for n, found in windows.items()}


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return table[at] == values


def _starts(words: np.ndarray, n: int, index: Index) -> np.ndarray:
    """Where windows of n words may begin: around fingerprint hits, or anywhere if short."""
    if n < WINDOW:
        return np.arange(len(words) - n + 1)
    grams = ngram_hashes(words, K)
    kept = winnow(grams, WINDOW - K + 1)
    met = kept[_member(grams[kept], index.prints)]
    starts = np.unique((met[:, None] - np.arange(WINDOW - K + 1)).ravel())
    return starts[(starts >= 0) & (starts + n <= len(words))]


def _occurrences(words: np.ndarray, text_of: np.ndarray, index: Index) -> Iterator[tuple]:
    """(window length, first words, window hashes) of occurring windows."""
    for n, (table, _) in index.windows.items():
        if len(table) and len(words) >= n and len(starts := _starts(words, n, index)):
            whole = ngram_hashes(words, n)[starts]
            real = (text_of[starts] == text_of[starts + n - 1]) & _member(whole, table)
            if real.any():
                yield n, starts[real], whole[real]


def _union(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, with those that touch joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _search(texts: pa.Array, index: Index) -> list[pa.Array]:
    """Words, spans and items of each text."""
    n_words: list[int] = []
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
    items: list[set[str]] = [set() for _ in range(len(texts))]
    for chunk in chunks(texts):
        words = find_words(chunk, ALPHANUMERIC)
        n_words += words.counts.tolist()
        text_of = words.text
        hashes = hash_spans(chunk.data, words.start, words.end)
        for n, starts, whole in _occurrences(hashes, text_of, index):
            rows = text_of[starts]
            local = starts - words.first[rows]
            for row, a in zip(rows.tolist(), local.tolist(), strict=True):
                spans[chunk.first + row].append((a, a + n))
            table, owners = index.windows[n]
            order = np.lexsort((whole, rows))
            rows, whole = rows[order], whole[order]
            new = np.append(True, (rows[1:] != rows[:-1]) | (whole[1:] != whole[:-1]))
            low = np.searchsorted(table, whole[new], side="left")
            high = np.searchsorted(table, whole[new], side="right")
            for row, a, b in zip(rows[new].tolist(), low.tolist(), high.tolist(), strict=True):
                items[chunk.first + row].update(index.ids[i] for i in owners[a:b].tolist())
    return [
        pa.array(n_words, pa.int64()),
        pa.array([[{"start": a, "stop": b} for a, b in _union(x)] for x in spans], _SPANS),
        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
    ]


def _small_index(items: DataFrame) -> Index | None:
    """The benchmark as an index, or None if it has too many words to be sent."""
    ids: list[str] = []
    texts: list[str] = []
    left = BROADCAST_WORDS
    for key, value in items.toLocalIterator():
        left -= len(value) // 2 + 1  # as many as its words, or more
        if left < 0:
            return None
        ids.append(key)
        texts.append(value)
    return Index(ids, texts)


# Larger benchmarks ---------------------------------------------------------------


def _texts_of_words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Row and word hashes of each text that has words."""
    for chunk in chunks(texts):
        words = find_words(chunk, ALPHANUMERIC)
        hashes = hash_spans(chunk.data, words.start, words.end)
        for row in np.flatnonzero(words.counts).tolist():
            yield chunk.first + row, hashes[words.first[row] : words.first[row + 1]]


def _kept_grams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """K-grams that winnowing keeps, and their positions."""
    grams = ngram_hashes(words, K)
    at = winnow(grams, WINDOW - K + 1)
    return grams[at], at


def _hashed(rows: DataFrame, short: Sequence[int] | None) -> DataFrame:
    """Distinct ``n``, ``hash`` of each ``key``: kept grams as n = 0, and windows.

    Without ``short`` rows are items, and give their windows; with it they are documents,
    and give all runs of words of the lengths in ``short``.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n, found = [], [], []
            for row, words in _texts_of_words(batch.column(1)):
                own = [min(len(words), WINDOW)] if short is None else [x for x in short if x <= len(words)]
                parts = [(x, ngram_hashes(words, x)) for x in own]
                if len(words) >= WINDOW:
                    parts.append((0, _kept_grams(words)[0]))
                for size, values in parts:
                    once = np.unique(values)
                    key.append(np.full(len(once), row))
                    n.append(np.full(len(once), size))
                    found.append(once.view(np.int64))
            if key:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(key))),
                     pa.array(np.concatenate(n), pa.int32()), pa.array(np.concatenate(found))],
                    ["key", "n", "hash"],
                )

    small_batches(rows.sparkSession)
    return rows.select("key", "text").mapInArrow(hashes, "key string, n int, hash bigint")


def _salted_join(found: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of documents joined with the benchmark's, which has each (n, hash) once."""
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int").alias("salt")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    return found.select("*", salt).join(known.select("*", salts), ["n", "hash", "salt"])


def _windows_around(texts: DataFrame) -> DataFrame:
    """``key``, ``n``, ``start``, ``hash`` of windows around the ``hits`` of each text."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column(2).to_pylist()
            key, n, start, found = [], [], [], []
            for row, words in _texts_of_words(batch.column(1)):
                by_size: dict[int, list[int]] = {}
                for hit in hits[row]:
                    by_size.setdefault(hit["n"], []).append(hit["hash"])
                for size, known in by_size.items():
                    known = np.sort(np.array(known, dtype=np.int64).view(np.uint64))
                    if size == 0:
                        size = WINDOW
                        grams, at = _kept_grams(words)
                        met = at[_member(grams, known)]
                        at = np.unique((met[:, None] - np.arange(WINDOW - K + 1)).ravel())
                        at = at[(at >= 0) & (at + size <= len(words))]
                        whole = ngram_hashes(words, size)[at]
                    else:
                        whole = ngram_hashes(words, size)
                        at = np.flatnonzero(_member(whole, known))
                        whole = whole[at]
                    key.append(np.full(len(at), row))
                    n.append(np.full(len(at), size))
                    start.append(at)
                    found.append(whole.view(np.int64))
            if key:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(key))),
                     pa.array(np.concatenate(n), pa.int32()), pa.array(np.concatenate(start), pa.int64()),
                     pa.array(np.concatenate(found))], ["key", "n", "start", "hash"],
                )

    return texts.mapInArrow(windows, "key string, n int, start bigint, hash bigint")


def _by_join(docs: DataFrame, items: DataFrame, text: str, keep: Sequence[str] | None) -> DataFrame:
    """``contamination`` by a benchmark that stays a table."""
    known = stored(_hashed(items.select("key", "text"), None))
    short = [r.n for r in known.where(f"n > 0 AND n < {WINDOW}").select("n").distinct().collect()]
    body = F.coalesce(docs[text], F.lit(""))
    texts = docs.select(F.sha2(body, 256).alias("key"), body.alias("text"))
    wanted = known.where(f"n < {WINDOW}").select("n", "hash").distinct()
    met = _salted_join(_hashed(texts, short).distinct(), wanted)
    hits = met.groupBy("key").agg(F.collect_set(F.struct("n", "hash")).alias("hits"))
    # Of repeated texts one is looked at.
    one = texts.join(hits, "key").groupBy("key").agg(F.first("text").alias("text"), F.first("hits").alias("hits"))
    owners = known.where("n > 0").groupBy("n", "hash").agg(F.collect_set("key").alias("owners"))
    windows = stored(_salted_join(_windows_around(one), owners).select("key", "n", "start", "owners"))
    found = windows.groupBy("key").agg(
        F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("stop"))).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("owners")))).alias("items"),
    )

    def count(values: pa.Array) -> list[pa.Array]:
        n = [c for chunk in chunks(values) for c in find_words(chunk, ALPHANUMERIC).counts.tolist()]
        return [pa.array(n, pa.int64())]

    columns = [docs[c] for c in (docs.columns if keep is None else keep)]
    both = docs.select(
        F.struct(F.struct(*columns, *[] if columns else [F.lit(True).alias("_")]).alias("row"),
                 F.sha2(body, 256).alias("key")).alias("row"),
        docs[text].alias("text"),
    )
    counted = map_texts(both, "text", "n_words bigint", count, ["row"]).select("row.row.*", "n_words")
    rows = counted.join(found, "key", "left").select("row", "n_words", "ranges", "items")
    schema = StructType([rows.schema["row"], *StructType.fromDDL(_FOUND)])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, n_words, ranges, items = batch.columns
            spans = [[{"start": a, "stop": b} for a, b in _union([(x["start"], x["stop"]) for x in own or ()])]
                     for own in ranges.to_pylist()]
            own = pa.array([x or [] for x in items.to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([row, n_words, pa.array(spans, _SPANS), own], schema.names)

    return rows.mapInArrow(merge, schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """What of each document occurs in the benchmark.

    Returns, for every row: ``row`` (struct of the columns ``keep``, default all),
    ``n_words``, ``spans`` (ranges of word positions inside occurrences of windows,
    in order, disjoint) and ``items`` (ids, as strings, of items with an occurring
    window, sorted). Null or wordless texts have 0 words and no spans; wordless items
    match nothing; repeated rows each get their result; an empty benchmark finds
    nothing. A null item id is the string ''. Very long texts are read whole. An empty table
    gives an empty result, and columns of the input stay inside ``row``.
    """
    items = benchmark.select(
        F.coalesce(benchmark[item].cast("string"), F.lit("")).alias("key"),
        F.coalesce(benchmark[item_text], F.lit("")).alias("text"),
    )
    index = _small_index(items)
    if index is None:
        return _by_join(docs, items, text, keep)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    return map_texts(docs, text, _FOUND, lambda texts: _search(texts, shared.value), keep)


def hit_words() -> Column:
    """How many words the spans cover."""
    covered = F.transform("spans", lambda x: x["stop"] - x["start"])
    return F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x)


def is_contaminated() -> Column:
    """At least one word in twenty inside occurrences."""
    return (hit_words() > 0) & (20 * hit_words() >= F.col("n_words"))
