"""How far the words of sources diverge from each other and from their language.

1. Terms of each language that at least ``least_docs`` documents have are kept. They are
   sorted and cut into pieces of PIECE_TERMS; a task makes each piece a minimal acyclic
   transducer that gives each term its lexicographic ordinal.
2. All texts are streamed through the transducers, which are broadcast in blocks of at
   most BLOCK_BYTES, one pass of the texts for each block. Only ordinals and counts leave
   the tasks, and only of kept terms.
3. Each group of a language and a source, and each language as a whole, gives a term the
   whole-number probability ``p = 1 + floor(10^9 (count + 1) / (N + V))``. The divergence
   of a term is ``floor((p - q)^2 / q)``.

Part ``term`` lists the terms a group has more of than its language; ties go by ordinal,
and only then is an ordinal turned into its term, by its transducer. Part ``pair`` has the
sum over all terms for each two sources of a language. Nearly all terms are in few sources,
so each task takes what two sources would have if neither had any term, and adds up the
differences of the terms that one of them has: work in proportion to counts times sources,
with one row for each two sources from a task, and no pairs of rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.frames import lanes, stored
from logweir.llm.textbatch import byte_class, chunks, find_words
from logweir.llm.transducer import Transducer, build, stack

LEAST_DOCS = 3
TOP_TERMS = 200
#: Terms of one piece of the vocabulary.
PIECE_TERMS = 50_000
#: Bytes of transducers that are broadcast at once.
BLOCK_BYTES = 64 << 20
#: Groups are broadcast up to so many; their results are the square of them.
BROADCAST_GROUPS = 100_000
_CHUNK_BYTES = 4 << 20
_CELLS = 1 << 20
_SCALE = 1_000_000_000

#: ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``: letters A-Z and a-z, and all beyond ASCII.
LETTERS = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


# Terms of texts ----------------------------------------------------------------


def _terms(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
    """For each chunk: first row, row of each word, its place among the terms, the terms."""
    for chunk in chunks(texts, _CHUNK_BYTES):
        words = find_words(chunk, LETTERS)
        data = _LOWER[chunk.data[LETTERS[chunk.data]]]
        offsets = np.concatenate([[0], np.cumsum(words.end - words.start)])
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(words.start), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        ).dictionary_encode()
        yield chunk.first, words.text, found.indices.to_numpy().astype(np.int64), found.dictionary


def _groups(*columns: pa.Array) -> tuple[np.ndarray, list[tuple[str, ...]]]:
    """The number of each row's values, and the values of each number."""
    number: dict[tuple[str, ...], int] = {}
    rows = zip(*(c.to_pylist() for c in columns), strict=True)
    return np.array([number.setdefault(x, len(number)) for x in rows], dtype=np.int64), list(number)


def _docs_with(docs: DataFrame) -> DataFrame:
    """``lang``, ``term`` (binary) and ``n_docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, names = _groups(batch.column(0))
            langs = pa.array([n for n, in names], pa.string())
            for first, row, term, terms in _terms(batch.column(2)):
                if not len(terms):
                    continue
                once = np.unique(row * len(terms) + term)
                row, term = np.divmod(once, len(terms))
                seen, times = np.unique(group[first + row] * len(terms) + term, return_counts=True)
                lang, term = np.divmod(seen, len(terms))
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(lang)), terms.take(pa.array(term)).cast(pa.binary()), pa.array(times)],
                    ["lang", "term", "n"],
                )

    found = docs.mapInArrow(count, "lang string, term binary, n bigint")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n_docs"))


# The vocabulary ------------------------------------------------------------------


def _pieces(kept: DataFrame) -> DataFrame:
    """Transducers of ``lang`` from term ``first`` on, in the order of ``piece``."""
    names = ["lang", "piece", "first", "n_terms", "root", "keys", "target", "skip", "final"]

    def piece(lang: str, number: int, terms: list[bytes]) -> pa.RecordBatch:
        made, root = build(terms)
        values = [lang, number, terms[0], len(terms), root, *(a.tobytes() for a in made)]
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names
        )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        of, terms = "", []
        for batch in batches:
            for lang, term in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if terms and (lang != of or len(terms) == PIECE_TERMS):
                    yield piece(of, number, terms)
                    number, terms = number + 1, []
                of = lang
                terms.append(term)
        if terms:
            yield piece(of, number, terms)

    parts = kept.count() // PIECE_TERMS + 1
    ordered = kept.select("lang", "term").repartitionByRange(parts, "lang", "term")
    return ordered.sortWithinPartitions("lang", "term").mapInArrow(
        make, "lang string, piece bigint, first binary, n_terms bigint, root bigint, "
        "keys binary, target binary, skip binary, final binary"
    )


class Vocabulary(NamedTuple):
    """A block of pieces: stacked arrays, and by language the pieces' first terms, roots
    and ordinals of first terms, in order."""

    arcs: Transducer
    by_lang: dict[str, tuple[list[bytes], np.ndarray, np.ndarray]]

    def ordinals(self, lang: str, terms: pa.Array) -> np.ndarray:
        """The ordinal of each of the terms (distinct) in a language's vocabulary, or -1."""
        out = np.full(len(terms), -1, dtype=np.int64)
        if lang not in self.by_lang or not len(terms):
            return out
        first, roots, bases = self.by_lang[lang]
        terms = terms.cast(pa.large_binary())
        order = pc.array_sort_indices(terms)
        ordered = terms.take(order)
        cuts = [bisect_left(ordered, term, key=lambda x: x.as_py()) for term in first]
        piece = np.repeat(np.arange(len(first)), np.diff([*cuts, len(ordered)]))
        _, offsets, data = ordered.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[ordered.offset :][cuts[0] : len(ordered) + 1]
        data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
        found = self.arcs.ordinals(data, offsets[:-1], offsets[1:], roots[piece])
        out[order.to_numpy()[cuts[0] :]] = np.where(found >= 0, found + bases[piece], -1)
        return out

    def term(self, lang: str, ordinal: int) -> str | None:
        """The term of an ordinal, if its piece is in this block."""
        if lang not in self.by_lang:
            return None
        _, roots, bases = self.by_lang[lang]
        k = int(np.searchsorted(bases, ordinal, side="right")) - 1
        if k < 0 or k == len(roots) - 1:  # the last base is where the block ends
            return None
        return self.arcs.word(ordinal - int(bases[k]), int(roots[k])).decode()


def _blocks(pieces: DataFrame) -> Iterator[Vocabulary]:
    """The pieces in blocks of BLOCK_BYTES, as vocabularies to broadcast."""
    arrays = ["keys", "target", "skip", "final"]
    size = sum((F.octet_length(a) for a in arrays), F.lit(0)).alias("bytes")
    known = pieces.select("lang", "piece", "n_terms", size).orderBy("lang", "piece").collect()
    blocks, base, used = [], {}, BLOCK_BYTES
    for p in known:
        if used + p.bytes > BLOCK_BYTES:
            blocks.append([])
            used = 0
        blocks[-1].append((p.lang, p.piece, base.get(p.lang, 0), p.n_terms))
        used += p.bytes
        base[p.lang] = base.get(p.lang, 0) + p.n_terms
    for block in blocks:
        low, high = block[0][:2], block[-1][:2]
        at = F.struct("lang", "piece")
        inside = pieces.where(
            (at >= F.struct(F.lit(low[0]).alias("lang"), F.lit(low[1]).alias("piece")))
            & (at <= F.struct(F.lit(high[0]).alias("lang"), F.lit(high[1]).alias("piece")))
        ).orderBy("lang", "piece")
        rows = inside.collect()
        kinds = (np.int64, np.int32, np.int32, bool)
        arcs, moves = stack(
            [Transducer(*(np.frombuffer(r[a], dtype=k) for a, k in zip(arrays, kinds, strict=True)))
             for r in rows]
        )
        by_lang: dict = {}
        for (lang, _, start, n), row, move in zip(block, rows, moves, strict=True):
            first, roots, bases = by_lang.setdefault(lang, ([], [], []))
            first.append(bytes(row["first"]))
            roots.append(row["root"] + move)
            bases[len(roots) - 1 :] = [start, start + n]
        # One root more than pieces keeps roots and bases of one length.
        yield Vocabulary(
            arcs, {k: (f, np.array([*r, 0]), np.array(b)) for k, (f, r, b) in by_lang.items()}
        )


def _counted(docs: DataFrame, shared) -> DataFrame:
    """``lang``, ``source``, ``ordinal`` and ``n`` occurrences, for a broadcast block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Vocabulary = shared.value
        for batch in batches:
            group, names = _groups(batch.column(0), batch.column(1))
            lang_of, langs = _groups(pa.array([lang for lang, _ in names], pa.string()))
            found = [np.zeros((3, 0), dtype=np.int64)]
            for first, row, term, terms in _terms(batch.column(2)):
                if not len(terms):
                    continue
                own, times = np.unique(group[first + row] * len(terms) + term, return_counts=True)
                own, term = np.divmod(own, len(terms))
                ordinal = np.full(len(own), -1, dtype=np.int64)
                for k, (lang,) in enumerate(langs):
                    at = np.flatnonzero(lang_of[own] == k)
                    once, back = np.unique(term[at], return_inverse=True)
                    ordinal[at] = block.ordinals(lang, terms.take(pa.array(once)))[back]
                hit = ordinal >= 0
                found.append(np.stack([own[hit], ordinal[hit], times[hit]]))
            own, ordinal, times = np.concatenate(found, axis=1)
            order = np.lexsort((ordinal, own))
            own, ordinal, times = own[order], ordinal[order], times[order]
            new = np.append(True, (own[1:] != own[:-1]) | (ordinal[1:] != ordinal[:-1]))
            at = np.flatnonzero(new[: len(own)])
            if len(at):
                lang, source = (pa.array([n[k] for n in names], pa.string()) for k in (0, 1))
                of = pa.array(own[at])
                yield pa.RecordBatch.from_arrays(
                    [lang.take(of), source.take(of), pa.array(ordinal[at]), pa.array(np.add.reduceat(times, at))],
                    ["lang", "source", "ordinal", "n"],
                )

    found = docs.mapInArrow(count, "lang string, source string, ordinal bigint, n bigint")
    return found.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


# Divergences ---------------------------------------------------------------------


def _p(count: Column | str, total: str, kept: str) -> Column:
    """1 + floor(10^9 (count + 1) / (total + kept)), without overflow."""
    up = F.col(count) if isinstance(count, str) else count
    times = F.lit(_SCALE).cast("decimal(10,0)") * (up + 1).cast("decimal(20,0)")
    below = (F.col(total) + F.col(kept)).cast("decimal(20,0)")
    return (F.call_function("div", times, below) + 1).cast("bigint")


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class Sources(NamedTuple):
    """Of a language: its sources' places, and p of a term that a source does not have."""

    place: dict[str, int]
    none: np.ndarray


def differences(sources: Sources, term: np.ndarray, source: np.ndarray, p: np.ndarray) -> np.ndarray:
    """By group and other source: what given terms (ascending numbers from 0) add to the
    divergence of two sources that both have none of them."""
    size = len(sources.none)
    p0 = sources.none
    both_none = (p0[:, None] - p0[None, :]) ** 2 // p0[None, :]
    out = np.zeros((size, size), dtype=np.int64)  # by group, then other
    back = np.zeros((size, size), dtype=np.int64)  # by other, then group
    step = max(1, _CELLS // size)
    edges = np.append(np.flatnonzero(np.append(True, term[1:] != term[:-1])), len(term))
    low = 0
    while low < len(edges) - 1:
        high = min(max(int(np.searchsorted(edges, edges[low] + step, side="right")) - 1, low + 1), len(edges) - 1)
        rows = slice(edges[low], edges[high])
        t, s, own = term[rows] - term[edges[low]], source[rows], p[rows]
        at = np.searchsorted(np.unique(t), t)
        all_p = np.tile(p0, (high - low, 1))
        has = np.zeros((high - low, size), dtype=bool)
        all_p[at, s] = own
        has[at, s] = True
        q = all_p[at]
        gained = (own[:, None] - q) ** 2 // q - both_none[s]
        np.add.at(out, s, gained)
        # Groups without the term, against the source that has it.
        gained = (p0[None, :] - own[:, None]) ** 2 // own[:, None] - both_none[:, s].T
        np.add.at(back, s, np.where(has[at], 0, gained))
        low = high
    return out + back.T


def _pair_sums(counts: DataFrame, shared) -> DataFrame:
    """``lang``, ``source``, ``item`` (other source) and the sum of ``differences``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[str, Sources] = shared.value
        sums: dict[str, np.ndarray] = {}
        left: pa.Table | None = None

        def take(table: pa.Table) -> None:
            langs = table["lang"].combine_chunks().dictionary_encode()
            lang_of = langs.indices.to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                own = table.filter(pa.array(lang_of == k))
                known = groups[lang]
                names = own["source"].combine_chunks().dictionary_encode()
                place = np.array([known.place[s] for s in names.dictionary.to_pylist()])
                found = differences(
                    known, own["ordinal"].to_numpy(), place[names.indices.to_numpy()], own["p"].to_numpy()
                )
                sums[lang] = sums[lang] + found if lang in sums else found

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([left, table]) if left is not None else table
            # The last term may go on in the next batch.
            last = table.slice(table.num_rows - 1).to_pylist()[0] if table.num_rows else None
            if last is None:
                continue
            ordinal = table["ordinal"].to_numpy()
            same = (ordinal == last["ordinal"]) & pc.equal(table["lang"], last["lang"]).to_numpy()
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            take(table.slice(0, cut))
            left = table.slice(cut)
        if left is not None:
            take(left)
        for lang, found in sums.items():
            names = sorted(groups[lang].place, key=groups[lang].place.get)
            for k, source in enumerate(names):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names)), pa.array([source] * len(names)), pa.array(names), pa.array(found[k])],
                    ["lang", "source", "item", "more"],
                )

    columns = "lang string, source string, item string, more bigint"
    found = counts.select("lang", "ordinal", "source", "p").mapInArrow(add, columns)
    return found.groupBy("lang", "source", "item").agg(F.sum("more").alias("more"))


def _decoded(terms: DataFrame, shared) -> DataFrame:
    """Rows of ``terms`` whose ordinal is in the broadcast block, with ``item``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Vocabulary = shared.value
        for batch in batches:
            found = [block.term(*x) for x in zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True)]
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names)
            yield out.filter(out.column("item").is_valid())

    terms = terms.select("lang", "ordinal", "source", "value", "rank")
    names = [*terms.columns, "item"]
    schema = ", ".join(f"{n} {t}" for n, t in terms.dtypes) + ", item string"
    return terms.mapInArrow(decode, schema)


def source_audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value`` and ``rank``.

    Null texts, languages and sources count as ''. Every (language, source) that occurs is
    a group, also without texts or terms. Part ``pair``: for each other source of the
    language the divergence from it over all kept terms, 0 where none is kept. Part
    ``term``: the ``top`` kept terms with the largest divergence from the language among
    those the group has and has more of. Ranks count from 1 by falling value; ties go by
    the item's UTF-8 bytes. Repeated rows each count as documents. Very long texts are read
    whole, and so are very long terms. An empty table gives an empty result, and other
    columns are not looked at. The sources of a language are held in each task as one
    square, which is what the result has of them.
    """
    blank = lambda name: F.coalesce(docs[name].cast("string"), F.lit(""))
    texts = docs.select(blank(lang).alias("lang"), blank(source).alias("source"), blank(text).alias("text"))
    kept = stored(_docs_with(texts).where(F.col("n_docs") >= least_docs))
    pieces = stored(_pieces(kept))
    spark = docs.sparkSession
    shared = [spark.sparkContext.broadcast(block) for block in _blocks(pieces)]
    counts = spark.createDataFrame([], "lang string, source string, ordinal bigint, n bigint")
    for block in shared:
        counts = counts.unionByName(_counted(texts, block))
    counts = stored(counts)

    sizes = pieces.groupBy("lang").agg(F.sum("n_terms").alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        texts.select("lang", "source").distinct()
        .join(sizes, "lang", "left")
        .join(totals, ["lang", "source"], "left")
        .fillna(0, ["kept", "total"])
    )
    none = F.when(F.col("kept") > 0, _p(F.lit(0), "total", "kept"))
    groups = stored(groups.withColumn("none", none))
    of_lang = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    few = F.broadcast if groups.count() <= BROADCAST_GROUPS else lambda x: x
    by_lang: dict[str, Sources] = {}
    for g in groups.where("kept > 0").orderBy("lang", "source").collect():
        place, nones = by_lang.setdefault(g.lang, Sources({}, []))
        place[g.source] = len(place)
        nones.append(g.none)
    by_lang = {k: Sources(v.place, np.array(v.none, dtype=np.int64)) for k, v in by_lang.items()}

    # All sources of a term meet: they are at most as many as the language has.
    with_p = (
        counts.join(few(groups.drop("none")), ["lang", "source"])
        .withColumn("p", _p("n", "total", "kept"))
        .repartition(lanes(spark), "lang", "ordinal")
    )
    in_all = F.sum("n").over(Window.partitionBy("lang", "ordinal"))
    with_q = (
        with_p.withColumn("in_all", in_all)
        .join(few(of_lang), "lang")
        .withColumn("q", _p("in_all", "lang_total", "kept"))
        .where("p > q")
        .select("lang", "source", "ordinal", _f(F.col("p"), F.col("q")).alias("value"))
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    tops = stored(with_q.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top))
    out = ["lang", "source", "part", "item", "value", "rank"]
    terms = spark.createDataFrame([], "lang string, source string, item string, value bigint, rank int")
    for block in shared:
        terms = terms.unionByName(_decoded(tops, block).select(terms.columns))

    more = _pair_sums(with_p.sortWithinPartitions("lang", "ordinal"), spark.sparkContext.broadcast(by_lang))
    other = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("other_none"))
    base = F.when(F.col("kept") > 0, F.col("kept") * _f(F.col("none"), F.col("other_none"))).otherwise(0)
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (
        groups.join(other, "lang")
        .where("source <> item")
        .join(more, ["lang", "source", "item"], "left")
        .withColumn("value", (base + F.coalesce("more", F.lit(0))).cast("bigint"))
        .withColumn("rank", F.row_number().over(ranked))
    )
    return (
        pairs.withColumn("part", F.lit("pair")).select(out)
        .unionByName(terms.withColumn("part", F.lit("term")).select(out))
    )
