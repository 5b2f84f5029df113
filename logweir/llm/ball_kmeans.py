"""Product codes of vectors, by codebooks that ball k-means trains.

A vector is cut into equal parts; each part position has a codebook, and a part's code is
the nearest entry in it. Training is k-means over all vectors, with ball k-means' way of
assigning parts once a first assignment is known:

* An entry and the parts assigned to it are a ball. When entries have moved, the ball's
  radius is at most its old one and the way its entry moved.
* Only entries nearer to a ball's entry than twice its radius are its neighbours; no other
  entry can be nearest to any of its parts.
* A part nearer to its entry than half the way to the nearest neighbour is in the stable
  core and keeps its code. The ring a part is in, by half the ways to the neighbours in
  order, says how many of them it must be compared with.
* A ball that, with all its neighbours, has not moved is skipped.

All of this is in whole numbers, and a comparison that could tie is made, so codes are
those of comparing every part with every entry (ties go to the lower index).

In Spark: each assignment is one pass of tasks over a table of vectors with their last
codes, which writes the next such table and, once for each task, what has moved: counts
and sums of parts come and gone, and the greatest distance by entry. Those are summed by
Spark to the size of the codebooks, which is all that reaches the driver. Nothing depends
on how rows are dealt to tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from logweir.llm.frames import stored

#: So many different labels are broadcast with their sums; more are joined by a shuffle.
BROADCAST_LABELS = 100_000
#: Vectors handled at once.
_ROWS = 4_000


class Balls(NamedTuple):
    """Codebooks (parts x entries x width) and, after an assignment, what a ball knows.

    ``near`` has the other entries of each entry's part by distance, ``reach`` their
    squared distances, and ``count`` how many of them are neighbours.
    """

    books: np.ndarray
    near: np.ndarray | None = None
    reach: np.ndarray | None = None
    count: np.ndarray | None = None


def _root_up(x: np.ndarray) -> np.ndarray:
    """Least whole numbers that are not below the square roots."""
    flat = [math.isqrt(v - 1) + 1 if v else 0 for v in x.ravel().tolist()]
    return np.array(flat, dtype=np.int64).reshape(x.shape)


def largest(length: int) -> int:
    """Components are held to so much either way, so that no distance overflows."""
    return math.isqrt((1 << 63) // (16 * length)) - 1


def moved_balls(before: np.ndarray, books: np.ndarray, farthest: np.ndarray) -> Balls:
    """Balls of moved entries; ``farthest`` is by squared distance to those before.

    An entry without parts has ``farthest`` -1, and no part asks for its neighbours.
    """
    parts, entries, _ = books.shape
    way = ((books - before) ** 2).sum(axis=2)
    radius = _root_up(np.maximum(farthest, 0)) + _root_up(way)
    between = ((books[:, :, None, :] - books[:, None, :, :]) ** 2).sum(axis=3)
    between[:, np.arange(entries), np.arange(entries)] = -1
    order = np.argsort(between, axis=2, kind="stable")[:, :, 1:]
    reach = np.take_along_axis(between, order, axis=2)
    limit = [4 * r * r for r in radius.ravel().tolist()]  # may be beyond 64 bits
    count = np.array(
        [int(np.searchsorted(row, min(m, (1 << 63) - 1), side="right"))
         for row, m in zip(reach.reshape(parts * entries, -1), limit, strict=True)],
        dtype=np.int64,
    ).reshape(parts, entries)
    still = way == 0
    rank = np.arange(entries - 1)
    around = np.take_along_axis(np.broadcast_to(still[:, None, :], between.shape), order, axis=2)
    quiet = still & (around | (rank >= count[:, :, None])).all(axis=2)
    return Balls(books, order, reach, np.where(quiet, 0, count))


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each point, and its squared distance, by comparing with all."""
    far = ((points[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    code = far.argmin(axis=1)
    return code, far[np.arange(len(points)), code]


def in_rings(points: np.ndarray, last: np.ndarray, balls: Balls, part: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``nearest``, for points whose last code is known."""
    book, reach, count = balls.books[part], balls.reach[part], balls.count[part]
    code, best = last.copy(), ((points - book[last]) ** 2).sum(axis=1)
    # Neighbours no farther than twice the part: by rank among all distances, ball by ball.
    ranks = np.unique(reach)
    step = len(ranks) + 1
    keys = (np.arange(len(book))[:, None] * step + np.searchsorted(ranks, reach)).ravel()
    own = last * step + np.searchsorted(ranks, 4 * best, side="right") - 1
    ring = np.searchsorted(keys, own, side="right") - last * reach.shape[1]
    ring = np.minimum(ring, count[last])
    order = np.argsort(-ring, kind="stable")
    order = order[: int(np.count_nonzero(ring))]
    left = np.cumsum(np.bincount(ring[order])[::-1])[::-1]  # left[k]: with ring >= k
    for k in range(len(left) - 1):
        at = order[: left[k + 1]]
        other = balls.near[part][last[at], k]
        far = ((points[at] - book[other]) ** 2).sum(axis=1)
        better = (far < best[at]) | ((far == best[at]) & (other < code[at]))
        hit = at[better]
        code[hit], best[hit] = other[better], far[better]
    return code, best


def _whole(vectors: pa.ListArray, length: int) -> np.ndarray:
    """Rows of floor(256 x), held to the largest components."""
    x = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * 256)
    most = largest(length)
    return np.clip(x, -most, most).astype(np.int64).reshape(len(vectors), length)


def _length(rows: DataFrame) -> int | None:
    sizes = rows.groupBy(F.size("vector").alias("n")).count()
    first = sizes.where("n > 0").orderBy(F.desc("count"), "n").first()
    return None if first is None else first.n


def _assigned(rows: DataFrame, balls: Balls, first: bool) -> DataFrame:
    """One pass: ``row``, ``whole`` components and new ``code``; and rows of what has moved.

    Where ``row`` is null, ``moved`` has, for one task, by part and entry: parts come less
    those gone, the greatest squared distance (-1: none), and sums of components as counts.
    """
    shared = rows.sparkSession.sparkContext.broadcast(balls)
    row = StructField("row", rows.schema["row"].dataType, True)
    schema = StructType([row, *StructType.fromDDL(
        "whole array<int>, code binary, error bigint, moved struct<count: array<bigint>, "
        "farthest: array<bigint>, sums: array<bigint>>")])  # fmt: skip
    kind = pa.struct([(n, pa.list_(pa.int64())) for n in ("count", "farthest", "sums")])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = shared.value
        parts, entries, width = balls.books.shape
        count = np.zeros((parts, entries), dtype=np.int64)
        farthest = np.full((parts, entries), -1, dtype=np.int64)
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        row_type = None
        for whole_batch in batches:
            row_type = whole_batch.schema.field(0).type
            for at in range(0, whole_batch.num_rows, _ROWS):
                batch = whole_batch.slice(at, _ROWS)
                n = batch.num_rows
                if first:
                    whole = _whole(batch.column(1), parts * width)
                else:
                    whole = batch.column(1).flatten().to_numpy().astype(np.int64).reshape(n, -1)
                    old = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint8)
                    old = old.reshape(n, parts).astype(np.int64)
                code = np.zeros((n, parts), dtype=np.uint8)
                error = np.zeros(n, dtype=np.int64)
                for p in range(parts):
                    points = whole[:, p * width : (p + 1) * width]
                    if first:
                        new, far = nearest(points, balls.books[p])
                        come = np.arange(n)
                    else:
                        new, far = in_rings(points, old[:, p], balls, p)
                        come = np.flatnonzero(new != old[:, p])
                        np.subtract.at(count[p], old[come, p], 1)
                        np.subtract.at(sums[p], old[come, p], points[come])
                    np.add.at(count[p], new[come], 1)
                    np.add.at(sums[p], new[come], points[come])
                    np.maximum.at(farthest[p], new, far)
                    code[:, p] = new
                    error += far
                out = [
                    batch.column(0),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(0, whole.size + 1, parts * width), pa.int32()),
                        pa.array(whole.ravel().astype(np.int32)),
                    ),
                    pa.array([c.tobytes() for c in code], pa.binary()),
                    pa.array(error),
                    pa.nulls(n, kind),
                ]
                yield pa.RecordBatch.from_arrays(out, schema.names)
        if row_type is not None:
            moved = {"count": count.ravel(), "farthest": farthest.ravel(), "sums": sums.ravel()}
            out = [pa.nulls(1, row_type), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.binary()),
                   pa.nulls(1, pa.int64()), pa.array([moved], kind)]
            yield pa.RecordBatch.from_arrays(out, schema.names)

    return rows.mapInArrow(assign, schema)


def _summed(moved: DataFrame, what: str, combine, size: int, start: int) -> np.ndarray:
    """The arrays of all tasks combined by position."""
    by = moved.select(F.posexplode(f"moved.{what}").alias("at", "n")).groupBy("at").agg(combine("n"))
    out = np.full(size, start, dtype=np.int64)
    for at, n in by.collect():
        out[at] = n
    return out


class Compressed(NamedTuple):
    """``rows`` has struct ``row``, ``code`` (a byte for each part) and ``error`` (squared
    distance to what the code stands for); ``books`` is parts x entries x width."""

    rows: DataFrame
    books: np.ndarray


def compressed(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    ident: str = "vec_id",
    vector: str = "embedding",
    keep: Sequence[str] | None = None,
) -> Compressed:
    """Codes of all vectors, by codebooks trained on all of them.

    A component x counts as floor(256 x), held to ``largest(length)`` either way (370,000
    for 64 components), so that no squared distance overflows. Rows whose vector is null or
    holds null, NaN or infinite components are dropped, and so are rows whose vector is
    empty or not as long as most are (of equally frequent lengths the least). A length that
    ``parts`` does not divide is an error. Codebooks start as the vectors of the least
    ``entries`` ids, nulls last, equal ids by their vectors; with fewer vectors they have
    fewer entries. Repeated rows each count. An empty table gives no rows and empty
    codebooks. Columns of the input stay inside ``row``.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    spark = vectors.sparkSession
    columns = [vectors[c] for c in (vectors.columns if keep is None else keep)]
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    # What forall says of a null is null, which drops the row.
    rows = vectors.select(
        F.struct(*columns, *[] if columns else [F.lit(True).alias("_")]).alias("row"),
        vectors[vector].cast("array<double>").alias("vector"),
        vectors[ident].alias("ident"),
    ).where(usable)
    length = _length(rows)
    if length is None:
        schema = StructType([rows.schema["row"], *StructType.fromDDL("code binary, error bigint")])
        return Compressed(spark.createDataFrame([], schema), np.zeros((parts, 0, 0), dtype=np.int64))
    if length % parts:
        raise ValueError(f"vectors of {length} components do not have {parts} equal parts")
    rows = rows.where(F.size("vector") == length)
    least = rows.orderBy(F.col("ident").asc_nulls_last(), "vector").limit(entries)
    start = _whole(least.select("vector").toArrow()["vector"].combine_chunks(), length)
    width = length // parts
    books = np.ascontiguousarray(start.reshape(-1, parts, width).transpose(1, 0, 2))
    shape = books.shape
    balls = Balls(books)
    table = stored(_assigned(rows.select("row", "vector"), balls, first=True))
    counts = np.zeros(shape[:2], dtype=np.int64)
    sums = np.zeros(shape, dtype=np.int64)
    for _ in range(rounds):
        moved = table.where("row IS NULL").select("moved")
        counts += _summed(moved, "count", F.sum, counts.size, 0).reshape(counts.shape)
        sums += _summed(moved, "sums", F.sum, sums.size, 0).reshape(shape)
        farthest = _summed(moved, "farthest", F.max, counts.size, -1).reshape(counts.shape)
        used = counts[:, :, None] > 0
        books = np.where(used, sums // np.maximum(counts, 1)[:, :, None], balls.books)
        balls = moved_balls(balls.books, books, farthest)
        vectors_and_codes = table.where("row IS NOT NULL").select("row", "whole", "code")
        table = stored(_assigned(vectors_and_codes, balls, first=False))
    return Compressed(table.where("row IS NOT NULL").select("row", "code", "error"), balls.books)


def books_sha256(books: np.ndarray) -> str:
    """Digest of all components as decimals, by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(rows: DataFrame, label: Column) -> DataFrame:
    """``rows`` with ``label_error``: ``error`` summed over rows of equal labels (nulls
    together; null if the sum is beyond a long). Sums are combined before the shuffle."""
    rows = stored(rows.withColumn("_label", label))
    sums = rows.groupBy("_label").agg(F.try_sum("error").alias("label_error"))
    if (few := stored(sums)).count() <= BROADCAST_LABELS:
        few = F.broadcast(few)
    few = few.withColumnRenamed("_label", "_of")
    return rows.join(few, F.col("_label").eqNullSafe(F.col("_of"))).drop("_label", "_of")
