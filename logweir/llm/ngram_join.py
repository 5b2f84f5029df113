"""N-gram Jaccard self-join by signature trees.

A document's set is that of its distinct word n-grams. Two documents link when
``100 * |intersection| >= percent * |union|``; components of links are the result.
Documents with one set form a class, and all further work is on classes.

Finding who may link: sizes fall into levels such that linked sets are in one level or
in neighbouring ones. For a level, sets that link differ in at most d grams. Grams are
dealt by hash into d / 2 + 1 groups of three segments and some more, so that in some group
two segments of both sets are equal. Each class has a key for each two segments of a group;
classes with a common key are tied to the least one of them. Components of these ties hold
all links and are the blocks of the join. What keeps texts that only share a passage from
being tied by chance into long chains is that keys are of two segments, and that a class
leaves out those with the fewest grams besides the ones that very many texts have.

Finding links: for each block a signature tree is built over its sets. Nodes hold the
OR of token bitmaps and the range of sizes. Pairs of nodes are walked from the top;
a pair whose maximum possible overlap (common bits, and tokens that share bits) is
below what its sizes need is pruned with all below it. What is left at the leaves is
counted exactly. Pairs already connected are skipped: one link more would not change
the components.

Large blocks are cut by hash into parts of ``PART_TOKENS``. Each part is joined with
itself and its neighbour in a ring; that connects groups of copies in linear time.
Only sets outside the largest component of their block are then compared with all
other parts.

Keys are combined within each batch before they are shuffled, so that a key of many
copies is sent about once for each batch. Nothing that grows with the data is
collected or broadcast; steps end in tables in the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.components import connected, contract, contracted
from logweir.llm.frames import give_back, lanes, map_texts, small_batches, stored
from logweir.llm.textbatch import (
    NON_SPACE, chunks, find_words, hash_spans, mix, ngram_hashes, seeded,
)

#: Grams in one part of a block; parts are joined in one task, two at a time.
PART_TOKENS = 2_000_000
#: So many rows of ids are broadcast to pick documents; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
SALTS = 16
#: Percent of groups of segments beyond those needed; keys of so many groups can be left
#: out where they have the fewest grams.
SPARE = 20
#: Grams that are in the most texts count for nothing when keys are left out: so many, 8
#: bytes each, are broadcast; a gram is counted where so many texts of a batch have it.
COMMON_GRAMS = 1_000_000
LEAST_OF_BATCH = 3
_FAN_OUT = 8
_SLICE_BYTES = 8 << 20
_MOST_BITS = 1 << 16


# Sets -----------------------------------------------------------------------


def gram_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each chunk of texts: first row, distinct gram hashes by row, and row borders.

    A text of fewer than n words has the whole sequence as its one gram; without words
    its set is empty.
    """
    for chunk in chunks(texts):
        words = find_words(chunk, NON_SPACE)
        hashes = hash_spans(chunk.data, words.start, words.end)
        counts = words.counts
        own = np.maximum(counts - n + 1, 0)
        at = np.arange(len(hashes)) - np.repeat(words.first[:-1], counts)
        begins = np.flatnonzero(at < np.repeat(own, counts))
        grams = ngram_hashes(hashes, n)[begins]
        rows = np.repeat(np.arange(chunk.rows), own)
        short = np.flatnonzero((counts > 0) & (counts < n))
        if len(short):
            whole = [
                ngram_hashes(hashes[words.first[r] : words.first[r + 1]], int(counts[r]))[0]
                for r in short.tolist()
            ]
            grams = np.concatenate([grams, np.array(whole, dtype=np.uint64)])
            rows = np.concatenate([rows, short])
        order = np.lexsort((grams, rows))
        grams, rows = grams[order], rows[order]
        new = np.ones(len(grams), dtype=bool)
        new[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
        grams, rows = grams[new], rows[new]
        yield chunk.first, grams, np.searchsorted(rows, np.arange(chunk.rows + 1))


def _sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return total[borders[1:]] - total[borders[:-1]]


def class_ids(grams: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    sizes = np.diff(borders).astype(np.uint64)
    return mix(_sums(seeded(grams, 1), borders) + mix(sizes)).view(np.int64)


def level_borders(percent: int, largest: int) -> np.ndarray:
    """Least sizes of the levels, past the level after that of ``largest``.

    A set links only with sets of its level and of the ones beside it.
    """
    out = [1]
    while len(out) < 4 or out[-3] <= largest:
        out.append(100 * out[-1] // percent + 1)
    return np.array(out, dtype=np.int64)


def level_of(size, percent: int):
    """The level of a size, as a Column."""
    # Levels grow geometrically; those of any size up to 2^40 are listed.
    borders = level_borders(percent, 1 << 40)
    return F.size(F.filter(F.lit(borders.tolist()), lambda b: b <= size))


def segment_keys(
    grams: np.ndarray, borders: np.ndarray, percent: int, common: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every set, for the level of its size and the next.

    Grams are dealt by hash to groups of three segments, and each two segments of a group
    make a key. A gram in which two sets differ spoils one segment, so it takes two of them
    to spoil all keys of a group: of more groups than half the differences, one has an equal
    key. There are SPARE more. So a set may leave out its weakest keys, those of the fewest
    grams that are not among the ``common`` ones (sorted), as long as groups that lose one
    are no more than the spare ones: equal keys have equally many such grams, so what one of
    two sets leaves out among their common keys contains what the other does, or is
    contained in it, and one common key is left. That holds for any choice of ``common``.
    """
    sizes = np.diff(borders)
    limits = level_borders(percent, int(sizes.max(initial=1)))
    level = np.searchsorted(limits, sizes, side="right") - 1
    spread = seeded(grams, 2) >> np.uint64(32)
    values = seeded(grams, 3)
    rare = np.ones(len(grams))
    if common is not None and len(common):
        rare = (common[np.minimum(np.searchsorted(common, grams), len(common) - 1)] != grams) * 1.0
    row_of = np.repeat(np.arange(len(sizes)), sizes)
    rows, keys = [], []
    for step in (0, 1):
        scheme = np.maximum(level, 0) + step
        # Linked sets differ in at most (1 - s) / (1 + s) of the sum of their sizes, and
        # both are below limits[scheme + 1]. If no gram may differ, classes are equal.
        differ = 2 * (100 - percent) * (limits[scheme + 1] - 1) // (100 + percent)
        needed = differ // 2 + 1
        spare = needed * SPARE // 100 + 2
        groups = np.where((sizes > 0) & (differ > 0), needed + spare, 0)
        first = np.concatenate([[0], np.cumsum(groups)])
        used = groups[row_of] > 0
        own = row_of[used]
        part = (spread[used] * (3 * groups[own]).astype(np.uint64)) >> np.uint64(32)
        at = 3 * first[own] + part.astype(np.int64)
        sums = np.zeros(3 * first[-1], dtype=np.uint64)
        np.add.at(sums, at, values[used])
        filled = np.bincount(at, rare[used], minlength=3 * first[-1]).astype(np.int64)
        sums, filled = sums.reshape(-1, 3), filled.reshape(-1, 3)
        row = np.repeat(np.arange(len(sizes)), groups)
        number = (np.arange(first[-1]) - first[row]).astype(np.uint64)
        place = mix((scheme[row].astype(np.uint64) << np.uint64(40)) + number)
        # The two segments of each key, without the third.
        count = filled.sum(axis=1, keepdims=True) - filled
        least = count.min(axis=1)
        kept = count > _weakest(row, least, spare, len(sizes))[row][:, None]
        for k in range(3):
            x, y = sums[:, (k + 1) % 3], sums[:, (k + 2) % 3]
            key = mix(seeded(x, 4) + y + place * np.uint64(2 * k + 1))
            rows.append(row[kept[:, k]])
            keys.append(key[kept[:, k]])
    return np.concatenate(rows), np.concatenate(keys).view(np.int64)


def _weakest(row: np.ndarray, least: np.ndarray, spare: np.ndarray, sets: int) -> np.ndarray:
    """By set, the largest count such that at most ``spare`` groups have a key of no more
    grams (-1: none)."""
    order = np.lexsort((least, row))
    ordered, of = least[order], row[order]
    first = np.searchsorted(of, np.arange(sets))
    many = np.diff(np.append(first, len(of)))
    out = np.full(sets, -1, dtype=np.int64)
    has = np.flatnonzero(many > 0)
    # The first group that must stay; counts below its own may go.
    stays = first[has] + np.minimum(spare[has], many[has] - 1)
    out[has] = ordered[stays] - 1
    return out


# Candidates -----------------------------------------------------------------


def _ties(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each key once, with its least node; and (node, node) for those with a common key."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    least = nodes[new][np.cumsum(new) - 1]
    other = nodes != least
    return keys[new], nodes[new], *contract(nodes[other], least[other])


def common_grams(texts: DataFrame, n: int) -> np.ndarray:
    """The COMMON_GRAMS that are in the most texts of ``text``, sorted.

    Each batch of a task counts the grams that LEAST_OF_BATCH of its texts have. What is
    missed has no effect on results, only on how many texts are tied by chance.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, grams, _ in gram_sets(batch.column(0), n):
                found, times = np.unique(grams, return_counts=True)
                many = times >= LEAST_OF_BATCH
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[many].view(np.int64)), pa.array(times[many])], names=["gram", "n"]
                )
        give_back()

    small_batches(texts.sparkSession)
    counted = texts.select("text").mapInArrow(count, "gram bigint, n bigint").groupBy("gram")
    most = counted.agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(COMMON_GRAMS)
    return np.sort(most.toArrow()["gram"].to_numpy().view(np.uint64))


def _candidate_ties(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Edges ``a``, ``b`` that connect classes of ``text`` with a common key.

    A task sends each key once for each batch, with its least class; in the batch, and
    among the keys of a task after the shuffle, ties are contracted to stars. The keys
    of a task are sorted by Spark and read as a stream.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, grams, borders in gram_sets(batch.column(0), n):
                rows, keys = segment_keys(grams, borders, percent, common.value)
                keys, nodes, a, b = _ties(keys, class_ids(grams, borders)[rows])
                # A tie is a key of its own, of two rows.
                tie = mix(mix(a.view(np.uint64)) ^ b.view(np.uint64)).view(np.int64)
                out = np.concatenate([keys, tie, tie]), np.concatenate([nodes, a, b])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["key", "a"])
        give_back()

    def tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[pa.RecordBatch]:
            last_key, least = None, 0
            for batch in batches:
                key, a = (c.to_numpy() for c in batch.columns)
                if not len(key):
                    continue
                new = np.append(True, key[1:] != key[:-1])
                first = a.copy()
                if key[0] == last_key:  # goes on from the batch before
                    new[0], first[0] = False, least
                at = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
                root = first[at]
                last_key, least = key[-1], int(root[-1])
                other = a != root
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[other]), pa.array(root[other])], names=["a", "b"]
                )

        return contracted(pairs())

    common = texts.sparkSession.sparkContext.broadcast(common_grams(texts, n))
    found = texts.select("text").mapInArrow(keyed, "key bigint, a bigint")
    dealt = found.repartition(lanes(texts.sparkSession), "key").sortWithinPartitions("key", "a")
    return dealt.mapInArrow(tied, "a bigint, b bigint")


# Signature trees ------------------------------------------------------------


class Tree:
    """Levels of nodes, leaves first: OR of bitmaps, least and greatest size, sharing."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        bits = 1024
        while bits < 16 * sizes.max() and bits < _MOST_BITS:
            bits *= 2
        words = np.zeros((len(sets), bits // 64), dtype=np.uint64)
        row = np.repeat(np.arange(len(sets)), sizes)
        bit = np.concatenate(sets) & np.uint64(bits - 1)
        np.bitwise_or.at(
            words, (row, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63))
        )
        # Tokens beyond the first on a bit of a set.
        sharing = sizes - np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        self.levels = [(words, sizes, sizes, sharing)]
        while len(self.levels[-1][1]) > _FAN_OUT:
            words, low, high, sharing = self.levels[-1]
            at = np.arange(0, len(low), _FAN_OUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(words, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(sharing, at),
                )
            )

    def possible(self, level: int, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
        """Which node pairs may hold sets that link, and by how much at most."""
        words, low, high, sharing = self.levels[level]
        small, large = np.maximum(low[x], low[y]), np.minimum(high[x], high[y])
        fits = (100 * high[x] >= percent * low[y]) & (100 * high[y] >= percent * low[x])
        common = np.bitwise_count(words[x] & words[y]).sum(axis=1, dtype=np.int64)
        most = np.minimum(common + np.minimum(sharing[x], sharing[y]), large)
        # overlap / (a + b - overlap) >= percent / 100, for the least a and b.
        del small
        needed = (100 + percent) * most >= percent * (low[x] + low[y])
        return np.where(fits & needed, most, -1)


def _walk(tree: Tree, percent: int, level: int, x: np.ndarray, y: np.ndarray, leaf) -> None:
    """Dual traversal from node pairs of a level down to ``leaf(x, y, most)``."""
    size = max(64, _SLICE_BYTES // (tree.levels[0][0].shape[1] * 8))
    for i in range(0, len(x), size):
        a, b = x[i : i + size], y[i : i + size]
        if level == 0:
            leaf(a, b)
            continue
        keep = tree.possible(level, a, b, percent) >= 0
        a, b = a[keep], b[keep]
        if len(a):
            child = np.arange(_FAN_OUT)
            down = len(tree.levels[level - 1][1])
            p = (a[:, None, None] * _FAN_OUT + child[:, None] + 0 * child).ravel()
            q = (b[:, None, None] * _FAN_OUT + child + 0 * child[:, None]).ravel()
            ok = (p < down) & (q < down) & ((p < q) if level == 1 else (p <= q))
            _walk(tree, percent, level - 1, p[ok], q[ok], leaf)


def tree_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (positions in ``sets``) that connect what all links would connect.

    The sets are sorted arrays of distinct values, none of them empty.
    """
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][0]))
    sets = [sets[i] for i in order]
    tree = Tree(sets)
    label = np.arange(len(sets))
    found: list[tuple[int, int]] = []

    def leaf(x: np.ndarray, y: np.ndarray) -> None:
        apart = label[x] != label[y]
        x, y = x[apart], y[apart]
        most = tree.possible(0, x, y, percent)
        near = np.flatnonzero(most >= 0)
        for k in near[np.argsort(-most[near], kind="stable")].tolist():
            i, j = int(x[k]), int(y[k])
            if label[i] == label[j]:
                continue
            a, b = sets[i], sets[j]
            both = np.sort(np.concatenate([a, b]), kind="stable")
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            if 100 * common >= percent * (len(a) + len(b) - common):
                label[label == label[j]] = label[i]
                found.append((order[i], order[j]))

    top = len(tree.levels) - 1
    nodes = np.arange(len(tree.levels[top][1]))
    x, y = np.meshgrid(nodes, nodes, indexing="ij")
    ok = (x < y) if top == 0 else (x <= y)
    _walk(tree, percent, top, x[ok], y[ok], leaf)
    return found


def _join_parts(members: DataFrame, n: int, percent: int) -> DataFrame:
    """Links ``a``, ``b`` among members (``node``, ``text``) of each (root, zone, part)."""

    def join(table: pa.Table) -> pa.Table:
        texts = table["text"].combine_chunks()
        wanted = table["node"].to_numpy()
        sets: dict[int, np.ndarray] = {}
        for first, grams, borders in gram_sets(texts, n):
            ids = class_ids(grams, borders)
            for r in range(len(borders) - 1):
                if ids[r] == wanted[first + r]:
                    sets.setdefault(int(ids[r]), grams[borders[r] : borders[r + 1]])
        names = list(sets)
        links = tree_links(list(sets.values()), percent) if len(sets) > 1 else []
        a = np.array([names[i] for i, _ in links], dtype=np.int64)
        b = np.array([names[j] for _, j in links], dtype=np.int64)
        give_back()
        return pa.table({"a": a, "b": b})

    # In Spark the rows of a part meet in one task; a part is bounded.
    return members.groupBy("root", "zone", "part").applyInArrow(join, "a bigint, b bigint")


# The join -------------------------------------------------------------------


def _key(docs: DataFrame, text: str, ident: str) -> Column:
    """Hashes of a row's id and text, neither ever null."""
    return F.struct(
        F.xxhash64(docs[ident]).alias("id"), F.xxhash64(docs[text]).alias("text")
    ).alias("key")


def _pick(docs: DataFrame, chosen: DataFrame, text: str, ident: str) -> DataFrame:
    """Rows of ``docs`` (as ``row``) whose key is in ``chosen``, with its columns."""
    few = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), _key(docs, text, ident))
    return rows.join(few, "key")


def jaccard_components(
    docs: DataFrame,
    n: int = 3,
    percent: int = 90,
    text: str = "text",
    ident: str = "doc_id",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every row as struct ``row``, with ``n_shingles``, ``class_id`` and ``component_id``.

    ``component_id`` is the least ``ident`` reachable by links, the row's own included;
    nulls count only where there is nothing else. ``component`` is a key of the
    component (null without words), and ``key`` (two longs) a hash of the row's id and text. Rows without words or text have 0
    n-grams, link with nothing and are their own component. Repeated rows are in one
    component. An empty table gives an empty result.
    """
    columns = list(dict.fromkeys([*(docs.columns if keep is None else keep), ident]))

    def describe(texts: pa.Array) -> list[pa.Array]:
        sizes = np.zeros(len(texts), dtype=np.int64)
        ids = np.zeros(len(texts), dtype=np.int64)
        for first, grams, borders in gram_sets(texts, n):
            stop = first + len(borders) - 1
            sizes[first:stop] = np.diff(borders)
            ids[first:stop] = class_ids(grams, borders)
        return [pa.array(sizes), pa.array(ids)]

    with_key = docs.select(
        F.struct(*[docs[c] for c in columns]).alias("row"),
        docs[text].alias("text"),
        docs[ident].alias("ident"),
        _key(docs, text, ident),
    )
    described = map_texts(
        with_key, "text", "n_shingles bigint, class_id bigint", describe, ["row", "ident", "key"]
    ).select("row.row", "row.ident", "row.key", "n_shingles", "class_id")
    rows = stored(described)

    # One row for each class; its first document stands for it.
    stands = F.min(F.struct(F.col("ident").isNull().alias("no"), "ident", "key"))
    classes = (
        rows.where("n_shingles > 0")
        .groupBy(F.col("class_id").alias("node"))
        .agg(F.first("n_shingles").alias("n"), stands.alias("stands"))
        .select("node", "n", "stands.ident", "stands.key")
    )
    texts = docs.select(docs[text].alias("text"))
    blocks = _with_roots(connected(_candidate_ties(texts, n, percent)))
    links = _links(docs, classes, blocks, n, percent, text, ident)
    return _labelled(rows, classes, connected(links))


def _with_roots(roots: DataFrame) -> DataFrame:
    """Blocks, which hold all links: ``node`` and ``root``, roots too."""
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _links(
    docs: DataFrame, classes: DataFrame, blocks: DataFrame, n: int, percent: int, text: str, ident: str
) -> DataFrame:
    """Links that connect every component, between classes."""
    level = level_of(F.col("n"), percent)
    members = classes.join(blocks, "node").withColumn("level", level)
    # A zone is a level with the next one; a set is in two zones.
    zoned = members.withColumn("zone", F.explode(F.array(F.col("level"), F.col("level") - 1)))
    zones = (
        zoned.groupBy("root", "zone")
        .agg(
            F.sum("n").alias("tokens"),
            F.count("*").alias("sets"),
            F.max((F.col("level") == F.col("zone")).cast("int")).alias("own"),
        )
        .where("sets > 1 AND own = 1")
        .select("root", "zone", F.ceil(F.col("tokens") / PART_TOKENS).cast("int").alias("parts"))
    )
    # The sets of a large block are joined with its row in SALTS tasks, not in one.
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int").alias("salt")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    placed = stored(
        zoned.select("*", salt)
        .join(zones.select("*", salts), ["root", "zone", "salt"])
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .drop("salt")
    )
    def with_texts(sent: DataFrame) -> DataFrame:
        wanted = _pick(docs.select(docs[ident], docs[text]), sent, text, ident)
        return wanted.select(
            "node", F.col("row")[text].alias("text"), "root", F.explode("places").alias("place")
        ).select("node", "text", "root", "place.zone", "place.part")

    def grouped(sent: DataFrame) -> DataFrame:
        places = F.collect_set(F.struct("zone", "part")).alias("places")
        return stored(sent.groupBy("node", "root", "key").agg(places))

    ring = F.explode(
        F.array_distinct(
            F.array("part", F.pmod(F.col("part") - 1, F.col("parts")))
        )
    )
    first = stored(
        _join_parts(with_texts(grouped(placed.withColumn("part", ring))), n, percent)
    )
    wide = placed.where("parts > 2")
    if wide.isEmpty():
        return first
    roots = connected(first)
    labelled = wide.join(
        roots.select("node", F.col("root").alias("component")), "node", "left"
    ).withColumn("component", F.coalesce("component", "node"))
    sizes = labelled.groupBy("root", "zone", "component").agg(F.count("*").alias("size"))
    main = sizes.groupBy("root", "zone").agg(F.max_by("component", F.struct("size", "component")).alias("main"))
    labelled = labelled.join(main, ["root", "zone"])
    rest = labelled.where("component <> main")
    rest_parts = rest.groupBy("root", "zone").agg(
        F.ceil(F.sum("n") / PART_TOKENS).cast("int").alias("rest_parts")
    )
    # Part p of all sets meets part r of the rest in place p * rest_parts + r.
    all_p = F.col("part") * F.col("rest_parts")
    r = F.pmod(F.xxhash64(F.lit(1), F.col("node")), F.col("rest_parts")).cast("int")
    meeting = labelled.join(rest_parts, ["root", "zone"]).select(
        "node", "root", "key", "zone",
        F.explode(
            F.when(
                F.col("component") == F.col("main"),
                F.transform(F.sequence(F.lit(0), F.col("rest_parts") - 1), lambda k: all_p + k),
            ).otherwise(
                F.array_union(
                    F.transform(F.sequence(F.lit(0), F.col("rest_parts") - 1), lambda k: all_p + k),
                    F.transform(
                        F.sequence(F.lit(0), F.col("parts") - 1),
                        lambda p: p * F.col("rest_parts") + r,
                    ),
                )
            )
        ).alias("part"),
    )
    second = _join_parts(with_texts(grouped(meeting)), n, percent)
    return first.unionByName(stored(second))


def _labelled(rows: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    own = classes.join(roots, "node", "left").select(
        "node", "ident", F.coalesce("root", "node").alias("component")
    )
    least = own.groupBy("component").agg(F.min("ident").alias("component_id"))
    labels = own.join(least, "component").select(
        F.col("node").alias("class_id"), "component", "component_id"
    )
    some = rows.where("n_shingles > 0").join(labels, "class_id")
    none = rows.where("n_shingles = 0").select(
        "*", F.lit(None).cast("bigint").alias("component"), F.col("ident").alias("component_id")
    )
    out = ["row", "n_shingles", "class_id", "component", "component_id", "ident", "key"]
    return some.select(*out).unionByName(none.select(*out))


def one_of_each(
    docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", ident: str = "doc_id"
) -> DataFrame:
    """The rows of ``docs``, of each component only one: that with the least ``ident``.

    Of equal ids the row with the least text hash stays, and one of wholly repeated
    rows. Rows without words are linked with nothing and all stay.
    """
    joined = stored(
        jaccard_components(docs, n, percent, text, ident, keep=[ident]).select(
            "n_shingles", "component", "ident", "key"
        )
    )
    first = F.min(F.struct(F.col("ident").isNull().alias("no"), "ident", "key"))
    leaders = (
        joined.where("n_shingles > 0").groupBy("component").agg(first.alias("first")).select("first.key")
    )
    times = joined.where("n_shingles > 0").groupBy("key").agg(F.count("*").alias("times"))
    leaders = stored(leaders.join(times, "key"))
    wordless = joined.where("n_shingles = 0").select("key").distinct()
    chosen = leaders.where("times = 1").select("key").unionByName(wordless)
    kept = _pick(docs, stored(chosen), text, ident).select("row")
    again = leaders.where("times > 1").select("key")
    if not again.isEmpty():
        # Rows repeated as a whole: any one of them.
        number = F.row_number().over(Window.partitionBy("key").orderBy("key"))
        repeated = _pick(docs, again, text, ident).withColumn("number", number)
        kept = kept.unionByName(repeated.where("number = 1").select("row"))
    return kept.select("row.*")
