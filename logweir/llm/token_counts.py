"""Token counts of texts by a public tokenizer, without making ids of whole texts.

A tokenizer cuts a text into pre-tokens (roughly words) and each pre-token into pieces,
whatever stands around it. So a text's count is the sum, over its different pre-tokens,
of how often each occurs times its pieces:

1. different pre-tokens of all texts, counted by texts, combined in each task before
   they are shuffled;
2. the pieces of each different pre-token, once, as a table;
3. each text's pre-token frequencies, joined with that table and summed.

The join is split by how common a pre-token is. The BROADCAST_PRETOKENS found in the
most texts (of a bounded length each) are sent to all tasks and joined there, which takes
all hot keys and nearly all rows out of the shuffle. The frequencies of all others stay
with their text in a written table, and are joined with the table of pieces by a shuffle.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from operator import methodcaller, mul
from unicodedata import category

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from logweir.llm.frames import stored

#: Pre-tokens that are broadcast, at most, and the most UTF-8 bytes one of them may have:
#: 25 MB in all. All others are joined.
BROADCAST_PRETOKENS = 100_000
BROADCAST_BYTES = 256
#: A task sends its counts on when it has so many different pre-tokens.
_COMBINED = 200_000
#: Characters of a text from which its pre-tokens are read one by one.
_LONG_TEXT = 1 << 20
_BATCH = 20_000

# How byte-level tokenizers cut texts.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class is the same in every version of Unicode that the libraries know
#: (a test compares all of them); texts with others are cut by the tokenizer's own code.
SETTLED = (
    (0x0000, 0x0557), (0x0900, 0x0BFF), (0x0D00, 0x206F), (0x20A0, 0xA6FF), (0xA800, 0xAB2F),
    (0xAC00, 0xFFFF), (0x1F000, 0x1FAFF), (0x20000, 0x2A6DF),
)


#: Below this, characters are listed one by one, for a pattern that is twice as fast.
_LATIN = 0x250


def _latin_pattern() -> re.Pattern:
    """BYTE_LEVEL for texts of characters below _LATIN."""

    def all_of(kinds: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(_LATIN) if category(chr(c))[0] in kinds)

    letter, number = all_of("L"), all_of("N")
    space = "".join(chr(c) for c in range(_LATIN) if regex.match(r"\s", chr(c)))
    return re.compile(
        f" ?[{letter}]+| ?[{number}]+|'(?:[stmd]|re|ve|ll)| ?[^{space}{letter}{number}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one beyond 255."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Pretokens:
    """Cuts texts into pre-tokens, and counts the pieces of one, as a tokenizer file says."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        self._of = Tokenizer.from_str(definition)
        added = spec.get("added_tokens") or []
        if any(t[flag] for t in added for flag in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError("added tokens that take in what stands around them")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, names))) if names else None
        kind = spec.get("pre_tokenizer") or {}
        self._bytes = (
            kind.get("type") == "ByteLevel" and kind.get("use_regex", True)
            and not kind.get("add_prefix_space") and not spec.get("normalizer")
        )
        self._cut, self._cut_latin = regex.compile(BYTE_LEVEL), _latin_pattern()
        self._beyond_latin = re.compile(f"[^\0-{chr(_LATIN - 1)}]")
        settled = "".join(f"{chr(a)}-{chr(b)}" for a, b in SETTLED if a) + "\0-" + chr(SETTLED[0][1])
        self._unsettled = regex.compile(f"[^{settled}]")
        self._letters = _byte_letters()

    def split(self, text: str) -> tuple[int, Iterable[str]]:
        """How many special tokens a text has, and the pre-tokens of what is between them."""
        if self._special is None or not self._special.search(text):
            return 0, self._between(text)
        parts = self._special.split(text)
        return len(parts) - 1, (x for part in parts for x in self._between(part))

    def _between(self, text: str) -> Iterable[str]:
        if not self._bytes:
            if self._of.normalizer is not None:
                text = self._of.normalizer.normalize_str(text)
            cut = self._of.pre_tokenizer
            return [x for x, _ in cut.pre_tokenize_str(text)] if cut else [text] if text else []
        cut = self._cut_latin
        if self._beyond_latin.search(text):
            if self._unsettled.search(text):
                return [text[a:b] for _, (a, b) in self._of.pre_tokenizer.pre_tokenize_str(text)]
            cut = self._cut
        if len(text) < _LONG_TEXT:
            return cut.findall(text)
        return map(methodcaller("group"), cut.finditer(text))

    def pieces(self, pretoken: str) -> int:
        if self._bytes:
            pretoken = "".join([self._letters[b] for b in pretoken.encode()])
        return len(self._of.model.tokenize(pretoken))


def _distinct(docs: DataFrame, text: str, definition) -> DataFrame:
    """``pretoken`` and ``n_docs``, the texts that have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen = Pretokens(definition.value), Counter()
        for batch in batches:
            for value in batch.column(0):
                seen.update(set(cut.split(value.as_py() or "")[1]))
                if len(seen) >= _COMBINED:
                    yield _counted(seen)
                    seen = Counter()
        if seen:
            yield _counted(seen)

    def _counted(seen: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["pretoken", "n"])

    found = docs.select(docs[text].alias("text")).mapInArrow(count, "pretoken string, n bigint")
    return found.groupBy("pretoken").agg(F.sum("n").alias("n_docs"))


def _with_pieces(pretokens: DataFrame, definition) -> DataFrame:
    """``pretoken``, ``n_docs`` and ``pieces``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Pretokens(definition.value)
        for batch in batches:
            found = pa.array([cut.pieces(x) for x in batch.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "pieces"])

    return pretokens.mapInArrow(count, "pretoken string, n_docs bigint, pieces bigint")


def _partly_summed(rows: DataFrame, definition, known) -> DataFrame:
    """``row``, ``place`` (unique), ``n_known`` tokens, and ``rest``: frequencies not known."""
    schema = StructType(
        [rows.schema["row"], *StructType.fromDDL(
            "place bigint, n_known bigint, rest array<struct<pretoken: string, times: bigint>>")]
    )
    pair = pa.struct([("pretoken", pa.string()), ("times", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, pieces = Pretokens(definition.value), known.value
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            sums, rests = [], []
            for value in batch.column(1):
                total, found = cut.split(value.as_py() or "")
                times = Counter(found)
                others = set(times).difference(pieces)
                rests.append([(pretoken, times.pop(pretoken)) for pretoken in others])
                sums.append(total + sum(map(mul, map(pieces.__getitem__, times), times.values())))
            places = pa.array(range(place, place + len(sums)), pa.int64())
            place += len(sums)
            columns = [batch.column(0), places, pa.array(sums, pa.int64()), pa.array(rests, pa.list_(pair))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(count, schema)


def token_counts(
    docs: DataFrame, tokenizer: str, text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """Every row as struct ``row`` of the columns ``keep`` (default: all), with ``n_bytes``
    and ``n_tokens`` (longs) of its text.

    ``tokenizer`` is the path, on the driver, of a tokenizer in the ``tokenizers`` library's
    JSON format. Counts are those of ``encode(text, add_special_tokens=False)``: strings of
    special tokens inside a text are one token each. Null and empty texts have 0 bytes and
    0 tokens. Repeated rows are counted each for itself. A very long text, or pre-token, is
    counted whole. An empty table gives an empty result. Columns of the input that are
    called as the new ones stay inside ``row``.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    Pretokens(definition.value)  # refuses a file it cannot follow before any work
    table = stored(_with_pieces(_distinct(docs, text, definition), definition))
    common = (
        table.where(F.octet_length("pretoken") <= BROADCAST_BYTES)
        .orderBy(F.desc("n_docs"), "pretoken")
        .limit(BROADCAST_PRETOKENS)
        .select("pretoken", "pieces")
        .toArrow()
    )
    known = spark.sparkContext.broadcast(
        dict(zip(common["pretoken"].to_pylist(), common["pieces"].to_pylist(), strict=True))
    )
    columns = [docs[c] for c in (docs.columns if keep is None else keep)]
    size = F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("bigint")
    rows = docs.select(
        F.struct(F.struct(*columns, *[] if columns else [F.lit(True).alias("_")]).alias("row"),
                 size.alias("n_bytes")).alias("row"),
        docs[text].alias("text"),
    )
    summed = stored(_partly_summed(rows, definition, known))
    others = (
        summed.select("place", F.explode("rest").alias("of"))
        .join(table.select(F.col("pretoken").alias("known"), "pieces"), F.col("of.pretoken") == F.col("known"))
        .groupBy("place")
        .agg(F.sum(F.col("of.times") * F.col("pieces")).alias("n_others"))
    )
    total = F.col("n_known") + F.coalesce("n_others", F.lit(0))
    return summed.drop("rest").join(others, "place", "left").select(
        "row.row", "row.n_bytes", total.alias("n_tokens")
    )
