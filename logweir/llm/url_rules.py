"""URL rules by a sort-merge range join.

A rule (host, path) fits a host and all its subdomains, if the path starts with the
rule's. The canonical key of a host with a path is the labels reversed, joined by
dots, a separator and the path; then a rule is a prefix, which is an interval of keys,
and intervals of rules are nested or disjoint. A URL fits a rule if the key of its
path with one of its host's parents (or the host itself) lies in the rule's interval,
so each URL has one key for each label of its host.

Keys of URLs and rules are sorted together. In the sweep, the last rule at or before
a key carries its stack: itself and the rules around it. Those of the stack that have
not ended before the key are exactly the rules that fit it. The sweep is a window over
lanes, ranges of keys with about equally many URLs each; a rule is put into the lanes
that its interval reaches. Lane borders come from a hash sample of keys with the rows'
own hash at their end, so that one host or one URL with a third of all rows is spread
over many lanes. The sample sets borders only; every row is swept.

Native: DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.frames import lanes

_SEPARATOR = "\u0001"
_ROW = "\u0000"
_AFTER_ALL = "\U0010ffff"
#: Lanes for each shuffle partition, and at most; keys sampled for each lane.
LANES_PER_PARTITION = 4
MOST_LANES = 4096
SAMPLE = 20
_STEP = 64


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, A-Z lower-cased; '' without ://."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """From the host's end to the next ? or #; '' without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://[^/?#]*([^?#]*)", 1)


def _reversed(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _rule_table(rules: DataFrame) -> DataFrame:
    """``key``, and ``stack``: the rule and all rules whose intervals hold it."""
    host, path = ascii_lower(F.col("host")), F.col("path")
    own = (
        rules.where("host IS NOT NULL AND path IS NOT NULL")
        .select(
            F.concat(F.array_join(_reversed(host), "."), F.lit(_SEPARATOR), path).alias("key"),
            F.concat(host, path).alias("rule"),
            F.col("verdict"),
        )
        .groupBy("key", "rule")
        .agg(F.max("verdict").alias("verdict"))
    )
    cut = F.explode(F.sequence(F.lit(1), F.length("key")))
    inner = own.select(F.col("key").alias("inner"), cut.alias("n")).select(
        "inner", F.substring(F.col("inner"), F.lit(1), F.col("n")).alias("key")
    )
    return (
        inner.join(own, "key")
        .groupBy(F.col("inner").alias("key"))
        .agg(F.collect_list(F.struct(F.length("key").alias("depth"), "key", "rule", "verdict")).alias("stack"))
    )


def _borders(keys: DataFrame) -> list[str]:
    """Borders between lanes, in order; few or none where there are few keys."""
    wanted = min(MOST_LANES, LANES_PER_PARTITION * lanes(keys.sparkSession))
    every = max(1, keys.count() // (wanted * SAMPLE))
    picked = keys.where(F.pmod(F.xxhash64("place"), F.lit(every)) == 0)
    sample = sorted(x for (x,) in picked.select("place").toLocalIterator())
    step = max(1, len(sample) // wanted)
    return sorted(set(sample[step::step]))


def _lane(place: Column, borders: list[str]) -> Column:
    """How many borders are at or below the place: first by every 64th, then within."""
    if not borders:
        return F.lit(0)
    coarse = F.size(F.filter(F.lit(borders[_STEP - 1 :: _STEP] or [_AFTER_ALL]), lambda b: b <= place))
    part = F.slice(F.lit(borders), coarse * _STEP + 1, F.lit(_STEP))
    return coarse * _STEP + F.size(F.filter(part, lambda b: b <= place))


def url_verdicts(
    pages: DataFrame,
    rules: DataFrame,
    ident: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``ident``, ``url``, ``host``, ``path``, ``rule`` and ``verdict`` of every row.

    ``rules`` has host, path and verdict. Of the rules that fit, the longest (host and
    path together; then the longest host) wins; without any, ``rule`` is null and
    ``verdict`` is ``default``. A null URL, or one without ://, has an empty host and
    path and fits no rule. Rules with a null are ignored; of contrary equal rules the
    greater verdict (block) holds. Repeated rows each get their verdict. Empty tables
    of pages or rules are no special case. Other columns of pages are not looked at.
    """
    links = (
        pages.select(pages[ident].alias("id"), pages[url].alias("url"))
        .groupBy("id", "url")
        .agg(F.count("*").alias("times"))
        .select("*", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    )
    labels = _reversed(F.col("host"))
    level = F.explode(F.sequence(F.lit(1), F.size(labels)))
    parent = F.array_join(F.slice(labels, F.lit(1), F.col("level")), ".")
    keys = links.select("*", level.alias("level")).select(
        "id", "url", "times",
        F.concat(parent, F.lit(_SEPARATOR), F.col("path")).alias("key"),
    )
    keys = keys.withColumn(
        "place", F.concat("key", F.lit(_ROW), F.lower(F.hex(F.xxhash64("id", "url"))))
    )
    borders = _borders(keys)
    table = _rule_table(rules)
    reach = F.sequence(
        _lane(F.col("key"), borders), _lane(F.concat("key", F.lit(_AFTER_ALL)), borders)
    )
    starts = table.select(
        F.explode(reach).alias("lane"), F.col("key").alias("place"), "key", "stack"
    )
    swept = keys.withColumn("lane", _lane(F.col("place"), borders)).unionByName(
        starts, allowMissingColumns=True
    )
    # At one place a rule (times is null) comes before a URL.
    sweep = Window.partitionBy("lane").orderBy("place", F.col("times").asc_nulls_first())
    active = F.last("stack", ignorenulls=True).over(sweep.rowsBetween(Window.unboundedPreceding, 0))
    open_rules = F.filter("active", lambda x: F.startswith(F.col("key"), x["key"]))
    best = F.array_max(
        F.transform(
            open_rules,
            lambda x: F.struct(
                F.length(x["rule"]).alias("length"), x["depth"].alias("depth"),
                x["rule"].alias("rule"), x["verdict"].alias("verdict"),
            ),
        )
    )
    judged = (
        swept.withColumn("active", active)
        .where("times IS NOT NULL")
        .select("id", "url", "times", best.alias("best"))
        .groupBy("id", "url", "times")
        .agg(F.max("best").alias("best"))
    )
    once = judged.select("*", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time"))
    return once.select(
        F.col("id").alias(ident),
        "url",
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
