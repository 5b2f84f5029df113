"""Registered queries over whole tables: against SQL, or brute force."""

import hashlib
import math
from collections import Counter, defaultdict

import brute
import duckdb
import pytest

from logweir.llm import quality_rules, queries

SF = "/root/testdata/sf0.001"
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double"}


def _duck(sf_dir):
    db = duckdb.connect()
    for table in ("documents", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _table(name, *columns):
    return duckdb.sql(f"SELECT {', '.join(columns)} FROM '{SF}/{name}.parquet'").fetchall()


def _rows(spark, key, *columns):
    frame = queries.queries()[key](spark, SF)
    return Counter(tuple(r) for r in frame.select(*columns).collect())


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, key, scale):
    wanted = _duck(f"/root/testdata/{scale}").sql(queries.oracle_sql()[key])
    got = queries.queries()[key](spark, f"/root/testdata/{scale}")
    types = {n: TYPES[str(t)] for n, t in zip(wanted.columns, wanted.types, strict=True)}
    assert dict(got.dtypes) == types
    columns = sorted(types)
    order = [wanted.columns.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in wanted.fetchall())
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == expected


def test_every_operator_has_a_query():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.queries())
    assert numbers == list(range(1, 14))


def test_ngram_join(spark):
    wanted = Counter(brute.components(_table("documents", "doc_id", "text")))
    assert _rows(spark, "op1_ngram_join", "doc_id", "n_shingles", "component_id") == wanted


def test_decontaminate(spark):
    docs, items = _table("documents", "doc_id", "text"), _table("benchmark", "item_id", "text")
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert _rows(spark, "op2_decontaminate", *columns) == Counter(brute.contamination(docs, items))


def test_html_text(spark):
    got = _rows(spark, "op4_html_text", "page_id", "url", "text", "n_chars")
    assert {k[:2] for k in got} == set(_table("pages", "page_id", "url"))
    assert all(k[3] == len(k[2]) and "  " not in k[2] and "<p>" not in k[2] for k in got)


@pytest.mark.parametrize(
    ("key", "folds", "held", "cut"), [("op5_toxicity", 4, 2, 0.3), ("op7_quality_model", 3, 1, 0.5)]
)
def test_scores(spark, key, folds, held, cut):
    got = _rows(spark, key, "doc_id", "held_out", "score", "predicted")
    assert {k[0] for k in got} == {r[0] for r in _table("documents", "doc_id")}
    assert all(k[1] == (brute.crc(str(k[0])) % folds == held) for k in got)
    assert all(0 <= k[2] <= 1 and k[3] == (k[2] >= cut) for k in got)


def _held_out(spark, key, label):
    """(label, predicted) of rows whose labels were not learnt, on a table with 3,980."""
    folder = "/root/testdata/sf0.1"
    truth = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{folder}/labels.parquet'").fetchall())
    scored = queries.queries()[key](spark, folder).where("held_out").collect()
    return Counter((truth[r.doc_id], r.predicted) for r in scored if r.doc_id in truth)


def test_toxicity_on_held_out_rows(spark):
    n = _held_out(spark, "op5_toxicity", "toxic")
    assert n[0, 0] / (n[0, 0] + n[0, 1]) > 0.97
    assert n[1, 1] / (n[1, 0] + n[1, 1]) > 0.85


def test_quality_on_held_out_rows(spark):
    n = _held_out(spark, "op7_quality_model", "quality")
    assert n[1, 1] / (n[1, 0] + n[1, 1]) > 0.99
    assert n[0, 0] / (n[0, 0] + n[0, 1]) > 0.95


def test_shard(spark):
    got = _rows(spark, "op8_shard", "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    texts = dict(_table("documents", "doc_id", "text"))
    assert {k[0] for k in got} == set(texts)
    slots = defaultdict(list)
    for doc, size, crc, law, shard, slot, grown in got:
        assert (size, crc) == (len((texts[doc] or "").encode()) + 8, brute.crc(texts[doc]))
        assert law == "bytes" and grown is None and 0 <= shard < 24
        slots[shard].append(slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    home, load, group = defaultdict(set), Counter(), Counter()
    for doc, size, _, _, shard, _, _ in got:
        home[texts[doc] or ""].add(shard)
        load[shard] += size
        group[texts[doc] or ""] += size
    assert all(len(x) == 1 for x in home.values())
    # No two loads are further apart than the largest group that stays together.
    assert max(load.values()) - min(load[s] for s in range(24)) <= max(group.values())


def test_chat(spark):
    got = queries.queries()["op9_chat"](spark, SF)
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    by_id = {r.conv_id: r for r in got.collect()}
    turns = Counter(r[0] for r in _table("conversations", "conv_id")) + Counter({-7: 2})
    assert {i: r.n_turns for i, r in by_id.items()} == turns
    said = "</s>[INST] ok [/INST]"
    assert by_id[-7].loss_chars == len(said) and by_id[-7].formatted_chars > 2 * len(said)


def test_chat_digests(spark):
    """Every digest, from the table alone."""
    talk = defaultdict(list)
    for conv, turn, role, text in _table("conversations", "conv_id", "turn", "role", "text"):
        talk[conv].append((turn, role, text or ""))
    said = "</s>[INST] ok [/INST]"
    talk[-7] = [(0, "user", said), (1, "assistant", said)]
    wanted = Counter()
    for conv, rows in talk.items():
        rows.sort(key=lambda r: r[0])
        turns = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        loss = "".join(text for _, role, text in rows if role == "assistant")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (turns, loss)]
        wanted[conv, len(rows), digests[0], len(loss), digests[1]] += 1
    columns = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert _rows(spark, "op9_chat", *columns) == wanted


def test_kept_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [
        {(r.row.doc_id, r.kept, r.class_distance, r.word_distance)
         for r in quality_rules.judged(docs.repartition(n), keep=["doc_id"]).collect()}
        for n in (2, 9, 61)
    ]
    assert found[0] == found[1] == found[2]
    assert {k[1] for k in found[0]} == {True, False}


def test_distances_are_those_of_plain_python(spark):
    """Jensen-Shannon distances, the middle and the verdict, recomputed from the counts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = quality_rules.text_counts(docs, "text", ["doc_id", "lang"]).collect()
    got = {r.row.doc_id: r for r in quality_rules.judged(docs, keep=["doc_id"]).collect()}

    def shares(values):
        total = sum(values)
        return [x / total for x in values] if total else [0.0] * len(values)

    def distance(p, q):
        total = 0.0
        for a, b in zip(p, q, strict=True):
            m = (a + b) / 2
            total += sum(x * math.log2(x / m) / 2 for x in (a, b) if x > 0)
        return math.sqrt(max(0.0, total))

    def reference(rows, name):
        whole = [sum(math.floor(s * 1_000_000 + 0.5) for s in col)
                 for col in zip(*(shares(getattr(r, name)) for r in rows), strict=True)]
        return shares(whole)

    by_lang = defaultdict(list)
    for r in counts:
        if r.n_words > 0:
            by_lang[r.row.lang].append(r)
    for rows in by_lang.values():
        trusted = [r for r in rows if not got[r.row.doc_id].base_failed]
        first = reference(trusted or rows, "classes")
        steps = {r.row.doc_id: int(distance(shares(r.classes), first) * quality_rules.STEPS) for r in trusted}
        if trusted:
            middle = sorted(steps.values())[(len(steps) - 1) // 2]
            trusted = [r for r in trusted if steps[r.row.doc_id] <= middle]
        for name, column in (("classes", "class_distance"), ("common", "word_distance")):
            ref = reference(trusted or rows, name)
            for r in rows:
                wanted = distance(shares(getattr(r, name)), ref)
                assert got[r.row.doc_id][column] == pytest.approx(wanted, abs=1e-4)


def test_quality_rules(spark):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    wanted = Counter((d, *brute.base_rules(t)) for d, t in _table("documents", "doc_id", "text"))
    assert _rows(spark, "op10_quality_rules", "doc_id", *columns) == wanted
