"""The pipeline's stages, each against a brute-force version on its own input."""

import random
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logweir.llm import toxicity
from logweir.llm.frames import read

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """Each stage's input and output, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = read(spark, SF, "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        frames.append(docs)
    return frames


def rows(frame, *columns):
    return [tuple(r) for r in frame.select(*columns).collect()]


def test_stages(staged):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    columns = staged[0].columns
    assert all(x.columns == columns for x in staged[:-1])
    assert staged[-1].columns == [*columns, "shard", "slot"]


def test_toxicity_stage(spark, staged):
    scored = toxicity.toxicity(staged[0], read(spark, SF, "labels"))
    wanted = {r.row.doc_id for r in scored.where("predicted = 0").collect()}
    assert {r[0] for r in rows(staged[1], "doc_id")} == wanted
    assert 0 < len(wanted) < staged[0].count()


@pytest.mark.parametrize("size", [0, 40])
def test_toxicity_stage_keeps_pairs_beyond_the_broadcast(spark, tmp_path, monkeypatch, size):
    """Texts that only a pair of common words makes toxic go, however few pairs are broadcast."""
    rng = random.Random(22)
    docs, labels = [], []
    for i in range(3_000):
        own = [f"w{rng.randrange(600)}" for _ in range(rng.randrange(30, 90))]
        for _ in range(3):  # both words in every text, apart from each other
            own.insert(rng.randrange(len(own)), rng.choice(["amber", "harbor"]))
        own = [x for k, x in enumerate(own) if own[k - 1 : k] + [x] != ["amber", "harbor"]]
        if i % 5 == 0:
            at = rng.randrange(len(own))
            own[at:at] = ["amber", "harbor"]
        elif i % 5 == 1:
            own[3:3] = ["harbor", "amber"]
        docs.append((i, " ".join(own), "en", "s"))
        labels.append((i, 1, int(i % 5 == 0)))
    docs += [(10_000 + i, docs[0][1], "en", "s") for i in range(50)]  # copies in all partitions
    docs += [(20_000, None, "en", "s"), (20_001, "", None, None)]
    schema = "doc_id bigint, quality int, toxic int"
    spark.createDataFrame(labels, schema).write.parquet(f"{tmp_path}/labels.parquet")
    source = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    source.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    source = read(spark, tmp_path, "documents")

    def kept():
        return sorted(rows(corpus_pipeline.without_toxic(spark, source, str(tmp_path)), "doc_id"))

    wanted = kept()
    monkeypatch.setattr(toxicity, "BROADCAST_PAIRS", size)
    left = kept()
    assert left == wanted
    left = {r[0] for r in left}
    unseen = [i for i in range(3_000) if brute.crc(str(i)) % 4 == 2]
    toxic = [i for i in unseen if i % 5 == 0]
    assert len(toxic) > 50 and sum(i in left for i in toxic) <= 0.1 * len(toxic)
    assert sum(i in left for i in unseen) >= 0.95 * (len(unseen) - len(toxic))
    assert not left & set(range(10_000, 10_050))


def test_near_duplicate_stage(staged):
    docs = rows(staged[1], "doc_id", "text")
    wanted = sorted(d for d, _, c in brute.components(docs, 5, 80) if d == c)
    assert sorted(r[0] for r in rows(staged[2], "doc_id")) == wanted
    assert len(wanted) < len(docs)


def test_decontamination_stage(spark, staged):
    docs = rows(staged[2], "doc_id", "text")
    items = rows(read(spark, SF, "benchmark"), "item_id", "text")
    wanted = sorted(r[0] for r in brute.contamination(docs, items) if not r[5])
    assert sorted(r[0] for r in rows(staged[3], "doc_id")) == wanted


def test_mixing_stage(staged):
    docs = rows(staged[3], "doc_id", "text", "source")
    wanted = Counter(d for d, _ in brute.copies(docs, corpus_pipeline.WEIGHTS))
    assert Counter(r[0] for r in rows(staged[4], "doc_id")) == wanted


def test_sharding_stage(staged):
    out = rows(staged[5], "doc_id", "text", "shard", "slot")
    assert Counter(r[0] for r in out) == Counter(r[0] for r in rows(staged[4], "doc_id"))
    home, slots = defaultdict(set), defaultdict(list)
    for _, text, shard, slot in out:
        home[text].add(shard)
        slots[shard].append(slot)
    assert all(len(x) == 1 for x in home.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_run_is_all_stages(spark, staged):
    done = corpus_pipeline.run(spark, SF)
    assert done.columns == staged[-1].columns
    wanted = Counter(rows(staged[-1], "doc_id", "shard"))
    assert Counter(rows(done, "doc_id", "shard")) == wanted


def test_clashing_columns(spark):
    docs = read(spark, SF, "documents").limit(30)
    odd = docs.withColumns({c: F.lit(1) for c in ("shard", "slot", "row", "key", "text_key", "copy")})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, SF)
        assert len(set(out.columns)) == len(out.columns)
        assert set(out.columns) == set(odd.columns)
        if name == "sharding":
            assert out.where("shard <> 1 OR slot <> 1").count() > 0


def test_awkward_documents(spark):
    """Nulls everywhere, empty texts and repeated rows go through all stages."""
    schema = read(spark, SF, "documents").schema
    rows = [(None,) * 5, (None,) * 5, (1, "", None, "a", 0), (2, None, "en", None, None)]
    rows += [(3, "some words of a text that is long enough to have shingles", "en", "a", 9)] * 3
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        docs = spark.createDataFrame(out.collect(), out.schema)
        if name == "near_duplicates":
            assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "2", "3", "None", "None"]
    assert docs.columns == [*schema.names, "shard", "slot"]


def test_empty_documents(spark):
    for _, stage in corpus_pipeline.STAGES:
        docs = read(spark, SF, "documents").where(F.lit(False))
        assert stage(spark, docs, SF).count() == 0
