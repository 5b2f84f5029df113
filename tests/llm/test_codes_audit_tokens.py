"""Product codes, source audit and token counts: queries and operators by brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from logweir.llm import ball_kmeans, queries, source_audit, token_counts, transducer

SF = "/root/testdata/sf0.01"
TOKENIZER = str(public_tokenizers.path("byte_bpe_50k.json"))


def _table(name, *columns):
    return duckdb.sql(f"SELECT {', '.join(columns)} FROM '{SF}/{name}.parquet'").fetchall()


# Ball k-means ---------------------------------------------------------------------


def lloyd(rows, parts, entries, rounds):
    """Codes, errors and codebooks by comparing every part with every entry; rows are
    (id, vector) in any order."""
    kept = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = len(kept[0][1]) // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * width : (p + 1) * width] for _, v in first] for p in range(parts)]

    def assign():
        out = []
        for _, v in kept:
            far = [
                [sum((a - b) ** 2 for a, b in zip(v[p * width : (p + 1) * width], e)) for e in books[p]]
                for p in range(parts)
            ]
            out.append(([f.index(min(f)) for f in far], sum(map(min, far))))
        return out

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(first)):
                own = [v[p * width : (p + 1) * width] for (_, v), (c, _) in zip(kept, codes) if c[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, bytes(c), e) for (i, _), (c, e) in zip(kept, assign())]
    return found, books


def test_product_codes_query(spark):
    rows = _table("embeddings", "vec_id", "embedding", "label")
    found, books = lloyd([r[:2] for r in rows], 16, 64, 2)
    label = {r[0]: r[2] for r in rows}
    by_label = Counter()
    for i, _, error in found:
        by_label[label[i]] += error
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    wanted = Counter((i, c.hex(), e, by_label[label[i]], sha) for i, c, e in found)
    got = queries.queries()["op11_ball_kmeans"](spark, SF)
    assert dict(got.dtypes) == {"vec_id": "bigint", "code": "string", "error": "bigint",
                                "label_error": "bigint", "codebooks_sha256": "string"}
    assert Counter(tuple(r) for r in got.collect()) == wanted


@pytest.mark.parametrize(("seed", "rounds", "spread"), [(1, 2, 1.0), (2, 6, 0.02), (3, 0, 1.0), (4, 9, 300.0)])
def test_codes_are_those_of_all_comparisons(spark, frame, seed, rounds, spread):
    random.seed(seed)
    middles = [[random.uniform(-1, 1) for _ in range(6)] for _ in range(7)]
    rows = [
        (random.randrange(150), [round(x + random.gauss(0, 0.05), 2) * spread for x in random.choice(middles)])
        for _ in range(400)
    ]
    rows += rows[:30]
    found, books = lloyd(rows, 3, 12, rounds)
    made = ball_kmeans.compressed(
        frame(rows, "vec_id bigint, embedding array<double>", 5), parts=3, entries=12, rounds=rounds
    )
    assert made.books.tolist() == books
    got = Counter((r.row.vec_id, bytes(r.code), r.error) for r in made.rows.collect())
    assert got == Counter(found)


def test_vectors_that_are_dropped_and_clashing_columns(spark, frame):
    inf, nan = math.inf, math.nan
    good = [(None, [0.5, -0.001]), (3, [1.0, 2.0]), (3, [1.0, 2.0]), (1, [-1e30, 0.0])]
    bad = [(5, None), (6, [None, 1.0]), (7, [nan, 1.0]), (8, [1.0, -inf]), (9, []), (10, [1.0])]
    schema = "vec_id bigint, embedding array<float>, code string, error int, moved int"
    docs = frame([(*r, "x", 1, 2) for r in [*good, *bad]], schema)
    rows, books = ball_kmeans.compressed(docs, parts=2)
    assert rows.columns == ["row", "code", "error"]
    got = rows.select("row.vec_id", "row.code", "error").collect()
    assert Counter(r.vec_id for r in got) == Counter(i for i, _ in good)
    assert {r.code for r in got} == {"x"}
    most = ball_kmeans.largest(2)
    # Ids 1, 3, 3 and null, of which the two equal ones share a nearest entry.
    assert books.tolist() == [[[-most], [256], [256], [128]], [[0], [512], [512], [-1]]]
    labels = ball_kmeans.with_label_error(rows.withColumn("error", rows.error + 1), rows.row.vec_id)
    assert {(r.row.vec_id, r.label_error) for r in labels.collect()} == {(None, 1), (3, 2), (1, 1)}


def test_no_vectors(spark, frame):
    rows, books = ball_kmeans.compressed(frame([], "vec_id bigint, embedding array<float>"))
    assert rows.count() == 0 and books.size == 0
    rows, _ = ball_kmeans.compressed(frame([(1, None)], "vec_id bigint, embedding array<float>"))
    assert ball_kmeans.with_label_error(rows, rows.row.vec_id).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        ball_kmeans.compressed(frame([(1, [1.0])], "vec_id bigint, embedding array<float>"), parts=2)
    with pytest.raises(ValueError, match="one byte"):
        ball_kmeans.compressed(frame([], "vec_id bigint, embedding array<float>"), entries=257)


# Source audit ---------------------------------------------------------------------


def audit(rows, least_docs, top):
    """The audit of (lang, source, text), in plain Python."""
    rows = [tuple(x or "" for x in r) for r in rows]
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    have, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = Counter(term.findall(text.translate(lower)))
        have[lang].update(found.keys())
        counts[lang, source].update(found)
    out = []
    for lang in have:
        kept = sorted((t for t, n in have[lang].items() if n >= least_docs), key=str.encode)
        sources = sorted({s for k, s in counts if k == lang}, key=str.encode)
        by = {s: [counts[lang, s][t] for t in kept] for s in sources}

        def ps(n):
            return [1 + 10**9 * (x + 1) // (sum(n) + len(kept)) for x in n]

        p, q = {s: ps(n) for s, n in by.items()}, ps([sum(x) for x in zip(*by.values())])
        for s in sources:
            pairs = [(sum((a - b) ** 2 // b for a, b in zip(p[s], p[o])), o) for o in sources if o != s]
            terms = [((a - b) ** 2 // b, t) for a, b, t, n in zip(p[s], q, kept, by[s]) if n and a > b]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, r) for r, (v, i) in enumerate(found[:most], 1)]
    return Counter(out)


def test_transducer_is_minimal_and_ordered():
    random.seed(5)
    words = {"a", "", "é", "日本"} | {"".join(random.choices("abé", k=random.randint(1, 6))) for _ in range(900)}
    words = sorted(w.encode() for w in words)
    made, root = transducer.build(words)
    behind = {}  # of each state, the words behind it: different for different states

    def of(state):
        if state not in behind:
            arcs = [i for i, k in enumerate(made.keys.tolist()) if k >> 8 == state]
            behind[state] = frozenset([b""] * bool(made.final[state])).union(
                *(frozenset(bytes([int(made.keys[i]) & 255]) + w for w in of(int(made.target[i]))) for i in arcs)
            )
        return behind[state]

    assert of(root) == set(words)
    assert len(set(behind.values())) == len(behind) == len(made.final)
    others = [b"zz", b"ab" * 9, b"\xc3", b"abx"]
    both = words + others
    data = np.frombuffer(b"".join(both), dtype=np.uint8)
    end = np.cumsum([len(w) for w in both])
    start = end - np.array([len(w) for w in both])
    got = made.ordinals(data, start, end, np.full(len(both), root))
    assert got.tolist() == [*range(len(words)), -1, -1, -1, -1]
    assert [made.word(i, root) for i in range(len(words))] == words


def test_no_words_and_stacks():
    none, root = transducer.build([])
    one, one_root = transducer.build([b"x"])
    both, moves = transducer.stack([none, one])
    data = np.frombuffer(b"xx", dtype=np.uint8)
    got = both.ordinals(data, np.array([0, 1]), np.array([1, 2]), np.array([root, one_root + moves[1]]))
    assert got.tolist() == [-1, 0]


def _audited(frame, **options):
    return Counter(tuple(r) for r in source_audit.source_audit(frame, **options).collect())


@pytest.mark.parametrize(("pieces", "block", "cells"), [(50_000, 64 << 20, 1 << 20), (7, 300, 5)])
def test_audit_of_odd_rows(spark, frame, monkeypatch, pieces, block, cells):
    monkeypatch.setattr(source_audit, "PIECE_TERMS", pieces)
    monkeypatch.setattr(source_audit, "BLOCK_BYTES", block)
    monkeypatch.setattr(source_audit, "_CELLS", cells)
    random.seed(6)
    words = ["".join(random.choices("abÀß", k=random.randint(1, 3))) for _ in range(80)]
    rows = [
        (random.choice(["en", "de", None, ""]), random.choice(["s1", "S2", None, "ß", ""]),
         " ".join(random.choices(words, k=random.randint(0, 30))).upper())
        for _ in range(300)
    ]
    rows += rows[:20]
    rows += [("en", "s1", "x" * 5000)] * 3 + [("fr", "alone", None), ("fr", "other", "1 2 3"), ("it", None, "a")]
    rows.append(("en", "s3", "word1long " * 40_000))
    docs = frame([(*r, 1, "p") for r in rows], "lang string, source string, text string, p int, term string")
    assert _audited(docs, top=9) == audit(rows, 3, 9)


def test_audit_of_no_rows(spark, frame):
    assert not _audited(frame([], "lang string, source string, text string"))
    assert _audited(frame([("en", "a", "x y")], "lang string, source string, text string")) == Counter()


# Token counts ---------------------------------------------------------------------


def test_token_counts_query(spark):
    docs = _table("documents", "doc_id", "text")
    encoded = Tokenizer.from_file(TOKENIZER).encode_batch([t or "" for _, t in docs], add_special_tokens=False)
    wanted = Counter(
        (i, len((t or "").encode()), len(e.ids), len(e.ids) > 1024) for (i, t), e in zip(docs, encoded)
    )
    got = queries.queries()["op13_token_counts"](spark, SF)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    assert Counter(tuple(r) for r in got.collect()) == wanted


ODD_TEXTS = [
    None, "", " ", "\n\n  x", "don't we'll I'M", "<|endoftext|>", "a<|endoftext|><|endoftext|> b",
    "<|endoftext|", "naïve 日本語 ½ ²", "՘֋ new ₝", "🙂🙂 ‍ ok", "   \x1c x\x85y",
    "a" * 70_000, " " * 3000 + "x", "=" * 400 + "\n" + "=" * 400, "x  y   z\t\t1234567", "é ﻿\0",
]


@pytest.mark.parametrize("known", [0, 3, 100_000])
def test_token_counts_of_odd_texts(spark, frame, monkeypatch, known):
    monkeypatch.setattr(token_counts, "BROADCAST_PRETOKENS", known)
    monkeypatch.setattr(token_counts, "_COMBINED", 5)
    monkeypatch.setattr(token_counts, "_LONG_TEXT", 5000)
    rows = [(i % 4, t, "c", 7) for i, t in enumerate(ODD_TEXTS * 2)]
    docs = frame(rows, "doc_id int, text string, pretoken string, place int")
    of = Tokenizer.from_file(TOKENIZER)
    wanted = Counter(
        (i, t, c, p, len((t or "").encode()), len(of.encode(t or "", add_special_tokens=False).ids))
        for i, t, c, p in rows
    )
    got = token_counts.token_counts(docs, TOKENIZER).select("row.*", "n_bytes", "n_tokens")
    assert Counter(tuple(r) for r in got.collect()) == wanted


def test_token_counts_by_a_tokenizer_with_a_normalizer(spark, frame):
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    of = Tokenizer.from_file(path)
    texts = ["Hello  World, it's 42!", "<|startoftext|>É x", "", "word " * 50, "A B\nC"]
    got = token_counts.token_counts(frame([(t,) for t in texts], "text string"), path)
    assert {r.row.text: r.n_tokens for r in got.collect()} == {
        t: len(of.encode(t, add_special_tokens=False).ids) for t in texts
    }


def test_token_counts_of_no_rows(spark, frame):
    assert token_counts.token_counts(frame([], "text string"), TOKENIZER, keep=[]).count() == 0


def test_settled_characters_are_cut_alike():
    """Every settled character, after and before letters, digits, signs and spaces."""
    with open(TOKENIZER, encoding="utf-8") as file:
        cut = token_counts.Pretokens(file.read())
    library = Tokenizer.from_file(TOKENIZER).pre_tokenizer
    points = [c for a, b in token_counts.SETTLED for c in range(a, b + 1) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4000):
        text = "".join(f"a{chr(c)}a1{chr(c)}1!{chr(c)}! {chr(c)} {chr(c)}b" for c in points[i : i + 4000])
        assert cut._unsettled.search(text) is None
        wanted = [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]
        assert cut._cut.findall(text) == wanted
        latin = "".join(c for c in text if ord(c) < token_counts._LATIN)
        assert cut._cut_latin.findall(latin) == cut._cut.findall(latin)
