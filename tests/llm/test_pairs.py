"""Near duplicates of texts and vectors, components, and the pipeline, against brute force."""

import os
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rillgauge.llm import covertree, ordermin
from rillgauge.llm.common import SCHEMAS
from rillgauge.llm.components import components
from rillgauge.llm.queries import BYTE_BPE

from .conftest import prose

TABLES = "/root/testdata/sf0.001"


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7), (200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == roots({x for p in chain for x in p}, chain)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance():
    rng = np.random.default_rng(2)
    for _ in range(400):
        a = rng.integers(0, 4, rng.integers(0, 15)).tolist()
        b = a[:] if rng.random() < 0.5 else rng.integers(0, 4, rng.integers(0, 15)).tolist()
        for _ in range(rng.integers(0, 4)):
            b.insert(int(rng.integers(0, len(b) + 1)), int(rng.integers(0, 4)))
        limit, d = int(rng.integers(0, 10)), plain_distance(a, b)
        assert ordermin.edit_distance(a, b, limit) == (d if d <= limit else None)


def test_edit_distance_of_many_edits():
    rng = np.random.default_rng(3)
    for n, edits in ((200, 40), (300, 5), (300, 100), (150, 150)):
        a = rng.integers(0, 60, n).tolist()
        b = a[:]
        for _ in range(edits):
            at = int(rng.integers(0, len(b)))
            b[at : at + int(rng.integers(0, 2))] = [int(rng.integers(0, 80))]
        d = plain_distance(a, b)
        assert ordermin.edit_distance(a, b, d) == ordermin.edit_distance(b, a, d + 20) == d and ordermin.edit_distance(a, b, d - 1) is None


def test_sketches_of_many_texts_are_those_of_each():
    texts = [prose(i, n).encode() for i, n in enumerate([0, 3, 20, 33, 35, 41, 300, 2000, 34, 500])]
    for text, keys in zip(texts, ordermin.sketches(texts), strict=True):
        assert (ordermin.sketches([text])[0] == keys).all()


def test_texts_of_impossible_pairs_are_not_read(spark, monkeypatch):
    """Texts that share a run of words, but whose lengths or classes of words leave no link possible, are not compared."""
    read, verified = [], ordermin._verified

    def seen(pairs, texts):
        read.extend((r.a, r.b) for r in pairs.collect())
        return verified(pairs, texts)

    monkeypatch.setattr(ordermin, "_verified", seen)
    base = [f"b{i}" for i in range(20)]
    rows = [base, base[:10] + [f"c{i}" for i in range(25)], base[:8] + [f"d{i}" for i in range(12)], base[:-1] + ["e"]]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in ordermin.near_duplicates(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 0} and read == [(0, 3)]


def test_sketch_keeps_order():
    x = ordermin.mixed(np.arange(1, 200, dtype=np.uint64))
    same, turned = ordermin.sketch(x), ordermin.sketch(x[::-1].copy())
    assert (ordermin.sketch(np.concatenate([x])) == same).all() and not (same == turned).any()
    twice = np.concatenate([x, x[:50]])
    assert 0 < (ordermin.sketch(twice) == same).sum() < len(same)


def edited(rng, words, edits, even):
    """The words with so many of them replaced, evenly or anywhere, or for short texts also left out."""
    at = (np.arange(edits) * len(words) // max(1, edits)) if even else rng.choice(len(words), edits, replace=False)
    out = list(words)
    for i in at.tolist():
        out[i] = f"e{rng.integers(0, 1 << 40)}" if len(words) > 60 or rng.random() < 0.7 else None
    return [w for w in out if w is not None]


@pytest.mark.parametrize("even", [False, True])
def test_links_share_a_key(even):
    """Planted links at 0.80 to 0.90: all of short texts have a common key, and nearly all of longer ones."""
    rng = np.random.default_rng(11)
    for lengths, least in ((range(5, 41), 1.0), (range(41, 121, 4), 0.98 if even else 0.999), (range(200, 601, 40), 0.98 if even else 0.999)):
        found = total = 0
        for n in lengths:
            for rate in (0.2, 0.18, 0.15, 0.1):
                for _ in range(8):
                    a = [f"v{x}" for x in rng.integers(0, 5000, n)]
                    b = edited(rng, a, max(1, int(n * rate + 1e-9)), even)
                    assert ordermin.similar(a, b)
                    x, y = ordermin.sketches([" ".join(a).encode(), " ".join(b).encode()])
                    total += 1
                    found += bool(np.intersect1d(x, y).size)
        assert found >= least * total, (lengths, found, total)


def test_planted_links_are_found(spark):
    rng = np.random.default_rng(12)
    rows = []
    for i, n in enumerate([5, 6, 7, 9, 10, 12, 15, 16, 19, 20, 24, 30, 40, 41, 60, 150, 300, 600]):
        words = [f"t{i}w{x}" for x in range(n)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(edited(rng, words, n // 5, n % 2 == 0)))]
    got = ordermin.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {k: k - k % 2 for k, _ in rows}


def near_rows():
    rng = np.random.default_rng(7)
    rows = []
    for family in range(12):
        words = prose(family, 120 + 10 * family).split()
        for copy in range(int(rng.integers(1, 7))):
            changed = list(words)
            for _ in range(int(rng.integers(0, 8))):
                changed[int(rng.integers(0, len(changed)))] = f"w{rng.integers(0, 999)}"
            rows.append((len(rows), " ".join(changed)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "one  two"), (504, "one  two"), (None, "one three"), (505, prose(99, 30_000))]
    return rows


def test_near_duplicates(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id bigint, text string, key string, root int")
    got = ordermin.near_duplicates(docs).collect()
    split = {k: (t or "").split() for k, t in rows}
    links = [
        (a, b) for a in split for b in split
        if a is not None and b is not None and a < b and max(len(split[a]), len(split[b])) < 5000
        and (split[a] == split[b] or ordermin.similar(split[a], split[b]) and len(split[a]) > 5)
    ]
    want = roots([k for k in split if k is not None], links) | {None: None}
    assert {(r.doc_id, r.class_id) for r in got} == set(want.items()) and len(got) == len(rows)
    kept = ordermin.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted({v for v in want.values() if v is not None})
    none = docs.limit(0)
    assert ordermin.near_duplicates(none).count() == 0 and ordermin.drop_near_duplicates(none).count() == 0


@pytest.mark.parametrize("direct", [ordermin.DIRECT, 3])
def test_chains_and_outsiders(spark, monkeypatch, direct):
    """Chains of texts of which only neighbours are similar, and texts that share a passage with all of them."""
    monkeypatch.setattr(ordermin, "DIRECT", direct)
    base = prose(3, 100).split()
    chain = [base]
    for i in range(5):
        at = 15 * i
        chain.append(chain[-1][:at] + [f"s{i}w{j}" for j in range(15)] + chain[-1][at + 15 :])
    others = [base[:40] + [f"o{i}w{j}" for j in range(60)] for i in range(12)]
    rows = [(i + 1, " ".join(w)) for i, w in enumerate([*chain, *others])]
    got = {r.doc_id: r.class_id for r in ordermin.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert not ordermin.similar(chain[0], chain[-1])
    assert got == {i: 1 if i <= 6 else i for i in range(1, 19)}


@pytest.mark.parametrize("values", [covertree.BLOCK_VALUES, 20 * 6])
def test_near_vectors(spark, monkeypatch, values):
    monkeypatch.setattr(covertree, "BLOCK_VALUES", values)
    monkeypatch.setattr(covertree, "SHARE", 50)
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(6, 6))
    rows = []
    for i in range(400):
        v = (middles[rng.integers(0, 6)] * (0.5 + rng.random()) + rng.normal(size=6) * rng.choice([0.001, 0.1, 0.6])).astype("f4")
        rows.append((i, v.tolist(), int(i % 3)))
    rows += [(1000 + i, rows[5][1], 2) for i in range(30)]
    bad = [
        (2000, None, 1), (2001, [], 1), (2002, [0.0] * 6, 1), (2003, [1.0, None] + [0.0] * 4, 1), (2004, [float("nan")] * 6, 1),
        (2005, [float("inf")] + [0.0] * 5, 1), (2006, rows[0][1], None), (2007, [1.0, 2.0], 1),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows + bad], "vec_id bigint, embedding array<float>, label int, node string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in covertree.near_vectors(df).collect()}
    matrix, labels, ids = np.array([r[1] for r in rows], dtype="f4").astype(float), np.array([r[2] for r in rows]), [r[0] for r in rows]
    linked = (covertree.cosines(matrix, matrix) >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    want = roots(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked))])
    for i, k in enumerate(ids):
        assert got[k] == (int(linked[i].sum()), want[k], want[k] == k)
    assert all(got[r[0]] == (0, r[0], True) for r in bad) and len(got) == len(rows) + len(bad)
    assert covertree.near_vectors(df.limit(0)).count() == 0


def test_near_vectors_with_repeated_ids(spark):
    """One id names two vectors: each has its own links, and the smallest id of a component is found behind it."""
    rows = [
        (1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (5, [1.0, 0.01], 0), (6, [0.01, 1.0], 0), (7, [0.02, 1.0], 0), (7, [0.02, 1.0], 0),
        (0, [-1.0, 0.0], 0), (5, [-1.0, 0.01], 0), (8, [1.0, 0.0], 1), (1, [1.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = sorted(tuple(r) for r in covertree.near_vectors(df).collect())
    assert got == sorted([
        (1, 1, 1, True), (1, 3, 1, True), (5, 1, 1, False), (6, 3, 1, False), (7, 3, 1, False), (7, 3, 1, False),
        (0, 1, 0, True), (5, 1, 0, False), (8, 1, 1, False), (1, 1, 1, True),
    ])


def test_pipeline_on_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = corpus_pipeline.materialised(stage(spark, docs, ""), name)
            assert out.columns == docs.columns and out.count() <= docs.count()
            docs = out
        corpus_pipeline.STAGES[-1][1](spark, docs, "").count()


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="given tables not present")
def test_pipeline_keeps_one_of_each_class(spark):
    pieces = corpus_pipeline.run(spark, TABLES).collect()
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").collect()
    by_words = {}
    for d in sorted(docs, key=lambda d: d.doc_id):
        by_words.setdefault("".join(d.text.split()), []).append(d.doc_id)
    left = {p.doc_id for p in pieces}
    assert all(len(left & set(same)) <= 1 for same in by_words.values()) and left <= {d.doc_id for d in docs}


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="given tables not present")
def test_pipeline_ends_without_secrets_and_copies(spark, tmp_path):
    """Planted rows: one holds keys, one is its near copy, one an exact copy, one has no letters; the ids at the end tell."""
    docs = spark.read.schema(SCHEMAS["documents"]).parquet(f"{TABLES}/documents.parquet")
    key, account = "q7Zk2VxP9sLm4TtRw8Yb3NcE", "AKIA" + "Q3Z7" * 5
    body = prose(11, 150)
    text = f"{body} api_key = {key} and then {account} {prose(12, 40)}"
    planted = [
        (900_001, text), (900_002, text.replace("river", "canal", 1)), (900_003, text.replace(" ", "  ", 3)),
        (900_004, "12345 67890 --"), (900_005, None),
    ]
    rows = spark.createDataFrame([(k, t, None, "web", len(t or "")) for k, t in planted], SCHEMAS["documents"])
    docs.unionByName(rows).write.parquet(str(tmp_path / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    decode = Tokenizer.from_file(BYTE_BPE).decode
    ids = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.piece)):
        assert len(p.token_ids) == 4 * p.length and zlib.crc32(bytes(p.token_ids)) == p.ids_crc32
        ids.setdefault(p.doc_id, []).extend(np.frombuffer(bytes(p.token_ids), "<u4").tolist())
    left = {k for k in ids if k > 900_000}
    # Of exact copies the longest stays, then of near copies the smallest id.
    assert left == {900_002}
    out = decode(ids[900_002][:-1], skip_special_tokens=False)
    assert key not in out and account not in out and out.count("[secret]") == 2 and "canal" in out
