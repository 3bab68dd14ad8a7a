"""Phrases, source mixes and the repair of conversations, against brute force and plain SQL."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillgauge.llm import dialogue, mixing, phrases
from rillgauge.llm import queries as Q

from .conftest import prose

TABLES = "/root/testdata/sf0.001"
PIECES, WORDS = re.compile("[.,;:!?\x0a-\x0d]"), re.compile("[^\x20\x09]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SOLID = re.compile("[^\x20\x09-\x0d]+")


def cell(v):
    return f"{v:.10g}" if isinstance(v, float) else v


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="given tables not present")
@pytest.mark.parametrize("name", ["op11_phrases", "op12_source_mix", "op13_conversation_repair"])
def test_queries_equal_plain_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(TABLES):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{TABLES}/{file}'")
    df = Q.QUERIES[name](spark, TABLES)
    columns = sorted(df.columns)
    relation = con.sql(Q.ORACLES[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    want = sorted([tuple(cell(r[i]) for i in order) for r in relation.fetchall()], key=repr)
    assert sorted([tuple(cell(r[c]) for c in columns) for r in df.collect()], key=repr) == want


# Phrases


def brute_counts(rows, longest):
    found, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECES.split((text or "").translate(LOWER)):
            words = WORDS.findall(piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                found[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return found, totals


def brute_collocations(rows, least=10, covered=50, top=2000):
    out = []
    counts, totals = brute_counts(rows, 3)
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = []
        for p, a in good.items():
            more = max((b for q, b in good.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))), default=0)
            if more and 100 * more >= covered * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            held.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(held)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def got_collocations(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture()
def small_tables(monkeypatch):
    monkeypatch.setattr(phrases, "BITS", 22)


def test_collocations_of_odd_rows(odd, empty, texts, small_tables):
    rows = [(r.lang, r.text) for r in odd.select("lang", "text").collect()]
    assert got_collocations(phrases.collocations(odd)) == brute_collocations(rows)
    assert phrases.collocations(empty).count() == 0


def test_collocations_in_many_shards_and_slices(spark, monkeypatch, small_tables):
    rng = random.Random(3)
    names = ["a\nb", "a", None, "", "é"]
    parts = ["The", "the", "b", "Été", "été", "x\x01y", "中", ".", ", ", "\t", "\x0b", "  ", "-", "..", "lamp post", "of the"]
    rows = [(rng.choice(names), "".join(rng.choice(parts) + rng.choice([" ", " ", " ", ""]) for _ in range(rng.randint(0, 300)))) for _ in range(60)]
    rows += [("a", "lamp post in the garden " * 4000), ("a", ""), ("a", None), ("b", "."), *[("r", "one two three")] * 12]
    want = brute_collocations(rows, least=12, top=40)
    monkeypatch.setattr(phrases, "SHARD_BYTES", 300)
    monkeypatch.setattr(phrases, "SLICE_BYTES", 500)
    monkeypatch.setattr(phrases, "HELD", 200)
    monkeypatch.setattr(phrases, "AT_ONCE", 2)
    got = got_collocations(phrases.collocations(spark.createDataFrame(rows, "lang string, text string"), least=12, top=40))
    assert got == want


def test_hash_sums_are_packed(spark):
    """Sums of hashes over several parts, counts of over 255 too, and no row per hash in the shuffle."""
    rng = np.random.default_rng(5)
    want, parts = Counter(), {}
    for _ in range(3):
        some = rng.integers(0, 1 << phrases.DIGITS, 3000, dtype=np.uint64)
        some = np.concatenate([some, some[:20].repeat(700), some[:1].repeat(255), rng.integers(0, 900, 2000).astype(np.uint64), [0, (1 << phrases.DIGITS) - 1]])
        want.update(some.astype(np.uint64).tolist())
        batch = phrases.packed(*np.unique(some.astype(np.uint64), return_counts=True))
        for group, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parts.setdefault(group, []).append(data)
    got = {}
    for group, data in parts.items():
        found, times = phrases.unpacked(group, data)
        got |= dict(zip(found.tolist(), times.tolist(), strict=True))
    assert got == want
    rows = [("en", "one two " * 9 + "three"), ("en", "One two, four"), ("en", "one two"), (None, "one two " * 4)]
    docs = spark.createDataFrame(rows, "lang string, text string").fillna("und")
    assert [phrases._frequent(docs, [], n).count() for n in (1, 4, 8, 11, 12)] == [5, 3, 2, 1, 0]
    plan = phrases._frequent(docs, [], 1)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and plan.count("Exchange") == 1


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_019
    counts = spark.createDataFrame([("x", "p q", big), ("x", "p", big + 2), ("x", "q", big + 7)], "lang string, phrase string, n bigint")
    totals = spark.createDataFrame([("x", 7 * big)], "lang string, n bigint")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *a: (counts, totals))
    row = phrases.collocations(counts).first()
    assert row.score == 1_000_000 * big * big // ((big + 2) * (big + 7)) and row.a == big


def test_trie_holds_its_keys_alone():
    rng = random.Random(1)
    keys = sorted({bytes(rng.choice(b"abc \n\x00\xff") for _ in range(rng.randint(1, 9))) for _ in range(3000)} | {bytes([c]) for c in range(256)})
    trie = phrases.Trie.of(keys)
    assert [trie.accept[trie.walk(k)] for k in keys] == list(range(len(keys)))
    known = set(keys)
    for _ in range(3000):
        other = bytes(rng.choice(b"abcd \n\x00\xff") for _ in range(rng.randint(1, 9)))
        state = trie.walk(other)
        assert (state is not None and trie.accept[state] >= 0) == (other in known)


def test_equal_hashes_are_told_apart():
    words = phrases.Words(b"aa bb aa cc bb aa", 17)
    at = phrases._distinct(words, np.zeros(6, dtype=np.uint64), np.arange(6), 1)
    assert {words.row[words.starts[i] : words.ends[i]].tobytes() for i in at} == {b"aa", b"bb", b"cc"}


# Mixes


def brute_mix(rows, weights=(5, 2, 1), share=1.5, most=2):
    size = {k: Counter() for k in ("source",)}["source"]
    for _, text, source in rows:
        size[source] += len(SOLID.findall(text or ""))
    names = sorted((s for s in size if s is not None)) + [s for s in size if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(size.values()), set(names), {}
    while True:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * left / total >= most * size[s]] if total else []
        if not over:
            break
        for s in over:
            target[s] = float(most * size[s])
            left -= target[s]
            open_.remove(s)
    for s in open_:
        target[s] = weight[s] * left / total
    return size, target


def checked_mix(df, rows, most=2):
    size, target = brute_mix(rows)
    got = df.collect()
    assert len(got) == len(rows)
    taken, partly = Counter(), Counter()
    source_of = {}
    for k, _, source in rows:
        source_of.setdefault(k, source)
    for r in got:
        source = source_of[r.doc_id]
        assert r.source_size == size[source] and math.isclose(r.target, target[source], rel_tol=1e-12, abs_tol=1e-9)
        assert 0 <= r.taken <= most * r.size
        taken[source] += r.taken
        partly[source] += bool(r.size and r.taken % r.size)
        if r.size:
            assert r.taken // r.size >= int(round(target[source]) // size[source]) or r.taken % r.size
    for s in size:
        assert taken[s] == math.floor(target[s] + 0.5) and partly[s] <= 1
    return got


@pytest.fixture(scope="module")
def sourced(spark, odd):
    rng = random.Random(9)
    rows = [(r.doc_id, r.text, None if r.doc_id and r.doc_id % 2 else "Ω") for r in odd.select("doc_id", "text").collect() if r.doc_id != 9]
    rows = [r for r in rows if r[0] is not None] + [(None, "a null id", None), (None, "a null id", None)]
    for i in range(100, 700):
        rows.append((i, prose(i, rng.randint(0, 60)), rng.choice(["a", "a", "a", "b", "B", "", "tiny"]) if i % 50 else "tiny"))
    rows.append((9000, "   ", "blank"))  # words of other white space
    rows.append((9001, None, "nothing"))
    return rows


def test_mix_meets_its_targets(spark, sourced):
    frame = spark.createDataFrame(sourced, "doc_id bigint, text string, source string")
    got = checked_mix(mixing.mix(frame), sourced)
    again = mixing.mix(frame.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    coarse = mixing.mix(frame.withColumn("size", F.lit("x")).withColumn("class", F.lit(1)))
    assert sorted(map(repr, coarse.collect())) == sorted(map(repr, got))
    assert mixing.mix(frame.limit(0)).count() == 0


def test_heavier_documents_come_first(spark):
    rows = [(i, "w " * 10, "s" if i < 4000 else "t") for i in range(8000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    quality = spark.createDataFrame([(i, 3.0) for i in range(0, 8000, 2)] + [(1, 0.0), (1, None), (None, 5.0), (0, 1.0)], "doc_id bigint, weight double")
    got = {r.doc_id: r for r in mixing.mix(frame, quality).collect()}
    drawn = [k for k, r in got.items() if k >= 4000 and r.taken]
    heavy = sum(1 for k in drawn if k % 2 == 0) / len(drawn)
    chance = random.Random(4)  # the same draw in plain Python
    keys = sorted((-math.log(chance.random()) / (3 if i % 2 == 0 else 1), i) for i in range(4000))[: len(drawn)]
    assert abs(heavy - sum(1 for _, i in keys if i % 2 == 0) / len(keys)) < 0.04
    assert got[1].taken % 10 == 0


def test_the_mix_itself(spark, sourced):
    frame = spark.createDataFrame([(*r, "x") for r in sourced], "doc_id bigint, text string, source string, rank string")
    taken = Counter()
    for r in mixing.mix(frame).collect():
        taken[r.doc_id] += r.taken
    whole = mixing.mixed(frame)
    assert whole.columns == frame.columns
    words = Counter()
    for r in whole.collect():
        words[r.doc_id] += len(SOLID.findall(r.text or ""))
    assert +words == +taken


# Conversations


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute_repair(rows):
    """(blank, duplicate, truncated, illegal, cost, audit, lines) of the (turn, role, text) of a conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.sub("[\x20\x09-\x0d]", "", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    legal = re.compile("(s?(ua)+)?")
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserts):
        options = []
        if i == len(rows):
            if last in ("", "a"):
                options.append((0, "", ()))
        else:
            _, role, text = rows[i]
            late = 3 if faults[i] == "truncated" else 0

            def then(cost, letter, line, to):
                c, edits, lines = best(i + 1, to, 0)
                options.append((cost + c, letter + edits, (*line, *lines)))

            then(4, "D", (), last)
            if faults[i] not in ("blank", "duplicate"):
                if role[:1] and role[:1] in after[last]:
                    then(late, "K", (f"{role}:{text}",), role[0])
                for new in ("user", "assistant"):
                    if new[0] in after[last]:
                        then(3 + late, "R", (f"{new}:{text}",), new[0])
        if inserts < 3:
            for new in ("user", "assistant"):
                if new[0] in after[last]:
                    c, edits, lines = best(i, new[0], inserts + 1)
                    options.append((3 + c, "I" + edits, (f"{new}:", *lines)))
        return min(options, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    assert legal.fullmatch("".join(line[0] for line in lines))
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return *(faults.count(x) for x in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, lines


def brute_report(rows):
    hurt = defaultdict(list)
    for conv, *rest in brute_damage(rows):
        hurt[conv].append(tuple(rest))
    out = []
    for conv in {r[0] for r in rows}:
        held = hurt[conv]
        blank, duplicate, truncated, illegal, cost, audit, lines = brute_repair(held)
        turns = {t for t, *_ in held if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(8)
    roles = ["user", "assistant", "system", "tool", "", None, "s", "User", "admin"]
    texts = ["Yes.", "Yes.", "no", "Why?\n", "Go! \t", "", " ", None, " ", "a.b", "Ok.  ", "naïve…", "Fine."]
    rows = []
    for conv in [*range(60), None, -5]:
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 13])):
            rows.append((conv, rng.choice([None, *range(12), -3]), rng.choice(roles[:3] if rng.random() < 0.8 else roles), rng.choice(texts)))
    rows += [(777, i, "ua"[i % 2] if i % 7 else "s", rng.choice(["Yes.", f"{i}.", f"{i}", "  "])) for i in range(300)]
    rows += [(778, 1, "user", "the same.")] * 50
    return rows


@pytest.mark.parametrize("block, segment", [(4, 1 << 20), (3, 7), (1, 1)])
def test_repair_equals_brute_force(spark, talks, monkeypatch, block, segment):
    monkeypatch.setattr(dialogue, "SEGMENT", segment)
    if block != dialogue.BLOCK:
        own = dialogue.Tables
        monkeypatch.setattr(dialogue, "Tables", lambda: own(block))
    frame = spark.createDataFrame([(*r, "x") for r in talks], "conv_id bigint, turn bigint, role string, text string, at string")
    got = dialogue.report(frame, dialogue.Repair(dialogue.damaged(frame)))
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == brute_report(talks)


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    repair = dialogue.Repair(none)
    assert repair.repaired().count() == 0 and dialogue.report(none, repair).count() == 0
    dropped = spark.createDataFrame([(5, None, None, None)], none.schema)
    row = dialogue.report(dropped, dialogue.Repair(none)).first()
    assert (row.conv_id, row.cost, row.audit, row.repaired_sha256) == (5, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_rows(spark):
    rows = [("x", 1, "system", "Be kind."), ("x", 2, "user", "Hi."), ("x", 4, "user", "Hello?"), ("x", 5, "assistant", "Yes.")]
    repair = dialogue.Repair(spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string"))
    got = [(r.role, r.text) for r in repair.repaired().orderBy("at", "place").collect()]
    assert got == [("system", "Be kind."), ("user", "Hi."), ("assistant", ""), ("user", "Hello?"), ("assistant", "Yes.")]
    assert repair.audits().first().audit == "KKIKK"


def test_block_tables_equal_single_steps():
    one, four = dialogue.Tables(1), dialogue.Tables(4)
    rng = np.random.default_rng(1)
    for _ in range(200):
        symbols = rng.integers(0, dialogue.SYMBOLS, rng.integers(0, 15)).astype(np.uint8)
        for a, b in zip(one.through(symbols), four.through(symbols), strict=True):
            assert (a == b).all()
        assert list(one.behind(symbols, 3)) == list(four.behind(symbols, 3))
