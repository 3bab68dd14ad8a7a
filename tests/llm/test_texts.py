"""Operators on single texts and on equal ones, against plain Python."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rillgauge.llm import bpe, counts, exact, langid, packing, planes, secrets, substring
from rillgauge.llm import queries as Q
from rillgauge.session import scratch_path

WHITE = re.compile("[\x20\x09-\x0d]")
ARGS = (Q.BYTE_BPE, Q.BYTE_RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(Q.BYTE_BPE)


def sorted_rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_exact_groups(odd, texts):
    groups = defaultdict(list)
    for k, t in texts:
        groups[WHITE.sub("", t or "")].append((-len(t or ""), k is None, k or 0, k))
    want = []
    for content, rows in groups.items():
        best = min(rows)[3]
        digest = hashlib.sha256(content.encode()).hexdigest()
        want += [(k, best, len(rows), digest) for *_, k in rows]
    got = exact.duplicates(odd)
    assert sorted_rows(got, "doc_id", "keep_id", "group_size", "digest") == sorted(want, key=repr)
    kept = got.where("kept").collect()
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_exact_colliding_digests(odd):
    from pyspark.sql import functions as F

    weak = exact.duplicates(odd, digest=lambda content: F.substring(F.sha2(F.encode(content, "UTF-8"), 256), 1, 1))
    columns = ("doc_id", "keep_id", "group_size")
    assert sorted_rows(weak, *columns) == sorted_rows(exact.duplicates(odd), *columns)


def test_exact_hot_group_is_dealt_over_shares(spark):
    """A third of all rows are copies: they meet their winner in many shares, and unique texts in one each."""
    data = [(i, "hot  text" if i == 1500 else "hot text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.duplicates(docs).collect()}
    assert got == {i: (1500, 1000, i == 1500) if i % 3 == 0 else (i, 1, True) for i, _ in data}
    shares = {r.content: bin(r.shares).count("1") for r in exact.classes(docs).collect()}
    assert shares.pop("hottext") == exact.SHARES and set(shares.values()) == {1}
    assert sorted(r.doc_id for r in exact.drop_duplicates(docs).collect()) == sorted({k for k, *_ in got.values()})


def test_exact_rows_that_stay(odd, empty, texts):
    rows = exact.drop_duplicates(odd)
    assert rows.columns == odd.columns
    assert rows.count() == len({WHITE.sub("", t or "") for _, t in texts})
    assert exact.drop_duplicates(empty).count() == 0 and exact.duplicates(empty).count() == 0


@pytest.mark.parametrize("text", [
    "", " ", "a  b", "don't  stop\n\n x", "é à  la", "x  y 　 z", "<|endoftext|> a<|endoftext|>", "a\x1c b", "ᄀ \U0001f600 中文 1²Ⅷ",
])
def test_bpe_equals_library(library, text):
    coder = bpe.Encoder(*ARGS)
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == ids
    assert coder.decode(np.array(ids, dtype=int)) == library.decode(ids, skip_special_tokens=False)
    plain = bpe.Encoder(Q.BYTE_BPE)
    assert plain.encode(text) == coder.encode(text)


def test_no_token_crosses_a_cut():
    tokens = [t for t in bpe.token_bytes(Q.BYTE_BPE)]
    pattern = bpe.fragment_pattern(tokens)
    assert all(len(pattern.findall(t)) == 1 for t in (x.decode("utf-8", "ignore") for x in tokens) if t)


def test_bpe_query_columns(odd, empty, texts, library):
    got = bpe.id_digests(bpe.encode(odd, *ARGS))
    want = []
    for k, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        joined = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((k, len(ids), joined, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted_rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert bpe.id_digests(bpe.encode(empty, *ARGS)).count() == 0


@pytest.mark.parametrize("block", [counts.BLOCK_BYTES, 2000])
def test_token_counts(odd, empty, texts, monkeypatch, block):
    import sentencepiece

    monkeypatch.setattr(counts, "BLOCK_BYTES", block)
    model = sentencepiece.SentencePieceProcessor(model_file=Q.PIECES)
    want = [(k, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for k, t in texts]
    got = counts.token_counts(odd, Q.PIECES)
    assert sorted_rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    assert counts.token_counts(empty, Q.PIECES).count() == 0


def test_pieces_of_pre_tokens():
    import random

    import sentencepiece

    model, count = sentencepiece.SentencePieceProcessor(model_file=Q.PIECES), counts.PieceCounter(Q.PIECES)
    cut, rng = re.compile(count.pattern), random.Random(5)
    letters = [*"abcZ é'\t\n\r .,!?0中ع\U0001f600▁<|", "  ", "the ", "<s>", "　"]
    for _ in range(2000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))
        assert sum(count(counts.pre_tokens(text, cut))) == len(model.encode(text)), text


def brute_repeats(rows, width):
    seen, out = set(), []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out.append((key, len(words), sum(gone), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(16 << 20, 24 << 20, 1 << 20), (30_000, 60_000, 4000)])
def test_substring(odd, empty, texts, monkeypatch, sizes):
    for name, size in zip(("CHUNK_BYTES", "BUCKET_BYTES", "SLICE_BYTES"), sizes):
        monkeypatch.setattr(substring, name, size)
    got = substring.remove_repeats(odd)
    assert sorted_rows(got, "doc_id", "n_words", "n_removed", "kept_text") == brute_repeats(texts, 20)
    for r in got.where("n_removed > 0").collect():
        spans = [(s.start, s.end) for s in r.removed]
        assert sum(b - a for a, b in spans) == r.n_removed and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    assert substring.remove_repeats(empty).count() == 0


def test_long_words_made_to_collide():
    """A Thue-Morse word and its complement are equal for every polynomial modulo 2^64."""
    for n in (1024, 4096):
        bits = [bin(i).count("1") % 2 for i in range(n)]
        a, b = (bytes(97 + (x ^ y) for x in bits) for y in (0, 1))
        found = substring.word_hashes(b"%s %s\nword %s" % (a, b, a))
        assert len(found) == 4 and found[0] != found[1] and found[0] == found[3]


def test_language(spark, odd, empty):
    held = [("de", "der alte mann und das haus am fluss mit dem hund"), ("en", "the old man and the house at the river with the dog")]
    labelled = spark.createDataFrame([*held, (None, "x"), ("fr", None)] * 3, "lang string, text string")
    model = langid.fit(labelled)
    assert model.languages == ["de", "en"]
    asked = spark.createDataFrame([("the dog and the man",), ("Das Haus und der Hund!",), (None,), ("12 -- !",), ("",)], "text string")
    got = langid.predict(asked, model).collect()
    assert [r.lang_pred for r in got] == ["en", "de", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in got) and [r.score for r in got[2:]] == [0, 0, 0]
    kept = langid.recognised(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()}.isdisjoint({1, 2, 3, 13})
    assert langid.recognised(empty, model).count() == 0
    none = langid.fit(labelled.limit(0))
    assert {r.lang_pred for r in langid.predict(asked, none).collect()} == {"und"}


def test_cross_parse_counts_longest_matches(monkeypatch):
    sample = "abracadabra cad"
    model = langid.build({"a": [sample], "b": ["zzz yyy"]})
    indexed = "".join(chr(c) if c else " " for c in np.concatenate([langid.code_points(sample), np.zeros(1, "<u4")]))

    def phrases(text, source):
        at = n = 0
        while at < len(text):
            k = 1
            while at + k < len(text) and text[at : at + k + 1] in source:
                k += 1
            at, n = at + k, n + 1
        return n

    rng = np.random.default_rng(4)
    long = "".join(rng.choice(list("abrcd qzé"), 5000))
    for text in ("abra", "cadabracad", "brabra cad ab", "qqaq", "ra" * 50, "a", "abracadabra cad" * 400, long):
        text = "".join(chr(c) if c else " " for c in langid.code_points(text))  # as the parse sees it
        bits = langid.parse(model, [langid.code_points(text)])
        byte_wise = text.encode().decode("latin-1")  # phrases are runs of bytes
        assert bits[0, 0] == pytest.approx(phrases(byte_wise, indexed) * model.bits[0] / len(text))


def test_languages_with_many_letters():
    """Four made-up languages, two of them on the same 120 letters, that differ in the order of their syllables."""
    import random

    def words(language, seed):
        first, second = (0x4E00, 0x4E00, 0x0430, 0x05D0)[language], (60, 60, 15, 12)[language]
        rng, turn = random.Random(seed), language == 1
        pairs = [(a, b) for a in range(second) for b in range(second, 2 * second) if (a * 7 + b) % 5 == 0]
        return " ".join("".join(chr(first + x) for x in (p[::-1] if turn else p)) for p in rng.choices(pairs, k=60))

    model = langid.build({str(n): [words(n, 1000 * n + k) for k in range(400)] for n in range(4)})
    asked = [(n, langid.code_points(words(n, 10**6 + 1000 * n + k))) for n in range(4) for k in range(25)]
    bits = langid.parse(model, [a for _, a in asked])
    assert bits.argmin(axis=0).tolist() == [n for n, _ in asked]


def test_language_sample_goes_beyond_openings():
    import random

    def body(seed, letters):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(200))

    banner = "shared banner " * 20
    samples = {n: [banner + body(k, x) for k in range(400)] for n, x in (("a", "bcdfg"), ("b", "hjklm"))}
    model = langid.build(samples)
    assert all(model.symbols[ord(c)] for c in "bcdfghjklm")
    bits = langid.parse(model, [langid.code_points(body(1000, "bcdfg")), langid.code_points(body(1001, "hjklm"))])
    assert bits.argmin(axis=0).tolist() == [0, 1] and (bits.max(axis=0) > 1.5 * bits.min(axis=0)).all()


def test_secrets(odd, empty, spark):
    key = "kX9vQ2mZ7pLw4RtB8nYc3HsD"
    rows = [
        (1, 'é password = "abc123" x password=ab1 passwd:abcdef'), (2, "AKIA" + "Q" * 16 + " AKIA12"), (3, f"id {key} end"),
        (4, "a" * 3 + "0123456789abcdef0123456789abcdef"), (5, "550e8400-e29b-41d4-a716-446655440000 some_long_identifier_name_here2"),
        (6, None), (7, ""), (8, "D41D8CD98F00B204E9800998ECF8427E"), (9, f"API_KEY: {key}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.find_secrets(docs, *ARGS[1:]).collect()}
    assert got[1] == [("assign", 2, 20), ("assign", 37, 50)]
    assert got[2] == [("access", 0, 20)]
    assert got[3] == [("random", 3, 27)]
    assert got[4] == [("hex", 0, 35)]
    assert got[5] == got[6] == got[7] == got[8] == []
    assert got[9] == [("assign", 0, 33)]
    clean = {r.doc_id: r.text for r in secrets.redact(docs, *ARGS[1:]).collect()}
    assert clean[3] == "id [secret] end" and clean[6] is None and clean[5] == rows[4][1]
    assert secrets.redact(odd, *ARGS[1:]).columns == odd.columns
    assert secrets.find_secrets(empty, *ARGS[1:]).count() == 0


@pytest.fixture(scope="module")
def efficiency():
    return secrets.Efficiency(*ARGS[1:])


NAMES = [
    "some_long_identifier_name_here2", "getElementsByTagNameNS", "AbstractSingletonProxyFactoryBean", "internationalization",
    "/internal/service/configuration/production/credentials/", "com/path/users/documents/download/files/",
]


def test_random_letters_and_groups(efficiency):
    import random
    import string

    rng = random.Random(8)

    def some(letters, n):
        return "".join(rng.choice(letters) for _ in range(n))

    makers = [
        lambda: some(string.ascii_lowercase, 32), lambda: some(string.ascii_uppercase, 32),
        lambda: "-".join(some(string.ascii_uppercase, 5) for _ in range(5)),
        lambda: "-".join(some(string.ascii_lowercase, 4) + some(string.digits, 4) for _ in range(4)),
    ]
    for make in makers:
        found = 0
        for _ in range(200):
            key = make()
            found += secrets.all_spans(f"see {key} here", efficiency) == [(4, 3, 4 + len(key))]
        assert found >= 190
    assert not any(secrets.all_spans(f"see {x} here", efficiency) for x in NAMES)


def test_random_keys_beside_readable_text(efficiency):
    import random
    import string

    rng = random.Random(9)
    base62 = string.ascii_letters + string.digits
    digest = "0123456789abcdef01234567"
    for before, after in (*((x, "") for x in NAMES[-2:]), ("/".join(NAMES[-2:] * 40), "/config/files/" * 9), (f"{digest}-", "")):
        found = 0
        for _ in range(100):
            key = "".join(rng.choice(base62) for _ in range(24))
            text = f"see {before}{key}{after} here"
            at = text.index(key)
            found += any(k == 3 and a <= at and at + 24 <= b <= at + 32 for a, k, b in secrets.all_spans(text, efficiency))
        assert found >= 95, (before[:40], found)
    plain = ["log/2024-11-05-12-33-22-44-55", "item_550e8400-e29b-41d4-a716-446655440000", "md5-D41D8CD98F00B204E9800998ECF8427E"]
    assert not any(secrets.all_spans(f"see {x} here", efficiency) for x in plain + ["/".join(NAMES * 50)])


def test_packing(odd, empty, texts, library):
    pieces = packing.cut(odd, *ARGS, capacity=64)
    got = packing.pack(pieces, 64).collect()
    want = sorted((library.encode(t or "", add_special_tokens=False).ids + [0] for _, t in texts), key=len)
    assert sum(r.length for r in got) == sum(map(len, want))
    whole, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        assert r.length == 64 or r.piece == 0
        if r.doc_id == 10:
            whole[r.piece] = np.frombuffer(bytes(r.token_ids), "<u4").tolist()
            assert r.start == (0 if r.piece == 0 else len(whole[0]) + 64 * (r.piece - 1)) or 0 not in whole
    assert [i for k in sorted(whole) for i in whole[k]] == want[-1]
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(packing.cut(empty, *ARGS), 2048).count() == 0


def test_packing_ranks_narrow_rows(odd):
    """The ranking window holds no token ids: a length's pieces are not buffered whole (pipeline, over 3000 MB)."""
    packed = packing.pack(packing.cut(odd, *ARGS, capacity=64), 64)

    def nodes(plan):
        yield plan
        children = plan.children()
        for i in range(children.size()):
            yield from nodes(children.apply(i))

    windows = [n for n in nodes(packed._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Window"]
    assert windows
    assert not any("token_ids" in n.output().mkString(",") for n in windows)
    got = packed.collect()
    assert sorted(r.doc_id or 0 for r in got) == sorted(r.doc_id or 0 for r in packing.cut(odd, *ARGS, capacity=64).collect())
    assert "_piece_row" not in packed.columns


def test_packing_plans():
    import random

    rng = random.Random(1)
    for _ in range(60):
        capacity, wanted = rng.randint(1, 60), defaultdict(int)
        for _ in range(rng.randint(0, 200)):
            wanted[rng.randint(1, capacity)] += rng.randint(1, 9)
        found = defaultdict(int)
        for times, lengths in packing.plan(dict(wanted), capacity, groups=rng.randint(1, 12), large=rng.choice([2, 4, 8])):
            assert times > 0 and 0 < sum(lengths) <= capacity
            for k in lengths:
                found[k] += times
        assert found == wanted
    many = {k: 40 + k % 7 for k in range(1, 2049)}
    least = -(-sum(k * n for k, n in many.items()) // 2048)
    assert sum(n for n, _ in packing.plan(many, 2048)) <= 1.02 * least


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    for n in (1, 7, 8, 1000):
        ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
        assert (planes.from_planes(planes.to_planes(ids, bits), n) == ids).all()


@pytest.mark.parametrize("bits", [False, True])
def test_token_files(spark, odd, empty, texts, library, monkeypatch, bits):
    monkeypatch.setattr(planes, "BLOCK_IDS", 256)
    monkeypatch.setattr(planes, "SHARD_BYTES", 50_000)
    folder = scratch_path(spark, "planes")
    planes.write(odd, folder, *ARGS, bits=bits)
    rows = planes.read(spark, folder).collect()
    at = 0
    for k, t in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4").tobytes()
        mine = [r for r in rows if r.start == at]
        assert len(mine) == 1 and mine[0].doc_id == k and zlib.crc32(mine[0].token_ids) == zlib.crc32(ids)
        at += len(ids) // 4
    index = spark.read.parquet(f"{folder}/index").orderBy("start").collect()
    assert sum(r.n_ids for r in index) == at and all(x.start + x.n_ids == y.start for x, y in zip(index, index[1:]))
    folder = scratch_path(spark, "none")
    planes.write(empty, folder, *ARGS)
    assert planes.read(spark, folder).count() == 0
