"""Near duplicates by order MinHash and banded alignment.

A text's shingles of three words are labelled with their number of occurrence. Under each of ``SKETCHES`` hash functions
the ``ORDERED`` smallest labelled shingles are taken, and their sequence in the order of the text is a key: two texts
share a key when they hold the same rare shingles in the same order, which follows their edit similarity and not
the bag of words alone. Texts that share a key are candidates; a candidate pair is linked when the edit
distance of its words, found in a band around the diagonal, is at most a fifth of the longer text.

Texts too short for hashing have exact keys, so that no link between them is missed. With ``k`` edits, two texts have the same
words in the same order but for ``k`` words of the longer one: up to ``WORDWISE`` words, every such choice of words is a key.
Up to ``GRAMWISE`` words, every run of ``GRAM`` words is a key, since as many edits as a link allows leave one run unbroken.

Exact copies are one class from the start and take part as one text. Pairs whose lengths or classes of words leave no link possible
are left out before their texts are read. The texts of a key are not
all paired with each other: each is compared with a leader first, then with one text of a key's largest component at a time.
In keys that still hold several components, the texts outside the largest one take turns, more in each round, in meeting all
texts in other components; pairs of which one text has more classes of words that the other lacks than a link has edits are
left out. Before that, keys of more than ``DIRECT`` texts, such as those made of a passage that thousands of otherwise different
texts hold, are divided by rare words. Of two texts with ``k`` edits, each lacks at most ``k`` of the other's words, so
both have a word in common among the ``k + 1`` words that each holds and that are rarest among the texts of such keys (a word's
first, second, ... occurrences count as different words). So the texts of a link meet in a rare word, and texts that share the
passage alone do not; the turns are then taken among the texts of a rare word. So every candidate pair is compared, already
connected, or out of reach of a link.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillgauge.llm.common import ready, row_slices, whole_text
from rillgauge.llm.components import components
from rillgauge.llm.phrases import DIGITS, among, bit_table
from rillgauge.llm.substring import hashed, mixed, windows
from rillgauge.operators.sizing import broadcast_if_small
from rillgauge.session import discard, materialised

SHINGLE = 3
SKETCHES = 96
ORDERED = 2
SIMILARITY = 0.8
WORDWISE = 15  # words of the longer text of a pair, up to which choices of words are keys
GRAMWISE = 40  # and up to which runs of GRAM words are; from WORDWISE + 1 words on, a link leaves one unbroken
GRAM = 4
SLICE_BYTES = 2 << 20
COLUMNS = 65_536  # shingles hashed at once, of whole texts
NEAREST = 12  # of a text's shingles, about, are looked through for the smallest ones
BITWISE = 1 << 14  # words of a text up to which its words are bits of one number
CANDIDATE_BYTES = 64 << 20  # up to this measured size the candidates' ids are broadcast
SIGNS = 8  # 64-bit numbers that say which of 512 classes of words a text holds
DIRECT = 256  # texts of a key up to which they take turns in it, rather than in their rare words
SINGLE_ROUNDS = 3  # rounds of one pair per text, before turns are taken
FIRST_TURN = 16  # texts of a key that take their turn in the first round; each round has so many times more
NO_ID = -(1 << 63)  # stands for a null id inside
_ODD = mixed(np.arange(1, 2 * SKETCHES + 1, dtype=np.uint64))
_TIMES, _PLUS = _ODD[:SKETCHES, None] | np.uint64(1), _ODD[SKETCHES:, None]


def labelled(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of shingles, or words, that also tell first, second, ... occurrences in a text apart; ``sizes`` has their number in each text."""
    order = np.argsort(shingles, kind="stable")
    ordered, owner = shingles[order], np.repeat(np.arange(len(sizes)), sizes)[order]
    fresh = np.concatenate([[True], (ordered[1:] != ordered[:-1]) | (owner[1:] != owner[:-1])])[: len(order)]
    if fresh.all():
        return mixed(shingles)
    place = np.arange(len(order))
    number = np.empty(len(order), dtype=np.uint64)
    number[order] = place - np.maximum.accumulate(np.where(fresh, place, 0))
    return mixed(shingles + number * np.uint64(0x9FB21C651E98DF25))


def sketched(marks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The keys of texts, a row each, from their labelled shingles in order, ``ORDERED`` a text at least.

    Only the shingles under a bound that about ``NEAREST`` of a text's are under are compared; a text with too few of them is looked through whole.
    """
    every = np.iinfo(np.uint64).max
    out = np.empty((len(sizes), SKETCHES), dtype=np.uint64)
    starts = np.cumsum(sizes) - sizes
    limit = np.repeat(every // np.maximum(sizes, NEAREST).astype(np.uint64) * np.uint64(NEAREST), sizes)
    for i in range(SKETCHES):
        values = (marks ^ _PLUS[i]) * _TIMES[i]
        at = np.flatnonzero(values <= limit)
        first = np.searchsorted(at, starts)
        held = np.diff(first, append=len(at))
        if (held < ORDERED).any():
            at = np.flatnonzero((values <= limit) | np.repeat(held < ORDERED, sizes))
            first = np.searchsorted(at, starts)
            held = np.diff(first, append=len(at))
        least, picked = values[at], []
        for _ in range(ORDERED):
            found = np.flatnonzero(least == np.repeat(np.minimum.reduceat(least, first), held))
            one = found[np.searchsorted(found, first)]
            picked.append(at[one])
            least[one] = every
        key = _PLUS[i]
        for chosen in marks[np.sort(picked, axis=0)]:
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + chosen)
        out[:, i] = key
    return out.view(np.int64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The keys of a text from its shingles in order."""
    sizes = np.array([len(shingles)])
    return sketched(labelled(shingles, sizes), sizes)[0]


def allowed(longer: int) -> int:
    """Edits that a link may have when its longer text has so many words."""
    return int(longer * (1 - SIMILARITY) + 1e-9)


def choices(words: np.ndarray) -> np.ndarray:
    """Keys of a short text: the choices of its words that every linked text of up to ``WORDWISE`` words has one of."""
    lengths = {longer - allowed(longer) for longer in range(len(words), WORDWISE + 1)}
    out = []
    for n in sorted(x for x in lengths if x <= len(words)):
        chosen = words[np.array(list(combinations(range(len(words)), n)))]
        key = np.full(len(chosen), n, dtype=np.uint64)
        for i in range(n):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + chosen[:, i])
        out.append(key)
    return np.unique(np.concatenate(out))


def sketches(texts: list[bytes]) -> list[np.ndarray]:
    """Keys of each text; one without words has no key."""
    hashes, counts = hashed(texts)
    every, at = windows(hashes, counts, SHINGLE)
    grams, gram_at = windows(hashes, counts, GRAM)
    ends = np.cumsum(counts)
    starts = ends - counts
    first, last = np.searchsorted(at, starts), np.searchsorted(at, ends)
    first_gram, last_gram = np.searchsorted(gram_at, starts), np.searchsorted(gram_at, ends)
    long, rows = np.flatnonzero(counts >= GRAMWISE + 1 - allowed(GRAMWISE + 1)), {}
    # The shingles of texts behind one another, of so many texts at once that they stay near the processor.
    group = np.cumsum((last - first)[long]) // COLUMNS
    for some in np.split(long, np.flatnonzero(np.diff(group)) + 1) if len(long) else []:
        sizes = (last - first)[some]
        inside = np.repeat(first[some] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        rows.update(zip(some.tolist(), sketched(labelled(every[inside], sizes), sizes), strict=True))
    out = []
    for i, n in enumerate(counts.tolist()):
        keys = [np.empty(0, dtype=np.int64)]
        if 0 < n <= WORDWISE:
            keys.append(choices(hashes[starts[i] : ends[i]]).view(np.int64))
        # A text has a link with a longer one of up to n / SIMILARITY words, so it takes part from fewer words on.
        if WORDWISE + 1 - allowed(WORDWISE + 1) <= n <= GRAMWISE:
            keys.append(mixed(np.unique(grams[first_gram[i] : last_gram[i]])).view(np.int64))
        if i in rows:
            keys.append(rows[i])
        out.append(np.concatenate(keys))
    return out


def edit_distance(a: list, b: list, limit: int) -> int | None:
    """Least number of words to insert, delete or replace, or None when it is over ``limit``.

    Per number of edits, the furthest place reached on each diagonal of the band. When there are more than a few edits, and the texts are
    not very long, the columns of the table of distances are worked out as numbers of as many bits as there are words.
    """
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return None
    at = 0
    while at < n and at < m and a[at] == b[at]:
        at += 1
    while n > at and m > at and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    a, b = a[at:n], b[at:m]
    n, m = len(a), len(b)
    if not n or not m:
        return max(n, m)
    if max(n, m) - sum((Counter(a) & Counter(b)).values()) > limit:
        return None
    goal, far = m - n, {0: 0}
    few = limit if min(n, m) > BITWISE else min(limit, isqrt(max(n, m)))
    for edits in range(1, few + 1):
        reach = {}
        for k in range(max(-n, goal - (limit - edits), -edits), min(m, goal + (limit - edits), edits) + 1):
            i = max(far.get(k, -2) + 1, far.get(k - 1, -2), far.get(k + 1, -2) + 1)
            if i < 0:
                continue
            i = min(i, n, m - k)
            while i < n and i + k < m and a[i] == b[i + k]:
                i += 1
            reach[k] = i
        if reach.get(goal, -1) >= n:
            return edits
        far = reach
    return _bitwise(a, b, limit) if few < limit else None


def _bitwise(a: list, b: list, limit: int) -> int | None:
    """The edit distance by differences along the columns of the table, each a bit (Myers, Hyyro)."""
    if len(a) > len(b):
        a, b = b, a
    n, m = len(a), len(b)
    both, at = set(b), {}
    for i, word in enumerate(a):
        if word in both:
            at[word] = at.get(word, 0) | 1 << i
    every, last = (1 << n) - 1, n - 1
    up, down, edits = every, 0, n
    for j, word in enumerate(b):
        same = at.get(word, 0)
        level = same | down
        across = (((same & up) + up) ^ up) | same
        more, less = down | (every & ~(across | up)), up & across
        edits += (more >> last & 1) - (less >> last & 1)
        # Each word that is left takes one edit back at most.
        if edits - (m - 1 - j) > limit:
            return None
        more = more << 1 | 1
        up, down = (less << 1 & every) | (every & ~(level | more)), more & level
    return edits


def similar(a: list, b: list, least: float = SIMILARITY) -> bool:
    """Whether one less the edit distance over the longer length is ``least`` or more."""
    longest = max(len(a), len(b))
    return edit_distance(a, b, int(longest * (1 - least) + 1e-9)) is not None


def _sized(texts: DataFrame) -> DataFrame:
    """(``key``, ``text``, ``words``, ``signs``): with the number of words and the classes of words as bits."""

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, 1, SLICE_BYTES):
                hashes, counts = hashed([t.encode() for t in part.column(1).to_pylist()])
                held = np.zeros((len(part), 64 * SIGNS), dtype=bool)
                held[np.repeat(np.arange(len(part)), counts), (hashes % np.uint64(64 * SIGNS)).astype(np.int64)] = True
                signs = np.packbits(held, axis=1, bitorder="little").view("<i8").ravel()
                signs = pa.ListArray.from_arrays(pa.array(np.arange(0, len(signs) + 1, SIGNS, dtype=np.int32)), pa.array(signs))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(counts), signs], names=["key", "text", "words", "signs"]
                )

    return texts.select("key", "text").mapInArrow(run, "key bigint, text string, words bigint, signs array<bigint>")


def _sifted(unique: DataFrame, table) -> DataFrame:
    """(``key``, ``bucket``): the keys that both bits of a broadcast table are marked for, see :func:`phrases.bit_table`."""

    def run(batches):
        for batch in batches:
            keys = batch.column(1)
            flat = keys.flatten().to_numpy(zero_copy_only=False)
            good = among(table.value, flat.view(np.uint64))
            owner = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), pa.compute.list_value_length(keys).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(owner[good]), pa.array(flat[good])], names=["key", "bucket"])

    return unique.select("key", "keys").mapInArrow(run, "key bigint, bucket bigint")


def _rare_words(texts: DataFrame) -> DataFrame:
    """(``bucket``, ``key``): of each text the words one of which it shares with every text that it is similar to.

    That is one word more than a link has edits, the rarest ones among all these texts, and of them those that
    another text holds too. Words are hashes that tell occurrences apart.
    """

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, 1, SLICE_BYTES):
                hashes, counts = hashed([t.encode() for t in part.column(1).to_pylist()])
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                words = pa.ListArray.from_arrays(ends, pa.array(labelled(hashes, counts).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), words], names=["key", "words"])

    held = materialised(texts.select("key", "text").mapInArrow(run, "key bigint, words array<bigint>"), "held")
    words = held.select("key", F.size("words").alias("n"), F.explode("words").alias("bucket"))
    # A word that one text alone holds is in no pair, but takes a place among the rarest.
    counts = words.groupBy("bucket").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    shared = words.join(counts, "bucket")
    edits = F.floor(F.col("n") * (1 - SIMILARITY) + 1e-9)
    rarest = Window.partitionBy("key").orderBy("texts", "bucket")
    ranked = shared.withColumn("single", F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("key"))).withColumn(
        "rank", F.col("single") + F.row_number().over(rarest)
    )
    rare = materialised(ranked.where(F.col("rank") <= edits + 1).select("bucket", "key"), "rare")
    discard(held)
    return rare


def _near(own: str, other: str):
    """Whether lengths and classes of words of two texts leave a link possible."""
    longer = F.greatest("words", "lead_words")
    edits = F.floor(longer * (1 - SIMILARITY) + 1e-9)

    def lacking(x: str, y: str):
        return sum((F.bit_count(F.col(x)[i].bitwiseAND(F.bitwise_not(F.col(y)[i]))) for i in range(SIGNS)), F.lit(0))

    # Each word that the other text lacks takes an edit.
    return (F.least("words", "lead_words") >= longer - edits) & (lacking(own, other) <= edits) & (lacking(other, own) <= edits)


def _possible(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) that may be linked by their lengths and classes of words; no text is read."""
    first = texts.select(F.col("key").alias("a"), "words", "signs")
    second = texts.select(F.col("key").alias("b"), F.col("words").alias("lead_words"), F.col("signs").alias("lead_signs"))
    return pairs.join(first, "a").join(second, "b").where(_near("signs", "lead_signs")).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose texts are similar."""
    inside = broadcast_if_small(materialised(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "inside"), CANDIDATE_BYTES)
    some = texts.select("key", "text").join(inside, "key", "left_semi")
    second = pairs.join(some.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    both = second.join(some.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")

    def check(batches):
        for batch in batches:
            known: dict[str, list] = {}
            for part in row_slices(batch, 2, SLICE_BYTES):
                good = []
                for a, b in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    if a not in known:
                        known = {a: a.encode().split()}
                    good.append(similar(known[a], b.encode().split()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(good))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, ``copy_id``, ``class_id``, ``class_size`` and ``kept``.

    ``copy_id`` is the smallest id of the documents with the same words in a row, ``class_id`` the smallest id reached
    by links, ``kept`` is true for one row of each class, that with this id. Words are what white space
    ``[\\x20\\x09-\\x0D]`` parts, unchanged. Texts without a word, null ones too, are copies of each other. A
    null id counts as the smallest of all; rows that repeat an id are one class, of which one row is kept. An empty
    table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    ready(spark)
    source = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("key"), whole_text(text_col).alias("text")
    )

    def run(batches):
        from hashlib import sha256

        for batch in batches:
            for part in row_slices(batch, 1, SLICE_BYTES):
                texts = [t.encode() for t in part.column(1).to_pylist()]
                digests = [sha256(b" ".join(t.split())).digest() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(digests, pa.binary()), pa.array(sketches(texts), pa.list_(pa.int64()))],
                    names=["key", "digest", "keys"],
                )

    found = materialised(source.mapInArrow(run, "key bigint, digest binary, keys array<bigint>"), "sketches")
    firsts = found.groupBy("digest").agg(F.min("key").alias("copy"))
    member = materialised(found.select("key", "digest").join(firsts, "digest").select("key", "copy", "digest"), "copies")

    only = member.select(F.col("copy").alias("key"), "digest").distinct()
    unique = materialised(found.join(only, ["key", "digest"], "left_semi").select("key", "keys"), "unique")
    discard(found)
    leads = unique.select("key", F.explode("keys").alias("bucket")).groupBy("bucket").agg(F.min("key").alias("lead"), F.max("key").alias("top"))
    shared = materialised(leads.where("lead != top").select("bucket", "lead"), "shared")
    # Most keys are those of one text. A table of fixed size leaves nearly all of them out of the shuffle to the others' leaders.
    table = spark.sparkContext.broadcast(bit_table(shared.select(F.shiftrightunsigned("bucket", 64 - DIGITS).alias("h"))))
    buckets = materialised(_sifted(unique, table).join(shared, "bucket"), "buckets")
    table.destroy()
    discard(unique)
    discard(shared)
    candidates = materialised(buckets.select("key").distinct(), "candidates")
    own = source.join(broadcast_if_small(candidates, CANDIDATE_BYTES), "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))
    texts = materialised(_sized(own), "texts")
    discard(candidates)

    # First each text against one leader, which connects most of them.
    pairs = buckets.where("key != lead").groupBy(F.col("key").alias("b")).agg(F.min("lead").alias("a")).select("a", "b")
    tested = materialised(_possible(pairs, texts), "pairs")
    links = materialised(_verified(tested, texts), "links")
    roots = materialised(components(links), "roots")
    state = buckets.select("bucket", "key", F.lit(False).alias("led"))
    single, divided, leaders = SINGLE_ROUNDS, False, FIRST_TURN
    rows = buckets
    while True:
        before, rows = rows, materialised(_open(state, roots), "rows")
        discard(before)
        if rows.isEmpty():
            break
        state = rows.select("bucket", "key", "led", "size")
        if single:
            # At first each text meets one text of one key's largest component: as many pairs as texts.
            single -= 1
            pairs = (
                rows.where("root != main").groupBy("key").agg(F.min("low").alias("low"))
                .select(F.least("key", "low").alias("a"), F.greatest("key", "low").alias("b")).distinct()
                .join(tested, ["a", "b"], "left_anti")
            )
            pairs = _possible(pairs, texts)
        elif not divided:
            signs = materialised(texts.join(rows.select("key").distinct(), "key", "left_semi").select("key", "words", "signs"), "signs")
            large = rows.where(F.col("size") > DIRECT).select("key").distinct()
            rare = _rare_words(texts.join(large, "key", "left_semi"))
            state = state.where(F.col("size") <= DIRECT).select("bucket", "key", "led").unionByName(
                rare.select("bucket", "key", F.lit(False).alias("led"))
            )
            divided = True
            continue
        else:
            turn = Window.partitionBy("bucket").orderBy("key")
            leads = materialised(
                rows.where("root != main AND NOT led").withColumn("n", F.row_number().over(turn)).where(F.col("n") <= leaders)
                .select("bucket", F.col("key").alias("lead"), F.col("root").alias("lead_root")),
                "leads",
            )
            leading = leads.join(signs.select(F.col("key").alias("lead"), F.col("words").alias("lead_words"), F.col("signs").alias("lead_signs")), "lead")
            pairs = (
                rows.join(signs, "key").join(leading, "bucket").where((F.col("root") != F.col("lead_root")) & _near("signs", "lead_signs"))
                .select(F.least("key", "lead").alias("a"), F.greatest("key", "lead").alias("b")).distinct()
                .join(tested, ["a", "b"], "left_anti")
            )
            done = leads.select("bucket", F.col("lead").alias("key"), F.lit(True).alias("done"))
            state = state.join(done, ["bucket", "key"], "left").withColumn("led", F.col("led") | F.col("done").isNotNull())
            leaders *= FIRST_TURN
        pairs = materialised(pairs, "pairs")
        tested = tested.unionByName(pairs)
        more = materialised(_verified(pairs, texts), "links")
        if more.isEmpty():
            single = 0
        else:
            before, roots = roots, materialised(_joined(roots, more), "roots")
            discard(before)
        discard(more)
    discard(texts)

    repeated = materialised(_repeated(member), "repeated")
    if not repeated.isEmpty():
        roots = materialised(_joined(roots, repeated), "roots")
    rows = member.join(roots.select(F.col("node").alias("copy"), "root"), "copy", "left").withColumn(
        "root", F.coalesce("root", "copy")
    )
    rows = materialised(rows, "classes")
    sizes = rows.groupBy("root").agg(F.count(F.lit(1)).alias("class_size"))
    first = Window.partitionBy("key", "root").orderBy("digest")
    out = rows.withColumn("kept", (F.col("key") == F.col("root")) & (F.row_number().over(first) == 1)).join(sizes, "root")

    def shown(column: str):
        return F.when(F.col(column) != NO_ID, F.col(column)).cast("bigint")

    return out.select(
        shown("key").alias(id_col), shown("copy").alias("copy_id"), shown("root").alias("class_id"), "class_size", "kept"
    )


def _open(state: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of the keys that hold several components and a text outside the largest one that had no turn.

    With ``root`` of the text, ``main`` and ``low``: root and smallest text of the key's largest component, and
    ``size``, the key's number of texts.
    """
    known = state.select("bucket", "key", "led").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    parts = known.groupBy("bucket", "root").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("led")).alias("waiting"), F.min("key").alias("low")
    )
    mains = (
        parts.groupBy("bucket").agg(F.max(F.struct("n", "root", "waiting", "low")).alias("most"), F.sum("waiting").alias("waiting"), F.sum("n").alias("size"))
        .where("waiting > most.waiting").select("bucket", "size", F.col("most.root").alias("main"), F.col("most.low").alias("low"))
    )
    return known.join(mains, "bucket")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The roots after more links: only the components that these connect are worked on."""
    new = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(roots, "node", "left_anti")
    every = materialised(roots.unionByName(new.select("node", F.col("node").alias("root"))), "roots")

    def root_of(name: str) -> DataFrame:
        return every.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))

    between = links.join(root_of("a"), "a").join(root_of("b"), "b").select(
        F.col("root_a").alias("a"), F.col("root_b").alias("b")
    )
    moved = materialised(components(materialised(between.where("a != b").distinct(), "between")), "moved")
    return every.join(moved.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select(
        "node", F.coalesce("to", "root").alias("root")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class with all its columns: that with the class's id.

    Of rows that repeat this id one stays, the first in the order of their texts. See :func:`near_duplicates`.
    """
    found = materialised(near_duplicates(docs, id_col, text_col), "near")
    kept = found.where("kept").select(F.col(id_col).alias("k"))
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("key"), F.col(text_col).alias("text"))
    rows = keyed.join(kept, F.col("key").eqNullSafe(F.col("k")), "left_semi")
    repeated = materialised(
        found.groupBy(F.col(id_col).alias("r")).count().where("count > 1").select("r"), "repeated"
    )
    if repeated.isEmpty():
        return rows.select("row.*")
    same = F.col("key").eqNullSafe(F.col("r"))
    first = Window.partitionBy("key").orderBy("text")
    one = rows.join(repeated, same, "left_semi").withColumn("n", F.row_number().over(first)).where("n = 1")
    return rows.join(repeated, same, "left_anti").select("row").unionByName(one.select("row")).select("row.*")


def _repeated(member: DataFrame) -> DataFrame:
    """Links between the copies of an id that has several texts."""
    lowest = member.groupBy("key").agg(F.min("copy").alias("a"), F.max("copy").alias("z")).where("a != z")
    return member.join(lowest.select("key", "a"), "key").select("a", F.col("copy").alias("b"))
