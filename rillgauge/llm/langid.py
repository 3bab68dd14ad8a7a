"""Language of texts by cross-parsing entropy.

A bounded sample of labelled texts of each language is indexed by a suffix automaton. A text is parsed
greedily: a phrase is the longest string that occurs in the language's sample, and the next one begins
where it ends. The fewer phrases, times the bits to name one (the logarithm of the sample's length) and per
symbol of the text, the better the language fits; the least value wins.

Texts are lower-cased letters; every run of other characters is one blank. Automata and parses go over their UTF-8 bytes, so that every
letter of every script is told apart. Texts are parsed whole, in blocks of ``BLOCK`` bytes that numpy advances side by side, each for
all languages: first as if a phrase began with each block, then those blocks again that an open phrase reaches into, from its
state, until no state at a border changes. That is the parse without blocks.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillgauge.llm.common import ready, row_slices

SAMPLE_DOCS = 400  # labelled documents of a language in the sample, at most
SAMPLE_SYMBOLS = 30_000  # symbols of a language's sample, at most; shared evenly by its texts
WINDOW_CHARACTERS = 120_000  # of a drawn text that reach the driver, at most
BLOCK = 1024
SLICE_BYTES = 4 << 20
UNKNOWN = "und"
OTHER = 0
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def code_points(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each run of other characters than letters as one blank (0)."""
    row = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4")
    row = np.where(letters()[row], row, 0)
    keep = np.ones(len(row), dtype=bool)
    keep[1:] = (row[1:] != 0) | (row[:-1] != 0)
    return row[keep]


def encoded(row: np.ndarray) -> np.ndarray:
    """The UTF-8 bytes of code points; the blank is a space."""
    text = np.where(row == 0, ord(" "), row).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every substring; state 0 is the start."""
    to, link, size = [{}], [-1], [0]
    last = 0
    for c in symbols:
        now = len(to)
        to.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in to[p]:
            to[p][c] = now
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if size[p] + 1 == size[q]:
                link[now] = q
            else:
                copy = len(to)
                to.append(dict(to[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return to


@dataclass
class Model:
    """Languages, symbols of bytes (0 for those in no sample), and the automata as one table of steps.

    ``steps[state + symbol]`` is the next state; where the symbol begins a phrase it is the complement of the state after it. States are multiples of ``width``; ``roots`` are the languages' start states.
    """

    languages: list[str]
    symbols: np.ndarray
    width: int
    steps: np.ndarray
    roots: np.ndarray
    bits: np.ndarray


def build(samples: dict[str, list[str]]) -> Model:
    """The model of sampled texts by language."""
    languages = sorted(samples)
    rows = {}
    for name in languages:
        # Every text gives an even share, so that one long text is not the whole sample, from a place chosen by its
        # hash, so that openings that many texts have in common are not all of it.
        held = sorted((code_points(t) for t in samples[name]), key=len)
        taken, left = [], SAMPLE_SYMBOLS
        for i, row in enumerate(held):
            share = min(len(row), left // (len(held) - i))
            start = zlib.crc32(row.tobytes()) % (len(row) - share + 1)
            taken.append(row[start : start + share])
            left -= len(taken[-1])
        rows[name] = np.concatenate([*taken, np.zeros(1, dtype="<u4")])
    rows = {name: encoded(row) for name, row in rows.items()}
    seen = np.unique(np.concatenate([*rows.values(), np.zeros(0, np.uint8)]))
    symbols = np.full(256, OTHER, dtype=np.uint8)  # UTF-8 has fewer than 255 different bytes
    symbols[seen] = np.arange(1, len(seen) + 1)
    width = len(seen) + 1
    tables, roots, bits, base = [], [], [], 0
    for name in languages:
        automaton = suffix_automaton(symbols[rows[name]].tolist())
        table = np.full((len(automaton), width), -1, dtype=np.int32)
        for state, to in enumerate(automaton):
            for c, target in to.items():
                if c != OTHER:
                    table[state, c] = target * width + base
        del automaton  # its dictionaries are larger than the table
        begun = np.where(table[0] >= 0, table[0], base)
        np.copyto(table, ~begun[None, :], where=table < 0)
        table[0] = ~begun  # the start, also behind a symbol that is not in the sample and so a phrase of its own
        tables.append(table.ravel())
        roots.append(base)
        bits.append(np.log2(max(2, len(rows[name]))))
        base += table.size
    steps = np.concatenate([*tables, np.zeros(0, np.int32)])
    return Model(languages, symbols, width, steps, np.array(roots, dtype=np.int32), np.array(bits))


def parse(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Bits per letter or blank of each text (code points) under each language; infinite for an empty one."""
    letters_of = np.array([len(t) for t in texts], dtype=np.int64)
    rows = [model.symbols[encoded(t)] for t in texts]
    lengths = np.array([len(r) for r in rows], dtype=np.int64)
    blocks = -(-lengths // BLOCK)
    owner = np.repeat(np.arange(len(texts)), blocks)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    sizes = np.minimum(lengths[owner] - place * BLOCK, BLOCK)
    grid = np.zeros((len(owner), BLOCK), dtype=np.uint8)
    at = 0
    for row, n in zip(rows, blocks, strict=True):
        padded = np.zeros(n * BLOCK, dtype=np.uint8)
        padded[: len(row)] = row
        grid[at : at + n] = padded.reshape(n, BLOCK)
        at += n
    entry = np.repeat(model.roots[:, None], len(owner), axis=1)
    leaving, starts = np.zeros_like(entry), np.zeros(entry.shape, dtype=np.int32)
    changed = np.arange(len(owner))
    while len(changed):
        leaving[:, changed], starts[:, changed] = _advanced(model, grid[changed], sizes[changed], entry[:, changed])
        reached = entry.copy()
        reached[:, 1:] = np.where(place[1:] > 0, leaving[:, :-1], entry[:, 1:])
        changed = np.flatnonzero((reached != entry).any(axis=0))
        entry = reached
    phrases = np.zeros((len(model.languages), len(texts)))
    for i in range(len(model.languages)):
        phrases[i] = np.bincount(owner, weights=starts[i], minlength=len(texts))
    return phrases * model.bits[:, None] / np.where(letters_of > 0, letters_of, np.inf)[None, :]


def _advanced(model: Model, grid: np.ndarray, sizes: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The states behind blocks and the phrases that begin in them, from the states before them."""
    order = np.argsort(-sizes, kind="stable")
    columns = np.ascontiguousarray(grid[order].T)
    active = np.searchsorted(-sizes[order], -np.arange(BLOCK), side="left")  # blocks longer than each step
    state, starts = entry[:, order], np.zeros(entry.shape, dtype=np.int32)
    for step in range(BLOCK):
        n = active[step]
        if n == 0:
            break
        to = model.steps[state[:, :n] + columns[step, :n]]
        turn = to >> 31
        starts[:, :n] -= turn
        state[:, :n] = to ^ turn
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.arange(len(order))
    return state[:, back], starts[:, back]


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of the languages in a labelled frame.

    The sample is bounded: of each language the ``SAMPLE_DOCS`` rows with the smallest hashes of their texts, and of
    their symbols ``SAMPLE_SYMBOLS``, from a place in each text that a hash chooses. Rows without a text or a label teach nothing.
    """
    ready(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    # The draw is among distinct hashes, without the texts; at most SAMPLE_DOCS of a language come back.
    keyed = rows.withColumn("mark", F.xxhash64("text"))
    drawn = Window.partitionBy("lang").orderBy("mark")
    picked = (
        keyed.select("lang", "mark").distinct().withColumn("n", F.row_number().over(drawn))
        .where(F.col("n") <= SAMPLE_DOCS).select("lang", "mark")
    )
    place = F.pmod("mark", F.greatest(F.char_length("text") - WINDOW_CHARACTERS + 1, F.lit(1))) + 1
    drawn_part = F.substring("text", place.cast("int"), F.lit(WINDOW_CHARACTERS))
    sample = (
        keyed.join(F.broadcast(picked), ["lang", "mark"], "left_semi").groupBy("lang", "mark")
        .agg(F.min("text").alias("text")).select("lang", drawn_part.alias("text"))
    )
    found: dict[str, list[str]] = {}
    for row in sample.toLocalIterator():
        found.setdefault(row.lang, []).append(row.text)
    return build({k: sorted(v) for k, v in found.items()})


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The frame with ``lang_pred``, ``score`` (0 to 1) and ``entropy`` (bits per letter or blank under that language).

    ``score`` is one less the ratio of the best to the second best value, and 1 for a model of one language. A null
    text, one without a letter, and every text under a model of no language get ``und`` and 0. Texts are
    parsed whole; equal values go to the first name in order; repeated rows stay, other columns are passed on, an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by SAMPLE_SYMBOLS letters a language, four bytes each at most
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)

    def run(batches):
        own = shared.value
        for batch in batches:
            for part in row_slices(batch, at, SLICE_BYTES):
                texts = [code_points(t or "") for t in part.column(at).to_pylist()]
                lang, score, entropy = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
                good = [i for i, t in enumerate(texts) if own.languages and t.any()]
                if good:
                    bits = parse(own, [texts[i] for i in good])
                    best = bits.argmin(axis=0)
                    least = bits.min(axis=0)
                    score[good] = 1.0
                    if len(own.languages) > 1:
                        score[good] = 1 - least / np.partition(bits, 1, axis=0)[1]
                    entropy[good] = least
                    for i, k in zip(good, best.tolist(), strict=True):
                        lang[i] = own.languages[k]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(entropy)],
                    names=[*names, "lang_pred", "score", "entropy"],
                )

    fields = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields, strict=True))
    out = docs.toDF(*names).mapInArrow(run, f"{fields}, lang_pred string, score double, entropy double")
    return out.toDF(*docs.columns, "lang_pred", "score", "entropy")


def recognised(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose language is known, with the columns of the frame."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = predict(docs, model, text_col).toDF(*names, "lang_pred", "score", "entropy")
    return rows.where(F.col("lang_pred") != UNKNOWN).select(*names).toDF(*docs.columns)


def held_out(key: Column) -> Column:
    """Whether a document is kept from learning: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))
