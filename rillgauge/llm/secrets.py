"""Secrets in texts: fixed patterns, and random strings that a vocabulary spells inefficiently.

A tokenizer's vocabulary packs several characters of ordinary words and names into a token and
hardly more than one and a half of a random key. So every long run of key characters is
encoded, outside of fixed patterns, digests and UUIDs, and each long stretch of it with few characters per token
is reported, up to the next separators, unless it is plain numbers. Each text is scanned whole, where it is read; there is no shuffle.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillgauge.llm.common import ready, row_slices, whole_text

SLICE_BYTES = 4 << 20
RUN = 20  # characters of the shortest run that is examined
EFFICIENCY = 2.1  # characters per token below which a run counts as random
BLOCK = 4096  # a longer run is encoded in blocks of so many characters
KINDS = ("assign", "access", "hex", "random")

# The patterns and least lengths of the base kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

RUNS = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % RUN)
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
KNOWN = re.compile(r"[0-9/_=+-]+")
SEPARATORS = "/_=+-"
PART = re.compile(rf"(?<![A-Za-z0-9])(?:{UUID.pattern}|{DIGEST.pattern})(?![A-Za-z0-9])")


class Efficiency:
    """Characters per token under a vocabulary of ranks."""

    def __init__(self, ranks_path: str, split: str):
        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.coder = tiktoken.Encoding("ranks", pat_str=split, mergeable_ranks=ranks, special_tokens={})

    def lengths(self, run: str) -> list[int]:
        """Characters of each token of an ASCII string."""
        ids = (k for i in range(0, len(run), BLOCK) for k in self.coder.encode_ordinary(run[i : i + BLOCK]))
        return [len(self.coder.decode_single_token_bytes(k)) for k in ids]

    def __call__(self, run: str) -> float:
        return len(run) / len(self.lengths(run))


_EFFICIENCY: dict[tuple[str, str], Efficiency] = {}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in code points, end exclusive."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    # A match of the other two that is long enough lies inside a run.
    for run in RUNS.finditer(text):
        at, part = run.start(), run[0]
        if "AKIA" in part:
            found += [
                (at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(part) if m.end() - m.start() >= ACCESS_LEAST
            ]
        found += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(part) if m.end() - m.start() >= HEX_LEAST]
    return found


def excluded(run: str) -> bool:
    """A digest, a UUID or plain numbers."""
    return bool(KNOWN.fullmatch(run) or UUID.fullmatch(run) or len(run) in DIGEST_LENGTHS and DIGEST.fullmatch(run))


def longest(scores: list[float], ends: list[int]) -> tuple[int, int] | None:
    """The longest stretch of tokens (first, end) whose scores add up to more than 0, of ``RUN`` characters or more."""
    total = [0.0]
    for x in scores:
        total.append(total[-1] + x)
    lows = [0]  # places of ever lower sums, where a longest stretch can begin
    for i, x in enumerate(total):
        if x < total[lows[-1]]:
            lows.append(i)
    best, size = None, RUN - 1
    for j in range(len(scores), 0, -1):
        while lows and total[lows[-1]] < total[j]:
            i = lows.pop()
            if i < j and ends[j] - ends[i] > size:
                best, size = (i, j), ends[j] - ends[i]
    return best


def random_parts(piece: str, efficiency: Efficiency) -> list[tuple[int, int]]:
    """Stretches with few characters per token (start, end), to the next separators or the ends of the piece.

    A stretch that is inefficient as a whole is narrowed to where its tokens are shortest, so that readable parts beside
    a key are not taken along; what is left on either side is examined again.
    """
    lengths = efficiency.lengths(piece)
    ends = [0]
    for n in lengths:
        ends.append(ends[-1] + n)
    found, open_parts = [], [(0, len(lengths))]
    while open_parts:
        first, end = open_parts.pop()
        scores = [EFFICIENCY - n for n in lengths[first:end]]
        stretch = longest(scores, ends[first : end + 1])
        if stretch is None:
            continue
        low, high = first + stretch[0], first + stretch[1]
        best = total = 0.0
        start, a, b = low, low, high
        for i in range(low, high):
            total += EFFICIENCY - lengths[i]
            if total <= 0:
                total, start = 0.0, i + 1
            elif total > best:
                best, a, b = total, start, i + 1
        left, right = ends[a], ends[b]
        while left > 0 and piece[left - 1] not in SEPARATORS:
            left -= 1
        while right < len(piece) and piece[right] not in SEPARATORS:
            right += 1
        while left < right and piece[left] in SEPARATORS:
            left += 1
        if not excluded(piece[left:right]):
            found.append((left, right))
        open_parts += [(first, a), (b, end)]
    merged: list[tuple[int, int]] = []
    for left, right in sorted(found):
        if merged and left < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(right, merged[-1][1]))
        else:
            merged.append((left, right))
    return merged


def all_spans(text: str, efficiency: Efficiency) -> list[tuple[int, int, int]]:
    """Base spans and, in the runs beside them, stretches with few characters per token; by start, then kind."""
    base = base_spans(text)
    more = []
    for run in RUNS.finditer(text):
        start, end = run.span()
        cuts = [(max(a, start), min(b, end)) for a, _, b in base if a < end and start < b]
        cuts += [(start + m.start(), start + m.end()) for m in PART.finditer(run[0]) if excluded(m[0])]
        at = start
        for a, b in [*sorted(cuts), (end, end)]:
            if a - at >= RUN and not excluded(text[at:a]):
                more += [(at + x, 3, at + y) for x, y in random_parts(text[at:a], efficiency)]
            at = max(at, b)
    return sorted(base + more)


def find_secrets(
    docs: DataFrame, ranks_path: str, split: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: the id and ``spans``, an array of (kind, start, end) by start, then kind.

    Offsets are code points, the end exclusive. A null or empty text has no spans; texts of any length are scanned whole;
    repeated rows give repeated results; a null id stays null; other columns, whatever their names, are not read.
    """
    ready(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        key = (ranks_path, split)
        efficiency = _EFFICIENCY.get(key) or _EFFICIENCY.setdefault(key, Efficiency(*key))
        for batch in batches:
            for part in row_slices(batch, 1, SLICE_BYTES):
                spans = [
                    [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in all_spans(text, efficiency)]
                    for text in part.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind)], names=["key", "spans"])

    id_kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("key"), whole_text(text_col).alias("text"))
    out = source.mapInArrow(run, f"key {id_kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")
    return out.withColumnRenamed("key", id_col)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def redact(
    docs: DataFrame, ranks_path: str, split: str, text_col: str = "text", mark: str = "[secret]",
) -> DataFrame:
    """The same rows and columns, each secret in the text replaced by ``mark``; a text without one is unchanged.

    Overlapping spans are replaced as one. A null text stays null.
    """
    ready(docs.sparkSession)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)
    schema = docs.toDF(*names).schema

    def run(batches):
        key = (ranks_path, split)
        efficiency = _EFFICIENCY.get(key) or _EFFICIENCY.setdefault(key, Efficiency(*key))
        for batch in batches:
            for part in row_slices(batch, at, SLICE_BYTES):
                texts = [t if t is None else masked(t, efficiency, mark) for t in part.column(at).to_pylist()]
                columns = [pa.array(texts, pa.string()) if i == at else part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.toDF(*names).mapInArrow(run, schema).toDF(*docs.columns)


def masked(text: str, efficiency: Efficiency, mark: str) -> str:
    out, at = [], 0
    for start, _, end in all_spans(text, efficiency):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
