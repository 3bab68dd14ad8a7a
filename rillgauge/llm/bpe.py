"""Byte-level BPE by forced boundaries.

A byte pair that occurs inside no vocabulary token can never be merged across, so
the text may be cut there. The pairs are taken from the vocabulary; a cut is used only
where the pre-tokenizer ends a match for certain as well: before a blank, tab or line
break that follows something else, and before ASCII punctuation that follows a Latin
letter or a digit. The fragments between cuts are encoded one by one, each distinct one
once while it is remembered, and their ids are put together in order.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgauge.llm.common import ready, row_slices, whole_text

REMEMBERED = 500_000  # distinct fragments kept by a worker; beyond it they are encoded again
SLICE_BYTES = 4 << 20
LATIN = "0-9A-Za-zÀ-ÖØ-öø-ſ"
PUNCTUATION = r"!-/:-@\[-`{-~"
BREAKS = " \t\n\r"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file, as letter to byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level BPE file, added tokens included."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = byte_letters()
    found = {i: bytes(letters[c] for c in word) for word, i in spec["model"]["vocab"].items()}
    found |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
    return [found.get(i, b"") for i in range(max(found) + 1)]


def inner_pairs(tokens: list[bytes]) -> np.ndarray:
    """``[a, b]`` is true where byte b follows byte a inside some token."""
    seen = np.zeros((256, 256), dtype=bool)
    for token in tokens:
        row = np.frombuffer(token, dtype=np.uint8)
        seen[row[:-1], row[1:]] = True
    return seen


def fragment_pattern(tokens: list[bytes]) -> re.Pattern:
    """The pattern whose matches are the fragments; it cuts only at pairs no token holds inside."""
    seen = inner_pairs(tokens)
    solid = np.array([b for b in range(256) if b not in (*range(9, 14), 32)])
    # After an ASCII character a break must always be a cut; the last bytes of other characters may be exceptions.
    breaks = [c for c in BREAKS if not seen[solid[solid < 128], ord(c)].any()]
    if not breaks:
        return re.compile(r"(?s:.+)")
    except_after = {int(b) for c in breaks for b in solid if seen[b, ord(c)]}
    doubtful = "".join(
        chr(c) for c in range(0x80, 0x10000)
        if not 0xD800 <= c < 0xE000 and chr(c).encode()[-1] in except_after
    ) + ("\U00010000-\U0010ffff" if except_after else "\x00")
    ends = {chr(c).encode()[-1] for c in range(0x30, 0x180) if re.match(f"[{LATIN}]", chr(c))}
    marks = [c for c in range(33, 127) if re.match(f"[{PUNCTUATION}]", chr(c)) and not seen[list(ends), c].any()]
    stop = re.escape("".join(map(chr, marks))) + "".join(breaks)
    return re.compile(
        rf"\s*[{LATIN}]+(?:(?=[{stop}])(?<![{doubtful}])|\Z)"
        rf"|\s*\S+(?:(?:[^\S{''.join(breaks)}]|(?<=[{doubtful}])\s)\s*\S*)*|\s+"
    )


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, and back."""

    def __init__(self, path: str, ranks_path: str | None = None, split: str | None = None):
        self.path = path
        self.tokens = token_bytes(path)
        self.pattern = fragment_pattern([t for t in self.tokens if t])
        with open(path, encoding="utf-8") as file:
            self.added = [t["content"] for t in json.load(file).get("added_tokens", [])]
        self.quick = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            # Only when both files state the same ids may one stand in for the other.
            if all(self.tokens[i] == t for t, i in ranks.items()):
                self.quick = tiktoken.Encoding("ranks", pat_str=split, mergeable_ranks=ranks, special_tokens={})
        self.latin = re.compile("[\\x00-ɏ]*\\Z")
        self.known: dict[str, bytes] = {}

    @cached_property
    def whole(self):
        """The library's tokenizer; made when a fragment or text first needs it."""
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.path)
        made.no_truncation()
        made.no_padding()
        return made

    def _fragment(self, text: str) -> bytes:
        if self.quick is not None and (text.isascii() or self.latin.match(text)):
            ids = self.quick.encode_ordinary(text)
        else:
            ids = self.whole.encode(text, add_special_tokens=False).ids
        ids = array("I", ids).tobytes()
        if len(self.known) < REMEMBERED and len(text) <= 64:
            self.known[text] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """All ids of the text; a text that spells an added token goes to the library whole."""
        if any(t in text for t in self.added):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        known, fragment = self.known, self._fragment
        return b"".join([known.get(p) or fragment(p) for p in self.pattern.findall(text)])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join([self.tokens[i] for i in ids.tolist()]).decode("utf-8", errors="replace")


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, ranks_path: str | None = None, split: str | None = None) -> Encoder:
    """The worker's encoder for these files, made once."""
    key = (path, ranks_path, split)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def crc32(ids: bytes) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids) & 0xFFFFFFFF


def encode(
    docs: DataFrame, path: str, ranks_path: str | None = None, split: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: the id, ``token_ids`` (little-endian unsigned 32-bit, binary) and ``decoded``.

    No shuffle: every document is encoded where it is read. A null text is empty and gives no ids; texts of any
    length are encoded whole; repeated rows give repeated results; a null id stays null; other columns,
    whatever their names, are not read.
    """
    ready(docs.sparkSession)

    def run(batches):
        coder = encoder(path, ranks_path, split)
        for batch in batches:
            for part in row_slices(batch, 1, SLICE_BYTES):
                ids = [coder.encode(t) for t in part.column(1).to_pylist()]
                decoded = [coder.decode(np.frombuffer(x, dtype="<u4")) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                    names=["key", "token_ids", "decoded"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("key"), whole_text(text_col).alias("text"))
    out = source.mapInArrow(run, f"key {kind}, token_ids binary, decoded string")
    return out.withColumnRenamed("key", id_col)


def id_digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of ids, sha256 of the decimal ids joined by commas, sha256 of the decoded text."""

    def run(batches):
        import hashlib

        words: list[str] = []
        for batch in batches:
            for part in row_slices(batch, 1, SLICE_BYTES):
                ids = [np.frombuffer(x, dtype="<u4").tolist() for x in part.column(1).to_pylist()]
                top = max((max(x) for x in ids if x), default=-1)
                words.extend(map(str, range(len(words), top + 1)))
                joined = [hashlib.sha256(",".join([words[i] for i in x]).encode()).hexdigest() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([len(x) for x in ids], pa.int64()),
                        pa.array(joined, pa.string()), part.column(2),
                    ],
                    names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = encoded.schema[id_col].dataType.simpleString()
    source = encoded.select(
        F.col(id_col).alias("key"), "token_ids", F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    )
    out = source.mapInArrow(run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", id_col)
