"""Sequence packing along a space-filling curve.

Each document's hashed bag of token ids is projected to ``DIMS`` dimensions;
the point's place on a Hilbert curve is its key. Documents are range-sorted by
key, so that neighbours in a partition are alike, and laid end to end into
sequences of ``LENGTH`` tokens; a document is cut where a sequence is full.
What remains at the end of a partition fills sequences whose lengths are powers
of two, largest first, so no sequence needs padding.

Texts are tokenised once; ids are written compressed to the shared folder
(range bounds are then sampled from that table) and shuffled once. A
document's key is completed by a hash of its id, so copies of one text spread
over partitions. A task streams its documents and holds one sequence.

Words repeat, so a worker keeps the ids of words it has seen; the cache is
bounded. That, and the short way from plain words to the merge model, holds for
tokenizers that normalise and split as ``SPLIT_WORDS`` says and never merge over
white space. A tokenizer's file is compared with it when it is loaded; any other
one reads every text whole. Ids take 16 bits where the vocabulary allows it,
else 32.

Nulls: a null text is empty and consists of the end token alone. A null doc_id
is packed like any other. Rows that repeat a doc_id are packed each for itself.
Other columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import ctypes
import gc
import json
import re
import sys
import types
import zlib
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, by_ranges, mix64, table, written

LENGTH = 2048
#: Tokens of a range of the curve, about, at most.
RANGE_TOKENS = 100_000_000
END = 1
DIMS, BITS = 4, 10
HASHED = 4096
#: Words whose ids a worker keeps.
CACHE = 400_000
#: Rows of texts in one Arrow batch.
TEXT_ROWS = 2_000
_SCHEMA = "doc_id bigint, hilbert bigint, salt bigint, doc_tokens bigint, ids binary"
_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places of integer points [n, dims] on the Hilbert curve, by the
    transpose algorithm: undo the turns of each level, Gray-code, interleave."""
    x = [points[:, i].astype(np.uint64) for i in range(points.shape[1])]
    one, q = np.uint64(1), np.uint64(1 << (bits - 1))
    level = q
    while level > one:
        low = level - one
        for i in range(len(x)):
            turned = (x[i] & level) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        level >>= one
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    t, level = np.zeros_like(x[0]), q
    while level > one:
        t = np.where((x[-1] & level) != 0, t ^ (level - one), t)
        level >>= one
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = (key << one) | (((v ^ t) >> np.uint64(b)) & one)
    return key


def projection(n_ids: int) -> np.ndarray:
    """Token id -> its row of the projection of hashed vectors."""
    bits = mix64(np.arange(HASHED * DIMS, dtype=np.uint64) + np.uint64(77))
    rows = (bits >> np.uint64(11)).astype(float).reshape(HASHED, DIMS) / 2.0**53 * 2 - 1
    return rows[(mix64(np.arange(n_ids, dtype=np.uint64)) % np.uint64(HASHED)).astype(np.int64)].astype(np.float32)


def curve_point(vector: np.ndarray) -> np.ndarray:
    """Projected mean vectors [n, DIMS] -> integer points (their spread is a
    few tenths, whatever the corpus)."""
    squeezed = 1.0 / (1.0 + np.exp(-vector / 0.06))
    return np.minimum((squeezed * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


#: How the tokenizers that may be read word by word normalise and split (their
#: own settings, fixed values).
SPLIT_WORDS = (
    [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None)],
    [("Split", r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), ("ByteLevel", None)],
)


def by_words(path: str) -> bool:
    """Whether a tokenizer's file says that texts may be read word by word."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)

    def steps(part: dict | None, inner: str) -> list[tuple]:
        each = (part or {}).get(inner) or ([part] if part else [])
        return [(x.get("type"), (x.get("pattern") or {}).get("Regex")) for x in each]

    return (steps(told.get("normalizer"), "normalizers"), steps(told.get("pre_tokenizer"), "pretokenizers")) == SPLIT_WORDS


def id_type(path: str) -> str:
    """The numpy type of a tokenizer's ids."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


#: ASCII marks but the apostrophe, which contractions use.
_MARKS = re.escape("".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"))
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_ONE_RUN = re.compile(f"[{_LETTERS}]+").fullmatch
_PLAIN = re.compile(f"[{_LETTERS}0-9{_MARKS}]+").fullmatch
_RUNS = re.compile(f"[{_LETTERS}]+|[0-9]|[{_MARKS}]+").findall
#: Byte-level vocabularies write a byte as one character: printable ones as
#: themselves, the others as those from 256 on, in order.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(_HIDDEN)}


class WordIds(dict):
    """word (UTF-8) -> its ids as 16-bit numbers.

    Words of Latin letters, digits and marks, nearly all, go straight to the
    merge model: the tokenizer's own normalising and splitting would leave them
    lower-cased and cut at changes of kind. All others take the whole
    tokenizer. Half of ``CACHE`` words are kept in each of two generations.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model, self.older = self.tokenizer.model, {}
        self.by_words, self.kind = by_words(path), id_type(path)
        if self.kind != "<u2":
            self.by_words = False

    def _compute(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():  # ASCII letters
            return array("H", [t.id for t in self.model.tokenize(word.decode("ascii"))]).tobytes()
        if word[-1] in b".," and word[-2:-1].isalpha():
            return self[word[:-1]] + self[word[-1:]]  # a mark after a letter is cut off
        text = word.decode("utf-8").lower()
        if _ONE_RUN(text):
            runs = [text]
        elif _PLAIN(text) and "<|" not in text:
            runs = _RUNS(text)
        else:
            return array("H", self.tokenizer.encode(word.decode("utf-8"), add_special_tokens=False).ids).tobytes()
        if not text.isascii():
            runs = [r.encode("utf-8").decode("latin-1").translate(_BYTE_CHARS) for r in runs]
        return array("H", [t.id for r in runs for t in self.model.tokenize(r)]).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._compute(word)
        if len(self) >= CACHE // 2:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, words)), np.uint16)

    def ids_of(self, raw: bytes) -> np.ndarray:
        """The ids of a text in UTF-8."""
        if not self.by_words:
            return np.array(self.tokenizer.encode(raw.decode("utf-8"), add_special_tokens=False).ids, self.kind)
        # With nothing to compose with and no special token, case can go first.
        raw = raw.lower() if raw.isascii() and b"<|" not in raw else raw
        return self.ids(raw.split())


def worker_ids(path: str) -> WordIds:
    """The cache of this worker process, kept between its tasks."""
    held = sys.modules.setdefault("_packing_word_ids", types.ModuleType("_packing_word_ids")).__dict__
    if path not in held:
        held[path] = WordIds(path)
    return held[path]


def release_ids() -> None:
    """Frees this worker's cache, for the stages that follow: workers live on
    between stages, and without the trim the freed pages stay with them, beside
    the sorts of the next stage."""
    if sys.modules.pop("_packing_word_ids", None) is not None:
        gc.collect()
        if sys.platform == "linux":
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def _tokenise(path: str):
    def run(batches):
        cache, packer = worker_ids(path), zstandard.ZstdCompressor(level=1)
        end = np.array([END], cache.kind)
        rows_of, ones = projection(max(1 << 16, cache.tokenizer.get_vocab_size())), np.ones(1 << 16, np.float32)
        for batch in batches:
            sizes, packed, means = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                raw = text.as_py() or b""
                ids = np.concatenate([cache.ids_of(raw), end])
                if len(ids) > len(ones):
                    ones = np.ones(2 * len(ids), np.float32)
                sizes.append(len(ids))
                means.append(ones[: len(ids)] @ rows_of[ids] / len(ids))
                packed.append(packer.compress(ids.tobytes()))
            if not sizes:
                continue
            key = hilbert_key(curve_point(np.array(means, float))).astype(np.int64)
            # Rows that repeat an id (or have none) differ by their place in the batch.
            place = np.arange(len(sizes), dtype=np.uint64)
            salt = mix64(np.array([i or 0 for i in batch.column(0).to_pylist()], np.int64).view(np.uint64) + mix64(place)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(key), pa.array(salt), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                names=["doc_id", "hilbert", "salt", "doc_tokens", "ids"],
            )

    return run


class _Packer:
    """Lays documents end to end; ``rows`` collects finished pieces."""

    def __init__(self, first_sequence: int, length: int):
        self.sequence, self.length, self.rows = first_sequence, length, []
        self.open: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of the open sequence
        self.used = 0

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            part = ids[start : start + self.length - self.used]
            self.open.append((doc_id, start, part, len(ids)))
            self.used += len(part)
            start += len(part)
            if self.used == self.length:
                self._close(self.open)
                self.open, self.used = [], 0

    def finish(self) -> None:
        left, self.open = self.open[::-1], []
        for bit in range(self.used.bit_length() - 1, -1, -1):
            room, pieces = self.used & (1 << bit), []
            while room:
                doc_id, start, ids, total = left.pop()
                pieces.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    left.append((doc_id, start + room, ids[room:], total))
                room -= len(pieces[-1][2])
            if pieces:
                self._close(pieces)
        self.used = 0


def _pack(length: int, kind: str):
    names = [c.split()[0] for c in _PIECES.split(", ")]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    def run(batches):
        release_ids()
        # A partition's number is the same when a lost task runs again.
        packer = _Packer(TaskContext.get().partitionId() << 40, length)
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc_id, np.frombuffer(unpack.decompress(ids.as_py()), kind))
                if len(packer.rows) >= 20_000:
                    yield out(packer.rows)
                    packer.rows = []
        packer.finish()
        if packer.rows:
            yield out(packer.rows)

    return run


def tokenised(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, hilbert, salt, doc_tokens, ids) of every document, written out."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_tokenise(tokenizer_path), _SCHEMA)
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        return written(rows, "tokens")


def pack(docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH) -> DataFrame:
    """The pieces of all documents, each with its sequence and offset."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    rows = tokenised(docs, tokenizer_path)
    n_tokens = rows.agg(F.coalesce(F.sum("doc_tokens"), F.lit(0))).first()[0]
    along = by_ranges(rows, n_tokens, RANGE_TOKENS, "hilbert", "salt").sortWithinPartitions("hilbert", "salt", "doc_id", "doc_tokens")
    return along.select("doc_id", "ids").mapInArrow(_pack(length, id_type(tokenizer_path)), _PIECES)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    """Per piece: document, place in it, checksum, sequence and offset."""
    return pack(table(spark, sf_dir, "documents"))
