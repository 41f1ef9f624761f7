"""Token ids of a corpus in wavelet-matrix shards (operator 9).

Documents are range-partitioned by id. Each task encodes its documents and
cuts them into shards of bounded size; a shard is one record of the written
table: a wavelet matrix over its ids plus the documents' borders. All reading
goes through the matrix: access by position, counting and occurrence lookup by
rank and select, and whole runs by undoing its levels.
"""

from __future__ import annotations

import codecs
import json
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress, count, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from farol.llm.common import BATCH_BYTES, by_bytes
from farol.session import new_path

END_ID = 2               # closes every document
SHARD_IDS = 1 << 19      # ids after which a shard is closed
SAMPLE = 512             # bits between two rank samples
MAX_PIECES = 1_000_000   # encoded pieces a worker keeps (some 200 MB); beyond it they are dropped and made again
_HEAD = struct.Struct("<4sBQ")
_MAGIC = b"WVM1"

# Characters whose class every Unicode version agrees on: letters, digits, spaces, and signs that are none of these.
_LETTERS, _DIGITS, _SPACES, _SIGNS = "A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ԧ", "0-9", r" \t\n\r", r"!-/:-@\[-`{-~¡«¿»–—‘’“”…"
_KNOWN = re.compile(f"[{_LETTERS}{_DIGITS}{_SPACES}{_SIGNS}]*")
# Fixed value: the byte-level pre-tokenizer's pattern, over these characters.
_PIECE = re.compile(rf" ?[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[{_DIGITS}]+| ?[{_SIGNS}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+")
# Fixed value: byte-level models show printable Latin-1 as itself and the other bytes, in order, from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(256) if b not in _PRINTED]
_SHOWN = "".join(chr(b if b in _PRINTED else 0x100 + _OTHERS.index(b)) for b in range(256))


class WaveletMatrix:
    """Bit planes from the highest bit down; after each plane ids with a 0 there stand before those with a 1."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        depth = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        planes, zeros, ranks, now = [], [], [], ids.astype(np.uint16 if depth <= 16 else np.uint32)
        for level in range(depth - 1, -1, -1):
            bits = (now >> level & 1).astype(bool)
            plane = np.packbits(bits, bitorder="little")
            low = now.take(np.flatnonzero(~bits))  # positions first: a mask alone mispredicts every other bit
            planes.append(plane)
            zeros.append(len(low))
            ranks.append(cls._samples(plane))
            now = np.concatenate([low, now.take(np.flatnonzero(bits))])
        return cls(len(ids), planes, zeros, ranks)

    @staticmethod
    def _samples(plane: np.ndarray) -> np.ndarray:
        ones = np.bitwise_count(np.pad(plane, (0, -len(plane) % (SAMPLE // 8)))).reshape(-1, SAMPLE // 8).sum(1, dtype=np.uint32)
        return np.concatenate([[0], np.cumsum(ones)]).astype("<u4")

    def to_bytes(self) -> bytes:
        parts = [_HEAD.pack(_MAGIC, len(self.planes), self.n)]
        for plane, zero, rank in zip(self.planes, self.zeros, self.ranks, strict=True):
            parts += [struct.pack("<Q", zero), plane.tobytes(), rank.tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        magic, depth, n = _HEAD.unpack_from(raw)
        if magic != _MAGIC:
            raise ValueError("not a shard")
        at, planes, zeros, ranks = _HEAD.size, [], [], []
        size = -(-n // 8)
        samples = -(-size // (SAMPLE // 8)) + 1
        for _ in range(depth):
            zeros.append(struct.unpack_from("<Q", raw, at)[0])
            planes.append(np.frombuffer(raw, np.uint8, size, at + 8))
            ranks.append(np.frombuffer(raw, "<u4", samples, at + 8 + size))
            at += 8 + size + 4 * samples
        return cls(n, planes, zeros, ranks)

    def _rank1(self, level: int, at: int) -> int:
        """Ones before position ``at`` of a plane."""
        block = at // SAMPLE
        plane, first = self.planes[level], block * (SAMPLE // 8)
        ones = int(self.ranks[level][block]) + int(np.bitwise_count(plane[first : at // 8]).sum())
        return ones + (int(plane[at // 8]) & ((1 << at % 8) - 1)).bit_count() if at % 8 else ones

    def access(self, at: int) -> int:
        value = 0
        for level, plane in enumerate(self.planes):
            bit = plane[at // 8] >> (at % 8) & 1
            ones = self._rank1(level, at)
            value, at = value << 1 | int(bit), self.zeros[level] + ones if bit else at - ones
        return value

    def _range(self, value: int, start: int, stop: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` in [start, stop) stand below the last plane."""
        depth = len(self.planes)
        if value >> depth:
            return 0, 0
        for level in range(depth):
            a, b = self._rank1(level, start), self._rank1(level, stop)
            if value >> (depth - 1 - level) & 1:
                start, stop = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def count(self, value: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of an id in a range of positions."""
        a, b = self._range(value, start, self.n if stop is None else stop)
        return b - a

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit of a plane."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._rank1(level, mid + 1)
            if (ones if bit else mid + 1 - ones) <= k:
                low = mid + 1
            else:
                high = mid
        return low

    def find(self, value: int, k: int = 0) -> int | None:
        """Position of the k-th (from 0) occurrence of an id."""
        a, b = self._range(value, 0, self.n)
        if k >= b - a:
            return None
        at, depth = a + k, len(self.planes)
        for level in range(depth - 1, -1, -1):
            bit = value >> (depth - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at

    def ids(self) -> np.ndarray:
        """All ids in order: levels are undone from the last to the first."""
        depth = len(self.planes)
        now = np.zeros(self.n, np.uint16 if depth <= 16 else np.uint32)
        for level in range(depth - 1, -1, -1):
            bits = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            before = np.empty_like(now)
            zero, bit = self.zeros[level], depth - 1 - level
            before[np.flatnonzero(~bits)] = now[:zero]
            before[np.flatnonzero(bits)] = now[zero:] | now.dtype.type(1 << bit)
            now = before
        return now.astype(np.uint32)


class PieceEncoder:
    """The library's encoding, kept per piece.

    A text of known characters is cut by the pattern of the byte-level
    pre-tokenizer, and each new piece goes to the library's model once. Other
    texts are cut before each space that a non-space follows, where the
    pre-tokenizer never joins; what holds other characters or an added token
    there goes through the whole library. The ids of the pieces, in order, are
    the ids of the text. Those of piece k are ``flat[starts[k] : starts[k + 1]]``.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        said = json.loads(spec)
        self.added = [t["content"] for t in said.get("added_tokens") or []]
        cut = said.get("pre_tokenizer") or {}
        plain = not said.get("normalizer") and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut["add_prefix_space"]
        self.known_text = _KNOWN.fullmatch if plain else lambda text: None
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = defaultdict(count().__next__)
        self.starts, self.flat = np.zeros(1, np.int64), np.empty(0, "<u4")

    @staticmethod
    def units(text: str) -> list[str]:
        parts = text.split(" ")
        out = [parts[0]]
        for part in parts[1:]:
            if part and not part[0].isspace():
                out.append(" " + part)
            else:
                out[-1] += " " + part
        return out

    def _is_plain(self, text: str) -> bool:
        return bool(self.known_text(text)) and not any(t in text for t in self.added)

    def pieces(self, text: str) -> list[str]:
        if self._is_plain(text):
            return _PIECE.findall(text)
        return list(chain.from_iterable(_PIECE.findall(u) if self._is_plain(u) else [u] for u in self.units(text)))

    def _learn(self, unseen: list[str]) -> None:
        plain = [self._is_plain(p) for p in unseen]
        # Pieces of known characters hold no NUL.
        raw = "\0".join(compress(unseen, plain)).encode()
        shown = iter(codecs.charmap_decode(raw, "strict", _SHOWN)[0].split(_SHOWN[0]))
        others = [p for p, known in zip(unseen, plain, strict=True) if not known]
        whole = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False))
        tokenize = self.model.tokenize
        coded = [[t.id for t in tokenize(next(shown))] if known else next(whole).ids for known in plain]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(coded), "<u4", int(sizes.sum()))])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [self.pieces(t) for t in texts]
        if len(self.numbers) >= MAX_PIECES:
            self._forget()
        met, total = len(self.numbers), sum(map(len, split))
        number = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), np.int64, total)
        self._learn(list(islice(self.numbers, met, None)))
        first = self.starts[number]
        size = self.starts[number + 1] - first
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(first - ends[:-1], size) + np.arange(ends[-1])]
        stops = ends[np.cumsum([0, *map(len, split)])].tolist()
        return [ids[a:b].tobytes() for a, b in pairwise(stops)]


@lru_cache(maxsize=2)
def encoder(spec: str) -> PieceEncoder:
    return PieceEncoder(spec)


SHARD = "part int, seq int, n_ids long, doc_ids array<long>, starts array<long>, body binary"


def _shard(part: int, seq: int, docs: list[tuple[int | None, bytes]]) -> dict:
    sizes = [len(raw) // 4 for _, raw in docs]
    ids = np.frombuffer(b"".join(raw for _, raw in docs), "<u4")
    return {"part": part, "seq": seq, "n_ids": len(ids), "doc_ids": [d for d, _ in docs],
            "starts": np.cumsum([0, *sizes])[:-1].tolist(), "body": WaveletMatrix.build(ids).to_bytes()}


def _write(spec: str, end: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    coder, part, seq = encoder(spec), TaskContext.get().partitionId(), 0
    close = np.array([end], "<u4").tobytes()
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("starts", pa.list_(pa.int64())), ("body", pa.binary())])
    held, size = [], 0
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for first, texts in by_bytes(batch.column("text").to_pylist(), BATCH_BYTES):
            for doc, raw in zip(ids[first : first + len(texts)], coder.encode(texts), strict=True):
                held.append((doc, raw + close))
                size += len(raw) // 4 + 1
                if size >= SHARD_IDS:
                    yield pa.RecordBatch.from_pylist([_shard(part, seq, held)], schema)
                    held, size, seq = [], 0, seq + 1
    if held:
        yield pa.RecordBatch.from_pylist([_shard(part, seq, held)], schema)


def write_ids(docs: DataFrame, tokenizer: str, path: str, end: int = END_ID) -> None:
    """Write the ids of all documents to ``path``, in ascending id order over (part, seq).

    Parts are ranges of ids, so part numbers ascend with them; rows that
    repeat an id are ordered by text. NULL ids come first, NULL text is empty.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file, whatever the corpus
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(lambda batches: _write(spec.value, end, batches), SHARD)
        .write.mode("overwrite").option("compression", "zstd").parquet(path)
    )


def shard_starts(shards: DataFrame) -> DataFrame:
    """Ids before each shard: totals per part first, so one window sees only a row per part."""
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = parts.withColumn("before", F.coalesce(
        F.sum("part_ids").over(W.Window.orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.coalesce(F.sum("n_ids").over(
        W.Window.partitionBy("part").orderBy("seq").rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0))
    return shards.select("part", "seq", inside.alias("inside")).join(before, "part").select(
        "part", "seq", (F.col("before") + F.col("inside")).cast("long").alias("shard_start"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            docs, starts = (batch.column(c)[row].as_py() for c in ("doc_ids", "starts"))
            ids = WaveletMatrix.from_bytes(batch.column("body")[row].as_py()).ids().astype("<u4")
            stops = [*starts[1:], len(ids)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(docs, pa.int64()),
                "part": pa.array([batch.column("part")[row].as_py()] * len(docs), pa.int32()),
                "seq": pa.array([batch.column("seq")[row].as_py()] * len(docs), pa.int32()),
                "at": pa.array(starts, pa.int64()),
                "n_tokens": pa.array([b - a for a, b in zip(starts, stops, strict=True)], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, stops, strict=True)], pa.int64()),
            })


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: its first position in the corpus, its number of ids and their crc32."""
    schema = T._parse_datatype_string(SHARD)
    shards = spark.read.schema(schema).parquet(path)
    rows = shards.mapInArrow(_digest, "doc_id long, part int, seq int, at long, n_tokens long, ids_crc32 long")
    return rows.join(shard_starts(shards), ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def encode_corpus(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write the corpus and read it back; one row per row of ``docs``, none for an empty table."""
    path = path or new_path(docs.sparkSession, "ids")
    write_ids(docs, tokenizer, path)
    return read_digests(docs.sparkSession, path)
