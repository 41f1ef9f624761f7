"""Byte-level BPE by a sentencepiece model made from the ranks (operator 11).

Every vocabulary entry becomes a piece: its bytes shown one character each,
scored by its negative rank, in a BPE model whose normalisation is the
identity. Sentencepiece then merges the adjacent pair with the highest score,
the leftmost of equal ones, which is the pair of the lowest rank. Texts are cut
into pre-tokens by the pattern, and each pre-token is encoded by itself, so no
merge crosses a border. Decoding maps ids to pieces and pieces back to bytes.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol.llm.common import by_bytes

LONG_TEXT = 1 << 22     # characters from which the pre-tokens of a text are met in runs instead of as one list
RUN = 1 << 18           # pre-tokens of such a run
KEPT = 1 << 26          # characters of pre-tokens, and ENTRY for each, whose ids a worker keeps; beyond it they are made again
ENTRY = 100             # bytes of an entry beside its characters (some 600,000 common pre-tokens are kept)
# Fixed value: byte-level models show printable Latin-1 as itself and the other bytes, in order, from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_HIDDEN = [b for b in range(256) if b not in _PRINTED]
SHOWN = [chr(b) if b in _PRINTED else chr(0x100 + _HIDDEN.index(b)) for b in range(256)]
_BYTE_OF = {c: b for b, c in enumerate(SHOWN)}
# Field numbers and kinds of the sentencepiece model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _BPE = 1, 2, 2


def shown(raw: bytes) -> str:
    """One character per byte."""
    return raw.decode("latin-1").translate(dict(enumerate(SHOWN)))


def hidden(piece: str) -> bytes:
    return bytes(_BYTE_OF[c] for c in piece)


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary entries in order of their ranks, from lines of base64 text and rank."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in f if line.strip())}
    tokens = [ranks.get(i) for i in range(len(ranks))]
    if None in tokens or {bytes([b]) for b in range(256)} - set(tokens):
        raise ValueError("ranks must be 0 to n - 1 and hold every single byte")
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value % (1 << 64))


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _piece(text: str, score: float, kind: int) -> bytes:
    return _message(_PIECES, _message(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks; one more piece, after them, stands for what it cannot know."""
    pieces = [_piece(shown(t), -float(rank), _NORMAL) for rank, t in enumerate(tokens)]
    trainer = _number(3, _BPE) + _number(40, len(tokens)) + b"".join(_number(field, -1) for field in (41, 42, 43))  # no begin, end, pad
    identity = _message(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))  # no prefix, blanks as they are
    return b"".join(pieces) + _piece("<unk>", 0.0, _UNKNOWN) + _message(_TRAINER, trainer) + _message(_NORMALIZER, identity)


def unreached(tokens: list[bytes], model: bytes) -> dict[str, int]:
    """Entries that merges alone do not make; as a whole pre-token they are still one id."""
    pieces = [shown(t) for t in tokens]
    coded = _processor(model).encode(pieces)
    return {p: rank for rank, (p, ids) in enumerate(zip(pieces, coded, strict=True)) if ids != [rank]}


def _processor(model: bytes):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=model, num_threads=1)


class ByteBPE:
    def __init__(self, model: bytes, whole: tuple[tuple[str, int], ...], pattern: str):
        self.model, self.whole, self.cut = _processor(model), dict(whole), regex.compile(pattern)
        n = self.model.get_piece_size() - 1
        self.bytes_of = [hidden(p) for p in self.model.id_to_piece(list(range(n)))]
        self.known: dict[str, bytes] = {}
        self.kept = 0

    def _learn(self, runs: list[list[str]]) -> None:
        new = list(set(chain.from_iterable(runs)).difference(self.known))
        if self.kept > KEPT:
            self.known, self.kept, new = {}, 0, list(set(chain.from_iterable(runs)))
        pieces = [shown(t.encode()) for t in new]
        for token, piece, ids in zip(new, pieces, self.model.encode(pieces), strict=True):
            self.known[token] = np.array([self.whole[piece]] if piece in self.whole else ids, "<u4").tobytes()
            self.kept += len(token) + ENTRY

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        runs = [self.cut.findall(t) if len(t) < LONG_TEXT else None for t in texts]
        long = {at: b"".join(self._long(t)) for at, t in enumerate(texts) if runs[at] is None}
        self._learn([run for run in runs if run])
        return [long[at] if run is None else b"".join(map(self.known.__getitem__, run)) for at, run in enumerate(runs)]

    def _long(self, text: str) -> Iterator[bytes]:
        found = (m.group() for m in self.cut.finditer(text))
        while run := list(islice(found, RUN)):
            self._learn([run])
            yield b"".join(map(self.known.__getitem__, run))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def coder(model: bytes, whole: tuple[tuple[str, int], ...], pattern: str) -> ByteBPE:
    return ByteBPE(model, whole, pattern)


class Vocabulary:
    """A rank file as a model of its own, sent to the workers as it is: its size does not depend on the corpus."""

    def __init__(self, path: str, pattern: str = PATTERN):
        tokens = read_ranks(path)
        model = serialise(tokens)
        self.spec = (model, tuple(unreached(tokens, model).items()), pattern)

    def encode(self, docs: DataFrame) -> DataFrame:
        """doc_id and ids (little-endian unsigned 32-bit integers) of each row of ``docs``.

        NULL and empty texts have no ids; NULL and repeated doc_ids keep their
        rows; special strings are ordinary text; other columns are ignored. An
        empty table gives no rows.
        """
        spec = docs.sparkSession.sparkContext.broadcast(self.spec)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bpe = coder(*spec.value)
            for batch in batches:
                doc = batch.column("doc_id")
                for first, texts in by_bytes(batch.column("text").to_pylist()):
                    ids = pa.array(bpe.encode(texts), pa.binary())
                    yield pa.RecordBatch.from_arrays([doc.slice(first, len(texts)), ids], names=["doc_id", "ids"])

        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary")

    def decode(self, encoded: DataFrame) -> DataFrame:
        """doc_id, ids and the bytes they stand for; NULL ids stand for none."""
        spec = encoded.sparkSession.sparkContext.broadcast(self.spec)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bpe = coder(*spec.value)
            for batch in batches:
                ids = batch.column("ids")
                for at in range(0, batch.num_rows, 64):
                    part = batch.slice(at, 64)
                    raw = pa.array([bpe.decode(i or b"") for i in ids.slice(at, 64).to_pylist()], pa.binary())
                    yield pa.RecordBatch.from_arrays([*part.columns, raw], names=["doc_id", "ids", "decoded"])

        return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """Number of ids and SHA-256 of the ids and of the decoded bytes, one row per row."""
    return decoded.select(
        "doc_id", (F.coalesce(F.octet_length("ids"), F.lit(0)) / 4).cast("long").alias("n_tokens"),
        F.sha2(F.coalesce("ids", F.lit(b"")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
