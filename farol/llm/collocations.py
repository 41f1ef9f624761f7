"""Phrase collocations by the stripes pattern (operator 12).

A stripe belongs to a prefix and counts the words that follow it. The empty
prefix counts all words; the stripe of two words counts what follows them in
their piece, its end included, so that its total is their own count, its
entries are their extensions and its largest entry tells whether a longer
phrase takes over.

A task counts a block of text at a time and sends its stripes packed: one row
per block, language and bucket of prefixes. A bucket's stripes are merged
elementwise in one task; the number of buckets follows from the size of the
corpus. A stripe that is long in a block is cut by its next words over many
buckets, and its first bucket is told so: what belongs to cut stripes is put
together again by a sum over all their parts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from farol.llm.common import staged
from farol.llm.shingles import mix
from farol.operators.joins import HOT_SHARE, lookup_join, salted_left_join

LEAST = 10               # occurrences of a candidate
COVER = 50               # per cent of its occurrences that a longer candidate must have to replace it
TOP = 2000               # phrases reported per language
BLOCK = 1 << 23          # bytes of text counted at a time
BUCKET = 1 << 23         # bytes of text whose stripes share a bucket, on average
LONG = 64                # entries beyond which a block's stripe is cut
PARTS = 1024             # buckets the entries of a cut stripe are dealt to, at most
HELD = 4_000_000         # entries of a bucket that are merged before more are taken in
WIDE = 1 << 20           # words of a block whose threes still make one number of 63 bits
PIECES = 64              # pieces of the phrases that share a frequent word
SALTS = 256              # parts of a language that are ranked before the whole
_WHOLE, _PART, _WORDS = 0, 1, 2
# What separates words, and what ends a piece.
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[[10, 11, 12, 13, *b".,;:!?"]] = 2
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ENDS = re.compile(rb"[.,;:!?\n-\r]")
_STRIPES = pa.schema([("prefix", pa.string()), ("next", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))])

Stripes = tuple[pa.Array, np.ndarray, pa.Array, np.ndarray]  # prefixes, entries of each, next words, counts


def _hashes(words: pa.Array) -> np.ndarray:
    """Numbers that only deal words out to buckets."""
    return mix(np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), np.uint64, len(words)))


def _words(raw: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of each word, the words by code, whether a piece ends after each word)."""
    data = np.frombuffer(raw.translate(_LOWER), np.uint8)
    kind = _KIND[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind == 0
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edge[::2], edge[1::2]
    ends = np.zeros(len(data) + 1, np.int32)
    np.cumsum(kind == 2, out=ends[1:])
    closed = np.ones(len(start), bool)
    closed[:-1] = ends[start[1:]] > ends[stop[:-1]]
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(stop - start, out=offsets[1:])
    coded = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[inside[1:-1]])).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, closed


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


@cache
def _zip() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=1)


@cache
def _unzip() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def _packed(prefixes: pa.Array, sizes: np.ndarray, following: pa.Array, n: np.ndarray) -> bytes:
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    columns = [prefixes, pa.ListArray.from_arrays(ends, following), pa.ListArray.from_arrays(ends, pa.array(n, pa.int64()))]
    body = pa.RecordBatch.from_arrays(columns, schema=_STRIPES).serialize().to_pybytes()
    return _zip().compress(body)


def _unpacked(body: bytes) -> Stripes:
    batch = pa.ipc.read_record_batch(pa.py_buffer(_unzip().decompress(body)), _STRIPES)
    sizes = batch.column("next").value_lengths().to_numpy().astype(np.int64)
    return batch.column("prefix"), sizes, batch.column("next").flatten(), batch.column("n").flatten().to_numpy()


def _dealt(bucket: np.ndarray, prefixes: pa.Array, sizes: np.ndarray, following: pa.Array, n: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed stripes) of stripes with a bucket each."""
    order = np.argsort(bucket, kind="stable")
    starts = np.concatenate([[0], np.cumsum(sizes)])
    first, size = starts[order], sizes[order]
    moved = np.concatenate([[0], np.cumsum(size)])
    entries = np.repeat(first - moved[:-1], size) + np.arange(moved[-1])
    prefixes, following, n = prefixes.take(pa.array(order)), following.take(pa.array(entries)), n[entries]
    there = bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], there[1:] != there[:-1]])) if len(there) else []
    for a, b in zip(cuts, np.append(cuts[1:], len(there)), strict=True):
        x, y = moved[a], moved[b]
        yield int(there[a]), _packed(prefixes[a:b], size[a:b], following[x:y], n[x:y])


def block_stripes(raw: bytes, lang: str, buckets: int) -> Iterator[tuple[int, str, int, bytes]]:
    """(bucket, language, kind, packed stripes) of a block of one language, texts parted by line ends."""
    code, words, closed = _words(raw)
    if not len(code):
        return
    salt = np.uint64(zlib.crc32(lang.encode()))
    hashes, buckets = _hashes(words), np.uint64(buckets)
    seen = np.bincount(code, minlength=len(words))
    own = (mix(hashes + salt) % buckets).astype(np.int64)
    order = np.argsort(own, kind="stable")
    there, cuts = own[order], np.flatnonzero(np.diff(own[order], prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
        part = order[a:b]
        yield int(there[a]), lang, _WORDS, _packed(pa.array([""]), np.array([b - a]), words.take(pa.array(part)), seen[part])

    end = len(words)
    second = np.append(code[1:], end)
    second[closed] = end
    third = np.append(second[1:], end)
    at = second < end
    pairs = code[at] * end + second[at]
    if end < WIDE:
        keys, n = _counted(pairs * (end + 1) + third[at])
        pair, following = keys // (end + 1), keys % (end + 1)
    else:  # too many words for one number of 63 bits
        known = np.unique(pairs)
        keys, n = _counted(np.searchsorted(known, pairs) * (end + 1) + third[at])
        pair, following = known[keys // (end + 1)], keys % (end + 1)
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    size = np.diff(np.append(first, len(pair)))
    one, two = pair[first] // end, pair[first] % end
    prefixes = pc.binary_join_element_wise(words.take(pa.array(one)), words.take(pa.array(two)), " ")
    after = pa.concat_arrays([words, pa.array([""])]).take(pa.array(following))
    base = mix(mix(hashes[one] + salt) + hashes[two])
    home = (base % buckets).astype(np.int64)
    # Long stripes leave an empty one at home: it says that they were cut.
    long = size > LONG
    stay = np.repeat(~long, size)
    for bucket, body in _dealt(home, prefixes, np.where(long, 0, size), after.filter(pa.array(stay)), n[stay]):
        yield bucket, lang, _WHOLE, body
    if long.any():
        go = np.repeat(long, size)
        stripe = np.repeat(np.arange(len(size)), size)[go]
        segment = np.append(hashes, np.uint64(0))[following[go]] % np.uint64(PARTS)
        place = (mix(base[stripe] + segment + np.uint64(1)) % buckets).astype(np.int64)
        order = np.lexsort((stripe, place))
        place, stripe = place[order], stripe[order]
        new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (stripe[1:] != stripe[:-1])]))
        sizes = np.diff(np.append(new, len(place)))
        entries = np.flatnonzero(go)[order]
        for bucket, body in _dealt(place[new], prefixes.take(pa.array(stripe[new])), sizes, after.take(pa.array(entries)), n[entries]):
            yield bucket, lang, _PART, body


def _slices(text: str) -> Iterator[bytes]:
    """A text in slices of about a block, cut where a piece ends."""
    raw, at = text.encode(), 0
    while len(raw) - at > BLOCK and (cut := _ENDS.search(raw, at + BLOCK)):
        yield raw[at : cut.end()]
        at = cut.end()
    yield raw[at:]


def _count(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            rows = block_stripes(b"\n".join(parts), lang, buckets)
            while some := [r for _, r in zip(range(64), rows)]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*some), (pa.int64(), pa.string(), pa.int32(), pa.binary()))],
                    names=["bucket", "lang", "kind", "body"])

    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            for part in _slices(text.as_py()):
                held.setdefault(lang.as_py(), []).append(part)
                size += len(part) + 1
                if size >= BLOCK:
                    yield from flush()
                    held, size = {}, 0
    yield from flush()


def merged(parts: list[Stripes]) -> Stripes:
    """The elementwise sum of stripes; an empty one, told apart from the others, comes first of its prefix."""
    prefixes = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
    following = pa.concat_arrays([p[2] for p in parts]).dictionary_encode()
    sizes, n = np.concatenate([p[1] for p in parts]), np.concatenate([p[3] for p in parts])
    owner = prefixes.indices.to_numpy().astype(np.int64)
    key = np.repeat(owner, sizes) << 32 | following.indices.to_numpy()
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    n = np.add.reduceat(n, first) if len(first) else n
    key = key[first]
    names = np.flatnonzero(np.diff(key >> 32, prepend=-1))
    size = np.diff(np.append(names, len(key)))
    cut = np.unique(owner[sizes == 0])
    held = np.concatenate([cut, key[names] >> 32])
    # Empty stripes have no entries, so they may stand before all others.
    return (prefixes.dictionary.take(pa.array(held)), np.concatenate([np.zeros(len(cut), np.int64), size]),
            following.dictionary.take(pa.array(key & 0xFFFFFFFF)), n)


RESULT = "kind string, lang string, prefix string, word string, n long, total long"


def _results(lang: str, kind: int, stripes: Stripes, least: int) -> pa.RecordBatch:
    """Rows of merged stripes; only what reaches ``least`` leaves a stripe that was cut nowhere."""
    prefixes, sizes, following, n = stripes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    total = np.bincount(owner, n, len(sizes)).astype(np.int64) if len(sizes) else np.empty(0, np.int64)
    if kind == _WORDS:
        keep = n >= least
        table = {"kind": ["word"] * int(keep.sum()) + ["all"], "prefix": None,
                 "word": pa.concat_arrays([following.filter(pa.array(keep)), pa.array([None], pa.string())]),
                 "n": np.append(n[keep], n.sum()), "total": None}
    else:
        told = pc.index_in(prefixes, prefixes.slice(0, int((sizes == 0).sum()))).is_valid().to_numpy(zero_copy_only=False)
        cut = told if kind == _WHOLE else np.ones(len(sizes), bool)
        loose = cut[owner]
        is_end = pc.equal(following, "").to_numpy(zero_copy_only=False)
        best = np.zeros(len(sizes), np.int64)
        enough = ~is_end & (n >= least)
        np.maximum.at(best, owner[enough], n[enough])
        phrase = np.flatnonzero(~cut & (total >= least))
        longer = np.flatnonzero(~loose & enough)
        parts = np.flatnonzero(loose)
        table = {
            "kind": ["pair"] * len(phrase) + ["longer"] * len(longer) + ["part"] * len(parts),
            "prefix": prefixes.take(pa.array(np.concatenate([phrase, owner[longer], owner[parts]]))),
            "word": pa.concat_arrays([pa.nulls(len(phrase), pa.string()), following.take(pa.array(np.concatenate([longer, parts])))]),
            "n": np.concatenate([total[phrase], n[longer], n[parts]]),
            # Of a pair its largest extension that is a candidate, of an extension the count of its prefix.
            "total": np.concatenate([best[phrase], total[owner[longer]], np.zeros(len(parts), np.int64)])}
    rows = len(table["kind"])
    fields = [("kind", pa.string()), ("lang", pa.string()), ("prefix", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("total", pa.int64())]
    table["lang"] = [lang] * rows
    return pa.RecordBatch.from_arrays(
        [pa.nulls(rows, t) if table[c] is None else table[c] if isinstance(table[c], pa.Array) else pa.array(table[c], t) for c, t in fields],
        names=[c for c, _ in fields])


def _merge(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by bucket, language and kind; one such group is held, merged whenever it grows large."""
    now, parts, size = None, [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            group = tuple(batch.column(c)[i].as_py() for c in ("bucket", "lang", "kind"))
            if group != now:
                if parts:
                    yield _results(now[1], now[2], merged(parts), least)
                now, parts, size = group, [], 0
            parts.append(_unpacked(batch.column("body")[i].as_py()))
            size += len(parts[-1][3]) + len(parts[-1][1])
            if size > HELD:
                parts = [merged(parts)]
                size = min(len(parts[0][3]), HELD // 2)
    if parts:
        yield _results(now[1], now[2], merged(parts), least)


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Rows told apart by ``kind``.

    ``all``: n words of a language; ``word``: n occurrences of a word;
    ``pair``: n occurrences of the two words ``prefix`` and, as ``total``, of
    its most frequent extension that reaches ``least``; ``longer``: n occurrences of ``prefix`` and
    ``word``, ``prefix`` itself occurring ``total`` times. All but ``all``
    reach ``least``.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    buckets = 1 + size // BUCKET
    rows = staged(
        texts.where(F.length("text") > 0).mapInArrow(lambda b: _count(buckets, b), "bucket long, lang string, kind int, body binary")
        .repartition("bucket").sortWithinPartitions("bucket", "lang", "kind")
        .mapInArrow(lambda b: _merge(least, b), RESULT), "stripes")
    loose = staged(rows.where("kind = 'part'").groupBy("lang", "prefix", "word").agg(F.sum("n").alias("n")), "cut_stripes")
    inside = F.col("word") != ""
    pairs = loose.groupBy("lang", "prefix").agg(
        F.sum("n").alias("n"), F.coalesce(F.max(F.when(inside & (F.col("n") >= least), F.col("n"))), F.lit(0)).alias("total")).where(F.col("n") >= least)
    longer = loose.where(inside & (F.col("n") >= least)).join(pairs.select("lang", "prefix", F.col("n").alias("total")), ["lang", "prefix"])
    return (
        rows.where("kind in ('word', 'pair', 'longer')")
        .unionByName(rows.where("kind = 'all'").groupBy("kind", "lang").agg(F.sum("n").alias("n")), allowMissingColumns=True)
        .unionByName(pairs.withColumn("kind", F.lit("pair")), allowMissingColumns=True)
        .unionByName(longer.withColumn("kind", F.lit("longer")).select(rows.columns))
    )


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), in numbers of 38 digits."""
    a, left, right = (c.cast("decimal(16,0)") for c in (a, left, right))
    million = F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", a * a * million, left * right)


def _found(facts: DataFrame, counts: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Counts joined to phrases by word or pair; frequent ones, which many phrases hold, are cut into pieces."""
    return salted_left_join(facts, counts, ["lang", key], hot.withColumnRenamed("name", key), ["phrase"])


def candidates(counts: DataFrame, cover: int = COVER) -> DataFrame:
    """lang, phrase, a, l, r, score of each phrase that no longer one covers."""
    words = counts.where("kind = 'word'").select("lang", "word", F.col("n").alias("f"))
    pairs = counts.where("kind = 'pair'").select("lang", F.col("prefix").alias("pair"), "n", "total")
    second = F.split_part("prefix", F.lit(" "), F.lit(2))
    longer = counts.where("kind = 'longer'").select(
        "lang", F.concat_ws(" ", "prefix", "word").alias("phrase"), F.split_part("prefix", F.lit(" "), F.lit(1)).alias("first"),
        F.col("word").alias("last"), F.concat_ws(" ", second, F.col("word")).alias("pair"), F.col("n").alias("a"), F.col("total").alias("l2"))
    total = counts.where("kind = 'all'").agg(F.sum("n")).first()[0] or 0
    # At most 1 / HOT_SHARE words and as many pairs, whatever the corpus.
    frequent = counts.where(F.col("kind").isin("word", "pair") & (F.col("n") > HOT_SHARE * total)).select(
        "kind", "lang", F.coalesce("word", "prefix").alias("name"), F.lit(PIECES).cast("bigint").alias("_pieces"))
    hot_words, hot_pairs = (frequent.where(F.col("kind") == k).drop("kind") for k in ("word", "pair"))
    longer = _found(longer, pairs.select("lang", "pair", F.col("n").alias("r1")), "pair", hot_pairs)
    before = longer.groupBy("lang", "pair").agg(F.max("a").alias("before"))
    two = (
        pairs.join(before, ["lang", "pair"], "left")
        .where(100 * F.greatest("total", F.coalesce("before", F.lit(0))) < cover * F.col("n"))
        .select("lang", F.col("pair").alias("phrase"), F.split_part("pair", F.lit(" "), F.lit(1)).alias("first"),
                F.split_part("pair", F.lit(" "), F.lit(2)).alias("last"), F.col("n").alias("a"),
                F.lit(None).cast("long").alias("l2"), F.lit(None).cast("long").alias("r1"))
    )
    both = staged(two.unionByName(longer.drop("pair")), "phrases")
    both = _found(both, words.select("lang", F.col("word").alias("first"), F.col("f").alias("l1")), "first", hot_words)
    both = _found(both, words.select("lang", F.col("word").alias("last"), F.col("f").alias("r2")), "last", hot_words)
    a, l1, l2, r1, r2 = (F.col(c) for c in ("a", "l1", "l2", "r1", "r2"))
    one = _score(a, l1, F.coalesce(r1, r2))
    other = _score(a, l2, r2)
    late = l2.isNotNull() & (other < one)
    return both.select(
        "lang", "phrase", "a", F.when(late, l2).otherwise(l1).alias("l"), F.when(late, r2).otherwise(F.coalesce(r1, r2)).alias("r"),
        F.when(late, other).otherwise(one).alias("score"))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, cover: int = COVER) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    NULL texts are empty and a NULL language is ``und``; doc_id is not looked
    at, so rows that repeat one or have none count like any other. Equal
    scores are ordered by count and then phrase. Other columns are ignored; an
    empty table gives no rows.
    """
    counts = staged(phrase_counts(docs, least), "phrase_counts")
    found = candidates(counts, cover)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    # A language is ranked in parts first, so no task meets more than a bounded number of its phrases in the end.
    first = found.withColumn("rank", F.row_number().over(W.Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(W.Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.where("kind = 'all'").select("lang", "n")
    return lookup_join(ranked, totals, totals.count(), ["lang"], ["phrase"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
