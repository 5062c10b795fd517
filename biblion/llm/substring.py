"""Substring dedup: Rabin-Karp hashes of every window of tokens, counted in Spark.

Documents are dealt into blocks of neighbouring ids and of about
``BLOCK_BYTES``.  A block rolls two 64-bit polynomial hashes over every window
of ``length`` words of every whole text.  It sends its distinct hashes, packed
and sorted, to the bucket that the second hash names, with 32 further bits of
that hash: windows are told apart by 96 + log2(buckets) bits at every step, 105
at least.  A bucket counts the blocks of each hash.  Since blocks are in order
of ids, the smallest id that holds a window lies in its first block, so every
later block gets the hash back, and within its first block a window is compared
by id directly.  Blocks then mark each occurrence and merge the marked windows
into maximal intervals of words.

A passage that a third of all documents share is one hash a block, however
often it stands there: no bucket receives more than one entry of a window from
a block.  Blocks hold a bounded number of bytes (long texts weigh more when the
borders are drawn; a text longer than a block is a block of its own), buckets a
bounded number of hashes, and both are dealt over partitions that grow with the
input.  A block sends a row to each of its buckets, at most one for each of its
windows, so rows grow no faster than the windows.  The driver and the tasks hold
one id for each block, a millionth of the input.  Texts are shuffled once
(compressed) and used twice.

Defined cases: null and empty texts have no words; documents of fewer words
than a window are left alone; windows of rows with equal ids do not remove one
another (the tie goes to neither); rows without an id keep all words and remove
none; repeated rows are answered each; very long texts are taken whole; an
empty table gives an empty table; other columns, whatever their names, play no
part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblion.llm.base import bounded, slices
from biblion.llm.hashing import OTHER_BASE, WORD_BASE, hashed_words, mixed, rolled, words_of

LENGTH = 50
#: Bytes of text that a block holds on average.
BLOCK_BYTES = 8_000_000
#: Blocks at least: they and their buckets part the work of small tables, too.
BLOCKS = 16
#: Buckets for each block; more blocks, more buckets.
SPREAD = 4
#: Partitions at most; beyond that a task takes several blocks or buckets, one after another.
PARTITIONS = 50_000
#: Ids among which the borders of a block are drawn; a text counts once for each such part of a block.
DRAWN = 32


def windows(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each window of ``length`` words of a text."""
    word, starts, _ = hashed_words(raw)
    n = len(starts) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at = np.arange(n)
    return mixed(rolled(word, WORD_BASE, at, at + length)), mixed(rolled(mixed(word + np.uint64(1)), OTHER_BASE, at, at + length))


def removed(marked: np.ndarray, n_words: int, length: int) -> np.ndarray:
    """True for each word that a marked window covers: the union of the intervals."""
    change = np.zeros(n_words + 1, np.int64)
    change[: len(marked)] += marked
    change[length : length + len(marked)] -= marked
    return np.cumsum(change)[:n_words] > 0


def _borders(docs: DataFrame, key: str, text: str) -> tuple[list[int], int]:
    """Ids that part the blocks (a few per block on the driver), and the number of blocks."""
    bytes_ = F.coalesce(F.octet_length(text), F.lit(0))
    size = docs.agg(F.sum(bytes_).alias("b"), F.count(key).alias("n")).first()
    blocks = max(BLOCKS, math.ceil((size.b or 0) / BLOCK_BYTES))
    if not size.n:
        return [], 1
    # an id counts for its bytes: the fraction of a unit is rounded by chance, fixed by the id
    unit = max(1, (size.b or 0) // (DRAWN * blocks))
    chance = F.pmod(F.xxhash64(key, bytes_), F.lit(1 << 30)) / (1 << 30)
    times = F.floor(bytes_ / unit + chance).cast("int")
    weighed = docs.filter(F.col(key).isNotNull() & (times > 0)).select(F.col(key).cast("long").alias("id"), F.explode(F.sequence(F.lit(1), times)))
    found = weighed.agg(F.percentile_approx("id", [i / blocks for i in range(1, blocks)], max(10_000, 4 * blocks))).first()[0]
    return sorted(set(found or [])), blocks


def _dealt(docs: DataFrame, key: str, text: str, borders: list[int], blocks: int) -> DataFrame:
    """block, doc_id, z (the text compressed); rows without an id are spread over blocks of their own."""
    sent = docs.sparkSession.sparkContext.broadcast(np.array(borders, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in (part for whole in batches for part in slices(whole)):
            ids = batch.column(0)
            block = np.searchsorted(sent.value, np.asarray(ids.fill_null(0), np.int64), side="left")
            block = np.where(np.asarray(ids.is_null()), -1 - np.arange(len(ids)) % blocks, block)
            z = [press.compress((t or "").encode("utf-8", "surrogatepass")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), ids, pa.array(z, pa.binary())], names=["block", "doc_id", "z"])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, "block long, doc_id long, z binary")


def _texts(rows: pa.Table) -> Iterator[tuple[int | None, bytes]]:
    open_ = zstandard.ZstdDecompressor()
    for batch in rows.to_batches():
        for i, z in zip(batch.column("doc_id").to_pylist(), batch.column("z"), strict=True):
            yield i, open_.decompress(z.as_py())


def _more(b: np.ndarray, buckets: int) -> np.ndarray:
    """The bits of the second hash that are kept: its upper half, and its bucket."""
    return (b & np.uint64(0xFFFFFFFF00000000)) | (b % np.uint64(buckets))


def _sorted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order by (a, b), and where a new pair begins in it."""
    by = np.argsort(a, kind="stable")
    x, y = a[by], b[by]
    if ((x[1:] == x[:-1]) & (y[1:] != y[:-1])).any():  # equal first hashes of different windows
        by = np.lexsort((b, a))
        x, y = a[by], b[by]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    return by, new


def _parts(*columns: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """Runs of equal ``of``: where they begin, and the bytes of each column's runs."""
    at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, int)
    return at, [[x.tobytes() for x in np.split(c, at[1:])] if len(of) else [] for c in columns]


def _hashed(length: int, buckets: int):
    """Of a block: its distinct window hashes, a row for each bucket."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        block = key[0].as_py()
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.uint64),) * 2]
        if block >= 0:
            for _, raw in _texts(rows.select(["doc_id", "z"])):
                found.append(windows(raw, length))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        del found
        b = _more(b, buckets)
        by, new = _sorted(a, b)
        a, b = a[by[new]], b[by[new]]
        by = np.argsort(b & np.uint64(0xFFFFFFFF), kind="stable")
        a, b = a[by], b[by]
        bucket = (b & np.uint64(0xFFFFFFFF)).astype(np.int64)
        at, (hashes, more) = _parts(a, (b >> np.uint64(32)).astype(np.uint32), of=bucket)
        return pa.table({"bucket": pa.array(bucket[at], pa.int64()), "block": pa.array(np.full(len(at), block), pa.int64()), "hashes": pa.array(hashes, pa.binary()), "more": pa.array(more, pa.binary())})

    return run


def _unpacked(rows: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of rows, their other halves, and ``name`` (block or bucket) of each."""
    a, b, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for batch in rows.to_batches():
        for k, x, y in zip(batch.column(name).to_pylist(), batch.column("hashes"), batch.column("more"), strict=True):
            a.append(np.frombuffer(x.as_py(), np.uint64))
            b.append(np.frombuffer(y.as_py(), np.uint32).astype(np.uint64))
            of.append(np.full(len(a[-1]), k, np.int64))
    return np.concatenate(a), np.concatenate(b), np.concatenate(of)


def _counted(key: tuple, rows: pa.Table) -> pa.Table:
    """Of a bucket: for each block the hashes that an earlier block has too."""
    bucket = key[0].as_py()
    a, b, of = _unpacked(rows.take(pa.compute.sort_indices(rows.column("block"))), "block")
    by, new = _sorted(a, b)  # of equal hashes the first block stays first
    a, b, of = a[by], b[by], of[by]
    first = of[np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))] if len(a) else of
    later = of > first
    a, b, of = a[later], b[later], of[later]
    by = np.argsort(of, kind="stable")
    a, b, of = a[by], b[by], of[by]
    at, (hashes, more) = _parts(a, b.astype(np.uint32), of=of)
    return pa.table({"block": pa.array(of[at], pa.int64()), "bucket": pa.array(np.full(len(at), bucket), pa.int64()), "hashes": pa.array(hashes, pa.binary()), "more": pa.array(more, pa.binary())})


def _member(a: np.ndarray, b: np.ndarray, known_a: np.ndarray, known_b: np.ndarray) -> np.ndarray:
    """Which pairs (a, b) stand among the known ones, which are sorted by ``known_a``."""
    found = np.zeros(len(a), bool)
    at = np.searchsorted(known_a, a)
    left = np.arange(len(a))
    while len(left):  # once, but for equal first hashes of different windows
        left = left[at[left] < len(known_a)]
        left = left[known_a[at[left]] == a[left]]
        hit = known_b[at[left]] == b[left]
        found[left[hit]] = True
        left = left[~hit]
        at[left] += 1
    return found


def _cut(length: int, buckets: int, with_text: bool):
    """Of a block and the hashes it got back: the kept words of each document."""

    def run(key: tuple, rows: pa.Table, back: pa.Table) -> pa.Table:
        block = key[0]
        block = block.as_py() if block is not None else None
        known_a, known_b, bucket = _unpacked(back, "bucket")
        known_b = (known_b << np.uint64(32)) | bucket.astype(np.uint64)
        by = np.argsort(known_a, kind="stable")
        known_a, known_b = known_a[by], known_b[by]
        texts = sorted(_texts(rows.select(["doc_id", "z"])), key=lambda x: (x[0] is None, x[0] or 0))
        ids = np.array([i if i is not None else -1 for i, _ in texts], np.int64)
        none = (np.zeros(0, np.uint64),) * 2
        found = [windows(raw, length) if block is not None and block >= 0 else none for _, raw in texts]
        sizes = [len(x) for x, _ in found]
        a, b = (np.concatenate(x) for x in zip(none, *found, strict=True))
        del found
        b, owner = _more(b, buckets), np.repeat(ids, sizes)
        marked = _member(a, b, known_a, known_b)
        # within the block: the first row of a hash has its smallest id
        by, new = _sorted(a, b)
        o = owner[by]
        smallest = o[np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))] if len(o) else o
        marked[by] |= o > smallest
        out: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "kept_sha256": []}
        if with_text:
            out["text"] = []
        at = 0
        for (i, raw), n in zip(texts, sizes, strict=True):
            starts, ends = words_of(raw)
            gone = removed(marked[at : at + n], len(starts), length)
            at += n
            words = raw.split() if not gone.any() else [raw[s:e] for s, e in zip(starts[~gone].tolist(), ends[~gone].tolist(), strict=True)]
            kept = b" ".join(words)
            out["doc_id"].append(i)
            out["n_words"].append(len(starts))
            out["n_removed"].append(int(gone.sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_text:
                out["text"].append(kept.decode("utf-8", "surrogatepass"))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.table({name: pa.array(x, kind) for (name, x), kind in zip(out.items(), kinds, strict=False)})

    return run


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and the kept text) of each document."""
    bounded(docs.sparkSession)
    docs = docs.select(key, text)
    borders, blocks = _borders(docs, key, text)
    buckets, parts = SPREAD * blocks, min(blocks, PARTITIONS)
    dealt = _dealt(docs, key, text, borders, blocks).repartition(parts, "block")
    hashes = dealt.groupBy("block").applyInArrow(_hashed(length, buckets), "bucket long, block long, hashes binary, more binary")
    back = hashes.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_counted, "block long, bucket long, hashes binary, more binary")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    return dealt.groupBy("block").cogroup(back.repartition(parts, "block").groupBy("block")).applyInArrow(_cut(length, buckets, with_text), schema)
