"""Substring deduplication with Rabin-Karp hashes of token windows.

Every window of `width` words gets a Rabin-Karp hash. A window repeats if its
hash also starts in a document with a smaller doc_id; the words under such
windows are merged into maximal removal intervals and leave the text.

Counting every window in one shuffle would move several times the input, so
the count runs in two steps, neither of which loses a window:

1. Each window holds width - gram + 1 shorter grams; the one with the least
   hash stands for it. Equal windows have equal grams, so a window can repeat
   only if that gram occurs in two documents. Grams are counted with partial
   aggregation, and those in two or more documents go to a bitmap of fixed
   size (a fuller bitmap only sends more windows to step 2).
2. Windows whose gram may repeat are counted by their own hash. A task sends
   only the least doc_id for each hash of a chunk; later documents of the same
   chunk are known to repeat at once. So a very common passage sends a row for
   each chunk, not for each document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import Words, bitmap, chunks, first_of_runs, hits, partitions, prefix, rolling, scratch, spans, text_bytes, _BYTE

#: doc_id of rows without one: they follow all others.
LAST = (1 << 63) - 1
_STEP = 4 << 20


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _anchors(words: Words, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, the index of each window's least gram, and all grams' hashes."""
    n = width - gram + 1
    grams = rolling(prefix(words.hashes), gram)
    if len(words.hashes) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), grams
    at = np.arange(len(words.hashes) - width + 1)
    least = at + sliding_window_view(grams, n).argmin(axis=1)
    inside = at + width <= words.first[words.doc[at] + 1]
    return at[inside], least[inside], grams


def _runs(doc: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows sorted by document and start, merged into maximal intervals."""
    if not len(doc):
        return doc, start, start
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + width)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], start[last] + width


def repeated_spans(documents: DataFrame, width: int = 13, gram: int = 5, bits: int = 26) -> DataFrame:
    """Maximal word intervals [start, end) of each document to be removed.

    Returns row_key (doc_id with a hash of the text, so that repeated ids stay
    apart), doc_id, start and end; intervals of one document may still touch.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, most=_STEP):
                words = Words(part.column(1))
                _, least, hashes = _anchors(words, width, gram)
                least = least[first_of_runs(least)]
                h, d = hashes[least], _ids(part)[words.doc[least]]
                order = np.lexsort((d, h))
                h, d = h[order], d[order]
                at = np.flatnonzero(first_of_runs(h))
                last = np.append(at[1:], len(h))[: len(at)] - 1
                back = np.argsort(order[at])  # in document order, which compresses better
                at, last = at[back], last[back]
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(d[at]), pa.array(d[last])], ["h", "low", "high"])

    shared = (
        docs.mapInArrow(grams, "h long, low long, high long")
        .groupBy("h")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low < high")
        .select("h")
    )
    seen = spark.sparkContext.broadcast(bitmap(shared, "h", bits))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies: dict[int, int] = {}
        for batch in batches:
            for part in chunks(batch, most=_STEP):
                ids, words = _ids(part), Words(part.column(1))
                raw, off = text_bytes(part.column(1))
                keys = spans(prefix(_BYTE[raw]), off[:-1], off[1:])
                whole = np.zeros(len(ids), bool)  # copies of a text with a smaller id in this task
                for i, (k, d) in enumerate(zip(keys.tolist(), ids.tolist(), strict=True)):
                    if copies.get(k, d) < d:
                        whole[i] = True
                    else:
                        copies[k] = d
                at, least, hashes = _anchors(words, width, gram)
                use = hits(seen.value, hashes[least]) & ~whole[words.doc[at]]
                at = at[use]
                doc = words.doc[at]
                h = spans(prefix(words.hashes), at, at + width)
                order = np.lexsort((at, ids[doc], h))
                h, at, doc = h[order], at[order], doc[order]
                head = first_of_runs(h)
                low = ids[doc[head]][np.cumsum(head) - 1] if len(h) else ids[:0]
                later = ids[doc] > low
                once = ~later
                # what repeats inside the chunk, as intervals
                k = np.sort(at[later])
                d, s, e = _runs(words.doc[k], k, width)
                full = np.flatnonzero(whole & (words.counts >= width))
                d, s, e = (np.concatenate(x) for x in ((d, full), (s, words.first[full]), (e, words.first[full + 1])))
                yield _rows(np.zeros(len(d), np.int64), ids[d], keys[d], s - words.first[d], e - words.first[d], known=True)
                # in document order: ids and keys of neighbours are equal and compress well
                once = np.flatnonzero(once)
                once = once[np.argsort(at[once])]
                yield _rows(h[once].view(np.int64), ids[doc[once]], keys[doc[once]], at[once] - words.first[doc[once]], at[once] - words.first[doc[once]] + width, known=False)

    def _rows(h, d, k, s, e, known):
        if known:
            h = k.view(np.int64) ^ d  # spreads rows that need no partner
        # start, length and known in one number: fewer changing bytes in a row compress better
        place = s.astype(np.int64) << 32 | (e - s).astype(np.int64) << 1 | int(known)
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(place), pa.array(d), pa.array(k.view(np.int64))], ["h", "place", "doc_id", "row_key"])

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[int, int] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, place, d, k = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            known, s = place & 1 == 1, (place >> 32).astype(np.int32)
            e = s + (place >> 1 & 0x7FFFFFFF).astype(np.int32)
            head = first_of_runs(h, known)
            low = d[head][np.cumsum(head) - 1]
            if before and not known[0] and before[0] == h[0]:
                same = np.cumsum(head) == 1
                low = np.where(same, before[1], low)
            before = (int(h[-1]), int(low[-1])) if not known[-1] else None
            use = known | (d > low)
            d, k, s, e = d[use], k[use], s[use], e[use]
            order = np.lexsort((s, k, d))
            d, k, s, e = d[order], k[order], s[order], e[order]
            new = first_of_runs(d, k)
            if len(d):
                new[1:] |= s[1:] > e[:-1]
                at = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (d[at], k[at], s[at], np.maximum.reduceat(e, at))], ["doc_id", "row_key", "start", "end"])

    return (
        docs.mapInArrow(windows, "h long, place long, doc_id long, row_key long")
        .repartition(partitions(spark), "h")
        .sortWithinPartitions(F.col("place").bitwiseAND(F.lit(1)), "h", "doc_id", "place")
        .mapInArrow(later, "doc_id long, row_key long, start int, end int")
    )


def remove_repeats(documents: DataFrame, width: int = 13, gram: int = 5, bits: int = 26) -> DataFrame:
    """Every document with its words outside the repeated windows.

    Returns doc_id, n_words, n_removed, kept (the kept words joined by one
    space) and intervals (maximal, merged, in words). Null or empty text: no
    words, kept is empty. A null doc_id follows all ids, so it never takes
    words from others. Rows with the same doc_id never remove each other's
    words; further columns are ignored.
    """
    found = repeated_spans(documents, width, gram, bits).groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    docs = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, most=_STEP):
                raw, off = text_bytes(part.column(1))
                keys = spans(prefix(_BYTE[raw]), off[:-1], off[1:]).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(keys)], ["doc_id", "text", "row_key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, most=_STEP):
                out = []
                for d, text, found in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    words = text.encode().split()
                    merged: list[list[int]] = []
                    for s, e in sorted((x["start"], x["end"]) for x in found or ()):
                        if merged and s <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        else:
                            merged.append([s, e])
                    keep, at = [], 0
                    for s, e in merged:
                        keep += words[at:s]
                        at = e
                    keep += words[at:]
                    out.append((None if d == LAST else d, len(words), len(words) - len(keep), b" ".join(keep).decode(), [{"start": s, "end": e} for s, e in merged]))
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("intervals", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
    return (
        docs.mapInArrow(keyed, "doc_id long, text string, row_key long")
        .join(found, ["doc_id", "row_key"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string, intervals array<struct<start:int,end:int>>")
    )


def op9(spark, sf_dir) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words of each document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(documents).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
m AS (SELECT s, min(doc_id) AS low FROM g GROUP BY s),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM g JOIN m USING (s) WHERE low < doc_id),
gone AS (SELECT doc_id, list(k) AS ks FROM hit GROUP BY doc_id),
e AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM w),
kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.k) AS kept, count(*) AS n
  FROM e LEFT JOIN hit ON e.doc_id = hit.doc_id AND e.k = hit.k WHERE hit.k IS NULL GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
