"""Byte-level substring deduplication by distributed prefix doubling.

Suffixes are compared by the ranks of prefixes that grow to the threshold
(200 bytes); what is unique at some length is dropped and never ranked again.
Ranks are Rabin-Karp names: equal prefixes have equal names, so the rank pair
at an offset is read from the text itself and Spark only sorts the pairs and
ranks them anew. To keep the sorted rows at a fraction of the bytes:

1. Each window of 200 bytes is stood for by its anchor, the 16-byte gram of
   least hash among its first 120. Equal windows have equal anchors at equal
   offsets. Windows with one anchor form a segment. Segments are sorted by the
   pair of names of the 40 bytes at the anchor and the 40 bytes behind; a
   unique pair means that no window of the segment repeats.
2. Segments left are sorted by the name of their whole span (all windows of
   the segment). Equal spans repeat as a whole.
3. Where one anchor pair has several spans, one segment of each span is read
   again and its windows are ranked at the full 200 bytes, beside the others of
   the pair: partners of a window always have its anchor pair.

A pair with more spans than `most` ranks its windows in a Spark sort of their
own, so a very common passage does not meet in one task's memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import _BYTE, _mix, bitmap, chunks, first_of_runs, hits, partitions, prefix, rolling, spans, text_bytes, written

LAST = (1 << 63) - 1
_STEP, _GRAM = 2 << 20, 16


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the least value (the leftmost of equals) of each window."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    bits = np.uint64(max(1, int(n).bit_length()))
    packed = (values >> bits) << bits | np.arange(n, dtype=np.uint64)
    size = -(-n // width) * width
    padded = np.full(size, np.iinfo(np.uint64).max)
    padded[:n] = packed
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[: n - width + 1], ahead[width - 1 : n])
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


class _Segments:
    """Segments of a batch of texts: anchor pair, span name, document, first and last window."""

    def __init__(self, texts: pa.Array, least: int):
        self.raw, self.off = text_bytes(texts)
        self.sums = prefix(_BYTE[self.raw])
        self.keys = (spans(self.sums, self.off[:-1], self.off[1:]) >> np.uint64(1)).view(np.int64)
        reach = least - 80  # anchors lie in the first `reach` bytes of a window
        anchor = _sliding_least(rolling(self.sums, _GRAM), reach)
        doc = np.repeat(np.arange(len(texts)), np.maximum(np.diff(self.off) - least + 1, 0))
        first = np.cumsum(np.maximum(np.diff(self.off) - least + 1, 0))
        window = np.arange(len(doc)) - np.concatenate([[0], first])[:-1][doc] + self.off[:-1][doc]
        anchor = anchor[window]
        new = first_of_runs(anchor, doc)
        at = np.flatnonzero(new)
        self.doc, self.low, self.anchor = doc[at], window[at], anchor[at]
        self.high = window[np.append(at[1:], len(doc)) - 1] if len(at) else window
        pair = spans(self.sums, self.anchor, self.anchor + 40) * np.uint64(3) ^ spans(self.sums, self.anchor + 40, self.anchor + 80)
        self.pair = _mix(pair)
        self.name = spans(self.sums, self.low, self.high + least)


def _probe(name: np.ndarray, doc_id: np.ndarray, row_key: np.ndarray) -> np.ndarray:
    return _mix(name ^ _mix(doc_id.astype(np.uint64) * np.uint64(5) + row_key.astype(np.uint64)))


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _whole_groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list[np.ndarray], bool]]:
    """Columns of sorted batches cut between keys (column 0); True for parts of a key with more than most rows."""
    left: list[np.ndarray] | None = None
    for batch in batches:
        rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        if left is not None:
            rows = [np.concatenate(x) for x in zip(left, rows, strict=True)]
        if not len(rows[0]):
            continue
        tail = int(np.searchsorted(rows[0], rows[0][-1]))
        if tail:
            yield [x[:tail] for x in rows], False
        left = [x[tail:] for x in rows]
        if len(left[0]) > most:
            yield left, True
            left = [x[-1:] for x in left]  # the next part sees that the key goes on
    if left is not None and len(left[0]):
        yield left, False


_SPANS = "doc_id long, row_key long, start int, end int"


def repeated_bytes(documents: DataFrame, least: int = 200, bits: int = 26, most: int = 200_000) -> DataFrame:
    """Byte intervals [start, end) of each text covered by a string of `least` bytes that also starts elsewhere.

    Returns doc_id, row_key (a hash of the text), start, end; they may touch and overlap.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def copies_of(known: dict[int, int], keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Which texts this task has read before, and (doc_id, row_key, size) of those that so repeat as a whole."""
        again, whole = np.zeros(len(keys), bool), []
        for i, (k, d, n) in enumerate(zip(keys.tolist(), ids.tolist(), sizes.tolist(), strict=True)):
            if n < least:
                continue
            if k in known:
                again[i] = True
                whole.append((d, k, n))
                if known[k] >= 0:
                    whole.append((known[k], k, n))
                    known[k] = -1
            else:
                known[k] = d if d >= 0 else -1
                if d < 0:
                    whole.append((d, k, 0))
        if len(known) > 1_000_000:
            known.clear()
        return again, [x for x in whole if x[2]]

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, int] = {}
        for batch in batches:
            for part in chunks(batch, most=_STEP):
                ids, s = _ids(part), _Segments(part.column(1), least)
                again, whole = copies_of(known, s.keys, ids, np.diff(s.off))
                use = ~again[s.doc]
                d, low = s.doc[use], s.low[use]
                begin = s.off[:-1][d]
                zero = np.zeros(len(whole), np.int64)
                w = np.array(whole, np.int64).reshape(-1, 3)
                cols = [
                    np.concatenate([s.pair[use].view(np.int64), w[:, 1]]),
                    np.concatenate([s.name[use].view(np.int64), zero]),
                    np.concatenate([ids[d], w[:, 0]]),
                    np.concatenate([s.keys[d], w[:, 1]]),
                    np.concatenate([low - begin, zero]).astype(np.int32),
                    np.concatenate([s.high[use] - begin + least, w[:, 2]]).astype(np.int32),
                    np.concatenate([np.zeros(len(d), bool), np.ones(len(w), bool)]),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["pair", "name", "doc_id", "row_key", "start", "end", "whole"])

    def rank_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (pair, name, d, k, s, e, whole), cut in _whole_groups(batches, 4_000_000):
            out = [np.flatnonzero(whole)]
            at = np.flatnonzero(~whole)
            p, n = pair[at], name[at]
            new, head = first_of_runs(p, n), first_of_runs(p)
            span, group = np.cumsum(new) - 1, np.cumsum(head) - 1
            many = np.bincount(span, minlength=1)[span] > 1 if len(at) else new
            spans_of = np.bincount(group, weights=new, minlength=1)[group] if len(at) else new
            out.append(at[many])
            probe = at[new & ((spans_of > 1) | cut)]
            rows = np.concatenate([*out, probe])
            if len(rows):
                ask = np.zeros(len(rows), bool)
                ask[len(rows) - len(probe) :] = True
                yield pa.RecordBatch.from_arrays([*(pa.array(x[rows]) for x in (d, k, s, e)), pa.array(ask), pa.array(_probe(name[rows].view(np.uint64), d[rows], k[rows]).view(np.int64))], ["doc_id", "row_key", "start", "end", "ask", "probe"])

    ranked = written(
        docs.mapInArrow(segments, "pair long, name long, doc_id long, row_key long, start int, end int, whole boolean")
        .repartition(partitions(spark), "pair")
        .sortWithinPartitions("pair", "name", "doc_id", "start")
        .mapInArrow(rank_spans, f"{_SPANS}, ask boolean, probe long")
    )
    asked = spark.sparkContext.broadcast(bitmap(ranked.where("ask"), "probe", bits))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, int] = {}
        for batch in batches:
            for part in chunks(batch, most=_STEP):
                ids, s = _ids(part), _Segments(part.column(1), least)
                again, _ = copies_of(known, s.keys, ids, np.diff(s.off))
                at = np.flatnonzero(~again[s.doc] & hits(asked.value, _probe(s.name, ids[s.doc], s.keys[s.doc])))
                d = s.doc[at]
                begin = s.off[:-1][d]
                raw = s.raw.tobytes()
                cols = [pa.array(s.pair[at].view(np.int64)), pa.array(ids[d]), pa.array(s.keys[d]), pa.array((s.low[at] - begin).astype(np.int32)), pa.array([raw[a:b] for a, b in zip(s.low[at].tolist(), (s.high[at] + least).tolist(), strict=True)], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["pair", "doc_id", "row_key", "start", "bytes"])

    def rank_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "row_key", "start", "end", "name"]
        common = None  # the last pair that was cut
        for (pair, d, k, s, raw), cut in _whole_groups(batches, most):
            common = pair[0] if cut else common
            sizes = np.array([len(x) for x in raw], np.int64)
            sums = prefix(_BYTE[np.frombuffer(b"".join(raw), np.uint8)])
            n = sizes - least + 1
            row = np.repeat(np.arange(len(raw)), n)
            place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            begin = (np.cumsum(sizes) - sizes)[row] + place
            half = least // 2
            h = _mix(spans(sums, begin, begin + half) * np.uint64(3) ^ spans(sums, begin + half, begin + least))
            part = np.flatnonzero(pair[row] == common) if common is not None else ()
            if len(part):  # windows of a very common pair are ranked with its other parts below
                r, x = row[part], place[part]
                yield pa.RecordBatch.from_arrays([pa.array(d[r]), pa.array(k[r]), pa.array((s[r] + x).astype(np.int32)), pa.array((s[r] + x + least).astype(np.int32)), pa.array(h[part].view(np.int64))], names)
            if cut:
                continue
            order = np.lexsort((row, h, pair[row]))
            ph, pp = h[order], pair[row][order]
            new = first_of_runs(ph, pp)
            group = np.cumsum(new) - 1
            twice = np.zeros(len(row), bool)
            twice[order] = np.bincount(group, minlength=1)[group] > 1 if len(row) else False
            hit = np.flatnonzero(twice)
            if len(hit):
                r, x = row[hit], place[hit]
                new = first_of_runs(r) | np.concatenate([[True], x[1:] != x[:-1] + 1])
                at = np.flatnonzero(new)
                last = np.append(at[1:], len(hit)) - 1
                r = r[at]
                yield pa.RecordBatch.from_arrays([pa.array(d[r]), pa.array(k[r]), pa.array((s[r] + x[at]).astype(np.int32)), pa.array((s[r] + x[last] + least).astype(np.int32)), pa.nulls(len(r), pa.int64())], names)

    found = written(
        docs.mapInArrow(probes, "pair long, doc_id long, row_key long, start int, bytes binary")
        .repartition(partitions(spark), "pair")
        .sortWithinPartitions("pair", "doc_id", "start")
        .mapInArrow(rank_windows, f"{_SPANS}, name long")
    )
    open_ = found.where("name IS NOT NULL").dropDuplicates(["name", "doc_id", "row_key", "start"])
    more = open_.join(open_.groupBy("name").agg(F.count("*").alias("many")).where("many > 1"), "name", "left_semi")
    columns = ["doc_id", "row_key", "start", "end"]
    return ranked.where("NOT ask").select(*columns).unionByName(found.where("name IS NULL").select(*columns)).unionByName(more.select(*columns))


def remove_repeated_bytes(documents: DataFrame, least: int = 200, bits: int = 26, most: int = 200_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, kept (bytes) and removed (maximal byte intervals) of every row.

    Null text: empty. Rows with equal doc_id are documents of their own; equal
    rows repeat each other as any copies do. Rows without doc_id count like
    others. Further columns are ignored.
    """
    found = repeated_bytes(documents, least, bits, most).groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    docs = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, most=_STEP):
                raw, off = text_bytes(part.column(1))
                keys = (spans(prefix(_BYTE[raw]), off[:-1], off[1:]) >> np.uint64(1)).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(keys)], ["doc_id", "text", "row_key"])

    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, most=_STEP):
                out = []
                for d, text, rows in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    raw, merged = text.encode(), []
                    for s, e in sorted((x["start"], x["end"]) for x in rows or ()):
                        if merged and s <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        else:
                            merged.append([s, e])
                    at, keep = 0, []
                    for s, e in merged:
                        keep.append(raw[at:s])
                        at = e
                    keep.append(raw[at:])
                    kept = b"".join(keep)
                    out.append({"doc_id": None if d == LAST else d, "n_bytes": len(raw), "n_removed": len(raw) - len(kept), "kept": kept, "removed": [{"start": s, "end": e} for s, e in merged]})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return (
        docs.mapInArrow(keyed, "doc_id long, text string, row_key long")
        .join(found, ["doc_id", "row_key"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, kept binary, removed array<struct<start:int,end:int>>")
    )


def op10(spark, sf_dir) -> DataFrame:
    """Counts of removed bytes and runs, and the SHA-256 of the bytes that stay."""
    out = remove_repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: dict[int, str | None], least: int = 200) -> dict[int, tuple[int, int, int, str]]:
    """n_bytes, n_removed, n_spans and digest of each text, by a table of all windows."""
    seen: dict[bytes, int] = {}
    raws = {d: (t or "").encode() for d, t in texts.items()}
    for raw in raws.values():
        for i in range(len(raw) - least + 1):
            w = hashlib.blake2b(raw[i : i + least], digest_size=12).digest()
            seen[w] = seen.get(w, 0) + 1
    out = {}
    for d, raw in raws.items():
        gone = np.zeros(len(raw) + 1, np.int64)
        for i in range(len(raw) - least + 1):
            if seen[hashlib.blake2b(raw[i : i + least], digest_size=12).digest()] > 1:
                gone[i] += 1
                gone[i + least] -= 1
        cover = np.cumsum(gone)[: len(raw)] > 0
        runs = int((cover & ~np.concatenate([[False], cover[:-1]])).sum()) if len(raw) else 0
        kept = np.frombuffer(raw, np.uint8)[~cover].tobytes()
        out[d] = (len(raw), int(cover.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out
