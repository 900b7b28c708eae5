"""Byte-level BPE with DuckDB recursive queries inside each partition.

A text is cut into words by the tokenizer's pattern. The words of a chunk that
are not known yet go to one recursive query: a word's tokens are unnested to
position rows, neighbours join the merge table, and each word's leftmost pair
of least rank is contracted until no pair is left. A word that is a token as a
whole takes its id at once. Decoding joins token-position rows with the
vocabulary and aggregates the bytes in order.

A word over `LONG` bytes (an unbroken run) would take as many steps as it has
tokens, each over the whole word. It is encoded in pieces, and the tokens
around each cut are encoded again as a word of their own: tokens are the
encoding of their text if every two neighbours are that of theirs, so the
piece's tokens hold up to where both agree. Where they do not agree, more
tokens are taken, and at last the whole word.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorate.llm.common import chunks, first_of_runs, give_back

#: Bytes of words, and sum of their squared lengths (the size of all steps), that one recursive query takes.
QUERY_BYTES, QUERY_SQUARES = 300_000, 16_000_000
#: Words that a task keeps.
KEPT_WORDS = 150_000
#: Bytes of a word that is encoded at once, bytes of the pieces of a longer one, and tokens on each side of a cut.
LONG, PIECE, AROUND = 2_000, 512, 16

# a row leaves the recursion, done, when no pair of its word is in the merge table
_ENCODE = """
WITH RECURSIVE state(w, done, ids) AS (
  SELECT w, false, ids FROM fresh
  UNION ALL
  SELECT s.w, b.best IS NULL,
         CASE WHEN b.best IS NULL THEN s.ids ELSE s.ids[:(b.best & 4294967295) - 1] || [(b.best >> 32)::INTEGER] || s.ids[(b.best & 4294967295) + 2:] END
  FROM state s LEFT JOIN (
    SELECT w, min((m.rank::BIGINT << 32) + p.at) AS best
    FROM (
      SELECT w, unnest(ids[:-2]) AS l, unnest(ids[2:]) AS r, unnest(range(1, len(ids))) AS at FROM state WHERE len(ids) > 1) p
    JOIN merges m ON m.pair = (p.l::BIGINT << 32) + p.r
    GROUP BY w) b ON s.w = b.w
  WHERE NOT s.done)
SELECT w, ids FROM state WHERE done ORDER BY w
"""
# the same with one kept row for each word, for words of any length
_ENCODE_KEYED = """
WITH RECURSIVE state(w, ids) USING KEY (w) AS (
  SELECT w, ids FROM fresh
  UNION
  SELECT s.w, s.ids[:(b.best & 4294967295) - 1] || [(b.best >> 32)::INTEGER] || s.ids[(b.best & 4294967295) + 2:]
  FROM state s JOIN (
    SELECT w, min((m.rank::BIGINT << 32) + p.at) AS best
    FROM (
      SELECT w, unnest(ids[:-2]) AS l, unnest(ids[2:]) AS r, unnest(range(1, len(ids))) AS at FROM state WHERE len(ids) > 1) p
    JOIN merges m ON m.pair = (p.l::BIGINT << 32) + p.r
    GROUP BY w) b ON s.w = b.w)
SELECT w, ids FROM state ORDER BY w
"""
# bytes travel as the characters of their numbers
_DECODE = "SELECT d, string_agg(chars, '' ORDER BY k) AS chars FROM tokens JOIN vocabulary USING (id) GROUP BY d"


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes to ranks from a file of base64 tokens and ranks; a local path is the driver's."""
    if "://" in path:
        lines = [r.value for r in spark.read.text(path).collect()]  # one vocabulary
    else:
        with open(path) as f:
            lines = f.read().splitlines()
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class Coder:
    """Encoder and decoder of one task. Known words keep their ids in one array."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb
        import regex

        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        merges = pa.table({"pair": (np.array(left, np.int64) << 32) + np.array(right, np.int64), "rank": pa.array(rank, pa.int32())})
        vocabulary = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "chars": [t.decode("latin-1") for t in ranks]})
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("rows", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM rows")
            self.db.unregister("rows")
        self.token = {r: t for t, r in ranks.items()}
        self.digits = pa.array([str(i) for i in range(max(ranks.values()) + 1)])
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sizes = self.begins = self.flat = np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        """Adds the ids of unknown words."""
        raws = [w.encode() for w in words]
        whole = np.array([self.ranks.get(r, -1) for r in raws], np.int64)
        ids: list = [None] * len(words)
        part = np.flatnonzero(whole < 0).tolist()
        short = [i for i in part if len(raws[i]) <= LONG]
        flats, sizes, rows = [whole[whole >= 0]], [np.ones(int((whole >= 0).sum()), np.int64)], [np.flatnonzero(whole >= 0)]
        for at, n, flat in self._encoded([raws[i] for i in short]):
            rows.append(np.array(short, np.int64)[at])
            sizes.append(n)
            flats.append(flat)
        for i in part:
            if len(raws[i]) > LONG:
                ids[i] = self._long(raws[i])
                rows.append(np.array([i]))
                sizes.append(np.array([len(ids[i])]))
                flats.append(np.array(ids[i], np.int64))
        base = len(self.sizes)
        for k, i in enumerate(np.concatenate(rows).tolist()):
            self.known[words[i]] = base + k
        self.sizes = np.concatenate([self.sizes, *sizes])
        self.flat = np.concatenate([self.flat, *flats]).astype(np.int32)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def _encoded(self, raws: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows of raws, their numbers of ids, and all ids; a bounded number of bytes at a time."""
        lengths = np.array([len(r) for r in raws], np.int64)
        group = np.maximum(np.cumsum(lengths) // QUERY_BYTES, np.cumsum(lengths * lengths) // QUERY_SQUARES)
        cuts = np.append(np.flatnonzero(first_of_runs(group)), len(raws)) if raws else [0]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            done = self._query(raws[a:b], _ENCODE)
            yield a + np.arange(b - a), np.diff(done.offsets.to_numpy()).astype(np.int64), done.flatten().to_numpy().astype(np.int64)

    def _query(self, raws: list[bytes], sql: str) -> pa.ListArray:
        offsets = np.cumsum([0, *map(len, raws)], dtype=np.int32)
        values = self.bytes[np.frombuffer(b"".join(raws), np.uint8)]
        self.db.register("fresh", pa.table({"w": pa.array(np.arange(len(raws), dtype=np.int32)), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))}))
        ids = self.db.sql(sql).to_arrow_table().column("ids").combine_chunks()
        self.db.unregister("fresh")
        return ids.cast(pa.list_(pa.int32()))

    def _many(self, raws: list[bytes]) -> list[list[int]]:
        out = []
        for _, sizes, flat in self._encoded(raws):
            out += [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
        return out

    def _long(self, raw: bytes) -> list[int]:
        """The ids of a long word from those of its pieces."""
        pieces = self._many([raw[i : i + PIECE] for i in range(0, len(raw), PIECE)])
        around, begins, ends = AROUND, [0] * len(pieces), [len(p) for p in pieces]
        joints: list[list[int]] = [[] for _ in pieces]  # what stands before each piece's own tokens
        open_ = list(range(1, len(pieces)))
        while open_:
            takes = [(pieces[k - 1][-around:], pieces[k][:around]) for k in open_]
            again = self._many([b"".join(self.token[i] for i in left + right) for left, right in takes])
            still = []
            for k, (left, right), new in zip(open_, takes, again, strict=True):
                # agreement at both ends: the tokens there stand in both encodings
                if len(new) > 1 and new[0] == left[0] and new[-1] == right[-1]:
                    ends[k - 1], begins[k], joints[k] = len(pieces[k - 1]) - len(left) + 1, len(right) - 1, new[1:-1]
                else:
                    still.append(k)
            open_, around = still, around * 2
            if open_ and around > PIECE:
                return self._query([raw], _ENCODE_KEYED).flatten().to_pylist()
        if any(b >= e for b, e in zip(begins, ends, strict=True)):  # two cuts' tokens meet
            return self._query([raw], _ENCODE_KEYED).flatten().to_pylist()
        return list(chain.from_iterable(j + p[b:e] for j, p, b, e in zip(joints, pieces, begins, ends, strict=True)))

    def encode(self, texts: list[str]) -> pa.ListArray:
        """Token ids of each text."""
        words = [self.pattern.findall(t) for t in texts]
        if len(self.known) > KEPT_WORDS:
            self.forget()
        unknown = set().union(*words) - self.known.keys() if words else set()
        if unknown:
            self._learn(list(unknown))
        counts = np.array([len(x) for x in words], np.int64)
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.begins[at] - (ends - sizes), sizes) + np.arange(total)]
        offsets = np.append(0, ends)[np.append(0, np.cumsum(counts))]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))

    def decode(self, ids: pa.ListArray) -> list[bytes]:
        sizes = np.diff(ids.offsets.to_numpy())
        rows = pa.table({"d": np.repeat(np.arange(len(ids), dtype=np.int32), sizes), "k": np.arange(sizes.sum(), dtype=np.int32), "id": ids.flatten()})
        self.db.register("tokens", rows)
        found = self.db.sql(_DECODE).to_arrow_table()
        self.db.unregister("tokens")
        out = [b""] * len(ids)
        for d, chars in zip(found.column("d").to_pylist(), found.column("chars").to_pylist(), strict=True):
            out[d] = chars.encode("latin-1")
        return out

    def written(self, ids: pa.ListArray) -> pa.Array:
        """The decimal ids of each text, joined by commas."""
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.digits.take(ids.flatten())), ",")


def _run(texts: DataFrame, columns: list[str], path: str, pattern: str, finish, schema: str, arrow: pa.Schema) -> DataFrame:
    spark = texts.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(spark, path))  # one file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        try:
            for batch in batches:
                for part in chunks(batch, columns[-1], 1 << 20):
                    coder = coder or Coder(ranks.value, pattern)
                    yield pa.RecordBatch.from_arrays(finish(coder, part), schema=arrow)
        finally:  # a Python worker outlives its task: what the task knew is given back
            if coder is not None:
                coder.db.close()
                coder = None
                give_back()

    return texts.select(*columns).mapInArrow(run, schema)


def encode_texts(documents: DataFrame, path: str, pattern: str, decode: bool = False) -> DataFrame:
    """doc_id, token ids (array of int) of each row's whole text; with decode also the decoded bytes.

    Null text: no tokens. Rows are independent, so repeated rows and ids are
    kept as they are; further columns are ignored.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    fields = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), *([("decoded", pa.binary())] if decode else [])]

    def finish(coder: Coder, part: pa.RecordBatch) -> list[pa.Array]:
        ids = coder.encode(part.column(1).to_pylist())
        return [part.column(0), ids, *([pa.array(coder.decode(ids), pa.binary())] if decode else [])]

    return _run(docs, ["doc_id", "text"], path, pattern, finish, "doc_id long, ids array<int>" + ", decoded binary" * decode, pa.schema(fields))


def round_trip_digests(documents: DataFrame, path: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests made where the ids are, so that they need not travel."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]

    def finish(coder: Coder, part: pa.RecordBatch) -> list[pa.Array]:
        ids = coder.encode(part.column(1).to_pylist())
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return [
            part.column(0),
            pa.array(np.diff(ids.offsets.to_numpy()), pa.int64()),
            pa.array([sha(x.as_buffer()) for x in coder.written(ids)], pa.string()),
            pa.array([sha(b) for b in coder.decode(ids)], pa.string()),
        ]

    return _run(docs, ["doc_id", "text"], path, pattern, finish, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", pa.schema(list(zip(names, types, strict=True))))


def op4(spark, sf_dir) -> DataFrame:
    """Digests of each document's token ids and of the bytes they decode to."""
    import public_tokenizers

    return round_trip_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
