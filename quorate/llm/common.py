"""Shared helpers: checkpoints, bounded bitmaps, and vectorised text hashing.

The hashing works on the Arrow buffers of a whole batch at a time: a prefix
polynomial over all bytes (or words) gives the hash of any span by one
subtraction and one multiplication, so no Python code runs for each word.
"""

from __future__ import annotations

import contextlib
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step handles; a longer text is a step of its own.
CHUNK_BYTES = 1 << 21

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = _U(0x9E3779B97F4A7C15 | 1)
_P_INV = _U(pow(int(_P), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), kept for the next call."""
    kept = _powers.get(int(base))
    if kept is None or len(kept) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        kept = np.cumprod(steps, dtype=np.uint64)
        if size <= CHUNK_BYTES * 2:
            _powers[int(base)] = kept
    return kept[:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix polynomial of values; spans() reads from it."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_P, len(values)), out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values start .. end - 1, wherever they stand."""
    return _mix((sums[end] - sums[start]) * _power(_P_INV, len(sums))[start] + (end - start).astype(np.uint64))


def rolling(sums: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of width values."""
    n = len(sums) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    return _mix((sums[width:] - sums[:-width]) * _power(_P_INV, n) + _U(width))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offsets of its rows; null: empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def chunks(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about most bytes of text each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        base = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, base + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


class Words:
    """Words (runs of bytes other than ASCII white space) of a batch of texts.

    start, end: byte spans; first: index of each text's first word, with the
    total at its end; hashes: one for each word; doc: the row of each word.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        raw, off = text_bytes(texts)
        self.raw, self.off = raw, off
        space = _SPACE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[off] = True
        before = np.ones(len(raw), bool)
        before[1:] = space[:-1]
        after = np.ones(len(raw), bool)
        after[:-1] = space[1:]
        solid = ~space
        self.start = np.flatnonzero(solid & (before | edge[:-1]))
        self.end = np.flatnonzero(solid & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, off)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(off) - 1), self.counts)
        self.hashes = spans(prefix((_BYTE_LOWER if lower else _BYTE)[raw]), self.start, self.end)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Start index and hash of each window of width words inside one text."""
        every = rolling(prefix(self.hashes), width)
        at = np.arange(len(every))
        at = at[at + width <= self.first[self.doc[at] + 1]] if len(every) else at
        return at, every[at]


def first_of_runs(*keys: np.ndarray) -> np.ndarray:
    """Marks rows of sorted columns that differ from the row before."""
    out = np.ones(len(keys[0]), bool)
    if len(out):
        out[1:] = False
        for k in keys:
            out[1:] |= k[1:] != k[:-1]
    return out


def give_back() -> None:
    """Returns freed memory to the system, where the C library can: a Python worker idles beside other stages."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run):
    """run, a function of mapInArrow, which gives its memory back when its task ends."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def scratch(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in spark.checkpoint.dir.

    The setting is read from the session; a temporary folder is used only
    where it is unset and the master is local, as in tests.
    """
    ready(df.sparkSession)
    return df.checkpoint(eager=True)


def ready(spark: SparkSession) -> None:
    """Sets the checkpoint folder from spark.checkpoint.dir."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            import tempfile

            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)


def bits_for(rows: int, least: int = 16, most: int = 28) -> int:
    """Bits of a bitmap in which about one of eight is set; 2 ** most bits (32 MB) at most."""
    return min(most, max(least, int(8 * rows).bit_length()))


def bitmap(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of 2 ** bits bits of the keys' low bits, as packed uint64.

    Its size is fixed by bits, whatever the number of keys; a fuller bitmap
    only lets more rows through. Users treat a hit as "perhaps".
    """
    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        keys.select(F.shiftright(slot, 6).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast({column} & 63L as int))").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def hits(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys' bits are set."""
    slot = keys & _U(len(words) * 64 - 1)
    return (words[(slot >> _U(6)).astype(np.int64)] >> (slot & _U(63))) & _U(1) != 0


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_path(spark: SparkSession) -> str:
    import uuid

    ready(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared checkpoint folder, read back."""
    path = _shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a table that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Collects the driver's garbage, so that Spark lets go of the shuffles and broadcasts of plans that are done."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ease(spark: SparkSession) -> None:
    """release(), once the driver's heap takes half of what it may: a collection gives the free part back to the system."""
    runtime = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    if 2 * runtime.totalMemory() > runtime.maxMemory():
        release(spark)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is made and run within loses its shuffle files as soon as it has run, not when the driver happens to collect its garbage.

    Each DataFrame within should run once; Spark repeats the stages of one that runs again.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Tables:
    """Parquet tables in the shared checkpoint folder that are deleted with the block; its result is written before."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            delete(self.spark, path)

    def written(self, df: DataFrame) -> DataFrame:
        path = _shared_path(self.spark)
        self.paths.append(path)
        df.write.parquet(path)
        ease(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, path: str) -> None:
        """Deletes a table of the block before its end."""
        self.paths.remove(path)
        delete(self.spark, path)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every node of the edges; root is the least node of its component.

    Each node takes the least root among its neighbours' and then its root's
    root, until nothing changes.
    """
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    return nodes, nodes[root]


def components(links: DataFrame, tables: Tables, local: int = 4_000_000, rounds: int = 40) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the least node of its component.

    Tasks of at most about `local` links each contract what they have to
    stars; if there is one such task, that is the result. Otherwise large-star
    and small-star steps, each a grouped minimum, go on until the edges stop
    changing; no step holds a component in one place.
    """
    edges = tables.written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    tasks = -(-edges.count() // local)

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [batch for batch in batches if batch.num_rows]
        if rows:
            both = pa.Table.from_batches(rows)
            node, root = forest(*(both.column(i).to_numpy() for i in range(2)))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])

    stars = edges.coalesce(max(1, tasks)).mapInArrow(contract, "node long, root long")
    if tasks <= 1:
        return tables.written(stars)
    sums = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    edges = tables.written(stars.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    before = sums(edges)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        edges = tables.written(small)
        after = sums(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle; raise rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
