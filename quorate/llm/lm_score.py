"""Language-model scores by online logistic context mixing.

A byte is a path of bits through a Huffman tree made from the training bytes
(a text ends with a symbol of its own; every byte of the training texts has
one, up to 254 of the 256, while valid UTF-8 has 243; a byte that training
never met is an escape and eight plain bits). Predictors for each bit look up
the last byte, the last three (hashed) and the word so far (hashed) in tables
of counts, gathered from all training texts. Their logits are mixed by weights that the tree node gates
(the bits of the byte read so far), learned online by gradient steps, and the
mixed probability is refined by a table of what happened at that probability
after the last byte. Weights and refinement are learned on one fold of the
training texts with tables of the others; the tables then take in that fold.

The bit tables have a fixed size, so what grows with the corpus is a table of
passages: a text is cut after each word whose hash is divisible by `every`, and
every passage of the training texts is counted under a 64-bit hash. A passage's
probability is the mixture (1 - g) * bits + g * c / N: the bits' product, and
the share of its c copies among N passages. The gate g is the share of the
passages of the learning fold that the other folds have. A training text does
not count its own copies, so texts that occur once and texts that occur again
are told apart.

Beside the model, each text gets an add-one unigram score from the counts of
all words of the training texts: the most common words travel as a table of
fixed size, all others meet their counts in a shuffle, and so do passages.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import _BYTE, Tables, Words, _mix, chunks, first_of_runs, partitions, prefix, spans, text_bytes, tidy, written

_STEP = 1 << 21
_TREE = 128  # least cells for each context: symbols when counting, nodes when scoring; twice as many for over 126 kinds of byte
#: log2 of the contexts: the last byte, the last three, the word so far.
ORDERS = (7, 15, 16)
_STARTS = np.cumsum([0, *(_TREE << o for o in ORDERS)])
_BLOCK = 1 << 16
_BUCKETS = 33  # refinement: logits -8 .. 8 in halves
LAST = (1 << 63) - 1


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 7; null id: that of the empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(7)).cast("int")


class Code:
    """Symbols, their bits and tree nodes, from the counts of bytes (256) and texts (the end)."""

    def __init__(self, counts: np.ndarray):
        self.tree = _TREE if np.count_nonzero(counts[:256]) <= _TREE - 2 else 2 * _TREE
        self.orders = (self.tree.bit_length() - 1, *ORDERS[1:])
        self.starts = np.cumsum([0, *(self.tree << o for o in self.orders)])
        common = np.argsort(-counts[:256], kind="stable")[: self.tree - 2]
        common = common[counts[common] > 0]
        self.symbol = np.full(256, 1, np.uint8)  # 0: end, 1: escape
        self.symbol[common] = np.arange(2, len(common) + 2)
        self.blank = np.zeros(self.tree, bool)  # symbols that end a word
        self.blank[[0, *(x for x in self.symbol[[9, 10, 11, 12, 13, 32]].tolist() if x > 1)]] = True
        weight = np.concatenate([[counts[256], counts[:256].sum() - counts[common].sum()], counts[common]]) + 1
        heap: list[tuple[int, int, object]] = [(int(w), i, i) for i, w in enumerate(weight)]
        heapq.heapify(heap)
        order = len(heap)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (a[0] + b[0], order, (a[2], b[2])))
            order += 1
        paths: dict[int, list[tuple[int, int]]] = {}
        nodes = 0
        stack: list[tuple[object, list[tuple[int, int]]]] = [(heap[0][2], [])]
        while stack:
            tree, path = stack.pop()
            if isinstance(tree, tuple):
                stack += [(tree[bit], [*path, (nodes, bit)]) for bit in (0, 1)]
                nodes += 1
            else:
                paths[tree] = path
        self.length = np.zeros(self.tree, np.int64)
        depth = max(map(len, paths.values()))
        self.node, self.bit = np.zeros((depth, self.tree), np.int32), np.zeros((depth, self.tree), np.float32)
        self.below = np.zeros((2, self.tree, self.tree), np.float32)  # symbol, node: whether the path takes that bit there
        for s, path in paths.items():
            self.length[s] = len(path)
            for d, (n, b) in enumerate(path):
                self.node[d, s], self.bit[d, s] = n, b
                self.below[b, s, n] = 1


def symbols_of(texts: pa.Array, code: Code) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Symbols with an end after each text, first cells of their contexts, offsets, and bytes."""
    raw, off = text_bytes(texts)
    ends = off[1:] + np.arange(len(off) - 1)
    s = np.zeros(len(raw) + len(ends), np.uint8)
    inside = np.ones(len(s), bool)
    inside[ends] = False
    s[inside] = code.symbol[raw]

    def back(x: np.ndarray, after: np.ndarray) -> np.ndarray:
        out = np.zeros_like(x)
        out[1:] = x[:-1]
        out[after == 0] = 0  # what stands before a text is its end symbol
        return out

    one = back(s, np.ones_like(s))
    two = back(one, one)
    three = back(two, two)
    a, b, c = (x.astype(np.uint32) for x in (one, two, three))
    bits = code.orders[0]
    triple = ((a | b << np.uint32(bits) | c << np.uint32(2 * bits)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - ORDERS[1])
    gap = code.blank[s]
    begin = np.zeros(len(s), np.int64)
    begin[1:] = np.maximum.accumulate(np.where(gap, np.arange(len(s)) + 1, 0))[:-1]
    word = (spans(prefix(s.astype(np.uint64) + np.uint64(1)), begin, np.arange(len(s))) >> np.uint64(64 - ORDERS[2])).astype(np.uint32)
    cells = [(x * np.uint32(code.tree) + np.uint32(start)).astype(np.int32) for x, start in zip((a, triple, word), code.starts, strict=False)]
    return s, cells, np.append(0, ends + 1), raw


def _tables(counts: np.ndarray, code: Code) -> np.ndarray:
    """Logits of the bit 1 at each (context, node), shrunk to one half where a context is rare."""
    rows = counts.reshape(-1, code.tree)
    out = np.empty(rows.shape, np.float32)
    for k in range(0, len(rows), _BLOCK // 4):
        part = rows[k : k + _BLOCK // 4].astype(np.float32)
        out[k : k + len(part)] = np.log(part @ code.below[1] + 0.4) - np.log(part @ code.below[0] + 0.4)
    return out.ravel()


def _bucket(x: np.ndarray) -> np.ndarray:
    return (np.clip(x, -8, 8) * 2 + 16.5).astype(np.int32)


class Mixer:
    """Node-gated weights over the orders' logits, and the refinement table."""

    def __init__(self, weights: np.ndarray | None = None, counts: np.ndarray | None = None, tree: int = _TREE):
        self.weights = np.full((tree, len(ORDERS)), 0.4, np.float32) if weights is None else weights
        self.counts = np.zeros((2, tree, _BUCKETS)) if counts is None else counts
        self.steps = np.zeros(tree)

    def refined(self) -> np.ndarray:
        middle = (np.arange(_BUCKETS) - 16) / 2
        p = 1 / (1 + np.exp(-middle))
        return (np.log(self.counts[1] + 8 * p) - np.log(self.counts[0] + 8 * (1 - p))).astype(np.float32)

    def learn(self, s: np.ndarray, cells: list[np.ndarray], tables: np.ndarray, code: Code, rate: float = 0.5, block: int = 1 << 15) -> None:
        """Online: each block is predicted with what the blocks before it taught."""
        for k in range(0, len(s), block):
            part = s[k : k + block]
            before = cells[0][k : k + block] // code.tree
            at, gradient, seen = np.arange(len(part)), np.zeros((code.tree, len(ORDERS))), np.zeros(code.tree)
            for d in range(len(code.node)):
                at = at[code.length[part[at]] > d]
                if not len(at):
                    break
                node, bit = code.node[d][part[at]], code.bit[d][part[at]]
                logits = [tables[c[k : k + block][at] + node] for c in cells]
                w = self.weights[node]
                x = sum(w[:, i] * z for i, z in enumerate(logits))
                error = bit - 1 / (1 + np.exp(-x))
                for i, z in enumerate(logits):
                    gradient[:, i] += np.bincount(node, error * z, code.tree)
                seen += np.bincount(node, minlength=code.tree)
                place = before[at] * _BUCKETS + _bucket(x)
                for b in (0, 1):
                    self.counts[b] += np.bincount(place[bit == b], minlength=code.tree * _BUCKETS).reshape(code.tree, _BUCKETS)
            self.weights += (rate * gradient / (seen[:, None] + 200)).astype(np.float32)
            self.steps += seen


def nats(s: np.ndarray, cells: list[np.ndarray], mixed: np.ndarray, refined: np.ndarray, code: Code) -> np.ndarray:
    """Minus the natural logarithm of each symbol's probability. mixed: tables times weights."""
    out = np.zeros(len(s), np.float32)
    out[s == 1] = 8 * np.log(2)
    flat, half = refined.ravel(), (0.5 - code.bit).astype(np.float32)
    before = cells[0] // code.tree * _BUCKETS
    at = None  # symbols whose path goes on
    for d in range(len(code.node)):
        if d:
            use = np.flatnonzero((code.length > d)[s])
            if not len(use):
                break
            at = use if at is None else at.take(use)
            s, before, cells = s.take(use), before.take(use), [c.take(use) for c in cells]
        node = code.node[d].take(s)
        x = mixed.take(cells[0] + node)
        for c in cells[1:]:
            x += mixed.take(c + node)
        x += flat.take(before + _bucket(x))
        x *= half[d].take(s)  # half of the sum, turned by the bit
        np.minimum(x, 80, out=x)
        np.exp(x, out=x)
        x += 1
        np.log(x, out=x)
        if at is None:
            out += x
        else:
            out[at] += x
    return out.astype(np.float64)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), fold_of(F.col("doc_id")).alias("fold"))


_END = int(spans(prefix(_BYTE[np.frombuffer(b" ", np.uint8)]), np.array([0]), np.array([1])).view(np.int64)[0])  # no word is a space


def passages(words: Words, every: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte and hash of each passage; they tile the texts, and the last one takes in the end. sums: the bytes' prefix."""
    cut = np.flatnonzero((words.hashes[:-1] % np.uint64(every) == 0) & (words.doc[1:] == words.doc[:-1])) + 1
    doc = np.concatenate([np.arange(len(words.off) - 1), words.doc[cut]])
    start = np.concatenate([words.off[:-1], words.start[cut]])
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    last = np.append(doc[1:] != doc[:-1], True)
    end = np.where(last, words.off[doc + 1], np.append(start[1:], 0))
    return doc, start, _mix(spans(sums, start, end) + np.where(last, np.uint64(2), np.uint64(1)))


def gains(copies: np.ndarray, score: np.ndarray, gate: float, total: int) -> np.ndarray:
    """What the table of passages adds to log10 of their probability by bits (score)."""
    if not gate:
        return np.zeros(len(score))
    out = np.full(len(score), np.log10(1 - gate))
    at = np.flatnonzero(copies > 0)
    found = np.log(gate * copies[at] / total) - score[at] * np.log(10)
    out[at] = np.logaddexp(np.log(1 - gate), found) / np.log(10)
    return out


def _counts(train: DataFrame, held: int, every: int) -> DataFrame:
    """Rows (h, c) of words and the end, rows (h, c, inner) of passages, inner in the fold `held`, and rows (byte, c); 256 stands for texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(257, np.int64)
        for batch in batches:
            for part in chunks(batch, most=_STEP):
                words = Words(part.column(1), lower=True)
                total[:256] += np.bincount(words.raw, minlength=256)
                total[256] += part.num_rows
                h, c = np.unique(words.hashes, return_counts=True)
                doc, _, keys = passages(words, every, prefix(_BYTE[words.raw]))
                keys, at, times = np.unique(keys, return_inverse=True, return_counts=True)
                inner = np.bincount(at, (part.column(2).to_numpy(zero_copy_only=False) == held)[doc], len(keys)).astype(np.int64)
                kind = np.repeat([False, True], [len(h) + 1, len(keys)])
                inner = np.concatenate([np.zeros(len(h) + 1, np.int64), inner])
                h, c = np.concatenate([h.view(np.int64), [_END], keys.view(np.int64)]), np.concatenate([c, [part.num_rows], times])
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(kind), pa.nulls(len(h), pa.int32()), pa.array(c), pa.array(inner)], ["h", "passage", "byte", "c", "inner"])
        yield pa.RecordBatch.from_arrays([pa.nulls(257, pa.int64()), pa.nulls(257, pa.bool_()), pa.array(np.arange(257, dtype=np.int32)), pa.array(total), pa.nulls(257, pa.int64())], ["h", "passage", "byte", "c", "inner"])

    rows = train.mapInArrow(tidy(run), "h long, passage boolean, byte int, c long, inner long")
    return rows.groupBy("h", "passage", "byte").agg(F.sum("c").alias("c"), F.sum("inner").alias("inner"))


def _context_counts(train: DataFrame, code: Code, held: int) -> dict[bool, np.ndarray]:
    """Counts of (context, symbol) cells, of the fold `held` and of the others."""
    shared = train.sparkSession.sparkContext.broadcast(code)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = shared.value
        totals = np.zeros((2, code.starts[-1]), np.uint32)
        flat = totals.ravel()
        for batch in batches:
            for part in chunks(batch, most=_STEP // 2):
                mine = part.column(2).to_numpy(zero_copy_only=False) == held
                s, cells, off, _ = symbols_of(part.column(1), code)
                add_to = s + np.repeat(np.where(mine, code.starts[-1], 0), np.diff(off))
                for c in cells:
                    np.add.at(flat, add_to + c, np.uint32(1))
        for t, total in enumerate(totals):
            for b in range(0, len(total), _BLOCK):
                at = np.flatnonzero(total[b : b + _BLOCK])
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array([t == 1]), pa.array([b], pa.int32()), pa.array([at.astype(np.uint16).tobytes()]), pa.array([total[b : b + _BLOCK][at].tobytes()])], ["held", "b", "at", "n"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(_BLOCK, np.int64)
        for at, n in zip(rows.column("at"), rows.column("n"), strict=True):
            x = np.frombuffer(n.as_py(), np.uint32 if len(n.as_py()) == 2 * len(at.as_py()) else np.int64)
            total[np.frombuffer(at.as_py(), np.uint16)] += x
        at = np.flatnonzero(total)
        return pa.table({"held": rows.column("held")[:1], "b": rows.column("b")[:1], "at": pa.array([at.astype(np.uint16).tobytes()]), "n": pa.array([total[at].astype(np.float32).tobytes()])})

    out = {k: np.zeros(code.starts[-1], np.float32) for k in (False, True)}
    # the cells' number is fixed by ORDERS and the code's tree
    for r in train.mapInArrow(tidy(run), "held boolean, b int, at binary, n binary").groupBy("held", "b").applyInArrow(add, "held boolean, b int, at binary, n binary").toLocalIterator():
        out[r.held][r.b + np.frombuffer(r.at, np.uint16).astype(np.int64)] = np.frombuffer(r.n, np.float32)
    return out


def _learned(fold: DataFrame, tables: np.ndarray, code: Code) -> Mixer:
    """Weights averaged over tasks by the bits that taught them; refinement counts added up."""
    shared = fold.sparkSession.sparkContext.broadcast((tables.astype(np.float16), code))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, tables = Mixer(tree=shared.value[1].tree), None
        for batch in batches:
            for part in chunks(batch, most=_STEP):
                tables = shared.value[0].astype(np.float32) if tables is None else tables
                s, cells, _, _ = symbols_of(part.column(1), shared.value[1])
                mixer.learn(s, cells, tables, shared.value[1])
        if tables is not None:
            w = np.concatenate([(mixer.weights * mixer.steps[:, None]).ravel(), mixer.steps, mixer.counts.ravel()])
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(w[at])], ["i", "x"])

    total = np.zeros(code.tree * (len(ORDERS) + 1 + 2 * _BUCKETS))
    rows = fold.mapInArrow(tidy(run), "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    total[rows.column("i").to_numpy()] = rows.column("x").to_numpy()
    n = code.tree * len(ORDERS)
    steps = total[n : n + code.tree]
    weights = np.where(steps[:, None] > 0, total[:n].reshape(code.tree, -1) / np.maximum(steps, 1)[:, None], 0.4)
    return Mixer(weights.astype(np.float32), total[n + code.tree :].reshape(2, code.tree, _BUCKETS))


def score_documents(documents: DataFrame, held_out: int = 2, inner: int = 6, common: int = 1 << 18, every: int = 16) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row.

    Learns from rows whose fold (fold_of) is not held_out. Null or empty text:
    the end alone; bits_per_byte is then null. A null doc_id is in the fold of
    the empty text. Without training rows all counts are 0 and the mixer keeps
    its start. Repeated rows count and score like others; further columns are
    ignored. common: words and passages whose counts are sent to every task; any
    other is at most one in `common` of all, so no task meets a hot one. every:
    words of a passage, on average.
    """
    with Tables(documents.sparkSession) as tables:
        return written(_scores(documents, tables, held_out, inner, common, every))


def _scores(documents: DataFrame, kept: Tables, held_out: int, inner: int, common: int, every: int) -> DataFrame:
    spark = documents.sparkSession
    texts = _texts(documents)
    train = texts.where(F.col("fold") != held_out)
    counts = kept.written(_counts(train, inner, every))
    keyed = counts.where("h IS NOT NULL").select("h", "c")
    byte_rows = counts.where("byte IS NOT NULL").select("byte", "c").toArrow()  # 257 rows
    bytes_ = np.zeros(257, np.int64)
    bytes_[byte_rows.column("byte").to_numpy()] = byte_rows.column("c").to_numpy()
    sums = [F.coalesce(F.sum(F.when(F.expr(on), F.col(x))), F.lit(0)) for x, on in (("c", "NOT passage"), ("c", "passage"), ("inner", "passage"), ("inner", "passage AND c > inner"))]
    n, n_passages, asked_inner, found_inner, v = counts.where("h IS NOT NULL").agg(*sums, F.count_if(~F.col("passage"))).first()
    gate = (found_inner + 0.5) / (asked_inner + 1) if n_passages else 0.0
    top = keyed.orderBy(F.desc("c"), "h").limit(common).toArrow().sort_by("h")
    known = spark.sparkContext.broadcast((top.column("h").to_numpy(), top.column("c").to_numpy().astype(np.int64)))

    code = Code(bytes_)
    cells = _context_counts(train, code, inner)
    mixer = _learned(train.where(F.col("fold") == inner), _tables(cells[False], code), code)
    tables = _tables(cells[False] + cells[True], code).reshape(-1, code.tree)
    for i, start in enumerate(code.starts[:-1] // code.tree):
        tables[start : start + (1 << code.orders[i])] *= mixer.weights[:, i]
    model = spark.sparkContext.broadcast((tables.ravel().astype(np.float16), mixer.refined(), code))

    def counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the hashes, and whether the common table has them."""
        h, c = known.value
        if not len(h):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        at = np.minimum(np.searchsorted(h, x.view(np.int64)), len(h) - 1)
        have = h[at] == x.view(np.int64)
        return np.where(have, c[at], 0), have

    columns = {"doc_id": pa.int64(), "row_key": pa.int64(), "h": pa.int64(), "place": pa.int64(), "x": pa.int64(), "bits": pa.float64(), "fold": pa.int32(), "n_tokens": pa.int64(), "seen": pa.int64(), "logs": pa.float64(), "score": pa.float64(), "n_bytes": pa.int64()}

    def out(**found) -> pa.RecordBatch:
        size = len(found["doc_id"])
        return pa.RecordBatch.from_arrays([pa.array(found[k], t) if k in found else pa.nulls(size, t) for k, t in columns.items()], list(columns))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row of each text (h null), and rows that ask for counts of its rare words and passages (bits null: a word)."""
        mixed, end = None, int(counted(np.array([_END]))[0][0])
        for batch in batches:
            for part in chunks(batch, most=_STEP // 2):
                mixed = model.value[0].astype(np.float32) if mixed is None else mixed
                _, refined, code = model.value
                s, cells, _, _ = symbols_of(part.column(1), code)
                words = Words(part.column(1), lower=True)
                whole = prefix(_BYTE[words.raw])
                keys, ids, fold = spans(whole, words.off[:-1], words.off[1:]).view(np.int64), part.column(0).to_numpy(zero_copy_only=False), part.column(2).to_numpy(zero_copy_only=False)
                c, have = counted(words.hashes)
                sums = np.concatenate([[0.0], np.cumsum(np.where(have, np.log10(c + 1.0), 0.0))])
                seen = np.concatenate([[0], np.cumsum(have & (c > 0))])
                a, b = words.first[:-1], words.first[1:]

                doc, start, h = passages(words, every, whole)
                bits = -np.add.reduceat(nats(s, cells, mixed, refined, code), start + doc) / np.log(10)
                order = np.lexsort((h, doc))
                new = first_of_runs(doc[order], h[order])
                run = np.cumsum(new) - 1
                own = np.empty(len(doc), np.int64)
                own[order] = np.bincount(run)[run]
                own[fold[doc] == held_out] = 0
                copies, there = counted(h)
                first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
                score = np.add.reduceat(bits + gains(copies - own, bits, gate, n_passages), first)
                yield out(doc_id=ids, row_key=keys, fold=fold, n_tokens=words.counts.astype(np.int64) + 1, seen=seen[b] - seen[a] + (end > 0), logs=sums[b] - sums[a] + np.log10(end + 1.0), score=score, n_bytes=np.diff(words.off))

                at = np.flatnonzero(~there)
                yield out(doc_id=ids[doc[at]], row_key=keys[doc[at]], h=h[at].view(np.int64), place=start[at] - words.off[doc[at]], x=own[at], bits=bits[at])
                at = np.flatnonzero(~have)
                at = at[np.lexsort((words.hashes[at], words.doc[at]))]
                new = np.flatnonzero(first_of_runs(words.doc[at], words.hashes[at]))
                times = np.diff(np.append(new, len(at)))
                at = at[new]
                yield out(doc_id=ids[words.doc[at]], row_key=keys[words.doc[at]], h=words.hashes[at].view(np.int64), place=np.zeros(len(at), np.int64), x=times.astype(np.int64))

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (0, 0)  # key and count
        before = None
        for batch in batches:
            h, ask, d, k, place, x, bits = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
            if not len(h):
                continue
            # a count stands before the texts that ask for it
            at = np.maximum.accumulate(np.where(ask == 0, np.arange(len(h)), -1))
            key = np.where(at >= 0, h[at], last[0])
            c = np.where(key == h, np.where(at >= 0, x[at], last[1]), 0)
            last = (int(key[-1]), int(c[-1]) if key[-1] == h[-1] else 0)
            once = first_of_runs(h, d, k, place) & (ask == 1)  # equal rows ask once
            if before == (h[0], d[0], k[0], place[0]):
                once[0] = False
            before = (h[-1], d[-1], k[-1], place[-1])
            word = np.isnan(bits)
            order = np.flatnonzero(once & (c > np.where(word, 0, x)))
            order = order[np.lexsort((k[order], d[order]))]
            if len(order):
                new = np.flatnonzero(first_of_runs(d[order], k[order]))
                word, c, x, bits = word[order], c[order], x[order], bits[order]
                more = np.where(word, 0.0, gains(np.where(word, 0, c - x), np.where(word, 0.0, bits), gate, n_passages) - gains(np.zeros(len(c)), bits, gate, n_passages))
                parts = (np.where(word, x, 0), np.where(word, x * np.log10(c + 1.0), 0.0), more)
                yield pa.RecordBatch.from_arrays([pa.array(d[order][new]), pa.array(k[order][new]), *(pa.array(np.add.reduceat(p, new)) for p in parts)], ["doc_id", "row_key", "seen", "logs", "gain"])

    names = {pa.int64(): "long", pa.int32(): "int", pa.float64(): "double"}
    rows = kept.written(texts.mapInArrow(tidy(scored), ", ".join(f"{k} {names[t]}" for k, t in columns.items())))
    zero = F.lit(0).cast("long")
    rare = keyed.select("h", F.lit(0).alias("ask"), zero.alias("doc_id"), zero.alias("row_key"), zero.alias("place"), F.col("c").alias("x"), F.lit(None).cast("double").alias("bits"))
    asking = rows.where("h IS NOT NULL").select("h", F.lit(1).alias("ask"), "doc_id", "row_key", "place", "x", "bits")
    answers = (
        rare.unionByName(asking)
        .repartition(partitions(spark), "h")
        .sortWithinPartitions("h", "ask", "doc_id", "row_key", "place")
        .mapInArrow(tidy(answered), "doc_id long, row_key long, seen long, logs double, gain double")
        .groupBy("doc_id", "row_key")
        .agg(F.sum("seen").alias("more_seen"), F.sum("logs").alias("more_logs"), F.sum("gain").alias("gain"))
    )
    total = float(n) + (v + 1)
    score = F.col("score") + F.coalesce("gain", F.lit(0.0))
    return (
        rows.where("h IS NULL")
        .select("doc_id", "row_key", "fold", "n_tokens", "seen", "logs", "score", "n_bytes")
        .join(answers, ["doc_id", "row_key"], "left")
        .select(
            F.when(F.col("doc_id") != LAST, F.col("doc_id")).alias("doc_id"),
            (F.col("fold") == held_out).alias("held_out"),
            "n_tokens",
            (F.col("seen") + F.coalesce("more_seen", F.lit(0))).alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(total))).alias("base_score"),
            score.alias("score"),
            F.when(F.col("n_bytes") > 0, -score * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
        )
    )


def op7(spark, sf_dir) -> DataFrame:
    """Scores of each document by the model and by unigrams."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
