"""Benchmark decontamination by latent semantic retrieval.

Documents are read as passages (windows of words). Term frequencies in
passages are counted over all documents; a randomised SVD of TF-IDF passages,
computed in Spark, gives the latent space. Every passage with a word of the
benchmark's vocabulary is projected and compared with the benchmark's passages
by the cosine in that vocabulary: rare words around an item must not hide it.
Projections are sums over words, so a word is projected once, into its block of
`stride` words, and a passage adds up its blocks' products with the targets.
Candidates around which enough words of that vocabulary stand are checked by
the longest common subsequence of words around the passage with the whole item;
a weaker match (a paraphrase) must also hold the item's answer, its last words.

The SVD is fitted on every passage: the right singular vectors need no more
than the sums of TF-IDF products of two terms of the benchmark over passages,
which one pass over all documents counts together with the frequencies. The
passages of the corpus weigh as `weigh` ones beside those of the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import Words, chunks, first_of_runs, scratch, tidy

TERM_BITS = 18
_TERMS = 1 << TERM_BITS
_STEP = 2 << 20
_SEARCH_STEP = 1 << 19  # so that sums over its blocks stay in the cache
_BLOCK = 1 << 16  # cells of a block of term pairs


def _terms(words: Words) -> np.ndarray:
    return (words.hashes & np.uint64(_TERMS - 1)).astype(np.int32)


def _starts(counts: np.ndarray, first: np.ndarray, width: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and end of each passage; the last one ends with its text."""
    rest = np.maximum(counts - width, 0)
    n = np.where(counts > 0, -(-rest // stride) + 1, 0)
    doc = np.repeat(np.arange(len(counts)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    begin = first[:-1][doc] + np.minimum(k * stride, rest[doc])
    return doc, begin, np.minimum(begin + width, first[1:][doc])


def _cells(docs: DataFrame, place: np.ndarray, width: int, dense_cells: int = 1 << 25, most: int = 1 << 22) -> DataFrame:
    """Sums over every passage of width words, in terms of the benchmark: rows (b, n) with n compressed.

    b = -1: passages with each term, occurrences of each term, and the number of
    passages. b >= 0: a block of rows of the table of term pairs (earlier, later)
    in one passage. A table of over dense_cells cells is added up sparsely, and
    handed on whenever that grows to over `most` cells.
    """
    v = int(place.max()) + 1
    rows = max(1, _BLOCK // v)
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def packed(b: list[int], sums: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array([pa.compress(x.astype(np.int64).tobytes(), "zstd", asbytes=True) for x in sums], pa.binary())], ["b", "n"])

    def blocks(codes: np.ndarray | None, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The table's blocks, from its cells in order, or from all cells (codes null)."""
        size = rows * v
        for b in range(-(-v // rows)):
            if codes is None:
                part = counts[b * size : (b + 1) * size]
            else:
                low, high = np.searchsorted(codes, [b * size, (b + 1) * size])
                part = np.zeros(min(size, v * v - b * size), np.int64)
                part[codes[low:high] - b * size] = counts[low:high]
            if part.any():
                yield packed([b], [part])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        having, times, total, pairs = np.zeros(v, np.int64), np.zeros(v, np.int64), 0, 0
        dense = np.zeros(v * v, np.uint32) if v * v <= dense_cells else None
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for part in chunks(batch, most=_STEP):
                words = Words(part.column(1))
                total += int((-(-words.counts // width)).sum())
                at = place[_terms(words)]
                have = np.flatnonzero(at >= 0)
                at = at[have].astype(np.int64)
                doc = words.doc[have]
                # a passage by its first word
                passage = words.first[:-1][doc] + (have - words.first[:-1][doc]) // width * width
                head = np.flatnonzero(first_of_runs(passage))
                nth = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
                again, later, found = np.zeros(len(at), bool), np.arange(len(at)), []
                for gap in range(1, width):
                    later = later[nth[later] >= gap]
                    if not len(later):
                        break
                    x, y = at[later - gap], at[later]
                    again[later[x == y]] = True
                    if dense is None:
                        found.append(x * v + y)
                    else:
                        np.add.at(dense, x * v + y, np.uint32(1))
                    pairs += len(later)
                having += np.bincount(at[~again], minlength=v)
                times += np.bincount(at, minlength=v)
                if found:
                    new, n = np.unique(np.concatenate(found), return_counts=True)
                    codes, back = np.unique(np.concatenate([codes, new]), return_inverse=True)
                    counts = np.bincount(back, np.concatenate([counts, n]), len(codes)).astype(np.int64)
                    if len(codes) > most:
                        yield from blocks(codes, counts)
                        codes, counts = codes[:0], counts[:0]
                if dense is not None and pairs > 1 << 31:  # before a cell can overflow
                    yield from blocks(None, dense)
                    dense[:], pairs = 0, 0
        yield from blocks(*((codes, counts) if dense is None else (None, dense)))
        yield packed([-1], [np.concatenate([having, times, [total]])])

    def add(part: pa.Table) -> pa.Table:
        b = part.column("b")[0].as_py()
        return pa.Table.from_batches([packed([b], [sum(_unpacked(x.as_py(), b, v) for x in part.column("n"))])])

    return docs.mapInArrow(tidy(run), "b int, n binary").groupBy("b").applyInArrow(add, "b int, n binary")


def _unpacked(n: bytes, b: int, v: int) -> np.ndarray:
    """Block b of the sums over v terms."""
    rows = max(1, _BLOCK // v)
    size = 2 * v + 1 if b < 0 else min(rows * v, v * v - b * rows * v)
    return np.frombuffer(pa.decompress(n, 8 * size, "zstd"), np.int64)


def _products(cells: DataFrame, omega: np.ndarray) -> np.ndarray:
    """(a + a') omega, a the table of term pairs."""
    v, block = len(omega), 1024
    rows = max(1, _BLOCK // v)
    tasks = min(64, 1 + (v * v >> 22))  # each hands on a sum as large as omega
    shared = cells.sparkSession.sparkContext.broadcast(omega)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        omega = shared.value
        total = np.zeros(omega.shape, np.float32)
        for batch in batches:
            for b, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = _unpacked(n, b, v).reshape(-1, v).astype(np.float32)
                own = slice(b * rows, b * rows + len(part))
                total += part.T @ omega[own]
                total[own] += part @ omega
        for b in range(0, v, block):
            if total[b : b + block].any():
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([total[b : b + block].tobytes()], pa.binary())], ["b", "sums"])

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in rows.column("sums"))
        return pa.table({"b": rows.column("b")[:1].cast(pa.int32()), "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    out = np.zeros(omega.shape, np.float32)
    for r in cells.where("b >= 0").coalesce(tasks).mapInArrow(run, "b int, sums binary").groupBy("b").applyInArrow(add, "b int, sums binary").collect():  # terms * rank numbers
        part = np.frombuffer(r.sums, np.float32).reshape(-1, omega.shape[1])
        out[r.b : r.b + len(part)] = part
    return out


class _Items:
    """The benchmark as the search needs it; sent to every task."""

    def __init__(self, ids: list[int], texts: list[str], width: int, stride: int):
        words = Words(pa.array(texts, pa.string()))
        self.ids = ids
        hashes = [words.hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        self.terms = [(w & np.uint64(_TERMS - 1)).astype(np.int32) for w in hashes]
        self.vocabulary = np.unique(words.hashes)
        self.words = [np.searchsorted(self.vocabulary, w) for w in hashes]
        self.sizes = np.array([len(w) for w in hashes], np.int64)
        self.owner, self.begin, self.end = _starts(words.counts, words.first, width, stride)
        self.begin, self.end = self.begin - words.first[self.owner], self.end - words.first[self.owner]
        self.masks = [self._masks(w) for w in self.words]
        # the masks of items of up to 64 words as one sorted table of (item, word)
        rows = sorted((i * len(self.vocabulary) + w, bits) for i, own in enumerate(self.masks) if len(self.words[i]) <= 64 for w, bits in own.items())
        self.keys, self.bits = np.array([k for k, _ in rows], np.int64), np.array([b for _, b in rows], np.uint64)
        # and as a table of all cells where that is small
        cells = np.zeros(len(self.ids) * len(self.vocabulary) if len(self.ids) * len(self.vocabulary) <= 1 << 21 else 0, np.uint64)
        if len(cells):
            cells[self.keys] = self.bits
        self.cells = cells
        self.answers = [w[-max(3, len(w) // 5) :] for w in self.words]
        self.answer_masks = [self._masks(w) for w in self.answers]

    def known(self, hashes: np.ndarray, perhaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that the benchmark has, among those that it may have, and how many of them stand before each word."""
        use = np.flatnonzero(perhaps)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes[use]), len(self.vocabulary) - 1)
        have = self.vocabulary[at] == hashes[use]
        mark = np.zeros(len(hashes), bool)
        mark[use[have]] = True
        return at[have], np.append(0, np.cumsum(mark))

    def _bits(self, key: np.ndarray) -> np.ndarray:
        """Masks of the items' words at the keys item * size of the vocabulary + word; none: 0."""
        if len(self.cells):
            return self.cells.take(key)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.bits[at], np.uint64(0))

    def _steps(self, rows: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray, numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """How many of the rows, long ones first, have a word t, and the masks of these words, for t = 0, 1 and so on."""
        base, start, length = item[rows] * len(self.vocabulary), low[rows], high[rows] - low[rows]
        many = len(rows) - np.cumsum(np.bincount(length))  # rows over t words
        for t in range(int(length[0])):
            n = int(many[t])
            yield n, self._bits(base[:n] + numbers.take(start[:n] + t))

    def enough(self, item: np.ndarray, low: np.ndarray, high: np.ndarray, numbers: np.ndarray, perhaps: float) -> np.ndarray:
        """Whether words low .. high - 1 of numbers can hold that share of the item: no subsequence is longer than its words among them."""
        out = np.zeros(len(item), bool)
        sizes = self.sizes[item]
        long = np.flatnonzero(sizes > 64)
        for rows in np.split(long[np.argsort(item[long], kind="stable")], np.flatnonzero(np.diff(np.sort(item[long]))) + 1) if len(long) else []:
            words, begin, end = self.words[item[rows[0]]], low[rows].min(), high[rows].max()
            member = np.zeros(len(self.vocabulary), bool)
            member[words] = True
            sums = np.append(0, np.cumsum(member[numbers[begin:end]]))
            out[rows] = sums[high[rows] - begin] - sums[low[rows] - begin] >= perhaps * len(words) - 1e-9
        rows = np.flatnonzero(sizes <= 64)
        rows = rows[np.argsort(low[rows] - high[rows], kind="stable")]
        if len(rows):
            covered = np.zeros(len(rows), np.uint64)  # words of the item that stand there
            for n, bits in self._steps(rows, item, low, high, numbers):
                covered[:n] |= bits
            out[rows] = np.bitwise_count(covered) >= perhaps * sizes[rows] - 1e-9
        return out

    def subsequences(self, item: np.ndarray, low: np.ndarray, high: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of each item with words low .. high - 1 of numbers, all rows word by word."""
        sizes = self.sizes[item]
        out = np.zeros(len(item), np.int64)
        for k in np.flatnonzero(sizes > 64).tolist():
            out[k] = common_subsequence(self.masks[item[k]], int(sizes[k]), numbers[low[k] : high[k]].tolist())
        rows = np.flatnonzero(sizes <= 64)
        rows = rows[np.argsort(low[rows] - high[rows], kind="stable")]  # long ones first
        if not len(rows):
            return out
        v = np.full(len(rows), ~np.uint64(0))
        for n, bits in self._steps(rows, item, low, high, numbers):
            u = v[:n] & bits
            v[:n] = (v[:n] + u) | (v[:n] - u)
        zeros = ~v & (~np.uint64(0) >> (np.uint64(64) - sizes[rows].astype(np.uint64)))
        out[rows] = np.bitwise_count(zeros)
        return out

    @staticmethod
    def _masks(words: np.ndarray) -> dict[int, int]:
        masks: dict[int, int] = {}
        for i, h in enumerate(words.tolist()):
            masks[h] = masks.get(h, 0) | 1 << i
        return masks


def common_subsequence(masks: dict[int, int], m: int, words: list[int]) -> int:
    """Length of the longest common subsequence, one big-integer step for each word."""
    full = (1 << m) - 1
    v = full
    for h in words:
        y = masks.get(h)
        if y:
            u = v & y
            v = ((v + u) | (v - u)) & full
    return m - v.bit_count()


def block_sums(at: np.ndarray, first: np.ndarray, counts: np.ndarray, stride: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of rows[at] over each text's blocks of stride words (at < 0: none), and the first block of each text."""
    blocks = -(-counts // stride)
    base = np.cumsum(blocks) - blocks
    known = np.flatnonzero(at >= 0)
    doc = np.repeat(np.arange(len(counts)), counts)[known]
    block = base[doc] + (known - first[:-1][doc]) // stride
    new = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, np.int64)
    have = np.zeros(int(blocks.sum()), np.int64)
    have[block[new]] = np.diff(np.append(new, len(block)))
    table = np.zeros((len(have), stride), np.int32)  # a block's known words stand in its first slots
    table[block, np.arange(len(block)) - np.repeat(new, have[block[new]])] = at[known]
    out = np.zeros((len(have), rows.shape[1]), np.float32)
    step = max(16, (1 << 17) // max(1, rows.shape[1]))
    part = np.empty((step, rows.shape[1]), np.float32)
    for k in range(0, len(have), step):
        order = np.argsort(-have[k : k + step], kind="stable")
        own, size = table[k : k + step][order], have[k : k + step][order]
        total = np.zeros((len(own), rows.shape[1]), np.float32)
        for j in range(stride):
            n = int((size > j).sum())
            if not n:
                break
            np.take(rows, own[:n, j], axis=0, out=part[:n], mode="clip")
            total[:n] += part[:n]
        out[k + order] = total
    return out, base


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    width: int = 32,
    stride: int = 8,
    rank: int = 256,
    cosine: float = 0.33,
    sure: float = 0.7,
    perhaps: float = 0.5,
    weigh: float = 8192.0,
    block: int = 10_000,
) -> DataFrame:
    """One row (doc_id, item_id, cosine, lcs_share, answer_found) for each document that holds an item.

    Words are compared in lower case. Items without words match
    nothing; nor does null or empty text. A document holds an item if the
    common subsequence has `sure` of the item's words, or `perhaps` of them and
    four fifths of its answer. Repeated rows of one doc_id give one row, with
    the best match. The benchmark is searched in blocks of `block` items, so
    what is sent to tasks is bounded. Further columns are ignored.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text")).where("text <> ''")
    out, last = None, None
    while True:
        rows = (items if last is None else items.where(F.struct("item_id", "text") > F.struct(F.lit(last[0]).cast("long"), F.lit(last[1])))).orderBy("item_id", "text").limit(block).collect()
        if any(r.text.strip("\t\n\v\f\r ") for r in rows):
            found = _search(docs, _Items([r.item_id for r in rows], [r.text for r in rows], width, stride), width, stride, rank, cosine, sure, perhaps, weigh)
            out = found if out is None else out.unionByName(found)
        if len(rows) < block:
            break
        last = rows[-1]
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, cosine double, lcs_share double, answer_found boolean")
    return out.groupBy("doc_id", "item_id").agg(F.max(F.struct("lcs_share", "answer_found", "cosine")).alias("x")).select("doc_id", "item_id", "x.cosine", "x.lcs_share", "x.answer_found")


def _search(docs, items, width, stride, rank, cosine, sure, perhaps, weigh) -> DataFrame:
    spark = docs.sparkSession
    used = np.unique(np.concatenate(items.terms))
    place = np.full(_TERMS, -1, np.int32)
    place[used] = np.arange(len(used))
    cells = scratch(_cells(docs, place, width))
    seen = sum((_unpacked(bytes(r.n), -1, len(used)) for r in cells.where("b < 0").collect()), np.zeros(2 * len(used) + 1, np.int64))  # one row, or none
    having, times, total = seen[: len(used)], seen[len(used) : -1], int(seen[-1])
    weight = (np.log((total + 1) / (having + 1)) + 0.1).astype(np.float32)
    share = min(1.0, weigh / max(1, total))
    # the benchmark's passages count more, so that the space keeps what tells them apart
    own = [place[items.terms[o][b:e]] for o, b, e in zip(items.owner, items.begin, items.end, strict=True)]

    def gram(omega: np.ndarray) -> np.ndarray:
        """Sum of a'(a omega) over TF-IDF rows a."""
        weighted = weight[:, None] * omega
        out = np.float32(share) * (_products(cells, weighted) + times.astype(np.float32)[:, None] * weighted)
        for at in own:
            np.add.at(out, at, 16 * weighted[at].sum(0)[None, :])
        return weight[:, None] * out

    rank = min(rank, len(used))
    basis = np.random.default_rng(7).standard_normal((len(used), rank)).astype(np.float32)
    for _ in range(2):  # range finder with one power iteration
        basis = np.linalg.qr(gram(basis))[0].astype(np.float32)
    values, vectors = np.linalg.eigh(basis.T @ gram(basis))
    space = (basis @ vectors[:, ::-1]).astype(np.float32)  # right singular vectors, largest first
    projected = np.zeros((len(used) + 1, rank), np.float32)
    projected[:-1] = space * weight[:, None]  # row -1: words outside the benchmark
    targets = np.stack([projected[place[items.terms[o][b:e]]].sum(0) for o, b, e in zip(items.owner, items.begin, items.end, strict=True)]) if len(items.owner) else np.zeros((0, rank), np.float32)
    # a passage scores against what the space keeps of the target, so that an equal passage scores 1
    norms = [float((weight[place[items.terms[o][b:e]]].astype(np.float64) ** 2).sum()) ** 0.5 for o, b, e in zip(items.owner, items.begin, items.end, strict=True)]
    targets = targets / np.maximum((targets * targets).sum(1), 1e-9)[:, None] * np.array(norms, np.float32)[:, None]
    squares = np.append(weight, 0).astype(np.float64) ** 2
    # few targets: each word's products with them, which a passage adds up
    direct = len(used) * len(targets) <= 1 << 22
    table = projected[:-1] @ targets.T if direct else projected[:-1]
    shared = spark.sparkContext.broadcast((items, squares, place, table, None if direct else targets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, squares, place, table, targets = shared.value
        sizes, many = items.sizes, max(1, width // stride)
        for batch in batches:
            for part in chunks(batch, most=_SEARCH_STEP):
                words = Words(part.column(1))
                terms = _terms(words)
                if not len(terms):
                    continue
                at = place[terms]
                sums = np.zeros(len(at) + 1)
                np.cumsum(squares[at], out=sums[1:])
                numbers, before = items.known(words.hashes, at >= 0)
                blocks, base = block_sums(at, words.first, words.counts, stride, table)
                # a passage starts at each block and takes `many`, as far as its text goes
                n = -(-words.counts // stride)
                doc = np.repeat(np.arange(len(n)), n)
                begin = words.first[:-1][doc] + (np.arange(len(doc)) - base[doc]) * stride
                end = np.minimum(begin + many * stride, words.first[1:][doc])
                known = sums[end] - sums[begin]
                found = []
                step = max(16, (1 << 21) // len(items.owner))
                for k in range(0, len(doc), step):
                    own = np.arange(k, min(k + step, len(doc)))
                    product = blocks[k : k + step + many - 1]
                    product = product if targets is None else product @ targets.T
                    scores = product[: len(own)].copy()
                    for m in range(1, many):
                        use = max(0, min(len(own), len(product) - m))
                        scores[:use] += product[m : m + use]
                        other = np.flatnonzero(doc[k + m : k + m + use] != doc[k : k + use])  # the next text's blocks
                        scores[other] -= product[other + m]
                    i, j = np.divmod(np.flatnonzero(scores >= (cosine * np.sqrt(np.maximum(known[own], 1e-9))).astype(np.float32)[:, None]), scores.shape[1])
                    w, item = own[i], items.owner[j]
                    m = sizes[item]
                    low, high = before[np.maximum(words.first[:-1][doc[w]], begin[w] - m)], before[np.minimum(words.first[1:][doc[w]], end[w] + m)]
                    enough = (known[w] > 0) & items.enough(item, low, high, numbers, perhaps)
                    found.append([x[enough] for x in (doc[w], item, low, high, scores[i, j] / np.sqrt(np.maximum(known[w], 1e-9)))])
                of, item, low, high, value = (np.concatenate(x) for x in zip(*found, strict=True))
                shares = items.subsequences(item, low, high, numbers) / np.maximum(sizes[item], 1)
                best: dict[tuple[int, int], tuple] = {}
                ids = part.column(0).to_pylist()
                some = np.flatnonzero(shares >= perhaps)
                for d, j, a, b, share, x in zip(*(v[some].tolist() for v in (of, item, low, high, shares, value)), strict=True):
                    n = len(items.answers[j])
                    answer = common_subsequence(items.answer_masks[j], n, numbers[a:b].tolist()) >= 0.8 * n
                    if share >= sure or answer:
                        best[d, j] = max(best.get((d, j), (0.0, False, 0.0)), (share, answer, x))
                if best:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[d] for d, _ in best], pa.int64()), pa.array([items.ids[i] for _, i in best], pa.int64()), *(pa.array([x[n] for x in best.values()], t) for n, t in ((2, pa.float64()), (0, pa.float64()), (1, pa.bool_())))],
                        ["doc_id", "item_id", "cosine", "lcs_share", "answer_found"],
                    )

    return docs.mapInArrow(tidy(run), "doc_id long, item_id long, cosine double, lcs_share double, answer_found boolean")


def op6(spark, sf_dir) -> DataFrame:
    """The documents that hold benchmark items, with the match."""
    documents, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return find_leaks(documents, benchmark)
