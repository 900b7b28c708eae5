"""Size-aware heavy-light Jaccard join on word shingles, and its components.

Texts with the same shingle set are one class, joined once. For the classes:

* Every set is put in one global order, light shingles (rare ones) before
  heavy ones. Two sets of sizes n, m with Jaccard t or more share t * max(n, m)
  shingles, so their prefixes of n - ceil(t n) + k shingles share k of them.
  Where the first shingle shared stands at places i and j, the overlap is at
  most min(n - i, m - j); a list's pair that this rules out is no candidate.
* Small sets (size up to a boundary) enumerate all 2-subsets of that prefix
  with k = 2; two small sets that link have a subset in common.
* Large sets write inverted lists of their prefix with k = 1, which are
  scanned. Sets over t * boundary do so too, so that small meets large.
* The boundary is the size with the least cost: rows written, and candidates
  that they bring at `edge_cost` rows each. Both are measured by writing the
  lists and the subsets of a sample of the sets.

A list of m sets gives m - 1 star edges, not all pairs. A sketch of each set
bounds the overlap of a candidate exactly; what passes is checked with the
whole sets. Further candidates are taken only between sets that are
not connected yet: stars around other centres while that joins components, then
an eighth of the remaining pairs of a list across components, and last all of
them. So no link between
components is lost, and groups of near copies cost their size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import Tables, Words, _mix, bitmap, bits_for, chunks, components, first_of_runs, hits, partitions, passing, prefix, release, spans, text_bytes, tidy, written

_STEP = 4 << 20
#: Sizes over this are measured as one, as lists only.
_MOST_MEASURED = 256


class Sets:
    """Distinct shingle hashes of each text of a batch, in (doc, hash) order."""

    def __init__(self, texts: pa.Array, width: int):
        words = Words(texts, lower=True)
        at, h = words.windows(width)
        doc = words.doc[at]
        short = np.flatnonzero((words.counts > 0) & (words.counts < width))
        whole = spans(prefix(words.hashes), words.first[short], words.first[short + 1])
        doc, h = np.concatenate([doc, short]), np.concatenate([h, whole])
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        new = first_of_runs(doc, h)
        self.doc, self.hash = doc[new], h[new]
        self.counts = np.bincount(self.doc, minlength=len(texts))
        sums = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(_mix(self.hash), out=sums[1:])
        ends = np.cumsum(self.counts)
        #: one id for each set; equal sets have equal ids
        self.ids = _mix(sums[ends] - sums[ends - self.counts] + self.counts.astype(np.uint64))


def _need(n: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set of size n with any partner: ceil(percent / 100 * n)."""
    return -(-percent * n // 100)


def _docs(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _ordered(doc: np.ndarray, h: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each set in the global order: light shingles, then heavy ones, each by hash."""
    order = np.lexsort((_mix(h), hits(heavy, h), doc))
    return doc[order], h[order]


def _list_rows(place: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    return place < n - _need(n, percent) + 1


def _subset_rows(h: np.ndarray, place: np.ndarray, n: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the first and keys of each pair of the prefix with one shingle more; a set of one has no pair."""
    reach = np.minimum(n - _need(n, percent) + 2, n)
    for gap in range(1, int(reach.max(initial=0))):
        i = np.flatnonzero(place + gap < reach)
        yield i, _mix(h[i] * np.uint64(3) ^ _mix(h[i + gap]))


def _measured(sample: DataFrame, percent: int, heavy: np.ndarray) -> list[tuple[bool, int, int, float]]:
    """(subsets, size, rows, star edges) of the sample's lists and subsets by the size of the set."""
    shared = sample.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist()]
            n = np.array([len(x) for x in sets], np.int64)
            doc, h = _ordered(np.repeat(np.arange(len(n)), n), np.concatenate([*sets, np.zeros(0, np.uint64)]), shared.value)
            place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            n = n[doc]
            one = np.flatnonzero(_list_rows(place, n, percent))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(one), bool)), pa.array(h[one].view(np.int64)), pa.array(np.minimum(n[one], _MOST_MEASURED).astype(np.int32))], ["subsets", "key", "n"])
            small = n < _MOST_MEASURED
            for i, key in _subset_rows(h[small], place[small], n[small], percent):
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(i), bool)), pa.array(key.view(np.int64)), pa.array(n[small][i].astype(np.int32))], ["subsets", "key", "n"])

    keys = sample.mapInArrow(run, "subsets boolean, key long, n int").groupBy("subsets", "key", "n").agg(F.count("*").alias("c"))
    sizes = keys.groupBy("subsets", "key").agg(F.sum("c").alias("m"), F.collect_list(F.struct("n", "c")).alias("x"))  # 256 sizes at most
    return [tuple(r) for r in sizes.select("subsets", "m", F.explode("x").alias("x")).groupBy("subsets", "x.n").agg(F.sum("x.c"), F.sum(F.col("x.c") * (F.col("m") - 1) / F.col("m"))).collect()]  # 512 rows at most


def choose_boundary(measured: list[tuple[bool, int, int, float]], share: int, percent: int, edge_cost: float) -> int:
    """The set size up to which enumerating 2-subsets costs least, with what larger sets' lists then cost.

    A set of the sample stands for `share` sets and so meets `share` times the partners.
    """
    costs: dict[bool, dict[int, float]] = {False: {}, True: {}}
    for subsets, n, rows, edges in measured:
        costs[subsets][n] = rows + edge_cost * min(rows, share * edges)
    best, best_cost = 0, math.inf
    for x in [0, *sorted(costs[True])]:
        cost = sum(c for n, c in costs[True].items() if n <= x) + sum(c for n, c in costs[False].items() if 100 * n > percent * x)
        if cost < best_cost:
            best, best_cost = x, cost
    return best


def _postings(docs: DataFrame, width: int, percent: int, boundary: int, heavy: np.ndarray) -> DataFrame:
    """(key, sid, n, at): subsets of small sets and list entries of large ones; at is the place of the (first) shingle."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            for part in chunks(batch, most=_STEP):
                sets = Sets(part.column(1), width)
                fresh = np.zeros(len(sets.ids), bool)
                for i, s in enumerate(sets.ids.tolist()):  # copies in one task write once
                    if s not in known:
                        fresh[i] = True
                        known.add(s)
                if len(known) > 1_000_000:
                    known.clear()
                use = fresh[sets.doc]
                doc, h = _ordered(sets.doc[use], sets.hash[use], shared.value)
                n = sets.counts[doc]
                counts = np.where(fresh, sets.counts, 0)
                place = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                one = np.flatnonzero(_list_rows(place, n, percent) & (100 * n > percent * boundary))
                keys, rows = [h[one]], [one]
                small = np.flatnonzero(n <= boundary)
                for i, key in _subset_rows(h[small], place[small], n[small], percent):
                    keys.append(key)
                    rows.append(small[i])
                k, r = np.concatenate(keys), np.concatenate(rows)
                back = np.argsort(doc[r], kind="stable")  # neighbours of one set compress well
                k, r = k[back], r[back]
                d = doc[r]
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(sets.ids[d].view(np.int64)), pa.array(sets.counts[d].astype(np.int32)), pa.array(place[r].astype(np.int32))], ["key", "sid", "n", "at"])

    return docs.mapInArrow(tidy(run), "key long, sid long, n int, at int")


def _lists(postings: DataFrame, percent: int) -> DataFrame:
    """Lists of two sets or more: (key, sid, n, at, hub, hub_n, hub_at, two), hub the star's centre within reach of the size.

    two: the list has two sets and no more, so that its star is all of its pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, cut = None, None
        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if left is not None:
                rows = [np.concatenate(x) for x in zip(left, rows, strict=True)]
            k = rows[0]
            if not len(k):
                continue
            tail = int(np.searchsorted(k, k[-1]))
            if tail == 0 and len(k) < 1 << 22:  # a long list goes on in the next batch
                left = rows
                continue
            if tail == 0:  # cut, but its first set stays so that the parts share a centre
                yield from out(*rows, cut=k[-1])
                left, cut = [x[:1] for x in rows], k[-1]
                continue
            yield from out(*(x[:tail] for x in rows), cut=cut)
            left = [x[tail:] for x in rows]
        if left is not None:
            yield from out(*left, cut=cut)

    def out(k, s, n, at, cut):
        new = first_of_runs(k, s)
        k, s, n, at = k[new], s[new], n[new], at[new]
        head = first_of_runs(k)
        group = np.cumsum(head) - 1
        size = np.bincount(group, minlength=1)[group]
        many = size > 1
        two = (size == 2) & (k != cut) if cut is not None else size == 2
        k, s, n, at, head, two = k[many], s[many], n[many], at[many], head[many], two[many]
        if not len(k):
            return
        # sizes ascend in a list; a set out of the centre's reach becomes a centre
        centre = np.flatnonzero(head)
        while True:
            own = np.searchsorted(centre, np.arange(len(k)), "right") - 1
            far = percent * n.astype(np.int64) > 100 * n[centre][own].astype(np.int64)
            if not far.any():
                break
            first = np.flatnonzero(far)
            centre = np.union1d(centre, first[first_of_runs(own[first])])
        c = centre[own]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (k, s, n, at, s[c], n[c], at[c], two)], ["key", "sid", "n", "at", "hub", "hub_n", "hub_at", "two"])

    parts = partitions(postings.sparkSession)
    return postings.repartition(parts, "key").sortWithinPartitions("key", "n", "sid").mapInArrow(tidy(run), "key long, sid long, n int, at int, hub long, hub_n int, hub_at int, two boolean")


def _sketch(hashes: np.ndarray) -> bytes:
    """How many hashes fall into each of n / 2 to n buckets; empty if a count does not fit a byte.

    The sum of the lesser counts of two sketches is never under the overlap.
    """
    buckets = 1 << max(4, (len(hashes) // 2).bit_length())
    counts = np.bincount((hashes >> np.uint64(40)).astype(np.int64) & (buckets - 1), minlength=buckets)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def _most_common(x, y) -> int:
    """An upper bound of the overlap of two sketched sets."""
    if not len(x) or not len(y):  # a count that did not fit
        return 1 << 62
    x, y = (np.frombuffer(v, np.uint8) for v in sorted((x, y), key=len))
    if len(y) > len(x):
        y = y.reshape(-1, len(x)).sum(0, dtype=np.int64)  # coarser buckets are the low bits
    return int(np.minimum(x, y).sum(dtype=np.int64))


def _common(x, y) -> int:
    """The overlap of two sets of 64-bit hashes in ascending order."""
    low, high = (np.frombuffer(v, np.uint64) for v in sorted((x, y), key=len))
    at = np.searchsorted(high, low)
    return int((high[np.minimum(at, len(high) - 1)] == low).sum())


def _forms(docs: DataFrame, width: int, wanted: DataFrame, form) -> DataFrame:
    """(sid, items): form (a sketch or the whole set) of the wanted sets (sid, least).

    Only documents that may have the least id of a wanted set are read as words.
    """
    key = F.xxhash64(F.coalesce("least", F.lit(-1).cast("long")))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select(key.alias("key")), "key", bits_for(wanted.count())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(hits(shared.value, batch.column(2).to_numpy().view(np.uint64))))
            for part in chunks(batch, most=_STEP):
                sets = Sets(part.column(1), width)
                ends = np.cumsum(sets.counts)
                rows = np.flatnonzero(sets.counts > 0)
                items = [form(sets.hash[ends[i] - sets.counts[i] : ends[i]]) for i in rows.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(sets.ids[rows].view(np.int64)), pa.array(items, pa.binary())], ["sid", "items"])

    keyed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("doc_id", F.lit(-1).cast("long"))).alias("key"))
    return keyed.mapInArrow(tidy(run), "sid long, items binary").join(wanted.select("sid"), "sid", "left_semi").dropDuplicates(["sid"])


def _verified(pairs: DataFrame, forms: DataFrame, percent: int, common, tables: Tables) -> DataFrame:
    """The pairs (a, an, b, bn) of sets and sizes that common, the overlap of two forms (sid, items), lets link.

    Members of a large star are dealt to several tasks, each with the centre's form.
    """
    spark = pairs.sparkSession
    fans = pairs.groupBy("a").agg((F.count("*") / 512).cast("int").alias("fan")).where("fan > 0")
    if (large := fans.count()) <= 100_000:  # else Spark chooses, and splits skewed keys
        fans = F.broadcast(fans)
    part = F.pmod(F.xxhash64("b"), F.coalesce("fan", F.lit(0)) + 1).cast("int").alias("part")
    dealt = tables.written(pairs.join(fans, "a", "left").select("a", "an", "b", "bn", part)) if large else pairs.withColumn("part", F.lit(0))
    # a centre's form is copied to its parts before it meets the members
    copies = dealt.groupBy("a", "part").agg(F.first("an").alias("n")).join(forms.withColumnRenamed("sid", "a"), "a")
    members = dealt.select("a", "part", F.lit(True).alias("member"), "b", F.col("bn").alias("n")).join(forms.withColumnRenamed("sid", "b"), "b")
    rows = copies.select("a", "part", F.lit(False).alias("member"), F.lit(0).cast("long").alias("b"), "n", "items").unionByName(members.select("a", "part", "member", "b", "n", "items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, key, size = b"", None, 0
        for batch in batches:
            found = []
            raw, off = text_bytes(batch.column(5))  # sets stay in the batch's buffer
            off = off.tolist()
            for i, (a, part, member, b, n) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)):
                if not member:
                    centre, key, size = raw[off[i] : off[i + 1]].tobytes(), (a, part), n
                elif key == (a, part):
                    same = min(common(raw[off[i] : off[i + 1]], centre), n, size)
                    if 100 * same >= percent * (size + n - same):
                        found.append((a, size, b, n))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int64(), pa.int32()) * 2)], ["a", "an", "b", "bn"])

    return rows.repartition(partitions(spark), "a", "part").sortWithinPartitions("a", "part", "member", "b").mapInArrow(tidy(run), "a long, an int, b long, bn int")


def similar_components(documents: DataFrame, width: int = 5, percent: int = 80, share: int = 16, heavy: int = 2, edge_cost: float = 16.0, boundary: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of documents.

    A text of fewer than `width` words is one shingle; null, empty or blank
    text has none and links with nothing. component_id is the least doc_id
    that links reach. Rows of one doc_id with different texts are documents
    of their own under that id. Rows without doc_id are members, but name a
    component only where no member has an id (null). Further columns are
    ignored. Sets and their shingles are told apart by 64-bit hashes.

    share: heavy shingles (`heavy` times in it) and the costs are counted in
    the sets whose id is divisible by share; they decide what is cheap, never
    what links. edge_cost: a candidate took about 50 microseconds, a row 3, on
    0.5 GB. boundary: the largest small set, instead of the measured one.
    """
    with passing(documents.sparkSession), Tables(documents.sparkSession) as tables:
        return written(_components_of(_docs(documents), tables, width, percent, share, heavy, edge_cost, boundary))


def _components_of(docs: DataFrame, tables: Tables, width: int, percent: int, share: int, heavy: int, edge_cost: float, boundary: int | None) -> DataFrame:
    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, most=_STEP):
                sets = Sets(part.column(1), width)
                ends = np.cumsum(sets.counts)
                use = (sets.ids % np.uint64(share) == 0) & (sets.counts > 0)
                items = [sets.hash[e - n : e].tobytes() if u else None for u, e, n in zip(use.tolist(), ends.tolist(), sets.counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets.counts.astype(np.int64)), pa.array(sets.ids.view(np.int64)), pa.array(items, pa.binary())], ["doc_id", "n_shingles", "sid", "items"])

    first = tables.written(docs.mapInArrow(tidy(first_pass), "doc_id long, n_shingles long, sid long, items binary"))
    first_path = tables.paths[-1]
    members = tables.written(first.select("doc_id", "n_shingles", "sid"))
    classes = members.where("n_shingles > 0").groupBy("sid").agg(F.min("doc_id").alias("least"))
    sample = tables.written(first.where("items IS NOT NULL").select("sid", "items").dropDuplicates(["sid"]))
    sample_path = tables.paths[-1]
    tables.drop(first_path)

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, n = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], ["h", "n"])

    often = tables.written(sample.select("items").mapInArrow(shingles, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= heavy))
    often = bitmap(often, "h", bits_for(often.count()))
    if boundary is None:
        boundary = choose_boundary(_measured(sample, percent, often), share, percent, edge_cost)
    tables.drop(sample_path)  # the postings take the most disk: only what is still read stays beside them
    lists = tables.written(_lists(_postings(docs, width, percent, boundary, often), percent))
    release(docs.sparkSession)  # the shuffle of all postings
    wanted = tables.written(classes.join(lists.select("sid").distinct(), "sid", "left_semi"))
    sketches = tables.written(_forms(docs, width, wanted, _sketch))
    roots, roots_path = docs.sparkSession.createDataFrame([], "node long, root long"), None

    def check(pairs: DataFrame) -> bool:
        """Joins the components that links among the pairs, of different components, connect; whether there were any."""
        nonlocal roots, roots_path
        release(docs.sparkSession)
        ra, rb = (roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
        rooted = lambda df: df.join(ra, "a", "left").join(rb, "b", "left").withColumns({"ra": F.coalesce("ra", "a"), "rb": F.coalesce("rb", "b")})
        with Tables(docs.sparkSession) as own:  # the round's tables go with it
            near = own.written(_verified(own.written(pairs), sketches, percent, _most_common, own))
            if near.isEmpty():
                return False
            wholes = own.written(_forms(docs, width, wanted.join(near.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), "sid", "left_semi"), np.ndarray.tobytes))
            links = own.written(rooted(_verified(near, wholes, percent, _common, own)).select(F.col("ra").alias("a"), F.col("rb").alias("b")))
            if links.isEmpty():
                return False
            step = components(links, own)
            moved = roots.join(step.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
            fresh = step.join(roots.select("node"), "node", "left_anti").select("node", "root")
            roots, before = tables.written(moved.unionByName(fresh)), roots_path
            roots_path = tables.paths[-1]
        if before:
            tables.drop(before)
        return True

    check(_near(lists.where("hub <> sid").select(F.struct(F.col("hub").alias("sid"), F.col("hub_n").alias("n"), F.col("hub_at").alias("at")).alias("a"), F.struct("sid", "n", "at").alias("b")), percent))
    before, turn, first_part, left_path = math.inf, 0, False, None
    left = lists.where("NOT two").select("key", "sid", "n", "at")
    while True:
        # lists that still meet sets of several components; one that does not any more never will
        placed = left.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("many"), F.min_by(F.struct("sid", "n", "at", "root"), F.xxhash64("sid", "key", F.lit(turn))).alias("hub")).where("low <> high and many > 2")
        rest = tables.written(placed.join(mixed, "key").select("key", F.struct("sid", "n", "at").alias("own"), "root", "hub"))
        left, older, left_path = rest.select("key", "own.*"), left_path, tables.paths[-1]
        if older:
            tables.drop(older)
        # pairs across components, before those of several lists are told apart
        shares = rest.groupBy("key", "root").agg(F.count("*").alias("c")).groupBy("key").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("own"))
        size = shares.agg(F.sum("m").alias("rows"), F.sum((F.col("m") * F.col("m") - F.col("own")) / 2).alias("pairs")).first()
        if not size.rows:
            break
        # long lists: stars around other centres first, others in each list, as long as they spare a quarter of the pairs
        if size.pairs > 16 * size.rows and size.pairs <= 0.75 * before:
            check(_near(rest.where("root <> hub.root").select(F.col("hub").alias("a"), F.col("own").alias("b")), percent))
            before, turn = size.pairs, turn + 1
            continue
        sids = rest.select(F.col("own.sid").alias("sid")).distinct()
        twos = lists.where("two").groupBy("sid").agg(F.count("*").alias("twos")).join(sids, "sid", "left_semi")
        counted = rest.select("key", "own.*", "root").join(twos, "sid", "left").select("key", F.struct("sid", "n", "at", F.coalesce("twos", F.lit(0)).alias("twos")).alias("a"), "root")
        counted = tables.written(counted)
        other = counted.select("key", F.col("a").alias("b"), F.col("root").alias("rb"))
        pairs = counted.join(other, "key").where("a.sid < b.sid and root <> rb")
        part = F.pmod(F.xxhash64("a.sid", "b.sid"), F.lit(8))
        # an eighth of many pairs first: what it joins spares most of the others
        if size.pairs > 16 * size.rows and not first_part:
            check(_often(pairs.where(part == 0), percent, boundary))
            first_part = True
            continue
        check(_often(pairs.where(part > 0) if first_part else pairs, percent, boundary))
        break

    named = classes.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    best = named.groupBy("root").agg(F.min("least").alias("component_id"))
    own = named.join(best, "root").select("sid", "component_id")
    return members.join(own, "sid", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _near(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, an, b, bn): distinct pairs of a list's entries (sid, n, at) whose sizes and places allow a link."""
    most = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at")).cast("long")
    near = pairs.where((100 + percent) * most >= percent * (F.col("a.n") + F.col("b.n")))
    return near.select(F.col("a.sid").alias("a"), F.col("a.n").alias("an"), F.col("b.sid").alias("b"), F.col("b.n").alias("bn")).distinct()


def _often(pairs: DataFrame, percent: int, boundary: int) -> DataFrame:
    """(a, an, b, bn): distinct pairs of entries (sid, n, at, twos) whose sizes, places and number of common lists allow a link.

    pairs: of each list with three sets or more that has both; in lists of two
    they have been together min(twos) times at most. What two sets over the
    boundary share beyond their lists lies outside the prefix of the one whose
    prefix ends first, which leaves ceil(percent / 100 * n) - 1 shingles.
    """
    most = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at")).cast("long")
    ids = [F.col("a.sid").alias("a"), F.col("a.n").alias("an"), F.col("b.sid").alias("b"), F.col("b.n").alias("bn")]
    met = pairs.groupBy(*ids).agg(F.max(most).alias("most"), F.count("*").alias("lists"), F.min(F.least("a.twos", "b.twos")).alias("twos"))
    beyond = F.ceil(percent * F.greatest("an", "bn").cast("long") / 100) - 1
    small = F.least("an", "bn") <= boundary
    most = F.when(small, F.col("most")).otherwise(F.least("most", F.col("lists") + F.col("twos") + beyond))
    return met.where((100 + percent) * most >= percent * (F.col("an") + F.col("bn"))).select("a", "an", "b", "bn")


def op2(spark, sf_dir) -> DataFrame:
    """Set size and component of each document."""
    return similar_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT doc_id, hash(array_to_string(words[i:i + 4], ' ')) AS s FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)
  GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * same >= 80 * (x.n + y.n - same)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(c.b, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) c ON w.doc_id = c.a
"""
