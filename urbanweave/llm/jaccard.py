"""n-gram Jaccard join: documents whose sets of word shingles overlap enough, found by T-occurrence search with DivideSkip.

Exact for the whole table: two documents link when ``100 * common >= threshold * union``.

1. *Signatures.* A set's 128-bit signature groups its copies; the smallest id stands for them.
2. *Shared shingles.* Every task cuts its sets into chunks and sends each distinct shingle once, packed as six bytes, to the bucket of
   its hash, where shingles of two chunks meet; those that two texts of a chunk hold need no meeting, so a shingle of a third of
   all rows is sent once per chunk. What is shared goes back to its chunk, and a set survives if at least ``ceil(t * n)`` of its
   shingles are shared. A set below that can't link with anything. Hash collisions only let more sets survive.
3. *Candidates.* Among surviving sets the shingles are counted again, exactly. Every pair above the threshold shares one of the
   ``n - ceil(t * n) + 1`` rarest shingles of each set. Sets that share such a shingle are tied to the smallest of them: rows in
   proportion to the prefixes, never all pairs, by an aggregate and a join that AQE can split.
   *Clusters* are the connected components of these ties; all links lie inside one. A cluster is cut into parts of about
   :data:`PART` shingles by a hash of the node; each part is an inverted index in one task, and the nodes of later parts
   pass by it as queries. So the memory of a task is bounded, and a large group is worked on by many tasks.
4. *T-occurrence.* A query of ``n`` shingles needs ``T = ceil(t * n)`` of them in a partner, and a partner has ``t * n`` to ``n / t`` of its own.
   Sets are numbered by size, so each list skips by binary search to the owners of such sizes. The ``L`` longest lists are set
   aside; the short ones, ascending runs of owners, are merged (a stable merge sort of the runs, so the cost follows what is read), and
   owners met at least ``T - L`` times are probed in all long lists by binary search. The exact overlap decides. Documents already tied to the most central one of a part need no query of their own. Only links
   that join two groups inside a part leave the task: enough for components, in proportion to the nodes.
5. *Components* of the links, and back from nodes to all documents.

Defined cases: null and empty texts, or texts of white space only, have an empty set, link with nothing and are their own component; a
text of fewer words than a shingle is one shingle; repeated rows and rows with one id are one node of the graph; a row without id
gets the component of texts with an equal set, or null; an empty table gives an empty table; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanweave.llm.components import components
from urbanweave.llm.kernels import BROAD, Flat, distinct_in_owner, lists, mix, pieces, signed
from urbanweave.llm.shared import fresh, saved

#: Shingles in an index part (8 MB, about 100 MB while it is built).
PART = 1 << 20
#: Shingles in a chunk, and mean shingles in a bucket, however many there are.
CHUNK = 1 << 20
BUCKET = 1 << 17
#: Cluster members up to which their list is broadcast, and not joined by a shuffle of the texts.
MEMBERS = 1 << 20


def shingle_sets(flat: Flat, length: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within a text, and their number for each text."""
    words = flat.words(BROAD)
    hashes = words.hashes()
    at, found = words.windows(hashes, length)
    owner = np.searchsorted(words.first, at, side="right") - 1
    short = np.flatnonzero((words.counts > 0) & (words.counts < length))
    if len(short):
        found = np.concatenate([found, words.runs(hashes, words.first[short], words.first[short + 1])])
        owner = np.concatenate([owner, short])
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    keep = distinct_in_owner(owner, found)
    return found[keep], np.bincount(owner[keep], minlength=len(flat))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def signatures(found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set, independent of order."""
    return _sums(mix(found), counts), _sums(mix(found ^ np.uint64(0xA0761D6478BD642F)), counts)


def set_table(docs: DataFrame, doc: str, text: str, length: int) -> DataFrame:
    """``(doc, n, s1, s2)`` of every row: size and signature of its set."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, flat in pieces(batch.column(1)):
                found, counts = shingle_sets(flat, length)
                s1, s2 = signatures(found, counts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(flat)), pa.array(counts.astype(np.int64)), pa.array(signed(s1)), pa.array(signed(s2))],
                                                 names=["doc", "n", "s1", "s2"])

    return docs.select(F.col(doc).cast("long"), F.col(text).cast("string")).mapInArrow(measure, "doc long, n long, s1 long, s2 long")


#: Rows of the exchange of shingles. Kind 0: signatures and sizes of the sets of a chunk. Kind 1: distinct shingles of a chunk in a
#: bucket (32 bits below the bucket's) and the set each came from. Kind 2: shared shingles of a chunk, bucket included.
PACKED = "goal long, kind int, chunk long, codes binary, owners binary"
#: Owner of a shingle that several sets of its chunk hold.
SEVERAL = 0xFFFF


def _packed(rows: list[tuple[int, int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64()),
                                       pa.array([r[3].tobytes() for r in rows], pa.binary()), pa.array([r[4].tobytes() for r in rows], pa.binary())],
                                      names=["goal", "kind", "chunk", "codes", "owners"])


def _chunk_rows(chunk: int, found: np.ndarray, owner: np.ndarray, s1: np.ndarray, sizes: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    order = np.argsort(found, kind="stable")
    found, owner = found[order], owner[order]
    head = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    times = np.diff(np.append(head, len(found)))
    several = np.repeat(times > 1, times)
    codes = found >> np.uint64(32 - bits)
    rows = [(chunk, 0, chunk, s1, sizes), (chunk, 2, chunk, codes[several], owner[several].astype(np.uint16))]
    codes, holder = codes[head], np.where(times > 1, SEVERAL, owner[head]).astype(np.uint16)
    bucket = (codes >> np.uint64(32)).astype(np.int64)
    edge = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(bucket))
    low = codes.astype(np.uint32)
    rows += [(int(bucket[a]), 1, chunk, low[a:b], holder[a:b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
    for lo in range(0, len(rows), 256):
        yield _packed(rows[lo:lo + 256])


def surviving_sets(docs: DataFrame, text: str, length: int, threshold: int, bits: int) -> DataFrame:
    """``(s1, n, codes)``: sets of which enough shingles are held by other sets (or by copies), with those shingles."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        held: list[tuple[np.ndarray, ...]] = []
        seen: set[int] = set()
        size = 0
        for batch in batches:
            for _, flat in pieces(batch.column(0)):
                found, counts = shingle_sets(flat, length)
                s1 = signatures(found, counts)[0]
                new = np.zeros(len(s1), bool)
                for k, key in enumerate(s1.tolist()):
                    if counts[k] and key not in seen:
                        seen.add(key)
                        new[k] = True
                held.append((found[np.repeat(new, counts)], counts[new], s1[new]))
                size += len(held[-1][0])
                if size >= CHUNK or len(seen) >= SEVERAL - 10_000:
                    yield from flush(chunk, held)
                    chunk, held, seen, size = chunk + 1, [], set(), 0
        if size:
            yield from flush(chunk, held)

    def flush(chunk: int, held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        found, counts, s1 = (np.concatenate(x) for x in zip(*held, strict=True))
        for lo in range(0, len(counts), SEVERAL):  # an owner is a number of 16 bits
            own = slice(lo, lo + SEVERAL)
            first, last = int(counts[:lo].sum()), int(counts[:lo + SEVERAL].sum())
            yield from _chunk_rows((chunk << 8) + lo // SEVERAL, found[first:last], np.repeat(np.arange(len(counts[own])), counts[own]), s1[own], counts[own].astype(np.int64), bits)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            rows = []
            for goal, kind, chunk, codes, owners in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind != 1:
                    rows.append((goal, kind, chunk, np.frombuffer(codes, np.uint64), np.frombuffer(owners, np.uint8)))
                    continue
                if goal != bucket:
                    rows += shared_in(bucket, held)
                    bucket, held = goal, []
                held.append((chunk, np.frombuffer(codes, np.uint32), np.frombuffer(owners, np.uint16)))
            yield _packed(rows)
        yield _packed(shared_in(bucket, held))

    def shared_in(bucket: int | None, held: list[tuple[int, np.ndarray, np.ndarray]]) -> list[tuple]:
        if len(held) < 2:
            return []
        codes = np.concatenate([h[1] for h in held])
        order = np.argsort(codes, kind="stable")
        ordered = codes[order]
        same = ordered[1:] == ordered[:-1]
        shared = np.zeros(len(codes), bool)
        shared[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        out, at = [], 0
        for chunk, own, owners in held:
            keep = shared[at:at + len(own)] & (owners != SEVERAL)
            at += len(own)
            if keep.any():
                out.append((chunk, 2, chunk, own[keep].astype(np.uint64) | np.uint64(bucket << 32), owners[keep]))
        return out

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, s1, sizes, held = None, None, None, []
        for batch in batches:
            for _, kind, own, codes, owners in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != chunk:
                    if chunk is not None:
                        yield survivors(s1, sizes, held)
                    chunk, held = own, []
                if kind == 0:
                    s1, sizes = np.frombuffer(codes, np.uint64), np.frombuffer(owners, np.int64)
                else:
                    held.append((np.frombuffer(codes, np.uint64), np.frombuffer(owners, np.uint16)))
        if chunk is not None:
            yield survivors(s1, sizes, held)

    def survivors(s1: np.ndarray, sizes: np.ndarray, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        codes, owner = (np.concatenate(x) for x in zip(*held, strict=True))
        counts = np.bincount(owner, minlength=len(sizes))
        enough = 100 * counts >= threshold * sizes
        keep = enough[owner]
        codes, owner = codes[keep], owner[keep]
        order = np.argsort(owner, kind="stable")
        return pa.RecordBatch.from_arrays([pa.array(signed(s1[enough])), pa.array(sizes[enough]), lists(signed(codes[order]), counts[enough])], names=["s1", "n", "codes"])

    sent = docs.select(F.col(text).cast("string")).mapInArrow(send, PACKED)
    met = sent.repartition("goal", "kind").sortWithinPartitions("kind", "goal").mapInArrow(meet, PACKED)
    return met.repartition("chunk").sortWithinPartitions("chunk", "kind").mapInArrow(judge, "s1 long, n long, codes array<long>")


def candidate_ties(survivors: DataFrame, threshold: int) -> DataFrame:
    """``(a, b)``: pairs of signatures whose components hold all pairs that may link."""
    sets = survivors.groupBy("s1").agg(F.first("n").alias("n"), F.first("codes").alias("codes"))
    held = saved(sets.select("s1", "n", F.explode("codes").alias("code")), "shared-shingles")
    often = held.groupBy("code").agg(F.count(F.lit(1)).alias("times"), F.min("s1").alias("b")).where("times > 1").select(F.col("code").alias("of"), "times", "b")
    met = held.join(often, F.col("code") == F.col("of")).select("s1", "n", "code", "times", "b")
    whole = Window.partitionBy("s1")
    ranked = met.withColumn("m", F.count(F.lit(1)).over(whole)).withColumn("rank", F.row_number().over(whole.orderBy("times", "code")))
    # the n - m shingles that no other surviving set holds come first in the order
    least = F.expr(f"n - ({threshold} * n + 99) div 100 + 1 - (n - m)")
    chosen = saved(ranked.where((F.col("rank") <= least) & (F.col("m") * 100 >= F.col("n") * threshold)).select("s1", "code"), "prefixes")
    heads = chosen.groupBy("code").agg(F.min("s1").alias("b"), F.max("s1").alias("last")).where("b < last").select(F.col("code").alias("of"), "b")
    return chosen.join(heads, F.col("code") == F.col("of")).where("s1 <> b").select(F.col("s1").alias("a"), "b").distinct()


class Part:
    """Inverted index over the sets of one part of a cluster, with the groups found so far. Sets are numbered by size."""

    def __init__(self, nodes: list[int], sets: list[np.ndarray], threshold: int):
        by_size = np.argsort([len(s) for s in sets], kind="stable").tolist()
        self.nodes, self.sets, self.threshold = [nodes[k] for k in by_size], [sets[k] for k in by_size], threshold
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        values = np.concatenate(self.sets)
        order = np.argsort(values, kind="stable")  # owners ascend in each list
        values = values[order]
        owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        self.shingles = values[self.start]
        self.length = np.diff(np.append(self.start, len(values)))
        #: All lists, one after the other, as ascending numbers: list and owner.
        self.placed = np.repeat(np.arange(len(self.start)), self.length) * len(sets) + owner
        self.group = list(range(len(sets)))

    def _lists(self, own: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.shingles, own), len(self.shingles) - 1)
        return at[self.shingles[at] == own]

    def _merged(self, at: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Owners ``first:last`` in these lists, ascending, and in how many of the lists each is."""
        count = len(self.sets)
        lo, hi = np.searchsorted(self.placed, at * count + first), np.searchsorted(self.placed, at * count + last)
        length = hi - lo
        ends = np.cumsum(length)
        if not len(at) or not ends[-1]:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        owners = self.placed[np.repeat(lo - (ends - length), length) + np.arange(ends[-1])] - np.repeat(at * count, length)
        owners.sort(kind="stable")
        head = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]]))
        return owners[head], np.diff(np.append(head, len(owners)))

    def _probed(self, at: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """In how many of these lists each owner is, by binary search."""
        wanted = at[:, None] * len(self.sets) + owners
        place = np.minimum(np.searchsorted(self.placed, wanted), len(self.placed) - 1)
        return (self.placed[place] == wanted).sum(axis=0)

    def _enough(self, n: int, common: np.ndarray, others: np.ndarray) -> np.ndarray:
        return 100 * common >= self.threshold * (n + self.sizes[others] - common)

    def search(self, own: np.ndarray) -> np.ndarray:
        """Positions of all documents that link with a set."""
        n = len(own)
        need = -(-self.threshold * n // 100)
        first, last = np.searchsorted(self.sizes, need), np.searchsorted(self.sizes, 100 * n // self.threshold, side="right")
        at = self._lists(own)
        if len(at) < need or first >= last:
            return np.empty(0, np.int64)
        at = at[np.argsort(self.length[at], kind="stable")]
        aside = min(need - 1, int(need / (0.05 * np.log2(self.length[at[-1]] + 1) + 1)))
        owners, common = self._merged(at[:len(at) - aside], first, last)
        near = common >= need - aside
        owners, common = owners[near], common[near]
        if len(owners) and aside:
            common = common + self._probed(at[len(at) - aside:], owners)
        return owners[self._enough(n, common, owners)]

    def _root(self, k: int) -> int:
        while self.group[k] != k:
            self.group[k] = self.group[self.group[k]]
            k = self.group[k]
        return k

    def inner_links(self) -> list[tuple[int, int]]:
        """Links that join all documents of the part that any links join."""
        owner = self.placed % len(self.sets)
        weight = np.bincount(owner, weights=np.repeat(self.length, self.length), minlength=len(self.sets))
        central = int(np.argmax(weight / self.sizes))
        owners, common = self._merged(self._lists(self.sets[central]), 0, len(self.sets))
        tied = np.zeros(len(self.sets), bool)
        tied[owners[self._enough(len(self.sets[central]), common, owners)]] = True
        out = []
        for k in np.flatnonzero(tied).tolist():
            if k != central:
                self.group[k] = central
                out.append((self.nodes[k], self.nodes[central]))
        rest = np.flatnonzero(~tied).tolist()
        for k in rest if len(self.sets) > 2 else ():
            for other in self.search(self.sets[k]).tolist():
                a, b = self._root(k), self._root(other)
                if a != b:
                    self.group[a] = b
                    out.append((self.nodes[k], self.nodes[other]))
        return out

    def outer_links(self, node: int, own: np.ndarray) -> list[tuple[int, int]]:
        """For a set of another part: one link to each group of this part that it links with."""
        groups: dict[int, int] = {}
        for k in self.search(own).tolist():
            groups.setdefault(self._root(k), k)
        return [(node, self.nodes[k]) for k in groups.values()]


def verified_links(members: DataFrame, docs: DataFrame, doc: str, text: str, length: int, threshold: int) -> DataFrame:
    """``(a, b)``: links inside clusters. ``members`` has ``(node, cluster, n)``."""
    members = saved(members, "members")
    sizes = members.groupBy("cluster").agg(F.ceil(F.sum("n") / PART).cast("int").alias("parts")).select(F.col("cluster").alias("of"), "parts")
    placed = members.join(sizes, F.col("cluster") == F.col("of")).select("node", "cluster", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    if members.count() <= MEMBERS:
        placed = F.broadcast(placed)
    met = docs.select(F.col(doc).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).join(placed, F.col("doc") == F.col("node"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, flat in pieces(batch.column(3)):
                found, counts = shingle_sets(flat, length)
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(at, len(flat)) for k in range(3)], lists(signed(found), counts)],
                                                 names=["node", "cluster", "part", "shingles"])

    sets = met.select("node", "cluster", "part", "text").mapInArrow(cut, "node long, cluster long, part int, shingles array<long>")
    sent = sets.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("part")))).withColumn("asks", F.col("to") < F.col("part"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets, part = None, [], [], None
        for batch in batches:
            out: list[tuple[int, int]] = []
            clusters, to, asks, node = (batch.column(k).to_pylist() for k in range(4))
            values = batch.column(4)
            flat, first = values.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(values.value_lengths().to_numpy())])
            for k in range(batch.num_rows):
                own = flat[first[k]:first[k + 1]]
                if (clusters[k], to[k]) != key:
                    if part is None and len(nodes) > 1:
                        out += Part(nodes, sets, threshold).inner_links()
                    key, nodes, sets, part = (clusters[k], to[k]), [], [], None
                if not asks[k]:
                    nodes.append(node[k])
                    sets.append(own)
                elif nodes:
                    if part is None:
                        part = Part(nodes, sets, threshold)
                        out += part.inner_links()
                    out += part.outer_links(node[k], own)
            sets = [s.copy() for s in sets]  # keep no batch alive
            yield _pairs(out)
        if part is None and len(nodes) > 1:
            yield _pairs(Part(nodes, sets, threshold).inner_links())

    dealt = sent.select("cluster", "to", "asks", "node", "shingles").repartition("cluster", "to").sortWithinPartitions("cluster", "to", "asks", "node")
    return dealt.mapInArrow(search, "a long, b long")


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(rows, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def near_groups(docs: DataFrame, doc: str = "doc_id", text: str = "text", length: int = 5, threshold: int = 75) -> DataFrame:
    """``(doc, n_shingles, component_id)`` of every row: the smallest id reachable by links of at least ``threshold`` percent."""
    sets = saved(set_table(docs, doc, text, length), "sets")
    total = sets.agg(F.sum("n")).first()[0] or 0
    bits = min(32, max(6, int(total // BUCKET).bit_length()))  # codes have 32 bits below the bucket's
    survivors = saved(surviving_sets(docs, text, length, threshold, bits), "survivors")
    clusters = components(candidate_ties(survivors, threshold))
    named = sets.where("n > 0 and doc is not null").groupBy(F.col("s1").alias("of")).agg(F.min("doc").alias("doc"), F.max("n").alias("n"))
    members = clusters.join(named, F.col("node") == F.col("of")).select(F.col("doc").alias("node"), F.col("label").alias("cluster"), "n")
    links = components(saved(verified_links(members, docs, doc, text, length, threshold), "links"))
    nodes = sets.where("n > 0").groupBy("s1", "s2").agg(F.min("doc").alias("node"))
    nodes = nodes.join(links.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left").select(
        F.col("s1").alias("g1"), F.col("s2").alias("g2"), F.coalesce("label", "node").alias("group"))
    met = sets.select("doc", "n", "s1", "s2").join(nodes, (F.col("n") > 0) & (F.col("s1") == F.col("g1")) & (F.col("s2") == F.col("g2")), "left")
    return met.select("doc", F.col("n").alias("n_shingles"), F.coalesce("group", "doc").alias("component_id"))


def without_copies(docs: DataFrame, groups: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The documents, in their own columns, that stand for their group. Rows without id stay, rows with one id stay together."""
    name = fresh(docs, "__copy")
    copies = saved(groups.where("doc <> component_id").select(F.col("doc").alias(name)).distinct(), "copies")
    if copies.count() <= MEMBERS:
        copies = F.broadcast(copies)
    return docs.join(copies, F.col(doc) == F.col(name), "left_anti")
