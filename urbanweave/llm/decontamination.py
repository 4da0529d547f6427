"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, looked up for every window of the training text.

Words are runs of ASCII letters and digits and of non-ASCII characters, lower-cased in A-Z. A benchmark item gives its
windows of ``length`` consecutive words; an item of fewer words, but not none, is one window. A training word inside any
occurrence of a window is *hit*. Hashes only propose hits: the words themselves are compared before a hit counts.

The hash set is counted before it is broadcast. Beyond :data:`GRAM_LIMIT` windows it is cut into blocks of that size, and
the texts are scanned once per block with the hits of earlier blocks carried along, so the result does not depend on size.

Defined cases: a null or empty text has no words and no hits; an item with null id or without words takes no part; equal
items count once per id; repeated rows of documents are each scanned; an empty benchmark hits nothing. All columns of the
documents are kept by position, so their names can't clash with names used here.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanweave.llm.kernels import ALNUM, Flat, pieces, signed
from urbanweave.llm.shared import fresh
from urbanweave.session import cut_lineage

#: Windows in one broadcast block: about 60 MB in a task.
GRAM_LIMIT = 1 << 18

_BITS = 20

#: What :func:`find_contamination` adds: words, hit words, byte spans of the hit runs, items with occurring windows.
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.LongType())),
])


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", length: int = 10) -> DataFrame:
    """Distinct windows ``(hash, words, gram, item)`` of all items; ``gram`` is the lower-cased words joined by blanks."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, flat in pieces(batch.column(1)):
                words = flat.words(ALNUM)
                hashes = words.hashes()
                rows = []
                for doc in range(len(flat)):
                    lo, hi = words.first[doc], words.first[doc + 1]
                    size = min(length, hi - lo)
                    own = [flat.low[words.start[k]:words.end[k]].tobytes() for k in range(lo, hi)]
                    for k in range(hi - lo - size + 1 if size else 0):
                        rows.append((lo + k, size, b" ".join(own[k:k + size]), int(ids[at + doc])))
                found = {size: dict(zip(*map(np.ndarray.tolist, words.windows(hashes, size)))) for size in {r[1] for r in rows}}
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.array([found[r[1]][r[0]] for r in rows], np.uint64).view(np.int64)),
                    pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary()),
                    pa.array([r[3] for r in rows], pa.int64())], names=["hash", "words", "gram", "item"])

    known = benchmark.where(F.col(item).isNotNull()).select(F.col(item).cast("long"), F.col(text).cast("string"))
    return known.mapInArrow(cut, "hash long, words int, gram binary, item long").distinct()


class GramSet:
    """Hash set of one block: per window length the sorted hashes and a bit for their leading bits, and the grams by hash."""

    def __init__(self, rows: Sequence[tuple[int, int, bytes, int]]):
        self.grams: dict[int, dict[bytes, list[int]]] = defaultdict(dict)
        by_length = defaultdict(set)
        for key, size, gram, item in rows:
            self.grams[key].setdefault(bytes(gram), []).append(item)
            by_length[size].add(key)
        self.sorted = {}
        for size, keys in by_length.items():
            hashes = np.sort(np.array(list(keys), np.int64).view(np.uint64))
            seen = np.zeros(1 << _BITS, bool)
            seen[hashes >> np.uint64(64 - _BITS)] = True
            self.sorted[size] = (hashes, seen)

    def scan(self, flat: Flat) -> tuple[list[int], list[list[tuple[int, int]]], list[set[int]], list[int]]:
        """Words of each text, its hit runs as word ranges, its items, and the words hit."""
        words = flat.words(ALNUM)
        hashes = words.hashes()
        cover = np.zeros(len(words) + 1, np.int32)
        items: list[set[int]] = [set() for _ in range(len(flat))]
        low = flat.low.tobytes() if self.sorted else b""
        for size, (sorted_hashes, seen) in self.sorted.items():
            at, found = words.windows(hashes, size)
            near = np.flatnonzero(seen[found >> np.uint64(64 - _BITS)])
            place = np.minimum(np.searchsorted(sorted_hashes, found[near]), len(sorted_hashes) - 1)
            near = near[sorted_hashes[place] == found[near]]
            owner = np.searchsorted(words.first, at[near], side="right") - 1
            for k, key, doc in zip(at[near].tolist(), signed(found[near]).tolist(), owner.tolist(), strict=True):
                gram = b" ".join(low[s:e] for s, e in zip(words.start[k:k + size].tolist(), words.end[k:k + size].tolist(), strict=True))
                if named := self.grams[key].get(gram):
                    items[doc].update(named)
                    cover[k] += 1
                    cover[k + size] -= 1
        hit = np.zeros(len(words) + 2, bool)
        hit[1:-1] = np.cumsum(cover)[:-1] > 0
        runs = []
        for doc, found in enumerate(items):
            if not found:
                runs.append([])
                continue
            lo, hi = int(words.first[doc]), int(words.first[doc + 1])
            own = np.concatenate([[False], hit[lo + 1:hi + 1], [False]])
            edge = np.flatnonzero(own[1:] != own[:-1]) + lo
            runs.append([(int(words.start[s]), int(words.end[e - 1]), int(e - s)) for s, e in edge.reshape(-1, 2)])
        return words.counts.tolist(), [[r[:2] for r in own] for own in runs], items, [sum(r[2] for r in own) for own in runs]


def _count_words(flat: Flat, doc: int, spans: list[tuple[int, int]]) -> int:
    base = int(flat.first[doc])
    return sum(int(np.diff(Flat(flat.raw[base + s:base + e], np.array([0, e - s])).words(ALNUM).first)[0]) for s, e in spans)


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _without(column: pa.Array, spans: list[list[dict]]) -> pa.Array:
    """The texts without their spans; if none has any, the column as it is."""
    if not any(spans):
        return column
    texts = column.to_pylist()
    for k, own in enumerate(spans):
        if own:
            raw, at, parts = texts[k].encode(), 0, []
            for span in own:
                parts.append(raw[at:span["start"]])
                at = span["end"]
            texts[k] = b"".join([*parts, raw[at:]]).decode()
    return pa.array(texts, column.type)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",),
                       length: int = 10, limit: int = GRAM_LIMIT, name: str = "found",
                       cut: str | None = None) -> DataFrame:
    """Columns ``keep`` of every document, and :data:`FOUND` as a struct ``name``. Hit spans are cut out of the kept column ``cut``."""
    spark = docs.sparkSession
    grams = benchmark_windows(benchmark, length=length)
    count = grams.count()
    blocks = max(1, -(-count // limit))
    if blocks > 1:
        grams = cut_lineage(grams)
    kept, held = docs.select(*[F.col(c) for c in keep]), fresh(docs, "__text")
    schema = T.StructType([*kept.schema.fields, T.StructField(held, T.StringType()), T.StructField(name, FOUND)])
    arrow_found = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()),
                             ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.int64()))])
    out = docs.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias(held), F.lit(None).cast(FOUND).alias(name))
    place = list(keep).index(cut) if cut is not None else -1
    for block in range(blocks):
        own = grams if blocks == 1 else grams.where(F.pmod(F.xxhash64("hash", "item"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast(GramSet([tuple(r) for r in own.collect()]))
        last = block == blocks - 1

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(len(batch.columns) - 2)
                earlier = batch.column(len(batch.columns) - 1).to_pylist()
                rows = []
                for at, flat in pieces(texts):
                    for doc, (n, runs, items, n_hit) in enumerate(zip(*shared.value.scan(flat), strict=True)):
                        base = int(flat.first[doc])
                        spans = [(s - base, e - base) for s, e in runs]
                        if (old := earlier[at + doc]) and old["items"]:
                            spans = _joined(spans + [(x["start"], x["end"]) for x in old["spans"]])
                            items, n_hit = items | set(old["items"]), _count_words(flat, doc, spans)
                        rows.append((n, n_hit, [{"start": s, "end": e} for s, e in spans], sorted(items)))
                found = pa.array([dict(zip(("n_words", "n_hit", "spans", "items"), r, strict=True)) for r in rows], arrow_found)
                text_out = pa.nulls(len(rows), pa.string()) if last else texts
                columns = list(batch.columns[:-2])
                if last and cut is not None:
                    columns[place] = _without(columns[place], [r[2] for r in rows])
                yield pa.RecordBatch.from_arrays([*columns, text_out, found], names=batch.schema.names)

        out = out.mapInArrow(scan, schema)
        if not last:
            out = cut_lineage(out)
    return out.drop(held)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", length: int = 10, documents: bool = False,
                  limit: int = GRAM_LIMIT) -> DataFrame:
    """The documents, in their own columns, without hit spans: the text from the first to the last word of each hit run goes.

    With ``documents`` a document with any hit goes as a whole. A document of which no word is left goes as well.
    """
    name = fresh(docs, "__found")
    found = find_contamination(docs, benchmark, text, docs.columns, length, limit, name, None if documents else text)
    n_hit = F.col(name)["n_hit"]
    kept = n_hit == 0 if documents else (n_hit == 0) | (n_hit < F.col(name)["n_words"])
    return found.where(kept).drop(name)
