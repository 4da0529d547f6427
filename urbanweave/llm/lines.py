"""Line dedup: lines are hashed, documents counted per hash, and repeated lines dropped in all documents but one.

A line's key is the line (text split at LF) without white space at both ends and with A-Z in lower case. Keys of at least
``min_chars`` characters that at least ``min_documents`` documents hold lose all their lines except those in the
document with the smallest id. The other lines keep their order and are joined by LF.

Keys are compared by 128 bits of hash. Only ids and hashes are grouped and joined: the aggregate combines map-side and the
join is one that AQE can split, so a line that a third of all documents hold is no hot task. The texts are moved once, to meet
the list of keys each document loses; the lines are cut out inside the task that holds the document.

Defined cases: a null or empty text is one empty line and stays; a row without id has no rank, so it neither counts nor loses
lines; rows with equal ids are one document, and each of them loses the same keys; ties can't arise, as ids are compared;
an empty table gives an empty table. Other columns are passed by position, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanweave.llm.kernels import Flat, distinct_in_owner, pieces, signed
from urbanweave.llm.shared import fresh, saved


def _hashed(flat: Flat) -> tuple[np.ndarray, ...]:
    """Start and end of all lines, lines before each text, characters of their keys, and two hashes of the keys."""
    start, end, first = flat.lines()
    head, tail = flat.stripped(start, end)
    return start, end, first, flat.characters(head, tail), flat.span_hash(head, tail, 1), flat.span_hash(head, tail, 2)


def line_keys(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = 10) -> DataFrame:
    """Distinct long line keys ``(doc, h1, h2)`` of every document with an id."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, flat in pieces(batch.column(1)):
                _, _, first, chars, h1, h2 = _hashed(flat)
                owner = np.repeat(np.arange(len(flat)), np.diff(first))
                long = np.flatnonzero(chars >= min_chars)
                long = long[distinct_in_owner(owner[long], h1[long])]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at + owner[long]], pa.int64()), pa.array(signed(h1[long])),
                                                  pa.array(signed(h2[long]))], names=["doc", "h1", "h2"])

    known = docs.where(F.col(doc).isNotNull()).select(F.col(doc).cast("long"), F.col(text).cast("string"))
    return known.mapInArrow(cut, "doc long, h1 long, h2 long")


def lost_keys(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = 10,
              min_documents: int = 2) -> DataFrame:
    """For each document that loses lines: ``(doc, lost)``, with ``lost`` the keys as structs of two hashes."""
    keys = saved(line_keys(docs, doc, text, min_chars), "line-keys")
    if min_documents <= 2:
        held = keys.groupBy("h1", "h2").agg(F.min("doc").alias("keeper"), F.max("doc").alias("other")).where("keeper < other")
    else:
        single = keys.distinct()
        held = single.groupBy("h1", "h2").agg(F.min("doc").alias("keeper"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_documents)
    held = held.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "keeper")
    found = keys.join(held, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("doc") != F.col("keeper")))
    return found.groupBy("doc").agg(F.collect_set(F.struct("h1", "h2")).alias("lost"))


def drop_repeated_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = 10, min_documents: int = 2,
                        counts: bool = False) -> DataFrame:
    """The documents with repeated lines cut out, in their own columns.

    With ``counts`` only the id, the new text and, before it, ``n_lines`` (lines before dropping) and ``n_dropped``.
    """
    columns = [doc, text] if counts else docs.columns
    place = columns.index(text)
    of = fresh(docs, "__lost_doc")
    lost = lost_keys(docs, doc, text, min_chars, min_documents).select(F.col("doc").alias(of), F.col("lost").alias(fresh(docs, "__lost")))
    met = docs.select(*columns).join(lost, F.col(doc) == F.col(of), "left").drop(of)
    added = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())] if counts else []
    schema = T.StructType([*docs.select(*columns).schema.fields, *added])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lost = batch.column(place), batch.column(len(batch.columns) - 1)
            out: list = texts.to_pylist() if lost.null_count < len(lost) else []
            n_lines, n_dropped = np.zeros(len(lost), np.int64), np.zeros(len(lost), np.int64)
            touched = np.flatnonzero(lost.is_valid().to_numpy(zero_copy_only=False))
            for at, flat in pieces(texts) if counts else ():
                n_lines[at:at + len(flat)] = np.diff(flat.lines()[2])
            for lo, flat in pieces(texts.take(pa.array(touched))):
                start, end, first, chars, h1, h2 = _hashed(flat)
                h1, h2 = signed(h1), signed(h2)
                raw = flat.raw.tobytes()
                for k in range(len(flat)):
                    row, a, b = int(touched[lo + k]), first[k], first[k + 1]
                    gone = {(x["h1"], x["h2"]) for x in lost[row].as_py()}
                    stay = [(s, e) for s, e, c, x, y in zip(start[a:b].tolist(), end[a:b].tolist(), chars[a:b].tolist(), h1[a:b].tolist(), h2[a:b].tolist(), strict=True)
                            if c < min_chars or (x, y) not in gone]
                    n_dropped[row] = b - a - len(stay)
                    out[row] = b"\n".join(raw[s:e] for s, e in stay).decode()
            arrays = list(batch.columns[:-1])
            if out:
                arrays[place] = pa.array(out, texts.type)
            if counts:
                arrays += [pa.array(n_lines), pa.array(n_dropped)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return met.mapInArrow(cut, schema)
