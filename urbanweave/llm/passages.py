"""Substring dedup by lines, paragraphs or words: normalised units are hashed, grouped over the whole corpus, and only the first stays.

:func:`repeated_passages` takes every ``min_words`` consecutive words as a unit, wherever they begin or end, so a passage inside longer lines
is found too. Of the shorter windows in each unit the one of least hash marks it, so equal units have equal marks, and neighbours mostly share
one: units are told apart by stretches with one mark. A mark that occurs once has no repeated unit; stretches that are equal as a whole
are settled by their first place; only where unequal stretches have the same mark are units hashed, once for each distinct stretch. No repeated unit is
lost, as all its copies hold the same mark at the same place.

:func:`repeated_runs` takes runs of consecutive lines as units: ``min_words`` counts for the run, so short lines take part. For every
line it hashes the shortest run of lines from it and the shortest one up to it that reach ``min_words``; every line of a repeated run
that long is in one of them. A run that overlaps its own first occurrence stays. Lines without words are stepped over.

:func:`repeated_units` judges each unit alone: a line, or with ``paragraphs`` a run of lines between blank ones, of ``min_words`` or more.

Units are normalised to their sequence of words (ASCII letters, digits and non-ASCII characters, lower-cased in A-Z), so punctuation and
spacing don't hide a copy. Of equal units the one in the document with the smallest id stays, in it the first.

Only hashes (two of 64 bits for each unit or stretch) and positions are shuffled, and once the texts for :func:`repeated_passages`. The first
occurrence of a unit is an aggregate that combines map-side; it is joined back in a join AQE can split, so a passage that a third of all rows hold
does not meet in one task.

Defined cases: null and empty texts have no units; a row without id takes no part; rows with equal ids hold equal ranks, so of
rows repeated as a whole the copies stay together (they are one document); shorter units always stay; an empty table gives no
spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanweave.llm.kernels import ALNUM, Flat, pieces, signed
from urbanweave.llm.kernels import lists as arrow_lists
from urbanweave.llm.shared import fresh, saved, written
from urbanweave.session import remove_path


def _units(flat: Flat, paragraphs: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of every unit."""
    start, end, first = flat.lines()
    owner = np.repeat(np.arange(len(flat)), np.diff(first))
    if not paragraphs:
        return start, end, owner
    head, tail = flat.stripped(start, end)
    full = np.flatnonzero(tail > head)
    if not len(full):
        return start[:0], end[:0], owner[:0]
    new = np.ones(len(full), bool)
    new[1:] = (np.diff(full) > 1) | (np.diff(owner[full]) > 0)
    last = np.append(np.flatnonzero(new)[1:] - 1, len(full) - 1)
    return start[full[new]], end[full[last]], owner[full[new]]


def unit_hashes(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = 20,
                paragraphs: bool = False) -> DataFrame:
    """Long units of all documents: ``(doc, unit, start, end, n_words, h1, h2)``; byte offsets in the original text."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, flat in pieces(batch.column(1)):
                start, end, owner = _units(flat, paragraphs)
                words = flat.words(ALNUM)
                lo, hi = np.searchsorted(words.start, start), np.searchsorted(words.start, end)
                keep = np.flatnonzero(hi - lo >= min_words)
                number = np.arange(len(owner)) - np.searchsorted(owner, owner)
                start, end, owner, lo, hi, number = (x[keep] for x in (start, end, owner, lo, hi, number))
                base = flat.first[owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at + owner], pa.int64()), pa.array(number, pa.int64()), pa.array(start - base), pa.array(end - base),
                     pa.array(hi - lo, pa.int64()), *[pa.array(signed(words.runs(words.hashes(seed), lo, hi))) for seed in (1, 2)]],
                    names=["doc", "unit", "start", "end", "n_words", "h1", "h2"])

    known = docs.where(F.col(doc).isNotNull()).select(F.col(doc).cast("long"), F.col(text).cast("string"))
    return known.mapInArrow(cut, "doc long, unit long, start long, end long, n_words long, h1 long, h2 long")


def repeated_units(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = 20,
                   paragraphs: bool = False) -> DataFrame:
    """Spans to remove: ``(doc_id, unit, start, end, n_words, kept_doc_id, kept_unit)``, offsets in bytes of the original."""
    units = saved(unit_hashes(docs, doc, text, min_words, paragraphs), "units")
    place = F.struct("doc", "unit")
    first = (units.groupBy("h1", "h2").agg(F.min(place).alias("kept"), F.max(place).alias("last")).where("kept < last")
             .select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "kept"))
    later = units.join(first, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
                       & (F.struct("doc", "unit") > F.col("kept")))
    return later.select(F.col("doc").alias("doc_id"), "unit", "start", "end", "n_words",
                        F.col("kept.doc").alias("kept_doc_id"), F.col("kept.unit").alias("kept_unit"))


def run_hashes(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = 20) -> DataFrame:
    """Shortest runs of lines with ``min_words``: ``(doc, unit, last, start, end, lo, hi, h1, h2)``; ``lo:hi`` are words of the text."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, flat in pieces(batch.column(1)):
                start, end, owner = _units(flat, False)
                words = flat.words(ALNUM)
                lo, hi = np.searchsorted(words.start, start), np.searchsorted(words.start, end)
                full = np.flatnonzero(hi > lo)
                number = np.arange(len(owner)) - np.searchsorted(owner, owner)
                start, end, owner, lo, hi, number = (x[full] for x in (start, end, owner, lo, hi, number))
                on = np.flatnonzero(lo + min_words <= words.first[owner + 1])
                back = np.flatnonzero(hi - min_words >= words.first[owner])
                head = np.concatenate([on, np.searchsorted(lo, hi[back] - min_words, side="right") - 1])
                tail = np.concatenate([np.searchsorted(hi, lo[on] + min_words), back])
                head, tail = np.divmod(np.unique(head * max(len(full), 1) + tail), max(len(full), 1))
                own = owner[head]
                base, before = flat.first[own], words.first[own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at + own], pa.int64()), *[pa.array(x, pa.int64()) for x in (number[head], number[tail], start[head] - base,
                     end[tail] - base, lo[head] - before, hi[tail] - before)],
                     *[pa.array(signed(words.runs(words.hashes(seed), lo[head], hi[tail]))) for seed in (1, 2)]],
                    names=["doc", "unit", "last", "start", "end", "lo", "hi", "h1", "h2"])

    known = docs.where(F.col(doc).isNotNull()).select(F.col(doc).cast("long"), F.col(text).cast("string"))
    return known.mapInArrow(cut, "doc long, unit long, last long, start long, end long, lo long, hi long, h1 long, h2 long")


def repeated_runs(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = 20) -> DataFrame:
    """Spans of lines to remove: ``(doc_id, unit, last_unit, start, end, n_words, kept_doc_id, kept_unit)``, offsets in bytes.

    Touching runs are one span. ``kept_doc_id`` and ``kept_unit`` say where the earliest occurrence of its first run begins.
    """
    runs = saved(run_hashes(docs, doc, text, min_words), "runs")
    place = F.struct("doc", "unit", "last")
    first = (runs.groupBy("h1", "h2").agg(F.min(place).alias("kept"), F.max(place).alias("final")).where("kept < final")
             .select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "kept"))
    later = runs.join(first, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
                      & ((F.col("doc") > F.col("kept.doc")) | ((F.col("doc") == F.col("kept.doc")) & (F.col("unit") > F.col("kept.last")))))
    inside = Window.partitionBy("doc").orderBy("unit", "last")
    reach = F.max("last").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    number = F.sum(F.when(F.col("unit") <= F.col("reach") + 1, 0).otherwise(1)).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    joined = later.select("doc", "unit", "last", "start", "end", "lo", "hi", "kept").withColumn("reach", reach).withColumn("span", number)
    return joined.groupBy(F.col("doc").alias("doc_id"), "span").agg(
        F.min("unit").alias("unit"), F.max("last").alias("last_unit"), F.min("start").alias("start"), F.max("end").alias("end"),
        (F.max("hi") - F.min("lo")).alias("n_words"), F.min(F.struct("unit", "last", "kept")).alias("first")).select(
        "doc_id", "unit", "last_unit", "start", "end", "n_words", F.col("first.kept.doc").alias("kept_doc_id"), F.col("first.kept.unit").alias("kept_unit"))


def passage_marks(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """Stretches of units with one mark: ``(doc, lo, n, h, c)``: the first word of the first unit, the units, the mark's hash and that of all their words.

    The mark of a unit of ``min_words`` words is, of the windows of half of them in it, the one of least hash.
    """
    length = max(1, min_words // 2)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, flat in pieces(batch.column(1)):
                words = flat.words(ALNUM)
                if len(words) < min_words:
                    continue
                place = np.arange(len(words) - length + 1)
                hashes = words.runs(words.hashes(), place, place + length)
                # places in the lower half: of equal hashes the leftmost, in all copies alike
                least, size, wanted = (hashes >> np.uint64(32) << np.uint64(32)) | place.astype(np.uint64), 1, min_words - length + 1
                while 2 * size <= wanted:
                    least, size = np.minimum(least[:-size], least[size:]), 2 * size
                least = np.minimum(least[:len(least) - (wanted - size)], least[wanted - size:])
                owner = words.owner()
                unit = np.flatnonzero(np.arange(len(least)) + min_words <= words.first[owner[:len(least)] + 1])
                if not len(unit):
                    continue
                mark = (least[unit] & np.uint64(0xFFFFFFFF)).astype(np.int64)
                head = np.flatnonzero(np.append(True, mark[1:] != mark[:-1]))
                count = np.diff(np.append(head, len(unit)))
                unit, mark = unit[head], mark[head]
                own = owner[unit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at + own], pa.int64()), pa.array(unit - words.first[own], pa.int64()), pa.array(count, pa.int64()), pa.array(signed(hashes[mark])),
                     pa.array(signed(words.runs(words.hashes(2), unit, unit + count + min_words - 1)))], names=["doc", "lo", "n", "h", "c"])

    known = docs.where(F.col(doc).isNotNull()).select(F.col(doc).cast("long"), F.col(text).cast("string"))
    return known.mapInArrow(cut, "doc long, lo long, n long, h long, c long")


def passage_stretches(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """Stretches that can hold repeated units: ``(doc, lo, n, h, c, several, kept, starts, ends, units)``.

    ``kept`` is the first place of an equal stretch, ``several`` whether unequal ones have the same mark. Then there are the byte offsets of
    each unit, and at the first place the hashes of the units; else one start and one end, and only stretches that are later ones as a whole.
    """
    marks, path = written(passage_marks(docs, doc, text, min_words), "marks")
    again = saved(marks.groupBy(F.col("h").alias("g")).agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("g"), "again")
    met = saved(marks.join(again, F.col("h") == F.col("g")).drop("g"), "met")
    remove_path(docs.sparkSession, path)
    first = saved(met.groupBy("h", "c").agg(F.min(F.struct("doc", "lo")).alias("kept")), "first")
    unequal = saved(first.groupBy(F.col("h").alias("g")).agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("g"), "unequal")
    told = saved(first.join(unequal, F.col("h") == F.col("g"), "left").select(
        F.col("h").alias("h1"), F.col("c").alias("c1"), F.col("g").isNotNull().alias("several"), "kept"), "told")
    placed = met.join(told, (F.col("h") == F.col("h1")) & (F.col("c") == F.col("c1"))).where(
        F.col("several") | (F.col("doc") > F.col("kept.doc")) | (F.col("lo") >= F.col("kept.lo") + min_words))
    places = placed.groupBy(F.col("doc").alias("of")).agg(F.collect_list(F.struct(
        "lo", "n", "h", "c", "several", F.col("kept.doc").alias("kept_doc"), F.col("kept.lo").alias("kept_lo"))).alias("places"))
    known = docs.where(F.col(doc).isNotNull()).select(F.col(doc).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for at, flat in pieces(batch.column(1)):
                own = found.slice(at, len(flat))
                text_of = np.repeat(np.arange(len(flat)), own.value_lengths().to_numpy(zero_copy_only=False))
                lo, n, h, c, several, kept_doc, kept_lo = (x.to_numpy(zero_copy_only=False) for x in own.flatten().flatten())
                words = flat.words(ALNUM)
                from_word = words.first[text_of] + lo
                fits = np.flatnonzero(from_word + n + min_words - 1 <= words.first[text_of + 1])
                # rows with equal ids: the stretch may be of another one
                fits = fits[signed(words.runs(words.hashes(2), from_word[fits], from_word[fits] + n[fits] + min_words - 1)) == c[fits]]
                text_of, from_word, lo, n, h, c, several, kept_doc, kept_lo = (x[fits] for x in (text_of, from_word, lo, n, h, c, several, kept_doc, kept_lo))
                if not len(fits):
                    continue
                base, doc_of = flat.first[text_of], ids[at + text_of].astype(np.int64)

                def along(counts: np.ndarray, from_word: np.ndarray = from_word) -> np.ndarray:
                    return np.repeat(from_word - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())

                counts = np.where(several, n, 1)
                last = along(counts) + min_words - 1 + np.repeat(np.where(several, 0, n - 1), counts)
                hashed = np.where(several & (doc_of == kept_doc) & (lo == kept_lo), n, 0)
                unit = along(hashed)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x) for x in (doc_of, lo, n, h, c, several)), pa.StructArray.from_arrays([pa.array(kept_doc), pa.array(kept_lo)], ["doc", "lo"]),
                     arrow_lists((words.start[along(counts)] - np.repeat(base, counts)).astype(np.int64), counts),
                     arrow_lists((words.end[last] - np.repeat(base, counts)).astype(np.int64), counts),
                     arrow_lists(signed(words.runs(words.hashes(3), unit, unit + min_words)), hashed)],
                    names=["doc", "lo", "n", "h", "c", "several", "kept", "starts", "ends", "units"])

    return known.join(places, F.col("doc") == F.col("of")).select("doc", "text", "places").mapInArrow(
        cut, "doc long, lo long, n long, h long, c long, several boolean, kept struct<doc: long, lo: long>, starts array<long>, ends array<long>, units array<long>")


def repeated_passages(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """Spans of words to remove: ``(doc_id, word, start, end, n_words, kept_doc_id, kept_word)``; ``word`` is the first, offsets in bytes.

    A span is made of overlapping or touching units of ``min_words`` words that also occur earlier, and not overlapping them there.
    ``kept_doc_id`` and ``kept_word`` say where the earliest occurrence of its first unit begins.
    """
    stretches = saved(passage_stretches(docs, doc, text, min_words), "stretches")
    units = stretches.where(F.size("units") > 0).select("doc", "lo", "h", "c", F.posexplode("units").alias("k", "u"))
    first = units.groupBy(F.col("h").alias("h1"), F.col("u").alias("u1")).agg(F.min(F.struct("doc", (F.col("lo") + F.col("k")).alias("lo"))).alias("first"))
    within = Window.partitionBy("h", "c").orderBy("k")
    place = F.struct(F.col("first.doc").alias("doc"), (F.col("first.lo") - F.col("k")).alias("lo"))
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    told = (units.join(first, (F.col("h") == F.col("h1")) & (F.col("u") == F.col("u1"))).select("h", "c", "k", place.alias("begin"))
            .withColumn("other", F.lag("begin").over(within)).withColumn("part", F.sum(F.when(F.col("begin") == F.col("other"), 0).otherwise(1)).over(so_far)))
    parts = saved(told.groupBy(F.col("h").alias("h1"), F.col("c").alias("c1"), "part", "begin").agg(F.min("k").alias("k"), F.max("k").alias("final")), "parts")
    whole = stretches.where(~F.col("several")).select("doc", "lo", (F.col("lo") + F.col("n") - 1).alias("last"), F.get("starts", F.lit(0)).alias("start"),
                                                      F.get("ends", F.lit(0)).alias("end"), "kept")
    cut = stretches.where("several").drop("kept", "units").join(parts, (F.col("h") == F.col("h1")) & (F.col("c") == F.col("c1"))).select(
        "doc", (F.col("lo") + F.col("k")).alias("lo"), (F.col("lo") + F.col("final")).alias("last"), F.get("starts", F.col("k").cast("int")).alias("start"),
        F.get("ends", F.col("final").cast("int")).alias("end"), F.struct(F.col("begin.doc").alias("doc"), (F.col("begin.lo") + F.col("k")).alias("lo")).alias("kept"))
    later = whole.union(cut.where((F.col("doc") > F.col("kept.doc")) | (F.col("lo") >= F.col("kept.lo") + min_words)))
    inside = Window.partitionBy("doc").orderBy("lo", "last")
    reach = F.max("last").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    joined = later.withColumn("reach", reach).withColumn(
        "span", F.sum(F.when(F.col("lo") <= F.col("reach") + min_words, 0).otherwise(1)).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    return joined.groupBy(F.col("doc").alias("doc_id"), "span").agg(
        F.min("lo").alias("word"), F.min("start").alias("start"), F.max("end").alias("end"), (F.max("last") + min_words - F.min("lo")).alias("n_words"),
        F.min(F.struct("lo", "kept")).alias("first")).select(
        "doc_id", "word", "start", "end", "n_words", F.col("first.kept.doc").alias("kept_doc_id"), F.col("first.kept.lo").alias("kept_word"))


def remove_units(docs: DataFrame, spans: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, in their own columns, without the spans of :func:`repeated_units`, :func:`repeated_runs` or :func:`repeated_passages`; a removed end of a line takes its LF along."""
    of = fresh(docs, "__span_doc")
    lists = spans.groupBy(F.col("doc_id").alias(of)).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias(fresh(docs, "__spans")))
    met = docs.join(lists, F.col(doc) == F.col(of), "left").drop(of)
    place = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(place).to_pylist(), batch.column(len(batch.columns) - 1).to_pylist()
            for k, own in enumerate(spans):
                if own and texts[k]:
                    raw, at, parts = texts[k].encode(), 0, []
                    for span in own:
                        parts.append(raw[at:span["start"]])
                        at = span["end"] + (raw[span["end"]:span["end"] + 1] == b"\n")
                    texts[k] = b"".join([*parts, raw[at:]]).decode()
            arrays = list(batch.columns[:-1])
            arrays[place] = pa.array(texts, arrays[place].type)
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:-1])

    return met.mapInArrow(cut, docs.schema)
