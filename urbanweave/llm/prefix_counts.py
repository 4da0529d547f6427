"""Token counts of every prefix of every text, by dynamic programming over prefixes, and what they answer.

For a byte-pair vocabulary the last token of a prefix decides its count: ``count(prefix) = count(prefix without its last token) + 1``.
A token can be last after another exactly if the two, joined, would be cut into these two again; for each prefix one token that
ends there fits the last token of the prefix before it. So one pass over a text, left to right, stores the exact number of tokens of
all its prefixes. Truncation, budget and length questions are then reads of stored numbers: no text is encoded again, or even read.

A piece vocabulary (the ``sentencepiece`` library's byte-pair kind, text unchanged but for a blank put before it) never joins certain
neighbours: bytes that stand side by side in no piece. Texts fall apart there into short segments whose counts add up. The distinct
segments of some texts are worked on once, everything around them is whole-array numpy.

The stored table has a row for each :data:`PART` code points of a text, so no row grows with a text: ``row`` (a number of the input
row, as ids may be null or repeated), ``doc``, ``n_bytes``, ``part``, ``is_last``, ``first`` and ``size`` (code points before the part and
in it), ``before`` and ``after`` (tokens up to its start and its end), ``least`` (of its prefixes), ``steps`` (change with each code point).

Defined cases: null and empty texts have one part without steps and no tokens; null and repeated ids are rows like others; an empty
table gives an empty table; columns besides id and text aren't read. Characters outside the vocabulary count a token a byte.
Adding a character may make a count smaller; the longest prefix within a budget is the longest of all, whatever lies between.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanweave.llm.kernels import Flat, lists, pieces
from urbanweave.llm.shared import saved

#: Code points of a text in one row of the stored table.
PART = 1 << 16

#: Distinct segments kept from one piece of texts to the next, the longest one kept in bytes, and pairs of tokens looked up.
KEPT, KEPT_LENGTH, PAIRS = 1 << 18, 48, 1 << 20

_NEVER = float("inf")


class PieceVocabulary:
    """Prefix counts under a byte-pair model file of the ``sentencepiece`` library."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        stated, changes = model.trainer_spec, model.normalizer_spec
        kinds = type(model).SentencePiece
        odd = [p.piece for p in model.pieces if p.type in (kinds.USER_DEFINED, kinds.UNUSED)]
        if (stated.model_type != type(stated).BPE or not stated.byte_fallback or changes.precompiled_charsmap or changes.remove_extra_whitespaces
                or not changes.add_dummy_prefix or stated.treat_whitespace_as_suffix or odd):
            raise ValueError(f"{path} isn't a byte-pair model with byte fallback over unchanged texts")
        #: When a piece is joined: the lower, the earlier. Blanks stand for the mark of the library's pieces.
        self.rank = {p.piece.replace("▁", " "): -p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.tails = {piece[k:] for piece in self.rank for k in range(len(piece))}
        self.side_by_side = np.zeros((256, 256), bool)
        for piece in self.rank:
            raw = np.frombuffer(piece.encode(), np.uint8)
            self.side_by_side[raw[:-1], raw[1:]] = True
        #: What was looked up: for each token, the tokens that were asked for after it.
        self.rows: dict[str, dict[str, bool]] = {"": {}}
        self.looked_up = 0
        self.kept: dict[bytes, bytes] = {}

    def cut(self, text: str) -> list[str]:
        """Tokens of a short text, by joining the earliest pair, the leftmost of equals, again and again."""
        parts = list(text)
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == _NEVER:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stays(self, left: str, token: str) -> bool:
        """Whether a token stays as it is, after ``left`` if that isn't empty."""
        return self.cut(token) == [token] and (not left or self.cut(left + token) == [left, token])

    def prefixes(self, segment: str) -> array:
        """Number of tokens of the first 1, 2, .. characters of a segment."""
        rank, tails, rows = self.rank, self.tails, self.rows
        count, last = [0], [""]  # of each prefix, and what may follow its last token, as far as it was looked up
        after = [rows[""]]
        for end in range(1, len(segment) + 1):
            start = end - 1
            token = segment[start]
            if token not in rank:  # no piece has it: its bytes are tokens, and nothing joins over them
                count.append(count[-1] + len(token.encode()))
                last.append("")
                after.append(rows[""])
                continue
            while True:
                if token in rank:
                    row = after[start]
                    fits = row.get(token)
                    if fits is None:
                        fits = row[token] = self.stays(last[start], token)
                        self.looked_up += 1
                    if fits:
                        break
                start -= 1
                token = segment[start:end]
                if start < 0 or token not in tails:
                    raise AssertionError(f"no token ends after {segment[:end]!r}")
            count.append(count[start] + 1)
            last.append(token)
            row = rows.get(token)
            if row is None:
                row = rows[token] = {}
            after.append(row)
        if self.looked_up > PAIRS:
            self.rows, self.looked_up = {"": {}}, 0
        return array("i", count[1:])

    def known(self, segment: bytes) -> bytes:
        """The same of UTF-8 bytes, as the bytes of 32-bit numbers, from what was kept."""
        found = self.kept.get(segment)
        if found is None:
            found = self.prefixes(segment.decode("utf-8", "replace")).tobytes()
            if len(segment) <= KEPT_LENGTH:
                if len(self.kept) >= KEPT:
                    self.kept.clear()
                self.kept[segment] = found
        return found

    def count(self, flat: Flat) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of every prefix of every text of a piece, one after the other, and the code points before each text."""
        raw, first = _blank_before(flat)
        heads = (raw & 0xC0) != 0x80
        chars = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(heads, out=chars[1:])
        new = np.ones(len(raw) + 1, bool)
        new[1:-1] = heads[1:] & ~self.side_by_side[raw[:-1], raw[1:]]
        new[first] = True
        edge = np.flatnonzero(new)
        start, end = edge[:-1], edge[1:]
        plain = Flat(raw, first, fold=False)
        _, at, place = np.unique(plain.span_hash(start, end), return_index=True, return_inverse=True)
        data = raw.tobytes()
        own = [self.known(data[s:e]) for s, e in zip(start[at].tolist(), end[at].tolist(), strict=True)]
        if not own:
            return np.empty(0, np.int64), np.zeros(len(flat) + 1, np.int64)
        pool = np.frombuffer(b"".join(own), np.int32)
        sizes = np.array([len(x) for x in own]) // 4
        begins = np.cumsum(sizes) - sizes
        totals = pool[begins + sizes - 1].astype(np.int64)[place]
        sums = np.cumsum(totals) - totals
        owner = np.searchsorted(first, start, side="right") - 1
        sums -= sums[np.searchsorted(start, first[:-1])[owner]]  # from the start of the own text
        lengths = sizes[place]
        before = np.cumsum(lengths) - lengths
        gather = np.repeat(begins[place] - before, lengths) + np.arange(lengths.sum())
        counts = pool[gather] + np.repeat(sums, lengths)
        text_first = chars[first]
        full = np.flatnonzero(np.diff(first) > 0)
        stays = np.ones(len(counts), bool)
        stays[text_first[full]] = False  # the blank put before each text is no prefix of it
        return counts[stays], text_first - np.searchsorted(full, np.arange(len(first)))


def _blank_before(flat: Flat) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with a blank before every text that isn't empty, and with blanks for the mark that stands for them in pieces."""
    raw, first = flat.raw, flat.first
    mark = np.flatnonzero((raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81)) if len(raw) > 2 else np.empty(0, np.int64)
    if len(mark):
        stays = np.ones(len(raw), bool)
        stays[mark + 1] = stays[mark + 2] = False
        raw = raw.copy()
        raw[mark] = 32
        kept = np.concatenate([[0], np.cumsum(stays)])
        raw, first = raw[stays], kept[first]
    full = np.diff(first) > 0
    added = np.concatenate([[0], np.cumsum(full)])
    return np.insert(raw, first[:-1][full], 32), first + added


@cache
def vocabulary(path: str) -> PieceVocabulary:
    return PieceVocabulary(path)


def prefix_counts(docs: DataFrame, model: str, doc: str = "doc_id", text: str = "text", part: int = PART) -> DataFrame:
    """The stored table of all texts, written to the shared folder. ``model`` is the model file, at the same path on every executor."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, row = vocabulary(model), TaskContext.get().partitionId() << 36
        for batch in batches:
            for at, flat in pieces(batch.column(1)):
                counts, first = words.count(flat)
                chars = np.diff(first)
                parts = np.maximum(-(-chars // part), 1)
                owner = np.repeat(np.arange(len(flat)), parts)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
                begin = first[:-1][owner] + number * part
                end = np.minimum(begin + part, first[1:][owner])
                padded = np.concatenate([[0], counts])
                starts = np.where(number > 0, padded[begin], 0)
                steps = np.diff(padded)
                steps[first[:-1][chars > 0]] = counts[first[:-1][chars > 0]]
                full = np.flatnonzero(end > begin)
                least = starts.copy()
                if len(full):
                    least[full] = np.minimum.reduceat(counts, begin[full])
                after = np.where(end > begin, padded[end], 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + owner), batch.column(0).slice(at, len(flat)).take(pa.array(owner)), pa.array(np.diff(flat.first)[owner]),
                     pa.array(number.astype(np.int32)), pa.array(number == parts[owner] - 1),
                     *[pa.array(x, pa.int64()) for x in (number * part, end - begin, starts, after, least)], lists(steps.astype(np.int32), end - begin)],
                    names=["row", "doc", "n_bytes", "part", "is_last", "first", "size", "before", "after", "least", "steps"])
                row += len(flat)

    rows = docs.select(F.col(doc).cast("long"), F.col(text).cast("string"))
    return saved(rows.mapInArrow(count, "row long, doc long, n_bytes long, part int, is_last boolean, first long, size long, before long, "
                                        "after long, least long, steps array<int>"), "prefix-counts")


def totals(counts: DataFrame) -> DataFrame:
    """``(row, doc, n_bytes, n_chars, n_tokens)`` of every whole text: the last part of each says it."""
    return counts.where("is_last").select("row", "doc", "n_bytes", (F.col("first") + F.col("size")).alias("n_chars"), F.col("after").alias("n_tokens"))


def longest_prefixes(counts: DataFrame, budget: int) -> DataFrame:
    """``(row, doc, n_bytes, n_chars, n_tokens, fit_chars, fit_tokens)``: what :func:`totals` says, and the longest prefix of each text with at
    most ``budget`` tokens, in code points. One pass over the stored table, whose steps count only where a part has prefixes within the budget and others.
    """
    begin = F.struct(F.col("before").alias("tokens"), F.col("first").alias("at"), F.col("first").alias("fit"), F.col("before").alias("best"))

    def onward(state, step):
        tokens, at = state["tokens"] + step, state["at"] + 1
        fits = tokens <= budget
        return F.struct(tokens.alias("tokens"), at.alias("at"), F.when(fits, at).otherwise(state["fit"]).alias("fit"),
                        F.when(fits, tokens).otherwise(state["best"]).alias("best"))

    read = F.aggregate("steps", begin, onward, lambda s: F.struct(s["fit"].alias("fit_chars"), s["best"].alias("fit_tokens")))
    end = F.struct((F.col("first") + F.col("size")).alias("fit_chars"), F.col("after").alias("fit_tokens"))
    found = F.when(F.col("after") <= budget, end).otherwise(read)
    whole = F.struct("doc", "n_bytes", (F.col("first") + F.col("size")).alias("n_chars"), F.col("after").alias("n_tokens"))
    fits = F.when((F.col("least") <= budget) | (F.col("part") == 0), found)
    own = counts.select("row", "part", whole.alias("whole"), fits.alias("fit")).groupBy("row").agg(F.max("fit").alias("fit"), F.max_by("whole", "part").alias("whole"))
    return own.select("row", "whole.*", "fit.fit_chars", "fit.fit_tokens")


def tokens_before(counts: DataFrame, places: DataFrame) -> DataFrame:
    """Tokens of the prefixes that ``places (doc, n_chars)`` name, as ``(doc, n_chars, n_tokens)``; beyond the end that of the whole text."""
    inside = (F.col("at.n_chars") > F.col("first")) & (F.col("at.n_chars") <= F.col("first") + F.col("size"))
    early = (F.col("part") == 0) & (F.col("at.n_chars") <= 0)
    late = F.col("is_last") & (F.col("at.n_chars") > F.greatest(F.col("first") + F.col("size"), F.lit(0)))
    met = counts.join(places.select("doc", F.struct("n_chars").alias("at")), "doc").where(inside | early | late)
    own = F.slice("steps", F.lit(1), F.greatest(F.least(F.col("at.n_chars") - F.col("first"), F.col("size")), F.lit(0)).cast("int"))
    return met.select("doc", F.col("at.n_chars").alias("n_chars"), F.aggregate(own, F.col("before"), lambda a, x: a + x).alias("n_tokens"))
