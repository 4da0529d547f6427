"""Indel similarity of two texts: ``200 * LCS / (len(a) + len(b))``."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The functions below travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cells of one vectorised comparison; longer batches are cut in slices so that memory stays bounded.
SLICE_CELLS = 2_000_000


def _codes(texts: list[str], width: int, filler: int) -> np.ndarray:
    out = np.full((len(texts), width), filler, dtype=np.int32)
    for row, text in enumerate(texts):
        out[row, : len(text)] = np.frombuffer(text.encode("utf-32-le"), dtype=np.int32)
    return out


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair ``(left[i], right[i])``.

    One dynamic-programming row per character of the left texts; all pairs of a slice move together.
    """
    lengths = np.zeros(len(left), dtype=np.int32)
    order = sorted(range(len(left)), key=lambda i: (len(right[i]), len(left[i])))
    begin = 0
    while begin < len(order):
        end, widest = begin, 1
        while end < len(order):
            widest = max(widest, len(right[order[end]]), len(left[order[end]]))
            if end > begin and (end - begin + 1) * widest > SLICE_CELLS:
                break
            end += 1
        rows = order[begin:end]
        a, b = [left[i] for i in rows], [right[i] for i in rows]
        width_a, width_b = max(map(len, a)), max(map(len, b))
        if width_a and width_b:
            codes_a, codes_b = _codes(a, width_a, -1), _codes(b, width_b, -2)
            best = np.zeros((len(rows), width_b + 1), dtype=np.int32)
            for step in range(width_a):
                taken = best[:, :-1] + (codes_b == codes_a[:, step : step + 1])
                np.maximum(best[:, 1:], taken, out=best[:, 1:])
                np.maximum.accumulate(best, axis=1, out=best)
            lengths[rows] = best[:, -1]
        begin = end
    return lengths


def ratios(left: list[str], right: list[str]) -> np.ndarray:
    total = np.array([len(a) + len(b) for a, b in zip(left, right)], dtype=np.float64)
    lcs = lcs_lengths(left, right)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(total > 0, 200.0 * lcs / total, 100.0)


@F.pandas_udf(T.DoubleType())
def indel_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(ratios(left.tolist(), right.tolist()), index=left.index)


@F.pandas_udf(T.ArrayType(T.StringType()))
def numbered_grams(texts: pd.Series, width: pd.Series) -> pd.Series:
    """Grams of each padded text, each with the number of its occurrence in the text."""
    rows = []
    for text, size in zip(texts, width):
        pad, times, grams = "\u0001" * (size - 1), {}, []
        padded = pad + text + pad
        for i in range(len(padded) - size + 1):
            gram = padded[i:i + size]
            times[gram] = times.get(gram, 0) + 1
            grams.append(gram + str(times[gram]))
        rows.append(grams)
    return pd.Series(rows, index=texts.index)


class Offered:
    """Texts encoded once for many comparisons: characters, lengths, and how often each character occurs."""

    def __init__(self, texts: list[str]):
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.codes = _codes(texts, max(1, int(self.lengths.max(initial=0))), -2)
        self.letters, place = np.unique(self.codes, return_inverse=True)
        rows = np.repeat(np.arange(len(texts)), self.codes.shape[1])
        self.counts = np.bincount(rows * len(self.letters) + place.ravel(), minlength=len(texts) * len(self.letters)).reshape(len(texts), -1).astype(np.int32)

    def bounds(self, text: np.ndarray) -> np.ndarray:
        """No score with ``text`` is above these: common characters, in whatever order."""
        letters, times = np.unique(text, return_counts=True)
        at = np.minimum(np.searchsorted(self.letters, letters), len(self.letters) - 1)
        known = self.letters[at] == letters
        common = np.minimum(self.counts[:, at[known]], times[known]).sum(axis=1)
        return self._score(common, len(text), slice(None))

    def reach(self, text: np.ndarray) -> np.ndarray:
        """No ratio of ``text`` with any window of a text, or the other way round, is above these: common characters again."""
        total = self.lengths + len(text)
        common = np.rint(self.bounds(text) * total / 200.0)
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(common > 0, 200.0 * common / (np.minimum(self.lengths, len(text)) + common), np.where(total > 0, 0.0, 100.0))

    def scores(self, text: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact scores with the texts at ``rows``."""
        codes = self.codes[rows]
        best = np.zeros((len(rows), codes.shape[1] + 1), dtype=np.int32)
        for letter in text:
            taken = best[:, :-1] + (codes == letter)
            np.maximum(best[:, 1:], taken, out=best[:, 1:])
            np.maximum.accumulate(best, axis=1, out=best)
        return self._score(best[:, -1], len(text), rows)

    def _score(self, common: np.ndarray, length: int, rows) -> np.ndarray:
        total = (self.lengths[rows] + length).astype(np.float64)
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(total > 0, 200.0 * common / total, 100.0)


def _letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.int32)


def _best(offered: Offered, order: np.ndarray, text: str) -> tuple[int, float]:
    """Place and score of the best offered text; comparisons stop where no bound reaches the best score."""
    letters = _letters(text)
    bounds = offered.bounds(letters)
    by_bound = np.argsort(-bounds, kind="stable")
    pick, most, step = -1, -1.0, max(32, min(1024, SLICE_CELLS // offered.codes.shape[1]))
    for begin in range(0, len(by_bound), step):
        rows = by_bound[begin:begin + step]
        rows = rows[bounds[rows] >= most]
        if not len(rows):
            break
        found = offered.scores(letters, rows)
        k = int(np.lexsort((order[rows], -found))[0])
        if found[k] > most or (found[k] == most and order[rows[k]] < order[pick]):
            pick, most = int(rows[k]), float(found[k])
    return pick, most


_BEST = T.ArrayType(T.StructType([
    T.StructField("text", T.StringType()), T.StructField("best", T.StringType()), T.StructField("score", T.DoubleType()),
]))


@F.pandas_udf(_BEST)
def best_in_chunk(block: pd.Series, texts: pd.Series, ranks: pd.Series) -> pd.Series:
    """For each text of a block the best text of a chunk; the lower rank wins a tie."""
    rows = []
    for wanted, offered, order in zip(block, texts, ranks):
        offered, order = list(offered), np.asarray(order)
        encoded, found = Offered(offered), []
        for text in wanted:
            pick, score = _best(encoded, order, text)
            found.append({"text": text, "best": offered[pick], "score": score})
        rows.append(found)
    return pd.Series(rows, index=block.index)


@F.pandas_udf(_BEST)
def near_in_chunk(block: pd.Series, texts: pd.Series, least: pd.Series) -> pd.Series:
    """All pairs of a block and a chunk that score at least ``least``."""
    rows = []
    for wanted, offered, threshold in zip(block, texts, least):
        offered = list(offered)
        encoded, found = Offered(offered), []
        for text in wanted:
            letters = _letters(text)
            near = np.flatnonzero(encoded.bounds(letters) >= threshold)
            scores = encoded.scores(letters, near)
            found += [{"text": text, "best": offered[k], "score": s} for k, s in zip(near.tolist(), scores.tolist()) if s >= threshold]
        rows.append(found)
    return pd.Series(rows, index=block.index)


def _words(text: str) -> tuple[str, str, set[str]]:
    """Words in order, distinct words in order, and the set of them."""
    words = text.split()
    return " ".join(sorted(words)), " ".join(sorted(set(words))), set(words)


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text with a window of its length in the longer one, or with less at an end."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 0.0 if long else 100.0
    if short in long:
        return 100.0
    size, best = len(short), 0.0
    for one, other in ((short, long), (long, short))[: 2 if len(a) == len(b) else 1]:
        windows = sorted({other[max(0, i):i + size] for i in range(1 - size, len(other))})
        best = max(best, float(ratios([one] * len(windows), windows).max()))
    return best


def word_set_ratio(a: set[str], b: set[str]) -> float:
    """Best ratio among common words, common words with the rest of one side, and with the rest of the other."""
    if not a or not b:
        return 0.0
    common, rest_a, rest_b = " ".join(sorted(a & b)), " ".join(sorted(a - b)), " ".join(sorted(b - a))
    if common and not (rest_a and rest_b):
        return 100.0
    whole_a, whole_b = (f"{common} {rest}" if common else rest for rest in (rest_a, rest_b))
    pairs = [(whole_a, whole_b)] + ([(common, whole_a), (common, whole_b)] if common else [])
    return float(ratios(*map(list, zip(*pairs))).max())


# Fixed values of the weighted score: weights of word scores and of partial scores, partial scores of very unequal texts, and the
# quotients of lengths from which partial scores take part and beyond which texts are very unequal.
WORDS, PARTIAL, UNEQUAL, PARTIAL_FROM, UNEQUAL_BEYOND = 0.95, 0.9, 0.6, 1.5, 8.0


def weighted_ratio(a: str, b: str) -> float:
    """The usual composite of plain, partial, word-sorted and word-set ratios, 0 to 100; texts are taken as they are. 0 if one is empty."""
    if not a or not b:
        return 0.0
    plain = float(ratios([a], [b])[0])
    (sorted_a, _, set_a), (sorted_b, _, set_b) = _words(a), _words(b)
    quotient = max(len(a), len(b)) / min(len(a), len(b))
    if quotient < PARTIAL_FROM:
        return max(plain, WORDS * max(float(ratios([sorted_a], [sorted_b])[0]) if set_a or set_b else 0.0, word_set_ratio(set_a, set_b)))
    weight = PARTIAL if quotient <= UNEQUAL_BEYOND else UNEQUAL
    words = 0.0
    if set_a and set_b:
        words = 100.0 if set_a & set_b else max(
            partial_ratio(sorted_a, sorted_b), partial_ratio(" ".join(sorted(set_a)), " ".join(sorted(set_b))))
    return max(plain, weight * partial_ratio(a, b), WORDS * weight * words)


@F.pandas_udf(_BEST)
def weighted_in_chunk(block: pd.Series, texts: pd.Series, least: pd.Series) -> pd.Series:
    """All pairs of a block and a chunk whose weighted score is at least ``least``.

    Common characters bound each part of the score of two texts without a common word; only pairs within it, or with a common word,
    are scored.
    """
    rows = []
    for wanted, offered, threshold in zip(block, texts, least):
        offered, found = list(offered), []
        forms = [_words(text) for text in offered]
        encoded = [Offered(list(column)) for column in (offered, [f[0] for f in forms], [f[1] for f in forms])]
        holders: dict[str, list[int]] = {}
        for place, form in enumerate(forms):
            for word in form[2]:
                holders.setdefault(word, []).append(place)
        for text in wanted:
            form = _words(text)
            near = np.zeros(len(offered), dtype=bool)
            for side, known in zip((text, form[0], form[1]), encoded):
                near |= known.reach(_letters(side)) >= threshold
            for word in form[2]:
                near[holders.get(word, [])] = True
            for k in np.flatnonzero(near).tolist():
                score = weighted_ratio(text, offered[k])
                if score >= threshold:
                    found.append({"text": text, "best": offered[k], "score": score})
        rows.append(found)
    return pd.Series(rows, index=block.index)


#: What :func:`take_in_order` returns of a pair that was taken.
TAKEN = "left_text string, right_text string, score double, take long, left_used long, right_used long"


def take_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Greedy pairs of rows sorted by ``component`` and then best first; only the texts of one component are held at a time."""
    component, left_used, right_used = None, {}, {}
    for batch in batches:
        taken = []
        for row in batch.itertuples(index=False):
            if row.component != component:
                component, left_used, right_used = row.component, {}, {}
            left, right = left_used.get(row.left_text, 0), right_used.get(row.right_text, 0)
            take = min(row.left_free - left, row.right_free - right)
            if take > 0:
                taken.append((row.left_text, row.right_text, row.score, take, row.left_used + left, row.right_used + right))
                left_used[row.left_text], right_used[row.right_text] = left + take, right + take
        yield pd.DataFrame(taken, columns=["left_text", "right_text", "score", "take", "left_used", "right_used"])
