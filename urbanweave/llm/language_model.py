"""A log-bilinear neural language model, trained in numpy with noise-contrastive estimation on all training texts.

Tokens are words (runs of non-blank characters, A-Z lower-cased) and one end for each text. The number of outputs follows the counted
vocabulary (:class:`Sizes`): with n distinct tokens the n ** (2/3) most frequent have an output each, at least :data:`HEAD`, and the others
a quarter as many classes, at least :data:`CLASSES` (by their last bytes and hash); within a class a token has its smoothed share of the training tokens.
As input every token is the sum of two vectors: its own, or for a rarer token one of as many by its hash, and one of its last bytes.
The vector predicted from the last :data:`CONTEXT` tokens is the sum of theirs, each scaled by the weights of its place. Outputs lie in
groups, about as many as a group has members: a softmax over the groups and one over the members of a group, of products with
their vectors plus a bias. So every token probability is normalised over all known tokens and one unknown token for each class.

1. *Counts.* Every training token is counted; tasks add up before the shuffle.
2. *Training.* All tasks start from the unigram model, take a short warm-up, and are averaged, weighted by tokens; then each trains on
   all its training texts, and the results are averaged again. Averaging is done by parameter block in the shuffle;
   a vector counts in the average as often as the task met it.
   Gradients compare each token, and its group, with :data:`NOISE` others drawn from the unigram distribution, in batches of matrix products.
3. *Scoring.* Batched matrix products give log probabilities of all outputs. Counts of the :data:`KNOWN` most frequent tokens
   (a bounded list) are looked up in the task; all rarer tokens meet their counts in a join, summed by document.

Tokens are told apart by 64-bit hashes. Texts are never shuffled, except for the hashes of their rare tokens.

Defined cases: a null or empty text is one end; repeated rows count as often as they occur and are scored each; a row without id is
held out from nothing the caller's rule does not name (null rules mean: not learned from); without training texts every count is
zero and the model is uniform over its outputs; an empty table gives an empty table; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanweave.llm.kernels import BROAD, Flat, lists, mix, pieces, signed
from urbanweave.llm.shared import frequent, saved

HEAD = 128
CLASSES = 128
SUFFIXES = 4096
CONTEXT = 3
WIDTH = 16
NOISE = 24
BATCH = 1024
#: Tokens of one training step.
STEP = 2048
#: Steps over which the rate rises to its value.
RISE = 60
#: Tokens that every task reads in the warm-up, a beginning for the training on all of them: up to so many training tokens the
#: first number, then less by as much as there are more, and the last at least.
WARM_UP, FEW, LEAST = 400_000, 4_000_000, 100_000
KNOWN = 1 << 20
#: Rows with up to so many gradients in a step have them added one by one.
FEW_ROWS = 4
#: Floats in one averaged block of parameters.
BLOCK = 2048

_END = np.uint64(0x5E2D58D8B3BCDF1B)


def token_hashes(flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and suffix hash of every token, the end of each text included, and the tokens before each text."""
    words = flat.words(BROAD)
    first = words.first + np.arange(len(words.first))
    place = np.arange(len(words)) + words.owner()
    hashes = np.full(first[-1], _END, np.uint64)
    suffix = np.full(first[-1], _END, np.uint64)
    hashes[place] = words.hashes()
    suffix[place] = flat.short_span_hash(np.maximum(words.start, words.end - 3), words.end, 3, 3)
    return hashes, suffix, first


@dataclass(frozen=True)
class Sizes:
    """Numbers of frequent tokens, of classes of the others, and of input vectors by hash."""

    head: int = HEAD
    classes: int = CLASSES
    hashed: int = HEAD

    @classmethod
    def of(cls, types: int) -> Sizes:
        """For this many distinct tokens."""
        head = max(HEAD, round(types ** (2 / 3)))
        return cls(head, max(CLASSES, head // 4), head)

    @property
    def outputs(self) -> int:
        return self.head + self.classes

    @property
    def inputs(self) -> int:
        """Own vectors, those by hash, those by last bytes, one before the text."""
        return self.head + self.hashed + SUFFIXES + 1

    @property
    def members(self) -> int:
        """Outputs of a group; the last one can have fewer."""
        return int(np.ceil(np.sqrt(self.outputs)))

    @property
    def groups(self) -> int:
        return -(-self.outputs // self.members)

    def class_of(self, hashes: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        """Class of each rarer token: its last bytes, and where classes are many also its hash, so that more of them are used."""
        part = (hashes >> np.uint64(40)) % np.uint64(-(-self.classes // CLASSES))
        return (mix(suffix + part * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.classes)).astype(np.int64)

    def shapes(self) -> list[tuple[int, ...]]:
        rows = self.outputs + self.groups
        return [(self.inputs, WIDTH), (rows, WIDTH), (CONTEXT, WIDTH), (rows,)]

    def by_group(self, shares: np.ndarray) -> np.ndarray:
        """Sums over the members of each group."""
        return np.add.reduceat(shares, np.arange(0, self.outputs, self.members))


@dataclass
class Parameters:
    """Vectors of input tokens, of outputs and then groups, weights of context places, and biases of outputs and then groups."""

    inputs: np.ndarray
    outputs: np.ndarray
    places: np.ndarray
    bias: np.ndarray
    sizes: Sizes

    NAMES = ("inputs", "outputs", "places", "bias")

    @classmethod
    def start(cls, log_share: np.ndarray, sizes: Sizes = Sizes()) -> Parameters:
        draw = np.random.Generator(np.random.PCG64(7))
        shapes = sizes.shapes()
        bias = np.concatenate([log_share, np.log(sizes.by_group(np.exp(log_share)))])
        return cls(draw.normal(0, 1 / np.sqrt(WIDTH), shapes[0]).astype(np.float32), draw.normal(0, 0.1, shapes[1]).astype(np.float32),
                   np.ones((CONTEXT, WIDTH), np.float32) / CONTEXT, bias.astype(np.float32), sizes)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).ravel() for name in self.NAMES])

    @classmethod
    def of(cls, values: np.ndarray, sizes: Sizes) -> Parameters:
        parts, at = [], 0
        for shape in sizes.shapes():
            parts.append(values[at:at + int(np.prod(shape))].astype(np.float32).reshape(shape))
            at += int(np.prod(shape))
        return cls(*parts, sizes)

    def inputs_of(self, context: np.ndarray) -> np.ndarray:
        """Sum of the input vectors of the token at each place."""
        rows = context.reshape(len(context), CONTEXT, -1)
        own = self.inputs.take(rows[:, :, 0], axis=0)
        for j in range(1, rows.shape[2]):
            own += self.inputs.take(rows[:, :, j], axis=0)
        return own

    def predicted(self, context: np.ndarray) -> np.ndarray:
        return np.einsum("nkw,kw->nw", self.inputs_of(context), self.places)

    def predicted_along(self, inputs: np.ndarray, first: np.ndarray) -> np.ndarray:
        """What :func:`contexts` and :meth:`predicted` give for all tokens of a piece; the vector of a token is looked up once for all its places."""
        own = self.inputs.take(inputs[:, 0], axis=0)
        for j in range(1, inputs.shape[1]):
            own += self.inputs.take(inputs[:, j], axis=0)
        out, last, before = np.zeros_like(own), np.empty_like(own), self.inputs[-1] * np.float32(inputs.shape[1])
        for k in range(CONTEXT):
            last[k + 1:] = own[:max(len(own) - k - 1, 0)]
            for j in range(k + 1):  # the first tokens of a text come after the start
                at = first[:-1] + j
                last[at[at < first[1:]]] = before
            last *= self.places[k]
            out += last
        return out

    def log_softmax_at(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target output after its context, normalised over all outputs."""
        return self.log_softmax(self.predicted(context), target)

    def log_softmax(self, predicted: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target output where such vectors are predicted, normalised over all outputs."""
        out, size = np.empty(len(target)), self.sizes
        outputs, members, groups = size.outputs, size.members, size.groups
        for lo in range(0, len(target), 64 * BATCH):
            group = target[lo:lo + 64 * BATCH] // members
            order = np.argsort(group.astype(np.uint16 if groups <= 1 << 16 else np.uint32), kind="stable")
            vectors, own, group = predicted[lo:lo + 64 * BATCH].take(order, axis=0), target[lo:lo + 64 * BATCH][order], group[order]
            lengths = np.einsum("ij,ij->i", vectors, vectors)
            vectors = np.concatenate([vectors, np.ones((len(vectors), 1), np.float32)], axis=1)  # for the biases
            logs = self._among(vectors, lengths, group, outputs, outputs + groups)
            edges = np.searchsorted(group, np.arange(groups + 1))
            for g in np.flatnonzero(np.diff(edges)):
                of, first = slice(edges[g], edges[g + 1]), g * members
                logs[of] += self._among(vectors[of], lengths[of], own[of] - first, first, min(first + members, outputs))
            out[lo + order] = logs
        return out

    def _among(self, vectors: np.ndarray, lengths: np.ndarray, target: np.ndarray, first: int, last: int) -> np.ndarray:
        """Log softmax over the rows ``first:last`` of outputs, at ``target``. The vectors end in a 1, ``lengths`` are their squares without it."""
        out, outputs, bias = np.empty(len(target)), self.outputs[first:last], self.bias[first:last]
        across = np.ones(last - first, np.float32)
        longest, highest = np.sqrt((outputs ** 2).sum(axis=1).max()), np.abs(bias).max()
        outputs = np.concatenate([outputs, bias[:, None]], axis=1).T
        at = np.arange(min(len(target), BATCH)) * (last - first)
        for lo in range(0, len(target), BATCH):
            part = vectors[lo:lo + BATCH]
            scores = part @ outputs
            own = scores.ravel().take(at[:len(part)] + target[lo:lo + BATCH]).astype(float)
            if np.sqrt(lengths[lo:lo + BATCH].max()) * longest + highest < 60:  # no exponential overflows or vanishes
                np.exp(scores, out=scores)
                out[lo:lo + BATCH] = own - np.log(scores @ across)
            else:
                top = scores.max(axis=1, keepdims=True)
                np.exp(scores - top, out=scores)
                out[lo:lo + BATCH] = own - top[:, 0] - np.log(scores @ across)
        return out


@dataclass
class Vocabulary:
    """What tasks need to know of the counts: the head tokens, output shares, and counts of frequent tokens."""

    sizes: Sizes
    head: np.ndarray  # sorted hashes
    rank: np.ndarray  # place of each by frequency, its output
    noise: np.ndarray  # share of each output among training tokens
    class_base: np.ndarray  # for each class log10 of its smoothed size
    known: np.ndarray  # sorted hashes of frequent tokens
    known_log: np.ndarray  # log10(count + 0.5) of each

    def ids(self, hashes: np.ndarray, suffix: np.ndarray, coded: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The two input numbers and the output number of tokens; ``coded`` are their distinct hashes, and the place of each there."""
        distinct, place = coded or _coded(hashes)
        hit, at = (x[place] for x in _found(self.head, distinct))
        if hit.any():
            at = np.where(hit, self.rank[at], 0)
        size = self.sizes
        own = np.where(hit, at, size.head + ((hashes >> np.uint64(20)) % np.uint64(size.hashed)).astype(np.int64))
        last = size.head + size.hashed + (suffix % np.uint64(SUFFIXES)).astype(np.int64)
        return np.stack([own, last], axis=1), np.where(hit, at, size.head + size.class_of(hashes, suffix))


def _coded(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the place of each value there."""
    coded = pa.array(hashes).dictionary_encode()
    values, place = coded.dictionary.to_numpy(), np.empty(len(coded.dictionary), np.int64)
    order = np.argsort(values)
    place[order] = np.arange(len(order))
    return values[order], place.take(coded.indices.to_numpy())


def _found(ordered: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are in an ordered array, and where."""
    if not len(ordered):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values, at


def contexts(inputs: np.ndarray, first: np.ndarray, sizes: Sizes) -> np.ndarray:
    """Input numbers of the last tokens before each token of the same text; a start token where there is none."""
    out = np.empty((len(inputs), CONTEXT, inputs.shape[1]), np.int64)
    for k in range(CONTEXT):
        out[k + 1:, k] = inputs[:max(len(inputs) - k - 1, 0)]
        for j in range(k + 1):
            at = first[:-1] + j
            out[at[at < first[1:]], k] = sizes.inputs - 1
    return out


class Trainer:
    """Noise-contrastive estimation with AdaGrad steps."""

    def __init__(self, model: Parameters, noise: np.ndarray, seed: int, rate: float = 0.3):
        self.model, self.rate, self.draw = model, rate, np.random.Generator(np.random.PCG64(seed))
        self.steps = {name: np.full_like(getattr(model, name), 1e-2) for name in model.NAMES}
        self.met = {name: np.zeros(len(getattr(model, name)), np.float32) for name in ("inputs", "outputs")}
        self.levels = []  # first row, sums of shares and logs for outputs and for groups
        for first, shares in ((0, noise), (model.sizes.outputs, model.sizes.by_group(noise))):
            self.levels.append((first, np.cumsum(shares), np.log(np.maximum(shares, 1e-12) * NOISE).astype(np.float32)))
        self.tokens = self.done = 0

    def read(self, context: np.ndarray, target: np.ndarray) -> None:
        """Steps over all tokens of a piece in random order."""
        mixed = self.draw.permutation(len(target))
        for lo in range(0, len(mixed), STEP):
            self.step(context.take(mixed[lo:lo + STEP], axis=0), target[mixed[lo:lo + STEP]])

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        m, n = self.model, len(target)
        self.tokens += n
        self.done += 1
        rate = self.rate * min(1.0, self.done / RISE)
        known = m.inputs_of(context)
        vectors = np.einsum("nkw,kw->nw", known, m.places)
        back, rows, pulls, lifts = np.zeros_like(vectors), [], [], []
        for (first, edges, log_noise), own_row in zip(self.levels, (target, target // m.sizes.members), strict=True):
            noise_row = np.minimum(np.searchsorted(edges, self.draw.random(NOISE) * edges[-1]), len(edges) - 1)
            at, other_at = first + own_row, first + noise_row
            data, others = m.outputs.take(at, axis=0), m.outputs[other_at]
            own = np.einsum("ij,ij->i", vectors, data) + m.bias.take(at) - log_noise.take(own_row)
            other = vectors @ others.T
            other += m.bias[other_at] - log_noise[noise_row]
            up = 1 / (1 + np.exp(np.clip(own, -30, 30)))  # how far the data is from being told from noise
            down = _logistic(other)
            data *= up[:, None]
            back += data
            back -= down @ others
            rows += [at, other_at]
            pulls += [up[:, None] * vectors, -(down.T @ vectors)]
            lifts += [up, -down.sum(axis=0)]
        places = np.einsum("nw,nkw->kw", back, known)
        moved = (back[:, None, :] * m.places).reshape(-1, WIDTH)  # one for all vectors of a token
        seen, times, inputs = _scatter(np.moveaxis(context.reshape(n, CONTEXT, -1), 2, 0).ravel(), moved, len(m.inputs))
        self.met["inputs"][seen] += times
        self._move("inputs", seen, inputs, n, rate)
        lift = np.concatenate(lifts)
        seen, times, outputs = _scatter(np.concatenate(rows), np.concatenate(pulls), len(m.outputs))
        self.met["outputs"][seen] += times
        self._move("outputs", seen, outputs, n, rate)
        self._move("bias", seen, np.bincount(np.concatenate(rows), weights=lift, minlength=len(m.bias))[seen], n, rate)
        self._move("places", None, places, n, rate)

    def _move(self, name: str, rows: np.ndarray | None, gradient: np.ndarray, n: int, rate: float) -> None:
        """An AdaGrad step of the rows that have a gradient, or of all."""
        values, steps = getattr(self.model, name), self.steps[name]
        gradient = (gradient / n).astype(np.float32, copy=False)
        size = gradient * gradient
        size += steps if rows is None else steps.take(rows, axis=0)
        _put(steps, rows, size)
        np.sqrt(size, out=size)
        np.divide(gradient, size, out=gradient)
        gradient *= np.float32(rate)
        gradient += values if rows is None else values.take(rows, axis=0)
        _put(values, rows, gradient)

    def weights(self) -> list[np.ndarray]:
        """How much each row of the parameters counts in an average: as often as it was met, and a little if never."""
        inputs, outputs = self.met["inputs"] + np.float32(1e-3), self.met["outputs"] + np.float32(1e-3)
        return [inputs, outputs, np.full(CONTEXT, self.tokens, np.float32), outputs]


def _weighted(model: Parameters, weights: list[np.ndarray]) -> np.ndarray:
    """All parameters times the weights of their rows, and then those weights."""
    parts = [getattr(model, name) * (w[:, None] if getattr(model, name).ndim > 1 else w) for name, w in zip(model.NAMES, weights, strict=True)]
    return np.concatenate([x.ravel() for x in parts + weights]).astype(np.float32)


def _average(sums: np.ndarray, sizes: Sizes) -> Parameters:
    """Parameters from the sums of what :func:`_weighted` gives."""
    shapes = sizes.shapes()
    at, parts = sum(int(np.prod(x)) for x in shapes), []
    model = Parameters.of(sums, sizes)
    for name, shape in zip(model.NAMES, shapes, strict=True):
        weight = sums[at:at + shape[0]].astype(np.float32)
        at += shape[0]
        parts.append(getattr(model, name) / (weight[:, None] if len(shape) > 1 else weight))
    return Parameters(*parts, sizes)


def _put(table: np.ndarray, rows: np.ndarray | None, values: np.ndarray) -> None:
    """``table[rows] = values``, each row copied at once, or the whole table."""
    if rows is None:
        table[:] = values
    elif table.ndim == 1:
        table[rows] = values
    else:
        row = np.dtype((np.void, table.strides[0]))
        table.view(row)[:, 0][rows] = values.view(row)[:, 0]


def _scatter(at: np.ndarray, values: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct numbers in ``at``, how often each occurs, and the sums of the rows of ``values``, taken round and round, by them."""
    narrow = at.astype(np.uint16 if rows <= 1 << 16 else np.uint32)
    order = np.argsort(narrow, kind="stable")
    ordered = narrow[order]
    head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    times = np.diff(np.append(head, len(at)))
    if len(at) > len(values):
        order %= len(values)
    sums = values.take(order[head], axis=0)
    for k in range(1, FEW_ROWS):  # most occur a few times: whole rows are added then
        more = np.flatnonzero((times > k) & (times <= FEW_ROWS))
        _put(sums, more, sums.take(more, axis=0) + values.take(order[head[more] + k], axis=0))
    often = times > FEW_ROWS
    if often.any():
        long = times[often]
        _put(sums, often, np.add.reduceat(values.take(order[np.repeat(often, times)], axis=0), np.cumsum(long) - long, axis=0))
    return ordered[head].astype(np.int64), times, sums


def _logistic(x: np.ndarray) -> np.ndarray:
    """``1 / (1 + exp(-x))`` in place, of values cut to 30."""
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def token_counts(docs: DataFrame, text: str, keep: int = 1 << 21) -> DataFrame:
    """``(token, suffix, times)`` over all rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            for _, flat in pieces(batch.column(0)):
                hashes, suffix, _ = token_hashes(flat)
                values, place = _coded(hashes)
                ending = np.empty(len(values), np.uint64)
                ending[place] = suffix  # equal tokens have equal ones
                held.append((values, ending, np.bincount(place, minlength=len(values))))
                size += len(values)
                if size > 2 * keep:
                    held = [_merged(held)]
                    size = len(held[0][0])
                    if size > keep:
                        yield _counted(held[0])
                        held, size = [], 0
        if held:
            yield _counted(_merged(held))

    return (docs.select(F.col(text).cast("string")).mapInArrow(count, "token long, suffix long, times long")
            .groupBy("token").agg(F.min("suffix").alias("suffix"), F.sum("times").alias("times")))


def _merged(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    hashes, suffix, times = (np.concatenate(x) for x in zip(*held, strict=True))
    values, at, place = np.unique(hashes, return_index=True, return_inverse=True)
    return values, suffix[at], np.bincount(place, weights=times).astype(np.int64)


def _counted(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(signed(rows[0])), pa.array(signed(rows[1])), pa.array(rows[2].astype(np.int64))],
                                      names=["token", "suffix", "times"])


def vocabulary(counts: DataFrame, types: int) -> Vocabulary:
    """From saved counts of so many tokens: bounded lists of frequent tokens and sums by class."""
    sizes = Sizes.of(types)
    tokens, times = frequent(counts, "token", "times", max(KNOWN, sizes.head))
    top = tokens[:KNOWN], times[:KNOWN]
    head = tokens[:sizes.head].view(np.uint64)
    own = np.zeros(sizes.head)
    own[:len(head)] = times[:sizes.head]
    rank = np.argsort(head)
    head = head[rank]
    shared = counts.sparkSession.sparkContext.broadcast(head)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, types = np.zeros(sizes.classes), np.zeros(sizes.classes)
        for batch in batches:
            hashes, suffix, times = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
            rare = ~_found(shared.value, hashes.view(np.uint64))[0]
            at = sizes.class_of(hashes[rare].view(np.uint64), suffix[rare].view(np.uint64))
            sums += np.bincount(at, weights=times[rare], minlength=sizes.classes)
            types += np.bincount(at, minlength=sizes.classes)
        full = np.flatnonzero(types)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(sums[full]), pa.array(types[full])], names=["at", "total", "n"])

    by_class = counts.select("token", "suffix", "times").mapInArrow(add, "at long, total double, n double").groupBy("at").agg(F.sum("total"), F.sum("n")).toArrow()
    sums, types_in = np.zeros(sizes.classes), np.zeros(sizes.classes)
    at, sums_in, n = (x.to_numpy() for x in by_class.columns)
    sums[at], types_in[at] = sums_in, n
    smooth = np.concatenate([own, sums]) + 0.5
    order = np.argsort(top[0].view(np.uint64))
    return Vocabulary(sizes, head, rank, smooth / smooth.sum(), np.log10(sums + 0.5 * (types_in + 1)), top[0].view(np.uint64)[order], np.log10(top[1][order] + 0.5))


def _rounds(docs: DataFrame, text: str, words: Vocabulary, model: Parameters, limit: int | None) -> Parameters:
    """One round: every task trains from ``model`` on its texts, or on ``limit`` tokens in a warm-up; the average."""
    shared = docs.sparkSession.sparkContext.broadcast((words, model.flat()))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, start = shared.value
        task = TaskContext.get().partitionId()
        trainer = Trainer(Parameters.of(start, words.sizes), words.noise, task)
        held, size = [], 0
        for batch in batches:  # to the end also in a warm-up: a worker that leaves rows unread is not used again
            for _, flat in pieces(batch.column(0)) if limit is None or size < limit else ():
                hashes, suffix, first = token_hashes(flat)
                inputs, outputs = words.ids(hashes, suffix)
                context = contexts(inputs, first, words.sizes)
                if limit is None:
                    trainer.read(context, outputs)
                    continue
                held.append((context[:limit - size], outputs[:limit - size]))
                size += len(held[-1][1])
                if size >= limit:
                    break
        if size:  # a small share is read again until the warm-up is as long as any other
            context, outputs = (np.concatenate(x) for x in zip(*held, strict=True))
            again = np.arange(limit) % size
            trainer.read(context[again], outputs[again])
        if trainer.tokens:
            flat_model = _weighted(trainer.model, trainer.weights())
            count = -(-len(flat_model) // BLOCK)
            flat_model = np.concatenate([flat_model, np.zeros(count * BLOCK - len(flat_model), np.float32)])
            yield _blocks(np.arange(count), task, trainer.tokens / 1e6, flat_model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight, total, task = None, 0.0, None, 0
        for batch in batches:
            keys, weights = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            values = batch.column(3).flatten().to_numpy().reshape(-1, BLOCK)
            for k in range(len(keys)):
                if keys[k] != block:
                    if block is not None:
                        yield _blocks(np.array([block]), task, weight, total)
                    block, weight, total, task = keys[k], 0.0, np.zeros(BLOCK, np.float64), int(batch.column(1)[k].as_py())
                weight += weights[k]
                total += values[k]
        if block is not None:
            yield _blocks(np.array([block]), task, weight, total)

    schema = "block int, task int, weight double, values array<float>"
    sums = docs.select(F.col(text).cast("string")).mapInArrow(train, schema)
    sums = sums.repartition("block", F.pmod("task", F.lit(32))).sortWithinPartitions("block", "task").mapInArrow(add, schema)
    sums = sums.repartition("block").sortWithinPartitions("block", "task").mapInArrow(add, schema)
    rows = sums.select("block", "values").toArrow().sort_by("block")  # one row for each block of the model
    if not len(rows):
        return model
    return _average(rows.column("values").combine_chunks().flatten().to_numpy().astype(np.float64), words.sizes)


def _blocks(block: np.ndarray, task: int, weight: float, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(np.full(len(block), task), pa.int32()), pa.array(np.full(len(block), weight)),
                                       lists(values.astype(np.float32), np.full(len(block), BLOCK))], names=["block", "task", "weight", "values"])


def score_texts(docs: DataFrame, learn: Column, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, learned, n_tokens, n_known, train_tokens, base_score, score)`` of every row, in log10.

    Rows that meet ``learn`` are learned from. The base is the unigram with half a count added to every known token and one unknown.
    """
    training = docs.where(learn)
    counts = saved(token_counts(training, text), "token-counts")
    total, types = counts.agg(F.coalesce(F.sum("times"), F.lit(0)), F.count(F.lit(1))).first()
    words = vocabulary(counts, types)
    model = Parameters.start(np.log(words.noise), words.sizes)
    if total:
        model = _rounds(training, text, words, model, max(LEAST, min(WARM_UP, WARM_UP * FEW // total)))
        model = _rounds(training, text, words, model, None)
    shared = docs.sparkSession.sparkContext.broadcast((words, model.flat()))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, values = shared.value
        model, row = Parameters.of(values, words.sizes), TaskContext.get().partitionId() << 36
        for batch in batches:
            for at, flat in pieces(batch.column(2)):
                hashes, suffix, first = token_hashes(flat)
                values, place = _coded(hashes)
                inputs, outputs = words.ids(hashes, suffix, (values, place))
                logs = model.log_softmax(model.predicted_along(inputs, first), outputs) / np.log(10)
                rare = outputs >= words.sizes.head
                logs[rare] -= words.class_base[outputs[rare] - words.sizes.head]
                near = np.minimum(np.searchsorted(words.known, values), max(len(words.known) - 1, 0))
                known = words.known[near] == values if len(words.known) else np.zeros(len(values), bool)
                own = np.where(known, words.known_log[near], 0.0)[place] if len(words.known) else np.zeros(len(place))
                known = known[place]
                left = np.flatnonzero(~known)
                owner = np.searchsorted(first, left, side="right") - 1
                order = np.lexsort((hashes[left], owner))
                owner, late = owner[order], hashes[left[order]]
                head = np.flatnonzero(np.concatenate([np.ones(min(len(late), 1), bool), (late[1:] != late[:-1]) | (owner[1:] != owner[:-1])]))
                n, distinct = len(flat), np.bincount(owner[head], minlength=len(flat))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(n)), *[batch.column(k).slice(at, n) for k in range(2)], pa.array(np.diff(first)), pa.array(_by_text(known, first).astype(np.int64)),
                     pa.array(_by_text(own, first)), pa.array(_by_text(logs + np.where(rare, own, 0.0), first)), lists(signed(late[head]), distinct), lists(np.diff(np.append(head, len(late))), distinct)],
                    names=["row", "doc_id", "learned", "n_tokens", "n_known", "logs", "score", "left", "n_left"])
                row += n

    schema = "row long, doc_id long, learned boolean, n_tokens long, n_known long, logs double, score double, left array<long>, n_left array<long>"
    source = docs.select(F.col(doc).cast("long").alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learned"), F.col(text).cast("string").alias("text"))
    scored = saved(source.mapInArrow(measure, schema), "scored")
    tokens = scored.select("row", F.inline(F.arrays_zip(F.col("left"), F.col("n_left").alias("n"))))
    met = tokens.join(counts.select("token", "times"), F.col("left") == F.col("token"), "left")
    late = met.groupBy(F.col("row").alias("of")).agg(F.sum(F.when(F.col("times").isNotNull(), F.col("n")).otherwise(0)).alias("more"),
                                                     F.sum(F.col("n") * F.log10(F.coalesce("times", F.lit(0)) + 0.5)).alias("more_logs"))
    base = float(np.log10(total + 0.5 * (types + 1)))
    added = F.coalesce("more_logs", F.lit(0.0))
    return scored.join(late, F.col("row") == F.col("of"), "left").select(
        "doc_id", "learned", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("logs") + added - F.col("n_tokens") * base).alias("base_score"), (F.col("score") + added).alias("score"))


def _by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return sums[first[1:]] - sums[first[:-1]]
