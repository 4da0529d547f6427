"""Prefix counts, periodic runs and the Merkle manifest against plain Python, and on their edge cases."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.test_edges import ROWS, SCHEMA
from urbanweave.llm import kernels, merkle, periodic, prefix_counts, queries

MODEL = queries.tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, None, "s", None, 5, "x", 0.5, 1, 2, "h", None, "t", 1, 2, 3, "z", 9) for d, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_every_prefix_has_the_count_of_the_library(library):
    draw = random.Random(4)
    letters = "  ab theingnos1 2é漢\n\t▁<s>.,!?-ХлоąÅ\x00\U0001F600"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(300)]
    texts += [" " * k for k in range(40)] + ["x" + " " * 40 + "the", "a" * 80, "=-=-=-=---====-----" * 3, "hahaha" * 9, "<0x0A><s></s><unk>", "▁▁▁ ▁", "über straße", "1234567890" * 4]
    texts += [(t or "")[:120] for _, t in ROWS]
    words = prefix_counts.vocabulary(MODEL)
    for limit in (1 << 20, 50):
        for at, flat in kernels.pieces(pa.array(texts), limit):
            counts, first = words.count(flat)
            for k in range(len(flat)):
                own = texts[at + k]
                assert counts[first[k]:first[k + 1]].tolist() == [len(x) for x in library.encode([own[:n + 1] for n in range(len(own))])], own


def test_other_vocabularies_are_refused():
    with pytest.raises(Exception):
        prefix_counts.PieceVocabulary(queries.tokenizer_file("word_bpe_49k.json"))


@pytest.mark.parametrize("part", [prefix_counts.PART, 7])
def test_prefix_counts(spark, docs, library, part):
    rows = [(d, t if t is None or len(t) < 3000 else t[:3000]) for d, t in ROWS]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, row int, part int")
    counts = prefix_counts.prefix_counts(table, MODEL, part=part)
    got = sorted((str(r.doc), r.n_bytes, r.n_chars, r.n_tokens) for r in prefix_counts.totals(counts).collect())
    whole = {t: library.encode([(t or "")[:n] for n in range(len(t or "") + 1)]) for _, t in rows}
    assert got == sorted((str(d), len((t or "").encode()), len(t or ""), len(whole[t][-1])) for d, t in rows)
    for budget in (0, 1, 20, 400):
        best = {}
        for d, t in rows:
            fit = max(n for n in range(len(t or "") + 1) if len(whole[t][n]) <= budget)
            best.setdefault(str(d), []).append((fit, len(whole[t][fit])))
        named = prefix_counts.longest_prefixes(counts, budget).collect()
        assert sorted((str(r.doc), r.n_bytes, r.n_chars, r.n_tokens) for r in named) == got
        assert sorted((str(r.doc), r.fit_chars, r.fit_tokens) for r in named) == sorted((d, *x) for d, many in best.items() for x in many)
    places = spark.createDataFrame([(1, 0), (1, 7), (1, 8), (1, 10**9), (5, 3), (16, 14), (4, -1), (99, 5)], "doc long, n_chars long")
    text = dict(r for r in rows if r[0] != 2)
    got = {(r.doc, r.n_chars): r.n_tokens for r in prefix_counts.tokens_before(counts, places).collect()}
    assert got == {(d, n): len(whole[text[d]][max(0, min(n, len(text[d] or "")))]) for d, n in [(1, 0), (1, 7), (1, 8), (1, 10**9), (5, 3), (16, 14), (4, -1)]}
    assert prefix_counts.prefix_counts(docs.limit(0), MODEL).count() == 0


def plain_runs(words, times=4, shortest=6):
    out = []
    for q in range(1, len(words) // times + 1):
        at = 0
        while at < len(words) - q:
            end = at
            while end < len(words) - q and words[end] == words[end + q]:
                end += 1
            size = end - at + q
            if end > at and size >= max(shortest, times * q) and not any(words[at:at + size - d] == words[at + d:at + size] for d in range(1, q)):
                out.append((at, size, q))
            at = max(end, at + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    draw = random.Random(3)
    for _ in range(600):
        words = [draw.randrange(draw.choice([1, 2, 3, 5, 30])) for _ in range(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 3)):
            if len(words) > 8:
                p, s = draw.randint(1, 6), draw.randrange(len(words))
                for i in range(s + p, min(len(words), s + p * draw.randint(3, 7) + draw.randrange(p))):
                    words[i] = words[i - p]
        own = np.array(words, np.uint64)
        for times, shortest in ((4, 6), (5, 5), (4, 12)):
            got = [(int(lo) + a, n, q) for lo, hi in zip(*periodic.stable_segments(own, np.array([0, len(own)]), times, shortest))
                   for a, n, q in periodic.runs_in(own[lo:hi], times, shortest)]
            assert got == plain_runs(words, times, shortest)


def test_splitting_ends_with_the_same_runs(monkeypatch):
    draw = np.random.default_rng(2)
    own = np.concatenate([draw.integers(0, 40, 300), np.tile(np.arange(5), 6), draw.integers(0, 9, 200)]).astype(np.uint64)
    monkeypatch.setattr(periodic, "ROUNDS", 0)
    segments = periodic.stable_segments(own, np.array([0, len(own)]), 4, 6)
    assert list(segments[0]) == [0] and periodic.runs_in(own, 4, 6) == plain_runs(own.tolist())


def test_hot_words_are_not_quadratic():
    for own in (np.zeros(100_000), np.tile(np.arange(7), 15_000), np.concatenate([np.zeros(60_000), np.ones(1), np.zeros(40_000)])):
        found = periodic.runs_in(own.astype(np.uint64), 4, 6)
        assert 1 <= len(found) <= 2


def test_periodic_runs(spark, docs):
    extra = [(50, "x  y\n" * 9 + "z"), (51, "A a A a A a A a"), (52, "no no no no no no"), (53, "no no no no no"), (54, "a b " * 40_000)]
    table = docs.select("doc_id", "text", F.lit(1).alias("runs"), F.lit(2).alias("collapsed")).union(spark.createDataFrame([(*r, 1, 2) for r in extra]))
    got = periodic.periodic_runs(table).collect()
    want = []
    for d, t in [*ROWS, *extra[:-1]]:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = plain_runs(words) if len(words) < 1000 else []
        gone = {k for a, n, q in runs for k in range(a + q, a + n)}
        want.append(str((d, len(words), runs, " ".join(w for k, w in enumerate(words) if k not in gone))))
    assert sorted(str((r.doc, r.n_words, [tuple(x) for x in r.runs], r.collapsed)) for r in got if r.doc != 54) == sorted(want)
    long = next(r for r in got if r.doc == 54)
    assert [tuple(x) for x in long.runs] == [(0, 80_000, 2)] and long.collapsed == "a b"
    placed = periodic.periodic_runs(table.where("doc_id in (11, 15) or doc_id is null"), arrange=lambda d, n: np.zeros(8, np.int64) if n else None).collect()
    assert {r.doc: r.collapsed for r in placed if r.doc} == {11: "one", 15: dict(ROWS)[15].split()[0]}
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, times=3)


def test_the_layout_puts_subtrees_together():
    for height in range(8):
        levels = height + 1
        every = [merkle.address(levels, d, k) for d in range(levels) for k in range(3**d)]
        assert sorted(every) == list(range(merkle.nodes_in(levels)))
        if height:
            upper = levels - levels // 2
            for which in range(3**upper):
                own = [merkle.address(levels, d, which * 3 ** (d - upper) + k) for d in range(upper, levels) for k in range(3 ** (d - upper))]
                assert max(own) - min(own) == len(own) - 1
    assert merkle.bands(0) == [] and merkle.bands(23) == [5, 6, 6, 6] and max(merkle.bands(40)) <= merkle.BLOCK


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """Root, and for every leaf its siblings, level by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, at in enumerate(places):
            run = at // 3 * 3
            paths[leaf].append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 3])))
            places[leaf] = at // 3
        nodes = [digest(*nodes[k:k + 3]) for k in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain_manifest(rows, other):
    def leaf(row):
        return digest(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])

    groups, out = {}, []
    for row in rows:
        groups.setdefault(row[1], []).append((-1 if row[0] is None else row[0], leaf(row), leaf(other(row)), row[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [plain_tree([x[1] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names]
    top, above = plain_tree([t[0] for t in trees])
    for k, g in enumerate(names):
        for (_, own, received, key), path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[k][1]):
            path, cur = path + above[k], received
            for before, after in path:
                cur = digest(before, cur, after)
            out.append(str((key, own, trees[k][0], top, digest(*[b + a for b, a in path]), cur)))
    return sorted(out)


@pytest.mark.parametrize("block", [merkle.BLOCK, 1, 2])
def test_merkle_manifest(spark, monkeypatch, block):
    monkeypatch.setattr(merkle.bands, "__defaults__", (block,))
    draw = random.Random(block)
    rows = [(k, draw.choice(["a", "a", "a", "b", None, "é", f"s{k % 40}"]), draw.choice(["en", None]), draw.choice([None, 5]), draw.choice([None, "", "x\ny", f"text {k}\n"]))
            for k in range(400)]
    rows += [rows[7], rows[7], (None, "a", None, None, None), (None, "a", None, None, "z\n"), (None, None, None, None, None), (7, rows[7][1], "de", 1, "other")]
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    table = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, `group` int, digest string, key string").repartition(3)
    bare = F.when(F.col("doc_id") % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    got = merkle.prove(merkle.build_manifest(table, "source", "doc_id", names, {"text": bare})).collect()
    want = plain_manifest(rows, lambda r: (*r[:4], r[4].replace("\n", "") if r[4] and r[0] is not None and r[0] % 2 == 0 else r[4]))
    assert sorted(str((r.key, r.leaf, r.subroot, r.root, r.proof, r.folded)) for r in got) == want
    assert {(r.folded == r.root) for r in got} == {True, False}


def test_merkle_manifest_of_few_rows(spark):
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    kinds = "doc_id long, source string, lang string, n_chars long, text string"
    for rows in ([(1, None, None, None, None)], [(1, "a", "x", 3, "t"), (2, "b", "x", 3, "t")], [(k, "a", "", 0, str(k)) for k in range(4)]):
        got = merkle.prove(merkle.build_manifest(spark.createDataFrame(rows, kinds), "source", "doc_id", names)).collect()
        assert sorted(str((r.key, r.leaf, r.subroot, r.root, r.proof, r.folded)) for r in got) == plain_manifest(rows, lambda r: r)
    empty = merkle.build_manifest(spark.createDataFrame([], kinds), "source", "doc_id", names)
    assert merkle.prove(empty).count() == 0


def test_blocks_hold_the_nodes_at_their_addresses():
    for height, count in itertools.product((1, 2, 3), (1, 2, 3, 5, 9, 20, 27)):
        if count <= 3**height:
            leaves = [digest(str(k)) for k in range(count)]
            nodes, root = merkle.fill_block(leaves, height)
            for k in range(count):
                assert merkle.fold(leaves[k], merkle.siblings(nodes, height, count, k)) == root
