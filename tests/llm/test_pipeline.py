"""The pipeline against plain Python, stage by stage, on the smallest tables."""

import os
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_edges import plain_groups
from urbanweave.llm import kernels, quality, queries, tokens

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain_quality(rows, labels):
    x = {d: quality.statistics(kernels.Flat(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])))[0] for d, t in rows}
    learned = [(x[d], q) for d, q in labels if d in x and zlib.crc32(str(d).encode()) % 5 != 0]
    groups = [np.array([v for v, q in learned if q == k]) for k in (0, 1)]
    own = [np.cov(g.T, bias=True) for g in groups]
    pooled = sum(c * len(g) for c, g in zip(own, groups)) / sum(map(len, groups))
    odds = {d: np.log(len(groups[1]) / len(groups[0])) for d in x}
    for k, sign in ((0, -1), (1, 1)):
        mixed = 0.95 * (0.9 * own[k] + 0.1 * pooled) + 0.05 * np.diag(np.diag(pooled)) + 1e-6 * np.eye(len(pooled))
        back, size = np.linalg.inv(mixed), np.linalg.slogdet(mixed)[1]
        for d, v in x.items():
            gap = v - groups[k].mean(axis=0)
            odds[d] += sign * -0.5 * (gap @ back @ gap + size)
    eased = {d: np.sign(o) * (np.sqrt(1 + 2 * abs(o)) - 1) for d, o in odds.items()}
    return {d for d, o in eased.items() if 1 / (1 + np.exp(-o)) >= 0.3}


def plain_lines(rows):
    keeper, key = {}, lambda line: low(line.strip(" \t\n\x0b\x0c\r"))
    for d, t in sorted(rows):
        for line in t.split("\n"):
            keeper.setdefault(key(line), d)
    return [(d, "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or keeper[key(x)] == d)) for d, t in rows]


def plain_clean(rows, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    grams = set()
    for _, text in items:
        own = word.findall(low(text or ""))
        size = min(10, len(own))
        grams |= {tuple(own[k:k + size]) for k in range(len(own) - size + 1)} if own else set()
    out = []
    for d, t in rows:
        found = list(word.finditer(low(t)))
        hit = [False] * len(found)
        for size in {len(g) for g in grams}:
            for k in range(len(found) - size + 1):
                if tuple(m[0] for m in found[k:k + size]) in grams:
                    hit[k:k + size] = [True] * size
        if found and all(hit):
            continue
        left, at = "", 0
        for k, m in enumerate(found):
            if hit[k]:
                if not (k and hit[k - 1]):
                    left += t[at:m.start()]
                at = m.end()
        out.append((d, left + t[at:]))
    return out


def test_stages(spark):
    read = lambda name: duckdb.sql(f"select * from '{FOLDER}/{name}.parquet'").fetchall()
    rows = [(r[0], r[1] or "") for r in read("documents")]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, FOLDER), "test-stage")
        assert docs.columns == columns
        if name == "quality classifier":
            kept = plain_quality(rows, [(r[0], r[1]) for r in read("labels")])
            rows = [r for r in rows if r[0] in kept]
        elif name == "line dedup":
            rows = plain_lines(rows)
        elif name == "n-gram Jaccard join":
            label = plain_groups(rows)
            rows = [r for r in rows if label[r[0]] == r[0]]
        else:
            rows = plain_clean(rows, read("benchmark"))
        got = docs.select("doc_id", "text", "n_chars").collect()
        assert sorted((r.doc_id, r.text) for r in got) == sorted(rows), name
        assert all(r.n_chars == len(r.text) for r in got) or name == "quality classifier"
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    library = tokens.tokenizer(queries.tokenizer_file("word_bpe_49k.json")).library
    lengths = {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for d, t in rows}
    assert {r.doc_id: r.doc_tokens for r in packed} == lengths and sum(r.length for r in packed) == sum(lengths.values())
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(tuple, packed))
