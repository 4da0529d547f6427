"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import itertools
import random
import re
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from urbanweave.llm import covertree, decontamination, jaccard, kernels, language_model, lines, packing, passages, quality, queries, sharding, tokens, warc
from urbanweave.llm.components import components
from urbanweave.llm.shared import frequent, saved
from urbanweave.session import scratch_path, shared_folder

WORDS = [f"w{k}é" if k % 7 == 0 else f"word{k}" for k in range(400)]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words long, found string, score double, shard int, slot long, hash string, lost string, "
          "`__text` string, doc long, node long, unit int, size string, start long")


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n))


LONG = prose(1, 60_000)
SHARED = " ".join(w for w in prose(2, 50).split() if w.isascii())
ROWS = [
    (1, prose(3, 200)), (2, prose(3, 200)), (2, prose(3, 200)), (3, prose(3, 199) + " other"), (4, None), (5, ""), (6, " \n\t "), (7, LONG), (8, LONG + " tail"),
    (9, f"Short line here\n{SHARED}\nown {prose(4, 30)}"), (10, f"SHORT line here  \n{SHARED.upper()}\nown {prose(5, 30)}"), (11, "one"), (12, "one"), (13, "!!! *** $$$"),
    (None, prose(6, 50)), (None, None), (14, "the end\n\n\nthe end\n"), (15, prose(7, 12)), (16, "İstanbul ΑΣ it's <|endoftext|> é   x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, None, "s", None, 5, "x", 0.5, 1, 2, "h", None, "t", 1, 2, 3, "z", 9) for d, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def words_of(text, kind=kernels.BROAD):
    flat = kernels.Flat(np.frombuffer((text or "").encode(), np.uint8), np.array([0, len((text or "").encode())]))
    found = flat.words(kind)
    return [flat.low[s:e].tobytes() for s, e in zip(found.start, found.end)]


def test_kernels_agree_with_plain_python():
    texts = [t for _, t in ROWS] + ["\n", "a\n", "\nb", " a b c\x1cd "]
    for limit in (1, 1 << 22):
        out = []
        for at, flat in kernels.pieces(pa.array(texts), limit):
            start, end, first = flat.lines()
            out += [[flat.raw[s:e].tobytes() for s, e in zip(start[first[k]:first[k + 1]], end[first[k]:first[k + 1]])] for k in range(len(flat))]
        assert out == [(t or "").encode().split(b"\n") for t in texts]
    flat = next(kernels.pieces(pa.array(["aB cd", "x ab CD ab"])))[1]
    hashes = flat.words(kernels.BROAD).hashes().tolist()
    assert hashes[:2] == hashes[3:5] and hashes[0] == hashes[5] and len(set(hashes)) == 3


def test_sharding(spark, docs, nothing):
    got = sharding.shard_rows(docs, 3).collect()
    assert len(got) == len(ROWS)
    counts = [sorted(r.slot for r in got if r.shard == s) for s in range(3)]
    assert all(c == list(range(len(c))) for c in counts) and max(map(len, counts)) - min(map(len, counts)) <= 1
    assert sorted(map(str, sharding.shard_rows(docs.repartition(5), 3).collect())) == sorted(map(str, got))
    assert sharding.shard_rows(nothing, 3).count() == 0


def test_a_new_shard_moves_few_rows(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    place = [{r.doc_id: r.shard for r in sharding.shard_rows(rows, n, slack=0.25).collect()} for n in (8, 9)]
    moved = sum(place[0][d] != place[1][d] for d in place[0])
    assert moved < 0.25 * 20_000


def test_repeated_rows_fill_no_hot_cell(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    got = sharding.shard_rows(rows, 4).groupBy("shard").count().collect()
    assert {r["count"] for r in got} == {750}


def plain_fill(cells, owned, shards, slack=0.0):
    """Every cell asks the shards in the order it meets them clockwise."""
    total = sum(cells.values())
    room = [int((total // shards) * (1 + slack)) + (k < total % shards) for k in range(shards)]
    used, plan = [0] * shards, []
    for (turn, arc), count in sorted(cells.items()):
        rank = 0
        for shard in dict.fromkeys(owned[(arc + k) % len(owned)][1] for k in range(len(owned))):
            take = min(count - rank, room[shard] - used[shard])
            if take > 0:
                plan.append((turn, arc, rank, rank + take, shard, used[shard]))
                used[shard] += take
                rank += take
    return plan


def test_filling_follows_the_ring():
    draw = random.Random(7)
    for shards, slack in ((3, 0.0), (8, 0.25), (40, 0.0)):
        owned = sharding.ring(shards, 5)
        cells = {(t, a): draw.randint(0, 30) for t in range(4) for a in range(len(owned))}
        assert sharding.fill(cells, owned, shards, slack) == plain_fill(cells, owned, shards, slack)


@pytest.mark.parametrize("constant", [sharding.CONSTANT, 0])
def test_hundreds_of_shards(spark, monkeypatch, constant):
    monkeypatch.setattr(sharding, "CONSTANT", constant)
    rows = spark.range(5_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_rows(rows, 300).collect()}
    assert len(got) == 5_000 and len({s for s, _ in got.values()}) == 300 and {sum(s == k for s, _ in got.values()) for k in (0, 150, 299)} <= {16, 17}
    ring = sharding.ring(300)
    assert len(ring) == 300 * 64 and [k for k in sharding.ring(299) if k not in ring] == []


def test_frequent_keys_whatever_the_limit(spark):
    draw = random.Random(3)
    times = {draw.getrandbits(64) - (1 << 63): draw.choice([1, 2, 3, 5000, 5001, 9000, 10**7]) for _ in range(400)}
    counts = saved(spark.createDataFrame(sorted(times.items()), "token long, times long"), "counts")
    order = sorted(times.items(), key=lambda x: (-x[1], x[0]))
    for limit in (1, 2, 3, 50, 150, 290, 399, 400, 1000):
        assert list(zip(*(x.tolist() for x in frequent(counts, "token", "times", limit)))) == order[:limit]
    assert len(frequent(counts.limit(0), "token", "times", 5)[0]) == 0


def test_the_head_is_taken_where_the_first_level_is_full(spark, monkeypatch):
    texts = spark.createDataFrame([("a b c " * 6000,)], "text string")
    counts = saved(language_model.token_counts(texts, "text"), "token-counts")
    monkeypatch.setattr(language_model, "KNOWN", 2)
    words = language_model.vocabulary(counts, 4)
    assert len(words.head) == 4 and len(words.known) == 2


def test_quality(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (13, 0), (5, 0), (5, 0), (None, 1), (7, None), (9, 2)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model, ["doc_id"], name="mark").collect()
    assert len(got) == len(ROWS) and all(0 <= r.mark <= 1 for r in got)
    assert quality.keep_good(docs, model).columns == docs.columns
    one_class = quality.fit(docs, labels.where("quality = 1"))
    assert {r.mark for r in quality.score(docs, one_class, ["doc_id"], name="mark").collect()} == {1.0}
    assert {r.mark for r in quality.score(docs, quality.fit(nothing, labels), ["doc_id"], name="mark").collect()} == {0.5}
    assert quality.score(nothing, model, ["doc_id"]).count() == 0


def test_decontamination(spark, docs, nothing):
    items = [(1, " ".join(SHARED.split()[5:25])), (2, "ONE"), (3, None), (4, ""), (None, SHARED), (5, "one"), (2, "one"), (6, "not there at all")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = {}
    for limit in (1 << 18, 3):
        got = decontamination.find_contamination(docs, benchmark, limit=limit).collect()
        whole[limit] = sorted((str(r.doc_id), r.found.n_words, r.found.n_hit, str(r.found.items)) for r in got)
    assert whole[3] == whole[1 << 18]
    by_id = {r.doc_id: r.found for r in got}
    assert by_id[9].n_hit == by_id[10].n_hit == 20 and by_id[9]["items"] == [1]
    assert by_id[11].n_hit == 1 and sorted(by_id[11]["items"]) == [2, 5]
    assert by_id[4].n_words == by_id[5].n_words == by_id[1].n_hit == 0
    cleaned = {r.doc_id: r.text for r in decontamination.decontaminate(docs, benchmark).collect()}
    assert 11 not in cleaned and cleaned[4] is None and cleaned[7] == LONG
    assert cleaned[9].split("\n")[1].split() == SHARED.split()[:5] + SHARED.split()[25:]
    assert 9 not in {r.doc_id for r in decontamination.decontaminate(docs, benchmark, documents=True).collect()}
    assert decontamination.find_contamination(nothing, benchmark).count() == 0
    assert decontamination.decontaminate(docs, benchmark.limit(0)).count() == len(ROWS)


def dot_products(rows, k):
    out = set()
    for q, v in rows:
        if q is not None and q % 50 == 0 and v:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), d) for d, w in rows if w and d is not None and d != q and len(w) == len(v))
            out |= {(q, n + 1, d, -s) for n, (s, d) in enumerate(scores[:k])}
    return out


def test_top_products(spark):
    draw = random.Random(5)
    rows = [(k, [draw.randint(-40, 40) / 256 for _ in range(8)]) for k in range(700)]
    rows += [(700 + k, rows[3][1]) for k in range(300)]  # one very common vector
    rows += [(2000, [1.0, 2.0]), (2050, [3.0, 1.0])]
    odd = [(5000, None), (5050, [float("nan")] * 8), (5100, [float("inf")] + [0.0] * 7), (None, [0.1] * 8), (5150, [None] * 8), (5200, [])]
    vectors = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("cell", F.lit("x")).withColumn("part", F.lit(1))
    old = covertree.PART, covertree.GROUP
    for covertree.PART, covertree.GROUP in (old, (50, 3)):
        got = {tuple(r) for r in covertree.top_products(vectors, vectors.where("vec_id % 50 = 0")).collect()}
        assert got == dot_products([(d, [int(np.floor(256 * x)) for x in v]) for d, v in rows], 5)
    covertree.PART, covertree.GROUP = old
    assert covertree.top_products(vectors.limit(0), vectors.limit(0)).count() == 0


def test_many_widths_in_one_search(spark, monkeypatch):
    draw = random.Random(2)
    rows = [(k, [draw.randint(-40, 40) / 256 for _ in range(1 + k % 12)]) for k in range(600)]
    for sample in (covertree.SAMPLE, 5):  # some widths without a sample
        monkeypatch.setattr(covertree, "SAMPLE", sample)
        vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = {tuple(r) for r in covertree.top_products(vectors, vectors.where("vec_id % 50 = 0")).collect()}
        assert got == dot_products([(d, [int(np.floor(256 * x)) for x in v]) for d, v in rows], 5)


def test_large_components_are_exact_or_fail(spark):
    draw = random.Random(4)
    rows = [(k, [float(draw.randint(-10**6, 10**6)) for _ in range(3)]) for k in range(120)] + [(200, [10.0**6] * 3), (201, [10.0**6] * 3)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in covertree.top_products(vectors, vectors.where("vec_id % 50 = 0")).collect()}
    assert got == dot_products([(d, [int(256 * x) for x in v]) for d, v in rows], 5)
    for factor in (1e4, 1e17):
        with pytest.raises(Exception, match="long|component"):
            large = spark.createDataFrame([(d, [x * factor for x in v]) for d, v in rows], "vec_id long, embedding array<double>")
            covertree.top_products(large, large.where("vec_id % 50 = 0")).collect()


def test_cover_tree_prunes_and_covers():
    draw = np.random.default_rng(3)
    points = np.concatenate([draw.normal(c * 100, 3, (200, 4)) for c in range(10)]).round()
    root = covertree.cover_tree(points)
    stack = [root]
    while stack:
        node = stack.pop()
        assert (np.sqrt(((points[node.rows] - node.center) ** 2).sum(axis=1)) <= node.radius + 1e-6).all()
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            stack += node.children
    assert len(root.children) > 1


def test_passages(spark, docs, nothing):
    spans = passages.repeated_units(docs, min_words=10).collect()
    assert {(r.doc_id, r.kept_doc_id) for r in spans} >= {(10, 9), (2, 1)}
    assert all(r.doc_id not in (1, 7, 11, 14) for r in spans)
    text = dict(ROWS[9:11])[10]
    span = next(r for r in spans if r.doc_id == 10)
    assert text.encode()[span.start:span.end].decode() == SHARED.upper()
    left = {r.doc_id: r.text for r in passages.remove_units(docs, passages.repeated_units(docs, min_words=10)).collect()}
    assert len(left) == len({d for d, _ in ROWS}) and left[10].split("\n")[0] == "SHORT line here  " and len(left[10].split("\n")) == 2
    assert passages.repeated_units(nothing).count() == 0
    two = spark.createDataFrame([(1, "a b\nc d\n\n e f"), (2, "x\n\nA b\n C d. \n \t\ny")], "doc_id long, text string")
    assert [(r.doc_id, r.kept_doc_id, r.n_words) for r in passages.repeated_units(two, min_words=3, paragraphs=True).collect()] == [(2, 1, 4)]


def test_passages_of_short_lines(spark, docs, nothing):
    short = [f"run{k} a{k} b{k} c{k}" for k in range(13)]
    uneven = ["p q r", " ".join(f"u{k}" for k in range(30)), "s t"]
    texts = [(1, "\n".join(["own one", *short, "\n", *uneven, "own two"])), (2, "\n".join(["other", *short, "two"]).upper()), (3, "\n".join(uneven)),
             (4, "\n".join(["only three", *short[:4]])), (5, "\n".join(["foo bar"] * 25)), (6, None), (7, "\n"), (None, "\n".join(short))]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    spans = passages.repeated_runs(rows)
    got = {(r.doc_id, r.unit, r.last_unit, r.n_words, r.kept_doc_id, r.kept_unit) for r in spans.collect()}
    assert got == {(2, 1, 13, 52, 1, 1), (3, 0, 2, 35, 1, 16), (5, 10, 24, 30, 5, 0)}
    left = {r.doc_id: r.text for r in passages.remove_units(rows, spans).collect()}
    assert left == dict(texts) | {2: "OTHER\nTWO", 3: "", 5: "\n".join(["foo bar"] * 10) + "\n"}
    assert passages.repeated_runs(nothing).count() == 0 and passages.repeated_runs(docs).count() > 0


def test_language_model_by_plain_steps():
    """What is looked up once, sorted or copied by rows equals the plain way; before, each of these was done token by token."""
    draw = np.random.default_rng(5)
    sizes = language_model.Sizes.of(3_000)
    model = language_model.Parameters.start(np.log(np.full(sizes.outputs, 1 / sizes.outputs)), sizes)
    first = np.array([0, 0, 1, 1, 3, 6, 7, 40, 40])
    inputs = draw.integers(0, sizes.inputs - 1, (40, 2))
    plain = np.full((40, language_model.CONTEXT, 2), sizes.inputs - 1)
    for t in range(40):
        for k in range(language_model.CONTEXT):
            if t - k - 1 >= first[np.searchsorted(first, t, side="right") - 1]:
                plain[t, k] = inputs[t - k - 1]
    context = language_model.contexts(inputs, first, sizes)
    assert (context == plain).all()
    assert np.allclose(model.predicted_along(inputs, first), model.predicted(context), atol=1e-5)
    assert model.predicted_along(inputs[:2], np.array([0, 2])).shape == (2, language_model.WIDTH) and not len(model.predicted_along(inputs[:0], np.array([0])))
    raw = np.frombuffer(("Ab é " * 9).encode(), np.uint8)
    flat = kernels.Flat(raw, np.array([0, len(raw)]))
    start = np.repeat(np.arange(len(raw) - 3), 4)
    end = start + np.tile(np.arange(4), len(raw) - 3)
    assert (flat.short_span_hash(start, end, 3, 3) == flat.span_hash(start, end, 3)).all()
    for rows in (5, 70_000):
        at, values = draw.integers(0, rows, 600), draw.normal(size=(200, 16)).astype(np.float32)
        at[:100] = draw.integers(0, 2, 100)
        seen, times, sums = language_model._scatter(at, values, rows)
        want = np.zeros((rows, 16))
        np.add.at(want, at, np.tile(values, (3, 1)))
        assert (seen == np.unique(at)).all() and (times == np.bincount(at)[seen]).all() and np.allclose(sums, want[seen], atol=1e-4)
    table = np.zeros((6, 16), np.float32)
    language_model._put(table, np.array([4, 1]), values[:2])
    assert (table[[4, 1]] == values[:2]).all() and not table[[0, 2, 3, 5]].any()


def test_quality_sums_take_one_python_worker(spark, docs):
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 15)], "doc_id long, quality int")
    sums = quality.label_sums(docs, labels)
    # before: a second worker in each task added up what the first had measured
    assert sums._jdf.queryExecution().sparkPlan().toString().count("MapInArrow") == 1
    got, width = {r[0]: r[1:] for r in sums.collect()}, len(quality.STATISTICS)
    x = {d: np.array([r.x for r in quality.document_statistics(docs).where((F.col("doc") % 2 == d) & F.col("doc").between(1, 14)).collect()]) for d in (0, 1)}
    for k in (0, 1):
        squares = x[k].T @ x[k]
        assert got[k][0] == len(x[k]) and np.allclose(got[k][1:1 + width], x[k].sum(axis=0))
        assert np.allclose(got[k][1 + width:], squares[np.triu_indices(width)])


def test_passages_inside_lines(spark, docs, nothing):
    shared, other = [f"w{k}" for k in range(60)], [f"v{k}" for k in range(49)]
    texts = [(1, "one begins " + " ".join(shared) + " and ends so"), (2, "Other words,\nthen " + "\n".join(shared[:30]).upper() + ", " + "; ".join(shared[30:]) + " é tail"),
             (3, " ".join(other) + " a"), (4, "b " + " ".join(other) + " c"), (5, "x " + " ".join(["same"] * 130)), (6, None), (7, "\n"), (None, " ".join(shared)),
             (8, "c " + " ".join(shared[:55]) + " d " + " ".join(shared[3:53]))]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    found = passages.repeated_passages(rows).collect()
    # before: lines and runs of lines alone, which none of these is
    assert passages.repeated_runs(rows).count() == 0
    assert {(r.doc_id, r.word, r.n_words, r.kept_doc_id, r.kept_word) for r in found} == {
        (2, 3, 60, 1, 2), (5, 51, 80, 5, 1), (8, 1, 55, 1, 2), (8, 57, 50, 1, 5)}
    span = next(r for r in found if r.doc_id == 2)
    cut = dict(texts)[2].encode()[span.start:span.end].decode()
    assert cut.startswith("W0\nW1") and cut.endswith("w58; w59")
    assert {r.doc_id: r.text for r in passages.remove_units(rows, passages.repeated_passages(rows)).collect()}[2] == "Other words,\nthen  é tail"
    assert passages.repeated_passages(nothing).count() == 0


@pytest.mark.parametrize("least", [1, 2, 7, 12])
def test_passages_by_brute_force(spark, least):
    draw = np.random.default_rng(least)
    texts = {d: [str(x) for x in draw.integers(0, 3 if d % 4 else 2, int(draw.integers(0, 60)))] for d in range(60)}
    first, units = {}, []
    for d, words in sorted(texts.items()):
        for lo in range(len(words) - least + 1):
            kept = first.setdefault(tuple(words[lo:lo + least]), (d, lo))
            if d > kept[0] or lo >= kept[1] + least:
                units.append((d, lo, kept))
    want = []
    for d, lo, kept in units:
        if want and want[-1][0] == d and lo <= want[-1][2]:
            want[-1][2] = lo + least
        else:
            want.append([d, lo, lo + least, *kept])
    rows = spark.createDataFrame([(d, " ".join(words)) for d, words in texts.items()], "doc_id long, text string")
    found = passages.repeated_passages(rows, min_words=least).collect()
    assert sorted([r.doc_id, r.word, r.word + r.n_words, r.kept_doc_id, r.kept_word] for r in found) == want


def test_passages_write_stretches_not_words(spark):
    def rows_written():
        return sum(pq.read_metadata(path).num_rows for path in Path(urlparse(shared_folder(spark)).path).rglob("*.parquet"))

    shared = " ".join(f"w{k}" for k in range(3000))
    rows = spark.createDataFrame([(k, f"own{k} {shared} end{k}") for k in range(50)], "doc_id long, text string")
    before = rows_written()
    found = passages.repeated_passages(rows).collect()
    assert {(r.doc_id, r.word, r.n_words, r.kept_doc_id, r.kept_word) for r in found} == {(k, 1, 3000, 0, 1) for k in range(1, 50)}
    # before: a row for each of the 50 * 2951 units
    assert 0 < rows_written() - before < 50_000


def test_passages_cut_inside_stretches(spark):
    """Copies with edits have stretches that are equal in part; offsets are those of each copy's own text."""
    draw = np.random.default_rng(3)
    base = [[f"b{k}x{j}" for j in range(int(draw.integers(20, 150)))] for k in range(5)]
    texts = []
    for d in range(70):
        words = [w for k in draw.integers(0, 5, 3) for w in base[k][int(draw.integers(0, 12)):]]
        for at in draw.integers(0, len(words), int(draw.integers(0, 6))):
            words[at] = str(draw.integers(0, 3))
        texts.append((d, "é, ".join(words) if d % 3 else "\n".join(words).upper()))
    texts += [(1000, None), (1001, "short")]
    least, first, want = 20, {}, {}
    for d, text in texts:
        words = [m for m in re.finditer(r"[a-z0-9é]+", (text or "").lower())]
        for lo in range(len(words) - least + 1):
            kept = first.setdefault(tuple(m[0] for m in words[lo:lo + least]), (d, lo))
            if d > kept[0] or lo >= kept[1] + least:
                if (own := want.setdefault(d, [])) and lo <= own[-1][1]:
                    own[-1][1] = lo + least
                else:
                    own.append([lo, lo + least, *kept])
        place = [(len(text[:m.start()].encode()), len(text[:m.end()].encode())) for m in words]
        want[d] = [(lo, place[lo][0], place[hi - 1][1], hi - lo, kept, at) for lo, hi, kept, at in want.get(d, [])]
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    stretches = passages.passage_stretches(rows, min_words=least)
    assert stretches.where("several").count() and stretches.where("not several").count()
    found = passages.repeated_passages(rows, min_words=least).collect()
    assert sorted(tuple(r) for r in found) == sorted((d, *span) for d, spans in want.items() for span in spans)


def test_passages_of_rows_with_one_id(spark):
    """A stretch is taken from the row that holds it."""
    words = [f"w{k}" for k in range(60)]
    rows = spark.createDataFrame([(1, "short"), (1, " ".join(words)), (1, " ".join(f"v{k}" for k in range(80))), (2, "a b " + " ".join(words)), (3, "c " + " ".join(words[4:])),
                                  (3, "d " * 9)], "doc_id long, text string")
    found = {tuple(r) for r in passages.repeated_passages(rows).collect()}
    assert found == {(2, 2, 4, 4 + len(" ".join(words)), 60, 1, 0), (3, 1, 2, 2 + len(" ".join(words[4:])), 56, 1, 4)}


def test_packing(spark, docs, nothing):
    path = queries.tokenizer_file("word_bpe_49k.json")
    got = packing.pack(docs, path, ids=True).collect()
    library = tokens.tokenizer(path).library
    want = sorted(str((d, library.encode(t or "", add_special_tokens=False).ids + [2])) for d, t in ROWS)
    whole, at = [], {}
    for r in sorted(got, key=lambda r: (r.doc_id or -1, r.start)):
        at.setdefault(r.doc_id, []).append(r)
    for doc, own in at.items():
        ids = []
        for r in own:
            if r.start == 0 and ids:
                whole.append(str((doc, ids)))
                ids = []
            ids = ids + list(r.ids) if doc not in (2, None) else list(r.ids)
        whole.append(str((doc, ids)))
    assert sorted(whole) == want
    fill = {}
    for r in got:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in fill.values():
        own.sort()
        assert all(a[0] + a[1] == b[0] for a, b in itertools.pairwise(own)) and own[0][0] == 0 and sum(own[-1]) <= 4096
    assert packing.pack(nothing, path).count() == 0


def test_patterns_cover_demand():
    draw = np.random.default_rng(9)
    units = np.sort(draw.choice(np.arange(1, 65), 30, replace=False))
    demand = draw.integers(1, 400, 30)
    found = packing.whole_patterns(units, demand, 64)
    assert (sum(c * n for c, n in found) == demand).all() and all((c * units).sum() <= 64 for c, _ in found)
    _, used = packing.fractional_patterns(units, demand.astype(float), 64)
    assert sum(n for _, n in found) <= used.sum() + 30 and used.sum() >= (units * demand).sum() / 64 - 1e-6


def test_other_tokenizers(docs):
    for name in ("byte_bpe_50k.json",):
        encoder = tokens.Tokenizer(queries.tokenizer_file(name))
        flat = next(kernels.pieces(pa.array(["Hello  World", "é x"])))[1]
        ids, first = encoder.encode(flat)
        assert ids[first[0]:first[1]].tolist() == encoder.library.encode("Hello  World", add_special_tokens=False).ids


def test_short_way_gives_the_library_ids():
    encoder = tokens.Tokenizer(queries.tokenizer_file("word_bpe_49k.json"))
    draw = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGÀÉÖÞßàéöÿ0123456789  \n\t.,;!'#-_|*"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 300))) for _ in range(300)] + [t or "" for _, t in ROWS if len(t or "") < 10_000]
    ids, first = encoder.encode(next(kernels.pieces(pa.array(texts)))[1])
    want = encoder.library.encode_batch(texts, add_special_tokens=False)
    assert all(ids[first[k]:first[k + 1]].tolist() == want[k].ids for k in range(len(texts)))


def plain_groups(rows, threshold=75):
    sets = {}
    for doc, text in rows:
        own = words_of(text)
        made = frozenset(tuple(own[k:k + 5]) for k in range(max(1, len(own) - 4))) if own else frozenset()
        sets.setdefault(doc, []).append(made)
    docs = [(d, s) for d, many in sets.items() if d is not None for s in many]
    label = {d: d for d, _ in docs}
    for (a, x), (b, y) in itertools.combinations(docs, 2):
        if x and y and label[a] != label[b] and 100 * len(x & y) >= threshold * len(x | y):
            low, high = sorted((label[a], label[b]))
            label = {d: low if c == high else c for d, c in label.items()}
    return label


def edited(seed: int, base: list[str], edits: int) -> str:
    draw, out = random.Random(seed), list(base)
    for _ in range(edits):
        out[draw.randrange(len(out))] = draw.choice(WORDS)
    return " ".join(out)


def test_jaccard_join(spark, docs, nothing):
    got = {(r.doc, r.component_id) for r in jaccard.near_groups(docs).collect()}
    label = plain_groups(ROWS)
    assert {g for g in got if g[0] is not None} == set(label.items())
    assert jaccard.without_copies(docs, jaccard.near_groups(docs)).columns == docs.columns
    assert jaccard.near_groups(nothing).count() == 0


@pytest.mark.parametrize("part", [1 << 20, 900])
def test_jaccard_join_of_large_groups(spark, part, monkeypatch):
    draw, rows = random.Random(8), []
    for group in range(4):
        base = prose(100 + group, 60).split()
        rows += [(group * 100 + k, edited(k + group, base, draw.randint(0, 4))) for k in range(60)]
    passage = prose(77, 30)
    rows += [(1000 + k, passage + " " + prose(200 + k, draw.choice([4, 8, 60]))) for k in range(60)]
    monkeypatch.setattr(jaccard, "PART", part)
    monkeypatch.setattr(jaccard, "CHUNK", 2000)
    monkeypatch.setattr(jaccard, "BUCKET", 1 << 17 if part > 1000 else 1)  # thousands of buckets
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc: r.component_id for r in jaccard.near_groups(table).collect()} == plain_groups(rows)


def test_search_part_finds_all_partners():
    draw = random.Random(6)
    common = [draw.getrandbits(60) for _ in range(40)]
    sets = [np.unique(np.array(draw.sample(common, draw.randint(20, 40)) + [draw.getrandbits(60) for _ in range(draw.randint(0, 12))], np.uint64)) for _ in range(80)]
    part = jaccard.Part(list(range(80)), sets, 75)
    for own in sets:
        plain = [k for k, s in enumerate(sets) if 100 * len(np.intersect1d(s, own)) >= 75 * len(np.union1d(s, own))]
        assert sorted(part.nodes[k] for k in part.search(own).tolist()) == plain


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(5, 5), (400, 401)] + [(500 + k, 501 + k) for k in range(40)]
    label = {n: n for e in edges for n in e if e[0] != e[1]}
    for a, b in edges:
        if a != b:
            low, high = sorted((label[a], label[b]))
            label = {n: low if c == high else c for n, c in label.items()}
    table = spark.createDataFrame(edges, "a long, b long")
    assert sorted(map(tuple, components(table).collect())) == sorted(label.items())
    assert components(table.limit(0)).count() == 0


def test_lines(spark, docs, nothing):
    got = {r.doc_id: r for r in lines.drop_repeated_lines(docs, counts=True).collect()}
    assert got[10].n_dropped == 2 and got[9].n_dropped == 0 and got[2].text == "" and got[2].n_dropped == 1
    assert got[4].n_lines == got[5].n_lines == 1 and got[14].n_lines == 5 and got[14].n_dropped == 0
    assert lines.drop_repeated_lines(docs).columns == docs.columns
    assert lines.drop_repeated_lines(docs).count() == len(ROWS)
    three = {r.doc_id: r.n_dropped for r in lines.drop_repeated_lines(docs, min_documents=3, counts=True).collect()}
    assert not any(three.values())
    assert lines.drop_repeated_lines(nothing).count() == 0


def test_language_model(spark, docs, nothing):
    got = language_model.score_texts(docs, F.col("doc_id") < 9).collect()
    assert len(got) == len(ROWS) and all(r.score <= 0 and r.base_score <= 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (4, 5, 6)} == {1}
    assert not any(r.learned for r in got if r.doc_id is None)
    unlearned = language_model.score_texts(docs, F.lit(False)).collect()
    assert {r.train_tokens for r in unlearned} == {0} and {r.n_known for r in unlearned} == {0}
    assert language_model.score_texts(nothing, F.lit(True)).count() == 0


def test_language_model_is_normalised():
    draw = np.random.default_rng(1)
    model = language_model.Parameters.start(np.log(np.full(language_model.HEAD + language_model.CLASSES, 1 / 256)))
    context = draw.integers(0, language_model.HEAD, (5, language_model.CONTEXT))
    total = sum(np.exp(model.log_softmax_at(context, np.full(5, w))) for w in range(language_model.HEAD + language_model.CLASSES))
    assert np.allclose(total, 1, atol=1e-5)


def test_language_model_grows_with_the_vocabulary(spark):
    texts = spark.createDataFrame([(" ".join(f"word{k}ing" for k in range(n)),) for n in (400, 8_000)], "text string")
    counts = saved(language_model.token_counts(texts, "text"), "token-counts")
    words = language_model.vocabulary(counts, counts.count())
    size = words.sizes
    assert (size.head, size.classes) == (400, 128) and len(words.head) == 400 and size.groups * size.members >= size.outputs
    assert len(language_model.Parameters.start(np.log(words.noise), size).flat()) > len(language_model.Parameters.start(np.log(np.full(256, 1 / 256))).flat())
    raw = " ".join(f"word{k}ing" for k in range(8_000)).encode()
    hashes, suffix, _ = language_model.token_hashes(kernels.Flat(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))
    inputs, outputs = words.ids(hashes, suffix)
    assert len(set(suffix[:-1])) == 1 and len(set(inputs[:-1, 0])) > 700  # one ending, many inputs
    own = outputs[outputs < size.head]
    assert len(own) == len(set(own)) == 400
    for sizes in (size, language_model.Sizes.of(50_000)):
        n = sizes.outputs
        model = language_model.Parameters.start(np.log(np.full(n, 1 / n)), sizes)
        context = np.random.default_rng(1).integers(0, sizes.inputs, (1, language_model.CONTEXT, 2))
        assert np.isclose(np.exp(model.log_softmax_at(np.repeat(context, n, axis=0), np.arange(n))).sum(), 1, atol=1e-4)
    assert language_model.Sizes.of(50_000).classes > 128


def test_language_model_learns_words_outside_the_first_outputs():
    sizes, draw = language_model.Sizes.of(4_000), np.random.default_rng(2)
    noise = np.full(sizes.outputs, 1 / sizes.outputs)
    trainer = language_model.Trainer(language_model.Parameters.start(np.log(noise), sizes), noise, 1)
    target = draw.choice([200, 220], 100_000)
    context = np.repeat(np.where(target == 200, 150, 160)[:, None, None], language_model.CONTEXT, axis=1)
    before = trainer.model.log_softmax_at(context[:100], target[:100]).mean()
    trainer.read(context, target)
    after = trainer.model.log_softmax_at(context[:100], target[:100])
    crossed = trainer.model.log_softmax_at(context[:100], 420 - target[:100])
    assert after.mean() > before + 1 and (after > crossed).all()
    merged = language_model._average(2 * language_model._weighted(trainer.model, trainer.weights()).astype(float), sizes)
    assert np.allclose(merged.flat(), trainer.model.flat(), rtol=1e-4, atol=1e-5)


def test_warc(spark, nothing):
    rows = [(1, "http://a/\r\nx", "p" * 1000), (2, None, "p" * 1000), (2, None, "p" * 1000), (3, "u", None), (4, "u", ""), (5, "u", "a\r\n\r\nWARC/1.1\r\nb\r\n\r\n"),
            (None, "u", "é" * 777), (6, "u", "é" * 777), (None, "u", "alone"), (7, "u", "\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("size", F.lit("x")).withColumn("sha", F.lit("y"))
    path = warc.write_archive(pages.coalesce(2), scratch_path(spark, "warc-test"), chunk=100)
    named = {n: warc.page_of(F.col(n)).alias(to) for n, to in (("record_id", "page_id"), ("refers_to", "refers_to"))}
    read = warc.read_chunks(spark, path).select(named["record_id"], "chunk", "is_last", "record_type", named["refers_to"], "payload_bytes", "payload")
    chunks = read.collect()
    last = {}
    for r in chunks:
        if r.is_last:
            last.setdefault(r.page_id, []).append(r)
    assert sum(map(len, last.values())) == len(rows)
    body = {}
    for r in sorted(chunks, key=lambda r: r.chunk):
        body.setdefault((r.page_id, r.record_type), []).append(bytes(r.payload))
        assert len(r.payload) <= 100
    assert b"".join(body[1, "response"]) == b"p" * 1000 and b"".join(body[6, "response"]).decode() == "é" * 777
    assert b"".join(body[5, "response"]) == rows[5][2].encode()
    assert [(r.record_type, r.refers_to, r.payload_bytes) for r in last[2]] == [("revisit", 1, 1000)] * 2
    assert last[4][0].refers_to == 3 and last[3][0].record_type == "response" and last[7][0].payload_bytes == 4
    assert sorted((r.record_type, r.refers_to) for r in last[None]) == [("response", None), ("revisit", 6)]
    empty = warc.write_archive(pages.limit(0), scratch_path(spark, "warc-test"))
    assert warc.read_chunks(spark, empty).count() == 0


def foreign_record(kind, record, block, **fields):
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record}>"), ("Content-Length", str(len(block))), *[(k.replace("_", "-"), v) for k, v in fields.items()]]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    import base64
    import gzip
    import hashlib

    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n"
    draw = random.Random(1)
    large = b"\n".join(draw.randbytes(draw.randint(0, 90_000)) for _ in range(1200))  # above 50 MB, with bytes that are no text
    sha = "sha1:" + base64.b32encode(hashlib.sha1(large).digest()).decode()
    odd = b"x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\n"
    records = [
        foreign_record("warcinfo", "urn:uuid:0", b"software: other\r\n"), foreign_record("response", "urn:uuid:1", http + large, Content_Type="application/http; msgtype=response", WARC_Payload_Digest=sha),
        foreign_record("request", "urn:uuid:2", b"GET / HTTP/1.1\r\n\r\n"), foreign_record("resource", "urn:uuid:3", odd), foreign_record("response", "urn:uuid:4", http, Content_Type="application/http"),
        foreign_record("revisit", "urn:uuid:5", http, WARC_Refers_To="<urn:uuid:1>", WARC_Payload_Digest=sha), foreign_record("response", "urn:uuid:6", http[:20], Content_Type="application/http"),
        foreign_record("response", "urn:uuid:7", http + large[:70_000], Content_Type="application/http", WARC_Segment_Number="1"),
        foreign_record("continuation", "urn:uuid:8", large[70_000:150_000], WARC_Segment_Number="2", WARC_Segment_Origin_ID="<urn:uuid:7>", WARC_Segment_Total_Length=str(150_000 + len(http))),
        foreign_record("continuation", "urn:uuid:9", b"lost", WARC_Segment_Number="3", WARC_Segment_Origin_ID="<urn:uuid:77>", WARC_Segment_Total_Length="4")]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r.replace(b"uuid:", b"uuid:b")) for r in records[2:]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    rows = warc.read_chunks(spark, str(tmp_path)).select("record_id", "chunk", "is_last", "record_type", "refers_to", "payload_bytes", F.length("payload").alias("n"),
                                                         F.sha1("payload").alias("sha"), "payload_digest").collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    by = {}
    for r in rows:
        by.setdefault(r.record_id, []).append(r)
        assert r.n <= 64 * 1024
    assert set(by) == {f"urn:uuid:{k}" for k in "1 3 4 5 6 7 77".split()} | {f"urn:uuid:b{k}" for k in "3 4 5 6 7 77".split()}
    whole = sorted(by["urn:uuid:1"], key=lambda r: r.chunk)
    assert [r.chunk for r in whole] == list(range(len(whole))) and [r.is_last for r in whole] == [False] * (len(whole) - 1) + [True]
    assert whole[-1].payload_bytes == len(large) and "sha1:" + whole[-1].payload_digest == sha
    assert [r.sha for r in whole] == [hashlib.sha1(large[k:k + 65536]).hexdigest() for k in range(0, len(large), 65536)]
    for tag in ("", "b"):
        end = {k: max(by[f"urn:uuid:{tag}{k}"], key=lambda r: r.chunk) for k in ("3", "4", "5", "6", "7", "77")}
        text = odd.replace(b"uuid:", b"uuid:b") if tag else odd
        assert end["3"].payload_bytes == len(text) and end["4"].payload_bytes == 0 and end["6"].payload_bytes == 20
        assert (end["5"].record_type, end["5"].refers_to, end["5"].payload_bytes) == ("revisit", f"urn:uuid:{tag}1", None)
        assert end["7"].payload_bytes == 150_000 and end["7"].payload_digest == base64.b32encode(hashlib.sha1(large[:150_000]).digest()).decode()
        assert (end["77"].record_type, end["77"].payload_digest) == ("continuation", None)
    (tmp_path / "c.warc").write_bytes(records[3][:-30])
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_chunks(spark, str(tmp_path / "c.warc")).collect()
