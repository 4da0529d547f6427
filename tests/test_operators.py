import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from urbanweave.functions.similarity import ratios, weighted_ratio
from urbanweave.operators import aggregate, dedup, fuzzy, lookups
from urbanweave.session import settle


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# ---------------------------------------------------------------- deduplication

def test_dedup_keeps_last_and_takes_nulls_as_equal(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", "x", 3), (None, None, 4), (None, None, 5)], "k string, d string, n int")
    assert rows(dedup.dedup_keep_last(df, ["k", "d"], ["n"]), "n") == [(2,), (3,), (5,)]
    assert rows(dedup.dedup_keep_first(df, ["k", "d"], ["n"]), "n") == [(1,), (3,), (4,)]


def test_dedup_follows_pandas(spark):
    random.seed(3)
    frame = pd.DataFrame([(random.choice("ab") if random.random() > 0.2 else None, random.randint(0, 3), i) for i in range(200)],
                         columns=["k", "d", "n"])
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "k string, d int, n int")
    want = frame[~frame.duplicated(subset=["k", "d"], keep="last")]
    assert rows(dedup.dedup_keep_last(df, ["k", "d"], ["n"]), "n") == sorted([(int(n),) for n in want["n"]], key=str)


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 2)
    plan = dedup.dedup_keep_last(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle


@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9)), max_size=15), st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9)), max_size=15))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_upsert_is_idempotent(spark, base, batch):
    schema = "k int, v int, seq int"
    target = dedup.dedup_keep_last(spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(base)], schema), ["k"], ["seq"])
    news = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(batch)], schema)
    once = dedup.upsert_by_key(target, news, ["k"], ["seq"])
    twice = dedup.upsert_by_key(once, news, ["k"], ["seq"])
    want = {k: v for k, v in base} | {k: v for k, v in batch}
    assert {r.k: r.v for r in once.collect()} == want == {r.k: r.v for r in twice.collect()}


def test_source_priority_puts_unlisted_sources_last(spark):
    df = spark.createDataFrame([("e", "other", 1), ("e", "Org", 2), ("e", "Org", 3), ("f", "other", 9), ("g", None, 4)], "e string, s string, n int")
    got = dedup.pick_by_source_priority(df, ["e"], "s", ["GPG", "Org"], ["n"])
    assert {r.n for r in got.where("selected").collect()} == {2, 9, 4}
    assert got.count() == 5


def test_numbers_are_dense_with_a_hot_key_and_null_keys(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2990, F.col("id").cast("string")).alias("k"))
    got = dedup.number_within(df, ["k"], ["id"], "no", F.pmod(F.xxhash64("id"), F.lit(7)), 7).toPandas()
    assert len(got) == 3000
    for key, numbers in got.groupby("k", dropna=False)["no"]:
        assert sorted(numbers) == list(range(1, len(numbers) + 1)), key


# ---------------------------------------------------------------- lookups

def test_strict_lookup_fails_on_unknown_and_null_keys(spark):
    words = spark.createDataFrame([("a", "A", 1), ("b", "B", 1), ("a", "last", 2)], "k string, v string, seq int")
    good = spark.createDataFrame([("a",), ("b",)], "x string")
    assert rows(lookups.lookup_strict(good, words, "x", "k", "v", "y", ["seq"]), "x", "y") == [("a", "last"), ("b", "B")]
    for bad in ("z", None):
        with pytest.raises(Exception, match="unknown key"):
            lookups.lookup_strict(spark.createDataFrame([(bad,)], "x string"), words, "x", "k", "v", "y", ["seq"]).collect()


def test_lenient_and_reject(spark):
    words = spark.createDataFrame([("a", None), ("b", "B")], "k string, v string")
    df = spark.createDataFrame([("a",), ("z",), (None,)], "x string")
    assert rows(lookups.lookup_lenient(df, words, "x", "k", "v", "x"), "x") == [(None,)] * 3
    assert rows(lookups.lookup(df, words, F.col("x"), "k", "v", "y", "reject"), "x") == [("z",), (None,)]
    assert rows(lookups.lookup(df, words, F.col("x"), "k", "v", "y", "drop"), "x") == [("a",)]


def test_strict_lookup_may_map_to_null(spark):
    words = spark.createDataFrame([("a", None)], "k string, v string")
    df = spark.createDataFrame([("a",)], "x string")
    assert rows(lookups.lookup_strict(df, words, "x", "k", "v", "y"), "y") == [(None,)]


def test_tariff_taxonomy_last_row_wins(spark):
    words = spark.createDataFrame([("1~T~F", "old", "s1", 1), ("1~T~F", "new", "s2", 2), ("1~U~F", "u", "s3", 3)],
                                  "SOURCE string, Tariff string, EconomicSector string, seq int")
    df = spark.createDataFrame([("1", "T", "F")], "sector string, disc string, fare string")
    got = lookups.tariff_taxonomy(df, words, ["sector", "disc", "fare"], order=["seq"]).first()
    assert (got.sector, got.tariff) == ("s3", "new")


def test_postal_fallback(spark):
    stations = spark.createDataFrame([("8001", "s1"), ("8010", "s10"), ("8019", "s19"), ("8020", "s20")], "code string, name string")
    df = spark.createDataFrame([(c,) for c in ("08001", "08002", "08000", "08009", "08011", "08018", "08029", "08021", "08020", "08025")], "cp string")
    got = {r.cp: r.name for r in lookups.postal_station_fallback(df, stations, "cp", "code", ["name"]).collect()}
    assert got == {"08001": "s1", "08002": "s1", "08000": "s1", "08009": None, "08011": "s10", "08018": "s19", "08029": None,
                   "08021": "s20", "08020": "s20", "08025": None}


def test_measured_side_is_broadcast_only_within_the_limit(spark):
    big, side = spark.range(1000), spark.range(100).withColumn("v", F.lit("x"))
    plan = lambda limit: big.join(settle(side, limit), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(10_000)
    assert "SortMergeJoin" in plan(10)


# ---------------------------------------------------------------- aggregates

def test_sum_by_series_follows_pandas(spark):
    frame = pd.DataFrame({"a": ["x", "x", None, "y"], "b": [1, 1, 1, 2], "value": [1.0, None, 5.0, None]})
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "a string, b int, value double")
    want = frame.groupby(["a", "b"]).agg({"value": "sum"}).reset_index()
    assert rows(aggregate.sum_by_series(df, ["a", "b"]), "a", "b", "value") == [tuple(r) for r in want.itertuples(index=False)]


def test_degree_days(spark):
    df = spark.createDataFrame([("s", "2024-01-01 00:00:00", 10.0), ("s", "2024-01-01 12:00:00", 14.0), ("s", "2024-07-01 12:00:00", 30.0)],
                               "st string, t string, c double").withColumn("t", F.col("t").cast("timestamp"))
    assert rows(aggregate.degree_days(df, "st", "t", "c"), "hdd", "cdd") == [(0.0, 9.0), (6.0, 0.0)]


# ---------------------------------------------------------------- fuzzy matching against brute force

LETTERS = "abcdé "


def words(count, seed, low=1, high=26):
    random.seed(seed)
    made = set()
    while len(made) < count:
        if made and random.random() < 0.6:
            text = list(random.choice(sorted(made)))
            for _ in range(random.randint(1, 3)):
                place = random.randint(0, len(text))
                if random.random() < 0.5 and len(text) > 1:
                    text.pop(min(place, len(text) - 1))
                else:
                    text.insert(place, random.choice(LETTERS))
            made.add("".join(text))
        else:
            made.add("".join(random.choice(LETTERS) for _ in range(random.randint(low, high))))
    return sorted(made)


def all_scores(left, right):
    pairs = [(a, b) for a in left for b in right]
    return {p: float(s) for p, s in zip(pairs, ratios([a for a, _ in pairs], [b for _, b in pairs]))}


def texts(spark, values, name="text"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


@pytest.mark.parametrize("threshold, low, high", [(97.0, 1, 80), (90.0, 1, 60), (90.0, 1, 6), (80.0, 1, 30)])
def test_similar_pairs_loses_none(spark, threshold, low, high):
    left, right = words(110, int(threshold) + high, low, high), words(110, int(threshold) + high, low, high)[::2] + words(40, 5, low, high)
    right = sorted(set(right) | {w + "a" for w in left[::3]} | {w[1:] for w in left[::4] if len(w) > 1})
    got = {(r.left_text, r.right_text): r.score for r in fuzzy.similar_pairs(texts(spark, left), texts(spark, right), threshold).collect()}
    want = {p: s for p, s in all_scores(left, right).items() if s >= threshold - 1e-9}
    assert set(got) == set(want) and len(want) > 20
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_similar_pairs_with_one_common_stem(spark):
    """A third of all texts share everything but their end."""
    stem = "carrer de la marina numero "
    left = [stem + str(i) for i in range(80)] + words(120, 8)
    right = [stem + str(i) for i in range(40, 160)] + words(60, 9)
    got = {(r.left_text, r.right_text) for r in fuzzy.similar_pairs(texts(spark, left), texts(spark, right), 97.0).collect()}
    assert got == {p for p, s in all_scores(left, right).items() if s >= 97.0 - 1e-9}


def test_long_texts_are_compared_whole(spark):
    base = "".join(random.Random(4).choice("abcdefgh ") for _ in range(900))
    left, right = [base, base[:450]], [base[:300] + "x" + base[301:], base[:450] + "z" * 450]
    got = {(r.left_text, r.right_text) for r in fuzzy.similar_pairs(texts(spark, left), texts(spark, right), 97.0).collect()}
    assert got == {(base, right[0])}


@pytest.mark.parametrize("block, chunk", [(7, 5), (256, 4096)])
def test_best_match_is_exact_at_any_score(spark, block, chunk):
    left, right = words(60, 11), words(45, 12)
    order = {text: i for i, text in enumerate(random.Random(1).sample(right, len(right)))}
    choices = spark.createDataFrame(list(order.items()), "street string, place int")
    got = {r.name: (r.match, r.score) for r in fuzzy.fuzzy_best_match(
        texts(spark, left, "name"), choices, "name", "street", "place", block=block, chunk=chunk).collect()}
    scores = all_scores(left, right)
    for a in left:
        best = min(right, key=lambda b: (-scores[a, b], order[b]))
        assert got[a][0] == best and abs(got[a][1] - scores[a, best]) < 1e-9
    assert len(got) == len(left)


def test_topk(spark):
    left, right = words(50, 21), words(80, 21)
    got = {r.a: r.matches for r in fuzzy.fuzzy_topk(texts(spark, left, "a"), texts(spark, right, "b"), "a", "b", 80.0, 3).collect()}
    scores = all_scores(left, right)
    for a in left:
        best = sorted((b for b in right if scores[a, b] >= 80 - 1e-9), key=lambda b: (-scores[a, b], b))[:3]
        assert got[a] == ", ".join(best)


def greedy(left, right, threshold):
    """Plain greedy pairing of text counts, best score first."""
    from collections import Counter
    a, b, total = Counter(left), Counter(right), Counter()
    for (x, y), score in sorted(all_scores(sorted(a), sorted(b)).items(), key=lambda i: (-i[1], i[0])):
        if score >= threshold - 1e-9:
            take = min(a[x], b[y])
            a[x] -= take
            b[y] -= take
            total[x, y] += take
    return {k: v for k, v in total.items() if v}


@pytest.mark.parametrize("together", [10**6, 40, 3])
def test_one_to_one_is_greedy_and_uses_each_row_once(spark, together):
    """All pairs in one task, components in tasks of their own, and giant ones cut by rounds."""
    stem = "avinguda de la mare de deu de montserrat numero "
    left = [stem + str(i) for i in (1, 2, 3, 11, 12, 12, 12, 40)] + ["hot"] * 150 + words(80, 31, 10, 60)
    right = [stem + str(i) for i in (1, 11, 12, 12, 21, 41, 400)] + ["hot"] * 100 + words(80, 31, 10, 60)[::2] + [w + "e" for w in words(80, 31, 10, 60)[::3]]
    meters = spark.createDataFrame(list(enumerate(left)), "m int, text string")
    places = spark.createDataFrame(list(enumerate(right)), "p int, address string")
    got = fuzzy.match_one_to_one(meters, places, "m", "text", "p", "address", shards=5, together=together).collect()
    assert len({r.m for r in got}) == len(got) == len({r.p for r in got})
    from collections import Counter
    assert Counter((left[r.m], right[r.p]) for r in got) == Counter(greedy(left, right, 97.0))


@pytest.mark.parametrize("threshold", [97.0, 90.0, 80.0])
def test_texts_one_character_apart_meet_without_grams(spark, monkeypatch, threshold):
    """Runs of one character, other alphabets, and lengths about the bounds of one and two edits; then numbered names, whose grams are all common."""
    rnd = random.Random(2)
    stems = ["".join(rnd.choice("aab\u00e9\U0001f600") for _ in range(n)) for n in (1, 2, 3, 5, 9, 10, 16, 17, 18, 19, 32, 33, 34, 35) for _ in range(3)] + ["aaaa", "aaaaa", "a" * 17, "a" * 18]
    near = [t[:k] + t[k + 1:] for t in stems for k in (0, len(t) // 2, len(t) - 1)] + [t[:k] + rnd.choice("ab") + t[k:] for t in stems for k in (0, len(t) // 2, len(t))]
    left, right = sorted({*stems, *near[::2]}), sorted({*stems[::2], *near[1::2]})
    frame = lambda texts: spark.createDataFrame([(t,) for t in texts], "text string")
    got = fuzzy.similar_pairs(frame(left), frame(right), threshold).collect()
    want = {k: v for k, v in all_scores(left, right).items() if v >= threshold - 1e-9}
    assert len(got) == len(want) and {(r.left_text, r.right_text): round(r.score, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    if threshold == 97.0:
        cut, whole = [], fuzzy._grams
        monkeypatch.setattr(fuzzy, "_grams", lambda texts, width: cut.append(texts) or whole(texts, width))
        names = [f"Customer#{k:09d}" for k in range(3000)]
        pairs = fuzzy.similar_pairs(frame([n + "." for n in names]), frame(names), threshold).collect()
        assert {(r.left_text, r.right_text) for r in pairs} == {(n + ".", n) for n in names} and len(pairs) == 3000
        assert [c.count() for c in cut] == [0, 0]


def test_one_to_one_keeps_a_good_pair_rather_than_the_best_total(spark):
    """Unlike an optimal assignment over all pairs, a pair above the threshold is never given up."""
    meters = spark.createDataFrame([(1, "abcdefghijklmnopqrstuvwxyzabcdefghij")], "m int, text string")
    places = spark.createDataFrame([(1, "abcdefghijklmnopqrstuvwxyzabcdefghi"), (2, "zzz")], "p int, address string")
    assert [(r.m, r.p) for r in fuzzy.match_one_to_one(meters, places, "m", "text", "p", "address").collect()] == [(1, 1)]
    none = fuzzy.match_one_to_one(meters, places.where("p = 2"), "m", "text", "p", "address")
    assert none.count() == 0 and none.columns == ["m", "p", "score"]


def test_zone_names_close_to_the_gazetteer(spark):
    rows = spark.createDataFrame([(1, "ES", "Barcelona"), (2, "ES", "barcelna "), (3, "ES", "Nowhere at all"), (4, "ES", None), (5, "FR", "Barcelona")], "id int, land string, city string")
    gazetteer = spark.createDataFrame([("ES", "A", "Barcelona", "u1"), ("ES", "A", "Badalona", "u2")], "country string, feature_code string, name string, uri string")
    levels = spark.createDataFrame([("ES", "city", "A", "in")], "country string, level string, feature_code string, relation string")
    link = lambda **more: lookups.link_admin_zone(rows, gazetteer, levels, "land", {"city": "city"}, **more)
    assert {(r.id, r.uri) for r in link().collect()} == {(1, "u1")}
    assert {(r.id, r.uri) for r in link(threshold=90.0).collect()} == {(1, "u1"), (2, "u1")}
    assert {r.id for r in link(threshold=90.0, rejects=True).collect()} == {3, 4, 5}


def test_zone_names_close_to_the_gazetteer_of_their_own_country(spark):
    rows = spark.createDataFrame([(1, "ES", "santa fee"), (2, "AR", "santa fee"), (3, "ES", "elsewhere"), (4, None, "santa fee")], "id int, land string, city string")
    gazetteer = spark.createDataFrame([("ES", "A", "santa fe", "u1"), ("AR", "A", "santa fee", "u2"), ("AR", "A", "elsewhere", "u3")],
                                      "country string, feature_code string, name string, uri string")
    levels = spark.createDataFrame([("ES", "city", "A", "in"), ("AR", "city", "A", "in")], "country string, level string, feature_code string, relation string")
    for threshold in (90.0, 70.0):
        link = lambda **more: lookups.link_admin_zone(rows, gazetteer, levels, "land", {"city": "city"}, threshold, **more)
        assert {(r.id, r.uri) for r in link().collect()} == {(1, "u1"), (2, "u2")}
        assert {r.id for r in link(rejects=True).collect()} == {3, 4}


def test_energy_is_not_multiplied_by_tariffs_of_a_sector(spark):
    words = spark.createDataFrame([("s~1~a", "T1", "Sector/x"), ("s~1~b", "T2", "Sector/x"), ("s~2~a", "T3", "Sector/x")], "SOURCE string, Tariff string, EconomicSector string")
    rows = spark.createDataFrame([("s", "1", "a", 24.0)], "sector string, disc string, fare string, value double")
    got = lookups.tariff_taxonomy(rows, words, ["sector", "disc", "fare"]).collect()
    assert [(r.tariff, r.sector, r.value) for r in got] == [("T1", "Sector/x", 24.0)]


def test_degree_days_of_device_aggregates(spark):
    rows = spark.createDataFrame([("d", "t", "2024-01-01 00:00:00", 10.0), ("d", "t", "2024-01-01 12:00:00", 14.0), ("d", "t", "2024-01-02 00:00:00", 30.0)],
                                 "device string, prop string, at string, v double").withColumn("at", F.col("at").cast("timestamp"))
    rule = {"measured_property": "t", "freq": "P1M", "agg_name": "a", "agg_func": ["AVG", "CDD", "HDD", "SUM"]}
    got = {r.agg_func: r.value for r in aggregate.device_aggregate(rows, [rule], ["device"], "prop", None, "at", "v").collect()}
    assert got == {"AVG": 18.0, "CDD": 9.0, "HDD": 6.0, "SUM": 54.0}
    with pytest.raises(ValueError):
        aggregate.device_aggregate(rows, [rule | {"agg_func": ["MAX"]}], ["device"], "prop", None, "at", "v")


def test_top_matches_below_the_gram_filter(spark):
    left = spark.createDataFrame([("abcdef",), ("xyz",), ("",)], "a string")
    right = spark.createDataFrame([("abcxyz",), ("abcdxx",), ("q",)], "b string")
    got = {r.a: r.matches for r in fuzzy.fuzzy_topk(left, right, "a", "b", 60.0, 2).collect()}
    assert got == {"abcdef": "abcdxx", "xyz": "abcxyz", "": ""}


# ---------------------------------------------------------------- the composite score


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def plain(a, b):
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def composite(a, b):
    """The score once more, letter by letter and window by window."""
    def partial(x, y):
        if not x:
            return 0.0 if y else 100.0
        return max(plain(x, y[i:j]) for i in range(len(y)) for j in range(i + 1, len(y) + 1)
                   if j - i == len(x) or (j - i < len(x) and (i == 0 or j == len(y))))

    def both_ways(x, y):
        return max(partial(x, y), partial(y, x)) if len(x) == len(y) else partial(*sorted((x, y), key=len))

    if not a or not b:
        return 0.0
    u, v = sorted(set(a.split())), sorted(set(b.split()))
    sort_a, sort_b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    same, only_u, only_v = [w for w in u if w in v], [w for w in u if w not in v], [w for w in v if w not in u]
    parts = [plain(a, b)]
    unequal = max(len(a), len(b)) / min(len(a), len(b))
    if unequal < 1.5:
        if u or v:
            parts.append(0.95 * plain(sort_a, sort_b))
        if u and v:
            if same and (not only_u or not only_v):
                parts.append(95.0)
            x, y, z = " ".join(same), " ".join(same + only_u), " ".join(same + only_v)
            parts += [0.95 * plain(y, z)] + ([0.95 * plain(x, y), 0.95 * plain(x, z)] if same else [])
    else:
        scale = 0.9 if unequal <= 8 else 0.6
        parts.append(scale * both_ways(a, b))
        if u and v:
            parts.append(scale * 0.95 * (100.0 if same else max(both_ways(sort_a, sort_b), both_ways(" ".join(u), " ".join(v)))))
    return max(parts)


@pytest.mark.parametrize("a, b, score", [
    ("this is a test", "this is a new test!!!", 85.5), ("this is a word", "THIS IS A WORD", 21.428571), ("", "a", 0.0), ("", "", 0.0),
    ("fuzzy was a bear", "fuzzy fuzzy was a bear", 95.0), ("wuzzy fuzzy was a bear", "fuzzy wuzzy was a bear", 95.0), ("calle", "calle", 100.0)])
def test_weighted_ratio_of_known_pairs(a, b, score):
    assert weighted_ratio(a, b) == pytest.approx(score, abs=1e-5) and composite(a, b) == pytest.approx(score, abs=1e-5)


@pytest.mark.parametrize("threshold", [90.0, 60.0])
def test_topk_with_the_composite_score(spark, threshold):
    left = words(25, 41) + ["carrer gran de gracia", "gracia", "gran  carrer de gracia", "plaça", " "]
    right = words(40, 41) + ["carrer gran", "gran de gracia carrer", "carrer de la plaça de gracia", "plaça nova", "  ", "gracia gracia"]
    got = {r.a: r.matches for r in fuzzy.fuzzy_topk(
        texts(spark, left, "a"), texts(spark, right, "b"), "a", "b", threshold, 3, scorer="weighted").collect()}
    for a in left:
        scores = {b: composite(a, b) for b in right}
        best = sorted((b for b in right if scores[b] >= threshold - 1e-9), key=lambda b: (-round(scores[b], 9), b))[:3]
        assert got[a] == ", ".join(best)
