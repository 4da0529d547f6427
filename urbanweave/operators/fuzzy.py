"""Approximate text joins that are exact about their score.

Candidates come from an equi-join on the rarest q-grams of each text (prefix filtering): two texts that
reach the threshold must share one of them, so no pair is lost and common grams never become a join key
while rarer ones are left. Texts so short that only one edit is allowed meet by what is left without a character. Everything runs on distinct texts; copies of a text cost nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanweave.functions.similarity import TAKEN, best_in_chunk, indel_ratio, near_in_chunk, numbered_grams, take_in_order, weighted_in_chunk
from urbanweave.operators.dedup import first_per_key, number_within
from urbanweave.operators.graph import connected_components
from urbanweave.session import cut_lineage, settle

_PAD = "\u0001"
_EPS = 1e-9
#: Up to this many edits, candidates must share two rare grams instead of one (at most 55 keys per text).
PAIR_EDITS = 3


def _max_edits(length: int, threshold: float) -> int:
    """Most insertions and deletions between a text of this length and any text within the threshold."""
    t = threshold / 100.0
    return math.floor(length * 2 * (1 - t) / t + _EPS)


def _gram_width(threshold: float) -> int | None:
    """Widest gram for which texts within the threshold always share one (grams are padded); None below about 80."""
    for width in (3, 2):
        if threshold > 0 and all(n + width - 1 > width * _max_edits(n, threshold) for n in range(1, 2000)):
            return width
    return None


def _max_edits_column(length: Column, threshold: float) -> Column:
    t = threshold / 100.0
    return F.floor(length * F.lit(2 * (1 - t) / t) + F.lit(_EPS))


def _grams(texts: DataFrame, width: int) -> DataFrame:
    """One row per (text, gram, occurrence); the occurrence makes repeated grams distinct."""
    return texts.select("text", F.explode(numbered_grams("text", F.lit(width))).alias("gram"))


def _two_gram_keys(threshold: float, width: int) -> bool:
    """Do texts within the threshold always share two grams, for up to ``PAIR_EDITS`` edits?"""
    return all(n + width - 1 - width * min(_max_edits(n, threshold), PAIR_EDITS) >= 2 for n in range(1, 2000))


def _join_keys(grams: DataFrame, frequency: DataFrame, width: int, threshold: float) -> DataFrame:
    """Join keys ``(text, key)`` out of the rarest grams of each text.

    ``e`` edits touch at most ``width * e`` grams, so two texts share one of their first ``width * e + 1``
    grams, and two of their first ``width * e + 2``, in any common order; rarest first is the most telling.
    Pairs that allow at most ``PAIR_EDITS`` edits meet on two grams at once, all others on one. A text has
    keys of both kinds if its partners may fall on either side.
    """
    t = threshold / 100.0
    ordered = grams.join(frequency, "gram").groupBy("text").agg(
        F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("grams")
    ).withColumn("edits", _max_edits_column(F.length("text"), threshold).cast("int"))
    two_limit = PAIR_EDITS if _two_gram_keys(threshold, width) else -1
    least = _max_edits_column(F.length("text") * F.lit(t / (2 - t)), threshold)

    def prefix(extra: int, edits: Column) -> Column:
        return F.transform(F.slice("grams", F.lit(1), edits * width + extra), lambda item: item.gram)

    def pairs(items: Column) -> Column:
        return F.flatten(F.transform(items, lambda x, i: F.transform(
            F.slice(items, i + 2, F.size(items)), lambda y: F.concat(x, F.lit(_PAD + _PAD), y))))

    none = F.array().cast("array<string>")
    singles = F.when(F.col("edits") > two_limit, prefix(1, F.col("edits"))).otherwise(none)
    doubles = F.when(least <= two_limit, pairs(prefix(2, F.least("edits", F.lit(two_limit))))).otherwise(none)
    return ordered.select("text", F.explode(F.concat(singles, doubles)).alias("key"))


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """All pairs ``(left_text, right_text, score)`` of distinct texts with ``score >= threshold``.

    ``left`` and ``right`` have one column ``text`` of distinct non-null values.
    """
    equal = left.join(right, "text", "left_semi").select(
        F.col("text").alias("left_text"), F.col("text").alias("right_text"), F.lit(100.0).alias("score")
    )
    width = _gram_width(threshold)
    if width is None:  # texts that far apart need not share any gram: blocks are compared, and only pairs in reach are kept
        met = _blocks(left, right.select(F.col("text").alias("right_text"), F.struct("text").alias("__rank")))
        return met.select(F.explode(near_in_chunk("block_texts", "texts", F.lit(threshold - _EPS))).alias("hit")).select(
            F.col("hit.text").alias("left_text"), F.col("hit.best").alias("right_text"), "hit.score")
    single = _one_deletion(left, right, threshold)
    long_enough = _max_edits_column(F.length("text"), threshold) >= 2
    left_grams = _grams(left.where(long_enough), width)
    right_grams = _grams(right.where(long_enough), width)
    frequency = settle(left_grams.select("gram").unionByName(right_grams.select("gram")).groupBy("gram").agg(
        F.count(F.lit(1)).alias("n")
    ))
    a = _join_keys(left_grams, frequency, width, threshold).withColumnRenamed("text", "left_text")
    b = _join_keys(right_grams, frequency, width, threshold).withColumnRenamed("text", "right_text")
    allowed = F.floor(
        (F.length("left_text") + F.length("right_text")) * F.lit(1 - threshold / 100.0) + F.lit(_EPS)
    ).cast("int")
    gap = F.abs(F.length("left_text") - F.length("right_text"))
    # Levenshtein distance is never above the indel distance, and -1 beyond the bound.
    bound = int(2 * 65536)
    near = F.when(allowed >= bound, F.lit(True)).otherwise(
        F.levenshtein("left_text", "right_text") <= allowed
    )
    candidates = (
        a.join(b.hint("merge"), "key").where((F.col("left_text") != F.col("right_text")) & (allowed >= 2) & (gap <= allowed) & near)
        .select("left_text", "right_text").distinct()
    )
    scored = candidates.withColumn("score", indel_ratio("left_text", "right_text"))
    return equal.unionByName(single).unionByName(scored.where(F.col("score") >= F.lit(threshold - _EPS)))


def _one_deletion(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(left_text, right_text, score)`` of lengths that allow just one insertion or deletion.

    The shorter text is the longer one without a character, so they meet by the hash of that: one key for each character of a text, however many
    texts share its grams. Texts are cut only if the other side has texts of that length.
    """
    lengths = [sorted(r[0] for r in side.select(F.length("text")).distinct().collect()) for side in (left, right)]  # few, whatever the rows

    def found(longer: DataFrame, shorter: DataFrame, of_longer: list[int], of_shorter: list[int]) -> DataFrame:
        kept = [n for n in of_shorter if n + 1 in of_longer and math.floor((2 * n + 1) * (1 - threshold / 100.0) + _EPS) == 1]
        without = "concat(substring(long, 1, at - 1), substring(long, at + 1))"
        # Deleting any character of a run of equal ones gives the same text: the first of the run stands for it.
        cut = longer.where(F.length("text").isin([n + 1 for n in kept])).select(F.col("text").alias("long"), F.explode(F.sequence(F.lit(1), F.length("text"))).alias("at")).where(
            "at = 1 or substring(long, at, 1) <> substring(long, at - 1, 1)").selectExpr("long", "at", f"xxhash64({without}) as key")
        whole = shorter.where(F.length("text").isin(kept)).selectExpr("text as short", "xxhash64(text) as own")
        return cut.join(whole.hint("merge"), F.expr(f"key = own and {without} = short")).selectExpr("long", "short", "200.0D * length(short) / (length(long) + length(short)) as score")

    return found(left, right, *lengths).select(F.col("long").alias("left_text"), F.col("short").alias("right_text"), "score").unionByName(
        found(right, left, *lengths[::-1]).select(F.col("short").alias("left_text"), F.col("long").alias("right_text"), "score"))


def weighted_pairs(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """All pairs ``(left_text, right_text, score)`` of distinct texts whose weighted score is at least ``threshold``.

    A short text inside a long one, or one common word, can reach a high score, so no gram is sure to be shared: blocks of texts meet
    chunks of texts, and only pairs within a bound or with a common word are scored.
    """
    met = _blocks(left, right.select(F.col("text").alias("right_text"), F.struct("text").alias("__rank")))
    return met.select(F.explode(weighted_in_chunk("block_texts", "texts", F.lit(threshold - _EPS))).alias("hit")).select(
        F.col("hit.text").alias("left_text"), F.col("hit.best").alias("right_text"), "hit.score")


#: Copies of each chunk of the offered side, so that a small choice is still compared by many tasks.
SPREAD = 64


def _blocks(wanted: DataFrame, choices: DataFrame, block: int = 256, chunk: int = 4096) -> DataFrame:
    """Every block of wanted texts next to every chunk of offered ones: ``(block_texts, texts, ranks)``.

    Distinct texts spread evenly by hash, so blocks and chunks stay near their size. Blocks meet a chunk in one of its
    copies, so the pairs of one chunk are spread over up to :data:`SPREAD` tasks.
    """
    wanted = cut_lineage(wanted)
    blocks, chunks = max(1, -(-wanted.count() // block)), max(1, -(-choices.count() // chunk))
    copies = min(SPREAD, blocks)
    right_chunks = choices.groupBy(F.pmod(F.xxhash64("right_text"), F.lit(chunks)).alias("chunk")).agg(
        F.array_sort(F.collect_list("__rank")).alias("items")
    ).select("chunk", F.transform("items", lambda i: i.getField(_text_field(choices))).alias("texts"),
             F.transform("items", lambda i, k: k.cast("long")).alias("ranks"),
             F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias("copy"))
    left_blocks = wanted.groupBy(F.pmod(F.xxhash64("text"), F.lit(blocks)).alias("block")).agg(
        F.collect_list("text").alias("block_texts")
    ).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    spread = left_blocks.withColumn("copy", F.pmod("block", F.lit(copies)))
    # as many partitions as pairs allow: neither side is large enough for Spark to see how much work a row is
    tasks = max(1, min(blocks * chunks, copies * chunks, 4096))
    return spread.repartition(tasks, "chunk", "copy").join(right_chunks.repartition(tasks, "chunk", "copy").hint("merge"), ["chunk", "copy"])


def _text_field(choices: DataFrame) -> str:
    """Last field of the rank: the text itself."""
    return choices.schema["__rank"].dataType.fieldNames()[-1]


def _distinct_texts(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("text")).where(F.col("text").isNotNull()).distinct()


def fuzzy_topk(left: DataFrame, right: DataFrame, left_on: str, right_on: str, threshold: float = 90.0,
               limit: int = 1, order: str | None = None, out: str = "matches", scorer: str = "ratio") -> DataFrame:
    """Rows of ``left`` with the ``limit`` best right texts of at least ``threshold``, joined by ``', '``.

    Ties go to the lower ``order`` column of ``right`` (its text by default). No match gives ``''``. ``scorer`` is ``ratio`` or
    ``weighted``, the composite of plain, partial and word ratios.
    """
    search = {"ratio": similar_pairs, "weighted": weighted_pairs}[scorer]
    ranks = right.where(F.col(right_on).isNotNull()).groupBy(F.col(right_on).alias("right_text")).agg(
        F.min(order or right_on).alias("__order")
    )
    pairs = search(_distinct_texts(left, left_on), ranks.select(F.col("right_text").alias("text")), threshold)
    best = first_per_key(
        pairs.join(ranks, "right_text"), ["left_text"],
        [F.col("score").desc(), F.col("__order").asc(), F.col("right_text").asc()], limit,
    )
    # At most ``limit`` structs per text; negating the score sorts best first.
    joined = best.groupBy("left_text").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("a"), F.col("__order").alias("b"), "right_text"))),
        lambda item: item.right_text), ", ").alias(out))
    return (
        left.join(joined, left[left_on] == joined["left_text"], "left").drop("left_text")
        .withColumn(out, F.coalesce(F.col(out), F.lit("")))
    )


def fuzzy_best_match(left: DataFrame, right: DataFrame, left_on: str, right_on: str, order: str | None = None,
                     out: str = "match", score: str = "score", block: int = 256, chunk: int = 4096) -> DataFrame:
    """Best right text for each distinct left text, whatever its score; ties go to the lower ``order``.

    Texts with a partner of 90 or more are settled by the gram join: all such partners are found, so the
    best one is exact. A text without one has to be compared with every right text; that is done block
    against chunk, both of bounded size, and each comparison leaves one row per text of the block.
    """
    ranks = right.where(F.col(right_on).isNotNull()).groupBy(F.col(right_on).alias("right_text")).agg(
        F.min(order or right_on).alias("__order")
    )
    choices = cut_lineage(ranks.select(
        "right_text", F.struct("__order", "right_text").alias("__rank")
    ))
    wanted = cut_lineage(_distinct_texts(left, left_on))
    ranking = [F.col("score").desc(), F.col("__rank").asc()]

    pairs = similar_pairs(wanted, choices.select(F.col("right_text").alias("text")), 90.0)
    settled = cut_lineage(first_per_key(pairs.join(choices, "right_text"), ["left_text"], ranking))
    rest = wanted.join(settled, wanted["text"] == settled["left_text"], "left_anti")
    found = settled.select("left_text", "right_text", "score")

    partial = (
        _blocks(rest, choices, block, chunk)
        .select(F.explode(best_in_chunk("block_texts", "texts", "ranks")).alias("hit"))
        .select(F.col("hit.text").alias("left_text"), F.col("hit.best").alias("right_text"), "hit.score")
    )
    scanned = first_per_key(partial.join(choices, "right_text"), ["left_text"], ranking)
    found = found.unionByName(scanned.select("left_text", "right_text", "score"))
    return found.select(F.col("left_text").alias(left_on), F.col("right_text").alias(out), F.col("score").alias(score))


#: A component of at most so many pairs is settled by one task.
TOGETHER = 1_000_000


def match_one_to_one(left: DataFrame, right: DataFrame, left_id: str, left_text: str, right_id: str,
                     right_text: str, threshold: float = 97.0, shards: int = 1024, together: int = TOGETHER) -> DataFrame:
    """Pair rows one to one by text similarity: ``(left_id, right_id, score)``.

    Pairs of at least ``threshold`` are taken greedily, best score first, then left text, then right text.
    Equal texts are paired first. Of more than ``together`` other pairs a round takes all that are best for both sides, and another one if
    that halves them. The pairs left fall into connected components that don't touch each other: one of at most ``together``
    pairs is sorted and settled by one task, which holds one component at a time. A larger one is cut by more rounds, until its parts fit. Texts carry their number of rows, so equal rows are paired by number instead of
    forming all combinations.
    """
    a = left.select(F.col(left_id).alias("__lid"), F.col(left_text).alias("left_text")).dropna()
    b = right.select(F.col(right_id).alias("__rid"), F.col(right_text).alias("right_text")).dropna()
    left_all = cut_lineage(a.groupBy("left_text").agg(F.count(F.lit(1)).alias("left_free"), F.min("__lid").alias("__lid")))
    right_all = cut_lineage(b.groupBy("right_text").agg(F.count(F.lit(1)).alias("right_free"), F.min("__rid").alias("__rid")))
    left_free = left_all.drop("__lid").withColumn("left_used", F.lit(0).cast("long"))
    right_free = right_all.drop("__rid").withColumn("right_used", F.lit(0).cast("long"))
    # Only equal texts score 100, so they are the first pairs in any case; the search is for what they leave.
    equal = cut_lineage(left_free.join(right_free, F.col("left_text") == F.col("right_text")).withColumn("score", F.lit(100.0))
                        .withColumn("take", F.least("left_free", "right_free")))
    parts: list[DataFrame] = [equal.select("left_text", "right_text", "score", "take", "left_used", "right_used")]
    left_free, right_free = (
        cut_lineage(_use(free, equal, side).where(f"{side}_free > 0")) for free, side in ((left_free, "left"), (right_free, "right")))
    live = cut_lineage(similar_pairs(
        left_free.select(F.col("left_text").alias("text")), right_free.select(F.col("right_text").alias("text")), threshold,
    ).join(left_free, "left_text").join(right_free, "right_text"))
    while count := live.count():
        if count <= together:  # all components fit in one task
            parts.append(cut_lineage(_settled(live.withColumn("component", F.lit(0).cast("long")).repartition(1))))
            break
        taken, live = _mutual_round(live)
        parts.append(taken)
        if live.count() <= max(together, count // 2):
            continue
        # Two texts of one hash at most unite two components, which changes no pair.
        ends = live.select(F.xxhash64(F.lit("left"), "left_text").alias("node"), F.xxhash64(F.lit("right"), "right_text").alias("other"))
        named = live.withColumn("node", F.xxhash64(F.lit("left"), "left_text")).join(connected_components(ends, "node", "other"), "node").drop("node")
        sizes = named.groupBy("component").agg(F.count(F.lit(1)).alias("__pairs"))
        giant = settle(sizes.where(F.col("__pairs") > together).select("component"))
        parts.append(cut_lineage(_settled(named.join(giant, "component", "left_anti").repartition("component"))))
        live = cut_lineage(named.join(giant, "component", "left_semi").drop("component"))
    agreed = parts[0]
    for later in parts[1:]:
        agreed = agreed.unionByName(later)
    numbered_left = _numbered(a, left_all, "left", "__lid", shards)
    numbered_right = _numbered(b, right_all, "right", "__rid", shards)
    # A pair of texts owns a run of numbers on each side; the k-th row of one run meets the k-th of the other.
    place = F.col("left_no") - F.col("left_used")
    seated = (
        numbered_left.join(agreed, "left_text").where((place >= 1) & (place <= F.col("take")))
        .withColumn("right_no", F.col("right_used") + place)
    )
    return seated.join(numbered_right, ["right_text", "right_no"]).select(
        F.col("__lid").alias(left_id), F.col("__rid").alias(right_id), "score"
    )


def _numbered(rows: DataFrame, texts: DataFrame, side: str, row_id: str, shards: int) -> DataFrame:
    """Rows with their number within their text. A text of one row has it beside its count, so only rows of repeated texts are numbered."""
    text, free = f"{side}_text", f"{side}_free"
    ones = texts.where(F.col(free) == 1).select(row_id, text, F.lit(1).cast("long").alias(f"{side}_no"))
    repeated = settle(texts.where(F.col(free) > 1).select(F.col(text).alias("__repeated")))
    if repeated.isEmpty():
        return ones
    many = rows.join(repeated, F.col(text) == F.col("__repeated"), "left_semi")
    return ones.unionByName(number_within(many, [text], [row_id], f"{side}_no", F.pmod(F.xxhash64(row_id), F.lit(shards)), shards))


def _settled(named: DataFrame) -> DataFrame:
    """Greedy pairs of whole components, each of which lies in one partition."""
    columns = ["component", "left_text", "right_text", "score", "left_free", "left_used", "right_free", "right_used"]
    return named.select(*columns).sortWithinPartitions("component", F.col("score").desc(), "left_text", "right_text").mapInPandas(
        take_in_order, TAKEN)


def _mutual_round(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All pairs that are best for both of their texts, and the pairs that are open after them."""
    by_left = first_per_key(live, ["left_text"], [F.col("score").desc(), F.col("right_text").asc()])
    best = first_per_key(live, ["right_text"], [F.col("score").desc(), F.col("left_text").asc()])
    taken = cut_lineage(by_left.join(best.select("left_text", "right_text"), ["left_text", "right_text"])
                        .withColumn("take", F.least("left_free", "right_free")))
    open_pairs = _use(_use(live, taken, "left"), taken, "right")
    return (taken.select("left_text", "right_text", "score", "take", "left_used", "right_used"),
            cut_lineage(open_pairs.where("left_free > 0 and right_free > 0").select(*live.columns)))


def _use(free: DataFrame, taken: DataFrame, side: str) -> DataFrame:
    """Subtract what a round took; each text takes part in at most one pair per round."""
    text, left_over, used = f"{side}_text", f"{side}_free", f"{side}_used"
    spent = taken.select(text, "take")
    return free.join(spent, text, "left").withColumns({
        left_over: F.col(left_over) - F.coalesce("take", F.lit(0)), used: F.col(used) + F.coalesce("take", F.lit(0))}).drop("take")
