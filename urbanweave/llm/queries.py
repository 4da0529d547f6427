"""The numbered queries on the test tables, each with the SQL that states its result where SQL can."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanweave.llm import (covertree, decontamination, jaccard, language_model, lines, merkle, packing, passages, periodic, prefix_counts, quality, sharding,
                            warc)
from urbanweave.llm.shared import prepare
from urbanweave.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies: in the installed package, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(key: str, sql: str | None = None):
    """Register ``function(read) -> DataFrame``, where ``read(name)`` gives a table, under ``key``."""
    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return function(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))

        run.__name__ = key
        QUERIES[key] = run
        if sql:
            ORACLES[key] = sql
        return function

    return register


def held_out(doc, remainder: int):
    """Whether an id falls in the fold of this remainder."""
    return F.crc32(doc.cast("string").cast("binary")) % 5 == remainder


@query("op2_quality")
def quality_query(read):
    docs = read("documents")
    model = quality.fit(docs, read("labels"), learn=lambda doc: ~held_out(doc, 0))
    scored = quality.score(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id"), 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op3_decontamination", r"""
with words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
grams as (
    select distinct item_id, least(10, len(w)) as n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') as gram
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as k from items where len(w) > 0)),
sizes as (select distinct n from grams),
windows as (
    select doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') as gram
    from (select doc_id, n, w, unnest(range(1, len(w) - n + 2)) as k from words, sizes where len(w) >= n)),
found as (select doc_id, w.n, k, item_id from windows w join grams g on w.n = g.n and w.gram = g.gram),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(k, k + n)) as p from found) group by doc_id),
named as (select doc_id, count(distinct item_id) as n_items,
                 string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from found group by doc_id)
select w.doc_id, len(w.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words w left join hit h on w.doc_id = h.doc_id left join named i on w.doc_id = i.doc_id
""")
def decontamination_query(read):
    found = decontamination.find_contamination(read("documents"), read("benchmark"))
    items = F.array_sort(F.transform("found.items", lambda x: x.cast("string")))
    return found.select("doc_id", F.col("found.n_words").alias("n_words"), F.col("found.n_hit").alias("n_hit"),
                        F.size("found.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("found.n_hit") > 0).alias("contaminated"))


@query("op4_top_products", """
with vectors as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding) and len(embedding) > 0),
scored as (
    select q.vec_id as query_id, d.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * d.v[i]))::bigint as score
    from vectors q join vectors d on q.vec_id <> d.vec_id and len(q.v) = len(d.v) where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 5
""")
def product_query(read):
    vectors = read("embeddings")
    return covertree.top_products(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@query("op5_substring_dedup", r"""
with lines as (
    select doc_id, unnest(range(len(l))) as unit, unnest(l) as line from (select doc_id, string_split(text, chr(10)) as l from documents)),
units as (
    select doc_id, unit, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w, line,
           coalesce(sum(strlen(line) + 1) over (partition by doc_id order by unit rows between unbounded preceding and 1 preceding), 0) as pos
    from lines),
counted as (
    select *, sum(len(w)) over (partition by doc_id order by unit) - len(w) as lo, sum(len(w)) over (partition by doc_id order by unit) as hi
    from units where len(w) > 0),
whole as (select doc_id, flatten(list(w order by unit)) as w from counted group by doc_id),
runs as (
    select a.doc_id, a.unit, b.unit as last, a.pos as start, b.pos + strlen(b.line) as "end", a.lo, b.hi from counted a join counted b
    on a.doc_id = b.doc_id and a.lo + 20 > b.lo and a.lo + 20 <= b.hi
    union
    select a.doc_id, a.unit, b.unit, a.pos, b.pos + strlen(b.line), a.lo, b.hi from counted a join counted b
    on a.doc_id = b.doc_id and b.hi - 20 >= a.lo and b.hi - 20 < a.hi),
keyed as (select r.*, array_to_string(w[r.lo::bigint + 1:r.hi::bigint], ' ') as run from runs r join whole using (doc_id)),
ranked as (select *, first_value(doc_id) over same as kept, first_value(unit) over same as kept_unit, first_value(last) over same as kept_last from keyed
           window same as (partition by run order by doc_id, unit, last)),
later as (
    select *, max(last) over (partition by doc_id order by unit, last rows between unbounded preceding and 1 preceding) as reach
    from ranked where doc_id > kept or unit > kept_last),
spans as (select *, sum(case when unit <= reach + 1 then 0 else 1 end) over (partition by doc_id order by unit, last) as span from later)
select doc_id, min(unit)::bigint as unit, max(last)::bigint as last_unit, min(start)::bigint as start, max("end")::bigint as "end",
       (max(hi) - min(lo))::bigint as n_words, first(kept order by unit, last) as kept_doc_id, first(kept_unit order by unit, last)::bigint as kept_unit
from spans group by doc_id, span
""")
def substring_query(read):
    return passages.repeated_runs(read("documents"))


@query("op5_passage_dedup", r"""
with parts as (
    select doc_id, unnest(p) as part, unnest(range(len(p))) as n
    from (select doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as p from documents)),
placed as (
    select doc_id, part, n, sum(strlen(part)) over (partition by doc_id order by n) as "end",
           not regexp_matches(part, '^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]') as is_word from parts),
words as (
    select doc_id, row_number() over (partition by doc_id order by n) - 1 as lo, "end" - strlen(part) as start, "end",
           translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as word
    from placed where is_word),
whole as (select doc_id, list(word order by lo) as w from words group by doc_id),
units as (
    select doc_id, lo, start, lead("end", 49) over (partition by doc_id order by lo) as "end", md5(array_to_string(w[lo + 1:lo + 50], ' ')) as unit
    from words join whole using (doc_id)),
ranked as (
    select *, first_value(doc_id) over same as kept, first_value(lo) over same as kept_lo from units where "end" is not null
    window same as (partition by unit order by doc_id, lo)),
later as (
    select *, lag(lo) over (partition by doc_id order by lo) as before from ranked where doc_id > kept or lo >= kept_lo + 50),
spans as (select *, sum(case when lo <= before + 50 then 0 else 1 end) over (partition by doc_id order by lo) as span from later)
select doc_id, min(lo)::bigint as word, min(start)::bigint as start, max("end")::bigint as "end", (max(lo) + 50 - min(lo))::bigint as n_words,
       first(kept order by lo) as kept_doc_id, first(kept_lo order by lo)::bigint as kept_word
from spans group by doc_id, span
""")
def passage_query(read):
    return passages.repeated_passages(read("documents"))


@query("op8_line_dedup", r"""
with lines as (
    select doc_id, unnest(range(len(l))) as n, unnest(l) as line
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)),
keyed as (
    select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
held as (select key, min(doc_id) as keeper from keyed where length(key) >= 10 group by key having count(distinct doc_id) >= 2),
judged as (select k.*, h.keeper is not null and h.keeper <> k.doc_id as gone from keyed k left join held h on k.key = h.key)
select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by n) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
""")
def line_query(read):
    kept = lines.drop_repeated_lines(read("documents"), counts=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op1_sharding")
def sharding_query(read):
    placed = sharding.shard_rows(read("documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op6_packing")
def packing_query(read):
    return packing.pack(read("documents"), tokenizer_file("word_bpe_49k.json"))


@query("op10_warc")
def warc_query(read):
    pages = read("pages")
    path = warc.write_archive(pages, scratch_path(pages.sparkSession, "warc"))
    chunks = warc.read_chunks(pages.sparkSession, path, payload=False)
    return chunks.where("is_last").select(warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                          warc.page_of(F.col("refers_to")).alias("refers_to"))


@query("op7_jaccard_join")
def jaccard_query(read):
    return jaccard.near_groups(read("documents")).withColumnRenamed("doc", "doc_id")


@query("op9_language_model")
def language_model_query(read):
    docs = read("documents")
    scored = language_model.score_texts(docs, learn=~held_out(F.col("doc_id"), 1))
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


#: CRC-32 of an id in decimal, which DuckDB lacks: a table of 256 remainders, and one step for each character.
CRC = """
bits as (select list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n)) as remainder),
hashed as (
    select d.*, xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint),
                                lambda a, b: xor(a >> 8, remainder[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) as h
    from documents d, bits)"""


def planted(doc: int, n: int) -> np.ndarray | None:
    """Places of a text's words when a part of it is repeated, for a tenth of the ids."""
    h = zlib.crc32(str(doc).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


@query("op11_periodic_runs", rf"""
with {CRC},
cut as (select doc_id, h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from hashed),
placed as (select *, len(w) as n, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end as a from cut),
period as (select *, 1 + (n - a) // (3 + (h // 10) % 8) as p from placed),
whole as (
    select doc_id, n, case when a is null then w else list_transform(range(n), lambda i: w[case when i < a then i else a + (i - a) % p end + 1]) end as w
    from period),
words as (select doc_id, n, unnest(range(n)) as i, unnest(w) as word from whole),
pairs as (select x.doc_id, y.i - x.i as q, x.i from words x join words y on x.doc_id = y.doc_id and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n),
stretches as (
    select doc_id, q, min(i) as start, count(*) + q as size
    from (select *, i - row_number() over (partition by doc_id, q order by i) as stretch from pairs) group by doc_id, q, stretch
    having count(*) + q >= greatest(6, 4 * q)),
runs as (select doc_id, start, size, min(q) as q from stretches group by doc_id, start, size),
gone as (select distinct doc_id, unnest(range(start + q, start + size)) as i from runs),
listed as (select doc_id, count(*) as n_runs, string_agg(start || ',' || size || ',' || q || chr(10), '' order by start, q) as list,
                  first(struct_pack(start, size, q) order by size desc, start, q) as best from runs group by doc_id),
kept as (select w.doc_id, string_agg(word, ' ' order by w.i) as text from words w left join gone g on w.doc_id = g.doc_id and w.i = g.i
         where g.i is null group by w.doc_id)
select d.doc_id, coalesce(n_runs, 0)::bigint as n_runs, best.start::bigint as start, best.size::bigint as length, best.q::bigint as period,
       (1000 * best.size // best.q)::bigint as exponent_milli, sha256(coalesce(list, '')) as runs_sha256, sha256(coalesce(k.text, '')) as collapsed_sha256
from documents d left join listed l on d.doc_id = l.doc_id left join kept k on d.doc_id = k.doc_id
""")
def periodic_query(read):
    found = periodic.periodic_runs(read("documents"), arrange=planted)
    lines_ = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return found.withColumn("best", longest).select(
        F.col("doc").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines_, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op12_token_counts")
def token_count_query(read):
    counts = prefix_counts.prefix_counts(read("documents"), tokenizer_file("piece_bpe_32k.model"))
    limit = 4096
    return prefix_counts.longest_prefixes(counts, limit).select(
        F.col("doc").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_chars", "fit_chars", "fit_tokens")


@query("op13_merkle_manifest", rf"""
with recursive {CRC},
written as (
    select doc_id, source, h, concat(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
           coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')) as head, text, replace(text, chr(10), '') as bare from hashed),
leaves as (
    select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
           case when h % 2 = 0 then sha256(head || coalesce(strlen(bare) || ':' || bare, '-')) else sha256(head || coalesce(strlen(text) || ':' || text, '-')) end as received
    from written),
ranked as (select *, row_number() over (partition by source order by doc_id) - 1 as k from leaves),
trees as (select source, row_number() over (order by source nulls first) - 1 as s, list(leaf order by k) as nodes from ranked group by source),
levels as (
    select s, 0::bigint as up, nodes from trees
    union all
    select s, up + 1, list_transform(range(1, len(nodes) + 1, 3), lambda i: sha256(array_to_string(nodes[i:i + 2], ''))) from levels where len(nodes) > 1),
subroots as (select s, nodes[1] as subroot from levels where len(nodes) = 1),
heads as (
    select 0::bigint as up, list(subroot order by s) as nodes from subroots
    union all
    select up + 1, list_transform(range(1, len(nodes) + 1, 3), lambda i: sha256(array_to_string(nodes[i:i + 2], ''))) from heads where len(nodes) > 1),
placed as (select doc_id, leaf, received, k, t.s, subroot from ranked r join trees t on r.source is not distinct from t.source join subroots b on t.s = b.s),
near as (
    select doc_id, up, nodes, (k // (3 ** up)::bigint) as place from placed join levels on levels.s = placed.s where len(nodes) > 1
    union all
    select doc_id, 1000 + up, nodes, (s // (3 ** up)::bigint) from placed, heads where len(nodes) > 1),
steps as (
    select doc_id, row_number() over (partition by doc_id order by up) as step, array_to_string(nodes[place - place % 3 + 1:place], '') as before,
           array_to_string(nodes[place + 2:place - place % 3 + 3], '') as after from near),
proofs as (select doc_id, string_agg(before || after, '' order by step) as proof from steps group by doc_id),
folds as (
    select doc_id, 0::bigint as step, received as cur from placed
    union all
    select f.doc_id, f.step + 1, sha256(before || cur || after) from folds f join steps s on s.doc_id = f.doc_id and s.step = f.step + 1),
last as (select doc_id, cur as folded_root from (select *, row_number() over (partition by doc_id order by step desc) as r from folds) where r = 1)
select p.doc_id, leaf, subroot, (select nodes[1] from heads where len(nodes) = 1) as root, sha256(coalesce(proof, '')) as proof_sha256, folded_root,
       folded_root = (select nodes[1] from heads where len(nodes) = 1) as verified
from placed p left join proofs o on p.doc_id = o.doc_id join last l on p.doc_id = l.doc_id
""")
def merkle_query(read):
    damaged = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    manifest = merkle.build_manifest(read("documents"), "source", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], {"text": damaged})
    return merkle.prove(manifest).select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"),
                                         (F.col("folded") == F.col("root")).alias("verified"))
