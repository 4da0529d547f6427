"""Spatial and fuzzy joins."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entries.registry import query
from urbanweave.operators import fuzzy, spatial


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """``parts`` of a rectangle."""
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return F.array(F.array(F.array(*[F.array(x.cast("double"), y.cast("double")) for x, y in corners])))


def _points(t) -> DataFrame:
    """A point per line item inside 0..1000 by 0..100; coordinates never fall on a zone border."""
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice") % 1000 + 0.003).alias("x"),
        (F.col("l_quantity") * 2 + F.col("l_tax") + 0.003).alias("y"))


_POINTS_SQL = """select l_orderkey, l_linenumber, l_partkey, l_extendedprice % 1000 + 0.003 as x, l_quantity * 2 + l_tax + 0.003 as y
                 from lineitem"""


def _zones(t) -> DataFrame:
    """One rectangle per nation; neighbours overlap, some points are in none and some in two."""
    x, y = (F.col("n_nationkey") % 5) * 200, F.floor(F.col("n_nationkey") / 5) * 20
    return t.nation.select(F.col("n_name").alias("zone"), rectangle(x, y + 2, x + 230, y + 19).alias("parts"))


@query("spatial_join_within", f"""
    select l_orderkey, l_linenumber, l_partkey, n_name as zone from ({_POINTS_SQL})
    left join nation on x > (n_nationkey % 5) * 200 and x < (n_nationkey % 5) * 200 + 230
                    and y > (n_nationkey // 5) * 20 + 2 and y < (n_nationkey // 5) * 20 + 19""")
def spatial_join_within(t):
    return spatial.spatial_join_within(_points(t), _zones(t), "x", "y", "parts", ["zone"], 25.0).select(
        "l_orderkey", "l_linenumber", "l_partkey", "zone")


@query("spatial_filter_points", f"""
    select l_orderkey, l_linenumber, l_partkey from ({_POINTS_SQL}) where exists (select 1 from nation
      where n_regionkey = 2 and x > (n_nationkey % 5) * 200 and x < (n_nationkey % 5) * 200 + 230
        and y > (n_nationkey // 5) * 20 + 2 and y < (n_nationkey // 5) * 20 + 19)""")
def spatial_filter_points(t):
    x, y = (F.col("n_nationkey") % 5) * 200, F.floor(F.col("n_nationkey") / 5) * 20
    areas = t.nation.where("n_regionkey = 2").select(rectangle(x, y + 2, x + 230, y + 19).alias("parts"))
    return spatial.spatial_join_within(_points(t), areas, "x", "y", "parts", [], 25.0, "left_semi").select(
        "l_orderkey", "l_linenumber", "l_partkey")


@query("spatial_filter", """
    with f as (select p_partkey, p_partkey % 997 * 1.0 as x, p_partkey // 97 * 3.0 as y, p_size * 0.5 + 0.25 as w,
                      p_retailprice / 400 as h from part),
         z as (select s_suppkey * 37 % 900 + 0.1 as x, s_suppkey * 11 % 60 + 0.1 as y, 20 + s_nationkey as w, 3 as h from supplier)
    select p_partkey from f where exists (select 1 from z where f.x <= z.x + z.w and z.x <= f.x + f.w and f.y <= z.y + z.h and z.y <= f.y + f.h)""")
def spatial_filter(t):
    x, y = (F.col("p_partkey") % 997).cast("double"), F.floor(F.col("p_partkey") / 97) * 3.0
    features = t.part.select("p_partkey", rectangle(x, y, x + F.col("p_size") * 0.5 + 0.25, y + F.col("p_retailprice") / 400).alias("shape"))
    zx, zy = F.col("s_suppkey") * 37 % 900 + 0.1, F.col("s_suppkey") * 11 % 60 + 0.1
    zones = t.supplier.select(rectangle(zx, zy, zx + F.col("s_nationkey") + 20, zy + 3).alias("area"))
    return spatial.spatial_filter(features, zones, "p_partkey", "shape", "area", 10.0).select("p_partkey")


@query("spatial_filter_null_ids", """
    with f as (select p_partkey, p_partkey % 997 * 1.0 as x, p_partkey // 97 * 3.0 as y, p_size * 0.5 + 0.25 as w,
                      p_retailprice / 400 as h from part),
         z as (select s_suppkey * 37 % 900 + 0.1 as x, s_suppkey * 11 % 60 + 0.1 as y, 20 + s_nationkey as w, 3 as h from supplier)
    select case when p_partkey % 3 > 0 then (p_partkey % 50)::varchar end as id, p_partkey from f
    where exists (select 1 from z where f.x <= z.x + z.w and z.x <= f.x + f.w and f.y <= z.y + z.h and z.y <= f.y + f.h)""")
def spatial_filter_null_ids(t):
    """Ids that repeat or are null: each feature is judged by itself."""
    x, y = (F.col("p_partkey") % 997).cast("double"), F.floor(F.col("p_partkey") / 97) * 3.0
    features = t.part.select(F.when(F.col("p_partkey") % 3 > 0, (F.col("p_partkey") % 50).cast("string")).alias("id"), "p_partkey",
                             rectangle(x, y, x + F.col("p_size") * 0.5 + 0.25, y + F.col("p_retailprice") / 400).alias("shape"))
    zx, zy = F.col("s_suppkey") * 37 % 900 + 0.1, F.col("s_suppkey") * 11 % 60 + 0.1
    zones = t.supplier.select(rectangle(zx, zy, zx + F.col("s_nationkey") + 20, zy + 3).alias("area"))
    return spatial.spatial_filter(features, zones, "id", "shape", "area", 10.0).select("id", "p_partkey")


_SHAPES = """select p_partkey, p_size * 1.0 as w, p_retailprice / 10 as h from part"""


def _framed(t) -> DataFrame:
    """A rectangle with a rectangular hole, and a unit square beside it as second part."""
    w, h = F.col("p_size").cast("double"), F.col("p_retailprice") / 10
    outer = rectangle(F.lit(5.0), F.lit(7.0), w + 5, h + 7)[0][0]
    hole = rectangle(F.lit(5.25), F.lit(7.5), F.lit(5.75), F.lit(8.0))[0][0]
    extra = rectangle(F.lit(-3.0), F.lit(-3.0), F.lit(-2.0), F.lit(-2.0))[0]
    return t.part.select("p_partkey", F.array(F.array(outer, hole), extra).alias("parts"))


@query("polygon_measures", f"""
    select p_partkey, round(w * h - 0.25 + 1, 6) as area, round(2 * (w + h) + 2 + 4, 6) as perimeter from ({_SHAPES})""")
def polygon_measures(t):
    measured = spatial.polygon_measures(_framed(t), "parts")
    return measured.select("p_partkey", F.round("area", 6).alias("area"), F.round("perimeter", 6).alias("perimeter"))


@query("polygon_centroid", f"""
    select p_partkey, 0 as part, round(((5 + w / 2) * w * h - 5.5 * 0.25) / (w * h - 0.25), 6) as x,
           round(((7 + h / 2) * w * h - 7.75 * 0.25) / (w * h - 0.25), 6) as y from ({_SHAPES})
    union all select p_partkey, 1, -2.5, -2.5 from part""")
def polygon_centroid(t):
    centred = spatial.polygon_centroid(_framed(t), "parts")
    return centred.select("p_partkey", "part", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("nearest_station", """
    with p as (select o_orderkey, o_orderkey % 137 - 68.5 as lat, o_custkey % 331 - 165.25 as lon from orders),
         s as (select s_name, s_suppkey * 17 % 120 - 60 as lat, s_suppkey * 29 % 340 - 170 as lon from supplier)
    select o_orderkey, arg_min(s_name, d) as station, round(min(d), 3) as distance from (
      select o_orderkey, s_name, 2 * 6371.0088 * asin(least(1, sqrt(sin(radians(s.lat - p.lat) / 2) ** 2 +
             cos(radians(p.lat)) * cos(radians(s.lat)) * sin(radians(s.lon - p.lon) / 2) ** 2))) as d from p, s) group by 1""")
def nearest_station(t):
    points = t.orders.select("o_orderkey", (F.col("o_orderkey") % 137 - 68.5).alias("lat"), (F.col("o_custkey") % 331 - 165.25).alias("lon"))
    stations = t.supplier.select("s_name", (F.col("s_suppkey") * 17 % 120 - 60).alias("lat"), (F.col("s_suppkey") * 29 % 340 - 170).alias("lon"))
    return spatial.nearest_station(points, stations, "o_orderkey", ["lat", "lon"], "s_name", ["lat", "lon"]).select(
        "o_orderkey", F.col("s_name").alias("station"), F.round("distance", 3).alias("distance"))


@query("nearest_station_plane", """
    with p as (select vec_id, embedding[1]::double as x, embedding[2]::double as y from embeddings),
         s as (select doc_id, (doc_id * 7 % 101) / 100.0 - 0.5 as x, (doc_id * 13 % 103) / 100.0 - 0.5 as y from documents)
    select vec_id, min_by(doc_id, (d2, doc_id)) as station, round(sqrt(min(d2)), 6) as distance from (
      select vec_id, doc_id, (p.x - s.x) ** 2 + (p.y - s.y) ** 2 as d2 from p, s) group by 1""")
def nearest_station_plane(t):
    points = t.embeddings.select("vec_id", F.get("embedding", 0).cast("double").alias("x"), F.get("embedding", 1).cast("double").alias("y"))
    stations = t.documents.select("doc_id", (F.col("doc_id") * 7 % 101 / 100 - 0.5).alias("x"), (F.col("doc_id") * 13 % 103 / 100 - 0.5).alias("y"))
    found = spatial.nearest_station(points, stations, "vec_id", ["x", "y"], "doc_id", ["x", "y"], "plane")
    return found.select("vec_id", F.col("doc_id").alias("station"), F.round("distance", 6).alias("distance"))


@query("nearest_station_many", """
    with p as (select c_custkey, c_custkey * 37 % 1009 / 10.0 as x, c_custkey * 91 % 997 / 10.0 as y from customer),
         s as (select o_orderkey, o_orderkey * 53 % 1013 / 10.0 as x, o_custkey * 71 % 1019 / 10.0 as y from orders),
         d as (select c_custkey, o_orderkey, (p.x - s.x) ** 2 + (p.y - s.y) ** 2 as d2 from p, s)
    select case when c_custkey % 20 > 0 then c_custkey::varchar end as c_custkey, min_by(o_orderkey, (d2, o_orderkey)) as station,
           round(sqrt(min(d2)), 6) as distance from d group by d.c_custkey""")
def nearest_station_many(t):
    # Some ids are null.
    points = t.customer.select(F.when(F.col("c_custkey") % 20 > 0, F.col("c_custkey").cast("string")).alias("c_custkey"),
                               (F.col("c_custkey") * 37 % 1009 / 10).alias("x"), (F.col("c_custkey") * 91 % 997 / 10).alias("y"))
    stations = t.orders.select("o_orderkey", (F.col("o_orderkey") * 53 % 1013 / 10).alias("x"), (F.col("o_custkey") * 71 % 1019 / 10).alias("y"))
    found = spatial.nearest_station(points, stations, "c_custkey", ["x", "y"], "o_orderkey", ["x", "y"], "plane")
    return found.select("c_custkey", F.col("o_orderkey").alias("station"), F.round("distance", 6).alias("distance"))


# Similarity of all pairs by dynamic programming over lists: one recursion step per character of the left text.
_LEFT = """select distinct unnest([replace(p_name, 'e', ''), p_name || 's', reverse(p_name), p_name]) as a from part"""
_SCORES = f"""
    with recursive l as ({_LEFT}), r as (select distinct p_name as b from part),
    dp(a, b, i, best) as (
      select a, b, 0, list_transform(range(length(b) + 1), lambda x: 0) from l, r
      union all
      select a, b, i + 1, list_concat([0], [list_max(t[1:j]) for j in range(1, length(b) + 1)]) from (
        select a, b, i, [greatest(best[j + 1], best[j] + (substr(a, i + 1, 1) = substr(b, j, 1))::integer)
                         for j in range(1, length(b) + 1)] as t from dp where i < length(a))),
    scores as (select a, b, 200.0::double * best[-1] / (length(a) + length(b)) as score from dp where i = length(a))"""


def _perturbed(t) -> DataFrame:
    return t.part.select(F.explode(F.array(
        F.replace("p_name", F.lit("e"), F.lit("")), F.concat("p_name", F.lit("s")), F.reverse("p_name"), "p_name")).alias("a"))


@query("fuzzy_best_match", f"""{_SCORES}
    select a, b as match, round(score, 6) as score from scores qualify row_number() over (partition by a order by score desc, b) = 1""")
def fuzzy_best_match(t):
    found = fuzzy.fuzzy_best_match(_perturbed(t), t.part, "a", "p_name", block=16, chunk=24)
    return found.select("a", "match", F.round("score", 6).alias("score"))


@query("fuzzy_topk", f"""{_SCORES}, top as (
      select a, b, score from scores where score >= 80 qualify row_number() over (partition by a order by score desc, b) <= 3)
    select l.a, coalesce(string_agg(b, ', ' order by score desc, b), '') as matches from l left join top on l.a = top.a group by 1""")
def fuzzy_topk(t):
    return fuzzy.fuzzy_topk(_perturbed(t).distinct(), t.part, "a", "p_name", 80.0, 3)


# The composite score: all texts that it compares, each with its weight, and the best of them. A partial score takes every window of the longer text.
_WEIGHTED = f"""
    with recursive l as ({_LEFT}), r as (select distinct p_name as b from part),
    words as (
      select t, list_sort(list_filter(string_split(t, ' '), lambda x: x <> '')) as w from (select a as t from l union select b from r)),
    pairs as (
      select a, b, p.w as wa, q.w as wb, list_sort(list_distinct(p.w)) as ua, list_sort(list_distinct(q.w)) as ub,
             greatest(length(a), length(b))::double / least(length(a), length(b)) as quotient
      from l, r, words p, words q where p.t = a and q.t = b and a <> '' and b <> ''),
    told as (
      select *, list_filter(ua, lambda x: list_contains(ub, x)) as same, list_filter(ua, lambda x: not list_contains(ub, x)) as rest_a,
             list_filter(ub, lambda x: not list_contains(ua, x)) as rest_b, len(wa) > 0 and len(wb) > 0 as worded,
             case when quotient < 1.5 then null when quotient <= 8 then 0.9::double else 0.6::double end as partial from pairs),
    partials as (
      select a, b, a as x, b as y, partial as weight from told where partial is not null
      union all select a, b, array_to_string(wa, ' '), array_to_string(wb, ' '), 0.95::double * partial from told where partial is not null and worded and len(same) = 0
      union all select a, b, array_to_string(ua, ' '), array_to_string(ub, ' '), 0.95::double * partial from told where partial is not null and worded and len(same) = 0),
    sides as (
      select a, b, x, y, weight from partials where length(x) <= length(y)
      union all select a, b, y, x, weight from partials where length(y) <= length(x)),
    compared as (
      select a, b, a as x, b as y, 1.0::double as weight from told
      union all select a, b, array_to_string(wa, ' '), array_to_string(wb, ' '), 0.95::double from told where partial is null and (len(wa) > 0 or len(wb) > 0)
      union all select a, b, array_to_string(list_concat(same, rest_a), ' '), array_to_string(list_concat(same, rest_b), ' '), 0.95::double
      from told where partial is null and worded
      union all select a, b, array_to_string(same, ' '), array_to_string(list_concat(same, rest_a), ' '), 0.95::double from told where partial is null and len(same) > 0
      union all select a, b, array_to_string(same, ' '), array_to_string(list_concat(same, rest_b), ' '), 0.95::double from told where partial is null and len(same) > 0
      union all select a, b, a, a, 0.95::double * partial from told where partial is not null and len(same) > 0
      union all select a, b, x, substr(y, greatest(i, 0) + 1, i + length(x) - greatest(i, 0)), weight
      from (select *, unnest(range(1 - length(x), length(y))) as i from sides)),
    dp(x, y, i, best) as (
      select x, y, 0, list_transform(range(length(y) + 1), lambda k: 0) from (select distinct x, y from compared)
      union all
      select x, y, i + 1, list_concat([0], [list_max(t[1:j]) for j in range(1, length(y) + 1)]) from (
        select x, y, i, [greatest(best[j + 1], best[j] + (substr(x, i + 1, 1) = substr(y, j, 1))::integer)
                         for j in range(1, length(y) + 1)] as t from dp where i < length(x))),
    ratios as (
      select x, y, case when length(x) + length(y) = 0 then 100.0::double else 200.0::double * best[-1] / (length(x) + length(y)) end as ratio
      from dp where i = length(x)),
    scores as (select a, b, max(weight * ratio) as score from compared join ratios using (x, y) group by a, b)"""


@query("fuzzy_topk_weighted", f"""{_WEIGHTED}, top as (
      select a, b, score from scores where score >= 90 - 1e-9 qualify row_number() over (partition by a order by score desc, b) <= 3)
    select l.a, coalesce(string_agg(b, ', ' order by score desc, b), '') as matches from l left join top on l.a = top.a group by 1""")
def fuzzy_topk_weighted(t):
    return fuzzy.fuzzy_topk(_perturbed(t).distinct(), t.part, "a", "p_name", 90.0, 3, scorer="weighted")


@query("match_one_to_one", """
    select c_custkey as meter, o_custkey as place, round(200.0 * 18 / 37, 6) as score from customer
    join (select distinct o_custkey from orders) on c_custkey = o_custkey where c_custkey % 5 > 0
    union all select c_custkey, c_custkey, 100.0 from customer
    where c_custkey % 5 = 0 and c_custkey in (select o_custkey from orders)""")
def match_one_to_one(t):
    meters = t.customer.select(F.col("c_custkey").alias("meter"), F.concat(
        "c_name", F.when(F.col("c_custkey") % 5 > 0, ".").otherwise("")).alias("text"))
    places = t.orders.select(F.col("o_custkey").alias("place")).distinct().withColumn(
        "address", F.concat(F.lit("Customer#"), F.lpad(F.col("place").cast("string"), 9, "0")))
    return fuzzy.match_one_to_one(meters, places, "meter", "text", "place", "address").select(
        "meter", "place", F.round("score", 6).alias("score"))
