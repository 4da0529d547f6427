"""Lookups, joins, deduplication and aggregation."""

from pyspark.sql import functions as F

from entries.registry import query
from urbanweave.functions.text import zero_pad
from urbanweave.operators import aggregate, dedup, lookups, reshape


@query("semi_join_known", """
    select o_orderkey, o_custkey from orders
    where o_custkey in (select c_custkey from customer where c_mktsegment <> 'MACHINERY')""")
def semi_join_known(t):
    known = t.customer.where(F.col("c_mktsegment") != "MACHINERY")
    return lookups.semi_join_known(t.orders.select("o_orderkey", "o_custkey"), known, "o_custkey", "c_custkey")


# Two dictionary rows per nation: the later one (seq 2) wins.
_NATIONS = """select n_nationkey, n_name, 1 as seq from nation union all
              select n_nationkey, n_name || '*', 2 from nation where n_regionkey < 3"""


def _nations(t):
    first = t.nation.select("n_nationkey", "n_name", F.lit(1).alias("seq"))
    return first.unionByName(t.nation.where("n_regionkey < 3").select(
        "n_nationkey", F.concat("n_name", F.lit("*")).alias("n_name"), F.lit(2).alias("seq")))


@query("lookup_strict", f"""
    select c_custkey, d.name from customer
    join (select n_nationkey, arg_max(n_name, seq) as name from ({_NATIONS}) group by 1) d on n_nationkey = c_nationkey""")
def lookup_strict(t):
    return lookups.lookup_strict(t.customer, _nations(t), "c_nationkey", "n_nationkey", "n_name", "name", ["seq"]).select(
        "c_custkey", "name")


@query("lookup_lenient", """
    select c_custkey, n_name as name from customer
    left join (select * from nation where n_regionkey <> 1) on n_nationkey = nullif(c_nationkey, 7)""")
def lookup_lenient(t):
    rows = t.customer.withColumn("k", F.nullif("c_nationkey", F.lit(7)))
    return lookups.lookup_lenient(rows, t.nation.where("n_regionkey <> 1"), "k", "n_nationkey", "n_name", "name").select(
        "c_custkey", "name")


@query("lookup_rejects", "select c_custkey, c_nationkey from customer where c_nationkey in (select n_nationkey from nation where n_regionkey = 1)")
def lookup_rejects(t):
    rows = t.customer.select("c_custkey", "c_nationkey")
    return lookups.lookup(rows, t.nation.where("n_regionkey <> 1"), F.col("c_nationkey"), "n_nationkey", "n_name", "name",
                          "reject")


@query("tariff_taxonomy", """
    select doc_id, upper(lang) as sector, 'T-' || lang || '-' || (n_chars % 3) || '-' || source || '-2' as tariff from documents""")
def tariff_taxonomy(t):
    rows = t.documents.select("doc_id", F.col("lang").alias("sector"), (F.col("n_chars") % 3).cast("string").alias("band"), "source")
    keys = rows.select("sector", "band", "source").distinct()
    dictionary = keys.select(
        F.concat_ws("~", "sector", "band", "source").alias("SOURCE"), F.upper("sector").alias("EconomicSector"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"), F.concat_ws("-", F.lit("T"), "sector", "band", "source").alias("stem"),
    ).withColumn("Tariff", F.concat_ws("-", "stem", F.col("seq").cast("string")))
    # Every key twice and many keys per sector: without an order the highest value of a key holds, and no row is multiplied.
    return lookups.tariff_taxonomy(rows, dictionary, ["sector", "band", "source"]).select(
        "doc_id", "sector", "tariff")


@query("join_derived_key", """
    select o_orderkey, c_name as name from orders join customer on cast(o_custkey as varchar) = ltrim(split_part(c_name, '#', 2), '0')""")
def join_derived_key(t):
    return lookups.join_derived_key(
        t.orders.select("o_orderkey", "o_custkey"), t.customer, F.col("o_custkey").cast("string"),
        F.ltrim(F.split_part("c_name", F.lit("#"), F.lit(2)), F.lit("0")), [F.col("c_name").alias("name")],
    ).select("o_orderkey", "name")


@query("join_matches", """
    select c_custkey, o_orderkey::varchar as purchase from customer left join orders on c_custkey = o_custkey""")
def join_matches(t):
    return lookups.join_matches(t.customer, t.orders, "c_custkey", "o_custkey").select(
        "c_custkey", F.col("o_orderkey").cast("string").alias("purchase"))


@query("postal_station_fallback", """
    with s as (select s_suppkey * 3 as code, s_name from supplier)
    select c_custkey, coalesce(a.s_name, n.s_name, p.s_name) as station from customer
    left join s a on a.code = c_custkey
    left join s n on n.code = c_custkey + 1 and c_custkey % 10 <> 9
    left join s p on p.code = c_custkey - 1 and c_custkey % 10 <> 0""")
def postal_station_fallback(t):
    stations = t.supplier.select((F.col("s_suppkey") * 3).cast("string").alias("code"), "s_name")
    rows = t.customer.select("c_custkey", zero_pad(F.col("c_custkey"), 5).alias("postal"))
    return lookups.postal_station_fallback(rows, stations, "postal", "code", ["s_name"]).select(
        "c_custkey", F.col("s_name").alias("station"))


@query("link_admin_zone", """
    select c_custkey, level, relation, uri from (
      select c_custkey, 'province' as level, 'AddressProvince' as relation, 'geo#R-' || r_regionkey as uri
      from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
      union all
      select c_custkey, 'municipality', 'AddressCity', 'geo#N-' || n_nationkey
      from customer join nation on n_nationkey = c_nationkey)""")
def link_admin_zone(t):
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "c_custkey", F.lit("ES").alias("land"), F.lower("r_name").alias("province"), F.concat(F.lit(" "), "n_name").alias("city"))
    gazetteer = t.region.select(
        F.lit("ES").alias("country"), F.lit("A.ADM2").alias("feature_code"), F.col("r_name").alias("name"),
        F.concat(F.lit("geo#R-"), "r_regionkey").alias("uri")
    ).unionByName(t.nation.select(
        F.lit("ES").alias("country"), F.lit("A.ADM3").alias("feature_code"), F.col("n_name").alias("name"),
        F.concat(F.lit("geo#N-"), "n_nationkey").alias("uri")))
    levels = t.spark.createDataFrame(
        [("ES", "province", "A.ADM2", "AddressProvince"), ("ES", "municipality", "A.ADM3", "AddressCity")],
        "country string, level string, feature_code string, relation string")
    return lookups.link_admin_zone(places, gazetteer, levels, "land", {"province": "province", "municipality": "city"}).select(
        "c_custkey", "level", "relation", "uri")


@query("link_admin_zone_similar", """
    select c_custkey, 'municipality' as level, 'AddressCity' as relation, 'geo#' || case c_custkey % 2 when 0 then 'ES' else 'FR' end || '-' || c_nationkey as uri
    from customer where c_nationkey is not null""")
def link_admin_zone_similar(t):
    """French zones have the very names that Spanish rows ask for; Spanish zones only have similar ones."""
    land = F.when(F.col("c_custkey") % 2 == 0, "ES").otherwise("FR")
    asked = F.concat(F.lower("n_name"), F.lit("e"))
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", land.alias("land"), asked.alias("city"))
    zone = lambda land, name: t.nation.select(
        F.lit(land).alias("country"), F.lit("A.ADM3").alias("feature_code"), name.alias("name"), F.concat(F.lit(f"geo#{land}-"), "n_nationkey").alias("uri"))
    levels = t.spark.createDataFrame([("ES", "municipality", "A.ADM3", "AddressCity"), ("FR", "municipality", "A.ADM3", "AddressCity")],
                                     "country string, level string, feature_code string, relation string")
    return lookups.link_admin_zone(places, zone("ES", F.col("n_name")).unionByName(zone("FR", asked)), levels, "land", {"municipality": "city"}, threshold=80.0).select(
        "c_custkey", "level", "relation", "uri")


@query("dedup_keep_last", """
    select o_orderkey, o_custkey, o_orderstatus from orders
    qualify row_number() over (partition by o_custkey, nullif(o_orderstatus, 'P') order by o_orderdate desc, o_orderkey desc) = 1""")
def dedup_keep_last(t):
    rows = t.orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return dedup.dedup_keep_last(rows, ["o_custkey", "status"], ["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_orderstatus")


@query("dedup_keep_first", """
    select event_id, user_id, event_type from events
    qualify row_number() over (partition by user_id order by ts, event_id) = 1""")
def dedup_keep_first(t):
    return dedup.dedup_keep_first(t.events, ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "event_type")


@query("first_row_per_device", """
    select o_custkey, arg_min(o_orderkey, o_orderdate::varchar || lpad(o_orderkey::varchar, 12, '0')) as first_order
    from orders group by 1""")
def first_row_per_device(t):
    return dedup.first_row_per_device(t.orders, "o_custkey", "o_orderdate", ["o_orderkey"]).select(
        "o_custkey", F.col("o_orderkey").alias("first_order"))


@query("pick_by_source_priority", """
    select event_id, user_id, event_type,
           row_number() over (partition by user_id order by coalesce(list_position(['purchase', 'signup', 'error'], event_type), 4),
                              event_id) = 1 as selected
    from events""")
def pick_by_source_priority(t):
    return dedup.pick_by_source_priority(
        t.events.select("event_id", "user_id", "event_type"), ["user_id"], "event_type", ["purchase", "signup", "error"],
        ["event_id"])


@query("upsert_by_key", """
    select o_orderkey, case when o_orderstatus = 'F' then 'new' else o_orderstatus end as status from orders
    where o_orderpriority <> '5-LOW' or o_orderstatus = 'F'""")
def upsert_by_key(t):
    base = t.orders.where("o_orderpriority <> '5-LOW'").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.lit(0).alias("seq"))
    batch = t.orders.where("o_orderstatus = 'F'").select(
        "o_orderkey", F.explode(F.array(F.struct(F.lit("old").alias("status"), F.lit(1).alias("seq")),
                                        F.struct(F.lit("new").alias("status"), F.lit(2).alias("seq")))).alias("v")
    ).select("o_orderkey", "v.status", "v.seq")
    return dedup.upsert_by_key(base, batch, ["o_orderkey"], ["seq"]).drop("seq")


@query("number_within", """
    select event_id, event_type, row_number() over (partition by event_type order by event_id % 16, event_id) as no from events""")
def number_within(t):
    return dedup.number_within(t.events.select("event_id", "event_type"), ["event_type"], ["event_id"], "no",
                               F.col("event_id") % 16, 16)


@query("sum_by_series", """
    select flag, status, day, round(coalesce(sum(v), 0), 2) as value from (
      select nullif(l_returnflag, 'N') as flag, l_linestatus as status, l_shipdate as day,
             case when l_linestatus = 'F' and day(l_shipdate) = 3 then null else l_quantity end as v from lineitem)
    where flag is not null group by all""")
def sum_by_series(t):
    rows = t.lineitem.select(
        F.nullif("l_returnflag", F.lit("N")).alias("flag"), F.col("l_linestatus").alias("status"),
        F.col("l_shipdate").alias("day"),
        F.when(~((F.col("l_linestatus") == "F") & (F.dayofmonth("l_shipdate") == 3)), F.col("l_quantity")).alias("value"))
    return aggregate.sum_by_series(rows, ["flag", "status", "day"]).withColumn("value", F.round("value", 2))


_ZONES = """
    select l_partkey, {sums} from (select l_partkey, l_quantity as q, l_discount * 8 - 0.1 as bin from lineitem) group by 1"""
_SUMS = {
    "darker": "bin < 0", "dark": "bin > 0 and bin < 0.2", "medium": "bin > 0.2 and bin < 0.4",
    "light": "bin > 0.4 and bin < 0.6", "lighter": "bin > 0.6",
}
_ZONE_SQL = _ZONES.format(sums=", ".join(f"coalesce(sum(q) filter ({test}), 0) as {name}" for name, test in _SUMS.items()))


def _zones(t):
    rows = t.lineitem.select("l_partkey", F.col("l_quantity").alias("q"), (F.col("l_discount") * 8 - 0.1).alias("bin"))
    return reshape.histogram_zones(rows, ["l_partkey"], "bin", "q")


@query("histogram_zones", _ZONE_SQL)
def histogram_zones(t):
    return _zones(t)


@query("histogram_zones_wide", """
    select l_orderkey, l_linenumber, coalesce(l_quantity, 0.0) as darker, nullif(l_tax, 0.02) is null as gap,
           coalesce(nullif(l_tax, 0.02), 0.0) + l_discount as dark, 0.0::double as medium, 0.0::double as light,
           l_extendedprice as lighter from lineitem""")
def histogram_zones_wide(t):
    wide = t.lineitem.select(
        "l_orderkey", "l_linenumber", (F.nullif("l_tax", F.lit(0.02)).isNull()).alias("gap"),
        F.col("l_quantity").alias("HISTO_-0.02"), F.nullif("l_tax", F.lit(0.02)).alias("HISTO_0.1"),
        F.col("l_discount").alias("HISTO_0.19"), F.col("l_extendedprice").alias("HISTO_0.74"),
        F.col("l_extendedprice").alias("HISTO_0.2"), F.col("l_extendedprice").alias("HISTO_0.6"))
    return reshape.zones_from_columns(wide)


@query("row_percentages", f"""
    with z as ({_ZONE_SQL}), w as (select l_partkey, {', '.join(f'cast(trunc({n}) as bigint) as {n}' for n in _SUMS)} from z)
    select l_partkey, {', '.join(f'round({n} / nullif({"+".join(_SUMS)}, 0) * 100, 6) as {n}' for n in _SUMS)} from w""")
def row_percentages(t):
    shares = reshape.row_percentages(_zones(t))
    return shares.withColumns({name: F.round(name, 6) for name in _SUMS})


_RULES = [
    {"measured_property": "view", "source": "even", "freq": "PT1H", "agg_name": "totalViews", "required": True, "agg_func": ["SUM"]},
    {"measured_property": "error", "source": "odd", "freq": "P1M", "agg_name": "errors", "required": False, "agg_func": ["AVG", "SUM"]},
    {"measured_property": "click", "source": "even", "freq": "", "agg_name": "clicks", "required": False, "agg_func": ["AVG"]},
]


@query("device_aggregate", """
    with e as (select *, case when event_id % 2 = 0 then 'even' else 'odd' end as src from events)
    select 'totalViews' as agg_name, 'PT1H' as freq, true as required, 'SUM' as agg_func, user_id, date_trunc('hour', ts) as period,
           round(sum(value), 2) as value from e where event_type = 'view' and src = 'even' group by user_id, period
    union all
    select 'errors', 'P1M', false, f, user_id, date_trunc('month', ts) as period,
           round(case f when 'SUM' then sum(value) else avg(value) end, 6)
    from e, (values ('AVG'), ('SUM')) v(f) where event_type = 'error' and src = 'odd' group by f, user_id, period
    union all
    select 'clicks', '', false, 'AVG', user_id, ts, round(avg(value), 2) from e where event_type = 'click' and src = 'even'
    group by user_id, ts""")
def device_aggregate(t):
    rows = t.events.withColumn("src", F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd"))
    return aggregate.device_aggregate(rows, _RULES, ["user_id"], "event_type", "src", "ts", "value").withColumn(
        "value", F.round("value", 6))


_ALL_SOURCES = [{"measured_property": kind, "freq": "P1M", "agg_name": f"{kind}Days", "agg_func": ["AVG", "CDD", "HDD"]} for kind in ("view", "error")]


@query("device_aggregate_degree_days", """
    with days as (select user_id, event_type, cast(ts as date) as day, sum(value) as total, count(value) as n, avg(value) as mean
                  from events where event_type in ('view', 'error') group by all),
    months as (select user_id, event_type, date_trunc('month', day)::timestamp as period, sum(total) / sum(n) as avg_value,
                      sum(greatest(mean - 21, 0)) as cdd, sum(greatest(18 - mean, 0)) as hdd from days group by all)
    select event_type || 'Days' as agg_name, 'P1M' as freq, false as required, f as agg_func, user_id, period,
           round(case f when 'AVG' then avg_value when 'CDD' then cdd else hdd end, 6) as value
    from months, (values ('AVG'), ('CDD'), ('HDD')) v(f)""")
def device_aggregate_degree_days(t):
    return aggregate.device_aggregate(t.events, _ALL_SOURCES, ["user_id"], "event_type", None, "ts", "value").withColumn(
        "value", F.round("value", 6))


@query("degree_days", """
    select user_id as station, day::varchar as day, round(m, 6) as mean, round(greatest(18 - m, 0), 6) as hdd, round(greatest(m - 21, 0), 6) as cdd
    from (select user_id, cast(ts as date) as day, avg(value) as m from events group by 1, 2)""")
def degree_days(t):
    rows = t.events.withColumnRenamed("user_id", "station")
    days = aggregate.degree_days(rows, "station", "ts", "value")
    return days.withColumns({"day": F.col("day").cast("string"), **{c: F.round(c, 6) for c in ("mean", "hdd", "cdd")}})
