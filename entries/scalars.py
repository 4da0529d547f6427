"""Projection, filters, text and time."""

from pyspark.sql import functions as F

from entries.registry import query
from urbanweave.functions import clock, text
from urbanweave.operators import reshape


@query("cast_columns", """
    select l_orderkey, l_linenumber, cast(cast(l_quantity as varchar) as double) as q,
           try_cast(case when l_linenumber = 3 then 'n/a' else cast(l_tax as varchar) end as double) as t
    from lineitem""")
def cast_columns(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("string").alias("q"),
        F.when(F.col("l_linenumber") == 3, "n/a").otherwise(F.col("l_tax").cast("string")).alias("t"))
    return reshape.cast_columns(reshape.cast_columns(rows, ["q"]), ["t"], strict=False)


@query("drop_by_prefix", "select l_orderkey, l_extendedprice, l_discount from lineitem")
def drop_by_prefix(t):
    kept = reshape.keep_prefixed(t.lineitem, ["l_ext", "l_dis", "l_sh"], ["l_orderkey"])
    return reshape.drop_prefixed(kept, ["l_ship"])


@query("rename_periods", """
    select l_orderkey, l_quantity as "2023-01-01", l_extendedprice as "2023-02-01", l_tax as "2023-12-01" from lineitem""")
def rename_periods(t):
    wide = t.lineitem.select("l_orderkey", F.col("l_quantity").alias("CONSUMO_M1"),
                             F.col("l_extendedprice").alias("CONSUMO_M2"), F.col("l_tax").alias("CONSUMO_M12"))
    return reshape.rename_months(wide, 2023)


@query("zero_pad", """
    select c_custkey, lpad(cast(c_nationkey as varchar), 2, '0') as nation,
           case when length(cast(c_custkey as varchar)) < 3 then lpad(cast(c_custkey as varchar), 3, '0')
                else cast(c_custkey as varchar) end as code
    from customer""")
def zero_pad(t):
    return t.customer.select("c_custkey", text.zero_pad(F.col("c_nationkey"), 2).alias("nation"),
                             text.zero_pad(F.col("c_custkey"), 3).alias("code"))


@query("extract_cadastral_id", """
    select c_custkey, split_part(c_name, '#', 2) as building, split_part(c_name, '#', 2) as address,
           split_part(c_name, '#', 2) as other
    from customer""")
def extract_cadastral_id(t):
    number = F.split_part("c_name", F.lit("#"), F.lit(2))
    return t.customer.select(
        "c_custkey",
        text.building_ref(F.concat(F.lit("ES.SDGC.BU."), number, F.lit("_part1"))).alias("building"),
        text.last_token(F.concat(F.lit("ES.SDGC.AD.08.900.1."), number)).alias("address"),
        text.last_token(F.concat(F.lit("ES.SDGC.BU."), number)).alias("other"))


@query("thoroughfare_key", """
    select s_suppkey, '08.' || s_nationkey || '.' || s_suppkey as address, '08.' || s_nationkey as street from supplier""")
def thoroughfare_key(t):
    key = F.concat_ws(".", F.lit("08"), "s_nationkey", "s_suppkey")
    return t.supplier.select(
        "s_suppkey",
        text.street_key_of_address(F.concat(F.lit("ES.SDGC.AD."), key, F.lit(".17.X"))).alias("address"),
        text.street_key_of_street(F.concat(F.lit("ES.SDGC.TN."), F.concat_ws(".", F.lit("08"), "s_nationkey"))).alias("street"))


@query("hash_device_id", """
    select c_custkey, sha256(c_name || '-Gas') as gas, sha256(c_custkey || '-Electricity') as electricity from customer""")
def hash_device_id(t):
    return t.customer.select("c_custkey", text.device_hash(F.col("c_name"), "-Gas").alias("gas"),
                             text.device_hash(F.col("c_custkey"), "-Electricity").alias("electricity"))


@query("compose_key", """
    select o_orderkey, nullif(o_orderstatus, 'P') || '-' || o_custkey || '-' || o_orderpriority as k from orders""")
def compose_key(t):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return t.orders.select("o_orderkey", text.compose_key(status, "o_custkey", "o_orderpriority").alias("k"))


@query("normalise_text", "select p_partkey, lower(p_brand || ' ' || p_name || ' ' || p_size) as address from part")
def normalise_text(t):
    return t.part.select("p_partkey", text.normalise_text("p_brand", "p_name", "p_size").alias("address"))


@query("split_latlon", "select s_suppkey, s_acctbal as lat, cast(s_nationkey as double) as lon from supplier")
def split_latlon(t):
    lat, lon = text.split_pair(F.concat_ws("_", F.col("s_acctbal").cast("string"), F.col("s_nationkey").cast("string")))
    return t.supplier.select("s_suppkey", lat.alias("lat"), lon.alias("lon"))


@query("split_to_list", """
    select p_partkey, unnest(string_split(p_type || '/' || p_name, '/')) as sector from part""")
def split_to_list(t):
    return t.part.select("p_partkey", F.explode(text.path_list(F.concat_ws("/", "p_type", "p_name"))).alias("sector"))


@query("coords_to_text", """
    select l_orderkey, l_linenumber, l_partkey || ' ' || l_suppkey as point,
           '[[' || l_partkey || ',' || l_suppkey || '],[' || l_suppkey || ',' || l_partkey || ']]' as ring,
           '{"type":"Point","coordinates":[' || l_partkey || ',' || l_suppkey || ']}' as geojson
    from lineitem""")
def coords_to_text(t):
    point = F.array("l_partkey", "l_suppkey")
    ring = F.array(F.array(point, F.array("l_suppkey", "l_partkey")))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", text.coords_to_text(point).alias("point"),
        text.coords_to_text(ring, kind="Polygon").alias("ring"), text.coords_to_text(point, "geojson").alias("geojson"))


@query("camel_to_snake", """
    select p_partkey, lower(regexp_replace(regexp_replace(n, '(.)([A-Z][a-z]+)', '\\1_\\2', 'g'),
                                           '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) as snake
    from (select p_partkey, 'homes' || upper(p_name[1]) || substr(p_name, 2) || p_type || 'CP' as n from part)""")
def camel_to_snake(t):
    name = F.concat(F.lit("homes"), F.upper(F.substring("p_name", 1, 1)), F.substring("p_name", 2, 1000),
                    F.col("p_type"), F.lit("CP"))
    return t.part.select("p_partkey", text.camel_to_snake(name).alias("snake"))


@query("numeric_suffix", """
    select l_orderkey, l_linenumber, cast(l_linenumber - 1 as integer) as hour, l_discount - 0.05 as bin from lineitem""")
def numeric_suffix(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", text.period_index(F.concat(F.lit("mi"), F.col("l_linenumber"))).alias("hour"),
        text.bin_value(F.concat(F.lit("HISTO_"), (F.col("l_discount") - F.lit(0.05)).cast("string"))).alias("bin"))


@query("not_equal_keep_null", """
    select l_orderkey, nullif(l_linenumber, 3)::varchar as number from lineitem where nullif(l_linenumber, 3) is distinct from 5""")
def not_equal_keep_null(t):
    rows = t.lineitem.select("l_orderkey", F.nullif("l_linenumber", F.lit(3)).alias("number"))
    return reshape.not_equal_keep_null(rows, "number", 5).withColumn("number", F.col("number").cast("string"))


@query("columns_agree", "select l_orderkey, l_linenumber, l_quantity from lineitem where l_linenumber = l_quantity")
def columns_agree(t):
    return reshape.columns_agree(t.lineitem, "l_linenumber", "l_quantity").select("l_orderkey", "l_linenumber", "l_quantity")


@query("drop_null_rows", """
    select l_orderkey, l_quantity, nullif(l_tax, 0.02) as tax from lineitem
    where nullif(l_linenumber, 3) is not null and nullif(l_returnflag, 'A') is not null""")
def drop_null_rows(t):
    rows = t.lineitem.withColumns({"n": F.nullif("l_linenumber", F.lit(3)), "f": F.nullif("l_returnflag", F.lit("A")),
                                   "tax": F.nullif("l_tax", F.lit(0.02))})
    return reshape.drop_null_rows(rows, ["n", "f"]).select("l_orderkey", "l_quantity", "tax")


@query("scale_values", """
    select l_orderkey, l_linenumber, l_extendedprice * l_quantity as total, l_tax * 100 as percent from lineitem""")
def scale_values(t):
    rows = t.lineitem.withColumnRenamed("l_quantity", "V306.Scons.total")
    return rows.select("l_orderkey", "l_linenumber",
                       (F.col("l_extendedprice") * reshape.quoted("V306.Scons.total")).alias("total"),
                       (F.col("l_tax") * 100).alias("percent"))


@query("constant_columns", """
    select c_custkey, true as "isReal", 'homesForTouristUse' as huts_type, '2017-01-01' as day from customer""")
def constant_columns(t):
    return reshape.constant_columns(t.customer.select("c_custkey"), isReal=True, huts_type="homesForTouristUse", day="2017-01-01")


@query("filter_located", """
    select * from (select c_custkey, case when c_nationkey < 5 then 'NULL' else cast(c_nationkey as varchar) end as lat,
                          case when c_mktsegment = 'MACHINERY' then 'NULL' else c_mktsegment end as lon from customer)
    where lat <> 'NULL' or lon <> 'NULL'""")
def filter_located(t):
    rows = t.customer.select(
        "c_custkey", F.when(F.col("c_nationkey") < 5, "NULL").otherwise(F.col("c_nationkey").cast("string")).alias("lat"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "NULL").otherwise(F.col("c_mktsegment")).alias("lon"))
    return reshape.filter_located(rows, "lat", "lon")


@query("format_time", "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as time from events")
def format_time(t):
    return t.events.select("event_id", clock.format_time(F.col("ts")).alias("time"))


@query("flatten_struct", """
    select c_custkey as "properties.id", c_name as "properties.who.name", c_acctbal as "properties.who.balance",
           c_nationkey as nation from customer""")
def flatten_struct(t):
    nested = t.customer.select(
        F.struct(F.col("c_custkey").alias("id"),
                 F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).alias("who")).alias("properties"),
        F.col("c_nationkey").alias("nation"))
    return reshape.flatten_struct(nested)


@query("nest_dotted", """
    select c_custkey as id, c_name as name, c_acctbal as balance, c_nationkey as nation from customer""")
def nest_dotted(t):
    flat = t.customer.select(F.col("c_custkey").alias("p.id"), F.col("c_name").alias("p.who.name"),
                             F.col("c_acctbal").alias("p.who.balance"), F.col("c_nationkey").alias("nation"))
    return reshape.nest_dotted(flat).select("p.id", "p.who.name", "p.who.balance", "nation")


@query("assemble_timestamp", """
    select o_orderkey, try_cast(year(o_orderdate) || '-' || month(o_orderdate) || '-' || (o_orderkey % 31 + 1) || ' ' ||
                                (o_orderkey % 24) || ':00:00' as timestamp) as at
    from orders""")
def assemble_timestamp(t):
    day = (F.col("o_orderkey") % 31 + 1).cast("string")
    return t.orders.select("o_orderkey", clock.assemble_timestamp(
        F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string"), day,
        (F.col("o_orderkey") % 24).cast("string")).alias("at"))


_LOCAL = "select o_orderkey, o_orderdate + interval 8036 day + interval 1 hour * (o_orderkey % 24) as local from orders"
_KEPT = f"""select * from ({_LOCAL}) where not (month(local) in (3, 10) and hour(local) = 2 and dayofweek(local) = 0
                                                and day(local) > 24)"""


def _local(t):
    """Orders moved to 2017-2023, with an hour of the day."""
    hour = F.make_dt_interval(hours=F.col("o_orderkey") % 24)
    return t.orders.select("o_orderkey", (F.col("o_orderdate") + F.expr("interval 8036 days") + hour).alias("local"))


@query("drop_dst_hours", f"select o_orderkey, local from ({_KEPT})")
def drop_dst_hours(t):
    return _local(t).where(~clock.is_clock_change(F.col("local")))


@query("localise", f"""
    select o_orderkey, cast(epoch(timezone('Europe/Madrid', local)) as bigint) as instant from ({_KEPT})""")
def localise(t):
    kept = _local(t).where(~clock.is_clock_change(F.col("local")))
    return kept.select("o_orderkey", clock.epoch_seconds(clock.localise(F.col("local"))).alias("instant"))


@query("epoch_seconds", """
    select event_id, cast(floor(epoch(ts)) as bigint) as start,
           cast(floor(epoch(ts - interval 60 year)) as bigint) as before from events""")
def epoch_seconds(t):
    return t.events.select("event_id", clock.epoch_seconds(F.col("ts")).alias("start"),
                           clock.epoch_seconds(F.col("ts") - F.expr("interval 60 years")).alias("before"))


@query("time_bucket", """
    select o_orderkey, cast(((s // 10000000) % 20 + 20) % 20 as bigint) as bucket,
           cast((cast(floor((s - 900000000) / 10000000.0) as bigint) % 4 + 4) % 4 as bigint) as weather
    from (select o_orderkey, cast(epoch(o_orderdate) as bigint) as s from orders)""")
def time_bucket(t):
    start = clock.epoch_seconds(F.col("o_orderdate"))
    return t.orders.select("o_orderkey", clock.time_bucket(start).alias("bucket"),
                           clock.time_bucket(start - 900_000_000, count=4).alias("weather"))


@query("period_end", """
    select event_id, ts + interval 1 hour as hour_end, ts + interval 365 day as year_end,
           ts + interval 1 day * date_diff('day', cast(ts as date), last_day(ts)) as month_end from events""")
def period_end(t):
    ts = F.col("ts")
    return t.events.select("event_id", clock.period_end(ts, "PT1H").alias("hour_end"),
                           clock.period_end(ts, "P1Y").alias("year_end"), clock.period_end(ts, "P1M").alias("month_end"))


_WIDE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("unpivot_periods", """
    unpivot (select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax from lineitem)
    on l_quantity, l_extendedprice, l_discount, l_tax into name period value value""")
def unpivot_periods(t):
    return reshape.unpivot_periods(t.lineitem, ["l_orderkey", "l_linenumber"], _WIDE)


@query("unpivot_rest", """
    select l_orderkey, d as date, cast(v as double) as value from (
      select l_orderkey, unnest(['2023-01-01', '2023-02-01', 'l_linenumber']) as d,
             unnest([l_quantity, l_tax, l_linenumber]) as v from lineitem)
    where try_strptime(d, '%Y-%m-%d') is not null""")
def unpivot_rest(t):
    wide = reshape.rename_months(t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("CONSUMO_M1"), F.col("l_tax").alias("CONSUMO_M2")), 2023)
    return reshape.unpivot_rest(wide, ["l_orderkey"]).where(F.try_to_timestamp("date", F.lit("yyyy-MM-dd")).isNotNull())


@query("pack_vector", """
    select l_orderkey, l_linenumber, l_quantity as first, l_tax as last, 4 as n from lineitem""")
def pack_vector(t):
    packed = reshape.pack_vector(t.lineitem, _WIDE, "vector")
    return packed.select("l_orderkey", "l_linenumber", F.get("vector", 0).alias("first"),
                         F.element_at("vector", -1).alias("last"), F.size("vector").alias("n"))


@query("union_by_name", """
    select c_custkey as id, c_name as name, c_mktsegment as segment from customer
    union all select s_suppkey, s_name, null from supplier""")
def union_by_name(t):
    return reshape.union_by_name([
        t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
        t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))])
