"""Sources and sinks: what is written is read back."""

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from entries.registry import query
from urbanweave.functions.clock import buckets_between
from urbanweave.functions.text import device_hash
from urbanweave.operators.dedup import first_row_per_device
from urbanweave.operators.graph import distinct_triples
from urbanweave.session import scratch_path
from urbanweave.sources import cells, files, messages, ntriples, store

_ORDERS = ["o_custkey", "o_orderstatus", "o_totalprice"]


@query("scan_delimited", """
    select o_orderkey as row_in_file, o_custkey::varchar as o_custkey, o_orderstatus,
           case when o_orderstatus <> 'F' then o_totalprice::varchar end as o_totalprice from orders""")
def scan_delimited(t):
    path = scratch_path(t.spark, "tsv")
    text = t.orders.select(F.col("o_orderkey").alias("_c0"), *[F.col(c).cast("string") for c in _ORDERS])
    # Two layouts in one folder: reordered columns, and one column missing.
    files.write_extract(text.where("o_orderstatus <> 'F'").select("_c0", "o_totalprice", "o_custkey", "o_orderstatus"), f"{path}/full", sep="\t")
    files.write_extract(text.where("o_orderstatus = 'F'").drop("o_totalprice"), f"{path}/short", sep="\t")
    return files.scan_delimited(t.spark, path, _ORDERS, mixed_layouts=True).drop("file_path")


@query("scan_delimited_unknown_columns", """
    select o_orderkey as row_in_file, o_custkey::varchar as o_custkey, case when o_orderstatus <> 'P' then o_orderstatus end as o_orderstatus,
           case when o_orderstatus = 'O' then o_totalprice::varchar end as o_totalprice from orders""")
def scan_delimited_unknown_columns(t):
    """Three layouts, one of them mostly of unknown columns."""
    path = scratch_path(t.spark, "tsv")
    text = t.orders.select(F.col("o_orderkey").alias("_c0"), *[F.col(c).cast("string") for c in _ORDERS])
    files.write_extract(text.where("o_orderstatus = 'O'"), f"{path}/a", sep="\t")
    files.write_extract(text.where("o_orderstatus = 'F'").select("_c0", "o_orderstatus", "o_custkey"), f"{path}/b", sep="\t")
    odd = [F.lit(str(k)).alias(f"unknown{k}") for k in range(6)]
    files.write_extract(text.where("o_orderstatus = 'P'").select("_c0", *odd, "o_custkey"), f"{path}/c", sep="\t")
    return files.scan_delimited(t.spark, path, _ORDERS, mixed_layouts=True).drop("file_path")


@query("scan_geojson", """
    select s_suppkey as id, s_name as name, 'Point' as kind, s_acctbal as x, s_nationkey::double as y from supplier""")
def scan_geojson(t):
    path = scratch_path(t.spark, "geojson")
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array("s_acctbal", F.col("s_nationkey").cast("double")).alias("coordinates")).alias("geometry"))
    # One FeatureCollection per nation.
    t.supplier.groupBy("s_nationkey").agg(F.collect_list(feature).alias("features")).select(
        F.lit("FeatureCollection").alias("type"), "features").write.option("maxRecordsPerFile", 1).json(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    read = files.with_shapes(files.scan_geojson(t.spark, path, schema))
    return read.select("properties.*", F.col("geometry.type").alias("kind"), F.get("point", 0).alias("x"), F.get("point", 1).alias("y"))


@query("scan_parquet", "select event_id, ts, user_id, event_type, value from events")
def scan_parquet(t):
    return files.scan_parquet(t.spark, f"{t.folder}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")


@query("scan_sheets", "select o_orderstatus as sheet, count(*) as n, max(o_orderkey) as last from orders group by 1")
def scan_sheets(t):
    path = scratch_path(t.spark, "book")
    t.orders.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("sheet")).write.partitionBy("sheet").option(
        "header", True).csv(path)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("o_orderkey", "o_custkey")])
    return files.scan_sheets(t.spark, path, schema).groupBy("sheet").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last"))


@query("decode_raw_cells", """
    select o_custkey::varchar as cups, o_orderkey::varchar as ts, o_orderstatus, o_orderpriority, o_totalprice::varchar as o_totalprice
    from orders""")
def decode_raw_cells(t):
    raw = cells.encode_cells(t.orders, ["o_custkey", "o_orderkey"],
                             {"info": ["o_orderstatus", "o_orderpriority"], "v": ["o_totalprice"]})
    return cells.decode_raw_cells(raw, ["o_orderstatus", "o_orderpriority", "o_totalprice"], "cups", "ts")


@query("write_dual_layout", """
    with s as (select sha256(user_id || '-Electricity') as device, cast(floor(epoch(ts)) as bigint) as start,
                      cast(floor(epoch(ts + interval 1 hour)) as bigint) as "end", value from events)
    select l.layout, (start // 10000000) % 20 as bucket, device, start, "end", value
    from s, (values ('online'), ('batch')) l(layout)""")
def write_dual_layout(t):
    rows = store.series_rows(t.events, device_hash(F.col("user_id"), "-Electricity"), F.col("ts"), "PT1H", F.col("value"))
    root = scratch_path(t.spark, "store")
    paths = store.write_dual_layout(rows, root, "EnergyConsumptionGridElectricity", "PT1H", "city")
    read = [store.read_series(t.spark, path).select(F.lit(layout).alias("layout"), F.col("bucket").cast("long").alias("bucket"),
                                                    "device", "start", "end", "value") for layout, path in paths.items()]
    return read[0].unionByName(read[1])


@query("write_dual_layout_append", """
    with s as (select event_id, sha256(user_id || '-Electricity') as device, cast(floor(epoch(ts)) as bigint) as start, value from events)
    select l.layout, count(*) as n, count(distinct device) as devices, min(start) as first, max(start) as last, round(sum(value), 2) as value
    from s, (values ('online'), ('batch')) l(layout) group by 1, event_id % 3""")
def write_dual_layout_append(t):
    """Three loads into one store: each layout has every row once. A user can have several events within a second, so their ids belong to the key."""
    root = scratch_path(t.spark, "store")
    for lot in range(3):
        part = t.events.where(F.col("event_id") % 3 == lot)
        rows = store.series_rows(part, device_hash(F.col("user_id"), "-Electricity"), F.col("ts"), "PT1H", F.col("value"),
                                 extra=[F.lit(lot).alias("lot"), F.col("event_id")])
        paths = store.write_dual_layout(rows, root, "EnergyConsumptionGridElectricity", "PT1H", "city", mode="append", key=(*store.KEY, "event_id"))
    read = [store.read_series(t.spark, path).withColumn("layout", F.lit(layout)) for layout, path in paths.items()]
    return read[0].unionByName(read[1]).groupBy("layout", "lot").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("device").alias("devices"), F.min("start").alias("first"), F.max("start").alias("last"),
        F.round(F.sum("value"), 2).alias("value")).drop("lot")


@query("write_dual_layout_merge", """
    with loads as (
        select sha256(user_id || '-Electricity') as device, cast(epoch(date_trunc('hour', ts)) as bigint) as start, event_id, value, 1 as lot from events
        where ts < timestamp '2024-01-20'
        union all
        select sha256(user_id || '-Electricity'), cast(epoch(date_trunc('hour', ts)) as bigint), event_id, 2 * value, 2 from events
        where ts >= timestamp '2024-01-10'),
    last as (select * from loads qualify row_number() over (partition by device, start order by lot desc, event_id desc) = 1)
    select l.layout, device, start, event_id, value from last, (values ('online'), ('batch')) l(layout)""")
def write_dual_layout_merge(t):
    """A backfill that overlaps ten days with corrected values overwrites their keys, in both layouts."""
    root = scratch_path(t.spark, "store")
    for part, factor in ((F.col("ts") < F.lit("2024-01-20"), 1), (F.col("ts") >= F.lit("2024-01-10"), 2)):
        rows = store.series_rows(t.events.where(part), device_hash(F.col("user_id"), "-Electricity"), F.date_trunc("hour", "ts"), "PT1H",
                                 F.col("value") * factor, extra=[F.col("event_id")])
        paths = store.write_dual_layout(rows, root, "EnergyConsumptionGridElectricity", "PT1H", "city", mode="merge", order=["event_id"])
    read = [store.read_series(t.spark, path).select(F.lit(layout).alias("layout"), "device", "start", "event_id", "value") for layout, path in paths.items()]
    return read[0].unionByName(read[1])


@query("read_bucket_range", """
    select sha256(o_custkey || '-Gas') as device, cast(epoch(o_orderdate) as bigint) as start, o_totalprice as value from orders
    where o_orderdate >= timestamp '1997-03-01' and o_orderdate < timestamp '1997-06-01'""")
def read_bucket_range(t):
    first, last = datetime(1997, 3, 1), datetime(1997, 6, 1)
    rows = store.series_rows(t.orders, device_hash(F.col("o_custkey"), "-Gas"), F.col("o_orderdate"), "P1M", F.col("o_totalprice"))
    paths = store.write_dual_layout(rows, scratch_path(t.spark, "store"), "EnergyConsumptionGas", "P1M", "city")
    read = store.read_series(t.spark, paths["batch"], buckets_between(first, last))
    return read.where((F.col("start") >= 857174400) & (F.col("start") < 865123200)).select("device", "start", "value")


@query("build_envelopes", """
    with n as (select *, row_number() over (partition by user_id order by event_id % 8, event_id) as no from events)
    select user_id, (no - 1) // 10 as chunk, count(*)::integer as records, string_agg(event_id, ',' order by no) as ids,
           'invoices' as collection_type
    from n group by 1, 2""")
def build_envelopes(t):
    sent = messages.build_envelopes(
        t.events, ["user_id"], ["event_id"], F.lit("invoices"), "https://city.example#", F.col("user_id"), "Europe/Madrid",
        F.lit("meters"), ["user_id", "event_id"], ["event_id", "event_type", "value"], F.col("event_id") % 8, 8)
    body = F.from_json("message", messages.ENVELOPE)
    return sent.withColumn("m", body).select(
        "user_id", "chunk", "records", F.array_join(F.transform("m.data", lambda d: d["event_id"]), ",").alias("ids"),
        "m.collection_type")


@query("distinct_devices", "select distinct user_id, user_id as devices from events")
def distinct_devices(t):
    return cells.distinct_devices(t.events, "user_id")


@query("first_cells_per_device", """
    select o_custkey::varchar as cups, min(o_orderkey)::varchar as ts from orders group by 1""")
def first_cells_per_device(t):
    raw = cells.encode_cells(t.orders.withColumn("at", F.lpad(F.col("o_orderkey").cast("string"), 10, "0")), ["o_custkey", "at"],
                             {"info": ["o_orderstatus"]})
    records = cells.decode_raw_cells(raw, ["o_orderstatus"], "cups", "at")
    return first_row_per_device(records, "cups", "at").select("cups", F.col("at").cast("long").cast("string").alias("ts"))


@query("plan_missing_partitions", """
    select c.c_custkey, strftime(m, '%Y-%m') as month, cast(m as date)::varchar as first_day, last_day(m)::varchar as last_day
    from customer c, generate_series(timestamp '1996-01-01', timestamp '1996-12-01', interval 1 month) g(m)
    where not exists (select 1 from orders where o_custkey = c.c_custkey and date_trunc('month', o_orderdate) = m)""")
def plan_missing_partitions(t):
    present = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    plan = messages.plan_missing_partitions(t.customer, present, "c_custkey", date(1996, 1, 1), date(1997, 1, 1))
    return plan.withColumns({c: F.col(c).cast("string") for c in ("first_day", "last_day")})


@query("write_extracts", "select 'csv' as style, c_custkey, c_name from customer union all select 'json', c_custkey, c_name from customer")
def write_extracts(t):
    path, rows = scratch_path(t.spark, "extract"), t.customer.select("c_custkey", "c_name")
    schema = "c_custkey bigint, c_name string"
    files.write_extract(rows, f"{path}/csv")
    files.write_extract(rows, f"{path}/json", "json")
    return t.spark.read.schema(schema).option("header", True).csv(f"{path}/csv").withColumn("style", F.lit("csv")).unionByName(
        t.spark.read.schema(schema).json(f"{path}/json").withColumn("style", F.lit("json")))


def _triples(t):
    subject = F.concat(F.lit("https://city.example#Device-"), "p_partkey")
    return t.part.select(
        subject.alias("s"), F.lit("https://saref.etsi.org/core/name").alias("p"),
        F.concat(F.lit('it\'s "'), "p_name", F.lit('"\\')).alias("o"), F.lit("literal").alias("o_kind")
    ).unionByName(t.part.select(
        subject.alias("s"), F.lit("https://saref.etsi.org/core/brand").alias("p"),
        F.concat(F.lit("https://city.example#"), "p_brand").alias("o"), F.lit("iri").alias("o_kind")))


@query("write_ntriples", """
    select '<https://city.example#Device-' || p_partkey || '> <https://saref.etsi.org/core/name> "it&apos;s &apos;' || p_name ||
           '&apos;\\\\" .' as value from part
    union all select '<https://city.example#Device-' || p_partkey || '> <https://saref.etsi.org/core/brand> <https://city.example#' ||
           p_brand || '> .' from part""")
def write_ntriples(t):
    path = ntriples.write_ntriples(_triples(t), scratch_path(t.spark, "nt"), entity_quotes=True)
    return t.spark.read.text(path)


@query("read_ntriples", """
    select 'https://city.example#Device-' || p_partkey as s, 'https://saref.etsi.org/core/name' as p,
           'it''s "' || p_name || '"\\' as o, 'literal' as o_kind from part
    union all select 'https://city.example#Device-' || p_partkey, 'https://saref.etsi.org/core/brand', 'https://city.example#' || p_brand,
           'iri' from part""")
def read_ntriples(t):
    return ntriples.read_ntriples(t.spark, ntriples.write_ntriples(_triples(t), scratch_path(t.spark, "nt")))


def _terms(t, table: str, key: str, name: str):
    """Triples of every kind of term, about blank nodes whose labels are the same in each table."""
    node = F.concat(F.lit("_:n"), F.col(key) % 7)
    base = "https://city.example#"
    literal = {"p": F.lit(base + "name"), "o": F.concat(F.lit('"a\\b\t'), name, F.lit("\n")), "o_kind": F.lit("literal")}
    kinds = [
        literal | {"language": F.lit("en")}, literal | {"language": F.lit("ca-ES")}, literal,
        {"p": F.lit(base + "number"), "o": F.col(key).cast("string"), "o_kind": F.lit("literal"), "datatype": F.lit("http://www.w3.org/2001/XMLSchema#integer")},
        {"p": F.lit(base + "place é"), "o": F.concat(F.lit(base + "caf\u00e9 {"), name, F.lit("}")), "o_kind": F.lit("iri")},
        {"p": F.lit(base + "near"), "o": F.concat(F.lit("_:n"), (F.col(key) + 1) % 7), "o_kind": F.lit("blank")},
    ]
    rows = [F.struct(node.alias("s"), *[(k.get(c, F.lit(None).cast("string"))).alias(c) for c in ("p", "o", "o_kind", "language", "datatype")]) for k in kinds]
    return getattr(t, table).select(F.inline(F.array(*rows)))


@query("ntriples_terms", """
    with r as (select 'supplier' as file, s_suppkey as k, s_name as n from supplier union all select 'nation', n_nationkey, n_name from nation),
    t as (
        select file, k % 7 as node, k, n, unnest(['name', 'name', 'name', 'number', 'place é', 'near']) as p, unnest(['en', 'ca-ES', null, null, null, null]) as language,
               unnest(['literal', 'literal', 'literal', 'literal', 'iri', 'blank']) as o_kind from r)
    select distinct file || '-' || node as s, 'https://city.example#' || p as p,
           case p when 'name' then '"a\\b' || chr(9) || n || chr(10) when 'number' then k::varchar when 'place é' then 'https://city.example#café {' || n || '}'
                  else file || '-' || (k + 1) % 7 end as o, o_kind, language,
           case when p = 'number' then 'http://www.w3.org/2001/XMLSchema#integer' end as datatype from t""")
def ntriples_terms(t):
    """Two files with the same blank labels, all kinds of terms: what is read are the terms written, and blank nodes of different files differ.

    A label is named here by the file and number its node stands for.
    """
    root = scratch_path(t.spark, "terms")
    for table, key, name in (("supplier", "s_suppkey", "s_name"), ("nation", "n_nationkey", "n_name")):
        ntriples.write_ntriples(distinct_triples(_terms(t, table, key, name)), f"{root}/{table}")
    read = distinct_triples(ntriples.read_ntriples(t.spark, f"{root}/*", details=True))
    of = read.where(F.col("p").endswith("#name")).groupBy("s").agg(F.max(F.contains("o", F.lit("NATION"))).alias("is_nation"))
    plain = lambda c: F.concat(F.when(F.col("is_nation"), "nation-").otherwise("supplier-"), F.substring_index(c, "-n", -1))
    return read.join(of, "s").select(plain("s").alias("s"), "p", F.when(F.col("o_kind") == "blank", plain("o")).otherwise(F.col("o")).alias("o"), "o_kind", "language", "datatype")
