"""Graph queries and mappings to triples."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entries.registry import query
from urbanweave.operators import graph, mapping
from urbanweave.plans.mappings import document, shape
from urbanweave.session import scratch_path
from urbanweave.sources import graph_store

_EDGES_SQL = """
    edges as (
      select 'r#' || r_regionkey as src, 'hasNation' as rel, 'n#' || n_nationkey as dst from region join nation on n_regionkey = r_regionkey
      union all select 'n#' || n_nationkey, 'hasCustomer', 'c#' || c_custkey from nation join customer on c_nationkey = n_nationkey
      union all select 'c#' || o_custkey, 'placed', 'o#' || o_orderkey from orders)"""


def _edges(t) -> DataFrame:
    def link(df, a, rel, b):
        return df.select(F.concat(*a).alias("src"), F.lit(rel).alias("rel"), F.concat(*b).alias("dst"))

    return (
        link(t.nation, (F.lit("r#"), "n_regionkey"), "hasNation", (F.lit("n#"), "n_nationkey"))
        .union(link(t.customer, (F.lit("n#"), "c_nationkey"), "hasCustomer", (F.lit("c#"), "c_custkey")))
        .union(link(t.orders, (F.lit("c#"), "o_custkey"), "placed", (F.lit("o#"), "o_orderkey")))
    )


@query("graph_path_join", f"""
    with {_EDGES_SQL}
    select a.dst as nation, c.dst as purchase from edges a join edges b on b.src = a.dst and b.rel = 'hasCustomer'
    join edges c on c.src = b.dst and c.rel = 'placed' where a.rel = 'hasNation' and split_part(a.src, '#', 1) in ('r')""")
def graph_path_join(t):
    paths = graph.graph_path_join(_edges(t), [("<", "placed"), ("<", "hasCustomer"), ("<", None)])
    return paths.where(graph.namespace_of(F.col("n3")).isin("r")).select(F.col("n2").alias("nation"), F.col("n0").alias("purchase"))


@query("graph_reach", f"""
    with recursive {_EDGES_SQL}, reach(root, node, depth) as (
      select src, dst, 1 from edges where src like 'r#%'
      union all select root, dst, depth + 1 from reach join edges on src = node)
    select root, node, depth from reach""")
def graph_reach(t):
    return graph.graph_reach(_edges(t), t.region.select(F.concat(F.lit("r#"), "r_regionkey").alias("root")))


@query("graph_reach_chain", """
    select first_value(o_orderkey) over w as root, o_orderkey as node, cast(row_number() over w - 1 as integer) as depth from orders
    where o_orderkey is not null and o_custkey is not null window w as (partition by o_custkey order by o_orderkey)
    qualify row_number() over w > 1""")
def graph_reach_chain(t):
    """Each order leads to the next one of its customer: chains of very different lengths."""
    by_customer = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    orders = t.orders.where("o_orderkey is not null and o_custkey is not null").select(
        F.col("o_orderkey").alias("src"), F.lit("next").alias("rel"), F.lead("o_orderkey").over(by_customer).alias("dst"),
        F.lag("o_orderkey").over(by_customer).alias("before"))
    return graph.graph_reach(orders.drop("before"), orders.where("before is null").select("src"), "next")


@query("graph_reach_cycle", """
    with recursive e as (select c_custkey as src, c_custkey - c_custkey % 10 + (c_custkey * 7 + 3) % 10 as dst from customer),
    reach(root, node) as (select src, dst from e union select root, dst from reach join e on src = node)
    select root, node from reach""")
def graph_reach_cycle(t):
    key = F.col("c_custkey")
    edges = t.customer.select(key.alias("src"), F.lit("next").alias("rel"), (key - key % 10 + (key * 7 + 3) % 10).alias("dst"))
    return graph.graph_reach(edges, t.customer.select("c_custkey")).select("root", "node")


@query("merge_if_absent", """
    select distinct 'c#' || o_custkey as src, 'hasContract' as rel, 'c#' || o_custkey || '_tariff' as dst from orders
    where o_custkey not in (select c_custkey from customer where c_mktsegment = 'MACHINERY')""")
def merge_if_absent(t):
    key = F.concat(F.lit("c#"), "c_custkey")
    present = t.customer.where("c_mktsegment = 'MACHINERY'").select(
        key.alias("src"), F.lit("hasContract").alias("rel"), F.concat(key, F.lit("_tariff")).alias("dst"))
    targets = t.orders.select(F.concat(F.lit("c#"), "o_custkey").alias("uri"))
    return graph.merge_if_absent(targets, present, "hasContract", F.concat("src", F.lit("_tariff")))


_SUPPLY = """
    e as (select 'c#' || c_custkey as space, 'p#' || c_custkey as point, case when c_acctbal > 2000 then 'gas' else 'power' end as utility,
                 c_mktsegment, c_nationkey from customer)"""


@query("link_contracts", f"""
    with {_SUPPLY}, hit as (select point, c_mktsegment from e join nation on n_nationkey = c_nationkey where n_regionkey = 1 and utility = 'power')
    select point as src, 'contracted' as rel, point || '_tariff' as dst from hit where c_mktsegment <> 'MACHINERY'
    union all select point || '_tariff', 'tariff', 't#default' from hit
    union all select point || '_tariff', unnest(['label', 'contractName', 'contractStartDate']),
                     unnest(['ContractedTariff', 'electricdefault', '2000-01-01T00:00:00.000+0100']) from hit""")
def link_contracts(t):
    def link(df, a, rel, b):
        return df.select(a.alias("src"), F.lit(rel).alias("rel"), b.alias("dst"))

    key = lambda mark, column: F.concat(F.lit(mark), column)
    nation, point = key("n#", "c_nationkey"), key("p#", "c_custkey")
    edges = (
        link(t.nation, key("r#", "n_regionkey"), "sub", key("n#", "n_nationkey"))
        .union(link(t.customer, nation, "manages", key("b#", "c_custkey")))
        .union(link(t.customer, key("b#", "c_custkey"), "space", key("c#", "c_custkey")))
        .union(link(t.customer, key("c#", "c_custkey"), "point", point))
        .union(link(t.customer, point, "utility", F.when(F.col("c_acctbal") > 2000, "gas").otherwise("power")))
        .union(link(t.customer.where("c_mktsegment = 'MACHINERY'"), point, "contracted", F.concat(point, F.lit("_tariff"))))
    )
    names = {k: k for k in ("sub", "manages", "space", "point", "utility", "contracted", "tariff")}
    top = t.region.where("r_regionkey = 1").select(F.concat(F.lit("r#"), "r_regionkey").alias("root"))
    nodes, new = graph.link_contracts(edges, top, "power", "electricdefault", "t#default", names)
    return new.unionByName(_listed(nodes))


def _listed(nodes: DataFrame) -> DataFrame:
    """Labels and values of nodes as rows ``(src, rel, dst)``."""
    labels = nodes.select(F.col("uri").alias("src"), F.lit("label").alias("rel"), F.explode("labels").alias("dst"))
    values = nodes.select("uri", F.explode("props").alias("rel", "values")).select(F.col("uri").alias("src"), "rel", F.explode("values").alias("dst"))
    return labels.unionByName(values)


@query("expand_generic_entities", """
    with d as (select 'https://org#D' || c_custkey as uri, nullif(c_name, 'Customer#000000007') as name, c_custkey as id from customer), ns as (select 'https://org#' as ns),
    n as (select uri, name, id, ns || 'ORGANIZATION-FE' || id as org, ns || 'BUILDING-FE' || id as building, ns || 'LOCATION-FE' || id as place, ns || 'BUILDINGSPACE-FE' || id as space,
                 ns || 'AREA-GrossFloorArea-generic-FE' || id as area, ns || 'ELEMENT-FE' || id as element from d, ns)
    select src, rel, dst, selected from (
      select unnest([uri, org, building, place, building, space, area, space]) as src,
             unnest(['hasSubOrganization', 'managesBuilding', 'hasLocationInfo', 'hasAddressCity', 'hasSpace', 'hasArea', 'hasAreaUnitOfMeasurement', 'isAssociatedWithElement']) as rel,
             unnest([org, building, place, 'geo#1', space, area, 'unit#M2', element]) as dst, unnest([false, false, false, true, false, true, false, false]) as selected from n)
    union all
    select src, rel, dst, null from (
      select unnest([org, org, org, org, building, building, building, building, space, space, space, area, area, area, element, element, element, place, place, place, place, place]) as src,
             unnest(['label', 'organizationName', 'organizationDivisionType', 'generic', 'label', 'buildingIDFromOrganization', 'buildingName', 'generic', 'label', 'buildingSpaceName', 'generic',
                     'label', 'areaValue', 'generic', 'label', 'label', 'generic', 'label', 'addressPostalCode', 'addressStreetName', 'addressStreetNumber', 'generic']) as rel,
             unnest(['Organization', 'Generic(' || name || ')', 'Building', '1', 'Building', 'FE' || id, 'Generic(' || name || ')', '1', 'BuildingSpace', 'Building', '1',
                     'Area', '0', '1', 'BuildingElement', 'BuildingConstructionElement', '1', 'LocationInfo', '0000', 'generic', '0', '1']) as dst from n)
    where dst is not null""")
def expand_generic_entities(t):
    departments = t.customer.select(F.concat(F.lit("https://org#D"), "c_custkey").alias("uri"), F.nullif("c_name", F.lit("Customer#000000007")).alias("c_name"), "c_custkey")
    nodes, edges = graph.expand_generic_entities(departments, "uri", "c_name", "c_custkey", "https://org#",
                                                 {"city": "geo#1", "unit": "unit#M2"})
    return edges.unionByName(_listed(nodes), allowMissingColumns=True)


RES, CORE = "https://city.example#", "https://saref.etsi.org/core/"
TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"


def _mapped(t, maps: dict, **frames: DataFrame) -> DataFrame:
    return mapping.apply_mapping(frames, document(maps))


@query("map_template_iri", f"""
    select distinct '{RES}Device-' || s_suppkey || '-' || nullif(s_nationkey, 3) as s, '{CORE}measures' as p, '{RES}M-' || s_name as o,
           'iri' as o_kind from supplier where nullif(s_nationkey, 3) is not null""")
def map_template_iri(t):
    rows = t.supplier.withColumn("zone", F.nullif("s_nationkey", F.lit(3)))
    return _mapped(t, {"d": shape("s", "res:Device-$(s_suppkey)-$(zone)", ("saref:measures", "res:M-$(s_name)"))}, s=rows)


@query("map_iri_encoding", """
    select distinct 'https://city.example#Part-' || replace(replace(p_name || '/' || p_brand, ' ', '%20'), '/', '%2F') as iri
    from (select p_name, replace(p_brand, '#', '-') as p_brand from part)""")
def map_iri_encoding(t):
    rows = t.part.select(F.concat_ws("/", "p_name", F.replace("p_brand", F.lit("#"), F.lit("-"))).alias("name"))
    made = mapping.apply_mapping({"p": rows}, document({"p": shape("p", "res:Part-$(name)", ("a", "saref:Device"))}), encode=True)
    return made.select(F.col("s").alias("iri"))


@query("map_type_label", f"""
    select '{RES}Device-' || s_suppkey as s, '{TYPE}' as p, unnest(['{CORE}Device', 'https://saref.etsi.org/saref4syst/System']) as o,
           'iri' as o_kind from supplier""")
def map_type_label(t):
    return _mapped(t, {"d": shape("s", "res:Device-$(s_suppkey)", ("a", "saref:Device"), ("a", "s4syst:System"))}, s=t.supplier)


@query("map_literal", f"""
    select '{RES}Supplier-' || s_suppkey as s, '{CORE}hasValue' as p, cast(s_acctbal as varchar) as o, 'literal' as o_kind from supplier""")
def map_literal(t):
    return _mapped(t, {"d": shape("s", "res:Supplier-$(s_suppkey)", ("saref:hasValue", "$(s_acctbal)"))}, s=t.supplier)


@query("map_multi_valued", f"""
    select distinct '{RES}Part-' || p_partkey as s, '{CORE}relatesToProperty' as p,
           'http://bigg-project.eu/ld/ontology#' || unnest(string_split(p_name, ' ')) as o, 'iri' as o_kind from part""")
def map_multi_valued(t):
    rows = t.part.select("p_partkey", F.split("p_name", " ").alias("words"))
    return _mapped(t, {"d": shape("s", "res:Part-$(p_partkey)", ("saref:relatesToProperty", "bigg:$(words)"))}, s=rows)


@query("map_dynamic_predicate_object", f"""
    select '{RES}Measurement-' || p_partkey || '-' || p_type as s, '{CORE}relatesToProperty' as p,
           'http://bigg-project.eu/ld/ontology#' || p_type as o, 'iri' as o_kind from part""")
def map_dynamic_predicate_object(t):
    return _mapped(t, {"d": shape("s", "res:Measurement-$(p_partkey)-$(p_type)",
                                  ("saref:relatesToProperty", "bigg:$(p_type)"))}, s=t.part)


@query("map_json_source", f"""
    select '{RES}Building-' || p_partkey as s, '{CORE}name' as p, p_name as o, 'literal' as o_kind from part
    union all select '{RES}Point-' || p_partkey, 'http://www.opengis.net/ont/geosparql#asGeoJSON', p_size || ' ' || p_partkey, 'literal' from part""")
def map_json_source(t):
    rows = t.part.select(F.struct("p_partkey", "p_name").alias("properties"),
                         F.struct(F.concat_ws(" ", "p_size", "p_partkey").alias("coordinates")).alias("geometry"))
    return mapping.apply_mapping({"parts.point": rows}, document({
        "b": shape("parts.point/properties", "res:Building-$(p_partkey)", ("saref:name", "$(p_name)")),
        "g": shape("parts.point", "res:Point-$(properties.p_partkey)", ("geosp:asGeoJSON", "$(geometry.coordinates)")),
    }))


@query("expand_prefixes", """
    select distinct 'http://qudt.org/schema/qudt/' || p_brand as o from part""")
def expand_prefixes(t):
    made = mapping.apply_mapping(
        {"p": t.part}, document({"p": shape("p", "res:P-$(p_partkey)", ("saref:isMeasuredIn", "qudt:$(p_brand)"))}),
        canonical_prefixes={"qudt": "http://qudt.org/schema/qudt/"})
    return made.select("o").distinct()


_CITY_MAPS = {
    "supplier": shape("suppliers", "res:Supplier-$(s_suppkey)", ("a", "saref:Device"), ("saref:name", "$(s_name)"),
                      ("saref:locatedIn", "res:Nation-$(s_nationkey)")),
    "nationOfSupplier": shape("suppliers", "res:Nation-$(s_nationkey)", ("a", "gn:PostalCode"), ("geosp:sfContains", "res:Supplier-$(s_suppkey)")),
    "nation": shape("nations", "res:Nation-$(n_nationkey)", ("a", "gn:PostalCode"), ("a", "s4city:District"),
                    ("gn:officialName", "$(n_name)"), ("gn:officialName", "$(alias)"), ("saref:name", "$(n_name)"), ("saref:name", "$(alias)")),
}
_CITY_SQL = f"""
    n as (select *, 'also ' || n_name as alias from nation),
    triples as (select distinct * from (
      select '{RES}Supplier-' || s_suppkey as s, '{TYPE}' as p, '{CORE}Device' as o, 'iri' as o_kind from supplier
      union all select '{RES}Supplier-' || s_suppkey, '{CORE}name', s_name, 'literal' from supplier
      union all select '{RES}Supplier-' || s_suppkey, '{CORE}locatedIn', '{RES}Nation-' || s_nationkey, 'iri' from supplier
      union all select '{RES}Nation-' || s_nationkey, '{TYPE}', 'http://www.geonames.org/ontology#PostalCode', 'iri' from supplier
      union all select '{RES}Nation-' || s_nationkey, 'http://www.opengis.net/ont/geosparql#sfContains', '{RES}Supplier-' || s_suppkey, 'iri' from supplier
      union all select '{RES}Nation-' || n_nationkey, '{TYPE}',
                       unnest(['http://www.geonames.org/ontology#PostalCode', 'https://saref.etsi.org/saref4city/District']), 'iri' from n
      union all select '{RES}Nation-' || n_nationkey, 'http://www.geonames.org/ontology#officialName', unnest([n_name, alias]), 'literal' from n
      union all select '{RES}Nation-' || n_nationkey, '{CORE}name', unnest([n_name, alias]), 'literal' from n))"""


def _city(t) -> DataFrame:
    return mapping.apply_mapping(
        {"suppliers": t.supplier, "nations": t.nation.withColumn("alias", F.concat(F.lit("also "), "n_name"))}, document(_CITY_MAPS))


@query("apply_mapping", f"with {_CITY_SQL} select * from triples")
def apply_mapping(t):
    return _city(t)


@query("distinct_triples", f"""
    select distinct '{RES}Part-' || l_partkey as s, '{CORE}suppliedBy' as p, '{RES}Supplier-' || l_suppkey as o, 'iri' as o_kind from lineitem""")
def distinct_triples(t):
    rows = t.lineitem.select(
        F.concat(F.lit(f"{RES}Part-"), "l_partkey").alias("s"), F.lit(f"{CORE}suppliedBy").alias("p"),
        F.concat(F.lit(f"{RES}Supplier-"), "l_suppkey").alias("o"), F.lit("iri").alias("o_kind"))
    return graph.distinct_triples(rows)


@query("merge_nodes", f"""
    with {_CITY_SQL}
    select s as uri, string_agg(o, ' ' order by o) filter (p = '{TYPE}') as labels,
           string_agg(o, ' | ' order by o) filter (p = 'http://www.geonames.org/ontology#officialName') as official,
           max(o) filter (p = '{CORE}name') as name
    from triples where p = '{TYPE}' or o_kind = 'literal' group by 1""")
def merge_nodes(t):
    nodes = graph.merge_nodes(_city(t))
    return nodes.select(
        "uri", F.array_join(F.array_sort("labels"), " ").alias("labels"),
        F.array_join(F.col("props")["http://www.geonames.org/ontology#officialName"], " | ").alias("official"),
        F.array_join(F.col("props")[f"{CORE}name"], " | ").alias("name"))


_GRAPH_SQL = f"""
    select s as src, p as rel, o as dst from triples where o_kind = 'iri' and p <> '{TYPE}'
    union all select s, 'label', o from triples where p = '{TYPE}'
    union all select s, p, o from triples where p = 'http://www.geonames.org/ontology#officialName'
    union all select s, p, max(o) from triples where o_kind = 'literal' and p <> 'http://www.geonames.org/ontology#officialName' group by s, p"""


@query("triples_to_graph", f"with {_CITY_SQL} {_GRAPH_SQL}")
def triples_to_graph(t):
    nodes, edges = graph.triples_to_graph(_city(t))
    return edges.unionByName(_listed(nodes))


@query("load_graph", f"""
    with {_CITY_SQL.replace('also ', 'later ')} {_GRAPH_SQL}
    union all select '{RES}Nation-' || n_nationkey, 'http://www.geonames.org/ontology#officialName', 'also ' || n_name from nation
    union all select 'versions', v, n from (values ('first', '1'), ('again', '1'), ('second', '2')) x(v, n)""")
def load_graph(t):
    """Two sources in one stored graph, the first of them twice: lists are united, single values are those of the last load."""
    root = scratch_path(t.spark, "graph")
    first = _city(t)
    second = mapping.apply_mapping({"suppliers": t.supplier.limit(0), "nations": t.nation.withColumn("alias", F.concat(F.lit("later "), "n_name"))}, document(_CITY_MAPS))
    loads = [(name, str(graph_store.load_graph(source, root))) for name, source in (("first", first), ("again", first), ("second", second))]
    nodes, edges = graph_store.read_graph(t.spark, root)
    versions = t.spark.createDataFrame([("versions", *load) for load in loads], "src string, rel string, dst string")
    return edges.unionByName(_listed(nodes)).unionByName(versions)
