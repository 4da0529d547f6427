import random

import pytest
from pyspark.sql import functions as F

from urbanweave.functions import text
from urbanweave.operators import graph, mapping
from urbanweave.plans import mappings as M
from urbanweave.plans import sources
from urbanweave.sources import graph_store


def edges(spark, items):
    return spark.createDataFrame(items, "src string, rel string, dst string")


def test_reach_handles_cycles_depth_and_roots(spark):
    chain = [(f"n{i}", "sub", f"n{i + 1}") for i in range(6)] + [("n6", "sub", "n2"), ("n3", "other", "x"), ("m", "sub", "m"), ("m", "sub", None)]
    seeds = spark.createDataFrame([("n0",), ("n4",), ("m",), ("lone",), (None,)], "s string")
    got = {(r.root, r.node): r.depth for r in graph.graph_reach(edges(spark, chain), seeds, "sub").collect()}
    assert got == {**{("n0", f"n{i}"): i for i in range(1, 7)}, ("n4", "n5"): 1, ("n4", "n6"): 2, ("n4", "n2"): 3, ("n4", "n3"): 4, ("n4", "n4"): 5,
                   ("m", "m"): 1}
    with_seeds = {(r.root, r.node): r.depth for r in graph.graph_reach(edges(spark, chain), seeds, "sub", True).collect()}
    assert with_seeds["n4", "n4"] == 0 and with_seeds["lone", "lone"] == 0 and with_seeds["n0", "n6"] == 6


def test_contracts_are_made_once(spark):
    v = {"sub": "hasSub", "manages": "manages", "space": "hasSpace", "point": "hasPoint", "utility": "type", "contracted": "hasContract", "tariff": "hasTariff"}
    g = edges(spark, [("org", "hasSub", "dep"), ("dep", "manages", "b"), ("b", "hasSpace", "s"), ("s", "hasPoint", "p1"), ("s", "hasPoint", "p2"),
                      ("s", "hasPoint", "p3"), ("p1", "type", "power"), ("p2", "type", "power"), ("p3", "type", "gas"), ("p2", "hasContract", "p2_tariff")])
    root = spark.createDataFrame([("org",)], "uri string")
    nodes, new = graph.link_contracts(g, root, "power", "default", "t", v)
    assert {tuple(r) for r in new.collect()} == {("p1", "hasContract", "p1_tariff"), ("p1_tariff", "hasTariff", "t"), ("p2_tariff", "hasTariff", "t")}
    assert {r.uri for r in nodes.collect()} == {"p1_tariff", "p2_tariff"}
    again = graph.link_contracts(g.unionByName(new), root, "power", "default", "t", v)[1]
    assert again.count() == 0


def test_generic_entities(spark):
    deps = spark.createDataFrame([("d#1", "Dep", 7)], "uri string, name string, id int")
    nodes, links = graph.expand_generic_entities(deps, "uri", "name", "id", "https://o#", {"city": "c", "province": "p", "unit": "u", "area_type": "t", "use_type": "x"})
    assert links.count() == 11 and nodes.select("uri").distinct().count() == 6
    assert {r.rel for r in links.collect() if r.selected} == {"hasAddressCity", "hasAddressProvince", "hasArea", "hasBuildingSpaceUseType"}
    made = {r.uri: (r.labels, {k: v[0] for k, v in r.props.items()}) for r in nodes.collect()}
    assert made["https://o#ORGANIZATION-FE7"] == (["Organization"], {"organizationName": "Generic(Dep)", "organizationDivisionType": "Building", "generic": "1"})
    assert made["https://o#BUILDING-FE7"] == (["Building"], {"buildingIDFromOrganization": "FE7", "buildingName": "Generic(Dep)", "generic": "1"})
    assert made["https://o#LOCATION-FE7"][1] == {"addressPostalCode": "0000", "addressStreetName": "generic", "addressStreetNumber": "0", "generic": "1"}
    assert made["https://o#ELEMENT-FE7"] == (["BuildingElement", "BuildingConstructionElement"], {"generic": "1"})


def test_stored_graph(spark, tmp_path):
    kinds = "s string, p string, o string, o_kind string, language string"
    first = [("u", graph.RDF_TYPE, "A", "iri", None), ("u", "name", "x", "literal", None), ("u", graph.LIST_PREDICATES[2], "l", "literal", "en"), ("u", "to", "v", "iri", None)]
    second = [("u", graph.RDF_TYPE, "B", "iri", None), ("u", "name", "y", "literal", "ca"), ("u", graph.LIST_PREDICATES[2], "l", "literal", "ca"), ("u", "to", "w", "iri", None),
              ("_:b", "name", "n", "literal", None)]
    load = lambda rows: graph_store.load_graph(spark.createDataFrame(rows, kinds), str(tmp_path))
    assert [load(first), load(first), load(second), load(second), load(first[1:2]), load([])] == [1, 1, 2, 2, 3, 3]
    nodes, edges = graph_store.read_graph(spark, str(tmp_path))
    got = {r.uri: (sorted(r.labels), {k: sorted(v) for k, v in r.props.items()}) for r in nodes.collect()}
    assert got == {"u": (["A", "B"], {"name": ["x"], graph.LIST_PREDICATES[2]: ["l@ca", "l@en"]}), "_:b": ([], {"name": ["n"]})}
    assert sorted(r.dst for r in edges.collect()) == ["v", "w"]
    before = graph_store.read_graph(spark, str(tmp_path), version=2)[0].where("uri = 'u'").first()
    assert before.props["name"] == ["y@ca"]


def test_template_rules(spark):
    df = spark.createDataFrame([("a b", None, ["x", None, "y"], 1)], "`Número d'inscripció` string, gone string, words array<string>, `v.dot` int")
    maps = {"m": M.shape("rows", "res:S-$(Número d'inscripció)", ("a", "saref:Device"), ("saref:n", "$(v.dot)"), ("saref:g", "$(gone)"),
                         ("saref:w", "bigg:$(words)"), ("unknown:p", "plain text"), ("saref:h", "res:G-$(gone)"))}
    raw = {r.s for r in mapping.apply_mapping({"rows": df}, M.document(maps), encode=False).collect()}
    assert raw == {"https://city.example#S-a b"}  # no valid IRI: only if asked for
    got = {(r.s, r.p, r.o, r.o_kind) for r in mapping.apply_mapping({"rows": df}, M.document(maps)).collect()}
    s, core = "https://city.example#S-a%20b", "https://saref.etsi.org/core/"
    assert got == {(s, graph.RDF_TYPE, core + "Device", "iri"), (s, core + "n", "1", "literal"), (s, core + "w", M.VOCABULARY["bigg"] + "x", "iri"),
                   (s, core + "w", M.VOCABULARY["bigg"] + "y", "iri"), (s, "unknown:p", "plain text", "literal")}
    encoded = mapping.apply_mapping({"rows": df}, M.document(maps), encode=True)
    assert {r.s for r in encoded.collect()} == {"https://city.example#S-a%20b"}
    with pytest.raises(KeyError):
        mapping.apply_mapping({"rows": df.drop("gone")}, M.document(maps))


def test_each_source_is_scanned_once(spark, tmp_path):
    spark.createDataFrame([(1, "n")], "id int, name string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    maps = {str(k): M.shape("rows", f"res:{k}-$(id)", ("a", "saref:Device"), ("saref:name", "$(name)")) for k in range(5)}
    plan = mapping.apply_mapping({"rows": df}, M.document(maps))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


# Number of triple maps and predicate-object rules per source.
COUNTS = {
    "hourly_postal": (6, 16), "annual_building": (4, 14), "monthly_address": (5, 15), "vegetation": (5, 15), "weather": (5, 22),
    "urban_climate": (3, 13), "tourism": (2, 6), "buildings": (8, 33), "building_spaces": (5, 17), "addresses": (3, 11),
}


@pytest.mark.parametrize("name", sorted(COUNTS))
def test_rule_counts(name):
    made = getattr(M, f"{name}_mapping")()
    assert (len(made["mappings"]), len(mapping.mapping_rules(made))) == COUNTS[name]


@pytest.mark.parametrize("level, maps, rules", [("census_tract", 3, 8), ("district", 3, 8), ("municipality", 2, 6), ("neighbourhood", 3, 9), ("postal_code", 2, 5)])
def test_boundary_rule_counts(level, maps, rules):
    made = M.boundary_mapping(level)
    assert (len(made["mappings"]), len(mapping.mapping_rules(made))) == (maps, rules)


def test_nodes_keep_lists_only_for_listed_predicates(spark):
    t = [("u", graph.RDF_TYPE, "A", "iri"), ("u", graph.RDF_TYPE, "B", "iri"), ("u", "name", "x", "literal"), ("u", "name", "y", "literal"),
         ("u", graph.LIST_PREDICATES[2], "l1", "literal"), ("u", graph.LIST_PREDICATES[2], "l2", "literal"), ("u", "link", "v", "iri"), ("w", "name", "z", "literal")]
    nodes, links = graph.triples_to_graph(spark.createDataFrame(t, "s string, p string, o string, o_kind string"))
    got = {r.uri: r for r in nodes.collect()}
    assert got["u"].labels == ["A", "B"] and got["u"].props == {"name": ["y"], graph.LIST_PREDICATES[2]: ["l1", "l2"]}
    assert got["w"].labels == [] and [tuple(r) for r in links.collect()] == [("u", "link", "v")]


def test_latest_value_of_a_node_wins(spark):
    rows = [("a", "p", "9", "literal", 1), ("a", "p", "1", "literal", 2), ("a", "q", "x", "literal", 1)]
    triples = spark.createDataFrame(rows, "s string, p string, o string, o_kind string, load int")
    assert graph.merge_nodes(triples, [], "load").first().props == {"p": ["1"], "q": ["x"]}
    assert graph.merge_nodes(triples, []).first().props == {"p": ["9"], "q": ["x"]}


def test_components_of_chains_hubs_and_rings(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(200)] + [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    pairs += [(3000 + rng.randrange(200), 3000 + rng.randrange(200)) for _ in range(90)] + [(5000, 5000), (None, 7), (7, 8), (8, 7)]
    rng.shuffle(pairs)
    label = {n: n for p in pairs if None not in p and p[0] != p[1] for n in p}
    for _ in label:
        before = dict(label)
        for a, b in pairs:
            if a in label and b in label:
                label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert set(got) == set(label)
    assert len({(got[n], label[n]) for n in label}) == len(set(label.values())) == len(set(got.values()))
    none = graph.connected_components(spark.createDataFrame([(1, 1)], "a long, b long"), "a", "b")
    assert none.count() == 0 and none.columns == ["node", "component"]


def walked(pairs, seeds):
    """Least number of edges, one or more, from each seed."""
    ways, found = {}, {}
    for a, b in pairs:
        ways.setdefault(a, set()).add(b)
    for seed in seeds:
        front, depth = {seed}, 0
        while front:
            depth += 1
            front = {b for a in front for b in ways.get(a, ()) if (seed, b) not in found}
            found.update({(seed, b): depth for b in front})
    return found


def test_reach_over_long_chains_forks_and_rings(spark):
    rng = random.Random(8)
    pairs = [(f"c{i}", f"c{i + 1}") for i in range(120)] + [("c60", "d0")] + [(f"d{i}", f"d{i + 1}") for i in range(40)] + [("d40", "c100"), ("d3", "c90")]
    pairs += [(f"r{i}", f"r{(i + 1) % 30}") for i in range(30)] + [("c20", "r0"), ("s", "s"), ("s", "c0")]
    pairs += [(f"x{rng.randrange(60)}", f"x{rng.randrange(60)}") for _ in range(75)] + pairs[:5]
    seeds = ["c0", "c50", "r7", "s", "x1", "x2", "nowhere"]
    table = spark.createDataFrame([(a, "sub", b) for a, b in pairs] + [("c0", "sub", None)], "src string, rel string, dst string")
    roots = spark.createDataFrame([(s,) for s in seeds], "root string")
    want = walked(pairs, seeds)
    assert {(r.root, r.node): r.depth for r in graph.graph_reach(table, roots, "sub").collect()} == want
    rows = graph.graph_reach(table, roots, "sub", True).collect()
    assert {(r.root, r.node): r.depth for r in rows} == {**want, **{(s, s): 0 for s in seeds}} and len(rows) == len({(r.root, r.node) for r in rows})


def test_jobs_of_a_chain_grow_with_the_logarithm(spark):
    jobs, context = {}, spark.sparkContext
    for length in (100, 500):
        table = spark.createDataFrame([(i, "sub", i + 1) for i in range(length)], "src long, rel string, dst long")
        context.setJobGroup(f"chain {length}", "")
        got = graph.graph_reach(table, spark.createDataFrame([(0,)], "root long"), "sub").collect()
        jobs[length] = len(context.statusTracker().getJobIdsForGroup(f"chain {length}"))
        assert sorted((r.node, r.depth) for r in got) == [(i, i) for i in range(1, length + 1)]
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[500] < 2 * jobs[100] and jobs[500] < 500


@pytest.mark.parametrize("encode", [None, True, False])
def test_triples_of_a_key_and_its_digests_are_not_shuffled(spark, encode):
    """Keys whose IRIs are equal state their common triples once; equal results to the way that compares triples."""
    keys = ["a b", "a%20b", "a%20b", "ab", "a\x01b", "x", "x", None, "c<d", "c%3Cd", "", " ", "e f", "e f", "g\x02"]
    df, digest = spark.createDataFrame([(k,) for k in keys], "reference string"), text.device_hash(F.col("reference"), "-ndvi")
    whole = mapping.apply_mapping({"ndvi": df.withColumn("ndviId", digest)}, M.vegetation_mapping(), encode).collect()
    keyed = mapping.apply_mapping({"ndvi": df}, M.vegetation_mapping(), encode, key="reference", digests={"ndviId": digest})
    got = keyed.collect()
    assert len(got) == len(set(got)) and set(got) == set(whole) and keyed.columns == ["s", "p", "o", "o_kind"]
    assert "hashpartitioning(s#" not in keyed._jdf.queryExecution().executedPlan().toString()
    plain = mapping.apply_mapping({"ndvi": df.where("reference in ('x', 'ab')")}, M.vegetation_mapping(), encode, key="reference", digests={"ndviId": digest})
    assert plain.count() == 30
    triples = sources.vegetation(df.selectExpr("reference", "1.0D as `HISTO_0.2`")).triples
    assert "hashpartitioning(s#" not in triples._jdf.queryExecution().executedPlan().toString()
    if encode is None:
        assert sorted(triples.collect()) == sorted(whole)


def test_rules_that_may_state_one_triple_are_compared(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b-c",), ("c",)], "k string").withColumn("h", text.device_hash(F.col("k"), "-x"))
    digests = {"h": text.device_hash(F.col("k"), "-x")}
    for rules in ([("res:$(k)", "res:p", "res:One"), ("res:$(k)", "res:p", "res:$(k)")], [("res:b-$(k)", "res:p", "res:One"), ("res:$(k)", "res:p", "res:One")],
                  [("res:$(k)$(k)", "res:p", "res:One")], [("res:all", "res:p", "res:One")], [("res:$(h)", "res:p", "$(k)"), ("res:all", "res:p", "$(k)"), ("res:$(k)", "res:q", "res:$(h)")]):
        maps = {str(i): M.shape("rows", s, (p, o)) for i, (s, p, o) in enumerate(rules)}
        got = mapping.apply_mapping({"rows": df}, M.document(maps), key="k", digests=digests).collect()
        assert len(got) == len(set(got)) and set(got) == set(mapping.apply_mapping({"rows": df}, M.document(maps)).collect())
