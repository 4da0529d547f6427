"""Graph tables: ``edges(src, rel, dst)``, ``nodes(uri, labels, props)`` and triples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanweave.operators.dedup import first_per_key
from urbanweave.session import cut_lineage, scratch_path

# Predicates whose values stay lists on a node, and the type predicate.
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
LIST_PREDICATES = (
    "http://bigg-project.eu/ontology#kpiType",
    "http://bigg-project.eu/ontology#shortName",
    "http://www.w3.org/2000/01/rdf-schema#label",
    "http://www.w3.org/2000/01/rdf-schema#comment",
    "http://www.geonames.org/ontology#officialName",
)


def graph_path_join(edges: DataFrame, path: Sequence[str | tuple[str | None, str]]) -> DataFrame:
    """Rows ``n0, n1, ..`` of a fixed-length pattern.

    Each step is a relation name, ``('<', name)`` against the arrow, or ``('<', None)`` for any relation.
    """
    found: DataFrame | None = None
    for step, item in enumerate(path):
        direction, name = item if isinstance(item, tuple) else (">", item)
        near, far = ("src", "dst") if direction == ">" else ("dst", "src")
        hop = (edges if name is None else edges.where(F.col("rel") == name)).select(
            F.col(near).alias(f"n{step}"), F.col(far).alias(f"n{step + 1}")
        )
        found = hop if found is None else found.join(hop, f"n{step}")
    return found.select(*[f"n{k}" for k in range(len(path) + 1)])


def namespace_of(uri: Column) -> Column:
    return F.substring_index(uri, "#", 1)


#: Rounds that follow one edge each; what is still open then may be a long chain and takes jumps.
SINGLE_STEPS = 8


def graph_reach(edges: DataFrame, seeds: DataFrame, rel: str | None = None, include_seeds: bool = False) -> DataFrame:
    """``(root, node, depth)`` of all nodes reached from each seed over one or more edges; cycles are safe.

    ``seeds`` has one column. Each round follows the new nodes only and is written to the shared folder,
    so a lost executor costs at most one round. Paths of more than :data:`SINGLE_STEPS` edges go on by jumps over stretches without a
    fork, so their rounds follow the forks on a path and not its length.
    """
    spark = edges.sparkSession
    links = (edges if rel is None else edges.where(F.col("rel") == rel)).select(
        F.col("src").alias("__src"), F.col("dst").alias("__dst")
    ).where(F.col("__dst").isNotNull())
    root = F.col(seeds.columns[0])
    start = seeds.select(root.alias("root"), root.alias("node")).where(root.isNotNull()).distinct()
    folder = scratch_path(spark, "reach")
    start.withColumn("depth", F.lit(0)).write.parquet(f"{folder}/round=0")
    read = spark.read.schema(f"root {_ddl(start, 'root')}, node {_ddl(start, 'node')}, depth int")
    depth, open_ends = 0, True
    while open_ends and depth < SINGLE_STEPS:
        frontier = read.parquet(f"{folder}/round={depth}").select("root", "node")
        hop = frontier.join(links, F.col("node") == F.col("__src")).select("root", F.col("__dst").alias("node")).distinct()
        if depth:  # a seed counts as reached only if an edge leads back to it, so round 0 is not in the way
            known = read.parquet(*[f"{folder}/round={k}" for k in range(1, depth + 1)]).select("root", "node")
            hop = hop.join(known, ["root", "node"], "left_anti")
        depth += 1
        hop.withColumn("depth", F.lit(depth)).write.parquet(f"{folder}/round={depth}")
        open_ends = not read.parquet(f"{folder}/round={depth}").isEmpty()
    reached = read.parquet(*[f"{folder}/round={k}" for k in range(1, depth + 1)])
    if open_ends:
        reached = _reach_on(reached, read.parquet(f"{folder}/round={depth}"), cut_lineage(links.distinct()))
    if include_seeds:
        return start.withColumn("depth", F.lit(0)).unionByName(
            reached.join(start, ["root", "node"], "left_anti"))
    return reached


def _jumps(links: DataFrame) -> list[DataFrame]:
    """Maps ``(__src, __dst)`` over 1, 2, 4, .. edges from nodes with one way out, as long as there are such stretches.

    A map has at most one row a node. Rings never end, so no jump is longer than there are nodes with one way out.
    """
    one_way = links.groupBy("__src").agg(F.count(F.lit(1)).alias("__ways"), F.min("__dst").alias("__dst")).where("__ways = 1")
    maps = [cut_lineage(one_way.where("__src <> __dst").select("__src", "__dst"))]
    most = maps[0].count()
    while 2 ** len(maps) <= most:
        on = maps[-1].select(F.col("__src").alias("__mid"), F.col("__dst").alias("__end"))
        further = cut_lineage(maps[-1].join(on, F.col("__dst") == F.col("__mid")).select("__src", F.col("__end").alias("__dst")))
        if further.isEmpty():
            break
        maps.append(further)
    return maps


def _reach_on(best: DataFrame, front: DataFrame, links: DataFrame) -> DataFrame:
    """The closure of ``best`` from its open ends ``front``, least depth first or corrected later.

    A round takes the open ends along their stretches, longest jumps first, and then one edge on from everything it met. Pairs whose
    depth became less are open again, unless the round has been on from them at that depth.
    """
    maps = _jumps(links)

    def followed(rows: DataFrame, ways: DataFrame, steps: int) -> DataFrame:
        return rows.join(ways, F.col("node") == F.col("__src")).select("root", F.col("__dst").alias("node"), (F.col("depth") + steps).alias("depth"))

    while not front.isEmpty():
        met = front
        for level in reversed(range(len(maps))):
            met = cut_lineage(met.unionByName(followed(met, maps[level], 2 ** level)).groupBy("root", "node").agg(F.min("depth").alias("depth")))
        seen = met.withColumn("open", F.lit(0)).unionByName(followed(met, links, 1).withColumn("open", F.lit(1)))
        least = seen.groupBy("root", "node").agg(F.min(F.struct("depth", "open")).alias("least")).select("root", "node", "least.*")
        known = best.select("root", "node", F.col("depth").alias("__known"))
        better = cut_lineage(least.join(known, ["root", "node"], "left").where("__known is null or depth < __known").drop("__known"))
        best = cut_lineage(best.unionByName(better.drop("open")).groupBy("root", "node").agg(F.min("depth").alias("depth")))
        front = better.where("open = 1").drop("open")
    return best


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` of every node of a link between two different nodes; the component is one of its nodes.

    Each round gives every node the leader of its neighbourhood by an order that is drawn anew, and contracts the links to links between
    leaders, so nodes fall by a constant factor a round (in expectation) whatever their shape, long chains included. Leaders are minima
    that combine map-side; a hub is one row of the map it is joined with.
    """
    linked = cut_lineage(links.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct())
    steps: list[DataFrame] = []
    while not steps or not linked.isEmpty():
        place = lambda name: F.struct(F.xxhash64(name, F.lit(len(steps))).alias("drawn"), F.col(name).alias("node"))
        least = linked.unionByName(linked.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy("u").agg(F.min(place("v")).alias("near"))
        leaders = cut_lineage(least.select(F.col("u").alias("node"), F.least("near", place("u"))["node"].alias("component")))
        steps.append(leaders)
        first, second = (leaders.select(F.col("node").alias(end), F.col("component").alias(f"{end}_leader")) for end in "uv")
        met = linked.join(first, "u").join(second, "v").where("u_leader <> v_leader")
        linked = cut_lineage(met.select(F.least("u_leader", "v_leader").alias("u"), F.greatest("u_leader", "v_leader").alias("v")).distinct())
    found = steps.pop()
    while steps:  # a leader that the next round doesn't know had no neighbour left
        later = found.select(F.col("node").alias("__leader"), F.col("component").alias("__last"))
        found = steps.pop().join(later, F.col("component") == F.col("__leader"), "left").select(
            "node", F.coalesce("__last", "component").alias("component"))
    return found


def _ddl(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def merge_if_absent(targets: DataFrame, edges: DataFrame, rel: str, make: Column) -> DataFrame:
    """New edges ``(src, rel, dst)`` for the targets (one column of URIs) without such an edge; ``make`` is the
    URI of the other end. Running it again on the union adds nothing."""
    name = targets.columns[0]
    wanted = targets.select(F.col(name).alias("src")).where(F.col("src").isNotNull()).distinct().select(
        "src", F.lit(rel).alias("rel"), make.alias("dst")
    )
    present = edges.where(F.col("rel") == rel).select("src", "dst")
    return wanted.join(present, ["src", "dst"], "left_anti").select("src", "rel", "dst")


def link_contracts(edges: DataFrame, organisation: DataFrame, utility: str, contract: str, tariff: str,
                   vocabulary: dict[str, str], start: str = "2000-01-01T00:00:00.000+0100") -> tuple[DataFrame, DataFrame]:
    """Tariff contracts for every supply point of a utility below an organisation: (nodes, new edges).

    ``vocabulary`` names the relations ``sub, manages, space, point, utility, contracted, tariff``.
    """
    below = graph_reach(edges, organisation, vocabulary["sub"]).select(F.col("node").alias("n0"))
    steps = [vocabulary[k] for k in ("manages", "space", "point", "utility")]
    points = graph_path_join(edges, steps).where(F.col("n4") == utility).join(below, "n0", "left_semi").select(
        F.col("n3").alias("uri")
    ).distinct()
    to_contract = merge_if_absent(points, edges, vocabulary["contracted"], F.concat("src", F.lit("_tariff")))
    contracts = points.select(F.concat("uri", F.lit("_tariff")).alias("uri"))
    to_tariff = merge_if_absent(contracts, edges, vocabulary["tariff"], F.lit(tariff))
    nodes = contracts.select("uri", F.array(F.lit("ContractedTariff")).alias("labels"),
                             F.create_map(F.lit("contractName"), F.array(F.lit(contract)), F.lit("contractStartDate"), F.array(F.lit(start))).alias("props"))
    return nodes, to_contract.unionByName(to_tariff)


# What a generic building under a department consists of: labels, URI stem, properties besides the mark ``generic``.
GENERIC_NODES = {
    "organisation": (("Organization",), "ORGANIZATION-FE", {"organizationName": "Generic({name})", "organizationDivisionType": "Building"}),
    "building": (("Building",), "BUILDING-FE", {"buildingIDFromOrganization": "FE{number}", "buildingName": "Generic({name})"}),
    "space": (("BuildingSpace",), "BUILDINGSPACE-FE", {"buildingSpaceName": "Building"}),
    "area": (("Area",), "AREA-GrossFloorArea-generic-FE", {"areaValue": "0"}),
    "element": (("BuildingElement", "BuildingConstructionElement"), "ELEMENT-FE", {}),
    "location": (("LocationInfo",), "LOCATION-FE", {"addressPostalCode": "0000", "addressStreetName": "generic", "addressStreetNumber": "0"}),
}
# Edges between them, and whether they are marked ``selected``; "department" is the starting node, other ends are given by the caller.
GENERIC_EDGES = (
    ("department", "hasSubOrganization", "organisation", False),
    ("organisation", "managesBuilding", "building", False),
    ("building", "hasLocationInfo", "location", False),
    ("location", "hasAddressCity", "city", True),
    ("location", "hasAddressProvince", "province", True),
    ("building", "hasSpace", "space", False),
    ("space", "hasArea", "area", True),
    ("area", "hasAreaUnitOfMeasurement", "unit", False),
    ("area", "hasAreaType", "area_type", False),
    ("space", "isAssociatedWithElement", "element", False),
    ("space", "hasBuildingSpaceUseType", "use_type", True),
)


def expand_generic_entities(departments: DataFrame, uri: str, name: str, number: str, namespace: str,
                            ends: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Generic building of each department: ``nodes(uri, labels, props)`` and ``edges(src, rel, dst, selected)``.

    ``ends`` gives the URIs of ``city, province, unit, area_type, use_type``; edges to a missing end are left out. Properties are
    texts; a department without name has generic nodes without names.
    """
    made = {key: F.concat(F.lit(namespace + stem), F.col(number).cast("string")) for key, (_, stem, _) in GENERIC_NODES.items()}
    filled = {"{name}": F.col(name), "{number}": F.col(number).cast("string")}

    def text(form: str) -> Column:
        for mark, column in filled.items():
            head, found, tail = form.partition(mark)
            if found:
                return F.concat(F.lit(head), column, F.lit(tail))
        return F.lit(form)

    node_rows = []
    for key, (labels, _, properties) in GENERIC_NODES.items():
        entries = [F.struct(F.lit(p).alias("key"), F.array(text(form)).alias("value")) for p, form in {**properties, "generic": "1"}.items()]
        props = F.map_from_entries(F.filter(F.array(*entries), lambda e: F.element_at(e["value"], 1).isNotNull()))
        node_rows.append(F.struct(made[key].alias("uri"), F.array(*[F.lit(x) for x in labels]).alias("labels"), props.alias("props")))
    at = {"department": F.col(uri), **made, **{key: F.lit(value) for key, value in ends.items()}}
    edge_rows = [
        F.struct(at[a].alias("src"), F.lit(rel).alias("rel"), at[b].alias("dst"), F.lit(selected).alias("selected"))
        for a, rel, b, selected in GENERIC_EDGES if b in at
    ]
    nodes = departments.select(F.inline(F.array(*node_rows)))
    return nodes, departments.select(F.inline(F.array(*edge_rows)))


#: What tells a literal from others of the same text; frames without tagged literals lack these columns.
TAGS = ("language", "datatype")


def distinct_triples(triples: DataFrame) -> DataFrame:
    """Each triple once; literals differ by language and datatype too."""
    return triples.select("s", "p", "o", "o_kind", *[c for c in TAGS if c in triples.columns]).distinct()


def _tagged(triples: DataFrame) -> Column:
    """The value of a fact as a node keeps it: a literal with a language as ``text@language``."""
    if "language" not in triples.columns:
        return F.col("o")
    return F.when(F.col("language").isNotNull(), F.concat("o", F.lit("@"), "language")).otherwise(F.col("o"))


def graph_edges(triples: DataFrame) -> DataFrame:
    """Triples whose object is a node, but for types."""
    return triples.where(F.col("o_kind").isin("iri", "blank") & (F.col("p") != RDF_TYPE)).select(
        F.col("s").alias("src"), F.col("p").alias("rel"), F.col("o").alias("dst")
    ).distinct()


def merge_nodes(triples: DataFrame, list_predicates: Sequence[str] = LIST_PREDICATES, order: str | None = None) -> DataFrame:
    """One node per URI: ``nodes(uri, labels, props)``.

    Labels are united. Values of the listed predicates become lists, others keep one value: that of the highest ``order`` (a
    column of the triples, such as a sequence of loads), then the highest. A value with a language keeps it, as ``text@language``.
    Blank nodes are nodes by their label.
    Edges are not gathered: a hub has as many as it likes, in :func:`graph_edges`.
    """
    place = F.struct(*([F.col(order)] if order else []), F.col("o"))
    kept = triples.where((F.col("o_kind") == "literal") | (F.col("p") == RDF_TYPE)).withColumn("o", _tagged(triples))
    facts = kept.select("s", "p", "o", place.alias("place"))
    many = F.col("p").isin(RDF_TYPE, *list_predicates)
    # Single-valued facts shrink to one row in the partial aggregate; only true lists are collected.
    single = facts.where(~many).groupBy("s", "p").agg(F.max("place")["o"].alias("o")).select(
        "s", "p", F.array("o").alias("values")
    )
    lists = facts.where(many).select("s", "p", "o").distinct().groupBy("s", "p").agg(
        F.array_sort(F.collect_list("o")).alias("values")
    )
    per_node = single.unionByName(lists).groupBy("s").agg(
        F.map_from_entries(F.collect_list(F.struct("p", "values"))).alias("all")
    )
    return per_node.select(
        F.col("s").alias("uri"),
        F.coalesce(F.col("all")[RDF_TYPE], F.array().cast("array<string>")).alias("labels"),
        F.map_filter("all", lambda k, v: k != RDF_TYPE).alias("props"),
    )


def triples_to_graph(triples: DataFrame, list_predicates: Sequence[str] = LIST_PREDICATES) -> tuple[DataFrame, DataFrame]:
    return merge_nodes(triples, list_predicates), graph_edges(triples)
