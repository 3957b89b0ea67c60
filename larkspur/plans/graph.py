"""Graph queries: regions, nations, customers and suppliers as one property graph."""

from pyspark.sql import functions as F

from larkspur.operators import graph
from larkspur.plans.registry import query

KIND = 1_000_000_000_000

NODES = """nodes AS (SELECT 'R' || r_regionkey AS id, 'region' AS type FROM region UNION ALL SELECT 'N' || n_nationkey, 'nation' FROM nation
  UNION ALL SELECT 'C' || c_custkey, 'customer' FROM customer UNION ALL SELECT 'S' || s_suppkey, 'supplier' FROM supplier)"""
EDGES = f"""edges AS (SELECT n_nationkey AS ord, 'N' || n_nationkey AS source, 'R' || n_regionkey AS target, 'IN_REGION' AS relation FROM nation
  UNION ALL SELECT {KIND} + c_custkey, 'C' || c_custkey, 'N' || c_nationkey, 'LIVES_IN' FROM customer
  UNION ALL SELECT {2 * KIND} + s_suppkey, 'S' || s_suppkey, 'N' || s_nationkey, 'BASED_IN' FROM supplier)"""
GRAPH = f"WITH {NODES}, {EDGES}"


def _id(prefix, col):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def nodes(t):
    parts = [
        t.region.select(_id("R", "r_regionkey").alias("id"), F.lit("region").alias("type")),
        t.nation.select(_id("N", "n_nationkey").alias("id"), F.lit("nation").alias("type")),
        t.customer.select(_id("C", "c_custkey").alias("id"), F.lit("customer").alias("type")),
        t.supplier.select(_id("S", "s_suppkey").alias("id"), F.lit("supplier").alias("type")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def edges(t):
    def part(df, kind, key, source, target, relation):
        return df.select(
            (F.lit(kind * KIND) + F.col(key)).cast("bigint").alias("ord"), source.alias("source"), target.alias("target"), F.lit(relation).alias("relation")
        )

    return (
        part(t.nation, 0, "n_nationkey", _id("N", "n_nationkey"), _id("R", "n_regionkey"), "IN_REGION")
        .unionByName(part(t.customer, 1, "c_custkey", _id("C", "c_custkey"), _id("N", "c_nationkey"), "LIVES_IN"))
        .unionByName(part(t.supplier, 2, "s_suppkey", _id("S", "s_suppkey"), _id("N", "s_nationkey"), "BASED_IN"))
    )


@query(
    "graph_neighbors",
    f"""{GRAPH}, u AS (SELECT source AS a, target AS b FROM edges UNION SELECT target, source FROM edges),
      l1 AS (SELECT DISTINCT 'R' || r_regionkey AS start, b AS node FROM region JOIN u ON a = 'R' || r_regionkey),
      l2 AS (SELECT DISTINCT start, b AS node FROM l1 JOIN u ON a = node),
      f AS (SELECT * FROM l1 UNION SELECT * FROM l2) SELECT start, id, type FROM f JOIN nodes ON id = node""",
)
def graph_neighbors(t):
    starts = t.region.select(_id("R", "r_regionkey").alias("id"))
    return graph.neighbors(nodes(t), edges(t), starts, depth=2)


@query(
    "graph_relations",
    f"""WITH {EDGES} SELECT source AS node, target AS neighbor, relation FROM edges UNION ALL SELECT target, source, 'inverse_' || relation FROM edges WHERE source <> target""",
)
def graph_relations(t):
    return graph.relations_of(edges(t))


@query(
    "graph_subgraph",
    f"""{GRAPH}, ent AS (SELECT 'N' || n_nationkey AS entity FROM nation)
      SELECT entity, -1 AS ord, 'Entity: ' || id || ' (' || type || ')' AS line FROM ent JOIN nodes ON id = entity
      UNION ALL SELECT entity, ord, '  -' || relation || '-> ' || id || ' (' || type || ')' FROM ent JOIN edges ON source = entity JOIN nodes ON id = target
      UNION ALL SELECT entity, ord, '  <-' || relation || '- ' || id || ' (' || type || ')' FROM ent JOIN edges ON target = entity AND source <> target JOIN nodes ON id = source""",
)
def graph_subgraph(t):
    return graph.subgraph_lines(nodes(t), edges(t), t.nation.select(_id("N", "n_nationkey").alias("id")))


@query(
    "graph_path",
    """WITH p AS (SELECT DISTINCT o_custkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
      SELECT 'C' || c_custkey AS start, 'S' || s_suppkey AS "end", 'C' || c_custkey || '>N' || c_nationkey || '>S' || s_suppkey AS path
      FROM p JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey WHERE c_nationkey = s_nationkey
      UNION ALL SELECT 'S' || s_suppkey, 'R' || n_regionkey, 'S' || s_suppkey || '>N' || n_nationkey || '>R' || n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def graph_path(t):
    """Customers to the suppliers they bought from, and suppliers to their region."""
    bought = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey").join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    home = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    pairs = bought.select(_id("C", "o_custkey").alias("start"), _id("S", "l_suppkey").alias("end")).unionByName(
        home.select(_id("S", "s_suppkey").alias("start"), _id("R", "n_regionkey").alias("end"))
    )
    return graph.shortest_paths(edges(t), pairs, 3).select("start", "end", F.array_join("path", ">").alias("path"))


ENTITY = "ent AS (SELECT min(item_id) AS ord, string_split(text, ' ')[1] AS id FROM benchmark GROUP BY 2)"


@query(
    "entity_mentions",
    f"""WITH {ENTITY}, h AS (SELECT DISTINCT conv_id, turn, id AS entity FROM conversations JOIN ent ON contains(lower(text), lower(id)))
      SELECT conv_id, turn, entity FROM h UNION ALL SELECT conv_id, turn, (SELECT arg_min(id, ord) FROM ent) FROM conversations ANTI JOIN h USING (conv_id, turn)""",
)
def entity_mentions(t):
    first_word = F.split("text", " ")[0]
    entities = t.benchmark.groupBy(first_word.alias("id")).agg(F.min("item_id").alias("ord"))
    asked = t.heavy("conversations", "conv_id", "turn").select(F.struct("conv_id", "turn").alias("q"), "text")
    return graph.entity_mentions(asked, "q", "text", entities).select("q.conv_id", "q.turn", "entity")


RULES = (("The", "The", True), ("Tion", "tion", False), ("Ment", "ment", False))


@query(
    "graph_build",
    """WITH h AS (SELECT contains(text, 'The') AS a, contains(lower(text), 'tion') AS b, contains(lower(text), 'ment') AS c FROM documents)
      SELECT 'The' AS source, 'Tion' AS target, 'USES' AS relation, count(*) AS texts FROM h WHERE a AND b HAVING count(*) > 0
      UNION ALL SELECT 'The', 'Ment', 'USES', count(*) FROM h WHERE a AND c HAVING count(*) > 0""",
)
def graph_build(t):
    return graph.build_graph(t.documents, "text", RULES)[1]


@query(
    "graph_nodes",
    """WITH h AS (SELECT contains(text, 'The') AS a, contains(lower(text), 'tion') AS b, contains(lower(text), 'ment') AS c FROM documents),
      n AS (SELECT 'The' AS id, count(*) FILTER (WHERE a) AS texts FROM h UNION ALL SELECT 'Tion', count(*) FILTER (WHERE b) FROM h UNION ALL SELECT 'Ment', count(*) FILTER (WHERE c) FROM h)
      SELECT id, texts, 'Concept' AS type FROM n WHERE texts > 0""",
)
def graph_nodes(t):
    return graph.build_graph(t.documents, "text", RULES)[0]
