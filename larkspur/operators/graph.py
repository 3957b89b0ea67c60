"""Property-graph operators over ``nodes(id, type)`` and ``edges(ord, source, target, relation)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.operators.ordered import first_n
from larkspur.session import cut_lineage

# Entities found in a text as (id, needle, case-sensitive), and the relation from the first to the others.
ENTITY_RULES = (("RAG", "RAG", True), ("Retrieval", "retrieval", False), ("Generation", "generation", False))
RELATION = "USES"


def undirected(edges: DataFrame) -> DataFrame:
    """Each edge from both ends; a loop once."""
    forward = edges.select("ord", F.col("source").alias("a"), F.col("target").alias("b"))
    back = edges.where(F.col("source") != F.col("target")).select(
        "ord", F.col("target").alias("a"), F.col("source").alias("b")
    )
    return forward.unionByName(back)


def neighbors(nodes: DataFrame, edges: DataFrame, starts: DataFrame, depth: int = 1) -> DataFrame:
    """Nodes within ``depth`` steps of each start; from two steps on a start may meet itself.

    Every level is deduplicated before the next join, so a level holds each
    (start, node) once.
    """
    links = undirected(edges).select("a", "b").distinct()
    level = starts.select(F.col("id").alias("start"), F.col("id").alias("node")).distinct()
    found = None
    for _ in range(depth):
        level = level.join(links, F.col("node") == F.col("a")).select("start", F.col("b").alias("node")).distinct()
        found = level if found is None else found.unionByName(level)
    return found.distinct().join(nodes, F.col("node") == F.col("id")).select("start", "id", "type")


def relations_of(edges: DataFrame) -> DataFrame:
    """(node, neighbor, relation) with ``inverse_`` relations for incoming edges."""
    out = edges.select(F.col("source").alias("node"), F.col("target").alias("neighbor"), "relation")
    back = edges.where(F.col("source") != F.col("target")).select(
        F.col("target").alias("node"),
        F.col("source").alias("neighbor"),
        F.concat(F.lit("inverse_"), "relation").alias("relation"),
    )
    return out.unionByName(back)


def subgraph_lines(nodes: DataFrame, edges: DataFrame, entities: DataFrame) -> DataFrame:
    """Text lines of each entity's surroundings as rows (entity, ord, line); ord -1 is the heading.

    A hub has as many lines as edges, so they stay rows; order by ord to print.
    """
    types = nodes.select("id", "type")
    wanted = entities.select(F.col("id").alias("entity")).distinct()
    heads = wanted.join(types, F.col("entity") == F.col("id")).select(
        "entity", F.lit(-1).cast("bigint").alias("ord"), F.format_string("Entity: %s (%s)", "id", "type").alias("line")
    )
    out = edges.select(
        F.col("source").alias("entity"), "ord", F.col("target").alias("other"), F.concat(F.lit("  -"), "relation", F.lit("-> ")).alias("arrow")
    )
    back = edges.where(F.col("source") != F.col("target")).select(
        F.col("target").alias("entity"), "ord", F.col("source").alias("other"), F.concat(F.lit("  <-"), "relation", F.lit("- ")).alias("arrow")
    )
    lines = (
        out.unionByName(back)
        .join(wanted, "entity", "left_semi")
        .join(types, F.col("other") == F.col("id"))
        .select("entity", "ord", F.concat("arrow", F.format_string("%s (%s)", "id", "type")).alias("line"))
    )
    return heads.unionByName(lines)


def shortest_paths(edges: DataFrame, pairs: DataFrame, max_hops: int = 3) -> DataFrame:
    """Shortest undirected path of each (start, end) within ``max_hops`` edges, ties by edge order.

    The last two steps are never walked forward: a path of h edges needs a node
    next to the end, so candidates meet the end's neighbours and the one edge
    between is an equi-join on both its ends. A hub is thus not expanded for the
    step into or out of it. Pairs found drop out before the next length.
    """
    links = undirected(edges)
    step = links.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("ord").alias("o"))
    step = step.groupBy("x", "y").agg(F.min("o").alias("o"))
    # One edge: the join takes the shuffle of the distinct pairs. Read by every length below, so it is written once.
    direct = step.select(F.col("x").alias("start"), F.col("y").alias("end"), "o")
    todo = cut_lineage(pairs.select("start", "end").distinct().join(direct, ["start", "end"], "left"), "pairs")
    done = todo.where(F.col("start") == F.col("end")).select("start", "end", F.array("start").alias("path"))
    todo = todo.where(F.col("start") != F.col("end"))
    if max_hops < 1:
        return done
    done = done.unionByName(todo.where(F.col("o").isNotNull()).select("start", "end", F.array("start", "end").alias("path")))
    todo = todo.where(F.col("o").isNull()).select("start", "end")
    last = step.select(F.col("x").alias("near"), F.col("y").alias("end"), F.col("o").alias("o_end"))
    walks = None
    for hops in range(2, max_hops + 1):
        # Paths and edge orders are put together where a path is found, not carried by every pair.
        if hops == 2:
            met = todo.join(last, "end").join(step.select(F.col("x").alias("start"), F.col("y").alias("near"), "o"), ["start", "near"])
            hit = met.where(F.col("near") != F.col("start")).select(
                "start", "end", F.array("start", "near", "end").alias("path"), F.array("o", "o_end").alias("ords")
            )
        else:
            # Walks from the start that avoid repeating a node; one best walk per pair and node.
            walks = _begun(todo, step) if walks is None else _extend(walks, step)
            middle = walks.join(last, "end").join(step, (F.col("at") == F.col("x")) & (F.col("near") == F.col("y")))
            hit = middle.where(~F.array_contains("path", F.col("near"))).select(
                "start",
                "end",
                F.concat("path", F.array("near", "end")).alias("path"),
                F.concat("ords", F.array("o", "o_end")).alias("ords"),
            )
        best = hit.groupBy("start", "end").agg(F.min_by("path", "ords").alias("path"))
        found = cut_lineage(best, "paths")
        done = done.unionByName(found)
        if hops < max_hops:
            rest = todo if walks is None else walks
            rest = rest.join(found.select("start", "end"), ["start", "end"], "left_anti")
            todo, walks = (rest, None) if walks is None else (todo, rest)
    return done


def _begun(todo: DataFrame, step: DataFrame) -> DataFrame:
    """Walks of one edge."""
    first = step.select(F.col("x").alias("start"), F.col("y").alias("at"), "o")
    return (
        todo.join(first, "start")
        .where(F.col("at") != F.col("start"))
        .select("start", "end", "at", F.array("start", "at").alias("path"), F.array("o").alias("ords"))
    )


def _extend(walks: DataFrame, step: DataFrame) -> DataFrame:
    """Walks one edge longer. Several may meet in a node: the first in edge order stays."""
    longer = (
        walks.join(step, F.col("at") == F.col("x"))
        .where(~F.array_contains("path", F.col("y")))
        .select("start", "end", F.col("y").alias("at"), F.concat("path", F.array("y")).alias("path"), F.concat("ords", F.array("o")).alias("ords"))
    )
    return first_n(longer, ["start", "end", "at"], [F.col("ords")], 1)


SEED = 4


def _grams(word, sizes=range(1, SEED + 1)):
    """Distinct character n-grams of a word."""
    chars = F.split(word, "")

    def of(n: int):
        starts = F.when(F.size(chars) >= n, F.sequence(F.lit(0), F.size(chars) - n))
        pieces = F.transform(starts, lambda i: F.concat(*[F.get(chars, i + j) for j in range(n)]))
        return F.coalesce(pieces, F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of(n) for n in sizes]))


def entity_mentions(questions: DataFrame, key: str, text: str, entities: DataFrame) -> DataFrame:
    """Entities whose id occurs in the question, case-folded; a question without any gets the first entity.

    ``entities``: ord, id. The longest blank-free part of an id lies inside one
    word of any text that holds the id. So the distinct words of all questions
    meet the entities, by the first characters of that part among the word's
    n-grams; the matches go back to the questions by word. Only an id with blanks
    still needs a look at the text.
    """
    parts = F.transform(tx.words(F.lower("id")), lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))
    ids = entities.select(F.col("id").alias("entity"), F.lower("id").alias("__id"), F.array_min(parts)["w"].alias("__part"))
    seeded = ids.where(F.col("__part").isNotNull()).withColumn("__seed", F.substring("__part", 1, SEED))
    folded = questions.select(key, F.lower(text).alias("__text"))
    worded = folded.select(key, F.explode(F.array_distinct(tx.words(F.col("__text")))).alias("__word"))
    matched = (
        worded.select("__word")
        .distinct()
        .select("__word", F.explode(_grams(F.col("__word"))).alias("__gram"))
        .join(seeded, F.col("__gram") == F.col("__seed"))
        .where(F.col("__word").contains(F.col("__part")))
        .select("__word", "entity", "__id", (F.col("__id") == F.col("__part")).alias("__sure"))
    )
    candidates = worded.join(matched, "__word").select(key, "entity", "__id", "__sure").distinct()
    sure = candidates.where("__sure").select(key, "entity")
    checked = candidates.where(~F.col("__sure")).join(folded, key).where(F.col("__text").contains(F.col("__id")))
    found = sure.unionByName(checked.select(key, "entity"))
    first = entities.agg(F.min_by("id", "ord")).scalar()
    missing = questions.select(key).join(found.select(key), key, "left_anti").withColumn("entity", first)
    return found.unionByName(missing)


def build_graph(docs: DataFrame, text: str, rules=ENTITY_RULES, relation: str = RELATION) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) found by rules; the first rule's entity points to the others of the same text."""
    hit = {
        name: (F.col(text).contains(needle) if exact else F.lower(text).contains(needle.lower())) for name, needle, exact in rules
    }
    names = F.array_compact(F.array(*[F.when(h, F.lit(n)) for n, h in hit.items()]))
    found = docs.select(names.alias("__names"))
    nodes = found.select(F.explode("__names").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("texts"))
    hub = rules[0][0]
    targets = F.when(F.array_contains("__names", hub), F.array_remove("__names", hub))
    edges = (
        found.select(F.explode(targets).alias("target"))
        .groupBy(F.lit(hub).alias("source"), "target", F.lit(relation).alias("relation"))
        .agg(F.count(F.lit(1)).alias("texts"))
    )
    return nodes.withColumn("type", F.lit("Concept")), edges
