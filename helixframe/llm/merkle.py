"""Merkle manifest of a table: checkpointed levels, proofs by recomputing what lies between.

Rows become leaves, leaves of one source a tree of runs of three, and the sources' roots one
tree more. Only every ``STORED_EVERY``-th level is persisted, cut into its aligned subtrees of
``FAN ** STORED_EVERY`` nodes, one row each. Extracting proofs goes down from the root: each
stored subtree regenerates its missing interior nodes from its stored nodes, every node takes
its siblings from them behind the path of the subtree's own root, and the interior nodes are
gone with the row. So no shuffle carries more than one path per subtree, and texts are read
once, for their digests.

Leaves are ranked within their source by a range sort and the counts of its partitions; a
source of any share of all rows is spread over many tasks, and nothing is gathered but 27
nodes of one subtree. Nulls are ``-`` in a leaf. A null source comes first, and so does a null
id within its source; rows of one id are ordered by their leaf, so repeated rows each have a
place and reruns agree. Empty and very long texts are hashed like others, a text as one value
of its row. An empty table has no leaves and no root. Columns besides the five hashed ones are
not read and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import own_columns, written
from helixframe.session import small

FAN = 3
STORED_EVERY = 3
SUBTREE = FAN**STORED_EVERY
HASHED = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*inputs: Column) -> Column:
    """Lowercase hex SHA-256 of the inputs' texts, one behind the other."""
    return F.sha2(F.concat(*inputs), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value; no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**replaced: Column) -> Column:
    """The leaf of a row; keyword arguments stand in for columns of the same name."""
    return digest(*[encoded(replaced.get(c, F.col(f"`{c}`"))) for c in HASHED])


def _group(source: Column) -> Column:
    """Source as text that orders nulls first and joins like any other value."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def ranked(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """Adds ``at``, the place of a row within its ``grp`` from 0, and ``members``, the group's rows.

    Rows are dealt by ranges of (group, order), so equal keys of one group are the most that
    must meet in a task; places follow from row counts of (partition, group).
    """
    keys = [F.col("grp"), *[F.col(c).asc_nulls_first() for c in order]]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = written(dealt.withColumn("row", F.monotonically_increasing_id()), f"merkle-{name}")
    part = F.call_function("shiftright", F.col("row"), F.lit(33))
    runs = numbered.groupBy("grp", part.alias("part")).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("grp")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.select(
        "grp", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("members"),
    )
    offsets = small(written(placed, f"merkle-{name}-runs"))
    joined = numbered.withColumn("part", part).join(offsets, ["grp", "part"])
    return joined.withColumn("at", F.col("row") + F.col("shift")).drop("row", "part", "shift")


def _depth(members: Column) -> Column:
    """Levels above ``members`` nodes until one remains, at most ``STORED_EVERY``."""
    steps = F.lit(STORED_EVERY)
    for level in reversed(range(STORED_EVERY)):
        steps = F.when(members <= FAN**level, F.lit(level)).otherwise(steps)
    return steps


def _up(nodes: Column) -> Column:
    """The next level: every run of ``FAN`` nodes, the last one shorter, becomes its digest."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.concat_ws("", F.slice(nodes, i * FAN + 1, F.lit(FAN))), 256))


def _regenerated(subtrees: DataFrame) -> DataFrame:
    """Stored subtrees with their interior levels ``level0`` .. and their ``top`` digest.

    The levels are columns of their own, each made once from the one below.
    """
    out = subtrees.withColumn("level0", F.col("nodes.hash"))
    for k in range(1, STORED_EVERY + 1):
        out = out.withColumn(f"level{k}", F.when(F.col("steps") >= k, _up(F.col(f"level{k - 1}"))))
    tops = F.array(*[F.get(F.col(f"level{k}"), F.lit(0)) for k in range(STORED_EVERY + 1)])
    return out.withColumn("top", F.get(tops, F.col("steps")))


@dataclass(frozen=True)
class Tree:
    """The stored levels of one tree per group, and the groups' roots.

    ``levels[k]`` holds the nodes of level ``k * STORED_EVERY`` in aligned subtrees: ``grp``,
    ``at`` (the subtree's number), ``members`` (nodes of the group's level), ``steps`` and
    ``nodes``. ``lone`` has the nodes of groups of one, which no subtree holds. ``roots`` has
    ``grp``, ``hash`` and ``height``, the number of stored levels below the root.
    """

    levels: tuple[DataFrame, ...]
    lone: DataFrame
    roots: DataFrame


def _node_fields(nodes: DataFrame) -> list[str]:
    return ["at", "hash", *[c for c in nodes.columns if c not in ("grp", "at", "hash", "members")]]


def build_tree(nodes: DataFrame, name: str) -> Tree:
    """Trees over ``nodes`` (``grp``, ``at``, ``hash``, ``members``, and columns to carry)."""
    lone = nodes.where("members = 1")
    roots = [lone.select("grp", "hash", F.lit(0).alias("height"))]
    levels: list[DataFrame] = []
    left = nodes.agg(F.max("members")).first()[0] or 0
    current = nodes
    while left > 1:
        several = current.where("members > 1")
        subtree = F.floor(F.col("at") / SUBTREE).cast("long").alias("number")
        grouped = several.groupBy("grp", "members", subtree).agg(
            F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in _node_fields(current)]))).alias("nodes")
        )
        level = written(
            grouped.select("grp", F.col("number").alias("at"), "members", _depth(F.col("members")).alias("steps"), "nodes"),
            f"merkle-{name}-{len(levels)}",
        )
        levels.append(level)
        above = F.ceil(F.col("members") / SUBTREE).cast("long")
        current = _regenerated(level).select("grp", "at", F.col("top").alias("hash"), above.alias("members"))
        roots.append(current.where("members = 1").select("grp", "hash", F.lit(len(levels)).alias("height")))
        left = -(-left // SUBTREE)
    merged = roots[0]
    for more in roots[1:]:
        merged = merged.unionByName(more)
    return Tree(tuple(levels), lone, written(merged, f"merkle-{name}-roots"))


def _siblings(at: Column) -> Column:
    """Per level of a subtree, the digests left and right of the run's node above node ``at``."""

    def step(k: int) -> Column:
        level, place = F.col(f"level{k}"), F.floor(at / FAN**k).cast("int")
        first = place - place % FAN
        return F.struct(
            F.concat_ws("", F.slice(level, first + 1, place % FAN)).alias("left"),
            F.concat_ws("", F.slice(level, place + 2, first + F.lit(FAN - 1) - place)).alias("right"),
        )

    return F.slice(F.array(*[step(k) for k in range(STORED_EVERY)]), F.lit(1), F.col("steps"))


def proofs(tree: Tree, root_paths: DataFrame) -> DataFrame:
    """The tree's first nodes, with their carried columns and ``path`` up to the last root.

    ``root_paths`` (``grp``, ``path``) continues above the roots of the groups. A path has one
    (``left``, ``right``) pair of sibling texts per level.
    """
    tops = tree.roots.join(root_paths, "grp")
    paths = None
    for k in reversed(range(len(tree.levels))):
        ended = tops.where(F.col("height") == k + 1).select("grp", F.lit(0).cast("long").alias("at"), "path")
        above = ended if paths is None else ended.unionByName(paths.select("grp", "at", "path"))
        nodes = _regenerated(tree.levels[k]).join(above.withColumnRenamed("path", "above"), ["grp", "at"])
        each = nodes.select(
            "grp", "above", "steps", *[f"level{j}" for j in range(STORED_EVERY)], F.explode("nodes").alias("node")
        )
        within = F.pmod(F.col("node.at"), F.lit(SUBTREE))
        paths = each.select("grp", "node.*", F.concat(_siblings(within), "above").alias("path"))
    alone = tree.lone.join(root_paths, "grp").drop("members")
    return alone if paths is None else paths.unionByName(alone)


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(F.col(path), leaf, lambda node, s: digest(s["left"], node, s["right"]))


def path_text(path: str = "path") -> Column:
    """All sibling digests of a path, level by level, left to right."""
    return F.array_join(F.transform(F.col(path), lambda s: F.concat(s["left"], s["right"])), "")


def build_manifest(docs: DataFrame, carry: dict[str, Column] | None = None) -> tuple[Tree, Tree]:
    """The trees of all sources, and the tree over their roots, with their levels stored.

    ``carry`` names expressions over ``docs`` that are kept beside each leaf.
    """
    rows = own_columns(docs, *HASHED).select(
        _group(F.col("source")).alias("grp"), "doc_id", leaf_digest().alias("hash"),
        *[expression.alias(name) for name, expression in (carry or {}).items()],
    )
    leaves = ranked(written(rows, "merkle-digests"), "leaves", "doc_id", "hash")
    sources = build_tree(leaves, "source")
    places = sources.roots.select(F.lit("").alias("grp"), F.col("grp").alias("source_grp"), "hash")
    return sources, build_tree(ranked(places, "sources", "source_grp"), "all")


def manifest_proofs(docs: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``path`` and what was carried."""
    sources, top = build_manifest(docs, carry)
    start = top.roots.select("grp", F.expr("cast(array() as array<struct<left: string, right: string>>)").alias("path"))
    upper = proofs(top, start).join(top.roots.select("grp", F.col("hash").alias("root")), "grp").select(
        F.col("source_grp").alias("grp"), F.col("hash").alias("subroot"), "root", "path"
    )
    upper = written(upper, "merkle-upper")
    rows = proofs(sources, upper.select("grp", "path")).withColumnRenamed("hash", "leaf")
    return rows.join(small(upper.drop("path")), "grp").drop("grp", "at")
