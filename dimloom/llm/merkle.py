"""Merkle manifest of a document table, by lag and lead windows.

A leaf is the digest of a row. Per source the leaves ascend by ``doc_id``; every
three neighbours hash to their parent until one node, the source's subroot,
remains; the subroots, ordered by source, hash to the root likewise.

Nodes are numbered densely (``i``) within their tree and cut into blocks of
``BLOCK`` = 3 ** ``LEVELS`` of them, so that no run of three is cut. One shuffle by
(tree, block) serves ``LEVELS`` levels: on level l a node lies on the row of its
first descendant, its siblings at the fixed offsets 3 ** l and 2 * 3 ** l before
and behind, as ``lag`` and ``lead`` columns masked by the node's slot and its run's
length; the rows of first children hash the parents. The block's top nodes, a
2,187th of the rows, are the next round's input. No task holds more than a block
of a tree at once, however many rows a source has.

Edge cases: a null source is a tree of its own, before all others; a null
``doc_id`` comes first in its source and is never tampered with; rows with equal
``doc_id`` are ordered by their leaf, so repeated rows give the same rows out;
null or empty texts are hashed as the contract says; of an empty table nothing
comes back; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimloom.operators.ids import materialize, with_dense_ids

ARITY = 3
LEVELS = 7
BLOCK = ARITY ** LEVELS
#: Rows a numbering task sorts.
ROWS = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated texts."""
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """The digest of a row, or of the row with another text."""
    return digest(*[framed(text if text is not None and f == "text" else F.col(f)) for f in FIELDS])


def _path(steps: list[Column]) -> Column:
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def _grown(nodes: DataFrame) -> DataFrame:
    """One round: ``nodes`` (tree, i, n, node, ...) with ``block``, the block's top digest and its place, and each row's ``path``.

    ``path`` holds, for each level with a parent, the siblings' digests before and
    behind the row's ancestor there, as (l, r). The top is on the block's first row (null elsewhere).
    """
    rows = Window.partitionBy("tree", "block").orderBy("i")
    df = nodes.withColumns({"block": F.floor(F.col("i") / BLOCK), "d0": F.col("node")})
    names = df.columns
    for level in range(LEVELS):
        width = ARITY ** level
        d, here = F.col(f"d{level}"), F.col("i") % width == 0
        place = F.floor(F.col("i") / width)
        slot, total = place % ARITY, F.ceil(F.col("n") / width)
        run = F.least(F.lit(ARITY), total - place + slot)

        def near(k: int, d=d, width=width, slot=slot, run=run) -> Column:
            """The digest k slots on, or an empty text outside of the run."""
            moved = F.lag(d, -k * width).over(rows) if k < 0 else F.lead(d, k * width).over(rows)
            return F.when((slot + k >= 0) & (slot + k < run), moved).otherwise("")

        df = df.withColumns({"b2": near(-2), "b1": near(-1), "f1": near(1), "f2": near(2)})
        before, behind = F.concat("b2", "b1"), F.concat("f1", "f2")
        step = F.when(here & (total > 1), F.struct(before.alias("l"), behind.alias("r")))
        parent = F.when(total > 1, digest(d, behind)).otherwise(d)
        df = df.select(*names, step.alias(f"s{level}"), F.when(here & (slot == 0), parent).alias(f"d{level + 1}"))
        names = df.columns
    # a step lies on the row of the ancestor's first descendant; the block's rows before a row hold it last
    upto = rows.rowsBetween(Window.unboundedPreceding, 0)
    steps = {f"s{k}": F.when(F.ceil(F.col("n") / ARITY ** k) > 1, F.last(f"s{k}", ignorenulls=True).over(upto)) for k in range(LEVELS)}
    df = df.withColumns(steps).withColumns({"path": _path([F.col(f"s{k}") for k in range(LEVELS)]), "top": F.col(f"d{LEVELS}")})
    return df.drop(*[f"s{k}" for k in range(LEVELS)], *[f"d{k}" for k in range(LEVELS + 1)], "node")


def grow(nodes: DataFrame, largest: int) -> DataFrame:
    """``nodes`` (tree, i, n, node, ...) with ``path``, all the way up, and the tree's ``top``.

    ``n`` is the tree's number of nodes, ``largest`` the greatest n. Blocks of a
    tree have their own round, and so on; each is a 2,187th of the one below.
    """
    grown = _grown(nodes)
    if largest <= BLOCK:  # one block a tree: its first row holds the top
        return grown.withColumn("top", F.first("top").over(Window.partitionBy("tree", "block").orderBy("i"))).drop("block")
    above = grown.where(F.col("i") % BLOCK == 0).select(
        "tree", F.col("block").alias("i"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("node"))
    higher = grow(materialize(above, "merkle-blocks"), -(-largest // BLOCK)).select(
        "tree", F.col("i").alias("block"), F.col("path").alias("rest"), "top")
    out = grown.drop("top").join(higher, ["tree", "block"])
    return out.withColumn("path", F.concat("path", "rest")).drop("block", "rest")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, start, lambda h, s: digest(s["l"], h, s["r"]))


def proof(path: Column) -> Column:
    """The digest of a path's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""), 256)


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, path, offered): a row a document.

    ``path`` holds the siblings (l, r) from leaf to root. ``offered`` is the leaf of
    the row with text ``changed``, or the leaf.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))  # null first, then bytewise
    rows = docs.select("doc_id", "source", key.alias("tree"), leaf().alias("node"),
                       (leaf(changed) if changed is not None else leaf()).alias("offered"))
    rows = with_dense_ids(rows, ["tree", "doc_id", "node", "offered"], "place", rows_per_bucket=ROWS)
    trees = materialize(rows.groupBy("tree").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), "merkle-trees")
    largest, count = trees.agg(F.coalesce(F.max("n"), F.lit(0)), F.count(F.lit(1))).first()
    leaves = rows.join(trees, "tree").withColumn("i", F.col("place") - F.col("first")).drop("place", "first")
    grown = grow(leaves.withColumn("leaf", F.col("node")), largest).withColumnRenamed("top", "subroot")
    # the subroots, from the first row of each tree, make the upper tree
    tops = with_dense_ids(materialize(grown.where("i = 0").select("tree", F.col("subroot").alias("node")), "merkle-subroots"), ["tree"], "place", rows_per_bucket=ROWS)
    upper = tops.select(F.lit("").alias("tree"), (F.col("place") - 1).alias("i"), F.lit(count).alias("n"), "node", F.col("tree").alias("of"))
    upper = materialize(grow(upper, count).select(F.col("of").alias("tree"), F.col("path").alias("rest"), F.col("top").alias("root")), "merkle-root")
    return grown.join(upper, "tree").select("doc_id", "source", "leaf", "subroot", "root", F.concat("path", "rest").alias("path"), "offered")


def tampered_text() -> Column:
    """The text without line feeds where 2 divides the CRC-32 of the id."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def verified_manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    rows = manifest(docs, tampered_text())
    return rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
                       fold(F.col("offered"), F.col("path")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


#: Levels the SQL is written for: 3 ** 20 nodes a tree.
SQL_LEVELS = 20


def _levels_sql(name: str, base: str) -> str:
    """CTEs: the nodes of every level (tree, i, node), each tree's top, and each first-level node's path."""
    parts = [f"{name}0 AS MATERIALIZED (SELECT tree, i, node, count(*) OVER (PARTITION BY tree) AS n FROM {base})"]
    for k in range(SQL_LEVELS):
        parts.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM (
    SELECT tree, i // {ARITY} AS i, CASE WHEN any_value(n) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY i)) END AS node
    FROM {name}{k} GROUP BY tree, i // {ARITY}) t)""")
    # children of one run, each with its siblings before and behind
    steps = " UNION ALL ".join(
        f"""SELECT a.tree, {k} AS level, a.i, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
  coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM {name}{k} a JOIN {name}{k} b ON a.tree = b.tree AND a.i // {ARITY} = b.i // {ARITY} WHERE a.n > 1 GROUP BY a.tree, a.i""" for k in range(SQL_LEVELS))
    parts.append(f"{name}_steps AS MATERIALIZED ({steps})")
    parts.append(f"""{name}_path AS MATERIALIZED (
  SELECT a.tree, a.i, list(struct_pack(l := s.l, r := s.r) ORDER BY s.level) FILTER (s.level IS NOT NULL) AS path
  FROM {name}0 a LEFT JOIN {name}_steps s ON a.tree = s.tree AND s.i = a.i // ({ARITY} ** s.level)::BIGINT GROUP BY a.tree, a.i)""")
    return ",\n".join(parts)


def _framed_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR))::VARCHAR || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_framed_sql(text if f == "text" else f) for f in FIELDS) + ")"


def _crc_sql() -> str:
    """The lowest bit of the CRC-32 of the id's decimal text, by the bitwise rule."""
    return """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda h, z: CASE WHEN h % 2 = 1 THEN xor(h >> 1, 3988292384) ELSE h >> 1 END))"""


ORACLE = f"""
WITH rows AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf_sql('text')} AS node,
         CASE WHEN doc_id IS NOT NULL AND ({_crc_sql()}) % 2 = 1 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql('text')} END AS offered
  FROM documents),
leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node, offered) - 1 AS i FROM rows),
{_levels_sql('a', 'leaves')},
subs AS MATERIALIZED (SELECT '' AS tree, tree AS of, node, row_number() OVER (ORDER BY encode(tree)) - 1 AS i FROM a{SQL_LEVELS}),
{_levels_sql('u', 'subs')},
found AS MATERIALIZED (
  SELECT l.doc_id, l.node AS leaf, l.offered, s.node AS subroot, (SELECT node FROM u{SQL_LEVELS}) AS root,
         list_concat(coalesce(p.path, []), coalesce(q.path, [])) AS path
  FROM leaves l JOIN a_path p ON l.tree = p.tree AND l.i = p.i JOIN subs s ON s.of = l.tree JOIN u_path q ON q.i = s.i)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM (SELECT *, list_reduce(list_prepend(struct_pack(l := '', r := offered), path),
                            lambda h, s: struct_pack(l := '', r := sha256(s.l || h.r || s.r))).r AS folded_root FROM found) f"""
