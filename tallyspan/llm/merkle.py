"""Merkle manifest of a dataset, with a proof for every row by pointer jumping.

A row's leaf is the SHA-256 of its fields, each written with its length. The leaves of a source, by
doc_id, are hashed in runs of ``ARITY`` until one digest is left, the subroot; the subroots, by source,
likewise give the root. A row's proof holds the other digests of every run on its way to the root.

Trees are built in storeys of ``LEVELS`` levels: the ``BLOCK`` nodes below one node meet in one row,
which bounds every group, however many rows a source has. Each node then points to its parent and
holds the *segment* of siblings on that step. Self-joins double the distance: a node takes over the
pointer of the node it points to and appends that node's segment, 1, 2, 4, then 8 levels. Only
nodes that a later round starts from or points to stay in the table. Segments of whole storeys are
joined from the root downwards, so that a join key never has more than ``BLOCK`` rows on either side:
joined from the leaves upwards, all rows of a source would meet at its subroot.

A null field is written ``-``. Rows of a null source are a source of their own, before all others; a null
doc_id comes before all numbers. Rows that repeat a doc_id in a source follow the order of their leaves,
and equal rows have a leaf each. An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.ordered import number_rows
from tallyspan.storage import settle

ARITY = 3
#: A power of two.
LEVELS = 8
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one behind the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as its UTF-8 length, a colon and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a row of documents, with some fields changed."""
    return digest(*[field(changed.get(name, F.col(name))) for name in FIELDS])


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and the siblings on its path give."""
    return F.aggregate(
        path, start, lambda done, step: digest(_text(step["left"]), done, _text(step["right"]))
    )


def path_digest(path: Column) -> Column:
    """The digest of all siblings of a path, from the leaf to the root and left to right."""
    return F.sha2(
        F.array_join(F.transform(path, lambda s: F.concat(_text(s["left"]), _text(s["right"]))), ""),
        256,
    )


def _text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


class Storey(NamedTuple):
    #: (tree, block, item, segment), a row for each node of the lowest level
    jumps: DataFrame
    #: (tree, digest) of the trees that end here
    roots: DataFrame


def _levels(nodes: DataFrame) -> DataFrame:
    """A row for each block with the digests of its levels, ``l0`` upwards, and of its ``top``.

    Blocks of a tree with several of them have all levels; a tree's only block ends at one digest.
    """
    blocks = nodes.groupBy("tree", "n", F.floor(F.col("idx") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("idx", "digest", "item"))).alias("l")
    )
    blocks = blocks.select(
        "tree", "n", "block", F.transform("l", lambda x: x["item"]).alias("items"),
        F.transform("l", lambda x: x["digest"]).alias("l0"),
    )
    for level in range(LEVELS):
        here = F.col(f"l{level}")
        runs = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(here) - 1) / ARITY).cast("int")),
            lambda i: F.sha2(F.array_join(F.slice(here, i * ARITY + 1, ARITY), ""), 256),
        )
        over = (F.size(here) == 0) | ((F.col("n") <= BLOCK) & (F.size(here) == 1))
        blocks = blocks.withColumn(
            f"l{level + 1}", F.when(over, F.array().cast("array<string>")).otherwise(runs)
        )
    tops = [F.when(F.size(f"l{k}") == 1, F.col(f"l{k}")[0]) for k in range(LEVELS, -1, -1)]
    return blocks.withColumn("top", F.coalesce(*tops))


def _steps(blocks: DataFrame, item_type: str) -> DataFrame:
    """Every node of the blocks with the segment of the step to its parent."""
    def step(level: int, nodes: Column, i: Column) -> Column:
        place = i % ARITY
        side = [
            F.unhex(F.array_join(F.slice(nodes, i - place + 1, place), "")).alias("left"),
            F.unhex(F.array_join(F.slice(nodes, i + 2, ARITY - 1 - place), "")).alias("right"),
        ]
        moves = F.size(F.col(f"l{level + 1}")) > 0
        none = F.array().cast("array<struct<left:binary,right:binary>>")
        return F.struct(
            F.lit(level).alias("level"), i.alias("idx"),
            (F.col("items")[i] if level == 0 else F.lit(None).cast(item_type)).alias("item"),
            F.when(moves, F.array(F.struct(*side))).otherwise(none).alias("segment"),
        )

    def of(level: int) -> Column:
        nodes = F.col(f"l{level}")
        places = F.when(
            F.size(nodes) > 0, F.sequence(F.lit(0), F.size(nodes) - 1)
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: step(level, nodes, i))

    return blocks.select(
        "tree", "block", F.explode(F.concat(*[of(level) for level in range(LEVELS)])).alias("x")
    ).select("tree", "block", "x.*")


def _jumps(steps: DataFrame) -> DataFrame:
    """Segments of the whole storey for the nodes of its lowest level."""
    jumps, far = steps, 1
    while far < LEVELS:
        start = jumps.filter(F.col("level") % (2 * far) == 0)
        over = jumps.filter(F.col("level") % (2 * far) == far).select(
            F.col("tree").alias("_tree"), F.col("block").alias("_block"),
            F.col("level").alias("_level"), F.col("idx").alias("_idx"),
            F.col("segment").alias("_segment"),
        )
        to = [
            F.col("tree") == F.col("_tree"), F.col("block") == F.col("_block"),
            F.col("level") + far == F.col("_level"),
            F.floor(F.col("idx") / ARITY**far).cast("int") == F.col("_idx"),
        ]
        longer = F.when(F.col("_segment").isNull(), F.col("segment")).otherwise(
            F.concat("segment", "_segment")
        )
        jumps = start.join(over, to, "left").select(
            "tree", "block", "level", "idx", "item", longer.alias("segment")
        )
        far *= 2
    return jumps.select("tree", "block", "idx", "item", "segment")


def _rise(nodes: DataFrame) -> list[Storey]:
    """The storeys over ``nodes`` (tree, n nodes of it, idx from 0, digest, item)."""
    storeys = []
    while True:
        item_type = dict(nodes.dtypes)["item"]
        blocks = settle(_levels(nodes), "merkle-blocks")
        roots = blocks.filter(F.col("n") <= BLOCK).select("tree", F.col("top").alias("digest"))
        storeys.append(Storey(_jumps(_steps(blocks, item_type)), roots))
        higher = blocks.filter(F.col("n") > BLOCK)
        if higher.isEmpty():
            return storeys
        nodes = higher.select(
            "tree", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("idx"),
            F.col("top").alias("digest"), F.lit(None).cast(item_type).alias("item"),
        )


def _descend(storeys: list[Storey], ends: DataFrame) -> DataFrame:
    """The lowest nodes' items, each with its path and the other columns of its tree's end.

    ``ends``: (tree, path from its root on, ...), a row for each tree.
    """
    given = [c for c in ends.columns if c not in ("tree", "path")]
    above = None
    for place, storey in reversed(list(enumerate(storeys))):
        last = storey.roots.select("tree").join(ends, "tree").select(
            F.col("tree").alias("_tree"), F.lit(0).cast("long").alias("_block"), "path", *given
        )
        if above is not None:
            last = last.union(above.select("tree", "idx", "path", *given))
        joined = storey.jumps.join(
            last, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_block"))
        ).select(
            "tree", (F.col("block") * BLOCK + F.col("idx")).alias("idx"), "item",
            F.concat("segment", "path").alias("path"), *given,
        )
        above = settle(joined, "merkle-paths") if place else joined
    return above


def manifest(docs: DataFrame, **others: Column) -> DataFrame:
    """A row for each row of ``docs``: doc_id, source, leaf, subroot, root, path, and ``others``.

    ``path``: from the leaf to the root, the siblings ``left`` and ``right`` of the node in its run,
    as bytes. ``others`` are digests of the same row to be checked against the path (see ``fold``).
    """
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", leaf().alias("leaf"),
        *[c.alias(name) for name, c in others.items()],
    )
    leaves = settle(leaves, "merkle-leaves")
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.monotonically_increasing_id()]
    leaves = settle(number_rows(leaves, ["source"], order), "merkle-order")
    sources = leaves.groupBy("source").agg(F.count("*").alias("n"))
    sources = number_rows(sources, [], [F.col("source").asc_nulls_first()], "tree")
    sources = settle(sources.select("source", "n", F.col("tree") - 1), "merkle-sources").toDF(
        "source", "n", "tree"
    )
    item = F.struct("doc_id", "a.source", "leaf", *others)
    nodes = leaves.alias("a").join(
        sources.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))
    ).select(
        "tree", "n", (F.col("position") - 1).alias("idx"), F.col("leaf").alias("digest"),
        item.alias("item"),
    )
    lower = _rise(nodes)
    subroots = lower[0].roots
    for storey in lower[1:]:
        subroots = subroots.union(storey.roots)
    tops = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(sources.count()).cast("long").alias("n"),
        F.col("tree").alias("idx"), "digest", F.struct("tree", "digest").alias("item"),
    )
    upper = _rise(tops)
    root = upper[-1].roots.select(
        "tree", F.array().cast("array<struct<left:binary,right:binary>>").alias("path"),
        F.col("digest").alias("root"),
    )
    ends = _descend(upper, root).select(
        "item.tree", "path", F.col("item.digest").alias("subroot"), "root"
    )
    ends = settle(ends, "merkle-ends")
    return _descend(lower, ends).select("item.*", "subroot", "root", "path")


def verified(docs: DataFrame, tampered: Column) -> DataFrame:
    """The manifest with every row checked: rows for which ``tampered`` is true without line feeds.

    ``folded_root`` is what the row's digest, of the tampered text if so, gives with the original siblings.
    """
    without = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    rows = manifest(docs, given=leaf(text=without))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"),
        fold(F.col("given"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
