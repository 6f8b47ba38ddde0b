"""A manifest of a dataset as Merkle trees: one per group of rows, and one over the groups' roots.

Every leaf is a row's digest, every node the digest of a run of ``fanout`` nodes, the last run of a level
being whatever is left. Rows are numbered over all partitions and dealt to blocks of ``fanout ** levels``
consecutive leaves. A block's subtree is built in one task. Above, blocks climb together by a
butterfly exchange: in each round aligned groups of ``fanout`` subtrees swap their roots, every block
taking from the block at its own place in each other subtree (or that subtree's last one), so that all
blocks of a group know, and each for itself computes, the node above. After as many rounds as the tree
has levels left every block holds its upper proof, and nothing has to be handed down.

A proof is a list of steps from the leaf up. A step is the run's digests in order, with ``*`` where
the node itself stands, so the node above is the digest of the step with the node put in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import chunks, columns, in_small_batches, pick, staged

FANOUT = 2
#: Levels of the tree within a block: 4096 leaves with a fanout of 2.
BLOCK_LEVELS = 12
SELF = "*"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, so that fields cannot run into each other."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(
        F.octet_length(text).cast("string"), F.lit(":"), text))


def height(n: int, fanout: int) -> int:
    """Levels above n leaves."""
    found = 0
    while n > 1:
        n, found = -(-n // fanout), found + 1
    return found


def climbed(nodes: Sequence[str], fanout: int, levels: int) -> tuple[list[list[str]], str]:
    """Steps of every node on every level, and the digest at the top."""
    steps: list[list[str]] = []
    for _ in range(levels):
        runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        steps.append(["".join([*run[:j], SELF, *run[j + 1:]]) for run in runs for j in range(len(run))])
        nodes = [hashlib.sha256("".join(run).encode()).hexdigest() for run in runs]
    return steps, nodes[0]


def numbered(nodes: DataFrame, size: int) -> DataFrame:
    """Nodes (tree, label, key, row, digest, claimed) with their position in their tree, by label, key and
    digest, the number ``n`` of its nodes, and their block of ``size``.

    Rows are sorted by range over all partitions, so a tree of any size spreads over many; ``row``
    spreads equal rows. Positions follow from the counts per partition and tree, of which there
    are no more than partitions and trees together.
    """
    order = ["tree", "label", "key", "digest", "row"]
    rows = staged(nodes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "place", F.monotonically_increasing_id()), "numbered").withColumn("part", F.shiftright("place", 33))
    counts = rows.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("tree").orderBy("part")) - F.col("rows")
    shifts = counts.select("tree", "part", (F.col("first") - before).alias("shift"),
                           F.sum("rows").over(Window.partitionBy("tree")).alias("n"))
    return rows.join(shifts, ["tree", "part"]).withColumn(
        "position", F.col("place") - F.col("shift")).select(
        "tree", "label", "key", "digest", "claimed", "n", "position",
        F.floor(F.col("position") / size).alias("block"))


def by_block(df: DataFrame) -> DataFrame:
    """Blocks whole in a task, their rows in order."""
    return in_small_batches(df).repartition("tree", "block").sortWithinPartitions("tree", "block", "position")


def rows_of_blocks(batches: Iterable[pa.RecordBatch], names: Sequence[str]) -> Iterator[list[tuple]]:
    """The rows of one block at a time; the first two names are tree and block."""
    rows = (row for batch in chunks(batches, 4096) for row in zip(*columns(batch, *names), strict=True))
    for _, block in groupby(rows, itemgetter(0, 1)):
        yield list(block)


def inner_levels(n: int, fanout: int, levels: int) -> int:
    """Levels built inside a block of a tree of n leaves: up to the root if the tree is one block."""
    return levels if n > fanout ** levels else height(n, fanout)


def subtrees(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Per block: the digest of its subtree, the number of blocks of its tree, and no steps yet."""
    names, size = ("tree", "block", "n", "digest"), fanout ** levels
    out = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("blocks", pa.int64()), ("digest", pa.string())])

    def built(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in rows_of_blocks(batches, names):
            tree, place, n, _ = block[0]
            _, top = climbed([row[3] for row in block], fanout, inner_levels(n, fanout, levels))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((tree, place, -(-n // size), top), out, strict=True)], schema=out)

    return by_block(nodes.select(*names, "position")).mapInArrow(
        built, "tree string, block long, blocks long, digest string").withColumn(
        "steps", F.expr("CAST(array() AS array<string>)"))


def swapped(blocks: DataFrame, width: int, fanout: int) -> DataFrame:
    """One round: blocks whose subtrees are ``width`` blocks wide take the roots of the other subtrees
    of their group, each from one block there, and compute the node above for themselves."""
    asking = blocks.withColumn("child", F.floor(F.col("block") / width) % fanout)
    others = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda j: F.struct(
            j.cast("long").alias("of"),
            (F.col("block") - F.col("block") % (width * fanout) + j * width).alias("start"))),
        lambda x: (x["of"] != F.col("child")) & (x["start"] < F.col("blocks")))
    asked = asking.where(F.col("blocks") > width).select(
        "tree", "block", F.col("block").alias("asking"), "blocks", F.inline(others)).select(
        "tree", "block", "of",
        F.least(F.col("start") + F.col("block") % width, F.col("blocks") - 1).alias("giver"))
    given = asked.join(blocks.select("tree", F.col("block").alias("giver"), "digest"), ["tree", "giver"]).select(
        "tree", "block", "of", "digest", F.lit(None).cast("long").alias("child"),
        F.lit(None).cast("long").alias("blocks"), F.lit(None).cast("array<string>").alias("steps"))
    own = asking.select("tree", "block", F.col("child").alias("of"), "digest", "child", "blocks", "steps")
    met = own.unionAll(given).groupBy("tree", "block").agg(
        F.max("child").alias("child"), F.max("blocks").alias("blocks"), F.max("steps").alias("steps"),
        F.array_sort(F.collect_list(F.struct("of", "digest"))).alias("run"))
    step = F.array_join(F.transform("run", lambda x: F.when(
        x["of"] == F.col("child"), SELF).otherwise(x["digest"])), "")
    above = digest(F.array_join(F.transform("run", lambda x: x["digest"]), ""))
    climbs = F.col("blocks") > width
    return met.select(
        "tree", "block", "blocks", F.when(climbs, above).otherwise(F.get("run", F.lit(0))["digest"]).alias("digest"),
        F.when(climbs, F.array_append("steps", step)).otherwise(F.col("steps")).alias("steps"))


def upper_proofs(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Per block: its tree's root as ``digest`` and the steps above the block. Every round is written,
    so a lost executor costs no earlier round."""
    blocks = staged(subtrees(nodes, fanout, levels), "subtrees")
    widest = blocks.agg(F.max("blocks")).first()[0] or 0
    width = 1
    while width < widest:
        blocks = staged(swapped(blocks, width, fanout), "swapped")
        width *= fanout
    return blocks.drop("blocks")


PROVED = ("tree string, label string, key long, position long, digest string, claimed string, "
          "subroot string, root string, proof array<string>")


def whole_proofs(nodes: DataFrame, heads: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Every node with its proof: the steps inside its block, then those of its block's head (tree,
    block, steps, subroot, root)."""
    leaf = ("label", "key", "n", "digest", "claimed")
    head = ("steps", "subroot", "root")
    names = ("tree", "block", "position", *leaf, *head)
    kinds = {f.name: f.dataType for df in (nodes, heads) for f in df.schema.fields}
    texts = pa.string()
    out = pa.schema([("tree", texts), ("label", texts), ("key", pa.int64()), ("position", pa.int64()),
                     ("digest", texts), ("claimed", texts), ("subroot", texts), ("root", texts),
                     ("proof", pa.list_(texts))])
    rows = nodes.select("tree", "block", "position", *leaf, *[
        F.lit(None).cast(kinds[c]).alias(c) for c in head]).unionAll(
        heads.select("tree", "block", F.lit(-1).cast("long").alias("position"), *[
            F.lit(None).cast(kinds[c]).alias(c) for c in leaf], *head))

    def proved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (*_, upper, subroot, root), *block in rows_of_blocks(batches, names):
            tree, n = block[0][0], block[0][5]
            steps, _ = climbed([row[6] for row in block], fanout, inner_levels(n, fanout, levels))
            widths = [fanout ** level for level in range(len(steps))]
            proofs = [[level[i // w] for level, w in zip(steps, widths, strict=True)] + upper
                      for i in range(len(block))]
            made = ([tree] * len(block), *([row[i] for row in block] for i in (3, 4, 2, 6, 7)),
                    [subroot] * len(block), [root] * len(block), proofs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(made, out, strict=True)], schema=out)

    return by_block(rows).mapInArrow(proved, PROVED)


def manifest(rows: DataFrame, fields: Sequence[str], group: str, order: str,
             claims: Mapping[str, Column] | None = None, fanout: int = FANOUT,
             levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per input row: ``order`` (a long), ``position`` in its group, ``leaf``, ``subroot``,
    ``root``, ``proof``, and ``claimed``, the leaf of the row with ``claims`` in place of its fields.

    A leaf covers the ``fields``, among them ``group`` and ``order``. Nulls are told from empty texts.
    Groups ascend bytewise, the null group first; within one, rows ascend by ``order``, nulls first,
    equal ones by their leaves; of equal rows any comes first, and they have proofs of their own. Other columns
    may have any names. No row in, no row out. Of the texts only digests are shuffled.
    """
    picked = pick(rows, **{name: name for name in fields}).withColumn(order, F.col(order).cast("long"))

    def leaf(changed: Mapping[str, Column]) -> Column:
        return digest(F.concat(*[field(changed.get(name, F.col(name))) for name in fields]))

    # The null group's name comes before all others, which begin with a sign of their own.
    tree = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    leaves = staged(picked.select(
        tree.alias("tree"), F.lit(None).cast("string").alias("label"), F.col(order).alias("key"),
        F.monotonically_increasing_id().alias("row"), leaf({}).alias("digest"),
        leaf(claims or {}).alias("claimed")), "leaves")
    size = fanout ** levels
    leaves = numbered(leaves, size)
    blocks = staged(upper_proofs(leaves, fanout, levels), "upper")
    groups = numbered(blocks.groupBy("tree").agg(F.max("digest").alias("digest")).select(
        F.lit("").alias("tree"), F.col("tree").alias("label"), F.lit(None).cast("long").alias("key"),
        F.lit(0).cast("long").alias("row"), "digest", F.col("digest").alias("claimed")), size)
    tops = upper_proofs(groups, fanout, levels)
    proved = whole_proofs(groups, tops.select("tree", "block", "steps", F.col("digest").alias("subroot"),
                                              F.col("digest").alias("root")), fanout, levels)
    heads = staged(blocks.join(proved.select(F.col("label").alias("tree"), "root", "proof"), "tree").select(
        "tree", "block", F.concat("steps", "proof").alias("steps"), F.col("digest").alias("subroot"), "root"), "heads")
    return whole_proofs(leaves, heads, fanout, levels).select(
        F.col("key").alias(order), "position", F.col("digest").alias("leaf"), "subroot", "root", "proof", "claimed")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: digest(F.replace(step, F.lit(SELF), node)))


def siblings(proof: Column) -> Column:
    """The digests that a proof holds, as one text."""
    return F.replace(F.array_join(proof, ""), F.lit(SELF), F.lit(""))


def verified(found: DataFrame, order: str) -> DataFrame:
    """Of ``manifest``: each row's digests, and whether the claimed leaf folds to the root."""
    return found.select(
        order, "leaf", "subroot", "root", digest(siblings(F.col("proof"))).alias("proof_sha256"),
        folded(F.col("claimed"), F.col("proof")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
