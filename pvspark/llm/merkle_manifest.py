"""Merkle manifest of a dataset by cogrouped subtree exchange.

Every row is a leaf: SHA-256 over its fields. The leaves of a group (``lang``) stand in the order of their ids; every
two consecutive nodes become their hash until one is left, the group's subroot; the subroots, in the order of the
groups, become the root in the same way.

A superblock is 1024 consecutive nodes (a subtree of ``LEVELS`` levels). Going up, each superblock's leaves are
reduced to one node, the nodes are the leaves of the next tier, and so on until a group has one superblock; tiers
shrink by 1024. Going down, a superblock's rows and the outer nodes that their proofs need (siblings above the
superblock, up to the root) are cogrouped by superblock: ``applyInPandas`` finishes the local reduction, joins local
and outer siblings to each row's proof, and folds it to a root. No task sees more than a superblock, whatever
share of the rows a group has. Places in the order come from range partitions and prefix sums.

Hashes are SHA-256 of concatenated lower-case hex digests; they travel as 32 bytes.

Defined results: null ids come first in their group, equal ids are ordered by leaf, and equal leaves are interchangeable;
a null group is a group, ordered first; a field that is null is ``-``; a lone node of a level is hashed alone; a group of one
leaf has it as subroot, and one group's subroot is the root; tampering leaves null ``n_chars`` and the largest
integer as they are; further columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pvspark.llm.common import Scratch
from pvspark.operators.ranks import numbered

LEVELS = 10
TAMPER = 7
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
STEP = 33                      # bytes of a path step: side of the sibling, digest
NONE, LEFT, RIGHT = 0, 1, 2
_ALONE = bytes(STEP)


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def _leaf(**fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[_field(fields[c]) for c in FIELDS]).cast("binary"), 256))


def _hash(a: bytes, b: bytes = b"") -> bytes:
    return hashlib.sha256((a + b).hex().encode()).digest()


def reduce_block(hashes: list[bytes], total: int, most: int) -> list[list[bytes]]:
    """The levels of a superblock of a group with ``total`` nodes in this tier: ``most`` levels up to the superblock's
    node, or to the subroot if the group has no other superblock."""
    levels = [hashes]
    for _ in range(min(most, (total - 1).bit_length())):
        h = levels[-1]
        levels.append([_hash(*h[i:i + 2]) for i in range(0, len(h), 2)])
    return levels


def steps(levels: list[list[bytes]], i: int) -> bytes:
    """The path steps of node ``i`` inside its superblock."""
    out = []
    for h in levels[:-1]:
        j = i ^ 1
        out.append((bytes([LEFT if j < i else RIGHT]) + h[j]) if j < len(h) else _ALONE)
        i >>= 1
    return b"".join(out)


def fold(node: bytes, path: bytes) -> bytes:
    """The root that a node and the steps above it give."""
    for at in range(0, len(path), STEP):
        side, sibling = path[at], path[at + 1:at + STEP]
        node = _hash(sibling, node) if side == LEFT else _hash(node, sibling) if side == RIGHT else _hash(node)
    return node


def siblings(path: bytes) -> bytes:
    return b"".join(path[at + 1:at + STEP] for at in range(0, len(path), STEP) if path[at] != NONE)


def _reduce(pdf: pd.DataFrame, most: int) -> pd.DataFrame:
    pdf = pdf.sort_values("idx")
    total, width = int(pdf["n"].iloc[0]), 1 << most
    top = reduce_block(pdf["h"].tolist(), total, most)[-1][0]
    return pd.DataFrame({"g": pdf["g"].iloc[:1], "idx": pdf["idx"].iloc[:1] // width, "h": [top], "n": [-(-total // width)]})


NODE = "g long, idx long, h binary, n long"


def _up(nodes: DataFrame, most: int) -> DataFrame:
    return (nodes.select("g", "idx", "h", "n", F.shiftright("idx", most).alias("block")).groupBy("g", "block")
            .applyInPandas(lambda pdf: _reduce(pdf, most), NODE))


def climb(nodes: DataFrame, most: int, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """The tiers above ``nodes(g, idx, h, n)``, themselves first, and the groups' roots (a tier of one node each)."""
    tiers = [nodes]
    while (nodes.agg(F.max("n").alias("n")).collect()[0].n or 0) > 1 << most:
        nodes = scratch.write(_up(nodes, most), "merkle-tier")
        tiers.append(nodes)
    return tiers, scratch.write(_up(nodes, most), "merkle-roots")


def _paths(inner: pd.DataFrame, outer: pd.DataFrame, most: int) -> pd.DataFrame:
    """A tier's nodes and the outer steps of their superblock -> the steps of each node."""
    if inner.empty or outer.empty:
        return pd.DataFrame({"g": [], "block": [], "path": [], "subroot": [], "root": []})
    inner, o = inner.sort_values("idx"), outer.iloc[0]
    levels = reduce_block(inner["h"].tolist(), int(inner["n"].iloc[0]), most)
    return pd.DataFrame({"g": inner["g"], "block": inner["idx"], "path": [steps(levels, i) + o["path"] for i in range(len(inner))],
                         "subroot": [o["subroot"]] * len(inner), "root": [o["root"]] * len(inner)})


def _proofs(inner: pd.DataFrame, outer: pd.DataFrame, most: int) -> pd.DataFrame:
    """Leaves of a superblock and its outer steps -> proof, folded root and verdict of each leaf."""
    if inner.empty or outer.empty:
        return pd.DataFrame({c.split()[0]: [] for c in PROOF.split(", ")})
    inner, o = inner.sort_values("idx"), outer.iloc[0]
    leaves = inner["h"].tolist()
    levels = reduce_block(leaves, int(inner["n"].iloc[0]), most)
    paths = [steps(levels, i) + o["path"] for i in range(len(leaves))]
    folded = [fold(t if t is not None else h, p) for h, t, p in zip(leaves, inner["tampered"], paths, strict=True)]
    return pd.DataFrame({"id": inner["id"], "leaf": leaves, "subroot": [o["subroot"]] * len(leaves), "root": [o["root"]] * len(leaves),
                         "path": paths, "proof": [siblings(p) for p in paths], "folded_root": folded,
                         "verified": [f == o["root"] for f in folded]})


OUTER = "g long, block long, path binary, subroot binary, root binary"
PROOF = "id string, leaf binary, subroot binary, root binary, path binary, proof binary, folded_root binary, verified boolean"


def _down(tiers: list[DataFrame], outer: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """The outer steps of the superblocks of the lowest tier, from those of the highest one (one a group)."""
    for nodes in reversed(tiers):
        blocks = nodes.withColumn("block", F.shiftright("idx", most)).groupBy("g", "block")
        outer = scratch.write(blocks.cogroup(outer.groupBy("g", "block")).applyInPandas(lambda a, b: _paths(a, b, most), OUTER), "merkle-outer")
    return outer


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", group_col: str = "lang", chars_col: str = "n_chars",
             text_col: str = "text", levels: int = LEVELS) -> DataFrame:
    """One row per document, by superblocks of 2 ** ``levels`` nodes: doc_id, leaf, subroot, root, path (a side byte and 32 bytes a level), proof (the siblings),
    folded_root (from the tampered leaf where there is one), verified."""
    scratch = Scratch(docs.sparkSession)
    chars = F.col(chars_col).cast("bigint")
    field = {"doc_id": F.col(id_col).cast("bigint"), "source": F.col(source_col), "lang": F.col(group_col), "text": F.col(text_col)}
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % TAMPER == 0
    leaves = scratch.write(docs.select(
        F.col(group_col).alias("lang"), F.col(id_col).cast("bigint").alias("doc_id"), _leaf(n_chars=chars, **field).alias("h"),
        F.when(hit & chars.isNotNull(), _leaf(n_chars=F.coalesce(F.try_add(chars, F.lit(1).cast("bigint")), chars), **field)).alias("tampered"),
        F.monotonically_increasing_id().alias("salt")), "merkle-leaves")      # equal leaves are spread by the salt
    langs = scratch.write(numbered(leaves.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), [F.col("lang").asc_nulls_first()],
                                   name="g", path=scratch.path("merkle-langs")), "merkle-groups")
    order = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("salt")]
    places = numbered(leaves, order, ["lang"], "idx", "n", path=scratch.path("merkle-order"))
    nodes = scratch.write(places.join(langs.select(F.col("lang").alias("l"), "g"), F.col("lang").eqNullSafe(F.col("l")))
                          .select("g", "idx", "h", "n", "tampered", F.col("doc_id").cast("string").alias("id")), "merkle-nodes")

    tiers, subroots = climb(nodes.select("g", "idx", "h", "n"), levels, scratch)
    count = langs.agg(F.count(F.lit(1)).alias("n")).collect()[0].n
    trees, root = climb(subroots.select(F.lit(0).cast("bigint").alias("g"), F.col("g").alias("idx"), "h", F.lit(count).cast("bigint").alias("n")),
                        levels, scratch)
    top = root.select("g", F.col("idx").alias("block"), F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"), F.col("h").alias("root"))
    above = _down(trees, top, levels, scratch).select(F.col("block").alias("g"), F.lit(0).cast("bigint").alias("block"), "path", "root")
    above = above.join(subroots.select("g", F.col("h").alias("subroot")), "g").select("g", "block", "path", "subroot", "root")
    outer = _down(tiers[1:], above, levels, scratch)
    blocks = nodes.withColumn("block", F.shiftright("idx", levels)).groupBy("g", "block")
    out = scratch.keep(blocks.cogroup(outer.groupBy("g", "block")).applyInPandas(lambda a, b: _proofs(a, b, levels), PROOF), "merkle-proofs")
    scratch.clear()
    return out.select(F.col("id").cast("bigint").alias("doc_id"), "leaf", "subroot", "root", "path", "proof", "folded_root", "verified")
