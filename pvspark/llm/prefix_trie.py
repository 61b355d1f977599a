"""Prefix trie of conversations: a z-fast trie in tables.

A conversation is a path of turns; a prefix of d turns is known by its running SHA-256 digest (root: no turns).
The trie is kept compacted: a row is a node at which a conversation ends or two of them part, with its extent (the
digest of all turns from the root), its depth, its parent's depth, and the digests of the edge between. Its
*handle* is the digest at the two-fattest depth of the edge, the depth in (parent, extent] divisible by the
largest power of two; handles are the hash table's keys.

Conversations come in batches that grow by ``GROWTH``. A batch is located by fat binary search: with the matched
depth a and the bound b, the digest at the two-fattest depth of (a, b] is looked up; a node whose extent the
conversation has moves a to its depth, a miss moves b below the probe. After about log2(length) lookups the first turn
beyond a names the exit node, whose edge tells how far the match goes. Edges are cut where conversations leave them,
and below their exits only the new turns are compared, combined map-side: a prefix that many conversations share is
in the trie since an early batch, so later batches bring rare prefixes only. Equal conversations are one path with a
count. Hot handles are split by Spark's skew join, whose other side has one row a handle.

Sums over subtrees are taken on compacted nodes by pointer doubling: a round adds the sums of all nodes whose pointer
leads here and doubles pointers, so deep tries take log2(depth) rounds. Edges are expanded at the end.

Defined results: null role and text are empty; turns are ordered null first, equal numbers by role, then by digest; rows without
conv_id are one conversation that takes nothing from another, its id ordered last and written ``null``; a conversation's turns
are held by one task as 40 bytes each, its text is not; c % 100 has the sign of c; further columns are ignored; no rows
give no rows, not even the root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pvspark.llm.common import Scratch

HEAD = 6                       # a conversation takes 0 to HEAD - 1 turns from another
FAMILY = 100
FIRST, GROWTH = 4_000, 8       # conversations in the first batch; factor of the next ones
ROOT = hashlib.sha256(b"").digest()
NODE = ("ext binary, par binary, first binary, handle binary, lo int, hi int, edge array<binary>, cum array<bigint>")


def _chains(batches):
    """conv_id, digests and code points of the turns -> conv_id, sid, m, ph (digest of each prefix), cum (code points)."""
    schema = pa.schema([("conv_id", pa.int64()), ("sid", pa.binary()), ("m", pa.int32()), ("ph", pa.list_(pa.binary())),
                        ("cum", pa.list_(pa.int64()))])
    for batch in batches:
        paths, sums = [], []
        for digests, chars in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            path, total = [ROOT], [0]
            for d, n in zip(digests, chars, strict=True):
                path.append(hashlib.sha256(path[-1] + d).digest())
                total.append(total[-1] + n)
            paths.append(path)
            sums.append(total)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p[-1] for p in paths], pa.binary()),
                                          pa.array([len(p) - 1 for p in paths], pa.int32()),
                                          pa.array(paths, pa.list_(pa.binary())), pa.array(sums, pa.list_(pa.int64()))], schema=schema)


def _end_digests(batches):
    """Rows (sid, conv_id) sorted within their partition -> one digest of the joined ids per sid, in constant memory."""
    last, h = None, None
    for batch in batches:
        sids, out = [], []
        for sid, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            conv = b"null" if conv is None else str(conv).encode()
            if sid != last:
                if h is not None:
                    sids.append(last)
                    out.append(h.hexdigest())
                last, h = sid, hashlib.sha256(conv)
            else:
                h.update(b"," + conv)
        yield pa.RecordBatch.from_arrays([pa.array(sids, pa.binary()), pa.array(out, pa.string())], ["sid", "ends_sha256"])
    if h is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([h.hexdigest()])], ["sid", "ends_sha256"])


def two_fattest(lo: Column, hi: Column) -> Column:
    """The number in (lo, hi] that the largest power of two divides."""
    top = F.floor(F.log2(lo.bitwiseXOR(hi).cast("double"))).cast("int")
    return hi.bitwiseAND(F.call_function("shiftleft", F.lit(-1), top))


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, sid, m, ph, cum of every rebuilt conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the role's length keeps (role, text) apart
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    item = F.struct(F.col("turn").isNotNull().alias("there"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), digest.alias("d"),
                    F.length(text).cast("bigint").alias("n"))
    own = (turns.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(F.array_sort(F.collect_list(item)).alias("ts"))
           .select("conv_id", F.transform("ts", lambda t: F.struct(t["d"].alias("d"), t["n"].alias("n"))).alias("ts")))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    # a head serves at most FAMILY ids on either side of 0
    heads = own.filter(F.col("conv_id") == base).select(F.col("conv_id").alias("base"), F.slice("ts", 1, HEAD - 1).alias("head"))
    h = F.when(F.col("conv_id").isNull(), 0).otherwise(F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).cast("int")
    none = F.array().cast("array<struct<d:binary,n:bigint>>")
    path = (own.join(heads, base == F.col("base"), "left").withColumn("h", h)
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                                        F.slice("ts", F.col("h") + 1, F.size("ts"))).alias("ts")))
    return (path.select("conv_id", F.col("ts.d").alias("ds"), F.col("ts.n").alias("ns"))
            .mapInArrow(_chains, "conv_id long, sid binary, m int, ph array<binary>, cum array<bigint>"))


def _nodes(edges: DataFrame) -> DataFrame:
    """Node rows from (lo, hi, edge, cum): digests and code points at the depths lo..hi."""
    at = two_fattest(F.col("lo"), F.col("hi")) - F.col("lo")
    return edges.select(F.element_at("edge", -1).alias("ext"), F.get("edge", F.lit(0)).alias("par"), F.get("edge", F.lit(1)).alias("first"),
                        F.get("edge", at).alias("handle"), "lo", "hi", "edge", "cum")


def _pieces(df: DataFrame, bounds: Column, path: str, cum: str, offset: Column) -> DataFrame:
    """One edge for each two neighbours of ``bounds``, cut from arrays that begin at the depth ``offset``."""
    i = F.explode(F.sequence(F.lit(1), F.size("bounds") - 1))
    cut = df.withColumn("bounds", bounds).filter(F.size("bounds") > 1).withColumn("i", i)
    lo, hi = F.get("bounds", F.col("i") - 1), F.get("bounds", F.col("i"))
    return cut.select(lo.alias("lo"), hi.alias("hi"), *[F.slice(c, lo - offset + 1, hi - lo + 1).alias(n) for c, n in ((path, "edge"), (cum, "cum"))])


def locate(batch: DataFrame, trie: DataFrame, rounds: int) -> DataFrame:
    """``batch`` with a (depth of the exit node's parent), exit (extent of the exit node; null: none) and l (turns that
    the conversation shares with the trie)."""
    table = trie.select("handle", F.col("ext").alias("t_ext"), F.col("lo").alias("t_lo"), F.col("hi").alias("t_hi"))
    found = batch.withColumns({"a": F.lit(0), "b": F.col("m")})
    open_ = F.col("a") < F.col("b")
    for _ in range(rounds):
        fat = F.when(open_, two_fattest(F.col("a"), F.col("b")))
        hit = F.col("t_ext").isNotNull()
        whole = F.coalesce(F.get("ph", F.col("t_hi")) == F.col("t_ext"), F.lit(False))
        found = (found.withColumns({"f": fat, "probe": F.get("ph", fat)}).join(table, F.col("probe") == F.col("handle"), "left")
                 .withColumns({"a": F.when(hit & whole, F.col("t_hi")).when(hit, F.col("t_lo")).otherwise(F.col("a")),
                               "b": F.when(hit & whole, F.col("b")).when(hit, F.col("t_lo"))
                               .when(open_, F.col("f") - 1).otherwise(F.col("b"))})
                 .drop("f", "probe", "handle", "t_ext", "t_lo", "t_hi"))
    child = trie.select(F.col("first").alias("c_first"), F.col("ext").alias("exit"), F.col("edge").alias("c_edge"))
    shared = F.size(F.array_intersect("c_edge", "ph")) - 1      # the edge begins with the parent's digest
    return (found.withColumn("next", F.get("ph", F.col("a") + 1)).join(child, F.col("next") == F.col("c_first"), "left")
            .withColumn("l", F.col("a") + F.when(F.col("exit").isNull(), 0).otherwise(shared)).drop("b", "next", "c_first", "c_edge"))


def insert(batch: DataFrame, trie: DataFrame, rounds: int, scratch: Scratch) -> DataFrame:
    """The trie with the conversations of ``batch`` (sid, m, ph, cum)."""
    at = scratch.write(locate(batch, trie, rounds), "trie-located")
    cuts = (at.filter(F.col("exit").isNotNull() & (F.col("l") > F.col("a"))).groupBy("exit")
            .agg(F.array_sort(F.collect_set("l")).alias("ls")))           # at most one for each depth of the edge
    cut = trie.join(cuts, F.col("ext") == F.col("exit")).withColumn("ls", F.filter("ls", lambda x: x < F.col("hi")))
    recut = _pieces(cut.withColumn("from", F.col("lo")), F.concat(F.array("lo"), F.col("ls"), F.array("hi")), "edge", "cum", F.col("from"))

    tails = at.filter("l < m")
    each = (tails.select("sid", "l", "ph", F.posexplode(F.slice("ph", F.col("l") + 2, F.size("ph"))).alias("i", "dg"))
            .select("sid", (F.col("l") + 1 + F.col("i")).alias("d"), "dg", F.get("ph", F.col("l") + 2 + F.col("i")).alias("nxt")))
    points = (each.groupBy("dg").agg(F.min("nxt").alias("x"), F.max("nxt").alias("y"), F.max(F.col("nxt").isNull()).alias("end"))
              .filter(F.col("end") | (F.col("x") != F.col("y"))).select("dg"))
    depths = each.select("sid", "d", "dg").join(points, "dg").groupBy("sid").agg(F.array_sort(F.collect_set("d")).alias("ds"))
    new = _pieces(tails.join(depths, "sid"), F.concat(F.array("l"), F.col("ds")), "ph", "cum", F.lit(0))
    parts = _nodes(recut).unionByName(_nodes(new).dropDuplicates(["ext"]))
    kept = trie.join(cuts.select(F.col("exit").alias("ext")), "ext", "left_anti").select(*trie.columns)
    return scratch.write(kept.unionByName(parts), "trie")


def build(paths: DataFrame, scratch: Scratch) -> DataFrame:
    """The compacted trie of distinct paths (sid, m, ph, cum), without the root."""
    size = paths.agg(F.count(F.lit(1)).alias("n"), F.max("m").alias("m")).collect()[0]
    trie, rounds = paths.sparkSession.createDataFrame([], NODE), int(size.m or 0).bit_length() + 1
    shares = [1.0]
    while size.n * shares[-1] > FIRST:
        shares.append(shares[-1] / GROWTH)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("batch"), "sid"), 11) * F.lit(2.0 ** -53)
    bounds = [0.0, *reversed(shares)]
    for i, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
        batch = paths.filter((draw >= low) & (draw < high)).select("sid", "m", "ph", "cum")
        trie = insert(batch, trie, rounds if i else 0, scratch)
    return trie


def _subtrees(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """``nodes(ext, anc, conv, n, leaves, tot, own)`` with all but ext summed over subtrees (conv: the least)."""
    sums = ["n", "leaves", "tot", "own"]
    d = nodes
    while not d.filter("anc is not null").isEmpty():
        below = d.filter("anc is not null").groupBy(F.col("anc").alias("to")).agg(
            F.min("conv").alias("x_conv"), *[F.sum(c).alias(f"x_{c}") for c in sums])
        # nothing is above the root, so its many children need no lookup
        jump = d.filter("anc is not null").select(F.col("ext").alias("via"), F.col("anc").alias("further"))
        d = d.join(below, F.col("ext") == F.col("to"), "left").withColumns(
            {"conv": F.least("conv", "x_conv")} | {c: F.col(c) + F.coalesce(f"x_{c}", F.lit(0)) for c in sums})
        d = d.drop("to", "x_conv", *[f"x_{c}" for c in sums])
        here, up = d.filter(F.col("anc").isNull() | (F.col("anc") == ROOT)), d.filter(F.col("anc") != ROOT)
        up = up.join(jump, F.col("anc") == F.col("via"), "left").drop("anc", "via").withColumnRenamed("further", "anc")
        d = scratch.write(here.withColumn("anc", F.lit(None).cast("binary")).select(*nodes.columns)
                          .unionByName(up.select(*nodes.columns)), "trie-sums")
    return d


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per prefix: prefix (its digest), conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    scratch = Scratch(turns.sparkSession)
    convs = scratch.write(rebuilt(turns), "trie-conversations")
    big = F.lit((1 << 63) - 1)
    seqs = scratch.write(convs.groupBy("sid").agg(F.first("m").alias("m"), F.first("ph").alias("ph"), F.first("cum").alias("cum"),
                                                  F.min(F.coalesce("conv_id", big)).alias("conv"), F.count(F.lit(1)).alias("copies")), "trie-paths")
    trie = build(seqs.filter("m > 0"), scratch)
    ends = scratch.write(convs.select("sid", "conv_id").repartition("sid").sortWithinPartitions("sid", F.col("conv_id").asc_nulls_last())
                         .mapInArrow(_end_digests, "sid binary, ends_sha256 string"), "trie-ends")
    children = scratch.write(trie.groupBy("par").agg(F.count(F.lit(1)).alias("children")), "trie-children")
    zero = F.lit(0).cast("bigint")
    rows = (trie.select("ext", F.col("par").alias("anc"), (F.element_at("cum", -1) - F.get("cum", F.lit(0))).alias("own"))
            .unionByName(seqs.limit(1).select(F.lit(ROOT).alias("ext"), F.lit(None).cast("binary").alias("anc"), zero.alias("own"))))
    ending = seqs.select("sid", "conv", "copies", (F.element_at("cum", -1) * F.col("copies")).alias("tot"))
    rows = (rows.join(ending, F.col("ext") == F.col("sid"), "left").join(children.withColumnRenamed("par", "p"), F.col("ext") == F.col("p"), "left")
            .select("ext", "anc", F.coalesce("conv", big).alias("conv"), F.coalesce("copies", zero).alias("n"),
                    F.when(F.col("children").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"), F.coalesce("tot", zero).alias("tot"), "own"))
    sums = _subtrees(scratch.write(rows, "trie-rows"), scratch).drop("anc")

    stats = (sums.join(children.withColumnRenamed("par", "p"), F.col("ext") == F.col("p"), "left").drop("p")
             .join(ends.withColumnRenamed("sid", "s"), F.col("ext") == F.col("s"), "left").drop("s"))
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    top = sums.filter(F.col("ext") == ROOT).select(F.col("conv").alias("top"))       # one row
    above = sums.filter(F.col("ext") != ROOT).select(F.col("ext").alias("above"), F.col("conv").alias("above_conv"))
    kids, last = F.coalesce("children", zero), F.coalesce("ends_sha256", nobody)
    node = (trie.select("ext", "par", "lo", "hi", "edge", "cum").join(stats, "ext"))
    inner = node.filter(F.col("par") != ROOT).join(above, F.col("par") == F.col("above")).drop("above")
    outer = node.filter(F.col("par") == ROOT).withColumn("above_conv", top.scalar())
    node = inner.unionByName(outer)
    i = F.col("i")
    at = node.select("*", F.posexplode(F.slice("edge", F.lit(2), F.size("edge"))).alias("j", "prefix")).withColumn("i", F.col("j") + 1)
    before = F.get("cum", i - 1)                            # code points of the turns before this one
    through = before - F.get("cum", F.lit(0))               # those on the edge
    expanded = at.select(
        "prefix", "conv", (F.col("lo") + i).cast("bigint").alias("depth"), F.when(i == 1, F.col("above_conv")).otherwise(F.col("conv")).alias("parent"),
        F.col("n").alias("n_convs"), F.when(F.col("lo") + i < F.col("hi"), F.lit(1).cast("bigint")).otherwise(kids).alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("tot") - F.col("n") * before - (F.col("own") - through)).alias("saved_tokens"),
        F.when(F.col("lo") + i < F.col("hi"), nobody).otherwise(last).alias("ends_sha256"))
    root = stats.filter(F.col("ext") == ROOT).select(
        F.col("ext").alias("prefix"), "conv", zero.alias("depth"), F.lit(None).cast("bigint").alias("parent"), F.col("n").alias("n_convs"),
        kids.alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("tot") - F.col("own")).alias("saved_tokens"), last.alias("ends_sha256"))
    out = scratch.keep(expanded.unionByName(root), "prefix-trie")
    scratch.clear()
    real = lambda c: F.when(F.col(c) != big, F.col(c))
    return out.select("prefix", real("conv").alias("conv_id"), "depth", real("parent").alias("parent_conv_id"), "n_convs", "n_children",
                      "n_leaves", "saved_tokens", "ends_sha256")
