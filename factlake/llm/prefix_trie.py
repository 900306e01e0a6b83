"""Conversation prefix trie, with subtree totals by parallel tree contraction.

``ordered_turns`` numbers the turns of each conversation, ``rebuild`` puts shared beginnings in front, ``trie`` folds the
rebuilt conversations into one row per distinct sequence of first turns, and ``subtree_sums`` adds up the nodes below each.

A turn is known by two 64-bit hashes of role and text; a sequence of turns by the exclusive or, twice 64 bits, of hashes of
its turns with their places.  Exclusive or adds up in any order, so a sequence is hashed in chunks of ``CHUNK`` turns
that are carried across, however long one conversation is.

Contraction.  A round rakes, then compresses.  Rake: a leaf has its total, hands it to its parent and goes.  Compress: a
node with one child left goes, and the child moves up to its parent, if the node's coin shows heads and the child's tails;
so no two neighbours go at once.  What it had gathered stays with the child's edge and is handed up with the child's total.  Bushy trees lose their leaves and long chains about a quarter of their nodes a round,
hence a number of rounds that grows with the logarithm of the table whatever its depth.  Going back over the rounds, the
total of a compressed node is what it and the edge below had gathered plus the total of its child.  Rounds are joins of tables in the shared
folder; only row counts reach the driver.

Null ``conv_id``: the row takes no part.  Null role or text is empty.  Equal turn numbers are ordered by role, then text;
repeated rows are turns of their own.  An empty table gives no nodes.  Further columns do no harm.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factlake.session import materialize

#: Turns of one conversation that one window takes.
CHUNK = 1024
#: Ids that are written as one text on the way to a digest.
ID_RUN = 256
NODE = ("conv_id", "depth")


def ordered_turns(table: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``za``, ``zb`` (hashes of role and text) and ``n_chars`` of every turn.

    One range sort numbers all turns; a conversation that runs over several of its ranges is numbered on from one to the next.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = table.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    line = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    hashes = [F.xxhash64(F.lit(k), F.length("role"), "role", "text").alias(z) for k, z in ((1, "za"), (2, "zb"))]
    line = materialize(line.select("conv_id", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at"), *hashes, F.length("text").cast("long").alias("n_chars")))
    parts = line.groupBy("conv_id", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    pos = F.col("at") - F.col("first") + F.col("before") + 1
    return line.join(parts, ["conv_id", "range"]).select("conv_id", pos.alias("pos"), "za", "zb", "n_chars")


def rebuild(turns: DataFrame, base: Column, head: Column, most_head: int) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations and the ids of all of them.

    Each conversation is rebuilt as the first ``head`` turns of conversation ``base`` (both columns over ``conv_id``, ``head`` at most
    ``most_head``), and its own turns after its first ``head``.
    """
    known = materialize(turns.groupBy("conv_id").agg(F.count("*").alias("n")))
    convs = known.select("conv_id", base.alias("base"), head.cast("long").alias("head"))
    held = known.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    # one row a conversation; its turns meet it by conv_id
    lead = convs.join(held, "base", "left").select("conv_id", "base", "head", F.least("head", F.coalesce("base_n", F.lit(0))).alias("lead"))
    lead = materialize(lead)
    own = turns.join(lead, "conv_id").where(F.col("pos") > F.col("head")).withColumn("pos", F.col("pos") - F.col("head") + F.col("lead"))
    first = turns.where(F.col("pos") <= most_head).withColumnRenamed("conv_id", "base")
    shared = lead.join(first, "base").where(F.col("pos") <= F.col("lead"))
    columns = ["conv_id", "pos", "za", "zb", "n_chars"]
    return own.select(*columns).unionByName(shared.select(*columns)), known.select("conv_id")


def _prefixes(rebuilt: DataFrame) -> DataFrame:
    """``conv_id``, ``depth``, ``xa``, ``xb`` (hash of the first ``depth`` turns), ``ya``, ``yb`` (of one turn less) and ``n_chars``."""
    placed = rebuilt.select("conv_id", "pos", F.floor(F.col("pos") / CHUNK).alias("chunk"), F.xxhash64("pos", "za", "zb").alias("ha"), F.xxhash64("zb", "za", "pos", F.lit(3)).alias("hb"), "n_chars")
    placed = materialize(placed)
    upto = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row for CHUNK turns
    sums = placed.groupBy("conv_id", "chunk").agg(F.bit_xor("ha").alias("ca"), F.bit_xor("hb").alias("cb"))
    zero = F.lit(0).cast("long")
    carry = sums.select("conv_id", "chunk", *(F.coalesce(F.bit_xor(c).over(ahead), zero).alias(c) for c in ("ca", "cb")))
    run = placed.withColumns({"xa": F.bit_xor("ha").over(upto), "xb": F.bit_xor("hb").over(upto)}).join(carry, ["conv_id", "chunk"])
    xa, xb = F.col("xa").bitwiseXOR(F.col("ca")), F.col("xb").bitwiseXOR(F.col("cb"))
    return run.select("conv_id", F.col("pos").alias("depth"), xa.alias("xa"), xb.alias("xb"), xa.bitwiseXOR(F.col("ha")).alias("ya"), xb.bitwiseXOR(F.col("hb")).alias("yb"), "n_chars")


def trie(rebuilt: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``last_chars`` and ``ends_sha256``."""
    paths = materialize(_prefixes(rebuilt))
    key = ["depth", "xa", "xb"]
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("xa"), zero.alias("xb"), F.lit(None).cast("long").alias("ya"), F.lit(None).cast("long").alias("yb"), "conv_id", "n_convs", zero.alias("last_chars"))
    folded = paths.groupBy(*key).agg(F.min("ya").alias("ya"), F.min("yb").alias("yb"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_chars").alias("last_chars"))
    nodes = materialize(folded.unionByName(root))
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("ya").alias("xa"), F.col("yb").alias("xb")).agg(F.count("*").alias("n_children"))
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("xa").alias("ya"), F.col("xb").alias("yb"), F.col("conv_id").alias("parent_conv_id"))
    last = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "xa", "xb")).alias("end"))
    ends = convs.join(last, "conv_id", "left").select("conv_id", *(F.coalesce(f"end.{c}", zero).alias(c) for c in key))
    out = nodes.join(kids, key, "left").join(up, ["depth", "ya", "yb"], "left").join(end_digests(ends, key), key, "left")
    return materialize(
        out.select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "last_chars",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def end_digests(ends: DataFrame, key: list[str]) -> DataFrame:
    """Per node (``key``) the SHA-256 of the ids of the conversations that end there, ascending and joined by commas.

    Ids are sorted and written out in ranges, ``ID_RUN`` to a text; a node's texts then pass one after another through one
    digest, so a node where very many end takes neither memory nor a row for each.
    """
    line = ends.select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")

    def write(batches):
        node, ids = None, []
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in (*key, "conv_id")]
            for *own, conv in zip(*columns):
                if own != node or len(ids) == ID_RUN:
                    out += [(*node, ids[0], ",".join(map(str, ids)))] if ids else []
                    node, ids = own, []
                ids.append(conv)
            yield _texts(out, key)
        yield _texts([(*node, ids[0], ",".join(map(str, ids)))] if ids else [], key)

    texts = line.mapInArrow(write, ", ".join(f"{k} long" for k in key) + ", first long, ids string")

    def digest(batches):
        node, sha = None, None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in (*key, "ids")]
            for *own, ids in zip(*columns):
                if own != node:
                    done += [(*node, sha.hexdigest())] if sha else []
                    node, sha = own, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield _digests(done, key)
        yield _digests([(*node, sha.hexdigest())] if sha else [], key)

    ordered = texts.repartition(*key).sortWithinPartitions(*key, "first").select(*key, "ids")
    return ordered.mapInArrow(digest, ", ".join(f"{k} long" for k in key) + ", ends_sha256 string")


def _texts(rows: list[tuple], key: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * (len(key) + 2)
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.string())], [*key, "first", "ids"])


def _digests(rows: list[tuple], key: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * (len(key) + 1)
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.string())], [*key, "ends_sha256"])


def _heads(round_: int, *node: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(round_), *node), F.lit(2)) == 1


def subtree_sums(tree: DataFrame, values: tuple[str, ...]) -> DataFrame:
    """``conv_id``, ``depth`` and the sums of the long columns ``values`` over the subtree of every node of ``tree``.

    ``tree`` has one row per node with ``conv_id``, ``depth`` and ``parent_conv_id`` (null: no parent); a parent is one level up.
    Column names beginning with ``e_`` or ``k_`` are used inside.
    """
    zero = F.lit(0).cast("long")
    own, edge = list(values), [f"e_{v}" for v in values]  # what a node has gathered; what compressed nodes between it and its parent had
    # the parent of a node may come to be any level up, so it is named in full
    parent = F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1)
    live = tree.select(*NODE, F.col("parent_conv_id").alias("p_conv"), parent.alias("p_depth"), *(F.col(v).cast("long").alias(v) for v in own), *(zero.alias(e) for e in edge))
    live = materialize(live)
    of_parent = (F.col("p_conv").alias("conv_id"), F.col("p_depth").alias("depth"))
    gone: list[tuple[DataFrame, bool]] = []
    round_ = 0
    while not live.isEmpty():
        round_ += 1
        # rake: what has no child is complete, and hands its total up
        below = live.where("p_conv IS NOT NULL")
        inner = below.select(*of_parent).distinct().withColumn("inner", F.lit(True))
        marked = materialize(live.join(inner, list(NODE), "left"))
        leaves = marked.where("inner IS NULL").drop("inner")
        gone.append((leaves.select(*NODE, *own), False))
        handed = leaves.where("p_conv IS NOT NULL").groupBy(*of_parent).agg(*(F.sum(F.col(v) + F.col(e)).alias(f"k_{v}") for v, e in zip(own, edge)))
        rest = marked.where("inner").drop("inner").join(handed, list(NODE), "left")
        live = materialize(rest.select(*NODE, "p_conv", "p_depth", *((F.col(v) + F.coalesce(f"k_{v}", zero)).alias(v) for v in own), *edge))
        # compress: a node with one child left goes, if its coin shows heads and the child's tails
        only = live.where("p_conv IS NOT NULL").groupBy(*of_parent).agg(F.count("*").alias("n"), F.min(F.struct("conv_id", "depth", *edge)).alias("c")).where("n = 1")
        only = only.select(*NODE, F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"), *(F.col(f"c.{e}").alias(f"k_{e}") for e in edge))
        only = only.where(_heads(round_, *NODE) & ~_heads(round_, "c_conv", "c_depth"))
        out = materialize(live.where("p_conv IS NOT NULL").join(only, list(NODE)))
        if out.isEmpty():
            continue
        gone.append((out.select(*NODE, "c_conv", "c_depth", *((F.col(v) + F.col(f"k_{e}")).alias(v) for v, e in zip(own, edge))), True))
        to_child = (F.col("c_conv").alias("conv_id"), F.col("c_depth").alias("depth"), F.col("p_conv").alias("n_conv"), F.col("p_depth").alias("n_depth"))
        moved = out.select(*to_child, *((F.col(v) + F.col(e)).alias(f"k_{e}") for v, e in zip(own, edge)))
        stay = live.join(out.select(*NODE), list(NODE), "left_anti").join(moved, list(NODE), "left")
        raised = (F.coalesce("n_conv", "p_conv").alias("p_conv"), F.coalesce("n_depth", "p_depth").alias("p_depth"))
        live = materialize(stay.select(*NODE, *raised, *own, *((F.col(e) + F.coalesce(f"k_{e}", zero)).alias(e) for e in edge)))
    # expand: the rounds backwards; the child of a compressed node went later and is known
    known = None
    for nodes, compressed in reversed(gone):
        if compressed:
            child = known.select(F.col("conv_id").alias("c_conv"), F.col("depth").alias("c_depth"), *(F.col(v).alias(f"k_{v}") for v in own))
            nodes = materialize(nodes.join(child, ["c_conv", "c_depth"]).select(*NODE, *((F.col(v) + F.col(f"k_{v}")).alias(v) for v in own)))
        known = nodes if known is None else known.unionByName(nodes)
    return live.select(*NODE, *own) if known is None else known


def node_table(table: DataFrame, base: Column, head: Column, most_head: int) -> DataFrame:
    """Every node of the trie of the rebuilt conversations, with its subtree totals.

    ``saved_tokens`` sums, over the subtree, the code points of each node's last text once for every member but one.
    """
    turns = materialize(ordered_turns(table))
    nodes = trie(*rebuild(turns, base, head, most_head))
    leaf = (F.col("n_children") == 0).cast("long")
    own = nodes.withColumns({"n_leaves": leaf, "saved_tokens": (F.col("n_convs") - 1) * F.col("last_chars")})
    sums = subtree_sums(own, ("n_leaves", "saved_tokens"))
    return nodes.join(sums, list(NODE)).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
