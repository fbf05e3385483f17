"""Prefix trie of conversations (operator 13).

A node is a distinct sequence of first turns.  Conversations are grouped in two steps:

* *Blocks.*  Every ``BLOCK`` turns of a conversation make a block; conversations whose successive
  block digests agree up to a block form one class.  The digests are chained by exclusive or
  of values salted with the depth, so a running total gives them for conversations of any
  length (``scan.running``), and copies collapse into one class before anything is shuffled.
* *Turns.*  Where a class goes on in one way only, the nodes inside the block have the members of
  that class.  Only where siblings diverge inside a block, its classes (not its
  conversations) are grouped again turn by turn.

Totals over subtrees need no walk.  A node belongs to its smallest member; the nodes a
conversation owns are the last ones of its path.  With Q the words of a conversation before
the nodes it owns, the words saved below a node of n members and b words before its last
turn are: sum of Q over the members - Q of the owner - (n - 1) * b.  A leaf is a childless
node, counted for its owner.

A node is known by its depth and 128 bits of hashes of SHA-256 turn digests.

Cases: conversations without turns are members of the root and end there; without any
conversation there is no node, not even the root; repeated conversations share all nodes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import staged
from orderlake.llm.scan import running

BLOCK = 4
#: Ids in one piece of the list of conversations that end at a node.
PIECE = 1 << 16
NODE = ["depth", "i1", "i2"]
CLASS = ["block", "p1", "p2", "e1", "e2"]


def turn_digest(role: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)


def _blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, block, depth of its first turn - 1, p1, p2, nodes) of every block of turns; ``nodes`` holds
    for each turn the hash of the block up to it and the words before and in the turn."""
    place = F.col("position")
    rows = turns.groupBy("conv_id", F.floor(place / BLOCK).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("position", "digest", "words"))).alias("turns"))
    upto = F.transform(F.sequence(F.lit(1), F.size("turns")), lambda j: F.struct(
        F.element_at("turns", j)["words"].alias("words"),
        F.aggregate(F.slice("turns", F.lit(1), j - 1), F.lit(0).cast("long"), lambda s, t: s + t["words"]).alias("before"),
        F.array_join(F.transform(F.slice("turns", F.lit(1), j), lambda t: t["digest"]), "").alias("joined"),
        (F.col("block") * BLOCK + j).alias("depth")))
    hashed = F.transform("upto", lambda u: F.struct(
        u["depth"].alias("depth"), u["words"].alias("words"), u["before"].alias("before"),
        F.xxhash64(F.lit(1), u["depth"], u["joined"]).alias("y1"),
        F.xxhash64(F.lit(2), u["depth"], u["joined"]).alias("y2")))
    rows = rows.select("conv_id", "block", upto.alias("upto")).select("conv_id", "block", hashed.alias("nodes"))
    last = F.element_at("nodes", -1)
    rows = rows.withColumn("y1", last["y1"]).withColumn("y2", last["y2"]) \
        .withColumn("words", last["before"] + last["words"])
    return running(rows, "conv_id", ["block"], ["words"], ["y1", "y2"], label="trie-blocks") \
        .withColumnsRenamed({"y1_before": "p1", "y2_before": "p2", "words_before": "before"}) \
        .withColumn("e1", F.col("p1").bitwiseXOR(F.col("y1"))).withColumn("e2", F.col("p2").bitwiseXOR(F.col("y2")))


def _turn_nodes(classes: DataFrame, *more: str) -> DataFrame:
    """A row per class and turn: node, parent, words of the turn and before it, and the columns
    ``more`` of the class."""
    at, n = F.col("at"), F.col("n")
    before = F.element_at("nodes", at)  # the node before, as ``at`` counts from 0
    rows = classes.select("*", F.posexplode("nodes").alias("at", "n"))
    return rows.select(
        n["depth"].alias("depth"), F.col("p1").bitwiseXOR(n["y1"]).alias("i1"), F.col("p2").bitwiseXOR(n["y2"]).alias("i2"),
        F.when(at == 0, F.col("p1")).otherwise(F.col("p1").bitwiseXOR(before["y1"])).alias("q1"),
        F.when(at == 0, F.col("p2")).otherwise(F.col("p2").bitwiseXOR(before["y2"])).alias("q2"),
        n["words"].alias("words"), (F.col("before") + n["before"]).alias("before"), *more)


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes of the trie.

    ``turns``: conv_id, position (gapless from 0), digest, words, one row per turn;
    ``conversations``: conv_id, length (number of turns), one row per conversation.
    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    zero = F.lit(0).cast("long")
    blocks = _blocks(turns)
    conversations = staged(conversations.select("conv_id", "length"), "trie-conversations")

    # classes of conversations with the same blocks, and whether they have siblings
    classes = staged(blocks.groupBy(*CLASS).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("nodes").alias("nodes"),
        F.first("before").alias("before")), "trie-classes")
    kinds = staged(classes.groupBy("block", "p1", "p2").agg(F.count("*").alias("kinds")).where("kinds > 1"), "trie-forks")
    classes = staged(classes.join(kinds, ["block", "p1", "p2"], "left").withColumn("forks", F.col("kinds").isNotNull())
                     .drop("kinds"), "trie-siblings")

    columns = [*NODE, "q1", "q2", "words", "before", "n_convs", "conv_id"]
    alone = _turn_nodes(classes.where(~F.col("forks")), "n_convs", "conv_id").select(columns)
    forked = _turn_nodes(classes.where("forks"), "n_convs", "conv_id").groupBy(*NODE).agg(
        F.first("q1").alias("q1"), F.first("q2").alias("q2"), F.first("words").alias("words"),
        F.first("before").alias("before"), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    root = conversations.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0") \
        .select(*(zero.alias(c) for c in NODE), *(F.lit(None).cast("long").alias(c) for c in ("q1", "q2")),
                zero.alias("words"), zero.alias("before"), "n_convs", "conv_id")
    nodes = alone.union(forked.select(columns)).union(root)
    nodes = staged(nodes, "trie-turns")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("i1"),
                                                F.col("q2").alias("i2")).agg(F.count("*").alias("n_children"))
    nodes = staged(nodes.join(children, NODE, "left").fillna(0, ["n_children"]), "trie-nodes")

    # what each conversation owns: its Q and whether its last node is a leaf
    owned = nodes.groupBy("conv_id").agg(F.sum("words").alias("owned"),
                                         F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    ends = conversations.select("conv_id", "length", F.floor((F.col("length") - 1) / BLOCK).cast("long").alias("block")) \
        .join(blocks.select("conv_id", "block", "e1", "e2", (F.col("before") + F.col("words")).alias("total")),
              ["conv_id", "block"], "left") \
        .join(owned, "conv_id", "left") \
        .select("conv_id", F.col("length").alias("depth"), F.coalesce("e1", zero).alias("i1"),
                F.coalesce("e2", zero).alias("i2"),
                (F.coalesce("total", zero) - F.coalesce("owned", zero)).alias("q"), F.coalesce("leaf", zero).alias("leaf"))
    ends = staged(ends, "trie-ends")

    # totals of Q and leaves by class, then by node
    totals = blocks.select("conv_id", *CLASS).join(ends.select("conv_id", "q", "leaf"), "conv_id").groupBy(*CLASS).agg(
        F.sum("q").alias("q"), F.sum("leaf").alias("leaves"), F.min_by("q", "conv_id").alias("own"))
    summed = staged(classes.join(totals, CLASS), "trie-totals")
    one = ["q", "leaves", "own"]
    alone = _turn_nodes(summed.where(~F.col("forks")), *one).select(*NODE, *one)
    forked = _turn_nodes(summed.where("forks"), *one, "conv_id").groupBy(*NODE).agg(
        F.sum("q").alias("q"), F.sum("leaves").alias("leaves"), F.min_by("own", "conv_id").alias("own"))
    whole = ends.agg(F.sum("q").alias("q"), F.sum("leaf").alias("leaves"), F.min_by("q", "conv_id").alias("own")) \
        .where("q is not null").select(*(zero.alias(c) for c in NODE), *one)
    sums = alone.union(forked).union(whole)

    parents = nodes.select(*(F.col(c).alias(f"parent_{c}") for c in NODE), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(sums, NODE).join(ends_digests(ends), NODE, "left")
    found = found.join(parents, (F.col("depth") - 1 == F.col("parent_depth")) & (F.col("q1") == F.col("parent_i1"))
                       & (F.col("q2") == F.col("parent_i2")), "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        (F.col("q") - F.col("own") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at each node, ascending, joined by
    commas.  Ids are joined in pieces of a range of ``PIECE`` ids, then the pieces of a node are hashed one after the
    other."""
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy(*NODE, F.floor(F.col("conv_id") / PIECE).cast("long").alias("piece")).agg(joined.alias("ids"))
    schema = pa.schema([("depth", pa.int64()), ("i1", pa.int64()), ("i2", pa.int64()), ("ends_sha256", pa.string())])

    def digest(batches):
        now, state = None, None
        for batch in batches:
            done = []
            for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if node != now:
                    if now is not None:
                        done.append(dict(zip(schema.names, (*now, state.hexdigest()))))
                    now, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*now, state.hexdigest())))], schema)

    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece").mapInArrow(
        digest, "depth long, i1 long, i2 long, ends_sha256 string")
