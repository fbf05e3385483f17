"""Merkle manifest of a dataset (operator 11).

Every row has a leaf digest.  The leaves of a group stand in the order of their key; every
``RUN`` neighbours become the SHA-256 of their joined hex digests, level by level, until one
subroot is left; the subroots, in the order of the groups, become the root in the same way.

*Store.*  The tree is built in bands of ``levels`` levels.  A segment is the part of a tree of
``levels`` levels under one node, at most ``RUN ** levels`` nodes wide; the store has one row per segment,
found by its digest, with a record (digest, children) of every node in it.  Equal segments
are stored once.

*Descent.*  Leaf requests are grouped by the segment they pass.  From the root down, band by
band, a segment is looked up by digest and every asked place descends in it by the base-RUN
digits of its rank: the child at the digit is followed, the children not selected are
collected.  What one band found is carried to the next as a path segment.  At the leaves the
path is reversed: it is the audit path from the leaf to the root.

A row moves by its place, so no task gets more leaves at once than a segment has, whatever a group
holds; paths move once per segment, not once per leaf.

Cases: null keys and null groups come first; a null field is ``-`` in the leaf; repeated rows
are leaves of their own, next to each other; an empty table has no root and no proofs; other
columns, whatever their names, take no part unless they are asked for in ``keep``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import staged
from orderlake.llm.scan import running

RUN = 3
#: Levels in a band; a segment has 729 leaves at most.
LEVELS = 6

PATH = "array<struct<left: string, right: string>>"
RECORDS = "array<struct<digest: string, children: array<string>>>"


def field(value: Column) -> Column:
    """One value inside a leaf: its UTF-8 byte count, ``:`` and itself; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def joined_digest(digests) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` neighbouring nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def _bands(n: Column, span: int) -> Column:
    """How many bands a tree of n leaves has."""
    made, b = F.lit(0), 0
    while span ** b < 1 << 62:
        made, b = F.when(n > span ** b, b + 1).otherwise(made), b + 1
    return made


@dataclass
class Manifest:
    """``leaves``: the rows with ``tree``, ``rank`` and ``leaf``; ``bands`` and ``top_bands``: segments,
    lowest first; ``subroots``: (tree, n, digest, place); ``root``: digest or None."""

    leaves: DataFrame
    bands: list[DataFrame]
    top_bands: list[DataFrame]
    subroots: DataFrame
    root: str | None
    levels: int

    def store(self) -> DataFrame:
        """(digest, records) of every distinct segment."""
        rows = [b.select("digest", "records") for b in (*self.bands, *self.top_bands)]
        if not rows:
            return self.leaves.sparkSession.createDataFrame([], f"digest string, records {RECORDS}")
        out = rows[0]
        for more in rows[1:]:
            out = out.union(more)
        return out.dropDuplicates(["digest"])


# --- building --------------------------------------------------------------------------

def _fold(levels: int):
    """Blocks (tree, n, block, base) to segments (tree, n, idx, digest, records)."""
    records_type = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))

    def run(batches):
        for batch in batches:
            digests, records = [], []
            for n, base in zip(batch.column("n").to_pylist(), batch.column("base").to_pylist()):
                nodes, kept = base, []
                for _ in range(min(levels, height(n))):
                    runs = [nodes[i:i + RUN] for i in range(0, len(nodes), RUN)]
                    nodes = [joined_digest(r) for r in runs]
                    kept += [{"digest": d, "children": r} for d, r in zip(nodes, runs)]
                digests.append(nodes[0])
                records.append(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("n"), batch.column("block"), pa.array(digests, pa.string()),
                 pa.array(records, records_type)], ["tree", "n", "idx", "digest", "records"])

    return run


def _blocks(nodes: DataFrame, span: int) -> DataFrame:
    """Nodes (tree, idx, digest) in blocks of at most ``span`` neighbours."""
    base = F.sort_array(F.collect_list(F.struct("idx", "digest")))
    return nodes.groupBy("tree", F.floor(F.col("idx") / span).alias("block")).agg(
        F.transform(base, lambda x: x["digest"]).alias("base"))


def _build(nodes: DataFrame, sizes: DataFrame, levels: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Bands of the trees and (tree, n, digest) of their roots, from nodes (tree, idx, digest) and
    the number of leaves of each tree (tree, n)."""
    span = RUN ** levels
    most = sizes.agg(F.max("n")).first()[0] or 0
    bands: list[DataFrame] = []
    done = nodes.where("idx = 0").join(sizes.where("n = 1"), "tree").select("tree", F.col("n").alias("leaves"), "digest")
    now = _blocks(nodes, span).join(sizes.where("n > 1"), "tree")
    while most > 1:
        made = staged(now.select("tree", "n", "block", "base").mapInArrow(
            _fold(levels), f"tree string, n long, idx long, digest string, records {RECORDS}"), f"{label}-{len(bands)}")
        bands.append(made)
        most = -(-most // span)
        up = F.ceil(F.col("n") / span).cast("long")
        done = done.union(made.where(up == 1).join(sizes.withColumnRenamed("n", "leaves"), "tree")
                          .select("tree", "leaves", "digest"))
        if most > 1:
            higher = made.where(up > 1)
            now = _blocks(higher, span).join(higher.select("tree", up.alias("n")).distinct(), "tree")
    return bands, done.withColumnRenamed("leaves", "n")


def build(rows: DataFrame, group: Column, key: Column, leaf: Column, keep: list[str],
          levels: int = LEVELS) -> Manifest:
    """The manifest of ``rows``: ``leaf`` digests in the order of ``key`` inside each ``group`` (a string);
    ``keep`` columns stay on the leaves, inside a struct ``row``."""
    # the scan's row number keeps repeated rows apart
    named = rows.select(
        F.coalesce(F.concat(F.lit("g"), group), F.lit("-")).alias("tree"), key.alias("key"), leaf.alias("leaf"),
        F.struct(*keep).alias("row"), F.lit(1).cast("long").alias("one"),
        F.monotonically_increasing_id().alias("number"))
    leaves = running(named, "tree", ["key", "leaf", "number"], ["one"], label="merkle-leaves") \
        .select("tree", F.col("one_before").alias("rank"), "leaf", "row")
    sizes = staged(leaves.groupBy("tree").agg(F.count("*").alias("n")), "merkle-sizes")
    bands, roots = _build(leaves.select("tree", F.col("rank").alias("idx"), F.col("leaf").alias("digest")),
                          sizes, levels, "merkle")
    # '-' sorts before 'g', so the null group is first
    placed = running(roots.select(F.lit("top").alias("all"), "tree", "n", "digest", F.lit(1).cast("long").alias("one")),
                     "all", ["tree"], ["one"], label="merkle-subroots")
    subroots = placed.select("tree", "n", "digest", F.col("one_before").alias("place"))
    count = placed.groupBy(F.col("all").alias("tree")).agg(F.count("*").alias("n"))
    top_bands, top = _build(placed.select(F.col("all").alias("tree"), F.col("one_before").alias("idx"), "digest"),
                            count, levels, "merkle-top")
    root = top.select("digest").first()
    return Manifest(leaves, bands, top_bands, subroots, root[0] if root else None, levels)


# --- descent ---------------------------------------------------------------------------

def _descend(records: dict, node: str, place: int, levels: int) -> tuple[str, list]:
    """Follow the digits of ``place`` from ``node``; (node reached, what was passed, top first)."""
    path = []
    for level in reversed(range(levels)):
        children = records[node]
        digit = place // RUN ** level % RUN
        path.append(("".join(children[:digit]), "".join(children[digit + 1:])))
        node = children[digit]
    return node, path


def _opened(batch, i: int, most: int) -> tuple[dict, list, int]:
    """The records of row i, the path so far, and the levels below its digest."""
    records = batch.column("records")[i].as_py() or []
    path = [(p["left"], p["right"]) for p in batch.column("path")[i].as_py()]
    n = batch.column("n")[i].as_py()
    return {r["digest"]: r["children"] for r in records}, path, min(most, height(n))


_PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _path_array(paths: list) -> pa.Array:
    return pa.array([[{"left": a, "right": b} for a, b in p] for p in paths], _PATH_TYPE)


def _down(most: int):
    """Asked places of a segment to the nodes below them, with their paths."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                records, path, levels = _opened(batch, i, most)
                node, idx = batch.column("digest")[i].as_py(), batch.column("idx")[i].as_py()
                places = batch.column("places")[i].as_py()
                reached = [_descend(records, node, p, levels) for p in places]
                many = pa.array([i] * len(places), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("tree").take(many), batch.column("leaves").take(many),
                     pa.array([idx * RUN ** most + p for p in places], pa.int64()),
                     pa.array([d for d, _ in reached], pa.string()), _path_array([path + p for _, p in reached]),
                     batch.column("subroot").take(many)],
                    ["tree", "leaves", "idx", "digest", "path", "subroot"])

    return run


def _proofs(root: str, most: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                records, path, levels = _opened(batch, i, most)
                node, asked = batch.column("digest")[i].as_py(), batch.column("asked")[i].values
                folded, proofs, found = [], [], []
                for rank, claim in zip(asked.field("rank").to_pylist(), asked.field("claim").to_pylist()):
                    leaf, below = _descend(records, node, rank % RUN ** most, levels)
                    proof = (path + below)[::-1]
                    for left, right in proof:
                        claim = joined_digest((left, claim, right))
                    found.append(leaf)
                    folded.append(claim)
                    proofs.append(proof)
                many = pa.array([i] * len(found), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [asked.field("row"), pa.array(found, pa.string()), batch.column("subroot").take(many),
                     pa.array([root] * len(found), pa.string()), _path_array(proofs), pa.array(folded, pa.string())],
                    ["row", "leaf", "subroot", "root", "proof", "folded_root"])

    return run


def _looked_up(frontier: DataFrame, asked: DataFrame, segments: DataFrame | None, covered: int) -> DataFrame:
    """Nodes of the frontier with what is asked below them and their records; a base node of the band
    covers ``covered`` leaves."""
    rows = frontier.join(asked, ["tree", "idx"]).withColumn(
        "n", F.ceil(F.col("leaves") / F.lit(covered)).cast("long"))
    if segments is None:
        return rows.withColumn("records", F.lit(None).cast(RECORDS))
    return rows.join(segments.select("digest", "records").dropDuplicates(["digest"]), "digest", "left")


_FRONTIER = f"tree string, leaves long, idx long, digest string, path {PATH}, subroot string"


def _places(requests: DataFrame, span: int, band: int) -> DataFrame:
    """What is asked of the segments of a band: the places of nodes inside them."""
    below = F.floor(F.col("rank") / F.lit(span ** band)).cast("long")
    asked = requests.select("tree", below.alias("node")).distinct()
    return asked.groupBy("tree", F.floor(F.col("node") / span).cast("long").alias("idx")).agg(
        F.collect_list(F.pmod("node", F.lit(span))).alias("places"))


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """The audit path of every request (tree, rank, claim, row), each leaf asked at most once:
    ``row``, the stored ``leaf``, its ``subroot`` and ``root``, ``proof`` (what stands left and right of
    the path at each level, from the leaf up) and ``folded_root``, the root that follows from
    ``claim`` and the proof."""
    spark, levels = requests.sparkSession, manifest.levels
    span = RUN ** levels
    asked = requests.groupBy("tree", F.floor(F.col("rank") / span).cast("long").alias("idx")).agg(
        F.collect_list(F.struct("rank", "claim", "row")).alias("asked"))
    out = f"row {requests.schema['row'].dataType.simpleString()}, leaf string, subroot string, root string, " \
          f"proof {PATH}, folded_root string"
    if manifest.root is None:
        return spark.createDataFrame([], out)

    # from the root to the subroots
    wanted = manifest.subroots.join(requests.select("tree").distinct(), "tree", "left_semi")
    count = manifest.subroots.count()
    frontier = spark.range(1).select(
        F.lit("top").alias("tree"), F.lit(count).cast("long").alias("leaves"), F.col("id").alias("idx"),
        F.lit(manifest.root).alias("digest"), F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"))
    tops = wanted.select(F.lit("top").alias("tree"), F.col("place").alias("rank"))
    for band in reversed(range(len(manifest.top_bands))):
        rows = _looked_up(frontier, _places(tops, span, band), manifest.top_bands[band], span ** band)
        frontier = rows.mapInArrow(_down(levels), _FRONTIER)
    roots = frontier.select(F.col("idx").alias("place"), "path").join(wanted, "place").select(
        "tree", F.col("n").alias("leaves"), F.lit(0).cast("long").alias("idx"), "digest", "path",
        F.col("digest").alias("subroot"))
    roots = staged(roots, "merkle-roots")

    # from the subroots to the leaves
    frontier = None
    for band in reversed(range(max(1, len(manifest.bands)))):
        bands = _bands(F.col("leaves"), span)
        starts = roots.where(bands == band + 1) if band else roots.where(bands <= 1)
        frontier = starts if frontier is None else frontier.union(starts)
        if band:
            rows = _looked_up(frontier, _places(requests, span, band), manifest.bands[band], span ** band)
            frontier = rows.mapInArrow(_down(levels), _FRONTIER)
    rows = _looked_up(frontier, asked, manifest.bands[0] if manifest.bands else None, 1)
    return rows.mapInArrow(_proofs(manifest.root, levels), out)
