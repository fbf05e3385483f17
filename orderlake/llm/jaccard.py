"""N-gram Jaccard join with parity sketches (operator 6).

A text's set holds the hashes of its distinct word shingles.  Its parity sketch is a very
long bit vector: a shingle's hash names one bit, and the bit is flipped for each shingle of
the set.  One more or one less shingle flips one bit, so the Hamming distance of two sketches
is at most the size of the symmetric difference.

Sets of Jaccard similarity s or more differ in at most (|A| + |B|) (1 - s) / (1 + s) shingles.
Sizes form bands, such that linked sets are in the same or in neighbouring bands; for a pair
of neighbouring bands that bound is one number D.  The sketch is cut into D + 1 + SPARE
pieces, so linked sets agree in SPARE + 1 pieces at least (pigeonhole).  A piece is kept as
the XOR of a 64-bit code per set bit.  Pieces without a set bit say nothing; a set with at
most SPARE of them leaves them out, since one of the SPARE + 1 pieces is then another.
Sets that agree in a piece are candidates, and candidates are verified on the whole sets.

Equal sets are one class from the start.  A group of classes that agree in a piece is not
paired out: first each class meets the most central class of the group, in a few rounds; then
only classes that the verified links left in different components meet, filtered by a short
dense parity sketch.
No link between different components is lost, so the components are exact.  (Shingles are
compared by 64-bit hashes.)

Work is spread by (pair of bands, range of the pieces' codes), so a crowded band is split and a set sends each of
its pieces once.  The groups found are dealt again by their smallest class, where equal ones become one, and
only then get the sizes and dense sketches of their classes.

Cases: a text without words (null, empty, blank) has the empty set and is its own component;
a text with fewer words than a shingle is one shingle; a null doc_id takes part, and the
component is the smallest doc_id that is not null (null if there is none); repeated rows
are linked like any equal texts; an empty table has no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import flat, mix, pack, pieces, staged, unpack, word_hashes

#: Pieces (8 bytes each) that a bucket takes in, about.
BUCKET_PIECES = 1_500_000
#: 64-bit words of the dense sketch.
DENSE = 16
#: Members from which on a group is dealt by its own hash.
LARGE_GROUP = 256
#: Rounds in which the classes of a group meet one of them, before all that are left meet.
STAR_ROUNDS = 1
#: Code of a piece without a set bit, where such pieces are sent.
EMPTY = np.uint64(1)


# --- sets and sketches -----------------------------------------------------------------

def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, counts = word_hashes(*flat(texts))
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    for i in range(words):
        rolled[:max(0, n - i)] = mix(rolled[:max(0, n - i)] * np.uint64(31) + hashes[i:])
    out, at = [], 0
    for c in counts.tolist():
        if c >= words:
            out.append(np.unique(rolled[at:at + c - words + 1]))
        elif c:
            one = np.full(1, c, np.uint64)
            for h in hashes[at:at + c]:
                one = mix(one * np.uint64(37) + h)
            out.append(one)
        else:
            out.append(hashes[:0])
        at += c
    return out


def set_id(s: np.ndarray) -> int:
    """64-bit name of a set, as a signed number."""
    total = mix(mix(s).sum(dtype=np.uint64, keepdims=True) ^ np.uint64(len(s)))
    return int(total.view(np.int64)[0])


def dense_sketch(s: np.ndarray) -> np.ndarray:
    """Parity sketch of DENSE * 64 bits."""
    bit = mix(s ^ np.uint64(77)) % np.uint64(DENSE * 64)
    odd = np.bincount(bit.astype(np.int64), minlength=DENSE * 64) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


class Bands:
    """Bands of set sizes for similarity num / den, and the pieces of each pair of bands.

    Band i holds sizes start[i] .. start[i+1]-1.  Family i finds pairs whose smaller set is in
    band i and whose larger one is in band i or i + 1.
    """

    def __init__(self, num: int, den: int, largest: int):
        self.num, self.den = num, den
        start = [1]
        while start[-1] <= largest:
            start.append(start[-1] * den // num + 1)
        start.append(start[-1] * den // num + 1)
        self.start = np.array(start, np.int64)
        self.apart = [self.most_apart(int(start[i + 1]) - 1, int(start[i + 2]) - 1)
                      for i in range(len(start) - 2)]
        self.spare = [1 + d // 12 for d in self.apart]
        self.pieces = [d + 1 + e if d else 0 for d, e in zip(self.apart, self.spare)]

    def most_apart(self, a, b):
        """Largest symmetric difference of linked sets of sizes a and b."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def band(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, sizes, "right") - 1

    def sketch_pieces(self, s: np.ndarray, family: int) -> np.ndarray:
        """XOR codes of the pieces; 0 stands for a piece that is not sent."""
        n = self.pieces[family]
        # the set is sorted by hash, and a piece is a range of hashes
        cuts = np.searchsorted(
            s >> np.uint64(32), (np.arange(n + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(n))
        folded = np.concatenate((np.zeros(1, np.uint64), np.bitwise_xor.accumulate(mix(s))))
        codes = folded[cuts[1:]] ^ folded[cuts[:-1]]
        if int((codes == 0).sum()) > self.spare[family]:
            codes[codes == 0] = EMPTY
        return codes


# --- candidates ------------------------------------------------------------------------

def _plan(bands: Bands, in_band: dict[int, int]) -> dict[int, tuple[int, int]]:
    """family -> (first bucket, buckets), by the pieces that the family will send."""
    plan, first = {}, 0
    for f, n in enumerate(bands.pieces):
        rows = in_band.get(f, 0) + in_band.get(f + 1, 0)
        if n and in_band.get(f, 0) and rows > 1:
            buckets = max(1, -(-rows * n // BUCKET_PIECES))
            plan[f] = (first, buckets)
            first += buckets
    return plan


def _share(hashes: np.ndarray, count: int) -> np.ndarray:
    """Which of ``count`` equal ranges each hash is in."""
    return (((hashes >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)).astype(np.int64)


def _dealt(buckets: np.ndarray):
    """(bucket, rows in it) of each bucket that has rows."""
    order = np.argsort(buckets, kind="stable")
    found, begin = np.unique(buckets[order], return_index=True)
    yield from zip(found.tolist(), np.split(order, begin[1:]))


def _payload(bucket: int, *arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([pack(*arrays)], pa.binary())],
                                      ["bucket", "payload"])


def _send(bands: Bands, plan: dict, words: int):
    """Packed pieces of each batch, names and codes only: one row per bucket, which is a range of codes, so that a
    set sends each piece once however many buckets there are."""

    def run(batches):
        for batch in pieces(batches):
            sets = [s for s in shingle_sets(batch.column("text"), words) if len(s)]
            by_id = {set_id(s): s for s in sets}
            held: dict[int, list] = {}
            for name, s in by_id.items():
                b = int(bands.band(np.array([len(s)]))[0])
                for f in (b, b - 1):
                    if f in plan:
                        held.setdefault(f, []).append((name, s))
            for f, members in held.items():
                first, buckets = plan[f]
                names = np.array([m[0] for m in members], np.int64)
                codes = np.stack([bands.sketch_pieces(m[1], f) for m in members])
                rows, piece = np.nonzero(codes)
                # equal codes of different pieces are no agreement
                codes = mix(codes[rows, piece] ^ mix(piece.astype(np.uint64) + np.uint64(1)))
                for bucket, here in _dealt(_share(codes, buckets)):
                    used, at = np.unique(rows[here], return_inverse=True)
                    yield _payload(first + bucket, names[used], at, codes[here])

    return run


def _distinct_groups(names: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of groups of sorted names, which begin at ``begin``: the first of each set of equal ones, the sizes of all and
    a hash of each."""
    size = np.diff(np.concatenate((begin, [len(names)])))
    if not len(begin):
        return begin, size, np.zeros(0, np.uint64)
    sign = mix(np.add.reduceat(mix(names.view(np.uint64)), begin) ^ size.astype(np.uint64))
    told = np.stack((sign, names[begin].view(np.uint64), size.astype(np.uint64)), axis=1)
    return np.sort(np.unique(told, axis=0, return_index=True)[1]), size, sign


def _members_of(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of the members of groups, one group after the other."""
    cuts = np.concatenate(([0], np.cumsum(size)))
    return np.repeat(begin - cuts[:-1], size) + np.arange(cuts[-1])


def _find_groups(buckets: int):
    """Distinct groups of classes that agree in a piece of a bucket, dealt by their smallest name: groups of the same
    classes meet there, and those of a cluster are mostly together.  A large group goes by its own hash."""

    def run(batches):
        for _, payloads in _runs(batches):
            parts = [unpack(p) for p in payloads]
            names = np.concatenate([p[0].astype(np.int64)[p[1].astype(np.int64)] for p in parts])
            codes = np.concatenate([p[2] for p in parts])
            del parts
            order = np.lexsort((names, codes))
            names, codes = names[order], codes[order]
            one = np.concatenate(([True], (codes[1:] != codes[:-1]) | (names[1:] != names[:-1])))
            names, codes = names[one], codes[one]  # the same set comes from several senders
            begin = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
            size = np.diff(np.concatenate((begin, [len(codes)])))
            begin, size = begin[size > 1], size[size > 1]
            names = names[_members_of(begin, size)]
            begin = np.cumsum(size) - size
            kept, size, sign = _distinct_groups(names, begin)
            home = np.where(size[kept] < LARGE_GROUP, mix(names[begin[kept]].view(np.uint64)), sign[kept])
            for bucket, here in _dealt(_share(home, buckets)):
                groups = kept[here]
                yield _payload(bucket, names[_members_of(begin[groups], size[groups])], size[groups])

    return run


def _settle_groups(batches):
    """Rows (bucket, payload) of the distinct groups of each bucket: names, member rows of all groups, cuts."""
    for bucket, payloads in _runs(batches):
        parts = [unpack(p) for p in payloads]
        names = np.concatenate([p[0].astype(np.int64) for p in parts])
        size = np.concatenate([p[1].astype(np.int64) for p in parts])
        begin = np.cumsum(size) - size
        kept, size, _ = _distinct_groups(names, begin)
        used, rows = np.unique(names[_members_of(begin[kept], size[kept])], return_inverse=True)
        yield _payload(bucket, used, rows, np.concatenate(([0], np.cumsum(size[kept]))))


def _sketches(batches):
    """set_id, size and dense sketch of whole sets."""
    for batch in batches:
        sets = [np.frombuffer(s, np.uint64) for s in batch.column("payload").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("set_id"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([dense_sketch(s).tobytes() for s in sets], pa.binary())], ["set_id", "n", "dense"])


def _gather(key, rows):
    """Names, sizes and dense sketches of a bucket's classes, in the order of their names."""
    names = rows.column("set_id").to_numpy()
    order = np.argsort(names)
    dense = np.frombuffer(b"".join(rows.column("dense").to_pylist()), np.uint64).reshape(-1, DENSE)
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "sketches": pa.array(
        [pack(names[order], rows.column("n").to_numpy()[order], dense[order].ravel())], pa.binary())})


def _with_sketches(batches):
    """Groups of a bucket with the sizes and dense sketches of its classes."""
    for batch in batches:
        for bucket, payload, sketches in zip(*(batch.column(c).to_pylist() for c in ("bucket", "payload", "sketches"))):
            names, rows, cuts = unpack(payload)
            known, sizes, dense = unpack(sketches)
            if not np.array_equal(known.astype(np.int64), names.astype(np.int64)):
                raise ValueError(f"bucket {bucket}: sets without a text")
            yield _payload(bucket, names, sizes, dense, rows, cuts)


def _runs(batches):
    """(bucket, payloads) from batches sorted by bucket."""
    now, held = None, []
    for batch in batches:
        for bucket, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist()):
            if held and bucket != now:
                yield now, held
                held = []
            now = bucket
            held.append(payload)
    if held:
        yield now, held


def _may_link(bands: Bands, size_a, size_b, dense_a, dense_b) -> np.ndarray:
    """Pairs that neither their sizes nor their dense sketches rule out."""
    small, large = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    apart = np.bitwise_count(dense_a ^ dense_b).sum(axis=-1, dtype=np.int64)
    return (small * bands.den >= large * bands.num) & (apart <= bands.most_apart(size_a, size_b))


def _centre(dense: np.ndarray) -> int:
    """The row whose sketch is nearest to the bits that most rows have."""
    bits = np.unpackbits(dense.view(np.uint8), axis=1)
    usual = np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(bits)).view(np.uint64)
    return int(np.bitwise_count(dense ^ usual).sum(axis=1, dtype=np.int64).argmin())


def _stars(bands: Bands):
    """Pairs of one class of a group with the others.

    The one is the most central class; once components are told, the most central of the
    classes outside the group's largest component, and it meets all other components."""

    def run(batches):
        for batch in batches:
            tolds = batch.column("told").to_pylist() if "told" in batch.schema.names else [None] * batch.num_rows
            for payload, told in zip(batch.column("payload").to_pylist(), tolds):
                names, sizes, dense, rows, cuts = _unpack_groups(payload)
                component = _components_of(names, told)
                pairs = []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    group = rows[a:b]
                    outer = group
                    if told:
                        _, of, times = np.unique(component[group], return_inverse=True, return_counts=True)
                        if len(times) == 1:
                            continue
                        outer = group[of != times.argmax()]
                    one = outer[_centre(dense[outer])] if len(outer) > 2 else outer[0]
                    rest = group[component[group] != component[one]]
                    pairs.append(np.stack((np.full(len(rest), one), rest), axis=1))
                if pairs:
                    pair = np.unique(np.concatenate(pairs), axis=0)
                    yield _pairs(bands, names, sizes, dense, pair[:, 0], pair[:, 1])

    return run


def _components_of(names: np.ndarray, told) -> np.ndarray:
    """Component of each class; a class without links is its own."""
    component = names.copy()
    if told:
        node, where = unpack(told)
        component[np.searchsorted(names, node)] = where
    return component


def _crossings(bands: Bands):
    """Pairs of classes of a group that are in different components.

    ``component`` has the components of a bucket's classes in the order of its names."""

    def run(batches):
        for batch in batches:
            for payload, told in zip(batch.column("payload").to_pylist(), batch.column("told").to_pylist()):
                names, sizes, dense, rows, cuts = _unpack_groups(payload)
                component = _components_of(names, told)
                done: set[bytes] = set()
                for a, b in zip(cuts[:-1], cuts[1:]):
                    group = rows[a:b]
                    if (component[group] == component[group[0]]).all() or group.tobytes() in done:
                        continue
                    done.add(group.tobytes())
                    for i in range(len(group) - 1):
                        rest = group[i + 1:]
                        rest = rest[component[rest] != component[group[i]]]
                        if len(rest):
                            out = _pairs(bands, names, sizes, dense, np.full(len(rest), group[i]), rest)
                            if out.num_rows:
                                yield out

    return run


def _unpack_groups(payload):
    names, sizes, dense, rows, cuts = unpack(payload)
    return (names.astype(np.int64), sizes.astype(np.int64), dense.reshape(-1, DENSE),
            rows.astype(np.int64), cuts.astype(np.int64))


def _pairs(bands, names, sizes, dense, a, b) -> pa.RecordBatch:
    ok = _may_link(bands, sizes[a], sizes[b], dense[a], dense[b])
    left, right = names[a[ok]], names[b[ok]]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right))], ["a", "b"])


# --- links and components --------------------------------------------------------------

def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose sets have Jaccard similarity num / den or more."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)],
                                             ["a", "b"])

    left = sets.select(F.col("set_id").alias("a"), F.col("payload").alias("x"))
    right = sets.select(F.col("set_id").alias("b"), F.col("payload").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y") \
        .mapInArrow(run, "a long, b long")


def connected(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over links (a, b).

    Each round takes the smallest component among neighbours and then the component of that
    one, so chains shorten by half; rounds end when nothing changes.
    """
    both = staged(links.union(links.select("b", "a")).toDF("node", "other").distinct(), "links")
    state = staged(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")),
                   "components")
    while True:
        near = both.join(state.withColumnRenamed("node", "other"), "other").groupBy("node") \
            .agg(F.min("component").alias("near"))
        lower = state.join(near, "node").select(
            "node", F.least("component", "near").alias("low"), "component")
        hop = lower.select(F.col("node").alias("low"), F.col("low").alias("hop"))
        after = staged(lower.join(hop, "low", "left").select(
            "node", F.least("low", "hop").alias("component"),
            (F.least("low", "hop") != F.col("component")).alias("moved")), "components")
        moved = after.where("moved").limit(1).count()
        state = after.drop("moved")
        if not moved:
            return state


def components(docs: DataFrame, words: int, similarity: tuple[int, int], doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``; see ``classes``."""
    rows, named = classes(docs, words, similarity, doc_id, text)
    return rows.join(named, "set_id", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def classes(docs: DataFrame, words: int, similarity: tuple[int, int], doc_id: str = "doc_id",
            text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, n_shingles, set_id) and (set_id, component_id)."""
    spark = docs.sparkSession
    num, den = similarity
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    id_field = docs.schema["doc_id"]

    def measure(batches):
        for batch in pieces(batches):
            sets = shingle_sets(batch.column("text"), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())],
                ["doc_id", "n_shingles", "set_id"])

    rows = staged(docs.mapInArrow(measure, T.StructType(
        [id_field, T.StructField("n_shingles", T.LongType()), T.StructField("set_id", T.LongType())])), "sets")
    known = rows.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(
        F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"))
    known = staged(known, "set-classes")
    bands = Bands(num, den, known.agg(F.max("n")).first()[0] or 0)
    band = F.lit(-1)
    for i, start in enumerate(bands.start.tolist()):
        band = F.when(F.col("n") >= start, F.lit(i)).otherwise(band)
    in_band = {r["band"]: r["count"] for r in known.groupBy(band.alias("band")).count().collect()}
    plan = _plan(bands, in_band)
    buckets = max([first + n for first, n in plan.values()], default=0)
    plain = known.select("set_id", F.col("first_id").alias("component_id"))
    if not buckets:
        return rows, plain

    packed = "bucket int, payload binary"
    agreed = staged(docs.mapInArrow(_send(bands, plan, words), packed)
                    .repartitionById(buckets, "bucket").sortWithinPartitions("bucket")
                    .mapInArrow(_find_groups(buckets), packed), "agreed")
    bare = staged(agreed.repartitionById(buckets, "bucket").sortWithinPartitions("bucket")
                  .mapInArrow(_settle_groups, packed), "groups")
    # every class of a group, with the bucket it is in
    members = staged(bare.mapInArrow(_members, "bucket int, set_id long"), "members")

    # whole sets of these classes only, from one text each
    asked = members.select("set_id").distinct()
    sets = staged(_whole_sets(docs, rows, asked, words), "whole-sets")
    sketches = members.join(sets.mapInArrow(_sketches, "set_id long, n long, dense binary"), "set_id") \
        .groupBy("bucket").applyInArrow(_gather, "bucket int, sketches binary")
    groups = staged(bare.join(sketches, "bucket").mapInArrow(_with_sketches, packed), "sketch-groups")
    pairs = staged(groups.mapInArrow(_stars(bands), "a long, b long").distinct(), "pairs")
    links = staged(_verified(pairs, sets, num, den), "links")
    found = connected(links)
    for turn in range(1, STAR_ROUNDS + 1):
        told = members.join(found, members["set_id"] == found["node"]).groupBy("bucket") \
            .applyInArrow(_tell, "bucket int, told binary")
        meet = _stars(bands) if turn < STAR_ROUNDS else _crossings(bands)
        more = groups.join(told, "bucket", "left").select("payload", "told") \
            .mapInArrow(meet, "a long, b long").distinct()
        extra = staged(_verified(staged(more, "pairs"), sets, num, den), "links")
        if not extra.isEmpty():
            links = links.union(extra)
            found = connected(links)
    named = known.join(found, known["set_id"] == found["node"], "left") \
        .select("set_id", "first_id", F.coalesce("component", "set_id").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return rows, staged(named.join(smallest, "component").select("set_id", "component_id"), "named")


def _members(batches):
    for batch in batches:
        for bucket, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist()):
            names = unpack(payload)[0].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(names), bucket, np.int32)), pa.array(names)], ["bucket", "set_id"])


def _tell(key, rows):
    node = rows.column("node").to_numpy()
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()),
                     "told": pa.array([pack(node, rows.column("component").to_numpy())], pa.binary())})


def _whole_sets(docs: DataFrame, rows: DataFrame, asked: DataFrame, words: int) -> DataFrame:
    """(set_id, payload) of the classes asked for, each from the text of its smallest doc_id."""
    ids = rows.join(asked, "set_id", "left_semi").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.count("doc_id").alias("named"))
    # classes without any doc_id are found by reading the texts without one
    texts = docs.join(ids.where("named > 0").select("doc_id").distinct(), "doc_id", "left_semi") \
        .union(docs.where(F.col("doc_id").isNull()))

    def run(batches):
        for batch in pieces(batches):
            sets = [s for s in shingle_sets(batch.column("text"), words) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_id(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["set_id", "payload"])

    made = texts.select("text").mapInArrow(run, "set_id long, payload binary")
    return made.dropDuplicates(["set_id"])


def keep_first(docs: DataFrame, words: int, similarity: tuple[int, int], doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """One row of each component, with its own columns: the row whose doc_id names the
    component.  Rows without words stay.  Of rows that share that doc_id and text one stays."""
    rows, named = classes(docs, words, similarity, doc_id, text)
    kept = rows.join(named, "set_id", "left").where(
        (F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id"))) \
        .select(F.col("doc_id").alias("__kept"), (F.col("n_shingles") == 0).alias("__blank"))
    kept = staged(kept, "kept")
    repeated = kept.groupBy("__kept").count().where("count > 1").limit(1).count() > 0
    ids = kept.select("__kept").distinct()
    out = docs.join(ids, docs[doc_id].eqNullSafe(ids["__kept"]), "left_semi")
    if repeated:
        blank = F.length(F.trim(F.translate(F.coalesce(F.col(text), F.lit("")), "\t\n\x0b\x0c\r", "     "))) == 0
        out = out.where(~blank).dropDuplicates([doc_id, text]).union(out.where(blank))
    return out
