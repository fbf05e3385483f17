"""Removal of repeated byte strings by distributed suffix sorting (operator 9).

A byte goes when a string of ``length`` bytes that covers it also starts earlier: in a
document with a smaller doc_id, or earlier in the same document.

Not every suffix is sorted.  In each string of ``length`` bytes one k-gram (k = length / 2) is
the *anchor*: the one with the smallest hash, the leftmost of equals.  Equal strings have equal
anchors at equal offsets, so suffixes that start at anchors are enough, each with the bytes
of the strings that share the anchor.  Anchors whose k-gram occurs once drop out first.

1. Tasks send the k-gram hashes of their anchors, packed, to hash buckets; a bucket tells each
   text which of them occur again.
2. Each task sorts the suffixes at those anchors, keeps the smallest of equal ones, and writes
   the run front-coded: per suffix the length of the prefix it shares with the one
   before, and the rest.
3. Runs are cut at splitters drawn from the k-grams and exchanged.  A task merges its runs with a
   loser tree whose nodes know the prefix that each loser shares with the last winner, so no
   byte of a known prefix is compared again.  The merged prefix lengths show which
   suffixes share their anchor; among those, equal strings are found by the hashes of all
   strings around the anchor, and all but the earliest are repeats.  Anchors that very
   many texts share (a common line) skip the merge: their strings are spread by hash.
4. Repeats return to their documents as intervals.

Equal whole texts are found first: one of them takes part, the others are repeats as a whole.
Hashes have 64 bits.

Cases: a null text counts as empty; texts shorter than ``length`` lose nothing; a null doc_id
comes before all others; rows that share a doc_id are readings of one document, so a string
at the same place in two of them is no repeat; an empty table has no rows; texts may have
any length (a task holds one text at a time, and its hashes).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import (flat, mix, pack, parts_for, pieces, prefix_hash,
                                  span_hash, staged, unpack)

#: Text bytes that one receiving task answers for.
PART_BYTES = 10 << 20
#: Texts that share an anchor from which on its strings are spread by hash.
COMMON = 3000
#: Sampled k-grams per range.
SAMPLES = 64
#: Key of a null doc_id.
NO_ID = -(1 << 63)


# --- anchors ---------------------------------------------------------------------------

def anchors(raw: np.ndarray, off: np.ndarray, length: int, k: int):
    """(position, first string, past last string, k-gram hash) of each anchor.

    Strings ``first .. last - 1`` are the starts whose anchor this is; positions count over
    the whole byte array, and strings never cross texts.
    """
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none, none, none.astype(np.uint64), None
    prefix = prefix_hash(raw)
    at = np.arange(len(raw) - k + 1)
    grams = span_hash(prefix, at, at + k)
    # hash above, position below: the smallest is the leftmost of the smallest hashes
    low = (grams & ~np.uint64(0x7FFFFFFF)) | at.astype(np.uint64)
    width, reach = length - k + 1, 1
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if width > reach:
        low = np.minimum(low[:len(low) - (width - reach)], low[width - reach:])
    spot = (low & np.uint64(0x7FFFFFFF)).astype(np.int64)
    ok = np.zeros(len(spot), bool)
    sizes = np.diff(off)
    for begin, size in zip(off[:-1][sizes >= length], sizes[sizes >= length]):
        ok[begin:begin + size - length + 1] = True
    starts = np.flatnonzero(ok)
    if not len(starts):
        return none, none, none, none.astype(np.uint64), None
    spot = spot[starts]
    # a run: neighbouring starts with one anchor (in one text, as invalid starts part texts)
    new = np.flatnonzero(np.concatenate(([True], (spot[1:] != spot[:-1]) | (starts[1:] != starts[:-1] + 1))))
    last = np.concatenate((new[1:], [len(starts)])) - 1
    # anchors have small hashes; mixed again they spread over all parts
    return spot[new], starts[new], starts[last] + 1, mix(grams[spot[new]]), prefix


def text_id(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def row_id(key: np.ndarray, tid: np.ndarray) -> np.ndarray:
    """Names a (doc_id, text) pair."""
    return mix(key.astype(np.int64).view(np.uint64) ^ mix(tid.astype(np.int64).view(np.uint64))).view(np.int64)


def _by_part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _batch(**columns) -> pa.RecordBatch:
    kinds = {"part": pa.int32(), "kind": pa.int32(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kinds.get(n, pa.int64())) for n, v in columns.items()], list(columns))


def _name_rows(batches):
    """(key, tid, n bytes) of each text."""
    for batch in pieces(batches, most=1 << 20):
        raw, off = flat(batch.column("text"))
        whole = raw.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array([text_id(whole[a:b]) for a, b in zip(off[:-1], off[1:])], pa.int64()),
             pa.array(np.diff(off))], ["key", "tid", "n"])


def _send_anchors(length: int, k: int, parts: int):
    """Rows (part, payload) with the anchors of a batch for one part."""

    def run(batches):
        for batch in pieces(batches, most=1 << 18):
            raw, off = flat(batch.column("text"))
            spot, _, _, grams, _ = anchors(raw, off, length, k)
            if not len(spot):
                continue
            whole = raw.tobytes()
            tids = np.array([text_id(whole[a:b]) for a, b in zip(off[:-1], off[1:])], np.int64)
            text = np.searchsorted(off, spot, "right") - 1
            order = np.lexsort((text, grams))
            grams, text = grams[order], text[order]
            cuts = np.searchsorted(_by_part(grams, parts), np.arange(parts + 1))
            packed = []
            for p in range(parts):
                mine = slice(cuts[p], cuts[p + 1])
                if mine.stop > mine.start:
                    used, at = np.unique(text[mine], return_inverse=True)
                    packed.append((p, pack(grams[mine], at, tids[used])))
            yield _batch(part=[p for p, _ in packed], payload=[x for _, x in packed])

    return run


def _repeated_anchors(common: int):
    """Rows (tid, payload): the k-grams of a text that occur elsewhere, and which are common."""

    def run(batches):
        for _, rows in _runs(batches):
            grams, tid, twice = [], [], []
            while rows:
                g, at, tids = unpack(rows.pop())
                t = tids.astype(np.int64)[at.astype(np.int64)]
                # sorted by (gram, text): neighbours show a gram that a text has twice
                same = (g[1:] == g[:-1]) & (t[1:] == t[:-1])
                new = np.concatenate(([True], ~same))
                grams.append(g[new])
                tid.append(t[new])
                twice.append(np.concatenate((same, [False]))[new])
            grams, tid, twice = np.concatenate(grams), np.concatenate(tid), np.concatenate(twice)
            order = np.lexsort((tid, grams))
            grams, tid, twice = grams[order], tid[order], twice[order]
            # equal texts count once
            begin = np.flatnonzero(np.concatenate(([True], (grams[1:] != grams[:-1]) | (tid[1:] != tid[:-1]))))
            twice = np.logical_or.reduceat(twice, begin)
            grams, tid = grams[begin], tid[begin]
            head = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
            texts = np.diff(np.concatenate((head, [len(grams)])))
            keep = np.repeat((texts > 1) | np.logical_or.reduceat(twice, head), texts)
            many = np.repeat(texts >= common, texts)[keep]
            grams, tid = grams[keep], tid[keep]
            order = np.argsort(tid, kind="stable")
            grams, tid, many = grams[order], tid[order], many[order]
            cuts = np.flatnonzero(np.concatenate(([True], tid[1:] != tid[:-1], [True]))) if len(tid) else np.zeros(1, int)
            names, packed = [], []
            for a, b in zip(cuts[:-1], cuts[1:]):
                names.append(int(tid[a]))
                packed.append(pack(grams[a:b], many[a:b]))
                if len(names) == 10_000:
                    yield _batch(tid=names, payload=packed)
                    names, packed = [], []
            if names:
                yield _batch(tid=names, payload=packed)

    return run


def _runs(batches, key: str = "part", value: str = "payload"):
    """(key, values) of consecutive rows with one key."""
    now, held = None, []
    for batch in batches:
        for k, v in zip(batch.column(key).to_pylist(), batch.column(value).to_pylist()):
            if held and k != now:
                yield now, held
                held = []
            now = k
            held.append(v)
    if held:
        yield now, held


# --- sorted runs -----------------------------------------------------------------------

def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, given that it is ``known`` at least."""
    n = min(len(a), len(b))
    at = known
    while at + 16 <= n and a[at:at + 16] == b[at:at + 16]:
        at += 16
    while at < n and a[at] == b[at]:
        at += 1
    return at


def front_coded(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(shared prefix lengths, rest lengths, rests) of sorted byte strings."""
    shared, rests, before = [], [], b""
    for s in suffixes:
        n = shared_prefix(before, s, 0)
        shared.append(n)
        rests.append(s[n:])
        before = s
    return np.array(shared, np.int64), np.array([len(r) for r in rests], np.int64), b"".join(rests)


def unfold(shared, lengths, rests: bytes):
    """(shared prefix length with the one before, string) of a front-coded run."""
    before, at = b"", 0
    for n, m in zip(shared.tolist(), lengths.tolist()):
        before = before[:n] + rests[at:at + m]
        at += m
        yield n, before


def merge(runs: list):
    """Loser-tree merge of sorted runs of (shared prefix with the one before, string).

    Yields (shared prefix with the string yielded before, string, run).  A node holds the
    loser of a match and the prefix it shares with the winner that passed; a contender that
    shares a longer prefix with the last winner is smaller without a look at any byte, and
    with equal prefixes comparison starts behind them.
    """
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    heads: list = [next(r, None) for r in runs] + [None] * (leaves - len(runs))
    text = [h[1] if h else None for h in heads]
    known = [0] * leaves
    tree = [-1] * leaves

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix becomes that with the winner."""
        if text[a] is None:
            return b, a
        if text[b] is None:
            return a, b
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        x, y = text[a], text[b]
        n = shared_prefix(x, y, known[a])
        if n == len(x) or n < len(y) and x[n] < y[n]:
            if n == len(x) == len(y) and b < a:
                a, b = b, a
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    def build(node: int) -> int:
        if node >= leaves:
            return node - leaves
        winner, tree[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    while text[winner] is not None:
        yield known[winner], text[winner], winner
        head = next(runs[winner], None) if winner < len(runs) else None
        text[winner] = head[1] if head else None
        known[winner] = head[0] if head else 0
        node = (winner + leaves) // 2
        while node:
            winner, tree[node] = play(winner, tree[node])
            node //= 2


def _suffix_runs(length: int, k: int, ranges: int):
    """From texts and their repeated k-grams to rows (kind, part, payload).

    kind 0: a sorted run; kind 1: strings around common anchors for one hash range; kind 2:
    repeats found here already."""

    def run(batches):
        for batch in _with_told(batches):
            raw, off, keys, tids, told = batch
            spot, first, last, grams, prefix = anchors(raw, off, length, k)
            if not len(spot):
                continue
            text = np.searchsorted(off, spot, "right") - 1
            asked = np.zeros(len(spot), bool)
            common = np.zeros(len(spot), bool)
            cuts = np.searchsorted(text, np.arange(len(off)))
            for t in range(len(off) - 1):
                mine = slice(cuts[t], cuts[t + 1])
                if told[t] is not None and mine.stop > mine.start:
                    listed, many = told[t]
                    where = np.minimum(np.searchsorted(listed, grams[mine]), len(listed) - 1)
                    asked[mine] = listed[where] == grams[mine]
                    common[mine] = asked[mine] & many[where]
            key, tid = keys[text], tids[text]
            at = np.flatnonzero(common)
            if len(at):
                times = last[at] - first[at]
                start = np.repeat(first[at] - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(int(times.sum()))
                of = np.repeat(at, times)
                strings = span_hash(prefix, start, start + length)
                place = start - off[text[of]]
                repeat, names = _later(strings, key[of], place)
                if len(repeat):
                    yield _repeats(key[of][repeat], tid[of][repeat], place[repeat], length)
                part = _by_part(strings[names], ranges)
                order = np.argsort(part, kind="stable")
                ends = np.searchsorted(part[order], np.arange(ranges + 1))
                for p in range(ranges):
                    pick = names[order[ends[p]:ends[p + 1]]]
                    if len(pick):
                        yield _row(1, p, pack(strings[pick], key[of][pick], tid[of][pick], place[pick]))
            at = np.flatnonzero(asked & ~common)
            if not len(at):
                continue
            # equal surroundings: the earliest goes on, the others are repeats
            begin, end = first[at], last[at] - 1 + length
            place = begin - off[text[at]]
            around = span_hash(prefix, begin, end) ^ mix((spot[at] - begin).astype(np.uint64))
            repeat, stay = _later(around, key[at], place)
            if len(repeat):
                yield _repeats(key[at][repeat], tid[at][repeat], place[repeat], (end - begin)[repeat])
            whole = raw.tobytes()
            at = at[stay]
            suffixes = [whole[a:b] for a, b in zip(spot[at].tolist(), (last[at] - 1 + length).tolist())]
            order = sorted(range(len(at)), key=suffixes.__getitem__)
            at = at[order]
            lefts = b"".join(whole[a:b] for a, b in zip(first[at].tolist(), spot[at].tolist()))
            shared, sizes, rests = front_coded([suffixes[i] for i in order])
            yield _row(0, 0, pack(
                shared, sizes, np.frombuffer(rests, np.uint8), key[at], tid[at], first[at] - off[text[at]], spot[at] - first[at], np.frombuffer(lefts, np.uint8)))

    return run


def _later(names: np.ndarray, key: np.ndarray, place: np.ndarray):
    """(indices that repeat an earlier (key, place) of the same name, the others).

    Equal (key, place) pairs of one name are all kept apart from repeats."""
    order = np.lexsort((place, key, names))
    n, a, p = names[order], key[order], place[order]
    new = np.concatenate(([True], n[1:] != n[:-1])) if len(n) else np.zeros(0, bool)
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(n) else np.zeros(0, int)
    late = (a != a[head]) | (p != p[head])
    return order[late], order[new]


def _row(kind, part, payload) -> pa.RecordBatch:
    return _batch(kind=[kind], part=[part], payload=[payload])


def _repeats(key, tid, place, size) -> pa.RecordBatch:
    return _row(2, 0, pack(row_id(key, tid), place, np.broadcast_to(size, place.shape).astype(np.int64)))


def _with_told(batches):
    """Texts of one part after the k-grams told about them: (bytes, offsets, keys, tids, told)."""
    told: dict[int, list] = {}
    now = None
    for batch in batches:
        for piece in _split(batch):
            part = piece.column("part")[0].as_py()
            if part != now:
                told, now = {}, part
            if piece.column("kind")[0].as_py() == 0:
                for tid, payload in zip(piece.column("tid").to_pylist(), piece.column("payload").to_pylist()):
                    told.setdefault(tid, []).append(unpack(payload))
                continue
            for p in pieces([piece], most=1 << 18):
                raw, off = flat(p.column("text"))
                tids = p.column("tid").to_numpy(zero_copy_only=False)
                lists = []
                for tid in tids.tolist():
                    found = told.get(tid)
                    if found:
                        grams = np.concatenate([f[0] for f in found])
                        many = np.concatenate([f[1].astype(bool) for f in found])
                        order = np.argsort(grams)
                        lists.append((grams[order], many[order]))
                    else:
                        lists.append(None)
                yield raw, off, p.column("key").to_numpy(zero_copy_only=False), tids, lists


def _split(batch: pa.RecordBatch):
    """Slices of a batch with one (part, kind)."""
    if not batch.num_rows:
        return
    part = batch.column("part").to_numpy(zero_copy_only=False)
    kind = batch.column("kind").to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((part[1:] != part[:-1]) | (kind[1:] != kind[:-1])) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(int(a), int(b - a))


# --- merged order ----------------------------------------------------------------------

def _cut_runs(splitters: list[bytes]):
    """Rows (part, payload): each run cut at the splitters; pieces start with a whole string."""
    import bisect

    def run(batches):
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                shared, lengths, rests, key, tid, place, nl, lefts = unpack(payload)
                strings = [s for _, s in unfold(shared, lengths, rests.tobytes())]
                left_at = np.concatenate(([0], np.cumsum(nl.astype(np.int64))))
                rest_at = np.concatenate(([0], np.cumsum(lengths.astype(np.int64))))
                edges = [0, *(bisect.bisect_left(strings, s) for s in splitters), len(strings)]
                for p, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    if b <= a:
                        continue
                    head = np.frombuffer(strings[a], np.uint8)
                    s, n = shared[a:b].astype(np.int64), lengths[a:b].astype(np.int64)
                    s[0], n[0] = 0, len(head)
                    yield _batch(part=[p], payload=[pack(
                        s, n, np.concatenate((head, rests[rest_at[a + 1]:rest_at[b]])), key[a:b], tid[a:b],
                        place[a:b], nl[a:b], lefts[left_at[a]:left_at[b]])])

    return run


def _merge_range(length: int, k: int, parts_out: int, hold: int = 6_000):
    """Merge the runs of a range; yields packed repeats by part."""

    def run(batches):
        for _, payloads in _runs(batches):
            parts = [unpack(p) for p in payloads]
            streams = [unfold(p[0], p[1], p[2].tobytes()) for p in parts]
            lefts = [(np.concatenate(([0], np.cumsum(p[6].astype(np.int64)))), p[7].tobytes()) for p in parts]
            ids = [(p[3].astype(np.int64), p[4].astype(np.int64), p[5].astype(np.int64), p[6].astype(np.int64)) for p in parts]
            used = [0] * len(parts)
            group: list = []
            ready: list = []
            for shared, string, source in merge(streams):
                i = used[source]
                used[source] += 1
                if shared < k and group:
                    if len(group) > 1:
                        ready += group
                    group = []
                    if len(ready) >= hold:
                        yield from _dealt(_strings_around(ready, ids, lefts, length), parts_out)
                        ready = []
                group.append((string, source, i))
            if len(group) > 1:
                ready += group
            if ready:
                yield from _dealt(_strings_around(ready, ids, lefts, length), parts_out)

    return run


def _strings_around(ready: list, ids, lefts, length: int):
    """Repeats among suffixes in whole groups: first equal surroundings, then the strings."""
    key, tid, place, nl = (np.array([ids[s][j][i] for _, s, i in ready], np.int64) for j in range(4))
    around = [lefts[s][1][lefts[s][0][i]:lefts[s][0][i + 1]] + string for string, s, i in ready]
    off = np.concatenate(([0], np.cumsum([len(c) for c in around])))
    prefix = prefix_hash(np.frombuffer(b"".join(around), np.uint8))
    names = span_hash(prefix, off[:-1], off[1:]) ^ mix(nl.astype(np.uint64))
    repeat, stay = _later(names, key, place)
    size = np.diff(off)
    if len(repeat):
        yield row_id(key[repeat], tid[repeat]), place[repeat], size[repeat]
    times = size[stay] - length + 1
    shift = np.arange(int(times.sum())) - np.repeat(np.concatenate(([0], np.cumsum(times)[:-1])), times)
    of = np.repeat(stay, times)
    start = off[of] + shift
    strings = span_hash(prefix, start, start + length)
    repeat, _ = _later(strings, key[of], place[of] + shift)
    if len(repeat):
        yield _joined(row_id(key[of][repeat], tid[of][repeat]), (place[of] + shift)[repeat], length)


def _joined(rid: np.ndarray, place: np.ndarray, length: int):
    """(row ids, starts, sizes) of single strings, neighbours joined."""
    order = np.lexsort((place, rid))
    rid, place = rid[order], place[order]
    new = np.concatenate(([True], (rid[1:] != rid[:-1]) | (place[1:] > place[:-1] + length)))
    head = np.flatnonzero(new)
    tail = np.concatenate((head[1:], [len(rid)])) - 1
    return rid[head], place[head], place[tail] - place[head] + length


def _merge_common(length: int, parts_out: int):
    """Repeats among the strings around common anchors of one hash range."""

    def run(batches):
        for _, payloads in _runs(batches):
            parts = [unpack(p) for p in payloads]
            names, key, tid, place = (np.concatenate([p[i] for p in parts]) for i in range(4))
            key, tid, place = key.astype(np.int64), tid.astype(np.int64), place.astype(np.int64)
            repeat, _ = _later(names, key, place)
            if len(repeat):
                yield from _dealt([_joined(row_id(key[repeat], tid[repeat]), place[repeat], length)], parts_out)

    return run


# --- the operator ----------------------------------------------------------------------

def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def _part_of(rid: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(rid), F.lit(parts)).cast("int")


def find_repeats(docs: DataFrame, length: int = 100, doc_id: str = "doc_id",
                 text: str = "text") -> tuple[DataFrame, int]:
    """(rows (part, payload) with the repeated intervals by row, number of parts).

    A payload holds row ids, starts and sizes in bytes; intervals may overlap."""
    if length < 8:
        raise ValueError("length is 8 bytes at least")
    spark = docs.sparkSession
    k = length // 2
    rows = docs.select(_key(docs[doc_id]).alias("key"), docs[text].alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = parts_for(total, PART_BYTES)

    named = staged(rows.mapInArrow(_name_rows, "key long, tid long, n long"), "text-names")
    told = staged(rows.mapInArrow(_send_anchors(length, k, parts), "part int, payload binary")
                  .repartitionById(parts, "part").sortWithinPartitions("part")
                  .mapInArrow(_repeated_anchors(COMMON), "tid long, payload binary"), "anchors-again")
    # equal texts: the smallest doc_id takes part
    first = staged(named.groupBy("tid", "n").agg(F.min("key").alias("key"), F.max("key").alias("top")), "texts")
    copies = named.join(first.where("top > key").select("tid", F.col("key").alias("first")), "tid") \
        .where((F.col("key") > F.col("first")) & (F.col("n") >= length)).select("key", "tid", "n")

    # each text meets what is told about it
    where = _part_of(F.col("tid"), parts)
    notes = told.join(first.select("tid"), "tid", "left_semi").select(
        where.alias("part"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("key"), "tid",
        F.lit(None).cast("string").alias("text"), "payload")
    asked = first.join(told.select("tid").distinct(), "tid", "left_semi").select("key", "tid")
    texts = _named_texts(rows, asked).select(
        where.alias("part"), F.lit(1).alias("kind"), "key", "tid", "text",
        F.lit(None).cast("binary").alias("payload"))
    runs = staged(notes.unionByName(texts).repartitionById(parts, "part").sortWithinPartitions("part", "kind")
                  .mapInArrow(_suffix_runs(length, k, parts), "kind int, part int, payload binary"),
                  "suffix-runs", partition_by="kind")
    made = "part int, payload binary"
    splitters = _splitters(runs.where("kind = 0"), k, parts)
    merged = runs.where("kind = 0").select("payload").mapInArrow(
        _cut_runs(splitters), "part int, payload binary").repartitionById(parts, "part") \
        .sortWithinPartitions("part").mapInArrow(_merge_range(length, k, parts), made)
    common = runs.where("kind = 1").select("part", "payload").repartitionById(parts, "part") \
        .sortWithinPartitions("part").mapInArrow(_merge_common(length, parts), made)
    found = merged.unionByName(common) \
        .unionByName(runs.where("kind = 2").select("payload").mapInArrow(_deal(parts), made)) \
        .unionByName(copies.mapInArrow(_whole_rows(parts), made))
    return staged(found, "repeats"), parts


def _named_texts(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """(key, tid, text) of the texts asked for; rows that share doc_id and text come once."""

    def run(batches):
        for batch in pieces(batches, most=2 << 20):
            raw, off = flat(batch.column("text"))
            whole = raw.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"),
                 pa.array([text_id(whole[a:b]) for a, b in zip(off[:-1], off[1:])], pa.int64()),
                 batch.column("text")], ["key", "tid", "text"])

    named = rows.mapInArrow(run, "key long, tid long, text string")
    return named.join(asked, ["key", "tid"], "left_semi")


def _splitters(runs: DataFrame, k: int, ranges: int) -> list[bytes]:
    """ranges - 1 k-grams that cut the sorted suffixes into about equal ranges; SAMPLES *
    ranges k-grams come to the driver at most."""

    def sample(batches):
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                shared, lengths, rests, *_ = unpack(payload)
                strings = [s[:k] for _, s in unfold(shared, lengths, rests.tobytes())]
                step = max(1, len(strings) // 32)
                some = strings[step // 2::step]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], ["gram"])

    grams = runs.select("payload").mapInArrow(sample, "gram binary")
    grams = grams.withColumn("draw", F.xxhash64("gram")).orderBy("draw").limit(SAMPLES * ranges)
    got = sorted(bytes(r["gram"]) for r in grams.select("gram").collect())
    return sorted({got[len(got) * i // ranges] for i in range(1, ranges)}) if got else []


def _whole_rows(parts: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                key, tid, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "tid", "n"))
                yield from _dealt([(row_id(key, tid), np.zeros(len(n), np.int64), n)], parts)

    return run


def _deal(parts: int):
    def run(batches):
        for batch in batches:
            yield from _dealt((unpack(p) for p in batch.column("payload").to_pylist()), parts)

    return run


def _dealt(repeats, parts: int):
    """Rows (part, payload) of repeats, by the part of the texts they are in."""
    for found in repeats:
        rid, place, size = (x.astype(np.int64) for x in found)
        part = _by_part(mix(rid.view(np.uint64)), parts)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        picks = [(p, order[cuts[p]:cuts[p + 1]]) for p in range(parts) if cuts[p + 1] > cuts[p]]
        if picks:
            yield _batch(part=[p for p, _ in picks],
                         payload=[pack(rid[x], place[x], size[x]) for _, x in picks])


def spans_of(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs (starts, ends) of overlapping or touching intervals."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], (begin + size)[order]
    reach = np.maximum.accumulate(end)
    new = np.flatnonzero(np.concatenate(([True], begin[1:] > reach[:-1])))
    return begin[new], reach[np.concatenate((new[1:], [len(begin)])) - 1]


def _apply(docs: DataFrame, length: int, doc_id: str, text: str, finish, schema) -> DataFrame:
    """Bring every row of ``docs`` together with its repeats and call ``finish(batch, spans)``."""
    repeats, parts = find_repeats(docs, length, doc_id, text)
    names = docs.columns

    def name(batches):
        for batch in pieces(batches, text, 2 << 20):
            raw, off = flat(batch.column(text))
            whole = raw.tobytes()
            tids = np.array([text_id(whole[a:b]) for a, b in zip(off[:-1], off[1:])], np.int64)
            rid = row_id(batch.column("__key").to_numpy(zero_copy_only=False), tids)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(rid),
                 pa.array(_by_part(mix(rid.view(np.uint64)), parts).astype(np.int32))], [*names, "__rid", "__part"])

    fields = [*docs.schema.fields, T.StructField("__rid", T.LongType()), T.StructField("__part", T.IntegerType())]
    rows = docs.withColumn("__key", _key(docs[doc_id])).mapInArrow(name, T.StructType(fields)) \
        .withColumn("__kind", F.lit(1)).withColumn("__payload", F.lit(None).cast("binary"))
    notes = repeats.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields],
                           F.lit(None).cast("long").alias("__rid"), F.col("part").alias("__part"),
                           F.lit(0).alias("__kind"), F.col("payload").alias("__payload"))

    def run(batches):
        now, rid, begin, size = None, None, None, None
        held: list = []
        for batch in batches:
            part_of = batch.column("__part").to_numpy(zero_copy_only=False)
            kind_of = batch.column("__kind").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((part_of[1:] != part_of[:-1]) | (kind_of[1:] != kind_of[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if b <= a:
                    continue
                piece = batch.slice(int(a), int(b - a))
                if part_of[a] != now:
                    now, held, rid = part_of[a], [], None
                if kind_of[a] == 0:
                    held += [unpack(p) for p in piece.column("__payload").to_pylist()]
                    continue
                if rid is None:
                    rid, begin, size = (np.concatenate([h[i].astype(np.int64) for h in held]) if held
                                        else np.zeros(0, np.int64) for i in range(3))
                    order = np.argsort(rid, kind="stable")
                    rid, begin, size, held = rid[order], begin[order], size[order], []
                for p in pieces([piece], text, 2 << 20):
                    own = p.column("__rid").to_numpy(zero_copy_only=False)
                    lo, hi = np.searchsorted(rid, own), np.searchsorted(rid, own, "right")
                    yield finish(p.select(names), [spans_of(begin[x:y], size[x:y]) if y > x else None
                                                   for x, y in zip(lo, hi)])

    return rows.unionByName(notes).repartitionById(parts, "__part").sortWithinPartitions("__part", "__kind") \
        .mapInArrow(run, schema)


def _kept(raw: bytes, spans) -> bytes:
    if spans is None:
        return raw
    out, at = [], 0
    for a, b in zip(*(x.tolist() for x in spans)):
        out.append(raw[at:a])
        at = b
    return b"".join((*out, raw[at:]))


def repeat_digests(docs: DataFrame, length: int = 100, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    schema = T.StructType([docs.schema[doc_id], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                           T.StructField("kept_sha256", T.StringType())])

    def finish(batch, spans):
        raw, off = flat(batch.column(text))
        whole = raw.tobytes()
        kept = [_kept(whole[a:b], s) for a, b, s in zip(off[:-1], off[1:], spans)]
        size = np.diff(off)
        return pa.RecordBatch.from_arrays(
            [batch.column(doc_id), pa.array(size), pa.array(size - np.array([len(x) for x in kept], np.int64)),
             pa.array([0 if s is None else len(s[0]) for s in spans], pa.int64()),
             pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())],
            [doc_id, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _apply(docs.select(doc_id, text), length, doc_id, text, finish, schema)


def remove_repeats(docs: DataFrame, length: int = 100, doc_id: str = "doc_id", text: str = "text",
                   n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with the repeats cut out of the text, and its length in ``n_chars`` (where that
    column is there).  Bytes of a character that was cut in two go with it; rows that lose
    all their text go."""
    names = docs.columns

    def finish(batch, spans):
        changed = [i for i, s in enumerate(spans) if s is not None]
        if not changed:
            return batch
        texts = batch.column(text).to_pylist()
        for i in changed:
            texts[i] = _kept(texts[i].encode(), spans[i]).decode("utf-8", "ignore")
        columns = {c: batch.column(c) for c in names}
        columns[text] = pa.array(texts, batch.column(text).type)
        if n_chars in columns:
            sizes = columns[n_chars].to_pylist()
            for i in changed:
                sizes[i] = len(texts[i])
            columns[n_chars] = pa.array(sizes, columns[n_chars].type)
        out = pa.RecordBatch.from_arrays(list(columns.values()), names)
        return out.filter(pa.array([spans[i] is None or bool(t) for i, t in enumerate(texts)], pa.bool_()))

    return _apply(docs, length, doc_id, text, finish, docs.schema)
