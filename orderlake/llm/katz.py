"""Language-model scoring with a Katz backoff bigram model (operator 10).

Tokens are words (A-Z lower-cased) and one end token per text.  The end token is also the
context of the first word, so a text is a ring of bigrams and every word is a context as
often as it is a token.

    P(w | h) = d(c(h,w)) c(h,w) / (c(h) + DELTA)     when c(h,w) > 0
             = alpha(h) P(w)                         otherwise (alpha = 1 for unseen h)
    P(w)     = d1(c(w)) c(w) / N, and the rest of the mass for the one unknown word

d and d1 are Good-Turing discounts for counts up to ``CUTOFF`` (larger counts stay), with
smoothed counts of counts where the plain ones allow none.
alpha(h) is the mass that the seen bigrams of h leave over, divided by the unigram mass of
the words not seen after h, so the probabilities of every context sum to one; DELTA keeps
that mass above zero when all counts are large.

Plan: two exchanges, no token rows.
1. Each task turns its texts into chunks and counts the distinct bigrams of a chunk.  One
   packed row per (chunk, word bucket) carries the bigrams whose word hashes into the
   bucket, their counts, and the texts that hold them.  A bucket adds the counts up, which
   gives c(h,w) and c(w), and returns what each text gets from the bucket, the
   counts of counts, and its part of the model: packed bigram tables by context bucket.
   Words that a sample shows to be frequent are spread over all buckets by their contexts;
   each chunk then reports their totals to every bucket.
2. A context bucket adds up the mass of its contexts, which gives alpha(h), and returns
   what the texts with unseen bigrams get from it.
A last grouping by chunk adds up the parts of each text.

Everything is counted over all texts; the sample only decides how work is spread.

Cases: a null text counts as empty (its one token is the end); without training rows all
counts are zero and every word is unknown; repeated rows are scored and counted each;
doc_id may be null or repeat.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import (flat, mix, pack, parts_for, pieces, staged, unpack,
                                  word_hashes)

#: Hash that stands for the end token; a word gets it with probability 2^-64.
END = np.uint64(0x5EED5EED5EED5EED)
#: Counts above this are not discounted.
CUTOFF = 5
#: Added to a context's count, so that some mass is always left for unseen words.
DELTA = 0.01
#: Text bytes of a chunk and text bytes that a bucket answers for.
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 12 << 20
#: Text bytes of the sample that finds frequent words.
SAMPLE_BYTES = 24 << 20

_DOC_INTS = 3 + 2 * CUTOFF + 2  # tokens, known, unseen&unknown, seen c=1.., unseen c=1.., large


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    """Bucket of a hash: equal ranges of its upper 32 bits, in order."""
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _sums(index: np.ndarray, weights: np.ndarray | None, n: int) -> np.ndarray:
    return np.bincount(index, weights, n)


def _frequent_words(docs: DataFrame, buckets: int, total: int) -> np.ndarray:
    """Hashes of words that may hold more than a quarter of a bucket's share of tokens: at
    most 4 * buckets of them, from a sample of bounded size."""
    part = docs.select("text") if total <= SAMPLE_BYTES else \
        docs.select("text").sample(False, SAMPLE_BYTES / total, 7)

    def count(batches):
        for batch in pieces(batches):
            words, _ = word_hashes(*flat(batch.column("text")))
            h, c = np.unique(words, return_counts=True)
            keep = c * 8 * buckets > len(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[keep].view(np.int64)), pa.array(c[keep]),
                 pa.array(np.full(keep.sum(), 0, np.int64))], ["h", "c", "n"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int64()), pa.array([0], pa.int64()),
                 pa.array([len(words)], pa.int64())], ["h", "c", "n"])

    sums = part.mapInArrow(count, "h long, c long, n long").groupBy("h").agg(
        F.sum("c").alias("c"), F.sum("n").alias("n"))
    rows = sums.agg(F.sum("n")).first()[0] or 0
    top = sums.where(F.col("c") * 4 * buckets > rows).orderBy(F.desc("c")).limit(4 * buckets)
    return np.sort(np.array([r["h"] for r in top.collect()], np.int64).view(np.uint64))


def _chunk_rows(ids, train, words, counts, frequent, buckets, chunk):
    """Packed rows of one chunk: (bucket, payload) for every bucket."""
    n_docs = len(ids)
    ends = np.cumsum(counts + 1) - 1
    tokens = np.full(len(words) + n_docs, END, np.uint64)
    inside = np.ones(len(tokens), bool)
    inside[ends] = False
    tokens[inside] = words
    doc = np.repeat(np.arange(n_docs), counts + 1)
    vocab, w = np.unique(tokens, return_inverse=True)
    end_id = int(np.searchsorted(vocab, END))
    h = np.concatenate(([end_id], w[:-1]))
    is_hot = np.isin(vocab, frequent)
    # (w, h) order; a frequent word's bigrams go by the context's hash instead
    target = _bucket(vocab, buckets)
    key = w.astype(np.int64) * len(vocab) + h
    order = np.argsort(key, kind="stable")
    key, doc = key[order], doc[order]
    first = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    begin = np.flatnonzero(first)
    size = np.diff(np.concatenate((begin, [len(key)])))
    pw, ph = key[begin] // len(vocab), key[begin] % len(vocab)
    seen = np.add.reduceat(train[doc].astype(np.int64), begin)
    goes = np.where(is_hot[pw], _bucket(mix(vocab[ph] + vocab[pw]), buckets), target[pw])
    by = np.argsort(goes, kind="stable")
    cuts = np.searchsorted(goes[by], np.arange(buckets + 1))
    hot = np.flatnonzero(is_hot)
    hot_total = _sums(pw, seen, len(vocab))[hot].astype(np.int64)
    for b in range(buckets):
        mine = by[cuts[b]:cuts[b + 1]]
        refs = np.repeat(begin[mine] - np.concatenate(([0], np.cumsum(size[mine])[:-1])),
                         size[mine]) + np.arange(int(size[mine].sum()))
        new = np.concatenate(([True], pw[mine][1:] != pw[mine][:-1])) if len(mine) else np.zeros(0, bool)
        runs = np.diff(np.concatenate((np.flatnonzero(new), [len(mine)]))) if len(mine) else np.zeros(0, np.int64)
        yield b, pack(vocab[pw[mine][new]], runs, vocab[ph[mine]], seen[mine], size[mine],
                      doc[refs], vocab[hot], hot_total, np.array([n_docs, chunk]))


def _count_bucket(bucket: int, rows, buckets: int, frequent: np.ndarray):
    """Counts of one word bucket; yields (kind, key, payload)."""
    messages = []
    while rows:  # the packed form goes as the arrays come
        messages.append(unpack(rows.pop(0)))
    w = np.concatenate([np.repeat(m[0], m[1]) for m in messages])
    h = np.concatenate([m[2] for m in messages])
    c = np.concatenate([m[3].astype(np.int64) for m in messages])
    sizes = [len(m[2]) for m in messages]
    for m in messages:
        m[2] = m[3] = None
    order = np.lexsort((h, w))
    w, h = w[order], h[order]
    new_pair = np.concatenate(([True], (w[1:] != w[:-1]) | (h[1:] != h[:-1]))) if len(w) else np.zeros(0, bool)
    begin = np.flatnonzero(new_pair)
    pair_count = np.add.reduceat(c[order], begin) if len(begin) else np.zeros(0, np.int64)
    pair_of = np.empty(len(order), np.int64)
    pair_of[order] = np.cumsum(new_pair) - 1
    w, h = w[begin], h[begin]
    words, word_of = np.unique(w, return_inverse=True)
    word_count = _sums(word_of, pair_count, len(words)).astype(np.int64)
    usual = ~np.isin(words, frequent)
    counted = word_count[usual]
    if len(frequent):
        total = np.zeros(len(frequent), np.int64)
        for m in messages:
            total[np.searchsorted(frequent, m[6])] += m[7].astype(np.int64)
        at = np.flatnonzero(~usual)
        word_count[at] = total[np.searchsorted(frequent, words[at])]
        # a frequent word is in many buckets; the one that its own hash names reports it
        counted = np.concatenate((counted, total[_bucket(frequent, buckets) == bucket]))
    cw = word_count[word_of]
    del c, order
    # counts of counts: bigrams, then words (frequent words have large counts)
    grams = np.bincount(np.minimum(pair_count, CUTOFF + 2), minlength=CUTOFF + 3)
    types = np.bincount(np.minimum(counted, CUTOFF + 2), minlength=CUTOFF + 3)
    tokens, vocab = int(counted.sum()), int((counted > 0).sum())
    yield "stat", 0, pack(grams, types, np.array([tokens, vocab]))
    # what each text gets from this bucket
    with np.errstate(divide="ignore"):
        log_w, log_p = np.log10(cw.astype(float)), np.log10(pair_count.astype(float))
    base, context = np.log10(cw + 0.5), np.log10(cw + DELTA)
    at, unseen = 0, []
    for m, size in zip(messages, sizes):
        n_docs, chunk = (int(x) for x in m[8])
        pair = np.repeat(pair_of[at:at + size], m[4].astype(np.int64))
        at += size
        doc = m[5].astype(np.int64)
        known, hit = cw[pair] > 0, pair_count[pair] > 0
        gain = np.where(known, -context[pair], 0.0)
        gain += np.where(pair_count[pair] > CUTOFF, log_p[pair], 0.0)
        large = ~hit & (cw[pair] > CUTOFF)
        gain += np.where(large, log_w[pair], 0.0)
        # one small class per token: 0 unknown, 1.. seen rarely, then unseen rare, then large
        kind = np.where(hit, np.where(pair_count[pair] <= CUTOFF, pair_count[pair], 2 * CUTOFF + 2),
                        np.where(large, 2 * CUTOFF + 1,
                                 np.where(known, CUTOFF + cw[pair], 0)))
        table = _sums(doc * (2 * CUTOFF + 3) + kind, None, n_docs * (2 * CUTOFF + 3))
        table = table.reshape(n_docs, -1)
        has = np.flatnonzero(table.any(axis=1))
        yield "doc", chunk, pack(has, *table[has].T, _sums(doc[known], None, n_docs).astype(np.int64)[has],
                                 _sums(doc, base[pair], n_docs)[has], _sums(doc, gain, n_docs)[has])
        miss = ~hit
        unseen.append((h[pair[miss]], np.full(int(miss.sum()), chunk), doc[miss]))
    # this bucket's part of the model, by context
    seen = pair_count > 0
    order = np.flatnonzero(seen)[np.argsort(h[seen], kind="stable")]
    mh, mc, mw = h[order], pair_count[order], cw[order]
    uh, uchunk, udoc = (np.concatenate(x) for x in zip(*unseen)) if unseen else (np.zeros(0, np.uint64),) * 3
    order = np.argsort(uh, kind="stable")
    uh, uchunk, udoc = uh[order], uchunk[order], udoc[order]
    edges = np.arange(buckets + 1)
    m_cut, u_cut = np.searchsorted(_bucket(mh, buckets), edges), np.searchsorted(_bucket(uh, buckets), edges)
    for b in range(buckets):
        m, u = slice(m_cut[b], m_cut[b + 1]), slice(u_cut[b], u_cut[b + 1])
        if m.stop > m.start or u.stop > u.start:
            yield "model", b, pack(mh[m], mc[m], mw[m], uh[u], uchunk[u], udoc[u])


def _line(n: np.ndarray) -> float | None:
    """Slope of log n(r) over log r by least squares, over the counts that occur; None where
    they give no line that falls faster than 1/r."""
    r = np.flatnonzero(n[:CUTOFF + 2] > 0)
    r = r[r > 0]
    if len(r) < 2:
        return None
    slope = float(np.polyfit(np.log(r), np.log(n[r]), 1)[0])
    return slope if slope < -1 else None


def good_turing(counts: np.ndarray) -> np.ndarray:
    """Discounts d(0..CUTOFF) from counts of counts (index = count; 0 unused).

    Katz's form: 1 - d(r) is in proportion to 1 - r*/r, so that the mass taken off is n1 / N.
    r* = (r + 1) n(r+1) / n(r) as long as that lies between 0 and r; from the first count
    where it does not (exact copies swell single n(r)), n(r) comes from the log-linear fit
    of Simple Good-Turing, whose r* always lies there.  If n1 asks for more than a whole
    count, d(r) is r*/r.  Only without once-seen entries, or without a falling line where
    one is needed, absolute discounting with n1 / (n1 + 2 n2) takes the place of r*.
    """
    n = counts.astype(float)
    d = np.ones(CUTOFF + 1)
    r = np.arange(1, CUTOFF + 1)
    kept = np.zeros(CUTOFF)                                   # r*/r
    np.divide((r + 1) * n[2:CUTOFF + 2], r * n[1:CUTOFF + 1], out=kept, where=n[1:CUTOFF + 1] > 0)
    bad = np.flatnonzero((kept <= 0) | (kept >= 1))
    if n[1] > 0 and len(bad):
        slope = _line(n)
        off = n[1] / (n[1] + 2 * n[2]) if n[2] > 0 else 0.5
        if slope is not None:
            kept[bad[0]:] = ((r + 1) / r)[bad[0]:] ** (slope + 1)
        else:
            kept[bad] = 1 - off / r[bad]
    if n[1] <= 0:
        d[1:] = 1 - 0.5 / r
        return d
    share = n[1] / (r * n[1:CUTOFF + 1] * (1 - kept)).sum()
    d[1:] = 1 - share * (1 - kept)
    if (d[1:] <= 0).any():
        d[1:] = kept
    return d


class Discounts:
    """The few global numbers of the model: discounts, N, V and the unknown word's mass."""

    def __init__(self, grams, types, tokens: int, vocab: int):
        self.pair = good_turing(np.asarray(grams))
        self.word = good_turing(np.asarray(types))
        self.tokens, self.vocab = tokens, vocab
        r = np.arange(1, CUTOFF + 1)
        taken = ((1 - self.word[1:]) * r * np.asarray(types, float)[1:CUTOFF + 1]).sum()
        # without any rare word the unknown word gets half a count
        self.short = 0.5 if taken <= 0 else 0.0
        self.total = max(tokens + self.short, 1e-9)
        self.unknown = (taken + self.short) / self.total if tokens else 1.0

    def word_mass(self, c: np.ndarray) -> np.ndarray:
        """P(w) from c(w) > 0."""
        c = c.astype(np.int64)
        return np.where(c <= CUTOFF, self.word[np.minimum(c, CUTOFF)], 1.0) * c / self.total


def _alpha_bucket(rows, found: Discounts):
    """log10 alpha(h) + log10(c(h) + DELTA) for the unseen bigrams; yields (chunk, payload)."""
    messages = [unpack(r) for r in rows]
    h, c, cw, uh, uchunk, udoc = (np.concatenate([m[i] for m in messages]) for i in range(6))
    if not len(uh):
        return
    contexts, at = np.unique(h, return_inverse=True)
    c = c.astype(np.int64)
    total = _sums(at, c, len(contexts)) + DELTA
    kept = _sums(at, np.where(c <= CUTOFF, found.pair[np.minimum(c, CUTOFF)], 1.0) * c, len(contexts))
    covered = _sums(at, found.word_mass(cw), len(contexts))
    # the words not seen after h hold at least the unknown word's mass
    alpha = (1 - kept / total) / np.maximum(1 - covered, found.unknown)
    value = np.log10(alpha) + np.log10(total)
    if not len(contexts):
        return
    where = np.minimum(np.searchsorted(contexts, uh), len(contexts) - 1)
    gain = np.where(contexts[where] == uh, value[where], 0.0)
    chunks, chunk_of = np.unique(uchunk, return_inverse=True)
    for i, chunk in enumerate(chunks):
        mine = chunk_of == i
        docs, doc_of = np.unique(udoc[mine].astype(np.int64), return_inverse=True)
        yield int(chunk), pack(docs, _sums(doc_of, gain[mine], len(docs)))


def katz_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                held_out: tuple[int, int] = (5, 1)) -> DataFrame:
    """Scores of all texts under a model of those whose crc32(doc_id as text) modulo
    ``held_out[0]`` is not ``held_out[1]`` (a null doc_id hashes as the empty text).

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    spark = docs.sparkSession
    modulo, out = held_out
    kind = docs.schema[doc_id].dataType.simpleString()
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = parts_for(total, BUCKET_BYTES)
    frequent = _frequent_words(docs, buckets, total)

    def send(batches):
        part = TaskContext.get().partitionId()
        held, size, serial = [], 0, 0

        def rows():
            chunk = part << 24 | serial
            ids = pa.concat_arrays([p[0] for p in held])
            train = np.array([zlib.crc32(b"" if i is None else str(i).encode()) % modulo != out
                              for i in ids.to_pylist()], bool)
            sink = pa.BufferOutputStream()
            table = pa.record_batch([ids, pa.array(~train)], ["doc_id", "held_out"])
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_batch(table)
            words = np.concatenate([p[1] for p in held])
            counts = np.concatenate([p[2] for p in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int32()), pa.array([chunk], pa.int64()),
                 pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["bucket", "chunk", "payload"])
            for b, payload in _chunk_rows(ids, train, words, counts, frequent, buckets, chunk):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([chunk], pa.int64()),
                     pa.array([payload], pa.binary())], ["bucket", "chunk", "payload"])

        for batch in pieces(batches, most=2 << 20):
            words, counts = word_hashes(*flat(batch.column("text")))
            held.append((_plain(batch.column("doc_id")), words, counts))
            size += int(batch.column("text").nbytes)
            if size >= CHUNK_BYTES:
                yield from rows()
                held, size, serial = [], 0, serial + 1
        if held:
            yield from rows()

    def count(batches):
        for bucket, rows in _runs(batches):
            if bucket < 0:
                for chunk, payload in rows:
                    yield _out("ids", chunk, payload)
                continue
            packed = [p for _, p in rows]
            rows.clear()
            for row in _count_bucket(bucket, packed, buckets, frequent):
                yield _out(*row)

    sent = docs.mapInArrow(send, "bucket int, chunk long, payload binary")
    # one row per (chunk, bucket); every bucket's rows come together and in chunk order
    dealt = sent.repartition(buckets, F.when(F.col("bucket") < 0, F.col("chunk"))
                             .otherwise(F.col("bucket").cast("long"))) \
        .sortWithinPartitions("bucket", "chunk")
    counted = staged(dealt.mapInArrow(count, "key long, payload binary, kind string"),
                     "katz-counts", partition_by="kind")

    stats = counted.where("kind = 'stat'").select("payload").mapInArrow(
        _add_stats, "payload binary")  # a row of 16 numbers per task
    got = [unpack(r["payload"]) for r in stats.collect()]
    grams, types, sums = ([sum(x) for x in zip(*(g[i].astype(np.int64) for g in got))] or
                          [0] * (CUTOFF + 3) for i in range(3))
    found = Discounts(grams, types, int(sums[0]), int(sums[1]))

    def back(batches):
        for _, rows in _runs(batches):
            for chunk, payload in _alpha_bucket([p for _, p in rows], found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([payload], pa.binary()),
                     pa.array(["back"])], ["key", "payload", "kind"])

    backed = counted.where("kind = 'model'").select(
        F.col("key").cast("int").alias("bucket"), F.xxhash64("payload").alias("chunk"), "payload") \
        .repartition(buckets, "bucket").sortWithinPartitions("bucket") \
        .mapInArrow(back, "key long, payload binary, kind string")
    parts = counted.where("kind in ('ids', 'doc')").unionByName(backed)
    schema = (f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, "
              "train_tokens long, base_score double, score double")
    wanted = max(buckets, 8)

    def finish(batches):
        for _, rows in _runs(batches, key="key", value=("kind", "payload")):
            yield _chunk_scores(rows, found)

    return parts.repartition(wanted, "key").sortWithinPartitions("key", "kind") \
        .select("key", "kind", "payload").mapInArrow(finish, schema)


def _plain(a):
    return a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a


def _out(kind, key, payload):
    return pa.RecordBatch.from_arrays(
        [pa.array([key], pa.int64()), pa.array([payload], pa.binary()), pa.array([kind])],
        ["key", "payload", "kind"])


def _runs(batches, key: str = "bucket", value: tuple[str, str] = ("chunk", "payload")):
    """Consecutive rows with one key, gathered from sorted batches."""
    now, rows = None, []
    for batch in batches:
        for k, a, b in zip(batch.column(key).to_pylist(), batch.column(value[0]).to_pylist(),
                           batch.column(value[1]).to_pylist()):
            if rows and k != now:
                yield now, rows
                rows = []
            now = k
            rows.append((a, b))
    if rows:
        yield now, rows


def _add_stats(batches):
    total = None
    for batch in batches:
        for p in batch.column("payload").to_pylist():
            one = [x.astype(np.int64) for x in unpack(p)]
            total = one if total is None else [a + b for a, b in zip(total, one)]
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([pack(*total)], pa.binary())], ["payload"])


def _chunk_scores(rows, found: Discounts) -> pa.RecordBatch:
    """Scores of one chunk's texts from the parts that the buckets sent."""
    table = next(pa.ipc.open_stream(p).read_next_batch() for k, p in rows if k == "ids")
    n = table.num_rows
    kinds = np.zeros((2 * CUTOFF + 3, n))
    known, base, score = np.zeros(n), np.zeros(n), np.zeros(n)
    for kind, payload in rows:
        if kind == "doc":
            part = unpack(payload)
            at = part[0].astype(np.int64)
            kinds[:, at] += part[1:2 * CUTOFF + 4]
            known[at] += part[-3]
            base[at] += part[-2]
            score[at] += part[-1]
        elif kind == "back":
            at, gain = unpack(payload)
            score[at.astype(np.int64)] += gain
    r = np.arange(1, CUTOFF + 1)
    value = np.concatenate((
        [np.log10(found.unknown)], np.log10(found.pair[1:] * r),
        np.log10(found.word[1:] * r / found.total), [-np.log10(found.total)], [0.0]))
    score += value @ kinds
    tokens = kinds.sum(axis=0)
    base -= tokens * np.log10(found.tokens + 0.5 * (found.vocab + 1))
    return pa.RecordBatch.from_arrays(
        [table.column(0), table.column(1), pa.array(tokens.astype(np.int64)),
         pa.array(known.astype(np.int64)), pa.array(np.full(n, found.tokens, np.int64)),
         pa.array(base), pa.array(score)],
        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
