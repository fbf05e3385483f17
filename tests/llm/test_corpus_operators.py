"""Shards, top-k, Jaccard join, suffix dedup, Katz model and pipeline against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderlake.llm import jaccard, katz, shards, suffixes, topk
from orderlake.llm.common import unpack


def _documents(seed=5, n=240):
    rnd = random.Random(seed)
    bits = ["".join(rnd.choice("abcdé \n") for _ in range(rnd.randint(5, 90))) for _ in range(25)]
    rows = [(i, "".join(rnd.choice(bits) if rnd.random() < 0.6 else "".join(rnd.choice("xyzé ") for _ in range(30))
                        for _ in range(rnd.randint(0, 8)))) for i in range(n)]
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (None, rows[3][1]), (1003, "a" * 150), (None, "ab" * 60),
                   (7, rows[7][1]), (1005, rows[5][1]), (1006, rows[5][1]), (1007, "A b C")]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def test_shards_hold_every_row_once(spark):
    rows = _documents()
    docs = _frame(spark, rows).withColumn("rank", F.lit(1)).withColumn("count", F.lit(2))
    got = shards.shard_documents(docs, 24).collect()
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(rows)
    sizes = collections.Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes[s] for s in range(24)) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    again = shards.shard_documents(docs.repartition(2), 24).collect()
    place = lambda x: collections.Counter((r.doc_id, r.text, r.shard, r.slot) for r in x)
    assert place(got) == place(again)
    assert shards.shard_documents(docs.where("false"), 24).count() == 0


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 100)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rnd.normal(0, 0.2, 8)]) for i in range(500)]
    rows += [(i + 500, rows[i][1]) for i in range(0, 60, 3)]
    rows += [(900, None), (1000, [1.0, None]), (1100, [float("nan")]), (1200, []), (1300, [0.5]), (None, [1.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = topk.top_k(docs, F.col("vec_id") % 100 == 0).collect()
    ok = {i: [math.floor(1024 * x) for x in v] for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in ok if i % 100 == 0):
        best = sorted((-sum(a * b for a, b in zip(ok[q], ok[i])), i) for i in ok if i != q)[:10]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want
    assert topk.top_k(docs.where("false"), F.col("vec_id") % 100 == 0).count() == 0


def _words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def _shingles(text, n):
    w = _words(text)
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def _components(rows, n, num, den):
    sets = [_shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return collections.Counter((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


def _near_copies():
    rnd = random.Random(8)
    base = [[rnd.choice("abcdefgh") + str(rnd.randint(0, 300)) for _ in range(rnd.choice([3, 6, 20, 80, 200]))] for _ in range(20)]
    rows = []
    for i in range(300):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 1, 1, 2, 4])):
            w[rnd.randrange(len(w))] = "z" + str(rnd.randint(0, 9))
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("words, num", [(4, 85), (5, 80)])
def test_components_equal_brute_force(spark, monkeypatch, words, num):
    monkeypatch.setattr(jaccard, "BUCKET_PIECES", 500)
    rows = _near_copies() + [(i + 10_000 if i is not None else None, t) for i, t in _documents(n=30)]
    got = jaccard.components(_frame(spark, rows), words, (num, 100)).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == _components(rows, words, num, 100)
    assert jaccard.components(_frame(spark, rows).where("false"), words, (num, 100)).count() == 0


def test_keep_first_keeps_one_of_each_component(spark):
    rows = _near_copies()
    docs = _frame(spark, rows + [rows[0]]).withColumn("set_id", F.lit("x"))
    want = sorted({c for _, _, c in _components(rows, 5, 80, 100)})
    assert sorted(r.doc_id for r in jaccard.keep_first(docs, 5, (80, 100)).collect()) == want


def _repeats(rows, length):
    first, out = {}, collections.Counter()
    rows = [(suffixes.NO_ID if d is None else d, (t or "").encode()) for d, t in rows]
    for d, x in rows:
        for i in range(len(x) - length + 1):
            s = x[i:i + length]
            first[s] = min(first.get(s, (d, i)), (d, i))
    for d, x in rows:
        cut = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if first[x[i:i + length]] < (d, i):
                cut[i:i + length] = b"\1" * length
        kept = bytes(c for c, z in zip(x, cut) if not z)
        spans = sum(1 for i in range(len(x)) if cut[i] and (not i or not cut[i - 1]))
        out[d, len(x), sum(cut), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("length, common", [(20, 6), (20, 3000), (100, 3000)])
def test_repeats_equal_brute_force(spark, monkeypatch, length, common):
    monkeypatch.setattr(suffixes, "COMMON", common)
    monkeypatch.setattr(suffixes, "PART_BYTES", 8000)
    rows = _documents()
    got = suffixes.repeat_digests(_frame(spark, rows), length).collect()
    assert collections.Counter((suffixes.NO_ID if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans,
                                r.kept_sha256) for r in got) == _repeats(rows, length)
    assert suffixes.repeat_digests(_frame(spark, rows).where("false"), length).count() == 0


def test_merge_is_sorted_and_knows_shared_prefixes():
    rnd = random.Random(3)
    runs = [sorted("".join(rnd.choice("ab") for _ in range(rnd.randint(0, 12))).encode() for _ in range(rnd.randint(0, 40)))
            for _ in range(7)]
    out, before = [], b""
    for shared, text, _ in suffixes.merge([suffixes.unfold(*suffixes.front_coded(r)) for r in runs]):
        assert shared == suffixes.shared_prefix(before, text, 0)
        out.append(text)
        before = text
    assert out == sorted(sum(runs, []))


def test_katz_equals_brute_force_and_sums_to_one(spark, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_BYTES", 1500)
    monkeypatch.setattr(katz, "CHUNK_BYTES", 2000)
    rows = _near_copies()[:120] + [(5000, None), (5001, ""), (5001, ""), (None, "the the")]
    got = katz.katz_scores(_frame(spark, rows)).collect()
    tokens = [(d, _words(t) + [None]) for d, t in rows]
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1
    word, pair = collections.Counter(), collections.Counter()
    for d, w in tokens:
        if not held(d):
            word.update(w)
            pair.update(zip([None, *w[:-1]], w))
    count = lambda c: np.bincount([min(v, 7) for v in c.values()], minlength=8)
    total, vocab = sum(word.values()), len(word)
    found = katz.Discounts(count(pair), count(word), total, vocab)
    d_of = lambda table, c: (table[c] if c <= katz.CUTOFF else 1.0) * c
    single = lambda w: d_of(found.word, word[w]) / found.total if word[w] else found.unknown
    after = collections.defaultdict(list)
    for (h, w), c in pair.items():
        after[h].append((w, c))
    alpha = {h: (1 - sum(d_of(found.pair, c) for _, c in ws) / (word[h] + katz.DELTA)) / (1 - sum(single(w) for w, _ in ws))
             for h, ws in after.items()}

    def p(h, w):
        c = pair.get((h, w), 0)
        return d_of(found.pair, c) / (word[h] + katz.DELTA) if c else alpha.get(h, 1.0) * single(w)

    for h in list(after)[:20]:
        assert abs(sum(p(h, w) for w in word) + alpha[h] * found.unknown - 1) < 1e-9
    want = collections.defaultdict(list)
    for d, w in tokens:
        want[d].append((held(d), len(w), sum(word[t] > 0 for t in w), total,
                        sum(math.log10((word[t] + 0.5) / (total + 0.5 * (vocab + 1))) for t in w),
                        sum(math.log10(p(h, t)) for h, t in zip([None, *w[:-1]], w))))
    assert len(got) == len(rows)
    for r in got:
        assert any(tuple(r)[1:5] == x[:4] and tuple(r)[5:] == pytest.approx(x[4:], rel=1e-9) for x in want[r.doc_id])
    assert katz.katz_scores(_frame(spark, rows).where("false")).count() == 0


@pytest.mark.parametrize("n", [  # words, then bigrams, of the training texts at sf0.01 and sf0.1
    [0, 47735, 12166, 4990, 2407, 2203, 1012, 4886], [0, 184712, 23127, 5984, 1951, 2262, 607, 2137],
    [0, 200420, 57120, 23804, 13644, 12859, 6775, 43634], [0, 1482341, 227973, 46941, 19718, 17404, 6993, 32766]])
def test_discounts_of_real_counts_of_counts_stay_good_turing(n):
    n = np.array(n)
    d, r = katz.good_turing(n), np.arange(1, katz.CUTOFF + 1)
    assert ((d[1:] > 0) & (d[1:] < 1)).all() and (np.diff(d[1:]) > 0).all()
    assert (r * n[1:6] * (1 - d[1:])).sum() == pytest.approx(n[1])  # the once-seen mass is taken off
    raw = (r + 1) * n[2:7] / n[1:6] / r
    assert raw[3] > 1
    # counts below the swollen one keep their own estimate, up to Katz's common factor
    assert np.ptp(((1 - d[1:]) / (1 - raw))[:3]) < 1e-12
    slope = np.polyfit(np.log(np.arange(1, 7)), np.log(n[1:7]), 1)[0]
    smooth = ((r + 1) / r) ** (slope + 1)
    assert (1 - d[4:]) / (1 - smooth[3:]) == pytest.approx((1 - d[1]) / (1 - raw[0]))


def test_discounts_are_katz_where_the_counts_allow_them():
    n = np.array([0, 6000, 1500, 600, 300, 170, 100, 900])
    r, a = np.arange(1, 6), 6 * n[6] / n[1]
    assert katz.good_turing(n)[1:] == pytest.approx(((r + 1) * n[2:7] / n[1:6] / r - a) / (1 - a))
    for odd in ([0] * 8, [0, 0, 9, 0, 0, 0, 0, 3], [0, 5, 0, 0, 0, 0, 0, 0], [0, 3, 9, 9, 9, 9, 9, 9],
                [0, 40, 0, 7, 0, 0, 1, 0], [0, 10, 9, 1, 1, 1, 1, 0]):
        d = katz.good_turing(np.array(odd))[1:]
        assert ((d > 0) & (d < 1)).all()


def test_pipeline_stages_pass_their_columns_on(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got.columns == [*docs.columns, "token_ids", "n_tokens"]
    rows = got.collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in docs.collect()}
    assert all(r.n_tokens == len(r.token_ids) // 4 and r.n_chars == len(r.text) for r in rows)


def test_pipeline_equals_plain_references(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    from orderlake.llm import toxicity
    from orderlake.llm.queries import vocabulary

    rnd = random.Random(21)
    prose = lambda n: " ".join(rnd.choice("abcdefgh") + str(rnd.randint(0, 5000)) for _ in range(n))
    texts, items = [prose(rnd.randint(60, 120)) for _ in range(60)], [prose(20) for _ in range(5)]
    texts += [t + " " + prose(1) for t in texts[:8]]                                    # near copies
    texts += [f"{prose(20)} {t[50:250]} {prose(20)}" for t in texts[10:16]]             # repeated passages
    texts += [texts[20][:200] + texts[21][:200]]                                        # nothing else
    texts += [f"{prose(30)} {i} {prose(30)}" for i in items]                            # leaks
    texts += [f"{prose(20)} you idiot {prose(5)} stupid moron {prose(20)}" for _ in range(60)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(d, t, "en", "web", len(t)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(d, 1, int("idiot" in t)) for d, t in rows], "doc_id long, quality int, toxic int")
    for name, table in (("documents", docs), ("labels", labels), ("benchmark", spark.createDataFrame(
            list(enumerate(items)), "item_id long, text string"))):
        table.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    stored = {n: spark.read.parquet(f"{tmp_path}/{n}.parquet") for n in ("documents", "labels")}

    # the model's verdicts are given
    model = toxicity.fit(stored["documents"], stored["labels"])
    scores = {r.doc_id: r["__score"] for r in toxicity.score_documents(stored["documents"], model, ["doc_id"]).collect()}
    clean = [(d, t) for d, t in rows if scores[d] < toxicity.REJECT]
    least = {d for d, _, c in _components(clean, 5, 80, 100) if c == d}
    single = [(d, t) for d, t in clean if d in least]
    first, cut = {}, []
    for d, t in single:
        for i in range(len(t) - 99):
            first.setdefault(t[i:i + 100], (d, i))
    for d, t in single:
        gone = {j for i in range(len(t) - 99) if first[t[i:i + 100]] < (d, i) for j in range(i, i + 100)}
        cut.append((d, "".join(c for j, c in enumerate(t) if j not in gone)))
    left = [(d, t) for d, t in cut if t]
    kept = [(d, t) for d, t in left if not any(i in t for i in items)]
    assert len(rows) > len(clean) > len(single) > len(left) > len(kept) and dict(left).items() - dict(single).items()

    reference = Tokenizer.from_file(vocabulary())
    reference.no_truncation()
    got = {r.doc_id: (r.text, r.n_chars, np.frombuffer(bytes(r.token_ids), "<u4").tolist(), r.n_tokens, r.lang, r.source)
           for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    ids = {d: reference.encode(t, add_special_tokens=False).ids for d, t in kept}
    assert got == {d: (t, len(t), ids[d], len(ids[d]), "en", "web") for d, t in kept}


def test_more_buckets_do_not_send_pieces_again():
    """A set sends each of its pieces once, and no sketch, however many buckets its band is cut into."""
    rnd = random.Random(3)
    texts = [" ".join(str(rnd.randint(0, 10 ** 6)) for _ in range(300)) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    bands = jaccard.Bands(80, 100, 400)
    family = int(bands.band(np.array([296]))[0])

    def sent(buckets):
        out = list(jaccard._send(bands, {family: (0, buckets)}, 5)([batch]))
        assert {b for r in out for b in r.column("bucket").to_pylist()} <= set(range(buckets))
        payloads = [p for r in out for p in r.column("payload").to_pylist()]
        return sum(map(len, payloads)), sum(len(unpack(p)[2]) for p in payloads)

    (few, pieces_few), (many, pieces_many) = sent(2), sent(64)
    assert pieces_few == pieces_many <= 200 * bands.pieces[family]
    assert many < 2 * few


def test_groups_of_two_buckets_become_one():
    names = np.array([1, 5, 9, 1, 5, 2, 9, 1, 5, 9], np.int64)
    kept, size, _ = jaccard._distinct_groups(names, np.array([0, 3, 5, 7]))
    assert kept.tolist() == [0, 1, 2] and size.tolist() == [3, 2, 2, 3]
    assert names[jaccard._members_of(np.array([0, 5]), np.array([3, 2]))].tolist() == [1, 5, 9, 2, 9]
