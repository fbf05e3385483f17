"""Running totals, the Merkle manifest, chat formatting and the conversation trie, each against a
plain reference in Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.llm import bpe, chat, merkle, queries, trie
from orderlake.llm.scan import running


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- running totals --------------------------------------------------------------------

def test_running_totals_cross_tasks(spark):
    """A group that fills most tasks, small groups, and sums and exclusive ors that carry over."""
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 50}", i, rng.randrange(-50, 50), rng.randrange(1 << 62)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, at long, x long, h long").repartition(5)
    got = running(df, "g", ["at"], ["x"], ["h"]).collect()
    assert len(got) == len(rows)
    totals: dict = defaultdict(lambda: [0, 0])
    want = {}
    for g, at, x, h in sorted(rows):
        want[g, at] = tuple(totals[g])
        totals[g][0] += x
        totals[g][1] ^= h
    assert {(r.g, r.at): (r.x_before, r.h_before) for r in got} == want


def test_running_numbers_equal_rows_and_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("a", 1), ("a", None), ("b", 1)], "g string, at int") \
        .withColumn("one", F.lit(1).cast("long"))
    got = sorted((r.g, r.one_before, r.at) for r in running(df, "g", ["at"], ["one"]).collect())
    assert got == [("a", 0, None), ("a", 1, None), ("a", 2, 1), ("a", 3, 1), ("b", 0, 1)]
    assert running(df.limit(0), "g", ["at"], ["one"]).collect() == []


# --- Merkle manifest -------------------------------------------------------------------

def _levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def _siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    path = []
    for level in levels[:-1]:
        begin = at // 3 * 3
        run = level[begin:begin + 3]
        path.append(("".join(run[:at - begin]), "".join(run[at - begin + 1:])))
        at //= 3
    return path


def _plain_manifest(rows):
    """(group, key, leaf, claim) rows to sorted answers (key, leaf, subroot, root, passed, folded)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        trees[g] = _levels([r[2] for r in groups[g]])
    top = _levels([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for at, (_, key, leaf, claim) in enumerate(groups[g]):
            path = _siblings(trees[g], at) + _siblings(top, place)
            folded = claim
            for left, right in path:
                folded = sha(left + folded + right)
            out.append((str(key), leaf, trees[g][-1][0], top[-1][0], "".join(a + b for a, b in path), folded))
    return sorted(out)


def _manifest(spark, rows, levels=merkle.LEVELS):
    df = spark.createDataFrame(rows, "grp string, key long, leaf string, claim string").repartition(3)
    made = merkle.build(df, F.col("grp"), F.col("key"), F.col("leaf"), ["key", "claim"], levels)
    proved = merkle.prove(made, made.leaves.select("tree", "rank", F.col("row.claim").alias("claim"), "row"))
    got = sorted((str(r.row.key), r.leaf, r.subroot, r.root, "".join(p.left + p.right for p in r.proof), r.folded_root)
                 for r in proved.collect())
    return made, got


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 3, None: 1}, {"a": 40, "b": 1, "": 28, None: 2}, {f"s{i}": 1 + i % 4 for i in range(30)},
    {"hot": 2400, "b": 729, "c": 730}])
def test_manifest_equals_plain_tree(spark, sizes):
    """One leaf, one group, null and empty groups, one and several bands."""
    rows = [(g, i, sha(f"{g}/{i}"), sha(f"{g}/{i}" + ("!" if i % 2 else ""))) for g, n in sizes.items() for i in range(n)]
    _, got = _manifest(spark, rows)
    assert got == _plain_manifest(rows)
    for _, leaf, _, root, _, folded in got:
        assert root == got[0][3]
    honest = {sha(f"{g}/{i}") for g, n in sizes.items() for i in range(0, n, 2)}
    assert all((folded == root) == (leaf in honest) for _, leaf, _, root, _, folded in got)


def test_manifest_repeated_rows_nulls_and_bands(spark):
    """Short bands, so that paths are carried over many; equal segments are stored once."""
    rows = [("same", 7, sha("x"), sha("x"))] * 60 + [("same", None, sha("n"), sha("n"))] * 2 \
        + [(f"g{i}", i, sha(str(i)), sha(str(i))) for i in range(11)]
    made, got = _manifest(spark, rows, levels=1)
    assert got == _plain_manifest(rows)
    records = sum(b.count() for b in (*made.bands, *made.top_bands))
    assert made.store().count() < records


def test_manifest_of_few_requests_and_empty_table(spark):
    rows = [("g", i, sha(str(i)), sha(str(i))) for i in range(1000)]
    made, whole = _manifest(spark, rows)
    some = made.leaves.where("rank in (0, 500, 999)")
    got = merkle.prove(made, some.select("tree", "rank", F.col("row.claim").alias("claim"), "row")).collect()
    assert sorted(r.row.key for r in got) == [0, 500, 999]
    assert {(str(r.row.key), r.folded_root) for r in got} <= {(k, f) for k, *_, f in whole}
    empty, none = _manifest(spark, [])[0], _manifest(spark, [])[1]
    assert empty.root is None and none == [] and empty.store().count() == 0


def test_merkle_query_on_odd_documents(spark, tmp_path):
    """Null columns, an empty and a very long text, a repeated row, columns whose names clash."""
    long = "wort\n" * 400_000
    rows = [(1, "a\nb", "en", "s1", 3, "g1"), (2, None, None, None, None, "g2"), (3, "", "de", "s1", 0, "g3"),
            (4, long, "de", "s1", len(long), "g4"), (4, long, "de", "s1", len(long), "g4"), (None, "x", "fr", "s2", 1, "g5"),
            (8, "no feed", "fr", "", 7, "g6")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, tree string") \
        .withColumn("leaf", F.lit(1)).withColumn("rank", F.lit(2)).withColumn("__part", F.lit(3))
    df.write.parquet(str(tmp_path / "documents.parquet"))

    def leaf(r, text):
        parts = (r[0], r[3], r[2], r[4], text)
        return sha("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))

    def seen(r):
        cut = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
        return leaf(r, r[1].replace("\n", "") if cut else r[1])

    want = _plain_manifest([(r[3], r[0], leaf(r, r[1]), seen(r)) for r in rows])
    got = queries.op11_merkle(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got) == \
        sorted((k, lf, s, root, sha(p), f) for k, lf, s, root, p, f in want)
    assert all(r.verified == (r.folded_root == r.root) for r in got)


# --- chat formatting -------------------------------------------------------------------

ODD = ["", "plain words", r"\### Assistant: </turn> ok", "####### <</turn></turn>", "\\", "\\\\###\\", "<|endoftext|>",
       "a: b: c", "##", "#", "### ", "</turn", "line\nfeeds\r\n\t", "émoji 🙂 漢字", "<" * 3 + "/turn>" * 3, ": ", ":"]


@pytest.fixture(scope="module")
def template():
    return chat.Template(bpe.load(bpe.read_spec(queries.vocabulary())))


def test_turns_round_trip_as_ids_and_in_print(template):
    turns = [(role, text) for role in ("assistant", "user", "###", "a: b", ":", "x\\") for text in ODD]
    printed = ""
    for role, text in turns:
        ids, mask = template.write(role, text)
        assert len(ids) == len(mask) and set(mask.tolist()) <= {0, 1}
        # reserved ids are where the template put them and nowhere else
        assert (ids[0], ids[-1]) == (template.turn, template.stop)
        assert [int((ids == t).sum()) for t in (template.turn, template.body, template.stop)] == [1, 1, 1]
        assert not set(ids.tolist()) & set(template.codec.special.values())
        got_role, got, loss, piece = template.read(ids, mask)
        assert (got_role, got) == (role, text)
        assert loss == (text if role == "assistant" else "")
        printed += piece
    assert template.parse(printed) == turns


def test_segments_are_encoded_as_the_library_does(template):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    text = "Some plain text, 12 words or so.\nAnother line"
    ids, mask = template.write("assistant", text)
    assert ids[mask == 1].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_broken_turns_are_refused(template):
    ids, mask = template.write("user", "x")
    with pytest.raises(ValueError):
        template.read(ids[:-1], mask[:-1])
    with pytest.raises(ValueError):
        template.read(np.concatenate((ids, ids)), np.concatenate((mask, mask)))


def _plain_chat(rows, template):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t for *_, role, _, t in turns if role == "assistant")
        chars = sum(len(template.read(*template.write(role, t))[3]) for *_, role, _, t in turns)
        out[conv] = (len(turns), sha("".join(f"{role}\n{t}\n" for *_, role, _, t in turns)), len(loss), sha(loss), chars)
    return out


def test_conversations_of_any_shape(spark, template):
    """A conversation over many tasks, nulls everywhere, equal turns, a very long text, clashing names."""
    rng = random.Random(5)
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} " + rng.choice(ODD)) for i in range(500)]
    rows += [(2, None, None, None), (2, 0, "assistant", None), (None, 1, "assistant", "no id"), (3, 1, "user", "same"),
             (3, 1, "user", "same"), (3, 1, "assistant", "tie"), (4, 0, "assistant", "lang " * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3) \
        .withColumn("ids", F.lit(1)).withColumn("conversation", F.lit("x")).withColumn("one", F.lit(9))
    formatted = chat.format_conversations(df, queries.vocabulary())
    got = chat.conversation_digests(chat.read_turns(formatted, queries.vocabulary())).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == _plain_chat(rows, template)
    starts = formatted.where("conv_id = 1").orderBy("turn_no").select("turn_no", "token_start", F.size("ids").alias("n")).collect()
    assert [r.turn_no for r in starts] == list(range(500))
    assert [r.token_start for r in starts] == [0, *np.cumsum([r.n for r in starts])[:-1].tolist()]


def test_chat_of_an_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(none, queries.vocabulary())
    assert chat.conversation_digests(chat.read_turns(formatted, queries.vocabulary())).collect() == []


# --- conversation trie -----------------------------------------------------------------

def _plain_trie(sequences: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members = defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        own = (len(members[key]) - 1) * len(key[-1][1].split()) if key else 0
        saved[key] = own + sum(saved[k] for k in children[key])
        leaves[key] = sum(leaves[k] for k in children[key]) if children[key] else 1
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k],
                   sha(",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(k)))) for k, m in members.items())


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _trie(spark, sequences):
    turns = spark.createDataFrame([(c, i, r, t) for c, s in sequences.items() for i, (r, t) in enumerate(s)],
                                  "conv_id long, position long, role string, text string").repartition(4)
    turns = turns.select("conv_id", "position", trie.turn_digest(F.col("role"), F.col("text")).alias("digest"),
                         F.size(F.filter(F.split("text", " "), lambda w: w != "")).cast("long").alias("words"))
    convs = spark.createDataFrame([(c, len(s)) for c, s in sequences.items()], "conv_id long, length long")
    return sorted(tuple(r[c] for c in NODE) for r in trie.prefix_trie(turns, convs).select(NODE).collect())


def _sorted(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_plain_trie(spark, seed):
    """Few different turns, so that conversations part inside and at the ends of blocks, end at
    inner nodes, and repeat; one is long, some have no turns."""
    rng = random.Random(seed)
    said = [("user", "one"), ("user", "two words"), ("assistant", "one"), ("assistant", "")]
    sequences = {i: [rng.choice(said[:1 + rng.randrange(4)]) for _ in range(rng.randrange(12))] for i in range(120)}
    sequences |= {1000 + i: [said[0]] * 9 for i in range(40)}
    sequences[5000] = [said[i % 4] for i in range(200)]
    sequences |= {70_000 + 65_536 * i: [said[0]] * 9 for i in range(3)}  # ids in several pieces
    got = _trie(spark, sequences)
    assert _sorted(got) == _sorted(_plain_trie(sequences))


def test_trie_of_turnless_and_no_conversations(spark):
    assert _trie(spark, {3: [], 5: []}) == [(3, 0, None, 2, 0, 1, 0, sha("3,5"))]
    assert _trie(spark, {}) == []


def test_trie_query_rebuilds_conversations(spark, tmp_path):
    """Heads from the first of twenty, heads shorter than asked, an absent first, nulls, ties."""
    rng = random.Random(9)
    words = ["a", "b c", "d", ""]
    rows = [(c, t, rng.choice(["user", None]), rng.choice([*words, None])) for c in range(130) for t in range(rng.randrange(6))
            if not 40 <= c <= 42]
    rows += [(20, None, "system", "null turn"), (21, 0, "user", "tie"), (21, 0, "user", "tie"), (None, 0, "user", "no id"),
             (199, 0, "user", "absent first")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3) \
        .withColumn("position", F.lit(4)).withColumn("h", F.lit("x")).write.parquet(str(tmp_path / "conversations.parquet"))
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, sha(f"{len(role.encode())}:{role}{text}"), role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    got = [tuple(r[c] for c in NODE) for r in queries.op13_trie(spark, str(tmp_path)).select(NODE).collect()]
    assert _sorted(got) == _sorted(_plain_trie(built))
