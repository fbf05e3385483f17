"""One registered query per operator: its production parameters on its whole table."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import importable, scratch, staged

#: Words of the two counting rules of the token-count query.
WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD = r"[^\x20\x09-\x0D]*[A-Za-z0-9][^\x20\x09-\x0D]*"
#: Tasks that the copies of one text are spread over.
SALTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary() -> str:
    """Path of the vocabulary file; ``BPE_VOCABULARY`` names another one."""
    import public_tokenizers
    return os.environ.get("BPE_VOCABULARY") or public_tokenizers.path("byte_bpe_50k.json")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    from orderlake.llm import bpe

    def digest(codec, text):
        ids = codec.encode(text)
        return (len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                hashlib.sha256(codec.decode(ids).encode()).hexdigest())

    made = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                         T.StructField("decoded_sha256", T.StringType())])
    return bpe.map_texts(table(spark, sf_dir, "documents"), vocabulary(), ["doc_id"], made, digest)


def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 24 shuffled shards (law ``rows``)."""
    from orderlake.llm import shards
    placed = shards.shard_documents(table(spark, sf_dir, "documents"), 24)
    return placed.select(
        "doc_id", shards.record_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, with the item."""
    from orderlake.llm import decontam
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best rows for every row whose vec_id is divisible by 100 (the stated queries)."""
    from orderlake.llm import topk
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from orderlake.llm import html
    return html.extract_text(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document: four-word shingles, similarity 0.85."""
    from orderlake.llm import jaccard
    return jaccard.components(table(spark, sf_dir, "documents"), words=4, similarity=(85, 100))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after a load of all documents under two tokenizer versions, a revision (words
    without a letter or digit no longer count), the deletion of later copies of equal texts,
    and a replay of the load and the revision, which changes nothing."""
    from orderlake.llm.counts import Rollup
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", F.sha2(text.cast("binary"), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.regexp_count(text, F.lit(PLAIN_WORD)).cast("long").alias("plain_words"),
        F.octet_length(text).cast("long").alias("bytes"))
    docs = staged(docs, "counted")
    both = F.explode(F.array(
        F.struct(F.lit("words").alias("tokenizer"), F.col("words").alias("before"), F.col("plain_words").alias("after")),
        F.struct(F.lit("bytes").alias("tokenizer"), F.col("bytes").alias("before"), F.col("bytes").alias("after"))))
    rows = docs.select("doc_id", "source", "lang", "digest", both.alias("c")).select(
        "doc_id", "source", "lang", "digest", "c.*")
    none = F.lit(None).cast("long")
    load = rows.select("source", "lang", "tokenizer", F.lit("insert").alias("kind"),
                       F.col("before").alias("n_tokens"), none.alias("old_tokens"))
    revised = rows.where("before <> after").select(
        "source", "lang", "tokenizer", F.lit("revise").alias("kind"),
        F.col("after").alias("n_tokens"), F.col("before").alias("old_tokens"))
    # one text may be a third of all rows: its rows are spread over SALTS tasks
    first = docs.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")) \
        .where("copies > 1").select("digest", "first", F.explode(
            F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    gone = salted.join(first, ["digest", "salt"]).where("doc_id > first").select(
        "source", "lang", "tokenizer", F.lit("delete").alias("kind"),
        F.col("after").alias("n_tokens"), none.alias("old_tokens"))
    rollup = Rollup(spark, scratch(spark, "token-counts"))
    for batch, changes in (("load", load), ("revision", revised), ("copies", gone),
                           ("load", load), ("revision", revised)):
        rollup.commit(batch, changes)
    return rollup.totals()


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document."""
    from orderlake.llm import toxicity
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model, ["doc_id"]).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= toxicity.REJECT).cast("int").alias("predicted"))


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 100-byte strings."""
    from orderlake.llm import suffixes
    return suffixes.repeat_digests(table(spark, sf_dir, "documents"), 100)


def op10_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz backoff scores of every document."""
    from orderlake.llm.katz import katz_scores
    return katz_scores(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf in the manifest, its proof, and the root that follows from the text
    as it is now: for every second document (by checksum) without its line feeds."""
    from orderlake.llm import merkle
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = merkle.leaf_digest(*fields, F.col("text"))
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    claim = F.when(changed, merkle.leaf_digest(*fields, F.translate("text", "\n", ""))).otherwise(leaf)
    # stored, as dealing out by range reads its input twice
    rows = staged(docs.select("doc_id", "source", leaf.alias("leaf"), claim.alias("claim")), "merkle-digests")
    manifest = merkle.build(rows, F.col("source"), F.col("doc_id"), F.col("leaf"), ["doc_id", "claim"])
    proved = merkle.prove(manifest, manifest.leaves.select("tree", "rank", F.col("row.claim").alias("claim"), "row"))
    passed = F.array_join(F.transform("proof", lambda p: F.concat(p["left"], p["right"])), "")
    return proved.select(
        F.col("row.doc_id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(passed.cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation as read back from its ids, and of one made of control strings."""
    from orderlake.llm import chat
    columns = ["conv_id", "turn", "role", "text"]
    turns = table(spark, sf_dir, "conversations").select(columns)
    control = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], turns.schema)
    formatted = chat.format_conversations(turns.union(planted), vocabulary())
    return chat.conversation_digests(chat.read_turns(formatted, vocabulary()))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, each begun like the first of its twenty."""
    from orderlake.llm import trie
    return trie.prefix_trie(*rebuilt(table(spark, sf_dir, "conversations")))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) for the trie: conversation c gets the first h turns of c - c % 20 before its
    own turns from the h-th on, h = crc32(c) % 4.

    Turns of a conversation stand by ``turn``, null first, equal ones by the digest of role and
    text; rows without conv_id take no part."""
    from orderlake.llm import trie
    from orderlake.llm.scan import running
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", trie.turn_digest(role, text).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.lit(1).cast("long").alias("one"),
        F.monotonically_increasing_id().alias("number"))
    rows = staged(rows, "trie-digests")  # dealing out by range reads its input twice
    own = running(rows, "conv_id", ["turn", "digest", "number"], ["one"], label="trie-turns").select(
        "conv_id", F.col("one_before").alias("position"), "digest", "words")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4)).cast("int")
    heads = own.where("conv_id % 20 = 0 and position < 3").groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("position", "digest", "words"))).alias("head"))
    made = own.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("base", F.expr("conv_id - conv_id % 20")) \
        .join(heads, "base", "left").withColumn("h", h)
    made = made.withColumn("head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h"))) \
        .withColumn("k", F.size("head").cast("long"))
    made = staged(made.select("conv_id", "h", "k", "head", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")),
                  "trie-heads")
    # own turns move up where the head is shorter than h
    short = made.where("k < h").select("conv_id", "k")
    kept = own.where(F.col("position") >= h).join(short, "conv_id", "left").select(
        "conv_id", (F.col("position") - h + F.coalesce("k", h)).cast("long").alias("position"), "digest", "words")
    begun = made.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.position", "t.digest", "t.words")
    return begun.union(kept), made.select("conv_id", "length")


QUERIES = {
    "op1_shards": op1_shards,
    "op2_bpe": op2_bpe,
    "op3_decontamination": op3_decontamination,
    "op4_topk": op4_topk,
    "op5_html": op5_html,
    "op6_jaccard": op6_jaccard,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_suffixes": op9_suffixes,
    "op10_katz": op10_katz,
    "op11_merkle": op11_merkle,
    "op12_chat": op12_chat,
    "op13_trie": op13_trie,
}


def _crc32(text: str) -> str:
    """DuckDB expression: CRC-32 of an ASCII string."""
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), "
            f"lambda s: ascii(s)::BIGINT)), lambda a, b: {step}), 4294967295)")


def _field(value: str) -> str:
    """DuckDB expression: a value inside a Merkle leaf."""
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


_LEAF = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))

ORACLE_SQL = {
    "op4_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        r AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
                   vec_id, score
            FROM s)
        SELECT * FROM r WHERE rank <= 10""",
    "op6_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
            FROM documents),
        g AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(ws) = 0 THEN []
                WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS s
            FROM w),
        n AS (SELECT doc_id, count(*) AS c FROM g GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b USING (s)
              WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
              WHERE 100 * p.c >= 85 * (x.c + y.c - p.c)),
        t(doc_id, root) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT l.b, t.root FROM t JOIN l ON l.a = t.doc_id)
        SELECT w.doc_id, coalesce(n.c, 0) AS n_shingles, m.component_id
        FROM w LEFT JOIN n USING (doc_id)
        JOIN (SELECT doc_id, min(root) AS component_id FROM t GROUP BY doc_id) m USING (doc_id)""",
    "op7_token_counts": r"""
        WITH d AS (
            SELECT doc_id, source, lang, coalesce(text, '') AS t,
                   doc_id = min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept
            FROM documents),
        c AS (
            SELECT source, lang, kept, unnest([
                {'tokenizer': 'words', 'n': len(regexp_extract_all(t, '[^\x20\x09-\x0D]*[A-Za-z0-9][^\x20\x09-\x0D]*'))},
                {'tokenizer': 'bytes', 'n': strlen(t)}]) AS x
            FROM d)
        SELECT source, lang, x.tokenizer AS tokenizer,
               count(*) FILTER (WHERE kept)::BIGINT AS documents,
               coalesce(sum(x.n) FILTER (WHERE kept), 0)::BIGINT AS tokens
        FROM c GROUP BY ALL""",
    "op11_merkle": f"""
        WITH RECURSIVE l AS (
            SELECT doc_id, coalesce('g' || source, '-') AS tree, sha256({_LEAF} || {_field("text")}) AS leaf,
                   CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0
                        THEN sha256({_LEAF} || {_field("replace(text, chr(10), '')")})
                        ELSE sha256({_LEAF} || {_field("text")}) END AS claim
            FROM documents),
        d AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
                   count(*) OVER (PARTITION BY tree) AS n
            FROM l),
        lv(tree, level, idx, n, digest) AS (
            SELECT tree, 0, rank, n, leaf FROM d
            UNION ALL
            SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
            FROM lv WHERE n > 1 GROUP BY tree, level, idx // 3, n),
        sub AS (
            SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n
            FROM lv WHERE n = 1),
        tp(level, idx, n, digest) AS (
            SELECT 0, place, n, digest FROM sub
            UNION ALL
            SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
            FROM tp WHERE n > 1 GROUP BY level, idx // 3, n),
        steps AS (
            SELECT d.tree, d.rank, v.level AS step,
                   coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx < d.rank // pow(3, level)::BIGINT), '') AS l,
                   coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx > d.rank // pow(3, level)::BIGINT), '') AS r
            FROM d JOIN lv v ON v.tree = d.tree AND v.n > 1 AND v.idx // 3 = d.rank // pow(3, level + 1)::BIGINT
            GROUP BY ALL
            UNION ALL
            SELECT d.tree, d.rank, 1000 + v.level,
                   coalesce(string_agg(v.digest, '' ORDER BY idx) FILTER (idx < s.place // pow(3, level)::BIGINT), ''),
                   coalesce(string_agg(v.digest, '' ORDER BY idx) FILTER (idx > s.place // pow(3, level)::BIGINT), '')
            FROM d JOIN sub s USING (tree) JOIN tp v ON v.n > 1 AND v.idx // 3 = s.place // pow(3, level + 1)::BIGINT
            GROUP BY ALL),
        paths AS (
            SELECT tree, rank, string_agg(l || r, '' ORDER BY step) AS passed,
                   list({{'l': l, 'r': r}} ORDER BY step) AS path
            FROM steps GROUP BY tree, rank),
        f AS (
            SELECT d.doc_id, d.leaf, sub.digest AS subroot, (SELECT digest FROM tp WHERE n = 1) AS root,
                   sha256(coalesce(passed, '')) AS proof_sha256,
                   list_reduce(list_prepend({{'l': '', 'r': claim}}, coalesce(path, [])),
                               lambda a, b: {{'l': '', 'r': sha256(b.l || a.r || b.r)}}).r AS folded_root
            FROM d JOIN sub USING (tree) LEFT JOIN paths USING (tree, rank))
        SELECT *, folded_root = root AS verified FROM f""",
    "op12_chat": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
        e AS (
            SELECT *, role || chr(10) || text || chr(10) AS whole, role = 'assistant' AS learnt,
                   list_transform([role, text], lambda t: len(t) + len(t) - len(replace(t, '\', ''))
                       + (len(t) - len(replace(t, '</turn>', ''))) // 7
                       + (len(t) - len(replace(t, '<|endoftext|>', ''))) // 13
                       + coalesce(list_sum(list_transform(regexp_extract_all(t, '#{3,}'), lambda x: len(x) - 2)), 0)) AS sizes,
                   (len(role) - len(replace(role, ': ', ''))) // 2 AS colons
            FROM c)
        SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(whole, '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
               coalesce(sum(len(text)) FILTER (learnt), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (learnt), '')) AS loss_sha256,
               sum(list_sum(sizes) + colons + 14)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op13_trie": f"""
        WITH o AS (
            SELECT conv_id, turn, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS body,
                   len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS words
            FROM conversations WHERE conv_id IS NOT NULL),
        own AS (
            SELECT conv_id, md5(body) AS digest, words,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(body)) - 1 AS pos
            FROM o),
        c AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM o)),
        r AS (
            SELECT c.conv_id, pos, digest, words FROM c JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20 AND pos < h
            UNION ALL
            SELECT conv_id, pos, digest, words FROM c JOIN own USING (conv_id) WHERE pos >= h),
        p AS (
            SELECT conv_id, row_number() OVER w AS depth, words, string_agg(digest, '') OVER w AS key
            FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
            UNION ALL SELECT conv_id, 0, 0, '' FROM c),
        n AS (SELECT key, depth, count(*) AS n_convs, min(conv_id) AS conv_id, any_value(words) AS words
              FROM p GROUP BY key, depth),
        k AS (SELECT left(key, 32 * (depth - 1)) AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
        m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (key)),
        a AS (
            SELECT left(key, 32 * d) AS key, count(*) FILTER (n_children = 0) AS n_leaves,
                   sum((n_convs - 1) * words) AS saved
            FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM m) GROUP BY 1),
        e AS (
            SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
            FROM (SELECT conv_id, max_by(key, depth) AS key FROM p GROUP BY conv_id) GROUP BY key)
        SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, a.n_leaves,
               a.saved::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
        FROM m JOIN a USING (key) LEFT JOIN e USING (key)
        LEFT JOIN m u ON m.depth > 0 AND u.key = left(m.key, 32 * (m.depth - 1))""",
}
