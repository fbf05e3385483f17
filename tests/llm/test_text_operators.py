"""BPE, pages, decontamination, token counts, toxicity: small cases against plain references."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.llm import bpe, decontam, html, toxicity
from orderlake.llm.common import scratch
from orderlake.llm.counts import Rollup
from orderlake.llm.queries import vocabulary

ODD = [None, "", " ", "\n\n x\t\ty ", "<|endoftext|>a <|endoftext|> b", "日本語 ½Ⅷ १२", "a\x85d\x1ce",
       "don't 's'LL", "é́", "a" * 500, "  two  spaces ", "the" * 300]


def _texts(n=400):
    rnd = random.Random(4)
    return ODD + ["".join(rnd.choice("abcdehintor  .,'\n019éñß日🎉") for _ in range(rnd.randint(1, 120)))
                  for _ in range(n)]


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer
    reference = Tokenizer.from_file(vocabulary())
    reference.no_truncation()
    reference.no_padding()
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    both = bpe.encode_documents(docs, vocabulary(), ["doc_id"])
    rows = {r.doc_id: bytes(r.token_ids) for r in both.collect()}
    back = {r.doc_id: r.decoded for r in bpe.decode_documents(both, vocabulary(), ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        ids = reference.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(rows[i], "<u4").tolist() == ids
        assert back[i] == reference.decode(ids, skip_special_tokens=False)


def test_bpe_keeps_other_columns_and_takes_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", dt.date(2024, 1, 1))], "doc_id long, text string, token date")
    assert bpe.encode_documents(docs, vocabulary(), ["doc_id", "token", "text"]).first()["token"] == dt.date(2024, 1, 1)
    assert bpe.encode_documents(docs.where("false"), vocabulary(), ["doc_id"]).count() == 0


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>a", "a"),
    ("<nav><p>menu</nav><article><h1>T &amp; x</h1><p>a\n b<br>c</article><footer>f", "T & x\na b\nc"),
    ("<div class='ad'>buy</div><main><p>one<p>two<script>var a='</p>'</script></main>", "one\ntwo"),
    ("<article><p>x<section class='comments'><p>first!</section></article>", "x"),
    ("<article><aside>see also</aside><p>x<form><p>mail</form><!-- no -->y</article>", "x\ny"),
    ("<main><p>open <b>end", "open end"), ("<!-- never closed <p>x", ""),
])
def test_page_text(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    *((f"<body class='{c}'><div class='{c}' id='{c}'><article class='post {c}'><p>real text</article></div>", "real text")
      for c in ("has-sidebar", "layout with-sidebar", "no-sidebar", "comments-open", "sidebar", "ad")),
    *((f"<article><p>a<h2 id='{i}' class='{i}'>head</h2><section id='{i}'><p>real text</section><p>z</article>",
       "a\nhead\nreal text\nz") for i in ("side-effects", "related-work", "search-algorithms", "social-impact")),
    ("<main><h2 id=comments>Comments</h2><section id=comments><p>in code</section></main>", "Comments\nin code"),
    ("<form id=page><nav>n</nav><main><p>x</main></form>", "x"),
    ("<article><p>x<p title='hidden class=ad'>y<p data-id=sidebar>z</p></article>", "x\ny\nz"),
    ("<article><p>x<p class=ad>buy</p><p>y<div class='box comments'><p>first!</div></article>", "x\ny"),
    ("<main><ul><li class=ad>buy<li>x</li></ul><p>y</main>", "buy\nx\ny"),
])
def test_words_in_class_and_id_hide_no_text(page, text):
    assert html.main_text(page) == text


def test_pages_without_article_keep_the_dense_part():
    menu = "<ul>" + "<li><a href=x>item</a>" * 8 + "</ul>"
    body = "<p>" + "long sentence here " * 20 + "</p><p>short</p><p>" + "and more words " * 20 + "</p>"
    got = html.main_text(f"<body>{menu}<div>{body}</div>{menu}")
    assert "item" not in got and "short" in got and got.startswith("long sentence")


def test_pages_keep_the_dense_part_outside_article():
    cards = "<article class=card><h3><a href=x>Other</a></h3><p>teaser</article>" * 3
    body = "".join(f"<div>paragraph {i} " + "of the real text " * 20 + "</div>" for i in range(4))
    got = html.main_text(f"<body><ul><li>Home<li>About</ul><div>{body}</div><ul><li><a href=x>more</a></ul>{cards}"
                         "<p>(c) us")
    assert all(f"paragraph {i} of the real text" in got for i in range(4)) and "teaser" in got
    # short lines outside stay out, also beside an article
    assert html.main_text("<p>Home<p>About<article><p>x<p>" + "text " * 50 + "<p>y</article><p>(c) us") \
        == "x\n" + " ".join(["text"] * 50) + "\ny"


def test_pages_table(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>é</article>", "x"), (2, None, None, None)],
                                  "page_id long, url string, html string, extra string")
    got = {r.page_id: (r.text, r.n_chars) for r in html.extract_text(pages, ["page_id", "url"]).collect()}
    assert got == {1: ("é", 1), 2: ("", 0)}


def _words(rnd, n):
    return [rnd.choice("abcdefghij") + str(rnd.randint(0, 3000)) for _ in range(n)]


def test_leaks_are_found_and_clean_documents_stay(spark):
    rnd = random.Random(2)
    items = [(i, " ".join(_words(rnd, rnd.randint(8, 40)))) for i in range(60)] + [(90, None), (91, ""), (92, "one two")]
    docs, leaks = [], set()
    for d in range(200):
        words = _words(rnd, rnd.randint(0, 400))
        if d % 4 == 0:
            item = rnd.randrange(60)
            at = rnd.randint(0, len(words))
            words[at:at] = items[item][1].upper().split()
            leaks.add((d, item))
        docs.append((d, " ".join(words)))
    docs += [(900, None), (901, ""), (None, items[3][1])]
    leaks.add((None, 3))
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find_leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks and len(got) == len(leaks)
    bad = {d for d, _ in leaks}
    kept = decontam.keep_clean(docs, items)
    assert {r.doc_id for r in kept.collect()} == set(range(200)) - bad | {900, 901}
    assert decontam.find_leaks(docs, items.where("false")).count() == 0
    assert decontam.find_leaks(docs.where("false"), items).count() == 0


def test_blocks_of_items_change_no_score(spark, monkeypatch):
    rnd = random.Random(12)
    items = [(i, " ".join(f"w{int(rnd.random() ** 3 * 200)}" for _ in range(rnd.randint(5, 40)))) for i in range(40)]
    items += [(90, None), (91, ""), (3, items[3][1])]
    docs = []
    for d in range(60):
        words = _words(rnd, rnd.randint(0, 80)) + items[rnd.randrange(40)][1].split()
        docs.append((d, " ".join(w for w in words if rnd.random() < 0.93)))
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    items = spark.createDataFrame(items, "item_id long, text string")

    def found():
        rows = sorted(tuple(r) for r in decontam.find_leaks(docs, items).collect())
        return [r[:2] for r in rows], [x for r in rows for x in r[2:]]

    pairs, values = found()
    monkeypatch.setattr(decontam, "ITEMS_PER_BLOCK", 12)
    split_pairs, split_values = found()
    assert pairs and split_pairs == pairs and split_values == pytest.approx(values, rel=1e-9)


def test_wand_equals_brute_force():
    rnd = random.Random(9)
    index = decontam.build_index(list(range(80)), [" ".join(f"w{rnd.randint(0, 150)}" for _ in range(20))
                                                   for _ in range(80)], [None] * 80)
    for _ in range(60):
        terms = np.array(sorted(rnd.sample(range(len(index.words)), rnd.randint(1, 60))))
        score = np.zeros(80)
        for t in terms:
            np.add.at(score, index.item[index.start[t]:index.start[t + 1]], index.weight[index.start[t]:index.start[t + 1]])
        least = rnd.choice([0.1, 0.3, 0.5])
        assert {i for i, _ in decontam.wand(index, terms, least)} == set(np.flatnonzero(score >= least).tolist())


CHANGE = "source string, lang string, tokenizer string, kind string, n_tokens long, old_tokens long"


def test_rollup_is_additive_and_commits_once(spark):
    rollup = Rollup(spark, scratch(spark, "rollup-test"))
    assert rollup.totals().count() == 0
    load = spark.createDataFrame([("a", "en", "t1", "insert", 5, None), ("a", "en", "t1", "insert", 7, None),
                                  (None, "en", "t1", "insert", None, None)], CHANGE)
    change = spark.createDataFrame([("a", "en", "t1", "revise", 9, 7), ("a", "en", "t1", "delete", 5, None)], CHANGE)
    assert rollup.commit("1", load) and not rollup.commit("1", load)
    assert rollup.commit("2", change) and rollup.commit("3", load.where("false"))
    got = {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in rollup.totals().collect()}
    assert got == {("a", "en", "t1"): (1, 9), (None, "en", "t1"): (1, 0)}
    with pytest.raises(Exception, match="unknown kind"):
        rollup.commit("4", spark.createDataFrame([("a", "en", "t1", "move", 1, None)], CHANGE))
    assert not rollup.committed("4") and rollup.batches() == ["1", "2", "3"]


def test_toxicity_on_rows_it_never_learned_from(spark):
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(900):
        words = _words(rnd, rnd.randint(5, 60))
        toxic = int(rnd.random() < 0.3)
        for _ in range(rnd.randint(2, 4) if toxic else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(["grubzel", "grubzels", "idiot", "Grubz1x"]))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    rows += [(None, None), (5000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score_documents(docs, model, ["doc_id"]).withColumn(
        "held", toxicity.held_out(F.col("doc_id"))).join(labels, "doc_id", "left").collect()
    assert len(got) == 902 and all(0 <= r["__score"] <= 1 for r in got)
    held = [r for r in got if r.held and r.toxic is not None]
    assert sum((r["__score"] >= 0.3) == bool(r.toxic) for r in held) >= 0.95 * len(held)
    prior = toxicity.fit(docs, labels.where("toxic = 0"))
    assert prior.trees is None and toxicity.keep_clean(docs, prior).count() == 902


def test_features_of_a_text_do_not_change_with_its_size():
    prose = "You ARE an idiot, 12 of Them! "
    short, long = (dict(zip(toxicity.FEATURES, toxicity.features(prose * n, toxicity.INSULTS))) for n in (100, 5000))
    assert len(prose * 5000) > 1 << 16
    assert short["capitals"] == pytest.approx(5 / 19)
    for name in set(toxicity.FEATURES) - {"words", "hits", "kinds", "fixed_hits"}:
        assert long[name] == pytest.approx(short[name]), name
