"""Benchmark decontamination (operator 3).

Test items form an inverted index with BM25 weights, each weight divided by what the whole
item would score against itself, so that a passage scores between 0 and 1 for an item.
Every document is cut into overlapping passages, and every passage is a query: all items
that score ``LEAST_SCORE`` or more are retrieved with block-max WAND.  A retrieved item is a
leak when the word 3-grams of its question and of its answer are in the passage to
``LEAST_OVERLAP`` each.  An item without its own answer column is split: the last third of
its words is the answer.

WAND only looks at a passage when bounds allow a score above the threshold.  This first
test runs over all passages of a batch at once: an item's words are split into the
common ones, which together stay below half the threshold, and the rest.  Only passages whose
other words give some item the missing half go to the index.

The index is small and is sent to the workers in blocks of at most ``ITEMS_PER_BLOCK`` items;
documents are read once per block.  Number of items, items by word, average and longest item
are those of the whole benchmark in every block.

Cases: null or empty texts and items match nothing; items with equal texts are found each;
items of fewer than three words count their whole word sequence as one gram; an empty
benchmark finds nothing; repeated rows are found each; words are compared with A-Z
lower-cased.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orderlake.llm.common import flat, mix, pieces, staged, word_hashes

K1, B = 1.2, 0.75
LEAST_SCORE = 0.5
LEAST_OVERLAP = 0.6
GRAM = 3
#: Postings in a block of the index, and most items that one index holds.
BLOCK = 16
ITEMS_PER_BLOCK = 20_000


@dataclass
class Index:
    """Postings by word: ``start`` cuts ``item`` and ``weight``; ``peak`` is the largest
    weight of each block of ``BLOCK`` postings, ``block_start`` cuts it."""

    ids: list
    words: np.ndarray
    start: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    top: np.ndarray
    block_start: np.ndarray
    peak: np.ndarray
    rare: np.ndarray          # postings that are not of the item's common words
    common: np.ndarray        # by item, what its common words can give
    question: list[np.ndarray]
    answer: list[np.ndarray]
    span: int                 # words of the longest item


def grams(words: np.ndarray) -> np.ndarray:
    """Hashes of the word 3-grams; a shorter sequence is one gram."""
    if not len(words):
        return words
    n = min(GRAM, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(31) + words[i:len(words) - n + 1 + i])
    return out


@dataclass
class Totals:
    """What BM25 takes from the whole benchmark: items, words an item, words of the longest
    item, and by word (sorted hashes) the items that hold it."""

    items: int
    average: float
    span: int
    words: np.ndarray
    df: np.ndarray


def build_index(ids: list, questions: list, answers: list, least: float = LEAST_SCORE,
                totals: Totals | None = None) -> Index:
    """The index of items; ``answers`` may hold None, then the question's text is split.
    ``totals`` belong to the benchmark that the items are a block of; None: they are all."""
    q_words, a_words = _words(questions), _words(answers)
    parts = []
    for i, (q, a) in enumerate(zip(q_words, a_words)):
        if answers[i] is None and len(q) > 1:
            cut = len(q) - max(1, len(q) // 3)
            q, a = q[:cut], q[cut:]
        parts.append((q, a))
    whole = [np.concatenate(p) for p in parts]
    lengths = np.array([len(w) for w in whole], float)
    average = totals.average if totals else lengths.mean() if len(lengths) else 1.0
    average = max(average, 1.0)
    word = np.concatenate(whole) if whole else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(whole)), lengths.astype(int))
    order = np.lexsort((item, word))
    word, item = word[order], item[order]
    new = np.concatenate(([True], (word[1:] != word[:-1]) | (item[1:] != item[:-1]))) if len(word) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    tf = np.diff(np.concatenate((begin, [len(word)]))).astype(float)
    word, item = word[begin], item[begin]
    words, of, df = np.unique(word, return_inverse=True, return_counts=True)
    held, n = (totals.df[np.searchsorted(totals.words, words)], totals.items) if totals else (df, len(whole))
    idf = np.log(1 + (n - held + 0.5) / (held + 0.5))
    weight = idf[of] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[item] / average))
    own = np.bincount(item, weight, len(whole))
    weight = weight / own[item]
    start = np.concatenate(([0], np.cumsum(df))).astype(np.int64)
    top = np.maximum.reduceat(weight, start[:-1]) if len(words) else np.zeros(0)
    # common words of an item: by falling number of items, while they stay below half the threshold
    rare = np.ones(len(weight), bool)
    common = np.zeros(len(whole))
    for i in np.lexsort((weight, -df[of], item)):
        if common[item[i]] + weight[i] < least / 2:
            common[item[i]] += weight[i]
            rare[i] = False
    block_start, peak = [0], []
    for w in range(len(words)):
        for at in range(start[w], start[w + 1], BLOCK):
            peak.append(weight[at:min(at + BLOCK, start[w + 1])].max())
        block_start.append(len(peak))
    return Index(ids, words, start, item, weight, top, np.array(block_start), np.array(peak), rare,
                 common, [grams(q) for q, _ in parts], [grams(a) for _, a in parts],
                 totals.span if totals else int(lengths.max()) if len(lengths) else 0)


def _words(texts: list) -> list[np.ndarray]:
    hashes, counts = word_hashes(*flat(pa.array(texts, pa.string())))
    return np.split(hashes, np.cumsum(counts)[:-1]) if len(texts) else []


def wand(index: Index, terms: np.ndarray, least: float) -> list[tuple[int, float]]:
    """(item, score) of all items that score ``least`` or more for the distinct ``terms``
    (numbers of index words), by block-max WAND."""
    at = {int(t): int(index.start[t]) for t in terms}
    end = {t: int(index.start[t + 1]) for t in at}
    found = []
    while True:
        alive = sorted((int(index.item[p]), t) for t, p in at.items() if p < end[t])
        bound, pivot = 0.0, -1
        for i, (_, t) in enumerate(alive):
            bound += index.top[t]
            if bound >= least - 1e-12:
                pivot = i
                break
        if pivot < 0:
            return found
        target = alive[pivot][0]
        while pivot + 1 < len(alive) and alive[pivot + 1][0] == target:
            pivot += 1
        lists = [t for _, t in alive[:pivot + 1]]
        bound_until, limit = len(index.ids), 0.0
        for t in lists:
            # the block of the list that may hold the pivot item
            p = at[t] + int(np.searchsorted(index.item[at[t]:end[t]], target))
            if p >= end[t]:
                continue
            block = (p - int(index.start[t])) // BLOCK
            limit += index.peak[index.block_start[t] + block]
            last = min(int(index.start[t]) + (block + 1) * BLOCK, end[t]) - 1
            bound_until = min(bound_until, int(index.item[last]))
        if limit >= least - 1e-12:
            score = 0.0
            for t in lists:
                p = at[t] + int(np.searchsorted(index.item[at[t]:end[t]], target))
                if p < end[t] and index.item[p] == target:
                    score += index.weight[p]
                    p += 1
                at[t] = p
            if score >= least - 1e-12:
                found.append((target, float(score)))
            continue
        # no item before the nearest block end (or the next list) can reach the threshold
        following = alive[pivot + 1][0] if pivot + 1 < len(alive) else len(index.ids)
        jump = max(target + 1, min(bound_until + 1, following))
        for t in lists:
            at[t] += int(np.searchsorted(index.item[at[t]:end[t]], jump))


def _candidates(index: Index, words: np.ndarray, doc: np.ndarray, starts: np.ndarray,
                step: int, least: float):
    """(first word, past last word, document) of passages that may hold an item."""
    spot = np.searchsorted(index.words, words)
    spot = np.minimum(spot, len(index.words) - 1)
    known = index.words[spot] == words
    token = np.flatnonzero(known)
    term = spot[token]
    # one row per (token, posting of a word that is not common in the item)
    rare_before = np.concatenate(([0], np.cumsum(index.rare)))
    begin, end = rare_before[index.start[term]], rare_before[index.start[term + 1]]
    times = end - begin
    rare_at = np.flatnonzero(index.rare)
    which = np.repeat(begin - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(int(times.sum()))
    posting = rare_at[which]
    token, term = np.repeat(token, times), np.repeat(term, times)
    # a token is in the passage that starts at its step and in the one before
    place = (token - starts[doc[token]]) // step
    first_of = np.concatenate(([0], np.cumsum((np.diff(np.concatenate((starts, [len(words)]))) + step - 1) // step)))
    passage = np.concatenate((first_of[doc[token]] + place, first_of[doc[token]] + place - 1))
    posting, term = np.tile(posting, 2), np.tile(term, 2)
    ok = np.concatenate((np.ones(len(place), bool), place > 0))
    passage, posting = passage[ok], posting[ok]
    # each word counts once in a passage
    key = np.unique(passage * np.int64(len(index.item)) + posting)
    passage, posting = key // len(index.item), key % len(index.item)
    pair, of = np.unique(passage * np.int64(len(index.ids)) + index.item[posting], return_inverse=True)
    reach = np.bincount(of, index.weight[posting], len(pair)) + index.common[pair % len(index.ids)]
    hopeful = np.unique(pair[reach >= least - 1e-9] // len(index.ids))
    docs = np.searchsorted(first_of, hopeful, "right") - 1
    at = starts[docs] + (hopeful - first_of[docs]) * step
    stop = np.concatenate((starts[1:], [len(words)]))
    return at, np.minimum(at + 2 * step, stop[docs]), docs


def _leaks(index: Index, words: np.ndarray, counts: np.ndarray, least: float, overlap: float):
    """(document, item, score, question overlap, answer overlap, first word) of a batch."""
    if not len(words) or not len(index.words):
        return
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    doc = np.repeat(np.arange(len(counts)), counts)
    step = max(index.span, 8)
    for a, b, d in zip(*_candidates(index, words, doc, starts, step, least)):
        passage = words[a:b]
        spot = np.minimum(np.searchsorted(index.words, passage), len(index.words) - 1)
        terms = np.unique(spot[index.words[spot] == passage])
        held = None
        for item, score in wand(index, terms, least):
            if held is None:
                held = {n: grams_of(passage, n) for n in range(1, GRAM + 1)}
            q, r = (_share(g, held) for g in (index.question[item], index.answer[item]))
            if q >= overlap and r >= overlap:
                yield int(d), item, score, q, r, int(a - starts[d])


def grams_of(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted hashes of the n-grams of a passage, in the form of ``grams``."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(31) + words[i:len(words) - n + 1 + i])
    return np.unique(out)


def _share(item_grams: np.ndarray, held: dict[int, np.ndarray]) -> float:
    """Share of an item part's grams that a passage has; an empty part is there."""
    if not len(item_grams):
        return 1.0
    return max(float(np.isin(item_grams, g).mean()) for g in held.values())


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", question: str = "text", answer: str | None = None,
               least: float = LEAST_SCORE, overlap: float = LEAST_OVERLAP) -> DataFrame:
    """One row per (document row, item) that leaks, with its best passage: doc_id, item_id,
    score, question_overlap, answer_overlap, first_word."""
    kinds = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = (f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, question_overlap double, "
              "answer_overlap double, first_word long")
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    found = docs.sparkSession.createDataFrame([], schema)
    for index in index_blocks(items, item_id, question, answer, least):
        found = found.unionByName(rows.mapInArrow(_search(index, least, overlap, to_arrow_type(items.schema[item_id].dataType)), schema))
    return found


def index_blocks(items: DataFrame, item_id: str = "item_id", question: str = "text",
                 answer: str | None = None, least: float = LEAST_SCORE):
    """Broadcast indexes of at most ``ITEMS_PER_BLOCK`` items each."""
    spark = items.sparkSession
    part = items.select(items[item_id].alias("i"), items[question].alias("q"),
                        (items[answer] if answer else F.lit(None)).cast("string").alias("a"))
    n = part.count()
    blocks = -(-n // ITEMS_PER_BLOCK)
    counts = None if blocks <= 1 else staged(_item_words(part).groupBy("word").agg(
        F.sum("items").alias("items"), F.sum("words").alias("words"), F.max("longest").alias("longest")),
        "benchmark-words")
    for b in range(blocks):
        mine = part if blocks == 1 else part.where(F.pmod(F.xxhash64("i", "q"), F.lit(blocks)) == b)
        got = sorted(mine.collect(), key=lambda r: (r["i"] is None, r["i"], r["q"] or ""))
        if got:
            yield spark.sparkContext.broadcast(
                build_index([r["i"] for r in got], [r["q"] for r in got], [r["a"] for r in got], least,
                            None if counts is None else _totals(counts, mine)))


def _item_words(part: DataFrame) -> DataFrame:
    """Items by word, and on rows without a word the number of items, their words and the
    longest one's."""

    def count(batches):
        for batch in pieces(batches, "q", 2 << 20):
            whole = [np.concatenate(w) for w in zip(_words(batch.column("q").to_pylist()),
                                                    _words(batch.column("a").to_pylist()))]
            lengths = [len(w) for w in whole]
            word, items = np.unique(np.concatenate([np.unique(w) for w in whole]), return_counts=True)
            none = [0] * len(word)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*word.view(np.int64).tolist(), None], pa.int64()),
                 *(pa.array(v, pa.int64()) for v in ([*items.tolist(), len(whole)], [*none, sum(lengths)],
                                                     [*none, max(lengths)]))],
                ["word", "items", "words", "longest"])

    return part.mapInArrow(count, "word long, items long, words long, longest long")


def _totals(counts: DataFrame, mine: DataFrame) -> Totals:
    """Totals of the benchmark, with the words of one block only."""
    every = counts.where("word is null").first()
    got = counts.join(_item_words(mine).select("word").distinct(), "word").select("word", "items").toArrow()
    words = got.column("word").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(words)
    return Totals(every["items"], every["words"] / every["items"], every["longest"], words[order],
                  got.column("items").to_numpy()[order])


def _search(shared, least: float, overlap: float, kind: pa.DataType):
    def run(batches):
        index = shared.value
        for batch in pieces(batches, most=2 << 20):
            best: dict[tuple[int, int], tuple] = {}
            for d, item, score, q, a, at in _leaks(index, *word_hashes(*flat(batch.column("text"))),
                                                   least, overlap):
                if (d, item) not in best or best[d, item][:3] < (score, q, a):
                    best[d, item] = (score, q, a, at)
            ids = batch.column("doc_id")
            names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array([d for d, _ in best], pa.int64())),
                 pa.array([index.ids[i] for _, i in best], kind),
                 *(pa.array([v[j] for v in best.values()], pa.float64()) for j in range(3)),
                 pa.array([v[3] for v in best.values()], pa.int64())], names)

    return run


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` without a leak, all columns: a narrow filter, no join.  Only the text goes to Python."""
    kept = docs
    for index in index_blocks(items):
        kept = kept.where(~_leaky(index)(F.col(text)))
    return kept


def _leaky(shared):
    @F.arrow_udf("boolean")
    def leaky(texts: pa.Array) -> pa.Array:
        index, out = shared.value, []
        for piece in pieces([pa.RecordBatch.from_arrays([texts], ["text"])], most=2 << 20):
            bad = {d for d, *_ in _leaks(index, *word_hashes(*flat(piece.column("text"))), LEAST_SCORE, LEAST_OVERLAP)}
            out += [i in bad for i in range(piece.num_rows)]
        return pa.array(out, pa.bool_())

    return leaky
