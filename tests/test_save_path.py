"""The save path: parts, schema reconciliation, changes, emptied groups, what others wrote."""

import datetime as dt
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderlake.functions.digest import drop_duplicate_rows
from orderlake.sources import versions as V
from orderlake.sources.reconcile import SchemaConflict, common_schema, conform
from orderlake.sources.upsert import read_changes, save_with_merge, stored_versions

DAY = dt.date(2024, 1, 1)


def _frame(spark, rows, ddl="k INT, v INT"):
    return spark.createDataFrame(rows, ddl)


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def _files(folder) -> set[str]:
    return {str(p) for p in Path(folder).rglob("*.parquet")}


# --- parts -----------------------------------------------------------------------------

def test_small_batch_writes_few_parts(spark, tmp_path):
    """1% of the keys: about as many of the parts are written, the other files are as they were."""
    path = tmp_path / "t"
    save = lambda rows: save_with_merge(rows, str(path), "ol_parts", "t", ["k"], DAY, parts=200)
    save(_frame(spark, [(i, i) for i in range(400)]))
    before = _files(path)
    assert len(before) > 120
    out = save(_frame(spark, [(i, -i) for i in (7, 19, 300, 399)]))
    written = _files(f"{path}__v1_part")
    assert 1 <= len(written) <= 4
    assert _files(path) == before
    assert _rows(out, "k", "v") == sorted(((i, -i if i in (7, 19, 300, 399) else i) for i in range(400)), key=str)
    # the catalog shows the same rows, and the path alone does too
    for again in (spark.table("ol_parts.t"), V.read_saved(spark, str(path))):
        assert _rows(again, "k", "v") == _rows(out, "k", "v")


def test_only_touched_parts_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    save_with_merge(_frame(spark, [(i, i) for i in range(100)]), path, "ol_parts", "r", ["k"], DAY, parts=50)
    state = V.current(spark, path)
    some = sorted(state.parts)[:3]
    assert set(state.read(spark, some).inputFiles()) <= {f for d in some for f in spark.read.parquet(state.parts[d]).inputFiles()}


def test_table_is_dealt_into_parts_by_its_size(spark, tmp_path, monkeypatch):
    """A flat first load is dealt out at its first merge, by stored bytes, and again when the keys change."""
    from orderlake.sources import upsert
    path = str(tmp_path / "t")
    monkeypatch.setattr(upsert, "PART_BYTES", 500)
    save = lambda rows, keys: save_with_merge(rows, path, "ol_parts", "s", keys, DAY)
    save(_frame(spark, [(i, i) for i in range(500)]), "k")
    assert set(V.current(spark, path).parts) == {V.WHOLE}
    save(_frame(spark, [(1, -1)]), "k")
    first = set(V.current(spark, path).parts)
    assert len(first) > 3
    out = save(_frame(spark, [(2, 2), (2, 5)]), "k,v")
    assert not first & set(V.current(spark, path).parts)
    assert _rows(out, "k", "v") == sorted([(i, -1 if i == 1 else i) for i in range(500)] + [(2, 5)], key=str)


def test_many_random_batches_equal_a_dictionary(spark, tmp_path):
    """Upserts with inserts, updates and null keys, old versions removed on the way."""
    rng, path, want, nulls = random.Random(1), str(tmp_path / "t"), {}, []
    for batch in range(5):
        rows = {rng.randrange(60): rng.randrange(1000) for _ in range(rng.randrange(1, 15))}
        want |= rows
        lost = [rng.randrange(9) for _ in range(rng.randrange(3))]
        nulls += lost
        out = save_with_merge(_frame(spark, [*rows.items(), *((None, v) for v in lost)]), path, "ol_parts", "many", "k",
                              DAY, parts=None if batch == 0 else 4)
        assert Counter(map(tuple, out.select("k", "v").collect())) == Counter([*want.items(), *((None, v) for v in nulls)])
        assert Counter(map(tuple, spark.table("ol_parts.many").select("k", "v").collect())) == \
            Counter([*want.items(), *((None, v) for v in nulls)])


def test_groups_that_lose_all_rows(spark, tmp_path):
    """A group named without rows goes, and stays gone when older versions are removed."""
    path = str(tmp_path / "lines")
    save = lambda rows, groups=None: save_with_merge(
        _frame(spark, rows), path, "ol_parts", "lines", None, DAY, replace_by=["k"], parts=4,
        groups=None if groups is None else _frame(spark, [(g,) for g in groups], "k INT"))
    save([(k, v) for k in range(12) for v in range(2)])
    out = save([(1, 9)], groups=[1, 2, 3])
    want = sorted([(1, 9), *((k, v) for k in [0, *range(4, 12)] for v in range(2))], key=str)
    assert _rows(out, "k", "v") == want
    for v in range(3):
        out = save([(20, v)])
        want = sorted([r for r in want if r[0] != 20] + [(20, v)], key=str)
        assert _rows(out, "k", "v") == want
    # all groups of one part at once
    out = save([], groups=list(range(30)))
    assert _rows(out, "k", "v") == []
    assert _rows(save([(5, 5)]), "k", "v") == [(5, 5)]


def test_null_groups_are_kept_and_null_safe_keys_match(spark, tmp_path):
    path = str(tmp_path / "n")
    for v in (1, 2):
        out = save_with_merge(_frame(spark, [(None, v), (1, v)]), path, "ol_parts", "n", None, DAY, replace_by=["k"])
    assert _rows(out, "k", "v") == [(1, 2), (None, 1), (None, 2)]
    path = str(tmp_path / "safe")
    for v in (1, 2, 3):
        out = save_with_merge(_frame(spark, [(None, v), (1, v)]), path, "ol_parts", "safe", ["k"], DAY, null_safe=True)
    assert _rows(out, "k", "v") == [(1, 3), (None, 3)]


def test_appended_batches_by_name(spark, tmp_path):
    path = str(tmp_path / "log")
    save = lambda rows, batch: save_with_merge(_frame(spark, rows), path, "ol_parts", "log", None, DAY, append=True,
                                               batch=batch)
    save([(1, 1)], None)
    save([(2, 2)], "2024-01-02/a")
    save([(3, 3)], None)
    out = save([(2, 2)], "2024-01-02/a")  # a repeated load
    assert _rows(out, "k", "v") == [(1, 1), (2, 2), (3, 3)]
    assert _rows(save([], "2024-01-02/a"), "k", "v") == [(1, 1), (3, 3)]
    assert _rows(spark.table("ol_parts.log"), "k", "v") == [(1, 1), (3, 3)]


# --- what is there already -------------------------------------------------------------

def test_unmarked_files_of_others_are_the_table(spark, tmp_path):
    """Written with success marks off, or by something else: merged into, never written over."""
    path = tmp_path / "foreign"
    _frame(spark, [(1, 1), (2, 2)]).write.parquet(str(path))
    (path / "_SUCCESS").unlink()
    before = _files(path)
    for v in (20, 21, 22):
        out = save_with_merge(_frame(spark, [(2, v), (3, v)]), str(path), "ol_parts", "foreign", "k", DAY)
    assert _rows(out, "k", "v") == [(1, 1), (2, 22), (3, 22)]
    assert _rows(out.where("k = 1"), "load_date") == [(None,)]
    assert _files(path) == before


def test_names_like_versions(spark, tmp_path):
    for name in ("store__visits", "a__vb__v", "x__v1_parts"):
        path = str(tmp_path / name)
        for v in (1, 2, 3):
            out = save_with_merge(_frame(spark, [(v, v)]), path, "ol_parts", name, "k", DAY)
        assert _rows(out, "k", "v") == [(1, 1), (2, 2), (3, 3)]
    with pytest.raises(ValueError):
        save_with_merge(_frame(spark, [(1, 1)]), str(tmp_path / "x__v3"), "ol_parts", "x", "k", DAY)
    assert not (tmp_path / "x__v3").exists()


def test_empty_folder_and_empty_first_load(spark, tmp_path):
    (tmp_path / "t").mkdir()
    save_with_merge(_frame(spark, []), str(tmp_path / "t"), "ol_parts", "e", "k", DAY)
    out = save_with_merge(_frame(spark, [(1, 1)]), str(tmp_path / "t"), "ol_parts", "e", "k", DAY)
    assert _rows(out, "k", "v") == [(1, 1)]
    out = save_with_merge(_frame(spark, []), str(tmp_path / "t"), "ol_parts", "e", "k", DAY)
    assert _rows(out, "k", "v") == [(1, 1)]
    for parts in (None, 3):  # nothing, again and again, then something
        path = str(tmp_path / f"e{parts}")
        for rows in ([], [], [], [], [(2, 2)]):
            out = save_with_merge(_frame(spark, rows), path, "ol_parts", f"e{parts}", "k", DAY, parts=parts)
            assert _rows(out, "k", "v") == rows and out.columns == ["k", "v", "load_date"]


def test_second_writer_fails_and_a_failed_save_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    save_with_merge(_frame(spark, [(1, 1)]), path, "ol_parts", "w", "k", DAY)
    with V.claimed(spark, path):
        with pytest.raises(V.SaveConflict):
            save_with_merge(_frame(spark, [(2, 2)]), path, "ol_parts", "w", "k", DAY)
    bad = _frame(spark, [(3, 3)]).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        save_with_merge(bad, path, "ol_parts", "w", "k", DAY)
    assert stored_versions(spark, path) == [(0, f"file:{path}")]
    out = save_with_merge(_frame(spark, [(4, 4)]), path, "ol_parts", "w", "k", DAY)
    assert _rows(out, "k", "v") == [(1, 1), (4, 4)]


def test_leftovers_of_a_cut_off_save_do_not_count(spark, tmp_path):
    path = tmp_path / "t"
    save_with_merge(_frame(spark, [(1, 1)]), str(path), "ol_parts", "cut", "k", DAY)
    _frame(spark, [(9, 9)]).write.parquet(f"{path}__v1_part/key_part=00000-00001-00000000")  # no mark
    out = save_with_merge(_frame(spark, [(2, 2)]), str(path), "ol_parts", "cut", "k", DAY)
    assert _rows(out, "k", "v") == [(1, 1), (2, 2)]
    out = save_with_merge(_frame(spark, [(3, 3)]), str(path), "ol_parts", "cut", "k", DAY)
    assert _rows(out, "k", "v") == [(1, 1), (2, 2), (3, 3)]


# --- schemas ---------------------------------------------------------------------------

def test_missing_new_and_widened_columns(spark, tmp_path):
    """Rows of older batches keep what a batch does not have; parts that are not written again read
    as the wider type."""
    path = str(tmp_path / "t")
    save = lambda rows, ddl: save_with_merge(_frame(spark, rows, ddl), path, "ol_parts", "drift", "k", DAY, parts=8)
    save([(i, i * 10, "a") for i in range(20)], "k INT, v INT, note STRING")
    save([(0, "b")], "k INT, note STRING")
    out = save([(1 << 40, 1 << 50, 2.5)], "k BIGINT, v BIGINT, rate DOUBLE")
    want = [(i, i * 10, "a", None) for i in range(1, 20)] + [(0, None, "b", None), (1 << 40, 1 << 50, None, 2.5)]
    assert out.columns == ["k", "v", "note", "load_date", "rate"]
    assert dict(out.dtypes)["v"] == "bigint"
    for got in (out, spark.table("ol_parts.drift")):
        assert _rows(got, "k", "v", "note", "rate") == sorted(want, key=str)


def test_conflicts_are_refused_before_a_row_is_written(spark, tmp_path):
    path = str(tmp_path / "t")
    save_with_merge(_frame(spark, [(1, "x", 2.0)], "k INT, v STRING, w DOUBLE"), path, "ol_parts", "conflict", "k", DAY)
    with pytest.raises(SchemaConflict, match="v: string is stored, int comes.*w: double is stored, bigint comes"):
        save_with_merge(_frame(spark, [(1, 2, 3)], "k INT, v INT, w BIGINT"), path, "ol_parts", "conflict", "k", DAY)
    assert len(stored_versions(spark, path)) == 1
    assert _rows(save_with_merge(_frame(spark, [(2, "y", 1.0)], "k INT, v STRING, w DOUBLE"), path, "ol_parts", "conflict",
                                 "k", DAY), "k", "v") == [(1, "x"), (2, "y")]


def test_nested_schemas_meet(spark):
    a = spark.createDataFrame([((1, [{"x": 1}], {"m": 1}),)], "s STRUCT<i INT, l ARRAY<STRUCT<x INT>>, m MAP<STRING, INT>>")
    b = spark.createDataFrame([((2, [{"x": 2, "y": "z"}], {"n": 1 << 40}, "new"),), (None,)],
                              "S STRUCT<I INT, l ARRAY<STRUCT<x BIGINT, y STRING>>, m MAP<STRING, BIGINT>, t STRING>")
    schema = common_schema(a.schema, b.schema)
    assert schema.simpleString() == "struct<s:struct<i:int,l:array<struct<x:bigint,y:string>>,m:map<string,bigint>,t:string>>"
    got = [r.s.asDict(True) if r.s else None for r in conform(a, schema).union(conform(b, schema)).collect()]
    assert got == [{"i": 1, "l": [{"x": 1, "y": None}], "m": {"m": 1}, "t": None},
                   {"i": 2, "l": [{"x": 2, "y": "z"}], "m": {"n": 1 << 40}, "t": "new"}, None]
    with pytest.raises(SchemaConflict):
        common_schema(a.schema, spark.createDataFrame([], "s STRUCT<i STRING>").schema)


# --- changes ---------------------------------------------------------------------------

def _apply(rows: Counter, changes) -> Counter:
    out = Counter(rows)
    for r in changes:
        out[(r.k, r.v)] += r.change_sign
    assert min(out.values(), default=0) >= 0
    return +out


def test_changes_of_an_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    save = lambda rows: save_with_merge(_frame(spark, rows), path, "ol_parts", "ch", "k", DAY, parts=4, changes=True)
    save([(1, 1), (2, 2), (3, 3), (None, 0)])
    assert {r.change_kind for r in read_changes(spark, path).collect()} == {"inserted"}
    save([(1, 1), (2, 20), (4, 4), (None, 0)])
    got = _rows(read_changes(spark, path), "k", "v", "change_kind", "change_sign")
    assert got == sorted([(1, 1, "unchanged", 0), (2, 2, "updated", -1), (2, 20, "updated", 1), (4, 4, "inserted", 1),
                          (None, 0, "inserted", 1)], key=str)


def test_changes_turn_one_version_into_the_next(spark, tmp_path):
    """Groups with repeated rows: signed rows added to the old version give the new one."""
    rng, path = random.Random(4), str(tmp_path / "g")
    held: Counter = Counter()
    for n in range(4):
        rows = [(rng.randrange(6), rng.randrange(3)) for _ in range(12)]
        groups = sorted({k for k, _ in rows} | {rng.randrange(6)})
        out = save_with_merge(_frame(spark, rows), path, "ol_parts", "ch_groups", None, DAY, replace_by=["k"], changes=True,
                              groups=_frame(spark, [(g,) for g in groups], "k INT"), parts=3 if n else None)
        held = _apply(held, read_changes(spark, path, n).collect())
        assert held == Counter(map(tuple, out.select("k", "v").collect()))


def test_changes_of_a_replacement_and_of_equal_rows(spark, tmp_path):
    path = str(tmp_path / "r")
    for rows in ([(1, 1), (1, 1), (2, 2)], [(1, 1), (3, 3)]):
        save_with_merge(_frame(spark, rows), path, "ol_parts", "ch_all", None, DAY, changes=True)
    got = _rows(read_changes(spark, path), "k", "v", "change_kind", "change_sign")
    assert got == [(1, 1, "removed", -1), (1, 1, "unchanged", 0), (2, 2, "removed", -1), (3, 3, "inserted", 1)]


# --- rows with maps --------------------------------------------------------------------

def test_dedupe_of_rows_with_maps(spark):
    ddl = "id INT, m MAP<STRING, STRUCT<a INT, n MAP<STRING, INT>>>, l ARRAY<MAP<STRING, INT>>, t TIMESTAMP"
    at = dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    one = {"x": {"a": 1, "n": {"p": 1, "q": 2}}, "y": None}
    same = {"y": None, "x": {"a": 1, "n": {"q": 2, "p": 1}}}
    rows = [(1, one, [{"k": 1}], at), (1, same, [{"k": 1}], at), (1, one, [], at), (1, one, None, at), (1, one, [None], at),
            (1, {}, [{"k": 1}], at), (1, None, [{"k": 1}], at), (1, one, [{"k": 1}], at + dt.timedelta(microseconds=1)),
            (None, None, None, None), (None, None, None, None)]
    assert drop_duplicate_rows(_frame(spark, rows, ddl)).count() == 8
    empty = drop_duplicate_rows(_frame(spark, [], ddl))
    assert empty.count() == 0 and empty.columns == ["id", "m", "l", "t"]
