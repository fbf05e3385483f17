"""Generators, struct expansion and drops (G1-G4, P2, P5, F3) on literal edge cases."""

from orderlake.operators import flatten as FL

SCHEMA = "id INT, arr ARRAY<STRING>, m MAP<STRING,STRING>, s STRUCT<a: INT, b: STRING>"
ROWS = [
    (1, None, None, None),                       # null array, null map, null struct
    (2, [], {}, (1, "x")),                       # empty array, empty map
    (3, ["p", "q"], {"k1": "v1", "k2": None}, (2, None)),  # two elements, null map value
]


def test_explode_inner_drops_null_and_empty(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted((r.id, r.arr) for r in FL.explode_inner(df, "arr").collect())
    assert got == [(3, "p"), (3, "q")]


def test_explode_outer_keeps_one_null_row(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted((r.id, r.arr or "") for r in FL.explode_outer(df, "arr").collect())
    assert got == [(1, ""), (2, ""), (3, "p"), (3, "q")]


def test_explode_map_outer_keeps_null_values(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = FL.explode_map(df, "m", "k", "v")
    assert "m" not in out.columns
    got = sorted((r.id, r.k or "", r.v or "") for r in out.collect())
    assert got == [(1, "", ""), (2, "", ""), (3, "k1", "v1"), (3, "k2", "")]


def test_explode_chain_multiplies(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x", "y", "z"]), (2, None, ["x"])],
                               "id INT, p ARRAY<STRING>, q ARRAY<STRING>")
    out = FL.explode_chain(df, ["p", "q"])
    counts = {r.id: r["count"] for r in out.groupBy("id").count().collect()}
    assert counts == {1: 6, 2: 1}


def test_expand_null_struct_gives_null_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = FL.expand(df, "s", rename={"b": "s_b"})
    assert out.columns == ["id", "arr", "m", "a", "s_b"]
    got = {r.id: (r.a, r.s_b) for r in out.collect()}
    assert got == {1: (None, None), 2: (1, "x"), 3: (2, None)}


def test_drop_names_case_insensitive_and_missing(spark):
    df = spark.createDataFrame([(1, 2)], "entityId INT, keep INT")
    assert FL.drop_names(df, "entityid", "not_there").columns == ["keep"]


def test_drop_all_null(spark):
    df = spark.createDataFrame([(None, None), (1, None), (None, "x")], "a INT, b STRING")
    assert FL.drop_all_null(df).count() == 2
