"""Loads in batches: rejects, streams of new files, and gold tables kept up by changes."""

import datetime as dt
import json
import random
from collections import Counter

from pyspark.sql import functions as F

from orderlake.operators.metrics import materialize
from orderlake.plans import maintained as M
from orderlake.plans.kpi import kpi_table
from orderlake.plans.medallion import bronze_to_silver, read_silver
from orderlake.plans.summary import order_summary
from orderlake.sources import versions as V
from orderlake.sources.documents import bronze_from_dir
from orderlake.sources.upsert import read_changes
from orderlake.streaming import load_new_files

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 1)


def _bronze(spark, *documents):
    return spark.createDataFrame([(d if d is None or isinstance(d, str) else json.dumps(d),) for d in documents],
                                 "orderDetails string")


def _rows(df) -> Counter:
    return Counter(map(str, (tuple(r) for r in df.collect())))


# --- orders that lose lines, rejects ---------------------------------------------------

def test_order_that_comes_without_items_loses_them(spark, tmp_path):
    lake = str(tmp_path)
    names = ("orders", "items", "totals", "sellers")
    full = {"orderId": "a", "items": [{"uniqueId": "u1", "quantity": 1}, {"uniqueId": "u2", "quantity": 2}],
            "totals": [{"id": "Items", "value": 3}], "sellers": [{"id": "s"}]}
    bronze_to_silver(_bronze(spark, full, full | {"orderId": "b"}), lake, "ol_empty", names, DAY)
    saved = bronze_to_silver(_bronze(spark, {"orderId": "a", "items": [], "totals": None}), lake, "ol_empty", names, DAY)
    for name in names[1:]:
        assert {r.order_id for r in saved[name].collect()} == {"b"}, name
    assert saved["orders"].count() == 2


def test_rejects_with_their_reason(spark, tmp_path):
    bad = ["{\"orderId\": \"cut", "not json", "", None, "[1, 2]", {"status": "lost"}, "{\"orderId\": null}"]
    odd = {"orderId": "odd", "value": "much", "status": "ok"}
    for _ in range(2):  # the same documents again are the same rejects
        saved = bronze_to_silver(_bronze(spark, {"orderId": "good", "value": 5}, odd, *bad, "not json"), str(tmp_path), "ol_rejects",
                                 ("orders",), DAY, quarantine=True)
    assert sorted((r.order_id, r.value, r.status) for r in saved["orders"].collect()) == [("good", 5, None), ("odd", None, "ok")]
    got = {r.document: (r.reason, r.is_kept, r.copies) for r in saved["rejects"].collect()}
    assert got[None] == ("no document", False, 1)
    assert got["not json"] == ("malformed", False, 2)
    assert got["{\"orderId\": \"cut"][0] == "malformed"
    assert got[json.dumps({"status": "lost"})] == ("no order id", False, 1)
    assert got["{\"orderId\": null}"][0] == "no order id"
    assert got[json.dumps(odd)] == ("field of another type", True, 1)
    assert len(got) == 8


# --- streams ---------------------------------------------------------------------------

def _drop(folder, name, *documents):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps({"orderDetails": json.dumps(d)}) + "\n" for d in documents))


def test_only_new_files_are_loaded(spark, tmp_path):
    drops, lake, marks = tmp_path / "drops", str(tmp_path / "lake"), str(tmp_path / "marks")
    tables = ("orders", "rates_and_benefits")
    rate = {"ratesAndBenefitsData": {"rateAndBenefitsIdentifiers": [{"id": "r", "name": "n"}]}}
    load = lambda: load_new_files(spark, str(drops), lake, "ol_stream", marks, tables, DAY, files_per_batch=1)
    _drop(drops, "one", {"orderId": "a", "value": 1} | rate, {"orderId": "b", "value": 1})
    assert load() == 1
    _drop(drops, "two", {"orderId": "b", "value": 2} | rate)
    _drop(drops, "three", {"orderId": "c", "value": 3})
    assert load() == 2
    before = {n: V.current(spark, f"{lake}/silver/{n}").number for n in tables}
    assert load() == 0  # nothing new: nothing is written
    assert {n: V.current(spark, f"{lake}/silver/{n}").number for n in tables} == before
    orders = V.read_saved(spark, f"{lake}/silver/orders")
    assert sorted((r.order_id, r.value) for r in orders.collect()) == [("a", 1), ("b", 2), ("c", 3)]
    assert V.read_saved(spark, f"{lake}/silver/rates_and_benefits").count() == 2


def test_replayed_batch_changes_nothing(spark, tmp_path):
    lake, tables = str(tmp_path), ("orders", "items", "rates_and_benefits")
    bronze = bronze_from_dir(spark, SF).limit(50)
    first = {n: _rows(t) for n, t in bronze_to_silver(bronze, lake, "ol_replay", tables, DAY, batch="b1").items()}
    again = bronze_to_silver(bronze, lake, "ol_replay", tables, DAY, batch="b1", changes=True)
    assert {n: _rows(t) for n, t in again.items()} == first
    for n in tables:
        assert {r.change_kind for r in read_changes(spark, f"{lake}/silver/{n}").select("change_kind").collect()} <= {"unchanged"}


# --- gold tables kept up by changes ----------------------------------------------------

def _assert_equals_rebuild(spark, lake, database):
    silver = read_silver(spark, database, *M.INPUTS)
    kept = M.read_gold(spark, lake, DAY)
    for name, built in (("order_summary", order_summary(silver)), ("kpi_table", kpi_table(silver, DAY))):
        assert kept[name].columns == built.columns and kept[name].dtypes == built.dtypes
        assert _rows(kept[name]) == _rows(built), name


def test_gold_after_batches_equals_a_rebuild(spark, tmp_path, monkeypatch):
    """New orders, orders that come again changed, emptied or the same; then nothing, then a rebuild, as
    where versions are gone."""
    lake = str(tmp_path)
    bronze = materialize(bronze_from_dir(spark, SF).where(F.pmod(F.xxhash64("orderDetails"), F.lit(7)) == 0), "some")
    part = F.pmod(F.xxhash64("orderDetails"), F.lit(10))
    load = lambda rows: bronze_to_silver(rows, lake, "ol_kept", M.INPUTS, DAY, changes=True, parts=4)
    load(bronze.where(part < 6))
    assert M.update_gold(spark, lake, "ol_kept", DAY) == "rebuilt"
    _assert_equals_rebuild(spark, lake, "ol_kept")
    changed = [json.loads(r.orderDetails) for r in bronze.orderBy("orderDetails").limit(12).collect()]
    for i, d in enumerate(changed):
        d |= [{"status": "canceled", "isCompleted": False}, {"items": []}, {"salesChannel": None, "value": None},
              {"clientProfileData": changed[0]["clientProfileData"]}][i % 4]
    ids = [d["orderId"] for d in changed]
    load(bronze.where((part >= 5) & ~F.get_json_object("orderDetails", "$.orderId").isin(ids))
         .union(_bronze(spark, *changed)))
    assert M.update_gold(spark, lake, "ol_kept", DAY) == "updated"
    assert M.update_gold(spark, lake, "ol_kept", DAY) == "nothing"
    _assert_equals_rebuild(spark, lake, "ol_kept")
    load(_bronze(spark, {"orderId": "new", "status": "x"}))
    monkeypatch.setattr(M, "_follows", lambda *_: False)
    assert M.update_gold(spark, lake, "ol_kept", DAY) == "rebuilt"
    _assert_equals_rebuild(spark, lake, "ol_kept")


def _document(rng, order):
    """A small document with nulls, repeated rows and shared keys."""
    some = lambda values: rng.choice([*values, None])
    return {"orderId": order, "status": some(["new", "canceled"]), "salesChannel": some(["1", "2"]), "value": some([10, 25]),
            "isCompleted": some([True, False]),
            "items": [{"uniqueId": some(["u1", "u2", "u3"]), "productId": some(["p1", "p2"]), "quantity": some([1, 2]),
                       "sellingPrice": some([5, 7]), "listPrice": some([6, 9])} for _ in range(rng.randrange(4))],
            "clientProfileData": some([{"email": some(["x@y", "z@y"]), "userProfileId": some(["f1", "f2"])}]),
            "shippingData": {"logisticsInfo": [{"price": some([3, 4])} for _ in range(rng.randrange(3))]},
            "paymentData": {"transactions": [{"payments": [{"paymentSystemName": some(["card", "cash"]), "value": some([10, 15])}
                                                          for _ in range(rng.randrange(3))]}]},
            "cancellationData": some([{"Reason": some(["late", "broken"]), "CancellationDate": some(["2024-01-01"])}])}


def test_gold_with_nulls_and_orders_without_an_id(spark, tmp_path):
    rng, lake = random.Random(2), str(tmp_path)
    for batch in range(3):
        ids = rng.sample([f"o{i}" for i in range(12)], 5) + [None] * (batch % 2 + 1)
        bronze_to_silver(_bronze(spark, *(_document(rng, i) for i in ids)), lake, "ol_odd", M.INPUTS, DAY, changes=True,
                         parts=4 if batch else None)
        assert M.update_gold(spark, lake, "ol_odd", DAY) == ("updated" if batch else "rebuilt")
        _assert_equals_rebuild(spark, lake, "ol_odd")


def test_update_reads_only_touched_parts(spark, tmp_path, monkeypatch):
    """The silver files read for one changed order are those of its parts."""
    lake = str(tmp_path)
    load = lambda ids, status: bronze_to_silver(
        _bronze(spark, *({"orderId": i, "status": status} for i in ids)), lake, "ol_few", M.INPUTS, DAY, changes=True, parts=8)
    load([f"o{i}" for i in range(40)], "a")
    M.update_gold(spark, lake, "ol_few", DAY)
    load(["o7"], "b")
    read: list[set] = []
    plain = V.State.read
    monkeypatch.setattr(V.State, "read", lambda self, spark, parts=None: read.append(parts) or plain(self, spark, parts))
    assert M.update_gold(spark, lake, "ol_few", DAY) == "updated"
    silver = [p for p in read if p is not None and all(n.split("-")[0].isdigit() for n in p)]
    assert len(silver) >= 10 and all(len(p) <= 1 for p in silver)
    monkeypatch.undo()
    _assert_equals_rebuild(spark, lake, "ol_few")
