import json

import pytest

from featuremart.sources import documents


def put(folder, files):
    for name, content in files.items():
        place = folder / name
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_text(content if isinstance(content, str) else json.dumps(content, indent=1))
    return str(folder)


def test_conflicting_files_keep_both_typed_leaves(spark, tmp_path):
    path = put(tmp_path, {
        "m1/summary_1.json": {"evaluation_time": "2024-05-01 10:00:00", "f1": 0.5, "n": 3, "note": "ok"},
        "m2/summary_1.json": {"evaluation_time": "soon", "f1": {"macro": 0.25, "deep": {"x": 7}}, "n": 1.5, "note": 4},
    })
    flat, skipped = documents.read_varied_summaries(spark, path)
    types = dict(flat.dtypes)
    assert types == {
        "model_version": "string", "evaluation_time": "timestamp", "f1": "double", "f1.deep.x": "bigint",
        "f1.macro": "double", "n": "double", "note:bigint": "bigint", "note:string": "string"}
    rows = {r["model_version"]: r.asDict() for r in flat.collect()}
    assert (rows["m1"]["f1"], rows["m1"]["f1.macro"], rows["m1"]["n"], rows["m1"]["note:string"]) == (0.5, None, 3.0, "ok")
    assert (rows["m2"]["f1"], rows["m2"]["f1.macro"], rows["m2"]["f1.deep.x"], rows["m2"]["n"]) == (None, 0.25, 7, 1.5)
    assert (rows["m2"]["note:bigint"], rows["m2"]["note:string"], rows["m2"]["evaluation_time"]) == (4, None, None)
    assert skipped.count() == 0


def test_files_that_hold_no_object_are_named(spark, tmp_path):
    path = put(tmp_path, {"a/x.json": {"v": 1}, "b/x.json": "{broken", "c/x.json": [1, 2], "d/x.json": " \n", "e/x.txt": "{}"})
    flat, skipped = documents.read_varied_summaries(spark, path)
    assert [tuple(r) for r in flat.collect()] == [("a", 1)]
    assert {(r.file.split("/")[-2], r.reason) for r in skipped.collect()} == {
        ("b", "not valid JSON"), ("c", "not an object"), ("d", "not valid JSON")}


def test_nulls_arrays_empty_objects_and_odd_names(spark, tmp_path):
    path = put(tmp_path, {
        "a/x.json": {"only null": None, "list": [1, {"k": 2}], "empty": {}, "a<b": {"c.d`e": True}, "model_version": "x"},
        "b/x.json": {"empty": {}},
    })
    flat, _ = documents.read_varied_summaries(spark, path)
    rows = {r["model_version"]: r.asDict() for r in flat.collect()}
    assert rows["a"] == {"model_version": "a", "only null": None, "list": '[1,{"k":2}]', "a<b.c.d`e": True}
    assert set(rows) == {"a", "b"} and rows["b"]["list"] is None
    assert dict(flat.dtypes)["only null"] == "string"


def test_files_are_read_once(spark, tmp_path):
    path = put(tmp_path / "in", {"a/x.json": {"v": {"w": 1}}})
    stored = documents.read_documents(spark, path)
    (tmp_path / "in" / "a" / "x.json").unlink()
    assert [r.asDict()["v.w"] for r in documents.flattened(stored).collect()] == [1]


def test_without_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        documents.read_documents(spark, str(tmp_path / "none"))
