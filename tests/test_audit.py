from tokenloom.operators import audit
from tokenloom.sources import files

FULL = [*audit.REQUIRED, "vocab.json", "merges.txt"]


def listing(spark, bundles):
    rows = [(name, path, 1) for name, paths in bundles.items() for path in paths]
    return spark.createDataFrame(rows, "bundle string, rel_path string, length long")


def test_verdicts(spark):
    bundles = {
        "all": FULL,
        "no_vocab": [p for p in FULL if p != "vocab.json"],
        "neither": list(audit.REQUIRED),
        "only_vocab": [*audit.REQUIRED, "vocab.json"],
        "no_model": [p for p in FULL if p != "onnx/model.onnx"],
    }
    df = listing(spark, bundles)
    assert {r.bundle: r.status for r in audit.check(df).collect()} == {
        "all": "ok", "no_vocab": "error", "neither": "warning", "only_vocab": "ok", "no_model": "error"
    }
    assert [tuple(r) for r in audit.missing(df).collect()] == [("no_model", "onnx/model.onnx")]


def test_ignored_and_kept_paths(spark):
    paths = [*FULL, "a.pt", "x/b.bin", "__pycache__/m.pyc", "XXpycacheXX/m", "runs/1/log", "onnx/decoder.onnx", "a.ptx"]
    df = listing(spark, {"b": paths})
    left = {r.rel_path for r in audit.upload_set(df).collect()}
    assert left == {*FULL, "XXpycacheXX/m", "onnx/decoder.onnx", "a.ptx"}
    assert {r.rel_path for r in audit.keep_list(df).collect()} == set(FULL)


def test_listing_of_folders(spark, tmp_path):
    for path in ("one/config.json", "one/onnx/model.onnx", "two/merges.txt"):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text("x")
    rows = {(r.bundle, r.rel_path, r.length) for r in files.read_listing(spark, str(tmp_path)).collect()}
    assert rows == {("one", "config.json", 1), ("one", "onnx/model.onnx", 1), ("two", "merges.txt", 1)}


def test_bundles_without_files_and_files_without_bytes(spark, tmp_path):
    for path in ("one/config.json", "one/onnx/model.onnx", "full/vocab.json"):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text("" if path.startswith("one/config") else "x")
    (tmp_path / "empty" / "onnx").mkdir(parents=True)
    df = files.read_listing(spark, str(tmp_path))
    assert {(r.bundle, r.rel_path, r.length) for r in df.collect()} == {
        ("one", "config.json", 0), ("one", "onnx/model.onnx", 1), ("full", "vocab.json", 1)
    }
    bundles = files.read_bundles(spark, str(tmp_path))
    assert sorted(r.bundle for r in bundles.collect()) == ["empty", "full", "one"]
    assert {r.bundle: r.status for r in audit.check(df, bundles).collect()} == {"one": "error", "full": "error", "empty": "error"}
    lacks = [tuple(r) for r in audit.missing(df, bundles).collect()]
    assert {p for b, p in lacks if b == "empty"} == set(audit.REQUIRED)
    assert {p for b, p in lacks if b == "one"} == set(audit.REQUIRED) - {"config.json", "onnx/model.onnx"}


def test_models_are_kept_at_any_depth(spark):
    df = listing(spark, {"b": ["onnx/sub/model.onnx", "onnx/model.onnx", "onnx/xmodel.onnx", "onnx/model.onnx/x", "model.onnx"]})
    assert {r.rel_path for r in audit.keep_list(df).collect()} == {"onnx/sub/model.onnx", "onnx/model.onnx"}
