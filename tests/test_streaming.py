import pyarrow as pa
import pytest

from hexfold.streaming import ingest


def node(i, lon):
    return f'{{"type":"node","id":{i},"lon":{lon},"lat":50.5}}'


def test_elements_arrive_once(spark, tmp_path):
    parts, table, checkpoint = (str(tmp_path / x) for x in ("parts", "table", "checkpoint"))
    (tmp_path / "parts").mkdir()
    land = lambda name, lines: (tmp_path / "parts" / name).write_text("\n".join(lines))
    land("a.json", [node(1, 4.1), node(2, 4.2), node(2, 4.2), "broken"])
    ingest.ingest(spark, parts, table, checkpoint)
    land("b.json", [node(2, 9.9), node(3, 5.5)])
    for _ in range(2):  # nothing new the second time
        ingest.ingest(spark, parts, table, checkpoint)
        got = sorted((r.osm_id, r.points[0].lon) for r in spark.read.parquet(table).collect())
        assert got == [("node/1", 4.1), ("node/2", 4.2), ("node/3", 5.5)]
    assert [tuple(r) for r in ingest.touched_tiles(spark, table, 1).collect()] == [(5, 50)]


def test_missing_parts_fail(spark):
    parts = lambda *names: spark.createDataFrame([(n,) for n in names], "part string")
    ingest.require_parts(parts("a", "b"), parts("b", "a", "c"))
    with pytest.raises(FileNotFoundError, match="b"):
        ingest.require_parts(parts("a", "b"), parts("a"))


def test_python_is_not_called_for_each_element(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "MERGE", 2)
    batches = [pa.record_batch({"osm_id": ["a", "b"], "value": ["2", "\U00010000"]}), pa.record_batch({"osm_id": ["a", "b", "c"], "value": ["1", "\uffff", ""]}), pa.record_batch({"osm_id": ["a"], "value": ["3"]})]
    assert sorted((r["osm_id"], r["value"]) for b in ingest._least(iter(batches)) for r in b.to_pylist()) == [("a", "1"), ("b", "\uffff"), ("c", "")]
    assert list(ingest._least(iter([]))) == []
    (tmp_path / "parts").mkdir()
    plan = ingest.arrivals(spark, str(tmp_path / "parts"))._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate" in plan and "PandasWithState" not in plan
