"""Feature collections per frame, and bad timesteps kept aside."""

import json
import urllib.parse

from pyspark.sql import functions as F

from lanewatch.sinks.tables import write_frame_collections
from lanewatch.sources.vehicle_xml import malformed_counts, malformed_timesteps, read_vehicle_xml

SCHEMA = "time string, feature string, analysis_type string, location_x double, location_y double"


def documents(path):
    return {urllib.parse.unquote(folder.name.removeprefix("frame=")): [
        json.loads(f.read_text()) for f in folder.glob("part-*")]
        for folder in path.glob("frame=*")}


def test_each_frame_is_one_document(spark, tmp_path):
    rows = [(f"2026-05-01T00:{m:02}:00Z", json.dumps({"n": n, "m": m}), "traffic", float(n), 1.0)
            for m in range(5) for n in range(200 if m == 2 else 3)]
    rows += [(None, "{}", "traffic", 0.0, 0.0)]
    made = spark.createDataFrame(rows, SCHEMA).repartition(7)
    write_frame_collections(made, str(tmp_path / "f"))
    found = documents(tmp_path / "f")
    assert len(found) == 5
    for time, files in found.items():
        assert len(files) == 1 and files[0]["type"] == "FeatureCollection"
        n = 200 if ":02:" in time else 3
        assert [f["n"] for f in files[0]["features"]] == list(range(n))
    # A frame that is written again is replaced, the others stay.
    again = made.where("time like '%:04:%'").limit(2)
    write_frame_collections(again, str(tmp_path / "f"))
    after = documents(tmp_path / "f")
    assert len(after) == 5 and len(after["2026-05-01T00:04:00Z"][0]["features"]) == 2
    assert after["2026-05-01T00:02:00Z"] == found["2026-05-01T00:02:00Z"]


def test_bad_timesteps_are_kept_aside(spark, tmp_path):
    good = '<timestep time="1.00"><vehicle id="a" x="1" y="2" speed=""/><person id="p"/></timestep>'
    parts = [
        '<?xml version="1.0"?>\n<fcd-export>\n<timestep time="0.00"/>\n', good,
        '\n<timestep><vehicle id="b"/></timestep>', '<timestep time="  "></timestep>',
        '<timestep time="x1"><vehicle id="c"/></timestep>',
        '<timestep time="2.00"><vehicle id="d></timestep>',
        '<timestep time="3.00"><vehicle id="e"/><timestep time="4.00"><vehicle id="f"/></timestep>',
        '<vehicle id="g"/></timestep>', good, '\n<timestep time="9.00"/>\n</fcd-export>\n']
    (tmp_path / "a.xml").write_text("".join(parts))
    (tmp_path / "cut.xml").write_text(f'<fcd-export>{good}<timestep time="5.00"><vehicle id="h"/><veh')
    (tmp_path / "fine.xml").write_text(f"<fcd-export>{good}</fcd-export>")
    bad = malformed_timesteps(spark, str(tmp_path), "fcd")
    rows = sorted((r["file"].rsplit("/", 1)[-1], r["kind"], r["text"].strip()) for r in bad.collect())
    assert [row[:2] for row in rows] == [
        ("a.xml", "bad_time"), ("a.xml", "no_opening"), ("a.xml", "no_time"), ("a.xml", "no_time"),
        ("a.xml", "not_xml"), ("a.xml", "unclosed"), ("cut.xml", "not_xml")]
    assert rows[0][2] == '<timestep time="x1"><vehicle id="c"/>'
    assert rows[5][2] == '<timestep time="3.00"><vehicle id="e"/>'
    counts = {(r["file"].rsplit("/", 1)[-1], r["kind"]): r["timesteps"] for r in malformed_counts(bad).collect()}
    assert counts[("a.xml", "no_time")] == 2 and sum(counts.values()) == 7
    ids = {r["id"] for r in read_vehicle_xml(spark, str(tmp_path), "fcd").where(
        F.col("timestep").isNotNull()).collect()}
    assert ids >= {"a", "f"} and not ids & {"b", "c", "e", "g"}
    bad.explain()


def test_faults_are_found_in_one_narrow_pass(spark, tmp_path, capsys):
    (tmp_path / "fine.xml").write_text("<fcd-export></fcd-export>")
    bad = malformed_timesteps(spark, str(tmp_path), "emission")
    assert bad.collect() == []
    bad.explain()
    assert "Exchange" not in capsys.readouterr().out
