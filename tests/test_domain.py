"""Maps, rounds, sources and streams on small made-up broadcasts."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from timeline_engine.operators import runs as R
from timeline_engine.plans import segments as G
from timeline_engine.sources import files
from timeline_engine.streaming import runs as T

PLAYERS = {f"p{k}": "left" if k < 4 else "right" for k in range(8)}


def header(spark):
    """Two maps: hardpoint from 0 to 300, search and destroy from 302 to 600."""
    rows = [("best_of", "9", 0, 600)]
    rows += [("maps_left", "0", 0, 300), ("maps_left", "1", 302, 600), ("maps_right", "0", 0, 600)]
    rows += [("score_left", "0", 0, 50), ("score_left", "20", 50, 300), ("score_left", "0", 302, 400), ("score_left", "1", 400, 600)]
    rows += [("score_right", "0", 0, 100), ("score_right", "30", 100, 300), ("score_right", "0", 302, 500), ("score_right", "1", 500, 600)]
    rows += [("rotation", v, a, b) for v, a, b in (("0:58", 5, 10), ("0:10", 11, 20), (None, 21, 22), ("0:59", 23, 30), ("0:20", 31, 40), ("0:55", 70, 80))]
    rows += [("clock", v, a, b) for v, a, b in (("1:30", 305, 306), ("0:30", 360, 361), ("0:44", 370, 371), ("0.4", 395, 395.2), ("1:29", 402, 403), ("0:50", 440, 441), ("1:30", 501, 502), ("0:20", 580, 581))]
    rows += [("lives_left", "4", 304, 340), ("lives_left", "2", 340, 401), ("lives_left", "4", 401, 480), ("lives_left", "0", 480, 500.5), ("lives_left", "4", 500.5, 600)]
    rows += [("lives_right", "4", 304, 350), ("lives_right", "1", 350, 401), ("lives_right", "4", 401, 470), ("lives_right", "1", 470, 500.5), ("lives_right", "4", 500.5, 570), ("lives_right", "1", 570, 600)]
    return spark.createDataFrame([("v", f, v, float(a), float(b), 9) for f, v, a, b in rows], "vod string, field string, value string, start_t double, end_t double, samples bigint")


def board(spark):
    rows = []
    for k, name in enumerate(PLAYERS):
        for start, end, kills, label in ((0, 140, 0, "TIME"), (140, 300, 3 + k, "TIME"), (302, 350, 0, "PLNT"), (350, 599, 1, "PLNT")):
            rows.append(("v", PLAYERS[name], k % 4, float(start), float(end), 10, k, name, kills, kills, label, "skull" if start == 350 else "none"))
    rows.append(("v", "left", 0, 150.0, 151.0, 1, 2, "stranger", 9, 9, "TIME", "none"))
    return spark.createDataFrame(rows, "vod string, side string, slot int, start_t double, end_t double, samples bigint, number int, name string, kills int, deaths int, stat_label string, gutter string")


def events(spark):
    rows = [(305.0 + k, "p1", "p6") for k in range(2)] + [(520.0, None, "p4"), (521.0, "p0", "p5"), (522.0, "p0", "p6"), (523.0, "p0", "p7"), (560.0, "p0", "p7"), (524.0, "p0", None)]
    return spark.createDataFrame([("v", *r) for r in rows], "vod string, t double, attacker string, victim string")


def test_maps_and_rounds(spark):
    ours, theirs = G.split_foreign(board(spark))
    assert [r.name for r in theirs.collect()] == ["stranger"]
    h = G.Header(header(spark))
    found = G.map_boundaries(ours, h).collect()
    assert [(r.t, r.confirmed) for r in found] == [(302.0, True)]
    maps = G.map_windows(ours, h)
    got = [(r.number, r.start_t, r.end_t, r["mode"], tuple(r.pips)) for r in maps.orderBy("number").collect()]
    assert got == [(1, 0.0, 300.0, "hardpoint", (0, 0)), (2, 302.0, 599.0, "search_and_destroy", (1, 0))]
    assert [tuple(r) for r in G.map_winners(maps).collect()] == [("v", 1, "left")]
    sides = spark.createDataFrame([("v", n, s) for n, s in PLAYERS.items()], "vod string, name string, side string")
    rounds = G.rounds(h, maps, events(spark), sides).orderBy("number").collect()
    assert [(r.start_t, r.end_t, r.winner, r.decided_by, r.wiped, r.outcome) for r in rounds] == [
        (302.0, 402.0, "left", "score_step", None, "detonation"),
        (402.0, 501.0, "right", "score_step", "left", "wipe"),
        (501.0, 599.0, "left", "killfeed_wipe", "right", "wipe"),
    ]
    assert [r.witnesses for r in rounds] == [["map_start"], ["clock_reset", "lives_reset", "score_step"], ["clock_reset", "lives_reset", "score_step"]]
    assert rounds[0].plant_t == 370.0 and (rounds[0].low_left, rounds[0].low_right) == (2, 1)
    plain = G.rounds(h, maps)
    assert plain.where("last").first().winner is None
    closed = G.close_from_series(plain, spark.createDataFrame([("v", 2, "right")], "vod string, number int, winner string")).where("last").first()
    assert (closed.winner, closed.decided_by) == ("right", "series_pips")
    hills = G.hills(h, maps).orderBy("number").collect()
    assert [(r.start_t, r.end_t) for r in hills] == [(0.0, 70.0), (70.0, 300.0)]
    kinds = G.subdivisions(h, maps).groupBy("kind").count().collect()
    assert dict(kinds) == {"round": 3, "hill": 2}
    dup = G.duplicate_victims(events(spark), G.rounds(h, maps)).collect()
    assert sorted((r.victim, r.gap, r.kind) for r in dup) == [("p6", 1.0, "fragment"), ("p7", 37.0, "replay")]
    steps = G.increments(ours).where("player = 'p3'").collect()
    assert sorted((r.field, r.before, r.after, r.latest, r.skull) for r in steps) == [("deaths", 0, 1, 350.0, True), ("kills", 0, 1, 350.0, True)]


def test_halves(spark):
    h = header(spark).where("field not in ('substrip')").unionByName(
        spark.createDataFrame([("v", "substrip", v, a, b, 1) for v, a, b in (("FIRST HALF", 10.0, 20.0), ("x", 25.0, 30.0), ("FIRST HALF", 40.0, 50.0), ("SECOND HALF", 160.0, 170.0))], "vod string, field string, value string, start_t double, end_t double, samples bigint")
    )
    maps = spark.createDataFrame([("v", 1, 0.0, 300.0, "overload")], "vod string, number int, start_t double, end_t double, mode string")
    assert [(r.start_t, r.end_t) for r in G.halves(h, maps).orderBy("number").collect()] == [(0.0, 160.0), (160.0, 300.0)]


def test_hp_pairing(spark):
    rows = [("name", "a", 0, 50), ("name", "b", 50.5, 99)] + [("hp", v, s, e) for v, s, e in (("100", 0, 9), (None, 9.1, 9.2), ("60", 9.3, 10), ("0", 10.2, 12), ("100", 12.1, 50), ("0", 50.6, 60), ("80", 60.1, 70), ("0", 73, 75))]
    panel = spark.createDataFrame([("v", f, v, float(s), float(e)) for f, v, s, e in rows], "vod string, field string, value string, start_t double, end_t double")
    falls = G.hp_falls(panel)
    assert [tuple(r) for r in falls.collect()] == [("v", "a", 10.2)]
    assert [tuple(r) for r in G.hp_falls(panel, to_zero=False, least=25).collect()] == [("v", "a", 9.3)]
    deaths = spark.createDataFrame([("v", 10.4, "a"), ("v", 10.6, "a"), ("v", 10.4, "b")], "vod string, t double, victim string")
    (row,) = G.pair_falls(falls, deaths).collect()
    assert row.matched_t == 10.4 and row.delta == pytest.approx(0.2 - 0.167)


def test_kill_checks(spark):
    rows = [("v", 1, k + 1, 5, 6 if k < 4 else 5) for k in range(8)] + [("v", 2, k + 1, 9 if k < 4 else 1, 2) for k in range(8)] + [("v", 3, 1, 0, 0)]
    out = {(r["map"], r.name): (r.passed, r.others) for r in G.kill_checks(spark.createDataFrame(rows, "vod string, map int, slot int, kills int, deaths int")).collect()}
    assert out[1, "left kills"] == (True, 0) and out[1, "right kills"] == (True, 4) and out[2, "left kills"] == (False, -28) and out[3, "left kills"][0] is False


def test_sources(spark, tmp_path):
    lines = [{"field": "clock", "value": "3:43", "start": 1.0, "end": 2.0, "samples": 3}, {"field": "maps_left", "value": 2, "start": 1, "end": 2, "samples": 3}, {"field": "hp", "value": None, "start": 1, "end": 2, "samples": 3}]
    with gzip.open(tmp_path / "runs.jsonl.gz", "wt") as f:
        f.write("\n\n".join(map(json.dumps, lines)) + "\n")
    runs = files.timed(files.read_lines(spark, str(tmp_path / "runs.jsonl.gz"), files.HEADER_RUNS), "v")
    assert sorted((r.field, r.value, r.start_t, r.vod) for r in runs.collect()) == [("clock", "3:43", 1.0, "v"), ("hp", None, 1.0, "v"), ("maps_left", "2", 1.0, "v")]
    files.write_lines(runs, str(tmp_path / "out"))
    assert files.read_lines(spark, str(tmp_path / "out"), "field string, value string").count() == 3
    value = {"number": 1, "name": "a", "kills": 2, "deaths": 3, "streak": None, "stat": "0:01", "stat_label": "TIME", "gutter": "none", "spectated": True}
    (tmp_path / "board.jsonl").write_text(json.dumps({"side": "left", "slot": 0, "start": 0.0, "end": 1.0, "samples": 2, "value": value}))
    row = files.timed(files.read_lines(spark, str(tmp_path / "board.jsonl"), files.BOARD_RUNS)).first()
    assert (row.side, row.start_t, row.kills, row.spectated) == ("left", 0.0, 2, True)
    (tmp_path / "names.json").write_text(json.dumps({"name": "n", "teams": {"a": "x"}, "templates": {"a": [["#.", ".#"], ["##"]]}}))
    atlas = files.read_atlas(spark, str(tmp_path / "names.json"), "name")
    assert {(r.label, r.variant, r.h, r.w) for r in atlas.collect()} == {("a", 0, 2, 2), ("a", 1, 1, 2)}
    assert files.bitmaps_of(atlas)["a"][1].tolist() == [[True, True]] and files.read_teams(spark, str(tmp_path / "names.json")).first().side == "x"
    (tmp_path / "glyphs.json").write_text(json.dumps({"font": "f", "canvas": [2, 2], "threshold": 150, "glyphs": {"1": ["#", "#"]}}))
    assert files.read_atlas(spark, str(tmp_path / "glyphs.json"), "glyph").first().h == 2
    (tmp_path / "line.json").write_text(json.dumps([{"state": s, "start": 0.0, "end": 9.0, "duration": 9.0, "n_samples": 9} for s in ("live", "boxscore")]))
    assert files.state_spans(spark, str(tmp_path / "line.json"), "boxscore").count() == 1
    (tmp_path / "box.json").write_text(json.dumps([{"map": 1, "t": 2.0, "mode": "m", "start": 0.0, "end": 1.0, "kd": {"a": {"kills": 1, "deaths": 2}, "b": {"kills": 3, "deaths": 4}}}]))
    assert files.box_totals(spark, str(tmp_path / "box.json")).agg(F.sum("kills"), F.sum("deaths")).first()[:] == (4, 6)


def test_an_atlas_too_large_for_workers(spark, monkeypatch):
    monkeypatch.setattr(files, "MOST_BITMAPS", 1)
    atlas = spark.createDataFrame([("a", 0, ["#"]), ("b", 0, ["#"])], "label string, variant int, rows array<string>")
    assert list(files.bitmaps_of(atlas.where("label = 'a'"))) == ["a"]
    with pytest.raises(ValueError):
        files.bitmaps_of(atlas)


def test_strips(spark, tmp_path):
    frames = spark.range(3000).select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("region"), F.col("id").alias("frame"), F.col("id").cast("string").cast("binary").alias("pixels"))
    files.write_strip(frames, str(tmp_path / "s"), fps=6.0, start=100.0)
    part = files.read_strip(spark, str(tmp_path / "s"), "b", first=1200, count=12)
    got = part.orderBy("frame").collect()
    assert [r.frame for r in got] == list(range(1200, 1212)) and got[0].t == 300.0 and bytes(got[0].pixels) == b"1200"
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(frame), GreaterThanOrEqual(frame,1200), LessThan(frame,1212)]" in plan and "PartitionFilters: [isnotnull(region" in plan


def test_streams_equal_batch(spark, tmp_path):
    rows = [(u, f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00", "abc"[(m * u // 7) % 3]) for m in range(0, 600, 2) for u in (1, 2, 3) if (m // 50 + u) % 4]
    df = spark.createDataFrame(rows, "user_id bigint, s string, event_type string").select("user_id", F.col("s").cast("timestamp_ntz").alias("ts"), "event_type")
    parts = 6
    for k in range(parts):
        df.where((F.hour("ts") * 60 + F.minute("ts") >= 100 * k) & (F.hour("ts") * 60 + F.minute("ts") < 100 * (k + 1))).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.createDataFrame([(99, "2024-01-03 00:00:00", "z")], "user_id bigint, s string, event_type string").select("user_id", F.col("s").cast("timestamp_ntz").alias("ts"), "event_type").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    def run(out, name):
        q = out.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name)

    from timeline_engine.functions.exprs import seconds

    batch = df.withColumn("t", seconds(F.col("ts")))
    want = R.run_lengths(batch, ["user_id"], ["t"], ["event_type"], "t", max_gap=1800.0).select("user_id", "event_type", "start_t", "end_t", "samples")
    got = run(T.stream_runs(stream, "user_id", "event_type", "ts", 1800.0), "runs").where("user_id <> 99")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    sessions = run(T.stream_sessions(stream, "user_id", "ts", "20 minutes"), "sessions").where("user_id <> 99")
    whole = R.sessions(batch.withColumn("e", F.col("t")), ["user_id"], "t", "e", 20 * 60.0 - 1e-6)
    assert sorted(r.items for r in sessions.collect()) == sorted(r["items"] for r in whole.collect())
    counts = run(T.stream_counts(stream, ["event_type"], "ts", "1 hour"), "counts").where("event_type <> 'z'")
    assert counts.agg(F.sum("items")).first()[0] == len(rows)
