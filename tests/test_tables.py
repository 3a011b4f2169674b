"""Serving tables, searches, observations, sampling, repair and labels on small inputs."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollcall import schemas, session
from rollcall.operators import detections, marts, observations, repair, sampling, search
from rollcall.sources import io, media


def rows(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=str)


@pytest.fixture(scope="module")
def world(spark):
    make = lambda schema, *r: spark.createDataFrame(r, schema)
    return {
        "battles": make(schemas.BATTLES, ("B1", "t", "m1"), ("B2", "t", None), ("B3", "t", "m0")),
        "participants": make(schemas.PARTICIPANTS, ("B1", "x"), ("B1", "y"), ("B2", "x"), ("B3", "z"), ("B1", None), ("B9", "w")),
        "battle_videos": make(schemas.BATTLE_VIDEOS, ("B1", "v1", 810, 90.0, 6, 6), ("B1", "v1", 90, 80.0, 6, 6), ("B2", "v2", 90, 80.0, 6, 6), ("B1", "v3", 90, 80.0, 6, 6)),
        "videos": make(schemas.VIDEOS, ("v1", "20240102", "one", "u"), ("v2", "N/A", "", None), ("v3", "20240301", None, "u")),
        "observations": make(schemas.OBSERVATIONS, ("v1", 90, ["x", "", None, "xx", "x"], "20240102"), ("v2", 90, [], "N/A"), ("v3", 90, ["Xavier"], None)),
    }


def test_serving_tables(spark, world, tmp_path):
    t = marts.serving_tables(**world)
    assert rows(t["player_index"]) == [("x", "B1"), ("x", "B2"), ("y", "B1")]
    assert rows(t["battle_matches"]) == [("B1", "v1", 90, "one", "20240102", "u"), ("B1", "v3", 90, "Unknown Title", "20240301", "u"), ("B2", "v2", 90, "Unknown Title", "N/A", "N/A")]
    assert [r.video_id for r in marts.ordered_map_index(t["map_index"]).collect()] == ["v3", "v1"]
    assert t["last_battle"].first()[0] == 20240301
    assert marts.last_upload(world["videos"].limit(0)).first()[0] == 0
    assert rows(t["ocr_index"], "ocr_name") == [("Xavier",), ("x",), ("x",), ("xx",)]
    io.write_serving_tables(t, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/all_player_names").count() == 2
    lines = [json.loads(r.value) for r in marts.serving_document(t).collect()]
    assert {"last_battle": 20240301} in lines and sum("all_map_names" in x for x in lines) == 1
    assert [x["player_index"]["x"] for x in lines if "x" in x.get("player_index", {})] == [[{"battle_id": "B1"}, {"battle_id": "B2"}]]
    assert marts.index_totals(t["player_index"], t["battle_matches"], t["ocr_index"], t["map_index"]).first() == (2, 2, 3, 1)


def test_searches(world):
    t = marts.serving_tables(**world)
    assert [r.video_id for r in search.search_player(t["player_index"], t["battle_matches"], "x").collect()] == ["v3", "v1", "v2"]
    assert [r.video_id for r in search.search_map(t["map_index"], "m1").collect()] == ["v3", "v1"]
    assert [(r.ocr_name, r.score) for r in search.search_ocr(t["ocr_index"], "xavir").collect()] == [("Xavier", 0.2)]
    assert search.search_ocr(t["ocr_index"], "x", k=2).count() == 2
    names = t["all_player_names"]
    assert search.autocomplete(names, "player_name", "x").isEmpty() and search.autocomplete(names, "player_name", " ", "map").count() == 2
    outcome = lambda n: search.player_outcome(world["participants"], t["battle_matches"], n).first()[0]
    assert (outcome("nobody"), outcome("z"), outcome("x")) == ("unknown_player", "no_videos", "found")
    link = search.with_links(t["battle_matches"].where("video_id = 'v1'"), "https://r/?").first()
    assert (link.watch_url[-12:], link.time, link.display_date, link.replay_url) == ("?v=v1&t=90s", "1:30", "Tue Jan 02 2024", "https://r/?B1") or link.watch_url.endswith("?v=v1&t=90s")
    assert search.query_name("https://a/?playerName=a%20b&c=1") == "a b" and search.query_name("https://a/") is None


def test_schedule_and_plan(spark):
    durations = [None, 60.5, 89.0, 90.0, 91.2, 810.0, 811.0]
    videos = spark.createDataFrame([(f"v{i}", d, ["Game", "x"] if i % 2 else None) for i, d in enumerate(durations)], "video_id string, duration double, tags array<string>")
    out = [r.s for r in videos.select(sampling.schedule(F.col("duration")).alias("s")).collect()]
    assert out == [[], [], [], [], [90], [90], [90, 810]]
    frames = spark.createDataFrame([("v4", 90), ("v6", 90)], "video_id string, video_timestamp_sec int")
    assert rows(sampling.frames_to_take(videos, frames), "video_id") == [("v5",), ("v6",)]
    assert rows(sampling.frames_to_take(videos, frames, "gAME"), "video_id") == [("v5",)]
    one = spark.createDataFrame([([{"url": "f"}], "u"), ([], "u"), (None, "u")], "requested_formats array<struct<url:string>>, url string")
    assert [r[0] for r in one.select(sampling.stream_url(F.col("requested_formats"), F.col("url"))).collect()] == ["f", "u", "u"]


@pytest.mark.parametrize("n", [0, 1, 5, 101])
def test_exact_split(spark, n):
    df = spark.range(n).withColumn("k", F.col("id").cast("string"))
    got = Counter(r.split for r in sampling.exact_split(df, "k").collect())
    assert got["train"] == int(n * 0.8) and sum(got.values()) == n
    assert rows(sampling.exact_split(df, "k", seed=3)) == rows(sampling.exact_split(df.repartition(3), "k", seed=3))


class Reader:
    def hits(self, content):
        box = lambda x, y: [[float(x), float(y)]] * 4
        return [{"box": box(5, 9), "text": "12 name_b", "score": 0.9}, {"box": box(1, 9), "text": "nameA", "score": None}, {"box": box(0, 0), "text": "top", "score": 0.35}, {"box": box(0, 1), "text": "unsure", "score": 0.34}, {"box": box(0, 2), "text": "Total: 3", "score": 0.9}] if content == b"x" else []


def test_pictures_to_observations(spark, tmp_path):
    folder = tmp_path / "shots" / "deep"
    folder.mkdir(parents=True)
    for name, content in (("v_1_90s.png", b"x"), ("v_1_810s.png", b"x"), ("w_90s.png", b"0"), ("other.png", b"x"), ("v_90s.jpg", b"x")):
        (folder / name).write_bytes(content)
    files = io.read_pictures(spark, str(tmp_path / "shots"))
    shots = observations.frames(files)
    assert rows(shots, "video_id", "video_timestamp_sec") == [("v_1", 810), ("v_1", 90), ("w", 90)]
    done = spark.createDataFrame([("v_1", 810)], "video_id string, video_timestamp_sec int")
    read = observations.recognise(observations.unprocessed(shots, done), Reader)
    assert rows(read) == [("v_1", 90, ["top", "nameA", "name_b"]), ("w", 90, [])]
    assert rows(repair.video_ids_of_files(files)) == [("other.png",), ("v_1",), ("w",)]
    old = spark.createDataFrame([("v_1", 90, ["old"]), ("k", 1, ["k"])], read.schema)
    assert rows(observations.merged(old, read)) == [("k", 1, ["k"]), ("v_1", 90, ["top", "nameA", "name_b"]), ("w", 90, [])]


class Panels:
    def panels(self, content):
        if content == b"broken":
            raise ValueError("no picture")
        return 1000, 500, [([10, 0, 300, 200], 0.85), ([600, 20, 5000, 400], 0.9), ([700, 0, 900, 100], 0.9)] if content != b"none" else []

    def crop(self, content, box):
        return content + f" {box}".encode()


class Echo:
    def hits(self, content):
        return [{"box": [[0.0, 0.0]] * 4, "text": content.decode().translate({32: 95, 44: 95}), "score": 0.9}]


def test_only_the_panel_is_read(spark):
    shots = spark.createDataFrame([("a", 1, b"pic"), ("b", 2, b"none"), ("c", 3, b"broken"), ("d", 4, None)], "video_id string, video_timestamp_sec int, content binary")
    assert rows(observations.recognise(shots, Echo, Panels)) == [("a", 1, ["pic_[600__20__999__400]"]), ("b", 2, []), ("c", 3, []), ("d", 4, [])]
    found = [([600, 0, 700, 29], 0.99)]
    assert observations.panel_of(1000, 500, found) is None and observations.panel_of(1000, 500, [([500, 0, 700, 90], 0.99)]) is None
    assert observations.panel_of(1000, 500, [([501, -5, 700, 90], 0.81)]) == [501, 0, 700, 90] and observations.panel_of(1000, 500, [([501, 0, 700, 90], 0.80)]) is None


def test_labels_marks_keys_and_outcomes(spark, world):
    labels = spark.createDataFrame([("a", "0 1 1 1 1"), ("b", "0 2 2 2 2")], "stem string, line string")
    after = detections.labelled(labels, spark.createDataFrame([("b", None), ("c", "0 3 3 3 3")], labels.schema))
    assert rows(after) == [("a", "0 1 1 1 1"), ("b", None), ("c", "0 3 3 3 3")] and detections.label_counts(after).first() == (2, 1)
    found = spark.createDataFrame([("/x/a.png", ([1, 2, 3, 4], 0.5)), ("/x/b.png", None)], "path string, detection struct<box:array<int>,confidence:double>")
    document = detections.detections_document(found)
    assert [json.loads(r.value) for r in io.document_lines(document, "name", "detection").orderBy("value").collect()] == [{"a.png": {"box": [1, 2, 3, 4], "confidence": 0.5}}, {"b.png": None}]
    repeated = {(r.battle_id, r.player_name): r.rows for r in schemas.repeated_keys(world["participants"].union(world["participants"].where("player_name = 'z'")), "participants").collect()}
    assert repeated == {("B3", "z"): 2, ("B1", None): 1}
    index = marts.map_index(world["battles"], world["battle_videos"], world["videos"])
    assert rows(search.map_outcomes(spark.createDataFrame([("m1",), ("m0",)], "map_name string"), index)) == [("m0", "no_videos"), ("m1", "found")]
    assert [search.search_outcome(df, q).first()[0] for df, q in ((index, "x"), (index.limit(0), "x"), (index, ""))] == ["found", "no_matches", "no_query"]


def test_documents(spark, tmp_path):
    document = {"v1": {"title": "t", "upload_date": "20240101", "duration": 100, "tags": ["a"], "screenshots": {"90": ["x", "y"], "bad": []}}, "v2": {"title": None}}
    (tmp_path / "d.json").write_text(json.dumps(document, indent=4))
    (tmp_path / "broken.json").write_text("{nonsense")
    read = io.read_document(spark, str(tmp_path / "d.json"), schemas.SCREENSHOT_DOCUMENT)
    assert rows(io.screenshots_of(read)) == [("v1", 90, ["x", "y"], "20240101"), ("v1", None, [], "20240101")]
    assert rows(io.metadata_of(read), "video_id", "title") == [("v1", "t"), ("v2", None)]
    assert io.read_document(spark, str(tmp_path / "broken.json"), schemas.SCREENSHOT_DOCUMENT, strict=False).isEmpty()
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        io.read_document(spark, str(tmp_path / "broken.json"), schemas.SCREENSHOT_DOCUMENT).collect()
    full = observations.documents(io.metadata_of(read), io.screenshots_of(read).where("video_timestamp_sec is not null").select("video_id", "video_timestamp_sec", "players"))
    io.write_document(full, "video_id", "document", str(tmp_path / "out"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert {k: v.get("screenshots") for x in lines for k, v in x.items()} == {"v1": {"90": ["x", "y"]}, "v2": None}


class Service:
    def listing(self, channel, after):
        return [{"video_id": f"{channel}{i}", "upload_date": d} for i, d in enumerate(["20230101", "20240202", None])]

    def metadata(self, video_id):
        if video_id.endswith("1"):
            raise ValueError("private")
        return {"title": "t " + video_id, "upload_date": "20240101", "duration": 95.0, "uploader": "u", "tags": ["g"], "url": "s"}

    def frame(self, url, second):
        return f"{url}@{second}".encode()


def test_media_and_repair(spark):
    listing = media.list_channels(io.channels(spark, ["a", "b"]), Service, "20240101", spark.createDataFrame([("youtube b2",)], "value string"))
    assert rows(listing, "video_id") == [("a1",), ("a2",), ("b1",)]
    got = media.fetch_metadata(listing, Service)
    assert rows(got, "video_id", "title", "error") == [("a1", None, "private"), ("a2", "t a2", None), ("b1", None, "private")]
    none = spark.createDataFrame([], "video_id string, video_timestamp_sec int")
    assert rows(media.take_frames(got, none, Service)) == [("a2", 90, bytearray(b"s@90"), None)]
    metadata, frames = media.channel_frames(io.channels(spark, ["a"]), Service, "20240101", spark.createDataFrame([], "value string"), none)
    assert rows(metadata, "video_id") == [("a1",), ("a2",)] and rows(frames, "video_id", "video_timestamp_sec") == [("a2", 90)]
    calls = spark.sparkContext.accumulator(0)
    files = spark.createDataFrame([("/s/a2_90s.png",), ("/s/x1_90s.png",), ("/s/y_90s.png",)], "path string")
    names = ["video_id", "title", "upload_date", "duration", "uploader", "tags", "thumbnail"]
    known = spark.createDataFrame([("a2", "", "d", 1.0, "u", None, None), ("y", "kept", "d", 1.0, "u", None, None), ("q1", "titled", None, 1.0, "u", None, None)], "video_id string, title string, upload_date string, duration double, uploader string, tags array<string>, thumbnail string")
    assert rows(repair.to_refetch(files, known)) == [("a2",), ("q1",), ("x1",)]

    class Counted(Service):
        def metadata(self, video_id):
            calls.add(1)
            return super().metadata(video_id)

    after = repair.synced(files, known, lambda ids: media.fetch_metadata(ids, Counted).select(*names, "error"))
    assert rows(after, "video_id", "title", "upload_date") == [("a2", "t a2", "20240101"), ("q1", "titled", None), ("x1", "N/A", "N/A"), ("y", "kept", "d")]
    assert after.count() == 4 and calls.value == 3  # each of the three was asked for once
    other = files.union(spark.createDataFrame([("/s/ z_90s.jpg ",)], "path string"))
    assert [r.value for r in repair.skip_list(other, known).collect()] == ["youtube a2", "youtube q1", "youtube x1", "youtube y", "youtube z_90s.jpg"]


class Detector:
    def detect(self, content):
        return [((1, 2, 3, 4), 0.5), ((5, 6, 7, 8), 0.9)] if content else []


def test_labels_and_detections(spark, tmp_path):
    boxes = spark.createDataFrame([("s1", 10, 20, 110, 220, 1920, 1080), ("s2", 0, 0, 1920, 1080, 1920, 1080)], "stem string, x1 int, y1 int, x2 int, y2 int, w int, h int")
    c = F.col
    lines = boxes.withColumn("line", detections.encode_label(c("x1"), c("y1"), c("x2"), c("y2"), c("w"), c("h")))
    back = lines.select("x1", "y1", "x2", "y2", "line", detections.decode_label(c("line"), c("w"), c("h")).alias("b")).collect()
    assert back[0].line == "0 0.031250 0.111111 0.052083 0.185185"
    assert all(abs(a - b) <= 1 for r in back for a, b in zip(r[:4], r.b, strict=True))
    bad = spark.createDataFrame([("0 1 2",), ("",), (None,), ("a b c d e",)], "line string")
    assert [r[0] for r in bad.select(detections.decode_label(c("line"), F.lit(10), F.lit(10))).collect()] == [None] * 4
    images = spark.createDataFrame([("s1", "p"), ("s9", "p")], "stem string, path string")
    data = detections.dataset(lines.select("stem", "line"), images)
    assert rows(data, "stem") == [("s1",)]
    detections.write_dataset(data, str(tmp_path))
    assert "train" in spark.read.text(f"{tmp_path}/data.yaml").first()[0] or spark.read.text(f"{tmp_path}/data.yaml").count() > 1
    pictures = spark.createDataFrame([("a", b"x"), ("b", b"")], "path string, content binary")
    assert [(r.path, r.detection and r.detection.box) for r in detections.infer(pictures, Detector).orderBy("path").collect()] == [("a", [1, 2, 3, 4]), ("b", None)]
    found = spark.createDataFrame([("a", 0, [1000, -5, 3000, 900], 0.9, 1920, 1080), ("a", 1, [1, 1, 90, 90], 0.9, 1920, 1080), ("b", 0, [1000, 1, 1100, 90], 0.8, 1920, 1080), ("c", 0, [100, 1, 1100, 90], 0.99, 1920, 1080), ("d", 0, [1000, 1, 1020, 90], 0.99, 1920, 1080)], "path string, pos int, box array<int>, conf double, width int, height int")
    assert rows(observations.best_panel(found)) == [("a", [1000, 0, 1919, 900]), ("b", None), ("c", None), ("d", None)]


def test_ddl(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS roll_test")
    schemas.create_tables(spark, "roll_test")
    schemas.create_tables(spark, "roll_test")
    assert spark.table("roll_test.battles").columns == ["battle_id", "timestamp", "map_name"]
    spark.sql("DROP DATABASE roll_test CASCADE")


def test_playlists_of_any_depth(spark):
    deep = '{"id": "last"}'
    for i in range(12):
        deep = f'{{"_type": "playlist", "id": "list", "entries": [{{"id": "v{i}"}}, null, {deep}]}}'
    others = '{"_type": "playlist", "id": "no entries"}, {"id": "video", "entries": [{"id": "inner"}]}, {"title": "no id"}, {"_type": "playlist", "entries": []}, {"id": ""}'
    nested = spark.createDataFrame([(f"[{deep}, {others}]", 1), ('[{"id": "x"}]', 2), ("[]", 3), (None, 4)], "entries string, entry int")
    got = [json.loads(r.entry)["id"] for r in media.flatten_playlist(nested).collect()]
    assert sorted(got) == sorted([*[f"v{i}" for i in range(12)], "last", "no entries", "video", "x"])


def test_playlists_are_opened_where_they_are(spark):
    """A level is no run of its own: 7 levels are one pass, 20 are three; escaped keys count as keys."""
    deep = lambda n: '{"_type": "playlist", "entries": [' * n + '{"id": "v"}, {"\\u005ftype": "playlist", "entrie\\u0073": [{"id": "w"}]}' + "]}" * n
    for levels, passes in ((7, 1), (20, 3)):
        nested = spark.createDataFrame([(f"[{deep(levels)}]",)] * 3, "entries string")
        before = len(session._stored)
        assert sorted(json.loads(r.entry)["id"] for r in media.flatten_playlist(nested).collect()) == ["v"] * 3 + ["w"] * 3
        assert len(session._stored) - before == passes


@pytest.mark.parametrize("page_rows", [1, 3, 1000])
def test_pages_keep_the_order(spark, page_rows):
    own = [("hot", i % 7, i) for i in range(40)] + [("b", 1, 1), ("b", 1, 1), (None, 2, 2), ("c", None, 5)]
    frame = spark.createDataFrame(own, "k string, x int, y int").repartition(5)
    pages = marts.paged_lists(frame, "k", "items", page_rows).collect()
    for key in ("hot", "b", None, "c"):
        mine = sorted((p for p in pages if p.k == key), key=lambda p: p.page)
        assert [p.page for p in mine] == list(range(len(mine))) and all(len(p["items"]) == page_rows for p in mine[:-1]) and len(mine[-1]["items"]) <= page_rows
        want = sorted(((x, y) for k, x, y in own if k == key), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        assert [tuple(i) for p in mine for i in p["items"]] == want
    assert marts.paged_lists(frame.limit(0), "k", "items").collect() == []


def test_lookup_reads_few_row_groups(spark, tmp_path):
    rows_ = spark.range(200_000).selectExpr("concat('p', lpad(cast(id % 50000 as string), 6, '0')) as player_name", "md5(cast(id as string)) as battle_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        io.write_serving_tables({"player_index": rows_}, str(tmp_path / "new"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows_.repartition(4).write.parquet(str(tmp_path / "old" / "player_index"))

    def scanned(folder):
        found = io.read_serving_table(spark, str(tmp_path / folder), "player_index").where("player_name = 'p012345'")
        assert len(found.collect()) == 4
        plan = found._jdf.queryExecution().executedPlan()
        return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()

    assert scanned("new") < scanned("old") / 2


def test_absent_is_not_null(spark):
    from rollcall.functions.text import field_or_default

    frame = spark.createDataFrame([('{"t": null}',), ("{}",), ('{"t": ""}',), ('{"t": "x", "u": 1}',), ('{"t": 5}',), (None,)], "j string").select(F.parse_json("j").alias("v"))
    assert [r[0] for r in frame.select(field_or_default(F.col("v"), "t", "d")).collect()] == [None, "d", "", "x", "5", "d"]
