import json

from rollcall import schemas
from rollcall.sources.io import Table
from rollcall.streaming import ingest as streams

from test_ingest import RECORDS


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    own = {n: Table(spark, f"{tmp_path}/{n}", schemas.TABLES[n]) for n in ("battles", "participants", "battle_videos")}

    def run():
        records = streams.once(streams.record_stream(spark, str(tmp_path / "in")), "30 days")
        streams.ingest_stream(records, own["battles"], own["participants"], str(tmp_path / "c1")).awaitTermination()

    (tmp_path / "in" / "1.json").write_text("\n".join(json.dumps(r) for r in RECORDS[:2]))
    run()
    assert own["battles"].read().count() == 2
    (tmp_path / "in" / "2.json").write_text("\n".join(json.dumps(r) for r in RECORDS[1:4]))
    run()
    assert sorted(r.battle_id for r in own["battles"].read().collect()) == ["a", "b", "d"]
    (tmp_path / "seen").mkdir()
    names = [f"p{i}" for i in range(6)]
    own["battles"].insert_or_ignore(spark.createDataFrame([("n", "2024-06-01T00:00:00.000Z", "m")], schemas.BATTLES), ["battle_id"])
    own["participants"].insert_or_ignore(spark.createDataFrame([("n", p) for p in names], schemas.PARTICIPANTS), ["battle_id", "player_name"])
    (tmp_path / "seen" / "1.json").write_text(json.dumps({"video_id": "v", "video_timestamp_sec": 90, "players": names, "upload_date": "20240701"}))
    streams.match_stream(spark, str(tmp_path / "seen"), own["battles"], own["participants"], own["battle_videos"], str(tmp_path / "c2")).awaitTermination()
    assert [tuple(r) for r in own["battle_videos"].read().collect()] == [("n", "v", 90, 100.0, 6, 6)]
    counts = streams.battles_per_window(streams.record_stream(spark, str(tmp_path / "in")))
    counts.writeStream.format("memory").queryName("per_window").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert {(str(r.start), r.map_name): r.battles for r in spark.table("per_window").collect()}[("2024-06-03 00:00:00", "m")] == 1
