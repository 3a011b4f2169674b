import json
import os

import pytest

from rollcall import schemas
from rollcall.operators import ingest
from rollcall.plans import queries as plans
from rollcall.plans.domain import Domain
from rollcall.sources import replay_api
from rollcall.sources.io import PartitionedTable, Table, write_together

RECORDS = [
    {"id": "a", "startTime": "2024-06-03T00:00:00.000Z", "Map": {"scriptName": "m"}, "AllyTeams": [{"Players": [{"name": "x"}, {"name": ""}, {"name": None}]}, {"Players": [{"name": "y"}, {"name": "x"}]}]},
    {"id": "b", "startTime": "2024-06-02T00:00:00.000Z", "Map": None, "AllyTeams": [{"Players": []}]},
    {"id": "c", "startTime": "2024-06-02T00:00:00.000Z", "AllyTeams": []},
    {"id": "d", "startTime": "2024-06-01T00:00:00.000Z", "AllyTeams": [{"Players": [{"name": "z"}]}]},
    {"id": None, "startTime": "2024-06-01T00:00:00.000Z", "AllyTeams": [{"Players": [{"name": "q"}]}]},
    {"id": "old", "startTime": "2023-06-01T00:00:00.000Z", "AllyTeams": [{"Players": [{"name": "q"}]}]},
]


def page(url, number, limit):
    return RECORDS[(number - 1) * limit : number * limit]


def records(spark, tmp_path):
    (tmp_path / "in.json").write_text("\n".join(map(json.dumps, RECORDS)))
    return spark.read.schema(schemas.API_BATTLE).json(str(tmp_path / "in.json"))


def tables(spark, tmp_path):
    return {n: Table(spark, f"{tmp_path}/{n}", schemas.TABLES[n]) for n in ("battles", "participants", "players")}


def test_ingest_twice_adds_nothing(spark, tmp_path):
    own = tables(spark, tmp_path)
    new, mark = ingest.ingest(records(spark, tmp_path), *(own[n].read() for n in own))
    assert mark == "2024-06-03T00:00:00.000Z"
    assert sorted(map(tuple, new["battles"].collect())) == [("a", "2024-06-03T00:00:00.000Z", "m"), ("b", "2024-06-02T00:00:00.000Z", None), ("d", "2024-06-01T00:00:00.000Z", None)]
    assert sorted(map(tuple, new["participants"].collect())) == [("a", "x"), ("a", "y"), ("d", "z")]
    for name, rows in new.items():
        own[name].insert_or_ignore(rows, schemas.KEYS[name])
    assert own["players"].read().count() == 3
    again, mark = ingest.ingest(records(spark, tmp_path), *(own[n].read() for n in own))
    assert mark == "2024-06-03T00:00:00.000Z" and all(rows.isEmpty() for rows in again.values())


def test_part_of_a_pull_moves_no_mark(spark, tmp_path):
    own = tables(spark, tmp_path)
    _, mark = ingest.ingest(records(spark, tmp_path), *(own[n].read() for n in own), complete=False)
    assert mark is None


def test_counts_of_a_run(spark, tmp_path):
    own = tables(spark, tmp_path)
    pulled = records(spark, tmp_path)
    new, counts = ingest.ingest_counted(pulled, *(own[n].read() for n in own), earliest=ingest.EARLIEST)
    assert counts.first() == (6, 2, 3, 3, 3) and counts.columns == ["records", "skipped", "battles", "players", "links"]
    want, _ = ingest.ingest(pulled, *(own[n].read() for n in own))
    assert {n: sorted(map(tuple, rows.collect())) for n, rows in new.items()} == {n: sorted(map(tuple, rows.collect())) for n, rows in want.items()}
    assert ingest.ingest_counted(pulled, *(own[n].read() for n in own), since="2024-06-02T00:00:00.000Z")[1].first() == (6, 2, 1, 2, 2)


def test_inserts_append_and_come_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Table, "MOST_PARTS", 3)
    t = Table(spark, f"{tmp_path}/p", schemas.PLAYERS)
    for i in range(5):
        t.insert_or_ignore(spark.createDataFrame([(f"p{i}",), ("p0",)], schemas.PLAYERS), ["player_name"])
        assert t.read().count() == i + 1
    assert t.parts(3) == ["v=1", "v=2", "v=3"] and t.parts() == ["v=4", "v=5"]
    write_together([(t, spark.createDataFrame([("q",)], schemas.PLAYERS))], append=True)
    assert t.read().count() == 6 and t.read(2).count() == 2


def test_mark_is_exclusive(spark, tmp_path):
    got = ingest.newer_than(records(spark, tmp_path), "2024-06-02T00:00:00.000Z").select("id").collect()
    assert [r.id for r in got] == ["a"]


def test_upserts_and_versions(spark, tmp_path):
    t = Table(spark, f"{tmp_path}/v", schemas.VIDEOS)
    rows = lambda *r: spark.createDataFrame(r, schemas.VIDEOS)
    assert t.read().isEmpty() and t.version() == 0
    t.insert_or_ignore(rows(("1", "d", "first", "u"), ("1", "d", "second", "u")), ["video_id"])
    assert [r.title for r in t.read().collect()] == ["first"]
    t.insert_or_ignore(rows(("1", "d", "other", "u"), ("2", "d", "two", "u")), ["video_id"])
    t.insert_or_replace(rows(("2", "e", "new two", "u")), ["video_id"])
    assert sorted((r.video_id, r.title) for r in t.read().collect()) == [("1", "first"), ("2", "new two")]
    assert t.version() == 3 and t.read(1).count() == 1  # older versions are backups
    counts = ingest.upsert_counts(t.read(), rows(("2", "x", "y", "z"), ("9", "x", "y", "z")), ["video_id"]).first()
    assert (counts.additions, counts.updates) == (1, 1)
    t.overwrite(t.read().where("video_id = '1'"))
    assert t.read().count() == 1


def test_write_together(spark, tmp_path):
    own = tables(spark, tmp_path)
    new, _ = ingest.ingest(records(spark, tmp_path), *(own[n].read() for n in own))
    write_together([(own[n], rows) for n, rows in new.items()])
    assert [own[n].read().count() for n in own] == [3, 3, 3]
    broken = spark.createDataFrame([("a", "b")], "battle_id string, player_name string").selectExpr("battle_id", "raise_error('no') as player_name")
    try:
        write_together([(own["battles"], own["battles"].read().limit(1)), (own["participants"], broken)])
    except Exception:
        pass
    assert [own[n].version() for n in own] == [1, 1, 1]


def test_replay_source(spark):
    replay_api.register(spark)
    read = lambda **o: spark.read.format("replay_api").options(url="none", fetch="test_ingest:page", limit=2, delay=0, **o).load()
    got = read().collect()
    assert [r.id for r in got] == ["a", "b", "c", "d"]
    assert got[0].Map.scriptName == "m" and got[1].Map.scriptName is None and [p.name for p in got[0].AllyTeams[1].Players] == ["y", "x"]
    assert [r.id for r in read(since="2024-06-02T00:00:00.000Z").collect()] == ["a"]


PULLED = [{"id": f"r{i}", "startTime": f"2024-07-{28 - i // 2:02d}T00:00:00.000Z", "AllyTeams": [{"Players": [{"name": f"n{i}"}]}]} for i in range(11)]


def breaking_page(url, number, limit):
    """Pages of what stands in a file of url; page 3 fails while url/broken exists."""
    if number == 3 and os.path.exists(f"{url}/broken"):
        raise OSError("page 3")
    with open(f"{url}/all.json") as f:
        return json.load(f)[(number - 1) * limit : number * limit]


def test_a_pull_that_fails_goes_on_where_it_was(spark, tmp_path):
    """Page 3 fails; before the pull goes on, newer records come in, and a later pull takes those: no gap, no repeat."""
    replay_api.register(spark)
    url = str(tmp_path / "service")
    os.mkdir(url)
    put = lambda rows: (tmp_path / "service" / "all.json").write_text(json.dumps(rows))
    put(PULLED)
    (tmp_path / "service" / "broken").touch()

    def run():
        stream = spark.readStream.format("replay_api").options(url=url, fetch="test_ingest:breaking_page", limit=3, delay=0, earliest="2024-07-24T00:00:00.000Z").load()
        query = stream.select("id").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "mark")).start(str(tmp_path / "out"))
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    got = lambda: sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    with pytest.raises(Exception, match="page 3"):
        run()
    assert got() == sorted(r["id"] for r in PULLED[:6])
    (tmp_path / "service" / "broken").unlink()
    newer = [{**PULLED[0], "id": f"new{i}", "startTime": "2024-08-01T00:00:00.000Z"} for i in range(4)]
    put([*newer, *PULLED])
    run()
    assert got() == sorted(r["id"] for r in [*PULLED[:10], *newer])
    run()
    assert got() == sorted(r["id"] for r in [*PULLED[:10], *newer])


def test_a_batch_that_runs_again_has_the_same_records(tmp_path):
    url = str(tmp_path)
    (tmp_path / "all.json").write_text(json.dumps(PULLED))
    reader = replay_api._StreamReader({"url": url, "fetch": "test_ingest:breaking_page", "limit": "3", "delay": "0", "earliest": "2024-07-24T00:00:00.000Z"})
    offsets, batches = [reader.initialOffset()], []
    for _ in range(5):
        rows, end = reader.read(offsets[-1])
        batches.append([r[0] for r in rows])
        offsets.append(end)
    assert sum(batches, []) == [r["id"] for r in PULLED[:10]] and offsets[-1]["since"] == PULLED[0]["startTime"]
    (tmp_path / "all.json").write_text(json.dumps([{**PULLED[0], "id": f"new{i}", "startTime": "2024-08-01T00:00:00.000Z"} for i in range(5)] + PULLED))
    for start, end, want in zip(offsets, offsets[1:], batches, strict=False):
        assert [r[0] for r in reader.readBetweenOffsets(start, end)] == want


def test_only_touched_partitions_are_written(spark, tmp_path):
    t = PartitionedTable(spark, f"{tmp_path}/t", schemas.VIDEOS, ["video_id"], partitions=8)
    make = lambda *r: spark.createDataFrame(r, schemas.VIDEOS)
    assert t.read().isEmpty()
    assert t.insert_or_replace(make(*[(str(i), "d", "old", "u") for i in range(100)])) == 8
    files = lambda: {str(f.relative_to(tmp_path)) for f in (tmp_path / "t").rglob("*.parquet")}
    before = files()
    assert t.insert_or_replace(make(("7", "d", "new", "u"), ("x", "d", "new", "u")), ["video_id"]) <= 2
    gone, come = {f.split("/")[1] for f in before - files()}, {f.split("/")[1] for f in files() - before}
    assert gone <= come and len(come) <= 2
    assert sorted((r.video_id, r.title) for r in t.read().where("title = 'new'").collect()) == [("7", "new"), ("x", "new")] and t.read().count() == 101
    try:
        t.insert_or_replace(make(("8", "d", "t", "u")).selectExpr("video_id", "upload_date", "raise_error('no') as title", "uploader"))
    except Exception:
        pass
    assert t.read().count() == 101


def test_participants_are_put_together_without_a_table_of_names(spark):
    """Null teams, players and names, and an id in two records; the plan explodes after its only grouping, which is by id."""
    schema = "id string, startTime string, Map struct<scriptName:string>, AllyTeams array<struct<Players:array<struct<name:string>>>>"
    team = lambda *names: (None if names == (None,) else [(n,) if n != "-" else None for n in names],)
    rows = [("a", "t", ("m",), [team("x", "y", "x"), team(None), None, team("", "-", "z")]), ("a", "u", None, [team("y", "w")]), ("b", "t", None, [team("x")]), ("c", "t", None, []), ("d", None, None, [team("x")]), ("e", "t", None, [team()])]
    found = ingest.participant_rows(spark.createDataFrame(rows, schema).repartition(3))
    assert sorted(map(tuple, found.collect())) == [("a", "w"), ("a", "x"), ("a", "y"), ("a", "z"), ("b", "x")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.index("Generate") < plan.index("Aggregate")


def test_a_counted_run_meets_the_known_tables_at_once(spark, monkeypatch):
    """An id in two records, a known battle with new names, known names whose battle or player isn't, nulls in known tables; two tables are written."""
    schema = "id string, startTime string, Map struct<scriptName:string>, AllyTeams array<struct<Players:array<struct<name:string>>>>"
    team = lambda *names: ([(n,) for n in names],)
    rows = [("a", "u", ("m",), [team("x", "y", "x")]), ("a", "t", None, [team("y", "w")]), ("b", "t", ("m",), [team("x", "z"), team("v")]), ("c", "t", None, [team()]), ("d", "t", None, [team("x")]), ("e", "t", None, None)]
    battles = spark.createDataFrame([("b", "t", "m"), ("b", "t", "n"), (None, "t", None)], schemas.BATTLES)
    participants = spark.createDataFrame([("b", "x"), ("b", "x"), ("b", None), ("d", "x"), ("a", "q"), (None, "w")], schemas.PARTICIPANTS)
    players = spark.createDataFrame([("v",), ("w",), (None,)], schemas.PLAYERS)
    written, stored = [], ingest.stored
    monkeypatch.setattr(ingest, "stored", lambda df: written.append(df) or stored(df))
    new, counts = ingest.ingest_counted(spark.createDataFrame(rows, schema).repartition(3), battles, participants, players)
    assert counts.first() == (6, 1, 3, 3, 5)
    assert sorted(map(tuple, new["battles"].collect())) == [("a", "t", None), ("c", "t", None), ("d", "t", None)]
    assert sorted(map(tuple, new["participants"].collect())) == [("a", "w"), ("a", "x"), ("a", "y"), ("b", "v"), ("b", "z")]
    assert sorted(map(tuple, new["players"].collect())) == [("x",), ("y",), ("z",)]
    assert len(written) == 2 and all(new[n].columns == schemas.TABLES[n].names for n in new)


def test_counts_shuffle_little_more_than_two_deals_of_the_names(spark):
    """Without broadcasts, as on large tables: one deal for records and known rosters, one for known players."""
    folder, sc = "/root/testdata/sf0.001", spark.sparkContext._jsc.sc()

    def shuffled():
        sc.listenerBus().waitUntilEmpty()
        return sc.statusStore().executorList(False).apply(0).totalShuffleWrite()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        start = shuffled()
        plans.QUERIES["ingest_counts"](spark, folder).collect()
        counted = shuffled() - start
        for _ in range(2):
            Domain(spark, folder)._names().repartition("l_orderkey").write.format("noop").mode("overwrite").save()
        assert 0 < counted < 0.75 * (shuffled() - start - counted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
