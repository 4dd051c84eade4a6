import json
import random


from screenloom.operators import compare as oc
from screenloom.sources import files as sf
from screenloom.streaming import incremental as inc


def test_library_and_tile_csv(spark, tmp_path):
    (tmp_path / "lib.csv").write_text("sgrna,sgrna_seq,grp\nG1_0,ACGT,1\nG2_0,TTTT,2\n")
    assert [r.sgrna_seq for r in sf.read_library(spark, str(tmp_path / "lib.csv")).orderBy("lib_idx").collect()] == ["ACGT", "TTTT"]
    folder = tmp_path / "tiles"
    folder.mkdir()
    (folder / "Well2_Tile7.csv").write_text("cell,n\n1,5\n")
    (folder / "Well3_Tile11.csv").write_text("cell,n\n4,6\n")
    got = sf.read_tile_tables(spark, str(folder), "cell int, n int")
    assert sorted(map(tuple, got.collect())) == [(1, 5, 2, 7), (4, 6, 3, 11)]


def test_library_of_several_files_is_their_concatenation(spark, tmp_path):
    rows = [(f"G{k}", "ACGT"[k % 4] * 5, k % 3) for k in range(5000)]
    ends = [0, 1700, 1700, 1705, 4990, 5000]
    for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):  # one file without rows
        (tmp_path / f"lib-{k}.csv").write_text("sgrna,sgrna_seq,grp\n" + "".join(f"{n},{s},{g}\n" for n, s, g in rows[a:b]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # files of many blocks, in any number of tasks
    try:
        got = sf.read_library(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [tuple(r[c] for c in ("sgrna", "sgrna_seq", "grp")) for r in sorted(got, key=lambda r: r.lib_idx)] == rows
    assert sorted(r.lib_idx for r in got) == list(range(5000))


def test_metadata(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"well": 1, "tile": 2, "magnification": "10X", "nuclei": [{"label": 3, "y": 1.5, "x": 2.5}]}, indent=1))
    assert tuple(sf.read_metadata(spark, str(tmp_path / "m.json")).first()) == (1, 2, "10X", 3, 1.5, 2.5)


def test_write_by_tile(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 6)], "well int, tile int, n int")
    sf.write_by_tile(df, str(tmp_path / "out"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select("well", "tile", "n").collect())) == [(1, 1, 5), (1, 2, 6)]


def test_names(spark):
    df = spark.createDataFrame([("x/Well3_Point1_0012_ChannelDAPI,G-ISS_Seq0123.nd2",), ("Point1_0001_ChannelDAPI_Seq0001.nd2",), ("notes.txt",)], ["path"])
    assert sorted((r.well, r.tile, r.seq) for r in sf.parse_names(df).collect()) == [(1, 1, 1), (3, 12, 123)]
    assert sf.well_number("B2") == 5


def test_upsert_twice_changes_nothing(spark):
    old = spark.createDataFrame([("2024-01-01", 1, 1, 1, "error", 1.0), ("2024-01-01", 2, 1, 2, "success", 1.0)], "ts string, event_id long, well long, tile long, status string, value double")
    new = spark.createDataFrame([("2024-01-02", 3, 1, 1, "success", 2.0)], old.schema)
    once = inc.upsert(inc.latest(old), new)
    twice = inc.upsert(once, new)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert tuple(inc.well_counters(twice).first()) == (1, 2, 2, 0, "1,2")


ARRIVAL = "ts string, event_id long, well long, tile long, status string, value double"


def plain(df):
    return sorted(map(tuple, df.collect()))


def test_streams_equal_batches(spark, tmp_path):
    rng = random.Random(4)
    source, seen = tmp_path / "in", []
    source.mkdir()
    rows = [(f"2024-01-01 00:{rng.randrange(60):02d}", d, 1 + d % 2, 1 + d % 3, rng.choice(["error", "success", "success"]), float(d)) for d in range(60)]
    rows += [("2024-01-02", 70, 1, 1, "success", 1.0), ("2024-01-02", 71, 1, 1, "error", 1.0), ("2024-01-02", 71, 1, 1, "error", 1.0)]  # a tile that runs twice at one time
    rows += [(None, 90, 2, 2, None, None), ("2023", 91, 1, 1, "success", 0.0), ("2025", 92, 9, 9, None, None)]  # what comes late, or without a time
    stream = lambda: spark.readStream.schema(ARRIVAL).option("maxFilesPerTrigger", 1).parquet(str(source))
    for k, batch in enumerate([rows[:20], rows[20:60], rows[60:62], rows[62:63], rows[63:] + rows[:5]]):
        spark.createDataFrame(batch, ARRIVAL).coalesce(1).write.mode("append").parquet(str(source))
        seen += batch
        want = inc.latest(spark.createDataFrame(seen, ARRIVAL))
        for _ in range(2 if k == 1 else 1):  # a second run finds nothing new
            inc.stream_upserts(stream(), str(tmp_path / "table"), str(tmp_path / "c1"), buckets=2).awaitTermination()
            inc.stream_counters(stream(), str(tmp_path / "counters"), str(tmp_path / "c2"), buckets=2).awaitTermination()
        assert plain(inc.read_current(spark, str(tmp_path / "table")).select(*want.columns)) == plain(want)
        assert plain(inc.read_counters(spark, str(tmp_path / "counters"))) == plain(inc.well_counters(want))
    inc.stream_log(stream(), str(tmp_path / "log"), str(tmp_path / "c3")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "log")).count() == len(seen)


def test_a_batch_writes_no_more_than_itself(spark, tmp_path):
    log = inc.tile_log(spark, str(tmp_path / "log"), buckets=4, most=6)
    assert log.read() is None
    tiles = [("2024", k, k % 7, k, "success", float(k)) for k in range(4000)]
    log.append(spark.createDataFrame(tiles, ARRIVAL), 0)
    kept = {k: r for k, r in enumerate(tiles)}
    size = lambda p: sum(f.stat().st_size for f in p.rglob("*.parquet"))
    folders = lambda kind: sorted(int(p.name) for p in (tmp_path / "log" / kind).iterdir())
    assert folders("base") == [0]
    whole, compacted = size(tmp_path / "log" / "base" / "0"), 0
    for k in range(1, 15):
        row = (f"2025-{k:02d}", 5000 + k, (k % 3) % 7, k % 3, "error", 0.0)
        kept[k % 3] = row
        log.append(spark.createDataFrame([row], ARRIVAL), k)
        if k % 5 == 0:  # a replay
            log.append(spark.createDataFrame([row], ARRIVAL), k)
        assert size(tmp_path / "log" / "changes" / str(k)) < whole / 5
        compacted += k in folders("base")
        assert plain(log.read().select("ts", "event_id", "well", "tile", "status", "value")) == sorted(kept.values())
    # a new base after every six changes; the one before it stays, with its changes
    assert compacted == 2 and folders("base") == [6, 12] and folders("changes") == list(range(7, 15))
    # a folder that was never completed isn't read
    (tmp_path / "log" / "base" / "13").mkdir()
    assert log.read().count() == 4000


def test_run_difference_with_zero_column(spark):
    schema = "well long, tile long, cell long, sgrna string, a long, z long"
    one = spark.createDataFrame([(1, 1, 1, "x", 10, 0), (1, 1, 2, "y", 10, 0), (1, 1, 3, "z", 1, 0)], schema)
    two = spark.createDataFrame([(1, 1, 1, "x", 11, 0), (1, 1, 2, "w", 10, 0), (1, 1, 4, "z", 1, 0)], schema)
    r = oc.run_difference(one, two, ["a", "z"]).first()
    assert (r.common, r.missing, r.extra, r.percent_other_guide, r.a_relative, r.a_within, r.z_relative, r.z_within) == (2, 1, 1, 50.0, 0.05, True, None, None)


def test_many_tiles_share_tasks(spark, tmp_path):
    """A folder for each tile in the layout of partitionBy, written and read by few tasks, not one or two listings for each."""
    rows = [(1 + k % 2, k // 4 if k % 4 else None, k, None if k % 7 == 0 else f"g{k}") for k in range(2800)]
    df = spark.createDataFrame(rows, "well long, tile long, n long, g string").repartition(3)
    plain = lambda d: sorted(map(tuple, d.select("well", "tile", "n", "g").collect()), key=lambda r: r[2])
    for _ in range(2):  # a second time what is there is replaced
        sf.write_by_tile(df, str(tmp_path / "out"))
        got = sf.read_by_tile(spark, str(tmp_path / "out"), "n long, g string, well long, tile long")
        assert plain(got) == rows
    assert plain(spark.read.parquet(str(tmp_path / "out"))) == rows
    folders = [p for p in (tmp_path / "out").iterdir()]
    assert sorted(p.name for p in folders) == ["well=1", "well=2"] and len(list((tmp_path / "out").rglob("*.parquet"))) == len({r[:2] for r in rows})
    assert got.rdd.getNumPartitions() == -(-len({r[:2] for r in rows}) // 256)
    assert plain(got.filter("tile = 5 AND well = 2")) == [r for r in rows if r[:2] == (2, 5)]
    assert plain(got.filter("well = 2 AND tile IS NULL")) == [r for r in rows if r[:2] == (2, None)]
    sf.write_by_tile(df.limit(0), str(tmp_path / "none"))
    assert sf.read_by_tile(spark, str(tmp_path / "none"), "n long, well long, tile long").count() == 0
