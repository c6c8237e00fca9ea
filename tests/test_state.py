"""Streams that keep state over batches and restarts, and the levelled log."""

import json
import random
import shutil

from pyspark.sql import functions as F

from brisalake.sources import files
from brisalake.streaming import events as ev
from brisalake.streaming import levels
from brisalake.streaming import pipeline as pl
from brisalake.streaming import state as st

EVENT = "id int, ts_convertido timestamp, sigla_uf string, latencia_ms double, peso_aluno double, alfabetizado boolean"


def land(spark, folder, i, rows):
    spark.createDataFrame(rows, EVENT.replace("timestamp", "string")).withColumn(
        "ts_convertido", F.col("ts_convertido").cast("timestamp")).coalesce(1).write.parquet(f"{folder}/part={i}")


def stream(spark, folder):
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)


def events(seed, n, day, uf="SP"):
    rng = random.Random(seed)
    return [(i, f"2024-05-{day:02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00", uf, float(rng.randrange(5000)), 1.0, rng.random() < 0.5) for i in range(n)]


def test_windows_close_once_and_late_rows_do_not_count(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    run = lambda: st.closed_windows(stream(spark, src), "1 hour", "sigla_uf", "30 minutes", out, cp)
    seen = lambda: {(str(r.janela_inicio), r.sigla_uf): r.eventos for r in spark.read.parquet(out).collect()}
    first = events(1, 300, 1)
    land(spark, src, 0, first)
    run()
    once = seen()
    land(spark, src, 1, events(2, 200, 2))
    run()  # a restart; day 1 is closed by now
    land(spark, src, 2, events(3, 50, 1))  # too late for every window of day 1
    land(spark, src, 3, events(4, 10, 9))
    run()
    rows = [(str(r.janela_inicio), r.sigla_uf) for r in spark.read.parquet(out).collect()]
    assert len(rows) == len(set(rows)) and once.items() <= seen().items()
    assert sum(n for (w, _), n in seen().items() if w.startswith("2024-05-01")) == 300
    assert sum(n for (w, _), n in seen().items() if w.startswith("2024-05-02")) == 200


def test_sketch_ranks_and_merging(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    n = 20_000
    rows = spark.range(n).select(F.col("id").cast("int").alias("id"), F.timestamp_seconds(F.lit(1_714_550_400) + F.col("id") % 7200).alias("ts_convertido"),
                                 F.lit("SP").alias("sigla_uf"), F.pow(F.rand(3), 4).alias("latencia_ms"), F.lit(2.0).alias("peso_aluno"), (F.col("id") % 4 == 0).alias("alfabetizado"))
    rows.write.parquet(src)
    spark.read.parquet(src).withColumns({"id": F.lit(0), "ts_convertido": F.col("ts_convertido") + F.expr("INTERVAL 3 DAYS")}).limit(1).write.mode("append").parquet(src)
    st.closed_windows(spark.readStream.schema(EVENT).parquet(src), "1 hour", "sigla_uf", "1 minute", out, str(tmp_path / "cp"))
    hours = spark.read.parquet(out)
    assert hours.count() == 2
    day = st.window_report(st.merged_windows(hours, "1 day", "sigla_uf"), "sigla_uf").first()
    assert day.eventos == n and day.taxa_pct == 25.0
    for p, cut in ((0.5, day.latencia_p50_ms), (0.95, day.latencia_p95_ms)):
        below = spark.read.parquet(src).filter("ts_convertido < '2024-05-02'").filter(F.col("latencia_ms") <= cut).count() / n
        assert abs(below - p) <= 3 * st.RANK_ERROR


def test_running_state_goes_on_without_earlier_output(spark, tmp_path):
    """Three batches with a restart; all output is deleted before the last, whose totals are still complete."""
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    run = lambda: st.running_state(stream(spark, src), ["sigla_uf"], out, cp)
    for i in range(2):
        land(spark, src, i, events(i, 40, 1, "SP") + events(i, 10, 1, "RJ"))
    query = run()
    assert [p.batchId for p in query.recentProgress if p.numInputRows] == [0, 1]
    shutil.rmtree(out)
    land(spark, src, 2, events(5, 7, 1, "SP"))
    run()
    got = {r.sigla_uf: (r.avaliados, r.peso) for r in pl.read_upserted(spark, out, ["sigla_uf"]).collect()}
    assert got == {"SP": (87, 87.0)}  # only units of the last batch are sent on


def test_progress(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for i in range(3):
        land(spark, src, i, events(i, 20 + i, 1))
    query = pl.stream_available_now(stream(spark, src), out, str(tmp_path / "cp"))
    progress = st.query_progress(spark, query)
    rate = st.throughput(progress).first()
    assert rate.linhas == spark.read.parquet(out).count() == 63 and rate.lotes == 3 and rate.throughput_msg_s > 0
    assert sorted(r.linhas for r in progress.filter("linhas > 0").collect()) == [20, 21, 22]
    log, report = st.ProgressLog(keep=2), json.loads(query.lastProgress.json)
    event = type("Event", (), {"progress": type("Progress", (), {"json": json.dumps(report)})})
    for _ in range(3):
        log.onQueryProgress(event)
    assert log.store(spark, str(tmp_path / "log")) == 2 and log.store(spark, str(tmp_path / "log")) == 0
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_no_progress(spark):
    rate = st.throughput(spark.createDataFrame([], st.PROGRESS)).first()
    assert (rate.lotes, rate.linhas, rate.linhas_estado, rate.throughput_msg_s) == (0, 0, 0, None)


def batch_of(spark, i, size=6, keys=40):
    rng = random.Random(i)
    return [(rng.randrange(keys), i, f"2024-05-0{1 + rng.randrange(3)}") for _ in range(size)]


def test_fifty_batches_open_few_files(spark, tmp_path):
    target, want = str(tmp_path / "t"), {}
    handle = pl.upsert_batch(target, ["k"], [F.desc("v"), F.asc("d")], "d", fan=4)
    for i in range(50):
        rows = batch_of(spark, i)
        frame = spark.createDataFrame(rows, "k int, v int, d string").coalesce(1)
        handle(frame, i)
        if i % 7 == 0:
            handle(frame, i)  # replayed
        for k, _, d in sorted(rows):
            want.setdefault((k, i), d)  # the first date of a key's rows of one batch
    newest = {}
    for (k, i), d in want.items():
        newest[k] = max(newest.get(k, (-1, "")), (i, d))
    got = {r.k: (r.v, r.d) for r in pl.read_upserted(spark, target, ["k"]).collect()}
    assert got == newest
    assert len(levels.runs(spark, target)) <= 3 * 3
    opened = pl.read_upserted(spark, target, ["k"]).inputFiles()
    assert len(opened) <= 3 * 3 * 3  # runs, levels, dates


def test_failed_fold_and_replay_of_a_folded_batch(spark, tmp_path):
    target = str(tmp_path / "t")
    handle = pl.upsert_batch(target, ["k"], [F.desc("v")], fan=3)
    frames = [spark.createDataFrame([(1, i), (10 + i, i)], "k int, v int") for i in range(4)]
    for i in range(3):
        handle(frames[i], i)
    assert [r.name for r in levels.runs(spark, target)] == ["run=1_0_2"]
    files.remove(spark, f"{target}/run=1_0_2/_SUCCESS")  # as if the fold had failed on the way
    assert [r.name for r in levels.runs(spark, target)] == ["run=0_0_0", "run=0_1_1", "run=0_2_2"]
    handle(frames[3], 3)
    handle(frames[1], 1)  # comes again after it has been folded
    assert {r.k: r.v for r in pl.read_upserted(spark, target, ["k"]).collect()} == {1: 3, 10: 0, 11: 1, 12: 2, 13: 3}


def test_single_partitions_and_moving_rows(spark, tmp_path):
    target = str(tmp_path / "t")
    handle = pl.upsert_batch(target, ["k"], [F.desc("v")], "d")
    handle(spark.createDataFrame([(1, 1, "01"), (2, 1, "02"), (3, 1, None)], "k int, v int, d string"), 0)
    handle(spark.createDataFrame([(2, 2, "01")], "k int, v int, d string"), 1)
    assert sorted((r.k, r.v, r.d) for r in pl.read_upserted(spark, target, ["k"]).collect() if r.d) == [(1, 1, "01"), (2, 2, "01")]
    assert {r.k for r in pl.read_upserted(spark, target, ["k"], ["1"]).collect() + pl.read_upserted(spark, target, ["k"], ["01"]).collect()} == {1, 2}


def test_bloom_filters_on_the_key(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    target = str(tmp_path / "t")
    pl.upsert_batch(target, ["k"], [F.desc("v")])(spark.range(2000).select(F.col("id").alias("k"), F.lit(1).alias("v")), 0)
    with open(glob.glob(f"{target}/run=0_0_0/*/*.parquet")[0], "rb") as f:
        size, footer = len(f.read()), pq.ParquetFile(f.name).metadata.row_group(0)
    data = sum(footer.column(i).total_compressed_size for i in range(footer.num_columns))
    assert size - data > 1500  # the filter lies between the columns and the footer


def test_parts_are_landed_by_all_tasks_and_read_a_part_a_trigger(spark, tmp_path):
    from types import SimpleNamespace

    from brisalake.plans.queries_stream import in_batches

    rows = spark.range(400).select(F.col("id").cast("string").alias("id_evento")).repartition(4, "id_evento")
    land, stream = in_batches(SimpleNamespace(spark=spark, work=str(tmp_path), valid=rows), "s")
    land(), land()
    assert len(list((tmp_path / "s_in" / "part=0").glob("*.parquet"))) == 4
    sizes = []
    stream().writeStream.foreachBatch(lambda df, _: sizes.append(df.count())).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert len(sizes) == 2 and sum(sizes) == rows.filter("pmod(xxhash64(id_evento), 3) < 2").count()
