from pyspark.sql import functions as F

from emberline import fixtures as fx
from emberline.operators.boxes import tag_places
from emberline.operators.clean import clean_detections
from emberline.plans.warehouse import Warehouse
from emberline.session import scratch_path
from emberline.sources.detections import landing_stream, parse_lines, scan_daily, standardise
from emberline.streaming import jobs


def test_ingest_in_pieces_equals_batch(spark, sf_dir):
    folder = scratch_path(spark, "pieces")
    events = fx.events(spark, sf_dir)
    events.repartitionByRange(4, "event_id").write.parquet(folder)
    store = Warehouse(spark, scratch_path(spark, "wh"))

    def load(batch):
        store.merge_detections(tag_places(clean_detections(standardise(fx.raw_detections(batch)))))

    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    checkpoint = scratch_path(spark, "checkpoint")
    jobs.ingest(stream, load, checkpoint)
    jobs.ingest(stream, load, checkpoint)
    jobs.ingest(stream, load, scratch_path(spark, "checkpoint"))
    batch = fx.fact(spark, sf_dir)
    assert store.detections().count() == batch.count()
    assert store.detections().select("id_externo").exceptAll(batch.select("id_externo")).count() == 0


def test_daily_counts_drop_copies_and_wait_for_the_watermark(spark):
    rows = [("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 23:00:00"),
            ("c", "2024-01-02 01:00:00"), ("d", "2024-01-04 12:00:00")]
    source, path = scratch_path(spark, "timed"), scratch_path(spark, "daily")
    spark.createDataFrame(rows, "id_externo string, t string").select(
        "id_externo", F.to_timestamp("t").alias("t")).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("id_externo string, t timestamp").parquet(source)
    jobs.run_to_parquet(jobs.daily_counts(stream, "t"), path, scratch_path(spark, "checkpoint"))
    found = {(str(r["dia"]), r["focos_no_dia"]) for r in spark.read.parquet(path).collect()}
    assert found == {("2024-01-01", 2), ("2024-01-02", 1)}


def test_daily_totals_hold_every_day_and_late_rows(spark):
    rows = [("a", "2024-01-01"), ("a", "2024-01-01"), ("b", "2024-01-01"), ("c", "2024-01-09"), (None, "2024-01-09"), ("z", None)]
    late = [("d", "2024-01-01"), ("b", "2024-01-01"), ("e", "2024-01-10")]
    source, store = scratch_path(spark, "timed"), scratch_path(spark, "totals")
    checkpoint = scratch_path(spark, "checkpoint")

    def totals():
        return {str(r["dia"]): r["focos_no_dia"] for r in jobs.daily_totals(spark, store).collect()}

    def put(some):
        spark.createDataFrame(some, "id_externo string, t string").coalesce(1).write.mode("append").parquet(source)

    assert totals() == {}
    put(rows)
    stream = spark.readStream.schema("id_externo string, t string").option("maxFilesPerTrigger", 1).parquet(source)
    jobs.upsert_daily(stream, F.to_date("t"), store, checkpoint)
    assert totals() == {"2024-01-01": 2, "2024-01-09": 1}
    put(late)
    jobs.upsert_daily(stream, F.to_date("t"), store, checkpoint)
    assert totals() == {"2024-01-01": 3, "2024-01-09": 1, "2024-01-10": 1}
    jobs.upsert_daily(stream, F.to_date("t"), store, scratch_path(spark, "checkpoint"))
    assert totals() == {"2024-01-01": 3, "2024-01-09": 1, "2024-01-10": 1}


def test_landed_files_are_parsed_by_their_own_header(spark, tmp_path):
    day = tmp_path / "sensor=S" / "date=2024-01-02"
    day.mkdir(parents=True)
    (day / "a.csv").write_text('acq_date,frp,latitude\n2024-01-02,"1,5",3\n\n2024-01-02,2,4\n')
    (day / "b b%20.csv").write_text("latitude,acq_date,brightness\n9,2024-01-02,300\n")
    (day / "empty.csv").write_text("")
    (day / "head.csv").write_text("acq_date,frp,latitude\n")
    expected = {("2024-01-02", "1,5", "3", None), ("2024-01-02", "2", "4", None), ("2024-01-02", None, "9", "300")}
    columns = ["acq_date", "frp", "latitude", "brightness"]
    batch = scan_daily(spark, str(tmp_path), "S", "2024-01-03")
    assert {tuple(r) for r in batch.select(*columns).collect()} == expected
    assert [r.latitude for r in batch.orderBy("ordinal").collect()] == ["3", "4", "9"]
    seen = []

    def keep(lines):
        parsed = parse_lines(lines)
        if parsed is not None:
            seen.append([(r.asDict().get("brightness"), r.latitude, r.ordinal.idade) for r in parsed.orderBy("ordinal").collect()])

    jobs.ingest(landing_stream(spark, str(tmp_path), "2024-01-03", files=1), keep, scratch_path(spark, "checkpoint"))
    assert sorted(map(str, seen)) == sorted(map(str, [[(None, "3", 1), (None, "4", 1)], [("300", "9", 1)], []]))


def test_many_daily_files_cost_one_job_for_headers(spark, tmp_path):
    for i in range(40):
        day = tmp_path / "sensor=S" / f"date=2024-01-{i % 20 + 1:02d}"
        day.mkdir(parents=True, exist_ok=True)
        (day / f"{i}.csv").write_text(f"acq_date,frp\n2024-01-01,{i}\n" if i % 2 else f"frp,acq_date\n{i},2024-01-01\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers of daily files")
    rows = scan_daily(spark, str(tmp_path), "S", "2024-01-25", days=30)
    jobs_run = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs_run < 8
    assert sorted(int(r.frp) for r in rows.collect()) == list(range(40))
