import json

from tests.records import RAW, messages
from tests.test_streams import job, place, routes, run  # noqa: F401
from tidegate.operators.ops import stage_timings
from tidegate.sources import files
from tidegate.streaming.progress import ProgressLog, progress_stages, read_progress


def test_every_progress_is_kept_and_merged(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for number in range(103):
        rows = "".join(json.dumps({"n": i}) + "\n" for i in range(number % 3 + 1))
        (tmp_path / "in" / f"{number:03d}.json").write_text(rows)
    folder = str(tmp_path / "log")

    def start():
        source = spark.readStream.schema("n INT").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        return (
            source.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True).start()
        )

    with ProgressLog(spark, folder, merge_every=40) as log:
        query = start()
        query.awaitTermination()
        assert log.wait(query)
        kept = read_progress(spark, folder).orderBy("batch_id").collect()
        assert [r["batch_id"] for r in kept] == list(range(103))
        # Files of the same second come in any order.
        assert sorted(r["input_rows"] for r in kept) == sorted(i % 3 + 1 for i in range(103))
        # Two merges: the files of the first are gone, those of the second and the rest are there.
        names = files.names(spark, folder)
        assert sum(name.startswith("many-") for name in names) == 2
        assert sum(name.startswith("one-") for name in names) == 103 - 40
        (tmp_path / "in" / "last.json").write_text('{"n": 1}\n')
        query = start()
        query.awaitTermination()
        assert log.wait(query)
    again = read_progress(spark, folder)
    assert again.count() == 104 and again.select("run_id").distinct().count() == 2
    stages = {r["stage"] for r in progress_stages(again).select("stage").distinct().collect()}
    assert {"addBatch", "triggerExecution"} <= stages


def test_routing_is_timed_apart(spark, place):  # noqa: F811
    messages(spark, RAW, "{").coalesce(1).write.json(place("wire"), ignoreNullFields=False)
    run(spark, place, job(place, time_routing=True)).awaitTermination()
    timed = {r["stage"]: r["millis"] for r in stage_timings(spark.read.parquet(place("ops"))).collect()}
    assert {"decode", "route_lookup", "points"} <= set(timed) and min(timed.values()) >= 0
