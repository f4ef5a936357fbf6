import datetime as dt

from folioframe.streaming import runs


def test_runs_as_a_stream(spark, tmp_path):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    days = [0, 1, 2, 4, 5, 7, 8, 10, 30, 31, 60]
    for k in range(2):  # the second file holds later days and moves the watermark
        rows = [(n, day(n), 1, "a", 0.0, "") for n in days[6 * k : 6 * k + 6]]
        spark.createDataFrame(rows, runs.EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")
    out = runs.recurring_runs(runs.read_events(spark, f"{tmp_path}/events", 1), least=3)
    q = out.writeStream.format("memory").queryName("found").outputMode("append").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = [(r["first"].day, r["last"].day, r["n"]) for r in spark.table("found").collect()]
    assert got == [(1, 11, 8)]
