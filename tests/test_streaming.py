"""Streams against batches, and models as batch functions."""

import pandas as pd

from folioloom.sources import plugins as G
from folioloom.streaming import pages as P


def run(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.sql(f"SELECT * FROM {name}").collect()


def test_documents_complete_when_all_pages_are_there(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.checkpointLocation", str(tmp_path / "cp"))
    schema = "doc_id string, page_idx int, page_count int"
    rows = [("a", 0, 3), ("b", 0, 1), ("a", 1, 3), ("a", 1, 3), ("c", 0, 2), ("z", -1, 0), ("a", 2, None), ("d", 5, None)]
    for k, r in enumerate(rows):
        spark.createDataFrame([r], schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/in/*")
    got = run(P.completed_documents(stream), "completed_docs")
    assert sorted((r.doc_id, r.n_pages, r.complete) for r in got) == [("a", 3, True), ("b", 1, True), ("z", 0, True)]


def test_task_states(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.checkpointLocation", str(tmp_path / "cp"))
    rows = [("t1", "pending", "2025-01-01 00:00:00"), ("t1", "processing", "2025-01-01 00:00:00"), ("t1", "processing", "2025-01-01 00:00:00"), ("t2", "failed", "2025-01-01 01:00:00"), ("t9", "pending", "2025-01-09 00:00:00")]
    spark.createDataFrame(rows, "task_id string, status string, t string").selectExpr("task_id", "status", "timestamp(t) AS submitted_at").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("task_id string, status string, submitted_at timestamp").parquet(str(tmp_path / "in"))
    got = {r.task_id: (r.status, r.n_states) for r in run(P.task_states(stream), "task_states", "update")}
    assert got["t1"] == ("processing", 2) and got["t2"] == ("failed", 1)


def test_windows_of_pages(spark):
    files = [(k, f"d{k}", n) for k, n in enumerate([3, 0, 5, None, 1, 4])]
    got = {(r.doc_id, r.page_idx): r.window_no for r in P.windows_of_pages(spark.createDataFrame(files, "ord int, doc_id string, page_count int"), 4).collect()}
    flat = [(d, p) for _, d, n in files for p in range(n or 0)]
    assert {k: w for k, w in got.items() if k[1] >= 0} == {k: i // 4 for i, k in enumerate(flat)}
    assert got["d1", -1] == got["d3", -1] == -1


def test_models(spark):
    rows = spark.createDataFrame([("d", 0, "text", 0.9, 0.0, 0.0, 1.0, 1.0)], "doc_id string, page_idx int, label string, score double, x0 double, y0 double, x1 double, y1 double")
    assert G.LAYOUT_DOUBLE.run(rows).count() == 1

    def shout():
        return lambda b: pd.DataFrame({"k": b["k"], "t": b["t"].str.upper()})

    m = G.Model("shout", shout, ("k", "t", "lang"), "k int, t string")
    df = spark.createDataFrame([(i, f"x{i}", "en" if i % 3 else "de", "extra") for i in range(50)], "k int, t string, lang string, more string")
    assert sorted(map(tuple, m.run(df, together="lang", partitions=3).collect())) == [(i, f"X{i}") for i in range(50)]


def test_acceptance_and_rotation(spark):
    df = spark.createDataFrame([("a", 0.9, "n"), ("b", 0.5, "n"), ("c", None, None)], "text string, score double, native string")
    assert [(r.accepted, r.accepted_score) for r in G.accept_recognised(df).collect()] == [("a", 0.9), ("n", 0.5), ("", 0.0)]
    s = spark.createDataFrame([(1, "0", 0.8), (1, "90", 0.85), (2, "0", 0.2), (2, "270", 0.9)], "k int, label string, score double")
    assert {r.k: r.label for r in G.best_rotation(s, "k").collect()} == {1: "0", 2: "270"}
