"""The driver contract: queries run, SQL has the same columns, nothing is registered twice."""

import __spark_entry__ as entry


def test_registry():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q) and len(q) > 80
    assert all(callable(f) for f in q.values())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["rec_id", "page_no"]


def test_sql_gives_the_same_rows(spark):
    duckdb = __import__("pytest").importorskip("duckdb")
    c = duckdb.connect()
    for t in ("blocks", "spans", "doc_pages", "documents", "tasks", "middle_json"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    for name in ("p1_found", "q_md_escape", "q_route", "q_span_owner", "q_table_shape", "q_text_continuations"):
        df = entry.queries()[name](spark, "/root/testdata/sf0.001")
        r = c.sql(entry.oracle_sql()[name])
        names = sorted(r.columns)
        assert sorted(df.columns) == names
        assert sorted(map(repr, (tuple(x[n] for n in names) for x in df.collect()))) == sorted(map(repr, (tuple(x[r.columns.index(n)] for n in names) for x in r.fetchall()))), name
