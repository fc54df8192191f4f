"""Targets and draws of the mixing operator on sources that tie, repeat and lack names or ids."""

import duckdb
import pytest

from clientele.llm import mixing
from clientele.llm.common import table


def filled(sizes, limit=3):
    """Targets by filling: all open sources rise at their weights until the words are used up or they are full."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), dict.fromkeys(names, 0.0)
    while open_ and left > 1e-9:
        step = min(left / sum(weight[s] for s in open_), min((limit * sizes[s] - target[s]) / weight[s] for s in open_))
        for s in open_:
            target[s] += step * weight[s]
        left -= step * sum(weight[s] for s in open_)
        open_ = {s for s in open_ if target[s] < limit * sizes[s] - 1e-9}
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 900, "b": 1800}, {c: 1000 for c in "abcdef"}, {"a": 5}, {"a": 10, None: 10}, {"a": 1, "b": 1, "c": 1000},
    {"a": 300, "b": 600, "c": 900, "d": 300, None: 40}, {"a": 0, "b": 7}, {"a": 0}])
def test_targets_equal_filling(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    want = filled(sizes)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)
    docs = [(i, "w " * sizes[s], s) for i, s in enumerate(sizes)]  # noqa: F841  (read by the SQL)
    table = duckdb.connect()
    table.execute("create table documents(doc_id bigint, text varchar, source varchar)")
    table.executemany("insert into documents values (?, ?, ?)", docs)
    by_sql = dict(table.execute(f"select source, target from ({mixing.oracle()})").fetchall())
    assert all(by_sql[s] == pytest.approx(want[s]) for s in want)


def test_mixed_documents_keep_columns_of_any_name(spark):
    rows = [(i, "w " * (5 + i), "ab"[i % 2], i, i, i) for i in range(12)] + [(50, None, None, 1, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _n int, copy int, _d int")
    got = mixing.mixed_documents(docs)
    taken = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    assert got.columns == docs.columns
    counts = {}
    for r in got.collect():
        assert (r._n, r.copy, r._d) == (r.doc_id,) * 3
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {d: n for d, n in taken.items() if n}


def test_rows_without_ids_and_equal_rows_meet_the_target(spark):
    texts = [(None, "w " * (1 + i % 9) + str(i), "a") for i in range(300)] + [(None, "same text", "a")] * 40
    texts += [(7, "one two three", "b")] * 25 + [(i, None, "b") for i in range(5)] + [(100 + i, "w " * (i % 5), None) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    want = {s: (t, n) for s, t, n in ((r.source, r.target, r.n) for r in mixing.mix(docs).groupBy("source", "target").agg(
        {"taken": "sum"}).withColumnRenamed("sum(taken)", "n").collect())}
    out = mixing.mixed_documents(docs)
    got = {r.source: r.n for r in out.select("source", mixing.words(out.text).alias("n")).groupBy("source").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert got == {s: n for s, (_, n) in want.items()}
    assert all(abs(t - n) <= 10 for t, n in want.values())


def test_longer_documents_are_likelier_and_the_draw_equals_the_sql(spark):
    rows = [(i, "w " * (20 if i % 2 else 2000), "ab"[i % 4 < 2]) for i in range(3000)] + [(None, "w " * i, "a") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    for source in "ab":
        mean = [sum(r.copies for r in got if r.source == source and (r.size > 1000) == long) / sum(
            r.source == source and (r.size > 1000) == long for r in got) for long in (False, True)]
        taken = [r for r in got if r.source == source]
        assert mean[1] > mean[0] + 0.05 and abs(sum(r.taken for r in taken) - taken[0].target) <= 2000
    documents = docs.toPandas()  # noqa: F841  (read by the SQL)
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    by_sql = duckdb.sql(mixing.oracle()).fetchall()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(by_sql, key=key) == sorted((tuple(r)[:6] for r in got), key=key)


def test_whole_table_equals_the_sql(spark):
    folder = "/root/testdata/sf0.01"
    got = [tuple(r)[:6] for r in mixing.mix(table(spark, folder, "documents")).collect()]
    assert sorted(got) == sorted(duckdb.sql(mixing.oracle(f"'{folder}/documents.parquet'")).fetchall())
