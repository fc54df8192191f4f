import pytest
from pyspark.sql import functions as F

from clientele.operators import conversation as cv
from clientele.operators import intent as it
from clientele.operators import lookups as lk

REQUESTS = [
    ("Show me top 3 segments", 2, 0, 0, 1, "strategic", "rfm_segment", 0.6667, 3, None, None),
    ("Tell me more about the first one", 0, 0, 0, 0, "strategic", "rfm_segment", 0.5, None, None, None),
    ("Compare Champions and At Risk", 0, 0, 1, 1, "anomaly", "both", 0.5, None, None, None),
    ("high-value customers acting weirdly", 0, 0, 2, 1, "anomaly", "both", 0.75, None, None, None),
    ("find electronics buyers for campaign", 0, 3, 0, 0, "targeting", "hdbscan_cluster", 0.9, None, "electronics", None),
    ("Which campaign audience in SP", 0, 2, 0, 0, "targeting", "hdbscan_cluster", 0.6667, None, None, "SP"),
    ("Why is revenue dropping", 1, 0, 2, 0, "anomaly", "both", 0.5, None, None, None),
    ("Who buys technology in rj", 0, 2, 0, 0, "targeting", "hdbscan_cluster", 0.6667, None, "tech", "RJ"),
]


def test_requests(spark):
    df = it.analyse(spark.createDataFrame([(r[0],) for r in REQUESTS], "text string"))
    got = {r.text: r for r in df.collect()}
    for text, *want in REQUESTS:
        r = got[text]
        assert [*r.scores, r.analysis.intent, r.analysis.column_selection, round(r.analysis.confidence, 4), *r.params] == want


@pytest.mark.parametrize("text,discussed,tool,segment,names", [
    ("Tell me more about the first one", ["Champions", "Loyal"], "get_segment_details", "Champions", None),
    ("the second", ["Champions", "Loyal"], "get_segment_details", "Loyal", None),
    ("the third", ["Champions", "Loyal"], None, None, None),
    ("Compare Champions and At Risk", [], "compare_segments", None, ["Champions", "At Risk"]),
    ("What should we prioritize?", ["Champions"], "smart_customer_query", None, None),
])
def test_resolver(spark, text, discussed, tool, segment, names):
    df = spark.createDataFrame([(text, discussed)], "t string, d array<string>")
    r = df.select(it.resolve(F.col("t"), F.col("d")).alias("r")).first().r
    assert (r.tool, r.segment, r.segment_names) == (tool, segment, names)


def test_mentions_keep_accents_and_phrases(spark):
    df = spark.createDataFrame([("Champions! são Lost, at risk; recently",)], "t string")
    assert df.select(it.cohort_mentions(F.col("t")).alias("c")).first().c == ["Champions", "At Risk", "Lost"]


def test_lookup_prefers_priority(spark):
    rows = [("Potential Loyalists", 8, 10.0), ("Loyal Customers", 9, 30.0)]
    book = spark.createDataFrame(rows, "cohort_name string, priority int, avg_customer_value double")
    for c in ("customer_count long", "percentage double", "marketing_goal string", "description string",
              "budget_allocation string", "actions array<string>", "kpis array<string>"):
        name, kind = c.split()
        book = book.withColumn(name, F.lit(None).cast(kind))
    segments = lk.segment_array(lk.segment_list(book))
    asked = spark.createDataFrame([(["loyal", "potential", "none"],), ([],)], "segment_names array<string>")
    got = lk.compare_segments(asked, segments).collect()
    assert [s.rfm_segment for s in got[0].segments] == ["Loyal Customers", "Potential Loyalists"]
    assert got[0].insights == ["Loyal Customers has 3.0x higher average spend", "Loyal Customers has higher marketing priority"]
    assert got[1].error == "No segments provided for comparison"


def test_context_ignores_order_and_repeats(spark):
    rows = [(1, 0, "user", "About Lost"), (1, 1, "assistant", "Lost or Champions"), (1, 2, "user", "the first one"), (2, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {r.conv_id: r for r in cv.running_context(df).collect()}
    assert want[1].segments_discussed == ["Lost", "Champions"] and want[2].segments_discussed == []
    again = cv.running_context(df.union(df).repartition(5, "turn")).collect()
    assert {r.conv_id: r for r in again} == want
    before = {(r.conv_id, r.turn): r.discussed for r in cv.with_context_before(df).collect()}
    assert before[(1, 0)] == [] and before[(1, 1)] == ["Lost"] and before[(1, 2)] == ["Lost", "Champions"]


def test_every_tool_request_is_answered(spark):
    book = spark.createDataFrame(
        [("Champions", 10, 90.0, 3), ("Lost", 2, 10.0, 7)], "cohort_name string, priority int, avg_customer_value double, customer_count long")
    for c, kind in {"percentage": "double", "marketing_goal": "string", "description": "string", "budget_allocation": "string",
                    "actions": "array<string>", "kpis": "array<string>"}.items():
        book = book.withColumn(c, F.lit(None).cast(kind))
    clusters = spark.createDataFrame([(1, 5, "Lost", "Tech-focused messaging", 9.0), (2, 6, "Lost", "Tech-focused messaging", 8.0)],
                                     "cluster_id int, size long, primary_cohort string, personalization_hint string, avg_monetary double")
    anomalies = spark.createDataFrame([(1,), (2,), (3,)], "customer_unique_id long")
    rows = [("a", None, None, None, None, None), ("b", "nonsense", None, None, None, None), ("c", "find_behavioral_cluster", None, None, " ", None),
            ("d", "find_behavioral_cluster", None, None, "tech", None), ("e", "get_segment_details", None, "nobody", None, None),
            ("f", "get_segment_details", None, None, None, None), ("g", "compare_segments", None, None, None, ["Champions", "Lost"]),
            ("h", "compare_segments", None, None, None, None), ("i", "detect_customer_anomalies", None, None, None, None),
            ("j", "smart_customer_query", "top 1 segments", None, None, None)]
    requests = spark.createDataFrame(
        rows, "request_id string, tool string, query string, segment_name string, category string, segment_names array<string>")
    done = lk.dispatch(requests, lk.segment_array(lk.segment_list(book)), clusters, anomalies).collect()
    got = {r.request_id: r for r in done}
    assert len(done) == len(rows) and all(got[r[0]].result != "{}" for r in rows)
    assert [got[k].error for k in "abe"] == ["Unknown tool: ", "Unknown tool: nonsense", "Segment 'nobody' not found"]
    assert got["c"].error.startswith("Missing parameter") and got["h"].error == "No segments provided for comparison"
    assert got["d"].total_clusters == 2 and got["i"].total_anomalies == 3 and len(got["i"].recommended_actions) == 3
    assert got["f"].segment.rfm_segment == "Champions" and len(got["g"].segments) == 2 and got["h"].type is None
    assert [s.rfm_segment for s in got["j"].segments] == ["Champions"] and got["j"].total_segments == 1
    matched = lk.category_clusters(clusters, lk.known_categories(spark)).collect()
    assert {(r.category, r.cluster_id) for r in matched} == {("tech", 1), ("tech", 2)}


def test_stored_upsert_replaces_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "memory")
    rows = spark.createDataFrame([(i, f"old {i}", 1) for i in range(40)], "user_id long, summary string, updated_at int")
    cv.upsert_table(spark, path, rows, ["user_id"], "updated_at", buckets=16)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "memory").rglob("*.parquet")}
    changes = spark.createDataFrame([(3, "new 3", 2), (3, "newest 3", 3), (99, "new 99", 1), (4, "stale", 0)], rows.schema)
    for _ in range(2):  # the same changes again change nothing
        cv.upsert_table(spark, path, changes, ["user_id"], "updated_at", buckets=16)
        got = {r.user_id: r.summary for r in cv.read_table(spark, path).collect()}
        assert got == {i: f"old {i}" for i in range(40)} | {3: "newest 3", 99: "new 99"}
    kept = {f for f in (tmp_path / "memory").rglob("*.parquet") if before.get(f) == f.stat().st_mtime_ns}
    assert len({f.parent for f in kept}) >= len({f.parent for f in before}) - 3
    touched = {f.parent for f in before} - {f.parent for f in kept}
    assert 1 <= len(touched) <= 3


def test_stream_forgets_idle_conversations(spark, tmp_path):
    from clientele.streaming import context as cx

    says = [[(1, 0, "user", "Show me Champions please"), (1, 1, "assistant", "Champions and Lost are here"), (2, 0, "user", "at risk of what?")],
            [(3, 0, "user", "hello")],
            [(1, 2, "user", "now compare Champions with Hibernating"), (1, 1, "assistant", "Champions and Lost are here")]]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    held = []
    for rows in says:  # each run starts more than the idle time after the one before
        spark.createDataFrame(rows, cx.MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = cx.start_context_stream(cx.message_stream(spark, folder), out, str(tmp_path / "checkpoint"), idle_seconds=0.2, buckets=4)
        assert stream.awaitTermination(120)
        held.append([p.stateOperators[0].numRowsTotal for p in stream.recentProgress if p.stateOperators])
    assert held[0][0] == 2 and held[1][-1] == 1  # when the third conversation came, the first two left
    want = cv.running_context(spark.createDataFrame([r for rows in says for r in rows], cx.MESSAGE_SCHEMA))
    key = lambda df: {r.conv_id: tuple(r) for r in df.collect()}
    assert key(cx.latest_context(spark, out)) == key(want)
