"""What is read and moved once, so that it grows no faster than the tables."""

import datetime
import glob
from dataclasses import replace

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from clientele.checks import cohorts as cohort_checks
from clientele.checks import messages as message_checks
from clientele.operators import explore as ex
from clientele.operators import features as fe
from clientele.operators import prepare as pr
from clientele.operators.base import order_facts
from clientele.plans.exploration_plan import exploration_report
from clientele.session import scratch_folder, truncate
from clientele.sources.tables import derive_retail

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_of_reviews_are_moved_once(spark):
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(ex.text_lengths(derive_retail(spark, SF).order_reviews))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    assert sum("FileScan" in line and "text" in line for line in plan.splitlines()) == 1


def test_described_rows_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    rows = ex.describe(spark.range(400).mapInPandas(counted, "id long"), ["id"]).collect()
    assert {r.stat: r.value for r in rows}["50%"] == 199.5
    assert seen.value == 400


def test_reviews_of_repeated_and_missing_numbers(spark, tmp_path):
    for name in ("customer", "lineitem", "part", "supplier"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(5).write.parquet(f"{tmp_path}/{name}.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet").limit(1).drop("o_orderkey", "o_orderstatus", "o_orderpriority")
    keys = [(1, "F", "2-HIGH"), (1, "P", "5-LOW"), (2, "P", "5-LOW"), (2, "P", "5-LOW"), (3, "O", "5-LOW"), (4, None, "5-LOW")]
    orders.crossJoin(spark.createDataFrame(keys, "o_orderkey long, o_orderstatus string, o_orderpriority string")).write.parquet(
        f"{tmp_path}/orders.parquet")
    texts = [(1, "a"), (1, "b"), (2, "c"), (4, "d"), (9, "e"), (None, "f"), (3, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = derive_retail(spark, str(tmp_path)).order_reviews.collect()
    got = sorted(((r.review_id, r.order_id, r.review_comment_message) for r in rows), key=repr)
    assert got == sorted([(2, 1, "a"), (2, 1, "b"), (3, 1, "a"), (3, 1, "b"), (-3, 2, "c"), (-3, 2, "c"), (-5, 4, "d"), (-10, None, "e"),
                          (None, None, "f"), (6, 3, None)], key=repr)


def test_lines_are_moved_once_for_both_groupings(spark):
    t = derive_retail(spark, SF)
    plan = plan_of(fe.category_counts(t, order_facts(t)))
    assert plan.count("hashpartitioning(customer_unique_id") == 1


def test_encoding_is_a_table_of_known_size(spark):
    df = spark.createDataFrame([(i, f"c{i % 3}") for i in range(9)], "id long, state string")
    plan = plan_of(pr.fit_encoding(df, ["state"]))
    assert "FileScan parquet" in plan and "Exchange" not in plan


def test_stream_reads_more_files_than_batches(spark):
    message_checks._stream(spark, SF)
    folder = sorted(glob.glob(f"{scratch_folder(spark)}/stream-*/in"))[-1]
    assert len(glob.glob(f"{folder}/*.parquet")) > 2


def test_answers_score_the_customers_once(spark, monkeypatch):
    calls, real = [], cohort_checks.clustered
    for module in (cohort_checks, message_checks):
        monkeypatch.setattr(module, "clustered", lambda t: calls.append(1) or real(t))
    message_checks._answers(spark, SF)
    assert len(calls) == 1


def test_lengths_of_reviews_are_moved_and_not_their_texts(spark):
    facts = order_facts(derive_retail(spark, SF)).select("text_length", "n_texts")
    plan = facts._jdf.queryExecution().optimizedPlan().toString().splitlines()
    using = [line for line in plan if "text#" in line and "Relation" not in line]
    assert len(using) == 1 and "length(text#" in using[0]


def test_lengths_follow_the_reviews_in_use(spark):
    t = derive_retail(spark, SF)
    short = replace(t, order_reviews=t.order_reviews.withColumn("review_comment_message", F.lit("abc")))
    assert {r.n for r in short.reviews_with(F.length, "n").select("n").distinct().collect()} == {3}
    joined = t.reviews_with(F.length, "n")
    stored = replace(t, joined_reviews=None).reviews_with(F.length, "n").select(joined.columns)
    assert joined.exceptAll(stored).isEmpty() and stored.exceptAll(joined).isEmpty()


def test_lines_meet_their_products_last(spark):
    t = derive_retail(spark, SF)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = truncate(order_facts(t))
        plan = plan_of(fe.category_counts(t, facts))
        moved = [line for line in plan.splitlines() if "hashpartitioning(order_id" in line]
        assert len(moved) == 2 and plan.index("hashpartitioning(product_id") < plan.index("hashpartitioning(order_id")
        assert plan_of(fe.payment_features(t, facts)).count("Exchange hashpartitioning(order_id") == 0
        gaps = plan_of(fe.purchase_gaps(facts))
        assert gaps.count("Exchange hashpartitioning") == 2 and "_to_date" not in gaps.split("Exchange hashpartitioning")[1].split("\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_counts_of_sellers_do_not_grow_with_the_tasks(spark):
    rows = [(1, i % 40) for i in range(400)] + [(2, None), (3, 7)]
    lines = spark.createDataFrame(rows, "customer_unique_id long, seller_id long")
    got = {r.customer_unique_id: r.distinct_sellers for r in fe.seller_features(None, None, lines).collect()}
    assert got == {1: 40, 2: 0, 3: 1}
    plan = plan_of(fe.seller_features(None, None, lines))
    assert plan.count("hashpartitioning(customer_unique_id") == 2 and "L, pmod(xxhash64(seller_id" in plan


def test_gaps_across_years(spark):
    days = {1: ["2019-12-30 10:00", "2019-12-31 09:00", "2020-01-01 23:00", "2022-03-01 01:00", "2022-03-01 05:00"], 2: ["2020-05-05 00:00"], 3: [None]}
    rows = [(c, None if d is None else datetime.datetime.fromisoformat(d), 2) for c, ds in days.items() for d in ds]
    facts = spark.createDataFrame(rows, "customer_unique_id long, order_purchase_timestamp timestamp, w_visit long")
    got = {r.customer_unique_id: r.avg_inter_purchase_days for r in fe.purchase_gaps(facts).collect()}
    # 23 hours, 1.6 days, 789 days and 2 hours, and 4 hours; each order counts twice
    assert got == {1: (0 + 1 + 789 + 0) / 9, 2: 0.0}


def test_stored_tables_are_compressed_well(spark):
    stored = truncate(spark.range(1000).withColumn("text", F.lit("ab")))
    kinds = {pq.ParquetFile(name.removeprefix("file:")).metadata.row_group(0).column(0).compression for name in stored.inputFiles()}
    assert kinds == {"ZSTD"}
    assert stored.agg(F.sum("id"), F.max("text")).first() == (499500, "ab")


def test_reviews_are_moved_and_not_their_sums(spark):
    plan = plan_of(order_facts(derive_retail(spark, SF)).select("score_sq", "text_length")).splitlines()
    sums = [i for i, line in enumerate(plan) if "HashAggregate" in line and "sum((review_score" in line]
    assert len(sums) == 2 and not any("Exchange" in line for line in plan[sums[0]:sums[1]])


def test_sums_of_reviews_with_missing_and_repeated_orders(spark):
    t = derive_retail(spark, SF)
    order = t.orders.join(t.order_items, "order_id", "left_semi").join(t.customers, "customer_id", "left_semi").agg(F.min("order_id")).first()[0]
    rows = [(1, order, 5, "abc"), (2, order, 2, None), (3, order, None, ""), (3, order, None, ""), (4, None, 1, "x"), (5, None, 1, None)]
    reviews = spark.createDataFrame(rows, "review_id long, order_id long, review_score int, review_comment_message string")
    names = ["n_reviews", "n_scores", "score_sum", "score_sq", "n_positive", "n_negative", "n_texts", "text_length"]
    facts = order_facts(replace(t, order_reviews=reviews))
    assert {tuple(r) for r in facts.filter(F.col("order_id") == order).select(names).collect()} == {(4, 2, 7, 29, 1, 1, 3, 3)}
    assert facts.filter((F.col("order_id") != order) & F.col("n_reviews").isNotNull()).isEmpty()


def moved_columns(df, key):
    """The columns below the exchange on ``key``, in the order in which they are moved."""
    lines = plan_of(df).splitlines()
    below = next(lines[i + 1] for i, line in enumerate(lines) if f"Exchange hashpartitioning({key}" in line)
    return [c.split("#")[0].split(" AS ")[-1].strip() for c in below.split("Project [")[1].rsplit("]", 1)[0].split(", ") if "#" in c]


def test_facts_are_moved_with_alike_columns_side_by_side(spark):
    t = derive_retail(spark, SF)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = order_facts(t)
        moved = moved_columns(facts.select("order_id", *[c for c in facts.columns if c.startswith(("n_", "w_", "p", "cents"))]), "customer_id")
        assert moved[:3] == ["paid_by", "paid_in", "n_payments"] and moved[-5:] == ["order_id", "customer_id", "price_max", "price_sum", "cents_sq"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_facts_keep_columns_of_any_name(spark):
    t = derive_retail(spark, SF)
    plain = order_facts(t)
    odd = order_facts(replace(t, orders=t.orders.withColumn("a.b", F.lit(1)).withColumn("c`d", F.lit(2))))
    assert [c for c in odd.columns if c not in ("a.b", "c`d")] == plain.columns
    assert odd.count() == plain.count() > 0 and odd.select(F.sum("`a.b`"), F.sum("`c``d`")).first() == (plain.count(), 2 * plain.count())


def test_lines_are_moved_with_their_key_last(spark):
    t = derive_retail(spark, SF)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = truncate(fe.customer_lines(t, truncate(order_facts(t))))
        counts = moved_columns(fe.category_counts(t, None, lines), fe.CUSTOMER)
        assert counts == ["category_english", "product_photos_qty", "product_weight_g", "product_id", "w_item", fe.CUSTOMER]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_the_report_reads_tables_whose_reviews_are_joined(spark, tmp_path):
    day = datetime.datetime(2020, 1, 5)
    tables = {
        "customer": ([(1, 3), (2, 3), (3, 4)], "c_custkey long, c_nationkey int"),
        "orders": ([(k, 1 + k % 3, "FO"[k % 2], "1-URGENT", 10.0 * k, day + datetime.timedelta(days=k)) for k in range(1, 13)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_totalprice double, o_orderdate timestamp"),
        "lineitem": ([(k, 1, k % 2 + 1, 1, day, 5.0 * k, 2.0) for k in range(1, 13)],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp, l_extendedprice double, l_quantity double"),
        "part": ([(1, "ECONOMY", "a", 4), (2, "PROMO", "b", 7)], "p_partkey long, p_type string, p_name string, p_size int"),
        "supplier": ([(1, 3)], "s_suppkey long, s_nationkey int"),
        "documents": ([(1, "good"), (2, "bad"), (40, "lost")], "doc_id long, text string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    t = derive_retail(spark, str(tmp_path))
    assert t.joined_reviews is not None
    got = {r.table: (r.rows, r.missing_cells) for r in exploration_report(t, on_tied_edges="rank")["table_profile"].collect()}
    assert got == {"customers": (3, 0), "orders": (12, 6), "order_items": (12, 0), "products": (2, 0), "product_category_translation": (2, 0),
                   "order_payments": (18, 0), "order_reviews": (13, 12), "sellers": (1, 0)}
