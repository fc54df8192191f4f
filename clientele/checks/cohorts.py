"""Checks of profiles, hints, playbook and look-ups.

The SQL side cannot cluster, so these queries give both sides the same
stand-in for the cluster column; the clustering itself has its own queries.
"""

from pyspark.sql import functions as F


from clientele.checks.registry import query, retail, rounded
from clientele.checks.segments import ATTRIBUTE_ROWS, ATTRIBUTES, SEGMENTED, segmented
from clientele.operators import cohorts as co
from clientele.operators import lookups as lk
from clientele.operators import segments as sg
from clientele.operators.base import order_facts
from clientele.operators.features import CUSTOMER, basket_features, geographic_features
from clientele.operators.density import DensityClustering
from clientele.session import truncate
from clientele.sources import results as res
from clientele.sources.tables import read_sample

CLUSTERED = SEGMENTED + """,
clustered AS (SELECT *, CAST(customer_unique_id % 7 - 1 AS BIGINT) AS cluster FROM segmented)"""


def clustered(t):
    return segmented(t).withColumn("cluster", (F.col(CUSTOMER) % 7 - 1).cast("int")).withColumn(
        "cluster_probability", F.lit(1.0))


def playbook_of(t, customers=None):
    """The playbook of the clustered customers, who may be given as a stored table."""
    document = res.playbook(co.cohort_profiles(clustered(t) if customers is None else customers), "2024-01-01T00:00:00")
    return truncate(res.playbook_rows(document))


COHORTS = CLUSTERED + """,
profiles AS (SELECT cohort_id, cohort_name, priority, count(*) AS customer_count,
  round(count(*) * 100.0 / (SELECT count(*) FROM clustered), 2) AS percentage, round(avg(recency), 1) AS avg_recency,
  round(avg(frequency), 2) AS avg_frequency, round(CAST(sum(monetary) AS DOUBLE) / count(*), 2) AS avg_monetary,
  round(CAST(sum(monetary) AS DOUBLE), 2) AS total_revenue,
  coalesce(string_agg(DISTINCT CAST(cluster AS VARCHAR), ',' ORDER BY CAST(cluster AS VARCHAR)) FILTER (WHERE cluster <> -1), '') AS cluster_ids,
  count(*) FILTER (WHERE cluster = -1) AS includes_noise_points FROM clustered GROUP BY 1, 2, 3)"""


@retail("g07_cohort_profiles", f"WITH {COHORTS} SELECT * FROM profiles")
def _cohorts(t):
    df = co.cohort_profiles(clustered(t)).drop("description", "marketing_goal", "recommended_actions", "kpis", "budget_allocation")
    return rounded(df.withColumn("cluster_ids", F.array_join("cluster_ids", ",")))


@retail("g07_cohort_clusters", f"""WITH {CLUSTERED} SELECT cohort_id, cohort_name, cluster, count(*) AS customers,
  round(count(*) * 100.0 / any_value(n), 2) AS share FROM clustered JOIN (SELECT cohort_name, count(*) AS n FROM clustered GROUP BY 1) a USING (cohort_name)
  WHERE cluster <> -1 GROUP BY 1, 2, 3""")
def _cohort_clusters(t):
    return rounded(co.cohort_clusters(clustered(t)))


_CLUSTERS = CLUSTERED + """,
means AS (SELECT cluster AS cluster_id, count(*) AS size, round(avg(recency), 1) AS avg_recency, round(avg(frequency), 2) AS avg_frequency,
  round(CAST(sum(monetary) AS DOUBLE) / count(*), 2) AS avg_monetary, round(avg(RFM_total), 2) AS avg_rfm_total
  FROM clustered WHERE cluster <> -1 GROUP BY 1),
mix AS (SELECT cluster AS cluster_id, cohort_name, count(*) AS n FROM clustered WHERE cluster <> -1 GROUP BY 1, 2),
main AS (SELECT cluster_id, cohort_name AS primary_cohort FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, cohort_name) AS k FROM mix) x WHERE k = 1)"""


@retail("g08_cluster_profiles", f"WITH {_CLUSTERS} SELECT * FROM means JOIN main USING (cluster_id)")
def _clusters(t):
    return rounded(co.cluster_profiles(clustered(t)).drop("cohort_distribution", "personalization_hint"))


@retail("g08_cohort_distribution", f"WITH {_CLUSTERS} SELECT cluster_id, cohort_name, n AS count FROM mix")
def _mix(t):
    df = co.cluster_profiles(clustered(t))
    return rounded(df.select("cluster_id", F.explode("cohort_distribution").alias("cohort_name", "count")))


_TOPS = CLUSTERED + """,
fav AS (SELECT u.customer_unique_id, coalesce(m.v, 'unknown') AS favorite_category FROM (SELECT DISTINCT customer_unique_id FROM base) u LEFT JOIN (
  SELECT customer_unique_id, v, row_number() OVER (PARTITION BY customer_unique_id ORDER BY n DESC, v) AS k FROM (
    SELECT customer_unique_id, category_english AS v, count(*) AS n FROM base WHERE category_english IS NOT NULL GROUP BY 1, 2) x) m
  ON u.customer_unique_id = m.customer_unique_id AND m.k = 1),
places AS (SELECT customer_unique_id, customer_state AS state FROM (SELECT *, row_number() OVER (
  PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, order_id) AS k FROM base) x WHERE k = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY cluster, kind ORDER BY count DESC, value) AS place FROM (
  SELECT cluster, 'category' AS kind, favorite_category AS value, count(*) AS count FROM clustered JOIN fav USING (customer_unique_id) WHERE cluster <> -1 GROUP BY 1, 2, 3
  UNION ALL SELECT cluster, 'state', state, count(*) FROM clustered JOIN places USING (customer_unique_id) WHERE cluster <> -1 GROUP BY 1, 2, 3) c)"""


def _with_places(t, customers=None):
    """Stored, because a profile reads its members several times."""
    facts, customers = order_facts(t), clustered(t) if customers is None else customers
    return truncate(customers.join(basket_features(t, facts).select(CUSTOMER, "favorite_category"), CUSTOMER).join(
        geographic_features(facts).select(CUSTOMER, "state"), CUSTOMER))


@retail("g09_top_values", f"WITH {_TOPS} SELECT cluster AS cluster_id, kind, value, count FROM ranked WHERE place <= 3")
def _tops(t):
    df = co.cluster_profiles(_with_places(t), "favorite_category", "state")
    return df.select("cluster_id", F.lit("category").alias("kind"), F.explode("top_categories").alias("value", "count")).unionByName(
        df.select("cluster_id", F.lit("state").alias("kind"), F.explode("top_states").alias("value", "count"))).withColumn(
            "cluster_id", F.col("cluster_id").cast("long"))


_HINT = """concat_ws('; ', CASE WHEN value IN ('electronics','computers') THEN 'Tech-focused messaging, feature comparisons'
  WHEN value IN ('fashion','clothing') THEN 'Style guides, trend updates, lookbooks' WHEN value IN ('home','furniture') THEN 'Home improvement tips, room inspiration'
  WHEN value IN ('beauty','health') THEN 'Tutorial content, routine builders' END,
  CASE WHEN avg_monetary > 500 THEN 'Premium product recommendations' WHEN avg_monetary < 100 THEN 'Value bundles, budget-friendly options' END,
  CASE WHEN avg_frequency > 3 THEN 'Subscription/auto-replenish offers' WHEN avg_frequency = 1 THEN 'Discovery content, category expansion' END)"""
HINTED = _TOPS + ", means AS " + _CLUSTERS.split("means AS ", 1)[1] + f""",
hinted AS (SELECT m.cluster_id, m.size, n.primary_cohort, m.avg_monetary, {_HINT} AS personalization_hint FROM means m
  JOIN ranked r ON r.cluster = m.cluster_id AND r.kind = 'category' AND r.place = 1 JOIN main n ON n.cluster_id = m.cluster_id)"""


def hinted(t, customers=None):
    return truncate(co.cluster_profiles(_with_places(t, customers), "favorite_category"))


@retail("g10_personalization_hint", f"WITH {HINTED} SELECT cluster_id, personalization_hint FROM hinted")
def _hint(t):
    return rounded(hinted(t).select("cluster_id", "personalization_hint"))


@retail("g11_customer_output", f"""WITH {CLUSTERED} SELECT customer_unique_id, cluster, cohort_id, cohort_name, priority,
  1.0 AS cluster_probability, recency, frequency, round(CAST(monetary AS DOUBLE), 2) AS monetary, R_score, F_score, M_score, RFM_score, RFM_total FROM clustered""")
def _output(t):
    return rounded(co.customer_output(clustered(t)))


@retail("g12_playbook", f"""WITH {COHORTS} SELECT cohort_name, customer_count, percentage, priority, avg_monetary AS avg_customer_value FROM profiles""")
def _playbook(t):
    return rounded(playbook_of(t).select("cohort_name", "customer_count", "percentage", "priority", "avg_customer_value"))


@retail("s24_playbook_document")
def _document(t):
    document = res.playbook(co.cohort_profiles(clustered(t)), "2024-01-01T00:00:00")
    return document.select(F.to_json(F.struct("*")).alias("document"))


@retail("s24_playbook_segments", f"""WITH {COHORTS}, a({ATTRIBUTES}) AS (VALUES {ATTRIBUTE_ROWS})
SELECT cohort_name, customer_count, percentage, description, marketing_goal, priority, budget_allocation, actions, kpis,
  avg_monetary AS avg_customer_value FROM profiles JOIN (SELECT * EXCLUDE prio FROM a) b USING (cohort_name)""")
def _stored_playbook(t):
    """The document written as JSON and read again, with the texts of its lists."""
    import uuid

    from clientele.session import scratch_folder

    spark = t.orders.sparkSession
    path = f"{scratch_folder(spark)}/playbook-{uuid.uuid4().hex}"
    res.write_playbook(res.playbook(co.cohort_profiles(clustered(t)), "2024-01-01T00:00:00"), path)
    rows = res.read_playbook(spark, path)
    return rounded(rows.withColumns({c: F.array_join(c, " | ") for c in ("actions", "kpis")}))


@retail("g13_run_summary", f"""WITH {CLUSTERED} SELECT count(*) AS customers, count(DISTINCT cohort_name) AS segments,
  count(*) FILTER (WHERE cluster <> -1) AS clustered, count(DISTINCT cluster) FILTER (WHERE cluster <> -1) AS clusters,
  count(*) FILTER (WHERE cluster = -1) AS noise FROM clustered""")
def _summary(t):
    return co.run_summary(clustered(t))


_LIST = f"""WITH {COHORTS} SELECT cohort_name AS rfm_segment, customer_count, percentage, avg_monetary, priority FROM profiles
  ORDER BY priority DESC, cohort_id LIMIT """


def _listed(n):
    def run(t):
        return rounded(lk.segment_list(playbook_of(t), n).select("rfm_segment", "customer_count", "percentage", "avg_monetary", "priority"))
    return run


retail("n07_segment_list", _LIST + "5")(_listed(5))
retail("n07_segment_list_top_2", _LIST + "2")(_listed(2))
retail("n07_segment_list_top_4", _LIST + "4")(_listed(4))


# Requests: the first word of each segment name a customer belongs to.
_NAME = "lower(substr(cohort_name, 1, 4))"


@retail("n08_segment_details", f"""WITH {COHORTS}, wanted AS (SELECT customer_unique_id, CASE WHEN customer_unique_id % 9 = 0 THEN 'nobody' ELSE {_NAME} END AS segment_name FROM clustered),
names AS (SELECT DISTINCT segment_name FROM wanted),
hit AS (SELECT segment_name, cohort_name FROM (SELECT n.segment_name, p.cohort_name, row_number() OVER (PARTITION BY n.segment_name ORDER BY priority DESC, cohort_id) AS k
  FROM names n JOIN profiles p ON contains(lower(p.cohort_name), n.segment_name)) x WHERE k = 1)
SELECT customer_unique_id, w.segment_name, cohort_name AS rfm_segment, CASE WHEN cohort_name IS NULL THEN 'Segment ''' || w.segment_name || ''' not found' END AS error
FROM wanted w LEFT JOIN hit USING (segment_name)""")
def _details(t):
    df = clustered(t)
    name = F.when(F.col(CUSTOMER) % 9 == 0, "nobody").otherwise(F.lower(F.substring("cohort_name", 1, 4)))
    requests = truncate(df.select(CUSTOMER, name.alias("segment_name")))
    found = lk.segment_details(requests, lk.segment_array(lk.segment_list(playbook_of(t))))
    return found.select(CUSTOMER, "segment_name", F.col("segment.rfm_segment").alias("rfm_segment"), "error")


@retail("n09_clusters_by_hint", f"""WITH {HINTED} SELECT cluster_id, size, primary_cohort, personalization_hint, avg_monetary
  FROM hinted WHERE contains(lower(personalization_hint), 'tech')""")
def _by_hint(t):
    return rounded(co.clusters_by_hint(hinted(t), "Tech"))


@retail("n10_anomalies", f"""WITH {CLUSTERED} SELECT customer_unique_id, cohort_name AS rfm_segment, cluster AS hdbscan_cluster,
  round(CAST(monetary AS DOUBLE), 2) AS monetary FROM clustered WHERE cohort_name IN ('Champions', 'Loyal Customers', 'At Risk') AND cluster = -1""")
def _anomalies(t):
    return rounded(co.value_behaviour_anomalies(clustered(t)))


@retail("n11_comparison", f"""WITH {COHORTS}, pairs AS (SELECT a.cohort_name AS first, b.cohort_name AS second, a.avg_monetary AS v1, b.avg_monetary AS v2,
  a.priority AS p1, b.priority AS p2 FROM profiles a JOIN profiles b ON a.cohort_id < b.cohort_id)
SELECT first, second, concat_ws(' | ', CASE WHEN v1 > v2 AND v2 > 0 THEN first || ' has ' || printf('%.1f', v1 / v2) || 'x higher average spend' END,
  CASE WHEN p1 > p2 THEN first || ' has higher marketing priority' WHEN p2 > p1 THEN second || ' has higher marketing priority' END) AS insights FROM pairs""")
def _comparison(t):
    book = playbook_of(t)
    rows = sg.segment_dimension(book.sparkSession).join(book.select("cohort_name"), "cohort_name").select("cohort_id", "cohort_name")
    a = rows.select(F.col("cohort_id").alias("i"), F.col("cohort_name").alias("first"))
    b = rows.select(F.col("cohort_id").alias("j"), F.col("cohort_name").alias("second"))
    pairs = a.join(b, F.col("i") < F.col("j")).withColumn("segment_names", F.array("first", "second"))
    done = lk.compare_segments(pairs, lk.segment_array(lk.segment_list(book)))
    return done.select("first", "second", F.array_join("insights", " | ").alias("insights"))


@query("g05_density_clusters")
def _density(spark, sf_dir):
    points = read_sample(spark, sf_dir, "embeddings")
    model = DensityClustering(points, "vec_id", "embedding", max_min_samples=5)
    return rounded(model.labels(10, 5))


@query("g05_approximate_clusters")
def _approximate_density(spark, sf_dir):
    points = read_sample(spark, sf_dir, "embeddings")
    model = DensityClustering(points, "vec_id", "embedding", max_min_samples=5, probes=8)
    return rounded(model.labels(10, 5))


_KNN = 5


@query("g05_nearest_neighbours", f"""SELECT a, rank, round(dist, 5) AS dist FROM (
  SELECT x.vec_id AS a, list_distance(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])) AS dist,
    row_number() OVER (PARTITION BY x.vec_id ORDER BY list_distance(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[]))) AS rank
  FROM embeddings x JOIN embeddings y ON x.vec_id <> y.vec_id) d WHERE rank <= {_KNN}""")
def _knn(spark, sf_dir):
    from clientele.operators.neighbors import build_cells, distinct_vectors, nearest_neighbours
    points = read_sample(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    cells = build_cells(distinct_vectors(points))
    ids = points.join(cells.rows.select("nid", "vector"), "vector").select(F.col("vec_id").alias("a"), "nid")
    return rounded(nearest_neighbours(cells, _KNN).join(ids, "nid").select("a", "rank", "dist"), 5)


@query("g06_parameter_search")
def _search(spark, sf_dir):
    points = read_sample(spark, sf_dir, "embeddings")
    return rounded(DensityClustering(points, "vec_id", "embedding").search()[1])


@retail("g14_segmentation_run")
def _run(t):
    from clientele.plans.segmentation_plan import run_segmentation
    return rounded(run_segmentation(t, settings=[(10, 5), (20, 10)]).customers)


