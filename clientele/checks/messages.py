"""Checks of intent, entities and conversation context.

The sample's invented texts seldom name a segment, so every message gets one
of twelve requests in front, chosen by conversation and turn.
"""

from pyspark.sql import functions as F

from clientele.checks.cohorts import COHORTS, HINTED, clustered, hinted, playbook_of
from clientele.checks.registry import query, retail, rounded
from clientele.operators import cohorts as co
from clientele.operators import conversation as cv
from clientele.operators import intent as it
from clientele.operators import lookups as lk
from clientele.session import truncate
from clientele.sources.tables import derive_retail, read_sample

PHRASES = ["Show me top 3 segments", "Tell me more about the first one", "What should we prioritize?",
           "Compare Champions and At Risk", "Compare it with the Lost segment", "top priority segments with actions",
           "high-value customers acting weirdly", "find electronics buyers for campaign", "Which campaign audience in SP",
           "Why is revenue dropping", "Who buys technology in rj", "Are loyal or hibernating buyers on the second one?"]
_TEXT = ("concat(CASE (conv_id * 5 + turn * 7) % 12 "
         + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PHRASES)) + " END, ' ', text)")
MESSAGES = f"m AS (SELECT conv_id, turn, role, {_TEXT} AS text, lower({_TEXT}) AS low FROM conversations)"


def messages(spark, sf_dir):
    return read_sample(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "role", f"{_TEXT} AS text")


def _count(words):
    return "(" + " + ".join(f"CASE WHEN contains(low, '{w}') THEN 1 ELSE 0 END" for w in words) + ")"


SCORED = MESSAGES + f""",
s AS (SELECT *, {_count(it.STRATEGIC)} AS st, {_count(it.TARGETING)} AS ta, {_count(it.ANOMALY)} AS an, {_count(it.VALUE)} AS va,
  CAST(nullif(regexp_extract(low, 'top\\s*(\\d+)', 1), '') AS BIGINT) AS top_n,
  CASE {' '.join(f"WHEN contains(low, '{c}') THEN '{c}'" for c in it.CATEGORIES)} END AS category,
  CASE {' '.join(f"WHEN contains(' ' || low || ' ', ' {c} ') THEN '{c.upper()}'" for c in it.STATES)} END AS state FROM m),
a AS (SELECT *, CASE WHEN an > 0 AND va > 0 THEN 1 WHEN ta > 0 AND category IS NOT NULL THEN 2 WHEN an > 0 THEN 3 WHEN ta > st THEN 4 ELSE 5 END AS rule FROM s),
i AS (SELECT *, CASE WHEN rule IN (1, 3) THEN 'anomaly' WHEN rule IN (2, 4) THEN 'targeting' ELSE 'strategic' END AS intent,
  CASE WHEN rule IN (1, 3) THEN 'both' WHEN rule IN (2, 4) THEN 'hdbscan_cluster' ELSE 'rfm_segment' END AS column_selection,
  CASE rule WHEN 1 THEN least(0.9, (an + va) / 4.0) WHEN 2 THEN least(0.9, ta / 3.0) WHEN 3 THEN CAST(an AS DOUBLE) / (st + ta + an + 1)
    WHEN 4 THEN CAST(ta AS DOUBLE) / (st + ta + an + 1) ELSE greatest(0.5, CAST(st AS DOUBLE) / (st + ta + an + 1)) END AS confidence FROM a)"""


@query("n01_keyword_scores", f"WITH {SCORED} SELECT conv_id, turn, st AS strategic, ta AS targeting, an AS anomaly, va AS value FROM s")
def _scores(spark, sf_dir):
    df = it.analyse(messages(spark, sf_dir))
    return rounded(df.select("conv_id", "turn", "scores.*"))


@query("n02_intent", f"WITH {SCORED} SELECT conv_id, turn, intent, column_selection, round(confidence, 6) AS confidence FROM i")
def _intent(spark, sf_dir):
    return rounded(it.analyse(messages(spark, sf_dir)).select("conv_id", "turn", "analysis.*").drop("reasoning"))


@query("n03_parameters", f"WITH {SCORED} SELECT conv_id, turn, top_n, category, state FROM s")
def _params(spark, sf_dir):
    return rounded(it.analyse(messages(spark, sf_dir)).select("conv_id", "turn", "params.*"))


_WORDS = r"string_split(trim(regexp_replace(low, '[^\p{L}\p{M}\p{N}_]+', ' ', 'g')), ' ')"


def _names(words, title):
    tests = ", ".join(
        f"CASE WHEN {f'''contains(low, '{w}')''' if ' ' in w else f'''list_contains(w, '{w}')'''} THEN '{w.title() if title else w}' END" for w in words)
    return f"[{tests}]"  # nulls are skipped where the list is used


NAMED = MESSAGES + f""",
t AS (SELECT *, {_WORDS} AS w FROM m),
n AS (SELECT *, {_names(it.COHORTS, True)} AS cohorts, {_names(it.METRICS, False)} AS metrics FROM t)"""


@query("n05_segment_mentions", f"WITH {NAMED} SELECT conv_id, turn, coalesce(list_aggregate(cohorts, 'string_agg', ', '), '') AS cohorts FROM n")
def _mentions(spark, sf_dir):
    df = messages(spark, sf_dir)
    return df.select("conv_id", "turn", F.array_join(it.cohort_mentions(F.col("text")), ", ").alias("cohorts"))


@query("n06_metric_mentions", f"WITH {NAMED} SELECT conv_id, turn, coalesce(list_aggregate(metrics, 'string_agg', ', '), '') AS metrics FROM n")
def _metrics(spark, sf_dir):
    df = messages(spark, sf_dir)
    return df.select("conv_id", "turn", F.array_join(it.metric_mentions(F.col("text")), ", ").alias("metrics"))


_POS = "CASE name " + " ".join(f"WHEN '{k.title()}' THEN {i}" for i, k in enumerate(it.COHORTS)) + " END"
CONTEXT = NAMED + f""",
said AS (SELECT conv_id, name, min(turn) AS turn FROM (SELECT conv_id, turn, unnest(cohorts) AS name FROM n WHERE role IN ('user', 'assistant')) u WHERE name IS NOT NULL GROUP BY 1, 2),
placed AS (SELECT *, {_POS} AS pos FROM said)"""
_LISTS = "(SELECT conv_id, string_agg(name, ', ' ORDER BY turn, pos) AS names FROM placed GROUP BY 1)"


ORACLES_N14 = f"""WITH {CONTEXT}, {SCORED[SCORED.index('s AS ('):]}
SELECT c.conv_id, coalesce(l.names, '') AS segments_discussed, q.intent AS last_intent, q.column_selection AS last_data_source
FROM (SELECT DISTINCT conv_id FROM m WHERE role IN ('user', 'assistant')) c LEFT JOIN {_LISTS} l USING (conv_id)
LEFT JOIN (SELECT * FROM (SELECT conv_id, intent, column_selection, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM i WHERE role = 'user') z WHERE k = 1) q USING (conv_id)"""


@query("n14_running_context", ORACLES_N14)
def _context(spark, sf_dir):
    df = cv.running_context(messages(spark, sf_dir)).drop("mentions")
    return df.withColumn("segments_discussed", F.array_join("segments_discussed", ", "))


_BEFORE = CONTEXT + """,
before AS (SELECT m.conv_id, m.turn, m.low, coalesce(list(p.name ORDER BY p.turn, p.pos) FILTER (WHERE p.name IS NOT NULL), []) AS d
  FROM m LEFT JOIN placed p ON p.conv_id = m.conv_id AND p.turn < m.turn WHERE m.role = 'user' GROUP BY 1, 2, 3),
r AS (SELECT *, [""" + ", ".join(f"CASE WHEN contains(low, '{k}') THEN '{k.title()}' END" for k in it.COHORTS) + """] AS raw,
  (""" + " OR ".join(f"contains(low, '{k}')" for k in it.COMPARISON) + """) AS comparing,
  coalesce(""" + ", ".join(f"CASE WHEN contains(low, '{p}') THEN d[{i + 1}] END" for p, i in it.PRONOUNS) + """) AS referred,
  (""" + " OR ".join(f"contains(low, '{k}')" for k in it.PRIORITY) + """) AS prioritising FROM before),
z AS (SELECT *, list_aggregate(raw, 'count') AS n_named, list_aggregate(raw, 'string_agg', ', ') AS named FROM r)"""


@query("n13_resolved_requests", f"""WITH {_BEFORE} SELECT conv_id, turn,
  CASE WHEN comparing AND n_named >= 2 THEN 'compare_segments' WHEN referred IS NOT NULL THEN 'get_segment_details' WHEN prioritising THEN 'smart_customer_query' END AS tool,
  CASE WHEN comparing AND n_named >= 2 THEN NULL ELSE referred END AS segment,
  CASE WHEN comparing AND n_named >= 2 THEN named END AS segment_names FROM z""")
def _resolved(spark, sf_dir):
    df = cv.resolve_requests(messages(spark, sf_dir)).drop("query")
    return df.withColumn("segment_names", F.array_join("segment_names", ", "))


@query("n15_context_summary", f"""WITH {CONTEXT}, l AS (SELECT conv_id, list(name ORDER BY turn, pos) AS d FROM placed GROUP BY 1)
SELECT c.conv_id, CASE WHEN l.d IS NULL THEN 'General cohort discussion' ELSE 'Discussed: ' || array_to_string(l.d[1:3], ', ') END AS summary,
  CASE WHEN l.d IS NULL THEN '' ELSE chr(10) || '## Context' || chr(10) || 'Segments discussed: ' || array_to_string(l.d[greatest(len(l.d) - 4, 1):len(l.d)], ', ') END AS prompt
FROM (SELECT DISTINCT conv_id FROM m WHERE role IN ('user', 'assistant')) c LEFT JOIN l USING (conv_id)""")
def _prompt(spark, sf_dir):
    df = cv.running_context(messages(spark, sf_dir))
    none = F.array().cast("array<string>")
    return df.select("conv_id", cv.summary(F.col("segments_discussed")).alias("summary"),
                     cv.context_prompt(F.col("segments_discussed"), none, none).alias("prompt"))


@query("n16_saved_memories", f"""WITH {CONTEXT}, l AS (SELECT conv_id, list(name ORDER BY turn, pos) AS d FROM placed GROUP BY 1)
SELECT c.conv_id % 10 AS user_id, c.conv_id, CASE WHEN l.d IS NULL THEN 'General cohort discussion' ELSE 'Discussed: ' || array_to_string(l.d[1:3], ', ') END AS summary,
  c.updated_at FROM (SELECT conv_id, max(turn) AS updated_at, count(*) FILTER (WHERE role IN ('user', 'assistant')) AS n FROM m GROUP BY 1) c LEFT JOIN l USING (conv_id) WHERE c.n > 0""")
def _saved(spark, sf_dir):
    df = messages(spark, sf_dir)
    users = df.select("conv_id").distinct().withColumn("user_id", F.col("conv_id") % 10)
    return cv.memories(df, users).drop("key_facts")


@query("w05_last_messages", f"""WITH {MESSAGES} SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM m) x WHERE k <= 3""")
def _last(spark, sf_dir):
    return rounded(cv.last_messages(messages(spark, sf_dir), 3).drop("text"))


@query("w05_last_reply", f"""WITH {MESSAGES} SELECT conv_id, max(turn) AS turn FROM m WHERE role = 'assistant' GROUP BY 1""")
def _reply(spark, sf_dir):
    return cv.last_messages(messages(spark, sf_dir), 1, "assistant").select("conv_id", "turn")


@query("w06_last_memories", """SELECT user_id, conv_id, place FROM (SELECT conv_id % 10 AS user_id, conv_id, row_number() OVER (
  PARTITION BY conv_id % 10 ORDER BY max(turn) DESC, conv_id) AS place FROM conversations WHERE role IN ('user', 'assistant') GROUP BY conv_id) x WHERE place <= 5""")
def _memories(spark, sf_dir):
    df = messages(spark, sf_dir).filter(F.col("role").isin("user", "assistant"))
    users = df.select("conv_id").distinct().withColumn("user_id", F.col("conv_id") % 10)
    return rounded(cv.last_memories(cv.memories(df, users)).select("user_id", "conv_id", "place"))


@query("w13_known_conversations", "SELECT conv_id, turn FROM conversations WHERE conv_id IN (SELECT conv_id FROM conversations WHERE role = 'system')")
def _known(spark, sf_dir):
    df = messages(spark, sf_dir)
    return cv.known_conversations(df.select("conv_id", "turn"), df.filter(F.col("role") == "system"))


@query("s27_appended_messages", """SELECT conv_id, turn, role FROM conversations UNION ALL
  SELECT c.conv_id, m.last + 1 + c.turn, c.role FROM conversations c JOIN (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY 1) m USING (conv_id) WHERE c.role = 'user'""")
def _append(spark, sf_dir):
    df = read_sample(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return cv.append_messages(df, df.filter(F.col("role") == "user"))


@query("s28_upsert", """SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, count(*) > 0 AS known FROM events GROUP BY 1""".replace(", count(*) > 0 AS known", ""))
def _upsert(spark, sf_dir):
    df = read_sample(spark, sf_dir, "events").select("user_id", "event_type", F.struct("ts", "event_id").alias("version"))
    first = df.filter(F.col("event_type") == "click")
    return cv.upsert(first, df.filter(F.col("event_type") != "click"), ["user_id"], "version").select("user_id", "event_type")


@query("s28_stored_upsert", "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def _stored_upsert(spark, sf_dir):
    """The same in a stored table, whose buckets are replaced as changes come."""
    import uuid

    from clientele.session import scratch_folder

    path = f"{scratch_folder(spark)}/memory-{uuid.uuid4().hex}"
    df = read_sample(spark, sf_dir, "events").select("user_id", "event_type", F.struct("ts", "event_id").alias("version"))
    for part in (F.col("event_type") == "click", F.col("event_type") != "click"):
        cv.upsert_table(spark, path, df.filter(part), ["user_id"], "version", buckets=8)
    return cv.read_table(spark, path).select("user_id", "event_type")


_TOOLS = """CASE turn % 3 WHEN 0 THEN 'get_segment_details' WHEN 1 THEN 'compare_segments' ELSE 'other' END"""


@query("n12_completed_comparisons", f"""WITH q AS (SELECT conv_id, turn, {_TOOLS} AS tool, CASE WHEN turn % 3 = 0 THEN 'Segment ' || CAST((conv_id + turn) % 4 AS VARCHAR) END AS segment_name FROM conversations),
l AS (SELECT *, last_value(segment_name IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM q)
SELECT conv_id, turn, CASE WHEN tool = 'compare_segments' THEN CASE WHEN prev IS NOT NULL AND prev <> 'Segment 1' THEN prev || ',Segment 1' ELSE 'Segment 1' END END AS names FROM l""")
def _completed(spark, sf_dir):
    df = read_sample(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", f"{_TOOLS} AS tool",
        "CASE WHEN turn % 3 = 0 THEN concat('Segment ', cast((conv_id + turn) % 4 AS string)) END AS segment_name",
        "CASE WHEN turn % 3 = 1 THEN array('Segment 1') END AS segment_names")
    return cv.complete_comparisons(df).select("conv_id", "turn", F.array_join("segment_names", ",").alias("names"))


@query("n12_text_comparisons", f"""WITH {_BEFORE},
q AS (SELECT conv_id, turn, n_named, named, referred, CASE WHEN comparing AND n_named > 0 THEN 'compare_segments'
    WHEN referred IS NOT NULL THEN 'get_segment_details' WHEN prioritising THEN 'smart_customer_query' END AS tool FROM z),
l AS (SELECT *, last_value(CASE WHEN tool = 'get_segment_details' THEN referred END IGNORE NULLS) OVER (
  PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM q)
SELECT conv_id, turn, tool, CASE WHEN tool = 'compare_segments' THEN
  CASE WHEN n_named = 1 AND prev <> named THEN prev || ', ' || named ELSE named END END AS names FROM l""")
def _text_comparisons(spark, sf_dir):
    """Comparisons of the messages' own texts: one that names a single segment is completed from the conversation."""
    users = cv.with_context_before(messages(spark, sf_dir)).filter(F.col("role") == "user")
    asked = users.select("conv_id", "turn", "text", it.resolve(F.col("text"), F.col("discussed")).alias("r")).select("conv_id", "turn", "text", "r.*")
    low = F.lower("text")
    named = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(k)), k.title()) for k in it.COHORTS]))
    comparing = F.greatest(*[F.contains(low, F.lit(k)) for k in it.COMPARISON]) & (F.size(named) > 0)
    requests = asked.select(
        "conv_id", "turn", F.when(comparing, "compare_segments").otherwise(F.col("tool")).alias("tool"),
        F.col("segment").alias("segment_name"), F.when(comparing, named).alias("segment_names"))
    return cv.complete_comparisons(requests).select("conv_id", "turn", "tool", F.array_join("segment_names", ", ").alias("names"))


def _answers(spark, sf_dir):
    t = derive_retail(spark, sf_dir)
    customers = truncate(clustered(t))
    segments = lk.segment_array(lk.segment_list(playbook_of(t, customers)))
    return segments, truncate(hinted(t, customers)), truncate(co.value_behaviour_anomalies(customers))


def _names_of(segments):
    return F.array_join(F.transform(segments, lambda s: F.concat_ws(":", s["rfm_segment"], s["priority"], s["customer_count"])), ", ")


_ANSWERS = HINTED + ", profiles AS " + COHORTS.split("profiles AS ", 1)[1] + """,
ordered AS (SELECT *, row_number() OVER (ORDER BY priority DESC, cohort_id) AS k FROM profiles),
tops AS (SELECT n, coalesce(string_agg(cohort_name || ':' || priority || ':' || customer_count, ', ' ORDER BY k), '') AS names, count(cohort_name) AS total
  FROM (SELECT unnest(range(0, 1000)) AS n) g LEFT JOIN ordered o ON o.k <= g.n GROUP BY 1),
hits AS (SELECT c.category, h.* FROM (VALUES ('tech'), ('electronics'), ('fashion'), ('home'), ('beauty'), ('health'), ('sports'), ('computers')) c(category)
  JOIN hinted h ON contains(lower(h.personalization_hint), c.category)),
odd AS (SELECT count(*) AS n FROM clustered WHERE cohort_name IN ('Champions', 'Loyal Customers', 'At Risk') AND cluster = -1)"""


@retail("n04_category_clusters", f"""WITH {_ANSWERS} SELECT category, cluster_id, size, primary_cohort, personalization_hint,
  round(avg_monetary, 2) AS avg_monetary FROM hits""")
def _category_clusters(t):
    clusters = hinted(t)
    return rounded(lk.category_clusters(clusters, lk.known_categories(clusters.sparkSession)))


@query("n04_routed_requests", f"""WITH {SCORED}, {_ANSWERS}
SELECT conv_id, turn, CASE column_selection WHEN 'rfm_segment' THEN 'segment_overview' WHEN 'hdbscan_cluster' THEN 'behavioral_targeting' ELSE 'anomaly_detection' END AS type,
  CASE column_selection WHEN 'both' THEN 'both_rfm_and_hdbscan' ELSE column_selection END AS data_source,
  CASE rule WHEN 1 THEN 'Anomaly + value indicators → Use both RFM and HDBSCAN' WHEN 2 THEN 'Targeting with category → Use HDBSCAN clusters'
    WHEN 3 THEN 'Anomaly detection → Use both RFM and HDBSCAN' WHEN 4 THEN 'Campaign targeting → Use HDBSCAN clusters'
    ELSE 'Strategic/overview query → Use RFM segments (100% coverage)' END AS reasoning,
  CASE WHEN column_selection = 'rfm_segment' THEN names END AS segments, CASE WHEN column_selection = 'rfm_segment' THEN total END AS total_segments,
  CASE WHEN column_selection = 'hdbscan_cluster' THEN coalesce(i.category, 'electronics') END AS category,
  CASE WHEN column_selection = 'hdbscan_cluster' THEN (SELECT count(*) FROM hits h WHERE h.category = coalesce(i.category, 'electronics')) END AS total_clusters,
  CASE WHEN column_selection = 'both' THEN (SELECT n FROM odd) END AS total_anomalies,
  CASE WHEN column_selection = 'both' THEN 'Value-Behavior Mismatch: High RFM value + HDBSCAN noise' END AS anomaly,
  CASE WHEN column_selection = 'both' THEN 'Review purchase history for pattern changes|Personal outreach to understand behavior|Consider for VIP intervention program' END AS actions
FROM i JOIN tops ON tops.n = least(coalesce(i.top_n, 5), 999) WHERE role = 'user'""")
def _routed(spark, sf_dir):
    requests = truncate(messages(spark, sf_dir).filter(F.col("role") == "user"))
    df = lk.route(requests, *_answers(spark, sf_dir))
    return rounded(df.select(
        "conv_id", "turn", "type", "data_source", "reasoning", _names_of(F.col("segments")).alias("segments"), "total_segments", "category",
        "total_clusters", "total_anomalies", F.concat("anomaly_type", F.lit(": "), "detection_logic").alias("anomaly"),
        F.array_join("recommended_actions", "|").alias("actions")))


# Each keyword finds the first segment, in look-up order, whose name contains it.
_KNOWN = "known AS (SELECT * FROM (SELECT w.name, w.pos, o.*, row_number() OVER (PARTITION BY w.name ORDER BY o.k) AS place FROM (VALUES " + ", ".join(
    f"('{k.title()}', {i})" for i, k in enumerate(it.COHORTS)) + """) w(name, pos)
  JOIN ordered o ON contains(lower(o.cohort_name), lower(w.name))) y WHERE place = 1)"""


@query("n17_tool_results", f"""WITH {_BEFORE}, {_ANSWERS}, {_KNOWN},
q AS (SELECT conv_id || '-' || turn AS request_id, turn, raw, referred,
  CASE WHEN comparing AND n_named >= 2 THEN 'compare_segments' WHEN referred IS NOT NULL THEN 'get_segment_details'
    WHEN prioritising THEN 'smart_customer_query' ELSE 'find_behavioral_cluster' END AS tool FROM z),
compared AS (SELECT request_id, string_agg(cohort_name || ':' || priority || ':' || customer_count, ', ' ORDER BY pos) AS names, list(cohort_name ORDER BY pos) AS n,
  list(avg_monetary ORDER BY pos) AS v, list(priority ORDER BY pos) AS p FROM q JOIN known ON list_contains(q.raw, known.name) WHERE tool = 'compare_segments' GROUP BY 1)
SELECT q.request_id, tool, CASE tool WHEN 'compare_segments' THEN 'segment_comparison' WHEN 'smart_customer_query' THEN 'segment_overview'
    WHEN 'get_segment_details' THEN CASE WHEN known.name IS NOT NULL THEN 'segment_details' END ELSE CASE WHEN turn > 0 THEN 'behavioral_targeting' END END AS type,
  CASE tool WHEN 'compare_segments' THEN coalesce(compared.names, '') WHEN 'smart_customer_query' THEN (SELECT names FROM tops WHERE tops.n = 5) END AS segments,
  CASE WHEN tool = 'get_segment_details' THEN known.cohort_name END AS segment,
  CASE WHEN tool = 'compare_segments' THEN concat_ws(' | ', CASE WHEN v[1] > v[2] AND v[2] > 0 THEN compared.n[1] || ' has ' || printf('%.1f', v[1] / v[2]) || 'x higher average spend' END,
    CASE WHEN p[1] > p[2] THEN compared.n[1] || ' has higher marketing priority' WHEN p[2] > p[1] THEN compared.n[2] || ' has higher marketing priority' END) END AS insights,
  CASE WHEN tool = 'find_behavioral_cluster' AND turn > 0 THEN 'electronics' END AS category,
  CASE WHEN tool = 'find_behavioral_cluster' AND turn > 0 THEN (SELECT count(*) FROM hits WHERE hits.category = 'electronics') END AS total_clusters,
  CASE WHEN tool = 'find_behavioral_cluster' AND turn = 0 THEN 'Missing parameter: ''category''. Please ask the user which product category they are interested in.'
    WHEN tool = 'get_segment_details' AND known.name IS NULL THEN concat('Segment ', chr(39), referred, chr(39), ' not found') END AS error
FROM q LEFT JOIN compared USING (request_id) LEFT JOIN known ON known.name = q.referred""")
def _tools(spark, sf_dir):
    asked = truncate(cv.resolve_requests(messages(spark, sf_dir)))
    requests = asked.select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"), F.coalesce("tool", F.lit("find_behavioral_cluster")).alias("tool"),
        "query", F.col("segment").alias("segment_name"), F.when(F.col("turn") > 0, "electronics").alias("category"), "segment_names")
    df = lk.dispatch(truncate(requests), *_answers(spark, sf_dir))
    return rounded(df.select(
        "request_id", "tool", "type", _names_of(F.col("segments")).alias("segments"), F.col("segment.rfm_segment").alias("segment"),
        F.array_join("insights", " | ").alias("insights"), "category", "total_clusters", "error"))


@query("t01_context_stream", ORACLES_N14)
def _stream(spark, sf_dir):
    """The streaming job over the table's messages, in two batches of as many files as tasks can read at once, then its table."""
    import uuid

    from clientele.session import scratch_folder
    from clientele.streaming import context as cx

    root = f"{scratch_folder(spark)}/stream-{uuid.uuid4().hex}"
    df, files = messages(spark, sf_dir), spark.sparkContext.defaultParallelism
    df.repartition(2 * files, "conv_id", "turn").write.parquet(f"{root}/in")
    stream = cx.message_stream(spark, f"{root}/in", max_files_per_trigger=files)
    cx.start_context_stream(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    df = cx.latest_context(spark, f"{root}/out").drop("mentions")
    return df.withColumn("segments_discussed", F.array_join("segments_discussed", ", "))
