"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Every source gets a target number of words. A source whose target is r times
its size contributes each document floor(r) times for certain; the fraction f
that is left is drawn without replacement by Pareto order sampling: documents
are ranked by their random odds divided by their inclusion odds, and the ranks
are taken from the front until the words that are missing are reached. So the
number of words is fixed, not only expected.

Inclusion is unequal: longer documents, which carry more context, are likelier
to get the extra copy. A document of s words has the preference q = s / (s +
``HALF_WORDS``), in thousandths, and the inclusion
p = f + min(f, 1 - f) (q - the mean of q over the words of the source). That is
between 0 and 1, and p x s adds up to f times the size of the source.

The random number is a hash of id and text, so reruns agree. The running sum
over a source is taken over ``RANK_BINS`` bins of the rank first and inside the
one bin per source where the target is reached afterwards; no task sees all
documents of a source.

Defined results: a null text has size 0; a source of size 0 gets the target 0;
null is a source of its own, the last one; rows with equal doc_id and text have
equal ranks and are interchangeable; rows without an id are told apart by their
texts; an empty table gives an empty result. Only the
columns named here are read, others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.session import truncate

WORDS = r"[^\x20\x09-\x0D]+"
RANK_BINS = 4096
MAX_REPEATS = 3
HALF_WORDS = 256  # size of a document whose preference is one half


def words(text: Column) -> Column:
    """Number of words of a text, null counting as none."""
    marked = F.regexp_replace(text, WORDS, "x")
    return F.coalesce(F.length(F.regexp_replace(marked, r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Target of each source from (source, source_size), one row per source.

    Weights are 1, 2, 3, repeating in code point order, null last. Resharing
    what the limited sources leave ends at the level L where the targets
    least(limit, weight x L) add up to all words; L follows from running sums
    in the order in which sources reach their limit.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    s = (sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
         .withColumn("limit", (F.col("source_size") * max_repeats).cast("long")))
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = (s.withColumn("_left", F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
         .withColumn("_weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("_level", F.col("_left") / F.col("_weights"))
         # the first source that does not reach its limit fixes the level; sources that tie come in the order of the running sums
         .withColumn("_free", F.col("limit") / F.col("weight") > F.col("_level"))
         .withColumn("_at", F.min(F.when(F.col("_free"), F.struct(
             F.col("limit") / F.col("weight"), F.col("source").isNull(), "source", "_level"))).over(everything)["_level"]))
    share = F.col("weight") * F.coalesce("_at", F.lit(float("inf")))
    return s.select("source", "source_size", "weight",
                    F.least(F.col("limit").cast("double"), share).alias("target"))


def row_key(docs: DataFrame) -> Column:
    """Digest of id and text; equal keys are equal documents."""
    return F.md5(F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(docs["text"], F.lit(""))).cast("binary"))


def random_unit(key: Column) -> Column:
    """A number strictly between 0 and 1 from the digest."""
    return (F.conv(F.substring(key, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def preference(size: Column) -> Column:
    """Thousandths, so that sums over a source are exact in any order."""
    return F.floor(size.cast("double") * 1000 / (size + HALF_WORDS)).cast("long")


def mix(docs: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) per document."""
    return _draw(docs, max_repeats).drop("_key")


def _draw(docs: DataFrame, max_repeats: int) -> DataFrame:
    sized = truncate(docs.select("doc_id", "source", words(F.col("text")).alias("size"), row_key(docs).alias("_key"))
                     .withColumn("_q", preference(F.col("size"))))
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("_q") * F.col("size")).alias("_qs"))
    # one row per source: a name list, not a copy of the data
    by_source = truncate(by_source)
    some = F.col("source_size") > 0
    goal = truncate(targets(by_source, max_repeats).alias("t")
                    .join(by_source.select(F.col("source").alias("_s"), "_qs"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
                    .withColumn("ratio", F.when(some, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
                    .withColumn("whole", F.floor("ratio"))
                    .withColumn("_f", F.col("ratio") - F.col("whole"))
                    .withColumn("_mean", F.when(some, F.col("_qs").cast("double") / F.col("source_size")).otherwise(F.lit(0.0)))
                    .withColumn("_rest", F.col("target") - F.col("whole") * F.col("source_size")))
    inclusion = F.col("_f") + F.least(F.col("_f"), 1 - F.col("_f")) * (F.col("_q").cast("double") - F.col("_mean")) / 1000
    u = random_unit(F.col("_key"))
    odds = F.when(F.col("_f") > 0, u / (1 - u) / (F.col("_p") / (1 - F.col("_p"))))
    # x / (1 + x) spreads the ranks over the bins
    ranked = (sized.join(goal, sized.source.eqNullSafe(goal.source)).select(sized["*"], *[
        goal[c] for c in ("source_size", "target", "whole", "_f", "_mean", "_rest")])
        .withColumn("_p", inclusion).withColumn("_rank", odds)
        .withColumn("_bin", F.floor(F.col("_rank") / (1 + F.col("_rank")) * RANK_BINS)))
    bins = ranked.where("_rank is not null").groupBy("source", "_bin", "_rest").agg(F.sum("size").alias("_sum"))
    running = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("_before", F.coalesce(F.sum("_sum").over(running), F.lit(0)))
    # in the bin that holds the target, and nowhere else, the order inside the bin matters
    border = truncate(bins.where("_before < _rest and _before + _sum >= _rest")
                      .groupBy("source").agg(F.min_by("_bin", "_bin").alias("_border"),
                                             F.min_by("_before", "_bin").alias("_before")))
    placed = ranked.join(border.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    # without a border bin the source takes none or, if rounding leaves a little over, all of its rest
    none = F.col("_border").isNull()
    inside = F.coalesce(F.col("_bin") == F.col("_border"), F.lit(False))
    order = Window.partitionBy("source").orderBy("_rank", "_key").rowsBetween(Window.unboundedPreceding, -1)
    edge = (placed.where(inside).withColumn("_sum", F.col("_before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
            .withColumn("extra", (F.col("_sum") + F.col("size") / 2 <= F.col("_rest")).cast("long")).drop("_sum"))
    rest = placed.where(~inside).withColumn("extra", F.when(none | F.col("_rank").isNull(), F.lit(0)).otherwise(
        (F.col("_bin") < F.col("_border")).cast("int")).cast("long"))
    copies = F.col("whole") + F.col("extra")
    return edge.unionByName(rest).select(
        "doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"), "_key")


def mixed_documents(docs: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The documents themselves, each as often as the mix takes it.

    The same draw as ``mix``. Of rows with equal id, source and text the draw
    may give some one copy more than the others; those of them that get it are
    the first in an order without meaning.
    """
    drawn = _draw(docs, max_repeats).groupBy("source", "_key").agg(
        F.min("copies").alias("_low"), F.max("copies").alias("_high"), F.sum("copies").alias("_all"), F.count("*").alias("_rows"))
    keyed = drawn.where("_high > 0").alias("keyed")
    # the row travels as one value, so its columns may have any name
    rows = docs.select(row_key(docs).alias("_key"), "source", F.struct(*docs.columns).alias("row")).alias("docs")
    same = (F.col("docs._key") == F.col("keyed._key")) & F.col("docs.source").eqNullSafe(F.col("keyed.source"))
    met = rows.join(keyed, same).select("docs.row", "keyed.*")
    # equal rows have neighbouring ranks, so at most one key of a source is split
    place = F.row_number().over(Window.partitionBy("source", "_key").orderBy(F.lit(0)))
    split = met.where("_low < _high").withColumn("_n", F.when(
        place <= F.col("_all") - F.col("_low") * F.col("_rows"), F.col("_high")).otherwise(F.col("_low")))
    taken = met.where("_low = _high").withColumn("_n", F.col("_low")).unionByName(split).where("_n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("copy")).select("row.*")


def oracle(source: str = "documents") -> str:
    """The same draw as one DuckDB query over a table or subquery with doc_id, text, source."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key
  FROM {source}),
tilted AS (SELECT *, (('0x' || substr(key, 1, 12))::BIGINT::DOUBLE + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u,
    floor(size::DOUBLE * 1000::DOUBLE / (size + {HALF_WORDS})::DOUBLE)::BIGINT AS q FROM sized),
s AS (SELECT source, sum(size)::BIGINT AS source_size, sum(q * size)::BIGINT AS qs FROM tilted GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight, source_size * {MAX_REPEATS} AS lim FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(lim) OVER q, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER q, 0))::DOUBLE AS level FROM w
  WINDOW q AS (ORDER BY lim::DOUBLE / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, qs,
    least(lim::DOUBLE, weight * coalesce((SELECT level FROM l WHERE lim::DOUBLE / weight > level
      ORDER BY lim::DOUBLE / weight, source IS NULL, source LIMIT 1), 'inf'::DOUBLE)) AS target
  FROM l),
r AS (SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS whole,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM t),
d AS (SELECT x.doc_id, x.source, x.size, x.key, x.u, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size AS rest, ratio - whole AS f,
    CASE WHEN r.source_size > 0 THEN (ratio - whole) + least(ratio - whole, 1 - (ratio - whole))
      * (x.q::DOUBLE - r.qs::DOUBLE / r.source_size::DOUBLE) / 1000::DOUBLE END AS p
  FROM tilted x JOIN r ON x.source IS NOT DISTINCT FROM r.source),
e AS (SELECT *, CASE WHEN f > 0 THEN u / (1 - u) / (p / (1 - p)) END AS k FROM d),
c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k NULLS LAST, key
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e)
SELECT doc_id, source, size, source_size, target,
  (whole + CASE WHEN k IS NOT NULL AND before + size / 2.0 <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM c"""
