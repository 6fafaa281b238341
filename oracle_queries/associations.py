"""Ranks, association statistics and metadata levels; samples are customers."""

from pyspark.sql import functions as F

from abundix.operators import associations as a
from oracle_queries.registry import LENSES, query

DENSE = """
WITH s AS (SELECT sample, value AS meta FROM {{{meta}}}),
n AS (SELECT DISTINCT feature FROM {{customer_features}}),
d AS (SELECT n.feature, s.sample, s.meta, coalesce(c.value, 0) AS value FROM n CROSS JOIN s
      LEFT JOIN {{customer_features}} AS c ON c.feature = n.feature AND c.sample = s.sample)
"""
RANKS = """,
r AS (SELECT feature, sample, meta, value,
             rank() OVER (PARTITION BY feature ORDER BY value)
               + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0::DOUBLE AS rank{more}
      FROM d)
"""
META_RANK = """,
             rank() OVER (PARTITION BY feature ORDER BY meta)
               + (count(*) OVER (PARTITION BY feature, meta) - 1) / 2.0::DOUBLE AS meta_rank"""


@query(
    "average_rank",
    """
SELECT feature, sample, value, rank() OVER (PARTITION BY feature ORDER BY value)
  + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0::DOUBLE AS rank
FROM {customer_features}
""",
)
def average_rank(v):
    return a.average_rank(v["customer_features"], within=("feature",))


# two-sided t tail for whole degrees of freedom d: finite sums in cos^2 = 1 - rho^2, one for even and one for odd d
SPEARMAN = (
    DENSE.format(meta="customer_balance")
    + RANKS.format(more=META_RANK)
    + """,
c AS (SELECT feature, corr(rank, meta_rank) AS rho, count(*) AS samples, count(*) - 2 AS d FROM r GROUP BY feature),
pv AS (SELECT feature, rho, samples, 1 - CASE WHEN d % 2 = 0
    THEN abs(rho) * list_sum(list_transform(range(0, d // 2), lambda i:
         exp(lgamma(i + 0.5) - lgamma(0.5) - lgamma(i + 1.0) + i * ln(1 - rho * rho))))
    ELSE 2 / pi() * (asin(abs(rho)) + abs(rho) * sqrt(1 - rho * rho) * list_sum(list_transform(range(0, (d - 1) // 2), lambda i:
         exp(lgamma(1.5) + lgamma(i + 1.0) - lgamma(i + 1.5) + i * ln(1 - rho * rho))))) END AS p_value FROM c)
"""
)


@query(
    "spearman",
    SPEARMAN + "SELECT feature, round(rho, 6) AS rho, samples, round(p_value, 6) AS p_value FROM pv",
)
def spearman(v):
    out = a.spearman(v["customer_features"], v["customer_balance"])
    return out.select("feature", F.round("rho", 6).alias("rho"), "samples", F.round("p_value", 6).alias("p_value"))


LENSES["partial_balance"] = """
SELECT CAST(c_custkey AS STRING) AS sample,
       CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 3000 THEN 'NA' ELSE CAST(c_acctbal AS STRING) END AS value
FROM {customer}
"""


@query(
    "impute_metadata",
    """
SELECT sample, round(coalesce(TRY_CAST(value AS DOUBLE), (SELECT avg(TRY_CAST(value AS DOUBLE)) FROM {partial_balance})), 6) AS value
FROM {partial_balance}
""",
)
def impute_metadata(v):
    return a.impute_metadata(v["partial_balance"]).withColumn("value", F.round("value", 6))


KRUSKAL = DENSE.format(meta="customer_segment") + RANKS.format(more="") + """,
t AS (SELECT feature, sum(n * n * n - n) AS ties FROM (SELECT feature, value, CAST(count(*) AS DOUBLE) AS n FROM d GROUP BY feature, value) AS b GROUP BY feature),
l AS (SELECT feature, meta, sum(rank) AS ranks, CAST(count(*) AS DOUBLE) AS n FROM r GROUP BY feature, meta),
h AS (SELECT feature, sum(ranks * ranks / n) AS total, sum(n) AS n, count(*) AS levels FROM l GROUP BY feature)
"""


@query(
    "kruskal_wallis",
    KRUSKAL
    + """
SELECT h.feature, round((12 / (n * (n + 1)) * total - 3 * (n + 1)) / (1 - ties / (n * n * n - n)), 4) AS h, levels
FROM h JOIN t ON t.feature = h.feature
""",
)
def kruskal_wallis(v):
    out = a.kruskal_wallis(v["customer_features"], v["customer_segment"])
    return out.select("feature", F.round("h", 4).alias("h"), "levels")


@query(
    "level_means",
    """
SELECT feature, level, round(sum(value) / min(n), 6) AS mean FROM {customer_features} AS c
JOIN (SELECT sample, value AS level FROM {customer_segment}) AS m ON m.sample = c.sample
JOIN (SELECT value AS name, count(*) AS n FROM {customer_segment} GROUP BY value) AS k ON k.name = level
GROUP BY feature, level
""",
)
def level_means(v):
    out = a.level_means(v["customer_features"], v["customer_segment"])
    return out.withColumn("mean", F.round("mean", 6))


# p-values: one per part, with ties
LENSES["p_values"] = """
SELECT CAST(p_partkey AS STRING) AS feature, (p_size * p_size) / 2500.0 AS p_value FROM {part}
"""
LENSES["p_values"] = LENSES["p_values"].replace("2500.0", "CAST(2500 AS DOUBLE)")
BH = """
WITH r AS (SELECT feature, p_value, row_number() OVER (ORDER BY p_value, feature) AS at_rank, count(*) OVER () AS n FROM {p_values}),
q AS (SELECT feature, p_value, min(p_value * n / at_rank) OVER (ORDER BY at_rank DESC ROWS UNBOUNDED PRECEDING) AS q_value FROM r)
"""


@query("bh_qvalues", BH + "SELECT feature, p_value, round(q_value, 6) AS q_value FROM q")
def bh_qvalues(v):
    return a.bh_qvalues(v["p_values"]).withColumn("q_value", F.round("q_value", 6))


@query("fdr_select", BH + "SELECT feature, p_value, round(q_value, 6) AS q_value FROM q WHERE q_value <= 0.1")
def fdr_select(v):
    return a.fdr_select(a.bh_qvalues(v["p_values"]), 0.1).withColumn("q_value", F.round("q_value", 6))


TOP = "SELECT p_name AS level, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, p_name) AS place FROM part GROUP BY p_name"


@query("rank_levels", f'SELECT level, n AS count, CAST(place AS INTEGER) AS position FROM ({TOP}) WHERE place <= 12')
def rank_levels(v):
    return a.rank_levels(v["part"], 12, "p_name")


@query(
    "collapse_rare_levels",
    f"SELECT p_partkey, CASE WHEN p_name IN (SELECT level FROM ({TOP}) WHERE place <= 12) THEN p_name ELSE 'other' END AS p_name FROM part",
)
def collapse_rare_levels(v):
    return a.collapse_rare_levels(v["part"], 12, "p_name").select("p_partkey", "p_name")
