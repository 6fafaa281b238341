"""Strata of one feature: selection, order, scaling and sample distances."""

from pyspark.sql import functions as F

from abundix.operators import contributions as c
from oracle_queries.registry import LENSES, query

LENSES["focal"] = "SELECT stratum, sample, value FROM {feature_table} WHERE code = 'Brand#3' AND stratum IS NOT NULL"
# some samples without anything of the focal organisms
LENSES["gappy"] = """
SELECT stratum, sample, CASE WHEN sample > 'N' AND stratum < 'g__M' THEN 0.0 ELSE value END AS value
FROM {focal} WHERE stratum <> 'unclassified' AND (stratum < 'g__M' OR sample < 'R')
"""
LENSES["gappy"] = LENSES["gappy"].replace("THEN 0.0", "THEN CAST(0 AS DOUBLE)")


@query("focal_feature", "SELECT * FROM {focal} WHERE stratum <> 'unclassified'")
def focal_feature(v):
    return c.focal_feature(v["feature_table"], "Brand#3", exclude_unclassified=True)


@query(
    "drop_zero_samples",
    "SELECT * FROM {gappy} WHERE sample IN (SELECT sample FROM {gappy} GROUP BY sample HAVING sum(value) > 0)",
)
def drop_zero_samples(v):
    return c.drop_zero_samples(v["gappy"])


TOP = """
WITH b AS (SELECT stratum FROM {focal} WHERE stratum <> 'unclassified' GROUP BY stratum
           ORDER BY sum(value) DESC, stratum DESC LIMIT 5),
t AS (SELECT CASE WHEN stratum = 'unclassified' OR stratum IN (SELECT stratum FROM b) THEN stratum ELSE 'other' END AS stratum,
             sample, sum(value) AS value FROM {focal} GROUP BY 1, 2)
"""


@query("top_taxa", TOP + "SELECT stratum, sample, value FROM t")
def top_taxa(v):
    return c.top_taxa(v["focal"], 5)


DOMINANT = """
WITH o AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY value DESC, stratum DESC) AS place FROM {focal}),
d AS (SELECT sample, stratum, value FROM o WHERE place = 1),
p AS (SELECT stratum, max(value) AS peak FROM {focal} GROUP BY stratum),
x AS (SELECT d.sample, d.stratum, value, row_number() OVER (ORDER BY peak DESC, d.stratum DESC, value DESC, sample) AS position
      FROM d JOIN p ON p.stratum = d.stratum)
"""


@query("dominant_stratum", DOMINANT + "SELECT sample, stratum, value, position FROM x")
def dominant_stratum(v):
    return c.dominant_stratum(v["focal"])


LENSES["sample_meta"] = "SELECT DISTINCT sample, concat(substr(sample, 4, 4), substr(sample, 1, 2)) AS value FROM {focal}"
LENSES["sample_list"] = """
SELECT sample, 1000 - 3 * CAST(substr(sample, 4, 4) AS INT) - CASE WHEN sample < 'N' THEN 1 WHEN sample < 'R' THEN 2 ELSE 0 END
       - CASE WHEN substr(sample, 2, 1) = 'O' THEN 100 ELSE 0 END AS position
FROM (SELECT DISTINCT sample FROM {focal}) AS names
"""
ORDERS = {
    "sum": "SELECT sample, row_number() OVER (ORDER BY sum(value) DESC, sample) AS position FROM {focal} GROUP BY sample",
    "dominant": DOMINANT + "SELECT sample, position FROM x",
    "metadata": "SELECT sample, row_number() OVER (ORDER BY value, sample) AS position FROM {sample_meta}",
    "file": "SELECT sample, row_number() OVER (ORDER BY position, sample) AS position FROM {sample_list}",
    "none": "SELECT sample, row_number() OVER (ORDER BY sample) AS position FROM (SELECT DISTINCT sample FROM {focal}) AS s",
}


def _order_query(method):
    @query(f"order_samples_{method}", ORDERS[method])
    def ordered(v):
        return c.order_samples(v["focal"], method, v["sample_meta"], v["sample_list"])


for _method in ORDERS:
    _order_query(_method)

SUMS = "WITH s AS (SELECT sample, sum(value) AS total FROM {gappy} GROUP BY sample)"
SHARE = "value / CASE WHEN total > 0 THEN total ELSE -1 END"
SCALINGS = {
    "original": "SELECT stratum, sample, value FROM {gappy}",
    "totalsum": SUMS
    + f" SELECT stratum, g.sample, round({SHARE}, 6) + 0 AS value FROM {{gappy}} AS g JOIN s ON s.sample = g.sample",
    "logstack": SUMS
    + f""", f AS (SELECT floor(log10(min(total))) AS low FROM s WHERE total > 0)
SELECT stratum, g.sample, round({SHARE} * (CASE WHEN total > pow(10, low) THEN log10(total) ELSE low END - low), 6) + 0 AS value
FROM {{gappy}} AS g JOIN s ON s.sample = g.sample CROSS JOIN f
""",
}


def _scaling_query(scaling):
    @query(f"contribution_scaling_{scaling}", SCALINGS[scaling])
    def scaled(v):
        out = c.contribution_scaling(v["gappy"], scaling)
        return out if scaling == "original" else out.withColumn("value", F.round("value", 6) + F.lit(0.0)).select(
            "stratum", "sample", "value"
        )


for _scaling in SCALINGS:
    _scaling_query(_scaling)

DISTANCE = """
WITH c AS ({cells}),
t AS (SELECT sample, sum(value) AS total FROM c GROUP BY sample),
m AS (SELECT x.sample AS sample1, y.sample AS sample2, sum(least(x.value, y.value)) AS shared
      FROM c AS x JOIN c AS y ON x.stratum = y.stratum AND x.sample < y.sample GROUP BY x.sample, y.sample)
SELECT sample1, sample2, round(1 - 2 * shared / (a.total + b.total), 6) AS distance
FROM m JOIN t AS a ON a.sample = sample1 JOIN t AS b ON b.sample = sample2
"""
POSITIVE = "SELECT stratum, sample, value FROM {gappy} WHERE value > 0"
RELATIVE = (
    "SELECT stratum, g.sample, value / total AS value FROM {gappy} AS g "
    "JOIN (SELECT sample, sum(value) AS total FROM {gappy} GROUP BY sample) AS s ON s.sample = g.sample WHERE value > 0"
)


@query("braycurtis", DISTANCE.replace("{cells}", RELATIVE))
def braycurtis(v):
    return c.braycurtis(v["gappy"]).withColumn("distance", F.round("distance", 6))


@query("braycurtis_weighted", DISTANCE.replace("{cells}", POSITIVE))
def braycurtis_weighted(v):
    return c.braycurtis(v["gappy"], relative=False).withColumn("distance", F.round("distance", 6))


@query(
    "braycurtis_pairs",
    """
WITH c AS (SELECT stratum, sample, sum(value) AS value FROM {feature_table} WHERE stratum IS NOT NULL GROUP BY stratum, sample),
t AS (SELECT sample, sum(value) AS total FROM c GROUP BY sample),
p AS (SELECT a.sample AS sample1, b.sample AS sample2, a.total AS one, b.total AS two FROM t AS a JOIN t AS b
      ON substr(a.sample, 1, 3) = substr(b.sample, 1, 3) AND CAST(substr(a.sample, 4) AS INTEGER) + 1 = CAST(substr(b.sample, 4) AS INTEGER)),
s AS (SELECT sample1, sample2, sum(least(x.value, y.value)) AS shared FROM p JOIN c AS x ON x.sample = sample1
      JOIN c AS y ON y.sample = sample2 AND y.stratum = x.stratum GROUP BY sample1, sample2)
SELECT p.sample1, p.sample2, round(1 - 2 * coalesce(shared, 0) / (one + two), 6) AS distance
FROM p LEFT JOIN s ON s.sample1 = p.sample1 AND s.sample2 = p.sample2
""",
)
def braycurtis_pairs(v):
    """Each sample and the same flags a year later."""
    strata = v["feature_table"].where("stratum IS NOT NULL")
    names = strata.select(F.col("sample").alias("sample1")).distinct()
    year = F.substring("sample1", 4, 4).cast("int") + 1
    pairs = names.withColumn("sample2", F.concat(F.substring("sample1", 1, 3), year.cast("string")))
    return c.braycurtis_pairs(strata, pairs, relative=False).withColumn("distance", F.round("distance", 6))


# customers as samples, the kinds of parts they bought as strata
LENSES["baskets"] = """
SELECT concat(p_type, '-', CAST(p_size AS STRING)) AS stratum, CAST(o_custkey AS STRING) AS sample, SUM(l_quantity) AS value
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
GROUP BY p_type, p_size, o_custkey
"""
NEAR = """
WITH c AS (SELECT * FROM {baskets}),
t AS (SELECT sample, sum(value) AS total FROM c GROUP BY sample),
s AS (SELECT x.sample AS sample1, y.sample AS sample2, sum(least(x.value, y.value)) AS shared
      FROM c AS x JOIN c AS y ON y.stratum = x.stratum AND x.sample < y.sample GROUP BY x.sample, y.sample),
d AS (SELECT sample1, sample2, 1 - 2 * shared / (one.total + two.total) AS distance
      FROM s JOIN t AS one ON one.sample = sample1 JOIN t AS two ON two.sample = sample2)
"""


@query("similar_samples", NEAR + "SELECT sample1, sample2, round(distance, 6) AS distance FROM d WHERE distance <= 0.7")
def similar_samples(v):
    return c.similar_samples(v["baskets"], 0.7, relative=False).withColumn("distance", F.round("distance", 6))


@query(
    "nearest_samples",
    NEAR
    + """, n AS (SELECT sample1 AS sample, sample2 AS neighbour, distance FROM d UNION ALL SELECT sample2, sample1, distance FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY distance, neighbour) AS rank FROM n)
SELECT sample, CAST(rank AS INTEGER) AS rank, neighbour, round(distance, 6) AS distance FROM r WHERE rank <= 3
""",
)
def nearest_samples(v):
    return c.nearest_samples(v["baskets"], 3, relative=False).withColumn("distance", F.round("distance", 6))
