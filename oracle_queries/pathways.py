"""Reactions and pathways."""

from pyspark.sql import functions as F

from abundix.functions.statistics import chi2_cdf
from abundix.operators import pathways as pw
from abundix.operators.scaling import with_group_totals
from abundix.sources.mappings import is_optional, pathway_nodes
from oracle_queries.registry import LENSES, query


@query(
    "genes_to_reactions",
    """
SELECT bug, o.gene, reaction, score FROM {organism_genes} AS o JOIN {reaction_genes} AS r ON o.gene = r.gene
""",
)
def genes_to_reactions(v):
    return pw.genes_to_reactions(v["organism_genes"], v["reaction_genes"])


@query("reaction_scores", "SELECT bug, reaction, score FROM {reaction_scores}")
def reaction_scores(v):
    return pw.reaction_scores(v["organism_genes"], v["reaction_genes"])


@query(
    "unintegrated_genes",
    """
SELECT bug, sum(score) AS unintegrated FROM {organism_genes}
WHERE gene NOT IN (SELECT gene FROM {reaction_genes}) GROUP BY bug
""",
)
def unintegrated_genes(v):
    return pw.unintegrated_genes(v["organism_genes"], v["reaction_genes"])


@query("reactions_to_pathways", "SELECT bug, pathway, reaction, score FROM {pathway_scores}")
def reactions_to_pathways(v):
    return pw.reactions_to_pathways(v["reaction_scores"], v["pathway_reactions"])


@query(
    "harmonic_mean",
    """
SELECT bug, pathway, round(count(*) / sum(1 / score), 6) AS mean FROM {pathway_scores} GROUP BY bug, pathway
""",
)
def harmonic_mean(v):
    return v["pathway_scores"].groupBy("bug", "pathway").agg(F.round(pw.harmonic_mean("score"), 6).alias("mean"))


# scores with the key reactions a-e of every pathway: one gap is filled, or the lowest raised
FILLED = """
WITH k AS (SELECT p.bug, p.pathway, m.reaction, coalesce(s.score, 0) AS score
           FROM (SELECT DISTINCT bug, pathway FROM {structured_scores}) AS p
           JOIN {structured_members} AS m ON m.pathway = p.pathway AND m.slot <> 'f'
           LEFT JOIN {structured_scores} AS s ON s.bug = p.bug AND s.pathway = p.pathway AND s.reaction = m.reaction),
a AS (SELECT bug, pathway, count(*) FILTER (WHERE score = 0) AS missing,
             list_sort(list(score) FILTER (WHERE score > 0)) AS found FROM k GROUP BY bug, pathway),
n AS (SELECT k.bug, k.pathway, k.reaction,
             CASE WHEN missing = 1 AND score = 0 THEN found[1]
                  WHEN missing = 0 AND score = found[1] THEN found[2] END AS score
      FROM k JOIN a ON k.bug = a.bug AND k.pathway = a.pathway),
f AS (SELECT coalesce(s.bug, c.bug) AS bug, coalesce(s.pathway, c.pathway) AS pathway,
             coalesce(s.reaction, c.reaction) AS reaction, coalesce(c.score, s.score) AS score
      FROM {structured_scores} AS s
      FULL JOIN (SELECT DISTINCT * FROM n WHERE score IS NOT NULL) AS c
        ON s.bug = c.bug AND s.pathway = c.pathway AND s.reaction = c.reaction)
"""


def _nodes(v):
    return pathway_nodes(v["pathway_structures"])


def _filled(v):
    return pw.gap_fill(v["structured_scores"], pw.key_reactions(_nodes(v)))


@query("gap_fill", FILLED + "SELECT bug, pathway, reaction, score FROM f")
def gap_fill(v):
    return _filled(v)


@query(
    "pathway_nodes",
    """
WITH s AS (SELECT * FROM {pathway_parts})
SELECT pathway, 0 AS node_id, CAST(NULL AS INTEGER) AS parent_id, 0 AS depth, '+' AS join, NULL AS reaction, NULL AS is_key FROM s
UNION ALL SELECT pathway, 1, 0, 1, NULL, a, TRUE FROM s
UNION ALL SELECT pathway, 2, 0, 1, NULL, b, TRUE FROM s
UNION ALL SELECT pathway, 3, 0, 1, ',', NULL, NULL FROM s
UNION ALL SELECT pathway, 4, 3, 2, NULL, c, TRUE FROM s
UNION ALL SELECT pathway, 5, 3, 2, NULL, d, TRUE FROM s
UNION ALL SELECT pathway, 6, 0, 1, '+', NULL, NULL FROM s
UNION ALL SELECT pathway, 7, 6, 2, NULL, e, TRUE FROM s
UNION ALL SELECT pathway, 8, 6, 2, NULL, f, FALSE FROM s
""",
)
def nodes(v):
    return _nodes(v)


def _tree(values: str, leaf: str = "score") -> str:
    """Score of a b ( c , d ) ( e + -f ) from the reaction values of each slot."""
    return f"""{values},
l AS (SELECT p.bug, p.pathway, m.slot, {leaf} AS value
      FROM (SELECT DISTINCT bug, pathway FROM f) AS p
      JOIN {{structured_members}} AS m ON m.pathway = p.pathway
      LEFT JOIN f ON f.bug = p.bug AND f.pathway = p.pathway AND f.reaction = m.reaction),
w AS (SELECT bug, pathway, max(value) FILTER (WHERE slot = 'a') AS a, max(value) FILTER (WHERE slot = 'b') AS b,
             greatest(max(value) FILTER (WHERE slot = 'c'), max(value) FILTER (WHERE slot = 'd')) AS o,
             max(value) FILTER (WHERE slot = 'e') AS e, max(value) FILTER (WHERE slot = 'f') AS x
      FROM l GROUP BY bug, pathway),
y AS (SELECT *, CASE WHEN x > e AND e > 0 THEN 2 / (1 / e + 1 / x) ELSE e END AS n FROM w),
z AS (SELECT bug, pathway, CASE WHEN least(a, b, o, n) > 0 THEN 4 / (1 / a + 1 / b + 1 / o + 1 / n) ELSE 0 END AS score FROM y)
"""


@query(
    "structured_pathway_score",
    _tree(FILLED, "coalesce(f.score, 0)") + "SELECT bug, pathway, round(score, 6) AS score FROM z",
)
def structured_pathway_score(v):
    out = pw.structured_pathway_score(_filled(v), _nodes(v))
    return out.withColumn("score", F.round("score", 6))


@query(
    "flat_pathway_abundance",
    """
WITH n AS (SELECT pathway, count(DISTINCT reaction) AS size FROM {pathway_reactions} GROUP BY pathway),
r AS (SELECT s.bug, s.pathway, score, size, row_number() OVER (PARTITION BY s.bug, s.pathway ORDER BY score DESC) AS place
      FROM {pathway_scores} AS s JOIN n ON n.pathway = s.pathway)
SELECT bug, pathway, round(sum(score) FILTER (WHERE place <= size - size // 2) / min(size - size // 2), 6) AS score
FROM r GROUP BY bug, pathway
""",
)
def flat_pathway_abundance(v):
    out = pw.flat_pathway_abundance(v["pathway_scores"], v["pathway_reactions"])
    return out.withColumn("score", F.round("score", 6))


@query("median_score", "SELECT bug, median(score) AS median FROM {pathway_scores} GROUP BY bug")
def median_score(v):
    return pw.median_score(v["pathway_scores"])


@query(
    "max_median_score",
    """
SELECT bug, median(score) AS median
FROM (SELECT bug, pathway, max(score) AS score FROM {pathway_scores} GROUP BY bug, pathway) AS m GROUP BY bug
""",
)
def max_median_score(v):
    return pw.max_median_score(v["pathway_scores"])


@query(
    "flat_pathway_coverage",
    """
WITH m AS (SELECT bug, median(score) AS median FROM {pathway_scores} GROUP BY bug),
n AS (SELECT pathway, count(*) AS size FROM {pathway_reactions} GROUP BY pathway)
SELECT s.bug, s.pathway, round(count(*) FILTER (WHERE score > median) / min(size), 6) AS coverage
FROM {pathway_scores} AS s JOIN m ON m.bug = s.bug JOIN n ON n.pathway = s.pathway GROUP BY s.bug, s.pathway
""",
)
def flat_pathway_coverage(v):
    out = pw.flat_pathway_coverage(v["pathway_scores"], v["pathway_reactions"])
    return out.withColumn("coverage", F.round("coverage", 6))


# chi-square distribution function of even degrees of freedom in closed form
CHI2 = """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
       round(1 - exp(-l_quantity / 2) * list_sum(list_transform(range(0, l_linenumber),
             lambda i: pow(l_quantity / 2, i) / factorial(CAST(i AS INTEGER)))), 9) AS p
FROM lineitem
"""


@query("chi2_cdf", CHI2)
def chi2(v):
    p = F.round(chi2_cdf("l_quantity", F.col("l_linenumber") * 2), 9)
    return v["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", p.alias("p"))


# medians are real numbers, so the leaf probabilities come from the power series; all terms around its
# largest one are added, so their number follows the values and nothing is cut off
SERIES = """
list_sum(list_transform(
  range(CAST(greatest(0, floor(x - k - 12 * sqrt(x) - 30)) AS BIGINT), CAST(ceil(greatest(0, x - k) + 12 * sqrt(x + k) + 80) AS BIGINT)),
  lambda i: CASE WHEN x > 0 THEN exp((k + i) * ln(x) - x - lgamma(k + i + 1)) ELSE 0 END))
"""


def _coverage_sql(times: int, having: str = "") -> str:
    leaves = _tree(
        FILLED
        + f""",
med AS (SELECT bug, median(score) * {times} / 2 AS k FROM {{structured_scores}} GROUP BY bug),
vals AS (SELECT f.bug, f.pathway, f.reaction, score * {times} / 2 AS x, k FROM f JOIN med ON f.bug = med.bug),
uniq AS (SELECT DISTINCT x, k FROM vals),
prob AS (SELECT x, k, """
        + SERIES
        + """ AS p FROM uniq),
f2 AS (SELECT v.bug, v.pathway, v.reaction, p FROM vals AS v JOIN prob ON v.x = prob.x AND v.k = prob.k)""",
        "coalesce(f.p, 0)",
    )
    leaves = leaves.replace("DISTINCT bug, pathway FROM f)", "DISTINCT bug, pathway FROM f2)")
    leaves = leaves.replace("LEFT JOIN f ON f.bug = p.bug", "LEFT JOIN f2 AS f ON f.bug = p.bug")
    return leaves + "SELECT bug, pathway, round(score, 6) AS coverage FROM z" + having


@query("structured_pathway_coverage", _coverage_sql(1))
def structured_pathway_coverage(v):
    out = pw.structured_pathway_coverage(v["structured_scores"], _nodes(v))
    return out.withColumn("coverage", F.round("coverage", 6))


@query("structured_pathway_coverage_large", _coverage_sql(1000))
def structured_pathway_coverage_large(v):
    """Abundant reactions: the same scores times 1000."""
    scores = v["structured_scores"].withColumn("score", F.col("score") * 1000)
    out = pw.structured_pathway_coverage(scores, _nodes(v))
    return out.withColumn("coverage", F.round("coverage", 6))


LENSES["pathway_abundance"] = """
SELECT bug, pathway, SUM(score) - AVG(SUM(score)) OVER (PARTITION BY bug) AS score
FROM {pathway_scores} GROUP BY bug, pathway
"""
PRESENT = """
SELECT DISTINCT s.bug, s.reaction FROM {pathway_scores} AS s
JOIN {pathway_abundance} AS a ON a.bug = s.bug AND a.pathway = s.pathway WHERE a.score > 0 AND s.score > 0
"""


@query("present_reactions", PRESENT)
def present_reactions(v):
    return pw.present_reactions(v["pathway_scores"], v["pathway_abundance"])


IN_PATHWAYS = f"""
SELECT t.bug, coalesce(i.score, 0) AS in_pathways, t.score - coalesce(i.score, 0) AS remaining
FROM (SELECT bug, sum(score) AS score FROM {{organism_genes}} GROUP BY bug) AS t
LEFT JOIN (SELECT bug, sum(score) AS score FROM {{organism_genes}} AS o
           WHERE EXISTS (SELECT 1 FROM ({PRESENT}) AS p JOIN {{reaction_genes}} AS r ON r.reaction = p.reaction
                         WHERE p.bug = o.bug AND r.gene = o.gene) GROUP BY bug) AS i ON i.bug = t.bug
WHERE t.bug IN (SELECT bug FROM {{pathway_scores}})
"""


def _in_pathways(v):
    v.write("organism_genes", "pathway_scores")
    present = pw.present_reactions(v["pathway_scores"], v["pathway_abundance"])
    return pw.genes_in_pathways(v["organism_genes"], v["reaction_genes"], present, v["pathway_scores"])


@query("genes_in_pathways", IN_PATHWAYS)
def genes_in_pathways(v):
    return _in_pathways(v)


@query(
    "unmapped_unintegrated",
    f"""
WITH p AS (SELECT bug, sum(score) AS total FROM {{pathway_abundance}} WHERE score > 0 GROUP BY bug),
c AS (SELECT p.bug, CASE WHEN in_pathways <> 0 THEN total / in_pathways ELSE 0 END AS k, remaining
      FROM p JOIN ({IN_PATHWAYS}) AS g ON g.bug = p.bug)
SELECT bug, round(k, 6) AS compression, round(k * remaining, 4) AS unintegrated,
       CASE WHEN bug = 'all' THEN round(k * 1000, 4) END AS unmapped FROM c
""",
)
def unmapped_unintegrated(v):
    genes = _in_pathways(v)
    out = pw.unmapped_unintegrated(v["pathway_abundance"], genes, 1000)
    return out.select(
        "bug",
        F.round("compression", 6).alias("compression"),
        F.round("unintegrated", 4).alias("unintegrated"),
        F.round("unmapped", 4).alias("unmapped"),
    )


def cover_sql(observed: str, members: str) -> str:
    """Tables up to ``cover(bug, pathway)``: the smallest cover, of several the one whose pathways come first by
    number of observed reactions, then name.

    Covers grow by one pathway a round, always by an owner of the open reaction with the fewest owners, until a
    round completes one.  Of covers that leave the same reactions open only the first is kept.
    """
    return f"""
cv_edges AS MATERIALIZED (SELECT DISTINCT o.bug, p.pathway, o.reaction FROM {observed} AS o JOIN {members} AS p ON p.reaction = o.reaction),
cv_rank AS (SELECT bug, pathway, row_number() OVER (PARTITION BY bug ORDER BY count(*) DESC, pathway) AS rank FROM cv_edges GROUP BY bug, pathway),
cv_place AS (SELECT bug, reaction, row_number() OVER (PARTITION BY bug ORDER BY count(*), reaction) - 1 AS place, count(*) OVER (PARTITION BY bug) AS size
             FROM cv_edges GROUP BY bug, reaction),
cv_marked AS MATERIALIZED (SELECT e.bug, e.pathway, rank, place, size FROM cv_edges AS e JOIN cv_rank AS k ON k.bug = e.bug AND k.pathway = e.pathway
                           JOIN cv_place AS p ON p.bug = e.bug AND p.reaction = e.reaction),
cv_owned AS MATERIALIZED (SELECT bug, rank, bit_or(set_bit(CAST(repeat('0', CAST(size AS INTEGER)) AS BIT), CAST(place AS INTEGER), 1)) AS owns
                          FROM cv_marked GROUP BY bug, rank),
cv_step AS MATERIALIZED (SELECT m.bug, m.place, m.rank, o.owns FROM cv_marked AS m JOIN cv_owned AS o ON o.bug = m.bug AND o.rank = m.rank),
cv_search AS (
    SELECT bug, 0 AS n, CAST([] AS BIGINT[]) AS chosen, CAST(repeat('1', CAST(max(size) AS INTEGER)) AS BIT) AS remaining FROM cv_place GROUP BY bug
    UNION ALL
    SELECT s.bug, min(n) + 1, min(list_sort(list_append(s.chosen, o.rank))), s.remaining & ~o.owns
    FROM (SELECT *, bool_or(bit_count(remaining) = 0) OVER (PARTITION BY bug) AS done FROM cv_search) AS s
    JOIN cv_step AS o ON o.bug = s.bug AND o.place = bit_position(CAST('1' AS BIT), s.remaining) - 1
    WHERE NOT done GROUP BY s.bug, s.remaining & ~o.owns),
cover AS (SELECT c.bug, pathway FROM (SELECT bug, unnest(min(chosen)) AS rank FROM cv_search WHERE bit_count(remaining) = 0 GROUP BY bug) AS c
          JOIN cv_rank AS k ON k.bug = c.bug AND k.rank = c.rank)"""


def greedy_sql(observed: str, members: str) -> str:
    """Tables up to ``cv_chosen(bug, pathway)``: sole owners first, then one pathway at a time, the one with the most
    uncovered reactions, among equals by the number of observed ones, then by name.  An organism's pathways and open reactions are lists in one row.
    """
    return f"""
cv_edges AS (SELECT DISTINCT o.bug, p.pathway, o.reaction FROM {observed} AS o JOIN {members} AS p ON p.reaction = o.reaction),
cv_sole AS (SELECT DISTINCT bug, pathway FROM (SELECT bug, min(pathway) AS pathway FROM cv_edges GROUP BY bug, reaction HAVING count(*) = 1) AS u),
cv_open AS (SELECT bug, list(DISTINCT reaction) AS remaining FROM cv_edges AS e
            WHERE NOT EXISTS (SELECT 1 FROM cv_edges AS c JOIN cv_sole AS s ON s.bug = c.bug AND s.pathway = c.pathway
                              WHERE c.bug = e.bug AND c.reaction = e.reaction) GROUP BY bug),
cv_owned AS (SELECT bug, pathway, list(reaction) AS r FROM cv_edges GROUP BY bug, pathway),
cv_sets AS (SELECT bug, list(struct_pack(p := pathway, r := r)) AS ps FROM cv_owned GROUP BY bug),
cv_greedy AS (
    SELECT s.bug, ps, CAST(NULL AS VARCHAR) AS pathway, remaining FROM cv_sets AS s JOIN cv_open AS o ON o.bug = s.bug
    UNION ALL
    SELECT bug, ps, best.p, list_filter(remaining, lambda x: NOT list_contains(best.r, x))
    FROM (SELECT bug, ps, remaining, list_sort(list_transform(ps, lambda e:
              struct_pack(n := -len(list_intersect(e.r, remaining)), m := -len(e.r), p := e.p, r := e.r)))[1] AS best
          FROM cv_greedy WHERE len(remaining) > 0) AS picked),
cv_chosen AS (SELECT bug, pathway FROM cv_sole UNION SELECT bug, pathway FROM cv_greedy WHERE pathway IS NOT NULL)"""


def supported_sql(observed: str, members: str, share: float = 0.5) -> str:
    return f"""
SELECT o.bug, p.pathway FROM (SELECT DISTINCT bug, reaction FROM {observed}) AS o JOIN {members} AS p ON p.reaction = o.reaction
JOIN (SELECT pathway, count(*) AS size FROM {members} GROUP BY pathway) AS n ON n.pathway = p.pathway
GROUP BY o.bug, p.pathway HAVING count(*) >= min(size) * {share}"""


COVER = "WITH RECURSIVE" + cover_sql("{observed_reactions}", "{fine_pathways}")


@query("parsimonious_pathways", COVER + " SELECT bug, pathway FROM cover")
def parsimonious_pathways(v):
    return pw.parsimonious_pathways(v["observed_reactions"], v["fine_pathways"])


GREEDY = "WITH RECURSIVE" + greedy_sql("{observed_reactions}", "{fine_pathways}")


@query("greedy_pathways", GREEDY + " SELECT bug, pathway FROM cv_chosen")
def greedy_pathways(v):
    return pw.greedy_pathways(v["observed_reactions"], v["fine_pathways"])


@query(
    "pathway_cover",
    COVER + ", sizes AS (SELECT bug, count(*) AS n FROM cover GROUP BY bug) SELECT c.bug, pathway, TRUE AS proven, n AS n_pathways FROM cover AS c JOIN sizes AS s ON s.bug = c.bug",
)
def pathway_cover(v):
    covers = pw.pathway_cover(v["observed_reactions"], v["fine_pathways"])
    return with_group_totals(covers, ["bug"], n_pathways=F.count(F.lit(1)))


@query(
    "uncovered_reactions",
    "SELECT DISTINCT bug, CAST(0 AS BIGINT) AS uncovered FROM {observed_reactions}",
)
def uncovered_reactions(v):
    """Reactions of each organism that have a pathway but none among the chosen ones: always 0."""
    observed = v["observed_reactions"]
    covered = pw.parsimonious_pathways(observed, v["fine_pathways"]).join(v["fine_pathways"], "pathway")
    owned = observed.join(v["fine_pathways"].select("reaction"), "reaction", "left_semi")
    missed = owned.join(covered, ["bug", "reaction"], "left_anti").groupBy("bug").agg(F.count(F.lit(1)).alias("_n"))
    return (
        observed.select("bug").distinct().join(missed, "bug", "left").select("bug", F.coalesce("_n", F.lit(0)).alias("uncovered"))
    )


@query("well_supported_pathways", supported_sql("{observed_reactions}", "{fine_pathways}", 0.9))
def well_supported_pathways(v):
    return pw.well_supported_pathways(v["observed_reactions"], v["fine_pathways"], 0.9)


@query(
    "add_well_supported",
    COVER + " SELECT bug, pathway FROM cover UNION " + supported_sql("{observed_reactions}", "{fine_pathways}", 0.9),
)
def add_well_supported(v):
    v.write("observed_reactions", "fine_pathways")
    observed, members = v["observed_reactions"], v["fine_pathways"]
    return pw.add_well_supported(pw.parsimonious_pathways(observed, members), observed, members, 0.9)


def selected_sql(observed: str, members: str, more_than: int) -> str:
    """Tables up to ``selected(bug, pathway, reaction, score)``."""
    return f"""{cover_sql(observed, members)},
kept AS (SELECT bug, pathway FROM cover UNION {supported_sql(observed, members)}),
many AS (SELECT bug FROM {observed} GROUP BY bug HAVING count(*) > {more_than}),
selected AS (SELECT o.bug, p.pathway, o.reaction, o.score FROM {observed} AS o JOIN {members} AS p ON p.reaction = o.reaction
             LEFT JOIN kept ON kept.bug = o.bug AND kept.pathway = p.pathway
             WHERE o.bug NOT IN (SELECT bug FROM many) OR kept.bug IS NOT NULL)"""


@query(
    "select_pathways",
    "WITH RECURSIVE" + selected_sql("{observed_reactions}", "{fine_pathways}", 250) + " SELECT bug, pathway, reaction, score FROM selected",
)
def select_pathways(v):
    v.write("observed_reactions", "fine_pathways")
    return pw.select_pathways(v["observed_reactions"], v["fine_pathways"], more_than=250)


@query(
    "select_pathways_all",
    """
SELECT bug, pathway, o.reaction, score FROM {observed_reactions} AS o JOIN {fine_pathways} AS p ON p.reaction = o.reaction
""",
)
def select_pathways_all(v):
    return pw.select_pathways(v["observed_reactions"], v["fine_pathways"], parsimony=False)
