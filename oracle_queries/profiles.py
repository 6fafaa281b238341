"""Whole profiles."""

from pyspark.sql import functions as F

from abundix.functions.alignments import match_count
from abundix.plans import cohort, profiles as p
from abundix.session import cut_lineage, scratch_path
from oracle_queries import associations as sql_a, hits as sql_h, pathways as sql_p
from oracle_queries.registry import LENSES, query

LENSES["protein_hits"] = """
SELECT query, concat('p', substr(gene, length(gene), 1), bug) AS gene, bug, matches, 9000 AS gene_length, aligned_length,
       identity, evalue, q_start, q_end, q_length, s_start, s_end
FROM {hits}
"""
KEPT = """
f AS (SELECT * FROM {protein_hits} WHERE identity >= 70 AND evalue <= 0.06 AND (abs(q_end - q_start) + 1) / 60.0::DOUBLE * 100 >= 20),
o AS (SELECT gene, s_start, s_end, max(s_end) OVER (PARTITION BY gene ORDER BY s_start, s_end
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM f WHERE s_end > s_start),
g AS (SELECT gene FROM o GROUP BY gene HAVING sum(CASE WHEN reach IS NULL OR s_start > reach THEN s_end - s_start
      WHEN s_end > reach THEN s_end - reach ELSE 0 END) / 3000.0::DOUBLE * 100 >= 20),
k AS (SELECT * FROM f WHERE gene IN (SELECT gene FROM g)),
w AS (SELECT gene, bug, CASE WHEN count(*) OVER (PARTITION BY query) = 1 THEN 1.0::DOUBLE
              ELSE matches * matches / sum(matches * matches) OVER (PARTITION BY query) END
             / ((abs(gene_length - aligned_length) + 1) / 1000.0::DOUBLE) AS amount FROM k),
s AS (SELECT gene AS code, bug AS stratum, sum(amount) AS value FROM w GROUP BY GROUPING SETS ((gene, bug), (gene))),
c AS (SELECT code, stratum, value / (SELECT sum(value) FROM s WHERE stratum IS NULL) * 1e6 AS value FROM s)
"""


@query(
    "profile_gene_families",
    f"""
WITH {KEPT} SELECT code, stratum, round(value, 4) AS value FROM c
UNION ALL SELECT 'READS_UNMAPPED', NULL, 1234.0::DOUBLE
""",
)
def profile_gene_families(v):
    out = p.profile_gene_families(
        v["protein_hits"], identity=70, evalue=0.06, query_coverage=20, subject_coverage=20, unaligned=1234
    )
    return out.select("code", "stratum", F.round("value", 4).alias("value"))


ALIGNED = f"""
sam AS ({sql_h.SAM_KEPT}),
hit AS ({sql_h.FILTERED}),
un AS (SELECT count(DISTINCT query) AS unaligned FROM sam WHERE NOT kept AND query NOT IN (SELECT query FROM hit)),
k AS (SELECT query, gene, concat('m', CAST(l_linenumber AS VARCHAR)) AS bug, identity / 100.0::DOUBLE * aligned_length AS matches,
             1000 AS gene_length, CAST(aligned_length AS DOUBLE) AS aligned_length FROM sam WHERE kept
      UNION ALL SELECT query, gene, bug, matches, gene_length, aligned_length FROM hit),
w AS (SELECT gene, bug, CASE WHEN count(*) OVER (PARTITION BY query) = 1 THEN 1.0::DOUBLE
              ELSE matches * matches / sum(matches * matches) OVER (PARTITION BY query) END
             / ((abs(gene_length - aligned_length) + 1) / 1000.0::DOUBLE) AS amount FROM k),
s AS (SELECT gene AS code, bug AS stratum, sum(amount) AS value FROM w GROUP BY GROUPING SETS ((gene, bug), (gene)))
"""


def _aligned(v):
    records = sql_h.sam_records(v).withColumns(
        {"bug": F.concat(F.lit("m"), "l_linenumber"), "matches": match_count("identity", "aligned_length")}
    ).withColumn("aligned_length", F.col("aligned_length").cast("double"))
    return p.profile_alignments(
        records, v["hits"], v["reaction_genes"], v["pathway_reactions"], nucleotide_identity=60,
        nucleotide_subject_coverage=80, identity=80, evalue=0.05, query_coverage=40, subject_coverage=None, parsimony=False,
    )


@query(
    "profile_alignments",
    f"""
WITH {ALIGNED} SELECT code, stratum, round(value / (SELECT sum(value) FROM s WHERE stratum IS NULL) * 1e6, 4) AS value FROM s
UNION ALL SELECT 'READS_UNMAPPED', NULL, CAST(unaligned AS DOUBLE) FROM un
""",
)
def profile_alignments(v):
    """Gene families of nucleotide and translated alignments together, with the reads of neither."""
    return _aligned(v).gene_families.select("code", "stratum", F.round("value", 4).alias("value"))


@query(
    "profile_alignments_reactions",
    f"""
WITH {ALIGNED},
all_s AS (SELECT coalesce(stratum, 'all') AS bug, code AS gene, value FROM s),
r AS (SELECT bug, reaction, sum(value) AS value FROM all_s JOIN {{reaction_genes}} AS g ON g.gene = all_s.gene GROUP BY bug, reaction)
SELECT reaction AS code, CASE WHEN bug <> 'all' THEN bug END AS stratum, round(value, 6) AS value FROM r
UNION ALL SELECT 'UNGROUPED', CASE WHEN bug <> 'all' THEN bug END, round(sum(value), 6) FROM all_s
          WHERE gene NOT IN (SELECT gene FROM {{reaction_genes}}) GROUP BY bug
UNION ALL SELECT 'UNMAPPED', NULL, CAST(unaligned AS DOUBLE) FROM un
""",
)
def profile_alignments_reactions(v):
    return _aligned(v).reactions.select("code", "stratum", F.round("value", 6).alias("value"))


def _ordered(rows: str, special: str = "2") -> str:
    return f"""
SELECT code, stratum, value, row_number() OVER (ORDER BY {special}, community DESC, code,
       CASE WHEN stratum IS NULL THEN 1 ELSE 2 END, value DESC, stratum) AS position
FROM (SELECT r.code, r.stratum, r.value, coalesce(t.value, 0) AS community FROM ({rows}) AS r
      LEFT JOIN ({rows}) AS t ON t.code = r.code AND t.stratum IS NULL) AS x
"""


REACTIONS = """
SELECT reaction AS code, CASE WHEN bug <> 'all' THEN bug END AS stratum, score AS value FROM {reaction_scores}
UNION ALL SELECT 'UNGROUPED', CASE WHEN bug <> 'all' THEN bug END, sum(score) FROM {organism_genes}
          WHERE gene NOT IN (SELECT gene FROM {reaction_genes}) GROUP BY bug
UNION ALL SELECT 'UNMAPPED', NULL, 321.0::DOUBLE
"""


@query(
    "profile_reactions", _ordered(REACTIONS, "CASE code WHEN 'UNMAPPED' THEN 0 WHEN 'UNGROUPED' THEN 1 ELSE 2 END")
)
def profile_reactions(v):
    return p.profile_reactions(v["organism_genes"], v["reaction_genes"], 321).drop("name")


# flat pathways without the parsimony step
ABUNDANCE = """
n AS (SELECT pathway, count(*) AS size FROM {pathway_reactions} GROUP BY pathway),
r AS (SELECT s.bug, s.pathway, score, size, row_number() OVER (PARTITION BY s.bug, s.pathway ORDER BY score DESC) AS place
      FROM {pathway_scores} AS s JOIN n ON n.pathway = s.pathway),
a AS (SELECT bug, pathway, sum(score) FILTER (WHERE place <= size - size // 2) / min(size - size // 2) AS score FROM r GROUP BY bug, pathway),
present AS (SELECT DISTINCT bug, reaction FROM {pathway_scores}),
inside AS (SELECT o.bug, sum(score) AS score FROM {organism_genes} AS o WHERE EXISTS (
       SELECT 1 FROM present JOIN {reaction_genes} AS rg ON rg.reaction = present.reaction
       WHERE present.bug = o.bug AND rg.gene = o.gene) GROUP BY o.bug),
rest AS (SELECT o.bug, sum(o.score) - min(i.score) AS remaining, min(i.score) AS inside
         FROM {organism_genes} AS o JOIN inside AS i ON i.bug = o.bug GROUP BY o.bug),
k AS (SELECT a.bug, sum(a.score) / min(inside) AS k, min(remaining) AS remaining FROM a JOIN rest ON rest.bug = a.bug GROUP BY a.bug)
"""


@query(
    "profile_pathways",
    f"""
WITH {ABUNDANCE}
SELECT pathway AS code, concat('about ', pathway) AS name, CASE WHEN bug <> 'all' THEN bug END AS stratum, round(score, 4) AS value FROM a
UNION ALL SELECT 'UNINTEGRATED', NULL, CASE WHEN bug <> 'all' THEN bug END, round(k * remaining, 4) FROM k
UNION ALL SELECT 'UNMAPPED', NULL, NULL, round(k * 750, 4) FROM k WHERE bug = 'all'
""",
)
def profile_pathways(v):
    names = v["pathway_reactions"].select(F.col("pathway").alias("id")).distinct()
    names = names.withColumn("name", F.concat(F.lit("about "), "id"))
    out = p.profile_pathways(
        v["organism_genes"], v["reaction_genes"], v["pathway_reactions"], names=names, unaligned=750, parsimony=False
    )
    return out.select("code", "name", "stratum", F.round("value", 4).alias("value"))


# structured pathways with parsimony and gap filling
_TREE = sql_p._tree(sql_p.FILLED, "coalesce(f.score, 0)").replace("WITH k AS", "k AS").replace("{structured_scores}", "selected")
STRUCTURED = (
    "WITH RECURSIVE rs AS (SELECT o.bug, r.reaction, sum(o.score) AS score FROM {organism_genes} AS o"
    " JOIN {fine_reaction_genes} AS r ON r.gene = o.gene GROUP BY o.bug, r.reaction),"
    " mem AS (SELECT DISTINCT pathway, reaction FROM {structured_members}),"
    + sql_p.selected_sql("rs", "mem", 3)
    + ","
    + _TREE.strip()
    + """,
present AS (SELECT DISTINCT s.bug, s.reaction FROM selected AS s JOIN z ON z.bug = s.bug AND z.pathway = s.pathway WHERE z.score > 0 AND s.score > 0),
inside AS (SELECT bug, sum(score) AS score FROM {organism_genes} AS o WHERE EXISTS (
       SELECT 1 FROM present JOIN {fine_reaction_genes} AS rg ON rg.reaction = present.reaction
       WHERE present.bug = o.bug AND rg.gene = o.gene) GROUP BY bug),
rest AS (SELECT o.bug, sum(o.score) - coalesce(min(i.score), 0) AS remaining, coalesce(min(i.score), 0) AS within
         FROM {organism_genes} AS o LEFT JOIN inside AS i ON i.bug = o.bug GROUP BY o.bug),
comp AS (SELECT z.bug, CASE WHEN min(within) <> 0 THEN sum(z.score) / min(within) ELSE 0 END AS k, min(remaining) AS remaining
         FROM z JOIN rest ON rest.bug = z.bug WHERE z.score > 0 GROUP BY z.bug),
rows_out AS (
    SELECT pathway AS code, CASE WHEN bug <> 'all' THEN bug END AS stratum, score AS value FROM z WHERE round(score, 10) > 0
    UNION ALL SELECT 'UNINTEGRATED', CASE WHEN bug <> 'all' THEN bug END, k * remaining FROM comp
    UNION ALL SELECT 'UNMAPPED', NULL, k * 750 FROM comp WHERE bug = 'all')
SELECT code, stratum, round(value, 4) AS value FROM rows_out
"""
)


def _structured(v):
    return p.profile_pathways(
        v["organism_genes"], v["fine_reaction_genes"], v["structured_members"].select("pathway", "reaction"),
        sql_p._nodes(v), unaligned=750,
    )


@query("profile_pathways_structured", STRUCTURED)
def profile_pathways_structured(v):
    """Structured pathways with parsimony and gap filling."""
    return _structured(v).select("code", "stratum", F.round("value", 4).alias("value"))


# pathways defined on genes: every gene of a pathway is one of its reactions, none is integrated
LENSES["pathway_genes_flat"] = """
SELECT DISTINCT concat(p_brand, '.', CAST(p_size AS STRING)) AS pathway, concat('g', CAST(p_partkey AS STRING)) AS reaction FROM {part}
"""


@query(
    "profile_reactions_of_genes",
    """
SELECT gene AS code, CASE WHEN bug <> 'all' THEN bug END AS stratum, score AS value FROM {organism_genes}
UNION ALL SELECT 'UNGROUPED', CASE WHEN bug <> 'all' THEN bug END, sum(score) FROM {organism_genes} GROUP BY bug
UNION ALL SELECT 'UNMAPPED', NULL, 321.0::DOUBLE
""",
)
def profile_reactions_of_genes(v):
    return p.profile_reactions(v["organism_genes"], None, 321).drop("name", "position")


@query(
    "profile_pathways_of_genes",
    """
WITH s AS (SELECT o.bug, p.pathway, p.reaction, o.score FROM {organism_genes} AS o JOIN {pathway_genes_flat} AS p ON p.reaction = o.gene),
n AS (SELECT pathway, count(*) AS size FROM {pathway_genes_flat} GROUP BY pathway),
r AS (SELECT s.bug, s.pathway, score, size, row_number() OVER (PARTITION BY s.bug, s.pathway ORDER BY score DESC) AS place FROM s JOIN n ON n.pathway = s.pathway),
a AS (SELECT bug, pathway, sum(score) FILTER (WHERE place <= size - size // 2) / min(size - size // 2) AS score FROM r GROUP BY bug, pathway),
k AS (SELECT a.bug, sum(a.score) / min(total) AS k FROM a JOIN (SELECT bug, sum(score) AS total FROM {organism_genes} GROUP BY bug) AS t ON t.bug = a.bug GROUP BY a.bug)
SELECT pathway AS code, CASE WHEN bug <> 'all' THEN bug END AS stratum, round(score, 4) AS value FROM a
UNION ALL SELECT 'UNINTEGRATED', CASE WHEN bug <> 'all' THEN bug END, 0.0::DOUBLE FROM k
UNION ALL SELECT 'UNMAPPED', NULL, round(k * 750, 4) FROM k WHERE bug = 'all'
""",
)
def profile_pathways_of_genes(v):
    """No gene map: every gene is in a pathway, so nothing is left unintegrated."""
    out = p.profile_pathways(v["organism_genes"], None, v["pathway_genes_flat"], unaligned=750, parsimony=False)
    return out.select("code", "stratum", F.round("value", 4).alias("value"))


@query("profile_pathway_coverage_structured", sql_p._coverage_sql(1, " WHERE round(score, 10) > 0"))
def profile_pathway_coverage_structured(v):
    out = p.profile_pathway_coverage(v["structured_scores"], v["structured_members"], sql_p._nodes(v))
    return out.withColumn("coverage", F.round("coverage", 6))


@query(
    "profile_pathway_coverage",
    """
WITH m AS (SELECT bug, median(score) AS median FROM {pathway_scores} GROUP BY bug),
n AS (SELECT pathway, count(*) AS size FROM {pathway_reactions} GROUP BY pathway),
c AS (SELECT s.bug, s.pathway, count(*) FILTER (WHERE score > median) / min(size) AS coverage
      FROM {pathway_scores} AS s JOIN m ON m.bug = s.bug JOIN n ON n.pathway = s.pathway GROUP BY s.bug, s.pathway)
SELECT bug, pathway, round(coverage, 6) AS coverage FROM c WHERE coverage > 0
""",
)
def profile_pathway_coverage(v):
    out = p.profile_pathway_coverage(v["pathway_scores"], v["pathway_reactions"])
    return out.withColumn("coverage", F.round("coverage", 6))


# the customers' segments have five levels: the tail of chi-square with 4 degrees has a closed form
ASSOCIATE = (
    sql_a.KRUSKAL
    + """,
x AS (SELECT h.feature, (12 / (n * (n + 1)) * total - 3 * (n + 1)) / (1 - ties / (n * n * n - n)) AS h, levels
      FROM h JOIN t ON t.feature = h.feature),
pv AS (SELECT feature, h, levels, exp(-h / 2) * (1 + h / 2) AS p_value FROM x),
rk AS (SELECT *, row_number() OVER (ORDER BY p_value, feature) AS at_rank, count(*) OVER () AS tests FROM pv),
q AS (SELECT *, min(p_value * tests / at_rank) OVER (ORDER BY at_rank DESC ROWS UNBOUNDED PRECEDING) AS q_value FROM rk)
SELECT feature, round(h, 4) AS h, levels, round(p_value, 6) AS p_value, round(q_value, 6) AS q_value FROM q WHERE q_value <= 0.9
"""
)


@query("associate", ASSOCIATE)
def associate(v):
    out = p.associate(v["customer_features"], v["customer_segment"], "categorical", fdr=0.9)
    return out.withColumns({"h": F.round("h", 4), "p_value": F.round("p_value", 6), "q_value": F.round("q_value", 6)})


@query(
    "associate_continuous",
    sql_a.SPEARMAN
    + """,
rk AS (SELECT *, row_number() OVER (ORDER BY p_value, feature) AS at_rank, count(*) OVER () AS tests FROM pv WHERE p_value IS NOT NULL),
q AS (SELECT *, min(p_value * tests / at_rank) OVER (ORDER BY at_rank DESC ROWS UNBOUNDED PRECEDING) AS q_value FROM rk)
SELECT feature, round(rho, 6) AS rho, samples, round(p_value, 6) AS p_value, round(q_value, 6) AS q_value FROM q WHERE q_value <= 1.0
""",
)
def associate_continuous(v):
    metadata = v["customer_balance"].withColumn("value", F.col("value").cast("string"))
    out = p.associate(v["customer_features"], metadata, "continuous", fdr=1.0)
    return out.select("feature", *[F.round(c, 6).alias(c) for c in ("rho", "p_value", "q_value")], "samples")


# several metadata of the same samples
LENSES["customer_levels"] = """
SELECT 'segment' AS metadatum, CAST(c_custkey AS STRING) AS sample, c_mktsegment AS value FROM {customer}
UNION ALL SELECT 'third', CAST(c_custkey AS STRING), CAST(c_custkey % 3 AS STRING) FROM {customer}
UNION ALL SELECT 'nation', CAST(c_custkey AS STRING), CAST(c_nationkey % 7 AS STRING) FROM {customer}
"""
LENSES["customer_numbers"] = """
SELECT 'balance' AS metadatum, CAST(c_custkey AS STRING) AS sample, CAST(c_acctbal AS STRING) AS value FROM {customer}
UNION ALL SELECT 'key', CAST(c_custkey AS STRING), CAST(c_custkey % 17 AS STRING) FROM {customer}
UNION ALL SELECT 'nation', CAST(c_custkey AS STRING), CAST(c_nationkey AS STRING) FROM {customer}
"""


def _family(sql: str) -> str:
    """The SQL of one metadatum for several: all windows and groups by metadatum too."""
    for old, new in (
        ("SELECT sample, value AS meta FROM {customer_segment}", "SELECT metadatum, sample, value AS meta FROM {customer_levels}"),
        ("SELECT sample, value AS meta FROM {customer_balance}", "SELECT metadatum, sample, CAST(value AS DOUBLE) AS meta FROM {customer_numbers}"),
        ("SELECT n.feature, s.sample", "SELECT n.feature, s.metadatum, s.sample"),
        ("SELECT feature,", "SELECT feature, metadatum,"),
        ("PARTITION BY feature", "PARTITION BY feature, metadatum"),
        ("GROUP BY feature", "GROUP BY feature, metadatum"),
    ):
        sql = sql.replace(old, new)
    return sql


FAMILY_Q = """,
rk AS (SELECT *, row_number() OVER (PARTITION BY metadatum ORDER BY p_value, feature) AS at_rank, count(*) OVER (PARTITION BY metadatum) AS tests
       FROM pv WHERE p_value IS NOT NULL),
q AS (SELECT *, min(p_value * tests / at_rank) OVER (PARTITION BY metadatum ORDER BY at_rank DESC ROWS UNBOUNDED PRECEDING) AS q_value FROM rk)
"""


@query(
    "associate_all",
    _family(sql_a.KRUSKAL)
    + """,
x AS (SELECT h.feature, h.metadatum, (12 / (n * (n + 1)) * total - 3 * (n + 1)) / (1 - ties / (n * n * n - n)) AS h, levels
      FROM h JOIN t ON t.feature = h.feature AND t.metadatum = h.metadatum),
pv AS (SELECT *, exp(-h / 2) * list_sum(list_transform(range(0, (levels - 1) // 2), lambda i: pow(h / 2, i) / factorial(CAST(i AS INTEGER)))) AS p_value FROM x)"""
    + FAMILY_Q
    + "SELECT feature, metadatum, round(h, 4) AS h, levels, round(p_value, 6) AS p_value, round(q_value, 6) AS q_value FROM q WHERE q_value <= 0.95",
)
def associate_all(v):
    out = p.associate_all(v["customer_features"], v["customer_levels"], "categorical", fdr=0.95)
    return out.withColumns({"h": F.round("h", 4), "p_value": F.round("p_value", 6), "q_value": F.round("q_value", 6)})


@query(
    "associate_all_continuous",
    _family(sql_a.SPEARMAN)
    + FAMILY_Q
    + "SELECT feature, metadatum, round(rho, 6) AS rho, samples, round(p_value, 6) AS p_value, round(q_value, 6) AS q_value FROM q WHERE q_value <= 1.0",
)
def associate_all_continuous(v):
    out = p.associate_all(v["customer_features"], v["customer_numbers"], "continuous", fdr=1.0)
    return out.select("feature", "metadatum", *[F.round(c, 6).alias(c) for c in ("rho", "p_value", "q_value")], "samples")


@query(
    "contribution_table",
    """
WITH g AS (SELECT split_part(stratum, '.', 1) AS stratum, sample, sum(value) AS value FROM {focal} GROUP BY 1, 2),
ps AS (SELECT sample, row_number() OVER (ORDER BY sum(value) DESC, sample) AS position, sum(value) AS total FROM g GROUP BY sample),
b AS (SELECT stratum FROM g WHERE stratum <> 'unclassified' GROUP BY stratum ORDER BY sum(value) DESC, stratum DESC LIMIT 2),
tt AS (SELECT CASE WHEN stratum = 'unclassified' OR stratum IN (SELECT stratum FROM b) THEN stratum ELSE 'other' END AS stratum,
             sample, sum(value) AS value FROM g GROUP BY 1, 2),
lv AS (SELECT value AS level, row_number() OVER (ORDER BY count(*) DESC, value) AS place FROM {sample_meta} GROUP BY value)
SELECT tt.stratum, tt.sample, round(tt.value / total, 6) AS value, position,
       CASE WHEN place <= 3 THEN lv.level ELSE 'other' END AS level
FROM tt JOIN ps ON ps.sample = tt.sample JOIN {sample_meta} AS m ON m.sample = tt.sample JOIN lv ON lv.level = m.value
""",
)
def contribution_table(v):
    out = p.contribution_table(
        v["feature_table"], "Brand#3", v["sample_meta"], genera=True, taxa=2, levels=3, scaling="totalsum"
    )
    return out.withColumn("value", F.round("value", 6))


def _grown(v):
    """The feature table as a cohort to which the samples of two flags were added later, one of them twice."""
    path = scratch_path(v.spark, "cohort")
    table = cut_lineage(v["feature_table"])
    late = F.col("sample").startswith("N")
    cohort.create_cohort(table.where(~late), path, buckets=16)
    wrong = table.where(late & F.col("sample").endswith("5")).withColumn("value", F.lit(-1.0))
    cohort.add_samples(v.spark, path, wrong)
    cohort.add_samples(v.spark, path, table.where(late))
    return path


@query("cohort_add_samples", "SELECT code, name, stratum, sample, value FROM {feature_table}")
def cohort_add_samples(v):
    return cohort.read_cohort(v.spark, _grown(v))


@query(
    "cohort_totals",
    """
SELECT code, name, stratum, sum(value) AS sum, count(*) AS cells, min(value) AS low, max(value) AS high
FROM {feature_table} GROUP BY code, name, stratum
""",
)
def cohort_totals(v):
    return cohort.cohort_totals(v.spark, _grown(v))
