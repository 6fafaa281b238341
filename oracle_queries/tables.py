"""Feature ids and feature tables."""

from pyspark.sql import functions as F

from abundix.functions import features as ft
from abundix.functions.statistics import log_transform
from abundix.operators import ordering as o, tables as t
from abundix.sources.mappings import gene_pathways, pathway_members
from oracle_queries.registry import LENSES, query

LENSES["feature_ids"] = """
SELECT DISTINCT concat(p_brand, CASE WHEN p_size > 25 THEN concat(': ', p_name, CASE WHEN p_size > 40 THEN ': x' ELSE '' END)
                                     ELSE '' END,
                       CASE WHEN p_type <> 'SMALL' THEN concat('|', taxon) ELSE '' END) AS feature,
       p_brand AS brand, p_name AS part_name, p_size AS size, p_type AS type, taxon
FROM {shipped}
"""
LENSES["groups"] = """
SELECT DISTINCT p_brand AS code, concat('group ', p_type) AS "group" FROM {part} WHERE p_brand <> 'Brand#5'
"""
LENSES["groups"] = LENSES["groups"].replace('"group"', "grp")
LENSES["brand_names"] = """
SELECT DISTINCT p_brand AS key, p_type AS value FROM {part} WHERE p_brand <> 'Brand#5'
"""
LENSES["clusters"] = """
SELECT DISTINCT concat('cluster ', p_name) AS key, p_brand AS value FROM {part}
"""


def _groups(v):
    return v["groups"].withColumnRenamed("grp", "group")


PARTS = """
SELECT feature, brand AS code,
       CASE WHEN size > 40 THEN concat(part_name, ': x') WHEN size > 25 THEN part_name END AS name,
       CASE WHEN type <> 'SMALL' THEN taxon END AS stratum
FROM {feature_ids}
"""


@query("split_feature", PARTS)
def split_feature(v):
    return ft.split_feature(v["feature_ids"].select("feature"), keep=True)


@query("join_feature", "SELECT feature AS joined, feature FROM {feature_ids}")
def join_feature(v):
    parts = ft.split_feature(v["feature_ids"].select("feature"), keep=True)
    return parts.select(ft.join_feature().alias("joined"), "feature")


@query("genus_of", "SELECT DISTINCT taxon, split_part(taxon, '.', 1) AS genus FROM {shipped}")
def genus_of(v):
    return v["shipped"].select("taxon").distinct().withColumn("genus", ft.genus_of("taxon"))


@query(
    "simplify_name",
    "SELECT o_orderkey, regexp_replace(concat(o_orderpriority, '--', o_orderstatus), '[^A-Za-z0-9]+', '_', 'g') AS name FROM orders",
)
def simplify_name(v):
    text = F.concat("o_orderpriority", F.lit("--"), "o_orderstatus")
    return v["orders"].select("o_orderkey", ft.simplify_name(text).alias("name"))


@query(
    "pretty_taxon",
    """
SELECT DISTINCT taxon, CASE WHEN s_nationkey = 0 THEN taxon ELSE replace(n_name, '_', ' ') END AS pretty,
       CASE WHEN s_nationkey = 0 THEN taxon ELSE r_name END AS pretty_genus
FROM {shipped}
""",
)
def pretty_taxon(v):
    taxa = v["shipped"].select("taxon").distinct()
    return taxa.withColumns(
        {"pretty": ft.pretty_taxon("taxon"), "pretty_genus": ft.pretty_taxon(ft.genus_of("taxon"))}
    )


@query(
    "log_transform",
    "SELECT o_orderkey, round(log10(o_totalprice), 6) AS tens, round(ln(o_totalprice) / ln(2), 6) AS twos FROM orders",
)
def log_values(v):
    return v["orders"].select(
        "o_orderkey",
        F.round(log_transform("o_totalprice"), 6).alias("tens"),
        F.round(log_transform("o_totalprice", 2), 6).alias("twos"),
    )


@query("round_to", "SELECT o_orderkey, round_even((o_custkey + 0.5::DOUBLE) / 4, 1) AS value FROM orders")
def round_to(v):
    return v["orders"].select("o_orderkey", ft.round_to((F.col("o_custkey") + 0.5) / 4, 1).alias("value"))


@query(
    "clean_sample_name",
    "SELECT o_orderkey, regexp_replace(concat(o_orderpriority, '@[x]|y.z'), '[^a-zA-Z0-9_|.]', '_', 'g') AS name FROM orders",
)
def clean_sample_name(v):
    text = F.concat("o_orderpriority", F.lit("@[x]|y.z"))
    return v["orders"].select("o_orderkey", ft.clean_sample_name(text).alias("name"))


@query(
    "rename_samples",
    """
SELECT DISTINCT concat(p_brand, CASE WHEN p_size > 25 THEN '-RPKs' ELSE '' END) AS sample,
       concat(p_brand, '-CPM') AS renamed FROM part
""",
)
def rename_samples(v):
    sample = F.concat("p_brand", F.when(F.col("p_size") > 25, F.lit("-RPKs")).otherwise(F.lit("")))
    return v["part"].select(sample.alias("sample")).distinct().withColumn("renamed", ft.rename_sample("sample", "cpm"))


CELL = "code, stratum, sample, value"


@query(
    "drop_special",
    f"SELECT {CELL} FROM {{feature_table}} WHERE code NOT IN ('UNMAPPED', 'UNINTEGRATED', 'UNGROUPED')",
)
def drop_special(v):
    return t.drop_special(v["feature_table"]).drop("name")


@query(
    "split_stratified",
    f"SELECT {CELL}, CASE WHEN stratum IS NULL THEN 'community' ELSE 'strata' END AS part FROM {{feature_table}}",
)
def split_stratified(v):
    strata, community = t.split_stratified(v["feature_table"])
    return (
        strata.withColumn("part", F.lit("strata"))
        .unionByName(community.withColumn("part", F.lit("community")))
        .drop("name")
    )


@query(
    "nonzero_at_precision",
    "SELECT code, stratum, sample, value / 10000 AS value FROM {feature_table} WHERE round(value / 10000, 2) > 0",
)
def nonzero_at_precision(v):
    small = v["feature_table"].withColumn("value", F.col("value") / 10000)
    return t.nonzero_at_precision(small, 2).drop("name")


def _renorm(total: str, factor: str, rows: str = "{feature_table}") -> str:
    return f"""
SELECT code, stratum, sample, round(value / coalesce(nullif(({total}), 0), 1) * {factor}, 6) AS value
FROM {rows} AS r
"""


COMMUNITY = """
WITH t AS (SELECT sample, sum(value) AS total FROM {feature_table} WHERE stratum IS NULL GROUP BY sample)
SELECT code, stratum, r.sample, round(value / total * 1e6, 6) AS value FROM {feature_table} AS r
JOIN t ON r.sample = t.sample
"""


@query("renormalise", COMMUNITY)
def renormalise(v):
    return t.renormalise(v["feature_table"]).drop("name").withColumn("value", F.round("value", 6))


@query(
    "renormalise_levelwise",
    """
WITH k AS (SELECT * FROM {feature_table} WHERE code NOT IN ('UNMAPPED', 'UNINTEGRATED', 'UNGROUPED')),
t AS (SELECT sample, stratum IS NULL AS top, sum(value) AS total FROM k GROUP BY sample, stratum IS NULL)
SELECT code, stratum, k.sample, round(value / total, 6) AS value FROM k
JOIN t ON k.sample = t.sample AND (k.stratum IS NULL) = t.top
""",
)
def renormalise_levelwise(v):
    out = t.renormalise(v["feature_table"], "relab", "levelwise", special=False)
    return out.drop("name").withColumn("value", F.round("value", 6))


REGROUP = """
WITH m AS (SELECT code, grp FROM {groups} UNION SELECT 'UNMAPPED', 'UNMAPPED' UNION SELECT 'UNINTEGRATED', 'UNINTEGRATED'),
j AS (SELECT coalesce(grp, 'UNGROUPED') AS code, stratum, sample, value, r.code AS member
      FROM {feature_table} AS r LEFT JOIN m ON r.code = m.code)
"""


@query(
    "regroup",
    REGROUP + "SELECT code, stratum, sample, sum(value) AS value FROM j GROUP BY code, stratum, sample",
)
def regroup(v):
    return t.regroup(v["feature_table"], _groups(v), ungrouped=True).drop("name")


@query(
    "regroup_mean",
    REGROUP
    + """, n AS (SELECT code, stratum, count(DISTINCT member) AS members FROM j GROUP BY code, stratum)
SELECT j.code, j.stratum, sample, round_even(sum(value) / min(members), 2) AS value
FROM j JOIN n ON j.code = n.code AND j.stratum IS NOT DISTINCT FROM n.stratum
WHERE j.code <> 'UNGROUPED'
GROUP BY j.code, j.stratum, sample
""",
)
def regroup_mean(v):
    return t.regroup(v["feature_table"], _groups(v), "mean", precision=2).drop("name")


@query(
    "regroup_report",
    """
WITH c AS (SELECT DISTINCT code FROM {feature_table}),
n AS (SELECT c.code, count(grp) AS times FROM c LEFT JOIN {groups} AS m ON c.code = m.code GROUP BY c.code)
SELECT count(*) AS features, count(*) FILTER (WHERE times >= 1) AS grouped,
       count(*) FILTER (WHERE times >= 2) AS grouped_twice FROM n
""",
)
def regroup_report(v):
    return t.regroup_report(v["feature_table"], _groups(v))


def _reduced(function: str) -> str:
    samples = "(SELECT count(DISTINCT sample) FROM {strain_table})"
    value = {
        "sum": "sum(value)",
        "mean": f"round(sum(value) / {samples}, 6)",
        "max": f"CASE WHEN count(*) < {samples} THEN greatest(max(value), 0) ELSE max(value) END",
        "min": f"CASE WHEN count(*) < {samples} THEN least(min(value), 0) ELSE min(value) END",
    }[function]
    return f"SELECT code, stratum, {value} AS value FROM {{strain_table}} GROUP BY code, stratum"


def _reduce_query(function: str):
    @query(f"reduce_table_{function}", _reduced(function))
    def reduced(v):
        out = t.reduce_table(v["strain_table"], function).drop("name")
        return out.withColumn("value", F.round("value", 6)) if function == "mean" else out


for _function in ("sum", "mean", "min", "max"):
    _reduce_query(_function)


@query(
    "max_profile",
    """
SELECT n_name AS clade, max(value) AS abundance
FROM (SELECT n_name, p_brand, sum(l_quantity) AS value FROM {shipped} GROUP BY n_name, p_brand) AS p GROUP BY n_name
""",
)
def max_profile(v):
    profile = v["shipped"].groupBy(F.col("n_name").alias("clade"), "p_brand").agg(F.sum("l_quantity").alias("abundance"))
    return t.max_profile(profile)


@query(
    "to_genus_level",
    """
SELECT code, split_part(stratum, '.', 1) AS stratum, sample, sum(value) AS value
FROM {feature_table} GROUP BY code, split_part(stratum, '.', 1), sample
""",
)
def to_genus_level(v):
    return t.to_genus_level(v["feature_table"]).drop("name")


JOINED = """
SELECT code, stratum, sample, sum(value) AS value FROM (
  SELECT code, stratum, concat('o', sample) AS sample, value FROM {rna}
  UNION ALL SELECT code, stratum, concat('f', sample), value FROM {dna}
  UNION ALL SELECT code, stratum, concat('f', sample), value FROM {dna} WHERE sample > '1998') AS u
GROUP BY code, stratum, sample
"""


def _prefixed(df, prefix):
    return df.withColumn("sample", F.concat(F.lit(prefix), "sample"))


def _three(v):
    dna = v["dna"]
    return [_prefixed(v["rna"], "o"), _prefixed(dna, "f"), _prefixed(dna.where("sample > '1998'"), "f")]


@query("join_tables", JOINED)
def join_tables(v):
    return t.join_tables(_three(v)).drop("name")


DENSE = """
WITH cells AS ({cells}),
f AS (SELECT DISTINCT code, stratum FROM cells), s AS (SELECT DISTINCT sample FROM cells)
SELECT f.code, f.stratum, s.sample, coalesce(c.value, 0) AS value
FROM f CROSS JOIN s LEFT JOIN cells AS c
  ON c.code = f.code AND c.stratum IS NOT DISTINCT FROM f.stratum AND c.sample = s.sample
"""


@query("join_tables_dense", DENSE.replace("{cells}", JOINED))
def join_tables_dense(v):
    return t.join_tables(_three(v), dense=True).drop("name")


@query(
    "join_tables_source",
    "SELECT code, source AS sample, sum(value) AS value FROM (SELECT code, value, 'o' AS source FROM {rna} "
    "UNION ALL SELECT code, value, 'f' FROM {dna}) AS u GROUP BY code, source",
)
def join_tables_source(v):
    tables = []
    for name, source in (("rna", "o"), ("dna", "f")):
        one = v[name].withColumns({"sample": F.lit("abundance"), "stratum": F.lit(None).cast("string")})
        tables.append(one.withColumn("source", F.lit(source)))
    return t.join_tables(tables).drop("name", "stratum")


@query(
    "stack_samples",
    "SELECT code, sample, value, CAST(NULL AS DOUBLE) AS scale FROM {rna} "
    "UNION ALL SELECT code, sample, value, 2.0::DOUBLE FROM {dna}",
)
def stack_samples(v):
    rna, dna = v["rna"].select("code", "sample", "value"), v["dna"].select("code", "sample", "value")
    return t.stack_samples([rna, dna.withColumn("scale", F.lit(2.0))])


@query("feature_union", "SELECT code, stratum FROM {rna} UNION SELECT code, stratum FROM {dna}")
def feature_union(v):
    return t.feature_union(v["rna"], v["dna"]).drop("name")


@query(
    "rename_features",
    """
WITH n AS (SELECT key, string_agg(value, ';' ORDER BY value) AS name FROM {brand_names} GROUP BY key)
SELECT code, CASE WHEN code IN ('UNMAPPED', 'UNINTEGRATED') THEN NULL ELSE coalesce(n.name, 'NO_NAME') END AS name,
       stratum, sample, value
FROM {feature_table} AS r LEFT JOIN n ON r.code = n.key
""",
)
def rename_features(v):
    return t.rename_features(v["feature_table"], v["brand_names"])


@query(
    "attach_names",
    """
SELECT code, stratum, sample, CASE WHEN name IS NULL THEN code ELSE concat(code, ': ', name) END AS label
FROM (SELECT code, stratum, sample FROM {feature_table}) AS r
LEFT JOIN (SELECT key, max(value) AS name FROM {brand_names} GROUP BY key) AS n ON r.code = n.key
""",
)
def attach_names(v):
    names = v["brand_names"].groupBy(F.col("key").alias("id")).agg(F.max("value").alias("name"))
    return t.attach_names(v["feature_table"], names).select("code", "stratum", "sample", "label")


@query(
    "expand_cluster",
    """
SELECT code, stratum, sample, value FROM {feature_table} WHERE code IN (
  SELECT value FROM {clusters} WHERE key IN (SELECT key FROM {clusters} WHERE value = 'Brand#7'))
""",
)
def expand_cluster(v):
    return t.expand_cluster(v["feature_table"], v["clusters"], ["Brand#7"]).drop("name")


@query(
    "rebuild_totals",
    """
SELECT code, stratum, sample, value FROM {rna}
UNION ALL SELECT code, NULL, sample, sum(value) FROM {rna} GROUP BY code, sample
""",
)
def rebuild_totals(v):
    return t.rebuild_totals(v["rna"]).drop("name")


@query(
    "paired_tables",
    """
SELECT coalesce(r.code, d.code) AS code, coalesce(r.stratum, d.stratum) AS stratum,
       coalesce(r.sample, d.sample) AS sample, coalesce(r.value, 0) AS rna, coalesce(d.value, 0) AS dna
FROM {rna} AS r FULL JOIN {dna} AS d ON r.code = d.code AND r.stratum = d.stratum AND r.sample = d.sample
""",
)
def paired_tables(v):
    return t.paired_tables(v["rna"], v["dna"]).drop("name")


def _grid(table: str) -> str:
    return f"""
f AS (SELECT code FROM {{rna_community}} UNION SELECT code FROM {{dna_community}}),
s AS (SELECT DISTINCT sample FROM {{{table}}}),
g AS (SELECT f.code, s.sample, coalesce(c.value, 0) AS value FROM f CROSS JOIN s
      LEFT JOIN {{{table}}} AS c ON c.code = f.code AND c.sample = s.sample)"""


LAPLACE = """
a AS (SELECT sample, min(value) AS alpha FROM {%s} WHERE value > 0 GROUP BY sample),
v AS (SELECT code, g.sample, value + alpha AS value, value > 0 AS seen, alpha AS absent FROM g JOIN a ON g.sample = a.sample)"""
WITTEN_BELL = """
a AS (SELECT sample, sum(value) AS n, count(*) FILTER (WHERE value > 0) AS t, (SELECT count(*) FROM f) AS k
      FROM {%s} GROUP BY sample),
v AS (SELECT code, g.sample, CASE WHEN value = 0 THEN CASE WHEN k > t THEN n / (n + t) * t / (k - t) ELSE 0 END
                                  ELSE value * n / (n + t) END AS value,
             value > 0 AS seen, CASE WHEN k > t THEN n / (n + t) * t / (k - t) ELSE 0 END AS absent
      FROM g JOIN a ON g.sample = a.sample)"""


def _smooth(method, table):
    """The full grid, with the value that the cells without a value have."""
    body = LAPLACE if method == "laplace" else WITTEN_BELL
    return f"WITH {_grid(table)}, {body % table} SELECT code, sample, value, seen, absent FROM v"


def _expression(method):
    rna, dna = _smooth(method, "rna_community"), _smooth(method, "dna_community")
    totals = {
        "laplace": "SELECT sample, sum(value) AS total FROM ({}) GROUP BY sample",
        "witten_bell": "SELECT sample, sum(value) AS total FROM {{{}}} GROUP BY sample",
    }[method]
    rt = totals.format(rna if method == "laplace" else "rna_community")
    dt = totals.format(dna if method == "laplace" else "dna_community")
    return f"""
WITH x AS (
    SELECT r.code, r.sample, r.seen OR d.seen AS seen, r.value / d.value * dt.total / rt.total AS value,
           r.absent / nullif(d.absent, 0) * dt.total / rt.total AS absent
    FROM ({rna}) AS r JOIN ({dna}) AS d ON r.code = d.code AND r.sample = d.sample
    JOIN ({rt}) AS rt ON rt.sample = r.sample JOIN ({dt}) AS dt ON dt.sample = d.sample)
SELECT code, sample, round(value, 6) AS value FROM x WHERE seen
UNION ALL SELECT NULL, sample, round(min(absent), 6) FROM x GROUP BY sample
"""


def _sparse(filled):
    """The real cells, and a row without a code for the other cells of each sample."""
    absent = filled.absent.select(F.lit(None).cast("string").alias("code"), "sample", "value")
    out = filled.cells.select("code", "sample", "value").unionByName(absent)
    return out.withColumn("value", F.round("value", 6))


def _smoothing_queries(method):
    grid = _smooth(method, "rna_community")

    @query(
        f"smooth_{method}",
        f"SELECT code, sample, round(value, 6) AS value FROM ({grid}) WHERE seen"
        f" UNION ALL SELECT NULL, sample, round(min(absent), 6) FROM ({grid}) GROUP BY sample",
    )
    def smooth(v):
        rna, dna = v["rna_community"], v["dna_community"]
        return _sparse(t.smooth(rna, t.feature_union(rna, dna), method))

    @query(f"smooth_{method}_full", f"SELECT code, sample, round(value, 6) AS value FROM ({grid})")
    def smooth_full(v):
        rna, dna = v["rna_community"], v["dna_community"]
        features = t.feature_union(rna, dna)
        out = t.fill_cells(t.smooth(rna, features, method), features)
        return out.select("code", "sample", F.round("value", 6).alias("value"))

    @query(f"relative_expression_{method}", _expression(method))
    def relative_expression(v):
        return _sparse(t.relative_expression(v["rna_community"], v["dna_community"], method))


for _method in ("laplace", "witten_bell"):
    _smoothing_queries(_method)


@query(
    "relative_expression_stratified",
    """
WITH f AS (SELECT code, stratum FROM {rna} UNION SELECT code, stratum FROM {dna}),
s AS (SELECT DISTINCT sample FROM {rna}),
ra AS (SELECT sample, min(value) AS alpha FROM {rna} GROUP BY sample),
da AS (SELECT sample, min(value) AS alpha FROM {dna} GROUP BY sample),
g AS (SELECT f.code, f.stratum, s.sample, coalesce(r.value, 0) + ra.alpha AS rna, coalesce(d.value, 0) + da.alpha AS dna,
             r.value IS NOT NULL OR d.value IS NOT NULL AS seen
      FROM f CROSS JOIN s
      LEFT JOIN {rna} AS r ON r.code = f.code AND r.stratum = f.stratum AND r.sample = s.sample
      LEFT JOIN {dna} AS d ON d.code = f.code AND d.stratum = f.stratum AND d.sample = s.sample
      JOIN ra ON ra.sample = s.sample JOIN da ON da.sample = s.sample),
t AS (SELECT sample, sum(dna) / sum(rna) AS scale FROM g GROUP BY sample),
h AS (SELECT code, stratum, sample, rna, dna FROM g WHERE seen
      UNION ALL SELECT code, NULL, sample, sum(rna), sum(dna) FROM g GROUP BY code, sample HAVING bool_or(seen))
SELECT code, stratum, h.sample, round(ln(scale * rna / dna) / ln(2), 6) AS value FROM h JOIN t ON h.sample = t.sample
""",
)
def relative_expression_stratified(v):
    out = t.relative_expression(v["rna"], v["dna"], stratified=True, log=True).cells
    return out.select("code", "stratum", "sample", F.round("value", 6).alias("value"))


@query(
    "strain_profiles",
    """
WITH r AS (SELECT *, split_part(stratum, '.', 2) AS species FROM {strain_table} WHERE stratum <> 'unclassified'),
s AS (SELECT species, sample FROM r WHERE value > 0 GROUP BY species, sample HAVING count(*) >= 3 AND avg(value) >= 25),
n AS (SELECT species, count(*) AS samples FROM s GROUP BY species HAVING count(*) >= 2),
c AS (SELECT r.species, code, stratum, r.sample, value, samples FROM r
      JOIN s ON r.species = s.species AND r.sample = s.sample JOIN n ON n.species = r.species),
p AS (SELECT species, code, count(*) FILTER (WHERE value > 0) / (1e-10::DOUBLE + min(samples)) AS prevalence
      FROM c GROUP BY species, code)
SELECT c.species, c.code, stratum, sample, value, round(prevalence, 6) AS prevalence FROM c
JOIN p ON c.species = p.species AND c.code = p.code WHERE prevalence BETWEEN 0.03 AND 0.5
""",
)
def strain_profiles(v):
    out = t.strain_profiles(v["strain_table"], min_mean=25, min_count=3, prevalence=(0.03, 0.5))
    return out.withColumn("prevalence", F.round("prevalence", 6)).drop("name")


LENSES["contribution_rows"] = """
SELECT p_brand AS Gene, ship_year AS Sample,
       CASE WHEN l_returnflag = 'N' AND p_size = 3 THEN 'n/a' ELSE CAST(l_quantity AS STRING) END AS CountContributedByOTU,
       'k__B' AS Kingdom, 'p__X' AS Phylum, concat('c__', l_linestatus) AS Class, 'o__' AS Order_, concat('f__', r_name) AS Family,
       concat('g__', n_name) AS Genus, CASE WHEN p_size > 30 THEN 's__' ELSE concat('s__', p_type) END AS Species
FROM {shipped}
"""


@query(
    "split_by_sample_rows",
    """
WITH r AS (SELECT Gene AS code, Sample AS sample, coalesce(TRY_CAST(CountContributedByOTU AS DOUBLE), 0) AS value,
  concat(Family, '.', Genus, '.', CASE WHEN Species = 's__' THEN 's__unclassified' ELSE Species END) AS stratum
  FROM {contribution_rows})
SELECT code, stratum, sample, sum(value) AS value FROM r GROUP BY GROUPING SETS ((code, stratum, sample), (code, sample))
""",
)
def split_by_sample_rows(v):
    ranks = ("Kingdom", "Phylum", "Class", "Order_", "Family", "Genus", "Species")
    return t.split_by_sample_rows(v["contribution_rows"], ranks, "Family").drop("name")


LENSES["wide_rows"] = """
SELECT p_brand AS id, SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS A,
       SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS N,
       SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS R,
       concat('k__B; f__', r_name, '; g__', n_name) AS taxonomy
FROM {shipped} GROUP BY p_brand, r_name, n_name
"""


@query(
    "split_by_sample_columns",
    """
SELECT concat('f__', r_name) AS feature, l_returnflag AS sample, sum(l_quantity) AS value
FROM {shipped} GROUP BY r_name, l_returnflag
""",
)
def split_by_sample_columns(v):
    return t.split_by_sample_columns(v["wide_rows"], "id", "taxonomy", 1)


UNPACK = """
WITH p AS (SELECT pathway AS pathway, bug, sum(score) AS value FROM {pathway_scores} GROUP BY pathway, bug),
m AS (SELECT DISTINCT pathway, gene FROM {pathway_reactions} AS pr JOIN {reaction_genes} AS rg ON pr.reaction = rg.reaction),
g AS (SELECT bug, gene, score AS value FROM {organism_genes})
"""


def _pathway_table(v):
    v.write("organism_genes")
    scores = v["pathway_scores"].groupBy("pathway", "bug").agg(F.sum("score").alias("value"))
    stratum = F.when(F.col("bug") != "all", F.col("bug"))
    none = F.lit(None).cast("string")
    pathways = scores.select(
        F.col("pathway").alias("code"), none.alias("name"), stratum.alias("stratum"), F.lit("s").alias("sample"), "value"
    )
    genes = v["organism_genes"].select(
        F.col("gene").alias("code"), none.alias("name"), stratum.alias("stratum"), F.lit("s").alias("sample"),
        F.col("score").alias("value"),
    )
    return pathways, genes, gene_pathways(v["reaction_genes"], v["pathway_reactions"])


@query(
    "unpack_pathways",
    UNPACK
    + """
SELECT pathway, NULL AS bug, NULL AS gene, value FROM p WHERE bug = 'all'
UNION ALL SELECT pathway, bug, NULL, value FROM p WHERE bug <> 'all'
UNION ALL SELECT p.pathway, p.bug, g.gene, g.value FROM p JOIN m ON p.pathway = m.pathway
  JOIN g ON g.bug = p.bug AND g.gene = m.gene WHERE p.bug <> 'all'
""",
)
def unpack_pathways(v):
    pathways, genes, members = _pathway_table(v)
    return t.unpack_pathways(pathways, genes, members).select("pathway", "bug", "gene", "value")


@query(
    "unpack_pathways_community",
    UNPACK
    + """
SELECT pathway, NULL AS gene, value FROM p WHERE bug = 'all'
UNION ALL SELECT p.pathway, g.gene, g.value FROM p JOIN m ON p.pathway = m.pathway
  JOIN g ON g.bug = p.bug AND g.gene = m.gene WHERE p.bug = 'all'
""",
)
def unpack_pathways_community(v):
    pathways, genes, members = _pathway_table(v)
    # the table holds genes, so the EC members that are given too are not used
    ecs = v["pathway_reactions"].join(v["reaction_genes"], "reaction").select("pathway", F.col("ec").alias("gene"))
    return t.unpack_pathways(pathways, genes, members, ecs, taxonomy=False).select("pathway", "gene", "value")


@query(
    "unpack_pathways_ec",
    """
WITH p AS (SELECT bug, pathway, sum(score) AS value FROM {pathway_scores} GROUP BY bug, pathway),
m AS (SELECT DISTINCT pathway, ec AS gene FROM {pathway_reactions} AS pr JOIN {reaction_genes} AS rg ON rg.reaction = pr.reaction),
g AS (SELECT o.bug, ec AS gene, sum(score) AS value FROM {organism_genes} AS o
      JOIN (SELECT DISTINCT gene, ec FROM {reaction_genes}) AS rg ON rg.gene = o.gene GROUP BY o.bug, ec)
SELECT pathway, NULL AS bug, NULL AS gene, value FROM p WHERE bug = 'all'
UNION ALL SELECT pathway, bug, NULL, value FROM p WHERE bug <> 'all'
UNION ALL SELECT p.pathway, p.bug, g.gene, g.value FROM p JOIN m ON p.pathway = m.pathway
  JOIN g ON g.bug = p.bug AND g.gene = m.gene WHERE p.bug <> 'all'
""",
)
def unpack_pathways_ec(v):
    """The table holds EC numbers, which are no genes of the map, so the EC members are taken."""
    v.write("organism_genes")
    pathways = v["pathway_scores"].groupBy("bug", F.col("pathway").alias("feature")).agg(F.sum("score").alias("value"))
    ecs = v["reaction_genes"].select("gene", "ec").distinct()
    genes = v["organism_genes"].join(ecs, "gene").groupBy("bug", F.col("ec").alias("feature")).agg(F.sum("score").alias("value"))

    def one_sample(rows):
        stratum = F.when(F.col("bug") != "all", F.col("bug"))
        none = F.lit(None).cast("string")
        return rows.select(F.col("feature").alias("code"), none.alias("name"), stratum.alias("stratum"), F.lit("s").alias("sample"), "value")

    members, ec_members = pathway_members(v["reaction_genes"], v["pathway_reactions"])
    out = t.unpack_pathways(one_sample(pathways), one_sample(genes), members, ec_members)
    return out.select("pathway", "bug", "gene", "value")


@query(
    "pathway_members",
    """
WITH e AS (SELECT pathway, gene, string_split(concat(ec, ',', '2.', ec), ',') AS ecs FROM {pathway_reactions} AS p
           JOIN {reaction_genes} AS r ON r.reaction = p.reaction)
SELECT DISTINCT 'gene' AS kind, pathway, gene FROM e
UNION ALL SELECT DISTINCT 'ec', pathway, unnest(ecs) FROM e
""",
)
def members(v):
    reactions = v["reaction_genes"].withColumn("ec", F.concat("ec", F.lit(",2."), "ec"))
    genes, ecs = pathway_members(reactions, v["pathway_reactions"])
    return genes.withColumn("kind", F.lit("gene")).unionByName(ecs.withColumn("kind", F.lit("ec")))


@query(
    "build_gene_map",
    """
WITH e AS (SELECT concat('ORG', CAST(p_size AS VARCHAR), ':G', CAST(p_partkey AS VARCHAR)) AS k, max(p_brand) AS ortholog
           FROM part WHERE p_type <> 'PROMO' GROUP BY 1)
SELECT concat('org', CAST(p_size AS VARCHAR), ':g', CAST(p_partkey AS VARCHAR)) AS reference, ortholog AS gene,
       p_size * 3 AS length,
       CASE WHEN p_size < 25 THEN concat('Organism ', CAST(p_size AS VARCHAR)) ELSE concat('org', CAST(p_size AS VARCHAR)) END AS bug
FROM part JOIN e ON e.k = concat('ORG', CAST(p_size AS VARCHAR), ':G', CAST(p_partkey AS VARCHAR))
""",
)
def build_gene_map(v):
    part = v["part"]
    organism = F.concat(F.lit("org"), "p_size")
    entries = part.where("p_type <> 'PROMO'").select(
        F.col("p_brand").alias("ortholog"),
        F.array(F.upper(F.concat(organism, F.lit("#g"), "p_partkey"))).alias("entries"),
    )
    lengths = part.select(
        organism.alias("organism"), F.concat(F.lit("g"), "p_partkey").alias("gene"), F.col("p_size").alias("length_aa")
    )
    organisms = part.where("p_size < 25").select(
        organism.alias("organism"), F.concat(F.lit("Organism "), "p_size").alias("name")
    ).distinct()
    return t.build_gene_map(entries, lengths, organisms)


@query(
    "double_sort",
    """
SELECT l_partkey AS gene, sum(l_quantity) AS value,
       row_number() OVER (ORDER BY sum(l_quantity) DESC, l_partkey) AS position
FROM lineitem GROUP BY l_partkey
""",
)
def double_sort(v):
    sums = v["lineitem"].groupBy(F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").alias("value"))
    return o.double_sort(sums, "value", "gene")


@query(
    "profile_order",
    """
WITH c AS (SELECT code, sample, value AS community FROM {feature_table} WHERE stratum IS NULL)
SELECT f.code, f.stratum, f.sample, value,
       row_number() OVER (PARTITION BY f.sample ORDER BY CASE f.code WHEN 'UNMAPPED' THEN 0 WHEN 'UNINTEGRATED' THEN 1 ELSE 2 END,
         community DESC, f.code, CASE WHEN stratum IS NULL THEN 1 ELSE 2 END, value DESC, stratum) AS position
FROM {feature_table} AS f JOIN c ON f.code = c.code AND f.sample = c.sample
""",
)
def profile_order(v):
    return o.profile_order(v["feature_table"], special=("UNMAPPED", "UNINTEGRATED")).drop("name")


@query(
    "sort_by",
    """
SELECT code, stratum, value, row_number() OVER (ORDER BY CASE WHEN stratum IS NULL THEN 1 ELSE 2 END,
         concat(code, CASE WHEN stratum IS NULL THEN '' ELSE concat('|', stratum) END)) AS by_level,
       row_number() OVER (ORDER BY value DESC, concat(code, CASE WHEN stratum IS NULL THEN '' ELSE concat('|', stratum) END)) AS by_value
FROM (SELECT code, stratum, max(value) AS value FROM {feature_table} GROUP BY code, stratum) AS r
""",
)
def sort_by(v):
    from abundix.operators.scaling import sorted_position

    reduced = t.reduce_table(v["feature_table"], "max")
    feature = ft.join_feature()
    level = sorted_position(reduced, o._SORTS["level"](feature), name="by_level")
    return sorted_position(level, o._SORTS["value"](feature), name="by_value").drop("name")


@query(
    "feature_sort",
    """
SELECT code, stratum, row_number() OVER (ORDER BY CASE code WHEN 'UNMAPPED' THEN 0 WHEN 'UNINTEGRATED' THEN 2 ELSE 5 END,
         code, stratum NULLS FIRST) AS position
FROM (SELECT DISTINCT code, stratum FROM {feature_table}) AS r
""",
)
def feature_sort(v):
    from abundix.operators.scaling import sorted_position

    features = v["feature_table"].select("code", "name", "stratum").distinct()
    return sorted_position(features, o.feature_sort_keys()).drop("name")


@query(
    "significant_digits",
    """
SELECT code, stratum, sample, CAST(format('{{:.5e}}', value / 7) AS DOUBLE) AS value FROM {feature_table}
""",
)
def significant_digits(v):
    return v["feature_table"].select("code", "stratum", "sample", ft.significant(F.col("value") / 7).alias("value"))
