"""Operator inputs as views of the given tables."""

from oracle_queries.registry import LENSES

# alignments: an order is a read, its parts are the genes it hits, suppliers the organisms
LENSES["hits"] = """
SELECT CAST(l_orderkey AS STRING) AS query,
       concat('g', CAST(l_partkey AS STRING)) AS gene,
       concat('b', CAST(l_suppkey AS STRING)) AS bug,
       l_quantity AS matches,
       p_size * 100 AS gene_length,
       l_quantity AS aligned_length,
       CAST(100 - 5 * l_linenumber AS DOUBLE) AS identity,
       l_tax AS evalue,
       l_linenumber AS q_start,
       CAST(l_linenumber + l_quantity AS INT) AS q_end,
       60 AS q_length,
       CAST((l_partkey * 7 + l_linenumber * 13) % 3000 AS INT) AS s_start,
       CAST((l_partkey * 7 + l_linenumber * 13) % 3000 + l_quantity AS INT) AS s_end
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

# few long genes with many hits each; some intervals are empty or reversed
LENSES["intervals"] = """
SELECT concat('g', CAST(l_suppkey AS STRING)) AS gene,
       90000 AS gene_length,
       CAST((l_partkey * 37 + l_linenumber * 1009) % 30000 AS INT) AS s_start,
       CAST((l_partkey * 37 + l_linenumber * 1009) % 30000 + l_quantity - 3 AS INT) AS s_end
FROM {lineitem}
"""

LENSES["shipped"] = """
SELECT l_quantity, l_returnflag, l_linestatus, l_orderkey,
       CAST(year(l_shipdate) AS STRING) AS ship_year,
       p_partkey, p_name, p_brand, p_type, p_size,
       s_nationkey, n_name, r_name,
       CASE WHEN s_nationkey = 0 THEN 'unclassified'
            ELSE concat('g__', r_name, '.s__', n_name) END AS taxon
FROM {lineitem}
JOIN {part} ON l_partkey = p_partkey
JOIN {supplier} ON l_suppkey = s_suppkey
JOIN {nation} ON s_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
"""

# feature table with community rows (null stratum) and strata
LENSES["feature_table"] = """
SELECT code, CAST(NULL AS STRING) AS name, stratum, sample, SUM(l_quantity) AS value
FROM (SELECT CASE WHEN p_size = 1 THEN 'UNMAPPED' WHEN p_size = 2 THEN 'UNINTEGRATED'
                  ELSE p_brand END AS code,
             taxon AS stratum,
             concat(l_returnflag, l_linestatus, '-', ship_year) AS sample,
             l_quantity
      FROM {shipped}) AS rows
GROUP BY GROUPING SETS ((code, stratum, sample), (code, sample))
"""

# sparse one-sample-per-year tables whose features differ
LENSES["rna"] = """
SELECT concat(p_brand, '/', CAST(p_size AS STRING)) AS code, CAST(NULL AS STRING) AS name,
       concat('g__', r_name) AS stratum, ship_year AS sample, SUM(l_quantity) AS value
FROM {shipped} WHERE l_linestatus = 'O' AND p_size < 45
GROUP BY GROUPING SETS ((p_brand, p_size, r_name, ship_year))
"""
LENSES["dna"] = """
SELECT concat(p_brand, '/', CAST(p_size AS STRING)) AS code, CAST(NULL AS STRING) AS name,
       concat('g__', r_name) AS stratum, ship_year AS sample, SUM(l_quantity) AS value
FROM {shipped} WHERE l_linestatus = 'F' AND p_size > 5
GROUP BY GROUPING SETS ((p_brand, p_size, r_name, ship_year))
"""
for _kind in ("rna", "dna"):
    LENSES[f"{_kind}_community"] = (
        "SELECT code, CAST(NULL AS STRING) AS name, CAST(NULL AS STRING) AS stratum, sample, SUM(value) AS value "
        f"FROM {{{_kind}}} GROUP BY code, sample"
    )

# genes, reactions and pathways: parts, type and size bucket, brands
LENSES["reaction_genes"] = """
SELECT concat(p_type, '-', CAST(p_size % 10 AS STRING)) AS reaction,
       concat('1.1.', CAST(p_size AS STRING)) AS ec,
       concat('g', CAST(p_partkey AS STRING)) AS gene
FROM {part} WHERE p_size <> 7
UNION ALL
SELECT concat(p_type, '-', CAST(p_size % 10 AS STRING)) AS reaction,
       concat('1.1.', CAST(p_size AS STRING)) AS ec,
       concat('g', CAST(p_partkey AS STRING)) AS gene
FROM {part} WHERE p_size > 40
"""
LENSES["pathway_reactions"] = """
SELECT DISTINCT concat(p_brand, '.', CAST(p_size AS STRING)) AS pathway, concat(p_type, '-', CAST(p_size % 10 AS STRING)) AS reaction
FROM {part}
"""
LENSES["organism_genes"] = """
SELECT CASE WHEN grouping(n_name) = 1 THEN 'all' ELSE n_name END AS bug,
       concat('g', CAST(p_partkey AS STRING)) AS gene, SUM(l_quantity) AS score
FROM {shipped}
GROUP BY GROUPING SETS ((n_name, p_partkey), (p_partkey))
"""
LENSES["reaction_scores"] = """
SELECT bug, reaction, SUM(score) AS score
FROM {organism_genes} AS o JOIN {reaction_genes} AS r ON o.gene = r.gene
GROUP BY bug, reaction
"""
LENSES["pathway_scores"] = """
SELECT s.bug, p.pathway, s.reaction, s.score
FROM {reaction_scores} AS s JOIN {pathway_reactions} AS p ON s.reaction = p.reaction
"""

# finer reactions, of which a supplier's parts show most but not all
LENSES["fine_reaction_genes"] = """
SELECT concat(p_type, '-', CAST(p_size AS STRING)) AS reaction, concat('g', CAST(p_partkey AS STRING)) AS gene FROM {part}
"""
LENSES["fine_pathways"] = """
SELECT DISTINCT p_brand AS pathway, concat(p_type, '-', CAST(p_size AS STRING)) AS reaction FROM {part}
"""
LENSES["observed_reactions"] = """
SELECT s_name AS bug, concat(p_type, '-', CAST(p_size AS STRING)) AS reaction, SUM(l_quantity) AS score
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
GROUP BY s_name, p_type, p_size
"""

# one tree per brand: a b ( c , d ) ( e + -f ), a reaction of each part type
LENSES["pathway_parts"] = """
SELECT pathway,
       coalesce(max_by(reaction, part) FILTER (WHERE type = 'ECONOMY'), 'none-a') AS a,
       coalesce(max_by(reaction, part) FILTER (WHERE type = 'LARGE'), 'none-b') AS b,
       coalesce(max_by(reaction, part) FILTER (WHERE type = 'MEDIUM'), 'none-c') AS c,
       coalesce(max_by(reaction, part) FILTER (WHERE type = 'PROMO'), 'none-d') AS d,
       coalesce(max_by(reaction, part) FILTER (WHERE type = 'SMALL'), 'none-e') AS e,
       coalesce(max_by(reaction, part) FILTER (WHERE type = 'STANDARD'), 'none-f') AS f
FROM (SELECT p_brand AS pathway, p_partkey AS part, p_type AS type,
             concat(p_type, '-', CAST(p_size AS STRING)) AS reaction FROM {part}) AS parts
GROUP BY pathway
"""
LENSES["pathway_structures"] = """
SELECT pathway, concat(a, ' ', b, ' ( ', c, ' , ', d, ' ) ( ', e, ' + -', f, ' )') AS structure
FROM {pathway_parts}
"""
LENSES["structured_members"] = """
SELECT pathway, a AS reaction, 'a' AS slot FROM {pathway_parts}
UNION ALL SELECT pathway, b, 'b' FROM {pathway_parts}
UNION ALL SELECT pathway, c, 'c' FROM {pathway_parts}
UNION ALL SELECT pathway, d, 'd' FROM {pathway_parts}
UNION ALL SELECT pathway, e, 'e' FROM {pathway_parts}
UNION ALL SELECT pathway, f, 'f' FROM {pathway_parts}
"""
LENSES["structured_scores"] = """
SELECT s.bug, m.pathway, s.reaction, s.score
FROM {observed_reactions} AS s JOIN {structured_members} AS m ON s.reaction = m.reaction
"""

# taxonomy: region -> nation -> supplier
LENSES["taxonomy"] = """
SELECT 'Root' AS taxid, 'Root' AS name, 'no rank' AS rank, CAST(NULL AS STRING) AS parent
UNION ALL SELECT concat('r', CAST(r_regionkey AS STRING)), r_name, 'Family', 'Root' FROM {region}
UNION ALL SELECT concat('n', CAST(n_nationkey AS STRING)), n_name, 'Genus',
                 concat('r', CAST(n_regionkey AS STRING)) FROM {nation}
UNION ALL SELECT concat('s', CAST(s_suppkey AS STRING)), s_name, 'Species',
                 concat('n', CAST(s_nationkey AS STRING)) FROM {supplier}
"""
LENSES["family_lca"] = """
SELECT concat('UniRef90_', CAST(l_partkey AS STRING)) AS family,
       CASE WHEN count(DISTINCT s_nationkey) = 1 THEN concat('n', CAST(min(s_nationkey) AS STRING))
            WHEN min(l_suppkey) < 3 THEN 'Root'
            ELSE concat('s', CAST(min(l_suppkey) AS STRING)) END AS lca
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
GROUP BY l_partkey
"""
LENSES["family_table"] = """
SELECT concat('UniRef90_', CAST(p_partkey AS STRING)) AS code, CAST(NULL AS STRING) AS name,
       stratum, sample, SUM(l_quantity) AS value
FROM (SELECT p_partkey, l_quantity, l_returnflag AS sample,
             CASE WHEN l_linestatus = 'O' THEN 'unclassified'
                  ELSE concat('g__', n_name, '.s__', r_name) END AS stratum
      FROM {shipped}) AS rows
GROUP BY GROUPING SETS ((p_partkey, stratum, sample), (p_partkey, sample))
UNION ALL
SELECT 'UNMAPPED', CAST(NULL AS STRING), CAST(NULL AS STRING), l_returnflag, SUM(l_quantity)
FROM {lineitem} GROUP BY l_returnflag
"""
LENSES["profile"] = """
SELECT concat('k__Bacteria|g__', n_name, '|s__', s_name, '|t__SGB', CAST(s_suppkey AS STRING)) AS clade,
       s_acctbal / 100 AS abundance, CAST(s_nationkey AS DOUBLE) / 10 AS coverage
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
UNION ALL
SELECT concat('k__Bacteria|g__', n_name), CAST(n_regionkey AS DOUBLE) + 0.5, CAST(n_nationkey AS DOUBLE)
FROM {nation}
"""

# samples are customers
LENSES["customer_features"] = """
SELECT concat('orders ', o_orderpriority) AS feature, CAST(o_custkey AS STRING) AS sample,
       CAST(count(*) AS DOUBLE) AS value
FROM {orders} GROUP BY o_orderpriority, o_custkey
UNION ALL
SELECT concat('lines ', l_returnflag, l_linestatus), CAST(o_custkey AS STRING), SUM(l_quantity)
FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey GROUP BY l_returnflag, l_linestatus, o_custkey
UNION ALL
SELECT concat('spend ', o_orderstatus), CAST(o_custkey AS STRING),
       SUM(CASE WHEN o_totalprice > 100000 + 50 * c_acctbal THEN 1.0 ELSE 0.25 END)
FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY o_orderstatus, o_custkey
"""
LENSES["customer_balance"] = """
SELECT CAST(c_custkey AS STRING) AS sample, c_acctbal AS value FROM {customer}
"""
LENSES["customer_segment"] = """
SELECT CAST(c_custkey AS STRING) AS sample, c_mktsegment AS value FROM {customer}
"""

# species by month
LENSES["strain_table"] = """
SELECT concat(p_brand, '/', CAST(p_size AS STRING)) AS code, CAST(NULL AS STRING) AS name,
       taxon AS stratum,
       concat(CAST(year(o_orderdate) AS STRING), '-', CAST(month(o_orderdate) AS STRING)) AS sample,
       SUM(l_quantity) AS value
FROM {shipped} JOIN {orders} ON l_orderkey = o_orderkey
GROUP BY p_brand, p_size, taxon, year(o_orderdate), month(o_orderdate)
"""

# letters to bases; other characters are unknown
LENSES["genomes"] = """
SELECT doc_id, source,
       translate(lower(text), 'abcdefghijklmnopqrstuvwxyzß', 'ACGTACGTACGTACGTACGTACGTACN') AS bases
FROM {documents}
"""
