"""Taxonomy trees, profiles, clades and genera."""

from pyspark.sql import functions as F

from abundix.operators import taxonomy as tx
from oracle_queries.registry import LENSES, query

LINEAGE = """
WITH RECURSIVE climb(taxid, step, ancestor) AS (
  SELECT taxid, 0, taxid FROM {taxonomy} WHERE taxid <> 'Root'
  UNION ALL
  SELECT c.taxid, step + 1, t.parent FROM climb AS c JOIN {taxonomy} AS t ON t.taxid = c.ancestor
  WHERE t.parent <> 'Root')
"""


@query(
    "lineage",
    LINEAGE
    + "SELECT c.taxid, step, ancestor, rank, name FROM climb AS c JOIN {taxonomy} AS t ON t.taxid = c.ancestor",
)
def lineage(v):
    return tx.lineage(v["taxonomy"], v["taxonomy"])


FAMILY = (
    LINEAGE
    + """, fam AS (SELECT c.taxid, concat('f__', regexp_replace(name, '[^A-Za-z0-9]+', '_', 'g')) AS taxon
       FROM climb AS c JOIN {taxonomy} AS t ON t.taxid = c.ancestor WHERE rank = 'Family')
"""
)


@query("taxon_at_rank", FAMILY + "SELECT taxid, taxon FROM fam")
def taxon_at_rank(v):
    return tx.taxon_at_rank(v["taxonomy"], v["taxonomy"], "Family")


PREORDER = """
WITH RECURSIVE walk AS (
  SELECT taxid, [taxid] AS path FROM {taxonomy} WHERE parent = 'Root'
  UNION ALL
  SELECT t.taxid, list_append(path, t.taxid) FROM walk JOIN {taxonomy} AS t ON t.parent = walk.taxid),
numbered AS (SELECT taxid, path, row_number() OVER (ORDER BY path) AS enter FROM walk),
sizes AS (SELECT a AS taxid, count(*) AS size FROM (SELECT unnest(path) AS a FROM walk) AS every GROUP BY a)
"""


@query(
    "subtree_intervals",
    PREORDER + "SELECT n.taxid, enter, enter + size - 1 AS leave FROM numbered AS n JOIN sizes AS s ON s.taxid = n.taxid",
)
def subtree_intervals(v):
    return tx.subtree_intervals(v["taxonomy"])


@query("below", PREORDER + "SELECT family, lca FROM {family_lca} JOIN walk ON walk.taxid = lca WHERE list_contains(path, 'r2')")
def below(v):
    """Gene families whose lowest common ancestor lies in one region."""
    return tx.below(v["family_lca"], v["taxonomy"], "r2", taxid="lca").select("family", "lca")


LENSES["genus_names"] = """
SELECT concat('n', CAST(n_nationkey AS STRING)) AS taxid,
       CASE WHEN n_nationkey < 4 THEN 'Twin' ELSE n_name END AS name, 'Genus' AS rank, 'Root' AS parent FROM {nation}
"""


@query(
    "unique_genera",
    "SELECT name AS genus, min(taxid) AS taxid FROM {genus_names} GROUP BY name HAVING count(*) = 1",
)
def unique_genera(v):
    return tx.unique_genera(v["genus_names"])


MAP = (
    FAMILY
    + """, keyed AS (SELECT family AS key, lca AS taxid FROM {family_lca}
       WHERE family IN (SELECT code FROM {family_table})
  UNION ALL SELECT DISTINCT stratum, taxid FROM {family_table}
       JOIN {taxonomy} AS tree ON rank = 'Genus' AND stratum LIKE 'g\\_\\_%' ESCAPE '\\' AND split_part(stratum, '.', 1) = concat('g__', tree.name)),
map AS (SELECT key, taxon FROM keyed JOIN fam ON fam.taxid = keyed.taxid)
"""
)


def _map(v):
    return tx.taxon_map(v["family_table"], v["taxonomy"], v["family_lca"])


@query("taxon_map", MAP + "SELECT key, taxon FROM map")
def taxon_map(v):
    return _map(v)


@query(
    "taxon_map_genus",
    LINEAGE
    + """, gen AS (SELECT c.taxid, concat('g__', regexp_replace(name, '[^A-Za-z0-9]+', '_', 'g')) AS taxon
       FROM climb AS c JOIN {taxonomy} AS t ON t.taxid = c.ancestor WHERE rank = 'Genus')
SELECT family AS key, taxon FROM {family_lca} JOIN gen ON gen.taxid = lca WHERE family IN (SELECT code FROM {family_table})
UNION ALL SELECT DISTINCT stratum, split_part(stratum, '.', 1) FROM {family_table} WHERE contains(stratum, 'g__')
""",
)
def taxon_map_genus(v):
    return tx.taxon_map(v["family_table"], v["taxonomy"], v["family_lca"], "Genus")


COMMON = MAP + """, kept AS (SELECT key, taxon FROM map WHERE taxon IN (
  SELECT taxon FROM map GROUP BY taxon HAVING count(*) / (SELECT count(*) FROM map) >= 0.1))
"""


@query("drop_rare_taxa", COMMON + "SELECT key, taxon FROM kept")
def drop_rare_taxa(v):
    return tx.drop_rare_taxa(_map(v), 0.1)


ROWS = COMMON + """, r AS (SELECT t.code, t.stratum, t.sample, t.value, coalesce(k.taxon, 'unclassified') AS taxon
  FROM {family_table} AS t
  LEFT JOIN kept AS k ON k.key = CASE WHEN t.stratum IS NULL OR t.stratum = 'unclassified' THEN t.code ELSE t.stratum END)
"""
MODES = {
    "totals": """
SELECT code, stratum, sample, value FROM r WHERE stratum IS NULL
UNION ALL SELECT code, taxon, sample, value FROM r WHERE stratum IS NULL AND code <> 'UNMAPPED'
""",
    "stratified": """
SELECT code, CASE WHEN stratum IS NOT NULL THEN taxon END AS stratum, sample, sum(value) AS value FROM r
GROUP BY code, CASE WHEN stratum IS NOT NULL THEN taxon END, sample
""",
    "unclassified": """
SELECT code, NULL AS stratum, sample, value FROM r WHERE stratum = 'unclassified' OR code = 'UNMAPPED'
UNION ALL SELECT code, taxon, sample, value FROM r WHERE stratum = 'unclassified'
""",
}


def _mode_query(mode):
    @query(f"infer_taxonomy_{mode}", ROWS + MODES[mode])
    def infer(v):
        return tx.infer_taxonomy(v["family_table"], _map(v), mode, 0.1).drop("name")


for _mode in MODES:
    _mode_query(_mode)


@query(
    "infer_taxonomy_report",
    ROWS
    + f""", o AS (SELECT DISTINCT code, stratum FROM ({MODES['totals']}) AS m WHERE stratum IS NOT NULL)
SELECT count(*) AS strata, count(*) FILTER (WHERE stratum <> 'unclassified') AS resolved,
       round(100.0::DOUBLE * count(*) FILTER (WHERE stratum <> 'unclassified') / count(*), 6) AS percent FROM o
""",
)
def infer_taxonomy_report(v):
    table = tx.infer_taxonomy(v["family_table"], _map(v), "totals", 0.1)
    return tx.infer_taxonomy_report(table).withColumn("percent", F.round("percent", 6))


LENSES["species_tree"] = """
SELECT '1' AS taxid, 'root' AS name, 'no rank' AS rank, '0' AS parent
UNION ALL SELECT '131567', 'cells', 'domain', '1'
UNION ALL SELECT concat('r', CAST(r_regionkey AS STRING)), r_name, 'family', '131567' FROM {region}
UNION ALL SELECT concat('n', CAST(n_nationkey AS STRING)), concat('genus ', n_name),
                 CASE WHEN n_nationkey < 5 THEN 'no rank' ELSE 'genus' END, concat('r', CAST(n_regionkey AS STRING)) FROM {nation}
UNION ALL SELECT concat('s', CAST(s_suppkey AS STRING)), s_name, 'species', concat('n', CAST(s_nationkey AS STRING))
          FROM {supplier} WHERE s_suppkey <> 5
"""
LENSES["species_table"] = """
SELECT p_brand AS code, CAST(NULL AS STRING) AS name,
       CASE WHEN l_returnflag = 'N' THEN 'unclassified' ELSE concat('g__X.s__', s_name) END AS stratum,
       l_linestatus AS sample, SUM(l_quantity) AS value
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
GROUP BY GROUPING SETS ((p_brand, l_returnflag, s_name, l_linestatus))
"""


@query(
    "expand_lineage",
    """
WITH named AS (SELECT concat('g__X.s__', s_name) AS stratum, s_name,
  CASE WHEN s_suppkey <> 5 THEN concat('family__', r_name,
       CASE WHEN n_nationkey < 5 THEN '' ELSE concat('|genus__genus ', n_name) END, '|species__', s_name) ELSE s_name END AS label
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT code, CASE WHEN t.stratum = 'unclassified' THEN t.stratum ELSE label END AS stratum, sample, value
FROM {species_table} AS t LEFT JOIN named ON named.stratum = t.stratum
""",
)
def expand_lineage(v):
    return tx.expand_lineage(v["species_table"], v["species_tree"]).drop("name")


SELECTED = """
SELECT clade, abundance, concat('SGB', split_part(clade, 't__SGB', 2)) AS clade_id,
       split_part(clade, '|', 3) AS species
FROM {profile} WHERE contains(clade, 't__') AND coverage * 2 >= 1.5
"""


@query("select_clades", SELECTED)
def select_clades(v):
    return tx.select_clades(v["profile"], 2, 1.5).drop("coverage")


@query(
    "clade_report",
    f"SELECT count(*) AS clades, round(sum(abundance), 4) AS abundance FROM ({SELECTED})",
)
def clade_report(v):
    out = tx.clade_report(tx.select_clades(v["profile"], 2, 1.5))
    return out.withColumn("abundance", F.round("abundance", 4))


@query(
    "select_genera",
    "SELECT DISTINCT lower(regexp_extract(clade, 'g__([^|]*)', 1)) AS genus FROM {profile} WHERE abundance >= 30",
)
def select_genera(v):
    return tx.select_genera(v["profile"], 30)


LENSES["pangenome_files"] = """
SELECT concat(lower(n_name), '__SGB', CAST(s_suppkey AS STRING), '_', r_name, '_v3.fna') AS file
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""


@query(
    "select_pangenomes",
    f"""
SELECT DISTINCT file FROM {{pangenome_files}} JOIN ({SELECTED}) AS s
ON contains(lower(file), concat(lower(s.clade_id), '_'))
""",
)
def select_pangenomes(v):
    return tx.select_pangenomes(v["pangenome_files"], tx.select_clades(v["profile"], 2, 1.5))


LENSES["sequence_headers"] = """
SELECT CAST(p_partkey AS STRING) AS id, concat(CAST(p_partkey AS STRING), ' ', upper(p_name), ' ', p_type) AS header
FROM {part}
"""
LENSES["sequence_taxa"] = """
SELECT CAST(p_partkey AS STRING) AS reference, concat(p_brand, ' of ', p_type) AS bug FROM {part} WHERE p_partkey <> 10
"""
LENSES["wanted_genera"] = """
SELECT split_part(p_name, ' ', 1) AS genus FROM {part} GROUP BY split_part(p_name, ' ', 1) HAVING avg(p_size) > 25.5
UNION SELECT 'large'
"""


@query(
    "filter_sequences",
    """
SELECT id, header FROM {sequence_headers} AS s WHERE EXISTS (
  SELECT 1 FROM {wanted_genera} AS g WHERE list_contains(string_split(lower(header), ' '), g.genus))
""",
)
def filter_sequences(v):
    return tx.filter_sequences(v["sequence_headers"], v["wanted_genera"])


@query(
    "filter_sequences_mapped",
    """
SELECT id, header FROM {sequence_headers} AS s LEFT JOIN {sequence_taxa} AS t ON t.reference = s.id WHERE EXISTS (
  SELECT 1 FROM {wanted_genera} AS g WHERE list_contains(string_split(lower(coalesce(bug, header)), ' '), g.genus))
""",
)
def filter_sequences_mapped(v):
    return tx.filter_sequences(v["sequence_headers"], v["wanted_genera"], v["sequence_taxa"])
