"""Alignments, references and gene scores."""

from pyspark.sql import functions as F

from abundix.functions import alignments as al, references as ref
from abundix.operators import hits as h
from abundix.operators.scaling import ordered_prefix
from abundix.session import scratch_path
from abundix.sources.stored import store_by_query
from oracle_queries.registry import query

REFERENCES = """
SELECT l_orderkey, l_linenumber,
       CASE l_linenumber
         WHEN 1 THEN concat('gi', CAST(l_partkey AS {S}), '|g__', r_name, '.s__', n_name, '|UniRef90_',
                            CAST(l_partkey AS {S}), '|UniRef50_', p_brand, '|', CAST(p_size AS {S}))
         WHEN 2 THEN concat('UniRef90_', CAST(l_partkey AS {S}), '|', CAST(p_size AS {S}), '|', n_name)
         WHEN 3 THEN concat('UniRef90_', CAST(l_partkey AS {S}), '|', CAST(p_size AS {S}))
         WHEN 4 THEN concat(CAST(p_size AS {S}), '|UniRef90_', CAST(l_partkey AS {S}))
         WHEN 5 THEN concat('gi', CAST(l_partkey AS {S}), '|SGB', CAST(l_suppkey AS {S}), '|UniRef90_',
                            CAST(l_partkey AS {S}), '|UniRef50_', p_brand, '|', CAST(p_size AS {S}))
         ELSE concat('gene', CAST(l_partkey AS {S})) END AS reference
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
""".replace("{S}", "STRING")

from oracle_queries.registry import LENSES  # noqa: E402

LENSES["references"] = REFERENCES
LENSES["clades"] = """
SELECT concat('SGB', CAST(s_suppkey AS STRING)) AS clade, concat('s__', n_name) AS species
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey WHERE n_regionkey <> 2
"""
LENSES["id_mapping"] = """
SELECT concat('g', CAST(p_partkey AS STRING)) AS reference, concat('mapped', CAST(p_size AS STRING)) AS gene,
       CASE WHEN p_size > 20 THEN p_size * 10 END AS length,
       CASE WHEN p_size < 40 THEN concat('o', CAST(p_size AS STRING)) END AS bug
FROM {part} WHERE p_type <> 'SMALL'
"""
# alignments as SAM fields
LENSES["sam_records"] = """
SELECT CAST(l_orderkey AS STRING) AS query, concat('g', CAST(l_suppkey AS STRING)) AS gene,
       l_linenumber = 7 AS unmapped,
       concat(CAST(l_linenumber AS STRING), 'S', CAST(CAST(l_quantity AS INT) AS STRING), 'M',
              CAST(l_linenumber AS STRING), 'I2D', CAST(l_linenumber * 10 AS STRING), '=3N') AS cigar,
       concat('MD:Z:', CAST(CAST(l_quantity AS INT) AS STRING), 'A', CAST(l_linenumber * 2 AS STRING), '^TT',
              CAST(CASE WHEN l_returnflag = 'A' THEN 6 ELSE 0 END AS STRING)) AS md,
       l_returnflag, l_quantity, l_linenumber,
       CAST((l_partkey * 7) % 800 AS INT) AS pos
FROM {lineitem}
"""


@query(
    "parse_reference",
    """
WITH p AS (SELECT *, string_split(reference, '|') AS f FROM {references})
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber IN (1, 5) THEN f[3] WHEN l_linenumber IN (2, 3) THEN f[1]
            WHEN l_linenumber = 4 THEN f[2] ELSE reference END AS gene,
       CAST(CASE WHEN l_linenumber IN (1, 5) THEN f[5] WHEN l_linenumber IN (2, 3) THEN f[2]
            WHEN l_linenumber = 4 THEN f[1] ELSE '0' END AS INTEGER) AS gene_length,
       CASE WHEN l_linenumber = 1 THEN f[2] WHEN l_linenumber = 2 THEN f[3]
            WHEN l_linenumber = 5 THEN concat(coalesce(c.species, 'unclassified'), '.t__', f[2])
            ELSE 'unclassified' END AS bug
FROM p LEFT JOIN {clades} AS c ON l_linenumber = 5 AND c.clade = f[2]
""",
)
def parse_reference(v):
    out = ref.parse_reference(v["references"], clade_species=v["clades"])
    return out.select("l_orderkey", "l_linenumber", "gene", "gene_length", "bug")


@query(
    "location_length",
    """
SELECT o_orderkey,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 0
                 ELSE abs(o_custkey - o_orderkey) + 1 + o_custkey + 1 END AS BIGINT) AS length
FROM orders
""",
)
def location_length(v):
    o = v["orders"]
    good = F.concat(
        F.lit(":c"), F.col("o_orderkey"), F.lit("-"), F.col("o_custkey"), F.lit(",:"),
        F.lit("5-"), F.col("o_custkey") + 5,
    )
    text = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("7-9,"), F.col("o_custkey"))).otherwise(good)
    return o.select("o_orderkey", ref.location_length(text).alias("length"))


@query(
    "length_annotation",
    """
SELECT o_orderkey, concat(split_part(o_orderpriority, ' ', 1), '|', CAST(o_custkey AS VARCHAR)) AS annotated,
       split_part(o_orderpriority, ' ', 1) AS plain, CAST(o_custkey AS INTEGER) AS length,
       o_orderpriority AS unannotated, 1 AS default_length
FROM orders
""",
)
def length_annotation(v):
    once = ref.add_length_annotation("o_orderpriority", "o_custkey")
    annotated = v["orders"].withColumn("annotated", ref.add_length_annotation(once, "o_custkey"))
    return annotated.select(
        "o_orderkey",
        "annotated",
        ref.remove_length_annotation("annotated").alias("plain"),
        ref.annotated_length("annotated").alias("length"),
        ref.annotated_id("o_orderpriority").alias("unannotated"),
        ref.annotated_length("o_orderpriority").alias("default_length"),
    )


SAM_SQL = """
SELECT query, gene, unmapped, l_linenumber,
       CAST(CAST(l_quantity AS BIGINT) + l_linenumber + 2 + l_linenumber * 10 AS BIGINT) AS aligned_length,
       CAST(CAST(l_quantity AS BIGINT) + 2 + l_linenumber * 10 + 3 AS BIGINT) AS reference_length,
       100.0::DOUBLE * (CAST(CAST(l_quantity AS BIGINT) + l_linenumber * 2
         + CASE WHEN l_returnflag = 'A' THEN 6 ELSE 0 END AS DOUBLE)
         / (CAST(l_quantity AS BIGINT) + l_linenumber + 2 + l_linenumber * 10)) AS identity,
       pos
FROM {sam_records}
"""


@query(
    "cigar_identity",
    f"SELECT query, l_linenumber, aligned_length, reference_length, round(identity, 6) AS identity FROM ({SAM_SQL})",
)
def cigar_identity(v):
    return v["sam_records"].select(
        "query",
        "l_linenumber",
        al.cigar_aligned_length("cigar").alias("aligned_length"),
        al.cigar_reference_length("cigar").alias("reference_length"),
        F.round(al.cigar_identity("cigar", "md"), 6).alias("identity"),
    )


@query(
    "md_tag",
    """
SELECT query, l_linenumber, CASE WHEN l_returnflag = 'N' THEN '' ELSE md END AS md FROM {sam_records}
""",
)
def md_tag(v):
    tags = F.when(F.col("l_returnflag") == "N", F.array(F.lit("NM:i:3"))).otherwise(
        F.array(F.lit("AS:i:0"), F.col("md"), F.lit("MD:Z:other"))
    )
    return v["sam_records"].select("query", "l_linenumber", al.md_tag(tags).alias("md"))


@query(
    "matches_and_evalue",
    """
SELECT l_orderkey, l_linenumber, l_partkey, round((100 - l_linenumber * 5) / 100.0::DOUBLE * l_quantity, 6) AS matches,
       CASE WHEN l_returnflag = 'N' THEN 1.0::DOUBLE ELSE l_tax END AS evalue,
       round(CASE WHEN l_returnflag = 'N' THEN 10.0::DOUBLE ELSE pow(10.0::DOUBLE, -l_linenumber) END, 9) AS logged
FROM lineitem
""",
)
def matches_and_evalue(v):
    raw = F.when(F.col("l_returnflag") == "N", F.lit("n/a"))
    return v["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(al.match_count(100 - F.col("l_linenumber") * 5, "l_quantity"), 6).alias("matches"),
        al.evalue(raw.otherwise(F.col("l_tax").cast("string"))).alias("evalue"),
        F.round(al.evalue(raw.otherwise((-F.col("l_linenumber")).cast("string")), logged=True), 9).alias("logged"),
    )


@query(
    "query_coverage",
    """
SELECT l_orderkey, l_linenumber, l_partkey,
       round(CASE WHEN l_linenumber > 1 THEN (abs(l_quantity - l_linenumber) + 1) / l_linenumber * 100.0::DOUBLE END, 6)
         AS coverage
FROM lineitem
""",
)
def query_coverage(v):
    covered = al.query_coverage("l_linenumber", "l_quantity", "l_linenumber")
    return v["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", F.round(covered, 6).alias("coverage"))


@query(
    "normalized_length",
    """
SELECT l_orderkey, l_linenumber, l_partkey,
       round((CASE WHEN p_size < 10 THEN 1000 ELSE p_size END) / 1000.0::DOUBLE, 9) AS rpk,
       round((abs((CASE WHEN p_size < 10 THEN 1000 ELSE p_size END) - greatest(l_quantity - 5, 1)) + 1) / 1000.0::DOUBLE, 9)
         AS adjusted
FROM lineitem JOIN part ON l_partkey = p_partkey
""",
)
def normalized_length(v):
    rows = v["lineitem"].join(v["part"], F.col("l_partkey") == F.col("p_partkey"))
    length = F.when(F.col("p_size") < 10, F.lit(0)).otherwise(F.col("p_size"))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(al.normalized_length(length, None, al.RPK), 9).alias("rpk"),
        F.round(al.normalized_length(length, F.col("l_quantity") - 5, al.ADJUSTED_RPK), 9).alias("adjusted"),
    )


@query("hit_score", "SELECT query, gene, bug, matches * matches AS score FROM {hits}")
def hit_score(v):
    return v["hits"].select("query", "gene", "bug", al.hit_score("matches").alias("score"))


FILTERED = """
SELECT * FROM {hits}
WHERE identity >= 80 AND evalue <= 0.05
  AND (abs(q_end - q_start) + 1) / 60.0::DOUBLE * 100 >= 40
"""


@query("filter_hits", f"SELECT query, gene, bug, matches, identity FROM ({FILTERED})")
def filter_hits(v):
    return h.filter_hits(v["hits"], 80, 0.05, 40).select("query", "gene", "bug", "matches", "identity")


COVERAGE = """
SELECT gene, max(gene_length) AS gene_length, CAST(sum(CASE WHEN reach IS NULL OR s_start > reach THEN s_end - s_start
       WHEN s_end > reach THEN s_end - reach ELSE 0 END) AS BIGINT) AS covered
FROM (SELECT gene, gene_length, s_start, s_end,
             max(s_end) OVER (PARTITION BY gene ORDER BY s_start, s_end
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
      FROM {intervals} WHERE s_end > s_start) AS ordered
GROUP BY gene
"""


@query(
    "subject_coverage",
    f"SELECT gene, covered, round(covered / (gene_length / 3.0::DOUBLE) * 100, 6) AS coverage FROM ({COVERAGE})",
)
def subject_coverage(v):
    # a tile much smaller than the genes, so that islands cross tile borders
    out = h.subject_coverage(v["intervals"], tile=1000)
    return out.select("gene", "covered", F.round("coverage", 6).alias("coverage"))


@query(
    "filter_subject_coverage",
    f"""
SELECT i.gene, s_start, s_end FROM {{intervals}} AS i
WHERE i.gene IN (SELECT gene FROM ({COVERAGE}) WHERE covered / (gene_length / 3.0::DOUBLE) * 100 >= 35)
""",
)
def filter_subject_coverage(v):
    return h.filter_subject_coverage(v["intervals"], 35).select("gene", "s_start", "s_end")


ISLANDS = """
SELECT gene, CAST(min(s_start) AS BIGINT) AS island_start, CAST(max(s_end) AS BIGINT) AS island_stop
FROM (SELECT gene, s_start, s_end, sum(opens) OVER (PARTITION BY gene ORDER BY s_start, s_end
                                                   ROWS UNBOUNDED PRECEDING) AS island
      FROM (SELECT gene, s_start, s_end,
                   CASE WHEN s_start <= max(s_end) OVER (PARTITION BY gene ORDER BY s_start, s_end
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens
            FROM {intervals} WHERE s_end > s_start) AS marked) AS numbered
GROUP BY gene, island
"""


@query("interval_islands", ISLANDS)
def interval_islands(v):
    # a tile much smaller than the genes, so that islands cross tile borders
    return h.merge_intervals(v["intervals"], ["gene"], tile=1000)


@query(
    "apply_id_mapping",
    """
SELECT query, l.gene AS reference, coalesce(m.gene, l.gene) AS gene,
       CASE WHEN m.gene IS NULL THEN l.gene_length ELSE coalesce(m.length, 0) END AS gene_length,
       CASE WHEN m.gene IS NULL THEN l.bug ELSE coalesce(m.bug, 'unclassified') END AS bug
FROM {hits} AS l LEFT JOIN {id_mapping} AS m ON l.gene = m.reference
""",
)
def apply_id_mapping(v):
    hits = v["hits"].withColumn("reference", F.col("gene"))
    return h.apply_id_mapping(hits, v["id_mapping"]).select("query", "reference", "gene", "gene_length", "bug")


WEIGHTS = """
SELECT query, gene, bug, gene_length, aligned_length, matches,
       CASE WHEN count(*) OVER (PARTITION BY query) = 1 THEN 1.0::DOUBLE
            ELSE matches * matches / sum(matches * matches) OVER (PARTITION BY query) END AS weight
FROM {hits}
"""


@query("query_weight", f"SELECT query, gene, bug, matches, round(weight, 6) AS weight FROM ({WEIGHTS})")
def query_weight(v):
    weights = h.query_weights(v["hits"])
    return weights.select("query", "gene", "bug", "matches", F.round("weight", 6).alias("weight"))


def scores_sql(amount: str) -> str:
    return f"""
SELECT CASE WHEN grouping(bug) = 1 THEN 'all' ELSE bug END AS bug, gene, sum({amount}) AS score
FROM ({WEIGHTS}) GROUP BY GROUPING SETS ((bug, gene), (gene))
"""


ADJUSTED = "weight / ((abs(gene_length - aligned_length) + 1) / 1000.0::DOUBLE)"


@query("gene_scores", f"SELECT bug, gene, round(score, 6) AS score FROM ({scores_sql(ADJUSTED)})")
def gene_scores(v):
    return h.gene_scores(v["hits"]).withColumn("score", F.round("score", 6))


@query(
    "gene_scores_rpks",
    f"SELECT bug, gene, round(score, 6) AS score FROM ({scores_sql('weight / (gene_length / 1000.0::DOUBLE)')})",
)
def gene_scores_rpks(v):
    return h.gene_scores(v["hits"], al.RPK).withColumn("score", F.round("score", 6))


@query(
    "gene_scores_counts", f"SELECT bug, gene, round(score, 6) AS score FROM ({scores_sql('weight')})"
)
def gene_scores_counts(v):
    return h.gene_scores(v["hits"], al.COUNTS).withColumn("score", F.round("score", 6))


CPM = f"""
SELECT bug, gene, score / (SELECT sum(score) FROM ({scores_sql(ADJUSTED)}) WHERE bug = 'all') * 1e6 AS score
FROM ({scores_sql(ADJUSTED)})
"""


@query("adjusted_cpm", f"SELECT bug, gene, round(score, 6) AS score FROM ({CPM})")
def adjusted_cpm(v):
    return h.adjusted_cpm(h.gene_scores(v["hits"])).withColumn("score", F.round("score", 6))


@query(
    "hit_summary",
    """
SELECT bug, count(*) AS hits, count(DISTINCT query) AS queries, count(DISTINCT gene) AS genes
FROM {hits} GROUP BY bug
""",
)
def hit_summary(v):
    return h.hit_summary(v["hits"])


@query(
    "run_summary",
    """
SELECT count(DISTINCT bug) AS bugs, count(DISTINCT gene) AS genes, count(DISTINCT query) AS aligned,
       round(100.0::DOUBLE * 500 / (count(DISTINCT query) + 500), 6) AS percent_unaligned
FROM {hits}
""",
)
def run_summary(v):
    out = h.run_summary(v["hits"], unaligned=500)
    return out.withColumn("percent_unaligned", F.round("percent_unaligned", 6))


SAM_KEPT = f"""
WITH s AS ({SAM_SQL}),
r AS (SELECT gene, pos AS s_start, pos + reference_length AS s_end,
             max(pos + reference_length) OVER (PARTITION BY gene ORDER BY pos, reference_length
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
      FROM s WHERE NOT unmapped AND identity >= 60),
c AS (SELECT gene, sum(CASE WHEN reach IS NULL OR s_start > reach THEN s_end - s_start
                            WHEN s_end > reach THEN s_end - reach ELSE 0 END) AS covered FROM r GROUP BY gene)
SELECT s.query, s.gene, s.l_linenumber, s.identity, s.aligned_length,
       NOT s.unmapped AND s.identity > 60 AND coalesce(c.covered / 1000.0::DOUBLE * 100 >= 80, FALSE) AS kept
FROM s LEFT JOIN c ON s.gene = c.gene
"""


def sam_records(v):
    return v["sam_records"].withColumns(
        {
            "aligned_length": al.cigar_aligned_length("cigar"),
            "identity": al.cigar_identity("cigar", "md"),
            "s_start": F.col("pos"),
            "s_end": F.col("pos") + al.cigar_reference_length("cigar"),
            "gene_length": F.lit(1000),
        }
    )


def _sam(v):
    return h.filter_nucleotide_hits(sam_records(v), identity=60, subject_threshold=80)


@query("filter_nucleotide_hits", f"SELECT query, gene, l_linenumber, kept FROM ({SAM_KEPT})")
def filter_nucleotide_hits(v):
    return _sam(v).select("query", "gene", "l_linenumber", "kept")


@query(
    "unaligned_reads",
    f"""
SELECT DISTINCT query FROM ({SAM_KEPT}) WHERE NOT kept
AND query NOT IN (SELECT query FROM ({FILTERED}))
""",
)
def unaligned_reads(v):
    return h.unaligned_reads(_sam(v), h.filter_hits(v["hits"], 80, 0.05, 40))


@query(
    "annotate_queries",
    """
SELECT query, gene, bug, q_length, round(identity / 100.0::DOUBLE * aligned_length, 6) AS matches, matches AS quantity
FROM {hits}
""",
)
def annotate_queries(v):
    named = v["hits"].withColumn("quantity", F.col("matches")).withColumn(
        "query", ref.add_length_annotation("query", "q_length")
    )
    return h.annotate_queries(named).select(
        "query", "gene", "bug", "q_length", F.round("matches", 6).alias("matches"), "quantity"
    )


@query(
    "running_total",
    """
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity,
       coalesce(sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
FROM lineitem
""",
)
def running_total(v):
    order = [F.col(c).asc() for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")]
    out = ordered_prefix(v["lineitem"], ["l_suppkey"], order, "l_quantity", "sum", "earlier")
    return out.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "earlier")


def _stored(v, rows, kind: str):
    path = scratch_path(v.spark, kind)
    return store_by_query(rows, "stored_" + path.rsplit("-", 1)[-1], 16, path)


@query("gene_scores_stored", f"SELECT bug, gene, round(score, 6) AS score FROM ({scores_sql(ADJUSTED)})")
def gene_scores_stored(v):
    """The hits lie in buckets by read, so that the weights need no shuffle by read."""
    return h.gene_scores(_stored(v, v["hits"], "hits")).withColumn("score", F.round("score", 6))


@query(
    "unaligned_reads_stored",
    f"""
SELECT DISTINCT query FROM ({SAM_KEPT}) WHERE NOT kept
AND query NOT IN (SELECT query FROM ({FILTERED}))
""",
)
def unaligned_reads_stored(v):
    hits = _stored(v, h.filter_hits(v["hits"], 80, 0.05, 40), "hits")
    return h.unaligned_reads(_stored(v, _sam(v), "records"), hits)
