"""Readers and writers: the tables are written as text to the shared folder and read back."""

from pyspark.sql import functions as F

from abundix.functions.features import split_feature
from abundix.plans.profiles import cohort_table as cohort
from abundix.session import scratch_path
from abundix.sources import alignments as al, mappings as mp, sequences as sq, tables as st
from oracle_queries.registry import query


def _written(df, *columns, separator="\t"):
    """Tab separated text of the columns below a new shared folder."""
    path = scratch_path(df.sparkSession, "text")
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) if isinstance(c, str) else c for c in columns]
    df.select(F.concat_ws(separator, *texts)).write.text(path)
    return path


@query(
    "read_feature_table",
    """
WITH s AS (SELECT DISTINCT sample FROM {feature_table}), f AS (SELECT DISTINCT code, stratum FROM {feature_table})
SELECT f.code, f.stratum, s.sample, coalesce(t.value, 0) AS value FROM f CROSS JOIN s LEFT JOIN {feature_table} AS t
ON t.code = f.code AND t.stratum IS NOT DISTINCT FROM f.stratum AND t.sample = s.sample
""",
)
def read_feature_table(v):
    path = scratch_path(v.spark, "table")
    st.write_feature_table(v["feature_table"], path, digits=None)
    return st.read_feature_table(v.spark, path).select("code", "stratum", "sample", "value")


@query(
    "write_feature_table",
    """
SELECT code, stratum, sample, CAST(format('{{:.5e}}', value / 7) AS DOUBLE) AS value FROM {feature_table}
""",
)
def write_feature_table(v):
    path = scratch_path(v.spark, "table")
    st.write_feature_table(v["feature_table"].withColumn("value", F.col("value") / 7), path)
    back = st.read_feature_table(v.spark, path)
    return back.where(F.col("value") > 0).select("code", "stratum", "sample", "value")


@query(
    "write_per_sample",
    """
SELECT regexp_replace(sample, '-', '_') AS sample_file, code, stratum, value FROM {feature_table}
""",
)
def write_per_sample(v):
    path = scratch_path(v.spark, "samples")
    st.write_per_sample(v["feature_table"], path)
    back = v.spark.read.options(sep="\t", header=True).csv(path)
    parts = split_feature(back, "# Feature")
    return parts.select("sample_file", "code", "stratum", F.col("value").cast("double").alias("value"))


@query(
    "write_profile",
    """
SELECT regexp_replace(sample, '-', '_') AS sample_file, code, stratum, round(value, 3) AS value FROM {feature_table}
""",
)
def write_profile(v):
    path = scratch_path(v.spark, "profile")
    st.write_profile(v["feature_table"], path, special=("UNMAPPED", "UNINTEGRATED"), digits=3)
    back = v.spark.read.options(sep="\t", header=True).csv(path)
    parts = split_feature(back, "# Gene Family")
    return parts.select("sample_file", "code", "stratum", F.col("value").cast("double").alias("value"))


@query(
    "read_hits_m8",
    """
SELECT query, gene AS reference, CASE WHEN identity = 75 THEN 0 ELSE identity END AS identity, aligned_length,
       q_start, q_end, s_start, s_end, CASE WHEN evalue = 0 THEN 1.0::DOUBLE ELSE evalue END AS evalue
FROM {hits}
""",
)
def read_hits_m8(v):
    identity = F.when(F.col("identity") == 75, F.lit("none")).otherwise(F.col("identity").cast("string"))
    evalue = F.when(F.col("evalue") == 0, F.lit("n/a")).otherwise(F.col("evalue").cast("string"))
    rows = v["hits"]
    path = _written(
        rows, "query", "gene", identity, "aligned_length", F.lit("1"), F.lit("0"),
        "q_start", "q_end", "s_start", "s_end", evalue, F.lit("50.5"),
    )
    return al.read_hits_m8(v.spark, path).drop("mismatch", "gaps", "bitscore")


@query(
    "read_hits_sam",
    """
SELECT query, gene AS reference, unmapped, l_linenumber AS mapq,
       CAST(CAST(l_quantity AS BIGINT) + l_linenumber + 2 + l_linenumber * 10 AS BIGINT) AS aligned_length,
       pos AS s_start, CAST(pos + CAST(l_quantity AS BIGINT) + 2 + l_linenumber * 10 + 3 AS BIGINT) AS s_end
FROM {sam_records}
""",
)
def read_hits_sam(v):
    flag = F.when(F.col("unmapped"), F.lit("5")).otherwise(F.lit("16"))
    path = _written(
        v["sam_records"], "query", flag, "gene", "pos", "l_linenumber", "cigar", F.lit("*"), F.lit("0"), F.lit("0"),
        F.lit("ACGT"), F.lit("@@@@"), F.lit("AS:i:0"), "md",
    )
    out = al.read_hits_sam(v.spark, path)
    return out.select("query", "reference", "unmapped", "mapq", "aligned_length", "s_start", "s_end")


@query(
    "read_fasta",
    "SELECT CAST(doc_id AS VARCHAR) AS id, concat(CAST(doc_id AS VARCHAR), ' ', lang) AS header, "
    "regexp_replace(bases, '\\s', '', 'g') AS sequence FROM {genomes} JOIN documents USING (doc_id)",
)
def read_fasta(v):
    docs = v["genomes"].join(v["documents"].select("doc_id", "lang"), "doc_id")
    # the text keeps its own line breaks, so sequences span lines
    record = F.concat(F.lit(">"), F.col("doc_id"), F.lit(" "), F.col("lang"), F.lit("\n"), F.col("bases"))
    return sq.read_fasta(v.spark, _written(docs, record)).select("id", "header", "sequence")


FASTQ = "regexp_replace(bases, '[^ACGT]', '', 'g')"


@query(
    "read_fastq",
    f"SELECT CAST(doc_id AS VARCHAR) AS id, {FASTQ} AS sequence FROM {{genomes}} WHERE length({FASTQ}) > 0",
)
def read_fastq(v):
    bases = F.regexp_replace("bases", "[^ACGT]", "")
    record = F.concat(
        F.lit("@"), F.col("doc_id"), F.lit("\n"), bases, F.lit("\n+\n@"), F.regexp_replace(bases, "[CGT]", "@")
    )
    return sq.read_fastq(v.spark, _written(v["genomes"], record)).select("id", "sequence")


@query(
    "read_id_mapping",
    """
SELECT concat('g', CAST(p_partkey AS VARCHAR)) AS reference, p_name AS gene,
       CASE WHEN p_size > 10 AND p_size <> 20 THEN p_size ELSE 0 END AS length,
       CASE WHEN p_size > 30 THEN p_brand ELSE 'unclassified' END AS bug FROM part
""",
)
def read_id_mapping(v):
    size = F.when(F.col("p_size") == 20, F.lit("?")).otherwise(F.col("p_size").cast("string"))
    line = F.concat(
        F.lit("g"), F.col("p_partkey"), F.lit("\t"), F.col("p_name"),
        F.when(F.col("p_size") > 10, F.concat(F.lit("\t"), size)).otherwise(F.lit("")),
        F.when(F.col("p_size") > 30, F.concat(F.lit("\t"), F.col("p_brand"))).otherwise(F.lit("")),
    )
    return mp.read_id_mapping(v.spark, _written(v["part"], line))


@query(
    "read_reactions",
    "SELECT reaction, ec, gene FROM {reaction_genes}",
)
def read_reactions(v):
    return mp.read_reactions(v.spark, _written(v["reaction_genes"], "reaction", "ec", "gene"))


@query(
    "read_pathways",
    """
SELECT replace(concat(p_name, ' way'), ' ', '_') AS pathway, CAST(n AS INTEGER) AS pos,
       CASE n WHEN 0 THEN p_type WHEN 1 THEN p_brand ELSE p_type END AS reaction
FROM part CROSS JOIN (SELECT unnest(range(0, 3)) AS n) AS r
""",
)
def read_pathways(v):
    name = F.concat("p_name", F.lit(" way"))
    return mp.read_pathways(v.spark, _written(v["part"], name, "p_type", "p_brand", "p_type"))


@query(
    "read_pathway_nodes",
    """
SELECT pathway, 1 AS node_id, a AS reaction, TRUE AS is_key FROM {pathway_parts}
UNION ALL SELECT pathway, 2, b, TRUE FROM {pathway_parts}
UNION ALL SELECT pathway, 4, c, TRUE FROM {pathway_parts}
UNION ALL SELECT pathway, 5, d, TRUE FROM {pathway_parts}
UNION ALL SELECT pathway, 7, e, TRUE FROM {pathway_parts}
UNION ALL SELECT pathway, 8, f, FALSE FROM {pathway_parts}
""",
)
def read_pathway_nodes(v):
    nodes = mp.read_pathway_nodes(v.spark, _written(v["pathway_structures"], "pathway", "structure"))
    return nodes.where(F.col("reaction").isNotNull()).select("pathway", "node_id", "reaction", "is_key")


@query(
    "read_polymap",
    """
SELECT DISTINCT p_brand AS key, value FROM (SELECT p_brand, p_name AS value FROM part
  UNION ALL SELECT p_brand, concat('size ', CAST(p_size AS VARCHAR)) FROM part) AS u
WHERE value IN (SELECT p_name FROM part WHERE p_size > 45 UNION SELECT 'size 3') AND p_brand <> 'Brand#4'
""",
)
def read_polymap(v):
    part = v["part"]
    path = _written(part, "p_type", "p_name", "p_brand", F.concat(F.lit("size "), "p_size"))
    values = part.where("p_size > 45").select("p_name").union(v.spark.createDataFrame([("size 3",)], "p_name string"))
    keys = part.select("p_brand").where("p_brand <> 'Brand#4'")
    return mp.read_polymap(v.spark, path, start=2, skip=[0], allowed_keys=keys, allowed_values=values)


@query(
    "read_names",
    "SELECT concat('g', CAST(p_partkey AS VARCHAR)) AS id, p_name AS name FROM part",
)
def read_names(v):
    line = F.concat(F.lit("g"), F.col("p_partkey"), F.lit("\told\ng"), F.col("p_partkey"), F.lit("\t"), F.col("p_name"))
    return mp.read_names(v.spark, _written(v["part"], line))


@query(
    "read_gene_table",
    """
SELECT sample, coalesce(stratum, 'all') AS bug, code AS gene, value AS score, CAST(NULL AS DOUBLE) AS unmapped
FROM {feature_table} WHERE code <> 'UNMAPPED'
UNION ALL SELECT sample, NULL, NULL, NULL, value FROM {feature_table} WHERE code = 'UNMAPPED' AND stratum IS NULL
""",
)
def read_gene_table(v):
    table = v["feature_table"].where("code <> 'UNMAPPED' OR stratum IS NULL").withColumn(
        "code", F.when(F.col("code") == "UNMAPPED", F.lit("READS_UNMAPPED")).otherwise(F.col("code"))
    ).withColumn("name", F.when(F.col("code") > "Brand#2", F.concat(F.lit("named: "), "code")))
    path = scratch_path(v.spark, "table")
    st.write_feature_table(table, path, digits=None)
    scores, unmapped = st.read_gene_table(v.spark, path)
    scores = scores.where(F.col("score") > 0).select("sample", "bug", "gene", "score")
    return scores.unionByName(unmapped, allowMissingColumns=True)


@query("read_taxonomic_profile", "SELECT clade, abundance, coverage FROM {profile}")
def read_taxonomic_profile(v):
    path = _written(v["profile"], "clade", F.lit("2|1224"), "abundance", "coverage", F.lit("17"))
    return mp.read_taxonomic_profile(v.spark, path)


@query(
    "read_taxonomy",
    """
SELECT taxid AS key, name, rank, CAST(parent AS VARCHAR) AS parent FROM {taxonomy} WHERE parent IS NOT NULL
UNION ALL SELECT family, 'family', lca, NULL FROM {family_lca}
""",
)
def read_taxonomy(v):
    sections = {
        "tree": v["taxonomy"].where("parent IS NOT NULL").toDF("TAXID", "NAME", "RANK", "PARENT"),
        "families": v["family_lca"].select(
            F.col("family").alias("FAMILY"), F.lit("x").alias("SOURCE_TAX"), F.col("lca").alias("LCA")
        ),
    }
    paths = []
    for name, rows in sections.items():
        paths.append(scratch_path(v.spark, name))
        rows.write.options(sep="\t", header=True).csv(paths[-1])
    taxa, lca = mp.read_taxonomy(v.spark, paths)
    return taxa.withColumnRenamed("taxid", "key").unionByName(
        lca.select(F.col("family").alias("key"), F.lit("family").alias("name"), F.col("lca").alias("rank")),
        allowMissingColumns=True,
    )


@query(
    "read_metadata_table",
    """
WITH s AS (SELECT DISTINCT sample FROM {feature_table}),
f AS (SELECT DISTINCT code AS feature FROM {feature_table}),
c AS (SELECT * FROM {feature_table} WHERE stratum IS NULL)
SELECT 'meta' AS kind, 'year' AS key, sample, substr(sample, 4, 4) AS value FROM s
UNION ALL SELECT 'meta', 'flag', sample, substr(sample, 1, 2) FROM s
UNION ALL SELECT 'cell', f.feature, s.sample, CAST(CAST(coalesce(c.value, 0) AS BIGINT) AS VARCHAR)
FROM f CROSS JOIN s LEFT JOIN c ON c.code = f.feature AND c.sample = s.sample
""",
)
def read_metadata_table(v):
    table = v["feature_table"].where("stratum IS NULL")
    names = st.sample_row(table)
    text = st.wide_rows(table, names, digits=None).select(
        F.lit(3).alias("at"), F.concat_ws("\t", "code", F.array_join("cells", "\t")).alias("line")
    )
    heads = {
        "ID": F.col("names"),
        "year": F.transform("names", lambda s: F.substring(s, 4, 4)),
        "flag": F.transform("names", lambda s: F.substring(s, 1, 2)),
    }
    heads = F.array(*[F.concat_ws("\t", F.lit(k), F.array_join(c, "\t")) for k, c in heads.items()])
    # a file for each of the few codes, every one with the lines above
    files = text.withColumn("part", F.pmod(F.hash("line"), F.lit(4)))
    above = v.spark.range(1).select(names.alias("names")).select(F.posexplode(heads).alias("at", "line"))
    above = above.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(3))))
    path = scratch_path(v.spark, "metadata")
    lines = files.unionByName(above).repartition("part").sortWithinPartitions("part", "at")
    lines.select("part", "line").write.partitionBy("part").text(path)
    metadata, cells = st.read_metadata_table(v.spark, path, "flag")
    meta = metadata.select(F.lit("meta").alias("kind"), "key", "sample", "value")
    return meta.unionByName(
        cells.select(
            F.lit("cell").alias("kind"), F.col("feature").alias("key"), "sample",
            F.col("value").cast("bigint").cast("string").alias("value"),
        )
    )


@query(
    "cohort_table",
    """
SELECT code, stratum, sample, sum(value) AS value FROM (
  SELECT code, stratum, concat('o', sample) AS sample, value FROM {rna}
  UNION ALL SELECT code, stratum, concat('f', sample), value FROM {dna}) AS u
GROUP BY code, stratum, sample
""",
)
def cohort_table(v):
    paths = []
    for name, prefix in (("rna", "o"), ("dna", "f")):
        path = scratch_path(v.spark, name)
        table = v[name].withColumn("sample", F.concat(F.lit(prefix), "sample"))
        st.write_feature_table(table, path, digits=None)
        paths.append(path)
    out = cohort(v.spark, paths)
    return out.where(F.col("value") > 0).select("code", "stratum", "sample", "value")
