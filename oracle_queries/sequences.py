"""Reads and their translation."""

from pyspark.sql import functions as F

from abundix.functions import sequences as s
from abundix.operators.reads import read_counts
from abundix.session import scratch_path
from abundix.sources import sequences as sq
from oracle_queries.registry import LENSES, query

LENSES["reads"] = """
SELECT DISTINCT sequence FROM (SELECT explode(split(bases, '[.]')) AS sequence FROM {genomes}) AS pieces
"""
# DuckDB spells the split differently
READS = "(SELECT DISTINCT unnest(string_split(bases, '.')) AS sequence FROM {genomes})"

CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
FRAMES = f"""
WITH r AS (SELECT sequence, upper(sequence) AS fwd,
                  reverse(translate(regexp_replace(upper(sequence), '[^ACGT]', 'N', 'g'), 'ACGT', 'TGCA')) AS rev
           FROM {READS} AS pieces),
f AS (SELECT sequence, CAST(frame AS INTEGER) AS frame, substr(CASE WHEN frame < 3 THEN fwd ELSE rev END, frame % 3 + 1) AS strand
      FROM r CROSS JOIN (SELECT unnest(range(0, 6)) AS frame) AS n),
p AS (SELECT sequence, frame, array_to_string(list_transform(regexp_extract_all(strand, '(?s)...'), lambda c:
        CASE WHEN instr('TCAG', c[1]) = 0 OR instr('TCAG', c[2]) = 0 OR instr('TCAG', c[3]) = 0 THEN 'X'
             ELSE substr('{CODE}', 16 * (instr('TCAG', c[1]) - 1) + 4 * (instr('TCAG', c[2]) - 1) + instr('TCAG', c[3]), 1) END), '') AS peptide
      FROM f)
SELECT sequence, frame, peptide FROM p WHERE length(peptide) > 0 AND NOT contains(peptide, '*') AND NOT contains(peptide, 'X')
"""


@query("translate_frames", FRAMES)
def translate_frames(v):
    return s.translate_frames(v["reads"]).select("sequence", "frame", "peptide")


@query(
    "reverse_complement",
    """
SELECT doc_id, reverse(translate(regexp_replace(upper(bases), '[^ACGT]', 'N', 'g'), 'ACGT', 'TGCA')) AS reversed FROM {genomes}
""",
)
def reverse_complement(v):
    return v["genomes"].select("doc_id", s.reverse_complement("bases").alias("reversed"))


@query(
    "read_counts",
    "SELECT source, count(*) AS reads, count(DISTINCT text) AS distinct_reads FROM documents GROUP BY source",
)
def counts(v):
    return read_counts(v["documents"], "source", "text").select("source", "reads", "distinct_reads")


@query(
    "write_fasta",
    "SELECT concat(CAST(doc_id AS VARCHAR), '|', CAST(length(regexp_replace(bases, '\\s', '', 'g')) AS VARCHAR)) AS id, "
    "regexp_replace(bases, '\\s', '', 'g') AS sequence FROM {genomes}",
)
def write_fasta(v):
    reads = v["genomes"].select(F.col("doc_id").cast("string").alias("header"), F.regexp_replace("bases", r"\s", "").alias("sequence"))
    path = scratch_path(v.spark, "fasta")
    sq.write_fasta(reads.withColumn("length", F.length("sequence")), path, length="length")
    return sq.read_fasta(v.spark, path).select("id", "sequence")
