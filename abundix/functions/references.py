"""Reference strings of alignments: gene, length and organism."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from abundix.functions.features import UNCLASSIFIED, _col


def location_length(location: Column | str) -> Column:
    """Total length of comma separated ``start-end`` ranges; 0 if any range is malformed."""
    ranges = F.split(F.regexp_replace(_col(location), "[:|c]", ""), ",")
    ends = F.transform(ranges, lambda r: F.split(r, "-"))

    def width(pair: Column) -> Column:
        start = F.get(pair, F.lit(0)).try_cast("long")
        end = F.get(pair, F.lit(1)).try_cast("long")
        return F.when(F.size(pair) == 2, F.abs(end - start) + 1)

    total = F.aggregate(ends, F.lit(0).cast("long"), lambda acc, p: acc + width(p))
    return F.coalesce(total, F.lit(0).cast("long"))


def add_length_annotation(identifier: Column | str, length: Column | str) -> Column:
    """Id up to its first blank with ``|length`` appended once."""
    head = F.substring_index(_col(identifier), " ", 1)
    suffix = F.concat(F.lit("|"), _col(length).cast("string"))
    return F.when(F.endswith(head, suffix), head).otherwise(F.concat(head, suffix))


def remove_length_annotation(identifier: Column | str) -> Column:
    return F.regexp_replace(_col(identifier), r"\|[^|]*$", "")


def annotated_id(identifier: Column | str) -> Column:
    """Id without its numeric length suffix."""
    c = _col(identifier)
    return F.when(c.rlike(r"\|[+-]?[0-9]+$"), F.regexp_replace(c, r"\|[^|]*$", "")).otherwise(c)


def annotated_length(identifier: Column | str, default: int = 1) -> Column:
    last = F.regexp_extract(_col(identifier), r"\|([+-]?[0-9]+)$", 1)
    return F.coalesce(last.try_cast("int"), F.lit(default))


def parse_reference(
    df: DataFrame,
    reference: str = "reference",
    gene_fields: Sequence[int] = (2,),
    clade_species: DataFrame | None = None,
) -> DataFrame:
    """Add ``gene``, ``gene_length`` and ``bug`` read from the reference string.

    Known forms: pangenome (``id|taxon|uniref90|uniref50|length``, where
    ``gene_fields`` names the field(s) that identify the gene), ``gene|length|taxon``,
    ``gene|length``, ``length|gene`` and a bare gene.  ``clade_species(clade, species)``
    gives the species of taxon fields that start with ``SGB``.
    """
    ref = F.col(reference)
    parts = F.split(ref, r"\|")
    n = F.size(parts)
    first, second, third = (F.get(parts, F.lit(i)) for i in range(3))
    digits = "^[0-9]+$"

    gene_len_taxon = (n == 3) & second.rlike(digits) & ~third.rlike(digits)
    gene_len = (n == 2) & second.rlike(digits)
    len_gene = (n == 2) & ~second.rlike(digits) & first.rlike(digits)
    fielded = n > max(gene_fields)
    pangenome_length = F.get(parts, F.lit(4)).try_cast("int")

    gene = (
        F.when(gene_len_taxon | gene_len, first)
        .when(len_gene, second)
        .when(fielded, F.concat_ws("|", *[F.get(parts, F.lit(i)) for i in gene_fields]))
        .otherwise(ref)
    )
    length = (
        F.when(gene_len_taxon | gene_len, second.try_cast("int"))
        .when(len_gene, first.try_cast("int"))
        .when(fielded, pangenome_length)
    )
    taxa = F.split(second, r"\.")
    lineage = F.when(F.size(taxa) >= 2, F.concat_ws(".", F.slice(taxa, -2, 2)))
    bug = F.when(gene_len_taxon, third).otherwise(lineage)
    is_clade = second.startswith("SGB") & ~gene_len_taxon

    out = df.withColumns(
        {
            "gene": gene,
            "gene_length": F.coalesce(length, F.lit(0)),
            "bug": F.when(is_clade, second).otherwise(F.coalesce(bug, F.lit(UNCLASSIFIED))),
            "_is_clade": F.coalesce(is_clade, F.lit(False)),
        }
    )
    species = F.lit(None).cast("string")
    if clade_species is not None:
        known = clade_species.select(
            F.col("clade").alias("bug"), F.lit(True).alias("_is_clade"), F.col("species").alias("_species")
        )
        out = out.join(known, ["bug", "_is_clade"], "left")
        species = F.col("_species")
    named = F.concat(F.coalesce(species, F.lit(UNCLASSIFIED)), F.lit(".t__"), F.col("bug"))
    return out.withColumn(
        "bug", F.when(F.col("_is_clade"), named).otherwise(F.col("bug"))
    ).drop("_is_clade", "_species")
