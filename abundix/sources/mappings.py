"""Readers of mappings, databases, profiles and taxonomies."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from abundix.functions.features import UNCLASSIFIED
from abundix.session import cut_lineage
from abundix.sources.text import fields, placed_lines, raw_lines

_NODES = (
    "pathway string, node_id int, parent_id int, depth int, `join` string, reaction string, is_key boolean"
)


def read_id_mapping(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``reference, gene, length, bug``; missing length 0, missing organism unclassified."""
    rows = raw_lines(spark, path).where(~F.col("line").startswith("#"))
    f = [F.get(fields(F.rtrim("line")), F.lit(i)) for i in range(4)]
    return rows.select(
        f[0].alias("reference"),
        f[1].alias("gene"),
        F.coalesce(f[2].try_cast("int"), F.lit(0)).alias("length"),
        F.coalesce(f[3], F.lit(UNCLASSIFIED)).alias("bug"),
    ).where((F.length("reference") > 0) & (F.length("gene") > 0))


def read_reactions(spark: SparkSession, path: str | Sequence[str], ec_column: bool = True) -> DataFrame:
    """``reaction, ec, gene``; a gene listed twice is kept twice, lines below 3 fields are dropped."""
    first_gene = 3 if ec_column else 2
    f = fields(F.rtrim("line"))
    rows = raw_lines(spark, path).where(F.size(f) >= 3)
    ec = F.get(f, F.lit(1)) if ec_column else F.lit(None).cast("string")
    genes = F.slice(f, F.lit(first_gene), F.size(f) - first_gene + 1)
    return rows.select(F.get(f, F.lit(0)).alias("reaction"), ec.alias("ec"), F.explode(genes).alias("gene")).where(
        F.length("gene") > 0
    )


def _pathway_rows(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    f = fields(F.trim("line"))
    rows = raw_lines(spark, path).where(F.size(f) > 1)
    return rows.select(
        F.replace(F.get(f, F.lit(0)), F.lit(" "), F.lit("_")).alias("pathway"),
        F.slice(f, F.lit(2), F.size(f) - 1).alias("items"),
    )


def is_structured(spark: SparkSession, path: str | Sequence[str]) -> bool:
    """Whether a first item holds a parenthesis."""
    return not _pathway_rows(spark, path).where(F.get("items", F.lit(0)).contains("(")).isEmpty()


def read_pathways(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Flat pathways: ``pathway, pos, reaction``."""
    return _pathway_rows(spark, path).select("pathway", F.posexplode("items").alias("pos", "reaction"))


def is_optional(name: str, known: frozenset[str] = frozenset()) -> bool:
    """One or three leading dashes mark an optional reaction, unless they are part of its name."""
    dashes = len(name) - len(name.lstrip("-"))
    return name not in known and dashes in (1, 3)


def pathway_tree(pathway: str, structure: str, known: frozenset[str] = frozenset()) -> list[dict]:
    """Nodes of one pathway's AND/OR tree; lists have a join, leaves a reaction."""
    nodes: list[dict] = []

    def add(parent: int | None, depth: int, reaction: str | None, is_key: bool | None) -> int:
        nodes.append(
            {
                "pathway": pathway,
                "node_id": len(nodes),
                "parent_id": parent,
                "depth": depth,
                "join": "+" if reaction is None else None,
                "reaction": reaction,
                "is_key": is_key,
            }
        )
        return len(nodes) - 1

    open_lists = [add(None, 0, None, None)]
    for token in filter(None, structure.split(" ")):
        if token == "(":
            open_lists.append(add(open_lists[-1], len(open_lists), None, None))
        elif token == ")":
            if len(open_lists) > 1:
                open_lists.pop()
        elif token in ("+", ","):
            nodes[open_lists[-1]]["join"] = token
        else:
            optional = is_optional(token, known)
            add(open_lists[-1], len(open_lists), token[1:] if optional else token, not optional)
    return nodes


def pathway_nodes(structures: DataFrame, known_reactions: frozenset[str] = frozenset()) -> DataFrame:
    """Node table of ``structures(pathway, structure)``, one line of text per pathway.

    The table is written once, as the evaluation of the trees reads it in many branches.
    """

    def trees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                node
                for pathway, structure in zip(batch["pathway"], batch["structure"])
                for node in pathway_tree(pathway, structure, known_reactions)
            ]
            frame = pd.DataFrame(rows, columns=["pathway", "node_id", "parent_id", "depth", "join", "reaction", "is_key"])
            frame["parent_id"] = frame["parent_id"].astype("Int32")
            yield frame

    return cut_lineage(structures.select("pathway", "structure").mapInPandas(trees, _NODES))


def read_pathway_nodes(
    spark: SparkSession, path: str | Sequence[str], known_reactions: frozenset[str] = frozenset()
) -> DataFrame:
    """Structured pathways as tree nodes."""
    rows = _pathway_rows(spark, path)
    return pathway_nodes(rows.select("pathway", F.array_join("items", " ").alias("structure")), known_reactions)


def nodes_to_reactions(nodes: DataFrame) -> DataFrame:
    """``pathway, reaction`` of the leaves, entries listed twice kept."""
    return nodes.where(F.col("reaction").isNotNull()).select("pathway", "reaction")


def read_polymap(
    spark: SparkSession,
    path: str | Sequence[str],
    start: int = 0,
    skip: Sequence[int] = (),
    allowed_keys: DataFrame | None = None,
    allowed_values: DataFrame | None = None,
) -> DataFrame:
    """Distinct ``(key, value)`` of ragged lines, limited to the ids in use (first columns)."""
    f = fields(F.rtrim("line"))
    pairs = raw_lines(spark, path).select(
        F.get(f, F.lit(start)).alias("key"), F.posexplode(f).alias("_at", "value")
    )
    pairs = pairs.where(~F.col("_at").isin(start, *skip)).drop("_at")
    for column, allowed in (("key", allowed_keys), ("value", allowed_values)):
        if allowed is not None:
            ids = allowed.select(F.col(allowed.columns[0]).alias(column))
            pairs = pairs.join(ids, column, "left_semi")
    return pairs.select("key", "value").distinct()


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """``id, name``; the last line of an id wins."""
    f = fields(F.rtrim("line"))
    rows = placed_lines(spark, path).select(
        F.get(f, F.lit(0)).alias("id"), F.get(f, F.lit(1)).alias("name"), "file", "at"
    )
    named = rows.where((F.length("id") > 0) & F.col("name").isNotNull())
    return named.groupBy("id").agg(F.max_by("name", F.struct("file", "at")).alias("name"))


def read_taxonomic_profile(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``clade, abundance, coverage``: third and second column from the end."""
    f = fields()
    rows = raw_lines(spark, path).where(~F.col("line").startswith("#") & (F.size(f) >= 3))
    return rows.select(
        F.get(f, F.lit(0)).alias("clade"),
        F.get(f, F.size(f) - 3).try_cast("double").alias("abundance"),
        F.get(f, F.size(f) - 2).try_cast("double").alias("coverage"),
    )


def read_taxonomy(spark: SparkSession, path: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Tree ``(taxid, name, rank, parent)`` and family rows of two-section files.

    A section starts at a line whose first field is TAXID or FAMILY; its columns are
    named by that line, in lower case.  Every file may hold one or both sections.
    """
    lines = cut_lineage(placed_lines(spark, path).where(F.length("line") > 0))
    first = F.get(fields(), F.lit(0))
    marked = lines.where(first.isin("TAXID", "FAMILY"))
    starts = marked.groupBy("file").agg(
        *[F.min(F.when(first == m, F.col("at"))).alias(m) for m in ("TAXID", "FAMILY")]
    )
    # a file's own header line says where its columns are
    headers = marked.select("file", first.alias("marker"), F.transform(fields(), F.lower).alias("_names"))
    headers = headers.groupBy("file", "marker").agg(F.first("_names").alias("_names"))
    # the names of all columns, of which there are as many as a line has
    columns: dict[str, list[str]] = {}
    for row in headers.select("marker", F.posexplode("_names").alias("at", "name")).groupBy("marker", "name").agg(
        F.min("at").alias("at")
    ).orderBy("at", "name").collect():
        columns.setdefault(row["marker"], []).append(row["name"])
    placed = lines.join(starts, "file")

    def section(marker: str, other: str) -> DataFrame:
        start, stop = F.col(marker), F.col(other)
        inside = (F.col("at") > start) & (stop.isNull() | (stop < start) | (F.col("at") < stop))
        own = headers.where(F.col("marker") == marker).select("file", "_names")
        return placed.where(inside).join(own, "file").select(
            *[F.get(fields(), F.array_position("_names", n).cast("int") - 1).alias(n) for n in columns[marker]]
        )

    tree = section("TAXID", "FAMILY").select("taxid", "name", "rank", "parent")
    return tree, section("FAMILY", "TAXID")


def _owners(nodes: DataFrame) -> DataFrame:
    """``(reaction, _owners)``: the distinct pathways of each reaction, a name may be null."""
    entries = nodes.where(F.col("reaction").isNotNull()).select("pathway", "reaction")
    owners = entries.groupBy("reaction").agg(F.collect_set(F.struct("pathway")).alias("_owners"))
    # written, so that its size is known: a small one goes to the genes and these are not dealt out by reaction
    return cut_lineage(owners.select("reaction", F.transform("_owners", lambda o: o["pathway"]).alias("_owners")))


def _listed(pairs: DataFrame, owners: DataFrame) -> DataFrame:
    # a gene's reactions meet in one task before its pathways are put to them, so no list is shuffled
    pairs = pairs.select("gene", "reaction").where(F.col("reaction").isNotNull()).repartition("gene").distinct()
    lists = pairs.join(owners, "reaction").groupBy("gene").agg(F.collect_list("_owners").alias("_lists"))
    return lists.select("gene", F.array_distinct(F.flatten("_lists")).alias("pathways"))


def gene_pathways(reactions: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(gene, pathways)``: the members of :func:`pathway_members` as one list per gene."""
    return _listed(reactions, _owners(nodes))


def pathway_members(reactions: DataFrame, nodes: DataFrame, ec_separator: str = ",") -> tuple[DataFrame, DataFrame]:
    """``(pathway, gene)`` and the same for EC numbers, from ``read_reactions`` and pathway nodes or flat pathways.

    An optional reaction is a member like any other.  A reaction's EC list is split.  The pairs are unfolded from
    one list of pathways per gene, after the shuffle.
    """
    owners = _owners(nodes)
    ecs = reactions.select("reaction", F.explode(F.split("ec", ec_separator)).alias("gene"))
    ecs = ecs.where(F.length("gene") > 0).distinct()
    genes, numbers = (
        _listed(pairs, owners).select(F.explode("pathways").alias("pathway"), "gene") for pairs in (reactions, ecs)
    )
    return genes, numbers
