"""Per-hit arithmetic of alignments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from abundix.functions.features import _col

# CIGAR operations, hit score power, default gene length.
ALIGNED_OPS = ("M", "=", "X", "I", "D")
REFERENCE_OPS = ("M", "D", "N", "=", "X")
MATCH_POWER = 2
DEFAULT_GENE_LENGTH = 1000
RPK = "RPKs"
ADJUSTED_RPK = "Adjusted RPKs"
ADJUSTED_CPM = "Adjusted CPMs"
COUNTS = "Counts"


def _sum_numbers(texts: Column) -> Column:
    return F.aggregate(
        texts, F.lit(0).cast("long"), lambda acc, t: acc + F.coalesce(t.try_cast("long"), F.lit(0).cast("long"))
    )


def _cigar_sum(cigar: Column, ops: tuple[str, ...]) -> Column:
    pattern = "([0-9]+)[" + "".join(ops) + "]"
    return _sum_numbers(F.regexp_extract_all(cigar, F.lit(pattern), F.lit(1)))


def cigar_aligned_length(cigar: Column | str) -> Column:
    return _cigar_sum(_col(cigar), ALIGNED_OPS)


def cigar_reference_length(cigar: Column | str) -> Column:
    return _cigar_sum(_col(cigar), REFERENCE_OPS)


def md_matches(md: Column | str) -> Column:
    body = F.regexp_replace(_col(md), "^.*MD:Z:", "")
    return F.coalesce(
        _sum_numbers(F.regexp_extract_all(body, F.lit("([0-9]+)"), F.lit(1))), F.lit(0).cast("long")
    )


def cigar_identity(cigar: Column | str, md: Column | str) -> Column:
    """Percent identity: MD matches over matched, mismatched, inserted and deleted bases."""
    aligned = cigar_aligned_length(cigar)
    return F.when(aligned > 0, F.lit(100.0) * (md_matches(md) / aligned)).otherwise(F.lit(0.0))


def md_tag(tags: Column | str) -> Column:
    """First tag that starts with ``MD:Z:``, empty when there is none."""
    found = F.get(F.filter(_col(tags), lambda t: t.startswith("MD:Z:")), F.lit(0))
    return F.coalesce(found, F.lit(""))


def match_count(identity: Column | str, aligned_length: Column | str) -> Column:
    return _col(identity) / 100.0 * _col(aligned_length)


def evalue(raw: Column | str, logged: bool | Column = False) -> Column:
    """Plain e-value; unreadable values and overflowing powers become 1."""
    number = F.coalesce(_col(raw).try_cast("double"), F.lit(1.0))
    power = F.pow(F.lit(10.0), number)
    power = F.when(power == F.lit(float("inf")), F.lit(1.0)).otherwise(power)
    if isinstance(logged, bool):
        return power if logged else number
    return F.when(logged, power).otherwise(number)


def query_coverage(q_start: Column | str, q_end: Column | str, q_length: Column | str) -> Column:
    """Percent of the query aligned; null when the query length is not known (<= 1)."""
    span = F.abs(_col(q_end) - _col(q_start)) + 1
    length = _col(q_length)
    return F.when(length > 1, span / length * 100.0)


def normalized_length(
    gene_length: Column | str, read_length: Column | str | None = None, mode: str = ADJUSTED_CPM
) -> Column:
    """Gene length in kilobases; all modes but RPKs subtract the read length first."""
    length = _col(gene_length)
    length = F.when(length == 0, F.lit(DEFAULT_GENE_LENGTH)).otherwise(length)
    if mode == RPK:
        return length / 1000.0
    read = F.lit(1) if read_length is None else F.coalesce(_col(read_length), F.lit(1))
    read = F.when(read < 1, F.lit(1)).otherwise(read)
    return (F.abs(length - read) + 1) / 1000.0


def hit_score(matches: Column | str, power: float = MATCH_POWER) -> Column:
    return F.pow(_col(matches), F.lit(power))
