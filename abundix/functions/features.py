"""Feature ids: ``CODE: NAME|STRATUM`` with optional name and stratum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Separators and special codes of the table format.
STRATUM_SEP = "|"
NAME_SEP = ": "
MULTI_NAME_SEP = ";"
TAXON_SEP = "."
READS_UNMAPPED = "READS_UNMAPPED"
UNMAPPED = "UNMAPPED"
UNGROUPED = "UNGROUPED"
UNINTEGRATED = "UNINTEGRATED"
UNCLASSIFIED = "unclassified"
NO_NAME = "NO_NAME"
ALL = "all"
OTHER = "other"
SPECIAL = (UNMAPPED, UNINTEGRATED, UNGROUPED)
TOP_ORDER = {
    "UNMAPPED": 0,
    "UNGROUPED": 1,
    "UNINTEGRATED": 2,
    "UniRef50_unknown": 3,
    "UniRef90_unknown": 4,
}

FEATURE = ("code", "name", "stratum")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def feature_code(feature: Column | str) -> Column:
    return F.substring_index(F.get(F.split(_col(feature), r"\|"), F.lit(0)), NAME_SEP, 1)


def feature_name(feature: Column | str) -> Column:
    """Text after the first ``": "`` of the unstratified part, null when there is none."""
    head = F.get(F.split(_col(feature), r"\|"), F.lit(0))
    at = F.locate(NAME_SEP, head)
    return F.when(at > 0, F.substring(head, at + len(NAME_SEP), F.length(head)))


def feature_stratum(feature: Column | str) -> Column:
    return F.get(F.split(_col(feature), r"\|"), F.lit(1))


def split_feature(df: DataFrame, feature: str = "feature", keep: bool = False) -> DataFrame:
    """Add ``code``, ``name`` and ``stratum``; an id with a second ``|`` is an error."""
    c = F.col(feature)
    checked = F.when(
        F.size(F.split(c, r"\|")) > 2,
        F.raise_error(F.concat(F.lit("bad feature name: "), c)),
    ).otherwise(feature_code(c))
    out = df.withColumns(
        {"code": checked, "name": feature_name(c), "stratum": feature_stratum(c)}
    )
    return out if keep else out.drop(feature)


def is_valid_feature(feature: Column | str) -> Column:
    return F.size(F.split(_col(feature), r"\|")) <= 2


def join_feature(
    code: Column | str = "code", name: Column | str = "name", stratum: Column | str = "stratum"
) -> Column:
    return F.concat_ws(
        STRATUM_SEP, F.concat_ws(NAME_SEP, _col(code), _col(name)), _col(stratum)
    )


def level_of(stratum: Column | str = "stratum") -> Column:
    """Number of ``|`` separated parts: 1 for community rows, 2 for strata."""
    return F.when(_col(stratum).isNull(), F.lit(1)).otherwise(F.lit(2))


def top_rank(code: Column | str = "code") -> Column:
    rank = F.lit(len(TOP_ORDER))
    for special, position in TOP_ORDER.items():
        rank = F.when(_col(code) == special, F.lit(position)).otherwise(rank)
    return rank


def genus_of(stratum: Column | str = "stratum") -> Column:
    return F.substring_index(_col(stratum), TAXON_SEP, 1)


def simplify_name(name: Column | str) -> Column:
    return F.regexp_replace(_col(name), "[^A-Za-z0-9]+", "_")


def pretty_taxon(taxon: Column | str) -> Column:
    t = _col(taxon)
    species = F.get(F.split(t, r"\."), F.lit(1))
    return (
        F.when(t.contains("s__"), F.replace(F.replace(species, F.lit("s__"), F.lit("")), F.lit("_"), F.lit(" ")))
        .when(t.contains("g__"), F.replace(F.replace(t, F.lit("g__"), F.lit("")), F.lit("_"), F.lit(" ")))
        .otherwise(t)
    )


def round_to(value: Column | str, precision: int | None) -> Column:
    """Half-even rounding to ``precision`` decimals, nothing when ``None``."""
    return _col(value) if precision is None else F.bround(_col(value), precision)


def significant(value: Column | str, digits: int = 6) -> Column:
    """Round to a number of significant digits, as a double."""
    return F.format_string(f"%.{digits - 1}e", _col(value)).cast("double")


def clean_sample_name(sample: Column | str) -> Column:
    # Fixed value: the characters that sample names keep in file names (a dash is not one).
    return F.regexp_replace(_col(sample), "[^a-zA-Z0-9_|.]", "_")


def rename_sample(sample: Column | str, units: str, suffix: str = "-RPKs") -> Column:
    """``X-RPKs`` becomes ``X-CPM``; a name without the suffix gets ``-CPM`` appended."""
    s = _col(sample)
    unit = "-" + units.upper()
    return F.when(s.endswith(suffix), F.regexp_replace(s, suffix + "$", unit)).otherwise(
        F.concat(s, F.lit(unit))
    )
