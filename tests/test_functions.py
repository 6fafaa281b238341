"""Column functions on worked values."""

import math

import pytest
from pyspark.sql import functions as F

from abundix.functions import alignments as al, features as ft, references as ref, sequences as sq, statistics as st


def one(frame, expression, **values):
    names = list(values) or ["x"]
    kinds = {str: "string", int: "int", float: "double"}
    schema = ", ".join(f"{n} {kinds[type(values[n])]}" if n in values else f"{n} int" for n in names)
    row = tuple(values.get(n, 0) for n in names)
    return frame([row], schema).select(expression.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "feature, parts",
    [
        ("G1", ("G1", None, None)),
        ("G1: tRNA: proline|g__A.s__B", ("G1", "tRNA: proline", "g__A.s__B")),
        ("G1|unclassified", ("G1", None, "unclassified")),
        ("UNMAPPED", ("UNMAPPED", None, None)),
    ],
)
def test_split_and_join_feature(frame, feature, parts):
    row = ft.split_feature(frame([(feature,)], "feature string")).first()
    assert (row["code"], row["name"], row["stratum"]) == parts
    df = ft.split_feature(frame([(feature,)], "feature string"))
    assert df.select(ft.join_feature().alias("f")).first()["f"] == feature


def test_second_separator_is_an_error(frame):
    with pytest.raises(Exception, match="bad feature name"):
        ft.split_feature(frame([("a|b|c",)], "feature string")).collect()


def test_names_and_taxa(frame):
    assert one(frame, ft.genus_of("x"), x="g__A.s__B") == "g__A"
    assert one(frame, ft.simplify_name("x"), x="a (b)/c") == "a_b_c"
    assert one(frame, ft.pretty_taxon("x"), x="g__X.s__Y_z") == "Y z"
    assert one(frame, ft.pretty_taxon("x"), x="g__X_y") == "X y"
    assert one(frame, ft.pretty_taxon("x"), x="other") == "other"
    assert one(frame, ft.clean_sample_name("x"), x="a-b c|d.e_f") == "a_b_c|d.e_f"
    assert one(frame, ft.rename_sample("x", "relab"), x="s-RPKs") == "s-RELAB"
    assert one(frame, ft.rename_sample("x", "cpm"), x="s") == "s-CPM"


def test_rounding(frame):
    assert one(frame, ft.round_to("x", 0), x=2.5) == 2.0
    assert one(frame, ft.round_to("x", None), x=2.5) == 2.5
    assert one(frame, ft.significant("x"), x=123456.789) == 123457.0
    assert one(frame, ft.significant("x"), x=0.000123456789) == 0.000123457
    assert one(frame, ft.significant("x"), x=0.0) == 0.0


@pytest.mark.parametrize(
    "reference, expected",
    [
        ("id|g__A.s__B|UniRef90_x|UniRef50_y|900", ("UniRef90_x", 900, "g__A.s__B")),
        ("id|k.p.g__A.s__B|UniRef90_x|UniRef50_y|900", ("UniRef90_x", 900, "g__A.s__B")),
        ("gene|120|taxon", ("gene", 120, "taxon")),
        ("gene|120", ("gene", 120, "unclassified")),
        ("120|gene", ("gene", 120, "unclassified")),
        ("gene", ("gene", 0, "unclassified")),
        ("gene|other", ("gene|other", 0, "unclassified")),
        ("a|b.c|d", ("d", 0, "b.c")),
        ("a|1|2", ("2", 0, "unclassified")),
        ("id|SGB7|u90|u50|30", ("u90", 30, "s__known.t__SGB7")),
        ("id|SGB8|u90|u50|x", ("u90", 0, "unclassified.t__SGB8")),
    ],
)
def test_parse_reference(frame, reference, expected):
    clades = frame([("SGB7", "s__known")], "clade string, species string")
    row = ref.parse_reference(frame([(reference,)], "reference string"), clade_species=clades).first()
    assert (row["gene"], row["gene_length"], row["bug"]) == expected


def test_parse_reference_with_other_gene_fields(frame):
    df = frame([("id|g__A.s__B|u90|u50|900",)], "reference string")
    assert ref.parse_reference(df, gene_fields=(3,)).first()["gene"] == "u50"
    assert ref.parse_reference(df, gene_fields=(2, 3)).first()["gene"] == "u90|u50"


@pytest.mark.parametrize(
    "location, length", [(":1-10", 10), ("c10-1", 10), (":1-10,:20-29", 20), ("1-2-3", 0), ("a-b", 0), ("7", 0), ("1-10,x", 0)]
)
def test_location_length(frame, location, length):
    assert one(frame, ref.location_length("x"), x=location) == length


def test_length_annotations(frame):
    assert one(frame, ref.add_length_annotation("x", F.lit(30)), x="read 1") == "read|30"
    assert one(frame, ref.add_length_annotation("x", F.lit(30)), x="read|30") == "read|30"
    assert one(frame, ref.remove_length_annotation("x"), x="a|b|30") == "a|b"
    assert one(frame, ref.annotated_length("x"), x="a|b|30") == 30
    assert one(frame, ref.annotated_length("x"), x="a|b") == 1
    assert one(frame, ref.annotated_id("x"), x="a|b") == "a|b"


def test_cigar(frame):
    assert one(frame, al.cigar_aligned_length("x"), x="5S10M2I3D4N1=1X") == 17
    assert one(frame, al.cigar_reference_length("x"), x="5S10M2I3D4N1=1X") == 19
    assert one(frame, al.md_matches("x"), x="MD:Z:10A5^AC6") == 21
    assert one(frame, al.cigar_identity("x", F.lit("MD:Z:8A1")), x="10M") == 90.0
    assert one(frame, al.cigar_identity("x", F.lit("")), x="*") == 0.0
    tags = frame([(["AS:i:1", "MD:Z:4"],), ([],)], "t array<string>").select(al.md_tag("t").alias("m"))
    assert [r["m"] for r in tags.collect()] == ["MD:Z:4", ""]


def test_hit_arithmetic(frame):
    assert one(frame, al.match_count(F.lit(50.0), F.lit(30.0))) == 15.0
    assert one(frame, al.evalue("x"), x="1e-5") == 1e-5
    assert one(frame, al.evalue("x"), x="?") == 1.0
    assert one(frame, al.evalue("x", True), x="-2") == 0.01
    assert one(frame, al.evalue("x", True), x="400") == 1.0
    assert one(frame, al.query_coverage(F.lit(1), F.lit(10), F.lit(20))) == 50.0
    assert one(frame, al.query_coverage(F.lit(1), F.lit(10), F.lit(1))) is None
    assert one(frame, al.normalized_length(F.lit(2000), F.lit(100), al.RPK)) == 2.0
    assert one(frame, al.normalized_length(F.lit(2000), F.lit(100))) == 1.901
    assert one(frame, al.normalized_length(F.lit(0), F.lit(0))) == 1.0
    assert one(frame, al.hit_score(F.lit(3.0))) == 9.0


@pytest.mark.parametrize(
    "x, k, p", [(1.0, 1.0, 0.6826894921370859), (4.0, 2.0, 1 - math.exp(-2)), (0.0, 3.0, 0.0), (7.0, 7.0, 0.5711201), (5000.0, 10.0, 1.0)]
)
def test_chi2_cdf(frame, x, k, p):
    assert one(frame, st.chi2_cdf("x", "k"), x=x, k=k) == pytest.approx(p, abs=1e-7)


def test_chi2_tail_keeps_small_values(frame):
    assert one(frame, st.chi2_sf("x", F.lit(4)), x=100.0) == pytest.approx(math.exp(-50) * 51, rel=1e-9)
    assert one(frame, st.chi2_sf("x", F.lit(2)), x=0.5) == pytest.approx(math.exp(-0.25), rel=1e-12)


def test_spearman_p(frame):
    # two samples more than the degrees of freedom; 2 df have a closed form: 1 - |rho|
    assert one(frame, st.spearman_p("x", F.lit(4)), x=0.6) == pytest.approx(0.4, abs=1e-12)
    assert one(frame, st.spearman_p("x", F.lit(10)), x=0.5) == pytest.approx(0.1411, abs=1e-4)
    assert one(frame, st.spearman_p("x", F.lit(10)), x=1.0) == 0.0
    assert one(frame, st.spearman_p("x", F.lit(10)), x=0.0) == pytest.approx(1.0)


def test_log_transform(frame):
    assert one(frame, st.log_transform("x", 2), x=8.0) == pytest.approx(3.0)


def slow_frames(sequence):
    table = {}
    for i, a in enumerate("TCAG"):
        for j, b in enumerate("TCAG"):
            for k, c in enumerate("TCAG"):
                table[a + b + c] = sq.GENETIC_CODE[16 * i + 4 * j + k]
    sequence = sequence.upper()
    flipped = "".join({"A": "T", "T": "A", "C": "G", "G": "C"}.get(b, "N") for b in reversed(sequence))
    out = {}
    for strand, first in ((sequence, 0), (flipped, 3)):
        for frame in range(3):
            peptide = "".join(table.get(strand[i : i + 3], "X") for i in range(frame, len(strand) - 2, 3))
            if peptide and "*" not in peptide and "X" not in peptide:
                out[first + frame] = peptide
    return out


def test_translate_frames(frame):
    sequences = ["ATGGCC", "atggcctaa", "ATGNCCAAA", "AT", "", "TTTTTTTTTTTT", "ACGTACGTACGTACGTAAC", "GATTACAß"]
    df = frame([(s,) for s in sequences] + [(None,)], "sequence string").repartition(2)
    got = {}
    for row in sq.translate_frames(df).collect():
        got.setdefault(row["sequence"], {})[row["frame"]] = row["peptide"]
    assert got == {s: slow_frames(s) for s in sequences if slow_frames(s)}
    assert one(frame, sq.reverse_complement("x"), x="aCGTn") == "NACGT"
