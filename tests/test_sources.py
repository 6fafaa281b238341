"""Readers and writers on small files, also cut into many splits."""

import bz2
import gzip

import pytest
from pyspark.sql import functions as F

from abundix.plans.profiles import cohort_table
from abundix.sources import alignments as al, mappings as mp, sequences as sq, tables as st
from tests.conftest import as_dict


@pytest.fixture(params=[None, 64], ids=["whole", "split"])
def splits(request, spark):
    """Read files whole, or in splits of a few lines."""
    if request.param is None:
        yield
        return
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, str(request.param))
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def write(path, text):
    path.write_text(text)
    return str(path)


def cells(df):
    return as_dict(df, ("code", "stratum", "sample"), "value")


def test_feature_table(spark, tmp_path, splits):
    body = "".join(f"G{i}: name {i}|g__A.s__B\t{i}\tx\n" for i in range(40))
    path = write(tmp_path / "t.tsv", "#first\n# Feature\ts1\ts2\nG\t1\t2.5\n\n#late\t3\t4\n" + body)
    got = cells(st.read_feature_table(spark, path))
    assert got[("G", None, "s2")] == 2.5 and got[("#late", None, "s1")] == 3.0
    assert got[("G7", "g__A.s__B", "s1")] == 7.0 and got[("G7", "g__A.s__B", "s2")] == 0.0
    assert len(got) == 84
    row = st.read_feature_table(spark, path).where("code = 'G3'").first()
    assert (row["name"], row["source"]) == ("name 3", "t")


def test_first_line_is_the_header_without_a_comment(spark, tmp_path, splits):
    path = write(tmp_path / "t.tsv", "ID\ta\nG\t1\nH\t2\n")
    assert cells(st.read_feature_table(spark, path)) == {("G", None, "a"): 1.0, ("H", None, "a"): 2.0}


def test_compressed_and_many_files(spark, tmp_path):
    (tmp_path / "a.tsv.gz").write_bytes(gzip.compress(b"# F\ts1\nG\t1\n"))
    (tmp_path / "b.tsv.bz2").write_bytes(bz2.compress(b"# F\ts2\ts3\nG\t2\t3\nH\t4\t5\n"))
    write(tmp_path / "c.tsv", "s\ts4\nH\t9\n")
    paths = [str(tmp_path / n) for n in ("a.tsv.gz", "b.tsv.bz2", "c.tsv")]
    dense = cells(cohort_table(spark, paths, dense=True))
    assert len(dense) == 8
    assert (dense[("G", None, "s3")], dense[("H", None, "s1")], dense[("H", None, "s4")]) == (3.0, 0.0, 9.0)


def test_equal_sample_names_become_file_names(spark, tmp_path):
    paths = [write(tmp_path / f"{n}.tsv", f"# F\tAbundance\nG\t{n}\n") for n in (1, 2)]
    assert cells(cohort_table(spark, paths)) == {("G", None, "1"): 1.0, ("G", None, "2"): 2.0}


def test_round_trip(spark, tmp_path, frame):
    rows = [("UNMAPPED", None, None, "s 1", 10.0), ("A", "n: \"quoted\"", "g__X", "s 1", 1 / 3), ("A", None, None, "s-2", 2.0)]
    table = frame(rows, "code string, name string, stratum string, sample string, value double")
    st.write_feature_table(table, str(tmp_path / "w"))
    back = st.read_feature_table(spark, str(tmp_path / "w")).where("value > 0")
    assert {(r["code"], r["name"], r["stratum"], r["sample"], r["value"]) for r in back.collect()} == {
        ("UNMAPPED", None, None, "s 1", 10.0), ("A", "n: \"quoted\"", "g__X", "s 1", 0.333333), ("A", None, None, "s-2", 2.0)
    }
    st.write_per_sample(table, str(tmp_path / "p"))
    assert {p.name for p in (tmp_path / "p").glob("sample_file=*")} == {"sample_file=s_1", "sample_file=s_2"}


def test_profile_lines_are_in_order(spark, tmp_path, frame):
    rows = [("READS_UNMAPPED", None, 1.0), ("A", None, 2.0), ("B", None, 5.0), ("B", "x", 1.0), ("B", "y", 4.0), ("A", "x", 2.0)]
    table = frame([(c, None, s, "one", v) for c, s, v in rows],
                  "code string, name string, stratum string, sample string, value double").repartition(4)
    st.write_profile(table, str(tmp_path / "w"), digits=2)
    files = sorted((tmp_path / "w" / "sample_file=one").glob("*.csv"))
    lines = [x for f in files for x in f.read_text().splitlines()]
    lines = [x for x in lines if not x.startswith("# Gene Family")]
    assert lines == ["READS_UNMAPPED\t1.00", "B\t5.00", "B|y\t4.00", "B|x\t1.00", "A\t2.00", "A|x\t2.00"]
    st.write_profile(table, str(tmp_path / "c"), stratified=False)
    text = "".join(f.read_text() for f in (tmp_path / "c").rglob("*.csv"))
    assert "|" not in text and "B\t5.0000000000" in text


def test_gene_table(spark, tmp_path, frame):
    path = write(tmp_path / "g.tsv", "# Gene\ts\nREADS_UNMAPPED\t7\nA: name\t3\nA: name|x\t2\nB|y\tbad\n")
    scores, unmapped = st.read_gene_table(spark, path)
    assert as_dict(scores, ("gene", "bug"), "score") == {("A", "all"): 3.0, ("A", "x"): 2.0, ("B", "y"): 0.0}
    assert unmapped.first()["unmapped"] == 7.0
    mapping = frame([("A: name", "M", 1, "m")], "reference string, gene string, length int, bug string")
    assert as_dict(st.read_gene_table(spark, path, mapping)[0], ("gene", "bug"), "score")[("M", "m")] == 3.0


def test_metadata_table(spark, tmp_path, splits):
    body = "".join(f"F{i}\t{i}\t1\n" for i in range(30))
    path = write(tmp_path / "m.tsv", "ID\ts1\ts2\nage\t30\tNA\nsite\tgut\tskin\n" + body + "F1|x\t1\t1\n")
    metadata, values = st.read_metadata_table(spark, path, "site")
    assert as_dict(metadata, ("key", "sample"), "value") == {
        ("age", "s1"): "30", ("age", "s2"): "NA", ("site", "s1"): "gut", ("site", "s2"): "skin"
    }
    assert values.count() == 62 and as_dict(values, ("feature", "sample"), "value")[("F9", "s1")] == 9.0


def test_m8(spark, tmp_path, splits):
    line = "q|30\tg|900\t90.5\t30\t1\t0\t1\t30\t5\t34\t-3\t55\n"
    plain = write(tmp_path / "plain.m8", "# Fields: query\n" + line.replace("-3", "0.5") + line.replace("90.5", "?"))
    logged = write(tmp_path / "log.m8", "#" + "\t".join(["x"] * 10 + ["log(e-value)", "b"]) + "\n" + line)
    rows = al.read_hits_m8(spark, [plain, logged]).collect()
    assert sorted((r["identity"], round(r["evalue"], 6)) for r in rows) == [(0.0, -3.0), (90.5, 0.001), (90.5, 0.5)]
    assert al.read_hits_m8(spark, plain, log_evalue=True).where("evalue < 0.01").count() == 1


def test_sam(spark, tmp_path, splits):
    text = "@HD\tVN:1\nr1\t0\tg|100\t11\t9\t5M1D5M\t*\t0\t0\tACGTACGTAC\tIIII\tAS:i:1\tMD:Z:5^A5\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\t@@\n"
    rows = {r["query"]: r for r in al.read_hits_sam(spark, write(tmp_path / "a.sam", text)).collect()}
    assert (rows["r1"]["s_start"], rows["r1"]["s_end"], rows["r1"]["aligned_length"]) == (11, 22, 11)
    assert rows["r1"]["identity"] == pytest.approx(100 * 10 / 11) and not rows["r1"]["unmapped"]
    assert rows["r2"]["unmapped"] and rows["r2"]["md"] == "" and rows["r2"]["sequence"] == "AC"


def test_fasta(spark, tmp_path, splits):
    text = ">a first one\nACGT\nAC\n>b\n\nGG\n" + "".join(f">r{i} x\nACGT{'A' * i}\nC\n" for i in range(20))
    got = as_dict(sq.read_fasta(spark, write(tmp_path / "s.fasta", text)), "id", "sequence")
    assert got["a"] == "ACGTAC" and got["b"] == "GG" and got["r19"] == "ACGT" + "A" * 19 + "C" and len(got) == 22


def test_fastq(spark, tmp_path, splits):
    text = "".join(f"@r{i} 1:N\nACGTN{'A' * (i % 5)}\n+\n@@@@ACGT\n" for i in range(25)) + "@bad\nAC-GT\n+\nIIIII\n"
    got = as_dict(sq.read_fastq(spark, write(tmp_path / "s.fastq", text)), "id", "sequence")
    assert len(got) == 25 and got["r3 1:N"] == "ACGTNAAA"


def test_fastq_lines_that_look_like_records(spark, tmp_path, splits):
    """Quality lines that start with @ (also alone), carriage returns, a cut last record, no last line end."""
    records = [(f"r{i}", "ACGTN"[: 1 + i % 5] * (1 + i % 3)) for i in range(60)]
    quality = ["@{}", "+{}", "@", "I{}", "@r1\tx"]
    text = "".join(f"@{n} x\n{s}\n+{n}\n{quality[i % 5].format('I' * len(s))}\n" for i, (n, s) in enumerate(records))
    want = {f"{n} x": s for n, s in records}
    for name, body in (("a", text), ("b", text.replace("\n", "\r\n")), ("c", text + "@last\nacgt"), ("d", text[:-1])):
        got = as_dict(sq.read_fastq(spark, write(tmp_path / f"{name}.fastq", body)), "id", "sequence")
        assert got == (want | {"last": "acgt"} if name == "c" else want)
    plan = sq.read_fastq(spark, str(tmp_path / "a.fastq"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_mappings(spark, tmp_path, splits, frame):
    path = write(tmp_path / "i.tsv", "#c\nr1\tg1\t90\tbug\nr2\tg2\t?\nr3\tg3\nr4\n")
    rows = [tuple(r) for r in mp.read_id_mapping(spark, path).orderBy("reference").collect()]
    assert rows == [("r1", "g1", 90, "bug"), ("r2", "g2", 0, "unclassified"), ("r3", "g3", 0, "unclassified")]

    path = write(tmp_path / "r.tsv", "R1\t1.1\ta\tb\ta\nR2\t1.2\nR3\t\tc\n")
    rows = sorted((r["reaction"], r["ec"], r["gene"]) for r in mp.read_reactions(spark, path).collect())
    assert rows == [("R1", "1.1", "a"), ("R1", "1.1", "a"), ("R1", "1.1", "b"), ("R3", "", "c")]
    plain = mp.read_reactions(spark, path, ec_column=False).where("reaction = 'R1'")
    assert sorted(r["gene"] for r in plain.collect()) == ["1.1", "a", "a", "b"]

    path = write(tmp_path / "p.tsv", "A\t1\t2\nB\t1\nB\t3\nC\t1\t2\t4\t4\n")
    pairs = {(r["key"], r["value"]) for r in mp.read_polymap(spark, path).collect()}
    assert pairs == {("A", "1"), ("A", "2"), ("B", "1"), ("B", "3"), ("C", "1"), ("C", "2"), ("C", "4")}
    some = mp.read_polymap(spark, path, skip=[1], allowed_keys=frame([("C",)], "k string"))
    assert {(r["key"], r["value"]) for r in some.collect()} == {("C", "2"), ("C", "4")}
    flipped = mp.read_polymap(spark, path, start=1, allowed_values=frame([("A",), ("B",)], "k string"))
    assert {(r["key"], r["value"]) for r in flipped.collect()} == {("1", "A"), ("1", "B"), ("3", "B")}

    path = write(tmp_path / "n.tsv", "a\told\n" + "".join(f"x{i}\tname {i}\n" for i in range(30)) + "a\tnew\nb\n")
    names = as_dict(mp.read_names(spark, path), "id", "name")
    assert names["a"] == "new" and names["x29"] == "name 29" and "b" not in names


def test_pathways(spark, tmp_path, splits):
    flat = write(tmp_path / "f.tsv", "P 1\tA\tB\nP2\tC\nP3\n")
    rows = sorted(tuple(r) for r in mp.read_pathways(spark, flat).collect())
    assert rows == [("P2", 0, "C"), ("P_1", 0, "A"), ("P_1", 1, "B")]
    assert not mp.is_structured(spark, flat)
    tree = write(tmp_path / "t.tsv", "P\t( A , -B ) C\n")
    assert mp.is_structured(spark, tree)
    nodes = mp.read_pathway_nodes(spark, tree)
    assert {(r["reaction"], r["is_key"]) for r in nodes.where("reaction is not null").collect()} == {
        ("A", True), ("B", False), ("C", True)
    }
    known = mp.read_pathway_nodes(spark, tree, frozenset({"-B"})).where("reaction = '-B'")
    assert known.first()["is_key"]
    assert mp.nodes_to_reactions(nodes).count() == 3


def test_profile_and_taxonomy(spark, tmp_path, splits):
    path = write(tmp_path / "p.tsv", "#db\n#clade\tid\tab\tcov\treads\nk__B|g__A\t1\t40.5\t0.9\t17\n")
    assert tuple(mp.read_taxonomic_profile(spark, path).first()) == ("k__B|g__A", 40.5, 0.9)
    tree = "".join(f"t{i}\tname {i}\tGenus\tRoot\n" for i in range(20))
    path = write(tmp_path / "t.tsv", "TAXID\tNAME\tRANK\tPARENT\n" + tree + "FAMILY\tSOURCE_TAX\tUNIREF_LCA\nU1\tt1\tt2\nU2\tt3\tt4\n")
    taxa, families = mp.read_taxonomy(spark, path)
    assert taxa.count() == 20 and as_dict(taxa, "taxid", "name")["t7"] == "name 7"
    assert [tuple(r) for r in families.orderBy("family").collect()] == [("U1", "t1", "t2"), ("U2", "t3", "t4")]
