import corpus_pipeline
from abundix.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F

from tests.llm.conftest import prose


def test_stages(spark, tmp_path):
    toxic = ["scoundrel", "villain", "knave"]
    rows, labels = [], []
    for i in range(900):
        text = prose(60 + i % 50, i)
        if i % 5 == 0:
            text = f"{text} {toxic[i % 3]} {toxic[(i // 5) % 3]}."
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int(i % 5 == 0)))
    rows += [(2000 + i, rows[7 * i + 1][1], "en", "s0", 1) for i in range(40) if (7 * i + 1) % 5]
    base = rows[3][1]
    rows += [(3000 + i, base.replace(" ", f" q{i} ", 1), "en", "s1", 1) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        kept[name] = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.columns == docs.columns
        docs = kept[name]
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in kept.items()}
    assert not [i for i in ids["toxicity"] if i < 900 and i % 5 == 0]
    assert len(ids["toxicity"]) >= 0.99 * (len(rows) - 180)
    texts = {}
    for i, t, *_ in rows:
        if i in ids["toxicity"]:
            texts[t] = max(i, texts.get(t, -1))
    assert ids["exact_dedup"] == set(texts.values())
    family = {3, *range(3000, 3020)} & ids["exact_dedup"]
    assert ids["ngram_jaccard"] == ids["exact_dedup"] - family | {min(family)}
    assert ids["source_mix"] <= ids["ngram_jaccard"] and kept["source_mix"].count() > len(ids["source_mix"])
    tokens = kept["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert tokens <= 4096 and ids["packing"] == ids["source_mix"]


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert {n.split("_")[0] for n in ORACLES} == {"op1", "op2", "op3", "op5", "op9", "op10"}
