import hashlib

import corpus_pipeline
import __spark_entry__
from llm_samples import prose
from tidewatch.llm.mix import mix_copies


def write(spark, tmp_path, rows, labels):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages_against_brute_force(spark, tmp_path):
    clean = [(k, prose(k, 60), "en", f"s{k % 2}", 1) for k in range(80)]
    copies = [(100 + k, prose(k, 60) + (" end" if k % 2 else ""), "en", "s1", 1) for k in range(10)]
    junk = [(200 + k, " | ".join(f"Zq{k}x{i}" for i in range(50)), "en", "s0", 1) for k in range(8)]
    odd = [(300, None, None, None, None), (301, "", "en", "s0", 0), (302, "12 34 ...", "en", "s0", 1)]
    folder = write(spark, tmp_path, clean + copies + junk + odd, [(k, 1, 0) for k in range(60)])

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        counts.append(sorted({r.doc_id for r in docs.collect()}))
    assert not set(counts[0]) & {r[0] for r in junk} and set(range(80)) <= set(counts[0])
    assert 300 not in counts[0] and set(range(80)) <= set(counts[1])
    assert set(counts[2]) >= set(range(80)) and not set(counts[2]) & set(range(100, 110))

    library = corpus_pipeline.encode_documents(docs, with_ids=True).collect()
    final = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(tuple, final)) == sorted(tuple(r)[:4] for r in library)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in final:
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_last_two_stages_mix(spark):
    docs = spark.createDataFrame([(k, prose(k, 30), "en", f"s{k % 3}", 1) for k in range(60)], "doc_id long, text string, lang string, source string, n_chars long")
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    assert mixed.count() == mix_copies(docs).groupBy().sum("copies").first()[0]


def test_registered():
    names = set(__spark_entry__.queries())
    assert {"pipeline"} | {f"op{k}_" for k in range(1, 14)} == {
        n if n == "pipeline" else n[: n.index("_") + 1] for n in names if n == "pipeline" or n.startswith("op") and n[2].isdigit()
    }
