"""Tables whose own columns have the names that the operators use or return."""

import corpus_pipeline
import pytest
from llm_samples import prose
from pyspark.sql import functions as F

from tidewatch.llm import language_id, mix, quality_model, quality_rules, url_filter
from tidewatch.llm.common import pack

NAMES = (
    "_ _packed _words _lines _runs _ordered _places _of _trusted _letter _lang _count _rank won host path rule verdict "
    "high middle limit kept n_tokens log_perplexity score lang_pred held_out n_words base_failed size target copies "
    "source_size rest key bits band slice component set_id node n_shingles group first expression digest short"
).split()


def documents(spark):
    rows = [(k, prose(k % 40, 40 + k % 30), "en" if k % 3 else "de", f"s{k % 2}") for k in range(160)]
    rows += [(500, None, "en", "s0"), (501, "", None, None), (None, prose(3), "en", "s1"), (502, prose(5, 20_000), "de", "s0"), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    own = [F.concat(F.lit(f"{name} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(name) for name in NAMES]
    return df.select("doc_id", "text", *own, "lang", "source").repartition(3)


def own_values(df, names):
    for row in df.select("doc_id", *names).collect():
        for name in names:
            assert row[name] == f"{name} of {'none' if row.doc_id is None else row.doc_id}", name


def labels(spark):
    return spark.createDataFrame([(k, 1, 0) for k in range(160)], "doc_id long, quality int, toxic int")


def operators(spark):
    yield "rules", lambda d: quality_rules.judge(d), {*quality_rules.MEASURES, "base_failed", "kept"}
    yield "urls", lambda d: url_filter.judge_urls(
        d.withColumn("url", F.lit("http://a.net/x")), url_filter.rule_table(spark, url_filter.RULES)
    ), {"host", "path", "rule", "verdict"}
    yield "model", lambda d: quality_model.classify(d, labels(spark)), {"n_tokens", "log_perplexity", "limit", "kept"}
    yield "language", lambda d: language_id.identify(d, language_id.Training(steps=8)), {"held_out", "lang_pred", "score"}
    yield "mix", lambda d: mix.mix_copies(d), {"size", "source_size", "target", "copies"}


@pytest.mark.parametrize("which", range(5))
def test_operators_keep_foreign_columns(spark, which):
    _, job, made = list(operators(spark))[which]
    docs = documents(spark)
    result = job(docs)
    own_values(result, [n for n in NAMES if n not in made])
    assert result.count() == docs.count()
    assert len(set(result.columns)) == len(result.columns) and made <= set(result.columns)


def test_stages_return_the_columns_of_their_input(spark, tmp_path, monkeypatch):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, str(tmp_path))
        assert result.columns == docs.columns, name
        own_values(result, NAMES)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert last.count() == docs.count()


def test_empty_table_through_all_stages(spark, tmp_path):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents(spark).where("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0, name


def test_pack_gives_everything_back(spark):
    df = documents(spark)
    packed, unpack = pack(df, "doc_id", "text")
    assert packed.columns == ["doc_id", "text", "_packed"]
    assert unpack(packed).columns == df.columns and unpack(packed).exceptAll(df).count() == 0
    replaced = unpack(packed.withColumn("SCORE", F.lit(1)), "SCORE")
    assert "score" not in replaced.columns and replaced.columns[-1] == "SCORE"
    alone, back = pack(df.select("text"), "text")
    assert alone.columns == ["text"] and back(alone).columns == ["text"]
