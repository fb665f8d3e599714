"""Further columns, whatever they are called, neither clash nor change."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderloom.llm import (
    bagminhash, decontam, exact_dedup, langid, lemp, license_scan, merkle, mixing, pii, recompression, sharding,
    token_counts, warc_zip,
)
from orderloom.llm.common import boxed, picked, table, unboxed

NAMES = [
    "score", "n", "draw", "lang_pred", "__id", "__p", "__tokens", "__copy", "__shard", "__slot", "copies", "row", "_0", "_1",
    "node", "text_key", "own", "key", "copy", "item", "rank", "spans", "words", "digest", "tree", "place", "Row", "SCORE",
]
BASE = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark, names=NAMES):
    prose = [" ".join(f"w{(i * k) % 97}" for k in range(1, 40)) for i in range(1, 12)]
    rows = [(i, t, "en" if i % 2 else "fr", "s", len(t), *[f"{name}-{i}" for name in names]) for i, t in enumerate(prose)]
    rows += [(20, prose[3] + " end", "en", "s", 5, *[f"{name}-20" for name in names])]
    rows += [(21, prose[3], "en", "s", 5, *[f"{name}-21" for name in names])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, "
    return spark.createDataFrame(rows, schema + ", ".join(f"{name} string" for name in names))


def unchanged(out, docs, but=()):
    """All columns of the documents are there in their order, and each row has its own values."""
    kept = [c for c in docs.columns if c.lower() not in but]
    assert out.columns[: len(kept)] == kept
    rows = out.collect()
    assert rows
    own = {r[0]: tuple(r) for r in docs.select("doc_id").toDF("i").collect()}
    for r in rows:
        values = dict(zip(out.columns, r, strict=True))
        assert values["doc_id"] in own
        assert [values[c] for c in kept if c in NAMES] == [f"{c}-{values['doc_id']}" for c in kept if c in NAMES]
    return rows


def benchmark(spark):
    words = " ".join(f"w{(3 * k) % 97}" for k in range(1, 20))
    return spark.createDataFrame([("x", words, 1, "y", 2)], "n string, text string, item_id int, Text_key string, length int")


def labels(spark):
    return spark.createDataFrame([("x", 1, 1, 0, 3), ("x", 2, 0, 1, 3)], "n string, doc_id long, quality int, toxic int, Copies int")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages(spark, name, stage, monkeypatch):
    docs = documents(spark)
    given = {"benchmark": benchmark(spark), "labels": labels(spark)}
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, t: given[t])
    out = stage(spark, docs, "none")
    assert out.columns == docs.columns and out.schema.fieldNames() == docs.columns
    unchanged(out, docs)


def test_last_stage(spark):
    docs = documents(spark).withColumn("Slot", F.lit("old")).withColumn("shard", F.lit("old"))
    out = sharding.place(docs)
    assert out.columns == [*docs.columns[:-2], "slot", "shard"]
    unchanged(out, docs, but=("slot", "shard"))


def test_operators_that_return_documents(spark):
    docs = documents(spark)
    unchanged(exact_dedup.drop_duplicates(docs), docs)
    unchanged(bagminhash.representatives(docs), docs)
    unchanged(decontam.clean_documents(docs, benchmark(spark)), docs)
    unchanged(mixing.mixed(docs, labels(spark)), docs)
    unchanged(langid.languages_kept(docs, langid.fit(docs)), docs)


def test_operators_that_return_results(spark):
    """The same as on a table of their own columns alone."""
    docs = documents(spark)
    plain = docs.select(*BASE)
    pages = docs.toDF("page_id", "html", "lang", "url", "n_chars", *NAMES)

    def same(run):
        one, other = (sorted(map(str, run(d).collect())) for d in (docs, plain))
        assert one == other and one

    same(exact_dedup.exact_groups)
    same(pii.sanitised)
    same(lambda d: decontam.contamination(d, benchmark(spark)))
    same(recompression.without_repeats)
    same(bagminhash.near_groups)
    same(lambda d: lemp.ranked(d, benchmark(spark)))
    same(merkle.verified)
    same(lambda d: mixing.rates(d, labels(spark)))
    same(license_scan.licenses) if license_scan.licenses(plain).count() else None
    same(lambda d: token_counts.token_counts(d, token_model()))
    assert warc_zip.round_trip(spark, pages).count() == pages.count()


def token_model():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def test_columns_that_differ_in_case(spark):
    docs = spark.createDataFrame([("a", 1, "b", "t")], "Text string, doc_id long, DOC_ID string, text string")
    assert [tuple(r) for r in picked(docs, key="doc_id", words="text").collect()] == [(1, "t")]
    back = unboxed(boxed(docs, text="doc_id").withColumn("more", F.lit(2)), docs, "more", without=("text",))
    assert back.columns == ["doc_id", "DOC_ID", "more"] and tuple(back.head()) == (1, "b", 2)
    assert picked(spark.createDataFrame([("a",)], "TEXT string"), t="text").head()["t"] == "a"
    with pytest.raises(ValueError, match="2 columns are called"):
        picked(docs, t="TeXt")
    with pytest.raises(ValueError, match="0 columns are called"):
        picked(docs, t="other")


def test_a_pipeline_over_a_table_of_such_columns(spark, tmp_path):
    one_case = [n for n in NAMES if n.lower() not in ("score", "row")]
    docs = documents(spark, one_case).withColumn("Score", F.lit(0.5))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*docs.columns, "slot", "shard"]
    assert {r["Score"] for r in unchanged(out, table(spark, str(tmp_path), "documents"))} == {0.5}
