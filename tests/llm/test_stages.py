"""What the stages do to tables that are not as expected: clashing names, nulls, repeated rows, no rows; how often they run Python."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from agentlake.llm import bpe, langid, secrets
from agentlake.llm.rows import table

HELPERS = (
    "row key text_key doc_key k t _t _k _s _n _h _r _p _at _copy _size _times _rows _all _group _whole _role _block _text_key spans linked "
    "parts p fp label low component_id node found often once none size target times source_size raw held_out lang_pred score r n word piece"
).split()

#: In the tables' invented English, which is learned from.
SAME = "Is and retitioning ouen the of, nterti thorreou ndernt with the ndble whst the by for and threea"
OTHER = "Eaen onhe and onen this antire inger, the ofonndednd erea this edoued ble onthonshsh, this by enores"
LONE = "Thnt eringing onheed, with erenenst thaner ing tionha and, the by this anshwh, oninnting onndre ed the"


@pytest.fixture(scope="module")
def docs(spark, sf):
    return table(spark, sf, "documents")


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_all_columns_stay(spark, sf, docs, stage):
    wide = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.col("doc_id")).alias(c) for c in HELPERS])
    out = stage[1](spark, wide, sf)
    assert out.columns == wide.columns
    for r in out.collect():
        assert all(r[c] == f"{c} of {r.doc_id}" for c in HELPERS)
    # and the names change nothing
    plain = stage[1](spark, docs, sf)
    assert sorted(map(str, plain.collect())) == sorted(map(str, out.select(docs.columns).collect()))


@pytest.fixture(scope="module")
def odd(spark, docs):
    long = "word " * 60_000
    rows = [(None, None, None, None, None), (None, None, None, None, None), (9001, "", "en", "a", 0), (9002, long, "en", None, None)]
    rows += [(9003, f"{SAME}, password = abcdefgh12", "en", "s", 1)] * 3
    rows += [(9003, f"{OTHER}, password = abcdefgh12", "en", "s", 1), (None, LONE, None, "s", 2)]
    rows += [(9004, "123 456 !", "de", "b", 9), (None, LONE, None, "s", 2)]
    return docs.unionByName(spark.createDataFrame(rows, docs.schema))


def test_odd_rows_through_all_stages(spark, sf, odd, tmp_path):
    path = f"{tmp_path}/odd/documents.parquet"
    odd.write.parquet(path)
    out = odd
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, sf)
        rows = out.collect()
        out = spark.createDataFrame(rows, out.schema)
        seen[name] = [(r.doc_id, getattr(r, "text", None)) for r in rows]
    kept = seen["language"]
    assert not [r for r in kept if not r[1] or r[0] == 9004] and kept.count((None, LONE)) == 2
    assert len([r for r in kept if r[0] == 9003]) == 4
    one = seen["near_duplicates"]
    assert one.count((None, LONE)) == 1 and len([r for r in one if r[0] == 9003]) == 2
    assert all("abcdefgh12" not in (t or "") for _, t in seen["secret_spans"])
    assert sorted(r.doc_id or -1 for r in corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()) == sorted(r[0] or -1 for r in seen["tokens"])


def test_no_rows(spark, sf, docs, tmp_path):
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def evaluations(df):
    return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_python_runs_once_a_text(docs):
    assert evaluations(langid.kept_languages(docs, public_tokenizers.path("piece_bpe_32k.model"))) == 1
    assert evaluations(bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))) == 1


def test_long_runs_are_learned_from_to_their_ends():
    ends, into = {"a", "b", "▁", "▁a"}, {}
    langid._expected("a" * 450 + "b" * 30, 1.0, {"a": 0.5, "b": 0.5, "▁a": 0.1}, ends, into)
    assert into["b"] == pytest.approx(30) and into["a"] + into["▁a"] == pytest.approx(450)


def test_a_text_is_scanned_once(docs):
    held = docs.select("doc_id", secrets._parts("text").alias("parts")).where(F.size("parts") > 0)
    assert evaluations(held) == 1
