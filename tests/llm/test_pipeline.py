"""The stages on their own input, and the queries on the smallest tables."""

import duckdb
import pytest

import corpus_pipeline
from compare import difference, duck
from wavesym.llm.catalog import QUERIES
from wavesym.llm.oracle import ORACLE_SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), duck(FOLDER), ORACLE_SQL[name]) is None


def test_every_operator_is_a_query():
    assert sorted(int(q.split("_")[0][2:]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_a_stage_keeps_columns_and_clean_rows(spark, name, stage):
    item = duckdb.sql(f"select text from '{FOLDER}/benchmark.parquet' limit 1").fetchall()[0][0] if name == "decontamination" else ""
    clean = " ".join(f"clean{k}" for k in range(60))
    near = clean.replace("clean30", "other")
    rows = [(1, clean, None, "g", "k"), (2, near, "en", "g", "k"), (3, clean.replace(" ", "  "), "en", None, "k"), (4, None, "en", "g", None), (None, "no id", "en", "g", "k"), (6, f"intro words {item} end", "en", "g", "k"), (7, "", "en", "g", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone string, `Row` string, digest string")
    got = stage(spark, docs, FOLDER)
    assert got.columns == docs.columns
    ids = sorted((r.doc_id for r in got.collect()), key=str)
    want = {
        "toxicity": [1, 2, 3, 4, 6, 7, None],
        "exact_dedup": [1, 2, 4, 6, None],
        "near_dedup": [1, 4, 6, 7, None],
        "decontamination": [1, 2, 3, 4, 7, None],
    }
    assert ids == want[name]
    assert stage(spark, docs.limit(0), FOLDER).collect() == []


def test_the_packing_stage_places_every_id_once(spark):
    long = "word " * 40_000
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "y"), (None, "", None), (3, long, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place string")
    name, stage = corpus_pipeline.STAGES[-1]
    got = stage(spark, docs, FOLDER).collect()
    assert name == "packing" and len({(r.doc_id, r.piece) for r in got}) == len(got) - 1  # the repeated row
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in used.values():
        ends = [0]
        for offset, length in sorted(own):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
    assert stage(spark, docs.limit(0), FOLDER).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
@pytest.mark.parametrize("few", [0, 1_000_000])
def test_long_texts_and_repeated_rows(spark, monkeypatch, name, stage, few):
    monkeypatch.setattr(corpus_pipeline, "FEW", few)  # joins by shuffle as well as by broadcast
    long = " ".join(f"clean{k}" for k in range(30_000))
    rows = [(1, long), (1, long), (2, long.replace(" ", "  ", 1)), (3, "one two three"), (3, "one two three"), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id for r in stage(spark, docs, FOLDER).collect()), key=str)
    want = {"exact_dedup": [1, 3, None], "near_dedup": [1, 1, 3, 3, None, None]}
    assert got == want.get(name, [1, 1, 2, 3, 3, None, None])


def test_an_empty_corpus_stays_empty(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_the_pipeline_packs_what_stays(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    known = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()}
    kept = {r.doc_id for r in rows}
    assert kept <= known and 0.5 * len(known) < len(kept) < len(known)
