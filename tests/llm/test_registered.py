"""The registered queries over sf0.001: contracts, oracles and the pipeline's stages."""

import hashlib

import duckdb
import pytest

import corpus_pipeline
from cascata.llm import decontaminate, ngram_join, queries

BASE = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "benchmark", "labels", "conversations")

COLUMNS = {
    "op1_neighbour_quality": ["doc_id", "held_out", "score", "predicted"],
    "op2_token_planes": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op3_disclosure_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op4_compression_langid": ["doc_id", "held_out", "lang_pred", "score"],
    "op5_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op6_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op7_block_topk": ["query_id", "rank", "vec_id", "score"],
    "op8_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op9_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op10_unigram_counts": ["doc_id", "n_tokens"],
    "op11_ball_simhash": ["doc_id", "fingerprint", "component_id"],
    "op12_turn_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op13_treap_search": ["item_id", "rank", "doc_id", "score"],
}


def test_every_operator_is_registered():
    assert set(queries.queries()) == set(COLUMNS)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    got = queries.queries()[name](spark, BASE)
    assert got.columns[:len(COLUMNS[name])] == COLUMNS[name]
    if "doc_id" in got.columns and "rank" not in got.columns:
        assert got.count() == spark.read.parquet(f"{BASE}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{BASE}/{t}.parquet')")
    got = queries.queries()[name](spark, BASE)
    res = con.execute(queries.oracles()[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, res.fetchall()))


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, BASE)
        assert out.columns == columns, name
        assert out.schema.simpleString() == docs.schema.simpleString()
        after = out.count()
        assert 0 < after <= before
        assert (after == before) == (name == "personal_data")
        if name == "near_duplicates":
            left = ngram_join.join(out, 5, 80)
            assert left.where("doc_id <> component_id").count() == 0
        if name == "decontamination":
            bench = spark.read.parquet(f"{BASE}/benchmark.parquet")
            assert decontaminate.contamination(out, bench).where("contaminated").count() == 0
        docs, before = out, after


def test_pipeline_runs_to_token_ids(spark):
    out = corpus_pipeline.run(spark, BASE)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = out.collect()
    assert 0 < len(rows) < 200
    clean = spark.read.parquet(f"{BASE}/documents.parquet")
    source = {r["doc_id"]: r["text"] for r in clean.collect()}
    same = sum(hashlib.sha256(source[r["doc_id"]].encode()).hexdigest() == r["decoded_sha256"] for r in rows)
    assert same > 0.5 * len(rows)      # texts without personal data come through unchanged


def test_documents_without_the_known_columns(spark):
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "one two three four five six")], "doc_id long, text string")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, odd, BASE).columns == ["doc_id", "text"], name
        assert stage(spark, odd.limit(0), BASE).count() == 0, name


def test_stages_pass_any_other_columns_through(spark):
    """Names that the stages use inside, with dots, with backticks' worth of blanks: all come back as they were."""
    texts = ["one two three four five six seven", "one two three four five six seven", None, "", "mail me@x.org now, please",
             "ip 1.2.3.4 and more words of it"]
    clashes = ["_terms", "_a", "_b", "a", "b", "terms", "row", "_gone", "gone", "_bad", "key", "doc", "spans", "n_words", "a.b",
               "entity", "term", "id", "n", "component_id", "score", "x y"]
    rows = [(i, t, *[f"{c}{i}" for c in clashes]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in clashes))
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, BASE)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        got = {r[0]: tuple(r)[2:] for r in out.collect()}
        assert got and all(got[i] == rows[i][2:] for i in got), name


def test_all_stages_with_nulls_repeats_and_nothing(spark, tmp_path):
    documents = spark.read.parquet(f"{BASE}/documents.parquet")
    more = spark.createDataFrame([(None, None, None, None, None), (None, "words without an id", "en", "s", 19),
                                  (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "again and again " * 20_000, "en", "s", 1)],
                                 documents.schema)
    for name, table in (("odd", documents.unionAll(more)), ("empty", documents.limit(0))):
        folder = str(tmp_path / name)
        table.write.parquet(f"{folder}/documents.parquet")
        for other in ("labels", "benchmark"):
            spark.read.parquet(f"{BASE}/{other}.parquet").write.parquet(f"{folder}/{other}.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert (out.count() > 100) == (name == "odd")
