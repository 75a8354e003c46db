"""Chat formatting, the queries, and the pipeline's stages on their own inputs."""

import collections
import hashlib
import itertools
import os
import sys

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import edge
from lendwise.llm import chat_format, queries
from lendwise.llm.common import written

TEMPLATE = chat_format.Template()
PIECES = ["</s>", "[INST]", "[/INST]", "<s>", "<<SYS>>", "<</SYS>>", "<turn>", "</turn>", "<end>", "\\", "<", "[", "/", ">", "]", " ", "\n", "a", "é"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "a</turn> b\\"]),
                          st.lists(st.sampled_from(PIECES), max_size=8).map("".join)), max_size=6))
def test_template_round_trip(turns):
    whole = "".join(p for role, text in turns for p, _ in TEMPLATE.segments(role, text))
    assert [(role, text) for role, text, _ in TEMPLATE.parse(whole)] == turns


def check_chat(df):
    want = []
    rows = sorted(df.collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    for conv, turns in itertools.groupby(rows, key=lambda r: r.conv_id):
        turns = [(r.role or "", r.text or "") for r in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        states = ["start", *[r for r, _ in turns]]
        valid = all(b in TEMPLATE.allowed.get(a, ()) for a, b in itertools.pairwise(states)) and states[-1] in TEMPLATE.final
        want.append((str(conv), len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest(), sum(len(p) for r, t in turns for p, _ in TEMPLATE.segments(r, t)), valid))
    got = chat_format.read_back(written(chat_format.format_turns(df), "formatted")).collect()
    assert sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars, r.valid) for r in got) == sorted(want)
    return got


def test_conversations(spark, sf):
    got = check_chat(spark.read.parquet(f"{sf}/conversations.parquet"))
    assert any(r.valid for r in got) and any(not r.valid and r.problem for r in got)


def test_hard_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "".join(PIECES)), (1, 1, "assistant", "".join(PIECES)), (2, None, "tool", "x"),
            (2, 0, None, "\\"), (None, 3, "user", "q"), (None, 4, "assistant", "</s>"), (3, 0, "system", "s"), (3, 2, "assistant", "y" * 200_000),
            (3, 1, "user", "")]
    schema = "conv_id long, turn long, role string, text string, conv string, place int, formatted string"
    df = spark.createDataFrame([(*r, "c", 1, "f") for r in rows], schema)
    got = {r.conv_id: r for r in check_chat(df.repartition(3))}
    assert got[3].valid and got[None].valid and got[1].problem == "assistant after assistant"
    assert chat_format.read_back(written(chat_format.format_turns(df.limit(0)), "formatted")).count() == 0


def test_only_assistant_texts_carry_loss(spark, sf):
    rows = chat_format.format_turns(spark.read.parquet(f"{sf}/conversations.parquet")).collect()
    for r in rows:
        assert r.segments[0].start == 0 and sum(s.length for s in r.segments) == len(r.formatted)
        for s in r.segments:
            assert not s.loss or r.formatted.startswith("<s> ")


def test_queries_return_their_columns(spark, sf):
    columns = {
        "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op2_exact_dedup": "doc_id keep_id group_size kept text_sha256", "op3_token_files": "doc_id start n_tokens ids_crc32",
        "op5_simhash_dedup": "doc_id fingerprint component_id", "op6_source_mixing": "doc_id size source_size target taken",
        "op7_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op9_chat_formatting": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
        "op10_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
        "op11_centroid_clustering": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
        "op12_source_divergence": "lang source part item value rank", "op13_embedding_near_dedup": "vec_id n_links component_id kept"}
    assert {int(k[2:].split("_")[0]) for k in queries.QUERIES} == set(range(1, 14))
    for name in ("op2_exact_dedup", "op6_source_mixing", "op9_chat_formatting"):
        assert set(columns[name].split()) <= set(queries.QUERIES[name](spark, sf).columns)
    probe = queries.op9(spark, sf).filter("conv_id = -1").first()
    assert (probe.n_turns, probe.loss_chars) == (2, 21) and probe.loss_sha256 == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest()


def value(x):
    return round(x, 9) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_twins(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cursor = con.execute(queries.SQL[name])
    names = [d[0] for d in cursor.description]
    got = queries.QUERIES[name](spark, sf)
    assert sorted(names) == sorted(got.columns)
    assert collections.Counter(tuple(map(value, r)) for r in got.select(names).collect()) == \
        collections.Counter(tuple(map(value, r)) for r in cursor.fetchall())


@pytest.fixture(scope="module")
def pipeline():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import corpus_pipeline
    return corpus_pipeline


def test_pipeline_of_documents(spark, sf, pipeline, tmp_path):
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_dedup", "source_mixing", "best_fit_packing"]
    first = docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        assert rows and {r.doc_id for r in rows} <= set(before)
        if name != "best_fit_packing":
            assert docs.columns == first.columns
        if name == "line_dedup":
            assert {r.doc_id for r in rows} == set(before) and any(r.text != before[r.doc_id].text for r in rows)
            assert all(set(r.text.split("\n")) <= set(before[r.doc_id].text.split("\n")) | {""} and r.n_chars == len(r.text) for r in rows)
        elif name == "simhash_dedup":
            assert len(rows) == len({r.doc_id for r in rows}) < len(before)
        elif name == "source_mixing":
            assert max(collections.Counter(r.doc_id for r in rows).values()) <= 2
        before = {r.doc_id: r for r in rows}
    run = pipeline.run(spark, sf)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in run.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)


def test_pipeline_stages_on_hard_and_empty_tables(spark, pipeline, tmp_path):
    labels = spark.createDataFrame([(3, 1, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (edge.table(spark), edge.empty(spark)):
        for k, (_, stage) in enumerate(pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            assert k == 4 or out.columns == docs.columns
            assert out.count() >= 0 if docs.count() else out.count() == 0
