"""Registered queries on the driver's smallest tables, against their SQL or plain Python."""

import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import test_llm_alignment
import test_llm_decontaminate
import test_llm_repeats
import test_llm_secrets
import test_llm_token_files
import test_llm_whitening
from llm_fixtures import Sets, near_duplicates, shingle_set
from tokenizers import Tokenizer

import corpus_pipeline
import verify
from daygrain.llm import registry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def rows(spark, name, *columns):
    return [tuple(r) for r in table(spark, name).select(*columns).collect()]


def pieces_of(documents, capacity=4096):
    tokenizer, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for i, text in documents:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k, s in enumerate(range(0, len(ids), capacity)):
            cut = ids[s:s + capacity]
            out.append((i, k, s, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    return sorted(out)


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in verify.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    verdict, _, good = verify.compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert good, verdict


def test_every_operator_has_one_query():
    names = [n for n in QUERIES if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(ORACLES) <= set(QUERIES)


def test_op1(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op1_near_duplicates"](spark, SF).collect()}
    assert got == near_duplicates(rows(spark, "documents", "doc_id", "text"), 4, 80)


def test_op2(spark):
    got = QUERIES["op2_best_fit_packing"](spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in got) == pieces_of(rows(spark, "documents", "doc_id", "text"))
    assert len({r.sequence_id for r in got}) <= -(-sum(r.length for r in got) // 4096) + 1


def test_op3(spark):
    got = {r.doc_id: r for r in QUERIES["op3_language_id"](spark, SF).collect()}
    held = [(i, lang) for i, lang in rows(spark, "documents", "doc_id", "lang") if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, _ in held} == {i for i, r in got.items() if r.held_out}
    assert np.mean([got[i].lang_pred == lang for i, lang in held]) > 0.97


def test_op4(spark):
    data = rows(spark, "embeddings", "vec_id", "embedding", "label")
    x = np.array([r[1] for r in data], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.98) & (np.array([r[2] for r in data])[:, None] == np.array([r[2] for r in data])[None, :])
    np.fill_diagonal(near, False)
    groups = Sets([r[0] for r in data])
    for a, b in zip(*np.nonzero(near)):
        groups.join(data[a][0], data[b][0])
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op4_vector_near_duplicates"](spark, SF).collect()}
    assert got == {r[0]: (int(n), groups.find(r[0])) for r, n in zip(data, near.sum(axis=1))}


def test_op5(spark):
    got = QUERIES["op5_benchmark_decontamination"](spark, SF).collect()
    expected = test_llm_decontaminate.plain(rows(spark, "documents", "doc_id", "text"), rows(spark, "benchmark", "item_id", "text"), 10)
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in got) == sorted((e[0], e[1], e[2], e[4]) for e in expected)


def test_op7(spark):
    got = QUERIES["op7_suffix_dedup"](spark, SF).collect()
    expected = test_llm_repeats.plain(rows(spark, "documents", "doc_id", "text"), 400)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(
        (e[0], e[1], e[2], len(e[3]) // 2, e[4]) for e in expected
    )


def test_op10(spark):
    got = QUERIES["op10_lattice_likelihood"](spark, SF).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == table(spark, "documents").count() and held
    assert all(r.score < 0 and r.base_score < 0 and r.n_known <= r.n_tokens for r in got)
    assert np.corrcoef([r.score / r.n_tokens for r in held], [r.n_known / r.n_tokens for r in held])[0, 1] > 0


def plain_stages(documents, items):
    """(doc_id, text) that reach the last stage."""
    documents = [(i, t) for i, t in documents if any(c.isalpha() for c in t or "")]
    kept = {i for i, (_, _, k) in near_duplicates(documents, 5, 80).items() if k}
    documents = [(i, t) for i, t in documents if i in kept]
    hit = {e[0] for e in test_llm_decontaminate.plain(documents, items, 10) if e[2]}
    out = []
    for i, t in documents:
        if i in hit:
            continue
        at, text = 0, ""
        spans = sorted(tuple(map(int, s.split(":")[1:])) for s in test_llm_secrets.plain(t))
        for a, b in spans:
            if a >= at:
                text += t[at:a] + "[SECRET]"
            at = max(at, b)
        out.append((i, text + t[at:]))
    return out


def test_pipeline_equals_plain_python(spark):
    expected = plain_stages(rows(spark, "documents", "doc_id", "text"), rows(spark, "benchmark", "item_id", "text"))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in got) == pieces_of(expected)


def test_pipeline_stages_keep_columns_and_oddities(spark, tmp_path):
    from llm_fixtures import odd_documents

    base = [(i, t, "en" if k % 2 else None, "src", 7, "x") for k, (i, t) in enumerate(odd_documents())]
    docs = spark.createDataFrame(base, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    table(spark, "benchmark").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "packing"]
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(docs.count())
    assert seen[0] > seen[1] > seen[2] == seen[3] == seen[4]
    ids = [r.doc_id for r in docs.collect()]
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None}) and None in ids
    assert {r.lang for r in docs.collect()} == {"en"}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= len(ids)
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
    assert shingle_set("a b", 5) == {("a", "b")}


def test_language_stage_keeps_whatever_has_letters(spark):
    columns = "doc_id long, text string, lang string, kept string"
    texts = [(1, "the dog ran home"), (2, "12,5 %%"), (3, None), (4, "der Hund lief heim"), (5, ""), (6, "Δ"), (None, "le chien")]
    stage = corpus_pipeline.known_language

    def result(labels):
        docs = spark.createDataFrame([(i, t, labels.get(i), "x") for i, t in texts], columns)
        out = stage(spark, docs, SF)
        assert out.schema == docs.schema
        return {r.doc_id: r.lang for r in out.collect()}

    lettered = {1, 4, 6, None}
    assert result({}) == dict.fromkeys(lettered)
    assert zlib.crc32(b"4") % 3 == 1  # op3 holds this row out
    assert result({4: "de"}) == dict.fromkeys(lettered, "de")
    assert set(result({1: "und", 4: "und"})) == lettered


def test_op11(spark):
    got = [tuple(r) for r in QUERIES["op11_token_files"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got) == sorted(test_llm_token_files.expected(rows(spark, "documents", "doc_id", "text")))


def test_op12(spark):
    columns = "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    got = [tuple(r) for r in QUERIES["op12_token_alignment"](spark, SF).select(*columns).collect()]
    assert sorted(got) == sorted(test_llm_alignment.expected(rows(spark, "documents", "doc_id", "text")))


def test_op13(spark):
    found = QUERIES["op13_embedding_whitening"](spark, SF)
    assert dict(found.dtypes)["deviation"] == "bigint"
    want, explained = test_llm_whitening.expected(rows(spark, "embeddings", "vec_id", "embedding"), 16)
    got = {(r.vec_id, r.component): r for r in found.collect()}
    assert len(got) == len(want) * len(explained)
    for j, share in enumerate(explained):
        white = np.array([w[j] for _, _, _, w in want])
        own = np.array([got[i, j + 1].whitened for i, _, _, _ in want])
        assert min(np.abs(own - white).max(), np.abs(own + white).max()) < 1e-8
        assert got[want[0][0], j + 1].explained == pytest.approx(share, rel=1e-9)
    assert all((got[i, 1].n, got[i, 1].deviation) == (n, d) for i, n, d, _ in want)
    assert max(r.identity_error for r in got.values()) < 1e-9
