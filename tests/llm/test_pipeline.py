"""The pipeline against its stages' brute-force models, and its edge cases."""

import hashlib

import corpus_pipeline as C
import public_tokenizers
from helpers import sample_docs
from test_op03_token_groups import brute as near
from test_op07_spaced_seeds import brute as leaks
from test_op09_secret_scan import brute as secrets
from tokenizers import Tokenizer

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_stages_agree_with_models(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    kept = C.drop_toxic(spark, docs, SF)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r.text for r in kept.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(SF + "/labels.parquet").collect()}
    clean = {r.doc_id for r in docs.collect() if labels.get(r.doc_id) == 0}
    assert len(clean & set(rows)) >= 0.97 * len(clean)  # clean documents stay
    first = {i for i, _, c in near(list(rows.items())) if c == i}
    rows = {i: t for i, t in rows.items() if i in first}
    items = [tuple(r) for r in spark.read.parquet(SF + "/benchmark.parquet").collect()]
    bad = {h[0] for h in leaks([(i, t) for i, t in rows.items() if len(t) < 3000], items)}
    long = {i for i, t in rows.items() if len(t) >= 3000}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in C.run(spark, SF).collect()}
    assert set(got) - long == set(rows) - long - bad
    for i, r in got.items():
        t, at, out = rows[i], 0, ""
        for s, _, _, e in secrets(t):
            if s >= at or at == 0:
                out += t[at:s] + "[SECRET]"
            at = max(at, e)
        ids = tok.encode(out + t[at:], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def write(spark, folder, rows, labels=(), items=()):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, extra string"
    spark.createDataFrame([(i, t, "en", None, len(t or ""), 0.5, "e") for i, t in rows], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_awkward_rows(spark, tmp_path):
    rows = sample_docs()
    write(spark, str(tmp_path), rows, [(1, 1, 0)], [(1, rows[4][1])])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "extra"], name
    got = [r.doc_id for r in C.run(spark, str(tmp_path)).collect()]
    assert None in got and {300, 301, 302, 303, 309}.issubset(got)
    assert not {103, 107, 111, 304, 307} & set(got)


def test_empty_tables(spark, tmp_path):
    write(spark, str(tmp_path), [])
    assert C.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = list(E.queries())
    assert "pipeline" in names and [n for n in names if n.startswith("op")] and len([s for s in C.STAGES]) == 5
