"""The pipeline on planted documents, and every numbered query on the smallest tables."""

import random
import string

import pytest

import corpus_pipeline
from tests import compare
from tests.conftest import SMALL
from tests.llm.samples import documents, odd_rows, prose
from tests.llm.test_documents import brute_components, brute_print, brute_rules
from tidemark.llm.queries import ORACLES, QUERIES

CONTRACT = {
    "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_language_id": "doc_id held_out lang_pred score",
    "op3_quality_classifier": "doc_id held_out score predicted",
    "op5_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op6_simhash_near_duplicates": "doc_id fingerprint component_id",
    "op8_html_extraction": "page_id url text n_chars",
    "op9_legacy_archives": "page_id payload_bytes payload_digest record_type refers_to",
    "op10_mixing_to_target_weights": "doc_id size source_size target taken",
    "op11_spelling_variants": "word form root n n_near form_n",
    "op12_line_dedup": "doc_id n_lines n_dropped kept_sha256",
    "op13_vector_codes": "vec_id code error label_error codebooks_sha256",
}
EN, FR = "the and of thing wh er on sa mi", "le la que eau ré oui çon bu zo"


def planted(items):
    clean = [(i, prose(i, 90, EN if i % 3 else FR), "en" if i % 3 else "fr", f"s{i % 4}") for i in range(100, 220)]
    bad = [(300 + i, " ".join(w + "###" for w in prose(i, 90, EN).split()), "en", "s0") for i in range(12)]
    bad += [(320, prose(1, 30, EN), "en", "s1"), (321, "la la " * 80, "en", "s1"), (322, None, "en", None), (323, "... 12 34 " * 40, None, "s1")]
    copies = [(400, clean[0][1], "en", "s2"), (401, clean[0][1].title(), "en", "s2"), (100, *clean[0][1:])]
    leaks = [(410 + i, f"{prose(60 + i, 70, EN)} {items[i][1]} {prose(80 + i, 70, EN)}", "en", "s3") for i in range(3)]
    return clean, bad, copies, leaks


def test_stages_keep_clean_documents_and_nothing_else(spark, tmp_path):
    items = [(i, prose(900 + i, 30, EN)) for i in range(3)]
    clean, bad, copies, leaks = planted(items)
    documents(spark, clean + bad + copies + leaks).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1) for i, *_ in clean[::2]] + [(i, 0) for i, *_ in bad]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        rows = docs.select("doc_id", "text").collect()
        seen.append(sorted(r.doc_id for r in rows))
    rule, language, near, final = seen
    kept = clean + copies + leaks
    assert rule == sorted(i for i, *_ in kept) and all(not brute_rules(t)[-1] for _, t, _, _ in kept)
    assert language == rule
    label = brute_components([brute_print(t) for _, t, _, _ in kept])
    least = {}
    for (i, *_), at in zip(kept, label):
        least[at] = min(i, least.get(at, i))
    assert near == sorted(set(least.values()))
    assert final == [i for i in near if i < 410]
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in mixed) == final
    assert abs(sum(r.taken for r in mixed) - 1.5 * sum(r["size"] for r in mixed)) < 4 * 2 * 64


def test_language_stage_rejects_foreign_texts_and_noise(spark):
    clean = planted([(i, prose(900 + i, 30, EN)) for i in range(3)])[0]
    rng = random.Random(5)
    noise = [" ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(n)) for n in (60, 3_000)]
    foreign = [prose(70 + n, n, "kyl jää hän mitt vuo") for n in (60, 3_000)]
    rows = clean + [(500 + i, text, "en", "s0") for i, text in enumerate(noise + foreign)]
    # What is to be rejected does not teach: its languages are not given.
    docs = documents(spark, [(i, t, la if i < 500 else None, s) for i, t, la, s in rows])
    stayed = corpus_pipeline.language_stage(spark, docs, "")
    assert stayed.columns == docs.columns
    assert sorted(r.doc_id for r in stayed.collect()) == [i for i, *_ in clean]


def test_pipeline_of_odd_and_of_no_documents(spark, tmp_path):
    for name, rows in (("odd", odd_rows()), ("none", [])):
        documents(spark, rows).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        ids = {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()}
        assert ids == ({4, 6, 8, None} if rows else set()) or (rows and ids <= {4, 6, 8, None})


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_on_the_smallest_tables(spark, con, name, monkeypatch):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    if name in ORACLES:
        assert compare.difference(spark, con, name, SMALL) is None
    df = QUERIES[name](spark, SMALL)
    assert set(CONTRACT.get(name, "").split()) <= set(df.columns)
    assert df.count() > 0
