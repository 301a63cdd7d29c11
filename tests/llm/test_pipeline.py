"""The queries and the pipeline over the smallest given tables."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from mailspark.llm import language_id, mixing, token_files
from mailspark.llm.common import table
from mailspark.llm.queries import QUERIES
from tests.llm.test_operators import ODD_ROWS, brute_classes, docs_of, same_rows
from tests.llm.test_plain_parts import brute_hits

COLUMNS = {
    "op1_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op2_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op4_token_files": "doc_id start n_tokens ids_crc32",
    "op5_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op7_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op8_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op9_language_id": "doc_id held_out lang_pred score",
    "op12_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op13_token_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op10_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_queries_give_a_row_for_each_document(spark, tiny, name):
    got = QUERIES[name](spark, tiny)
    assert set(COLUMNS[name].split()) <= set(got.columns)
    same_rows(
        got.select("doc_id").collect(), table(spark, tiny, "documents").select("doc_id").collect()
    )


def test_near_duplicates_and_mix_give_whole_results(spark, tiny):
    docs = table(spark, tiny, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    same_rows(QUERIES["op3_near_duplicates"](spark, tiny).collect(), brute_classes(rows))
    mixed = QUERIES["op6_mixing"](spark, tiny)
    assert mixed.columns == ["doc_id", "source", "lang", "topic", "chance"]
    assert mixed.join(docs, ["doc_id", "source", "lang"]).count() == mixed.count() > 150
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_against_brute_force(spark, tiny):
    docs = table(spark, tiny, "documents")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    model = language_id.Model(*language_id.learn(docs).parts())
    rows = [r for r, (lang, _, _) in zip(rows, model.label([r[1] for r in rows])) if lang != "und"]
    rows = [r for r, (i, c) in zip(rows, brute_classes(rows)) if i == c]
    items = [(str(r.item_id), r.text) for r in table(spark, tiny, "benchmark").collect()]
    hits = brute_hits([r[1] for r in rows], items)
    rows = [r for r, (n, hit, _) in zip(rows, hits) if not (hit and 20 * hit >= n)]
    kept = docs.where(docs.doc_id.isin([r[0] for r in rows]))
    # documents of rare cells come several times
    chosen = Counter(r.doc_id for r in mixing.mix(kept, repeats=mixing.REPEATS).collect())
    assert 1 < max(chosen.values()) <= mixing.REPEATS
    library = Tokenizer.from_file(token_files.VOCABULARY)
    want, at = [], 0
    for i, text, *_ in sorted(r for r in rows for _ in range(chosen[r[0]])):
        n = len(library.encode(text, add_special_tokens=False).ids) + 1
        want.append((i, at, n))
        at += n
    got = corpus_pipeline.run(spark, tiny)
    same_rows(got.select("doc_id", "start", "n_tokens").collect(), want)
    assert len(want) > 100 and corpus_pipeline.ORACLE_SQL is None
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "decontamination", "mixing", "token_files",
    ]


def test_ids_read_back_are_those_of_the_library(spark, tiny, tmp_path):
    docs = table(spark, tiny, "documents")
    token_files.write_token_files(docs, str(tmp_path / "ids"))
    library = Tokenizer.from_file(token_files.VOCABULARY)
    back = token_files.read_token_files(spark, str(tmp_path / "ids"), with_ids=True)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in back.collect():
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
        assert np.array_equal(r.ids, want)


@pytest.mark.parametrize("rows", [ODD_ROWS, []])
def test_pipeline_on_odd_and_empty_tables(spark, tiny, tmp_path, rows):
    """Nulls, empty and very long texts, repeated rows and columns of other names, as a chain."""
    docs = docs_of(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, tiny, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns, name
        kept.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = Tokenizer.from_file(token_files.VOCABULARY)
    sizes = Counter(
        (r.doc_id, len(library.encode(r.text, add_special_tokens=False).ids) + 1)
        for r in kept.select("doc_id", "text").collect()
    )
    assert Counter((r.doc_id, r.n_tokens) for r in got) == sizes
    assert bool(got) == bool(rows)
    # each distinct text with a letter is there or was left to the draw
    assert {i for i, _ in sizes} <= {r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1])}


def test_the_mix_has_its_shares_and_keeps_most(spark, tiny):
    """With repeats, every value's share of the sample is its target, by the chances."""
    docs = table(spark, tiny, "documents")
    tokens = mixing.tokens_of(F.col("text")).alias("tokens")
    keyed = docs.select("source", "lang", mixing.topic_of(F.col("text")).alias("topic"), tokens)
    cells = mixing.with_targets(mixing.cells_of(keyed), {})
    raked = mixing.rake(cells).toPandas()
    own = mixing.calibrated(spark.createDataFrame(raked), None, mixing.REPEATS).toPandas()
    keys = list(mixing.DIMENSIONS)
    both = raked.fillna("-").merge(own.fillna("-"), on=keys)
    both["got"] = both.tokens * both.chance
    assert both.got.sum() > 0.9 * both.tokens.sum() and both.chance.max() <= mixing.REPEATS
    for d in keys:
        by_value = both.groupby(d).agg(got=("got", "sum"), want=(f"t_{d}", "first"))
        assert np.allclose(by_value.got / both.got.sum(), by_value.want, rtol=2e-3), by_value
