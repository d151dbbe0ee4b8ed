"""The registered queries of this subpackage on the smallest tables: columns, types, rows."""

import zlib

import numpy as np
import pytest

from tests.compare import SF
from tickloom.llm import common, queries

QUERIES = queries.queries()
# Name and columns of each query's result, and the table that gives its rows.
RESULTS = {
    "op1_suffix_tree": (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double", "documents"),
    "op2_benchmark_decontamination": (
        "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
        "documents"),
    "op3_ngram_jaccard_join": ("doc_id bigint, n_shingles bigint, component_id bigint", "documents"),
    "op4_nearest_neighbours": ("query_id bigint, rank int, vec_id bigint, score double", None),
    "op5_best_fit_packing": (
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, "
        "offset bigint", None),
    "op7_warc": (
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint", "pages"),
    "op8_line_dedup": ("doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string", "documents"),
    "op9_quality_classifier": ("doc_id bigint, held_out boolean, score double, predicted int", "documents"),
    "op10_token_counts": ("doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean", "documents"),
    "op11_quality_rules": (
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean", "documents"),
    "op12_hard_negatives": (
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
        "negative_score bigint", None),
    "op13_conversation_repair": (
        "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
        "cost bigint, audit string, repaired_sha256 string", None),
}


@pytest.mark.parametrize("name", sorted(RESULTS))
def test_columns_and_rows(spark, name):
    columns, table = RESULTS[name]
    got = QUERIES[name](spark, SF)
    types = dict(got.dtypes)
    for column in columns.split(", "):
        known, kind = column.split(" ")
        assert types[known] == kind, column
    rows = got.toArrow().to_pylist()
    if table:
        key = "page_id" if table == "pages" else "doc_id"
        ids = [r[key] for r in common.table(spark, SF, table).select(key).collect()]
        assert sorted(r[key] for r in rows) == sorted(ids)
    assert rows
    remainder = {"op1_suffix_tree": (7, 2), "op9_quality_classifier": (5, 0)}.get(name)
    if remainder:
        n, left = remainder
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % n == left) for r in rows)
    if name == "op9_quality_classifier":
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    if name == "op1_suffix_tree":
        assert len({r["train_tokens"] for r in rows}) == 1
        assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_nearest_are_those_of_brute_force(spark):
    """op4's recall on the supplied vectors, in double precision."""
    rows = common.table(spark, SF, "embeddings").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], np.float64)
    found = {}
    for r in QUERIES["op4_nearest_neighbours"](spark, SF).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        near = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        hits, total = hits + len(near & found[int(ids[i])]), total + len(near)
    assert hits >= 0.9 * total
