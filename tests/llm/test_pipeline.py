"""The pipeline over the smallest tables: each stage's effect on its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from tests.compare import SF
from tickloom.llm import common


@pytest.fixture(scope="module")
def stages(spark):
    docs = common.table(spark, SF, "documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(common.stored(stage(spark, found[-1], SF), f"test-{name}"))
    return found


def test_columns_and_rows(stages):
    for docs in stages[:-1]:
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        assert dict(docs.dtypes) == dict(stages[0].dtypes)
    counts = [docs.count() for docs in stages[:-1]]
    assert counts[0] > counts[1] == counts[2] >= counts[3] >= counts[4] > 0


def test_no_shared_line_stays(stages):
    keys = Counter()
    for r in stages[1].collect():
        keys.update({x.strip().lower() for x in r.text.split("\n")} - {""})
    left = {x.strip().lower() for r in stages[2].collect() for x in r.text.split("\n")} - {""}
    assert not any(keys[k] >= 10 for k in left)


def test_no_two_similar_documents_stay(stages):
    def grams(text):
        w = text.lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [grams(r.text) for r in stages[3].collect()]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert not a or 100 * len(a & b) < 80 * len(a | b)


def test_packed_documents_are_those_left(stages):
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in stages[4].collect()}
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 4096
    assert len(fill) <= -(-sum(fill.values()) // 4096) + 1


# Awkward rows: NULL and empty texts, no id, repeated rows, one id with two texts, a very long
# text, ties, columns with the names that stages use.
WIDE = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, predicted int, "
    "n_lines int, component_id long, contaminated boolean, _gone int, length string, kept boolean"
)


def _awkward(spark):
    line = "a line that many documents share"
    good = " ".join(f"Word{i} and the sentence number {i} goes on." for i in range(60))
    texts = [
        (900_001, None), (900_002, ""), (900_003, " \t\n\x0b"), (900_004, good), (900_004, good),
        (900_005, good.replace("Word7", "other")), (None, good), (None, None), (900_006, "one"),
        (900_006, "another text under the same id " + good[::-1]), (900_007, "x" * 300_000),
        (900_008, " ".join(f"w{i}" for i in range(50_000))),
    ]
    texts += [(910_000 + i, f"{line}\nown text {i} of this document alone, with some words more") for i in range(12)]
    rows = [(i, t, "en", None if i == 900_002 else "s", None, 0.5, 1, 2, 3, False, 4, "z", True) for i, t in texts]
    return texts, spark.createDataFrame(rows, WIDE).repartition(4)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_awkward_rows(spark, name, stage):
    texts, docs = _awkward(spark)
    got = stage(spark, docs, SF)
    assert got.columns == list(corpus_pipeline.COLUMNS)
    found = Counter((r.doc_id, r.text) for r in got.collect())
    given = Counter(texts)
    assert sum(given.values()) == docs.count()
    empty = stage(spark, docs.limit(0), SF)
    assert empty.columns == list(corpus_pipeline.COLUMNS) and not empty.count()
    if name == "quality":
        assert not found - given  # rows are kept or dropped whole
        assert {found[k] for k in found} <= {1, 2} and found[900_004, texts[3][1]] in (0, 2)
    elif name == "line_dedup":
        assert Counter(i for i, _ in found.elements()) == Counter(i for i, _ in texts)
        assert found[900_001, ""] == found[900_002, ""] == found[None, ""] == 1
        assert found[910_003, "own text 3 of this document alone, with some words more"] == 1
        assert found[900_007, "x" * 300_000] == 1
    elif name == "near_duplicates":
        good = texts[3][1]
        # the near copy and the repeated row go, both texts of one id and rows without an id stay
        expected = given - Counter([(900_004, good), (900_005, texts[5][1])])
        assert found == expected
    else:
        assert found == given  # none holds a benchmark passage


def test_awkward_rows_are_packed(spark):
    texts, docs = _awkward(spark)
    rows = corpus_pipeline.packing_stage(spark, docs, SF).collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(i for i, _ in texts)
    assert {r.length for r in rows if r.doc_id in (900_001, 900_002, 900_003)} == {1}
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 4096
    assert not corpus_pipeline.packing_stage(spark, docs.limit(0), SF).count()


def test_a_benchmark_passage_goes(spark):
    item = common.table(spark, SF, "benchmark").first()
    docs = spark.createDataFrame(
        [(1, item.text, "en", "s", 1), (2, "clean words only", "en", "s", 1), (3, f"before {item.text}", "en", "s", 1)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    left = corpus_pipeline.decontamination_stage(spark, docs, SF)
    assert [r.doc_id for r in left.collect()] == [2]
