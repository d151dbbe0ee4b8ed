"""Operators on small frames with the awkward cases, against brute force."""

import hashlib
import math
import pickle
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import (
    common,
    decontamination,
    graph,
    line_dedup,
    ngram_join,
    packing,
    quality,
    rp_forest,
    suffix_tree,
    token_counts,
    url_filters,
    warc,
)

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
RNG = random.Random(5)
VOCABULARY = ["the", "of", "Été", "naïve", "x1", "don't", "end.", "—", "zwölf", "ΟΔΟΣ", "İI", "a,b", "日本語"]
BASE = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    None, "", " ", "\n\n", "one", "One two\tthree", "a  b \n\n c d　e <|endoftext|> f", "\x1c x \x1f",
    "x" * 300, BASE, BASE.upper(), BASE.replace("w30", "other"), BASE + " tail", "é ́a, b!?",
] + [" ".join(RNG.choice(VOCABULARY) for _ in range(RNG.randrange(1, 90))) + "\nshared line" for _ in range(12)]
TEXTS.append(" ".join(RNG.choice(VOCABULARY) for _ in range(9_000)))
SCHEMA = "doc_id long, text string, n long, score string, n_lines int, a int"


@pytest.fixture(scope="module")
def rows():
    found = [(i, t) for i, t in enumerate(TEXTS)]
    return found + [found[9], (None, "null id"), (None, "null id")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "s", 2, 3) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_token_counts(docs, none, rows):
    tokenizer = Tokenizer.from_file(BYTE)
    expected = Counter()
    for i, t in rows:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        expected[i, len((t or "").encode()), n, n > 1024] += 1
    assert Counter(map(tuple, token_counts.token_counts(docs, BYTE).collect())) == expected
    assert token_counts.token_counts(none, BYTE).count() == 0


def test_packing(docs, none, rows):
    tokenizer = Tokenizer.from_file(WORD)
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in rows}
    found = packing.best_fit_packing(docs, WORD, capacity=256).collect()
    for r in found:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
    total = sum(len(ids[i]) for i, _ in rows)
    assert sum(r.length for r in found) == total
    for s in {r.sequence_id for r in found}:
        at = 0
        for r in sorted((r for r in found if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    assert len({r.sequence_id for r in found}) <= -(-total // 256) + 2
    assert packing.best_fit_packing(none, WORD).count() == 0


def test_local_search_empties_bins():
    rng = random.Random(3)
    for _ in range(20):
        lengths = [rng.randrange(5, 60) for _ in range(200)]
        number, offset, _ = packing.pack_group(lengths, 100)
        fill = Counter()
        for n, size in zip(number, lengths):
            fill[n] += size
        assert max(fill.values()) <= 100 and len(fill) <= -(-sum(lengths) // 100) + 2
    bins = packing.Bins([6, 5, 4, 3, 7], 10)  # one-for-one: 6 + 4 and 7 + 3 from 6 + 3 and 7
    for b, items in enumerate([[0, 3], [2, 1]]):
        bins.items.append([])
        bins._set_free(b, 10)
        for i in items:
            bins.put(i, b)
    squares = sum((10 - f) ** 2 for f in bins.free)
    while bins.improve(0):
        assert sum((10 - f) ** 2 for f in bins.free) > squares
        squares = sum((10 - f) ** 2 for f in bins.free)


def test_line_dedup(docs, none, rows):
    key = lambda x: x.strip(b" \t\n\x0b\x0c\r").lower()
    texts = [(i, (t or "").encode().split(b"\n")) for i, t in rows]
    count = Counter()
    for _, lines in texts:
        count.update({key(x) for x in lines})
    expected = Counter()
    for i, lines in texts:
        kept = [x for x in lines if not key(x) or count[key(x)] < 3]
        expected[i, b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)] += 1
    found = line_dedup.drop_repeated_lines(docs, min_docs=3).select("doc_id", "text", "n_lines", "n_dropped")
    assert Counter(map(tuple, found.collect())) == expected
    assert line_dedup.drop_repeated_lines(none).count() == 0


def test_perfect_hash_is_minimal():
    h = np.random.default_rng(1).integers(0, 1 << 63, (5_000, 2), dtype=np.uint64)
    number = line_dedup.PerfectHash.of(h).number(h)
    assert sorted(number.tolist()) == list(range(5_000))
    other = np.random.default_rng(2).integers(0, 1 << 63, (5_000, 2), dtype=np.uint64)
    shard = line_dedup.Shard.load(line_dedup.Shard.of(h, np.arange(5_000) + 1).columns())
    assert shard.count(h).tolist() == list(range(1, 5_001)) and not shard.count(other).any()


def _shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_similarity_components(docs, none, rows):
    sets = {i: _shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                same = len(sets[a] & sets[b])
                if sets[a] and 100 * same >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    expected = Counter((i, len(_shingles(t)), root.get(i)) for i, t in rows)
    assert len(set(root.values())) < len(root) - 2
    assert Counter(map(tuple, ngram_join.similarity_components(docs).collect())) == expected
    assert ngram_join.similarity_components(none).count() == 0
    kept = [r.doc_id for r in ngram_join.one_of_each_group(docs).select("doc_id").collect()]
    assert sorted(i for i in kept if i is not None) == sorted(set(root.values()))


def test_parities_let_all_links_pass():
    rng = np.random.default_rng(3)
    stopped = 0
    for _ in range(400):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        other = rng.integers(0, 1 << 63, int(rng.integers(0, n // 3 + 2)), dtype=np.uint64)
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(0.6, 1)], other]))
        if not len(b):
            continue
        bits = ngram_join.parities(a), ngram_join.parities(b)
        passes = ngram_join.may_agree(*bits, len(a), len(b), 80)
        assert passes or not ngram_join.links(a, b, 80)
        stopped += not passes
    assert stopped > 100


def test_components_of_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 80), (80, 90), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in graph.components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 80: 80, 90: 80}


def test_decontamination(spark, docs, none, rows):
    items = [(1, BASE[20:120]), (2, "w40 w41 w42"), (2, "w40 w41 w42"), (3, None), (4, ""), (None, "one"), (5, "ONE")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    expected = Counter()
    for i, t in rows:
        w, hit, ids = cut(t), set(), set()
        for item, text in items:
            x = cut(text)
            n = min(13, len(x))
            for k in range(len(x) - n + 1) if n and item is not None else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == x[k : k + n]:
                        hit.update(range(p, p + n))
                        ids.add(str(item))
        expected[i, len(w), len(hit), tuple(sorted(ids)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    found = decontamination.contamination(docs, benchmark)
    found = found.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    assert Counter((a, b, c, tuple(d), e) for a, b, c, d, e in found) == expected
    assert decontamination.contamination(none, benchmark).count() == 0
    assert not decontamination.contamination(docs, benchmark.limit(0)).where("contaminated").count()
    left = decontamination.remove_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert left.count() == sum(n for k, n in expected.items() if not k[-1])


def test_suffix_tree(docs, none, rows):
    out = F.col("doc_id") % 4 == 1
    found = suffix_tree.suffix_tree_scores(docs, out).collect()
    count = Counter()
    for i, t in rows:
        if i is None or i % 4 != 1:
            count.update((t or "").encode().lower().split() + [b""])
    total, norm = sum(count.values()), sum(count.values()) + len(count) + 1
    expected = Counter()
    for i, t in rows:
        w = (t or "").encode().lower().split() + [b""]
        base = sum(math.log10((count[x] + 1) / norm) for x in w)
        expected[i, len(w), sum(count[x] > 0 for x in w), total, round(base, 6)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected
    assert sum(r.score for r in found) > sum(r.base_score for r in found)
    assert suffix_tree.suffix_tree_scores(none, out).count() == 0


def _tree_scores(texts, held, depth, least=3, share=0.75):
    """The tree's scores by brute force: dictionaries of n-grams, longest state first."""
    found = [(t or "").encode().lower().split() + [b""] for t in texts]
    count = Counter()
    for w, out in zip(found, held):
        if not out:
            for n in range(1, depth + 2):
                count.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    words = [g for g in count if len(g) == 1]
    norm = sum(count[g] for g in words) + len(words) + 1
    states = {}  # context: log10 weight of its parent, next words' log10 P

    def log(context, w, n):
        if not n:
            return math.log10((count[w,] + 1) / norm)
        rest, symbols = states.get(context[-n:], (0.0, {})) if len(context) >= n else (0.0, {})
        return symbols[w] if w in symbols else rest + log(context, w, n - 1)

    for n in range(1, depth + 1):
        below = {}
        for g, k in count.items():
            if len(g) == n + 1 and k >= least:
                below.setdefault(g[:-1], {})[g[-1]] = k
        for c, symbols in below.items():
            own, left = count[c], count[c] - sum(symbols.values())
            rest = math.log10(max(share * len(symbols) + left, 1e-12) / own)
            parent = {w: log(c, w, n - 1) for w in symbols}
            p = {w: math.log10((k - share) / own + 10 ** (rest + parent[w])) for w, k in symbols.items()}
            gain = sum(k * (p[w] - parent[w]) for w, k in symbols.items()) + left * rest
            if gain * math.log(10) > 0.5 * (len(symbols) + 1) * math.log(max(own, 2)):
                states[c] = rest, p
    # in every context the words and all unseen ones together have probability one
    for context in [(), (b"so",), *list(states)[:20]]:
        p = [10 ** log(context, w, depth) for w, in words]
        unseen = 10 ** log(context, b"\0", depth) * (norm - sum(count[g] + 1 for g in words))
        assert abs(sum(p) + unseen - 1) < 1e-9
    longest = max(map(len, states), default=0)
    return [sum(log(tuple(w[max(0, i - depth) : i]), w[i], depth) for i in range(len(w))) for w in found], longest


@pytest.mark.parametrize("depth", [1, 2, 4])
@pytest.mark.parametrize("share", [0.01, 1e-6])
def test_suffix_tree_equals_dictionaries(spark, monkeypatch, depth, share):
    # a share of all tokens, as it comes to 3 occurrences and more on large tables, decides nothing
    rng = random.Random(8)
    texts = [" ".join(rng.choice(VOCABULARY) + str(rng.randrange(30)) for _ in range(60)) for _ in range(60)]
    texts += [f"the rare language says {i} so it goes" for i in range(4)] + [None, "", "so it goes"]
    texts += [f"{i} at the end of the long way home there is a light {i}" for i in range(30)]
    texts += [f"{x} of the long {y}" for x, y in (("end", "day"), ("all", "road"), ("why", "wait")) for _ in range(40)]
    held = [i % 5 == 1 for i in range(len(texts))]
    expected, longest = _tree_scores(texts, held, depth)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffix_tree, "P_NGRAM", share)  # with a high share most weights are joined
    monkeypatch.setattr(suffix_tree, "P_WORD", share)
    found = suffix_tree.suffix_tree_scores(frame, F.col("doc_id") % 5 == 1, depth=depth).collect()
    scores = {r.doc_id: r.score for r in found}
    assert longest == depth and all(abs(scores[i] - x) < 1e-6 for i, x in enumerate(expected))


def test_suffix_tree_of_many_blocks_and_shards(spark, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(VOCABULARY) + str(rng.randrange(9)) for _ in range(50)) for _ in range(80)]
    texts += [None, "", *texts[:30], "words that nothing else has", *["so it goes"] * 9]
    held = [i % 5 == 1 for i in range(len(texts))]
    expected, _ = _tree_scores(texts, held, 2)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    for name, value in {"P_NGRAM": 0.01, "P_WORD": 0.01, "ASKED": 100, "SHARD": 500}.items():
        monkeypatch.setattr(suffix_tree, name, value)
    found = suffix_tree.suffix_tree_scores(frame, F.col("doc_id") % 5 == 1, depth=2).collect()
    scores = {r.doc_id: r.score for r in found}
    assert len(found) == len(texts) and all(abs(scores[i] - x) < 1e-6 for i, x in enumerate(expected))


@pytest.mark.parametrize("n", [0, 1, 3_000, 40_000])
def test_sketch_is_as_large_as_its_keys_ask_for(spark, monkeypatch, n):
    monkeypatch.setattr(suffix_tree, "SLICE_BITS", 7)  # 1 KB
    keys = np.random.default_rng(n).integers(0, 2**64, n + 20_000, dtype=np.uint64)
    frame = spark.createDataFrame([(int(k),) for k in keys[:n].view(np.int64)], "key long")
    sketch = pickle.loads(pickle.dumps(suffix_tree.Sketch(frame)))  # as tasks get it
    holds = common.started(sketch.opened)
    assert sketch.slices == 1 + 12 * n // 8192
    assert holds(keys[:n]).all() and holds(keys[n:]).mean() < 0.02
    assert not n or holds(keys[n - 1 : n]).tolist() == [True]


def test_ngrams_are_passed_on_in_little_space():
    rng = np.random.default_rng(6)
    context = (rng.zipf(1.3, 120_000) % 20_000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    suffix = rng.permutation(context) + np.uint64(rng.integers(1, 9))
    expected = Counter(zip(context.tolist(), suffix.tolist()))
    pieces = []
    for part in np.array_split(np.arange(len(context)), 3):  # tasks
        held = suffix_tree.Summing(["context", "suffix"], suffix_tree.ngram_key)
        for some in np.array_split(part, 4):
            held.add(context[some], suffix[some])
        n = held.n
        batches = list(suffix_tree._pieces(held, 48))
        assert sum(b.nbytes for b in batches) < 16 * n  # a context and a suffix alone take as much in rows
        pieces += batches
    table = pa.Table.from_batches(pieces)
    table = table.add_column(0, "order", pa.array([2] * table.num_rows, pa.int32()))
    found = Counter()
    for shard in range(48):
        rows = table.filter(pc.equal(table["shard"], shard))
        if rows.num_rows:
            for order, c, s, k in zip(*suffix_tree._summed(rows).to_pydict().values()):
                assert order == 2 and (c % 2**64, s % 2**64) not in found
                found[c % 2**64, s % 2**64] = k
    assert found == {x: k for x, k in expected.items() if k >= suffix_tree.LEAST}


def test_texts_are_looked_up_a_part_at_a_time(spark, monkeypatch):
    texts = [f"{i % 7} so it goes {i % 5} on and on" for i in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    for name, value in {"P_NGRAM": 0.5, "P_WORD": 0.5, "ASKED": 10}.items():
        monkeypatch.setattr(suffix_tree, name, value)
    parts, looked_up = [], suffix_tree.looked_up

    def seen(asked, *rest):
        parts.append({r.block for r in asked.select("block").collect()})
        return looked_up(asked, *rest)

    monkeypatch.setattr(suffix_tree, "looked_up", seen)
    assert suffix_tree.suffix_tree_scores(frame, F.col("doc_id") % 5 == 1).count() == len(texts)
    blocks = set.union(*parts)
    assert len(parts) == 4 and sum(map(len, parts)) == len(blocks) >= 6
    assert max(map(len, parts)) <= len(blocks) / 2


def test_summing_takes_little_beside_what_it_holds():
    rng = np.random.default_rng(3)
    context = rng.integers(0, 2**64, 1_500_000, dtype=np.uint64)
    context[:1000] = context[0]
    suffix = context + np.uint64(1)
    tracemalloc.start()
    try:
        held = suffix_tree.Summing(["context", "suffix"], suffix_tree.ngram_key)
        for first in range(0, len(context), 100_000):
            held.add(context[first : first + 100_000].copy(), suffix[first : first + 100_000].copy())
        before = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
        found, total = 0, 0
        for batch in held.rows():
            found, total = found + batch.num_rows, total + int(batch["n"].to_numpy().sum())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (found, total) == (len(context) - 999, len(context))
    assert before < 24 * len(context) and peak < 1.6 * before


def test_nearest(spark):
    x = np.random.default_rng(4).normal(size=(400, 8)) * np.random.default_rng(5).uniform(0.5, 2, (400, 1))
    data = [(i, [float(np.float32(v)) for v in row], 0) for i, row in enumerate(x)]
    data += [(400 + i, data[3][1], 0) for i in range(60)]
    odd = [(900, None, 0), (920, [0.0] * 8, 0), (940, [float("nan")] * 8, 0), (960, [1.0, None] * 4, 0), (None, data[1][1], 0), (980, [1.0], 0)]
    frame = spark.createDataFrame(data + odd + data[:2], "vec_id long, embedding array<float>, id int")
    found = rp_forest.nearest(frame, F.col("id") % 20 == 0, k=20).collect()
    vectors = {i: np.array(v) for i, v, _ in data}
    expected = set()
    for q in (i for i in vectors if i % 20 == 0):
        near = sorted(((-float((vectors[q] * v).sum()), i) for i, v in vectors.items() if i != q))[:20]
        expected |= {(q, r + 1, i) for r, (_, i) in enumerate(near)}
    assert {(r.query_id, r.rank, r.vec_id) for r in found} == expected
    assert rp_forest.nearest(frame.limit(0), F.col("id") % 20 == 0).count() == 0


def test_quality(spark, none):
    rng = random.Random(2)
    good = [" ".join(rng.choice(VOCABULARY) for _ in range(40)) for _ in range(150)]
    data = [(i, t if i % 3 else t.upper().replace(" ", "!! "), i % 3) for i, t in enumerate(good)]
    frame = spark.createDataFrame([(i, t) for i, t, _ in data] + [(None, None), (500, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(q > 0)) for i, _, q in data] + [(9_999, None), (None, 1)], "doc_id long, quality int")
    found = quality.quality_scores(frame, labels, F.col("doc_id") % 5 != 0).collect()
    assert len(found) == 152 and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == int(r.doc_id % 3 > 0) for r in found if r.doc_id is not None and r.doc_id < 150 and r.doc_id % 5 == 0)
    assert quality.quality_scores(none, labels, F.lit(True)).count() == 0
    plain = quality.quality_scores(frame, labels.limit(0), F.lit(True)).collect()
    assert {r.score for r in plain} == {0.5}


def test_url_filters(spark):
    log = spark.createDataFrame(
        [("ads", "example.com", "add", "2024-01-10"), ("ads", "example.com", "remove", "2024-02-01"),
         ("ads", "example.com", "add", "2024-03-01"), ("bad", "a.example.com", "add", "2024-01-01"), ("bad", None, "add", "2024-01-01")],
        "list string, entry string, action string, at string",
    ).withColumn("at", F.col("at").cast("timestamp"))
    data = [
        (1, "http://A.Example.com:80/x", "2024-01-15"), (2, "https://u@b.example.com", "2024-02-15"), (3, "http://example.com/", "2024-03-01"),
        (4, "http://notexample.com/", "2024-01-15"), (5, None, "2024-01-15"), (6, "http://a.example.com", None), (1, "http://A.Example.com:80/x", "2024-01-15"),
    ]
    pages = spark.createDataFrame(data, "page_id long, url string, at string").select("page_id", "url", F.col("at").cast("timestamp").alias("fetched_at"))
    found = sorted((r.page_id, tuple(r.lists), r.n_entries) for r in url_filters.temporal_list_join(pages, log).collect())
    assert found == [(1, ("ads", "bad"), 2)] * 2 + [(2, (), 0), (3, ("ads",), 1), (4, (), 0), (5, (), 0), (6, (), 0)]
    assert url_filters.temporal_list_join(pages.limit(0), log).count() == 0
    assert not url_filters.temporal_list_join(pages, log.limit(0)).where("blocked").count()


def test_url_filters_of_deep_hosts(spark):
    deep = ".".join(f"l{i}" for i in range(127))
    parents = [deep.split(".", k)[-1] for k in (1, 60, 110, 125)]
    rows = [("spam", e, "add", "2024-01-01") for e in [deep, *parents, "l1." + parents[1], "26"]]
    log = spark.createDataFrame(rows, "list string, entry string, action string, at string")
    log = log.withColumn("at", F.col("at").cast("timestamp"))
    hosts = [deep, parents[0], "x." + parents[1], "x" + parents[2], "l126", "." * 300 + parents[3]]
    data = [(i, f"http://{h}/", "2024-02-01") for i, h in enumerate(hosts)]
    pages = spark.createDataFrame(data, "page_id long, url string, at string")
    pages = pages.select("page_id", "url", F.col("at").cast("timestamp").alias("fetched_at"))
    found = {r.page_id: r.n_entries for r in url_filters.temporal_list_join(pages, log).collect()}
    entries = {r[1] for r in rows}
    expected = {i: sum(h == e or h.endswith("." + e) for e in entries) for i, h in enumerate(hosts)}
    assert found == expected and expected[0] == 5 and expected[1] == 4


def test_warc_round_trip(spark, tmp_path):
    big = "é" * 600
    data = [(1, "http://a.b.c/x", big), (2, "http://a.b.c/x", big), (3, None, big), (4, "no url", None), (5, "http://d/", "x"), (6, "http://d/", "x"), (None, "http://e/", "\r\n\r\nWARC/1.1"), (1, "http://a.b.c/x", big)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    found = warc.archive_round_trip(pages, f"{tmp_path}/w").collect()
    expected = Counter()
    for i, _, html in data:
        raw = (html or "").encode()
        revisit = len(raw) >= 1000 and i != 3
        expected[i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None] += 1
    assert Counter(map(tuple, found)) == expected
    assert warc.archive_round_trip(pages.limit(0), f"{tmp_path}/e").count() == 0


def test_local_search_comes_near_the_bound():
    """Lengths that best fit packs badly: bins left against the figures of the plain best fit."""
    for (low, high), most in {(1200, 2400): 1840, (700, 1500): 1090, (1300, 1400): 1335}.items():
        rng = random.Random(1)
        lengths = [rng.randrange(low, high) for _ in range(4_000)]
        plain = packing.Bins(lengths, 4096)
        plain.best_fit()
        number, _, _ = packing.pack_group(lengths, 4096)
        assert -(-sum(lengths) // 4096) <= len(set(number)) <= most < sum(1 for x in plain.items if x)


def test_encoding_of_odd_texts():
    """Ids of whole texts, whatever marks, white space, special strings and scripts they mix."""
    tokenizer, encoding = Tokenizer.from_file(WORD), packing.Encoding(WORD)
    parts = list("abzAZ  .,;:!?'\"-_()019²½ªº§×÷ \t\n\v\f\r\x1c\x85\xa0éÉßſİıΣς́̀;…<|>你") + [
        "'s ", "'T", "don't ", "<|endoftext|>", "<|ENDOFTEXT|>", "...", "?!", ",***", " a.b ", "é.", "x" * 60, "end. ",
    ]
    rng = random.Random(2)
    found = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(4_000)]
    for at in range(0, len(found), 512):
        some = found[at : at + 512]
        for text, ids in zip(some, encoding.texts([t.encode() for t in some])):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_crowded_tokens_lose_no_link(spark, monkeypatch):
    """Documents of common passages, some of them near copies, with every token crowded soon."""
    monkeypatch.setattr(ngram_join, "CROWD", 3)
    monkeypatch.setattr(ngram_join, "BUCKETS", 1 << 13)  # so that common tokens pass for rare
    rng = random.Random(11)
    passages = [[f"p{k}x{i}" for i in range(60)] for k in range(3)]
    texts = []
    for i in range(150):
        own = [f"d{i}w{j}" for j in range(rng.randrange(10, 120))]
        at = rng.randrange(len(own))
        texts.append(own[:at] + passages[i % 3] + own[at:])
    for i in range(0, 150, 5):  # near copies, a fifth of the documents
        copy = list(texts[i])
        copy[rng.randrange(len(copy))] = f"changed{i}"
        texts.append(copy)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = {i: _shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = ngram_join.similarity_components(frame).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: find(i) for i in sets}
    assert len({find(i) for i in sets}) < len(sets)


def test_dual_coordinate_descent_reaches_the_optimum():
    """Weights against projected gradient on the dual, until that stands still."""
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(30, rng.integers(3, 9), replace=False)) for _ in range(40)]
    values = [rng.normal(size=len(r)) for r in rows]
    y = np.where(rng.random(40) < 0.4, 1.0, -1.0)
    cost = np.where(y > 0, 1.3, 0.7)
    w, bias = quality.dual_coordinate_descent(rows, values, y, cost, epochs=3_000)
    x = np.zeros((40, 31))
    x[:, 30] = 1.0  # the bias is the weight of a constant
    for i, (r, v) in enumerate(zip(rows, values)):
        x[i, r] = v
    q = (y[:, None] * x) @ (y[:, None] * x).T
    alpha, step = np.zeros(40), 1 / np.linalg.eigvalsh(q).max()
    for _ in range(200_000):
        alpha = np.clip(alpha - step * (q @ alpha - 1), 0, cost)
    exact = x.T @ (alpha * y)
    objective = lambda u: 0.5 * u @ u + cost @ np.maximum(0, 1 - y * (x @ u))
    ours = np.r_[w[:30], bias]
    gap = objective(ours) / objective(exact) - 1, np.abs(ours - exact).max()
    assert not w[30:].any() and gap[0] < 2e-3 and gap[1] < 0.02, gap


def test_log_count_ratios_are_those_of_a_dictionary():
    texts = ["good words here", "good and plain", "bad!!! $$$", "bad words $$$ here", ""]
    y = np.array([1.0, 1.0, -1.0, -1.0, -1.0])
    rows = [quality.ngrams(t.encode()) for t in texts]
    size = 1 << quality.BITS
    held = {1: Counter(), -1: Counter()}
    for r, label in zip(rows, y):
        held[int(label)].update(r.tolist())
    total = {k: sum(c.values()) + size for k, c in held.items()}
    ratio = quality.log_count_ratio(rows, y)
    for f in set(held[1]) | set(held[-1]) | {0, size - 1}:
        expected = math.log((held[1][f] + 1) / total[1]) - math.log((held[-1][f] + 1) / total[-1])
        assert abs(ratio[f] - expected) < 1e-12
    # a text has each n-gram once, and the n-grams of its bytes alone
    assert len(quality.ngrams(b"aaaaaaa")) == 3 and not len(quality.ngrams(b"a"))


def test_fit_holds_the_features_once():
    """The values of the features, twice their size, are made row by row."""
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(1 << quality.BITS, 2_500, replace=False)).astype(np.int32) for _ in range(2_000)]
    labels = rng.integers(0, 2, len(rows)).astype(float)
    tracemalloc.start()
    quality.fit(rows, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * sum(map(len, rows)) * 4 // 5


def test_workers_let_go_what_other_tasks_kept():
    """A worker keeps what its task asks for, and gives it up for a task that doesn't."""
    made = []

    def build():
        made.append(1)
        return "words"

    for _ in range(2):
        assert common.started(lambda: common.kept("a", build)) == "words"
    assert len(made) == 1
    common.started(lambda: None)
    assert not common._KEPT
    common.started(lambda: common.kept("a", build))
    assert len(made) == 2
    common.started(lambda: None)


def test_packing_learns_some_words_at_a_time(monkeypatch):
    """A slice of new words is learnt in parts, with the ids of each text as before."""
    monkeypatch.setattr(packing, "LEARNT", 3, raising=False)
    texts = [b"", b"one two, two three.", "Vier fünf, <|x|> one".encode(), b"three four five six; ONE seven"]
    encoding = packing.Encoding(public_tokenizers.path("word_bpe_49k.json"))
    learnt, real = [], encoding.learn
    monkeypatch.setattr(encoding, "learn", lambda words: learnt.append(len(words)) or real(words))
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = [np.array(plain.encode(t.decode(), add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoding.texts(texts) == expected and encoding.texts(texts) == expected
    assert max(learnt) <= 3 and len(learnt) > 1
