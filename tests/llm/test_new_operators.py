"""Quality rules, hard negatives and conversation repair against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import conversation_repair, hard_negatives, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _rules(rows, max_docs):
    """The result by (id, host, text) as Python loops over whole texts."""
    def key(line):
        return re.sub(r"[0-9]", "0", re.sub(r"[A-Z]", lambda m: m[0].lower(), " ".join(WORD.findall(line))))

    holders = defaultdict(set)
    for doc, host, text in rows:
        for line in (text or "").split("\n"):
            if key(line):
                holders[host, key(line)].add(doc)
    out = Counter()
    for doc, host, text in rows:
        t = text or ""
        w = WORD.findall(t)
        windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = t.split("\n")
        real = [x for x in lines if WORD.search(x)]
        gone = [x for x in lines if key(x) and len(holders[host, key(x)]) > max_docs]
        left = [x for x in lines if x not in gone]
        n_left = len(w) - sum(len(WORD.findall(x)) for x in gone)
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        kept = not failed and n_left >= 20 and 100 * (len(w) - n_left) <= 50 * len(w)
        out[
            doc, host, "\n".join(left), len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)),
            len(real) - len(set(real)), len(hit), failed, len(gone), n_left, kept,
        ] += 1
    return out


@pytest.mark.parametrize("broadcast_lines", [1_000, 0])
def test_quality_rules(spark, broadcast_lines):
    rng = random.Random(3)
    words = ["alpha", "Beta", "#x", "é", "日本", "a|b", "7up", "the"] + [f"w{i}" for i in range(200)]
    shared = "\n".join(" ".join(rng.choice(words) for _ in range(14)) for _ in range(4))
    rows = [(1, "h", None), (2, "h", ""), (3, "h", " \t\n\x0b\n"), (4, None, "one two"), (None, "h", shared), (None, "h", shared)]
    for i in range(10, 60):
        own = "\n".join(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(0, 5)))
        host = rng.choice(["h", "h", "i", None])
        extra = rng.choice([shared, "", " Page 12 of  9 ", "page 10 OF 1\n" + own])
        rows.append((i, host, own + "\n" + extra))
    rows += [(70, "i", "same again now " * 40), (71, "i", " ".join(rng.choice(words) for _ in range(30_000)))]
    rows += [rows[8]] * 5
    docs = spark.createDataFrame(
        [(*r, 1, True) for r in rows], "doc_id long, source string, text string, n_words int, kept boolean"
    ).repartition(4)
    found = quality_rules.line_frequency_rules(docs, max_docs=3, broadcast_lines=broadcast_lines)
    assert found.columns[:3] == ["doc_id", "source", "text"]
    expected = _rules(rows, 3)
    assert Counter(map(tuple, found.collect())) == expected
    assert len({r[-1] for r in expected}) == 2 and any(r[-3] for r in expected)
    assert not quality_rules.line_frequency_rules(docs.limit(0), broadcast_lines=broadcast_lines).count()


def _mined(rows, is_anchor, positives=5, negatives=10):
    """Brute force over (id, vector, label) with whole numbers of any size."""
    usable = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            row = (label, [math.floor(256 * float(np.float32(x))) for x in v])
            usable[i] = min(usable.get(i, row), row)
    lengths = Counter(len(v) for _, v in usable.values())
    most = min(lengths, key=lambda n: (-lengths[n], n), default=0)
    usable = {i: r for i, r in usable.items() if len(r[1]) == most}
    out = Counter()
    for a, (label, v) in usable.items():
        if not is_anchor(a):
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in usable.items() if i != a]
        for p, positive, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            found = sorted(x for x in scored if x[2] != label and 30 * -p <= 100 * -x[0] <= 90 * -p)
            for rank, (n, negative, _) in enumerate(found[:negatives], 1):
                out[a, positive, rank, negative, -p, -n] += 1
    return out


VECTORS = "vec_id long, embedding array<float>, label int, id string, v int"


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "CHUNK_BYTES", 1)  # several chunks of 1,024 rows
    monkeypatch.setattr(hard_negatives, "PILOT", 64)
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(9, 12))
    x = middles[rng.integers(0, 9, 2_600)] + rng.normal(size=(2_600, 12)) * 0.3
    x[500:1_300] = x[500]  # one very common vector, under all labels
    rows = [(i, [float(np.float32(c)) for c in v], int(rng.integers(0, 4))) for i, v in enumerate(x)]
    rows += [(3_000, [0.0] * 12, 1), (3_100, None, 1), (3_200, [1.0] * 11 + [None], 1), (3_300, [1.0] * 11 + [math.nan], 1)]
    rows += [(3_400, [1.0] * 11 + [math.inf], 1), (3_500, [1.0] * 12, None), (None, [1.0] * 12, 1), (3_600, [1.0] * 7, 1)]
    rows += [(3_700, [-1.0] * 12, 77), (3_800, [1.0] * 12, 2), (3_800, [0.5] * 12, 2), rows[40], rows[200]]
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], VECTORS).repartition(3)
    expected = _mined(rows, lambda i: i % 100 == 0)
    found = hard_negatives.hard_negatives(docs, F.col("id") % 100 == 0)
    assert Counter(map(tuple, found.collect())) == expected and len(expected) > 500
    for empty in (docs.limit(0), docs.where("vec_id = 3100")):
        assert not hard_negatives.hard_negatives(empty, F.col("id") % 100 == 0).count()
    assert not hard_negatives.hard_negatives(docs, F.lit(False)).count()


def test_hard_negatives_of_large_components(spark):
    """Products beyond 2^53 stay exact; those that no long holds raise."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=3) * 1e6], i % 3) for i in range(60)]
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], VECTORS)
    found = hard_negatives.hard_negatives(docs, F.col("id") % 10 == 0)
    assert Counter(map(tuple, found.collect())) == _mined(rows, lambda i: i % 10 == 0)
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(
            docs.select("vec_id", "label", F.transform("embedding", lambda c: c * 1e9).alias("embedding")), F.lit(True)
        )


def test_walks_end_early():
    """A shared list is walked a part only, and the bound holds for each member."""
    rng = np.random.default_rng(6)
    middles = rng.normal(size=(40, 16))
    x = np.floor(256 * (middles[rng.integers(0, 40, 20_000)] + rng.normal(size=(20_000, 16)) * 0.1))
    members = np.floor(256 * (middles[3] + rng.normal(size=(30, 16)) * 0.1))
    lengths = np.sqrt((x * x).sum(axis=1))
    order, bounds = hard_negatives.shared_list(members, x, lengths)
    sizes = np.sqrt((members * members).sum(axis=1))
    assert (members @ x[order].T <= sizes[:, None] * bounds).all()
    bests = [[hard_negatives.Best(10, hard_negatives.LEAST, hard_negatives.MOST)] for _ in members]
    done = hard_negatives.walk(members, bests, x, np.arange(len(x)))
    assert done < 0.3 * len(members) * len(x)
    for u, (best,) in zip(members, bests):
        expected = sorted((-int(s), i) for i, s in enumerate(x @ u))[:10]
        assert list(zip((-best.scores).tolist(), best.ids.tolist())) == expected


def _damage(rows):
    """(conv, turn, role, text) rows after the known damage."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        code = zlib.crc32(name.encode()) % 20
        if code == 1:
            text = ""
        elif code == 2:
            text = re.sub("[.!?]", "", text)
        elif code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def _repaired(rows):
    """One conversation by a plain table of all costs from the end; rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    white = " \t\n\v\f\r"
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(white)
        faults.append(0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else 3)
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    legal = {("s", "u"), ("u", "a"), ("a", "u")}
    illegal = sum((a[1][:1], b[1][:1]) not in legal for a, b in itertools.pairwise(rows))
    wanted = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    n = len(rows)
    best = {}
    for i in range(n, -1, -1):
        here = {s: [(0, "", ())] if i == n and s in ("", "a") else [] for s in wanted}
        if i < n:
            _, role, text = rows[i]
            for s in wanted:
                extra = 3 * (faults[i] == 2)
                ways = [("D", 4, s, ())]
                if faults[i] > 1:
                    if (s, role[:1]) in legal or (not s and role[:1] in ("s", "u")):
                        ways.append(("K", extra, role[:1], (f"{role}:{text}",)))
                    ways.append(("R", 3 + extra, wanted[s], (f"{names[wanted[s]]}:{text}",)))
                for edit, cost, t, made in ways:
                    here[s] += [(cost + c, edit + e, made + m) for c, e, m in [best[i + 1, t]]]
        for _ in range(4):  # insertions
            now = {s: min(x) for s, x in here.items() if x}
            for s, t in wanted.items():
                if t in now:
                    c, e, m = now[t]
                    here[s].append((3 + c, "I" + e, (f"{names[t]}:",) + m))
        best |= {(i, s): min(x) for s, x in here.items()}
    cost, audit, made = best[0, ""]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
    return (gaps, faults.count(0), faults.count(1), faults.count(2), illegal, cost, audit, digest)


def _conversations():
    rng = random.Random(8)
    texts = ["Yes.", "No!", "Why?", "cut off", " ", "", None, "two. lines\nhere", "é…", "Ok. \t", "1", "2.", "3?", "4!"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"]
    rows = []
    for conv in range(400):
        turns = [None if rng.random() < 0.05 else rng.randrange(12) for _ in range(rng.randrange(1, 12))]
        legal = rng.random() < 0.5
        for i, turn in enumerate(sorted(turns, key=lambda t: (t is not None, t or 0))):
            role = ("user", "assistant")[i % 2] if legal else rng.choice(roles)
            rows.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."))
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Hi."), (None, 2, "assistant", "So.")]
    rows += rows[100:110]  # repeated rows
    # one conversation of a third of all rows, with runs of equal rows
    for i in range(1_500):
        role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[i % 2]
        rows.append((7_000, i, role, rng.choice(["Said again.", f"line {i}.", f"line {i}"])))
    return rows + [(7_000, 700, "user", "Same.")] * 300


@pytest.mark.parametrize("segment, parts", [(256, 8), (16, 8), (7, 1)])
def test_conversation_repair(spark, monkeypatch, segment, parts):
    monkeypatch.setattr(conversation_repair, "SEGMENT", segment)
    rows = _conversations()
    docs = spark.createDataFrame(
        [(*r, 5, "x") for r in rows], "conv_id long, turn long, role string, text string, copies int, part string"
    ).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = conversation_repair.repair(conversation_repair.damaged(docs)).collect()
        assert not conversation_repair.repair(conversation_repair.damaged(docs.limit(0))).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    groups = {conv: [] for conv, *_ in rows}
    for conv, *rest in _damage(rows):
        groups[conv].append(tuple(rest))
    expected = {conv: _repaired(own) for conv, own in groups.items()}
    assert len(found) == len(expected)
    assert {r[0]: tuple(r[1:]) for r in found} == expected
    assert set("".join(r[6] for r in expected.values())) == set("DIKR")


def test_bidirectional_search_finds_the_least_edits():
    """Cost and audit of many short conversations, and of a long one by joined segments."""
    rng = random.Random(9)
    make = conversation_repair.Item
    choices = [make(r, t, 0) for r in "sua?" for t in (False, True)] + [make("", False, 2)]

    def plain(items, s, ends):
        best = {(len(items), t): (0, "") for t in ends}
        for i in range(len(items), -1, -1):
            for _ in range(4):
                for a in conversation_repair.STATES:
                    ways = [(3, "I", best.get((i, conversation_repair.WANTED[a])))]
                    if i < len(items):
                        ways += [(x.cost, x.edits, best.get((i + 1, x.state))) for x in conversation_repair.steps(items[i])[a]]
                    found = [(c + y[0], e + y[1]) for c, e, y in ways if y]
                    found += [best[i, a]] if (i, a) in best else []
                    if found:
                        best[i, a] = min(found)
        return best[0, s]

    for _ in range(1_500):
        items = [rng.choice(choices) for _ in range(rng.randrange(0, 9))]
        assert conversation_repair.cheapest(items, 0, (0, 3)) == plain(items, 0, (0, 3))
    items = [rng.choice(choices) for _ in range(120)]
    whole = conversation_repair.table(items)
    halves = conversation_repair.table([])
    for at in range(0, 120, 13):
        halves = conversation_repair.joined(halves, conversation_repair.table(items[at : at + 13]))
    assert halves == whole
