"""Packing of documents into fixed-size sequences: best fit, then swaps between underfull bins."""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import common

CACHED = 800_000  # words a worker remembers
LONGEST = 48  # bytes of the words it remembers
TEXTS = 6_144  # that are split and looked up at a time
LEARNT = 32_768  # unknown words that are Python objects at a time
# Bounds of the local search, all parameters of ``pack``.
STEPS = 10  # exchanges for each piece of a group, on average
PAIRED = 24  # longest pieces of a bin that are tried two at a time
# Below this character, lower case is one character of the same kind, and nothing composes.
_PLAIN = "\u0130"
_MARKS = ".,;:!?"
# Other characters, in UTF-8.
_NOT_PLAIN = re.compile(rb"[\xc5-\xff]|\xc4[\xb0-\xbf]").search
_SPECIAL = b"<|"  # what special strings begin with


class Encoding:
    """Packed ids (unsigned 32 bit, little endian) of words between ASCII white space.

    The tokenizer drops white space and never joins across it, so the ids of a text are
    those of its words in a row. It also parts letters from marks and lower-cases, so a
    word with marks at its end is its letters' ids and the marks' ids. Unknown runs of
    letters are encoded many at a time: each is one pre-token and ends with an end-of-word
    token, where the ids are cut apart again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Spark runs a task a core; threads of the library's own would take each other's time
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        # words known so far, their ids in a row, where each begins, and when it was last met
        self.words = pa.array([], pa.large_string())
        self.flat = np.zeros(0, "<u4")
        self.begins, self.sizes, self.met = (np.zeros(0, np.int64) for _ in range(3))
        self.clock = 0
        self.marks: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _letters(self, runs: list[str]) -> list[bytes]:
        """The ids of runs of letters, encoded many in one text."""
        out = []
        for at in range(0, len(runs), 4_000):
            part = runs[at : at + 4_000]
            ids = np.array(self._encode([" ".join(part)])[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                out += [self._ids(r).tobytes() for r in part]
                continue
            raw, cuts = ids.tobytes(), (4 * cuts).tolist()
            out += map(raw.__getitem__, map(slice, [0, *cuts], cuts))
        return out

    def _find(self, words: pa.Array) -> np.ndarray:
        """The place of each known word, -1 for others."""
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)

    def _add(self, words: pa.Array, ids: list[bytes]) -> None:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begins = len(self.flat) + np.cumsum(sizes) - sizes
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), "<u4")])
        self.words = pa.concat_arrays([self.words, words])
        self.begins, self.sizes = np.r_[self.begins, begins], np.r_[self.sizes, sizes]
        self.met = np.r_[self.met, np.full(len(ids), self.clock)]

    def _forget(self, keep: np.ndarray) -> None:
        own = self.sizes[keep]
        ends = np.cumsum(own)
        self.flat = self.flat[np.repeat(self.begins[keep] - (ends - own), own) + np.arange(int(own.sum()))]
        self.words, self.met = self.words.take(pa.array(keep)), self.met[keep]
        self.begins, self.sizes = ends - own, own

    def learn(self, words: list[str]) -> list[bytes]:
        """The ids of words that aren't known yet.

        Runs of plain letters, with marks behind them or not, go through the tokenizer many
        in one text unless they are known, all other words as texts of their own.
        """
        runs: dict[str, int] = {}
        plain, others = [], []
        for i, word in enumerate(words):
            run = word if word.isalpha() else word.rstrip(_MARKS)
            if run.isalpha() and len(word) <= LONGEST and (run.isascii() or max(run) < _PLAIN):
                plain.append((i, runs.setdefault(run.lower(), len(runs)), word[len(run) :]))
            else:
                others.append(i)
        named = list(runs)
        at = self._find(pa.array(named, pa.large_string())).tolist()
        new = iter(self._letters([r for r, k in zip(named, at) if k < 0]))
        begins, sizes = self.begins, self.sizes
        ids = [next(new) if k < 0 else self.flat[begins[k] : begins[k] + sizes[k]].tobytes() for k in at]
        out: list[bytes] = [b""] * len(words)
        for i, k, marks in plain:
            if not marks:
                out[i] = ids[k]
                continue
            if marks not in self.marks:
                self.marks[marks] = self._ids(marks).tobytes()
            out[i] = ids[k] + self.marks[marks]
        for first in range(0, len(others), 4_000):
            part = others[first : first + 4_000]
            for i, found in zip(part, self._encode([words[i] for i in part])):
                out[i] = np.array(found.ids, "<u4").tobytes()
        return out

    def texts(self, found: list[bytes]) -> list[bytes]:
        """The packed ids of each text: distinct words are looked up once for all texts."""
        lowered = pa.array(map(_lower, found), pa.large_binary(), size=len(found))
        split = pc.ascii_split_whitespace(lowered.cast(pa.large_string()))
        coded, offsets = split.flatten().dictionary_encode(), split.offsets.to_numpy()
        del lowered, split  # the words are held once
        words = coded.dictionary
        self.clock += 1
        at = self._find(words)
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = len(self.words) + np.arange(len(new))
            for first in range(0, len(new), LEARNT):
                missing = words.take(pa.array(new[first : first + LEARNT]))
                self._add(missing, self.learn(missing.to_pylist()))
        self.met[at] = self.clock
        numbers, out = coded.indices.to_numpy(), []
        for first in range(0, len(found), 256):  # so that places of ids are few at a time
            of = offsets[first : first + 257]
            own = at[numbers[of[0] : of[-1]]]
            sizes = self.sizes[own]
            ends = np.cumsum(sizes)
            place = np.repeat(self.begins[own] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
            tokens, cuts = self.flat[place], np.r_[0, ends][of - of[0]].tolist()
            out += [tokens[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        long_ = pc.greater(pc.binary_length(words), LONGEST).to_numpy(zero_copy_only=False)
        if long_.any():  # not remembered
            self._forget(np.setdiff1d(np.arange(len(self.words)), at[long_]))
        if len(self.words) > CACHED:  # the half that was met last stays
            self._forget(np.sort(np.argsort(self.met, kind="stable")[-CACHED // 2 :]))
        return out


def _lower(text: bytes) -> bytes:
    """A text of plain characters with A-Z in lower case, as the tokenizer makes it too, so
    that a word has few forms; others, and what may hold a special string, stay."""
    if _SPECIAL in text or not text.isascii() and _NOT_PLAIN(text):
        return text
    return text.lower()


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Documents as token ids with an end id, cut only where longer than ``capacity``.

    Columns: id, piece, start, length, ids_crc32 and, on request, ids. A NULL or empty
    text is the end id alone.
    """
    docs = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    schema = "piece int, start long, length long, ids_crc32 long"
    key = docs.schema[id_col]
    ddl = f"`{id_col}` {key.dataType.simpleString()}, {schema}" + ", ids array<int>" * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def make():
        # one in a Python worker: what it has learnt outlives a task
        encoding = common.kept(("encoding", tokenizer_path), lambda: Encoding(tokenizer_path))

        def fn(batch):
            rows: list[list] = [[] for _ in range(6)]
            for at, ids in enumerate(encoding.texts(common.texts(batch, "_text"))):
                ids += end
                for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    rows[0].append(at)
                    rows[1].append(k)
                    rows[2].append(start // 4)
                    rows[3].append(len(part) // 4)
                    rows[4].append(zlib.crc32(part))
                    if with_ids:
                        rows[5].append(np.frombuffer(part, "<i4"))
            columns = [batch.column(0).take(pa.array(rows[0], pa.int32()))]
            columns += [pa.array(rows[1], pa.int32())]
            columns += [pa.array(r, pa.int64()) for r in rows[2:5]]
            if with_ids:
                columns.append(pa.array(rows[5], pa.list_(pa.int32())))
            names = [id_col, "piece", "start", "length", "ids_crc32", "ids"][: len(columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

        return fn

    return common.map_batches(docs, make, ddl, rows=TEXTS)


class Bins:
    """Bins of one group of pieces; items are indices into ``lengths``."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.items: list[list[int]] = []
        self.free: list[int] = []
        self.by_free: dict[int, set[int]] = defaultdict(set)
        self.frees: list[int] = []  # sorted free sizes that some bin has
        # by rising length: an item's length, its bin's room, and the longest that fits in its place
        order = np.argsort(np.array(lengths, np.int64), kind="stable")
        self.order, self.place = order.tolist(), np.empty(len(lengths), np.int64)
        self.place[order] = np.arange(len(lengths))
        self.sorted = np.array(lengths, np.int64)[order]
        self.room = np.zeros(len(lengths), np.int64)
        self.where = [-1] * len(lengths)

    def _set_free(self, b: int, free: int) -> None:
        if b < len(self.free):
            old = self.free[b]
            self.by_free[old].discard(b)
            if not self.by_free[old]:
                del self.by_free[old]
                self.frees.pop(bisect_left(self.frees, old))
            self.free[b] = free
        else:
            self.free.append(free)
        if not self.by_free.get(free):
            insort(self.frees, free)
        self.by_free[free].add(b)

    def put(self, item: int, b: int) -> None:
        self.items[b].append(item)
        self.where[item] = b
        self._set_free(b, self.free[b] - self.lengths[item])
        self.room[self.place[self.items[b]]] = self.free[b]

    def take(self, item: int, b: int) -> None:
        self.items[b].remove(item)
        self._set_free(b, self.free[b] + self.lengths[item])
        self.room[self.place[self.items[b]]] = self.free[b]

    def best_fit(self) -> None:
        """Longest first, each into the fullest bin that has room."""
        for item in sorted(range(len(self.lengths)), key=lambda i: -self.lengths[i]):
            at = bisect_left(self.frees, self.lengths[item])
            if at < len(self.frees):
                b = min(self.by_free[self.frees[at]])
            else:
                b = len(self.items)
                self.items.append([])
                self._set_free(b, self.capacity)
            self.put(item, b)

    def underfull(self, width: int, apart_from: int) -> list[int]:
        """The ``width`` bins with most room that still hold something."""
        found = []
        for free in reversed(self.frees):
            if free == 0 or len(found) >= width:
                break
            for b in sorted(self.by_free[free]):
                if b != apart_from and self.items[b]:
                    found.append(b)
        return found[:width]

    def improve(self, b: int, paired: int = PAIRED) -> bool:
        """One exchange that moves length out of bin ``b`` into a fuller bin.

        Tried in turn: move a document; swap one, or two of the ``paired`` longest, for a
        shorter one of any other bin, the largest gain of all. Each raises the sum of
        squared fills, because the receiving bin is the fuller.
        """
        size = self.lengths
        own = sorted(self.items[b], key=lambda i: -size[i])
        for i in own:
            at = bisect_left(self.frees, size[i])
            while at < len(self.frees):
                fits = [x for x in self.by_free[self.frees[at]] if x != b and self.items[x]]
                fits = [x for x in fits if self.free[x] <= self.free[b]]
                if fits:
                    self.take(i, b)
                    self.put(i, min(fits))
                    return True
                at += 1
        # the longest that fits where an item lies; nothing where the bin isn't the fuller
        reach = np.where(self.room <= self.free[b], self.sorted + self.room, -1)
        reach[self.place[own]] = -1
        few = own[:paired]
        gives = {size[i]: (i,) for i in reversed(own)}
        gives |= {size[i] + size[j]: (i, j) for k, i in enumerate(few) for j in few[k + 1 :]
                  if size[i] + size[j] not in gives}
        best = (0, (), -1)
        for length, given in gives.items():
            if length > best[0]:  # a gain is less than what is given
                at = int(np.argmax(reach >= length))  # the shortest that makes room for it
                gain = length - int(self.sorted[at])
                if reach[at] >= length and gain > best[0]:
                    best = (gain, given, self.order[at])
        if not best[0]:
            return False
        theirs = best[2]
        x = self.where[theirs]
        for i in best[1]:
            self.take(i, b)
        self.take(theirs, x)
        for i in best[1]:
            self.put(i, x)
        self.put(theirs, b)
        return True

    def local_search(self, steps: int, paired: int) -> None:
        """Empty the bins with most room as long as the bound on the bin count allows.

        A bin that found no exchange is tried again once others have changed, until a whole
        round over the stuck ones finds none.
        """
        least = -(-sum(self.lengths) // self.capacity)
        stuck: set[int] = set()
        used, tried_at, changes = sum(1 for x in self.items if x), 0, 0
        while steps > 0 and used > least:
            source = [b for b in self.underfull(len(stuck) + 1, -1) if b not in stuck]
            if not source:
                if changes == tried_at:
                    break
                stuck, tried_at = set(), changes
                continue
            b = source[0]
            while steps > 0 and self.items[b] and self.improve(b, paired):
                steps -= 1
                changes += 1
            if self.items[b]:
                stuck.add(b)
            else:
                used -= 1


def pack_group(
    lengths: list[int], capacity: int, steps: int = STEPS, paired: int = PAIRED
) -> tuple[list[int], list[int], list[int]]:
    """Bin number, offset and free room of the bin for each length."""
    bins = Bins(lengths, capacity)
    bins.best_fit()
    bins.local_search(steps * len(lengths), paired)
    number, offset, room = [0] * len(lengths), [0] * len(lengths), [0] * len(lengths)
    n = 0
    for b, items in enumerate(bins.items):
        at = 0
        for i in items:
            number[i], offset[i], room[i] = n, at, bins.free[b]
            at += lengths[i]
        n += bool(items)
    return number, offset, room


def pack(
    cut: DataFrame,
    capacity: int = 4096,
    group_rows: int = 40_000,
    steps: int = STEPS,
    paired: int = PAIRED,
) -> DataFrame:
    """Place pieces (column ``length``, stored) into as few sequences as possible.

    Adds sequence_id and offset. Pieces are dealt at random into groups of about
    ``group_rows``; each group is packed on its own: best fit, then a local search that
    ends at the lower bound of the group's bins, when no bin finds an exchange, or after
    ``steps`` exchanges a piece. Every bin is a partner; two documents for one are given
    out of a bin's ``paired`` longest. Bins that stay less than 98 percent
    full in a first round are opened and their pieces dealt and packed once more, so the
    number of poorly filled sequences doesn't grow with the number of groups.
    """
    schema = T.StructType(
        cut.schema.fields
        + common.fields("sequence_id long, `offset` long, _room long")
    )
    names = cut.columns

    def packing(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        number, offset, room = pack_group(rows["length"].tolist(), capacity, steps, paired)
        out = rows[names].copy()
        out["sequence_id"] = np.array(number, np.int64) + (int(key[0]) << 32)
        out["offset"] = np.array(offset, np.int64)
        out["_room"] = np.array(room, np.int64)
        return out

    def one_round(rows: DataFrame, n: int, first: int) -> DataFrame:
        groups = -(-n // group_rows)
        dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(groups, 1)))
        return (
            rows.withColumn("_group", dealt + F.lit(first))
            .groupBy("_group")
            .applyInPandas(packing, schema)
        ), first + groups

    whole = F.col("length") == capacity
    full = cut.where(whole).select(
        *names,
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rest = cut.where(~whole)
    placed, first = one_round(rest, rest.count(), 0)
    placed = common.stored(placed, "packed")
    loose = F.col("_room") > capacity // 50
    again = placed.where(loose).drop("sequence_id", "offset", "_room")
    second, _ = one_round(again, again.count(), first)
    return full.unionByName(placed.where(~loose).drop("_room")).unionByName(second.drop("_room"))


def best_fit_packing(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_rows: int = 40_000,
    steps: int = STEPS,
    paired: int = PAIRED,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.
    A NULL or empty text is one end id, a NULL id is passed on, repeated rows are packed
    each on its own, an empty table gives no rows, further columns are ignored. ``steps``
    and ``paired`` bound the local search (see ``pack``).
    """
    cut = pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    return pack(common.stored(cut, "pieces"), capacity, group_rows, steps, paired)


def sequences(
    packed: DataFrame, with_ids: DataFrame, id_col: str = "doc_id"
) -> DataFrame:
    """The token ids of every sequence, for ids that are unique: sequence_id, length, ids."""
    ids = with_ids.select(id_col, "piece", "ids")
    parts = packed.join(ids, [id_col, "piece"]).groupBy("sequence_id")
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` ids
    return parts.agg(
        F.sum("length").alias("length"), F.flatten(ordered.getField("ids")).alias("ids")
    )
