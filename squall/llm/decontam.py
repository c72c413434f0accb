"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are normalised (lower case, white space runs as one space). An item of m
characters may differ from a passage in k = m * ``ERROR_RATE`` edits at most. Cut into
k + 1 pieces, at least one piece of a matching passage is untouched: an Aho-Corasick automaton
over all items' pieces finds exact piece hits in each whole text, and the passage around
each hit is verified with Myers' bit-parallel edit distance; windows of an item that overlap are
one passage, so a text of repeated hits is verified in linear time. Every item within its budget
is found; nothing else is reported.

Items are taken in blocks of bounded size (``BLOCK_PIECES`` pieces, each block one pass whose hits
are stored before the next is taken), so a benchmark of any size can be used; the driver holds a
block, and its automaton is built once for a Python worker.

Defined results: null or empty texts and items match nothing; items of fewer than ``WHOLE``
characters, whose budget is zero, match where they stand between word edges (no letter or digit
next to them). Rows that repeat an item_id or
doc_id are separate items or documents, reported once for each pair of ids with
the smallest distance. Empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.llm import common

ERROR_RATE = 0.05         # edits an item's passage may have, as a share of its characters
BLOCK_PIECES = 200_000    # pieces in an automaton
WHOLE = 20                # shorter normalised items must stand between word edges

HITS = "doc_id long, item_id long, distance int, start int, end int"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(m: int, rate: float = ERROR_RATE) -> int:
    return int(m * rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length, with their places."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, k: int) -> tuple[int, int] | None:
    """Smallest edit distance of ``pattern`` to any passage of ``text`` and the first such passage's end, if at most k."""
    m = len(pattern)
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, None
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (~(xh | pv) & full), pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | (~(xv | ph) & full), ph & xv
        if score <= k and (best is None or score < best[0]):
            best = score, j + 1
    return best


class Matcher:
    """Finds the items in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(i, t, budget(len(t), rate) if len(t) >= WHOLE else 0) for i, t in items]
        self.automaton = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int]]] = {}
        for n, (_, t, k) in enumerate(self.items):
            for place, piece in pieces(t, k):
                owners.setdefault(piece, []).append((n, place))
        for piece, own in owners.items():
            self.automaton.add_word(piece, (len(piece), own))
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, tuple[int, int, int]]:
        """item_id: (distance, start, end) of its best passage in a normalised text (start is exact for distance 0)."""
        found: dict[int, tuple[int, int, int]] = {}
        windows: dict[int, list[list[int]]] = {}
        if not self.items:
            return found
        for last, (length, own) in self.automaton.iter(text):
            for n, place in own:
                item_id, item, k = self.items[n]
                if found.get(item_id, (1,))[0] == 0:
                    continue
                begin = last + 1 - length - place
                if begin >= 0 and text.startswith(item, begin) and (len(item) >= WHOLE or _at_edges(text, begin, begin + len(item))):
                    found[item_id] = (0, begin, begin + len(item))
                    continue
                if k == 0:
                    continue
                lo, hi = max(0, begin - k), min(len(text), begin + len(item) + k)
                own_windows = windows.setdefault(n, [])
                if own_windows and lo <= own_windows[-1][1] and hi >= own_windows[-1][0]:
                    own_windows[-1] = [min(lo, own_windows[-1][0]), max(hi, own_windows[-1][1])]
                else:
                    own_windows.append([lo, hi])
        for n, held in windows.items():
            item_id, item, k = self.items[n]
            merged: list[list[int]] = []
            for lo, hi in sorted(held):
                if merged and lo <= merged[-1][1]:
                    merged[-1][1] = max(hi, merged[-1][1])
                else:
                    merged.append([lo, hi])
            for lo, hi in merged:
                if found.get(item_id, (1,))[0] == 0:
                    break
                best = myers(item, text[lo:hi], k)
                if best and best[0] < found.get(item_id, (k + 1,))[0]:
                    found[item_id] = (best[0], lo, lo + best[1])
        return found


def _at_edges(text: str, begin: int, end: int) -> bool:
    return not (begin and text[begin - 1].isalnum()) and not text[end:end + 1].isalnum()


_MATCHERS: dict[int, Matcher] = {}


def _matcher(items: list[tuple[int, str]], rate: float) -> Matcher:
    """A worker's matcher of the block; it keeps one."""
    key = hash((rate, tuple(items)))
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(items, rate)
    return _MATCHERS[key]


def _search(batches, items: list[tuple[int, str]], rate: float):
    matcher = _matcher(items, rate)
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows += [(doc, item, *hit) for item, hit in matcher.find(normal(text.as_py())).items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i < 2 else pa.int32()) for i in range(5)],
                                         names=["doc_id", "item_id", "distance", "start", "end"])


def blocks(benchmark: DataFrame, rate: float = ERROR_RATE, size: int = BLOCK_PIECES):
    """The benchmark's normalised non-empty items in lists of at most ``size`` pieces (one item at least)."""
    block, held = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), "text").distinct().orderBy("item_id", "text")
    for item_id, text in rows.toLocalIterator():
        item = normal(text)
        if not item:
            continue
        n = budget(len(item), rate) + 1
        if block and held + n > size:
            yield block
            block, held = [], 0
        block.append((item_id, item))
        held += n
    if block:
        yield block


def without(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, size: int = BLOCK_PIECES) -> DataFrame:
    """The rows of ``docs`` that hold no item within its budget: each text is searched where it lies, nothing is joined."""
    for block in blocks(benchmark, rate, size):
        docs = docs.where(~_holds(block, rate)("text"))
    return docs


def _holds(items: list[tuple[int, str]], rate: float):
    @F.pandas_udf("boolean")
    def holds(texts):
        import pandas as pd
        matcher = _matcher(items, rate)
        return pd.Series([bool(matcher.find(normal(t))) for t in texts], dtype=bool)

    return holds


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, size: int = BLOCK_PIECES) -> DataFrame:
    """Pairs (doc_id, item_id, distance, start, end) of documents that hold an item within its edit budget.

    ``start`` and ``end`` are places in the normalised text: exact where distance is 0, else
    the searched window's start and the passage's end.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for block in blocks(benchmark, rate, size):
        hits = common.stored(texts.mapInArrow(partial(_search, items=block, rate=rate), HITS), "benchmark-hits")
        out = hits if out is None else out.unionByName(hits)
    if out is None:
        out = docs.sparkSession.createDataFrame([], HITS)
    best = F.min(F.struct("distance", "start", "end")).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.distance", "best.start", "best.end")
