"""Secret scan: fixed patterns, and automata inferred from labelled credentials.

Base spans come from three patterns (``assign``, ``access``, ``hex``). Their credentials, with
their kind as label, train one probabilistic automaton a kind: the strings, as character
classes, form a prefix tree, and states whose outgoing and ending frequencies agree (Hoeffding
bound) are merged, so the automaton generalises to the kind's format. One more automaton is
learned from ordinary strings. Every candidate string (maximal run of credential characters,
12 or more) of every whole text is scored by the difference of log-likelihoods between its
best kind and the ordinary one; candidates at or above ``THRESHOLD`` that touch no base span are
added as ``learned``.

Automata are fitted on at most ``TRAIN_STRINGS`` distinct strings a label, those of the smallest
hash among the labelled and ordinary strings of all documents; each task keeps its smallest ones,
so little is shuffled. A rare kind trains on all its strings, however large the table. Scoring
covers all documents.

Defined results: null text is empty and has no spans; without training strings of a label
its automaton is left out (no automaton: nothing is learned); rows that repeat a doc_id are
separate rows; extra columns are ignored. Candidates of any length are scored whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.llm import common

KINDS = ("assign", "access", "hex", "learned")
# The base patterns.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
_WORDS = ("password", "passwd", "secret", "token", "api")

TRAIN_STRINGS = 2_000
TRAIN_LENGTH = 200        # longer strings do not train
FEW = 8                  # strings that are followed one by one
ALPHA = 0.05              # confidence of the merge test
THRESHOLD = 7.0           # log-likelihood ratio, about 1000 to 1

_GROUPS = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", *"+/_.=-")
SYMBOLS = len(_GROUPS)
_CLASS = np.zeros(128, np.int64)
for _i, _g in enumerate(_GROUPS):
    _CLASS[[ord(c) for c in _g]] = _i


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[str, str]], list[tuple[int, int]]]:
    """Spans (start, kind number, end), labelled credentials (kind, string), and candidates (start, end)."""
    spans, labelled = [], []
    low = text.lower()
    if any(w in low for w in _WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 12:
                spans.append((m.start(), 0, m.end()))
                labelled.append(("assign", m[2]))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 18:
                spans.append((m.start(), 1, m.end()))
                labelled.append(("access", m[0]))
    runs = []
    for run in CANDIDATE.finditer(text):
        runs.append(run.span())
        if run.end() - run.start() >= 16:      # a run of hex digits lies inside a run of credential characters
            for m in HEX.finditer(text, *run.span()):
                spans.append((m.start(), 2, m.end()))
                labelled.append(("hex", m[0]))
    return sorted(spans), labelled, runs


def untouched(spans: list[tuple[int, int, int]], runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs that no span overlaps; both lists are in order of start, so one pass does."""
    out, at, reach = [], 0, -1
    for start, end in runs:
        while at < len(spans) and spans[at][0] < end:      # reach: the furthest end of the spans that begin before this run's end
            reach = max(reach, spans[at][2])
            at += 1
        if reach <= start:
            out.append((start, end))
    return out


def symbols(strings: list[str]) -> list[np.ndarray]:
    return [_CLASS[np.frombuffer(s.encode("ascii"), np.uint8)] for s in strings]


class Automaton:
    """Probabilistic automaton inferred by merging compatible prefix-tree states."""

    def __init__(self, strings: list[np.ndarray], alpha: float = ALPHA):
        self.visits, self.ends = [0], [0]
        self.next: list[dict[int, int]] = [{}]
        self.took: list[dict[int, int]] = [{}]
        for s in strings:
            at = 0
            self.visits[0] += 1
            for c in s.tolist():
                self.took[at][c] = self.took[at].get(c, 0) + 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.visits)
                    self.visits.append(0)
                    self.ends.append(0)
                    self.next.append({})
                    self.took.append({})
                at = self.next[at][c]
                self.visits[at] += 1
            self.ends[at] += 1
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()
        self._tables()

    def _agree(self, f: int, n: int, g: int, m: int) -> bool:
        return abs(f / n - g / m) < self._bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, red: int, blue: int) -> bool:
        todo = [(red, blue)]
        while todo:
            r, b = todo.pop()
            n, m = self.visits[r], self.visits[b]
            if not self._agree(self.ends[r], n, self.ends[b], m):
                return False
            for c in self.took[r].keys() | self.took[b].keys():
                if not self._agree(self.took[r].get(c, 0), n, self.took[b].get(c, 0), m):
                    return False
                if c in self.next[r] and c in self.next[b]:
                    todo.append((self.next[r][c], self.next[b][c]))
        return True

    def _fold(self, red: int, blue: int) -> None:
        todo = [(red, blue)]
        while todo:
            r, b = todo.pop()
            self.visits[r] += self.visits[b]
            self.ends[r] += self.ends[b]
            for c, n in self.took[b].items():
                self.took[r][c] = self.took[r].get(c, 0) + n
                if c in self.next[r]:
                    todo.append((self.next[r][c], self.next[b][c]))
                else:
                    self.next[r][c] = self.next[b][c]

    def _merge_all(self) -> None:
        red = [0]
        while True:
            known = set(red)
            blue = [(b, r, c) for r in red for c, b in sorted(self.next[r].items()) if b not in known]
            if not blue:
                break
            b, parent, c = max(blue, key=lambda x: (self.visits[x[0]], -x[0]))
            for r in red:
                if self._compatible(r, b):
                    self.next[parent][c] = r
                    self._fold(r, b)
                    break
            else:
                red.append(b)
        self.states = red

    def _tables(self) -> None:
        number = {s: i for i, s in enumerate(self.states)}
        lost = len(number)                       # after a step never seen: every symbol alike
        self.step = np.full((lost + 1, SYMBOLS), lost, np.int32)
        self.score = np.full((lost + 1, SYMBOLS + 1), -math.log(SYMBOLS + 1))
        for s, i in number.items():
            n = self.visits[s] + 0.5 * (SYMBOLS + 1)
            for c in range(SYMBOLS):
                self.score[i, c] = math.log((self.took[s].get(c, 0) + 0.5) / n)
                if c in self.next[s]:
                    self.step[i, c] = number[self.next[s][c]]
            self.score[i, SYMBOLS] = math.log((self.ends[s] + 0.5) / n)

    def _walk(self, symbols_: np.ndarray, at: int, total: float) -> tuple[int, float]:
        step, score = self.step.tolist(), self.score.tolist()
        for c in symbols_.tolist():
            total += score[at][c]
            at = step[at][c]
        return at, total

    def log_likelihood(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of many strings at once: ``flat`` holds their symbols one after the other."""
        order = np.argsort(-lengths, kind="stable")
        at, total = np.zeros(len(lengths), np.int32), np.zeros(len(lengths))
        longest_first, live = lengths[order], len(order)
        for i in range(int(longest_first[0]) if live else 0):
            live = np.searchsorted(-longest_first, -i, side="left")
            now = order[:live]
            if live <= FEW:                      # the last long strings one by one: a step over an array costs as much as many of these
                for n in now.tolist():
                    at[n], total[n] = self._walk(flat[starts[n] + i:starts[n] + lengths[n]], int(at[n]), float(total[n]))
                break
            c = flat[starts[now] + i]
            total[now] += self.score[at[now], c]
            at[now] = self.step[at[now], c]
        return total + self.score[at, SYMBOLS]


class Formats:
    """Automata of the credential kinds and of ordinary strings."""

    def __init__(self, labelled: dict[str, list[str]], ordinary: list[str]):
        kinds = [k for k in KINDS[:3] if labelled.get(k)]
        self.kinds = [Automaton(symbols(labelled[k])) for k in kinds] if ordinary else []
        self.ordinary = Automaton(symbols(ordinary)) if ordinary else None

    def scores(self, strings: list[str]) -> np.ndarray:
        """Log-likelihood ratio of the best kind against ordinary strings."""
        if not self.kinds or not strings:
            return np.full(len(strings), -np.inf)
        lengths = np.array([len(s) for s in strings])
        flat = _CLASS[np.frombuffer("".join(strings).encode("ascii"), np.uint8)]
        starts = np.cumsum(lengths) - lengths
        return np.max([a.log_likelihood(flat, starts, lengths) for a in self.kinds], axis=0) - self.ordinary.log_likelihood(flat, starts, lengths)


class Smallest:
    """The distinct strings of the smallest MD5, at most ``most``."""

    def __init__(self, most: int):
        self.most, self.held, self.limit = most, {}, "g"      # above every hex digest

    def add(self, string: str) -> None:
        mark = hashlib.md5(string.encode()).hexdigest()
        if mark < self.limit:
            self.held[mark] = string
            if len(self.held) > 2 * self.most:
                self._cut()

    def _cut(self) -> None:
        self.held = dict(sorted(self.held.items())[:self.most])
        if len(self.held) == self.most:
            self.limit = max(self.held, default=self.limit)

    def strings(self) -> list[str]:
        self._cut()
        return list(self.held.values())


def _training(batches, most: int):
    kept = {k: Smallest(most) for k in (*KINDS[:3], "ordinary")}
    for batch in batches:
        for text in batch.column(0):
            t = text.as_py() or ""
            spans, labelled, runs = base_spans(t)
            own = labelled + [("ordinary", t[a:b]) for a, b in untouched(spans, runs)]
            for k, s in own:
                if len(s) <= TRAIN_LENGTH:
                    kept[k].add(s)
    for k, best in kept.items():
        strings = best.strings()
        yield pa.RecordBatch.from_arrays([pa.array([k] * len(strings), pa.string()), pa.array(strings, pa.string())], names=["kind", "string"])


def learn(docs: DataFrame, train_strings: int = TRAIN_STRINGS) -> Formats:
    """Fit the automata on at most ``train_strings`` strings a label of all ``docs`` (text)."""
    strings = common.stored(docs.select("text").where("text is not null").mapInArrow(partial(_training, most=train_strings), "kind string, string string")
                            .distinct(), "credential-strings")
    labelled = {}
    for kind in (*KINDS[:3], "ordinary"):
        best = strings.where(F.col("kind") == kind).orderBy(F.md5("string")).limit(train_strings)
        labelled[kind] = [r["string"] for r in best.collect()]
    ordinary = labelled.pop("ordinary")
    return Formats(labelled, ordinary)


_SPANS = [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
          ("spans", pa.string()), ("n_learned", pa.int64())]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(batches, formats: Formats, threshold: float):
    for batch in batches:
        found, open_ = [], []
        for i, text in enumerate(batch.column(1)):
            t = text.as_py() or ""
            spans, _, runs = base_spans(t)
            found.append(spans)
            open_ += [(i, a, b, t[a:b]) for a, b in untouched(spans, runs)]
        learned: dict[int, list] = {}
        for hit in np.flatnonzero(formats.scores([o[3] for o in open_]) >= threshold):
            i, a, b, _ = open_[hit]
            learned.setdefault(i, []).append((a, 3, b))
        rows = []
        for i, (doc, spans) in enumerate(zip(batch.column(0).to_pylist(), found)):
            more, base = learned.get(i, []), joined(spans)
            rows.append((doc, *(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(base.encode()).hexdigest(),
                         joined(sorted(spans + more)) if more else base, len(more)))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(_SPANS)], names=[n for n, _ in _SPANS])


def scan(docs: DataFrame, formats: Formats | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts, digest of the base spans, all spans."""
    formats = formats or learn(docs)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(partial(_scan, formats=formats, threshold=threshold),
                        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_learned long"))
