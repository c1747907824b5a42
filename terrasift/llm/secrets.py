"""Secret scan: stated patterns, and automata inferred from the credentials they find.

The stated patterns label credentials in the documents. From a bounded sample of
those a prefix tree of character classes is built for each kind, and states whose
outgoing frequencies are statistically compatible (Hoeffding bound) are merged
into a probabilistic automaton; ordinary tokens give one more, the background.
Tokens in every document are then scored by how much likelier a credential
automaton makes their format than the background does. Those that gain more than
``EVIDENCE`` bits and ``MARGIN`` bits for each character become ``format`` spans:
what a token must gain per character grows as its length falls, and no length is
left out. Ordinary tokens that an automaton prefers are left out of the
background, as they may be credentials.

Scored are all runs of ``CANDIDATE``, full stops included, or what the stated
spans leave of them, without full stops and hyphens at their ends.

The sample is bounded by ``SAMPLE_PER_KIND`` distinct tokens of each kind, in the
order of a hash, of at most ``LONGEST`` characters, and four times as many ordinary
ones: three quarters drawn by how often they occur, the rest from the ``SHAPES`` most
frequent shapes (numbers, dates, addresses), so that rare but ordinary forms are known
to the background. The scan covers all text.

Defined cases: a null or empty text has no spans; repeated rows are scanned each;
without labelled credentials no ``format`` spans are added; an empty table gives
an empty result. Spans count code points, end exclusive. Extra columns are left
alone.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import staged

# Fixed patterns; the lower bounds on lengths are part of them.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "format")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]+")
ENDS = ".-"           # not part of a token at its ends

SAMPLE_PER_KIND, LONGEST, SHAPES = 400, 200, 100
ALPHA = 0.05          # of the Hoeffding bound
PASSES = 4            # fits of the background at most
EVIDENCE = 10.0       # bits that a credential must stand above the background, whatever its length
MARGIN = 0.25         # and bits for each of its characters
VERDICTS = 500_000    # tokens whose verdict a task keeps
MASK = "[SECRET]"
CLASSES = {**{c: "d" for c in "0123456789"}, **{c: "h" for c in "abcdef"}, **{c: "l" for c in "ghijklmnopqrstuvwxyz"},
           **{c: "H" for c in "ABCDEF"}, **{c: "L" for c in "GHIJKLMNOPQRSTUVWXYZ"}}
CLASS_SIZE = {"d": 10, "h": 6, "l": 20, "H": 6, "L": 20}
SYMBOLS = "dhlHL+/_=-."
CODES = np.zeros(256, np.int64)
for _c in range(256):
    CODES[_c] = max(SYMBOLS.find(CLASSES.get(chr(_c), chr(_c))), 0)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the stated patterns, ordered by start and kind."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda x: (x[0], x[2]))]


class Automaton:
    """Probabilistic automaton learned by merging the states of a prefix tree."""

    def __init__(self, tokens: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        self.ends = [0]
        for token in tokens:
            self._add("".join(CLASSES.get(c, c) for c in token))
        self._merge_states()
        self._close()

    def _add(self, symbols: str) -> None:
        at = 0
        for s in symbols:
            if s not in self.next[at]:
                self.next.append({})
                self.count.append({})
                self.ends.append(0)
                self.next[at][s] = len(self.next) - 1
            self.count[at][s] = self.count[at].get(s, 0) + 1
            at = self.next[at][s]
        self.ends[at] += 1

    def _total(self, state: int) -> int:
        return self.ends[state] + sum(self.count[state].values())

    def _compatible(self, a: int, b: int) -> bool:
        """Whether two states, and those reached alike from them, show the same frequencies."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self._total(a), self._total(b)
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            pairs = [(self.ends[a], self.ends[b])]
            for s in self.count[a].keys() | self.count[b].keys():
                pairs.append((self.count[a].get(s, 0), self.count[b].get(s, 0)))
                if s in self.next[a] and s in self.next[b]:
                    todo.append((self.next[a][s], self.next[b][s]))
            if any(abs(x / n - y / m) > bound for x, y in pairs):
                return False
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.ends[a] += self.ends[b]
            for s, n in self.count[b].items():
                self.count[a][s] = self.count[a].get(s, 0) + n
                if s in self.next[a]:
                    todo.append((self.next[a][s], self.next[b][s]))
                else:
                    self.next[a][s] = self.next[b][s]

    def _merge_states(self) -> None:
        """Red states are final; a state next to one is merged into the first compatible red state or made red."""
        red = [0]
        while True:
            seen = set(red)
            blue = next(((r, s) for r in red for s in sorted(self.next[r]) if self.next[r][s] not in seen), None)
            if blue is None:
                break
            r, s = blue
            state = self.next[r][s]
            into = next((x for x in red if self._compatible(x, state)), None)
            if into is None:
                red.append(state)
            else:
                self.next[r][s] = into
                self._fold(into, state)
        self.states = red

    def _close(self) -> None:
        """Tables of the merged states: next state and bits of each symbol, smoothed, with a sink for what was never seen."""
        index = {state: k for k, state in enumerate(self.states)}
        sink, width = len(self.states), len(SYMBOLS) + 1
        self.step = np.full((sink + 1, width), sink, np.int32)
        self.bits = np.zeros((sink + 1, width))
        for state in [*self.states, None]:
            k = sink if state is None else index[state]
            total = 0 if state is None else self._total(state)
            for c, s in enumerate(SYMBOLS):
                seen = 0 if state is None else self.count[state].get(s, 0)
                self.bits[k, c] = math.log2((seen + 0.1) / (total + 0.1 * width) / CLASS_SIZE.get(s, 1))
                if seen:
                    self.step[k, c] = index[self.next[state][s]]
            seen = 0 if state is None else self.ends[state]
            self.bits[k, -1] = math.log2((seen + 0.1) / (total + 0.1 * width))
        del self.next, self.count, self.ends

    def bits_of(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Bits of many tokens, whose symbols lie one after the other in ``codes``."""
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order))
        for at in range(int(lengths[0]) if len(lengths) else 0):
            live = np.searchsorted(-lengths, -at, "left")  # the tokens longer than this come first
            symbol = codes[starts[:live] + at]
            total[:live] += self.bits[state[:live], symbol]
            state[:live] = self.step[state[:live], symbol]
        total += self.bits[state, -1]
        out = np.empty(len(order))
        out[order] = total
        return out

    def score(self, token: str) -> float:
        """Bits per character of a token."""
        codes = CODES[np.frombuffer(token.encode(), np.uint8)]
        return float(self.bits_of(codes, np.zeros(1, np.int64), np.array([len(token)]))[0]) / len(token)


def needed_bits(lengths):
    """What tokens of these lengths must gain over the background, in bits."""
    return EVIDENCE + MARGIN * lengths


def outside(spans, size: int) -> list[tuple[int, int]]:
    """The parts of a text of this size that no span covers."""
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if a > at:
            out.append((at, a))
        at = max(at, b)
    return [*out, (at, size)] if at < size else out


class Formats:
    """The inferred automata, and what they say of tokens."""

    def __init__(self, credentials: dict[str, list[str]], ordinary: list[str]):
        self.kinds = {k: Automaton(v) for k, v in credentials.items() if v}
        self.verdicts: dict[str, bool] = {}
        # Unlabelled credentials among the ordinary tokens, which the automata prefer, must not shape the background.
        for _ in range(PASSES):
            self.background = Automaton(ordinary)
            kept = [t for t, gain in zip(ordinary, self.gains(ordinary)) if gain <= 0]
            if len(kept) == len(ordinary):
                break
            ordinary = kept

    def gains(self, tokens: list[str]) -> np.ndarray:
        """Bits by which the likeliest credential automaton stands above the background, for each token."""
        if not tokens or not self.kinds:
            return np.full(len(tokens), -np.inf)
        codes = CODES[np.frombuffer("".join(tokens).encode(), np.uint8)]
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        starts = np.append(0, np.cumsum(lengths)[:-1])
        best = np.max([a.bits_of(codes, starts, lengths) for a in self.kinds.values()], axis=0)
        return best - self.background.bits_of(codes, starts, lengths)

    def accepted(self, tokens: set[str]) -> set[str]:
        """Those of the tokens that have the format of a credential."""
        known = self.verdicts
        fresh = [t for t in tokens if t not in known]
        if len(known) + len(fresh) > VERDICTS:
            known.clear()
            fresh = list(tokens)
        gains = self.gains(fresh)
        known.update(zip(fresh, (gains > needed_bits(np.fromiter(map(len, fresh), np.int64, len(fresh)))).tolist()))
        return {t for t in tokens if known[t]}

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """All spans of a text, the stated ones first of equal start."""
        base = base_spans(text)
        if not self.kinds:
            return base
        parts = outside(base, len(text))
        tokens = {t.strip(ENDS) for a, b in parts for t in CANDIDATE.findall(text, a, b)}
        tokens.discard("")
        found = self.accepted(tokens)
        if not found:
            return base
        added = []
        for a, b in parts:
            for m in CANDIDATE.finditer(text, a, b):
                token = m[0].strip(ENDS)
                if token in found:
                    start = m.start() + len(m[0]) - len(m[0].lstrip(ENDS))
                    added.append((start, start + len(token), "format"))
        return sorted(base + added, key=lambda x: (x[0], KINDS.index(x[2])))


def shape(token: str) -> str:
    """Digits, small and capital letters as one sign for each run, other characters as they are."""
    return re.sub(r"A+", "A", re.sub(r"a+", "a", re.sub(r"0+", "0", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"[0-9]", "0", token))))))


def infer_formats(documents: DataFrame) -> Formats:
    """Learn the automata from the credentials and ordinary tokens of the documents."""
    def run(batches):
        for batch in batches:
            out: Counter[tuple[str, str]] = Counter()
            for text in batch.column(0).to_pylist():
                if text:
                    spans = base_spans(text)
                    for a, b, kind in spans:
                        out[kind, ASSIGN.fullmatch(text[a:b])[1] if kind == "assign" else text[a:b]] += 1
                    if spans:  # ordinary tokens come from the documents that hold credentials
                        out.update(("ordinary", token) for a, b in outside(spans, len(text)) for t in CANDIDATE.findall(text, a, b)
                                   if (token := t.strip(ENDS)))
            rows = [x for x in out if len(x[1]) <= LONGEST]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(values, pa.string()) for values in ([x[0] for x in rows], [x[1] for x in rows], [shape(x[1]) for x in rows])),
                 pa.array([out[x] for x in rows], pa.int64())], ["kind", "token", "shape", "n"])

    found = documents.select("text").mapInArrow(run, "kind string, token string, shape string, n long")
    tokens = staged(found.groupBy("kind", "token", "shape").agg(F.sum("n").alias("n")), "tokens")
    # Ordinary tokens are drawn by how often they occur: random strings do not repeat, and among distinct tokens they would prevail as tables grow.
    draw = -F.log((F.pmod(F.xxhash64("token"), F.lit(1 << 52)) + 0.5) / float(1 << 52)) / F.col("n")

    def first(rows: DataFrame, order, count: int) -> list[str]:
        return [r["token"] for r in rows.orderBy(order, "token").limit(count).collect()]

    sample = {kind: first(tokens.filter(F.col("kind") == kind), F.xxhash64("token"), SAMPLE_PER_KIND) for kind in KINDS[:3]}
    ordinary = tokens.filter("kind = 'ordinary'")
    common = ordinary.groupBy("shape").agg(F.sum("n").alias("_n")).orderBy(F.desc("_n"), "shape").limit(SHAPES).select("shape")
    # One row for each of SHAPES shapes; of each the tokens with the least hashes of 16 ranges of hashes.
    shaped = ordinary.join(F.broadcast(common), "shape").groupBy("shape", F.pmod(F.xxhash64("token"), F.lit(16)).alias("part")).agg(
        F.min(F.struct(F.xxhash64("token"), F.col("token").alias("token"))).alias("least"))
    by_shape = first(shaped.select("least.token", "part"), F.col("part"), SAMPLE_PER_KIND)
    return Formats(sample, sorted(set(by_shape)) + first(ordinary, draw, 3 * SAMPLE_PER_KIND))


def joined_spans(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan_documents(documents: DataFrame, formats: Formats | None = None) -> DataFrame:
    """doc_id, counts of the stated kinds, digest of the stated spans, and all spans, of every row."""
    formats = formats or infer_formats(documents)

    def run(batches):
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for text in batch.column(1).to_pylist():
                spans = formats.spans(text or "")
                base = [x for x in spans if x[2] != "format"]
                row = [*(sum(x[2] == k for x in base) for k in KINDS[:3]),
                       hashlib.sha256(joined_spans(base).encode()).hexdigest(), joined_spans(spans), len(spans) - len(base)]
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long")


def masked(text: str, spans) -> str:
    """The text with every span, overlapping ones together, replaced by ``MASK``."""
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask_secrets(documents: DataFrame, formats: Formats | None = None) -> DataFrame:
    """The documents with their secrets masked in ``text``; other columns, nulls included, stay."""
    formats = formats or infer_formats(documents)

    @F.arrow_udf("string")
    def mask(texts):
        return pa.array([x and masked(x, formats.spans(x)) for x in texts.to_pylist()], pa.string())

    return documents.withColumn("text", mask("text"))
