"""Secret scan: base patterns, and credential formats learnt as probabilistic automata from labelled examples.

Grammar inference: the labelled values of a kind make a prefix tree; states are taken in order of depth and frequency and merged with
an earlier state whose outgoing frequencies, and those of all that follows, differ by no more than Hoeffding's bound allows (the likeliest
of those), else kept as a state of their own. What results is a deterministic probabilistic automaton a kind. One more is learnt from
ordinary runs. A candidate is any run of credential characters of MIN_LENGTH or more, of any length, that no base match touches; it is a secret
where its likelihood under some kind is more than exp(LOG_ODDS) times that as ordinary text.

Labels: values that the base patterns name in the table (a bounded sample, SAMPLE a kind, those of the smallest digests, so partitions
don't matter), and examples of published credential formats, made from FORMATS by a seeded generator; ordinary runs likewise from the
table and from ORDINARY. Sampling takes one pass whose tasks send SAMPLE values a kind at most; scoring is one pass over the texts alone, in which all
other columns stay on the JVM's side.

Defined results: a null text is an empty one, with no spans; rows that repeat an id are judged each; offsets are code points; an
empty table gives no rows; extra columns, also of clashing names, are ignored.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

c = F.col
#: The base patterns, in the order in which kinds are listed, the group that holds the value, and its least length.
BASE = (
    ("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)
#: The same matches sooner: only long runs are hexadecimal matches, and without one of the words in any case nothing is assigned.
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")
_ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
MIN_LENGTH = 12
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{MIN_LENGTH},}}")
LEARNT = "learnt"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
#: Labelled values of a kind that are sampled from the table at most, and examples made of each published format.
SAMPLE, EXAMPLES = 400, 120
#: Characters of an example that are learnt from; candidates are scored whole.
MAX_EXAMPLE = 200
#: Hoeffding's bound at this level; a state is told apart only on more evidence than that.
ALPHA = 0.05
#: A candidate has to be exp(LOG_ODDS) times likelier as a credential than as ordinary text.
LOG_ODDS = 14.0
_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_ALNUM = _UPPER + _LOWER + _DIGIT
#: Published credential formats, as pieces: a text stands for itself, (characters, least, most) for a random run.
FORMATS: dict[str, list] = {
    "github": [["ghp_", (_ALNUM, 36, 36)], ["gho_", (_ALNUM, 36, 36)], ["ghs_", (_ALNUM, 36, 36)]],
    "gitlab": [["glpat-", (_ALNUM + "_-", 20, 20)]],
    "slack": [["xoxb-", (_DIGIT, 10, 13), "-", (_DIGIT, 10, 13), "-", (_ALNUM, 24, 24)], ["xoxp-", (_DIGIT, 10, 13), "-", (_DIGIT, 10, 13), "-", (_ALNUM, 24, 32)]],
    "google": [["AIza", (_ALNUM + "_-", 35, 35)]],
    "stripe": [["sk_live_", (_ALNUM, 24, 24)], ["rk_live_", (_ALNUM, 24, 24)]],
    "temporary access": [["ASIA", (_UPPER + "234567", 16, 16)]],
    "package index": [["pypi-", (_ALNUM + "_-", 60, 90)], ["npm_", (_ALNUM, 36, 36)]],
    "signed token": [["eyJ", (_ALNUM + "_-", 17, 60), ".eyJ", (_ALNUM + "_-", 30, 90), ".", (_ALNUM + "_-", 43, 43)]],
    "upper hex": [[("0123456789ABCDEF", 32, 64)]],
    "base64 key": [[(_ALNUM + "+/", 40, 40)], [(_ALNUM + "+/", 43, 43), "="], [(_ALNUM + "+/", 86, 86), "=="]],
}
#: Runs of the same characters that are no secrets. A piece can also be a list of texts to choose from.
_WORDS = ["user", "config", "test", "data", "main", "index", "image", "file", "module", "python", "server", "local", "share", "value", "static", "assets", "report", "docs", "common", "utils", "build", "release", "version", "page", "home", "project"]
_PART = (_LOWER, 2, 9)
ORDINARY: list[list] = [
    [(_DIGIT, 4, 4), "-", (_DIGIT, 2, 2), "-", (_DIGIT, 2, 2), "T", (_DIGIT, 2, 2)],
    [(_DIGIT, 2, 9), ".", (_DIGIT, 2, 12)],
    [(_DIGIT, 12, 15)],
    ["+", (_DIGIT, 1, 3), "-", (_DIGIT, 3, 4), "-", (_DIGIT, 3, 4), "-", (_DIGIT, 3, 4)],
    [(_DIGIT, 3, 4), "-", (_DIGIT, 3, 4), "-", (_DIGIT, 4, 6)],
    [(_DIGIT, 1, 3), ".", (_DIGIT, 1, 3), ".", (_DIGIT, 1, 3), ".", (_DIGIT, 1, 3)],
    ["/", _WORDS, "/", _WORDS, "/", _WORDS, "/", _WORDS, ".", ["py", "html", "png", "jpg", "txt", "json", "css"]],
    [_PART, "/", _PART, "/", _PART, "/", _PART],
    [_WORDS, "_", _WORDS, "_", _WORDS], [_WORDS, "-", _WORDS, "-", _WORDS, "-", _WORDS], [_WORDS, ".", _WORDS, ".", _WORDS],
    ["www.", (_LOWER, 4, 14), ".", ["com", "org", "net", "de", "fr", "es"]],
    [(_UPPER, 1, 1), _WORDS, (_UPPER, 1, 1), _WORDS, (_UPPER, 1, 1), _WORDS],
    [_WORDS, "-", (_DIGIT, 1, 2), ".", (_DIGIT, 1, 2), ".", (_DIGIT, 1, 2)],
    [(_UPPER, 4, 10), "_", (_UPPER, 4, 10), "_", (_UPPER, 4, 10)],
    [("-", 12, 60)], [("=", 12, 60)], [(".", 12, 60)], [("_", 12, 60)], [("+", 12, 40)],
]


def made(pieces: list, rng: random.Random) -> str:
    out = []
    for p in pieces:
        if isinstance(p, tuple):
            out.append("".join(rng.choices(p[0], k=rng.randint(p[1], p[2]))))
        else:
            out.append(p if isinstance(p, str) else rng.choice(p))
    return "".join(out)


def examples(formats: list[list], n: int, seed: str) -> list[str]:
    rng = random.Random(seed)
    return [made(formats[k % len(formats)], rng) for k in range(n)]


class Automaton:
    """A deterministic probabilistic automaton: for each state how often it was passed, where a value ended there, and how often each
    character led on, and where to."""

    def __init__(self) -> None:
        self.passed: list[int] = [0]
        self.ended: list[int] = [0]
        self.count: list[dict[str, int]] = [{}]
        self.next: list[dict[str, int]] = [{}]

    def add(self, value: str) -> None:
        """Extends the prefix tree."""
        at = 0
        self.passed[0] += 1
        for ch in value:
            to = self.next[at].get(ch)
            if to is None:
                to = len(self.passed)
                self.next[at][ch] = to
                self.passed.append(0)
                self.ended.append(0)
                self.count.append({})
                self.next.append({})
            self.count[at][ch] = self.count[at].get(ch, 0) + 1
            self.passed[to] += 1
            at = to
        self.ended[at] += 1

    def differ(self, a: int, b: int) -> bool:
        """Whether frequencies of two states, or of what follows them, differ by more than Hoeffding's bound."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            na, nb = self.passed[a], self.passed[b]
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if bound >= 1:  # nothing can differ by more; what follows is rarer still
                continue
            if abs(self.ended[a] / na - self.ended[b] / nb) > bound:
                return True
            ca, cb = self.count[a], self.count[b]
            for ch in ca.keys() | cb.keys():
                if abs(ca.get(ch, 0) / na - cb.get(ch, 0) / nb) > bound:
                    return True
                x, y = self.next[a].get(ch), self.next[b].get(ch)
                if x is not None and y is not None and x != y:
                    todo.append((x, y))
        return False

    def likelihood(self, state: int, counts: dict[str, int], ended: int) -> float:
        """Log likelihood of a state's own counts under another one's frequencies."""
        n, own = self.passed[state], self.count[state]
        total = n + 1.0
        rest = 1.0 / (len(ALPHABET) + 1)
        return sum(k * math.log((own.get(ch, 0) + rest) / total) for ch, k in counts.items()) + ended * math.log((self.ended[state] + rest) / total)

    def fold(self, a: int, b: int) -> None:
        """State b, the root of a tree, goes into a, and so does what follows it."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.passed[a] += self.passed[b]
            self.ended[a] += self.ended[b]
            for ch, k in self.count[b].items():
                self.count[a][ch] = self.count[a].get(ch, 0) + k
                to = self.next[b][ch]
                if ch in self.next[a]:
                    todo.append((self.next[a][ch], to))
                else:
                    self.next[a][ch] = to

    def merge(self) -> Automaton:
        """Compatible states become one: of the states next to those kept, the most frequent is merged with the likeliest compatible kept one,
        or kept."""
        kept = [0]
        known = {0}
        while True:
            fringe = {}
            for a in kept:
                for ch, b in self.next[a].items():
                    if b not in known:
                        fringe[b] = (a, ch)
            if not fringe:
                return self.compact(kept)
            b = max(fringe, key=lambda s: (self.passed[s], -s))
            fits = [a for a in kept if not self.differ(a, b)]
            if fits:
                into = max(fits, key=lambda a: (self.likelihood(a, self.count[b], self.ended[b]), -a))
                a, ch = fringe[b]
                self.next[a][ch] = into
                self.fold(into, b)
            else:
                kept.append(b)
                known.add(b)

    def compact(self, kept: list[int]) -> Automaton:
        out, at = Automaton(), {s: k for k, s in enumerate(kept)}
        out.passed, out.ended, out.count = [self.passed[s] for s in kept], [self.ended[s] for s in kept], [self.count[s] for s in kept]
        out.next = [{ch: at[t] for ch, t in self.next[s].items()} for s in kept]
        return out

    def table(self, spread: float) -> tuple[list[dict[str, tuple[int, float]]], list[dict[str, float]], list[float], int]:
        """For scoring: each state's (next state, log probability) by character, the log probabilities of characters that it hasn't led on by, that
        of an end, and where such a character leads, the most frequent state. ``spread`` observations more, dealt by the frequency of
        characters in all states (and one each evenly), smooth."""
        total: dict[str, float] = dict.fromkeys(ALPHABET, 1.0)
        for counts in self.count:
            for ch, k in counts.items():
                total[ch] += k
        ends = sum(self.ended) + 1.0
        whole = sum(total.values()) + ends
        hub = max(range(len(self.passed)), key=lambda s: (self.passed[s], -s))
        moves, other, end = [], [], []
        for s, n in enumerate(self.passed):
            p = {ch: math.log((self.count[s].get(ch, 0) + spread * w / whole) / (n + spread)) for ch, w in total.items()}
            moves.append({ch: (self.next[s][ch], p[ch]) for ch in self.count[s]})
            other.append({ch: v for ch, v in p.items() if ch not in self.count[s]})
            end.append(math.log((self.ended[s] + spread * ends / whole) / (n + spread)))
        return moves, other, end, hub


def learn(values: list[str]) -> Automaton:
    tree = Automaton()
    for v in sorted(values):
        tree.add(v)
    return tree.merge()


def log_likelihood(table: tuple, value: str) -> float:
    """Of a value under a table of ``Automaton.table``."""
    moves, other, end, hub = table
    at, total = 0, 0.0
    for ch in value:
        step = moves[at].get(ch)
        if step is None:
            total += other[at][ch]
            at = hub
        else:
            at = step[0]
            total += step[1]
    return total + end[at]


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind's number, end, start and end of the value), by start, then kind."""
    out = []
    lower = text.lower()
    for k, (kind, pattern, group, least) in enumerate(BASE):
        if kind == "assign" and not any(w in lower for w in _ASSIGN_WORDS):
            continue
        for m in (_LONG_HEX if kind == "hex" else pattern).finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), k, m.end(), m.start(group), m.end(group)))
    return sorted(out)


def candidates(text: str, spans: list[tuple]) -> Iterator[tuple[int, int]]:
    """Runs of credential characters that no base span touches."""
    taken = sorted((s[0], s[2]) for s in spans)
    k, reach = 0, 0
    for m in CANDIDATE.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= m.start():
            yield m.span()


def _digest(value: str) -> int:
    return int.from_bytes(hashlib.md5(value.encode()).digest()[:8], "big") >> 1


def labelled(docs: DataFrame, limit: int = SAMPLE) -> dict[str, list[str]]:
    """Different values by base kind, and ordinary runs (kind ""), those of the smallest digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, dict[str, int]] = {}
        edge: dict[str, float] = {}

        def put(kind: str, value: str) -> None:
            h = _digest(value)
            if h <= edge.get(kind, math.inf):
                mine = found.setdefault(kind, {})
                mine[value] = h
                if len(mine) > 4 * limit:
                    best = sorted(mine.items(), key=lambda x: x[1])[:limit]
                    found[kind], edge[kind] = dict(best), best[-1][1]

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    spans = base_spans(text)
                    for _, k, _, a, b in spans:
                        put(BASE[k][0], text[a:b][:MAX_EXAMPLE])
                    for a, b in candidates(text, spans):
                        put("", text[a:b][:MAX_EXAMPLE])
        rows = [{"kind": k, "value": v, "h": h} for k, mine in found.items() for v, h in sorted(mine.items(), key=lambda x: x[1])[:limit]]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("kind", pa.string()), ("value", pa.string()), ("h", pa.int64())]))

    rows = cut(docs.select("text").mapInArrow(run, "kind string, value string, h bigint"))
    out = {}
    for kind in ["", *(b[0] for b in BASE)]:
        # of equal values one; the smallest are found task by task
        best = rows.filter(c("kind") == kind).groupBy("value").agg(F.min("h").alias("h")).orderBy("h", "value").limit(limit)
        out[kind] = [r["value"] for r in best.collect()]
    return out


#: Words, whole or joined, that don't change case within.
PLAIN = re.compile(r"(?:[/._=+-]*+[A-Z]?+[a-z]++)++[/._=+-]*+|[A-Z/._=+-]++")
#: Observations spread over a state's characters: few where a format is strict, more for ordinary runs, which are many-sided.
STRICT, LOOSE = 1.0, 12.0


def fit(labels: dict[str, list[str]], examples_each: int = EXAMPLES) -> tuple[dict[str, tuple], tuple]:
    """({kind: (table, least length, greatest length)}, table of ordinary runs). labels as of ``labelled``. A kind takes values from
    the least length of its examples to twice the greatest. The table's runs may hold credentials that no base pattern names: they are
    told apart by a first automaton, of plain words and known ordinary runs alone, and only the others make the second."""
    kinds = {k: v for k, v in labels.items() if k and v}
    for name, formats in FORMATS.items():
        kinds[name] = examples(formats, examples_each * len(formats), name)
    made_of = lambda v: (learn(v).table(STRICT), min(map(len, v)), 2 * max(map(len, v)))
    formats = {k: made_of(v) for k, v in kinds.items()}
    known = [v for k, f in enumerate(ORDINARY) for v in examples([f], examples_each // 3, f"ordinary {k}")]
    runs = labels.get("", [])
    first = learn(known + [v for v in runs if PLAIN.fullmatch(v)]).table(LOOSE)
    return formats, learn(known + [v for v in runs if not is_secret(v, (formats, first))]).table(LOOSE)


def is_secret(value: str, models: tuple[dict[str, tuple], tuple]) -> bool:
    kinds, ordinary = models
    fits = [table for table, least, most in kinds.values() if least <= len(value) <= most]
    if not fits:
        return False
    floor = log_likelihood(ordinary, value) + LOG_ODDS
    return any(log_likelihood(table, value) > floor for table in fits)


_FOUND = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def span_text(spans: list[tuple[int, int, int]]) -> str:
    names = [b[0] for b in BASE] + [LEARNT]
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)


def find(text: str, secret) -> tuple[int, int, int, str, str]:
    """The columns of _FOUND for a text; secret: value -> bool."""
    base = base_spans(text)
    counts = [sum(s[1] == k for s in base) for k in range(len(BASE))]
    own = [(s[0], s[1], s[2]) for s in base]
    more = [(a, len(BASE), b) for a, b in candidates(text, base) if secret(text[a:b])]
    return (*counts, hashlib.sha256(span_text(own).encode()).hexdigest(), span_text(sorted(own + more)))


def scan(docs: DataFrame, models: tuple[dict[str, tuple], tuple] | None = None) -> DataFrame:
    """docs(doc_id, text) -> doc_id, _FOUND. Without models they are fitted to the table's labels and the published formats."""
    models = fit(labelled(docs)) if models is None else models
    sent = docs.sparkSession.sparkContext.broadcast(models)  # some thousand transitions a kind

    @F.pandas_udf(f"struct<{_FOUND.replace(' ', ': ').replace(',: ', ', ')}>")
    def look(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[str, bool] = {}

        def secret(value: str) -> bool:
            out = known.get(value)
            if out is None:
                out = is_secret(value, sent.value)
                if len(known) < 100_000 and len(value) < 100:  # what isn't remembered is scored again
                    known[value] = out
            return out

        for part in texts:
            rows = [find(t or "", secret) for t in part]
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in _FOUND.split(", ")]).astype({"n_assign": np.int64, "n_access": np.int64, "n_hex": np.int64})

    found = docs.select("doc_id", F.coalesce(c("text"), F.lit("")).cast("string").alias("text")).select("doc_id", look("text").alias("f"))
    return found.select("doc_id", "f.*")
