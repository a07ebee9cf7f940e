"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field labels the words of segments, runs of words with a digit, an
at-sign (spelled out in brackets too) or a named secret that follow each other after one space; other words
are "outside" by constraint, so segments are independent and Viterbi runs over batches of them in numpy.
It sees shapes, the words before, and the name a value is assigned to. It is trained on a small labelled
table of its own (``pii_table``): numbers without country code, addresses spelled out, secrets, and what only
looks like them. Its spans are added where they touch no base span; secrets are a kind of their own.

Nulls: a null text is an empty one, without spans. Positions are code points, ends exclusive. Ties between
labels go to the first.
"""

from __future__ import annotations

import functools
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm import common as C
from waybill.llm import pii_table

KINDS = ("email", "ip", "card", "phone")     # of the patterns
ALL_KINDS = (*KINDS, "secret")


@dataclass(frozen=True)
class PiiConfig:
    copies: int = 12        # times each line of the table is drawn anew
    bits: int = 13          # hashed features
    steps: int = 100        # of the fit
    rate: float = 0.2
    ridge: float = 1e-3


# ---- base spans -------------------------------------------------------------------------------

# The four patterns
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str):
    """At each at-sign: the longest local part after the last match, and the domain."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m.group())) <= 15:
            out.append((3, *m.span()))
    return out


# ---- segments and features --------------------------------------------------------------------

MARK = re.compile(r"[0-9@]|[\[(]at[\])]|(?:[Pp]ass(?:word|wd|wort)|[Ss]ecret|[Tt]oken|[Kk]ey)[=:](?=\S)")
GAP, NAMED = re.compile(r"\s"), re.compile(r"^[\"'(]*([A-Za-z_-]+)[=:]+")
OUTSIDE = 0
LABELS = 1 + 2 * len(ALL_KINDS)  # outside, then first and further word of each kind
BOUND = ".,;:!?\"'()[]<>"
HEXADECIMAL = re.compile(r"[0-9a-f]{10,}\Z|[0-9A-F]{10,}\Z")
MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])[0-9A-Za-z+/_-]{8,}\Z")


def segments(text: str) -> list[list[tuple[int, int]]]:
    """Runs of words (start, end) with a digit or an at-sign, one space apart."""
    out, end = [], -2
    m = MARK.search(text)
    while m:
        a = m.start()
        while a > max(end, 0) and not text[a - 1].isspace():
            a -= 1
        gap = GAP.search(text, m.end())
        b = gap.start() if gap else len(text)
        if out and a == end + 1 and text[end] == " ":
            out[-1].append((a, b))
        else:
            out.append([(a, b)])
        end = b
        m = MARK.search(text, b)
    return out


def words_before(text: str, at: int) -> list[str]:
    """The two words before a place, nearest first, lower-cased and cut to twelve letters."""
    return [w.lower().strip(BOUND)[:12] for w in reversed(text[max(0, at - 40):at].split()[-2:])]


def shape(word: str) -> str:
    return re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]", "9", word)))


def _sound(word: str, digits: int) -> str:
    """Whether a word that looks like a card number or an address adds up."""
    if 13 <= digits <= 19:
        return f"luhn{luhn(re.sub('[^0-9]', '', word))}"
    parts = word.strip(BOUND).split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        return f"parts{all(len(p) <= 3 and int(p) <= 255 for p in parts)}"
    return ""


def _mixed(word: str) -> str:
    """How long a value is, and whether it is hexadecimal or mixes letters and digits."""
    value = NAMED.sub("", word).strip(BOUND)
    kind = "d" if value.isdigit() else "h" if HEXADECIMAL.match(value) else "m" if MIXED.match(value) else "o"
    return f"{kind}{min(len(value) // 4, 10)}"


@functools.lru_cache(1 << 16)
def _hashed(name: str, bits: int) -> int:
    return zlib.crc32(name.encode()) & ((1 << bits) - 1)


def _features(words: list[str], bits: int, before: list[str]) -> list[list[int]]:
    """Hashed features of each word: its shape, short and long, its digits, its neighbours' shapes, the words
    before it and the name before an equals sign or colon. ``before`` are the words before the segment."""
    shapes = [shape(w.strip(BOUND[:6])) for w in words]
    short = [re.sub(r"9+", "9", s) for s in shapes]
    out, left = [], [*reversed(before)]
    for i, w in enumerate(words):
        digits = sum(map(str.isdigit, w))
        named = NAMED.match(w)
        names = ("s" + shapes[i][:40], "c" + short[i][:40], f"d{min(digits, 20)}", f"p{w[:1] if not w[:1].isalnum() else ''}",
                 f"n{w.count('.')}{w.count('-')}{w.count('@')}", "v" + _sound(w, digits),
                 "l" + (short[i - 1][:20] if i else "^"), "r" + (short[i + 1][:20] if i + 1 < len(words) else "$"),
                 "b" + (left[-1] if left else "^"), "a" + (left[-2] if len(left) > 1 else "^"), "m" + _mixed(w),
                 "k" + (named.group(1).lower()[:16] if named else "-"))
        out.append([_hashed(x, bits) for x in names])
        left.append("9" if digits else w.lower().strip(BOUND)[:12])
    return out


def _labels(words: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    out, last = [], None
    for a, b in words:
        own = next(((i, k) for i, (k, s, e) in enumerate(spans) if s < b and e > a), None)
        out.append(OUTSIDE if own is None else 1 + 2 * own[1] + (own[0] == last))
        last = own[0] if own else None
    return out


# ---- the field ---------------------------------------------------------------------------------

@dataclass
class Field:
    weights: np.ndarray      # features x labels
    moves: np.ndarray        # label before x label
    begin: np.ndarray

    def decode(self, batch: list[list[list[int]]]) -> list[np.ndarray]:
        """Best label sequences of segments given as features of words; equal lengths go together."""
        out: list = [None] * len(batch)
        by: dict = {}
        for i, s in enumerate(batch):
            by.setdefault(len(s), []).append(i)
        for length, members in by.items():
            score = self.weights[np.array([batch[i] for i in members])].sum(2)
            best, back = score[:, 0] + self.begin, []
            for t in range(1, length):
                step = best[:, :, None] + self.moves
                back.append(step.argmax(1))
                best = step.max(1) + score[:, t]
            path = [best.argmax(1)]
            for b in reversed(back):
                path.append(b[np.arange(len(members)), path[-1]])
            for i, p in zip(members, np.stack(path[::-1], 1)):
                out[i] = p
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def fit(table: list[tuple[list, list]], config: PiiConfig) -> Field | None:
    """Maximum likelihood (with a ridge) by adaptive gradient steps; forward and backward in numpy."""
    if not table:
        return None
    size, n = 1 << config.bits, len(table)
    by: dict = {}
    for f, y in table:
        by.setdefault(len(y), []).append((f, y))
    groups = [(np.array([f for f, _ in g]), np.array([y for _, y in g])) for _, g in sorted(by.items())]
    par = [np.zeros((size, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS)]
    square = [np.zeros_like(p) for p in par]
    for _ in range(config.steps):
        grad = [config.ridge * n * p / 10 for p in par]
        for f, y in groups:
            score = par[0][f].sum(2)
            rows, length = y.shape
            fwd, bwd = [score[:, 0] + par[2]], [np.zeros((rows, LABELS))]
            for t in range(1, length):
                fwd.append(_logsum(fwd[-1][:, :, None] + par[1], 1) + score[:, t])
            for t in range(length - 1, 0, -1):
                bwd.append(_logsum(par[1] + (score[:, t] + bwd[-1])[:, None, :], 2))
            bwd = bwd[::-1]
            total = _logsum(fwd[-1], 1)[:, None]
            for t in range(length):
                p = np.exp(fwd[t] + bwd[t] - total)
                p[np.arange(rows), y[:, t]] -= 1
                np.add.at(grad[0], f[:, t].ravel(), np.repeat(p, f.shape[2], 0))
                if t == 0:
                    grad[2] += p.sum(0)
                else:
                    joint = np.exp(fwd[t - 1][:, :, None] + par[1] + (score[:, t] + bwd[t])[:, None, :] - total[:, :, None])
                    grad[1] += joint.sum(0)
                    np.add.at(grad[1], (y[:, t - 1], y[:, t]), -1)
        for p, g, s in zip(par, grad, square):
            s += g * g
            p -= config.rate * g / (np.sqrt(s) + 1e-8)
    return Field(*par)


def learn(config: PiiConfig = PiiConfig()) -> Field | None:
    """The field from the labelled table: a few hundred short segments, whatever the corpus."""
    table = []
    for text, spans in pii_table.rows(False, config.copies):
        spans = [(ALL_KINDS.index(k), a, b) for k, a, b in spans]
        for words in segments(text):
            near = words_before(text, words[0][0])
            table.append((_features([text[a:b] for a, b in words], config.bits, near), _labels(words, spans)))
    return fit(table, config)


def _added(text: str, base: list, field: Field, labels, words) -> list[tuple[int, int, int]]:
    out, open_ = [], None
    for (a, b), y in [*zip(words, labels), ((0, 0), OUTSIDE)]:
        if open_ and (y == OUTSIDE or y % 2 == 1 or (y - 1) // 2 != open_[0]):
            k, s, e = open_
            named = NAMED.match(text[s:e])
            if ALL_KINDS[k] == "secret" and named:
                s += named.end()                        # the value, not its name
            while s < e and text[s] in BOUND.replace("(", ""):
                s += 1
            while e > s and text[e - 1] in BOUND:
                e -= 1
            if s < e and all(x[2] <= s or x[1] >= e for x in base):
                out.append((k, s, e))
            open_ = None
        if y != OUTSIDE:
            open_ = ((y - 1) // 2, open_[1] if open_ else a, b)
    return out


def spans_of(texts: list[str], field: Field | None, config: PiiConfig = PiiConfig()):
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    every = [list(b) for b in base]
    if field is not None:
        where, batch = [], []
        for i, t in enumerate(texts):
            for words in segments(t):
                where.append((i, words))
                batch.append(_features([t[a:b] for a, b in words], config.bits, words_before(t, words[0][0])))
        for (i, words), labels in zip(where, field.decode(batch)):
            if (labels != OUTSIDE).any():
                near = [s for s in base[i] if s[1] < words[-1][1] and s[2] > words[0][0]]
                every[i] += _added(texts[i], near, field, labels.tolist(), words)
    return base, [sorted(e) for e in every]


def joined(spans) -> str:
    return ",".join(f"{ALL_KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, field: Field | None, config: PiiConfig = PiiConfig()) -> DataFrame:
    """doc_id, base_spans, spans: arrays of (kind, start, end), by kind and start."""
    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in (part for whole in batches for part in C.slices(whole, 1)):
            texts = C.as_text(batch.column(1)).to_pylist()
            pair = spans_of(texts, field, config)
            cols = [pa.array([[{"kind": ALL_KINDS[k], "start": a, "end": b} for k, a, b in s] for s in x], kind) for x in pair]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "base_spans", "spans"])

    C.ship(docs.sparkSession)
    s = "array<struct<kind:string,start:bigint,end:bigint>>"
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, f"doc_id long, base_spans {s}, spans {s}"))


def merged(spans) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the unions of overlapping spans, by start; a union has the kind of its longest
    span, the first one of equals. Spans that only touch stay apart."""
    out: list = []
    for k, a, b in sorted(spans, key=lambda s: (s[1], s[0], s[2])):
        if out and a < out[-1][2]:
            kind, start, end, longest = out[-1]
            if b - a > longest:
                kind, longest = k, b - a
            out[-1] = (kind, start, max(end, b), longest)
        else:
            out.append((k, a, b, b - a))
    return [s[:3] for s in out]


def mask(docs: DataFrame, field: Field | None, config: PiiConfig = PiiConfig()) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in angle brackets; overlapping spans are
    replaced as one, so that nothing of any of them stays. All other columns stay, whatever their names."""
    i = docs.columns.index("text")

    def run(batches):
        C.held("pii", dict)
        for batch in (part for whole in batches for part in C.slices(whole, i)):
            texts = batch.column(i).to_pylist()
            out = list(texts)
            for j, spans in enumerate(spans_of([t or "" for t in texts], field, config)[1]):
                if spans:
                    rest, at = [], 0
                    for k, a, b in merged(spans):
                        rest += [texts[j][at:a], f"<{ALL_KINDS[k]}>"]
                        at = b
                    out[j] = "".join(rest) + texts[j][at:]
            yield batch.set_column(i, "text", pa.array(out, pa.string()))

    C.ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def op2_pii(spark, sf_dir):
    docs = C.scan(spark, sf_dir, "documents")
    found = find(docs, learn())
    text = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    return found.select(
        "doc_id", *(F.expr(f"cast(size(filter(base_spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS),
        F.sha2(text("base_spans"), 256).alias("base_sha256"), text("spans").alias("spans"))


def pii_stage(spark, docs, sf_dir):
    """Pipeline stage: personal data in the texts is masked; ``n_chars`` follows, other columns stay. Null and
    empty texts hold nothing and stay as they are."""
    C.record_batches(docs.sparkSession, 1000)
    out = mask(docs, learn())
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars")).cast(kind)
        out = out.withColumn("n_chars", changed)
    return out
