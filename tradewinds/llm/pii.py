"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field beside them.

Patterns (`base_spans`) find email, ip, card and phone, leftmost and not overlapping per kind; matches
that fail their check are dropped. They miss what stands together, such as a card number right after a
phone number, and know no secrets (passwords, keys, tokens). The random field scores whole candidate
segments of up to `MAX_TOKENS` tokens by features of the span (shape, digits, check digits, randomness)
and of the word before it, and dynamic programming chooses boundaries and types of all segments of a
stretch jointly. Stretches are runs of tokens with a digit, `@` or `=`, and a token on either side;
elsewhere there are no candidates, so whole texts are covered. A segment is added where it overlaps no
span of the patterns and its posterior probability reaches `LEAST_POSTERIOR`.

The field is fitted to the patterns' own spans, and to key = value secrets, by the gradient of the
likelihood (forward-backward), on a bounded sample: up to `SAMPLE_DOCS` documents that have a
candidate, those whose ids hash lowest, and up to `SAMPLE_STRETCHES` stretches of them. Stretches in
which a pattern swallowed more than it may hold teach nothing and are left out.

Offsets are code points, ends exclusive. Defined cases: null text is empty and has no spans; a table
without any candidate gives the base spans alone; rows that repeat get a row each; very long texts are
read whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.llm.frames import documents, map_documents, prepared, sampled

KINDS = ("email", "ip", "card", "phone", "secret")
MAX_TOKENS = 6
SAMPLE_DOCS = 3_000
SAMPLE_STRETCHES = 1_200
LEAST_POSTERIOR = 0.8
EPOCHS = 4

Span = tuple[int, int, str]

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")
_SECRET = re.compile(
    r"\b(?:AKIA[0-9A-Z]{16}\b|(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?(?P<value>[A-Za-z0-9_+/-]{12,}))"
)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = max(free, start)
        at = text.find("@", max(free, at + 1))


def base_matches(text: str) -> Iterator[tuple[int, int, str, bool]]:
    """Matches of the patterns: start, end, kind, and whether the match passes its check."""
    for start, end in _emails(text):
        yield start, end, "email", True
    if not _DIGIT.search(text):
        return
    for chain in _DOTTED.finditer(text):
        parts = [(m.start(), m.end()) for m in _PART.finditer(text, chain.start(), chain.end())]
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            ok = all(e - s <= 3 or not text[s:e - 3].strip("0") for s, e in four) and all(int(text[max(s, e - 3):e]) <= 255 for s, e in four)
            yield four[0][0], four[3][1], "ip", ok
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m[0])
        yield m.start(), m.end(), "card", 14 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield m.start(), m.end(), "phone", 10 <= len(_NO_DIGIT.sub("", m[0])) <= 15


def _order(span: Span) -> tuple:
    return span[0], KINDS.index(span[2]), span[1]


def base_spans(text: str) -> list[Span]:
    return sorted(((s, e, kind) for s, e, kind, ok in base_matches(text) if ok), key=_order)


# Stretches and their candidate segments.

_TOKEN = re.compile(r"\S+")
_CANDIDATE = re.compile(r"\S*[0-9@=]\S*")
_OUTER = "\"'`,;:!?.<>[]{}|"
# Words before a value that tell its kind.
_CUES = frozenset("password passwd pwd secret token key apikey api_key phone tel mobile mail email ip host card visa".split())
_CLASS = {c: k for k, chars in {
    "9": "0123456789", "a": "abcdefghijklmnopqrstuvwxyz", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
}.items() for c in chars}


def stretches(text: str) -> list[list[tuple[int, int]]]:
    """Runs of tokens with a digit, `@` or `=`, with the token before and after, as (start, end)."""
    found = [(m.start(), m.end()) for m in _CANDIDATE.finditer(text)] if re.search("[0-9@=]", text) else []
    out: list[list[tuple[int, int]]] = []
    for start, end in found:
        if out and not text[out[-1][-1][1]:start].strip():
            out[-1].append((start, end))
        else:
            out.append([(start, end)])
    for tokens in out:
        first, last = tokens[0][0], tokens[-1][1]
        head = re.search(r"\S+\s+$", text[max(0, first - 60):first])
        if head:
            begin = max(0, first - 60) + head.start()
            tokens.insert(0, (begin, begin + len(head[0].rstrip())))
        tail = re.match(r"\s+(\S{1,60})", text[last:last + 80])
        if tail:
            tokens.append((last + tail.start(1), last + tail.end(1)))
    return out


def _bounds(text: str, tokens: list[tuple[int, int]], i: int, j: int) -> tuple[int, int]:
    """Where the segment of tokens i to j (exclusive) begins and ends without its outer marks; the value of key=value."""
    start, end = tokens[i][0], tokens[j - 1][1]
    if j - i == 1:
        key = text.find("=", start, end - 1)
        if 0 < key - start <= 20 and text[start:key].replace("_", "").replace("-", "").isalpha():
            start = key + 1
    while start < end and text[start] in _OUTER:
        start += 1
    while end > start and text[end - 1] in _OUTER:
        end -= 1
    return start, end


def _features(text: str, tokens: list[tuple[int, int]], i: int, j: int, start: int, end: int) -> list[str]:
    span = text[start:end]
    shape, runs, last = [], 0, ""
    for c in span[:200]:
        c = _CLASS.get(c, "u" if c.isalpha() else c)
        if c != last:
            shape.append(c)
            runs += 1
            last = c
    digits = _NO_DIGIT.sub("", span)
    counts = np.unique(np.frombuffer(span.encode("utf-32-le"), np.uint32), return_counts=True)[1]
    entropy = float(-(counts / counts.sum() * np.log2(counts / counts.sum())).sum())
    out = [
        "any", f"tokens:{j - i}", f"digits:{min(len(digits), 24)}", f"length:{int(math.log2(len(span)) * 2)}",
        f"runs:{min(runs, 12)}", f"entropy:{int(entropy * 2)}",
        # A span of one class of characters has a telling shape; a random one has not.
        "shape:" + ("".join(shape) if runs <= 12 else "mixed"), f"classes:{''.join(sorted(set(shape)))[:12]}",
    ]
    whole = span.isascii() and span.isalnum()
    if whole and digits and len(digits) < len(span):
        case = "upper" if span.isupper() else "lower" if span.islower() else "both"
        kind = "hex" if not set(span.lower()) - set("0123456789abcdef") else "word"
        out += [f"random:{kind}", f"random:{kind}:{case}:{min(len(span) // 4, 12)}"]
    if 14 <= len(digits) <= 19:
        out.append(f"luhn:{luhn(digits)}:{bool(_CARD.fullmatch(span))}")
    if span[0] == "+":
        out.append(f"plus:{10 <= len(digits) <= 15}:{bool(_PHONE.fullmatch(span))}")
    if span.count(".") == 3 and _DOTTED.fullmatch(span):
        out.append(f"four:{all(int(p[-4:]) <= 255 for p in span.split('.'))}")
    if "@" in span:
        local, _, domain = span.partition("@")
        out.append(f"at:{bool(local)}:{bool(_DOMAIN.fullmatch(domain))}")
    before = text[max(0, start - 24):start].lower()
    words = re.findall(r"[a-z_]+", before)
    if words and words[-1] in _CUES:
        out.append(f"cue:{words[-1]}")
    if re.search(r"[=:]\s*[\"']?$", before):
        out.append("assigned")
    return out


@dataclass
class Field:
    """Weights by feature and kind (column 0: outside), and by kind of one segment and the next."""

    numbers: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, len(KINDS) + 1)))
    follow: np.ndarray = field(default_factory=lambda: np.zeros((len(KINDS) + 1, len(KINDS) + 1)))

    def segments(self, text: str, tokens: list[tuple[int, int]], learn: bool = False) -> dict[tuple[int, int], tuple]:
        """Feature numbers and bounds of every candidate segment (i, j) of the stretch."""
        out = {}
        for i in range(len(tokens)):
            for j in range(i + 1, min(len(tokens), i + MAX_TOKENS) + 1):
                start, end = _bounds(text, tokens, i, j)
                if end <= start or not re.search("[0-9@]", text[start:end]):
                    continue
                names = _features(text, tokens, i, j, start, end)
                if learn:
                    numbers = [self.numbers.setdefault(n, len(self.numbers)) for n in names]
                else:
                    numbers = [self.numbers[n] for n in names if n in self.numbers]
                out[i, j] = (numbers, start, end)
        return out

    def scores(self, segments: dict, n: int) -> list[list[tuple[int, np.ndarray]]]:
        """For every end j the possible starts i with a score for each kind; outside has length one and score 0."""
        ends: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(n + 1)]
        for j in range(1, n + 1):
            for i in range(max(0, j - MAX_TOKENS), j):
                row = np.full(len(KINDS) + 1, -np.inf)
                if (i, j) in segments:
                    row = self.weights[segments[i, j][0]].sum(0)
                    row[0] = -np.inf
                if j - i == 1:
                    row[0] = 0.0
                if row.max() > -np.inf:
                    ends[j].append((i, row))
        return ends

    def best(self, ends: list, n: int) -> list[tuple[int, int, int]]:
        """The segments (i, j, kind number) of the best cut of the stretch."""
        value = np.full((n + 1, len(KINDS) + 1), -np.inf)
        value[0, 0] = 0
        back: list[list] = [[None] * (len(KINDS) + 1) for _ in range(n + 1)]
        for j in range(1, n + 1):
            for i, row in ends[j]:
                into = value[i][:, None] + self.follow
                total = into.max(0) + row
                source = into.argmax(0)
                for y in np.flatnonzero(total > value[j]):
                    value[j, y] = total[y]
                    back[j][y] = (i, int(source[y]))
        out, j, y = [], n, int(value[n].argmax())
        while j > 0:
            i, before = back[j][y]
            if y:
                out.append((i, j, y))
            j, y = i, before
        return out[::-1]

    def lattice(self, ends: list, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Log sums: into each place by kind to come, of each place, onwards from each place; and of everything."""
        none = np.full(len(KINDS) + 1, -np.inf)
        at, into = np.tile(none, (n + 1, 1)), np.tile(none, (n + 1, 1))
        at[0, 0] = 0
        into[0] = self.follow[0]
        for j in range(1, n + 1):
            if ends[j]:
                at[j] = np.logaddexp.reduce([into[i] + row for i, row in ends[j]])
            into[j] = np.logaddexp.reduce(at[j][:, None] + self.follow, 0)
        onward, leave = np.tile(none, (n + 1, 1)), np.tile(none, (n + 1, 1))
        onward[n] = 0
        for i in range(n, 0, -1):
            for start, row in ends[i]:
                leave[start] = np.logaddexp(leave[start], row + onward[i])
            if i - 1 > 0:
                onward[i - 1] = np.logaddexp.reduce(self.follow + leave[i - 1][None], 1)
        return into, at, onward, float(np.logaddexp.reduce(at[n]))

    def found(self, text: str) -> Iterator[tuple[int, int, str, float]]:
        """Segments of the best cuts with their posterior probabilities."""
        if not self.numbers:
            return
        for tokens in stretches(text):
            segments, n = self.segments(text, tokens), len(tokens)
            ends = self.scores(segments, n)
            chosen = self.best(ends, n)
            if not chosen:
                continue
            into, _, onward, total = self.lattice(ends, n)
            for i, j, y in chosen:
                row = next(r for s, r in ends[j] if s == i)
                _, start, end = segments[i, j]
                yield start, end, KINDS[y - 1], float(np.exp(min(0.0, into[i][y] + row[y] + onward[j][y] - total)))


def _silver(text: str) -> tuple[dict[tuple[int, int], str], list[tuple[int, int]]]:
    """Spans to learn from, and stretches of text that teach nothing."""
    good, bad = {}, []
    for start, end, kind, ok in base_matches(text):
        if ok:
            good[start, end] = kind
        else:
            digits = len(_NO_DIGIT.sub("", text[start:end]))
            if kind == "phone" or kind == "card" and digits > 19:
                bad.append((start, end))
    for m in _SECRET.finditer(text):
        good[m.span("value") if m["value"] else m.span()] = "secret"
    return good, bad


def fit_field(texts: list[str]) -> Field:
    """A field fitted to the patterns' spans in the texts."""
    model, cases = Field(), []
    for text in texts:
        good, bad = _silver(text)
        for tokens in stretches(text):
            if len(cases) >= SAMPLE_STRETCHES or len(tokens) > 40:
                break
            first, last = tokens[0][0], tokens[-1][1]
            if any(s < last and e > first for s, e in bad):
                continue
            here = {span: kind for span, kind in good.items() if span[0] >= first and span[1] <= last}
            segments = model.segments(text, tokens, learn=True)
            named = {ij: KINDS.index(here[s, e]) + 1 for ij, (_, s, e) in segments.items() if (s, e) in here}
            cut, at = [], 0
            while at < len(tokens):
                step = next(((i, j, y) for (i, j), y in named.items() if i == at), (at, at + 1, 0))
                cut.append(step)
                at = step[1]
            if sum(y > 0 for *_, y in cut) == len(here):
                cases.append((segments, len(tokens), cut))
    size = len(model.numbers)
    model.weights = np.zeros((size, len(KINDS) + 1))
    squares, follow_squares = np.full(model.weights.shape, 0.01), np.full(model.follow.shape, 0.01)
    random = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for c in random.permutation(len(cases)):
            segments, n, cut = cases[c]
            ends = model.scores(segments, n)
            into, at, onward, total = model.lattice(ends, n)
            slope, follow = {}, np.zeros_like(model.follow)
            for j in range(1, n + 1):
                for i, row in ends[j]:
                    if (i, j) in segments:
                        p = np.exp(np.minimum(0, into[i] + row + onward[j] - total))
                        p[0] = 0
                        slope[i, j] = -p
                    # The share of each kind before this segment, for what follows what.
                    follow -= np.exp(np.minimum(0, at[i][:, None] + model.follow + row[None] + onward[j][None] - total))
            before = 0
            for i, j, y in cut:
                if y:
                    slope[i, j][y] += 1
                follow[before, y] += 1
                before = y
            for ij, g in slope.items():
                rows = segments[ij][0]
                if np.abs(g).max() > 1e-4:
                    g = g[None] - 0.002 * model.weights[rows]
                    squares[rows] += g**2
                    model.weights[rows] += 0.3 * g / np.sqrt(squares[rows])
            follow_squares += follow**2
            model.follow += 0.3 * follow / np.sqrt(follow_squares)
    return model


def fit(docs: DataFrame) -> Field:
    """A field fitted on a bounded sample of the documents that have a candidate."""
    # Of a sampled row the driver gets a bounded part.
    candidates = documents(docs).where(F.col("text").rlike("[0-9@]"))
    rows = (
        sampled(candidates.withColumn("text", F.substring("text", 1, 20_000)), SAMPLE_DOCS, counted=candidates)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text").collect()
    )
    return fit_field([r.text for r in rows])


def spans(text: str, model: Field) -> tuple[list[Span], list[Span]]:
    """The spans of the patterns, and those with the field's own added."""
    base = base_spans(text)
    added: list[Span] = []
    for start, end, kind, p in model.found(text):
        if p >= LEAST_POSTERIOR and not any(s < end and e > start for s, e, _ in base):
            added.append((start, end, kind))
    return base, sorted(base + added, key=_order)


def joined(found: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def find(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, spans (array of start, end, kind, added, text) for every row of `docs`."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                base, every = spans(text, model)
                rows.append([(s, e, kind, (s, e, kind) not in base, text[s:e]) for s, e, kind in every])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "spans": rows})

    return map_documents(
        documents(docs), found, "doc_id bigint, spans array<struct<start: int, end: int, kind: string, added: boolean, text: string>>"
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts of the patterns' spans, their digest, and all spans as text."""
    base = F.filter("spans", lambda s: ~s["added"])

    def line(of):
        return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS[:4]), F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans")
    )


def redacted(text: str, found: list[Span]) -> str:
    """The text with every span replaced by its kind; spans that overlap are replaced as one, by the first's kind."""
    out, at = [], 0
    for start, end, kind in found:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Field) -> DataFrame:
    """`docs` with the spans replaced in `text`, and `n_chars`, where there is one, counted anew; null text stays null."""
    prepared(docs.sparkSession)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            text = [None if t is None else redacted(t, spans(t, model)[1]) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(text, batch.schema.field(at).type))

    out = docs.mapInArrow(clean, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
