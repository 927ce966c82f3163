"""Personal data, decontamination, chat formatting and exact search against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import ODD, docs, rows  # noqa: F401
from pyspark.sql import functions as F

from tradewinds.llm import chat, decontaminate, pii, topk

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else None,
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1290.@+-() %é\n", max_size=60))
def test_patterns(text):
    assert pii.base_spans(text) == base(text)


@pytest.mark.parametrize("text", ["a" * 50_000 + "@", "1" * 50_000, "1." * 20_000, "a@" * 20_000, "+1 " * 10_000])
def test_patterns_take_long_runs(text):
    pii.base_spans(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


@pytest.fixture(scope="module")
def field():
    pick = random.Random(1)
    texts = []
    for _ in range(500):
        card = "".join(pick.choice("0123456789") for _ in range(15))
        card += next(d for d in "0123456789" if pii.luhn(card + d))
        key = "".join(pick.choice("0123456789abcdef") for _ in range(pick.choice([18, 40])))
        part = pick.choice([
            f"mail {pick.choice('abc')}x.{pick.randrange(99)}@mail{pick.randrange(9)}.example.com", f"{pick.randrange(256)}.7.{pick.randrange(256)}.1",
            card, f"+1 ({pick.randrange(200, 999)}) 555-{pick.randrange(1000, 9999)}", f"password={key}", f'token = "{key}"',
            f"in {pick.randrange(1900, 2100)}", f"{pick.randrange(1, 30)}. part", "4111111111111112",
        ])
        texts.append(f"some words here {part} and others follow")
    return pii.fit_field(texts)


def test_field_adds_what_patterns_miss(field):
    joined = "call +1 (438) 555-5817 4111111111111111 now"
    plain, every = pii.spans(joined, field)
    assert plain == base(joined) == []
    assert pii.joined(every) == "phone:5:22,card:23:39"
    text = "his password=3fa9c0b17e55d2aa41 was in 1999"
    assert pii.joined(pii.spans(text, field)[1]) == "secret:13:31"
    assert pii.redacted(text, pii.spans(text, field)[1]) == "his password=[SECRET] was in 1999"
    for clean in ("part 12 of 2020, page 3", "he said 50% = half", "a = b + c", *(t or "" for t in ODD)):
        assert pii.spans(clean, field)[1] == base(clean)


def test_best_cut_is_the_best_of_all(field):
    text = "x password=3fa9c0b17e55d2aa41 7.7.7.7 +1 (438) 555-5817 y"
    tokens = pii.stretches(text)[0]
    segments, n = field.segments(text, tokens), len(tokens)
    ends = field.scores(segments, n)

    def cuts(j):
        if j == 0:
            yield 0.0, 0, []
            return
        for i, row in ends[j]:
            for total, before, cut in cuts(i):
                for y in np.flatnonzero(row > -np.inf):
                    yield total + row[y] + field.follow[before, y], y, cut + ([(i, j, int(y))] if y else [])

    every = list(cuts(n))
    assert field.best(ends, n) == max(every, key=lambda c: c[0])[2]
    assert field.lattice(ends, n)[3] == pytest.approx(np.logaddexp.reduce([c[0] for c in every]))


def test_find_and_redact(spark, docs, field):
    found = docs([*enumerate(ODD), (None, "mail a.b@c.de"), (2**60 + 1, None)])
    got = {r.doc_id: r for r in pii.digest(pii.find(found, field)).collect()}
    for k, text in enumerate(ODD):
        spans = ",".join(f"{kind}:{s}:{e}" for s, e, kind in base(text or ""))
        assert got[k].base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
    assert got[None].n_email == 1 and got[2**60 + 1].spans == ""
    clean = {r.doc_id: r for r in pii.redact(found, field).collect()}
    assert clean[None].text == "mail [EMAIL]" and clean[2**60 + 1].text is None and clean[0].text is None
    assert pii.redact(found, field).columns == found.columns
    assert pii.find(docs([]), pii.fit(docs([]))).collect() == []


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def matched(doc, item):
    """Pairs of texts with a hit of a mask, or of a whole short item, on a diagonal that has a stretch."""
    d, b = words_of(doc), words_of(item)
    if len(b) < decontaminate.SHORTEST_ITEM:
        return False
    short = len(b) < decontaminate.SPAN
    for diagonal in range(-len(b), len(d)):
        at = [k for k in range(max(0, diagonal), min(len(d), diagonal + len(b)))]
        same = [d[k] == b[k - diagonal] for k in at]
        if short:
            if len(at) == len(b) and all(same):
                return True
            continue
        hit = any(
            all(same[k + m] for m, c in enumerate(mask) if c == "1")
            for mask in decontaminate.MASKS for k in range(len(same) - decontaminate.SPAN + 1)
        )
        size = min(decontaminate.WINDOW, len(b))
        full = any(sum(same[k:k + size]) >= decontaminate.EQUAL * size for k in range(len(same) - size + 1))
        if hit and full:
            return True
    return False


def test_decontamination_against_brute_force(spark, docs):
    pick = random.Random(6)
    words = [f"w{k}" for k in range(60)]
    items = [" ".join(pick.choice(words) for _ in range(n)) for n in (3, 5, 9, 12, 13, 20, 40, 60)]
    found = []
    for k in range(60):
        passage = pick.choice(items).split()
        for _ in range(pick.randrange(4)):
            passage[pick.randrange(len(passage))] = "other"
        first = pick.randrange(len(passage) // 2 + 1)
        around = [pick.choice(words) for _ in range(pick.choice([0, 5, 200]))]
        found.append((k, " ".join(around + (passage[first:] if k % 3 else []) + around).upper()))
    benchmark = spark.createDataFrame([*enumerate(items), (3, items[3]), (None, items[6]), (99, None)], "item_id bigint, text string")
    want = sorted((d, i) for d, text in found for i, item in enumerate(items) if matched(text, item))
    got = decontaminate.contaminated(docs(found), benchmark)
    assert sorted((r.doc_id, i) for r in got.collect() for i in r.item_ids) == want
    assert 5 < len({d for d, _ in want}) < 50
    clean = decontaminate.clean(docs(found), benchmark)
    assert rows(clean, "doc_id") == sorted([(d,) for d, _ in found if d not in {w for w, _ in want}], key=repr)
    assert clean.columns == docs([]).columns


def accepted(n):
    """Sets of substituted words of an isolated item of n words (at most four) that the rule accepts."""
    size = min(decontaminate.WINDOW, n)
    for count in range(5):
        for gone in itertools.combinations(range(n), count):
            same = [k not in gone for k in range(n)]
            if any(sum(same[k:k + size]) >= decontaminate.EQUAL * size for k in range(n - size + 1)):
                yield gone


@pytest.mark.parametrize("n", [12, 13, 15, 17])
def test_every_accepted_overlap_shares_a_seed(n):
    item = np.arange(1, n + 1, dtype=np.uint64)
    seeds = list(decontaminate._window_hashes(item))
    for gone in accepted(n):
        doc = item.copy()
        doc[list(gone)] = 1_000
        assert any((a == b).any() for a, b in zip(seeds, decontaminate._window_hashes(doc))), gone


def test_substitutions_anywhere(spark, docs):
    items = [[f"{name}{k}" for k in range(n)] for name, n in (("a", 12), ("b", 13), ("c", 15))]
    found, want = [], []
    for i, item in enumerate(items):
        for gone in accepted(len(item)):
            want.append((len(found), [i]))
            found.append((len(found), " ".join("other" if k in gone else w for k, w in enumerate(item))))
        for gone in ((0, 5, 9), (0, 3, 6, 9, 11)):
            if gone not in set(accepted(len(item))):
                found.append((len(found), " ".join("other" if k in gone else w for k, w in enumerate(item))))
    benchmark = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id bigint, text string")
    assert rows(decontaminate.contaminated(docs(found), benchmark), "doc_id", "item_ids") == sorted(want, key=repr)
    assert len(found) > len(want)


def test_decontamination_odd(spark, docs):
    text = " ".join(f"a{k}" for k in range(20))
    benchmark = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    found = docs([*enumerate(ODD), (None, text), (70, text), (70, text), (2**60 + 1, "x " + text)])
    assert rows(decontaminate.contaminated(found, benchmark), "doc_id", "n_items") == sorted([(None, 1), (70, 1), (2**60 + 1, 1)], key=repr)
    assert decontaminate.clean(found, benchmark).count() == len(ODD) + 1
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contaminated(found, none).collect() == []
    assert decontaminate.contaminated(docs([]), benchmark).collect() == []


CONVERSATIONS = [
    (1, 0, "user", "a#####b\\h"), (1, 1, "user", "</turn></turn"), (1, 2, "assistant", "<next/<next/>\\\\"),
    (1, 3, "assistant", ""), (1, 3, "assistant", ""), (2, 0, None, None), (3, 0, "a: b:", "\\"),
    (3, 1, "assistant", "####\n\n</turn>\n### x: "), (None, 1, "user", "ü😀"), (4, None, "assistant", "x"), (4, 0, "assistant", "\\\\### : y"),
]


def test_conversations_read_back(spark):
    turns = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS parts", "2 AS loss")
    formatted = chat.format_conversations(turns)
    spans = {r.conv_id: r for r in formatted.collect()}
    for r in chat.read_back(formatted).collect():
        want = sorted((-1 if t is None else t, role or "", text or "") for c, t, role, text in CONVERSATIONS if c == r.conv_id)
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in want]
        assert r.loss_text == "".join(text for _, role, text in want if role == "assistant")
        blocks = sum(k == 0 or want[k - 1][1] != role for k, (_, role, _) in enumerate(want))
        assert r.formatted.count(chat.END) == blocks
        assert all(r.formatted[s.end:].startswith(("</turn>", "<next/>")) for s in spans[r.conv_id].loss)
    assert chat.digest(chat.format_conversations(turns.limit(0))).collect() == []


def test_formatting_runs_no_python(spark):
    formatted = chat.digest(chat.format_conversations(chat.control_conversation(spark)))
    plan = formatted._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("block_rows, query_rows", [(16_384, 2_048), (32, 3)])
def test_search_against_brute_force(spark, block_rows, query_rows):
    random_ = np.random.default_rng(9)
    vectors = random_.normal(size=(300, 8)) * random_.choice([0.1, 1, 3], 300)[:, None]
    vectors[50:90] = vectors[50]  # ties
    found = [(k, [float(x) for x in v], 1) for k, v in enumerate(vectors)]
    found += [(900, None, 1), (901, [None] * 8, 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] + [0.0] * 7, 1),
              (904, [1.0], 1), (None, [1.0] * 8, 1), (2**53 + 1, [0.5] * 8, 1), (5, found[5][1], 1)]
    table = spark.createDataFrame(found, "vec_id bigint, embedding array<double>, rank int")
    whole = [(i, np.floor(64 * np.array(v))) for i, v, _ in found if i is not None and i not in range(900, 910) and len(v) == 8]
    want = []
    for i, q in {i: q for i, q in whole if i % 20 == 0}.items():
        best = sorted(((-int(q @ c), j) for j, c in whole if j != i))[:topk.K]
        want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    got = topk.top_k(table, F.col("vec_id") % 20 == 0, block_rows=block_rows, query_rows=query_rows)
    assert rows(got) == sorted(want, key=repr)


def test_search_with_few_or_no_candidates(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<double>")
    assert rows(topk.top_k(table, F.col("vec_id") % 20 == 0)) == [(0, 1, 1, 64 * 128)]
    assert topk.top_k(table.limit(0), F.col("vec_id") % 20 == 0).collect() == []
