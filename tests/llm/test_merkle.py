"""Merkle manifest: against a plain recursive version, on odd tables, and every tampering found."""

from __future__ import annotations

import hashlib
import zlib
from itertools import groupby

import pytest
from llm_helpers import ODD, rows
from pyspark.sql import functions as F

from tradewinds.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"
#: Columns named like what the operator uses itself.
CLASHING = ("tree", "idx", "n", "value", "hash", "other", "path", "leaf", "root", "subroot", "slot0", "at", "range", "level")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row) -> str:
    out = ""
    for value in row:
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return sha(out)


def proofs(hashes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top of one tree, and for each leaf the (before, after) of every level."""
    paths, own = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for k, at in enumerate(own):
            first = at - at % 8
            paths[k].append(("".join(hashes[first:at]), "".join(hashes[at + 1:first + 8])))
            own[k] = at // 8
        hashes = [sha("".join(hashes[k:k + 8])) for k in range(0, len(hashes), 8)]
    return hashes[0], paths


def brute(table: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof, folded, verified) with capitals lowered in every third row by crc32."""
    order = sorted(table, key=lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf_of(r)))
    groups = [list(g) for _, g in groupby(order, key=lambda r: r[2])]
    trees = [proofs([leaf_of(r) for r in g]) for g in groups]
    if not trees:
        return []
    root, tops = proofs([t[0] for t in trees])
    out = []
    for group, (subroot, paths), top in zip(groups, trees, tops):
        for row, path in zip(group, paths):
            steps = path + top
            h = leaf_of(row)
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                h = leaf_of((*row[:4], "".join(c.lower() if c.isascii() else c for c in row[4])))
            for before, after in steps:
                h = sha(before + h + after)
            out.append((row[0], leaf_of(row), subroot, root, sha("".join(b + a for b, a in steps)), h, h == root))
    return sorted(out, key=repr)


def audited(spark, table):
    df = spark.createDataFrame(table, SCHEMA)
    for name in CLASHING:
        df = df.withColumn(name, F.lit(name))
    third = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    return merkle.audit(df, third, merkle.without_capitals(F.col("text")))


def odd_table() -> list[tuple]:
    table = [(k, "web", "en", 5, t) for k, t in enumerate(ODD)]
    table += [(100 + k, None if k % 5 else "Web", None, None, f"Text {k}") for k in range(70)]
    table += [(300, "a", "de", 1, "A"), (300, "a", "de", 1, "B"), (300, "a", "de", 1, "B"), (None, "a", "de", 1, "N"), (-3, "a", "de", 1, "M")]
    table += [(400 + k, "a", lang, 0, "X y") for k, lang in enumerate(["", "é", "z", "Z", "漢", "\U0001f600", "fr", "￿", "lone"])]
    return table


def test_odd_table_against_brute_force(spark):
    got = audited(spark, odd_table())
    want = brute(odd_table())
    assert rows(got) == want
    assert {r[6] for r in want} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_one_group_of_every_shape(spark, n):
    table = [(k, "s", "en", k, f"Word {k}") for k in range(n)]
    assert rows(audited(spark, table)) == brute(table)


def test_empty_table(spark):
    got = audited(spark, [])
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.collect() == []


def test_ranges_smaller_than_groups(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 20)
    table = [(k * 37 % 1000, "s", "en" if k % 3 else None, k, f"T{k}") for k in range(600)]
    assert rows(audited(spark, table)) == brute(table)


def test_any_changed_column_is_found(spark):
    table = [(k, "s", "en", k, f"t{k}") for k in range(20)]
    found = merkle.manifest(spark.createDataFrame(table, SCHEMA)).collect()
    for r in found:
        row = table[r.doc_id]
        for k, value in enumerate((99, "S", "fr", None, "")):
            h = leaf_of((*row[:k], value, *row[k + 1:]))
            for step in r.path:
                h = sha(step.before + h + step.after)
            assert h != r.root


def test_no_python_in_the_plan(spark):
    plan = audited(spark, odd_table())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
