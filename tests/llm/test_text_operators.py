"""Conversation repair, licence scans and fill-in-middle against brute force on small tables with odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import conversations, fill_middle, license_scan
from tidemark.llm.common import stage
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
CLASHES = "n int, form int, labels int, cost int, copies int, key int, part int, place int"
LOWER = {c: c + 32 for c in range(65, 91)}
SPACES = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# conversations

PUT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAME = {"u": "user", "a": "assistant"}


def cheapest(items):
    """Least ``(cost, audit, lines)`` of ``(role, text, fault)`` items, all choices tried row by row."""
    best = {"": (0, "", ())}

    def insert(states):
        out = dict(states)
        for _ in range(2):
            for state, (cost, audit, lines) in list(out.items()):
                made = (cost + 3, audit + "I", (*lines, f"{NAME[PUT[state]]}:"))
                if PUT[state] not in out or made < out[PUT[state]]:
                    out[PUT[state]] = made
        return out

    for role, text, fault in items:
        after = {}
        for state, (cost, audit, lines) in insert(best).items():
            moves = [(4, "D", state, ())]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                moves.append((3 + extra, "R", PUT[state], (f"{NAME[PUT[state]]}:{text}",)))
                if role[:1] == PUT[state] or (role[:1] == "s" and state == ""):
                    moves.append((extra, "K", role[:1], (f"{role}:{text}",)))
            for spent, letter, to, more in moves:
                made = (cost + spent, audit + letter, (*lines, *more))
                if to not in after or made < after[to]:
                    after[to] = made
        best = after
    return min(v for k, v in insert(best).items() if k in ("", "a"))


def expected_repairs(table):
    out = {}
    for conv in {r[0] for r in table}:
        kept = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            role, text = (" " if x is None else x for x in (role, text))
            kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(f"{r[1]}\0{r[2]}".encode()).digest()))
        items, seen = [], set()
        for _, role, text in kept:
            body = text.strip(SPACES)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            items.append((role, text, fault))
        turns = {t for t, _, _ in kept if t is not None}
        counts = [sum(f == k for _, _, f in items) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(items[:-1], items[1:]))
        cost, audit, lines = cheapest(items)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit, sha("\n".join(lines)))
    return out


def odd_conversations():
    rng = random.Random(7)
    table = [(None, 0, "user", "Hi."), (None, None, None, None), (1, None, "user", "a."), (1, None, "user", "a."), (1, 3, "", "x"), (2, 0, "system", "Be kind.")]
    table += [(3, k, "user", "again and again.") for k in range(150)]  # a long run of copies
    table += [(4, k, "user", f"question {k}.") for k in range(200)]  # a long run of one role
    table += [(5, 7, "assistant", "same")] * 90  # equal rows
    for conv in range(6, 60):
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(["system", "user", "assistant", "assistant", "user", "tool", "User", "", None])
            text = rng.choice(["", " \t", "Fine.", "Fine. \n", "cut off", "　", "é!", None, f"words {turn}?", "q" * 5000])
            table.append((conv, turn - 2 if rng.random() < 0.9 else None, role, text))
    return table


def test_repairs_equal_brute_force(spark):
    table = odd_conversations()
    frame = spark.createDataFrame([(*r, *range(8)) for r in table], f"conv_id long, turn int, role string, text string, {CLASHES}").repartition(5)
    got = conversations.repair_report(frame, "conv_id", "turn", "role", "text").collect()
    want = expected_repairs(table)
    assert {r[0]: tuple(r[1:]) for r in got} == want and len(got) == len(want)
    nothing = conversations.repair_report(frame.where("1 = 0"), "conv_id", "turn", "role", "text")
    assert nothing.count() == 0 and nothing.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_one_conversation_spreads_over_tasks(spark):
    table = [(1, k, ("user", "assistant", "user", "user")[k % 4], f"text {k % 97}" + "." * (k % 3)) for k in range(2000)]
    frame = spark.createDataFrame(table, "conv_id long, turn int, role string, text string").repartition(5)
    rows = conversations.damaged(frame, "conv_id", "turn", "role", "text")
    order = ["conv_id", "turn", "role", "key"]
    pieces = stage(conversations.with_faults(rows).repartitionByRange(6, *order).sortWithinPartitions(*order).mapInArrow(conversations.fragments, conversations.FRAGMENT), "pieces")
    assert pieces.count() > 3
    got = conversations.repair_report(frame, "conv_id", "turn", "role", "text").collect()
    assert [tuple(r) for r in got] == [(1, *expected_repairs(table)[1])]


def test_runs_by_powers_equal_row_by_row():
    rng = np.random.default_rng(3)
    sign = {(r, f): 2 * k + (f == "truncated") for k, r in enumerate(("system", "user", "assistant", "tool")) for f in ("", "truncated")}
    for _ in range(60):
        runs = [(int(rng.integers(0, 9)), int(rng.choice([1, 1, 2, 3, 65, 130]))) for _ in range(int(rng.integers(1, 6)))]
        items = [(*next((k for k, v in sign.items() if v == s), ("user", "blank")), ) for s, n in runs for _ in range(n)]
        symbols, lengths = np.array([s for s, _ in runs]), np.array([n for _, n in runs])
        packed, _ = conversations.joined_runs(symbols, lengths, np.zeros(len(runs)))
        assert conversations.repair_runs(packed.tobytes()) == cheapest([(r, "", f) for r, f in items])[:2]
    symbol = np.array([2])  # a million questions in a row
    cost, audit = conversations.solve(symbol, np.array([1_000_000]))
    assert cost == 3 * 500_000 and len(audit) == 1_000_000 and set(audit) == {"K", "R"}


def test_repaired_rows_are_the_texts(spark):
    frame = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "And?"), (2, 0, "assistant", "Yes.")], "conv_id long, turn int, role string, text string")
    rows = frame.selectExpr("*", "1L AS copies")
    got = conversations.repaired_rows(rows, stage(conversations.audits(rows), "audits")).collect()
    assert sorted(map(tuple, got)) == [(1, 0, "user", "Hi."), (1, 1, "assistant", "And?"), (2, 0, "user", ""), (2, 1, "assistant", "Yes.")]


# licence scans

LICENCE_TEXTS = [
    "Released under the MIT License.",
    "x\nLicensed under the Apache License, Version 2.0.\ny under the mit license; UNDER THE MIT LICENSE",
    "Licensed under CC BY-NC 4.0. cc-by-nc cc by ncx xcc by nc",
    "# SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-3.0-or-later WITH Classpath-exception-2.0\ncode",
    "SPDX-License-Identifier: MIT",
    "spdx license identifier without a colon MIT",
    "// SPDX-License-Identifier: AND",
    "License-Expression: BSD-3-Clause or zlib OR",
    "This work is licensed under the GNU General Public License, version 3.",
    "All rights reserved.",
    "under the mit license, under the mit licensé, underİthe mit license",
    "nothing to see",
    "",
    None,
    "İstanbul ß under the MIT license" * 3,
    "plain words " * 400_000 + "under the MIT license",
]
MORE_LABELS = {
    3: "apache-2,gpl-3-with-classpath-exception-2,mit", 4: "mit", 5: "", 6: "", 7: "bsd-3-clause,zlib", 8: "gpl-3", 9: "all-rights-reserved",
}


def naive_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = []
    for phrase, label in license_scan.BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i] == p[0] and words[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_scan_equals_brute_force(spark):
    frame = spark.createDataFrame([(k % 15, t, *range(8)) for k, t in enumerate(LICENCE_TEXTS)], f"doc_id long, text string, {CLASHES}").repartition(3)
    got = license_scan.scan_licenses(frame, "doc_id", "text").collect()
    assert sorted(map(repr, (tuple(r[1:6]) for r in got))) == sorted(map(repr, map(naive_scan, LICENCE_TEXTS)))
    for k, text in enumerate(LICENCE_TEXTS):
        labels, score = license_scan.scan((text or "").encode())[5:7]
        assert labels == MORE_LABELS.get(k, naive_scan(text)[4]) and (score > 0) == bool(labels) and 0 <= score <= 1
    assert license_scan.scan_licenses(frame.where("1 = 0"), "doc_id", "text").count() == 0


def test_scan_of_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r[1:6]) for r in QUERIES["op12_license_scan"](spark, FOLDER).collect()}
    assert got == {r.doc_id: naive_scan(r.text) for r in docs}


@pytest.mark.parametrize(
    ("text", "labels", "freedom"),
    [
        ("MIT OR GPL-2.0-only AND AGPL-3.0", {"mit", "gpl-2", "agpl-3"}, 1.0),
        ("(MIT OR GPL-2.0) AND AGPL-3.0", {"mit", "gpl-2", "agpl-3"}, 0.3),
        ("GPL-2.0 WITH x-exception AND MIT", {"gpl-2-with-x-exception", "mit"}, 0.4),
        ("(MIT and (BSD-2-Clause or Unknown)", {"mit", "bsd-2-clause", "unknown"}, 1.0),
        ("MIT) and GPL-3.0", {"mit"}, 1.0),
        ("MIT AND (", {"mit"}, 1.0),
        ("MIT this file", {"mit"}, 1.0),
        ("CC-BY-NC-4.0 or (MIT) with", {"cc-by-nc", "mit"}, 1.0),
        (") MIT", set(), None),
        ("((", set(), None),
        ("(" * 2000 + "MIT" + ")" * 2000, {"mit"}, 1.0),
    ],
)
def test_expressions(text, labels, freedom):
    tokens = license_scan.expression_tokens(text.encode(), 0)
    assert license_scan.evaluate(license_scan.postfix(tokens)) == (labels, freedom)


# fill-in-middle


def naive_fill(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    form = "spm" if h4 % 100 < 20 else "psm"
    output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(output), sha(text)


def test_fill_middle_equals_brute_force(spark, rows):
    rng = random.Random(5)
    shared = "".join(rng.choice("abc dé\U0001f600\n<PSM") for _ in range(9000))
    texts = [None, "", "a", "é", "<P", "P>", "<<S", "one <M> mark", "x" * 300_000, "é" * 120_000, "a1" * 100_000, shared, "lead " + shared, shared[:4000] + "z" + shared[4000:], "\U0001f600" * 40_000]
    texts += ["".join(rng.choice("ab İé<>M") for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    texts += [shared * 600]  # above 5 MB
    table = [(k if k % 50 else None, t) for k, t in enumerate(texts)] + [(7, "same row"), (7, "same row")]
    frame = spark.createDataFrame([(*r, *range(8)) for r in table], f"doc_id long, text string, {CLASHES}").repartition(3)
    got = fill_middle.digest_report(frame, "doc_id", "text")
    assert rows(got) == sorted((naive_fill(*r) for r in table), key=repr)
    assert fill_middle.digest_report(frame.where("1 = 0"), "doc_id", "text").count() == 0


def test_chunks_are_shared_and_found_again():
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ijk.é") for _ in range(20_000)).encode()
    texts = [passage, b"something else " + passage, passage[:7777].decode(errors="ignore").encode() + b"new" + passage]
    memo = fill_middle.ChunkMemo()
    chunked = fill_middle.ChunkedTexts(texts, memo)
    assert sum(map(len, memo.known)) < 0.6 * sum(map(len, texts))
    for i, text in enumerate(texts):
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text.decode())
        assert chunked.n_tokens()[i] == len(units)
        for k in [0, 1, len(units), *(rng.randrange(len(units)) for _ in range(50))]:
            head = "".join(units[:k])
            assert chunked.cut(i, k) == (len(head.encode()), len(head))
    small = fill_middle.ChunkMemo(most=100)
    fill_middle.ChunkedTexts(texts, small)
    fill_middle.ChunkedTexts([b"abc"], small)
    assert list(small.known) == [b"abc"]
