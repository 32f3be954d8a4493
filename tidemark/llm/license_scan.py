"""License notices and identifier tags in texts.

An Aho-Corasick automaton walks each text's words once and finds all notice phrases and identifier tags. What
follows a tag is read as a licence expression: a shunting-yard parser orders licences, parentheses and the
operators with, and, or; its output is evaluated to labels and to how free the terms are (the freest
alternative of an or, the strictest part of an and).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import id_text, slices

#: The phrases that everyone scans for.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notices, as label and weight of evidence.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.9),
    "permission to use copy modify and or distribute this software for any purpose": ("isc", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "bsd 2 clause license": ("bsd-2-clause", 0.9),
    "bsd 3 clause license": ("bsd-3-clause", 0.9),
    "gnu general public license version 2": ("gpl-2", 0.9),
    "gnu general public license version 3": ("gpl-3", 0.9),
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl", 0.9),
    "mozilla public license version 2": ("mpl-2", 0.9),
    "eclipse public license": ("epl", 0.8),
    "boost software license": ("bsl", 0.8),
    "creative commons attribution 4": ("cc-by", 0.8),
    "creative commons attribution sharealike": ("cc-by-sa", 0.8),
    "creative commons attribution noncommercial": ("cc-by-nc", 0.8),
    "creative commons zero": ("cc0", 0.8),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "this is free and unencumbered software released into the public domain": ("unlicense", 0.9),
    "all rights reserved": ("all-rights-reserved", 0.5),
}
#: Words that announce a licence expression.
TAGS = ("spdx license identifier", "license expression")
BASE_WEIGHT, TAG_WEIGHT = 0.9, 0.95
#: How free the terms are, by the start of a label; the first that fits counts.
FREEDOM = {
    "mit": 1.0, "isc": 1.0, "bsd": 1.0, "apache": 1.0, "bsl": 1.0, "cc0": 1.0, "unlicense": 1.0, "0bsd": 1.0, "zlib": 1.0,
    "mpl": 0.7, "epl": 0.7, "lgpl": 0.6, "gpl": 0.4, "agpl": 0.3,
    "cc-by-nc": 0.1, "cc-by-nd": 0.1, "cc-by-sa": 0.5, "cc-by": 0.9, "all-rights-reserved": 0.0,
}
UNKNOWN_FREEDOM = 0.2
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_GAPS = re.compile(rb"  +")
_AFTER_TAG = re.compile(rb"[ \t]*[:=]")
_TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")


def freedom_of(label: str) -> float:
    return next((f for start, f in FREEDOM.items() if label.startswith(start)), UNKNOWN_FREEDOM)


def label_of(identifier: str) -> str:
    """One label for the ways an identifier writes the same licence: ``GPL-3.0-or-later`` is ``gpl-3``."""
    label = re.sub(r"(-only|-or-later|\+)$", "", identifier.lower().rstrip(".:-"))
    label = re.sub(r"^(cc-by[a-z-]*?)-\d.*$", r"\1", label)
    return re.sub(r"(\d)\.0$", r"\1", label)


def expression_tokens(raw: bytes, at: int) -> Iterator[str]:
    """The tokens from ``at`` on; whoever reads them stops where the expression ends."""
    while found := _TOKEN.match(raw, at):
        at = found.end()
        yield found[1].decode()


def postfix(tokens: Iterable[str]) -> list[tuple[str, str]]:
    """Shunting-yard: ``(kind, text)`` of the longest expression the tokens begin with, operators behind their operands.

    It ends before a token that cannot follow. An operator without a right side is left out, and what is still
    open is closed.
    """
    out: list[tuple[str, str]] = []
    waiting: list[str] = []
    operand_next = True
    for token in tokens:
        word = token.lower()
        if operand_next:
            if word in PRECEDENCE or token == ")":
                break
            if token == "(":
                if waiting[-1:] == ["with"]:
                    break
                waiting.append("(")
                continue
            out.append(("id", token))
            operand_next = False
        elif token == ")":
            if "(" not in waiting:
                break
            while (top := waiting.pop()) != "(":
                out.append(("op", top))
        elif word in PRECEDENCE:
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[word]:
                out.append(("op", waiting.pop()))
            waiting.append(word)
            operand_next = True
        else:
            break
    if operand_next:  # what waits for a right side that never came
        while waiting and waiting[-1] == "(":
            waiting.pop()
        if waiting:
            waiting.pop()
    out.extend(("op", top) for top in reversed(waiting) if top != "(")
    return out if out and out[0][0] == "id" else []


def evaluate(expression: list[tuple[str, str]]) -> tuple[set[str], float | None]:
    """The labels of a postfix expression and how free its terms are; nothing and None if it is empty."""
    labels: set[str] = set()
    stack: list[tuple[str | None, float]] = []  # a licence not yet named, and its freedom

    def settle(value: tuple[str | None, float]) -> float:
        if value[0] is not None:
            labels.add(value[0])
        return value[1]

    for kind, text in expression:
        if kind == "id":
            label = label_of(text)
            stack.append((label, freedom_of(label)))
            continue
        right, left = stack.pop(), stack.pop()
        if text == "with":
            stack.append((f"{left[0]}-with-{right[0]}" if left[0] and right[0] else left[0], left[1]))
        else:
            stack.append((None, (max if text == "or" else min)(settle(left), settle(right))))
    return labels, settle(stack[-1]) if stack else None


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    """All phrases between spaces, so that only whole words match."""
    found = ahocorasick.Automaton()
    for kind, phrases in (("base", BASE_PHRASES), ("notice", NOTICES), ("tag", TAGS)):
        for phrase in phrases:
            found.add_word(f" {phrase} ", (kind, phrase))
    found.make_automaton()
    return found


def scan(raw: bytes) -> tuple[int, int, int | None, int | None, str, str, float, int, float | None]:
    """``n_words, n_base, first_word, last_word, base_labels, labels, score, n_tags, freedom`` of one text."""
    folded = raw.translate(_FOLD)
    body = _GAPS.sub(b" ", folded).strip(b" ")
    if not body:
        return 0, 0, None, None, "", "", 0.0, 0, None
    words = f" {body.decode('latin-1')} "
    base_at, tags, base, labels, evidence, terms = [], [], set(), set(), {}, []
    counted = word = 0
    # a phrase's place is its last character; no phrase holds another, so starts ascend closely enough to count on
    for last, (kind, phrase) in automaton().iter(words):
        start = last - len(phrase) - 1
        word += words.count(" ", counted, start) if start >= counted else -words.count(" ", start, counted)
        counted = start
        if kind == "base":
            base_at.append(word)
            base.add(BASE_PHRASES[phrase])
            evidence[phrase] = BASE_WEIGHT
        elif kind == "notice":
            labels.add(NOTICES[phrase][0])
            evidence[phrase] = NOTICES[phrase][1]
        else:
            tags.append(word + phrase.count(" "))
    if tags:
        inside = np.frombuffer(folded, np.uint8) != 32
        ends = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1
        for k in tags:
            if colon := _AFTER_TAG.match(raw, int(ends[k])):
                named, free = evaluate(postfix(expression_tokens(raw, colon.end())))
                if named:
                    labels |= named
                    terms.append(free)
                    evidence["tag"] = TAG_WEIGHT
    terms += [freedom_of(x) for x in base] + [freedom_of(NOTICES[p][0]) for p in evidence if p in NOTICES]
    doubt = 1.0
    for phrase in sorted(evidence):
        doubt *= 1.0 - evidence[phrase]
    return (
        words.count(" ") - 1, len(base_at), min(base_at, default=None), max(base_at, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 - doubt, len(tags), min(terms, default=None),
    )


def scan_licenses(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_tags, freedom``.

    Words are runs of digits, letters (A-Z as a-z) and all characters beyond ASCII. ``n_base`` counts all places of
    the base phrases; ``labels`` adds those of further notices and of expressions behind identifier tags. ``score``
    is the weight of the evidence that the text states a licence (0: none), each phrase counted once. ``freedom``
    (null without a finding) is that of the strictest notice. Null and empty texts have no words; repeated rows and
    ids are scanned alike; an empty table gives an empty result; other columns are not read. Nothing is shuffled.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.int64(), pa.float64()]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_tags", "freedom"]
        for batch in slices(batches, "text"):
            found = list(zip(*map(scan, batch.column("text").cast(pa.binary()).to_pylist()), strict=True)) or [()] * len(kinds)
            columns = [pa.array(x, kind) for x, kind in zip(found, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_tags long, freedom double"
    return id_text(docs, id_col, text_col).mapInArrow(rows, schema)
