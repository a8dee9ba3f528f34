"""Licence notices and SPDX expressions in texts.

One Aho-Corasick automaton finds all notice phrases and the identifier tag in a text's words; the
expression after a tag is read by a shunting-yard parser and evaluated.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.blocks import arrow_map, bounded, plain_text
from tillmart.llm.words import LETTERS_AND_DIGITS

BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
PHRASES = {
    "lesser general public license": "lgpl", "affero general public license": "agpl",
    "mozilla public license": "mpl", "bsd license": "bsd", "isc license": "isc",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc by": "cc-by", "cc0": "cc0",
    "creative commons attribution": "cc-by", "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "released into the public domain": "public-domain", "the unlicense": "unlicense",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
#: How freely text under a licence may be used, 0 to 1; what isn't listed counts as UNKNOWN.
OPENNESS = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "cc0": 1.0, "unlicense": 1.0, "public-domain": 1.0, "cc-by": 0.9,
    "mpl": 0.7, "lgpl": 0.6, "cc-by-sa": 0.6, "gpl": 0.3, "agpl": 0.2, "cc-by-nd": 0.2, "cc-by-nc": 0.1, "proprietary": 0.0,
}
UNKNOWN = 0.5
#: An exception to a licence makes it at least as open as this.
WITH_EXCEPTION = 0.6
_IDENTIFIERS = sorted(OPENNESS, key=len, reverse=True)
_EXPRESSION = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\n\r]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
_RANK = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str:
    """``GPL-3.0-only`` is ``gpl``; an identifier of no known family is itself, in lower case."""
    name = identifier.lower().rstrip("+")
    if name == "0bsd":
        return "bsd"
    return next((f for f in _IDENTIFIERS if name == f or name.startswith(f + "-")), name)


def postfix(expression: str) -> list[str] | None:
    """Operands and lower-case operators of an expression, operators last; None if it has no sense.

    WITH binds closest, then AND, then OR. What follows a complete expression on its line, such as
    the end of a comment, is left out.
    """
    out, held, operand, depth = [], [], True, 0
    for token in _TOKEN.findall(expression):
        name = token.lower()
        if token == "(":
            if not operand:
                break
            held.append(token)
            depth += 1
        elif token == ")":
            if operand or not depth:
                break
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
            depth -= 1
        elif name in _RANK:
            if operand:
                return None
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[name]:
                out.append(held.pop())
            held.append(name)
            operand = True
        else:
            if not operand:
                break
            out.append(token)
            operand = False
    if operand or depth:
        return None
    return out + held[::-1]


def evaluate(terms: list[str]) -> tuple[set[str], float]:
    """(labels, openness): OR lets the user choose, AND binds to both, WITH softens."""
    stack = []
    for term in terms:
        if term not in _RANK:
            label = family(term)
            stack.append(({label}, OPENNESS.get(label, UNKNOWN)))
            continue
        right, left = stack.pop(), stack.pop()
        if term == "with":
            stack.append((left[0], max(left[1], WITH_EXCEPTION)))
        else:
            stack.append((left[0] | right[0], (max if term == "or" else min)(left[1], right[1])))
    return stack[0]


def _automaton():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for phrase in {**PHRASES, **BASE_PHRASES, TAG: "tag"}:
        automaton.add_word(f" {phrase} ", phrase)
    automaton.make_automaton()
    return automaton


def scan(text: str | None, automaton) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, expressions of one text."""
    words = (text or "").encode().translate(LETTERS_AND_DIGITS).split()
    # One character a byte, so that places in it are places in the bytes.
    line = (b" " + b" ".join(words) + b" ").decode("latin-1") if words else ""
    found = [(end - len(phrase) - 1, phrase) for end, phrase in automaton.iter(line)]
    base = [(at, phrase) for at, phrase in found if phrase in BASE_PHRASES]
    first = last = None
    if base:
        blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
        first, last = (int(np.searchsorted(blanks, at)) for at in (base[0][0], base[-1][0]))
    longest = {}
    for at, phrase in found:
        longest[at] = max(longest.get(at, ""), phrase, key=len)
    labels = {PHRASES[p] for p in longest.values() if p in PHRASES} | {BASE_PHRASES[p] for _, p in base}
    weights = [OPENNESS[label] for label in labels]
    expressions = []
    if any(phrase == TAG for _, phrase in found):
        for match in _EXPRESSION.finditer(text):
            terms = postfix(match[1])
            if terms:
                named, openness = evaluate(terms)
                labels |= named
                weights.append(openness)
                expressions.append(" ".join(terms))
    base_labels = sorted({BASE_PHRASES[p] for _, p in base})
    return len(words), len(base), first, last, ",".join(base_labels), ",".join(sorted(labels)), min(weights, default=UNKNOWN), expressions


_COLUMNS = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "expressions": pa.list_(pa.string()),
}


def _scan(batches):
    automaton = _automaton()
    for batch in bounded(batches, "text"):
        rows = [scan(t, automaton) for t in plain_text(batch.column("text")).to_pylist()]
        found = [pa.array(column, kind) for column, kind in zip(zip(*rows), _COLUMNS.values())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *found], ["doc_id", *_COLUMNS])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Licences of every row of ``docs`` (doc_id, text).

    n_words, n_base (places of a base phrase), first_word and last_word (its smallest and largest
    start), base_labels, labels (also from other phrases and SPDX expressions; the longest phrase
    counts where several begin), score (openness of the least open notice, 0.5 without one) and
    expressions (operands and operators, operators last). Null text has no words. An expression
    that can't be parsed gives nothing. Rows are scanned one by one, so repeated rows and null ids
    need no care; other columns are left out; no rows give none.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, _scan, (
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, expressions array<string>"
    ))
