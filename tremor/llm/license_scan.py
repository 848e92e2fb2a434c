"""License scans: notice phrases and identifier tags found by an Aho-Corasick automaton, tag expressions parsed and evaluated.

A text becomes its words, A-Z in lower case, one space between them; the automaton finds every place of every phrase
in one pass. Where a tag such as ``SPDX-License-Identifier`` stands, the licence expression behind it is taken from
the text itself, ordered by a shunting yard (WITH binds before AND, AND before OR) and evaluated: OR offers a choice and
takes the least restrictive side, AND binds to the most restrictive, WITH relaxes a licence by its exception. A
document's score is that of all its statements joined by AND.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.base import in_chunks, per_process, plain, rows_of, ship_by_value

# The phrases every scan reports, with their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notice phrases, as words, with their labels.
NOTICES = {
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu general public license v2": "gpl-2.0",
    "gnu general public license v3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license version 2 0": "apache-2.0",
    "apache license 2 0": "apache-2.0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0 1 0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "2 clause bsd": "bsd-2-clause",
    "3 clause bsd": "bsd-3-clause",
    "isc license": "isc",
    "zlib license": "zlib",
    "boost software license": "bsl-1.0",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
# Tags that a licence expression follows, as words.
TAGS = ("spdx license identifier", "license expression")
# How much a licence restricts reuse, by the longest prefix of its name; other names count as OTHER.
GRADES = {
    "public-domain": 0.1, "cc0": 0.1, "unlicense": 0.1, "0bsd": 0.1,
    "mit": 0.25, "bsd": 0.25, "isc": 0.25, "zlib": 0.25, "bsl-1.0": 0.25, "apache": 0.25, "cc-by": 0.25, "artistic": 0.25,
    "lgpl": 0.5, "mpl": 0.5, "epl": 0.5, "cddl": 0.5,
    "gpl": 0.75, "cc-by-sa": 0.75, "agpl": 0.9,
    "cc-by-nc": 1.0, "cc-by-nd": 1.0, "all-rights-reserved": 1.0, "proprietary": 1.0,
}
OTHER, RELAXED = 0.6, 0.25
UNREADABLE = "unreadable-expression"

# Words are runs of digits, letters and everything beyond ASCII; A-Z are lowered and all other bytes end a word.
FOLD = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
STATEMENT = "struct<kind string, word long, label string, expression string, score double>"
SCANNED = f"doc_id long, n_words long, statements array<{STATEMENT}>"
TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def grade(name: str) -> float:
    known = [k for k in GRADES if name == k or name.startswith((k + "-", k + "+"))]
    return GRADES[max(known, key=len)] if known else OTHER


@dataclass
class Value:
    """What an expression allows: the score of the licences in force, their names, and all names it mentions."""

    score: float
    chosen: tuple[str, ...]
    named: tuple[str, ...]


def apply(operator: str, left: Value, right: Value) -> Value:
    named = left.named + right.named
    if operator == "or":
        better = min(left, right, key=lambda v: (v.score, v.chosen))
        return Value(better.score, better.chosen, named)
    if operator == "and":
        return Value(max(left.score, right.score), tuple(sorted({*left.chosen, *right.chosen})), named)
    return Value(max(0.0, left.score - RELAXED), tuple(f"{c} with {right.named[0]}" for c in left.chosen), named)


def postfix(text: str) -> list[str] | None:
    """The expression at the start of ``text`` in postfix order; None if none can be read there.

    Reading ends at the line's end or where an operator would have to follow and none does. An open bracket, or an
    operator without its right side, leaves no expression.
    """
    output: list[str] = []
    stack: list[str] = []
    at, operand_due = 0, True
    while match := TOKEN.match(text, at):
        token = match.group(1)
        low = token.lower()
        if operand_due:
            if token == "(":
                stack.append(token)
            elif token == ")" or low in PRECEDENCE:
                return None
            else:
                output.append(low)
                operand_due = False
        elif low in PRECEDENCE:
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[low]:
                output.append(stack.pop())
            stack.append(low)
            operand_due = True
        elif token == ")" and "(" in stack:
            while (top := stack.pop()) != "(":
                output.append(top)
        else:
            break
        at = match.end()
    if operand_due or "(" in stack:
        return None
    return output + stack[::-1]


def evaluate(order: list[str]) -> Value | None:
    """The value of a postfix expression; None where an exception stands before its licence or is itself a group."""
    stack: list[Value] = []
    simple: list[bool] = []
    for token in order:
        if token not in PRECEDENCE:
            stack.append(Value(grade(token), (token,), (token,)))
            simple.append(True)
            continue
        right, left = stack.pop(), stack.pop()
        plain_right, plain_left = simple.pop(), simple.pop()
        if token == "with" and not (plain_right and plain_left):
            return None
        stack.append(apply(token, left, right))
        simple.append(False)
    return stack[0]


def build() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, *TAGS}:
        automaton.add_word(f" {phrase} ", phrase)
    automaton.make_automaton()
    return automaton


def scan_text(text: str, automaton: ahocorasick.Automaton) -> tuple[int, list[tuple]]:
    """(number of words, statements); a statement is (kind, first word, label, expression, score)."""
    raw = text.encode()
    folded = raw.translate(FOLD)
    words = folded.split()
    line = (b" " + b" ".join(words) + b" ").decode()
    found, tags, seen, number = [], [], 0, 0
    for end, phrase in automaton.iter(line):
        start = end - len(phrase) - 1
        # Places come in the order of their ends; starts may step back by a phrase's length.
        number += line.count(" ", seen, start) if start >= seen else -line.count(" ", start, seen)
        seen = start
        if phrase in BASE:
            found.append(("base", number, BASE[phrase], None, grade(BASE[phrase])))
        if phrase in NOTICES:
            found.append(("notice", number, NOTICES[phrase], None, grade(NOTICES[phrase])))
        if phrase in TAGS:
            tags.append((number, len(phrase.split())))
    if tags:
        found.extend(_tagged(raw, folded, sorted(tags)))
    return len(words), found


def _tagged(raw: bytes, folded: bytes, tags: list[tuple[int, int]]) -> Iterator[tuple]:
    """The statements of all tags, given by first word and length: one per licence that a tag's expression names."""
    places = enumerate(re.finditer(rb"[^ ]+", folded))
    for number, length in tags:
        end = next(place.end() for at, place in places if at == number + length - 1)
        # Only the line behind the tag is decoded; lines end at line feed or carriage return.
        line = re.compile(rb"[^\r\n]*").match(raw, end).group().decode()
        behind = re.match(r"[\"']?[ \t]*[:=][ \t]*[\"']?(.*)", line, re.DOTALL)
        if not behind:
            continue
        order = postfix(behind.group(1))
        value = order and evaluate(order)
        if not value:
            yield "tag", number, UNREADABLE, behind.group(1), OTHER
            continue
        for name in sorted(set(value.named)):
            yield "tag", number, name, " ".join(order), value.score


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, statements (kind base, notice or tag; word; label; expression; score).

    Phrases come in the order of their ends, tags after them. A tag's expression is in postfix order; one that cannot be
    read is kept as it stands under the label ``unreadable-expression``. Null and empty texts have no words and no
    statements; a null doc_id stays null; repeated rows give repeated rows; an empty table gives none. Other columns
    are not read, and nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = per_process("license phrases", build)
        names = ["kind", "word", "label", "expression", "score"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.float64()]
        statement = pa.list_(pa.struct(list(zip(names, kinds))))

        def scanned(rows):
            for doc_id, text in rows:
                n, found = scan_text(text, automaton)
                yield doc_id, n, [dict(zip(names, f)) for f in found]

        def batch(rows: list) -> pa.RecordBatch:
            ids, n, found = zip(*rows)
            columns = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(found, statement)]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "statements"])

        yield from in_chunks(scanned(rows_of(batches, "doc_id", "text")), batch)

    return plain(docs, id_col, text_col).mapInArrow(run, SCANNED)


def license_labels(scanned: DataFrame) -> DataFrame:
    """One row per document from :func:`scan_licenses`: counts and places of base phrases, labels, and the score.

    first_word and last_word are null and labels empty where nothing is found; the score is then 0.
    """
    base = F.filter("statements", lambda s: s["kind"] == "base")

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["word"])).alias("last_word"),
        joined(F.transform(base, lambda s: s["label"])).alias("base_labels"),
        joined(F.transform("statements", lambda s: s["label"])).alias("labels"),
        F.coalesce(F.array_max(F.transform("statements", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )


ship_by_value(__name__)
