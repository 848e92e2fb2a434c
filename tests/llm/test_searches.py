"""Vector codes, license scans and ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tremor.llm import lexical_search, license_scan, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int, n int, part string, ints array<int>, used boolean, error string, entry long"
CLASH = (1, "p", [1], True, "e", 9)


def vectors(n, length=8, seed=3, spread=0.2):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(length)] for _ in range(12)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.choice([0, 1, 1, 1, None])) for i in range(n)]


def brute_codes(rows, parts=4, entries=256, rounds=4):
    """Every part against every entry with whole numbers."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == length]
    spans = [(p * length // parts, (p + 1) * length // parts) for p in range(parts)]
    books = [[r[1][a:b] for r in kept[:entries]] for a, b in spans]

    def nearest(x, book):
        return min((sum((u - v) ** 2 for u, v in zip(x, c)), k) for k, c in enumerate(book))

    for turn in range(rounds + 1):
        found = [[nearest(r[1][a:b], books[p]) for p, (a, b) in enumerate(spans)] for r in kept]
        if turn < rounds:
            for p, (a, b) in enumerate(spans):
                for k in {f[p][1] for f in found}:
                    mine = [r[1][a:b] for r, f in zip(kept, found) if f[p][1] == k]
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    out = [(r[0], "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), r[2]) for r, f in zip(kept, found)]
    totals = Counter()
    for _, _, error, label in out:
        totals[label] += error
    return sorted(((i, c, e, totals[label]) for i, c, e, label in out), key=str), books


def check_codes(spark, rows, **settings):
    df = spark.createDataFrame([(*r, *CLASH) for r in rows], VECTORS).repartition(3)
    codes, books = vector_codes.encode_vectors(df, **settings)
    got = vector_codes.with_label_errors(codes)
    settings.pop("keep", None)
    want, want_books = brute_codes(rows, **settings)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got.collect()), key=str) == want
    assert [b.astype(int).tolist() for b in books] == want_books
    return books


@pytest.mark.parametrize("keep", [1, 4, 32])
def test_vector_codes(spark, keep):
    rows = vectors(500)
    awkward = [
        (501, None, 1), (502, [None] * 8, 1), (503, [0.1] * 7 + [float("nan")], 1), (504, [0.1] * 7 + [float("-inf")], 1),
        (505, [0.5] * 5, 1), (506, [], 1), (None, rows[3][1], None), (7, rows[7][1], rows[7][2]), (7, rows[7][1], rows[7][2]),
        (600, rows[9][1], 0), (-5, [-0.0] * 8, None),
    ]
    check_codes(spark, rows + awkward, entries=16, keep=keep)


def test_vector_codes_few_rows(spark):
    rows = vectors(5, length=6)
    books = check_codes(spark, rows)
    assert [len(b) for b in books] == [5] * 4
    codes, books = vector_codes.encode_vectors(spark.createDataFrame([], VECTORS))
    assert codes.count() == 0 and books == []
    assert vector_codes.with_label_errors(codes).columns == ["vec_id", "label", "code", "error", "label_error"]


def test_hot_vector(spark):
    """Most rows are one vector: a tie between entries that start equal goes to the lower index."""
    rows = [(i, [0.25] * 8, 1) for i in range(300)] + [(1000 + i, v, 2) for i, v, _ in vectors(100)]
    check_codes(spark, rows, entries=32)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(1, 9), st.integers(1, 6))
def test_bounds_settle_exactly(seed, keep, grid):
    """States carried over moving entries name the nearest entry, however few bounds are kept; coarse grids make ties."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-grid * 4, grid * 4, (60, 3)).astype(float)
    books = [rng.integers(-grid * 4, grid * 4, (10, 3)).astype(float)]
    near, low, outer, _ = vector_codes.first_state(x, books[0], keep)
    for _ in range(4):
        moved = books[-1] + rng.integers(-grid, grid + 1, (10, 3))
        drift = np.sqrt(((moved - books[-1]) ** 2).sum(axis=1)) * vector_codes.UP
        near, low, outer, error, _ = vector_codes.next_state(x, moved, drift, near, low, outer, max(1, keep - 1))
        books.append(moved)
        all_of = ((x[:, None] - moved[None]) ** 2).sum(axis=2)
        assert (near[:, 0] == all_of.argmin(axis=1)).all() and (error == all_of.min(axis=1)).all()
        true = np.sqrt(all_of)
        assert (low <= np.take_along_axis(true, near, axis=1) + 1e-9).all()
        others = true.copy()
        np.put_along_axis(others, near, np.inf, axis=1)
        assert (outer <= others.min(axis=1) + 1e-9).all()


def test_fewer_entries_are_kept(spark):
    """Well separated clusters settle among few entries, so the kept lists shrink."""
    assert vector_codes._fewer([(-1, 1, -1, 990), (-1, 2, -1, 9), (-1, 7, -1, 1), (0, 3, 0, 5)], 8) == 2
    assert vector_codes._fewer([(-1, 255, -1, 10)], 8) == 8
    assert vector_codes._fewer([(-1, 1, -1, 90), (-1, 255, -1, 10)], 8) == 8


def test_too_large_components():
    with pytest.raises(ValueError):
        vector_codes.checked(np.array([[1 << 40, 0]]))


# 12: license scans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_scan(text):
    words = WORD.findall(ascii_lower(text or ""))
    found = []
    for phrase, label in license_scan.BASE.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(parts)] == parts]
    labels = {label for _, label in found}
    for phrase, label in license_scan.NOTICES.items():
        parts = phrase.split()
        if any(words[i:i + len(parts)] == parts for i in range(len(words))):
            labels.add(label)
    starts = [i for i, _ in found]
    return (
        len(words), len(found), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in found})), ",".join(sorted(labels)),
    )


NOTICE_TEXTS = [
    "Licensed under the Apache License, Version 2.0. MIT license MIT License", "cc by-nc 4.0", "CC\nBY", "ccby cc_by", "mitlicense",
    "GNU GENERAL PUBLIC\x00LICENSE v3", "the gnu general public licenses", "mit license " * 500, "é mit license", "émit license",
    "gnu gnu general public license", "cc cc by by", "MIT LİCENSE", "apache license apache license version 2 0",
]


def test_license_scan(spark, docs, texts):
    extra = [(2000 + i, t) for i, t in enumerate(NOTICE_TEXTS)]
    more = spark.createDataFrame([(i, t, "en", None, 1, 7, "n", None, True, "size", 1) for i, t in [*extra, (None, "mit license")]], docs.schema)
    got = license_scan.license_labels(license_scan.scan_licenses(docs.unionByName(more))).toPandas()
    want = [(i, *brute_scan(t)) for i, t in [*texts, *extra, (None, "mit license")]]
    rows = got.astype(object).where(got.notna(), None)
    assert sorted(map(str, want)) == sorted(str(tuple(
        int(v) if isinstance(v, float) else v for v in r[:-1])) for r in rows.itertuples(index=False, name=None))
    assert got.score.between(0, 1).all() and (got[got.labels == ""].score == 0).all()
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["mit", "license", "Apache", "cc", "by", "nc", "gnu", "general", "public", "é", "v3", "."]), max_size=40))
def test_phrases_anywhere(parts):
    text = " ".join(parts)
    n, found = license_scan.scan_text(text, license_scan.build())
    base = [f for f in found if f[0] == "base"]
    want = brute_scan(text)
    assert (n, len(base), min((f[1] for f in base), default=None), max((f[1] for f in base), default=None)) == want[:4]
    assert ",".join(sorted({f[2] for f in found})) == want[5]


@pytest.mark.parametrize("text, order", [
    ("MIT", "mit"),
    ("MIT OR Apache-2.0 AND GPL-2.0-only", "mit apache-2.0 gpl-2.0-only and or"),
    ("(MIT OR Apache-2.0) AND GPL-2.0+", "mit apache-2.0 or gpl-2.0+ and"),
    ("GPL-2.0-only WITH Classpath-exception-2.0 OR MIT */", "gpl-2.0-only classpath-exception-2.0 with mit or"),
    ("((MIT))", "mit"), ("MIT and ISC or Zlib", "mit isc and zlib or"), ("MIT License text", "mit"),
    ("MIT OR", None), ("OR MIT", None), ("(MIT", None), ("()", None), ("", None), ("MIT) OR ISC", "mit"), ("* x", None),
])
def test_expressions(text, order):
    assert license_scan.postfix(text) == (order and order.split())


EXPRESSIONS = st.recursive(
    st.sampled_from(["MIT", "GPL-3.0-only", "Apache-2.0", "CC-BY-NC-4.0", "Own-1.0", "MPL-2.0"]),
    lambda e: st.one_of(
        st.tuples(e, st.sampled_from(["AND", "OR", "and"]), e).map(lambda t: f"({t[0]} {t[1]} {t[2]})"),
        e.map(lambda t: f"({t})"),
    ), max_leaves=8,
)


def value_of(text):
    """The score by recursive splitting at the weakest operator outside brackets."""
    text = text.strip()
    depth = 0
    for operator, fold in (("or", min), ("and", max)):
        parts, held = [], []
        for token in re.findall(r"[()]|[^\s()]+", text):
            depth += (token == "(") - (token == ")")
            if depth == 0 and token.lower() == operator:
                parts.append(" ".join(held))
                held = []
            else:
                held.append(token)
        if parts:
            return fold(value_of(p) for p in [*parts, " ".join(held)])
    if text.startswith("("):
        return value_of(text[1:-1])
    return license_scan.grade(text.lower())


@settings(max_examples=200, deadline=None)
@given(EXPRESSIONS, EXPRESSIONS)
def test_evaluation(left, right):
    text = f"{left} OR {right} AND MIT"
    value = license_scan.evaluate(license_scan.postfix(text))
    assert value.score == value_of(text)
    assert set(value.chosen) <= set(value.named)


def test_tags():
    automaton = license_scan.build()

    def tags(text):
        return [(f[1], f[2], f[4]) for f in license_scan.scan_text(text, automaton)[1] if f[0] == "tag"]

    assert tags("x\n// SPDX-License-Identifier: MIT OR GPL-2.0-only\nint y;") == [(1, "gpl-2.0-only", 0.25), (1, "mit", 0.25)]
    assert tags('"License-Expression" = "GPL-3.0 WITH GCC-exception-3.1"') == [(0, "gcc-exception-3.1", 0.5), (0, "gpl-3.0", 0.5)]
    assert tags("SPDX-License-Identifier: (MIT") == [(0, license_scan.UNREADABLE, license_scan.OTHER)]
    assert tags("é SPDX-License-Identifier: MIT\r\nSPDX-License-Identifier: ISC") == [(1, "mit", 0.25), (5, "isc", 0.25)]
    assert tags("the spdx license identifier of a file") == []
    assert tags("SPDX-License-Identifier: MIT WITH (A OR B)") == [(0, license_scan.UNREADABLE, license_scan.OTHER)]
    assert len(tags("SPDX-License-Identifier: MIT\n" * 3000)) == 3000


# 13: ranked lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, top=20):
    counted = [(i, Counter(TERM.findall(ascii_lower(t or "")))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    total, size = sum(sum(c.values()) for _, c in counted), len(counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in dict.fromkeys(items):
        asked.setdefault(item, Counter()).update(TERM.findall(ascii_lower(text or "")))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc_id, c in counted:
            n = sum(c.values())
            m = 100 - 25 + (25 * n * size) // total
            score = sum(times * math.floor(1000 * math.log((2 * size + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                        for t, times in terms.items() if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item, rank, None if null else d, -low) for rank, (low, null, d) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def ranks(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def test_ranked_search(spark, docs_with_null, texts):
    rows = [*texts, (None, "no id"), (None, None), (4, "another text of document four")]
    words = [w for _, t in texts if t for w in t.split()[:40]]
    rng = random.Random(5)
    items = [(k, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for k in range(40)]
    items += [(100, None), (101, ""), (102, "nowhere-to-be-found"), (103, "ID no id"), (None, "id word"), (0, items[0][1]), (1, "word word")]
    asked = spark.createDataFrame([(i, t, 1, 2, "s") for i, t in items], "item_id long, text string, item int, batch int, score string")
    assert ranks(lexical_search.ranked_search(docs_with_null, asked)) == brute_search(rows, items)
    assert ranks(lexical_search.ranked_search(docs_with_null, asked, top=3)) == brute_search(rows, items, 3)
    assert lexical_search.ranked_search(docs_with_null.limit(0), asked).count() == 0
    assert lexical_search.ranked_search(docs_with_null, asked.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_many_queries_and_blocks(spark, monkeypatch):
    """Several batches of queries, several blocks of documents and of terms; thousands of equal documents tie."""
    monkeypatch.setattr(lexical_search, "QUERIES", 7)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([3, 20, 300])))) for i in range(1500)]
    rows += [(10_000 + i, "w1 w2 w3 copy") for i in range(1500)]
    items = [(k, " ".join(rng.choices([*words, "copy"], k=12))) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert ranks(lexical_search.ranked_search(docs, asked)) == brute_search(rows, items)


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(0, 3000), st.one_of(st.integers(1, 5), st.integers(1, 10**7)), min_size=1, max_size=300), st.integers(0, 99))
def test_bounds_hold(counts, seed):
    """No document's bound is below its score."""
    doc = Counter({b"t%d" % t: n for t, n in counts.items()})
    rng = random.Random(seed)
    queries = [(q, Counter(b"t%d" % rng.randrange(3000) for _ in range(30))) for q in range(5)]
    df = {t: rng.randint(1, 900) for _, terms in queries for t in terms}
    lookup = lexical_search.Lookup(queries, df, 1000, 400_000)
    sketch, n = lexical_search.sketch_of(doc), np.array([sum(doc.values())])
    bound = lookup.bounds(n, sketch, np.array([0, len(sketch)]))[0]
    for q in range(5):
        assert bound[q] >= lookup.score(q, doc, int(lookup.length_part(n)[0]))


def test_long_text(spark):
    """A text with more distinct terms than any block of terms, and very frequent ones."""
    rows = [(1, " ".join(f"x{i}" for i in range(20_000)) + " common" * 50_000), (2, "common x7"), (3, "x19999 x7 common common")]
    items = [(1, "x7 common"), (2, " ".join(f"x{i}" for i in range(9_000)))]
    got = lexical_search.ranked_search(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert ranks(got) == brute_search(rows, items)
