"""Deduplication operators and the pipeline against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import SCHEMA, as_rows, words
from tremor.llm import exact_dedup, minmax, near_dedup, paragraph_dedup, suffix_array, suffix_dedup


# 2: exact duplicates


def lowered(text):
    return (text or "").encode().lower().decode()


@pytest.mark.parametrize("weak", [False, True])
def test_exact_duplicates(spark, docs, texts, tmp_path, weak):
    path = str(tmp_path / "documents.parquet")
    docs.write.parquet(path)
    digest = (lambda c: F.unhex(F.hex(F.crc32(c.cast("binary")) % 5))) if weak else exact_dedup.sha256
    got = exact_dedup.exact_duplicates(spark, path, digest=digest, files_per_batch=1).collect()
    assert len(got) == len(texts)
    groups = defaultdict(list)
    for i, t in texts:
        groups[lowered(t)].append(i)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = Counter()
    for r in got:
        ids = by_sha[r["text_sha256"]]
        assert r["doc_id"] in ids and r["keep_id"] == max(ids) and r["group_size"] == len(ids)
        assert r["kept"] <= (r["doc_id"] == r["keep_id"])
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_exact_duplicates_of_nothing(spark, empty, docs_with_null, tmp_path):
    empty.write.parquet(str(tmp_path / "none.parquet"))
    assert exact_dedup.exact_duplicates(spark, str(tmp_path / "none.parquet")).count() == 0
    out = exact_dedup.drop_exact_duplicates(docs_with_null)
    assert out.schema == docs_with_null.schema
    want = {lowered(r["text"]) for r in docs_with_null.collect()}
    assert sorted(lowered(r["text"]) for r in out.collect()) == sorted(want)


# 3 and 6: near duplicates


def shingle_set(text, n):
    w = text.encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def components(keys, sets, percent):
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(keys)
    for i, a in enumerate(order):
        for b in order[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_signature_keeps_both_ends():
    s = minmax.shingles("a b c d e f g", 2)
    low, high = minmax.signature(s)
    x = minmax.FACTORS[:, None] * s[None, :] + minmax.SHIFTS[:, None]
    assert (low == x.min(axis=1)).all() and (high == x.max(axis=1)).all()
    assert len(minmax.band_keys(s, 32, 4)) == len(set(minmax.band_keys(s, 32, 4).tolist())) == 32
    assert minmax.shingles("A  b\nC", 2).tolist() == minmax.shingles("a b c", 2).tolist()


@pytest.mark.parametrize("bands, rows", [
    (near_dedup.BANDS, near_dedup.ROWS), (paragraph_dedup.BANDS, paragraph_dedup.ROWS), (10, 3), (25, 5), (42, 3), (128, 1),
])
def test_no_value_is_used_twice(monkeypatch, bands, rows):
    end, at = minmax.value_places(bands, rows)
    assert len({*zip(end.ravel().tolist(), at.ravel().tolist())}) == bands * rows
    assert all(len(set(band)) == rows for band in at.tolist())
    # A value that changes moves the key of its own band alone.
    low, high = minmax.signature(minmax.shingles("a b c d e f g", 2))
    before = minmax.band_keys(minmax.shingles("a b c d e f g", 2), bands, rows)
    moved = []
    for k in range(minmax.PERMUTATIONS):
        for changed in (0, 1):
            pair = [low.copy(), high.copy()]
            pair[changed][k] += np.uint64(1)
            monkeypatch.setattr(minmax, "signature", lambda s, pair=pair: tuple(pair))
            moved += np.flatnonzero(minmax.band_keys(minmax.shingles("x", 2), bands, rows) != before).tolist()
    assert Counter(moved) == dict.fromkeys(range(bands), rows)


def test_too_many_bands_are_refused():
    with pytest.raises(ValueError):
        minmax.band_keys(minmax.shingles("a b c", 2), 43, 3)


def test_paragraph_bands_miss_as_little_as_near_bands():
    def missed(kind):
        return (1 - 0.8**kind.ROWS) ** kind.BANDS

    assert missed(paragraph_dedup) <= missed(near_dedup) < 1e-7


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates(docs, texts, n):
    got = near_dedup.near_duplicates(docs, words=n).collect()
    sets = {i: shingle_set(t or "", n) for i, t in texts}
    want = components(sets, sets, 80)
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]])
        assert r["kept"] == (r["component_id"] == r["doc_id"])


def test_chains_of_near_duplicates(spark):
    """Members of a bucket that are linked with each other, but not with its pivot."""
    rng = random.Random(3)
    base = words(rng, 40).split()
    rows, now = [], list(base)
    for i in range(120):
        now = list(now if i % 3 else base)
        for _ in range(rng.randint(2, 9)):
            now[rng.randrange(40)] = words(rng, 1)
        rows.append((rng.randrange(10**9), " ".join(now)))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()
    sets = {i: shingle_set(t, 1) for i, t in rows}
    want = components(sets, sets, 80)
    assert len(set(want.values())) > 5
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def changed(rng, text, n=1):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = words(rng, 1, "xyz")
    return " ".join(w)


def test_near_copies_of_texts_without_id(spark):
    """Classes whose first row has a null id keep the links to their near copies."""
    rng = random.Random(13)
    a, b, c = (words(rng, 60) for _ in range(3))
    rows = [(None, a), (1, a), (2, a), (3, changed(rng, a)), (None, b), (None, b), (4, changed(rng, b)), (5, changed(rng, b)),
            (6, c), (7, changed(rng, c)), (None, words(rng, 60)), (8, words(rng, 60))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    keys = [(-1 if i is None else i, k) for k, (i, _) in enumerate(rows)]
    sets = {key: shingle_set(t, 2) for key, (_, t) in zip(keys, rows)}
    want = components(sets, sets, 80)
    assert want[keys[3]][0] == want[keys[6]][0] == -1
    got = near_dedup.near_duplicates(df, words=2).na.fill(-1, ["doc_id", "component_id"])
    assert sorted((r["doc_id"], r["component_id"]) for r in got.collect()) == sorted((k[0], v[0]) for k, v in want.items())
    kept = near_dedup.drop_near_duplicates(df, words=2)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for (i, _), key in zip(rows, keys) if (key[0] == want[key][0]))


def test_paragraphs_near_those_without_id(spark):
    rng = random.Random(14)
    a, b = (words(rng, 60) for _ in range(2))
    rows = [(None, f"{a}\n{words(rng, 30)}\n{b}"), (1, f"{changed(rng, a)}\n{words(rng, 30)}"), (2, f"{words(rng, 30)}\n{changed(rng, b)}"), (3, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    sets = {(-1 if i is None else i, k): shingle_set(line, 5) for i, t in rows for k, line in enumerate(t.split("\n"))}
    want = {k: first for k, first in components(sets, sets, 80).items() if k != first}
    assert want == {(1, 0): (-1, 0), (2, 1): (-1, 2), (3, 0): (-1, 0)}
    got = paragraph_dedup.duplicate_paragraphs(df).na.fill(-1, ["doc_id", "first_id"]).collect()
    assert {(r["doc_id"], r["paragraph"]): (r["first_id"], r["first_paragraph"]) for r in got} == want


def hashed(spark, rows):
    """Rows as (id or None, Spark's hash of the text, text)."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return [tuple(r) for r in df.select("doc_id", F.xxhash64("text"), "text").collect()]


def test_texts_that_share_an_id(spark):
    """Different texts under one id, null or not: one text of every component stays, and nothing else goes."""
    rng = random.Random(15)
    a, b, c, d = (words(rng, 60) for _ in range(4))
    rows = [(1, a), (2, changed(rng, a)), (2, b), (2, b), (3, changed(rng, b)), (None, c), (None, changed(rng, c)), (None, d), (None, None), (None, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    known = hashed(spark, [(i, t or "") for i, t in rows])
    keys = sorted({(i is not None, i or 0, h): t for i, h, t in known}.items())
    sets = {k: shingle_set(t, 2) for k, t in keys}
    first = components(sets, sets, 80)
    want = Counter((i, t) for i, h, t in known if not t or first[(i is not None, i or 0, h)] == (i is not None, i or 0, h))
    got = Counter((r["doc_id"], r["text"] or "") for r in near_dedup.drop_near_duplicates(df, words=2).collect())
    assert got == want and (2, rows[1][1]) not in got and got[(2, b)] == 2 and sum(n for (i, t), n in got.items() if i is None) == 4


def test_paragraphs_of_texts_that_share_an_id(spark):
    """No line goes from a text because another text of the same id, null or not, has lost one there."""
    rng = random.Random(16)
    x, y, z, only, kept, w = (words(rng, 30) for _ in range(6))
    rows = [(7, f"{x}\n{only}"), (7, f"{y}\n{z}"), (3, z), (None, f"{kept}\n{w}"), (None, f"{w}\n{kept} more"), (None, changed(rng, w)), (8, f"{w}\n{x}"), (8, f"{w}\n{x}")]
    known = hashed(spark, rows)
    sets = {(i is not None, i or 0, h, k): shingle_set(line, 5) for i, h, t in known for k, line in enumerate(t.split("\n"))}
    first = components(sorted(sets), sets, 80)

    def left(i, h, t):
        return "\n".join(line for k, line in enumerate(t.split("\n")) if first[(i is not None, i or 0, h, k)] == (i is not None, i or 0, h, k))

    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = paragraph_dedup.remove_paragraphs(df, paragraph_dedup.duplicate_paragraphs(df)).collect()
    assert Counter((r["doc_id"], r["kept_text"]) for r in got) == Counter((i, left(i, h, t)) for i, h, t in known)
    assert any(only in r["kept_text"] for r in got)


def test_signatures_of_many_sets():
    rng = random.Random(17)
    sets = [minmax.shingles(words(rng, n), 2) for n in (1, 2, 3, 900, 3000, 5, 700, 1, 2500, 40)]
    low, high = minmax.signatures(sets)
    for k, s in enumerate(sets):
        one = minmax.signature(s)
        assert (low[:, k] == one[0]).all() and (high[:, k] == one[1]).all()
        assert (minmax.keys_of(np.stack([low, high]), 32, 4)[k] == minmax.band_keys(s, 32, 4)).all()


def test_rare_shingles_find_every_link(spark, monkeypatch):
    """With a single round of pivots, most links come from rare shingles: a group of texts around the threshold, and a shared passage."""
    monkeypatch.setattr(minmax, "STAR_ROUNDS", 1)
    rng = random.Random(18)
    base, passage = words(rng, 60), words(rng, 30)
    rows = [(i, changed(rng, base, rng.randint(1, 9))) for i in range(150)] + [(1000 + i, f"{passage} {words(rng, rng.randint(5, 20))}") for i in range(80)]
    sets = {i: shingle_set(t, 2) for i, t in rows}
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), words=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == components(sets, sets, 80)


def test_near_duplicates_of_nothing(empty, docs_with_null):
    assert near_dedup.near_duplicates(empty).count() == 0
    out = near_dedup.near_duplicates(docs_with_null)
    assert out.count() == docs_with_null.count()
    assert near_dedup.drop_near_duplicates(docs_with_null).schema == docs_with_null.schema


def test_duplicate_paragraphs(docs, texts, empty, docs_with_null):
    removed = paragraph_dedup.duplicate_paragraphs(docs)
    got = {(r["doc_id"], r["paragraph"]): (r["first_id"], r["first_paragraph"]) for r in removed.collect()}
    sets = {}
    for i, t in texts:
        for k, line in enumerate((t or "").split("\n")):
            if len(line.encode().split()) >= 5:
                sets[i, k] = shingle_set(line, 5)
    want = {k: first for k, first in components(sets, sets, 80).items() if k != first}
    assert got == want
    lines = {r["doc_id"]: r for r in paragraph_dedup.remove_paragraphs(docs, removed).collect()}
    for i, t in texts:
        parts = (t or "").split("\n")
        assert lines[i]["kept_text"] == "\n".join(p for k, p in enumerate(parts) if (i, k) not in want)
        assert (lines[i]["n_paragraphs"], lines[i]["n_removed"]) == (len(parts), sum((i, k) in want for k in range(len(parts))))
    assert paragraph_dedup.duplicate_paragraphs(empty).count() == 0
    again = paragraph_dedup.duplicate_paragraphs(docs_with_null)
    assert paragraph_dedup.remove_paragraphs(docs_with_null, again).count() == docs_with_null.count()


# 4: repeated strings


def test_suffix_array_is_sorted():
    rng = random.Random(1)
    for k in range(600):
        n, top = rng.randint(0, 60), rng.choice([1, 2, 3, 5, 200])
        t = [rng.randint(0, top) for _ in range(n)]
        if k % 3 == 0 and n:
            t = (t[:rng.randint(1, 7)] * 60)[:n]
        assert suffix_array.suffix_array(np.array(t, dtype=np.int64)).tolist() == sorted(range(n), key=lambda i: t[i:])


def test_common_prefixes():
    rng = random.Random(2)
    data = bytes(rng.choice(b"ab") for _ in range(400))
    t = np.frombuffer(data, dtype=np.uint8).astype(np.int64) + 1
    sa = suffix_array.suffix_array(t)
    padded = data + bytes(64)
    eight = np.array([int.from_bytes(padded[i:i + 8], "little") for i in range(len(data) + 40)], dtype=np.uint64)
    got = suffix_array.common_prefixes(eight, sa, 12)
    for a, b in zip(sa, sa[1:]):
        n = 0
        while n < 12 and padded[a + n:a + n + 1] == padded[b + n:b + n + 1]:
            n += 1
        assert got[b] == n


def repeats(texts, least=100):
    first, out = set(), {}
    for i, t in sorted(texts):
        data = (t or "").encode()
        mark = bytearray(len(data))
        for x in range(len(data) - least + 1):
            s = data[x:x + least]
            if s in first:
                mark[x:x + least] = b"\1" * least
            first.add(s)
        out[i] = (
            len(data), sum(mark), [[m.start(), m.end()] for m in re.finditer(b"\1+", bytes(mark))],
            bytes(b for b, m in zip(data, mark) if not m),
        )
    return out


@pytest.mark.parametrize("per_block", [40_000, 2])
def test_repeats_are_removed(spark, texts, per_block):
    rng = random.Random(7)
    shared = words(rng, 70)
    more = [(i, words(rng, rng.randint(0, 30)) + shared[rng.randint(0, 40):rng.randint(150, 260)] + words(rng, 20)) for i in range(100, 130)]
    more += [(200, "a" * 99), (201, "a" * 99), (202, "b" * 100), (203, "b" * 100), (204, "ü" * 60 + shared[:120])]
    used = {i: t for i, t in [*texts, *more] if i != 5}
    docs = spark.createDataFrame(as_rows(list(used.items())), SCHEMA).repartition(4)
    want = repeats(used.items())
    got = suffix_dedup.remove_repeats(docs, pieces_per_block=per_block).collect()
    assert len(got) == len(used)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["spans"], bytes(r["kept"])) == want[r["doc_id"]], r["doc_id"]
        assert r["n_spans"] == len(r["spans"])


def test_repeats_with_unclear_ids(spark, empty, docs, docs_with_null):
    assert suffix_dedup.remove_repeats(empty).count() == 0
    # A null id comes first; one id with two texts are two documents; a repeated row gives an equal row.
    passage = words(random.Random(9), 60)
    rows = [(None, passage), (1, passage), (1, "other " + passage), (2, passage), (2, passage)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == sorted(
        [(0, 0), (1, len(passage)), (1, len(passage)), (2, len(passage)), (2, len(passage))]
    )
    assert suffix_dedup.remove_repeats(docs_with_null).count() == docs_with_null.count()
    assert sum(r["doc_id"] == 5 for r in suffix_dedup.remove_repeats(docs).collect()) == 2


# The pipeline


def test_pipeline_stage_by_stage(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline
    from test_text_operators import check_packing

    rng = random.Random(5)
    common = words(rng, 300, "etaoinshr").split()
    rows, toxic = [], {}
    for i in range(260):
        text = [rng.choice(common) for _ in range(rng.randint(30, 90))]
        toxic[i] = int(i % 4 == 0)
        for _ in range(toxic[i] * 5):
            text[rng.randrange(len(text))] = rng.choice(["zquag", "vuxet", "zquix"])
        rows.append((i, " ".join(text)))
    rows += [(300 + k, rows[4 * k + 1][1].upper()) for k in range(20)]
    rows += [(400 + k, rows[4 * k + 2][1] + " end") for k in range(20)]
    rows += [(500, None), (501, ""), (502, rows[1][1]), (502, rows[1][1])]
    folder = str(tmp_path)
    spark.createDataFrame(as_rows(rows), SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "MinHash near-dedup", "mixing sources to target weights", "packing"]

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        seen.append(docs)
        assert k == 4 or docs.schema == seen[0].schema
    stages = [[(r["doc_id"], r["text"], r["source"]) for r in d.collect()] for d in seen[:5]]
    # Toxic documents go, clean ones stay.
    left = Counter(i for i, _, _ in stages[1])
    assert sum(left[i] for i in toxic if toxic[i]) <= 2
    clean = [i for i in toxic if not toxic[i]]
    assert sum(left[i] for i in clean) >= len(clean) - 4
    # Exact copies: the largest id of equal texts, once.
    best = {}
    for i, t, _ in stages[1]:
        best[lowered(t)] = max(best.get(lowered(t), -1), i)
    assert sorted((i, lowered(t)) for i, t, _ in stages[2]) == sorted((i, t) for t, i in best.items())
    sets = {i: shingle_set(t or "", 5) for i, t, _ in stages[2]}
    joined = components(sets, sets, 80)
    assert sorted(i for i, _, _ in stages[3]) == sorted(i for i, first in joined.items() if i == first)
    taken = Counter(i for i, _, _ in stages[4])
    assert set(taken) <= {i for i, _, _ in stages[3]} and max(taken.values()) <= 2
    size = {i: len((t or "").split()) for i, t, _ in stages[3]}
    assert abs(sum(size[i] * n for i, n in taken.items()) - 1.5 * sum(size.values())) < 0.02 * sum(size.values())
    check_packing(seen[5].collect(), {i: t for i, t, _ in stages[4]}, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 4096)
    again = corpus_pipeline.run(spark, folder)
    assert sum(r["length"] for r in again.collect()) == sum(r["length"] for r in seen[5].collect())
