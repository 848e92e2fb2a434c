"""Operators that read each text by itself, or beside its neighbour."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tremor.llm import chat, fingerprints, mixing, packing, token_counts, toxicity

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def by_id(df):
    return df.toPandas().sort_values("doc_id", kind="stable")


# 1: fingerprints


def test_edited_fingerprints(docs, texts):
    got = by_id(fingerprints.edited_fingerprints(docs))
    assert len(got) == len(texts)
    unique = {i: t or "" for i, t in texts}
    order = sorted(i for i, _ in texts)
    # Document 5 is there twice; the next of its first row is its second.
    for place, row in zip(range(len(order)), got.itertuples()):
        text, after = unique[order[place]], unique[order[(place + 1) % len(order)]]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        if row.doc_id != 5:
            assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.n_chars == len(text) and 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    prints = dict(zip(got.doc_id, got.fingerprint))
    assert prints[4] == prints[6] and prints[1] == prints[2] == prints[3] == ""
    assert len({prints[i] for i in (4, 7, 9, 11, 12, 13)}) == 6
    big = got[got.doc_id == 7].iloc[0]
    assert big.near_next > 0.9 and 0.4 < big.near_edited


UNSPACED = r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF\uFF00-\uFFEF\U00020000-\U0003FFFF]"


def brute_units(text):
    out = []
    for run in regex.split(r"[\x20\x09-\x0D]+", text):
        for part in regex.split(f"({UNSPACED}+)", run):
            spaced = not regex.match(UNSPACED, part) and len(part) <= fingerprints.WORD
            out += [part] if spaced and part else list(part)
    return out


def brute_anchors(text, spark):
    """Closed syncmers one by one, with Spark's hash."""

    def xx(rows):
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)])
        return [r[0] for r in df.orderBy("_1").select(F.xxhash64(*df.columns[1:])).collect()]

    h = xx([(u,) for u in brute_units(text)])
    m = xx(list(zip(h, h[1:])))
    out = set(xx([(m[i], m[i + 2]) for i in range(len(m) - 2) if min(m[i:i + 3]) in (m[i], m[i + 2])]))
    hashes = sorted((x % (1 << 64)) >> 16 for x in out)
    return hashes[:max(fingerprints.LEAST, sum(x < (1 << 48) / fingerprints.SCALE for x in hashes))]


@pytest.mark.parametrize("text", [
    "some words that are taken whole, and https://one.example/a-long-run-of-characters?cut=into&code=points then hashed",
    "abc漢字かな交じりの文。 mixed ไทย and 日本 words \U0001f600\U0001f600 \U00020000 é",
    " ".join(f"w{i * i % 977}" for i in range(900)),
])
def test_closed_syncmers_one_by_one(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(fingerprints.anchors(F.col("t"))).first()[0]
    assert got == brute_anchors(text, spark)


def test_units_do_not_depend_on_offsets(spark):
    """One character inserted at the front or in the middle of text without spaces."""
    rng = random.Random(3)
    for low, high in ((0x4E00, 0x9FA5), (0x21, 0x7E)):
        text = "".join(chr(rng.randint(low, high)) for _ in range(2000))
        one = chr(low + 5)
        df = spark.createDataFrame([(text, one + text, text[:1000] + one + text[1000:])], "a string, b string, c string")
        a, b, c = (fingerprints.anchors(F.col(x)) for x in "abc")
        got = df.select(fingerprints.likeness(a, b), fingerprints.likeness(a, c)).first()
        assert min(got) > 0.98


def test_likeness_is_that_of_the_fingerprints(spark):
    def brute(x, y):
        x, y = ([int(t[i:i + 12], 16) for i in range(0, len(t), 12)] for t in (x, y))
        ends = [(1 << 48) if len(t) < fingerprints.LEAST else max(t[-1], fingerprints.BELOW) for t in (x, y)]
        x, y = ({h for h in t if h <= min(ends)} for t in (x, y))
        return len(x & y) / len(x | y) if x | y else 1.0

    rng = random.Random(4)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(700)]
    rows = [(i, " ".join(base[:rng.randint(0, 120 if i % 2 else 700)] + [str(i)] * (i % 3))) for i in range(40)]
    got = by_id(fingerprints.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")))
    prints = list(got.fingerprint)
    for i, row in enumerate(got.itertuples()):
        after = prints[(i + 1) % len(prints)]
        assert row.near_edited == brute(row.fingerprint, row.edited_fingerprint)
        assert row.near_next == brute(row.fingerprint, after) and (row.near_next == 1) == (row.fingerprint == after)


def test_long_texts_by_all_anchors(spark):
    rng = random.Random(8)

    def passage(n):
        return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n)]

    base, shared = passage(20_000), passage(300)
    rows = [(1, base)] + [(k, base[:k * 2000] + passage(50) + base[k * 2000 + 50:]) for k in range(2, 8)]
    rows += [(8, passage(9_000) + shared + passage(9_000)), (9, shared + passage(18_000))]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    got = by_id(fingerprints.edited_fingerprints(df))
    assert all(0.98 < x < 1 for x in got.near_next[:6]) and got.near_next[7] > 0.003
    # A passage of fifty words changes the fingerprint, which grows with the text.
    assert len(set(got.fingerprint)) == 9 and all(len(x) > 12 * 2_000 for x in got.fingerprint)
    found = {r["doc_id"]: r["anchors"] for r in fingerprints.located_anchors(df).collect()}
    for row in found.values():
        units = [a["unit"] for a in row]
        assert units == sorted(set(units)) and len(units) > 10_000
    # The shared passage is found at its place in both.
    at = {a["hash"]: a["unit"] for a in found[8]}
    moved = Counter(at[a["hash"]] - a["unit"] for a in found[9] if a["hash"] in at)
    assert moved.most_common(1)[0][0] == 9_000 and moved[9_000] > 150


def test_fingerprints_of_nothing(empty, docs_with_null):
    assert fingerprints.edited_fingerprints(empty).count() == 0
    assert fingerprints.edited_fingerprints(docs_with_null).count() == docs_with_null.count()
    one = docs_with_null.filter("doc_id = 11")
    assert fingerprints.edited_fingerprints(one).first()["near_next"] == 1.0


# 5: toxicity


def test_gram_codes():
    codes, ends = toxicity.gram_codes(b" ab cdefg ")
    text = [c.to_bytes(5, "big").lstrip(b"\0").decode() for c in codes.tolist()]
    assert text == [" a", " ab", " ab ", " c", " cd", " cde", " cdef", "cdefg", "defg "]
    assert ends.tolist() == [False, False, True, False, False, False, False, False, True]


def test_kneser_ney_ratios(spark):
    """Against the formulas written out on a few words."""
    rows = [("aa ab", 1), ("ab ab b", 0), ("ba", 1)]
    grams = toxicity.count_grams(spark.createDataFrame(rows, "text string, toxic long"))
    counts = {r["code"]: (r["toxic_n"], r["ordinary_n"]) for r in grams.collect()}
    plain = Counter()
    for text, toxic in rows:
        for piece in toxicity.pieces_of(text):
            for code in toxicity.gram_codes(piece)[0].tolist():
                plain[code, toxic] += 1
    assert counts == {c: (plain[c, 1], plain[c, 0]) for c in {k for k, _ in plain}}
    d, mask = toxicity.DISCOUNT, (1 << 32) - 1
    lower = defaultdict(set)
    for c in counts:
        lower[c & mask].add(c)
    cont = {c: len(s) for c, s in lower.items()}
    total, kinds, byte_n = Counter(), Counter(), Counter()
    for c, n in cont.items():
        total[c >> 8] += n
        kinds[c >> 8] += 1
        byte_n[c & 255] += n
    shared = {c: (n - d + d * kinds[c >> 8] * byte_n[c & 255] / sum(byte_n.values())) / total[c >> 8] for c, n in cont.items()}

    def chance(code, k):
        same = [c for c in counts if c >> 8 == code >> 8]
        n = sum(counts[c][k] for c in same)
        weight = d * sum(counts[c][k] > 0 for c in same) / n if n else 1.0
        return (max(counts[code][k] - d, 0) / n if n else 0) + weight * shared[code & mask]

    want = {int(toxicity.slot_of(np.array([c]))[0]): np.log(chance(c, 0)) - np.log(chance(c, 1)) for c in counts}
    got = {r["slot"]: r["ratio"] for r in toxicity.log_ratios(grams).filter("kind = 0").collect()}
    assert got.keys() == want.keys()
    for slot in got:
        assert got[slot] == pytest.approx(want[slot], abs=1e-9)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    common = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    rows = []
    for i in range(700):
        text = [rng.choice(common) for _ in range(rng.randint(20, 120))]
        toxic = int(rng.random() < 0.3)
        for _ in range(toxic * 3):
            text[rng.randrange(len(text))] = rng.choice(["zquag", "VUX", "zqui"]) + rng.choice(["", "et", "on", "ash"])
        rows.append((i, " ".join(text), toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3).cache()


def test_toxicity_held_out(spark, labelled, docs_with_null, empty):
    labels = labelled.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (5000, 1), (3, None)], "doc_id long, toxic int"))
    model = toxicity.train(labelled.drop("toxic"), labels)
    got = toxicity.toxicity(labelled, model).join(labelled.select("doc_id", "toxic"), "doc_id").toPandas()
    held = got[got.held_out]
    assert set(held.doc_id) == {i for i in range(700) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert ((held.predicted == 1) == (held.toxic == 1)).mean() > 0.97
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert toxicity.toxicity(docs_with_null, model).count() == docs_with_null.count()
    assert toxicity.toxicity(empty, model).count() == 0
    kept = toxicity.drop_toxic(labelled, model)
    assert kept.schema == labelled.schema and set(kept.toPandas().doc_id) == set(got[got.predicted == 0].doc_id)
    # Held-out labels are no input: turning them round changes nothing.
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.train(labelled.drop("toxic"), turned)
    assert np.allclose(again.logistic, model.logistic) and np.array_equal(again.ratios, model.ratios)


def test_training_on_nothing(empty, labelled):
    model = toxicity.train(empty, labelled.select("doc_id", "toxic").limit(0))
    assert set(toxicity.toxicity(labelled, model).toPandas().score) == {0.5}


def test_lookup_is_exact():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 40, 300_000))
    values = rng.normal(size=len(keys)).astype(np.float32)
    table = toxicity.Lookup(keys, values)
    got, known = table(keys)
    assert known.all() and (got == values).all()
    others = np.setdiff1d(rng.integers(0, 1 << 40, 5_000_000), keys)
    assert not table(others)[1].any()
    assert not toxicity.Lookup(keys[:0], values[:0])(keys)[1].any()
    # Exact codes: no two grams share a key, however many there are.
    assert len(np.unique(toxicity.slot_of(others))) == len(others)


def test_joined_model_scores_like_a_sent_one(spark, labelled, docs):
    labels = labelled.select("doc_id", "toxic")
    sent, joined = toxicity.train(labelled, labels), toxicity.train(labelled, labels, limit=0)
    assert sent.small and not joined.small and np.allclose(sent.logistic, joined.logistic, atol=1e-4)
    joined.logistic = sent.logistic
    texts = labelled.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    a, b = (sorted(map(tuple, toxicity.toxicity(texts, m).na.fill(-1).collect())) for m in (sent, joined))
    assert [x[:2] + x[3:] for x in a] == [x[:2] + x[3:] for x in b]
    assert np.allclose([x[2] for x in a], [x[2] for x in b], atol=1e-6)
    kept = [toxicity.drop_toxic(docs, m) for m in (sent, joined)]
    assert kept[0].schema == kept[1].schema == docs.schema
    x, y = (sorted(map(repr, k.collect())) for k in kept)
    assert x == y


def test_texts_go_to_python_in_small_batches(spark, labelled, monkeypatch):
    # Ten thousand texts in one Arrow batch took hundreds of MB outside the heap of every executor, which it keeps.
    def narrow(batches, *names):
        for batch in batches:
            if batch.num_rows > 1000:
                raise ValueError(f"{batch.num_rows} rows in a batch")
            yield from zip(*[batch.column(n).to_pylist() for n in names])

    many = labelled.drop("toxic").crossJoin(spark.range(6).select(F.col("id").alias("copy"))).select(
        (F.col("copy") * 700 + F.col("doc_id")).alias("doc_id"), "text").coalesce(1).cache()
    labels = many.join(labelled.select("text", "toxic"), "text").select("doc_id", "toxic")
    scores = toxicity.toxicity(many, toxicity.train(many, labels)).toPandas()
    for module in (toxicity, packing):
        monkeypatch.setattr(module, "rows_of", narrow)
    model = toxicity.train(many, labels)
    ordinary = set(scores[scores.predicted == 0].doc_id)
    assert set(toxicity.drop_toxic(many, model).toPandas().doc_id) == ordinary and 0 < len(ordinary) < 4200
    assert packing.pack_documents(many, WORD_BPE).select("doc_id").distinct().count() == 4200
    monkeypatch.setattr(toxicity, "SMALL_ROWS", 0)  # as if the toxic texts were too many to be sent
    assert set(toxicity.drop_toxic(many, model).toPandas().doc_id) == ordinary


# 7: mixing


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mixing(docs, texts):
    got = mixing.mix(docs).toPandas().astype({"source": object})
    again = mixing.mix(docs.repartition(5)).toPandas()
    assert len(got) == len(texts)
    key = ["doc_id", "size", "hash"]
    assert got.sort_values(key).taken.tolist() == again.sort_values(key).taken.tolist()
    size = {i: len((t or "").encode().split()) for i, t in texts}
    assert all(size[r.doc_id] == r.size and r.taken in (0, r.size, 2 * r.size) for r in got.itertuples())
    total = Counter()
    for r in got.itertuples():
        total[r.source if isinstance(r.source, str) else None] += r.size
    want = brute_targets(dict(total))
    for r in got.itertuples():
        source = r.source if isinstance(r.source, str) else None
        assert r.source_size == total[source] and r.target == pytest.approx(want[source])


def test_mixing_comes_near_its_targets(spark, empty, docs_with_null):
    rng = random.Random(4)
    rows = [(i, "w " * int(rng.lognormvariate(4, 1)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(900)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), slab_documents=50).toPandas()
    for _, part in got.groupby("source", dropna=False):
        assert abs(part.taken.sum() - part.target.iloc[0]) < 0.002 * part.target.iloc[0] + 5
    # Tilted rates: within a source, copies follow the size one way.
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(docs_with_null).count() == docs_with_null.count()


def test_repeat_documents(docs):
    mixed = mixing.mix(docs)
    out = mixing.repeat_documents(docs, mixed)
    assert out.columns == docs.columns
    want = Counter()
    for r in mixed.toPandas().itertuples():
        want[r.doc_id] += r.copies
    assert Counter(out.toPandas().doc_id) == +want


# 8: packing


@pytest.fixture(scope="module")
def word_ids():
    return packing.WordIds(WORD_BPE)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcABC ,.'\n!éÀßİΣ1\x1c\xa0"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_word_ids_are_the_tokenizers(word_ids, text):
    assert word_ids.encode([text])[0].tolist() == word_ids.tokenizer.encode(text, add_special_tokens=False).ids


def test_remembered_words_are_bounded(word_ids, monkeypatch):
    """Long runs are forgotten by their length, not by their number, and give the same ids again."""
    runs = [f"{chr(97 + i)}{'Q7+/' * 5_000} word{i} again" for i in range(12)]
    want = [word_ids.tokenizer.encode(t, add_special_tokens=False).ids for t in runs]
    monkeypatch.setattr(packing, "HELD_CHARACTERS", 50_000)
    for _ in range(2):
        for text, ids in zip(runs, want):
            assert word_ids.encode([text])[0].tolist() == ids
            assert word_ids.number.characters < 50_000 + 2 * len(text)


def check_packing(rows, texts, tokenizer, capacity):
    """Every id once, sequences gapless, full or a power of two."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for key, parts in pieces.items():
        ids = np.array([*tokenizer.encode(texts[key] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        copies = Counter(r["start"] for r in parts).most_common(1)[0][1]
        assert sum(r["length"] for r in parts) == copies * len(ids)
        for r in parts:
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    assert set(pieces) == set(texts)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == capacity or (at < capacity and at & (at - 1) == 0)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing(docs, texts, word_ids, capacity):
    rows = packing.pack_documents(docs, WORD_BPE, capacity=capacity).collect()
    check_packing(rows, dict(texts), word_ids.tokenizer, capacity)


def test_packing_nothing(empty, docs_with_null):
    assert packing.pack_documents(empty, WORD_BPE).count() == 0
    assert packing.pack_documents(docs_with_null, WORD_BPE).filter("doc_id IS NULL AND start = 0").count() == 2


def test_pack_balances_cost():
    rng = random.Random(1)
    pieces = [(i, 0, rng.randint(1, 900)) for i in range(400)]
    placed, count, rest = packing.pack(pieces, 1024, True, 1.0, 1 / 1024)
    assert not rest
    cost = Counter()
    for _, _, n, s, _ in placed:
        cost[s] += n + n * n / 1024
    full = sorted(cost.values())[-(sum(p[2] for p in pieces) // 1024):]
    assert max(full) < 2.2 * min(full)


# 9: chat


def test_chat_round_trip(spark):
    ok = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "system", None), (1, 1, "user", "a\\n<|im_end|>\n<\\|x"), (1, 2, "assistant", ok), (1, 3, "user", ""), (1, 4, "assistant", "b" * 50_000),
        (2, 0, "user", "only a question"), (3, 5, None, "\\"), (3, 2, "assistant", "é<"), (3, 5, "role\nwith|<|", "x"), (None, 1, "assistant", "z"),
        (4, 0, "assistant", "first"), (4, 0, "assistant", "first"),
    ]
    turns = spark.createDataFrame([(*r, 1, "e") for r in rows], "conv_id long, turn long, role string, text string, begin long, example string").repartition(3)
    segments = chat.format_conversations(turns)
    got = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    want = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1], r[2] or "", r[3] or "")):
        want[conv].append((role or "", text or ""))
    assert got.keys() == want.keys()
    for conv, said in want.items():
        replies = "".join(t for r, t in said if r == "assistant")
        assert got[conv]["n_turns"] == len(said)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(replies), hashlib.sha256(replies.encode()).hexdigest())
    whole = {(r["conv_id"], r["example"]): r for r in chat.render(segments).collect()}
    assert set(whole) == {(c, k) for c, said in want.items() for k in range(sum(r == "assistant" for r, _ in said))}
    for (conv, k), r in whole.items():
        reply = [t for role, t in want[conv] if role == "assistant"][k]
        assert chat.unescape(r["text"][r["loss_begin"]:r["loss_end"]]) == reply
        assert r["text"].count(chat.START) == [i for i, (role, _) in enumerate(want[conv]) if role == "assistant"][k] + 1
        assert r["text"][:r["loss_begin"]].endswith(f"{chat.START}assistant\n")
    assert {c: r["n_examples"] for c, r in got.items()} == {c: sum(role == "assistant" for role, _ in said) for c, said in want.items()}
    chosen = spark.createDataFrame([(None, 0), (1, 1), (2, 0)], "conv_id long, example long")
    assert {(r["conv_id"], r["example"]) for r in chat.render(segments, chosen).collect()} == {(None, 0), (1, 1)}
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


@given(st.text(max_size=30), st.text(max_size=30))
def test_turns_read_back(role, text):
    formatted, low, high = chat.format_turn(role, text)
    assert chat.read_turn(formatted) == (role, text) and chat.unescape(formatted[low:high]) == text
    assert formatted.count(chat.START) == formatted.count(chat.END) == 1


# 10: token counts


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=4), max_size=12), st.sets(st.text("abc", min_size=1, max_size=4), max_size=12), st.text("abcd", max_size=25))
def test_automaton_is_greedy(first, later, word):
    first, later, word = {w.encode() for w in first}, {w.encode() for w in later}, word.encode()

    def greedy():
        n = at = 0
        while at < len(word):
            size = max((len(w) for w in (first if at == 0 else later) if word.startswith(w, at)), default=0)
            if not size:
                return -1
            n, at = n + 1, at + size
        return n

    if word:
        assert token_counts.Automaton(first, later).pieces(word) == greedy()


def test_token_counts(docs, texts, empty, docs_with_null):
    first, later = token_counts.read_vocabulary(PIECES)
    assert len(first) > 10_000 and len(later) > 10_000
    longest = max(map(len, first | later))

    def greedy(word):
        n = at = 0
        while at < len(word):
            pool = first if at == 0 else later
            size = next((s for s in range(min(longest, len(word) - at), 0, -1) if word[at:at + s] in pool), 0)
            if not size:
                return -1
            n, at = n + 1, at + size
        return n

    want = {}
    for i, text in texts:
        counts = [greedy(w) for w in (text or "").encode().split()]
        want[i] = (len(counts), sum(1 if c < 0 else c for c in counts), sum(c < 0 for c in counts), len((text or "").encode()))
    rows = token_counts.count_tokens(docs, PIECES).collect()
    assert len(rows) == len(texts)
    assert {r["doc_id"]: (r["n_words"], r["n_pieces"], r["n_unknown"], r["n_bytes"]) for r in rows} == want
    assert token_counts.count_tokens(empty, PIECES).count() == 0
    assert token_counts.count_tokens(docs_with_null, PIECES).filter("doc_id IS NULL").count() == 2
