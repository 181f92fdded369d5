import re
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import quality, rules
from tallyspark.llm import vectext as V

LABELS = "doc_id long, quality int, toxic int"


def labelled(n=400):
    rows, labels = [], []
    for k in range(n):
        w = brute.passage(k, 80)
        bad = k % 4 == 0
        if bad:
            w = [x.upper() + "!!" if k % 8 else x + "###" for x in w]
        rows.append((k, " ".join(w), "en", "s", 0))
        labels.append((k, 0 if bad else 1, 0))
    return rows, labels


def test_token_and_word_bounds():
    texts = ["Ab, cd!!  é1", None, "", " \n", "x"]
    data, off = V.buffer(pa.array(texts))
    start, end, at = quality.tokens(data, off)
    got = [[bytes(data[a:b]).decode() for a, b in zip(start[i:j], end[i:j], strict=True)] for i, j in zip(at, at[1:], strict=False)]
    assert got == [["Ab", ",", "cd", "!!", "é1"], [], [], [], ["x"]]
    start, end, at = V.words(data, off)
    assert np.diff(at).tolist() == [3, 0, 0, 0, 1]


def test_block_borders_do_not_matter():
    texts = [r[1] for r in brute.awkward_documents()] * 3
    whole = pa.array(texts)
    for size in (1, 50, 3000):
        f, g = [], []
        for _, _, data, off in V.blocks(whole, size):
            a, at = quality.features(data, off)
            f += [tuple(a[i:j]) for i, j in zip(at, at[1:], strict=False)]
            counts, (h, wat) = rules.measures(data, off)
            c, cat = rules.char_features(data, off, 18)
            g += [(*(int(v[k]) for v in counts.values()), tuple(h[wat[k] : wat[k + 1]]), tuple(c[cat[k] : cat[k + 1]])) for k in range(len(off) - 1)]
        if size == 1:
            first = f, g
        assert (f, g) == first
    assert [x[:5] for x in first[1]] == [brute.base_rules(t) for t in texts]
    assert first[0] == (first[0][: len(texts) // 3] * 3)


def test_ftrl_scores_by_sparse_dot_products(spark):
    rows, labels = labelled()
    docs, known = spark.createDataFrame(rows, brute.COLUMNS), spark.createDataFrame(labels, LABELS)
    w = quality.train(docs, known)
    out = {r["doc_id"]: r for r in quality.score(docs, w).collect()}
    for doc, text, *_ in rows[:40]:
        data, off = V.buffer(pa.array([text]))
        at, x = quality.counted(quality.features(data, off)[0])
        want = 1 / (1 + np.exp(-(w[at].astype(float) @ x + float(w[-1]))))
        r = out[doc]
        assert r["score"] == pytest.approx(want, abs=1e-6)
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3)
    held = [k for k, *_ in rows if out[k]["held_out"]]
    assert np.mean([out[k]["predicted"] == labels[k][1] for k in held]) > 0.95


def test_held_out_labels_are_never_read(spark):
    rows, labels = labelled(200)
    docs = spark.createDataFrame(rows, brute.COLUMNS)
    flipped = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q, t) for k, q, t in labels]
    for module in (quality, rules):
        a, b = (module.train(docs, spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
        assert (a == b).all()


def test_held_out_accuracy_on_the_given_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, known = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality.score(docs, quality.train(docs, known)).where("held_out").join(known, "doc_id")
    judged = rules.judge(docs, rules.train(docs, known)).select("_doc.doc_id", "kept", "base_failed").join(known, "doc_id")
    judged = judged.where(quality.held_out(F.col("doc_id")))
    assert scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] > 0.9
    assert judged.where("quality = 1 and not base_failed").agg(F.avg(F.col("kept").cast("double"))).first()[0] > 0.95


def test_awkward_documents(spark):
    rows = brute.awkward_documents()
    docs = spark.createDataFrame(rows, brute.COLUMNS).withColumns({"score": F.lit("clash"), "kept": F.lit(1), "n_words": F.lit(2), "a.b": F.lit(3)})
    train_rows, labels = labelled(120)
    base = spark.createDataFrame(train_rows, brute.COLUMNS)
    known = spark.createDataFrame([*labels, (1, None, 0), (None, 1, 0), (4, 0, 0), (5, 0, 0), (5, 1, 0), (10**9, 1, 1)], LABELS)
    out = quality.score(docs, quality.train(base, known)).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["held_out"] for r in out if r["doc_id"] is None)
    model = rules.train(base, known)
    judged = rules.judge(docs, model).collect()
    want = sorted(str((r[0], *brute.base_rules(r[1]))) for r in rows)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert sorted(str((r["_doc"]["doc_id"], *(r[c] for c in names))) for r in judged) == want
    for r in judged:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    kept = rules.keep_documents(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in judged)


def test_no_labels_and_empty_tables(spark):
    none, docs = spark.createDataFrame([], LABELS), spark.createDataFrame(labelled(5)[0], brute.COLUMNS)
    assert {r["score"] for r in quality.score(docs, quality.train(docs, none)).collect()} == {0.5}
    assert {r["probability"] for r in rules.judge(docs, rules.train(docs, none)).collect()} == {0.5}
    empty = spark.createDataFrame([], brute.COLUMNS)
    assert quality.score(empty, quality.train(empty, none)).collect() == []
    assert rules.judge(empty, rules.train(empty, none)).collect() == []


def plain_mix(x):
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) % 2**64
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) % 2**64
    return x ^ x >> 31


def plain_hash(raw):
    """vectext's span hash of some bytes, in Python integers."""
    h = sum(int(V._TABLE[0][c]) * pow(V._BASE[0], i, 2**64) for i, c in enumerate(raw)) % 2**64
    return plain_mix(h ^ ((len(raw) << 40) % 2**64))


def plain_char_features(text, bits=18):
    def kind(ch):
        b = ch.encode()[0]
        return 1 if ch in " \t\n\v\f\r" else 2 if 65 <= b <= 90 else 3 if 97 <= b <= 122 else 4 if 48 <= b <= 57 else 5 if b > 127 else 6

    kinds, out = [kind(c) for c in text] + [0] * 6, []
    for i in range(len(text)):
        shape = sum(kinds[i + k] * 8 ** (5 - k) for k in range(6))
        for h in (plain_hash(text[i : i + 4].encode()), plain_mix(shape + 0x5BD1E995)):
            out.append((h >> (65 - bits)) + (1 << (bits - 1)))
    return out


def test_character_features_equal_plain_python():
    texts = ["Ab 9é日本語!\n\tx", "", "x", "日", "The quick brown fox 123", "a\u0301😀😀b"]
    data, off = V.buffer(pa.array(texts))
    got, at = rules.char_features(data, off, 18)
    assert [got[i:j].tolist() for i, j in zip(at, at[1:], strict=False)] == [plain_char_features(t) for t in texts]


def test_a_shifted_text_shares_nearly_all_character_features():
    text = " ".join(brute.passage(3, 40))
    sets = [set(plain_char_features(t)) for t in (text, "é" + text, "xy" + text)]
    assert all(len(sets[0] & s) >= 0.95 * len(sets[0]) for s in sets[1:])


def plain_token_features(text, bits=18):
    out, before = [], 7
    for t in [t for w in brute.words(text) for t in re.findall("[0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff]+", w)]:
        h = plain_hash(t.encode())
        pair = 0xA5A5A5A5A5A5A5A5 if before == h else plain_mix((before * 0x9E3779B97F4A7C15 + h) % 2**64)
        out += [h >> (64 - bits), pair >> (64 - bits)]
        before = h
    return out


def test_token_features_and_ftrl_equal_plain_python():
    texts, labels = ["Ab, cd!! é1 ab ab ab", "", "one two #3", "one one two"] * 3, [1, 0, 0, 1] * 3
    data, off = V.buffer(pa.array(texts))
    got, at = quality.features(data, off)
    assert [got[i:j].tolist() for i, j in zip(at, at[1:], strict=False)] == [plain_token_features(t) for t in texts]
    model, z, n = quality.Ftrl(1 << 18), {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= model.l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * model.l1) / ((model.beta + n[i] ** 0.5) / model.alpha + model.l2)

    for t, y in zip(texts, labels, strict=True):
        found = plain_token_features(t)
        x = {f: found.count(f) / max(1, len(found)) ** 0.5 for f in found} | {1 << 18: 1.0}
        f, v = quality.counted(np.array(found, np.int32))
        model.learn(np.append(f, 1 << 18), np.append(v, 1.0), y)
        p = 1 / (1 + np.exp(-sum(weight(i) * c for i, c in x.items())))
        for i, c in x.items():
            g, old, seen = (p - y) * c, weight(i), n.get(i, 0.0)
            n[i] = seen + g * g
            z[i] = z.get(i, 0.0) + g - (n[i] ** 0.5 - seen**0.5) / model.alpha * old
    assert np.allclose(model.weights(np.array(list(z))), [weight(i) for i in z])


def test_adagrad_and_calibration_equal_plain_python():
    rng = np.random.default_rng(2)
    rows = []
    for k in range(80):
        f = rng.choice(64, size=6, replace=False).astype(np.int32)
        x = rng.random(6).astype(np.float32)
        rows.append((k, int(x[f < 32].sum() > x[f >= 32].sum()) if k % 7 else int(rng.integers(2)), f, x))
    w, bias, slope, shift = rules._fit(list(rows), 6, 2)
    want, seen, b, b_seen = [0.0] * 64, [1e-3] * 64, 0.0, 1e-3
    learn = [k for k in range(80) if k % 4]
    for epoch in range(2):
        for k in np.random.Generator(np.random.PCG64(epoch)).permutation(learn):
            _, y, f, x = rows[k]
            g = 1 / (1 + np.exp(-(sum(want[i] * v for i, v in zip(f, x, strict=True)) + b))) - y
            for i, v in zip(f, x, strict=True):
                step = g * v + 1e-6 * want[i]
                seen[i] += step * step
                want[i] -= 0.3 * step / seen[i] ** 0.5
            b_seen += g * g
            b -= 0.3 * g / b_seen**0.5
    assert np.allclose(w, want, atol=1e-4) and abs(bias - b) < 1e-4
    # The calibration is the minimum of the logistic loss on the fold: a grid around it is no better.
    fold = [rows[k] for k in range(0, 80, 4)]
    m, y = np.array([float(w[f] @ x) + bias for _, _, f, x in fold]), np.array([r[1] for r in fold], float)
    goal = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))

    def loss(a, s):
        p = 1 / (1 + np.exp(-(a * m + s)))
        return -(goal * np.log(p) + (1 - goal) * np.log(1 - p)).sum()

    assert loss(slope, shift) <= min(loss(slope + i / 50, shift + j / 50) for i in range(-5, 6) for j in range(-5, 6)) + 1e-3


def test_sample_bounds_rows_and_one_kind_gives_one_half(spark):
    rows, labels = labelled(120)
    many = [(k % 60, f"{t} {k}", *r) for k, (_, t, *r) in enumerate(rows * 5)]
    docs, known = spark.createDataFrame(many, brute.COLUMNS), spark.createDataFrame(labels, LABELS)
    for n in (7, 1000):
        taken = quality.labelled_sample(docs, known, "quality", n).collect()
        assert 0 < len(taken) == len({r["doc_id"] for r in taken}) <= n
    ones = spark.createDataFrame([(k, 1, 0) for k in range(60)], LABELS)
    assert {r["probability"] for r in rules.judge(docs, rules.train(docs, ones)).collect()} == {0.5}


def test_string_ids(spark):
    rows, labels = labelled(60)
    docs = spark.createDataFrame(rows, brute.COLUMNS).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    known = spark.createDataFrame(labels, LABELS).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    assert quality.score(docs, quality.train(docs, known)).count() == 60
    assert rules.judge(docs, rules.train(docs, known)).count() == 60


def test_long_texts_in_parts_have_the_same_features(spark):
    for text in ["Ab, cd!! é1 ab ab ab  x\n" * 40, "word" * 100, " " * 300, "a" * 90 + " " + "b!" * 200 + " c", ""]:
        data, off = V.buffer(pa.array([text]))
        want = quality.features(data, off)[0].tolist()
        for size in (1, 7, 64, 10_000):
            assert b"".join(bytes(p) for p in V.parts(data, size)) == text.encode()
            assert [f for part in quality.long_features(data, size=size) for f in part.tolist()] == want
    rows, labels = labelled(60)
    long = " ".join(brute.passage(7, 60_000))  # over one block
    docs = spark.createDataFrame([*rows, (61, long, "en", "s", 0), (62, long.upper() + "!!", "en", "s", 0)], brute.COLUMNS)
    w = quality.train(docs, spark.createDataFrame([*labels, (61, 1, 0), (62, 0, 0)], LABELS))
    data, off = V.buffer(pa.array([long]))
    assert len(data) > V.BLOCK
    at, x = quality.counted(quality.features(data, off)[0])
    score = quality.score(docs, w).where("doc_id = 61").first()["score"]
    assert score == pytest.approx(1 / (1 + np.exp(-(w[at].astype(float) @ x + float(w[-1])))), abs=1e-6)


def test_fifty_megabytes_within_five_hundred():
    import tracemalloc

    data = np.frombuffer(b"some words, of 12 letters! " * 1_900_000, dtype=np.uint8)
    tracemalloc.start()
    n = sum(len(f) for f in quality.long_features(data))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 20_000_000 and peak < 500 << 20
