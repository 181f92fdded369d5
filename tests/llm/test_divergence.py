import re
from collections import Counter

import brute
import pytest
from oracle_harness import compare

from tallyspark.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_audit(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(brute.FOLD)))) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen, occurs, by_source = Counter(), Counter(), {}
        for at, source, terms in docs:
            if at == lang:
                seen.update(terms.keys())
                by_source.setdefault(source, Counter()).update(terms)
        kept = {t for t, n in seen.items() if n >= min_docs}
        for c in by_source.values():
            occurs.update({t: n for t, n in c.items() if t in kept})

        def shares(c):
            total = sum(c[x] for x in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p = {s: shares(c) for s, c in by_source.items()}
        q = shares(occurs)
        for s in by_source:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in by_source if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if by_source[s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:limit])]
    return sorted(out)


def awkward(spark):
    rows = brute.awkward_documents()
    long = "q" * 3000
    rows += [(900 + k, f"{long} {long}{'r' * (k % 2)} Straße naïve STRASSE don't", "en", f"s{k % 3}", 0) for k in range(7)]
    rows += [(950 + k, f"only{k}", "zz", f"s{k}", 0) for k in range(4)] + [(960, "123 ...", "yy", "a", 0), (961, None, "yy", "b", 0)]
    docs = spark.createDataFrame(rows, brute.COLUMNS)
    return rows, docs.selectExpr("*", "1 AS item", "'x' AS rank", "2 AS `a.b`", "3 AS p0", "4 AS v")


@pytest.mark.parametrize(("min_docs", "first", "bits", "block", "top"), [(3, 4, 1 << 26, 512, 200), (3, 1, 1 << 15, 3, 5), (2, 64, 1 << 18, 40, 200), (5, 2, 1 << 17, 7, 200)])
def test_equals_brute_force(spark, min_docs, first, bits, block, top):
    rows, docs = awkward(spark)
    got = sorted(map(tuple, divergence.audit(docs, min_docs, top, first, bits, block).select("lang", "source", "part", "item", "value", "rank").collect()))
    assert got == brute_audit(rows, min_docs, top) and got


def test_prefixes_are_discarded_level_by_level(spark):
    """Each level's state holds only longer terms whose prefix reaches the threshold."""
    texts = ["alphabet alphanumeric rare" + str(k) for k in range(4)] + ["almanac", "albatross rarity rarely"]
    docs = spark.createDataFrame([(k, t.replace("0", "zero"), "en", "s", 0) for k, t in enumerate(texts)], brute.COLUMNS)
    state = divergence._as_rows(docs)
    counts = {(bytes(r["item"]), r["complete"]): r["docs"] for r in divergence.level_counts(state, 4).collect()}
    # A document with two terms of a prefix counts once; the term "rare" itself is no longer term of its prefix.
    assert counts[b"alph", False] == 4 and counts[b"alma", False] == 1 and counts[b"rare", True] == 3 and counts[b"rare", False] == 2
    alive = divergence.alive_bits(divergence.level_counts(state, 4).where("not complete and docs >= 3"), 1 << 20)
    left = {w for r in divergence.refine(state, alive, 1 << 20, 4).collect() for w in bytes(r["text"]).split()}
    assert left == {b"alphabet", b"alphanumeric"}


def test_long_texts_are_cut_between_terms():
    text = b"Ab1cd " * 700_000 + b"z" * 3_000_000 + b" end"
    parts = list(divergence.words(text))
    assert len(parts) > 3 and Counter(w for p in parts for w in p) == {b"ab": 700_000, b"cd": 700_000, b"z" * 3_000_000: 1, b"end": 1}
    assert list(divergence.words(b"")) == [[]]


def test_counts_are_flushed(spark, monkeypatch):
    rows, docs = awkward(spark)
    monkeypatch.setattr(divergence, "ENTRIES", 1)
    state = divergence._as_rows(docs)
    want = {tuple(r) for r in divergence.level_counts(state, 6).collect()}
    monkeypatch.undo()
    assert want == {tuple(r) for r in divergence.level_counts(state, 6).collect()}


def test_a_block_is_counted_at_once():
    """A block's terms leave it once a (lang, source) and its prefixes once a language, with documents and occurrences."""
    texts = ["a bb a ccccdd", "bb ccccdd cccc ccccee", "", "a é ccccee a", "ééé bb", "a"]
    groups = [("en", "s"), ("en", "t"), ("en", "u"), ("en", "s"), ("de", "s"), ("", "")]
    split = [list(divergence.words(t.encode())) for t in texts]
    want = {}
    for (lang, source), parts in zip(groups, split, strict=True):
        own = Counter(w for p in parts for w in p)
        for key, n in [((lang, source, w, True), n) for w, n in own.items() if len(w) <= 4] + [((lang, None, w, False), 0) for w in {w[:4] for w in own if len(w) > 4}]:
            d, o = want.get(key, (0, 0))
            want[key] = (d + 1, o + n)
    sizes = [sum(map(len, parts)) for parts in split]
    batches = divergence._block_counts([divergence.pa.array(p, divergence.pa.binary()) for parts in split for p in parts], sizes, groups, 4)
    got = [tuple(r.values()) for b in batches for r in b.to_pylist()]
    assert len(got) == len(want) and {r[:4]: r[4:] for r in got} == want


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], brute.COLUMNS)).collect() == []


def test_matches_sql(spark, con, sf_dir):
    ok, msg = compare(queries.op11_source_divergence(spark, sf_dir), con, divergence.SQL)
    assert ok, msg
