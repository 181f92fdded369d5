"""Plain Python versions of the operators, and awkward documents to run them on."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def passage(seed, n):
    """n made-up words."""
    out, x = [], seed * 7919 + 11
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append("".join("aeioubcdfglmnprst"[(x >> (8 * k)) % 17] for k in range(2 + (x >> 50) % 7)))
    return out


def awkward_documents():
    """Rows (doc_id, text, lang, source, n_chars): nulls, empty, long, tied and repeated ones."""
    common = " ".join(passage(1, 80))
    lines = "\n".join(" ".join(passage(k, 9)) for k in range(20, 26))
    texts = [
        None, "", "   \n\t ", "one", "two words", "three words here", "Three WORDS here", "ÀÉ unaltered ÀÉ",
        common, common.upper(), common + " tail " + " ".join(passage(2, 40)), "head " + common, common, common,
        lines, lines, "x\n" + lines + "\ny", lines.replace("\n", "\n\n"), "a\nb\nc\na\nb\nc\na\nb\nc", "a" * 700, "ab" * 400, "\n" * 30,
        " ".join(passage(3, 6000)), "word " * 500, " ".join(passage(4, 300)) + " " + " ".join(passage(4, 300)), "日本語 テキスト 😀 " * 40,
        "\x1c\x85\xa0　odd spaces ’s 'll 12½²", "A  B   C\r\nD\x0bE\x0cF",
    ]
    texts += [" ".join(passage(100 + k, 60 + k)) for k in range(30)]
    texts += [" ".join(w if i != k else "changed" for i, w in enumerate(passage(50, 400))) for k in range(12)]
    rows = [(k, t, ["en", "de", None][k % 3], ["s0", "s1", "", None, "s0"][k % 5], len(t or "")) for k, t in enumerate(texts)]
    rows += [rows[8], rows[8], rows[14], (None, "no id", None, None, None), (None, common, "en", "s0", 1), (None, None, None, None, None)]
    return rows


def fingerprint(text, shingle=3):
    w = words((text or "").translate(FOLD))
    if not w:
        return 0
    parts = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, distance=3):
    """For each index the smallest index it is linked to, directly or not."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def removed(texts, length):
    """Per text (UTF-8): bytes, removed, runs, SHA-256 of the rest."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def base_rules(text):
    w = words(text)
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in lines
            lines.add(line)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """{source: target} by repeated resharing; ``sizes`` is {source: words}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), dict.fromkeys(order, 0.0)
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            out.update({s: left * weight[s] / total for s in free})
            break
        for s in over:
            out[s] = float(most * sizes[s])
            free.discard(s)
        left = share * sum(sizes.values()) - sum(out[s] for s in order if s not in free)
    return out


def cut_lines(rows):
    """{(doc_id, text): text without later three-line windows}; equal rows are one document."""
    seen = set()
    windows = defaultdict(list)
    for doc, text in rows:
        if text is None or (doc, text) in seen:
            continue
        seen.add((doc, text))
        solid = [(i, x) for i, x in enumerate(text.split("\n")) if words(x)]
        for p in range(len(solid) - 2):
            windows[tuple(x for _, x in solid[p : p + 3])].append(((doc is None, doc), solid[p][0], text, [i for i, _ in solid[p : p + 3]]))
    cut = defaultdict(set)
    for found in windows.values():
        found.sort(key=lambda f: (f[0][0], f[0][1] if f[0][1] is not None else 0, f[1]))
        for (none, doc), _, text, at in found[1:]:
            cut[(None if none else doc, text)].update(at)
    return {k: "\n".join(x for i, x in enumerate(k[1].split("\n")) if i not in cut[k]) for k in seen}
