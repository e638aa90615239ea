"""The operators again, one text at a time and without Spark."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def repeats(docs, window):
    """Per row: words, positions removed. Rows are (id, text); a null id comes last."""
    key = lambda i: (i is None, i or 0)
    first = {}
    for i, text in docs:
        w = words(text)
        for s in range(len(w) - window + 1):
            passage = tuple(w[s:s + window])
            first[passage] = min(first.get(passage, ((True, 1 << 70), 0)), (key(i), s))
    out = []
    for i, text in docs:
        w, gone = words(text), set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] != (key(i), s):
                gone.update(range(s, s + window))
        out.append((w, gone))
    return out


def digest(w, gone):
    return hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()


def cut_text(text, gone):
    """The text without the words in ``gone`` and the white space behind each."""
    if not gone:
        return text
    places = [m.start() for m in WORD.finditer(text)] + [len(text)]
    head = text[:places[0]]
    return head + "".join(text[places[j]:places[j + 1]] for j in range(len(places) - 1) if j not in gone)


def measures(text):
    w = words(text)
    runs = {}
    for s in range(len(w) - 4):
        runs.setdefault(tuple(w[s:s + 5]), []).append(s)
    repeated = {j for at in runs.values() if len(at) > 1 for s in at for j in range(s, s + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated), "n_lines": len(lines),
    }


def base_failed(m):
    return m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"]


def fingerprint(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[s:s + 3]).encode(), 42) for s in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints):
    """For each of the fingerprints the smallest position that links of three bits or fewer lead to."""
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def hits(text, items, window=13):
    w = ITEM_WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, body in items:
        p = ITEM_WORD.findall((body or "").translate(LOWER))
        m = min(window, len(p))
        for k in range(len(p) - m + 1 if m else 0):
            for s in range(len(w) - m + 1):
                if w[s:s + m] == p[k:k + m]:
                    hit.update(range(s, s + m))
                    found |= {str(item)} - {"None"}
    return len(w), len(hit), sorted(found)


def contaminated(text, items):
    n, hit, _ = hits(text, items)
    return hit > 0 and 20 * hit >= n


def lm(docs):
    """Per row: held out, tokens, known tokens, base score; and the training tokens."""
    tokens = [[*words((t or "").translate(LOWER)), None] for _, t in docs]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    single = Counter()
    for t, h in zip(tokens, held):
        if not h:
            single.update(t)
    n, kinds = sum(single.values()), len(single)
    return [
        (h, len(t), sum(single[x] > 0 for x in t), sum(math.log10((single[x] + 1) / (n + kinds + 1)) for x in t))
        for t, h in zip(tokens, held)
    ], n
