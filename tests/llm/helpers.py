"""Brute-force counterparts and odd tables."""

import hashlib

SF = "/root/testdata/sf0.001"

ODD_TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "One TWO",
    "é ü ß   \x1c 你好 <|endoftext|> <|im_end|>",
    "a" * 700,
    "word " * 400,
    "\n".join(["same line here"] * 30),
    "tail\x00nul <\\|im_sep|> &amp; |x| <|",
    "Hello's we'll  3 ½ ²  tabs\t\tend ",
    " ".join(f"w{i}" for i in range(3000)),
]


def odd_documents(spark):
    """Odd texts, repeated rows, copies under other ids, null ids, sources and languages, clashing extra columns."""
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    rows += [(100 + i, t, "en", "s1", 0) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[11], rows[11], (None, "no id at all", None, None, None), (None, None, None, None, None)]
    extra = [(*r, "x", 1, True, [1], "y", 2) for r in rows]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, "
        "component_id string, size int, kept boolean, spans array<int>, id string, n_words int"
    )
    return spark.createDataFrame(extra, schema)


def word_sets(rows, size):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(zip(*(w[k:] for k in range(size)))) if len(w) >= size else frozenset([tuple(w)] if w else [])
    return sets


def joined(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(ids)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def alike(a, b, percent):
    both = len(a & b)
    return bool(a and b) and 100 * both >= percent * (len(a) + len(b) - both)


def repeats_in_order(texts, limit):
    """Digest of op10 of texts in their order, from a set of all strings seen."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - limit + 1):
            window = data[p : p + limit]
            if window in seen:
                gone[p : p + limit] = b"\1" * limit
            seen.add(window)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repeats_by_hand(rows, limit):
    """The same by id, in order of ids."""
    rows = sorted(rows, key=lambda r: r[0])
    return dict(zip((i for i, _ in rows), repeats_in_order([t for _, t in rows], limit)))


def statistics_by_hand(text):
    from collections import Counter

    words = [w.decode() for w in (text or "").encode().split()]
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    covered = {p for k, w in enumerate(windows) if counts[w] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )
