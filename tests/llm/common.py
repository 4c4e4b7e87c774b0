"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns, and plain versions of operators."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["node", "band", "size", "score", "count", "kind", "start", "range", "own", "part", "mix_size", "mix_copies", "ord", "terms", "extra", "component", "lang_pred"]
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n, letters="etaoin"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n))


def documents(n=60, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang, letters = [("en", "theandofw "), ("de", "schüngeiß"), ("fr", "éleuxoiqu")][i % 3]
        text = prose(rng, rng.randint(1, 120), letters.strip())
        if i % 7 == 3:
            text = rows[rng.randrange(len(rows))][1] or "x"
        if i % 11 == 5:
            old = (rows[rng.randrange(len(rows))][1] or "x").split(" ")
            old[rng.randrange(len(old))] = "Changed"
            text = " ".join(old)
        if i % 13 == 6:
            text = prose(rng, 5) + " " + "a passage that many documents share, of more than one hundred bytes in all, which is removed where it comes again. " + prose(rng, 5)
        rows.append((3 * i, text, lang if i % 5 else None, f"src{i % 4}" if i % 9 else None, len(text)))
    rows += [(1000, None, None, None, None), (1001, "", "en", "src0", 0), (1002, "!!! 123 ²", "en", "src1", 9), (1003, "  two  spaces and \ttab\n\n", "en", "src1", 24), (1004, prose(rng, 4000), "en", "src2", 1), (1005, "Word", "en", "😀", 4), (1006, "▁ 中文 é ​ x\x00y", None, "￿", 9)]
    rows.append(rows[4])
    return rows


def table(spark, rows, clash=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *(F.lit("clash").alias(c) for c in CLASH)) if clash else df


def shingles(text, width):
    w = WORD.findall((text or "").translate(UPPER))
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def near_components(rows, width, percent=80):
    """Least reachable doc_id of each, over all pairs."""
    sets = [(r[0], shingles(r[1], width)) for r in rows]
    root = {d: d for d, _ in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = top(a), top(b)
                root[max(p, q)] = min(p, q)
    return {d: top(d) for d, _ in sets}


def repeats(rows, span=100):
    """doc_id to (removed flags, bytes); rows are distinct by doc_id."""
    seen, out = set(), {}
    for doc_id, text in sorted((r[0], r[1]) for r in rows):
        b = (text or "").encode()
        flags = bytearray(len(b))
        for p in range(len(b) - span + 1):
            if b[p : p + span] in seen:
                flags[p : p + span] = b"\1" * span
            seen.add(b[p : p + span])
        out[doc_id] = flags, b
    return out
