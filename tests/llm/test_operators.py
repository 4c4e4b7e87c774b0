"""Operators of the llm folder against plain versions, on tables with nulls, ties, repeated rows and clashing columns."""

import hashlib
import os
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratacloud.llm import imatch, langid, license_scan, mixing, near_dedup, pieces, suffix_dedup, token_output, topk, url_filter
from stratacloud.llm import collection_bwt
from stratacloud.llm import common as llm_common
from stratacloud.llm.anchors import longer_gram
from stratacloud.llm.collection_bwt import Strings, collection_suffixes, repeated_windows
from stratacloud.llm.common import range_of
from stratacloud.llm.components import connected_components
from stratacloud.llm.queries import URL_RULES

from . import common as T

tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def rows():
    return T.documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return T.table(spark, rows, clash=True).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return T.table(spark, [], clash=True)


# 1


def test_language(docs, rows):
    out = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert len(out) == len({r[0] for r in rows})
    for r in rows:
        got = out[r[0]]
        assert got.held_out == (zlib.crc32(str(r[0]).encode()) % 4 == 2) and 0 <= got.score <= 1
        assert (got.lang_pred == "und") == (not any(c.isalpha() for c in r[1] or ""))
    known = [r for r in rows if r[2] and r[1] and len(r[1]) > 200 and r[0] % 3 == 0 and r[0] < 1000 and (r[0] // 3) % 7 != 3 and (r[0] // 3) % 11 != 5 and (r[0] // 3) % 13 != 6]
    assert np.mean([out[r[0]].lang_pred == r[2] for r in known]) > 0.95


def test_language_scores_are_naive_bayes():
    matrix = np.random.default_rng(0).normal(size=(3, (1 << langid.BUCKETS_LOG2) + 2)).astype(np.float32)
    matrix[:, -2] = 0
    texts = [t.encode() for t in ("Abc dé", "x", "", "zz zz")]
    joint = langid.score_texts(texts, matrix)
    for k, t in enumerate(texts):
        buckets, _ = langid.gram_buckets([t])
        want = matrix[:, -1].astype(float) + sum(matrix[:, b].astype(float).sum(axis=1) for b in buckets)
        assert np.allclose(joint[k], want)


def test_language_degenerate(spark, empty):
    assert langid.identify(empty).count() == 0
    assert [r.lang_pred for r in langid.identify(T.table(spark, [(1, "text", None, None, 4), (None, "more", "en", None, 4)])).collect()] == ["und", "und"]


def test_language_of_many_labels(spark, monkeypatch):
    """300 labels, one letter pair each, and a bound that they exceed."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda k: letters[k // 26] + letters[k % 26]
    rows = [(3000 * c + k, f"{word(k)}{word(k)} " * 30, f"l{k:03}", None, 0) for k in range(300) for c in range(3)]
    out = {r.doc_id: r for r in langid.identify(T.table(spark, rows).repartition(4)).collect()}
    assert np.mean([out[r[0]].lang_pred == r[2] for r in rows]) > 0.9 and len({r.lang_pred for r in out.values()}) > 280
    monkeypatch.setattr(langid, "MATRIX_BYTES", 100 * 4 * ((1 << langid.BUCKETS_LOG2) + 2))
    with pytest.raises(ValueError):
        langid.identify(T.table(spark, rows))


def test_language_training_counts(spark, rows, monkeypatch):
    """The matrix from plain counts over all documents that may be learned from; languages are gathered two at a time."""
    monkeypatch.setattr(langid, "TOGETHER", 2)
    langs, matrix = langid.train(T.table(spark, rows).repartition(3))
    learn = [r for r in rows if r[2] and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2]
    assert langs == sorted({r[2] for r in learn})
    for lang, row in zip(langs, matrix, strict=True):
        own = [r[1].encode() for r in learn if r[2] == lang]
        counts = np.full(1 << langid.BUCKETS_LOG2, langid.SMOOTHING)
        for t in own:
            for buckets in langid.gram_buckets([t])[0]:
                for x in buckets[buckets < len(counts)]:
                    counts[x] += 1
        assert np.allclose(row[:-2], np.log(counts / counts.sum()), atol=1e-5) and row[-2] == 0 and row[-1] == pytest.approx(np.log(len(own) / len(learn)))


# 2


def test_imatch(docs, rows):
    out = sorted(imatch.fingerprint_edits(docs).collect(), key=lambda r: r.doc_id)
    ordered = sorted(((r[0], r[1] or "") for r in rows))
    assert [r.doc_id for r in out] == [d for d, _ in ordered]
    seen = {}
    for k, (r, (_, text)) in enumerate(zip(out, ordered, strict=True)):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and seen.setdefault(text, r.fingerprint) == r.fingerprint
        if edited == text:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
    assert np.mean([r.near_edited for r in out]) > np.mean([r.near_next for r in out])


def test_imatch_degenerate(spark, empty):
    assert imatch.fingerprint_edits(empty).count() == 0
    r = imatch.fingerprint_edits(T.table(spark, [(5, "one two", None, None, 7)])).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"one one").hexdigest()
    two = imatch.fingerprint_edits(T.table(spark, [(None, "a b", None, None, 3), (5, None, None, None, 0), (5, "c d", None, None, 3)])).collect()
    assert len(two) == 3


def plain_fingerprints(texts, band):
    """Of each text the whole list's hash and the sub-lexicons' hashes, from document frequencies over texts."""
    import regex
    import xxhash

    signed = lambda x: x - (1 << 64) if x >> 63 else x
    words = [{signed(xxhash.xxh64(w, seed=42).intdigest()) for w in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if w} for t in texts]
    low, high = len(texts) * np.exp(-band[1]), len(texts) * np.exp(-band[0])
    df: dict = {}
    for own in words:
        for w in own:
            df[w] = df.get(w, 0) + 1

    def hashed(listed):
        h = 42
        for t in sorted(listed):
            h = xxhash.xxh64((t % (1 << 64)).to_bytes(8, "little"), seed=h).intdigest()
        return h

    def of(text):
        own = {signed(xxhash.xxh64(w, seed=42).intdigest()) for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w}
        listed = {t for t in own if low <= df.get(t, 0) <= high} or own
        out = [f"{hashed(listed) if listed else xxhash.xxh64(text, seed=42).intdigest():x}"]
        for f in range(imatch.FAMILIES):
            for d in imatch.DEPTHS:
                mask = sum(1 << (imatch.BITS * f + k) % 64 for k in range(d))
                left = [t for t in listed if t & mask == mask & imatch.SEED]
                out.append(f"{hashed(left) >> 32:x}" if left else "-")
        return out

    return of


def plain_likeness(a, b):
    if a[0] == b[0]:
        return 1.0
    either = sum(x != "-" or y != "-" for x, y in zip(a[1:], b[1:]))
    return sum(x == y != "-" for x, y in zip(a[1:], b[1:])) / either if either else 0.0


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_imatch_against_plain(docs, rows, monkeypatch, most):
    """With the lexicon in the tasks and with the joined one; the band's edges are met exactly."""
    monkeypatch.setattr(imatch, "LEXICON_TERMS", most)
    ordered = sorted(((r[0], r[1] or "") for r in rows))
    n = len(ordered)
    band = (np.log(n / 8) - 1e-9, np.log(n / 2) + 1e-9)
    of = plain_fingerprints([t for _, t in ordered], band)
    out = sorted(imatch.fingerprint_edits(docs, band).collect(), key=lambda r: (r.doc_id, r.fingerprint))
    for k, (r, (doc_id, text)) in enumerate(zip(out, ordered, strict=True)):
        following = ordered[(k + 1) % n][1]
        half = len(text) // 2
        own, edited, after = of(text), of(text[: len(text) - half] + following[:half]), of(following)
        assert (r.doc_id, r.fingerprint, r.edited_fingerprint) == (doc_id, ".".join(own), ".".join(edited))
        assert r.near_edited == pytest.approx(plain_likeness(own, edited)) and r.near_next == pytest.approx(plain_likeness(own, after))
    assert len({r.near_edited for r in out}) > 10


def test_imatch_lexicon(spark):
    t = T.table(spark, [(i, f"every word{i} {'half' if i % 2 else ''}", None, None, 0) for i in range(10)])
    assert imatch.lexicon(t, (0.1, 1.5)).count() == 1  # only "half" is neither in all nor in one
    members = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000)
    tables, rest = imatch.hash_tables(members)
    found = [x for table in tables for x in table if x is not None]
    assert sorted([*found, *rest]) == sorted(members) and len(rest) < 50
    assert [len(t) for t in imatch.hash_tables(np.zeros(0, np.int64))[0]] == [2] * imatch.LEVELS


# 3


def test_urls(spark):
    pages = [(1, "http://A.Example.com/en/x?q", None), (2, "https://www.example.com/en/", ""), (3, "http://x.net/es/1", '<a href="http://bad.org/">'), (4, "nohost", None), (5, None, None), (6, "http://linker.org/a", "<a HREF='https://x.net/es/1'>" * 3), (7, "http://good.org", None), (8, "http://c.com", '<a href="//good.org/x">'), (9, "http://com/#a", None), (9, "http://com/#a", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("rule", F.lit("clash")).withColumn("host", F.lit("clash"))
    out = {r.page_id: r for r in url_filter.filter_urls(df, URL_RULES).collect()}
    assert (out[1].host, out[1].path, out[1].rule, out[1].verdict) == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert out[2].rule == "www.example.com/en/" and out[3].verdict == "block" and (out[4].host, out[4].path, out[4].rule) == ("", "", None) and out[5].host == ""
    assert out[6].verdict == "block" and out[7].verdict == "allow" and out[8].rule is None and out[9].rule == "com/"
    assert url_filter.filter_urls(df.limit(0), URL_RULES).count() == 0


def test_blocked_host_with_many_linkers(spark):
    link = lambda h: f'<a href="http://{h}/">'
    pages = [(0, "http://x.net/es/1", None), *((k, f"http://only{k}.org/", link("x.net")) for k in range(1, 30)), (30, "http://some.org/", link("x.net") + link("good.org") * 3), (31, "http://second.org/", link("only1.org")), (32, "http://good.org/", None)]
    verdicts = [{r.host: r.verdict for r in url_filter.filter_urls(spark.createDataFrame(p, "page_id long, url string, html string"), URL_RULES).collect()} for p in (pages, [pages[0], pages[1], *pages[-3:]])]
    assert all(verdicts[0][f"only{k}.org"] == "block" for k in range(1, 30)) and verdicts[0]["some.org"] == verdicts[0]["good.org"] == "allow"
    assert all(verdicts[0][h] == v for h, v in verdicts[1].items())


def test_rank_against_dense(spark):
    rng = random.Random(4)
    edges = [(a, b, rng.randint(1, 3)) for a in "abcdefg" for b in "abcdefg" if a != b and rng.random() < 0.4]
    got = {r.host: r.score for r in url_filter.personalised_rank(spark.createDataFrame(edges, "src string, dst string, n long"), spark.createDataFrame([("a", 1.0), ("b", 0.5)], "host string, seed double")).collect()}
    names = "abcdefg"
    m = np.zeros((7, 7))
    for a, b, n in edges:
        m[names.index(b), names.index(a)] += n / sum(e[2] for e in edges if e[0] == a)
    want = np.linalg.solve(np.eye(7) - 0.85 * m, 0.15 * np.array([1, 0.5, 0, 0, 0, 0, 0]))
    assert all(abs(got.get(h, 0) - w) < 1e-5 for h, w in zip(names, want))


def test_rank_of_a_long_ring(spark):
    """A ring passes everything on: twenty rounds would leave a share of 0.85 ** 20 unsettled."""
    edges = [(f"h{k}", f"h{(k + 1) % 3}", 1) for k in range(3)]
    got = {r.host: r.score for r in url_filter.personalised_rank(spark.createDataFrame(edges, "src string, dst string, n long"), spark.createDataFrame([("h0", 1.0)], "host string, seed double")).collect()}
    assert all(got[f"h{k}"] == pytest.approx(0.15 * 0.85**k / (1 - 0.85**3), abs=1e-5) for k in range(3))


def test_urls_against_plain(spark):
    """Verdicts of all pages of a random graph with a hot host, from dense linear equations."""
    rng = random.Random(12)
    hosts = [f"h{k}.org" for k in range(25)] + ["a.com", "b.com", "x.net", "y.net", "example.com"]
    pages = []
    for k in range(260):
        host = "h0.org" if k % 3 == 0 else rng.choice(hosts)
        path = rng.choice(["/", "/es/a", "/fr/b", "/en/c", ""])
        links = "".join(rng.choice([f'<a href="http://{h.upper()}/z">', f"<A HREF=//{h}>", f"<link href='https://{h}?q'>", '<a href="/here">']) for h in rng.choices(hosts, k=rng.randint(0, 4)))
        pages.append((None if k == 7 else k, f"http://{host}{path}", links if k % 11 else None))
    out = url_filter.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), URL_RULES).collect()
    import re

    rules, n = sorted(URL_RULES, key=lambda r: -len(r[1])), len(hosts)
    place = {h: k for k, h in enumerate(hosts)}
    links, seeds, judged = np.zeros((n, n)), np.zeros((n, 3)), []
    for page_id, url, html in pages:
        host, _, path = url[7:].partition("/")
        path = "/" + path if "/" in url[7:] else ""
        verdict, rule = next(((v, r) for v, r in rules if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])), (None, None))
        judged.append((page_id, host, path, rule, verdict))
        seeds[place[host]] += (verdict == "allow", verdict == "block", 1)
        for h in re.findall(r"(?i)href=[\"']?(?:https?:)?//([^/?\"'>]+)", html or ""):
            if (to := h.lower()) != host:
                links[place[host], place[to]] += 1
    share = links / np.maximum(links.sum(axis=1, keepdims=True), 1)
    allow, block = (seeds[:, k] / np.maximum(seeds[:, 2], 1) for k in (0, 1))
    trust = np.linalg.solve(np.eye(n) - 0.85 * share.T, 0.15 * allow)
    distrust = np.linalg.solve(np.eye(n) - 0.85 * share, 0.15 * block)
    blocked = (distrust > trust) & (distrust > 0.5 * 0.15)
    want = [(i, h, p, r, v or ("block" if blocked[place[h]] else "allow")) for i, h, p, r, v in judged]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)
    assert {v for _, h, _, r, v in want if r is None} == {"allow", "block"}


# 4


@pytest.mark.parametrize("n", [0, 5, 60, 300])
@pytest.mark.parametrize("block", [1 << 20, 7])
def test_collection_suffixes(monkeypatch, n, block):
    """Blocks of a few rows and files on disk give what one block in memory does."""
    monkeypatch.setattr(collection_bwt, "BLOCK", block)
    monkeypatch.setattr(collection_bwt, "FILE_BYTES", 32 << 20 if block > 7 else 100)
    rng = random.Random(n)
    strings = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(0, 14))) for _ in range(n)]
    string, start, front, common = collection_suffixes(strings)
    want = sorted(((s[k:], i, k) for i, s in enumerate(strings) for k in range(len(s) + 1)), key=lambda x: (x[0], x[1]))
    assert [(strings[i][k:], i, k) for i, k in zip(string, start)] == want
    assert all((strings[i][k - 1] if k else -1) == f for i, k, f in zip(string, start, front))
    shared = lambda a, b: next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    assert common[1:].tolist() == [shared(a[0], b[0]) for a, b in zip(want, want[1:])]


def test_repeated_windows():
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(40)]
    windows = np.array([max(0, len(s) - 3) for s in strings])
    seen, want = set(), []
    for s in strings:
        for k in range(len(s) - 3):
            want.append(s[k : k + 4] in seen)
            seen.add(s[k : k + 4])
    assert repeated_windows(Strings.of(strings), windows, 4).tolist() == want and not len(repeated_windows(Strings.of([]), np.zeros(0, int), 4))


def test_one_key_of_very_many_strings(monkeypatch):
    """200,000 strings of one key, which differ beyond it: files go to disk, memory stays near the strings' own size."""
    import pyarrow as pa
    import resource

    monkeypatch.setattr(collection_bwt, "FILE_BYTES", 1 << 20)
    rng = np.random.default_rng(3)
    n, gram = 200_000, longer_gram(100)
    data = rng.integers(97, 101, (n, 115), dtype=np.uint8)
    data[:, 20 : 20 + gram] = rng.integers(97, 123, gram, dtype=np.uint8)
    data[1::1000, :] = data[0, :]
    strings = pa.table({"key": pa.array(np.ones(n, np.int64)), "doc": pa.array(np.arange(n)), "tie": pa.array(np.zeros(n, np.int64)), "start": pa.array(np.zeros(n, np.int32)), "count": pa.array(np.full(n, 16, np.int16)), "place": pa.array(np.full(n, 20, np.int16)), "bytes": pa.array([x.tobytes() for x in data], pa.binary())})
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    out = suffix_dedup.repeated_runs(strings, 100).to_pydict()
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 600 << 10
    seen, want = set(), []
    for k in range(n):
        text = data[k].tobytes()
        flags = []
        for w in range(16):
            flags.append(text[w : w + 100] in seen)
            seen.add(text[w : w + 100])
        want += [(k, w) for w in range(16) if flags[w]]
    got = [(d, w) for d, s, c in zip(out["doc"], out["start"], out["count"], strict=True) for w in range(s, s + c)]
    assert sorted(got) == want and len(want) > 3000


def test_ranges(spark):
    bounds = np.array([-5, 0, 3, 10], np.int64)
    df = spark.createDataFrame([(v,) for v in (-9, -5, -1, 0, 3, 9, 10, 99, None)], "v long")
    assert [r[0] for r in df.select(range_of(F.col("v"), bounds)).collect()] == [0, 1, 1, 2, 3, 3, 4, 4, 0]


@pytest.mark.parametrize("span", [40, 100])
def test_suffix_dedup(spark, rows, span):
    distinct = list({r[0]: r for r in rows}.values())
    want = T.repeats(distinct, span)
    out = suffix_dedup.remove_repeats(T.table(spark, distinct, clash=True).repartition(5), span, keep=["lang", "extra"]).collect()
    assert len(out) == len(distinct)
    for r in out:
        flags, b = want[r.doc_id]
        kept = bytes(c for c, f in zip(b, flags) if not f)
        spans = sum(1 for j in range(len(flags)) if flags[j] and not (j and flags[j - 1]))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), sum(flags), spans, hashlib.sha256(kept).hexdigest())
        assert r.extra == "clash"
    assert sum(r.n_removed for r in out)


def test_suffix_dedup_degenerate(spark, empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0
    same = [(7, "y" * 150, None, None, 150)] * 2 + [(None, "z" * 120, None, None, 0)]
    out = sorted((r.doc_id or 0, r.n_removed) for r in suffix_dedup.remove_repeats(T.table(spark, same)).collect())
    assert out == [(0, 119), (7, 149), (7, 149)]  # the first byte starts no repeat


def test_suffix_dedup_leaves_no_candidates_on_disk(spark):
    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffled = lambda: {f for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")}
    key, before, rows = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffled(), T.documents(200)[:-1]
    setting = spark.conf.get(key, None)
    out = suffix_dedup.remove_repeats(T.table(spark, rows))
    ends = time.monotonic() + 10
    while (left := shuffled() - before) and time.monotonic() < ends:
        time.sleep(0.1)
    assert not left and spark.conf.get(key, None) == setting
    want = {d: sum(flags) for d, (flags, _) in T.repeats(rows).items()}
    assert {r.doc_id: r.n_removed for r in out.collect()} == want and sum(want.values())


def test_suffix_dedup_tiny_collections(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "COLLECTION", 4)
    rng = random.Random(9)
    base = [T.prose(rng, 60) for _ in range(3)]
    rows = [(i, base[i % 3][: rng.randint(80, 300)] + " " + base[(i + 1) % 3][rng.randint(0, 60) :], None, None, 0) for i in range(25)]
    want = T.repeats(rows)
    for r in suffix_dedup.remove_repeats(T.table(spark, rows)).collect():
        assert r.n_removed == sum(want[r.doc_id][0])


# 5


def test_pieces(docs, rows):
    import sentencepiece

    path = tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out = {}
    for r in pieces.encode_pieces(docs, path).collect():
        out[r.doc_id] = r
    for r in rows:
        ids = sp.encode(r[1] or "", add_eos=True)
        got = out[r[0]]
        assert got.ids == ids and got.decoded == sp.decode(ids) and got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        raw = (r[1] or "").encode()
        assert len(got.begins) == len(ids) - 1
        if raw:
            assert got.begins[0] == 0 and got.ends[-1] == len(raw) and all(a == b for a, b in zip(got.begins[1:], got.ends))


def test_pieces_odd_texts():
    coder = pieces.piece_coder(tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(2)
    parts = ["a", "b", " ", "\n", "é", "�", "▁", "\x00", "中", "😀", "the", "  ", "<s>", "</s>", "<0x41>", "​", "﻿"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        _, ids, widths = coder.encode(t)
        assert ids == coder.library.encode(t)
        coder.spans(t.encode(), widths)


def test_character_map():
    # a trie over "a" -> "bb" and "ab" -> "c": units at offset xor label
    units = [0] * 1024
    root = 256
    units[0] = root << 10

    def put(parent_base, byte, base, value=None):
        at = parent_base ^ byte
        units[at] = byte | ((at ^ base) << 10) | (256 if value is not None else 0)
        if value is not None:
            units[base] = value | 1 << 31

    put(root, ord("a"), 512, 0)
    put(512, ord("b"), 640, 3)
    import struct

    blob = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + b"bb\0c\0"
    chars = pieces.CharMap(blob)
    assert chars.longest(b"abx", 0) == (2, b"c") and chars.longest(b"ax", 0) == (1, b"bb") and chars.longest(b"x", 0) is None

    class Spec:
        precompiled_charsmap, add_dummy_prefix, remove_extra_whitespaces, escape_whitespaces = blob, True, True, True

    text, source = pieces.Normaliser(Spec, False)("  ab  aé ".encode())
    assert text.decode() == "▁c▁bbé" and source.tolist() == [2, 2, 2, 2, 4, 4, 4, 6, 6, 7, 7, 10]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("prefix, escape, squeeze", [(False, False, False), (True, True, True), (True, False, True), (False, True, False)])
def test_normaliser_against_library(rule, prefix, escape, squeeze):
    """The library's own compiled maps: long replacements, combining marks, removed characters, white space of all kinds."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=escape, remove_extra_whitespaces=squeeze)
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(library.serialized_model_proto())
    own, rng = pieces.Normaliser(model.normalizer_spec, False), random.Random(5)
    assert own.map.units and not own.plain
    parts = ["a", "B", " ", "  ", "Ａ", "ﬁ", "é", "e\u0301", "①", "㈱", "ﷺ", "\t", "\n", "　", "ß", "Ⅷ", "½", "가", "\u1100\u1161", "\u200b", "\xad", "İ", "ﾊ\uff9f", "中", "😀", "\xa0", "▁", "\x00"]
    for _ in range(1500):
        raw = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        text, source = own(raw.encode())
        assert text.decode() == library.normalize(raw)
        assert len(source) == len(text) + 1 and (np.diff(source) >= 0).all() and (not len(text) or 0 <= source[0] and source[-1] <= len(raw.encode()))


# 6


def test_mixing(docs, rows):
    out = mixing.mix_sources(docs, F.col("ord") % 3 + 1, 3.0).collect()
    assert len(out) == len(rows)
    sizes: dict = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(T.WORD.findall(r[1] or ""))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, left, total = {}, set(names), sum(sizes.values())
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * level > 3 * sizes[s]}
        if not over:
            target |= {s: weight[s] * level for s in left}
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= over
    taken: dict = {}
    for r in out:
        assert r.mix_size == len(T.WORD.findall(r.text or "")) and r.mix_source_size == sizes[r.source] and abs(r.mix_target - target[r.source]) < 1e-6
        assert 0 <= r.mix_copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.mix_copies * r.mix_size
    biggest = {s: max(len(T.WORD.findall(r[1] or "")) for r in rows if r[3] == s) for s in names}
    assert all(abs(taken[s] - target[s]) <= 2 * biggest[s] for s in names)
    again = {r.doc_id: r.mix_copies for r in mixing.mix_sources(docs.repartition(2), F.col("ord") % 3 + 1, 3.0).collect()}
    assert again == {r.doc_id: r.mix_copies for r in out}


def test_mixing_degenerate(spark, empty):
    assert mixing.mix_sources(empty, F.lit(1)).count() == 0
    out = mixing.mix_sources(T.table(spark, [(1, None, None, None, 0), (2, "", "a", "s", 0)]), F.lit(1)).collect()
    assert [r.mix_copies for r in out] == [0, 0]
    m = mixing.mix_sources(T.table(spark, [(1, "a b", None, "s", 0)]), F.lit(1))
    assert mixing.repeat_rows(m, ["doc_id"]).count() == 1


def test_mixing_without_ids(spark):
    """A source of null ids comes near its target: its documents are not one place."""
    rows = [(None, T.prose(random.Random(k), 20), None, "a", 0) for k in range(60)] + [(k, "w " * 50, None, "b", 0) for k in range(60)]
    out = mixing.mix_sources(T.table(spark, rows).repartition(3), F.col("ord") % 3 + 1).collect()
    taken = sum(r.mix_size * r.mix_copies for r in out if r.source == "a")
    target = next(r.mix_target for r in out if r.source == "a")
    assert abs(taken - target) <= 10 and 0 < target < 1200 * 3


# 7


def test_licenses(spark, docs, rows):
    import duckdb
    import pandas as pd

    texts = ["Hello. Licensed under the Apache License, Version 2.0.", "// Released under the MIT License.\nx", "This work is licensed under the GNU General Public License, version 3. Released under the mit license!", "licensed under nothing", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."]
    extra = [(2000 + k, t, None, None, 0) for k, t in enumerate(texts)]
    got = {r.doc_id: r for r in license_scan.scan_licenses(T.table(spark, rows + extra, clash=True)).collect()}
    assert [got[2000 + k].licenses for k in range(5)] == ["Apache-2.0", "MIT", "MIT,GPL-3.0", "", ""] and got[2004].n_known == 1
    documents = pd.DataFrame([r[:2] for r in rows + extra], columns=["doc_id", "text"])  # noqa: F841
    want = duckdb.sql(license_scan.scan_sql()).df().drop_duplicates()
    assert {tuple(r) for r in want.itertuples(index=False)} == {tuple(r) for r in got.values()}


APACHE = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.
"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
"""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""


def test_standard_licenses(spark):
    """Texts and headers as they are published, plain, commented and unwrapped, and tags and notices of one line."""
    comment = lambda lead: lambda t: "".join(f"{lead} {x}\n" for x in t.splitlines())
    unwrapped = lambda t: "\n\n".join(" ".join(x.split()) for x in t.split("\n\n"))
    wanted = [(APACHE, "Apache-2.0"), (MIT, "MIT"), (BSD2, "BSD-2-Clause"), (BSD3, "BSD-3-Clause"), (BSD3.replace("the copyright holder", "Some Company, Inc"), "BSD-3-Clause"), (GPL2, "GPL-2.0-or-later"), (GPL3, "GPL-3.0-or-later"), (LGPL, "LGPL-2.1-or-later"), (MPL, "MPL-2.0"), (ISC, "ISC")]
    texts = [(f(t), name) for t, name in wanted for f in (str, comment(" *"), comment("//"), comment("#"), unwrapped)]
    texts += [(f"x = 1  \n{lead} SPDX-License-Identifier: {tag}\nimport y", tag) for lead, tag in (("//", "MIT"), ("#", "Apache-2.0"), ("/*", "GPL-2.0-or-later"), (" *", "BSD-3-Clause"), ("//", "MIT OR Apache-2.0"))]
    texts += [("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"), ("This work is licensed under a Creative\nCommons Attribution-ShareAlike 4.0\nInternational License.", "CC-BY-SA-4.0"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("MIT License\n\nCopyright (c) 2020", "MIT"), ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n", "GPL-3.0"), (GPL2.replace("; either version 2 of the License, or\n(at your option) any later version.", "; version 2 of the License."), "GPL-2.0")]
    texts += [("No license is granted here. Ask for permission first.", ""), ("We drove under the bridge of the license office; version 2 was better.", ""), (None, ""), ("", ""), ("plain words " * 50_000 + "\n" + GPL3, "GPL-3.0-or-later")]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "doc_id long, text string").repartition(4)).collect()}
    assert [(got[k].licenses, t) for k, (t, _) in enumerate(texts)] == [(name, t) for t, name in texts]
    every = [t for d in (license_scan.KNOWN, license_scan.TITLES, license_scan.GAPPED) for ts in d.values() for t in ts]
    assert all(any(x in t for x in license_scan.TRIGGERS) for t in every)


def test_wrapped_licenses(spark):
    comment = lambda lead: lambda t: "".join(f"{lead} {x}\r\n" for x in t.splitlines())
    texts = [f(t) for f in (str, comment(" *"), comment("#"), comment("//")) for t in (APACHE, MIT, MIT.removeprefix("MIT License\n"), BSD)]
    more = ["This file is licensed\nunder the\nMIT\nLicense", "Licensed under the GNU General Public License version 3\nor later", "Licensed under the MIT\n\nLicense", "Licensed under the MIT. License", MIT.replace(" ", "\n"), "BSD 3-Clause License"]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts + more)), "doc_id long, text string")).collect()}
    assert [got[k].licenses for k in range(len(texts))] == ["Apache-2.0", "MIT", "MIT", "BSD"] * 4
    assert {got[k].identifiers for k in range(0, len(texts), 4)} == {"apache2,apache2use,apache2copy"} and {got[k].identifiers for k in range(1, len(texts), 4)} == {"mit,mitgrant,mitnotice,asis"}
    assert [got[len(texts) + k].licenses for k in range(len(more))] == ["MIT", "GPL-3.0-or-later", "", "", "MIT", "BSD-3-Clause"] and got[len(texts)].n_sentences == 1


# 8


def test_top_k(spark):
    rng = np.random.default_rng(5)
    vectors = [list(map(float, v)) for v in rng.normal(0, 0.2, (300, 8)).astype(np.float32)]
    for k in range(40, 60):
        vectors[k] = vectors[40]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(300, None), (301, [1.0, None]), (302, [float("nan")] * 8), (350, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).repartition(3)
    got: dict = {}
    for r in topk.exact_top_k(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.score, r.vec_id)
    m = np.floor(np.array(vectors, np.float32).astype(float) * 256).astype(int)
    assert sorted(got) == list(range(0, 300, 50))
    for q in got:
        want = sorted((-int(m[q] @ m[i]), i) for i in range(300) if i != q)[:5]
        assert [got[q][k + 1] for k in range(5)] == [(-s, i) for s, i in want]
    assert topk.exact_top_k(df.limit(0), F.lit(True)).count() == 0


def test_top_k_of_repeated_ids(spark, monkeypatch):
    """Copies of a row, other rows with its id, several blocks; vectors of different lengths, zeros, clashing columns."""
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "LEAST_BLOCK", 8)
    rng = random.Random(2)
    rows = [(rng.randrange(40), [rng.choice([0.0, 0.25, -0.5, 1.0]) for _ in range(rng.choice([3, 6]))]) for _ in range(90)] + [(5, [1.0] * 6)] * 9 + [(None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("clash") for c in ("rank", "query_id", "terms", "own", "copies", "one")}).repartition(5)
    got = sorted(tuple(r) for r in topk.exact_top_k(df, F.col("vec_id") % 5 == 0).collect())
    want, real = [], [r for r in rows if r[0] is not None]
    for k, (i, v) in enumerate(real):
        if i % 5 == 0:
            scores = sorted((-sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(v, w)), j) for m, (j, w) in enumerate(real) if m != k)
            want += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:5])]
    assert got == sorted(want)


# 9


def test_tokens(docs, rows):
    from tokenizers import Tokenizer

    path = tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    shards, dictionary = token_output.write_shards(docs, path, 2)
    out = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_output.read_documents(shards, dictionary).collect()))
    start, ordered = 0, sorted((r[0], r[1] or "") for r in rows)
    assert [o[1] for o in out] == [d for d, _ in ordered]
    for got, (_, text) in zip(out, ordered, strict=True):
        ids = t.encode(text, add_special_tokens=False).ids + [2]
        assert got[0] == start and got[2:] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_tokens_by_dictionary(spark):
    """A trained dictionary on a small table, raw content on a tiny one; null, repeated and extreme ids, a text of many cuts."""
    import zstandard
    from tokenizers import Tokenizer

    path, rng = tokenizers.path("byte_bpe_50k.json"), random.Random(3)
    t = Tokenizer.from_file(path)
    many = [(i, T.prose(rng, 40), None, None, 0) for i in range(60)]
    few = [(None, "null id", None, None, 0), (-(1 << 63), "least id", None, None, 0), (7, "b", None, None, 0), (7, "a a", None, None, 0), (8, None, None, None, 0)]
    for rows, trained in ((many, True), (few, False)):
        shards, dictionary = token_output.write_shards(T.table(spark, rows, clash=True), path, 2)
        assert (zstandard.ZstdCompressionDict(dictionary).dict_id() > 0) == trained and len(dictionary) >= 8
        image = bytes(shards.first().image)
        assert token_output.HEAD.unpack_from(image)[-1] == hashlib.sha256(dictionary).digest()
        out = sorted(token_output.read_documents(shards, dictionary).collect(), key=lambda r: r.start)
        ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, len(r[1] or "")))
        assert [r.doc_id for r in out] == [r[0] for r in ordered]
        for r, row in zip(out, ordered, strict=True):
            ids = np.array([*t.encode(row[1] or "", add_special_tokens=False).ids, 2], "<u4")
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


@pytest.mark.parametrize("longest", [1 << 20, 5])
def test_tokenizer_and_shards(monkeypatch, longest):
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(token_output, "LONGEST", longest)
    monkeypatch.setattr(token_output, "CACHE_CHUNKS", 40)
    t, own = Tokenizer.from_file(path), token_output.ByteTokenizer(path)
    rng = random.Random(6)
    parts = ["a", " b", " ", "\n", "é", "'s", "'ll", "12", "!", "  ", "中", "<|endoftext|>", "\x85", "　", "word", "\t", "_", "\x1c", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(3000)] + [" ".join(rng.choice(parts[3:]) for _ in range(30)) for _ in range(300)]
    for k in range(0, len(texts), 300):
        for text, ids in zip(texts[k : k + 300], own.encode(pa.array(texts[k : k + 300])), strict=True):
            assert ids.tolist() == t.encode(text, add_special_tokens=False).ids
    import zstandard

    docs = [np.array([1, 2, 3], "<u2").tobytes(), np.array([2], "<u2").tobytes()]
    dictionary = zstandard.train_dictionary(4096, [bytes(rng.choices(range(256), k=50)) * 3 for _ in range(500)]).as_bytes()
    z = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    image = token_output.pack_shard([(5, 3, z.compress(docs[0])), (9, 1, z.compress(docs[1]))], hashlib.sha256(dictionary).digest(), 2, 2)
    shard = token_output.Shard(image, dictionary)
    assert shard.ids(0).tolist() == [1, 2, 3] and shard.ids(1).tolist() == [2] and shard.index["start"].tolist() == [0, 3, 4]
    with pytest.raises(ValueError):
        token_output.Shard(image, b"other")


def test_tokens_empty(empty):
    shards, dictionary = token_output.write_shards(empty, tokenizers.path("byte_bpe_50k.json"), 2)
    assert token_output.read_documents(shards, dictionary).count() == 0


# 10


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(docs, rows, width):
    want = T.near_components(rows, width)
    out = near_dedup.near_duplicates(docs, width).collect()
    assert len(out) == len(rows)
    for r in out:
        text = next(x[1] for x in rows if x[0] == r.doc_id)
        assert r.n_shingles == len(T.shingles(text, width)) and r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert len(set(want.values())) < len(want) - 5


def test_near_duplicates_blocks(spark, monkeypatch):
    """Chains of copies at and around the limit, buckets of many blocks by rows and by bytes, hot keys."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(llm_common, "LEAST_HOT", 3)
    monkeypatch.setattr(llm_common, "HOT", 30)
    rng = random.Random(8)
    base = T.prose(rng, 80).split(" ")
    rows = []
    for i in range(70):
        w = list(base)
        for _ in range(i % 4):
            w[rng.randrange(len(w))] = f"new{i}"
        base = w if i % 10 == 9 else base
        rows.append((i, " ".join(w), None, None, 0))
    want = T.near_components(rows, 4)
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(T.table(spark, rows), 4).collect()} == want
    assert 1 < len(set(want.values())) < 70
    copies = rows + [(1000 + k, rows[3][1], None, None, 0) for k in range(40)] + [(rows[5][0], rows[5][1], None, None, 0)] * 9
    out = near_dedup.near_duplicates(T.table(spark, copies).repartition(3), 4).collect()
    want |= {1000 + k: want[3] for k in range(40)}
    assert len(out) == len(copies) and all(r.component_id == want[r.doc_id] for r in out)


def test_near_duplicates_leaves_no_steps_on_disk(spark, rows, monkeypatch):
    """The shuffle files of all steps go before the result is read, those of hot keys, counts and component rounds included."""
    monkeypatch.setattr(llm_common, "LEAST_HOT", 3)
    monkeypatch.setattr(llm_common, "HOT", 30)
    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffled = lambda: {f for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")}
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffled()
    setting, copies = spark.conf.get(key, None), rows + [(100_000 + k, rows[0][1], None, None, 0) for k in range(40)]
    out = near_dedup.near_duplicates(T.table(spark, copies), 4)
    ends = time.monotonic() + 10
    while (left := shuffled() - before) and time.monotonic() < ends:
        time.sleep(0.1)
    assert not left and spark.conf.get(key, None) == setting
    want = T.near_components(copies, 4)
    assert all(r.component_id == want[r.doc_id] for r in out.collect())


def test_salted_join(spark, monkeypatch):
    monkeypatch.setattr(llm_common, "LEAST_HOT", 5)
    many = spark.createDataFrame([(k % 7 if k % 3 else 0, k) for k in range(200)], "a long, x long")
    sizes, one = many.groupBy("a").agg(F.count("*").alias("n")), many.filter("a <> 6").groupBy("a").agg(F.max("x").alias("top"))
    plain = sorted(map(tuple, many.join(one, "a", "left").collect()))
    assert sorted(map(tuple, llm_common.salted_join(many, one, ["a"], sizes, ["x"], "left").collect())) == plain
    assert sorted(map(tuple, llm_common.salted_join(many, one.limit(0), ["a"], sizes.limit(0), ["x"]).collect())) == []


def test_shingle_hashes_are_whole():
    """Shingles that agree in 50 bits are two; sets and intersections against plain sets on long and repeated texts."""
    from stratacloud.llm import shingles

    rng = random.Random(4)
    texts = [T.prose(rng, n, "ab") for n in (0, 1, 3, 4, 5, 60, 5000)] + ["", "x " * 300]
    sets, bounds = shingles.shingle_sets([t.encode() for t in texts], 4)
    assert np.diff(bounds).tolist() == [len(T.shingles(t, 4)) for t in texts]
    assert all((np.diff(sets[a:b].astype(object)) > 0).all() for a, b in zip(bounds, bounds[1:])) and int(sets.max()).bit_length() > 60
    x, y, both = shingles.intersections([t.encode() for t in texts], [t.encode() for t in texts[::-1]], 4)
    assert both.tolist() == [len(T.shingles(a, 4) & T.shingles(b, 4)) for a, b in zip(texts, texts[::-1])]


def test_near_duplicates_degenerate(spark, empty):
    assert near_dedup.near_duplicates(empty).count() == 0
    out = near_dedup.near_duplicates(T.table(spark, [(None, "a b", None, None, 0), (1, None, None, None, 0), (2, "", None, None, 0)])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in out) == [(0, 0, True), (1, 1, True), (2, 2, True)]


def test_components(spark):
    rng = random.Random(7)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 130)]
    root = {x: x for e in links for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(top(a), top(b))] = min(top(a), top(b))
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got.get(x, x) == top(x) for x in root)


def test_very_long_texts(spark, monkeypatch):
    """A text of 400,000 characters, half of which another document has, through every operator of documents."""
    import sentencepiece
    from tokenizers import Tokenizer

    from stratacloud.llm import anchors

    monkeypatch.setattr(anchors, "LONGEST", 1 << 16)
    monkeypatch.setattr(token_output, "LONGEST", 1 << 16)
    rng = random.Random(11)
    half = T.prose(rng, 45_000, "abcdefgh")
    long = T.prose(rng, 45_000, "abcdefgh") + "\n\n" + half
    rows = [(1, half, "en", "a", 0), (2, long, "en", "a", 0), (3, "x" * 150_000, None, "b", 0), (4, long.upper(), "en", "b", 0)]
    df = T.table(spark, rows)
    words = [len(T.WORD.findall(r[1])) for r in rows]
    assert [r.lang_pred for r in langid.identify(df).orderBy("doc_id").collect()] == ["en"] * 4
    prints = imatch.fingerprint_edits(df).orderBy("doc_id").collect()
    assert [r.n_chars for r in prints] == [len(r[1]) for r in rows] and prints[1].fingerprint == prints[3].fingerprint
    want = T.repeats(rows)
    for r in suffix_dedup.remove_repeats(df).collect():
        assert (r.n_bytes, r.n_removed) == (len(want[r.doc_id][1]), sum(want[r.doc_id][0]))
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizers.path("piece_bpe_32k.model"))
    assert [r.ids for r in pieces.encode_pieces(df, tokenizers.path("piece_bpe_32k.model")).orderBy("doc_id").collect()] == [sp.encode(r[1], add_eos=True) for r in rows]
    assert [r.mix_size for r in mixing.mix_sources(df, F.lit(1)).orderBy("doc_id").collect()] == words
    assert all(r.licenses == "" for r in license_scan.scan_licenses(df).collect())
    t = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    out = token_output.read_documents(*token_output.write_shards(df, tokenizers.path("byte_bpe_50k.json"), 2)).orderBy("doc_id").collect()
    assert [r.n_tokens for r in out] == [len(t.encode(r[1], add_special_tokens=False).ids) + 1 for r in rows]
    near = near_dedup.near_duplicates(df, 4).orderBy("doc_id").collect()
    assert [r.n_shingles for r in near] == [len(T.shingles(r[1], 4)) for r in rows] and [r.component_id for r in near] == [1, 2, 3, 2]
