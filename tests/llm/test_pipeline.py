"""Every stage of the pipeline against a plain version on what the stage before kept."""

import hashlib

import corpus_pipeline

from . import common as T


def test_stages(spark, tmp_path):
    import public_tokenizers
    import sentencepiece

    rows = list({r[0]: r for r in T.documents(90, seed=5)}.values())
    T.table(spark, rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
    first = {r.doc_id: r for r in kept["language_id"]}
    # every text with letters whose language is clear stays as it is
    assert set(first) <= {r[0] for r in rows if any(c.isalpha() for c in r[1] or "")}
    assert {r[0] for r in rows if len(r[1] or "") > 200} <= set(first)
    assert all(first[r[0]].text == r[1] for r in rows if r[0] in first)
    component = T.near_components([(r.doc_id, r.text) for r in kept["language_id"]], 5)
    second = {r.doc_id: r for r in kept["near_dedup"]}
    assert set(second) == set(component.values()) and len(second) < len(first)
    cut = T.repeats([(r.doc_id, r.text) for r in kept["near_dedup"]])
    third = {r.doc_id: r for r in kept["suffix_dedup"]}
    assert set(third) == set(second)
    for d, (flags, b) in cut.items():
        text = bytes(c for c, f in zip(b, flags) if not f).decode(errors="replace")
        assert third[d].text == text and third[d].n_chars == len(text) and third[d].source == second[d].source
    assert any(any(flags) for flags, _ in cut.values())
    words = lambda text: len(T.WORD.findall(text or ""))
    sizes, taken = {}, {}
    for r in kept["suffix_dedup"]:
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    for r in kept["mixing"]:
        assert third[r.doc_id].text == r.text
        taken[r.source] = taken.get(r.source, 0) + words(r.text)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    assert all(taken.get(s, 0) <= 3 * sizes[s] for s in names)
    assert abs(sum(taken.values()) - sum(sizes.values())) <= sum(max(words(r.text) for r in kept["suffix_dedup"] if r.source == s) for s in names)
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    count = lambda items: {x: items.count(x) for x in set(items)}
    want = [(r.doc_id, hashlib.sha256(" ".join(map(str, sp.encode(r.text, add_eos=True))).encode()).hexdigest()) for r in kept["mixing"]]
    assert count([(r.doc_id, r.ids_sha256) for r in kept["sentencepiece"]]) == count(want)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(want)


CLASHES = ["lang_pred", "score", "dropped_id", "n_bytes", "kept_text", "extra", "mix_size", "mix_copy", "mix_copies", "place", "ord", "component", "kept", "row", "c0", "REST", "a.b", "n"]


def test_stages_keep_clashing_columns(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    rows = T.documents(40, seed=6)
    rows += [(None, rows[1][1], None, None, None), (None, None, None, None, None), (2000, T.prose(__import__("random").Random(1), 30_000), "en", "src0", 0)]
    docs = T.table(spark, rows).withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) for c in CLASHES}).repartition(3).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        got = out.collect()
        assert got and all(r[c] == f"{c} of {'null' if r.doc_id is None else r.doc_id}" for r in got for c in CLASHES)
        texts = {(r[0], r[1]) for r in rows}
        if name != "suffix_dedup":
            assert all((r.doc_id, r.text) in texts for r in got)
        else:
            assert len(got) == len(rows)
        if name == "language_id":
            assert all(any(c.isalpha() for c in r.text or "") for r in got) and 2000 in {r.doc_id for r in got}
        if name == "near_dedup":
            assert sum(r.doc_id == rows[4][0] for r in got) in (0, 2) and sum(r.doc_id is None for r in got) == 2
        if name == "mixing":
            assert all(r.text for r in got)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == len(rows)


def test_stages_of_empty_tables(spark, tmp_path):
    empty = T.table(spark, [], clash=True)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, "")
        assert out.count() == 0 and (out.columns == empty.columns) == (name != "sentencepiece")
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
