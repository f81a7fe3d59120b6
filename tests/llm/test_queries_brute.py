"""The registered queries that SQL can't express, run as registered, against brute force on sf0.001; clashing columns in the pipeline."""

import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tillpoint.llm import langid, pieces, quality, simhash
from tillpoint.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def test_op2_recall_and_contract(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, vecs = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    got = {}
    for r in QUERIES["op2_neighbours"](spark, SF).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == {i for i in ids.tolist() if i % 100 == 0}
    found = total = 0
    for q, ranks in got.items():
        dist = np.sqrt(((vecs - vecs[ids == q][0]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, dist)) if ids[i] != q][:10]
        assert sorted(ranks) == list(range(1, len(order) + 1))
        listed = [ranks[k] for k in sorted(ranks)]
        assert listed == sorted(listed, key=lambda x: (x[1], x[0])) and q not in [v for v, _ in listed]
        for v, s in listed:
            assert s == pytest.approx(dist[ids == v][0], rel=1e-12)
        found += len({v for v, _ in listed} & set(ids[order].tolist()))
        total += len(order)
    assert found >= 0.9 * total


def test_op3_fingerprints_and_components(spark, docs):
    got = {r["doc_id"]: r for r in QUERIES["op3_simhash"](spark, SF).collect()}
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) % (1 << 64) for r in docs}
    group = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if group[a] != group[b] and (prints[a] ^ prints[b]).bit_count() <= 2:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{p:016x}", group[i]) for i, p in prints.items()}


def test_op5_ids_are_the_librarys(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = {r["doc_id"]: r for r in QUERIES["op5_sentencepiece"](spark, SF).collect()}
    assert set(got) == {r["doc_id"] for r in docs}
    for r in docs:
        ids = model.encode(r["text"] or "")
        assert list(got[r["doc_id"]]["token_ids"]) == ids and got[r["doc_id"]]["n_tokens"] == len(ids) and got[r["doc_id"]]["decodes"]


def test_op7_predictions_are_recomputed(spark, docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    model = langid.fit(table.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    got = {r["doc_id"]: r for r in QUERIES["op7_language"](spark, SF).collect()}
    right = n = 0
    for r in docs:
        row = got[r["doc_id"]]
        lang, score, _ = model.predict(r["text"])
        assert row["held_out"] == held(r["doc_id"]) and row["lang_pred"] == lang and row["score"] == pytest.approx(score, abs=1e-6) and 0 <= row["score"] <= 1
        if row["held_out"] and r["lang"]:
            n, right = n + 1, right + (lang == r["lang"])
    assert right >= 0.95 * n > 0


def test_ambiguity_is_flagged_where_two_languages_fit():
    counts = np.zeros((2, langid.FEATURES))
    one, two = langid.features("aaa bbb aaa bbb"), langid.features("ccc ddd ccc ddd")
    counts[0], counts[1] = one * 50, two * 50
    model = langid.Ecoc.fit(["x", "y"], counts)
    assert model.predict("aaa bbb")[0] == "x" and model.predict("ccc ddd")[0] == "y" and not model.predict("aaa bbb aaa")[2]
    assert model.predict("zzz qqq")[2] and model.predict("")[2] and model.predict(None) == ("und", 0.0, True)


@pytest.mark.parametrize("n", [3, 8, 450])
def test_codewords_differ_at_any_number_of_languages(n):
    code = langid.codewords(n)
    assert len({tuple(r) for r in code.tolist()}) == n


def test_op10_sizes_checksums_and_slots(spark, docs):
    got = QUERIES["op10_sharding"](spark, SF).collect()
    text = {r["doc_id"]: (r["text"] or "").encode() for r in docs}
    assert sorted(r["doc_id"] for r in got) == sorted(text)
    load, slots = dict.fromkeys(range(8), 0), {}
    for r in got:
        raw = text[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        load[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) - min(load.values()) <= 2 * max(r["size"] for r in got)


def test_every_groups_own_sketch_moves_its_fence(spark):
    """Small groups too: no size below which a group's own documents stop counting."""
    def fences(shift):
        rows = [(f"l{i % 2}", f"s{k}", 0.001 * (k + 1), 0.0, 4.0 + k + (shift if k == 0 else 0.0), False) for k in range(4) for i in range(6 + 40 * k)]
        df = spark.createDataFrame(rows, "lang string, source string, symbols_per_word double, dup_line_share double, mean_word_chars double, base_failed boolean")
        return {(r["lang"], r["source"]): r["hi_mean_word_chars"] for r in quality.fences(df).collect()}

    plain, shifted = fences(0.0), fences(1.0)
    assert len({v for (lang, _), v in plain.items() if lang == "l0"}) == 4
    assert all(shifted[lang, "s0"] != plain[lang, "s0"] for lang in ("l0", "l1"))       # three documents move their own fence


def test_pipeline_keeps_columns_that_clash(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    extra = docs.select("*", *[(F.col("doc_id") * k).cast("double").alias(n) for k, n in enumerate(
        ("rate", "copy", "n_copies", "shuffle_key", "n_lines", "N_Dropped", "aside_rate"), 1)])
    want = {r["doc_id"]: tuple(r[c] for c in extra.columns[5:]) for r in extra.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, SF)
        assert out.columns == extra.columns, name
        assert all(tuple(r[c] for c in extra.columns[5:]) == want[r["doc_id"]] for r in out.collect()), name
    assert corpus_pipeline.STAGES[-1][1](spark, extra, SF).count() == 60
