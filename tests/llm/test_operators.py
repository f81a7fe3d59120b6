"""The training-data operators on small tables: brute force, round trips, nulls, ties, repeats, empties, clashing names."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillpoint.llm import ann, chat, components, langid, linededup, mixing, pieces, quality, sharding, simhash, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, rk int, Fingerprint string, copy int"
CLASH = ("x", 1, "f", 9)


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, wordless and long texts, null ids and groups, ties and repeated rows."""
    pick = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    long = " ".join(pick.choice(words) for _ in range(30_000))
    texts = [None, "", " \t\n", "one", "Shared line\nalone a", " shared LINE \nalone b\n", "x y z\nx y z", long, long]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, 0) for i, t in enumerate(texts)]
    rows += [(20 + i, f"shared line\nbody {i} of the text number {i}", "en", "s", 0) for i in range(12)]
    rows += [(3, "one", "en", "s", 0), (3, "one", "en", "s", 0), (None, "one", None, None, 0), (None, None, None, None, None)]
    return docs_of(spark, rows).cache()


@pytest.fixture(scope="module")
def none(spark):
    return docs_of(spark, []).cache()


# ------------------------------------------------------------ sharding

def test_sharding_balances_and_numbers(spark, odd, none):
    got = sharding.shard(odd, shards=4).collect()
    assert len(got) == odd.count()
    sizes, slots = {}, {}
    for r in got:
        assert r["size"] == len((r["text"] or "").encode()) + 1 and r["shard"] in range(4)
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    biggest = max(r["size"] for r in got)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(4)) <= 2 * biggest
    assert sharding.shard(none).collect() == []


def test_sharding_is_the_global_order_whatever_the_sample(spark):
    rows = [(i, "same" if i % 3 == 0 else "t" * (i % 97 + 1) + str(i), "en", "s", 0) for i in range(4000)]
    df = docs_of(spark, rows)
    want = sorted(({r["doc_id"]: (r["h"], r["doc_id"], r["s"]) for r in df.select(
        "doc_id", F.xxhash64("text").alias("h"), sharding.record_size(F.col("text")).alias("s")).collect()}).values())
    total, run, expect = sum(w[2] for w in want), 0, {}
    for _, doc, size in want:
        expect[doc] = run * 8 // total
        run += size
    for ranges, over in ((128, 32), (16, 2)):   # a poor sample leaves overfull ranges to subdivide
        got = {r["doc_id"]: r["shard"] for r in sharding.shard(df, ranges=ranges, oversample=over).select("doc_id", "shard").collect()}
        assert got == expect


# ------------------------------------------------------------ quality

@given(st.lists(st.sampled_from("abc"), max_size=60))
@settings(max_examples=200, deadline=None)
def test_repeat_words_brute_force(words):
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {j for i, w in enumerate(wins) if wins.count(w) > 1 for j in range(i, i + 5)}
    assert quality.repeat_words(words) == len(covered)


def test_quality_odd_rows(spark, odd, none):
    got = quality.judge(odd, {"doc_id": F.col("doc_id")}).collect()
    assert len(got) == odd.count()
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < 10)
    assert quality.judge(none, {"doc_id": F.col("doc_id")}).collect() == []
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns and 7 in [r["doc_id"] for r in kept.select("doc_id").collect()]


def test_quality_fences_follow_the_group(spark):
    pick = random.Random(1)
    clean = [" ".join("".join(pick.choice("abcdefgh") for _ in range(5)) for _ in range(60)) for _ in range(400)]
    junk = [t.replace(" ", "$$$ ") for t in clean[:60]]
    df = docs_of(spark, [(i, t, "en", "a", 0) for i, t in enumerate(clean + junk)])
    kept = {r["doc_id"] for r in quality.keep_good(df).select("doc_id").collect()}
    assert kept == set(range(400))


def test_sketch_merges_and_bounds_the_error(spark):
    values = np.random.default_rng(2).lognormal(size=5000)
    df = spark.createDataFrame([(i % 7, float(v)) for i, v in enumerate(values)], "part int, x double")
    whole = quality.sketch_quantiles(quality.sketch(df, ["part"], ["x"]), [], {"q": 0.5, "r": 0.9}).first()
    for p, got in ((0.5, whole["q"]), (0.9, whole["r"])):
        exact = np.sort(values)[int(np.ceil(p * len(values))) - 1]
        assert abs(got - exact) <= exact * (quality.GAMMA - 1)


# ------------------------------------------------------------ SimHash

def plain_fingerprint(text):
    words = [w for w in (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).translate(
        {9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    bits = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(grams))


@given(st.text(alphabet="abÀÉ \t\n\u00a0漢", max_size=40))
@settings(max_examples=200, deadline=None)
def test_fingerprint_brute_force(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_covering_masks_cover():
    masks = [m % (1 << 64) for m in simhash.covering_masks()]
    assert len(masks) == 7 and all(35 <= m.bit_count() <= 38 for m in masks)
    for i in range(64):
        for j in range(64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def brute_components(prints):
    label = {p: p for p in prints}

    def find(p):
        while label[p] != p:
            p = label[p]
        return p

    for a in prints:
        for b in prints:
            if ((a ^ b) % (1 << 64)).bit_count() <= 2:
                label[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("small", [2, 12])
def test_links_connect_what_brute_force_connects(spark, small):
    pick = random.Random(9)
    base = [pick.getrandbits(64) for _ in range(6)]
    prints = set(base)
    for b in base[:3]:   # balls of near copies, some larger than any bucket bound
        for _ in range(60):
            prints.add(b ^ sum(1 << k for k in pick.sample(range(64), pick.randrange(1, 4))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), small_bucket=small)
    assert all(((r["a"] ^ r["b"]) % (1 << 64)).bit_count() <= 2 for r in edges.collect())
    got = {r["node"]: r["label"] for r in components.connected_components(edges).collect()}
    assert {p: got.get(p, p) for p in signed} == brute_components(signed)


def test_components_of_a_long_chain_and_of_nothing(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (900, 901), (901, 900)], "a long, b long")
    got = {r["node"]: r["label"] for r in components.connected_components(chain).collect()}
    assert got == {i: 0 for i in range(201)} | {900: 900, 901: 900}
    assert components.connected_components(chain.limit(0)).collect() == []


def test_near_duplicates_odd_rows(spark, odd, none):
    got = simhash.near_duplicates(odd, {"doc_id": F.col("doc_id"), "text": F.col("text")}).collect()
    assert len(got) == odd.count()
    assert all(int(r["fingerprint"], 16) == plain_fingerprint(r["text"]) for r in got)
    assert {r["component_id"] for r in got if not (r["text"] or "").strip()} == {0}
    assert {r["component_id"] for r in got if r["text"] == "one"} == {3}
    kept = simhash.keep_one(odd).collect()
    assert sorted(r["doc_id"] for r in kept if r["text"] == "one") == [3] and simhash.keep_one(odd).columns == odd.columns
    assert simhash.near_duplicates(none, {"doc_id": F.col("doc_id")}).collect() == [] and simhash.keep_one(none).collect() == []


def test_keep_one_of_components_without_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    df = docs_of(spark, [(None, a, "en", "s", 0), (None, a, "en", "s", 0), (None, b, "en", "s", 0)])
    assert sorted(r["text"][0] for r in simhash.keep_one(df).collect()) == ["a", "b"]


# ------------------------------------------------------------ line dedup

def brute_lines(texts, least):
    keys = [[linededup.line_key(x) for x in (t or "").split("\n")] for t in texts]
    count = {}
    for ks in keys:
        for k in set(ks) - {""}:
            count[k] = count.get(k, 0) + 1
    return ["\n".join(x for x, k in zip((t or "").split("\n"), ks) if count.get(k, 0) < least) for t, ks in zip(texts, keys)]


def test_line_dedup_brute_force(spark, odd, none):
    rows = odd.select("doc_id", "text").collect()
    want = sorted(brute_lines([r["text"] for r in rows], 10))
    got = linededup.dedup_lines(odd)
    assert sorted(r["text"] for r in got.collect()) == want
    assert got.columns == [*odd.columns, "n_lines", "n_dropped"]
    assert linededup.dedup_lines(none).collect() == []


def test_line_dedup_is_reversible(spark):
    def some(lo, hi):
        return docs_of(spark, [(i, f"top\nline {i % 7}\nown {i}", "en", "s", 0) for i in range(lo, hi)])

    def content(state):
        refs = {(r["k1"], r["k2"]): r["n"] for r in state.refs.collect()}
        held = {r["shard"]: r["keys"] for r in state.filters.collect() if r["keys"]}
        return refs, held

    empty = linededup.empty_state(min_docs=5)
    base = empty.add(some(0, 40))
    more = base.add(some(40, 90))
    back = more.remove(some(40, 90))
    assert content(back) == content(base) and content(more) == content(empty.add(some(0, 90)))
    assert content(base.remove(some(0, 40)))[0] == {}
    with pytest.raises(ValueError):
        base.remove(some(0, 90))
    texts = [r["text"] for r in some(0, 40).collect()]
    got = sorted(r["text"] for r in linededup.drop_common_lines(some(0, 40), back).collect())
    assert got == sorted(brute_lines(texts, 5))


def test_cuckoo_filter_inserts_deletes_and_reports_full():
    pick = np.random.default_rng(1)
    k1, k2 = pick.integers(-2**62, 2**62, 3000), pick.integers(-2**62, 2**62, 3000)
    f = linededup.CuckooFilter.sized(3000)
    assert f.insert(k1, k2) and f.holds(k1, k2).all()
    f.delete(k1[:1000], k2[:1000])
    f = linededup.CuckooFilter.loads(f.dumps())
    assert f.holds(k1[1000:], k2[1000:]).all() and f.holds(k1[:1000], k2[:1000]).mean() < 0.01
    assert not linededup.CuckooFilter.sized(8).insert(k1, k2)


def test_line_hash_is_sparks(spark):
    keys = ["", "a", "é漢 x", "long " * 50]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string").select(F.xxhash64("k")).collect()]
    assert got == [linededup.line_hash(k) for k in keys]


# ------------------------------------------------------------ mixing

def test_mixing_rates_copies_and_order(spark, none):
    rows = [(i, f"text number {i}", "en", "big" if i % 4 else "small", 0) for i in range(4000)]
    df = docs_of(spark, rows)
    got = mixing.mix(df, weights={"big": 1.0, "small": 1.0}).collect()
    size = {s: sum(len(r[1]) + 1 for r in rows if r[3] == s) for s in ("big", "small")}
    made = {s: sum(len(r["text"]) + 1 for r in got if r["source"] == s) for s in size}
    assert abs(made["big"] / made["small"] - 1) < 0.1 and abs(sum(made.values()) / sum(size.values()) - 1) < 0.1
    per = {}
    for r in got:
        per.setdefault(r["doc_id"], []).append((r["copy"], r["n_copies"]))
    assert all(sorted(c for c, _ in v) == list(range(1, v[0][1] + 1)) for v in per.values())
    again = mixing.mix(df.repartition(5), weights={"big": 1.0, "small": 1.0}).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(none).collect() == [] and mixing.mix(df, weights={}).collect() == []


def test_mixing_high_rates_stay_poisson(spark):
    df = docs_of(spark, [(i, "x", "en", "rare", 0) for i in range(800)] + [(9000, "y" * 80_000, "en", "big", 0)])
    got = mixing.mix(df, weights={"rare": 1.0, "big": 1.0}).filter("source = 'rare'").groupBy("doc_id").agg(F.max("n_copies").alias("n"), F.max("rate").alias("r")).collect()
    n, rate = np.array([r["n"] for r in got]), got[0]["r"]
    assert rate > mixing.MEAN and abs(n.mean() / rate - 1) < 0.05 and abs(n.var() / rate - 1) < 0.25


def test_mixing_odd_rows(spark, odd):
    got = mixing.mix(odd, scale=20.0)
    assert set(odd.columns) <= set(got.columns)
    assert None in {r["source"] for r in got.select("source").distinct().collect()}


# ------------------------------------------------------------ pieces

@pytest.fixture(scope="module")
def coders():
    blob = open(pieces.MODEL, "rb").read()
    return pieces.PieceModel(blob), sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


TEXT = st.text(alphabet=st.one_of(st.sampled_from(" ▁\n\tabcdeThing.,é漢😀0<>/|$\x00"), st.characters(exclude_categories=["Cs"])), max_size=60)


@given(TEXT)
@settings(max_examples=400, deadline=None)
def test_bpe_pass_equals_the_library(coders, text):
    mine, lib = coders
    ids = mine.encode(text).tolist()
    assert ids == lib.encode(text) and mine.decode(ids) == lib.decode(ids) == text.replace("▁", " ")


def unigram_model(byte_fallback):
    """The same pieces with a unigram model's type: field 2 (trainer) with its field 3 changed."""
    blob = open(pieces.MODEL, "rb").read()
    at = blob.index(b"tok_v0") + 6
    assert blob[at:at + 2] == b"\x18\x02"
    blob = blob[:at] + b"\x18\x01" + blob[at + 2:]
    if not byte_fallback:
        k = blob.index(b"\x98\x02\x01", at)
        blob = blob[:k] + b"\x98\x02\x00" + blob[k + 3:]
    return blob


def test_unigram_pass_finds_the_best_score():
    blob = unigram_model(True)
    mine, lib = pieces.PieceModel(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    assert not mine.bpe
    score = lambda ids: sum(mine.scores[i] for i in ids)
    pick = random.Random(3)
    for _ in range(300):
        text = "".join(pick.choice("the ingcatdo") for _ in range(pick.randrange(1, 14)))
        a, b = mine.encode(text).tolist(), lib.encode(text)
        assert mine.decode(a) == text and score(a) >= score(b) - 1e-3 * abs(score(b))


def test_merge_heap_equals_merge(coders):
    mine, lib = coders
    pick = random.Random(5)
    for _ in range(200):
        text = "".join(pick.choice("   abthe") for _ in range(pick.randrange(1, 20)))
        assert mine.merge_heap(text) == mine.merge(text)


def test_piece_columns(spark, odd, none):
    coder = pieces.SentencePiece(spark)
    got = odd.select("text", coder.encode_verified(F.col("text")).alias("c"), coder.decode(coder.encode(F.col("text"))).alias("back")).collect()
    assert all(r["back"] == r["text"] for r in got)
    assert all(r["c"]["decodes"] for r in got if r["text"] is not None) and all(r["c"]["token_ids"] is None for r in got if r["text"] is None)
    assert none.select(coder.encode(F.col("text"))).collect() == []


# ------------------------------------------------------------ WARC

PAGES = "page_id long, url string, html string, type string, payload string"


def test_warc_round_trip(spark, tmp_path):
    big, tiny = "b" * 1500 + "é漢", "t"
    rows = [(1, "http://a/\r\nx", big), (5, None, big), (5, "http://c/", big), (2, "u", tiny), (3, "u", tiny), (7, "v", None), (8, "w", ""), (None, "n", big),
            (9, "x", "\r\n\r\nWARC/1.1\r\n\r\n")]
    df = spark.createDataFrame([(*r, "t", "p") for r in rows], PAGES)
    path = str(tmp_path / "w")
    got = warc.archive_pages(df, path).collect()
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = sorted((str(i or ""), sha(t), len((t or "").encode()), "revisit" if t == big and i != 5 else "response") for i, _, t in rows)
    assert sorted((r["record_id"][10:-1], r["payload_digest"], r["payload_bytes"], r["type"]) for r in got) == want
    assert {r["refers_to"] for r in got if r["type"] == "revisit"} == {"<urn:page:5>"}
    whole = warc.read_archive(spark, path).collect()
    assert len(whole) == len(rows) and all(r["headers"]["warc-type"] == r["type"] for r in whole)
    picked = warc.read_archive(spark, path).filter("type = 'response' and target_uri like 'http://c%' and payload_length >= 10")
    assert [r["record_id"] for r in picked.collect()] == ["<urn:page:5>"]
    assert warc.read_archive(spark, path, "record_id string").filter("record_id is not null").count() == len(rows)
    empty = str(tmp_path / "e")
    assert warc.archive_pages(df.limit(0), empty).collect() == []


def test_warc_reads_foreign_files(spark, tmp_path):
    import gzip

    rows = [{"record_id": f"<urn:x:{i}>", "type": "resource", "payload": b"p" * (i * 5000), "date": "2024-01-01T00:00:00Z"} for i in range(4)]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.warc").write_bytes(b"".join(map(warc.record, rows)))
    (tmp_path / "f" / "b.warc.gz").write_bytes(b"".join(gzip.compress(warc.record(r)) for r in rows))
    got = warc.read_archive(spark, str(tmp_path / "f")).collect()
    assert sorted(len(r["payload"]) for r in got) == sorted(2 * [0, 5000, 10000, 15000])
    assert warc.read_archive(spark, str(tmp_path / "f"), "record_id string").count() == 8


# ------------------------------------------------------------ neighbours

def test_neighbours_recall_ties_and_unusable_rows(spark):
    pick = np.random.default_rng(7)
    base = pick.standard_normal((3000, 24)).astype(np.float32)
    base[1000:2000] = base[0]   # a third of the rows is one vector
    rows = [(i, v.tolist(), 0) for i, v in enumerate(base)]
    rows += [(5000, None, 0), (5100, [0.0] * 24, 0), (5200, [float("nan")] * 24, 0), (5300, [1.0] * 7, 0), (5400, [None] * 24, 0), (None, [1.0] * 24, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in ann.nearest(df, F.col("id") % 100 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 3000, 100))
    hits = 0
    x = base.astype(np.float64)
    for q, found in got.items():
        dist = ann.exact_distances(x[q], x)
        dist[q] = np.inf
        best = np.lexsort((np.arange(len(x)), dist))[:10]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11)) and all(dist[f[1]] == f[2] for f in found)
        hits += len({f[1] for f in found} & set(best.tolist()))
        if 1000 <= q < 2000:
            assert [f[1] for f in found] == best.tolist()
    assert hits >= 0.9 * 10 * len(got)


def test_neighbours_of_few_and_of_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.0, 2.0]), (7, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(df, F.col("id") % 100 == 0).collect())
    assert got == [(0, 1, 7), (0, 2, 100), (100, 1, 7), (100, 2, 0)]
    assert ann.nearest(df.limit(0), F.col("id") % 100 == 0).collect() == []


def test_copies_enter_the_index_by_their_smallest_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(3, [1.0, 0.0])] + [(50 + i, [0.0, 1.0 + i]) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, x array<double>")
    kept = sorted((r["id"], r["x"][1]) for r in ann.first_copies(df, 4).collect())
    assert kept == [(0, 0.0), (1, 0.0), (2, 0.0), (3, 0.0), (3, 0.0), (50, 1.0), (51, 2.0), (52, 3.0)]
    assert "WindowGroupLimit" in ann.first_copies(df, 4)._jdf.queryExecution().executedPlan().toString()
    wide = df.withColumnsRenamed({"id": "vec_id", "x": "embedding"}).filter("vec_id <> 3")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(wide, F.col("id") == 39, k=4).collect())
    assert got == [(39, 1, 0), (39, 2, 1), (39, 3, 2), (39, 4, 4)]   # the query itself isn't in the index


# ------------------------------------------------------------ language

def test_language_held_out_accuracy_and_odd_rows(spark, odd, none):
    pick = random.Random(2)
    alphabets = {"aa": "abcde", "bb": "defgh", "cc": "ghijk", "dd": "klmno", "ee": "nopqr", "ff": "qrstu"}
    make = lambda lang: " ".join("".join(pick.choice(alphabets[lang]) for _ in range(5)) for _ in range(40))
    rows = [(i, make(lang), lang, "s", 0) for i, lang in enumerate(list(alphabets) * 30)] + [(999, None, None, "s", 0), (998, "12 $ ²", "aa", "s", 0)]
    got = langid.identify(docs_of(spark, rows), F.col("doc_id") % 4 != 2, {"doc_id": F.col("doc_id"), "lang": F.col("lang")}).collect()
    held = [r for r in got if r["doc_id"] % 4 == 2 and r["doc_id"] < 900]
    assert len(got) == len(rows) and all(r["lang"] == r["lang_pred"] for r in held)
    assert {r["lang_pred"] for r in got if r["doc_id"] > 900} == {"und"} and all(0 <= r["score"] <= 1 for r in got)
    alone = langid.identify(odd, F.lit(True), {"doc_id": F.col("doc_id")}).collect()
    assert {r["lang_pred"] for r in alone} <= {"en", "und"} and len(alone) == odd.count()
    assert langid.identify(none, F.lit(True), {"doc_id": F.col("doc_id")}).collect() == []
    assert {r["lang_pred"] for r in langid.identify(odd, F.lit(False), {"doc_id": F.col("doc_id")}).collect()} == {"und"}


def test_language_learns_from_few_texts_of_many_copies(spark):
    pick = random.Random(3)
    make = lambda letters: " ".join("".join(pick.choice(letters) for _ in range(5)) for _ in range(40))
    rare = [make("abcde") for _ in range(3)]
    rows = [(i, rare[i % 3], "aa", "s", 0) for i in range(400)] + [(400 + i, make("uvwxy"), "bb", "s", 0) for i in range(200)]
    docs = docs_of(spark, rows)
    model = langid.fit(docs, sample_per_language=20)
    assert model.languages == ["aa", "bb"]
    assert {model.predict(make("abcde"))[0] for _ in range(20)} == {"aa"} and {model.predict(make("uvwxy"))[0] for _ in range(20)} == {"bb"}


def test_codewords_are_distinct():
    for n in (1, 2, 3, 5, 6, 40):
        code = langid.codewords(n)
        assert code.shape[0] == n and len({tuple(r) for r in code.tolist()}) == n


# ------------------------------------------------------------ chat

@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a\nb", "<|im_sep|>"]),
                          st.text(alphabet=st.sampled_from("\\<|im_startepnd>[/INSTs]\n y"), max_size=30)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_chat_round_trip(turns):
    roles, texts = [r for r, _ in turns], [t for _, t in turns]
    text, spans = chat.format_turns(roles, texts)
    assert chat.parse_turns(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@given(st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "[", "x"]), max_size=8))
@settings(max_examples=300, deadline=None)
def test_escaped_text_holds_no_control_string(parts):
    text = "".join(parts)
    shown = chat.escape(text)
    assert chat.unescape(shown) == text and not any(c in shown for c in chat.CONTROL)


NODES = "c long, node long, parent long, role string, text string, score double"


def test_reply_trees_pick_the_best_path(spark):
    pick = random.Random(8)
    rows, tree = [], {}
    for c in range(6):
        for n in range(40):
            parent = None if n == 0 else pick.randrange(n)
            tree[c, n] = (parent, float(pick.randrange(10)))
            rows.append((c, n, parent, "user", f"t{n}", tree[c, n][1]))
    rows += [(None, 1, 77, None, None, None), (9, 5, None, "user", "only", 1.0)]   # an orphan; a lone root
    got = chat.format_trees(spark.createDataFrame(rows, NODES), top=2).collect()
    for c in range(6):
        paths = []
        for n in range(40):
            if n in {p for (k, _), (p, _) in tree.items() if k == c}:
                continue
            path, at = [], n
            while at is not None:
                path.append(at)
                at = tree[c, at][0]
            paths.append((-sum(tree[c, x][1] for x in path) / len(path), n, path[::-1]))
        for rank, (_, leaf, path) in enumerate(sorted(paths)[:2], 1):
            r, = [g for g in got if g["c"] == c and g["rank"] == rank]
            assert r["leaf"] == leaf and [t for _, t in chat.parse_turns(r["formatted"])] == [f"t{x}" for x in path]
    assert [chat.parse_turns(g["formatted"]) for g in got if g["c"] is None] == [[("", "")]]
    assert chat.format_trees(spark.createDataFrame([], NODES)).collect() == []


def test_reply_trees_refuse_circles_and_repeats(spark):
    for rows in ([(1, 1, 2, "u", "a", 0.0), (1, 2, 1, "u", "b", 0.0)], [(1, 1, None, "u", "a", 0.0)] * 2):
        with pytest.raises(ValueError):
            chat.format_trees(spark.createDataFrame(rows, NODES)).collect()


def test_chain_of_odd_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 3, "assistant", "x"), (2, 5, "assistant", "</s>[INST]")]
    nodes = chat.turns_as_chain(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text")
    got = {r["c"]: chat.parse_turns(r["formatted"]) for r in chat.format_trees(nodes).collect()}
    assert got == {1: [("", ""), ("user", "a"), ("user", "a")], None: [("assistant", "x")], 2: [("assistant", "</s>[INST]")]}
