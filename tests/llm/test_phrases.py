"""Phrase mining against brute force; ranges cut inside prefixes, control characters, odd rows."""

import random
import re
from collections import Counter

import pytest

from tillpoint.llm import phrases

SCHEMA = "doc_id long, text string, lang string, key string, m int, Rank long, stream string"


def brute(rows, min_count, top=2000):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    cand = {k: v for k, v in f.items() if v >= min_count and len(k[1]) > 1}
    out = []
    for (lang, p), a in cand.items():
        parts = lambda q: [q[i:j] for i in range(len(q)) for j in range(i + 1, len(q) + 1)]
        if any(lang == l2 and len(q) > len(p) and p in parts(q) and 100 * b >= 80 * a for (l2, q), b in cand.items()):
            continue
        score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), left, right))
    out.sort()
    rank, got = Counter(), []
    for lang, s, a, p, left, right in out:
        rank[lang] += 1
        if rank[lang] <= top:
            got.append((lang, rank[lang], p.decode(), -a, left, right, total[lang], -s))
    return sorted(got)


def run(spark, rows, min_count, **more):
    df = spark.createDataFrame([(i, t, lang, "k", 1, 5, "s") for i, (lang, t) in enumerate(rows)], SCHEMA).repartition(3)
    got = phrases.collocations(df, min_count=min_count, **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(3)
    words = ["a", "A", "a\x01", "a\x01b", "b", "é", "éa", "of", "the", "New", "york", "\x02", "z" * 40]
    glue = [" "] * 12 + [", ", ".", "\n", "\t", "  ", ": "]
    out = [(pick.choice(["en", "en", "de", None, "und"]), "".join(pick.choice(words) + pick.choice(glue) for _ in range(pick.randrange(0, 120)))) for _ in range(120)]
    out += [("en", None), ("en", ""), (None, " ., \n"), ("fr", "only once here"), ("en", "new york city of the " * 300)]
    return out + out[:9] * 3


@pytest.mark.parametrize("min_count", [1, 5, 30])
def test_equals_brute_force(spark, rows, min_count):
    given = rows if min_count > 1 else rows[:30]
    assert run(spark, given, min_count) == brute(given, min_count)


def test_ranges_and_chunks_change_nothing(spark, rows, monkeypatch):
    """Many ranges cut inside prefixes, small chunks and a coarse sample give the same counts."""
    want = run(spark, rows, 5)
    monkeypatch.setattr(phrases, "RANGE_PLACES", 40)
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 500)
    monkeypatch.setattr(phrases, "SAMPLE_PLACES", 500)
    assert run(spark, rows, 5) == want


def test_streams_cut_into_many_ranges(spark, rows):
    """Every prefix count is right wherever the streams are cut."""
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, rows, 5) == brute(rows, 5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_top_ties_and_empty_tables(spark, rows):
    assert run(spark, rows, 5, top=3) == brute(rows, 5, 3)
    assert run(spark, [], 5) == [] and run(spark, [("en", "a b"), (None, None)], 5) == []
