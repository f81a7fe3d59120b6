"""Substring dedup against brute force over all windows, odd inputs included."""

import random
import re

import numpy as np
import pytest

from tillpoint.llm import substring, words

SCHEMA = "doc_id long, text string, rk int, doc string, N_Words string, starts int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


def brute(rows, window):
    """(doc_id, n_words, n_removed, kept text) per row, straight from the definition."""
    split = [(LAST if d is None else d, WORD.findall(t or "")) for d, t in rows]
    least = {}
    for d, w in split:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            least[k] = min(least.get(k, LAST), d)
    out = []
    for (given, _), (d, w) in zip(rows, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        out.append((given, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def run(spark, rows, window):
    df = spark.createDataFrame([(*r, 1, "d", "n", 2) for r in rows], SCHEMA).repartition(3)
    got = substring.dedup_substrings(df, window)
    assert got.columns == ["doc_id", "text", "rk", "doc", "starts", "n_words", "n_removed"]
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got.collect()), key=repr)


def test_covers_hold_every_distance():
    for v, cover in substring.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    for window in range(1, 200):
        period, cover = substring.cover_for(window)
        assert window - period + 1 >= 1 and len(cover) <= period


@pytest.mark.parametrize("window", [2, 7, 50])
def test_equals_brute_force(spark, window):
    pick = random.Random(window)
    vocab = [f"w{i}" for i in range(400)]
    words_of = lambda n: [pick.choice(vocab) for _ in range(n)]
    shared = [words_of(n) for n in (window, window + 1, window + 40, 3 * window, max(1, window - 1))]
    rows = []
    for i in range(60):
        body = words_of(pick.randrange(0, 3 * window))
        for s in pick.sample(shared, pick.randrange(0, 3)):
            at = pick.randrange(len(body) + 1)
            body[at:at] = s
        rows.append((pick.randrange(40), pick.choice([" ", "\n", "\t "]).join(body)))
    rows += [(3, " ".join(shared[2] * 2)), (2, " ".join(shared[2])), (2, " ".join(shared[2])), (None, " ".join(shared[3])), (None, " ".join(shared[3])),
             (50, None), (51, ""), (52, " \n\t "), (None, None), (53, "é" * 30 + "   " + "ß"), (54, " ".join(words_of(20_000)))]
    rows += [(60 + i, rows[-1][1] if i % 2 else rows[1][1]) for i in range(6)]
    assert run(spark, rows, window) == brute(rows, window)


def test_ranges_alone_and_sample_alone_agree(spark, monkeypatch):
    """Without sampled keys everything meets in ranges; the result is the same."""
    rows = [(i, " ".join(["a b c d e f g h"] * 20 if i % 3 else [f"x{i} y{j}" for j in range(60)])) for i in range(40)]
    want = brute(rows, 50)
    assert run(spark, rows, 50) == want
    monkeypatch.setattr(substring, "COMMON_KEYS", 0)
    assert run(spark, rows, 50) == want
    monkeypatch.setattr(substring, "COMMON_KEYS", 3)
    assert run(spark, rows, 50) == want


def test_empty_table_and_short_rows(spark):
    assert run(spark, [], 50) == []
    assert run(spark, [(1, "one two"), (2, "one two")], 50) == [(1, 2, 0, "one two"), (2, 2, 0, "one two")]


def test_word_bounds_equal_the_pattern():
    import pyarrow as pa

    pick = random.Random(1)
    texts = ["".join(pick.choice("ab é\t\n\x0b. ") for _ in range(pick.randrange(30))) for _ in range(300)] + ["", None]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    sep = words.separators(" \t\n\x0b\x0c\r")
    for size in (1, 50, 1 << 20):
        found, hashes = [], {}
        for part, raw, offsets in words.chunks([batch], "text", size):
            w = words.Words(raw, offsets, sep)
            strings = [x.decode() for x in w.strings(np.arange(len(w.starts))).to_pylist()]
            for s, h in zip(strings, w.hashes(words.byte_table(1)).tolist()):
                assert hashes.setdefault(s, h) == h
            found += [strings[w.first[i]:w.first[i + 1]] for i in range(len(part))]
        assert found == [WORD.findall(t or "") for t in texts] and len(set(hashes.values())) == len(hashes)
