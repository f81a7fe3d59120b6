"""Registered queries against their SQL, and the pipeline's stages against brute force."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillpoint.llm import linededup, quality, simhash
from tillpoint.llm.queries import ORACLES, QUERIES
from tools.oracle_check import rows_key

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_its_sql(spark, tables, key):
    got = QUERIES[key](spark, SF)
    cols = sorted(got.columns)
    res = tables.execute(ORACLES[key])
    names = [d[0] for d in res.description]
    assert cols == sorted(names)
    want = [tuple(r[names.index(c)] for c in cols) for r in res.fetchall()]
    assert rows_key([tuple(r[c] for c in cols) for r in got.collect()], True) == rows_key(want, True)


def test_query_names():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_pipeline_stages_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kinds, seen = docs.dtypes, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.dtypes == kinds
        seen.append((docs.collect(), out.collect()))
        docs = out
    (d0, good), (_, lined), (_, one), (_, mixed), (_, coded) = seen

    failing = {r["doc_id"] for r in d0 if (m := quality.measure_text(r["text"] or ""))[0] < 10 or 100 * m[4] > 20 * m[0]}
    assert {r["doc_id"] for r in good} <= {r["doc_id"] for r in d0} - failing
    quiet = {r["doc_id"] for r in d0 if not quality._SYMBOL.search(r["text"] or "")} - failing
    assert len(quiet & {r["doc_id"] for r in good}) >= 0.98 * len(quiet)

    count = {}
    for r in good:
        for key in {linededup.line_key(x) for x in r["text"].split("\n")} - {""}:
            count[key] = count.get(key, 0) + 1
    want = {r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if count.get(linededup.line_key(x), 0) < 10) for r in good}
    assert {r["doc_id"]: r["text"] for r in lined} == want and all(r["n_chars"] == len(r["text"]) for r in lined)

    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) % (1 << 64) for r in lined}
    ids, group = sorted(prints), {}
    for i in ids:
        group[i] = i
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    assert sorted(r["doc_id"] for r in one) == sorted(set(group.values()))

    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in one}
    assert 0.7 < sum(len(r["text"]) for r in mixed) / sum(len(r["text"]) for r in one) < 1.3
    assert len(coded) == len(mixed) and all(r["decodes"] and r["n_tokens"] == len(r["token_ids"]) for r in coded)


def test_pipeline_on_an_empty_table_and_on_nulls(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    nulls = docs.select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes]).limit(3)
    for given in (docs.limit(0), nulls):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, given, SF).count() <= 3
