"""Compaction by file sizes, hash-dealt writes, forecasts of steady growth."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tillpoint.operators import forecast as FC
from tillpoint.session import scratch_path
from tillpoint.sinks import tables as K


def files(spark, path):
    return {r["path"]: r["length"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(path).select("path", "length").collect()}


def test_compaction_packs_small_files_only(spark):
    path = scratch_path(spark, "a b%c")      # names that a URI encodes
    df = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), (F.col("id") % 2).alias("side"))
    df.filter("id >= 30000").coalesce(1).write.partitionBy("side").parquet(path)
    large = files(spark, path)
    df.filter("id < 30000").repartition(12).write.mode("append").partitionBy("side").parquet(path)
    target = min(large.values())
    before = files(spark, path)
    done = K.compact_small_files(spark, path, target)
    after = files(spark, path)
    assert set(large) <= set(after) and all(after[f] == n for f, n in large.items())
    assert done["packed"] == len(before) - len(large) and len(after) == len(large) + done["made"] < len(before) / 2
    assert spark.read.parquet(path).exceptAll(df.select("id", "text", F.col("side").cast("int").alias("side"))).isEmpty()
    assert spark.read.parquet(path).count() == 40_000
    again = K.compact_small_files(spark, path, 100)
    assert again == {"packed": 0, "made": 0} and files(spark, path) == after


def test_compacted_write_deals_by_the_rows(spark):
    path = scratch_path(spark, "dealt")
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("p"))
    K.write_table(df, path, partition_by=["p"], compact_files=2)
    assert spark.read.parquet(path).count() == 1000 and 3 <= len(files(spark, path)) <= 6
    plan = df.repartition(F.col("p"), F.pmod(F.xxhash64("id", "p"), F.lit(2)))._jdf.queryExecution().optimizedPlan().toString()
    assert "rand" not in plan


def dense(y):
    """The same two least-squares stages in plain floats, residuals row by row."""
    d = [b - a for a, b in zip(y, y[1:])]
    a = sum(x * z for x, z in zip(d[1:], d)) / sum(z * z for z in d[:-1])
    rows = [(d[i], d[i - 1], d[i - 1] - a * d[i - 2]) for i in range(2, len(d))]
    xx, ee, xe = sum(p * p for _, p, _ in rows), sum(e * e for *_, e in rows), sum(p * e for _, p, e in rows)
    xd, ed = sum(p * q for q, p, _ in rows), sum(e * q for q, _, e in rows)
    det = xx * ee - xe * xe
    clip = lambda v: max(-0.99, min(0.99, v))
    phi, theta = clip((xd * ee - ed * xe) / det), clip((ed * xx - xd * xe) / det)
    u = [q - phi * p - theta * e for q, p, e in rows]
    return phi, theta, sum(x * x for x in u) / len(u)


def test_steady_growth_keeps_its_digits(spark):
    pick = random.Random(4)
    rows, want = [], {}
    for key, step in enumerate((0.0, 1e3, 1e6, 1e8)):
        y = [0.0]
        for _ in range(80):
            y.append(y[-1] + step + pick.gauss(0, 1))
        want[key] = dense(y)
        rows += [(key, dt.date(2024, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(y)]
    rows += [(90, dt.date(2024, 1, 1) + dt.timedelta(days=i), 5.0) for i in range(20)] + [(91, dt.date(2024, 1, 1), 1.0)]
    got = {r["product_id"]: r for r in FC.arima111_params(spark.createDataFrame(rows, "product_id int, date date, sales double")).collect()}
    for key, (phi, theta, sigma2) in want.items():
        assert abs(got[key]["phi"] - phi) < 1e-5 and abs(got[key]["theta"] - theta) < 1e-4 and abs(got[key]["sigma2"] / sigma2 - 1) < 1e-4
    assert got[90]["phi"] is None and got[91]["phi"] is None and got[91]["last_value"] == 1.0 and len(got) == 6


def test_the_job_ends_with_the_model_run(spark):
    from tillpoint.operators import customers as C
    from tillpoint.plans.retail_job import run_retail_job
    from tillpoint.sources import fixtures as fx

    sf = "/root/testdata/sf0.001"
    sources = {"customers": C.scalar_columns(fx.customers_raw(spark, sf)), "products": fx.products(spark, sf), "orders": fx.orders(spark, sf),
               "sales": fx.sales(spark, sf), "payments": fx.payments(spark, sf), "sessions": fx.sessions(spark, sf)}
    out = scratch_path(spark, "job6")
    first = run_retail_job(spark, sources, out, fx.AS_OF, orders_table="m1")["dim_customers"].collect()
    newer = sources["customers"].filter("customer_id % 5 = 0").withColumns({"last_name": F.lit("Moved"), "updated_at": F.lit(fx.AS_OF).cast(dict(sources["customers"].dtypes)["updated_at"])})
    again = run_retail_job(spark, sources | {"customers": sources["customers"].union(newer)}, out, fx.AS_OF, orders_table="m2")["dim_customers"].collect()
    assert len(first) == len(again) == len({r["customer_id"] for r in again}) > 50
    assert {r["last_name"] for r in again if r["customer_id"] % 5 == 0} == {"Moved"}
    assert {r for r in first if r["customer_id"] % 5} == {r for r in again if r["customer_id"] % 5}


def test_chi_square_tails_keep_their_digits(spark):
    """Against tails summed in 60 digits: P(X >= x) by the recurrence in the degrees of freedom, erfc by its series."""
    from decimal import Decimal, getcontext

    from tillpoint.functions.stats import chi2_sf

    getcontext().prec = 120
    pi = Decimal("3.14159265358979323846264338327950288419716939937510582097494459230781640628620899862803482534211706798214808651")

    def tail(x, k):
        h = Decimal(x) / 2
        if k % 2 == 0:
            term, total = Decimal(1), Decimal(0)
            for i in range(k // 2):
                total, term = total + term, term * h / (i + 1)
            return (-h).exp() * total
        z, total, n = h.sqrt(), Decimal(0), 0
        term = z
        while n < 2000 and (n < 5 or abs(term) > Decimal(10) ** -115):
            total, n = total + term, n + 1
            term = term * 2 * h / (2 * n + 1)
        out = 1 - 2 / pi.sqrt() * (-h).exp() * total
        extra = 2 * (h / pi).sqrt()
        for i in range(1, (k - 1) // 2 + 1):
            out, extra = out + (-h).exp() * extra, extra * h / (i + Decimal("0.5"))
        return out

    cases = [(x, k) for x in ("0.001", "0.5", "3.84", "7.9", "8.1", "30", "100", "180") for k in (1, 2, 3, 4, 7)]
    df = spark.createDataFrame([(float(x), k) for x, k in cases], "x double, k int").select(chi2_sf(F.col("x"), F.col("k")).alias("p"))
    for (x, k), r in zip(cases, df.collect()):
        want = float(tail(x, k))
        assert r["p"] > 0 and abs(r["p"] / want - 1) < 1e-9, (x, k, r["p"], want)


def test_compaction_streams_each_bin_through_its_own_task(spark, tmp_path):
    """Before, bins were dealt by hash and each task sorted its rows by bin, in memory that grew with the table."""
    path = str(tmp_path / "t")
    spark.range(6000).select("id", (F.col("id") % 5).alias("p")).repartition(8, "id").write.partitionBy("p").parquet(path)
    bins = K.small_file_bins(spark, path, 1 << 20)
    rows = K.rows_by_bin(spark, path, bins)
    assert "Sort [" not in rows._jdf.queryExecution().executedPlan().toString()
    got = {(r["k"], r["p"]) for r in rows.select(F.spark_partition_id().alias("k"), (F.col("id") % 5).alias("p")).distinct().collect()}
    assert len(bins) == 5 and got == {(k, int(names[0][0].rpartition("/")[0].rpartition("=")[2])) for k, names in enumerate(bins)}
    assert K.compact_small_files(spark, path, 1 << 20) == {"packed": sum(map(len, bins)), "made": 5}
    back = spark.read.parquet(path)
    assert back.count() == 6000 and back.filter("id % 5 <> p").isEmpty()
