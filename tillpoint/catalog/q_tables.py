"""Table lifecycle queries: scans, as-of reads, writes and read-backs,
upsert, compaction, catalog tables, retention, change feed, export.

Round-trip queries write into a fresh folder under the session's shared
checkpoint directory (``spark.checkpoint.dir``) and return the read-back
frame, so the check compares what actually landed on storage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillpoint.catalog.fixture_sql import with_inputs
from tillpoint.catalog.registry import register
from tillpoint.operators import customers as C
from tillpoint.operators import history as H
from tillpoint.session import scratch_path
from tillpoint.sinks import tables as K
from tillpoint.sources import fixtures as fx
from tillpoint.sources import tables as S
from tillpoint.sources.entities import CUSTOMER, EntitySpec

# the merge test works on a column subset of customers: key + the columns it carries
CUSTOMER_KEYED = EntitySpec("customers", ("customer_id",), ("customer_id",))

ASOF_TS = "2024-01-02 12:00:00"


@register("scan_table", """
select o_orderkey, o_custkey, o_totalprice from orders
where o_orderstatus = 'F' and o_totalprice > 100000""")
def q_scan_table(spark, sf):
    """Projection and filter reach the parquet scan (PushedFilters/ReadSchema)."""
    df = S.scan_table(spark, f"{sf}/orders.parquet")
    return (df.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000))
            .select("o_orderkey", "o_custkey", "o_totalprice"))


_ASOF = """
select * exclude (rn, op, version, commit_ts) from (
  select *, row_number() over (partition by order_id order by version desc) as rn
  from f_change_log where {pred}) where rn = 1 and op <> 'D'"""


@register("asof_version", with_inputs(["f_change_log"], _ASOF.format(pred="version <= 2")))
def q_asof_version(spark, sf):
    return H.latest_state(fx.change_log(spark, sf), "order_id", version=2)


@register("asof_timestamp", with_inputs(["f_change_log"],
                                        _ASOF.format(pred=f"commit_ts <= TIMESTAMP '{ASOF_TS}'")))
def q_asof_timestamp(spark, sf):
    return H.latest_state(fx.change_log(spark, sf), "order_id", timestamp=ASOF_TS)


@register("asof_latest_from_path", with_inputs(["f_change_log"], _ASOF.format(pred="true")))
def q_asof_latest_from_path(spark, sf):
    """The change log written as a table and read back as of 'latest'."""
    path = scratch_path(spark, "change_log")
    K.write_table(fx.change_log(spark, sf), path, "overwrite", partition_by=["version"])
    return S.read_as_of(spark, path, "order_id")


@register("schema_evolve_union", with_inputs(["f_orders"], """
select order_id, total_amount, order_status, null::varchar as priority from f_orders where order_status = 'F'
union all
select order_id, total_amount, order_status, priority from f_orders where order_status <> 'F'"""))
def q_schema_evolve_union(spark, sf):
    """Two appends, the second with an extra column; reading with schema
    merging yields the union with NULLs for the missing column."""
    o = fx.orders(spark, sf)
    path = scratch_path(spark, "evolving")
    K.write_table(o.filter("order_status = 'F'").select("order_id", "total_amount", "order_status"),
                  f"{path}/part=1", "overwrite")
    K.write_table(o.filter("order_status <> 'F'").select("order_id", "total_amount", "order_status", "priority"),
                  f"{path}/part=2", "overwrite")
    return S.scan_table(spark, path, schema_evolution=True).drop("part")


@register("schema_evolve_frames", with_inputs(["f_orders"], """
select order_id, total_amount, null::varchar as priority from f_orders where order_status = 'F'
union all
select order_id, null::double as total_amount, priority from f_orders where order_status <> 'F'"""))
def q_schema_evolve_frames(spark, sf):
    o = fx.orders(spark, sf)
    return S.union_evolving([o.filter("order_status = 'F'").select("order_id", "total_amount"),
                             o.filter("order_status <> 'F'").select("order_id", "priority")])


# --------------------------------------------------------------------------- writes
@register("write_overwrite_roundtrip", with_inputs(["f_orders"], "select * from f_orders where total_amount > 200"))
def q_write_overwrite(spark, sf):
    o = fx.orders(spark, sf)
    path = scratch_path(spark, "overwrite")
    K.write_table(o, path, "overwrite")
    K.write_table(o.filter("total_amount > 200"), path, "overwrite")
    return spark.read.parquet(path)


@register("write_append_roundtrip", with_inputs(["f_orders"], "select * from f_orders"))
def q_write_append(spark, sf):
    o = fx.orders(spark, sf)
    path = scratch_path(spark, "append")
    K.write_table(o.filter("order_status = 'F'"), path, "overwrite")
    K.write_table(o.filter("order_status <> 'F'"), path, "append")
    return spark.read.parquet(path)


@register("write_partitioned_roundtrip", with_inputs(["f_orders"], """
select *, cast(year(order_date) as integer) as year, cast(month(order_date) as integer) as month from f_orders"""))
def q_write_partitioned(spark, sf):
    o = fx.orders(spark, sf).withColumns({"year": F.year("order_date"), "month": F.month("order_date")})
    path = scratch_path(spark, "partitioned")
    K.write_table(o, path, "overwrite", partition_by=["year", "month"])
    return spark.read.parquet(path)


@register("dynamic_partition_overwrite", with_inputs(["f_orders"], """
select * replace (case when order_status = 'F' then total_amount * 2 else total_amount end as total_amount)
from f_orders"""))
def q_dynamic_partition_overwrite(spark, sf):
    """Overwrite only the partition present in the new data (status F)."""
    o = fx.orders(spark, sf)
    path = scratch_path(spark, "dynamic")
    K.write_table(o, path, "overwrite", partition_by=["order_status"])
    changed = o.filter("order_status = 'F'").withColumn("total_amount", F.col("total_amount") * 2)
    K.write_table(changed, path, "overwrite", partition_by=["order_status"], dynamic_partitions=True)
    return spark.read.parquet(path)


@register("compact_small_files", with_inputs(["f_orders"], "select *, 'kept' as large_file from f_orders"))
def q_compact_small_files(spark, sf):
    """Small files packed by size in place; the content is unchanged and the large file keeps its name."""
    o = fx.orders(spark, sf)
    path = scratch_path(spark, "packed")
    o.filter("order_id % 2 = 0").repartition(24, "order_id").write.parquet(path)
    o.filter("order_id % 2 = 1").coalesce(1).write.mode("append").parquet(path)
    listed = lambda: spark.read.format("binaryFile").load(path).select("path", "length")
    large = listed().orderBy(F.desc("length")).first()
    done = K.compact_small_files(spark, path, large["length"])
    kept = listed().filter(F.col("path") == large["path"]).count() == 1 and done["made"] < done["packed"]
    return spark.read.parquet(path).withColumn("large_file", F.lit("kept" if kept else "lost"))


@register("compact_roundtrip", with_inputs(["f_orders"], "select * from f_orders"))
def q_compact_roundtrip(spark, sf):
    """Many small files rewritten as few; content unchanged."""
    o = fx.orders(spark, sf)
    src, dst = scratch_path(spark, "fragmented"), scratch_path(spark, "compacted")
    o.repartition(32).write.mode("overwrite").parquet(src)
    K.compact(spark, src, dst, files=2)

    def n_files(path):       # works on any file system Spark reads
        return spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    before, after = n_files(src), n_files(dst)
    if not after < before:
        raise AssertionError(f"compaction did not reduce files: {before} -> {after}")
    return spark.read.parquet(dst)


@register("create_table_roundtrip", with_inputs(["f_orders"], """
select *, cast(year(order_date) as integer) as year from f_orders"""))
def q_create_table_roundtrip(spark, sf):
    o = fx.orders(spark, sf).withColumn("year", F.year("order_date"))
    name = f"orders_{uuid.uuid4().hex[:8]}"
    table = K.create_table(o, name, database="tillpoint", path=scratch_path(spark, name),
                           partition_by=["year"], comment="orders by year",
                           properties={"quality": "gold", "steward": "retail"}, overwrite=True)
    K.set_table_properties(spark, table, {"retention_hours": "168"})
    return spark.table(table)


@register("export_parquet_roundtrip", with_inputs(["f_orders"], "select * from f_orders"))
def q_export_parquet(spark, sf):
    path = scratch_path(spark, "export")
    K.export_parquet(fx.orders(spark, sf), path, partition_by=["priority"], compression="zstd")
    return spark.read.parquet(path)


# --------------------------------------------------------------------------- merge / history
_CUST = "customer_id, first_name, last_name, email, loyalty_tier, updated_at"


@register("merge_upsert", with_inputs(["f_customers_raw", "f_customers"], f"""
select {_CUST} from f_customers
where customer_id not in (select customer_id from src)
union all
select {_CUST} from src""", ctes=[("src", f"""
    select {_CUST} from f_customers_raw where last_name like 'Relast%'
    union all
    select customer_id + 1000000000 as customer_id, first_name, last_name, email, loyalty_tier, updated_at
    from f_customers where customer_id % 97 = 0""")]))
def q_merge_upsert(spark, sf):
    cols = [c.strip() for c in _CUST.split(",")]
    target = fx.customers(spark, sf).select(*cols)
    raw = fx.customers_raw(spark, sf).select(*cols)
    updates = raw.filter(F.col("last_name").startswith("Relast"))
    inserts = target.filter(F.col("customer_id") % 97 == 0).withColumn(
        "customer_id", F.col("customer_id") + 1000000000)
    return CUSTOMER_KEYED.merge(target, updates.unionByName(inserts))


@register("merge_into_table", with_inputs(["f_customers_raw", "f_customers"], f"""
select {_CUST} from f_customers
where customer_id not in (select customer_id from src)
union all
select {_CUST} from src""", ctes=[("src", f"""
    select {_CUST} from f_customers_raw where last_name like 'Relast%'
    union all
    select customer_id + 1000000000 as customer_id, first_name, last_name, email, loyalty_tier, updated_at
    from f_customers where customer_id % 97 = 0""")]))
def q_merge_into_table(spark, sf):
    """The same upsert against a stored, versioned table: version 1 holds
    the customers, the merge appends version 2, the latest state is read."""
    cols = [c.strip() for c in _CUST.split(",")]
    target = fx.customers(spark, sf).select(*cols)
    raw = fx.customers_raw(spark, sf).select(*cols)
    updates = raw.filter(F.col("last_name").startswith("Relast"))
    inserts = target.filter(F.col("customer_id") % 97 == 0).withColumn(
        "customer_id", F.col("customer_id") + 1000000000)
    path = scratch_path(spark, "customer_log")
    H.merge_into_log(spark, path, target, "customer_id", "2024-01-01 00:00:00")
    return H.merge_into_log(spark, path, updates.unionByName(inserts), "customer_id", "2024-01-02 00:00:00")


@register("retention_keep", with_inputs(["f_change_log"], f"""
select l.* from f_change_log l
left join (select order_id, max(version) as fl from f_change_log
           where commit_ts <= TIMESTAMP '{ASOF_TS}' group by order_id) f using (order_id)
where f.fl is null or l.version >= f.fl"""))
def q_retention_keep(spark, sf):
    return H.retention(fx.change_log(spark, sf), "order_id", ASOF_TS)


@register("retention_dry_run", with_inputs(["f_change_log"], f"""
select l.* from f_change_log l
join (select order_id, max(version) as fl from f_change_log
      where commit_ts <= TIMESTAMP '{ASOF_TS}' group by order_id) f using (order_id)
where l.version < f.fl"""))
def q_retention_dry_run(spark, sf):
    return H.retention(fx.change_log(spark, sf), "order_id", ASOF_TS, dry_run=True)


_STATE = """
select * exclude (rn, op, version, commit_ts) from (
  select *, row_number() over (partition by order_id order by version desc) as rn
  from f_change_log where version <= {v}) where rn = 1 and op <> 'D'"""


@register("change_feed", with_inputs(["f_change_log"], """
select order_id, n.total_amount, n.order_status, n.customer_id, 'insert' as _change_type
from v3 n anti join v1 o using (order_id)
union all
select order_id, o.total_amount, o.order_status, o.customer_id, 'delete' from v1 o anti join v3 n using (order_id)
union all
select order_id, o.total_amount, o.order_status, o.customer_id, 'update_preimage'
from v1 o join v3 n using (order_id)
where o.total_amount is distinct from n.total_amount or o.order_status is distinct from n.order_status
   or o.customer_id is distinct from n.customer_id
union all
select order_id, n.total_amount, n.order_status, n.customer_id, 'update_postimage'
from v1 o join v3 n using (order_id)
where o.total_amount is distinct from n.total_amount or o.order_status is distinct from n.order_status
   or o.customer_id is distinct from n.customer_id""", ctes=[("v1", _STATE.format(v=1)), ("v3", _STATE.format(v=3))]))
def q_change_feed(spark, sf):
    log = fx.change_log(spark, sf)
    return H.change_feed(H.latest_state(log, "order_id", version=1),
                         H.latest_state(log, "order_id", version=3), "order_id")


# --------------------------------------------------------------------------- entity load / quarantine


@register("customer_write_roundtrip", with_inputs(["f_customers"], "select * from f_customers"))
def q_customer_write_roundtrip(spark, sf):
    """Customer entity written partitioned by loyalty tier (NULL tier goes to
    the default partition and reads back as NULL)."""
    path = scratch_path(spark, "customers")
    K.write_table(CUSTOMER.validate(C.scalar_columns(fx.customers(spark, sf))), path, "overwrite",
                  partition_by=list(CUSTOMER.partition_by), compact_files=1)
    return spark.read.parquet(path)


@register("load_customer_entity", with_inputs(["f_customers"], "select * from f_customers"))
def q_load_customer_entity(spark, sf):
    path = scratch_path(spark, "customer_entity")
    K.write_table(C.scalar_columns(fx.customers(spark, sf)), path, "overwrite")
    return CUSTOMER.validate(S.scan_table(spark, path))


@register("quarantine_append", with_inputs(["f_customers_raw"], """
select * exclude (rn, loyalty_tier), coalesce(loyalty_tier, 'standard') as loyalty_tier,
       concat_ws(' ', first_name, last_name) as full_name
from (select *, row_number() over (partition by customer_id order by updated_at desc) as rn
      from f_customers_raw) t
where rn = 1 and not coalesce(customer_id is not null
      and regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$')
      and registration_date <= TIMESTAMP '2002-01-01 00:00:00', false)"""))
def q_quarantine_append(spark, sf):
    """Rejected customers appended to a quarantine table (two batches)."""
    _, invalid = C.process_customer_data(C.scalar_columns(fx.customers_raw(spark, sf)), fx.AS_OF)
    path = scratch_path(spark, "quarantine")
    first = F.col("loyalty_tier").eqNullSafe("standard")
    K.write_table(invalid.filter(first), path, "append")
    K.write_table(invalid.filter(~first), path, "append")
    return spark.read.parquet(path)
