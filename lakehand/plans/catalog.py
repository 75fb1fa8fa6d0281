"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator key.

Each query reads the driver's tables (or rows Spark derives from them by the
rules in :mod:`lakehand.plans.fixtures`) and runs a library operator over them.
Its SQL twin lives in :mod:`lakehand.plans.oracle`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehand.functions import scalar as fx
from lakehand.operators import keys as K
from lakehand.operators import scd as S
from lakehand.plans import fixtures as X
from lakehand.plans.fixtures import TS1, TS2, TS3, Tables

QUERIES: dict = {}
BK, SK = "Customer_BK", "Customer_SK"
STAR = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


# --------------------------------------------------------------------------- dims

def dim_first(t: Tables, batch_key: bool = False) -> DataFrame:
    return S.scd2_first_load(X.customer_entity(X.customer_v1(t)), BK, SK, TS1, with_batch_key=batch_key)


def dim_merge(t: Tables, batch_key: bool = False) -> DataFrame:
    return S.scd2_apply(dim_first(t, batch_key), X.customer_entity(X.customer_v2(t)), BK, SK, TS2)


def dim_merge_second(t: Tables, batch_key: bool = False) -> DataFrame:
    # each batch is saved before the next one reads it; the checkpoint stands in for
    # that write so the previous merge is not recomputed for every use of the target
    from lakehand.session import cut_lineage
    return S.scd2_apply(cut_lineage(dim_merge(t, batch_key)), X.customer_entity(X.customer_v3(t)), BK, SK, TS3)


# --------------------------------------------------------------------------- scans, counts

@query
def scan_parquet(spark, sf_dir):
    """Plain Parquet scan (the raw registration's default branch)."""
    from lakehand.sources.files import read_source
    return read_source(spark, f"{sf_dir}/lineitem.parquet", fmt="parquet")


@query
def row_count(spark, sf_dir):
    """A1: row count of a table."""
    return _t(spark, sf_dir).lineitem.agg(F.count(F.lit(1)).alias("Counts")).withColumn("TableName", F.lit("lineitem"))


@query
def table_row_counts(spark, sf_dir):
    """A5: row counts for many tables, unioned (one small aggregate per table)."""
    t = _t(spark, sf_dir)
    parts = [getattr(t, n).agg(F.count(F.lit(1)).alias("Counts")).select(F.lit(n).alias("TableName"), "Counts")
             for n in STAR]
    return reduce(DataFrame.unionByName, parts)


# --------------------------------------------------------------------------- keys

@query
def business_key_concat(spark, sf_dir):
    """Composite business key text (no separator)."""
    li = _t(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     K.business_key("l_orderkey,l_linenumber").alias("Lineitem_BK"),
                     K.business_key(["l_orderkey", "l_linenumber"], prefix="1001").alias("Lineitem_Org_BK"))


@query
def surrogate_key(spark, sf_dir):
    """Load time + '-' + business key, placed first."""
    src = X.customer_entity(X.customer_v1(_t(spark, sf_dir)))
    return K.inject_sk(src, SK, BK, fx.ts_lit(TS1)).select(SK, BK)


@query
def surrogate_key_hash(spark, sf_dir):
    """D3: hashed surrogate key (sha2 variant; xxhash64 is unit-tested)."""
    src = X.customer_entity(X.customer_v1(_t(spark, sf_dir)))
    return K.inject_sk(src, SK, BK, fx.ts_lit(TS1), method="sha2").select(SK, BK)


@query
def scd_columns(spark, sf_dir):
    """SCD columns with an explicit end date (end-of-day)."""
    src = X.customer_entity(X.customer_v1(_t(spark, sf_dir)))
    return K.scd_columns(src, fx.ts_lit(TS1), end="2024-01-31 00:00:00")


@query
def batch_key(spark, sf_dir):
    """Batch key on a first load and after two merges (open and closed rows)."""
    return dim_merge_second(_t(spark, sf_dir), batch_key=True).select(BK, "_Created", "_Ended", "_Current", "_Batch_SK")


@query
def duplicate_keys(spark, sf_dir):
    """Keys occurring more than once."""
    return K.duplicate_keys(_t(spark, sf_dir).orders, "o_custkey")


# --------------------------------------------------------------------------- SCD

@query
def scd2_first_load(spark, sf_dir):
    """D9 first batch: every row becomes a current version."""
    return dim_first(_t(spark, sf_dir))


@query
def scd2_merge(spark, sf_dir):
    """D9 second batch: close changed, add new versions and new keys."""
    return dim_merge(_t(spark, sf_dir))


@query
def scd2_merge_second(spark, sf_dir):
    """D9 third batch on a table that already has history."""
    return dim_merge_second(_t(spark, sf_dir))


@query
def scd2_current(spark, sf_dir):
    """current versions only."""
    return S.current_rows(dim_merge_second(_t(spark, sf_dir)))


@query
def scd2_fact_batch_key(spark, sf_dir):
    """Fact variant, batch key maintained on open and close."""
    return dim_merge_second(_t(spark, sf_dir), batch_key=True)


@query
def scd2_changed_rows(spark, sf_dir):
    """F8 + J2: changed source rows, NULL-safe comparison."""
    t = _t(spark, sf_dir)
    return S.scd2_changed_rows(X.customer_entity(X.customer_v2(t)), dim_first(t), BK, null_safe=True, sk=SK)


@query
def scd2_changed_strict(spark, sf_dir):
    """F8 with plain <> (changes to or from NULL are ignored, N2)."""
    t = _t(spark, sf_dir)
    return S.scd2_changed_rows(X.customer_entity(X.customer_v2(t)), dim_first(t), BK, null_safe=False, sk=SK)


@query
def scd2_staged_rows(spark, sf_dir):
    """Single-pass merge staging rows."""
    t = _t(spark, sf_dir)
    return S.scd2_staged_rows(X.customer_entity(X.customer_v2(t)), dim_first(t), BK, sk=SK)


@query
def scd1_upsert(spark, sf_dir):
    """Update-all / insert-all on the key."""
    t = _t(spark, sf_dir)
    return S.scd1_upsert(X.customer_v1(t), X.customer_v2(t), "c_custkey")


@query
def scd1_update_all_versions(spark, sf_dir):
    """Overwrite attributes of every version of matched keys."""
    t = _t(spark, sf_dir)
    return S.scd1_update(dim_merge(t), X.customer_entity(X.customer_v3(t)), BK, sk=SK)


@query
def seed_if_absent(spark, sf_dir):
    """Insert-if-absent seed with the action per row."""
    t = _t(spark, sf_dir)
    return S.seed_if_absent(X.customer_v1(t), X.customer_v2(t), "c_custkey")


@query
def semi_known_keys(spark, sf_dir):
    """Source rows whose key is already known (left semi, no driver list)."""
    t = _t(spark, sf_dir)
    return X.customer_v2(t).join(X.customer_v1(t).select("c_custkey"), "c_custkey", "left_semi")


@query
def anti_new_keys(spark, sf_dir):
    """Source rows with new keys (left anti)."""
    t = _t(spark, sf_dir)
    return X.customer_v2(t).join(X.customer_v1(t).select("c_custkey"), "c_custkey", "left_anti")


@query
def run_metrics(spark, sf_dir):
    """Source, inserted, closed and table row counts of a merge."""
    t = _t(spark, sf_dir)
    src = X.customer_entity(X.customer_v2(t))
    merged = S.scd2_apply(dim_first(t), src, BK, SK, TS2, with_action=True)
    return S.run_metrics(src, merged)


@query
def scd_load_counts(spark, sf_dir):
    """Rows per load timestamp."""
    return S.load_counts(dim_merge_second(_t(spark, sf_dir)))


@query
def scd_restamp(spark, sf_dir):
    """Rewrite the SCD dates of a whole table."""
    return S.restamp(dim_merge(_t(spark, sf_dir)), "2021-12-19 00:00:00", "2021-12-26 00:00:00")


@query
def append_schema_merge(spark, sf_dir):
    """K2: append with schema merge (missing columns become NULL)."""
    from lakehand.sinks.tables import union_schema_merge
    t = _t(spark, sf_dir)
    old = X.customer_v1(t).select("c_custkey", "c_name", "c_mktsegment")
    new = X.customer_v2(t).select("c_custkey", "c_name", "c_acctbal")
    return union_schema_merge(old, new)


# --------------------------------------------------------------------------- lookups, flagship

def _flag_dim(t: Tables) -> DataFrame:
    """Dimension built from sentinel-cleaned sources (the minimum end-to-end slice)."""
    cols = ["c_name", "c_mktsegment"]
    first = S.scd2_first_load(fx.null_sentinels(X.customer_entity(X.customer_v1(t)), cols), BK, SK, TS1)
    return S.scd2_apply(first, fx.null_sentinels(X.customer_entity(X.customer_v2(t)), cols), BK, SK, TS2)


def _orders_fact(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias(BK),
                           (F.col("o_custkey") % 2 + 1).cast("int").alias("CountryCode"),
                           "o_totalprice", "o_orderdate")


def _with_country(dim: DataFrame) -> DataFrame:
    return dim.withColumn("CountryCode", (F.col(BK).cast("bigint") % 2 + 1).cast("int"))


@query
def fact_lookup_sk(spark, sf_dir):
    """Facts pick up current surrogate keys on (natural key, country)."""
    from lakehand.operators.joins import lookup
    t = _t(spark, sf_dir)
    return lookup(_orders_fact(t), _with_country(dim_merge(t)), [BK, "CountryCode"],
                  dim_columns=[SK, "c_mktsegment"])


@query
def fact_lookup_hot_key(spark, sf_dir):
    """J1 with measured hot keys: half of the orders are of one customer, only its key is salted."""
    from lakehand.operators.joins import lookup
    t = _t(spark, sf_dir)
    key = F.when(F.col("o_orderkey") % 2 == 0, F.lit(1)).otherwise(F.col("o_custkey"))
    fact = t.orders.select("o_orderkey", key.cast("string").alias(BK), "o_totalprice")
    return lookup(fact, dim_merge(t), BK, dim_columns=[SK, "c_mktsegment"], salt_buckets=16)


@query
def revenue_by_segment(spark, sf_dir):
    """Flagship: sentinels -> keys -> SCD2 x2 -> current SK lookup -> revenue by segment."""
    from lakehand.operators.joins import lookup
    t = _t(spark, sf_dir)
    f = lookup(_orders_fact(t), _with_country(_flag_dim(t)), [BK, "CountryCode"], dim_columns=[SK, "c_mktsegment"])
    return f.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("revenue"))


# --------------------------------------------------------------------------- incremental

@query
def wm_bounds(spark, sf_dir):
    """A3: low/high watermark of a source column."""
    from lakehand.operators.incremental import wm_bounds as bounds
    return bounds(_t(spark, sf_dir).orders, "o_orderdate")


@query
def wm_range(spark, sf_dir):
    """low < column <= high, pushed to the scan."""
    from lakehand.operators.incremental import wm_filter
    return wm_filter(_t(spark, sf_dir).orders, "o_orderdate", "1996-12-31 00:00:00", "1998-08-02 00:00:00")


@query
def wm_last_per_source(spark, sf_dir):
    """Latest non-NULL high watermark per source (ties kept)."""
    from lakehand.operators.incremental import last_watermark_per_source
    return last_watermark_per_source(X.extract_status(_t(spark, sf_dir)))


@query
def wm_batch_init(spark, sf_dir):
    """M1: one new status row per enabled source, low mark = last high mark; task list."""
    from lakehand.plans.control import batch_init
    t = _t(spark, sf_dir)
    return batch_init(X.extract_status(t), X.extract_manifest(t), "20240201", created_at=TS2)


@query
def wm_batch_status_rows(spark, sf_dir):
    """M1: the status rows that a batch appends, all columns."""
    from lakehand.plans.control import new_status_rows
    t = _t(spark, sf_dir)
    return new_status_rows(X.extract_status(t), X.extract_manifest(t), "20240201", created_at=TS2)


@query
def wm_full_vs_delta(spark, sf_dir):
    """F7 + F6 + S9: per source, full or incremental query text with its bounds."""
    from lakehand.plans.control import source_queries
    t = _t(spark, sf_dir)
    return source_queries(X.extract_manifest(t), X.extract_status(t), high="2024-02-01 00:00:00")


@query
def src_query_or_table(spark, sf_dir):
    """The manifest query, else SELECT * FROM [schema].[table]."""
    from lakehand.operators.incremental import base_query
    sheet = X.ingestion_sheet(_t(spark, sf_dir))
    return sheet.select("SheetRow", base_query("TableSchema", "TableName", "SourceQuery").alias("BaseQuery"))


@query
def trusted_query(spark, sf_dir):
    """SQL template with a {tableFqn} slot over the sanitised frame."""
    from lakehand.operators.shape import sanitize_columns, trusted_query as tq
    df = sanitize_columns(_t(spark, sf_dir).orders)
    return tq(spark, "SELECT o_orderkey, o_custkey, o_totalprice * 2 AS double_price FROM {tableFqn} "
                     "WHERE o_orderstatus = 'F'", df)


# --------------------------------------------------------------------------- shape

@query
def project_exprs(spark, sf_dir):
    """declarative projection list."""
    from lakehand.operators.shape import project_exprs as pe
    return pe(_t(spark, sf_dir).part, ["p_partkey", "upper(p_brand) AS brand", "p_retailprice * 2 AS price2",
                                       "concat(p_type, '-', p_size) AS type_size"])


@query
def prefix_columns(spark, sf_dir):
    """prefix every column."""
    from lakehand.operators.shape import prefix_columns as pc
    return pc(_t(spark, sf_dir).part, "src_")


@query
def sanitize_columns(spark, sf_dir):
    """space, comma and parentheses become '_'."""
    from lakehand.operators.shape import sanitize_columns as sc
    p = _t(spark, sf_dir).part.select(F.col("p_partkey").alias("p key"), F.col("p_name").alias("p name (full)"),
                                      F.col("p_brand").alias("brand, maker"), "p_size")
    return sc(p, style="select")


@query
def drop_key_columns(spark, sf_dir):
    """drop the key columns of an entity (fact form)."""
    from lakehand.operators.shape import drop_key_columns as dk
    return dk(dim_first(_t(spark, sf_dir)), keys=[SK, BK])


@query
def null_sentinels(spark, sf_dir):
    """'' -> (~empty~), NULL -> (~null~) on every string column."""
    p = _t(spark, sf_dir).part
    k = F.col("p_partkey")
    p = p.withColumn("p_name", F.when(k % 7 == 0, F.lit(None)).when(k % 5 == 0, F.lit("")).otherwise(F.col("p_name")))
    return fx.null_sentinels(p)


# --------------------------------------------------------------------------- unions, history

def _orgs(t: Tables):
    v1 = X.customer_v1(t)
    return v1.where(F.col("c_nationkey") % 2 == 0), v1.where(F.col("c_nationkey") % 2 == 1)


@query
def union_orgs(spark, sf_dir):
    """One entity from two organisations, prefixed key and country tag."""
    from lakehand.operators.union import union_orgs as uo
    a, b = _orgs(_t(spark, sf_dir))
    a, b = (fx.null_sentinels(x, ["c_mktsegment"]) for x in (a, b))
    return uo([(1, "1001", a), (2, "2002", b)], "c_custkey", BK)


@query
def unionise_query(spark, sf_dir):
    """One SQL text run per organisation, tagged and unioned."""
    from lakehand.operators.union import unionise
    a, b = _orgs(_t(spark, sf_dir))
    return unionise(spark, "SELECT c_custkey, c_name, c_acctbal FROM {customer} WHERE c_acctbal > 0",
                    [(1, {"customer": a}), (2, {"customer": b})])


def _li_base(t: Tables) -> DataFrame:
    li = t.lineitem
    y = F.year("l_shipdate")
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("Lineitem_BK"),
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
        F.make_timestamp_ntz(y, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("_Created"),
        fx.ts_lit(None).alias("_Ended"), F.lit(1).alias("_Current"), y.alias("_year"))


def _li_current(t: Tables) -> DataFrame:
    b = _li_base(t).where(F.col("_year") >= 2000)
    return b.select(F.concat(F.lit("cur-"), F.col("Lineitem_BK")).alias("Lineitem_SK"), "*").drop("_year")


def _li_history(t: Tables) -> DataFrame:
    """Yearly snapshots: a row shipped in year y is in the y and y+1 snapshots."""
    b = _li_base(t).withColumn("as_at", F.explode(F.array(F.col("_year"), F.col("_year") + 1))).drop("_year")
    return b.select(F.concat(F.col("as_at").cast("string"), F.lit("-"), F.col("Lineitem_BK")).alias("Lineitem_SK"), "*")


@query
def history_union_fact(spark, sf_dir):
    """Current ∪ history snapshots, keys dropped, distinct."""
    from lakehand.operators.union import history_union
    t = _t(spark, sf_dir)
    return history_union(_li_current(t), _li_history(t).drop("as_at"), drop=["Lineitem_SK", "Lineitem_BK"])


@query
def history_union_override(spark, sf_dir):
    """One snapshot gets fixed dates before the distinct union."""
    from lakehand.operators.union import history_union, override_snapshot
    t = _t(spark, sf_dir)
    h = override_snapshot(_li_history(t), "as_at", 1996, _Created=fx.ts_lit("2022-04-25 00:00:00"),
                          _Ended=fx.ts_lit("2022-05-01 00:00:00"))
    return history_union(_li_current(t), h.drop("as_at"), drop=["Lineitem_SK", "Lineitem_BK"])


@query
def history_union_dim(spark, sf_dir):
    """U4: dimension form (all columns) of current ∪ dated snapshots."""
    from lakehand.operators.union import history_union, union_all
    t = _t(spark, sf_dir)
    snaps = union_all([S.scd2_first_load(X.customer_entity(X.customer_v1(t)), BK, SK, TS1),
                       S.scd2_first_load(X.customer_entity(X.customer_v2(t)), BK, SK, TS2)])
    return history_union(dim_merge_second(t), snaps)


@query
def history_replay(spark, sf_dir):
    """H2: replay three as-at periods with start = end - 6 days and end = as-at."""
    from lakehand.operators.history import replay_periods
    t = _t(spark, sf_dir)
    periods = [(TS1, X.customer_entity(X.customer_v1(t))), (TS2, X.customer_entity(X.customer_v2(t))),
               (TS3, X.customer_entity(X.customer_v3(t)))]
    return replay_periods(periods, BK, SK, days=6)


def _line_versions(t: Tables):
    """Two batches of lines keyed by (l_orderkey, l_linenumber): some leave, some change, some come."""
    o, n = F.col("l_orderkey"), F.col("l_linenumber")
    v1 = t.lineitem.where((o + n) % 10 != 9).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    v2 = t.lineitem.where(o % 7 != 3).select(
        "l_orderkey", "l_linenumber", F.when(o % 5 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.when(n == 4, F.lit(None)).otherwise(F.col("l_returnflag")).alias("l_returnflag"))
    return v1, v2


@query
def scd2_composite_key(spark, sf_dir):
    """D9/D11 on a key of two columns, batch key kept from the first version."""
    v1, v2 = _line_versions(_t(spark, sf_dir))
    key = ["l_orderkey", "l_linenumber"]
    return S.scd2_apply(S.scd2_first_load(v1, key, "Line_SK", TS1, with_batch_key=True), v2, key, "Line_SK", TS2)


@query
def staged_composite_key(spark, sf_dir):
    """D10 on a key of two columns: the merge key is the text of the whole key."""
    v1, v2 = _line_versions(_t(spark, sf_dir))
    key = ["l_orderkey", "l_linenumber"]
    return S.scd2_staged_rows(v2, S.scd2_first_load(v1, key, "Line_SK", TS1), key, sk="Line_SK")


@query
def replay_snapshot_table(spark, sf_dir):
    """H2 on a table of yearly snapshots onto a stored target: one pass over all of them."""
    from lakehand.operators.history import replay_snapshots
    t = _t(spark, sf_dir)
    target = S.scd2_apply(dim_first(t), X.customer_entity(X.customer_v2(t)), BK, SK, TS2)
    later = X.customer_entity(X.customer_v3(t)).select(
        "*", F.explode(F.array(fx.ts_lit("2024-03-07 00:00:00"), fx.ts_lit("2024-04-07 00:00:00"))).alias("as_at"))
    moved = F.when((F.col("as_at") > fx.ts_lit(TS3) + F.expr("INTERVAL 20 DAYS")) & (F.col("c_nationkey") % 3 == 0),
                   F.lit("LATE")).otherwise(F.col("c_mktsegment"))
    return replay_snapshots(later.withColumn("c_mktsegment", moved), "as_at", BK, SK, days=6, target=target)


@query
def period_filter(spark, sf_dir):
    """keep one year; the range is pushed into the scan of the date column."""
    from lakehand.operators.shape import period_filter as pf
    li = pf(_t(spark, sf_dir).lineitem, "l_shipdate", 1997)
    return li.select("l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyyMMdd").alias("DateKey"))


@query
def empty_clone(spark, sf_dir):
    """Same columns, zero rows."""
    from lakehand.operators.shape import empty_clone as ec
    return ec(_t(spark, sf_dir).lineitem)


# --------------------------------------------------------------------------- control tables

@query
def config_pivot(spark, sf_dir):
    """key/value config pivoted to one row per key group (MAX)."""
    from lakehand.plans.control import config_pivot as cp
    return cp(X.event_config(_t(spark, sf_dir)), ["Key0", "Key1", "Key2", "Key3"])


@query
def register_source(spark, sf_dir):
    """M3: register a batch of new sources (ids, paths and defaults from config)."""
    from lakehand.plans.control import register_sources
    t = _t(spark, sf_dir)
    return register_sources(X.extract_manifest(t), X.ingestion_sheet(t), created_at=TS2)


@query
def limit_or_all(spark, sf_dir):
    """All sheet rows in order; 0 means no limit."""
    from lakehand.operators.shape import limit_or_all as loa
    return loa(X.ingestion_sheet(_t(spark, sf_dir)), 0, order_by=["SystemCode", "TableSchema", "TableName", "SheetRow"])


@query
def system_selection(spark, sf_dir):
    """Selected systems (blank = all enabled), distinct and ordered."""
    from lakehand.plans.control import register_sources, system_selection as ss
    t = _t(spark, sf_dir)
    m = X.extract_manifest(t)
    registered = register_sources(m, X.ingestion_sheet(t), created_at=TS2)
    full = m.select("SourceID", "SystemCode", "Enabled").unionByName(
        registered.select("SourceID", "SystemCode", "Enabled"))
    return ss(full, " click, view,, purchase, NEWSYS1 ")


@query
def list_to_rows(spark, sf_dir):
    """2.10: delimited text -> rows (explode(split))."""
    s = X.extract_status(_t(spark, sf_dir))
    return s.select("ID", fx.list_to_rows("RawPath", "/").alias("Segment")).where(F.col("Segment") != "")


@query
def group_list(spark, sf_dir):
    """Transforms per parallel group, in order."""
    from lakehand.plans.control import group_plan
    return group_plan(X.transform_manifest(_t(spark, sf_dir)))


@query
def transform_init(spark, sf_dir):
    """M2: transform status rows for enabled transforms, with the group list."""
    from lakehand.plans.control import transform_init as ti
    t = _t(spark, sf_dir)
    tm = X.transform_manifest(t)
    existing = X.log_table(t).where(F.col("TransformStatusID").isNotNull()).select(
        F.col("TransformStatusID").alias("ID"))
    return ti(existing, tm, "20240201", created_at=TS2)


@query
def transform_status_rows(spark, sf_dir):
    """M2: the transform status rows that a batch appends, all columns."""
    from lakehand.plans.control import new_transform_rows
    t = _t(spark, sf_dir)
    existing = X.log_table(t).where(F.col("TransformStatusID").isNotNull()).select(F.col("TransformStatusID").alias("ID"))
    return new_transform_rows(existing, X.transform_manifest(t), "20240201", created_at=TS2)


@query
def status_from_events(spark, sf_dir):
    """M4: last value per (row, property) from appended status events, pivoted."""
    from lakehand.plans.control import fold_status_events
    return fold_status_events(X.status_events(_t(spark, sf_dir)), ["RawStatus", "TrustedStatus", "SinkRowCount"])


@query
def log_routing(spark, sf_dir):
    """M5: log rows routed to the extract or the transform id."""
    from lakehand.plans.control import route_logs
    ev = _t(spark, sf_dir).events
    msgs = ev.select(F.col("event_id").alias("ID"), (F.col("event_id") % 2 == 0).alias("IsTransform"),
                     F.col("event_type").alias("ActivityType"), F.col("props").alias("Message"),
                     F.col("ts").alias("CreatedDTS"))
    return route_logs(msgs)


@query
def end_system_stamp(spark, sf_dir):
    """M8: stamp the end of one system's run in one batch."""
    from lakehand.plans.control import end_system_stamp as es
    s = X.extract_status(_t(spark, sf_dir))
    return es(s, "20240115", "click", TS2).select("ID", "BatchID", "SystemCode", "EndedDTS")


# --------------------------------------------------------------------------- monitoring

def _mon(t: Tables):
    return X.extract_status(t), X.extract_manifest(t), X.log_table(t)


@query
def log_parsed(spark, sf_dir):
    """V1: parsed log (top-level size paths, as in that view)."""
    from lakehand.plans.monitor import log_parsed as lp
    return lp(X.log_table(_t(spark, sf_dir)))


@query
def first_log_per_task(spark, sf_dir):
    """First copy log per task (sizes)."""
    from lakehand.plans.monitor import task_log_facts
    return task_log_facts(X.log_table(_t(spark, sf_dir))).select(
        "ExtractLoadStatusID", "FirstCopyLogID", "DataRead", "DataWritten")


@query
def last_log_per_task(spark, sf_dir):
    """Last log per task (run id, status, error) and log count."""
    from lakehand.plans.monitor import task_log_facts
    return task_log_facts(X.log_table(_t(spark, sf_dir))).select(
        "ExtractLoadStatusID", "LastLogID", "JsonPipelineRunId", "Status", "Error", "Logs")


@query
def latest_per_key(spark, sf_dir):
    """Latest refresh per report (ties kept)."""
    from lakehand.plans.monitor import report_lineage
    return report_lineage(X.report_refresh(_t(spark, sf_dir)))


@query
def task_status_flags(spark, sf_dir):
    """F16: stage status, current stage and task flags."""
    from lakehand.plans.monitor import task_status
    s, m, _ = _mon(_t(spark, sf_dir))
    return task_status(s, m, TS2).select("ID", "RawStatus", "TrustedStatus", "CurrentStage", "RawDuration",
                                         "TrustedDuration", "TotalDuration", "Pending", "InProgress", "Success", "Fail")


@query
def stage_ranks(spark, sf_dir):
    """Dense ranks of stage times within (batch, system)."""
    from lakehand.plans.monitor import stage_ranks as sr, task_status
    s, m, _ = _mon(_t(spark, sf_dir))
    return sr(task_status(s, m, TS2)).select("ID", "RawStartRank", "RawEndRank", "TrustedStartRank", "TrustedEndRank")


@query
def system_rollup(spark, sf_dir):
    """System-level counts, times and status."""
    from lakehand.plans.monitor import system_rollup as sr, task_status
    s, m, _ = _mon(_t(spark, sf_dir))
    return sr(task_status(s, m, TS2), TS2).select(
        "ID", "SystemPendingTasks", "SystemInProgressTasks", "SystemSuccessTasks", "SystemFailTasks",
        "SystemCompletedTasks", "SystemFinishedTasks", "SystemTotalTasks", "SystemStartDTS", "SystemEndDTS",
        "SystemDuration", "SystemStatus")


@query
def batch_rollup(spark, sf_dir):
    """Batch-level counts, times, status and ranks."""
    from lakehand.plans.monitor import batch_rollup as br, stage_ranks as sr, task_status
    s, m, _ = _mon(_t(spark, sf_dir))
    return br(sr(task_status(s, m, TS2)), TS2).select(
        "ID", "BatchPendingTasks", "BatchInProgressTasks", "BatchSuccessTasks", "BatchFailTasks",
        "BatchCompletedTasks", "BatchTotalTasks", "BatchStartDTS", "BatchEndDTS", "BatchDuration", "BatchStatus",
        "BatchTaskRank", "BatchSystemRank", "BatchRank")


@query
def rollup_from_deltas(spark, sf_dir):
    """V2/V3: the roll-up state after three deltas of status rows, merged one into the other."""
    from lakehand.plans.monitor import levels, merge_states, source_state, task_status
    s, m, _ = _mon(_t(spark, sf_dir))
    tasks = task_status(s, m, TS2)
    part = lambda k: tasks.where(F.col("ID") % 3 == k)  # noqa: E731  (all three are merged)
    state = source_state(part(0))
    for k in (1, 2):
        state = merge_states(state, source_state(part(k)))
    return levels(state, TS2)


@query
def latest_batch_flag(spark, sf_dir):
    """Global dense rank of batch ends and the latest-batch flag."""
    from lakehand.plans.monitor import batch_rollup as br, latest_batches, task_status
    s, m, _ = _mon(_t(spark, sf_dir))
    return latest_batches(br(task_status(s, m, TS2), TS2))


@query
def batch_status_log(spark, sf_dir):
    """V2: the full batch status log."""
    from lakehand.plans.monitor import batch_status_log as bsl
    s, m, lg = _mon(_t(spark, sf_dir))
    return bsl(s, m, lg, TS2)


def _lineage(t: Tables) -> DataFrame:
    from lakehand.plans.monitor import object_lineage as ol
    return ol(X.log_table(t), X.report_refresh(t), X.transform_manifest(t), X.extract_manifest(t))


@query
def object_lineage(spark, sf_dir):
    """V4: report -> curated -> trusted -> source lineage."""
    return _lineage(_t(spark, sf_dir))


@query
def health_dashboard(spark, sf_dir):
    """V3: batch log x lineage with success rate, quarter and age."""
    from lakehand.plans.monitor import batch_status_log as bsl, health_dashboard as hd
    t = _t(spark, sf_dir)
    s, m, lg = _mon(t)
    return hd(bsl(s, m, lg, TS2), _lineage(t), X.transform_manifest(t), m, TS2)


# --------------------------------------------------------------------------- metadata

def _meta_manifest(t: Tables) -> DataFrame:
    from lakehand.sources.metadata import metadata_json
    return metadata_json(X.column_metadata(t))


@query
def meta_capture(spark, sf_dir):
    """Column metadata captured per table as a JSON array (ordinal order)."""
    return _meta_manifest(_t(spark, sf_dir))


@query
def meta_generated_sql(spark, sf_dir):
    """V5: create-schema, create-table, select and external-table texts per table."""
    from lakehand.plans.metadata import generated_sql
    return generated_sql(_meta_manifest(_t(spark, sf_dir)))


@query
def manifest_refresh(spark, sf_dir):
    """V6: the generated select written back as the manifest's source query."""
    from lakehand.plans.metadata import generated_sql, refresh_manifest
    t = _t(spark, sf_dir)
    return refresh_manifest(X.extract_manifest(t), generated_sql(_meta_manifest(t)))


# --------------------------------------------------------------------------- scalar functions

@query
def path_template(spark, sf_dir):
    """2.10: landing path template filled from the task row and its time."""
    from lakehand.constants import INGESTION_DEFAULTS
    s = X.extract_status(_t(spark, sf_dir))
    ts = F.col("CreatedDTS")
    path = fx.fill_template(INGESTION_DEFAULTS["RawPath"], {
        "$SYSTEM$": F.col("SystemCode"), "$SCHEMA$": F.lit("dbo"),
        "$TABLE$": F.concat(F.lit("T"), X.source_key(F.col("SourceID")).cast("string")),
        "$yyyy$": F.date_format(ts, "yyyy"), "$MM$": F.date_format(ts, "MM"), "$dd$": F.date_format(ts, "dd"),
        "$HH$": F.date_format(ts, "HH"), "$mm$": F.date_format(ts, "mm"),
        "$guid$": F.concat(F.lit("g"), F.col("ID").cast("string")), "$EXT$": F.lit("parquet")})
    return s.select("ID", path.alias("RawPath"))


@query
def date_key_parse(spark, sf_dir):
    """2.10: yyyyMMdd key -> date."""
    o = _t(spark, sf_dir).orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("DateKey"))
    return o.withColumn("OrderDate", fx.date_key_parse("DateKey"))


@query
def quarter_label(spark, sf_dir):
    """2.10: 'Q' + quarter."""
    return _t(spark, sf_dir).events.select("event_id", fx.quarter_label("ts").alias("Period"))


@query
def tz_stamp(spark, sf_dir):
    """2.10: UTC -> local wall-clock stamp."""
    return _t(spark, sf_dir).events.select(
        "event_id", fx.tz_stamp("ts", "Australia/Sydney").alias("LocalTS"))


@query
def duration_seconds(spark, sf_dir):
    """2.10: durations in whole seconds (open stages measured to as-of)."""
    s = X.extract_status(_t(spark, sf_dir))
    return s.select("ID", fx.duration_seconds("RawStartDTS", "RawEndDTS", TS2).alias("RawSeconds"),
                    fx.duration_seconds("CreatedDTS", "EndedDTS").alias("TaskSeconds"))


@query
def unit_format(spark, sf_dir):
    """2.10: bytes -> MB text (fixed and parity divisors), fixed-point text."""
    lg = X.log_table(_t(spark, sf_dir)).where(F.col("ActivityType") == "copy-data")
    b = fx.json_value(F.col("Message"), "$.Output.dataRead").try_cast("decimal(16,2)")
    return lg.select("ID", fx.scaled_units(b).alias("DataReadMB"), fx.scaled_units(b, 1026).alias("DataReadParity"),
                     fx.fixed2(fx.json_value(F.col("Message"), "$.Output.throughput")).alias("Throughput"))


@query
def json_scalar_paths(spark, sf_dir):
    """2.10: scalar JSON paths, array index path, object guard."""
    from lakehand.plans.monitor import RUN_OUTPUT_SCHEMA, _scalar, parse_message
    m = fx.strip_crlf("Message")
    lg = X.log_table(_t(spark, sf_dir)).select("ID", parse_message(m).alias("__p"),
                                               F.from_json(m, RUN_OUTPUT_SCHEMA).alias("__r"))
    p, run = F.col("__p"), F.col("__r")["Output"]["runOutput"]["CuratedTransform"]
    return lg.select("ID", _scalar(p["PipelineRunId"]).alias("RunId"), _scalar(p["Status"]).alias("Status"),
                     _scalar(F.get(p["Output"]["errors"], 0)["Message"]).alias("CopyError"),
                     _scalar(p["Error"]).alias("PlainError"), _scalar(run["Destination"]).alias("Destination"))


@query
def props_to_rows(spark, sf_dir):
    """M9: run-output counts object -> (property, value) rows."""
    lg = X.log_table(_t(spark, sf_dir)).where(F.col("TransformStatusID").isNotNull())
    counts = F.get_json_object(fx.strip_crlf("Message"), "$.Output.runOutput.Counts")
    return lg.select("ID", fx.props_to_rows(counts).alias("Property", "Value"))


@query
def json_pages_explode(spark, sf_dir):
    """Landed JSON pages -> one row per element of the response property."""
    from lakehand.sources.files import explode_pages
    ev = _t(spark, sf_dir).events
    pages = ev.select("event_id", F.concat(F.lit('{"Response":[{"n":1,"v":'), F.col("props"),
                                           F.lit('},{"n":2,"v":'), F.col("props"), F.lit("}]}")).alias("page"))
    rows = explode_pages(pages, "Response", page_col="page", element_schema="struct<n:int,v:struct<k:bigint>>")
    return rows.select("event_id", "n", F.col("v.k").alias("k"))
