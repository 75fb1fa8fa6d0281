"""DuckDB SQL twins of the registered queries (the correctness oracle)."""

from __future__ import annotations

from lakehand.plans.oracle_fixtures import (CUSTOMER_V1, CUSTOMER_V2, CUSTOMER_V3, EXTRACT_MANIFEST,
                                            EXTRACT_STATUS, LOG, TRANSFORM_MANIFEST, TS1, TS2, TS3, entity,
                                            with_ctes)

ORACLE: dict[str, str] = {}
ATTRS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
FMT = "'%y%m%d%H%M%S'"


def _sk(ts: str, bk: str = "Customer_BK") -> str:
    return f"strftime({ts}, {FMT}) || '-' || {bk}"


def _bkey(created: str, ended: str, current: str) -> str:
    return (f"CAST(strftime({created}, {FMT}) || COALESCE(strftime({ended}, {FMT}), '000000000000') || "
            f"CAST({current} AS VARCHAR) AS DECIMAL(25,0))")


def first_load_sql(src: str, ts: str, end: str | None = None, batch: bool = False) -> str:
    ended = "CAST(NULL AS TIMESTAMP)" if end is None else f"({end} + INTERVAL 1 DAY - INTERVAL 1 SECOND)"
    b = f", {_bkey(ts, ended, '1')} AS _Batch_SK" if batch else ""
    return (f"SELECT {_sk(ts)} AS Customer_SK, Customer_BK, {', '.join(ATTRS)}, {ts} AS _Created, "
            f"{ended} AS _Ended, 1 AS _Current{b} FROM {src}")


def changed_sql(null_safe: bool = True, a: str = "s", b: str = "t") -> str:
    if null_safe:
        return "(" + " OR ".join(f"{a}.{c} IS DISTINCT FROM {b}.{c}" for c in ATTRS) + ")"
    return "COALESCE(" + " OR ".join(f"{a}.{c} <> {b}.{c}" for c in ATTRS) + ", FALSE)"


def scd2_step_sql(target: str, src: str, ts: str, batch: bool = False, end: str | None = None) -> str:
    """One SCD2 merge step written as four UNION ALL branches."""
    cols = ["Customer_SK", "Customer_BK", *ATTRS, "_Created", "_Ended", "_Current"] + (["_Batch_SK"] if batch else [])
    tcols = ", ".join(f"t.{c}" for c in cols)
    ended_new = "CAST(NULL AS TIMESTAMP)" if end is None else f"({end} + INTERVAL 1 DAY - INTERVAL 1 SECOND)"
    close_end = f"({ts} - INTERVAL 1 SECOND)"
    closed_cols = []
    for c in cols:
        if c == "_Ended":
            closed_cols.append(f"{close_end} AS _Ended")
        elif c == "_Current":
            closed_cols.append("0 AS _Current")
        elif c == "_Batch_SK":
            closed_cols.append(f"{_bkey('t._Created', close_end, '0')} AS _Batch_SK")
        else:
            closed_cols.append(f"t.{c}")
    new_cols = [f"{_sk(ts, 's.Customer_BK')} AS Customer_SK", "s.Customer_BK", *[f"s.{c}" for c in ATTRS],
                f"{ts} AS _Created", f"{ended_new} AS _Ended", "1 AS _Current"]
    if batch:
        new_cols.append(f"{_bkey(ts, ended_new, '1')} AS _Batch_SK")
    ch = changed_sql(True)
    return f"""
SELECT {", ".join(cols)} FROM {target} WHERE _Current <> 1 OR Customer_BK IS NULL
UNION ALL
SELECT {tcols} FROM {target} t LEFT JOIN {src} s ON t.Customer_BK = s.Customer_BK
 WHERE t._Current = 1 AND t.Customer_BK IS NOT NULL AND (s.Customer_BK IS NULL OR NOT {ch})
UNION ALL
SELECT {", ".join(closed_cols)} FROM {target} t JOIN {src} s ON t.Customer_BK = s.Customer_BK
 WHERE t._Current = 1 AND {ch}
UNION ALL
SELECT {", ".join(new_cols)} FROM {src} s LEFT JOIN (SELECT * FROM {target} WHERE _Current = 1) t
  ON t.Customer_BK = s.Customer_BK
 WHERE (t.Customer_BK IS NOT NULL AND {ch})
    OR (t.Customer_BK IS NULL AND NOT EXISTS (SELECT 1 FROM {target} h WHERE h.Customer_BK = s.Customer_BK))"""


def dim_ctes(batch: bool = False, upto: int = 3) -> dict:
    c = {"v1": CUSTOMER_V1, "s1": entity("v1"), "d1": first_load_sql("s1", TS1, batch=batch)}
    if upto >= 2:
        c.update(v2=CUSTOMER_V2, s2=entity("v2"), d2=scd2_step_sql("d1", "s2", TS2, batch))
    if upto >= 3:
        c.update(v3=CUSTOMER_V3, s3=entity("v3"), d3=scd2_step_sql("d2", "s3", TS3, batch))
    return c


STAR = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

ORACLE.update({
    "scan_parquet": "SELECT * FROM lineitem",
    "row_count": "SELECT 'lineitem' AS TableName, COUNT(*) AS Counts FROM lineitem",
    "table_row_counts": " UNION ALL ".join(f"SELECT '{n}' AS TableName, COUNT(*) AS Counts FROM {n}" for n in STAR),
    "business_key_concat": """SELECT l_orderkey, l_linenumber,
        CAST(l_orderkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) AS Lineitem_BK,
        '1001' || CAST(l_orderkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) AS Lineitem_Org_BK FROM lineitem""",
    "surrogate_key": with_ctes(f"SELECT {_sk(TS1)} AS Customer_SK, Customer_BK FROM s1",
                               v1=CUSTOMER_V1, s1=entity("v1")),
    "surrogate_key_hash": with_ctes(f"SELECT sha256({_sk(TS1)}) AS Customer_SK, Customer_BK FROM s1",
                                    v1=CUSTOMER_V1, s1=entity("v1")),
    "scd_columns": with_ctes(f"""SELECT Customer_BK, {', '.join(ATTRS)}, {TS1} AS _Created,
        TIMESTAMP '2024-01-31 23:59:59' AS _Ended, 1 AS _Current FROM s1""", v1=CUSTOMER_V1, s1=entity("v1")),
    "batch_key": with_ctes("SELECT Customer_BK, _Created, _Ended, _Current, _Batch_SK FROM d3", **dim_ctes(True)),
    "duplicate_keys": "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1",
    "scd2_first_load": with_ctes("SELECT * FROM d1", **dim_ctes(upto=1)),
    "scd2_merge": with_ctes("SELECT * FROM d2", **dim_ctes(upto=2)),
    "scd2_merge_second": with_ctes("SELECT * FROM d3", **dim_ctes()),
    "scd2_current": with_ctes("SELECT * FROM d3 WHERE _Current = 1", **dim_ctes()),
    "scd2_fact_batch_key": with_ctes("SELECT * FROM d3", **dim_ctes(True)),
    "scd2_changed_rows": with_ctes(f"""SELECT s.* FROM s2 s JOIN d1 t ON s.Customer_BK = t.Customer_BK
        WHERE t._Current = 1 AND {changed_sql(True)}""", **dim_ctes(upto=2)),
    "scd2_changed_strict": with_ctes(f"""SELECT s.* FROM s2 s JOIN d1 t ON s.Customer_BK = t.Customer_BK
        WHERE t._Current = 1 AND {changed_sql(False)}""", **dim_ctes(upto=2)),
    "scd2_staged_rows": with_ctes(f"""SELECT CAST(NULL AS VARCHAR) AS MergeKey, s.* FROM s2 s JOIN d1 t
        ON s.Customer_BK = t.Customer_BK WHERE t._Current = 1 AND {changed_sql(True)}
        UNION ALL SELECT Customer_BK AS MergeKey, * FROM s2""", **dim_ctes(upto=2)),
    "scd1_upsert": with_ctes("""SELECT * FROM v1 WHERE c_custkey IS NULL OR c_custkey NOT IN (SELECT c_custkey FROM v2)
        UNION ALL SELECT * FROM v2""", v1=CUSTOMER_V1, v2=CUSTOMER_V2),
    "scd1_update_all_versions": with_ctes(f"""SELECT t.Customer_SK, t.Customer_BK,
        {', '.join(f'CASE WHEN s.Customer_BK IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}' for c in ATTRS)},
        t._Created, t._Ended, t._Current FROM d2 t LEFT JOIN s3 s ON t.Customer_BK = s.Customer_BK""",
                                          **dim_ctes(upto=2), v3=CUSTOMER_V3, s3=entity("v3")),
    "seed_if_absent": with_ctes("""SELECT *, CAST(NULL AS VARCHAR) AS _Action FROM v1
        UNION ALL SELECT *, 'INSERT' AS _Action FROM v2 WHERE NOT EXISTS (SELECT 1 FROM v1 WHERE v1.c_custkey = v2.c_custkey)""",
                                v1=CUSTOMER_V1, v2=CUSTOMER_V2),
    "semi_known_keys": with_ctes("SELECT * FROM v2 WHERE EXISTS (SELECT 1 FROM v1 WHERE v1.c_custkey = v2.c_custkey)",
                                 v1=CUSTOMER_V1, v2=CUSTOMER_V2),
    "anti_new_keys": with_ctes("SELECT * FROM v2 WHERE NOT EXISTS (SELECT 1 FROM v1 WHERE v1.c_custkey = v2.c_custkey)",
                               v1=CUSTOMER_V1, v2=CUSTOMER_V2),
    "run_metrics": with_ctes(f"""SELECT (SELECT COUNT(*) FROM s2) AS SpotCount,
        (SELECT COUNT(*) FROM d2 WHERE _Created = {TS2}) AS InsertCount,
        (SELECT COUNT(*) FROM d2 WHERE _Current = 0 AND _Ended = {TS2} - INTERVAL 1 SECOND) AS UpdateCount,
        (SELECT COUNT(*) FROM d2) AS CuratedCount""", **dim_ctes(upto=2)),
    "scd_load_counts": with_ctes("SELECT _Created, COUNT(*) AS Counts FROM d3 GROUP BY _Created", **dim_ctes()),
    "scd_restamp": with_ctes(f"""SELECT Customer_SK, Customer_BK, {', '.join(ATTRS)},
        TIMESTAMP '2021-12-19 00:00:00' AS _Created, TIMESTAMP '2021-12-26 00:00:00' AS _Ended, _Current FROM d2""",
                             **dim_ctes(upto=2)),
    "append_schema_merge": with_ctes("""SELECT c_custkey, c_name, c_mktsegment, CAST(NULL AS DOUBLE) AS c_acctbal FROM v1
        UNION ALL SELECT c_custkey, c_name, CAST(NULL AS VARCHAR), c_acctbal FROM v2""", v1=CUSTOMER_V1, v2=CUSTOMER_V2),
})

from lakehand.plans.oracle_fixtures import EVENT_CONFIG, INGESTION_SHEET, STATUS_EVENTS  # noqa: E402

_SENT = "CASE WHEN {c} = '' THEN '(~empty~)' WHEN {c} IS NULL THEN '(~null~)' ELSE {c} END"


def _sent_entity(v: str) -> str:
    return (f"SELECT CAST(c_custkey AS VARCHAR) AS Customer_BK, {_SENT.format(c='c_name')} AS c_name, c_nationkey, "
            f"c_acctbal, {_SENT.format(c='c_mktsegment')} AS c_mktsegment FROM {v}")


_FACT = """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS Customer_BK, CAST(o_custkey % 2 + 1 AS INTEGER) AS CountryCode,
  o_totalprice, o_orderdate FROM orders"""
_DIMC = "SELECT Customer_SK, Customer_BK, c_mktsegment, CAST(CAST(Customer_BK AS BIGINT) % 2 + 1 AS INTEGER) AS CountryCode FROM {d} WHERE _Current = 1"
_LOOKUP = """SELECT f.Customer_BK, f.CountryCode, f.o_orderkey, f.o_totalprice, f.o_orderdate, d.Customer_SK, d.c_mktsegment
  FROM fact f JOIN dim d ON f.Customer_BK = d.Customer_BK AND f.CountryCode = d.CountryCode"""

_LAST_WM = """SELECT SourceID, HighWatermark FROM (SELECT SourceID, HighWatermark,
  RANK() OVER (PARTITION BY SourceID ORDER BY CreatedDTS DESC) AS r FROM st WHERE HighWatermark IS NOT NULL) WHERE r = 1"""
_BASEQ = ("CASE WHEN SourceQuery IS NOT NULL AND trim(SourceQuery) <> '' THEN SourceQuery "
          "ELSE 'SELECT * FROM [' || SourceSchema || '].[' || SourceTableName || ']' END")
_HI = "'2024-02-01 00:00:00'"
_INC = "(WatermarkColumn IS NOT NULL AND trim(WatermarkColumn) <> '')"

_LI_BASE = """SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS Lineitem_BK,
  l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
  make_timestamp(year(l_shipdate), 1, 1, 0, 0, 0) AS _Created, CAST(NULL AS TIMESTAMP) AS _Ended, 1 AS _Current,
  year(l_shipdate) AS _year FROM lineitem"""
_LI_COLS = "l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, _Created, _Ended, _Current"
_LI_HIST = f"""SELECT _year AS as_at, {_LI_COLS} FROM lib UNION ALL SELECT _year + 1 AS as_at, {_LI_COLS} FROM lib"""


def _upd(ts_first, ts2, ts3, e1, e2, e3):
    c = {"v1": CUSTOMER_V1, "s1": entity("v1"), "d1": first_load_sql("s1", ts_first, end=e1),
         "v2": CUSTOMER_V2, "s2": entity("v2"), "d2": scd2_step_sql("d1", "s2", ts2, end=e2),
         "v3": CUSTOMER_V3, "s3": entity("v3"), "d3": scd2_step_sql("d2", "s3", ts3, end=e3)}
    return c


_CODE = ("CASE {n} % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase' "
         "WHEN 3 THEN 'signup' ELSE 'view' END")

#: Fixed parts of the landing and trusted paths.
_RAW_PATH = "'/raw/' || SystemCode || '/' || TableSchema || '_' || TableName || '/$yyyy$/$MM$/$dd$/$HH$$mm$/'"
_TRUSTED_PATH = "'/trusted/' || SystemCode || '/' || TableSchema || '_' || TableName || '/'"

#: New sources take the ids their system's prefixes have left, then those of fresh prefixes.
_REGISTER = """
WITH m AS ({m}), sh AS ({sh}),
once AS (SELECT SystemCode, TableSchema, TableName, min(SheetRow) AS SheetRow FROM sh GROUP BY ALL),
fresh AS (SELECT sh.* FROM sh JOIN once USING (SystemCode, TableSchema, TableName, SheetRow)
  ANTI JOIN m ON m.SystemCode = sh.SystemCode AND m.SourceSchema = sh.TableSchema AND m.SourceTableName = sh.TableName),
numbered AS (SELECT *, row_number() OVER (PARTITION BY SystemCode ORDER BY TableSchema, TableName) AS rn FROM fresh),
tails AS (SELECT SourceID // 1000 AS prefix, max(SourceID) AS taken, arg_max(SystemCode, SourceID) AS SystemCode FROM m GROUP BY ALL),
leftover AS (SELECT SystemCode, taken, prefix * 1000 + 999 - taken AS n,
  sum(prefix * 1000 + 999 - taken) OVER (PARTITION BY SystemCode ORDER BY prefix) AS upto FROM tails WHERE taken % 1000 < 999),
demand AS (SELECT SystemCode, coalesce(max(room), 0) AS room, greatest(0, count(*) - coalesce(max(room), 0)) AS extra
  FROM fresh LEFT JOIN (SELECT SystemCode, sum(n) AS room FROM leftover GROUP BY ALL) USING (SystemCode) GROUP BY ALL),
opened AS (SELECT SystemCode, room, coalesce((SELECT max(prefix) FROM tails), 19) + 1
  + coalesce(sum((extra + 998) // 999) OVER (ORDER BY SystemCode ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prefix FROM demand)
SELECT CAST(CASE WHEN rn <= room THEN taken + n - (upto - rn) ELSE (prefix + (rn - room - 1) // 999) * 1000 + (rn - room - 1) % 999 + 1 END
    AS BIGINT) AS SourceID,
  SystemCode, TableSchema AS SourceSchema, TableName AS SourceTableName, SourceQuery,
  COALESCE(KeyVaultSecret, '<FILL-ME-IN>') AS SourceKeyVaultSecret,
  COALESCE(SourceHandler, 'sql-load') AS SourceHandler, CAST(NULL AS VARCHAR) AS LoadType, CAST(NULL AS VARCHAR) AS BusinessKeyColumn,
  WatermarkColumn, """ + _RAW_PATH + """ || CASE WHEN RawFileExtension = '' THEN '' ELSE '$guid$.' END || COALESCE(RawFileExtension, 'parquet') AS RawPath,
  'raw-load' AS RawHandler, 'trusted-load' AS TrustedHandler, """ + _TRUSTED_PATH + """ AS TrustedPath,
  replace(replace(TableSchema, '\\', ''), ' ', '') AS DestinationSchema,
  replace(replace(TableName, '\\', ''), ' ', '') AS DestinationTableName,
  ExtendedProperties, TRUE AS Enabled, {ts2} AS CreatedDTS
FROM numbered JOIN opened USING (SystemCode)
LEFT JOIN (SELECT SystemCode AS sc, taken, n, upto FROM leftover) ON sc = SystemCode AND rn <= upto AND rn > upto - n"""

_LINE_V1 = "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE (l_orderkey + l_linenumber) % 10 <> 9"
_LINE_V2 = """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem WHERE l_orderkey % 7 <> 3"""
_LINE_KEY = "CAST({a}.l_orderkey AS VARCHAR) || '|' || CAST({a}.l_linenumber AS VARCHAR)"
_LINE_CHANGED = "(s.l_quantity IS DISTINCT FROM t.l_quantity OR s.l_returnflag IS DISTINCT FROM t.l_returnflag)"
_LINE_ON = "s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber"


def _line_version(a: str, ts: str, sk_ts: str, ended: str, current: int) -> str:
    """A version of row ``a``: key texts from ``sk_ts``, dates and batch key."""
    return (f"strftime({sk_ts}, {FMT}) || '-' || {_LINE_KEY.format(a=a)} AS Line_SK, {a}.l_orderkey, {a}.l_linenumber, "
            f"{a}.l_quantity, {a}.l_returnflag, {ts} AS _Created, {ended} AS _Ended, {current} AS _Current, "
            f"{_bkey(ts, ended, str(current))} AS _Batch_SK")


_NO_END = "CAST(NULL AS TIMESTAMP)"
_COMPOSITE = f"""SELECT {_line_version('t', TS1, TS1, f"({TS2} - INTERVAL 1 SECOND)", 0)} FROM v1 t JOIN v2 s ON {_LINE_ON}
  WHERE {_LINE_CHANGED}
UNION ALL SELECT {_line_version('t', TS1, TS1, _NO_END, 1)} FROM v1 t LEFT JOIN v2 s ON {_LINE_ON}
  WHERE s.l_orderkey IS NULL OR NOT {_LINE_CHANGED}
UNION ALL SELECT {_line_version('s', TS2, TS2, _NO_END, 1)} FROM v2 s LEFT JOIN v1 t ON {_LINE_ON}
  WHERE t.l_orderkey IS NULL OR {_LINE_CHANGED}"""

ORACLE.update({
    "scd2_composite_key": with_ctes(_COMPOSITE, v1=_LINE_V1, v2=_LINE_V2),
    "staged_composite_key": with_ctes(f"""SELECT CAST(NULL AS VARCHAR) AS MergeKey, s.* FROM v2 s JOIN v1 t ON {_LINE_ON}
        WHERE {_LINE_CHANGED} UNION ALL SELECT {_LINE_KEY.format(a='s')} AS MergeKey, s.* FROM v2 s""", v1=_LINE_V1, v2=_LINE_V2),
    "replay_snapshot_table": with_ctes("SELECT * FROM d4", **dim_ctes(upto=2), v3=CUSTOMER_V3, s3=entity("v3"),
        d3=scd2_step_sql("d2", "s3", "TIMESTAMP '2024-03-01 00:00:00'", end="TIMESTAMP '2024-03-07 00:00:00'"),
        s4="""SELECT Customer_BK, c_name, c_nationkey, c_acctbal,
          CASE WHEN c_nationkey % 3 = 0 THEN 'LATE' ELSE c_mktsegment END AS c_mktsegment FROM s3""",
        d4=scd2_step_sql("d3", "s4", "TIMESTAMP '2024-04-01 00:00:00'", end="TIMESTAMP '2024-04-07 00:00:00'")),
    "fact_lookup_sk": with_ctes(_LOOKUP, **dim_ctes(upto=2), fact=_FACT, dim=_DIMC.format(d="d2")),
    "fact_lookup_hot_key": with_ctes("""SELECT Customer_BK, o_orderkey, o_totalprice, Customer_SK, c_mktsegment
        FROM (SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE o_custkey END AS VARCHAR) AS Customer_BK, o_totalprice FROM orders)
        JOIN (SELECT Customer_SK, Customer_BK, c_mktsegment FROM d2 WHERE _Current = 1) USING (Customer_BK)""", **dim_ctes(upto=2)),
    "revenue_by_segment": with_ctes(
        """SELECT c_mktsegment, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue
           FROM (""" + _LOOKUP + ") GROUP BY c_mktsegment",
        v1=CUSTOMER_V1, s1=_sent_entity("v1"), d1=first_load_sql("s1", TS1),
        v2=CUSTOMER_V2, s2=_sent_entity("v2"), d2=scd2_step_sql("d1", "s2", TS2),
        fact=_FACT, dim=_DIMC.format(d="d2")),
    "wm_bounds": "SELECT min(o_orderdate) AS LowWatermark, max(o_orderdate) AS HighWatermark FROM orders",
    "wm_range": """SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1996-12-31 00:00:00'
                   AND o_orderdate <= TIMESTAMP '1998-08-02 00:00:00'""",
    "wm_last_per_source": with_ctes(_LAST_WM, st=EXTRACT_STATUS),
    "wm_batch_init": with_ctes(f"""SELECT '20240201' AS BatchID,
        CAST((SELECT COALESCE(max(ID), 0) FROM st) + ROW_NUMBER() OVER (ORDER BY m.SystemCode, m.SourceID) AS BIGINT) AS ID,
        l.HighWatermark AS LowWatermark, m.* EXCLUDE (SourceMetaData, Enabled, CreatedDTS)
        FROM m LEFT JOIN lastwm l ON l.SourceID = m.SourceID WHERE m.Enabled""",
                               st=EXTRACT_STATUS, m=EXTRACT_MANIFEST, lastwm=_LAST_WM),
    "wm_batch_status_rows": with_ctes(f"""SELECT
        CAST((SELECT COALESCE(max(ID), 0) FROM st) + ROW_NUMBER() OVER (ORDER BY m.SystemCode, m.SourceID) AS BIGINT) AS ID,
        '20240201' AS BatchID, m.SystemCode, m.SourceID, l.HighWatermark AS LowWatermark,
        {', '.join(f"CAST(NULL AS {'VARCHAR' if c in ('HighWatermark', 'RawPath', 'RawStatus', 'TrustedStatus') else 'BIGINT' if c.endswith('Count') else 'TIMESTAMP'}) AS {c}"
                   for c in ('HighWatermark', 'SourceRowCount', 'SinkRowCount', 'RawPath', 'RawStatus', 'RawStartDTS', 'RawEndDTS',
                             'TrustedStatus', 'TrustedStartDTS', 'TrustedEndDTS', 'EndedDTS'))}, {TS2} AS CreatedDTS
        FROM m LEFT JOIN lastwm l ON l.SourceID = m.SourceID WHERE m.Enabled""",
                                      st=EXTRACT_STATUS, m=EXTRACT_MANIFEST, lastwm=_LAST_WM),
    "wm_full_vs_delta": with_ctes(f"""SELECT m.SourceID, {_INC} AS IsDelta, {_BASEQ} AS BaseQuery,
        l.HighWatermark AS LowWatermark, {_HI} AS HighWatermark,
        CASE WHEN NOT {_INC} THEN {_BASEQ}
             WHEN l.HighWatermark IS NULL THEN 'SELECT * FROM (' || {_BASEQ} || ') T WHERE [' || WatermarkColumn || '] <= ''' || {_HI} || ''''
             ELSE 'SELECT * FROM (' || {_BASEQ} || ') T WHERE [' || WatermarkColumn || '] > ''' || l.HighWatermark ||
                  ''' AND [' || WatermarkColumn || '] <= ''' || {_HI} || '''' END AS Query
        FROM m LEFT JOIN lastwm l ON l.SourceID = m.SourceID""", st=EXTRACT_STATUS, m=EXTRACT_MANIFEST,
                                  lastwm=_LAST_WM),
    "src_query_or_table": with_ctes("""SELECT SheetRow, CASE WHEN SourceQuery IS NOT NULL AND trim(SourceQuery) <> ''
        THEN SourceQuery ELSE 'SELECT * FROM [' || TableSchema || '].[' || TableName || ']' END AS BaseQuery FROM sh""",
                                    sh=INGESTION_SHEET),
    "trusted_query": "SELECT o_orderkey, o_custkey, o_totalprice * 2 AS double_price FROM orders WHERE o_orderstatus = 'F'",
    "project_exprs": """SELECT p_partkey, upper(p_brand) AS brand, p_retailprice * 2 AS price2,
        p_type || '-' || CAST(p_size AS VARCHAR) AS type_size FROM part""",
    "prefix_columns": """SELECT p_partkey AS src_p_partkey, p_name AS src_p_name, p_brand AS src_p_brand,
        p_type AS src_p_type, p_size AS src_p_size, p_retailprice AS src_p_retailprice FROM part""",
    "sanitize_columns": 'SELECT p_partkey AS p_key, p_name AS p_name__full_, p_brand AS brand__maker, p_size FROM part',
    "drop_key_columns": with_ctes(f"SELECT {', '.join(ATTRS)}, _Created, _Ended, _Current FROM d1", **dim_ctes(upto=1)),
    "null_sentinels": f"""SELECT p_partkey,
        {_SENT.format(c="CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN '' ELSE p_name END")} AS p_name,
        {_SENT.format(c='p_brand')} AS p_brand, {_SENT.format(c='p_type')} AS p_type, p_size, p_retailprice FROM part""",
    "union_orgs": with_ctes(f"""SELECT '1001' || CAST(c_custkey AS VARCHAR) AS Customer_BK, c_name, c_nationkey, c_acctbal,
        {_SENT.format(c='c_mktsegment')} AS c_mktsegment, 1 AS CountryCode FROM v1 WHERE c_nationkey % 2 = 0
        UNION ALL SELECT '2002' || CAST(c_custkey AS VARCHAR), c_name, c_nationkey, c_acctbal,
        {_SENT.format(c='c_mktsegment')}, 2 FROM v1 WHERE c_nationkey % 2 = 1""", v1=CUSTOMER_V1),
    "unionise_query": with_ctes("""SELECT c_custkey, c_name, c_acctbal, 1 AS Organisation FROM v1
        WHERE c_nationkey % 2 = 0 AND c_acctbal > 0 UNION ALL
        SELECT c_custkey, c_name, c_acctbal, 2 FROM v1 WHERE c_nationkey % 2 = 1 AND c_acctbal > 0""", v1=CUSTOMER_V1),
    "history_union_fact": with_ctes(f"""SELECT {_LI_COLS} FROM lib WHERE _year >= 2000
        UNION SELECT {_LI_COLS} FROM hist""", lib=_LI_BASE, hist=_LI_HIST),
    "history_union_override": with_ctes(f"""SELECT {_LI_COLS} FROM lib WHERE _year >= 2000
        UNION SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
          CASE WHEN as_at = 1996 THEN TIMESTAMP '2022-04-25 00:00:00' ELSE _Created END,
          CASE WHEN as_at = 1996 THEN TIMESTAMP '2022-05-01 00:00:00' ELSE _Ended END, _Current FROM hist""",
                                        lib=_LI_BASE, hist=_LI_HIST),
    "history_union_dim": with_ctes(f"""SELECT * FROM d3 UNION SELECT * FROM d1
        UNION SELECT * FROM ({first_load_sql('s2', TS2)})""", **dim_ctes()),
    "history_replay": with_ctes("SELECT * FROM d3", **_upd(
        "TIMESTAMP '2023-12-26 00:00:00'", "TIMESTAMP '2024-01-26 00:00:00'", "TIMESTAMP '2024-02-24 00:00:00'",
        TS1, TS2, TS3)),
    "period_filter": """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m%d') AS DateKey FROM lineitem
        WHERE substring(strftime(l_shipdate, '%Y%m%d'), 1, 4) = '1997'""",
    "empty_clone": "SELECT * FROM lineitem LIMIT 0",
    "config_pivot": with_ctes("""SELECT KeyGroup, max(CASE WHEN Key = 'Key0' THEN Value END) AS Key0,
        max(CASE WHEN Key = 'Key1' THEN Value END) AS Key1, max(CASE WHEN Key = 'Key2' THEN Value END) AS Key2,
        max(CASE WHEN Key = 'Key3' THEN Value END) AS Key3 FROM cfg GROUP BY KeyGroup""", cfg=EVENT_CONFIG),
    "register_source": _REGISTER.format(m=EXTRACT_MANIFEST, sh=INGESTION_SHEET, ts2=TS2),
    "limit_or_all": with_ctes("SELECT * FROM sh ORDER BY SystemCode, TableSchema, TableName, SheetRow", sh=INGESTION_SHEET),
    "system_selection": with_ctes("""SELECT DISTINCT CAST(SourceID // 1000 AS VARCHAR) AS "Order", SystemCode
        FROM (SELECT SourceID, SystemCode, Enabled FROM m UNION ALL SELECT SourceID, SystemCode, Enabled FROM reg)
        WHERE Enabled AND SystemCode IN ('click', 'view', 'purchase', 'NEWSYS1')""",
                                  m=EXTRACT_MANIFEST,
                                  reg=_REGISTER.format(m=EXTRACT_MANIFEST, sh=INGESTION_SHEET, ts2=TS2).strip()),
    "list_to_rows": with_ctes("""SELECT ID, Segment FROM (SELECT ID, unnest(string_split(RawPath, '/')) AS Segment FROM st)
        WHERE Segment <> ''""", st=EXTRACT_STATUS),
    "group_list": with_ctes("""SELECT ParallelGroup, string_agg(CAST(TransformID AS VARCHAR), ',' ORDER BY TransformID) AS Transforms,
        COUNT(*) AS Tasks FROM tm WHERE Enabled GROUP BY ParallelGroup""", tm=TRANSFORM_MANIFEST),
    "transform_init": with_ctes("""SELECT '20240201' AS BatchID,
        CAST((SELECT COALESCE(max(TransformStatusID), 0) FROM lg) + ROW_NUMBER() OVER (ORDER BY TransformID) AS BIGINT) AS ID, tm.*,
        (SELECT string_agg(CAST(g AS VARCHAR), ',' ORDER BY g) FROM (SELECT DISTINCT ParallelGroup AS g FROM tm)) AS List
        FROM tm WHERE Enabled""", tm=TRANSFORM_MANIFEST, lg=LOG),
    "transform_status_rows": with_ctes(f"""SELECT '20240201' AS BatchID,
        CAST((SELECT COALESCE(max(TransformStatusID), 0) FROM lg) + ROW_NUMBER() OVER (ORDER BY TransformID) AS BIGINT) AS ID, TransformID,
        {', '.join(f'CAST(NULL AS BIGINT) AS {c}Count' for c in ('Spot', 'Insert', 'Update', 'Curated'))}, CAST(NULL AS VARCHAR) AS Status,
        CAST(NULL AS TIMESTAMP) AS StartDTS, CAST(NULL AS TIMESTAMP) AS EndDTS, {TS2} AS CreatedDTS
        FROM tm WHERE Enabled""", tm=TRANSFORM_MANIFEST, lg=LOG),
    "status_from_events": with_ctes("""SELECT ID, max(CASE WHEN Property = 'RawStatus' THEN v END) AS RawStatus,
        max(CASE WHEN Property = 'TrustedStatus' THEN v END) AS TrustedStatus,
        max(CASE WHEN Property = 'SinkRowCount' THEN v END) AS SinkRowCount
        FROM (SELECT ID, Property, arg_max(Value, Seq) AS v FROM ev GROUP BY ID, Property) GROUP BY ID""",
                                    ev=STATUS_EVENTS),
    "log_routing": """SELECT CASE WHEN NOT (event_id % 2 = 0) THEN event_id END AS ExtractLoadStatusID,
        CASE WHEN event_id % 2 = 0 THEN event_id END AS TransformStatusID, event_type AS ActivityType,
        props AS Message, ts AS CreatedDTS FROM events""",
    "end_system_stamp": with_ctes(f"""SELECT ID, BatchID, SystemCode,
        CASE WHEN BatchID = '20240115' AND SystemCode = 'click' THEN {TS2} ELSE EndedDTS END AS EndedDTS FROM st""",
                                  st=EXTRACT_STATUS),
})

from lakehand.plans.oracle_monitor import MONITOR  # noqa: E402

ORACLE.update(MONITOR)

from lakehand.plans.oracle_meta import META  # noqa: E402

ORACLE.update(META)
