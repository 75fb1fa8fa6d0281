"""SQL twins of :mod:`lakehand.plans.fixtures` (DuckDB dialect), as CTE bodies."""

TS1, TS2, TS3 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-02-01 00:00:00'", "TIMESTAMP '2024-03-01 00:00:00'"

CUSTOMER_V1 = """SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_custkey % 20 <> 19"""

_V2_SEG = """CASE WHEN c_custkey % 22 = 0 THEN 'NEW' WHEN c_custkey % 11 = 0 OR c_custkey % 23 = 0 THEN NULL
       WHEN c_custkey % 13 = 0 THEN '' ELSE c_mktsegment END"""

CUSTOMER_V2 = f"""SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
  {_V2_SEG} AS c_mktsegment
  FROM customer WHERE c_custkey % 17 <> 0"""

CUSTOMER_V3 = f"""SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 10 = 5 THEN 'MOVED' ELSE {_V2_SEG} END AS c_mktsegment
  FROM customer WHERE c_custkey % 17 <> 0"""


def entity(v: str) -> str:
    return f"SELECT CAST(c_custkey AS VARCHAR) AS Customer_BK, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {v}"


#: Part key of an event's source (``n`` sources on), and the SourceID of a part key.
EVENT_SOURCE = """((user_id * 13) % (SELECT count(*) FROM part) // 5 * 5
  + list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) - 1 + 5 * {n}) % (SELECT count(*) FROM part)"""
SOURCE_ID = "((20 + {p} % 5 + 5 * ({p} // 5 // 999)) * 1000 + {p} // 5 % 999 + 1)"
SOURCE_KEY = "(((({s} // 1000 - 20) // 5) * 999 + {s} % 1000 - 1) * 5 + ({s} // 1000 - 20) % 5)"

EXTRACT_STATUS = """SELECT event_id AS ID, strftime(ts, '%Y%m%d') AS BatchID, event_type AS SystemCode,
  """ + SOURCE_ID.format(p="p") + """ AS SourceID, CAST(NULL AS VARCHAR) AS LowWatermark,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS HighWatermark,
  event_id % 1000 AS SourceRowCount,
  event_id % 1000 - CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS SinkRowCount,
  '/raw/' || event_type || '/dbo_T' || CAST(p AS VARCHAR) || '/' || CAST(event_id AS VARCHAR) || '.parquet' AS RawPath,
  CASE WHEN event_id % 23 = 0 THEN 'Fail' ELSE 'Success' END AS RawStatus,
  ts AS RawStartDTS,
  CASE WHEN event_id % 29 = 0 THEN NULL ELSE ts + to_seconds(event_id % 90) END AS RawEndDTS,
  CASE WHEN event_id % 37 = 0 THEN 'Fail' ELSE 'Success' END AS TrustedStatus,
  CASE WHEN event_id % 29 = 0 THEN NULL ELSE ts + to_seconds(event_id % 90) + to_seconds(5) END AS TrustedStartDTS,
  CASE WHEN event_id % 31 = 0 OR event_id % 29 = 0 THEN NULL
       ELSE ts + to_seconds(event_id % 90) + to_seconds(5) + to_seconds(event_id % 60) END AS TrustedEndDTS,
  ts AS CreatedDTS, ts + to_seconds(3600) AS EndedDTS
  FROM (SELECT *, """ + EVENT_SOURCE.format(n=0) + """ AS p FROM events)"""

_SYS = ("CASE {n} % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase' "
        "WHEN 3 THEN 'signup' ELSE 'view' END")

_T = "'T' || CAST(p_partkey AS VARCHAR)"
_S = "(" + _SYS.format(n="p_partkey") + ")"
EXTRACT_MANIFEST = f"""SELECT {SOURCE_ID.format(p='p_partkey')} AS SourceID, {_S} AS SystemCode,
  'dbo' AS SourceSchema, {_T} AS SourceTableName,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'SELECT * FROM [dbo].[T' || CAST(p_partkey AS VARCHAR) || ']' END AS SourceQuery,
  CASE WHEN p_partkey % 13 = 0 THEN '/in/' || {_S} END AS SourceFolderPath,
  CASE WHEN p_partkey % 13 = 0 THEN {_T} || '.csv' END AS SourceFileName,
  'kv-' || {_S} AS SourceKeyVaultSecret, CAST(NULL AS VARCHAR) AS SourceMetaData,
  CASE WHEN p_partkey % 13 = 0 THEN 'csv-load' ELSE 'sql-load' END AS SourceHandler,
  CASE WHEN p_partkey % 3 = 0 THEN 'Full' ELSE 'Delta' END AS LoadType,
  CASE WHEN p_partkey % 8 < 5 THEN {_T} || '_ID' END AS BusinessKeyColumn,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'ModifiedDTS' END AS WatermarkColumn,
  'raw-load' AS RawHandler, '/raw/' || {_S} || '/dbo_' || {_T} || '/$guid$.parquet' AS RawPath,
  'trusted-load' AS TrustedHandler, '/trusted/' || {_S} || '/dbo_' || {_T} || '/' AS TrustedPath,
  'dbo' AS DestinationSchema, {_T} AS DestinationTableName,
  CASE WHEN p_partkey % 17 = 0 THEN 'kv-lake' END AS DestinationKeyVaultSecret,
  CAST(NULL AS VARCHAR) AS ExtendedProperties, p_partkey % 7 <> 6 AS Enabled, {TS1} AS CreatedDTS
  FROM part"""

_ES = "CAST(event_id AS VARCHAR)"
_CRLF = "CASE WHEN event_id % 5 = 0 THEN chr(13) || chr(10) ELSE '' END"
LOG = f"""SELECT event_id * 3 AS ID, event_id AS ExtractLoadStatusID, CAST(NULL AS BIGINT) AS TransformStatusID,
  'copy-data' AS ActivityType,
  '{{"PipelineRunId":"run-' || {_ES} || '",' || {_CRLF} || '"Status":"Succeeded","Output":{{"dataRead":' ||
  CAST(event_id * 7919 AS VARCHAR) || ',"dataWritten":' || CAST(event_id * 3571 AS VARCHAR) ||
  ',"rowsRead":' || CAST(event_id % 1000 AS VARCHAR) || ',"rowsCopied":' || CAST(event_id % 1000 AS VARCHAR) ||
  ',"copyDuration":' || CAST(event_id % 90 AS VARCHAR) || ',"throughput":' || CAST(event_id % 500 AS VARCHAR) ||
  '.' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') ||
  CASE WHEN event_id % 46 = 0 THEN ',"errors":[{{"Message":"copy failed ' || {_ES} || '"}}]' ELSE '' END || '}}}}' AS Message,
  ts + to_seconds(1) AS CreatedDTS
FROM events
UNION ALL
SELECT event_id * 3 + 1, event_id, CAST(NULL AS BIGINT), 'raw-status',
  CASE WHEN event_id % 23 = 0 THEN '{{"PipelineRunId":"run-' || {_ES} || '","Status":"Failed","Error":{{"message":"boom ' || {_ES} || '"}}}}'
       WHEN event_id % 19 = 0 THEN '{{"PipelineRunId":"run-' || {_ES} || '","Status":"Failed","Error":"plain ' || {_ES} || '"}}'
       ELSE '{{"PipelineRunId":"run-' || {_ES} || '","Status":"Succeeded","dataRead":' || CAST(event_id * 11 AS VARCHAR) ||
            ',"rowsRead":' || CAST(event_id % 700 AS VARCHAR) || '}}' END,
  ts + to_seconds(2)
FROM events
UNION ALL
SELECT event_id * 3 + 2, CAST(NULL AS BIGINT), event_id, 'curated-transform',
  '{{"PipelineRunId":"run-' || {_ES} || '","Status":"Succeeded","Output":{{"runOutput":{{"Counts":{{"SpotCount":' ||
  CAST(event_id % 1000 AS VARCHAR) || ',"InsertCount":-1,"UpdateCount":-1,"CuratedCount":' || CAST(event_id % 5000 AS VARCHAR) ||
  '}},"CuratedTransform":{{"EntityType":"Dimension","Name":"' || event_type || '","Destination":"curated.D_' || event_type ||
  '","Tables":["trusted.dbo_T' || CAST({EVENT_SOURCE.format(n=0)} AS VARCHAR) || '","trusted.dbo_T' || CAST({EVENT_SOURCE.format(n=1)} AS VARCHAR) ||
  '"]}}}}}}}}',
  ts + to_seconds(3)
FROM events"""

TRANSFORM_MANIFEST = f"""SELECT CAST(DENSE_RANK() OVER (ORDER BY event_type) AS INTEGER) AS TransformID,
  'Dimension' AS EntityType, 'd_' || event_type AS EntityName, 'notebook' AS ProcessorType,
  'kv-curated' AS TargetKeyVaultSecret, 'Transform/Dimension/' || event_type AS Command,
  CAST(NULL AS VARCHAR) AS Dependancies,
  CAST(DENSE_RANK() OVER (ORDER BY event_type) % 3 + 1 AS INTEGER) AS ParallelGroup,
  event_type <> 'error' AS Enabled, {TS1} AS CreatedDTS
  FROM (SELECT DISTINCT event_type FROM events)"""

REPORT_REFRESH = f"""SELECT 'R_' || event_type AS ReportName, 'curated.old_' || event_type AS SourceTable,
  'Success' AS Status, {TS1} AS CreatedDTS FROM (SELECT DISTINCT event_type FROM events)
  UNION ALL
  SELECT 'R_' || event_type, 'curated.d_' || event_type, 'Success', {TS2} FROM (SELECT DISTINCT event_type FROM events)"""

_TAB = "CAST(floor(p_partkey / 20) AS BIGINT)"
COLUMN_METADATA = f"""SELECT
  CASE {_TAB} % 8 WHEN 0 THEN 'D365FO' WHEN 1 THEN 'EDW1' WHEN 2 THEN 'EDW2' WHEN 3 THEN 'CRM' ELSE {_SYS.format(n=_TAB)} END
    AS SystemCode,
  'dbo' AS TABLE_SCHEMA, 'T' || CAST({_TAB} AS VARCHAR) AS TABLE_NAME,
  CASE WHEN p_partkey % 9 = 0 THEN p_name || ',(' || CAST(p_partkey AS VARCHAR) || ')'
       ELSE p_name || ' ' || CAST(p_partkey AS VARCHAR) END AS COLUMN_NAME,
  p_partkey % 20 + 1 AS ORDINAL_POSITION,
  CASE WHEN p_partkey % 3 = 0 THEN 'NO' ELSE 'YES' END AS IS_NULLABLE,
  CASE p_size % 6 WHEN 0 THEN 'nvarchar' WHEN 1 THEN 'int' WHEN 2 THEN 'decimal' WHEN 3 THEN 'datetime2'
       WHEN 4 THEN 'varbinary' ELSE 'bigint' END AS DATA_TYPE,
  CASE WHEN p_size % 6 IN (0, 4) THEN CASE WHEN p_size > 40 THEN -1 ELSE p_size * 10 END END AS CHARACTER_MAXIMUM_LENGTH,
  CASE WHEN p_size % 6 = 2 THEN 18 END AS NUMERIC_PRECISION,
  CASE WHEN p_size % 6 = 2 THEN p_size % 5 END AS NUMERIC_SCALE,
  CASE WHEN {_TAB} % 3 = 0 THEN '{{"SynapseTableSchema":"syn","SynapseTableName":"S' || CAST({_TAB} AS VARCHAR) || '"}}' END
    AS ExtendedProperties
  FROM part"""


def with_ctes(body: str, **ctes: str) -> str:
    """``WITH a AS (...), b AS (...) body``."""
    if not ctes:
        return body
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body

INGESTION_SHEET = f"""SELECT p_partkey AS SheetRow,
  CASE WHEN p_partkey % 7 = 0 THEN {_S} WHEN k % 10 = 0 THEN 'NEWSYS' || CAST(k % 3 AS VARCHAR) ELSE {_SYS.format(n='k')} END AS SystemCode,
  CASE WHEN p_partkey % 7 <> 0 AND k % 11 = 0 THEN 'sales data' ELSE 'dbo' END AS TableSchema,
  CASE WHEN p_partkey % 7 = 0 THEN {_T} ELSE 'N' || CAST(k AS VARCHAR) END AS TableName,
  CAST(NULL AS VARCHAR) AS SourceQuery,
  CASE WHEN p_partkey % 2 = 0 THEN 'ModifiedDTS' END AS WatermarkColumn,
  CASE WHEN p_partkey % 13 = 0 THEN 'csv-load' END AS SourceHandler,
  CASE WHEN p_partkey % 13 = 0 THEN 'csv' WHEN p_partkey % 17 = 0 THEN '' END AS RawFileExtension,
  CASE WHEN p_partkey % 19 = 0 THEN 'kv-' || CAST(p_partkey AS VARCHAR) END AS KeyVaultSecret,
  CAST(NULL AS VARCHAR) AS ExtendedProperties
  FROM (SELECT *, p_partkey - CASE WHEN p_partkey % 12 = 1 AND p_partkey % 7 <> 0 THEN 1 ELSE 0 END AS k FROM part)"""

EVENT_CONFIG = """SELECT event_type AS KeyGroup, 'Key' || CAST(user_id % 4 AS VARCHAR) AS Key,
  lpad(json_extract_string(props, '$.k'), 3, '0') AS Value FROM events"""

STATUS_EVENTS = f"""SELECT ID, 'RawStatus' AS Property, 'In Progress' AS Value, 1 AS Seq FROM ({EXTRACT_STATUS})
  UNION ALL SELECT ID, 'RawStatus', RawStatus, 2 FROM ({EXTRACT_STATUS})
  UNION ALL SELECT ID, 'TrustedStatus', 'In Progress', 3 FROM ({EXTRACT_STATUS})
  UNION ALL SELECT ID, 'TrustedStatus', TrustedStatus, 4 FROM ({EXTRACT_STATUS})
  UNION ALL SELECT ID, 'SinkRowCount', CAST(SinkRowCount AS VARCHAR), 5 FROM ({EXTRACT_STATUS})"""
