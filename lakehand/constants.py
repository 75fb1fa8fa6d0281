"""Fixed values that must equal the reference framework's for equal results.

Fixed values (stated as text, in natural order):
  empty-string sentinel            (~empty~)
  NULL sentinel                    (~null~)
  surrogate/batch key time format  yyMMddHHmmss
  open-row end code in batch key   000000000000
  hashed-key second value          512
  organisation key prefixes        1001 (organisation 1), 2002 (organisation 2)
  curated entity name              first letter of the entity type + "_" + name
  SCD system columns               _Created, _Ended, _Current, _Batch_SK
  ingestion path slots             $SYSTEM$ $SCHEMA$ $TABLE$ $yyyy$ $MM$ $dd$ $HH$ $mm$ $guid$ $EXT$
  ingestion defaults               RawPath  /raw/$SYSTEM$/$SCHEMA$_$TABLE$/$yyyy$/$MM$/$dd$/$HH$$mm$/$guid$.$EXT$
                                   TrustedPath  /trusted/$SYSTEM$/$SCHEMA$_$TABLE$/
                                   SourceKeyVaultSecret  <FILL-ME-IN>
                                   Enabled  1
                                   sheet Index 0, Limit 0, Path <FILL-ME-IN>
  first source id                  20001 (a new system gets max two-digit prefix + 1, then 001)
  default source handler           sql-load; raw handler raw-load; trusted handler trusted-load
  default raw file extension       parquet
  status literals                  Success, Fail (also read: Failed), In Progress, Completed, Skipped
  copy log activity type           copy-data
"""

EMPTY_SENTINEL = "(~empty~)"
NULL_SENTINEL = "(~null~)"
KEY_TIME_FORMAT = "yyMMddHHmmss"
OPEN_END_CODE = "000000000000"
HASH_SECOND_VALUE = 512
ORG_PREFIX = {1: "1001", 2: "2002"}

SCD_CREATED = "_Created"
SCD_ENDED = "_Ended"
SCD_CURRENT = "_Current"
SCD_BATCH = "_Batch_SK"
SCD_SYSTEM = (SCD_CREATED, SCD_ENDED, SCD_CURRENT, SCD_BATCH)

INGESTION_DEFAULTS = {
    "RawPath": "/raw/$SYSTEM$/$SCHEMA$_$TABLE$/$yyyy$/$MM$/$dd$/$HH$$mm$/$guid$.$EXT$",
    "TrustedPath": "/trusted/$SYSTEM$/$SCHEMA$_$TABLE$/",
    "SourceKeyVaultSecret": "<FILL-ME-IN>",
    "Enabled": "1",
}
SHEET_DEFAULTS = {"Index": "0", "Limit": "0", "Path": "<FILL-ME-IN>"}
FIRST_SOURCE_ID = 20001
DEFAULT_SOURCE_HANDLER = "sql-load"
RAW_HANDLER = "raw-load"
TRUSTED_HANDLER = "trusted-load"
DEFAULT_RAW_EXTENSION = "parquet"

STATUS_SUCCESS = "Success"
STATUS_FAIL = "Fail"
STATUS_FAIL_ALIASES = ("Fail", "Failed")
STATUS_IN_PROGRESS = "In Progress"
STATUS_COMPLETED = "Completed"
STATUS_SKIPPED = "Skipped"
COPY_ACTIVITY = "copy-data"

# Fixed values of the generated-SQL view (text must match the reference output):
#   create-schema text        BEGIN TRY DECLARE @Schema VARCHAR(8000) = REPLACE('CREATE SCHEMA [<schema>]', '\\', '\') EXEC(@Schema) END TRY BEGIN CATCH END CATCH
#   create-table text         CREATE TABLE [<schema>].[<table>] (<column definitions joined by ,>)
#   column definition         [<column>] [<type>]<size> NULL | NOT NULL
#   size                      (<length or MAX>) for *char/*binary, (<precision>,<scale>) for numeric/decimal, (7) for datetime2
#   select text               SELECT <[column] [clean column] joined by ,> FROM [<schema>].[<table>]   (trailing space)
#   external table suffix     " WITH (LOCATION ='/external-tables/<system>/<schema>_<table>/' ,DATA_SOURCE = [DLS-Synapse-EDS], FILE_FORMAT = [SynapseParquetFormat] )"
#   external schema names     D365FO -> D365, EDW1 and EDW2 -> EDW, else the system code
CREATE_SCHEMA_SQL = ("BEGIN TRY DECLARE @Schema VARCHAR(8000) = REPLACE('CREATE SCHEMA [{schema}]', '\\\\', '\\') "
                     "EXEC(@Schema) END TRY BEGIN CATCH END CATCH ")
EXTERNAL_DATA_SOURCE = "DLS-Synapse-EDS"
EXTERNAL_FILE_FORMAT = "SynapseParquetFormat"
EXTERNAL_SCHEMA_MAP = {"D365FO": "D365", "EDW1": "EDW", "EDW2": "EDW"}
