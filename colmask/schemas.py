"""Explicit schemas of the control data, so that empty inputs keep their types."""

CONTROL = (
    "Id bigint, TableName string, PIICategory string, ColumnName string, "
    "DataType string, EncryptFlag boolean"
)
COLUMNS = "TableName string, Ordinal int, ColumnName string, DataType string"
FIELDS = COLUMNS + ", Names array<string>"
NAMESPACES = "catalog string, schema string"
TABLES = "catalog string, schema string, tableName string, isTemporary boolean"
DDL = "TableName string, ddl string"
APPLIED = "TableName string, ColumnName string"
GRANTS = "principal string, grp string"
CLOSURE = "member string, grp string"
MASK_LOG = (
    "TableName string, ColumnName string, status string, error string, strategy string, at timestamp"
)
RUN_LOG = "unit string, status string, n_columns bigint, error string"
VAULT = "value string, token bigint"
SKETCHES = "TableName string, Columns string, unit string, theta bigint, hash bigint, n bigint"
