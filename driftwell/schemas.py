"""Fixed schemas of the inputs."""

from __future__ import annotations

# Column names and types of the change log and of the keyword master.
AUDIT_LOG = (
    "Id int, UserName string, AuditTypeId int, Source string, Summary string, "
    "Details string, LogDateTime string, WhoId string"
)
KEYWORD_MASTER = (
    "Id bigint, Name string, BidAmount string, StateId string, AdGroupId string, "
    "CreatedDateTime string, LastModifiedDateTime string"
)
# The columns of the keyword write report, all text.
WRITE_REPORT_COLUMNS = (
    "AUDIT ID",
    "ADGROUP ID",
    "USER ID",
    "LOG DATE TIME",
    "NAME",
    "KEYWORD",
    "NEW VALUE",
    "OLD VALUE",
    "STATE ID",
)
WRITE_REPORT = ", ".join(f"`{c}` string" for c in WRITE_REPORT_COLUMNS)

# The parsed details of a log record.  Leaves are text: a scalar as it is, an array or object as
# its JSON, so a value whose type changes from row to row needs no schema of its own.
DETAILS = (
    "entityId string, entityType string, parentId string, "
    "fields array<struct<fieldName:string, newValue:string, oldValue:string>>"
)
