from ledgerlake.sources.collections import (
    MarkStore,
    next_mark,
    point_lookup,
    read_collection,
    row_counts,
    since_mark,
)
from ledgerlake.sources.dumps import DocumentDump, read_dump
from ledgerlake.sources.files import (
    flatten_envelope,
    flatten_invoices,
    list_files,
    read_delimited,
    read_json_docs,
    read_json_inferred,
)
from ledgerlake.sources.json_arrays import array_documents, read_json_array

__all__ = [
    "DocumentDump",
    "MarkStore",
    "array_documents",
    "flatten_envelope",
    "flatten_invoices",
    "list_files",
    "next_mark",
    "point_lookup",
    "read_collection",
    "read_delimited",
    "read_dump",
    "read_json_array",
    "read_json_docs",
    "read_json_inferred",
    "row_counts",
    "since_mark",
]
