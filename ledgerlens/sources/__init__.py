"""Readers. Raw report fields are read as strings with an explicit schema
(never inferSchema: one odd value would change a column's type)."""

from ledgerlens.sources.files import (  # noqa: F401
    decode_fallback, explode_lines, file_sizes, json_rejects, read_binary_files, read_delimited,
    read_fields, read_json_documents, read_lines, read_records, read_sized_records, read_text_files, read_text_in_order,
)
from ledgerlens.sources.objects import copied, digests, list_files  # noqa: F401
from ledgerlens.sources.documents import json_documents, json_parts, read_json_parts  # noqa: F401
