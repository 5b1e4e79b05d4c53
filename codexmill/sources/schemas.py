"""Schemas of the archive's tables and of the pipeline's records."""

from __future__ import annotations

import re

from pyspark.sql.types import BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType


def _schema(**fields: object) -> StructType:
    return StructType([StructField(k, t, True) for k, t in fields.items()])


S, L = StringType(), LongType()
RAW_TEXT = _schema(old_id=IntegerType(), old_text=BinaryType(), old_flags=BinaryType())
PAGE = _schema(page_id=L, page_namespace=IntegerType(), page_title=S, page_latest=L)
REVISION = _schema(rev_id=L, rev_page=L)
SLOTS = _schema(slot_revision_id=L, slot_content_id=L)
CONTENT = _schema(content_id=L, content_address=S)
ENTRY = _schema(page_id=L, page_title=S, text_id=S, content=S, flags=S, blob_id=IntegerType())
ANALYSED = StructType([*ENTRY.fields, *_schema(content_length=IntegerType(), content_title=S, title_match=BooleanType(), content_type=S, year=S, publisher=S, location=S, language=S, page_count=S).fields])
CLEANED = _schema(page_id=L, page_title=S, text_id=S, content=S, content_cleaned=S, content_type=S, redirect_target=S, content_title=S, year=DoubleType(), publisher=S, location=S, language=S, page_count=DoubleType(), blob_id=IntegerType())
#: Columns of the final table, in order; those that are missing are left out.
FINAL = [
    "page_id", "text_id", "catalog_number_1", "catalog_number_2", "title", "original_title", "full_bibliographic_entry", "year", "publisher",
    "location", "language", "page_count", "clean_content",
    *[f"content_item_{i}_{f}" for i in (1, 2, 3) for f in ("title", "original_title", "translator", "pages")],
    "categories", "main_category", "time_period",
]

# Types of a dump's columns and what they are here.
DDL_TYPES = {"tinyint": IntegerType, "smallint": IntegerType, "int": IntegerType, "bigint": LongType, "float": DoubleType, "double": DoubleType, "binary": StringType, "varbinary": StringType, "char": StringType, "varchar": StringType, "text": StringType, "mediumtext": StringType, "longtext": StringType, "blob": BinaryType, "mediumblob": BinaryType, "longblob": BinaryType}


def from_ddl(sql: str) -> dict[str, StructType]:
    """The tables of a dump's CREATE TABLE statements, by name; unsigned ints are long, types that aren't known strings."""
    found = {}
    for name, body in re.findall(r"CREATE TABLE(?: IF NOT EXISTS)? `(\w+)` \((.*?)\n\)", sql, re.DOTALL):
        fields = []
        for column, kind, rest in re.findall(r"^\s*`(\w+)` (\w+)([^\n]*)", body, re.MULTILINE):
            known = DDL_TYPES.get(kind.lower(), StringType)
            fields.append(StructField(column, LongType() if known is IntegerType and "unsigned" in rest else known(), "NOT NULL" not in rest))
        found[name] = StructType(fields)
    return found
