"""Schemas of the seven entity tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

AUDIT = [
    ("id", StringType(), True),
    ("created_at", TimestampNTZType(), True),
    ("updated_at", TimestampNTZType(), True),
    ("is_active", BooleanType(), True),
    ("metadata", StringType(), False),
]


def _entity(required: list[str], optional: list[str] | None = None) -> StructType:
    own = [(name, StringType(), True) for name in required] + [(name, StringType(), False) for name in optional or []]
    return StructType([StructField(n, t, not needed) for n, t, needed in AUDIT + own])


# Tables and columns.
ENTITIES: dict[str, StructType] = {
    "users": _entity(["name", "email", "role", "school_id"]),
    "schools": _entity(["name"], ["address"]),
    "courses": _entity(["name", "teacher_id", "school_id"]),
    "contents": _entity(["course_id", "teacher_id", "file_path", "file_type"]),
    "homeworks": _entity(["course_id", "student_id", "file_path", "file_type"]),
    "grades": _entity(["course_id", "student_id", "grade"], ["comments"]),
    "adjustments": _entity(["student_id", "course_id", "action"]),
}
