"""Fixed schemas. Production reads pass them, so no read has to infer types."""

from __future__ import annotations

from pyspark.sql import types as T

REFERENCES = T.StructType(
    [
        T.StructField("short", T.StringType()),
        T.StructField("relative", T.StringType()),
        T.StructField("full", T.StringType()),
    ]
)

RAW_SCHEMA = T.StructType(
    [
        T.StructField("iid", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("closed_at", T.StringType()),
        T.StructField(
            "author",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("name", T.StringType()),
                    T.StructField("state", T.StringType()),
                ]
            ),
        ),
        T.StructField("user_notes_count", T.LongType()),
        T.StructField("upvotes", T.LongType()),
        T.StructField("downvotes", T.LongType()),
        T.StructField("references", REFERENCES),
    ]
)

CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("iid", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("closed_at", T.TimestampNTZType()),
        T.StructField("author_id", T.LongType()),
        T.StructField("author_name", T.StringType()),
        T.StructField("author_state", T.StringType()),
        T.StructField("user_notes_count", T.LongType()),
        T.StructField("upvotes", T.LongType()),
        T.StructField("downvotes", T.LongType()),
        T.StructField("references", REFERENCES),
    ]
)


def issue_schema(label_version: int = 1) -> T.StructType:
    """Schema of the processed table, without its partition columns."""
    return T.StructType(
        [
            *CLEAN_SCHEMA.fields,
            T.StructField("desc_clean", T.StringType()),
            T.StructField("is_from_form", T.BooleanType()),
            T.StructField("form_page", T.StringType()),
            T.StructField("sentiment", T.DoubleType()),
            T.StructField(f"labels_v{label_version}", T.ArrayType(T.StringType())),
            T.StructField("org", T.StringType()),
            T.StructField("feedback_round", T.ByteType()),
        ]
    )


ISSUE_SCHEMA = issue_schema()

# The timestamps are ISO text in the file, as the tracker writes them.
STATE_SCHEMA = T.StructType(
    [
        T.StructField("last_successful_run", T.StringType()),
        T.StructField("last_fetched_issues", T.LongType()),
        T.StructField("total_issues_processed", T.LongType()),
        T.StructField("recorded_at", T.StringType()),
    ]
)
