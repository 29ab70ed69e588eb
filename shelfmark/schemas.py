"""Declared schemas; nothing is inferred from data."""

from __future__ import annotations

# Field names and types of the stored documents and the packed dataset.
COLLECTION_METADATA = (
    "album_id string, title string, model_name string, tags array<string>, girl_id bigint, "
    "image_count bigint, completed boolean"
)

ITEM_LABEL = (
    "struct<score: tinyint, tags: array<string>, notes: string, ai_score: tinyint, ai_reason: string, "
    "ai_factors: map<string, double>, ai_tags: array<string>>"
)

LABEL_DOCUMENT = (
    "albumScore tinyint, albumTags array<string>, albumNotes string, text_en string, text_cn string, "
    "aiScore tinyint, aiReason string, has_face boolean, has_fullbody boolean, "
    f"images map<string, {ITEM_LABEL}>"
)

PACKED = (
    "image struct<bytes: binary, path: string>, file_name string, title string, model_name string, "
    "tags array<string>, album_id bigint, text_en string, text_cn string, album_score tinyint, "
    "album_reason string, ai_score tinyint, ai_reason string, has_face boolean, has_fullbody boolean"
)

JSON_VERDICT = (
    "score int, tags array<string>, reasoning string, is_relevant boolean, is_complete boolean, "
    "comment string"
)
