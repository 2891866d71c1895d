"""Schemas of the stored tables and of the JSON answers that sources give."""

PAGE_LOG = "pos BIGINT NOT NULL, batch BIGINT NOT NULL, id BIGINT NOT NULL, title STRING NOT NULL"

LISTING_JSON = "query STRUCT<allpages: ARRAY<STRUCT<title: STRING, pageid: BIGINT>>>, continue STRUCT<apcontinue: STRING>"
CATEGORY_JSON = "query STRUCT<categorymembers: ARRAY<STRUCT<title: STRING, pageid: BIGINT>>>, continue STRUCT<cmcontinue: STRING>"
CONTENT_JSON = "query STRUCT<pages: ARRAY<STRUCT<title: STRING, revisions: ARRAY<STRUCT<slots: STRUCT<main: STRUCT<content: STRING>>>>>>>, error STRUCT<code: STRING>"
LOCK_JSON = "query STRUCT<pages: ARRAY<STRUCT<title: STRING, allevel: STRING, missing: BOOLEAN, pageid: BIGINT>>>"
