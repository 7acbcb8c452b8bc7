"""Shared oracle SQL fragments."""

_TAG_SQL = r"""
WITH hits AS (
  SELECT doc_id, [
    CASE WHEN regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])en([^\p{L}\p{N}_]|$)') THEN 'en' END,
    CASE WHEN regexp_matches(text, 'Copyright|License') THEN 'license' END,
    CASE WHEN regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])ouble([^\p{L}\p{N}_]|$)') THEN 'ouble' END,
    CASE WHEN regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])the([^\p{L}\p{N}_]|$)') THEN 'the' END,
    CASE WHEN regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])the($|[^\p{L}\p{N}_ ]| $| [^o]| o$| o[^f])') THEN 'the_not_of' END,
    CASE WHEN regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])tion([^\p{L}\p{N}_]|$)') THEN 'tion' END,
    CASE WHEN regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])was([^\p{L}\p{N}_]|$)') THEN 'was' END,
    CASE WHEN regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])worthless([^\p{L}\p{N}_]|$)') THEN 'worthless' END
  ] AS arr FROM documents),
tags AS (SELECT doc_id, list_filter(arr, lambda x: x IS NOT NULL) AS terms FROM hits)
"""
TAG_SQL = _TAG_SQL
