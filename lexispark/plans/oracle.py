"""DuckDB SQL for the queries over the test tables.  RE2 has neither lookaround nor backreferences, so some rules are said differently."""

from __future__ import annotations

from lexispark.functions import constants as K

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _n(text: str, pattern: str, flags: str = "") -> str:
    """Matches of a pattern."""
    p = pattern.replace("'", "''")
    return f"len(regexp_extract_all({text}, '{'(?' + flags + ')' if flags else ''}{p}'))"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '\\s+'), lambda t: t <> '')"


PAGES = """pn AS (SELECT source AS book, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS page_number, doc_id, text FROM documents),
pages_v AS (SELECT book, page_number, text, page_number % 5 = 0 AS was_ocr,
  CASE WHEN page_number % 5 = 0 THEN CAST(40 + (page_number * 7 + doc_id) % 60 AS DOUBLE) / CAST(100 AS DOUBLE) END AS conf FROM pn)"""
GOOD = PAGES + """,
good_v AS (SELECT * FROM pages_v WHERE NOT (was_ocr AND conf < 0.55))"""
CANDS = GOOD + f""",
glued AS (SELECT *, list_filter(string_split(regexp_replace(array_to_string(list_filter(list_transform(string_split(text, chr(10)),
  lambda x: trim(x, {_WS})), lambda x: x <> ''), chr(10)), '\\n([^A-ZÀ-Ý])', ' \\1', 'g'), chr(10)), lambda x: x <> '') AS cs FROM good_v),
cands AS (SELECT book, page_number, was_ocr, conf, CAST(generate_subscripts(cs, 1) - 1 AS INTEGER) AS idx, unnest(cs) AS candidate FROM glued)"""
_ENTRY = K.ENTRY.replace("'", "''")
MATCHED = CANDS + f""",
matched AS (SELECT *, length(candidate) > 800 AS oversized, trim(regexp_extract(candidate, '{_ENTRY}', 1), {_WS}) AS hw,
  regexp_extract(candidate, '{_ENTRY}', 2) AS pos, trim(regexp_extract(candidate, '{_ENTRY}', 3), {_WS}) AS gl FROM cands)"""
ENTRIES = MATCHED + """,
entries AS (SELECT substr(md5(concat_ws('#', book, page_number, idx)), 1, 16) AS id, hw AS headword, nullif(pos, '') AS part_of_speech, gl AS gloss_pivot,
  coalesce(nullif(CASE WHEN was_ocr THEN conf END, 0), CAST(1 AS DOUBLE)) AS confidence, book, page_number, idx,
  lower(hw) AS lk, lower(trim(hw, ' ')) AS k, lower(gl) AS g, rtrim(lower(gl), '.') AS gn,
  CAST(regexp_extract(book, '([0-9]+)$', 1) AS INTEGER) % 2 = 0 AS even_book
  FROM matched WHERE NOT oversized AND hw <> '' AND gl <> '')"""
_BARE = f"list_transform({_words('lower(text)')}, lambda t: trim(t, '.,;:()''’'))"
_POS = "len(list_filter(regexp_split_to_array(text, '[^A-Za-z]+'), lambda t: list_contains(" + _list(K.POS) + ", t)))"
_SENT = f"list_filter(list_transform(regexp_split_to_array(text, '[.!?]'), lambda s: len({_words('s')})), lambda n: n > 0)"
STATS = PAGES + f""",
stats AS (SELECT book, page_number, was_ocr, conf, CAST(len({_words('text')}) AS INTEGER) AS words,
  CAST({_n('text', K.DOTTED)} + {_n('text', K.CROSS_REF, 'i')} + {_n('text', K.PAREN_VARIANT)} + {_POS} AS INTEGER) AS markers,
  CAST({_n('text', K.PROSE_HINT, 'i')} + {_n('text', K.NUMBERED)} AS INTEGER) AS prose_hints,
  coalesce(list_sum({_SENT}) / CAST(len({_SENT}) AS DOUBLE), 0) AS avg_sentence_len,
  CAST({_n('text', K.SECTION, 'im')} AS INTEGER) AS section_headers, CAST({_n('text', K.NUMBERED_ITEM, 'm')} AS INTEGER) AS numbered_items,
  CAST(len(list_filter({_BARE}, lambda t: list_contains({_list(K.FUNCTION_WORDS['indonesian'])}, t))) AS INTEGER) AS indonesian_hits,
  CAST(len(list_filter({_BARE}, lambda t: list_contains({_list(K.FUNCTION_WORDS['english'])}, t))) AS INTEGER) AS english_hits
  FROM pages_v)"""


def _zones(floor: int) -> str:
    return STATS + f""",
liked AS (SELECT *, words >= 30 AND markers >= {floor} AND avg_sentence_len <= 15 AS lik, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY book) AS n FROM stats
  WINDOW w AS (PARTITION BY book ORDER BY page_number)),
near AS (SELECT *, coalesce(lead(lik) OVER w, false) AS aft, coalesce(lag(lik) OVER w, false) AS bef FROM liked WINDOW w AS (PARTITION BY book ORDER BY page_number)),
ends AS (SELECT book, count(*) AS m, min(i) AS f, max(i) AS l, arg_min(aft, i) AS fa, arg_max(bef, i) AS lb, any_value(n) AS nn FROM near WHERE lik GROUP BY book),
span AS (SELECT book, greatest(0, CASE WHEN fa THEN f ELSE 0 END - greatest(1, nn // m)) AS s, least(nn - 1, CASE WHEN lb THEN l ELSE nn - 1 END + greatest(1, nn // m)) AS e FROM ends),
zoned AS (SELECT near.*, CASE WHEN span.book IS NULL THEN 'front' WHEN i < s THEN 'front' WHEN i > e THEN 'back' ELSE 'body' END AS zone FROM near LEFT JOIN span USING (book))"""


FIRST = PAGES + f""",
first_v AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY page_number) AS r FROM pages_v QUALIFY r <= {K.FIRST_PAGES}),
lines_v AS (SELECT book, page_number, trim(unnest(string_split(text, chr(10))), {_WS}) AS line FROM first_v),
full_lines AS (SELECT * FROM lines_v WHERE line <> '')"""
_VALID = "abcdefghijklmnopqrstuvwxyz''-"
FIXED = ENTRIES + f""",
cand AS (SELECT *, headword AS original, NOT confidence >= 1 AS eligible, replace(replace(replace(headword, 'rn', 'm'), 'tt', 't'), 'é', 'è') AS candidate FROM entries),
chg AS (SELECT *, eligible AND candidate <> original AS changed, translate(lower(candidate), '{_VALID}', '') = '' AS valid FROM cand),
fixed AS (SELECT * EXCLUDE (headword, confidence), CASE WHEN changed AND valid THEN candidate ELSE headword END AS headword, changed AND valid AS fixed,
  CASE WHEN changed AND valid THEN greatest(0, confidence - 0.03::DOUBLE) ELSE confidence END AS confidence FROM chg)"""
FLAGS = FIXED + """,
odd AS (SELECT * FROM fixed WHERE NOT even_book),
typo AS (SELECT id AS entry_id, original AS headword, 'ocr_typo' AS issue_type, false AS web, 1 AS stage, book, page_number, idx, 0 AS k, original || ' -> ' || candidate AS fix FROM odd WHERE changed AND NOT fixed
  UNION ALL SELECT id, headword, 'low_confidence', false, 1, book, page_number, idx, 1, NULL FROM odd WHERE eligible AND confidence < 0.75::DOUBLE),
keyed AS (SELECT *, lower(trim(headword, ' ')) AS hk FROM odd),
lagged AS (SELECT *, lag(gn) OVER (PARTITION BY hk ORDER BY book, page_number, idx) AS prior FROM keyed),
meaning AS (SELECT id AS entry_id, headword, 'duplicate_headword' AS issue_type, true AS web, 2 AS stage, book, page_number, idx, 0 AS k, NULL AS fix FROM lagged WHERE prior <> gn
  UNION ALL SELECT a.id, a.headword, 'meaning_conflict', true, 2, a.book, a.page_number, a.idx, CAST(row_number() OVER (PARTITION BY a.id ORDER BY b.book, b.page_number, b.idx) AS INTEGER), NULL
  FROM keyed a JOIN entries b ON a.hk = b.k AND b.even_book AND a.gn <> b.gn),
new AS (SELECT * FROM typo UNION ALL SELECT * FROM meaning)"""
STORED = FLAGS + """,
pass1 AS (SELECT * FROM new QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY stage, book, page_number, idx, k) = 1),
again AS (SELECT DISTINCT entry_id FROM new WHERE page_number % 2 = 0),
stored AS (SELECT pass1.*, again.entry_id IS NULL AS resolved, 1 AS raised_at_pass FROM pass1 LEFT JOIN again USING (entry_id))"""
ESCALATED = STORED + """,
late AS (SELECT * EXCLUDE (web), web OR NOT resolved AS web, web OR NOT resolved AS has_query FROM stored)"""
SENSES = ENTRIES + """,
sense AS (SELECT k, g, count(*) AS n, first(gloss_pivot ORDER BY confidence DESC, book, page_number, idx) AS gp, max(confidence) AS c, min((book, page_number, idx)) AS first_at,
  first(headword ORDER BY confidence DESC, book, page_number, idx) AS hw, first(page_number ORDER BY confidence DESC, book, page_number, idx) AS pr,
  first((book, page_number, idx) ORDER BY confidence DESC, book, page_number, idx) AS best_at FROM entries GROUP BY k, g),
numbered AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY first_at) AS no FROM sense),
books AS (SELECT k, array_to_string(list_sort(list_distinct(list(book))), ',') AS bs, count(*) AS n FROM entries GROUP BY k),
whole AS (SELECT k, count(*) AS gs, string_agg('(' || no || ') ' || gp, '; ' ORDER BY no) AS text, list_slice(list(gp ORDER BY no), 1, 10) AS xs, sum(c) AS cs, first(hw ORDER BY c DESC, best_at) AS hw,
  first(pr ORDER BY c DESC, best_at) AS pr, first(gp ORDER BY c DESC, best_at) AS gp, max(c) AS c FROM numbered GROUP BY k)"""


def _flags(name: str, where: str, issue: str, web: str = "false", head: str = ENTRIES, pass_no: int = 0) -> str:
    return f"WITH {head} SELECT id AS entry_id, headword, '{issue}' AS issue_type, {pass_no} AS raised_at_pass, {web} AS needs_web_check, book, page_number, idx FROM {name} WHERE {where}"


def _count_words(language: str) -> str:
    return f"len(list_filter({_words('lower(gloss_pivot)')}, lambda t: list_contains({_list(K.CHECK_WORDS[language])}, t)))"


def _hit(kind: str, pattern: str, word: str = "headword") -> str:
    root = f"regexp_extract({word}, '{pattern}', 1)"
    return f"CASE WHEN length({root}) >= 2 THEN '{kind}:' || {root} END"


_HITS = [
    *[_hit("prefix", p) for p in K.PREFIXES.values()],
    *[_hit("suffix", p) for p in K.SUFFIXES.values()],
    *[_hit("circumfix", p) for p in K.CIRCUMFIXES.values()],
]
_LOWER = "lower({w})"


def _base(w: str) -> str:
    """x-x, x x, and two or three letters doubled, of ASCII letters; the base in the word's own case."""
    half = f"substr({w}, 1, length({w}) // 2)"
    return f"""CASE WHEN regexp_full_match({w}, '(?i)[a-z]+-[a-z]+') AND lower(split_part({w}, '-', 1)) = lower(split_part({w}, '-', 2)) THEN split_part({w}, '-', 1)
  WHEN regexp_full_match({w}, '(?i)[a-z]{{4}}|[a-z]{{6}}') AND lower({half}) = lower(substr({w}, length({w}) // 2 + 1)) THEN {half} END"""


MORPH = ENTRIES + f""",
m AS (SELECT *, {_base('headword')} AS base, list_filter([{', '.join(_HITS)}], lambda x: x IS NOT NULL) AS hits FROM entries),
r AS (SELECT *, coalesce(base, substr(hits[1], instr(hits[1], ':') + 1)) AS root FROM m)"""

ORACLE: dict[str, str] = {
    "book_id": """WITH p AS (SELECT DISTINCT '/Data Sets/' || source || ' My-Book__' || lang || '.v1.PDF' AS path FROM documents)
SELECT path, trim(regexp_replace(translate(lower(regexp_replace(regexp_extract(path, '[^/]*$'), '\\.[^.]*$', '')), ' -', '__'), '_+', '_', 'g'), '_') AS book_id FROM p""",
    "natural_sort": """WITH n AS (SELECT CASE WHEN doc_id % 7 = 0 THEN 'part ' || source || '-' || doc_id || '.pdf' ELSE doc_id || ' ' || source || '.pdf' END AS name FROM documents)
SELECT name, CAST(row_number() OVER (ORDER BY TRY_CAST(regexp_extract(name, '^\\s*([0-9]+)', 1) AS DECIMAL(38,0)) NULLS LAST, name) AS INTEGER) AS place FROM n""",
    "page_probe": f"""WITH {PAGES}, probe AS (SELECT book, CASE WHEN was_ocr THEN substr(text, 1, 40) ELSE text END AS layer FROM pages_v)
SELECT book, count(*) FILTER (length(trim(coalesce(layer, ''), {_WS})) < 200) AS to_ocr, count(*) FILTER (length(trim(coalesce(layer, ''), {_WS})) >= 200) AS digital FROM probe GROUP BY book""",
    "page_quality_split": f"""WITH {PAGES} SELECT book, count(*) FILTER (NOT was_ocr) AS n_digital, count(*) FILTER (was_ocr AND conf >= 0.55) AS n_ocr,
  count(*) FILTER (was_ocr AND conf < 0.55) AS n_bad FROM pages_v GROUP BY book""",
    "ocr_word_agg": """WITH t AS (SELECT conv_id, turn, string_split(text, ' ') AS ws FROM conversations),
w AS (SELECT conv_id, turn, generate_subscripts(ws, 1) - 1 AS idx, unnest(ws) AS word FROM t),
c AS (SELECT *, (idx * 37 + turn * 11 + conv_id) % 110 - 10 AS conf FROM w WHERE trim(word, ' ' || chr(9) || chr(10) || chr(13)) <> '')
SELECT conv_id, turn, string_agg(word, ' ' ORDER BY idx) AS text, round(coalesce(avg(conf) FILTER (conf >= 0) / 100, 0), 6) AS ocr_confidence FROM c GROUP BY conv_id, turn""",
    "candidate_lines": f"WITH {CANDS} SELECT book, page_number, idx, candidate FROM cands",
    "split_mode_chunks": f"""WITH {GOOD}, s AS (SELECT book, page_number, list_filter(list_transform(string_split(regexp_replace(text, 'The ', chr(1) || 'The ', 'g'), chr(1)),
  lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'), ' ')), lambda x: x <> '') AS cs FROM good_v)
SELECT book, page_number, CAST(generate_subscripts(cs, 1) - 1 AS INTEGER) AS idx, unnest(cs) AS candidate FROM s""",
    "extract": f"WITH {ENTRIES} SELECT id, headword, part_of_speech, gloss_pivot, confidence, book, page_number, idx FROM entries",
    "extract_counts": f"""WITH {MATCHED} SELECT book, count(*) FILTER (NOT oversized AND hw <> '' AND gl <> '') AS entries,
  count(*) FILTER (NOT oversized AND NOT (hw <> '' AND gl <> '')) AS skipped, count(*) FILTER (oversized) AS oversized FROM matched GROUP BY book""",
    "page_sample": f"""WITH {PAGES}, i AS (SELECT book, page_number, row_number() OVER (PARTITION BY book ORDER BY page_number) - 1 AS i, count(*) OVER (PARTITION BY book) AS n FROM pages_v)
SELECT book, page_number FROM i WHERE n <= 24 OR i IN (SELECT least(CAST(floor(r.x * (CAST(i.n AS DOUBLE) / CAST(24 AS DOUBLE))) AS BIGINT), i.n - 1) FROM range(24) r(x))""",
    "page_stats": f"""WITH {STATS} SELECT book, page_number, words, markers, prose_hints, round(avg_sentence_len, 6) AS avg_sentence_len, section_headers, numbered_items,
  indonesian_hits, english_hits FROM stats""",
    "zone_split": f'WITH {_zones(3)} SELECT book, page_number, lik AS "like", zone FROM zoned',
    "zone_split_dense": f'WITH {_zones(0)} SELECT book, page_number, lik AS "like", zone FROM zoned',
    "book_kind": f"""WITH {_zones(0)}, b AS (SELECT *, bool_or(zone = 'body') OVER (PARTITION BY book) AS has_body FROM zoned),
f AS (SELECT book, bool_or(has_body) AS has_body, median(words) AS words, avg(markers) AS markers, avg(CAST(prose_hints >= 3 OR avg_sentence_len > 15 AS DOUBLE)) AS prose,
  avg(CAST(lik AS DOUBLE)) AS dict_like, avg(CAST(section_headers >= 1 AS DOUBLE)) AS sectional FROM b WHERE NOT has_body OR zone = 'body' GROUP BY book)
SELECT book, CASE WHEN NOT has_body AND words >= 30 THEN 'teaching_book' WHEN NOT has_body THEN 'unknown' WHEN words < 60 AND markers < 3 THEN 'kids_picture_book'
  WHEN sectional >= 0.15 AND (prose >= 0.3 OR sectional >= 0.5) THEN 'grammar_morphology' WHEN dict_like < 0.5 AND prose >= 0.5 THEN 'grammar_morphology'
  WHEN dict_like >= 0.2 AND prose >= 0.2 THEN 'mixed' ELSE 'dictionary' END AS book_kind, has_body,
  round(words, 6) AS words, round(markers, 6) AS markers, round(prose, 6) AS prose, round(dict_like, 6) AS dict_like, round(sectional, 6) AS sectional FROM f""",
    "book_conventions": f"""WITH {_zones(0)} SELECT book, count(*) AS pages, round(avg(markers), 6) AS markers_per_page, CAST(sum(markers) AS BIGINT) AS markers_total,
  count(*) FILTER (numbered_items >= 5) AS numbered_pages, CAST(sum(indonesian_hits) AS BIGINT) AS indonesian_hits, CAST(sum(english_hits) AS BIGINT) AS english_hits
  FROM zoned WHERE zone = 'body' GROUP BY book""",
    "unreadable_pages": f"WITH {PAGES} SELECT book, page_number FROM pages_v WHERE was_ocr AND conf < 0.55",
    "conv_headword_shape": f"""WITH {FIRST}, h AS (SELECT book, regexp_extract(line, '(?i)^(?:a\\s+)?[•·.]{{0,3}}\\s*([a-zà-ÿ''\\-]+)', 1) AS hw FROM full_lines)
SELECT book, 1 AS most_common_word_count, bool_or(contains(hw, '-')) AS has_hyphen, bool_or(contains(hw, '''')) AS has_apostrophe, CAST(max(length(hw)) AS INTEGER) AS max_headword_length
FROM h WHERE hw <> '' GROUP BY book""",
    "conv_gloss_langs": f"""WITH {FIRST}, w AS (SELECT book, unnest(list_transform({_words('lower(text)')}, lambda t: trim(t, '.,;:()''"'))) AS w FROM first_v),
h AS (SELECT book, 'english' AS language FROM w WHERE list_contains({_list(K.FUNCTION_WORDS['english'])}, w)
  UNION ALL SELECT book, 'indonesian' FROM w WHERE list_contains({_list(K.FUNCTION_WORDS['indonesian'])}, w))
SELECT book, language, count(*) AS hits FROM h GROUP BY book, language HAVING count(*) > 5""",
    "conv_cross_refs": f"WITH {FIRST} "
    + " UNION ALL ".join(f"SELECT book, '{m}' AS marker, CAST(sum({_n('text', p, 'i')}) AS BIGINT) AS n FROM first_v GROUP BY book" for m, p in K.CROSS_REFS.items()),
    "conv_layout": f"WITH {FIRST} SELECT book, bool_or({_n('text', K.ANY_DOTS)} > 5) AS dotted_markers, bool_or({_n('text', K.SENSE, 'm')} > 3) AS multi_sense FROM first_v GROUP BY book",
    "typo_fix": f"WITH {FIXED} SELECT id, original, candidate, headword, fixed, round(confidence, 6) AS confidence FROM fixed WHERE changed",
    "typo_and_low_flags": f"""WITH {FIXED} SELECT id AS entry_id, original AS headword, 'ocr_typo' AS issue_type, 2 AS raised_at_pass, false AS needs_web_check, book, page_number, idx
  FROM fixed WHERE changed AND NOT fixed
UNION ALL SELECT id, headword, 'low_confidence', 2, true, book, page_number, idx FROM fixed WHERE eligible AND confidence < 0.75::DOUBLE""",
    "dup_headword_flags": f"""WITH {ENTRIES}, l AS (SELECT *, lag(gloss_pivot) OVER w AS prior, lag(gn) OVER w AS pn FROM entries WINDOW w AS (PARTITION BY k ORDER BY book, page_number, idx))
SELECT id AS entry_id, headword, 'two glosses in this pass / ' || prior || ' / ' || gloss_pivot AS note,
  '"' || headword || '" Invented dictionary: "' || prior || '" or "' || gloss_pivot || '" (Bahasa Indonesia)?' AS suggested_query FROM l WHERE pn <> gn""",
    "corpus_conflict_flags": f"""WITH {ENTRIES}, p AS (SELECT a.id AS entry_id, a.headword, a.gloss_pivot, count(*) AS n, arg_min(b.gloss_pivot, (b.book, b.page_number, b.idx)) AS prior
  FROM entries a JOIN entries b ON a.k = b.k AND NOT a.even_book AND b.even_book AND a.gn <> b.gn GROUP BY a.id, a.headword, a.gloss_pivot)
SELECT entry_id, headword, 'meaning_conflict' AS issue_type, 'prior corpus differs / ' || prior || ' / ' || gloss_pivot AS note, true AS needs_web_check,
  '"' || headword || '" Invented language meaning ("' || prior || '" OR "' || gloss_pivot || '" in Bahasa Indonesia)' AS suggested_query, n FROM p""",
    "recurring_subs": f"""WITH {ENTRIES}, c AS (SELECT headword, replace(headword, 'e', 'c') AS candidate FROM entries WHERE NOT confidence >= 1)
SELECT headword || ' -> ' || candidate AS subject, count(*) AS n, round(least(CAST(0.5 AS DOUBLE) + CAST(0.05 AS DOUBLE) * count(*), CAST(0.95 AS DOUBLE)), 6) AS confidence
FROM c WHERE candidate <> headword AND translate(lower(candidate), 'abcdefgijklmnopqrstuvwxyz''-', '') <> '' GROUP BY 1 HAVING count(*) >= 3""",
    "page_clusters": f"WITH {FLAGS} SELECT concat_ws('#', book, page_number) AS subject, count(*) AS n, round(least(CAST(0.4 AS DOUBLE) + CAST(0.1 AS DOUBLE) * count(*), CAST(0.9 AS DOUBLE)), 6) AS confidence FROM new GROUP BY book, page_number HAVING count(*) >= 3",
    "issue_hotspot": f"""WITH {FLAGS}, t AS (SELECT issue_type, count(*) AS n, min((stage, book, page_number, idx, k)) AS f FROM new GROUP BY issue_type)
SELECT issue_type AS subject, n, round(CAST(n AS DOUBLE) / (SELECT sum(n) FROM t), 2) AS confidence FROM t WHERE n >= 3 AND n * 2 >= (SELECT sum(n) FROM t) ORDER BY n DESC, f LIMIT 1""",
    "reconcile_flags": f"WITH {STORED} SELECT entry_id, issue_type, raised_at_pass, resolved, web AS needs_web_check FROM stored",
    "final_escalation": f"WITH {ESCALATED} SELECT entry_id, issue_type, resolved, web AS needs_web_check, has_query FROM late",
    "web_queue": f"WITH {ESCALATED} SELECT entry_id, headword, issue_type FROM late WHERE web AND NOT resolved",
    "record_evidence": f"""WITH {STORED} SELECT entry_id, issue_type, resolved OR (page_number % 3 = 0 AND entry_id < '8') AS resolved, CASE WHEN page_number % 3 = 0 THEN 'seen' END AS web_evidence,
  CASE WHEN (resolved OR (page_number % 3 = 0 AND entry_id < '8')) AND page_number % 3 = 0 THEN 'resolved (web)' WHEN resolved THEN 'resolved' WHEN web THEN 'open, web check suggested' ELSE 'open' END AS status FROM stored""",
    "flag_status": f"""WITH {ESCALATED}, s AS (SELECT CASE WHEN resolved THEN 'resolved' WHEN web THEN 'open, web check suggested' ELSE 'open' END AS status FROM late)
SELECT status, count(*) AS n FROM s GROUP BY status""",
    "quality_report": f"WITH {STORED} SELECT (SELECT count(*) FROM new) AS flags_raised, (SELECT count(*) FROM stored WHERE resolved) AS flags_resolved, (SELECT count(*) FROM stored) AS flags_stored",
    "entries_by_headword": f"WITH {ENTRIES} SELECT headword, string_agg(id, ',' ORDER BY book, page_number, idx) AS ids FROM entries GROUP BY headword",
    "empty_gloss": _flags("entries", "length(gloss_pivot) < 2", "low_confidence"),
    "gloss_conflicts": f"""WITH {ENTRIES}, each AS (SELECT lk, gloss_pivot AS gp, min(g) AS g, min((book, page_number, idx)) AS first_at, count(*) AS n FROM entries GROUP BY lk, gloss_pivot),
many AS (SELECT lk, list({{'gp': gp, 'n': n}} ORDER BY first_at) AS m FROM each GROUP BY lk HAVING count(DISTINCT g) > 1),
told AS (SELECT e.*, list_filter(list_transform(m, lambda x: {{'gp': x.gp, 'n': x.n - CAST(x.gp = e.gloss_pivot AS INTEGER)}}), lambda x: x.n > 0) AS o FROM entries e JOIN many USING (lk))
SELECT id AS entry_id, headword, 'duplicate_headword' AS issue_type, 0 AS raised_at_pass, true AS needs_web_check, '"' || headword || '" arti bahasa Indonesia OR "' || headword || '" meaning' AS suggested_query,
  book, page_number, idx, md5('this gloss: ' || gloss_pivot || '; other glosses: ' ||
  array_to_string(list_transform(o, lambda x: CASE WHEN x.n > 1 THEN x.gp || ' (x' || x.n || ')' ELSE x.gp END), '; ')) AS note_md5 FROM told""",
    "example_check": _flags(
        "s",
        "NOT contains(lower(gloss_pivot), lk) AND stem <> '' AND NOT contains(lower(gloss_pivot), stem)",
        "low_confidence",
        head=ENTRIES + ", s AS (SELECT *, regexp_replace(regexp_replace(lk, '^(?:me[nmblryksw]|pe[nmblryksw]|ber|ter|di)', ''), '(?:an|i|kan)$', '') AS stem FROM entries)",
    ),
    "gloss_language": _flags("entries", f"{_count_words('english')} > {_count_words('indonesian')} + 2", "meaning_conflict"),
    "headword_suspicion": f"""WITH {ENTRIES}, a AS (SELECT *, length(headword) = 1 AND regexp_matches(headword, '^\\pL$') AS one FROM entries)
SELECT id AS entry_id, headword, 'one letter: ' || headword AS note, true AS needs_web_check FROM a WHERE one
UNION ALL SELECT id, headword, 'mixed case: ' || headword, false FROM a WHERE NOT one AND length(headword) > 3 AND regexp_matches(headword, '^\\p{{Lu}}.*\\p{{Lu}}') AND regexp_matches(headword, '\\p{{Ll}}')
UNION ALL SELECT id, headword, 'digits: ' || headword, false FROM a WHERE NOT one AND regexp_matches(headword, '\\p{{Nd}}')""",
    "web_query_text": f"""WITH {ENTRIES} SELECT id, '"' || headword || '" arti bahasa Indonesia OR "' || headword || '" meaning' AS query FROM entries""",
    "homonym_exact": f"""WITH {ENTRIES}, g AS (SELECT lk, g, count(*) AS n FROM entries GROUP BY lk, g),
h AS (SELECT lk, CAST(sum(n) AS INTEGER) AS n, list_sort(list_reduce(list({_words('g')}), lambda a, b: list_intersect(a, b))) AS shared FROM g GROUP BY lk HAVING count(*) > 1),
d AS (SELECT lk, n, list_sort(list_distinct(shared)) AS s FROM h)
SELECT CASE WHEN len(s) >= 2 THEN 'polysemy' ELSE 'homonym' END AS type, lk AS headword, n, array_to_string(s, ', ') AS evidence,
  CASE WHEN len(s) >= 2 THEN 'merge_with_senses' ELSE 'keep_separate' END AS action FROM d""",
    "homonym_known_pairs": f"""WITH {ENTRIES}, twin AS (SELECT id, lk, gloss_pivot FROM entries UNION ALL SELECT 't' || id, lk || 's', gloss_pivot FROM entries),
s AS (SELECT lk, list_sort(list_distinct(list(gloss_pivot))) AS gs, list(id) AS ids FROM twin GROUP BY lk)
SELECT unnest(list_concat(a.ids, b.ids)) AS entry_id, a.lk AS word1 FROM s a JOIN s b ON b.lk = a.lk || 's' AND a.gs = b.gs WHERE a.lk IN (SELECT lk FROM entries)""",
    "reduplication": f"""WITH w AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '[^A-Za-z-]+')) AS word FROM documents), b AS (SELECT word, {_base('word')} AS base FROM w)
SELECT word, base FROM b WHERE base IS NOT NULL""",
    "affix_strip": f"WITH {MORPH} SELECT DISTINCT headword, array_to_string(hits, ',') AS hits FROM m",
    "morph_findings": f"""WITH {MORPH} SELECT CASE WHEN base IS NOT NULL THEN 'reduplication' ELSE split_part(hits[1], ':', 1) END AS type, headword AS derived_form, root, id AS entry_id,
  CASE WHEN base IS NOT NULL THEN 'keep_as_entry' WHEN len(list_filter(hits, lambda x: starts_with(x, 'prefix:'))) > 0 THEN 'flag_as_variant'
  WHEN len(list_filter(hits, lambda x: starts_with(x, 'suffix:'))) > 0 THEN 'cross_reference' ELSE 'keep_as_entry' END AS action FROM r WHERE root <> headword""",
    "derived_forms": f"WITH {MORPH}, d AS (SELECT DISTINCT headword, root FROM r WHERE root IS NOT NULL) SELECT root, string_agg(headword, ',' ORDER BY headword) AS derived_forms FROM d GROUP BY root",
    "merge_same_gloss": f"""WITH {SENSES} SELECT w.hw AS headword, w.gp AS gloss_pivot, round(w.c, 3) AS confidence, b.bs AS source_book, w.pr AS page_ref, b.n AS n_entries,
  CASE WHEN b.n = 1 THEN 'single' ELSE 'same' END AS how, w.gp AS examples FROM whole w JOIN books b USING (k) WHERE w.gs = 1""",
    "merge_multi_sense": f"""WITH {SENSES} SELECT w.hw AS headword, md5(w.text) AS gloss_pivot, round(w.cs / b.n, 3) AS confidence, b.bs AS source_book, w.pr AS page_ref, b.n AS n_entries, 'senses' AS how,
  array_to_string(w.xs, '|') AS examples FROM whole w JOIN books b USING (k) WHERE w.gs > 1""",
    "merge_conflicts": f"""WITH {SENSES}, shared AS (SELECT k, list_reduce(list(string_split(g, ' ') ORDER BY first_at), lambda x, y: list_intersect(x, y)) AS common FROM sense GROUP BY k HAVING count(*) > 1)
SELECT k AS key, b.bs AS source_book, b.n AS n_entries FROM shared JOIN books b USING (k) WHERE len(common) = 0 AND contains(b.bs, ',')""",
    "merge_summary": f"WITH {ENTRIES} SELECT count(DISTINCT book) AS books, count(*) AS entries_in, count(DISTINCT k) AS entries_out, CAST(0 AS BIGINT) AS conflicts FROM entries",
    "cross_book_conflicts": f"WITH {ENTRIES} SELECT k AS key, count(DISTINCT g) AS n_glosses, count(DISTINCT book) AS n_books FROM entries GROUP BY k HAVING count(DISTINCT g) > 1 AND count(DISTINCT book) > 1",
    "dangling_references": f"""WITH {ENTRIES}, x AS (SELECT id, headword, unnest(list_distinct(regexp_extract_all(gloss_pivot, '(?i)\\b(?:of\\s+the|de\\s+la)\\s+([A-Za-zÀ-ÿ''’\\-]+)', 1))) AS reference FROM entries)
SELECT * FROM x WHERE lower(reference) NOT IN (SELECT k FROM entries)""",
}
