"""The mapping of problem 2 said in SQL, without trees: every try of every value is compared with every name of its field."""

from __future__ import annotations

from casegrain.llm.canonical import ORDINARY
from casegrain.llm.lookalikes import representatives


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _slips(n: str) -> str:
    return f"(CASE WHEN {n} < 5 THEN 0 WHEN {n} < 9 THEN 1 WHEN {n} < 18 THEN 2 ELSE 3 END)"


def mapped_sql() -> str:
    """CTEs that end in mapped (field, value, entry), over canonical_terms and pair_descriptions."""
    table = representatives({chr(c): 1 for c in range(32, 127)})
    folded = ", ".join(f"({ord(a)}, {_quoted(b)})" for a, b in table.items() if len(a) == 1)
    ordinary = ", ".join(_quoted(w) for w in sorted(ORDINARY))
    spaced = lambda c: f"trim(regexp_replace({c}, '[^\\p{{L}}\\p{{N}}&+'']+', ' ', 'g'))"
    near = f"abs(length(q) - length(name)) <= 3 AND damerau_levenshtein(q, name) <= {_slips('least(length(name), length(q) + 1)')}"
    return f"""folded AS (SELECT * FROM (VALUES {folded}) f(cp, plain)),
      entered AS (SELECT DISTINCT field, value FROM (SELECT 'modality' AS field, modality AS value FROM pair_descriptions UNION ALL SELECT 'anatomy', anatomy FROM pair_descriptions UNION ALL SELECT 'diagnosis', diagnosis FROM pair_descriptions)
        WHERE regexp_replace(value, '[\\s\\p{{Z}}\\p{{Cf}}]+', '', 'g') <> '' AND (field, value) NOT IN (SELECT (field, term) FROM canonical_terms)),
      given AS (SELECT field, term AS name, term_id FROM canonical_terms UNION ALL SELECT field, unnest(aliases), term_id FROM canonical_terms),
      raws AS (SELECT value AS raw FROM entered UNION SELECT name FROM given WHERE name IS NOT NULL),
      chars AS (SELECT raw, unnest(string_split(nfc_normalize(raw), '')) AS c, generate_subscripts(string_split(nfc_normalize(raw), ''), 1) AS i FROM raws),
      shown AS (SELECT raw, nfc_normalize(string_agg(coalesce(plain, c), '' ORDER BY i)) AS s FROM chars LEFT JOIN folded ON cp = unicode(c) GROUP BY raw),
      names AS (SELECT field, lower({spaced('s')}) AS name, min(term_id) AS entry, bool_or(regexp_full_match(trim(given.name), '[A-Z0-9&/]{{2,5}}')) AS acronym FROM given JOIN shown ON raw = given.name GROUP BY 1, 2 HAVING lower({spaced('s')}) <> ''),
      longest AS (SELECT field, max(len(string_split(name, ' '))) AS most FROM names GROUP BY 1),
      v AS (SELECT field, value, string_split({spaced('s')}, ' ') AS words, lower({spaced('s')}) AS whole, list_transform(string_split(s, ','), lambda p: lower({spaced('p')})) AS parts,
        list_transform(string_split_regex(lower({spaced('s')}), '\\bof(?: the)? '), lambda h: trim(h)) AS heads FROM entered JOIN shown ON raw = value),
      tries AS (SELECT field, value, whole AS q FROM v UNION SELECT field, value, left(whole, length(whole) - 1) FROM v WHERE whole LIKE '%s' AND length(whole) > 5 UNION SELECT field, value, left(whole, length(whole) - 2) FROM v WHERE whole LIKE '%es' AND length(whole) > 6
        UNION SELECT field, value, array_to_string(list_concat(parts[i + 1:], parts[:i]), ' ') FROM (SELECT *, unnest(generate_series(1, len(parts) - 1)) AS i FROM v) UNION SELECT field, value, array_to_string(list_reverse(heads), ' ') FROM v WHERE len(heads) > 1),
      exact AS (SELECT v.field, value, entry FROM v JOIN names n ON n.field = v.field AND n.name = whole),
      tried AS (SELECT t.field, q, min_by(entry, (CASE WHEN q = name THEN 0 ELSE 1 END, damerau_levenshtein(q, name) / length(name), -length(name), entry)) AS e, min((CASE WHEN q = name THEN 0 ELSE 1 END, damerau_levenshtein(q, name) / length(name), -length(name), entry)) AS k
        FROM (SELECT DISTINCT field, q FROM tries) t JOIN names n ON n.field = t.field AND {near} GROUP BY 1, 2),
      whole_hits AS (SELECT field, value, min_by(e, k) AS entry FROM tries JOIN tried USING (field, q) GROUP BY 1, 2),
      rest AS (SELECT v.*, most FROM v JOIN longest USING (field) WHERE (field, value) NOT IN (SELECT (field, value) FROM whole_hits)),
      starts AS (SELECT *, unnest(generate_series(1, len(words))) AS i FROM rest), grams AS (SELECT *, unnest(generate_series(1, least(len(words) - 1, most + 1, len(words) - i + 1))) AS n FROM starts),
      runs AS (SELECT field, value, lower(array_to_string(words[i:i + n - 1], ' ')) AS q, (upper(words[i]) = words[i] AND lower(words[i]) <> words[i]) OR lower(array_to_string(words[i:i + n - 1], ' ')) NOT IN ({ordinary}) AS short FROM grams),
      two AS (SELECT field, value, most, len(parts) AS k, string_split(parts[i], ' ') AS a, string_split(parts[i + 1], ' ') AS b, false AS inner_run FROM (SELECT *, unnest(generate_series(1, len(parts) - 1)) AS i FROM rest)
        UNION ALL SELECT field, value, most, 3, string_split(heads[i], ' '), string_split(heads[i + 1], ' '), true FROM (SELECT *, unnest(generate_series(1, len(heads) - 1)) AS i FROM rest)),
      ends AS (SELECT *, unnest(generate_series(1, least(len(a), most))) AS x FROM two WHERE a <> [''] AND b <> ['']), swaps AS (SELECT *, unnest(generate_series(1, least(len(b), CASE WHEN inner_run THEN most - x ELSE most END))) AS y FROM ends),
      placed AS (SELECT *, unnest(generate_series(1, CASE WHEN inner_run THEN len(b) - y + 1 ELSE 1 END)) AS z FROM swaps),
      every AS (SELECT field, value, q, short FROM runs UNION ALL SELECT field, value, left(q, length(q) - 2), false FROM runs WHERE q LIKE '%es' AND length(q) > 6
        UNION ALL SELECT field, value, array_to_string(list_concat(b[z:z + y - 1], a[len(a) - x + 1:]), ' '), false FROM placed WHERE inner_run OR x < len(a) OR y < len(b) OR k > 2),
      once AS (SELECT field, value, q, bool_or(short) AS short FROM every GROUP BY 1, 2, 3),
      met AS (SELECT t.field, q, name, entry, acronym, damerau_levenshtein(q, name) AS d FROM (SELECT DISTINCT field, q FROM once) t JOIN names n ON n.field = t.field AND {near}),
      run_hits AS (SELECT field, value, min_by(entry, (d / length(name) - length(name) / 1000, -length(name), entry)) AS entry FROM once JOIN met USING (field, q)
        WHERE CASE WHEN d = 0 THEN short OR NOT acronym ELSE length(name) >= 6 AND NOT acronym END GROUP BY 1, 2),
      mapped AS (SELECT v.field, v.value, coalesce(x.entry, w.entry, r.entry, -1) AS entry FROM v LEFT JOIN exact x USING (field, value) LEFT JOIN whole_hits w USING (field, value) LEFT JOIN run_hits r USING (field, value)),
      rows_in AS (SELECT record_index, 'modality' AS field, modality AS value FROM pair_descriptions UNION ALL SELECT record_index, 'anatomy', anatomy FROM pair_descriptions UNION ALL SELECT record_index, 'diagnosis', diagnosis FROM pair_descriptions)"""


FOUND_SQL = f"WITH {mapped_sql()} SELECT DISTINCT record_index, field, entry AS term_id FROM rows_in JOIN mapped USING (field, value)"
UNMATCHED_SQL = f"WITH {mapped_sql()} SELECT field, value, count(DISTINCT record_index) AS records FROM rows_in JOIN mapped USING (field, value) WHERE entry = -1 GROUP BY 1, 2"
