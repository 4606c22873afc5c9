"""DuckDB SQL for the queries that SQL can express. The others (a classifier fitted on a draw, a tokenizer, records)
are compared with brute force in the tests."""

# Lower-cases A-Z alone, as lower() takes all letters.
_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP5 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, i - 1 AS k, hash(w) AS item_row, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS said
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows
), places AS (
  SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS said
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
), met AS (SELECT r, i, p.size, item_id, k, item_row FROM places p JOIN windows USING (size, said)
), hit AS (SELECT DISTINCT r, unnest(range(i, i + size)) AS pos FROM (SELECT DISTINCT r, i, size FROM met)
), hits AS (SELECT r, count(*) AS n_hit FROM hit GROUP BY r
), matches AS (
  SELECT r, item_id, min(i) - 1 AS pos, min(k) AS k, max(size) + count(*) - 1 AS n
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, item_id, item_row, size, i - k ORDER BY i) AS g FROM (SELECT DISTINCT r, i, size, item_id, k, item_row FROM met)) GROUP BY r, item_id, item_row, size, i - k, g
), longest AS (
  SELECT r, n AS longest, pos AS longest_at, CAST(item_id AS VARCHAR) AS longest_item, k AS longest_item_at
  FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY n DESC, pos, CAST(item_id AS VARCHAR) NULLS LAST, k) AS best FROM matches) WHERE best = 1
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM met WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(longest, 0) AS BIGINT) AS longest, CAST(coalesce(longest_at, -1) AS BIGINT) AS longest_at, longest_item, CAST(coalesce(longest_item_at, -1) AS BIGINT) AS longest_item_at
FROM d LEFT JOIN hits USING (r) LEFT JOIN longest USING (r) LEFT JOIN items USING (r)
"""

_OP8 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS (
  SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (SELECT doc_id AS node, doc_id AS low FROM documents UNION SELECT e.b, reach.low FROM reach JOIN edge e ON e.a = reach.node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, low AS component_id
FROM d LEFT JOIN size USING (doc_id) JOIN (SELECT node, min(low) AS low FROM reach GROUP BY node) c ON c.node = d.doc_id
"""

# The patterns of the kinds of spans, in RE2, as in the modules; a span is the group, or all of a match.
_PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 0, "true"),
    "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", 0, "list_bool_and([len(ltrim(x, '0')) <= 3 AND coalesce(TRY_CAST(ltrim(x, '0') AS INT), 0) <= 255 for x in string_split(s, '.')])"),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", 0, "len(n) BETWEEN 12 AND 19 AND list_sum([CASE WHEN i % 2 = 1 THEN CAST(reverse(n)[i] AS INT) WHEN CAST(reverse(n)[i] AS INT) > 4 THEN 2 * CAST(reverse(n)[i] AS INT) - 9 ELSE 2 * CAST(reverse(n)[i] AS INT) END for i in range(1, len(n) + 1)]) % 10 = 0"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", 0, "len(n) BETWEEN 9 AND 15"),
    "url_login": (r"""://([^\s/?#@:"'<>]+:[^\s/?#@"'<>]+)@""", 1, "true"),
    "account": (r"(?:%s)[\x20:.#=-]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{2,4}){3,8}|[0-9](?:[\x20-]?[0-9]){7,33})", 1, "true"),
}
_CUES = ("iban", "account no", "account number", "acct", "passport no", "ssn")
_PII["account"] = (_PII["account"][0] % "|".join(sorted({f for c in _CUES for f in (c, c.upper(), c.capitalize(), c.title())})), 1, "true")
_SECRETS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 0, "len(g) >= 12"),
    "access": (r"AKIA[A-Z0-9]+", 0, "len(s) >= 18"),
    "hex": (r"[0-9a-f]+", 0, "len(s) >= 16"),
    "private_key": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, "true"),
    "web_token": (r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, "true"),
    "platform_token": (r"(?:ghp_|glpat-|xoxb-)[A-Za-z0-9-]{20,}", 0, "true"),
}


def _spans(kinds: dict[str, tuple[str, int, str]], base: int) -> str:
    """All spans of each text by kind: matches and the gaps between them give the places."""

    def one(k: int, name: str) -> str:
        pattern, group, rule = kinds[name]
        text = pattern.replace("'", "''")
        inner = 1 if "(" in pattern.replace("(?", "") else 0
        shift = "len(split_part(s, g, 1))" if group else "0"  # a group's place in its match, which starts with no part of it
        return f"""SELECT r, {k} AS k, '{name}' AS kind, pos + {shift} AS b, pos + {shift} + {'len(g)' if group else 'len(s)'} AS e FROM (
  SELECT r, found[i] AS s, inner_[i] AS g, regexp_replace(found[i], '[^0-9]', '', 'g') AS n, list_sum([len(x) for x in gaps[1:i]]) + coalesce(list_sum([len(x) for x in found[1:i - 1]]), 0) AS pos
  FROM (SELECT r, found, inner_, gaps, unnest(range(1, len(found) + 1)) AS i FROM (
    SELECT r, regexp_extract_all(t, '{text}') AS found, regexp_extract_all(t, '{text}', {inner}) AS inner_, string_split_regex(t, '{text}') AS gaps FROM d) WHERE len(found) > 0)) WHERE {rule}"""

    names = list(kinds)
    parts = " UNION ALL ".join(one(k, n) for k, n in enumerate(names))
    counts = ", ".join(f"CAST(coalesce(count(*) FILTER (k = {k}), 0) AS BIGINT) AS n_{n}" for k, n in enumerate(names[:base]))
    say = "concat(kind, ':', b, ':', e)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), spans AS ({parts})
SELECT doc_id, {counts}, sha256(coalesce(string_agg({say}, ',' ORDER BY b, k) FILTER (k < {base}), '')) AS base_sha256, coalesce(string_agg({say}, ',' ORDER BY b, k, e) FILTER (k IS NOT NULL), '') AS spans
FROM d LEFT JOIN spans USING (r) GROUP BY r, doc_id
"""


_OP6 = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, text, list_filter(string_split(replace(replace(replace(replace(coalesce(text, ''), chr(10), chr(10) || chr(1)), '. ', '. ' || chr(1)), '! ', '! ' || chr(1)), '? ', '? ' || chr(1)), chr(1)), lambda x: x <> '') AS lines FROM documents
), u AS (SELECT r, doc_id, unnest(range(len(lines))) AS pos, trim(unnest(lines), ' ' || chr(10) || chr(13) || chr(9)) AS line FROM t WHERE doc_id IS NOT NULL
), solid AS (SELECT r, doc_id, pos, line, row_number() OVER w AS i, sum(len(line)) OVER w AS upto, sum(len(line)) OVER w - len(line) AS before FROM u WHERE line <> '' WINDOW w AS (PARTITION BY r ORDER BY pos)
), ahead AS (SELECT a.r, a.i AS i, b.i AS j FROM (SELECT *, before + 100 AS need FROM solid) a ASOF JOIN solid b ON a.r = b.r AND a.need <= b.upto
), back AS (SELECT b.r, a.i AS i, b.i AS j FROM (SELECT *, upto - 100 AS most FROM solid) b ASOF JOIN solid a ON a.r = b.r AND b.most >= a.before
), listed AS (SELECT r, any_value(doc_id) AS doc_id, list(line ORDER BY i) AS lines, list(pos ORDER BY i) AS ats FROM solid GROUP BY r
), runs AS (SELECT doc_id, ats[i] AS pos, ats[j] AS last, array_to_string(lines[i:j], chr(1)) AS key FROM (SELECT * FROM ahead UNION SELECT * FROM back) JOIN listed USING (r)
), first AS (SELECT key, min(struct_pack(doc_id := doc_id, pos := pos)) AS place FROM runs GROUP BY key
), gone AS (SELECT DISTINCT doc_id, unnest(range(pos, last + 1)) AS pos FROM runs JOIN first USING (key) WHERE struct_pack(doc_id := doc_id, pos := pos) <> place
), per AS (SELECT doc_id, list(pos) AS gone FROM gone GROUP BY doc_id
), out AS (SELECT t.*, per.gone AS gone, CASE WHEN per.gone IS NULL THEN text ELSE array_to_string([lines[k + 1] for k in range(len(lines)) if NOT list_contains(per.gone, k)], '') END AS left_ FROM t LEFT JOIN per USING (doc_id))
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, CAST(CASE WHEN gone IS NULL THEN 0 ELSE len(text) - len(left_) END AS BIGINT) AS removed_chars, left_ AS text FROM out
"""

_GOOD = "1 / (1 + exp(-(ln(prior / (1 - prior)) + list_sum([ln(tbl[j][{v}[j] + 2] / tbl[j][{v}[j] + 5]) for j in range(1, 7)]))))"
_SEEN = "coalesce(list_sum([pats[k].n * {g} for k in range(1, len(pats) + 1) if pats[k].v[j] = {v}]), 0)"
_CELLS = ", ".join(f"({_SEEN.format(g=g, v=v)} + 1) / ({total} + 3)" for g, total in (("gs[k]", "good"), ("(1 - gs[k])", "(total - good)")) for v in (-1, 0, 1))
_START = ", ".join(cell for bad in ("2e-2", "3e-1") for cell in (f"CAST({bad} AS DOUBLE)", f"(1 - {bad}) * none_[j] / (up[j] + none_[j])", f"(1 - {bad}) * up[j] / (up[j] + none_[j])"))
_SHARE = "[greatest(1e-6, coalesce(list_sum([x.n for x in pats if x.v[j] = {v}]), 0) / total) for j in range(1, 7)]"
_OP10 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (SELECT r, doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d
), windows AS (SELECT r, i, array_to_string(w[i:i + 2], chr(1)) AS said FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), again AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, said) AS c FROM windows) WHERE c > 1) GROUP BY r
), c AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum([len(x) for x in w]), 0) AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words FROM w LEFT JOIN again USING (r)
), s AS (SELECT *, word_chars / greatest(n_words, 1) AS mean, n_symbols / greatest(n_words, 1) AS symbols, n_symbols / greatest(word_chars, 1) AS dense, n_repeat_words / greatest(n_words, 1) AS repeats FROM c
), v AS (SELECT *, [CASE WHEN n_words < 50 THEN -1 ELSE 0 END, CASE WHEN mean < 2 OR mean > 12 THEN -1 WHEN mean BETWEEN 3 AND 9 THEN 1 ELSE 0 END, CASE WHEN symbols > 1e-1 THEN -1 WHEN symbols <= 2e-2 THEN 1 ELSE 0 END,
  CASE WHEN dense > 2e-2 THEN -1 WHEN dense <= 5e-3 THEN 1 ELSE 0 END, CASE WHEN n_dup_lines >= 5 THEN -1 WHEN n_dup_lines = 0 THEN 1 ELSE 0 END, CASE WHEN repeats > 3e-1 THEN -1 WHEN repeats <= 1e-1 THEN 1 ELSE 0 END] AS v FROM s
), p AS (SELECT list(struct_pack(v := v, n := n) ORDER BY v) AS pats, sum(n) AS total FROM (SELECT v, count(*) AS n FROM v GROUP BY v)
), first AS (SELECT pats, total, {_SHARE.format(v=1)} AS up, {_SHARE.format(v=0)} AS none_ FROM p
), em(step, prior, tbl) AS (
  SELECT 0, CAST(8e-1 AS DOUBLE), [[{_START}] for j in range(1, 7)] FROM first
  UNION ALL SELECT step + 1, least(999e-3, greatest(1e-3, good / total)), [[{_CELLS}] for j in range(1, 7)]
  FROM (SELECT step, pats, total, gs, list_sum([pats[k].n * gs[k] for k in range(1, len(pats) + 1)]) AS good FROM (SELECT step, pats, total, [{_GOOD.format(v='x.v')} for x in pats] AS gs FROM em, p WHERE step < 100))
), judged AS (SELECT v.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {_GOOD.format(v='v')} AS good FROM v, (SELECT prior, tbl FROM em WHERE step = 100))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND good >= 5e-1 AS kept, round(good, 6) AS posterior FROM judged
"""

_OP11 = """
WITH priced AS (
  SELECT click_id, ts, kind, CASE WHEN abs(value) < 1e16 THEN CAST(floor(100 * value + 0.5) AS BIGINT) END AS c
  FROM clicks WHERE click_id IS NOT NULL AND ts IS NOT NULL
), once AS (
  SELECT click_id, ts, kind, c
  FROM (SELECT *, row_number() OVER (PARTITION BY click_id ORDER BY ts, kind NULLS FIRST, c NULLS FIRST) AS k FROM priced) WHERE k = 1
), held AS (
  SELECT click_id, kind, c, list_sort(coalesce(list(c) FILTER (c IS NOT NULL) OVER (PARTITION BY kind ORDER BY ts RANGE BETWEEN INTERVAL 3599999999 MICROSECONDS PRECEDING AND CURRENT ROW), [])) AS s
  FROM once
), middle AS (
  SELECT *, len(s) AS n, CASE WHEN len(s) > 1 THEN s[(len(s) + 1) // 2] + s[len(s) // 2 + 1] END AS median2 FROM held
), spread AS (
  SELECT *, list_sort(list_transform(s, lambda x: abs(2 * x - median2))) AS d FROM middle
), mads AS (
  SELECT *, CASE WHEN n > 1 THEN d[(n + 1) // 2] + d[n // 2 + 1] END AS mad4 FROM spread
)
SELECT click_id, kind, CAST(n AS BIGINT) AS n, median2, mad4, 2 * abs(2 * c - median2) > 3 * mad4 AS far FROM mads
"""

_OP12 = """
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(x) >= 262144)) = 0
), parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS a FROM (SELECT *, unnest(range(16)) AS p FROM kept)
), firsts AS (
  SELECT e, r FROM (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM (SELECT r, vec_id, v, row_number() OVER (PARTITION BY vec_id ORDER BY v) AS k FROM kept) WHERE k = 1) WHERE e < 64
), book0 AS MATERIALIZED (SELECT p, e, a AS c FROM firsts JOIN parts USING (r)
), near0 AS MATERIALIZED (SELECT r, p, any_value(a) AS a, min(struct_pack(d := list_sum(list_transform(list_zip(a, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := e)) AS best FROM parts JOIN book0 USING (p) GROUP BY r, p
), sums0 AS (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c
  FROM (SELECT p, best.e AS e, j, sum(a[j]) AS s, count(*) AS n FROM (SELECT *, unnest(range(1, len(a) + 1)) AS j FROM near0) GROUP BY ALL) GROUP BY p, e
), book1 AS MATERIALIZED (SELECT p, e, coalesce(s.c, b.c) AS c FROM book0 b LEFT JOIN sums0 s USING (p, e)
), near1 AS MATERIALIZED (SELECT r, p, any_value(a) AS a, min(struct_pack(d := list_sum(list_transform(list_zip(a, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := e)) AS best FROM parts JOIN book1 USING (p) GROUP BY r, p
), sums1 AS (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c
  FROM (SELECT p, best.e AS e, j, sum(a[j]) AS s, count(*) AS n FROM (SELECT *, unnest(range(1, len(a) + 1)) AS j FROM near1) GROUP BY ALL) GROUP BY p, e
), book2 AS MATERIALIZED (SELECT p, e, coalesce(s.c, b.c) AS c FROM book1 b LEFT JOIN sums1 s USING (p, e)
), near2 AS (SELECT r, p, min(struct_pack(d := list_sum(list_transform(list_zip(a, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := e)) AS best FROM parts JOIN book2 USING (p) GROUP BY r, p
), coded AS (
  SELECT vec_id, label, code, error FROM kept JOIN (SELECT r, string_agg(printf('%02x', CAST(best.e AS BIGINT)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM near2 GROUP BY r) USING (r)
), said AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, said
"""

_OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS said FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d WHERE doc_id IS NOT NULL AND len(w) > 12)
), firsts AS (SELECT said, min(doc_id) AS first FROM places GROUP BY said
), gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS pos FROM places JOIN firsts USING (said) WHERE doc_id > first
), kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY pos) AS said, count(*) AS n FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS pos FROM d) ANTI JOIN gone USING (r, pos) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(said, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""

ORACLES: dict[str, str] = {"op5_decontamination": _OP5, "op6_line_dedup": _OP6, "op7_pii": _spans(_PII, 4), "op8_ngram_join": _OP8, "op9_secrets": _spans(_SECRETS, 3), "op10_quality": _OP10, "op11_rolling_median": _OP11, "op12_vector_codes": _OP12, "op13_substring_dedup": _OP13}
