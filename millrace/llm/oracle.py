"""SQL for DuckDB that gives the rows of those queries that SQL can express."""

from __future__ import annotations

from .collocations import LEAST as LEAST_PHRASE
from .collocations import LONGEST, TOP, UNIT
from .embedding_dedup import LEAST
from .pii import KINDS, LEAD, NEAR, PRIOR, ROUNDS, RUNS, STRONG, TRAIL
from .pii import LONGEST as LONGEST_RUN
from .pii import UNIT as UNIT_SCORE
from .secret_scan import BASE_RULES, RULES

_ROOTS = """
  reach AS (SELECT a AS id, b AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
  roots AS (SELECT id, least(id, min(other)) AS root FROM reach GROUP BY id)"""

OP2 = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
    WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= {LEAST}),{_ROOTS}
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON c.a = vec_id LEFT JOIN roots ON roots.id = vec_id"""

OP8 = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
  s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
               ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
  n AS (SELECT doc_id, len(s) AS n FROM s),
  e AS (SELECT doc_id, unnest(s) AS x FROM s),
  links AS (SELECT p.a, p.b FROM (SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS c FROM e l JOIN e r ON l.x = r.x AND l.doc_id <> r.doc_id GROUP BY 1, 2) p
            JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * c >= 75 * (na.n + nb.n - c)),{_ROOTS}
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce(root, doc_id) AS component_id, coalesce(root, doc_id) = doc_id AS kept
FROM n LEFT JOIN roots ON roots.id = doc_id"""


def _op7() -> str:
    one = lambda k, r: f"""SELECT doc_id, '{r.kind}' AS kind, {k} AS nth, unnest(list_transform(string_split_regex(t, p), lambda x: length(x))) AS gap,
    unnest(list_concat(list_transform(regexp_extract_all(t, p, 0), lambda x: length(x)), [0])) AS size,
    unnest(list_concat(list_transform(regexp_extract_all(t, p, {r.group}), lambda x: length(x) >= {max(r.least, 1)}), [FALSE])) AS real,
    generate_subscripts(string_split_regex(t, p), 1) AS i FROM (SELECT doc_id, coalesce(text, '') AS t, '{r.pattern.replace("'", "''")}' AS p FROM documents)"""  # noqa: E731
    hits = "\nUNION ALL ".join(one(k, r) for k, r in enumerate(RULES))
    base = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
    span = "concat(kind, ':', CAST(stop - size AS VARCHAR), ':', CAST(stop AS VARCHAR))"
    order = "ORDER BY stop - size, nth"
    return f"""
WITH h AS ({hits}),
  s AS (SELECT *, CAST(sum(gap + size) OVER (PARTITION BY doc_id, nth ORDER BY i) AS BIGINT) AS stop FROM h),
  f AS (SELECT doc_id, {counts}, string_agg({span}, ',' {order}) FILTER (WHERE kind IN ({base})) AS base, string_agg({span}, ',' {order}) AS spans FROM s WHERE real GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in BASE_RULES)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN f ON f.doc_id = d.doc_id"""


OP12 = f"""
WITH p AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
  n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
  g AS (SELECT lang, k, gram, count(*) AS f FROM (
          SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS gram FROM p, range(1, {LONGEST} + 1) t(k) WHERE len(w) >= k) GROUP BY lang, k, gram),
  c AS (SELECT lang, k, gram, f AS a, string_split(gram, ' ') AS w FROM g WHERE k > 1 AND f >= {LEAST_PHRASE}),
  kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.lang = c.lang AND b.k > c.k AND 100 * b.a >= 100 * c.a AND contains(' ' || b.gram || ' ', ' ' || c.gram || ' '))),
  cuts AS (SELECT lang, gram, a, j, array_to_string(w[1:j], ' ') AS first, array_to_string(w[j + 1:], ' ') AS rest FROM kept, range(1, {LONGEST}) t(j) WHERE j < k),
  s AS (SELECT cuts.lang, cuts.gram, a, j, x.f AS l, y.f AS r, n, CAST((CAST({UNIT} AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
        FROM cuts JOIN n ON n.lang = cuts.lang JOIN g x ON x.lang = cuts.lang AND x.gram = first JOIN g y ON y.lang = cuts.lang AND y.gram = rest),
  best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, gram) AS rank, gram AS phrase, a, l, r, n, score FROM best QUALIFY rank <= {TOP}"""

#: The checksum byte by byte, from its polynomial.
OP13 = """
WITH bytes AS (SELECT list(v ORDER BY i) AS v FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v FROM range(256) t(i))),
  t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
  o AS (SELECT c, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, sha256(concat(strlen(role), ':', role, text))) AS l FROM t GROUP BY c),
  h AS (SELECT c, l, c - c % 5 AS base, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
          lambda a, b: xor(a >> 8, v[(xor(a, b) & 255) + 1]))) % 9 AS h FROM o, bytes),
  r AS (SELECT h.c, list_concat(coalesce(b.l[1:h.h], []), h.l[h.h + 1:]) AS l FROM h LEFT JOIN o b ON b.c = h.base),
  p AS (SELECT c, d, l[1:d] AS key, d = len(l) AS ends FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM r)),
  node AS (SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256,
             CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(key[d].text) END AS own FROM p GROUP BY key, d),
  up AS (SELECT n.*, m.conv_id AS parent_conv_id FROM node n LEFT JOIN node m ON m.d = n.d - 1 AND m.key = n.key[1:n.d - 1]),
  kids AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n FROM up WHERE d > 0 GROUP BY 1, 2),
  full_ AS (SELECT up.*, coalesce(kids.n, 0) AS n_children FROM up LEFT JOIN kids ON kids.conv_id = up.conv_id AND kids.d = up.d),
  sub AS (SELECT a.key, CAST(sum(f.own) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves FROM full_ f JOIN p a ON a.c = f.conv_id AND a.d <= f.d GROUP BY a.key)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM full_ JOIN sub ON sub.key = full_.key"""


def _op11() -> str:
    """The same definitions over plain patterns; rounds of scoring written out."""
    q = lambda p: "'" + p.replace("'", "''") + "'"
    plain = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    run = r"[^\x20\x09-\x0D0-9@]*[0-9@][^\x20\x09-\x0D]*(\x20[^\x20\x09-\x0D0-9@]*[0-9@][^\x20\x09-\x0D]*)*"
    ip = r"^(0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(\.|$)){4}$"
    word = r"[^\x20\x09-\x0D]+"
    digits = lambda m: f"regexp_replace({m}, '[^0-9]', '', 'g')"
    twice = lambda m: f"list_sum(list_transform(range(1, length({digits(m)}) + 1), lambda j: CASE WHEN j % 2 = 1 THEN 1 ELSE 2 END * CAST({digits(m)}[-j] AS INT) - CASE WHEN j % 2 = 0 AND CAST({digits(m)}[-j] AS INT) > 4 THEN 9 ELSE 0 END))"
    real = (
        lambda m: "TRUE",
        lambda m: f"regexp_matches({m}, {q(ip)})",
        lambda m: f"length({digits(m)}) BETWEEN 16 AND 19 AND {twice(m)} % 10 = 0",
        lambda m: f"length({digits(m)}) BETWEEN 8 AND 15",
    )
    names, hit = [k.name for k in KINDS], "blob, {k} AS k, unnest(string_split_regex(t, {p})) AS gap, unnest(list_concat(regexp_extract_all(t, {p}, 0), [''])) AS m, generate_subscripts(string_split_regex(t, {p}), 1) AS i"
    hits = "\n    UNION ALL ".join("SELECT " + hit.format(k=k, p=q(p)) + " FROM t" for k, p in enumerate([*plain, run]))
    valid = " ".join(f"WHEN {k} THEN {real[k]('m')}" for k in range(RUNS))
    known = " ".join(f"WHEN len(list_filter(regexp_extract_all(m, {q(p)}, 0), lambda x: {real[k]('x')})) > 0 THEN {k}" for k, p in enumerate(plain))
    looks = " + ".join(f"CASE WHEN regexp_matches(said, {q(k.look)}) AND length({digits('said')}) BETWEEN {k.digits[0]} AND {k.digits[1]} THEN {1 << n} ELSE 0 END" for n, k in enumerate(KINDS))
    context = lambda words: f"lower(regexp_replace(regexp_extract(right(gap, {NEAR}), {q(words + chr(92) + 's_end')}, 1), {q('[' + chr(92) + 'x20' + chr(92) + 'x09-' + chr(92) + 'x0D]+')}, ' ', 'g'))".replace(chr(92) + "s_end", r"[\x20\x09-\x0D]*\z")
    each = range(RUNS)
    rounds = f"p0 AS (SELECT context, n, {', '.join(f's{k} // (n + {PRIOR}) AS p{k}' for k in each)} FROM seeds)"
    for r in range(1, ROUNDS):
        best = ", ".join(f"max(CASE WHEN looks & {1 << k} > 0 THEN p{k} ELSE 0 END) AS p{k}" for k in each)
        rounds += f""",
  i{r} AS (SELECT said, {best} FROM open_ JOIN p{r - 1} USING (context) GROUP BY said),
  m{r} AS (SELECT context, {', '.join(f'sum(p{k}) AS m{k}' for k in each)} FROM open_ JOIN i{r} USING (said) GROUP BY context),
  p{r} AS (SELECT context, n, {', '.join(f'CAST((s{k} + coalesce(m{k}, 0)) // (n + {PRIOR}) AS BIGINT) AS p{k}' for k in each)} FROM seeds LEFT JOIN m{r} USING (context))"""
    sure = ", ".join(f"max(CASE WHEN looks & {1 << k} > 0 AND p{k} >= {STRONG} THEN p{k} END) AS p{k}" for k in each)
    pick = " ".join(f"WHEN p{k} = greatest(p0, p1, p2, p3) THEN {k}" for k in each)
    span, lists = "concat(name, ':', CAST(start AS VARCHAR), ':', CAST(stop AS VARCHAR))", "', '".join([*names, *[f"like_{n}" for n in names]])
    return f"""
WITH t AS (SELECT DISTINCT sha256(coalesce(text, '')) AS blob, coalesce(text, '') AS t FROM documents),
  h AS ({hits}),
  s AS (SELECT *, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY blob, k ORDER BY i) AS BIGINT) AS stop FROM h),
  base AS (SELECT blob, k, stop - length(m) AS start, stop FROM s WHERE k < {RUNS} AND m <> '' AND CASE k {valid} END),
  r1 AS (SELECT blob, stop - length(m) + length(regexp_extract(m, {q(LEAD)}, 0)) AS start, m, gap, lower(regexp_replace(regexp_replace(m, {q(LEAD)}, ''), {q(TRAIL)}, '')) AS said,
           length(regexp_replace(regexp_replace(m, {q(LEAD)}, ''), {q(TRAIL)}, '')) AS wide FROM s WHERE k = {RUNS} AND m <> ''),
  r2 AS (SELECT blob, start, start + wide AS stop, CASE WHEN length(m) <= {LONGEST_RUN} THEN said ELSE sha256(m) END AS said, length(m) <= {LONGEST_RUN} AS short, said AS bare, CASE {known} END AS base, {context(f'({word})')} AS one,
           {context(rf'({word}[{chr(92)}x20{chr(92)}x09-{chr(92)}x0D]+{word})')} AS two FROM r1 WHERE said <> ''),
  r3 AS (SELECT blob, start, stop, said, base, CASE WHEN short AND base IS NULL THEN {looks} ELSE 0 END AS looks, one, two FROM r2),
  runs AS (SELECT DISTINCT blob, start, stop, said, base, looks, unnest([one, two]) AS context FROM r3),
  named AS (SELECT * FROM runs WHERE regexp_matches(context, '\\p{{L}}[^\\x20]*\\z')),
  graph AS (SELECT DISTINCT context, said, base, looks FROM named),
  open_ AS (SELECT context, said, looks FROM graph WHERE looks > 0),
  seeds AS (SELECT context, count(*) AS n, {', '.join(f'{UNIT_SCORE} * count(*) FILTER (WHERE base = {k}) AS s{k}' for k in each)} FROM graph GROUP BY context),
  {rounds},
  told AS (SELECT blob, start, stop, {sure} FROM named JOIN p{ROUNDS - 1} USING (context) WHERE looks > 0 GROUP BY blob, start, stop),
  f AS (SELECT blob, k, start, stop FROM base UNION ALL SELECT blob, {RUNS} + CASE {pick} END, start, stop FROM told WHERE greatest(p0, p1, p2, p3) IS NOT NULL),
  d AS (SELECT blob, {', '.join(f'count(*) FILTER (WHERE k = {k}) AS n_{n}' for k, n in enumerate(names))}, string_agg({span}, ',' ORDER BY k, start) FILTER (WHERE k < {RUNS}) AS base, string_agg({span}, ',' ORDER BY k, start) AS spans
        FROM (SELECT *, ['{lists}'][k + 1] AS name FROM f) GROUP BY blob)
SELECT doc_id, {', '.join(f'coalesce(n_{n}, 0) AS n_{n}' for n in names)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN d ON d.blob = sha256(coalesce(text, ''))"""


def oracle_sql() -> dict[str, str]:
    return {"op2_embedding_dedup": OP2, "op7_secret_scan": _op7(), "op8_minhash_dedup": OP8, "op11_pii": _op11(), "op12_collocations": OP12, "op13_prefix_trie": OP13}
