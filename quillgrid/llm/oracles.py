"""Longer questions in SQL, for the operators that SQL can express."""

from __future__ import annotations

from quillgrid.llm import quality

# The checksum bit by bit, then the cheapest edits turn by turn: for each state the least
# cost and, of equal costs, the least text.
REPAIR_SQL = r"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS place FROM conversations),
    d AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(place, lambda x: ord(x)::UBIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::UBIGINT[]), lambda p, q: xor(p >> 1, (p & 1) * 3988292384::UBIGINT))),
      4294967295::UBIGINT) % 20 AS damage FROM k),
    t AS (SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
      CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM d, unnest(range(CASE damage WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS u(copy)),
    s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), md5(text)) AS seq,
      rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core FROM t),
    r AS (SELECT *, left(role, 1) AS letter, CASE WHEN core = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY seq) > 1 THEN 'duplicate'
      WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
      lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY seq) AS before FROM s),
    told AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
      count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
      count(*) FILTER (fault = 'truncated') AS truncated,
      count(*) FILTER (before IS NOT NULL AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
    dp(conv_id, i, state, best) AS (
      SELECT DISTINCT conv_id, 0::BIGINT, 0, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} FROM conversations
      UNION ALL
      SELECT conv_id, i, state, arg_min(best, {'cost': best.cost, 'audit': best.audit}) FROM (
        SELECT conv_id, i + 1 AS i, CASE e WHEN 'D' THEN q WHEN 'R' THEN CASE q WHEN 2 THEN 3 ELSE 2 END
            ELSE CASE letter WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END AS state,
          {'cost': cost + CASE e WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN e <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END,
           'audit': audit || e, 'lines': CASE e WHEN 'D' THEN lines
             ELSE list_append(lines, CASE e WHEN 'K' THEN role WHEN 'R' THEN CASE q WHEN 2 THEN 'assistant' ELSE 'user' END END || ':' || text) END} AS best
        FROM (SELECT dp.conv_id, i, r.role, r.text, r.letter, r.fault, p,
            CASE WHEN p = 0 THEN state WHEN state = 2 THEN 3 ELSE 2 END AS q, best.cost + 5 * p AS cost,
            best.audit || repeat('I', p) AS audit,
            CASE WHEN p = 0 THEN best.lines ELSE list_append(best.lines, CASE state WHEN 2 THEN 'assistant:' ELSE 'user:' END) END AS lines
          FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.seq = i + 1, (VALUES (0), (1)) AS ins(p)), (VALUES ('D'), ('K'), ('R')) AS edits(e)
        WHERE e = 'D' OR fault NOT IN ('blank', 'duplicate') AND (e = 'R' OR q = 0 AND letter IN ('s', 'u') OR q IN (1, 3) AND letter = 'u' OR q = 2 AND letter = 'a')
      ) GROUP BY conv_id, i, state),
    ends AS (SELECT dp.conv_id, {'cost': best.cost + CASE state WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END,
        'audit': best.audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END} AS told,
        list_concat(best.lines, CASE state WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE [] END) AS lines
      FROM dp LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM dp.conv_id WHERE i = coalesce(n, 0)),
    chosen AS (SELECT conv_id, min(told) AS told, arg_min(lines, told) AS lines FROM ends GROUP BY conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, c.told.cost::BIGINT AS cost, c.told.audit AS audit,
      sha256(array_to_string(lines, chr(10))) AS repaired_sha256
    FROM chosen c LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id"""


def quality_sql() -> str:
    """The counts by lists, the repeated words by their windows, and the cutoffs from a
    histogram of labelled texts, with binomial tails added up term by term."""
    rules = ", ".join(f"({i}, '{r}', {low!r})" for i, (r, (_, _, low)) in enumerate(quality.RULES.items()))
    rates = " ".join(f"WHEN '{r}' THEN {a} / greatest({b}, 1)" for r, (a, b, _) in quality.RULES.items())
    return rf"""WITH d AS (SELECT row_number() OVER () AS line, doc_id, lang, coalesce(text, '') AS text FROM documents),
    w AS (SELECT line, doc_id, lang, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
    win AS (SELECT line, i, count(*) OVER (PARTITION BY line, z) AS times FROM (
      SELECT line, unnest(range(len(words))) AS i, unnest(list_zip(words, words[2:], words[3:])) AS z FROM w) WHERE z[3] IS NOT NULL),
    rep AS (SELECT line, count(DISTINCT i + j) AS n FROM win, (VALUES (0), (1), (2)) AS v(j) WHERE times > 1 GROUP BY line),
    m AS (SELECT line, doc_id, lang, md5(text) AS text_id, len(words) AS n_words,
      coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
      len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
      coalesce(rep.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(regexp_extract_all(text, '[A-Z]')) AS n_capitals,
      length(text) - length(replace(text, '!', '')) AS n_calls FROM w LEFT JOIN rep USING (line)),
    b AS (SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed FROM m),
    rules(no, rule, low) AS (VALUES {rules}),
    x AS (SELECT DISTINCT b.* EXCLUDE (line, doc_id, base_failed), max(quality = 1) OVER (PARTITION BY lang, text_id) AS good
      FROM b JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND NOT base_failed),
    rated AS (SELECT lang, good, substr(text_id, 1, 1) >= '8' AS held, rule, low, (CASE rule {rates} END)::DOUBLE AS rate FROM x, rules),
    h AS (SELECT lang, rule, held, good, len(list_filter(range({quality.STEPS}), lambda i: low * pow(1.2, i) < rate)) AS step FROM rated),
    steps AS (SELECT lang, rule, s, count(*) FILTER (NOT held AND good) AS pg, count(*) FILTER (NOT held AND NOT good) AS pb,
      count(*) FILTER (NOT held AND good AND step > s) AS ag, count(*) FILTER (NOT held AND NOT good AND step > s) AS ab,
      count(*) FILTER (held AND good) AS n, count(*) FILTER (held AND good AND step > s) AS k
      FROM h, unnest(range({quality.STEPS})) AS u(s) GROUP BY lang, rule, s),
    gains AS (SELECT *, ab / pb - {quality.WEIGHT} * ag / pg AS gain FROM steps WHERE pg > 0 AND pb > 0),
    goals AS (SELECT lang, rule, max(s) AS goal FROM gains g WHERE gain >= {quality.LEAST_GAIN} AND gain = (SELECT max(gain) FROM gains o
      WHERE o.lang IS NOT DISTINCT FROM g.lang AND o.rule = g.rule) GROUP BY lang, rule),
    shared AS (SELECT *, {quality.RISK} / count(*) OVER (PARTITION BY lang) AS p, {quality.DOUBT} / count(*) OVER () AS doubt FROM goals),
    tested AS (SELECT s.lang, s.rule, goal, s, CASE WHEN k >= n THEN 1 ELSE list_sum(list_transform(range(k + 1), lambda j:
        exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(p) + (n - j) * ln(1 - p)))) END > doubt AS failed
      FROM steps s JOIN shared g ON s.lang IS NOT DISTINCT FROM g.lang AND s.rule = g.rule AND s >= goal),
    cut AS (SELECT t.lang, t.rule, no, low * pow(1.2, greatest(max(goal), coalesce(max(s) FILTER (failed), -1) + 1)) AS cutoff
      FROM tested t JOIN rules USING (rule) GROUP BY t.lang, t.rule, no, low HAVING coalesce(max(s) FILTER (failed), -1) < {quality.STEPS - 1}),
    hit AS (SELECT line, string_agg(rule, ',' ORDER BY no) AS rejected_by FROM b JOIN cut ON b.lang IS NOT DISTINCT FROM cut.lang
      WHERE (CASE rule {rates} END)::DOUBLE > cutoff GROUP BY line)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND rejected_by IS NULL AS kept, coalesce(rejected_by, '') AS rejected_by FROM b LEFT JOIN hit USING (line)"""
