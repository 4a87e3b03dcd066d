"""Independent DuckDB formulations of the named queries (the correctness
oracle). They spell each stage the plain SQL way — tokens unnested and
grouped, centroid sums as sums of document weights, dense rankings over all
(document, topic) pairs — so they share no shortcut with the Spark plans.

Views ``documents`` and ``labels`` are expected to exist.
"""

from __future__ import annotations

# Fixed values, spelt here on their own: the analyser's stop words.
_STOPS = ("a an and are as at be but by for if in into is it no not of on or such that the their then there "
          "these they this to was will with").split()
# Words by the word-break standard, spelt by scripts. Marks and format characters
# go with the character before them. Ideographs and Hiragana are set apart by
# blanks before. Hebrew quotes become a letter or a joiner of their own before
# (private characters) and are put back in the tokens.
_X = r"[\p{M}\x{00AD}\x{0600}-\x{0605}\x{061C}\x{200C}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{FEFF}]*"
_HEBREW = r"\x{05D0}-\x{05EA}\x{05EF}-\x{05F2}\x{FB1D}\x{FB1F}-\x{FB28}\x{FB2A}-\x{FB4F}"
_LETTERS = (r"\p{Latin}\p{Greek}\p{Cyrillic}\p{Armenian}\p{Georgian}\p{Devanagari}\p{Hangul}\p{Han}\p{Hiragana}\x{0620}-\x{064A}\x{066E}\x{066F}\x{0671}-\x{06D3}\x{06D5}"
            r"\x{00B5}\x{05F3}\x{24B6}-\x{24E9}\x{E001}" + _HEBREW)
_KANA = r"\x{30A1}-\x{30FA}\x{30FC}-\x{30FF}\x{31F0}-\x{31FF}\x{FF66}-\x{FF9D}"
_THAI = r"\x{0E01}-\x{0E3A}\x{0E40}-\x{0E4E}"
_TIES = r"_\x{203F}\x{2040}\x{2054}\x{FE33}\x{FE34}\x{FE4D}-\x{FE4F}\x{FF3F}"
_LETTER_MID = r"[.':\x{00B7}\x{2018}\x{2019}\x{2027}\x{05F4}\x{E000}]"
_DIGIT_MID = r"[.,;'\x{2018}\x{2019}\x{066C}]"
_CORE = (rf"(?:(?:[{_LETTERS}]{_X}(?:{_LETTER_MID}{_X}[{_LETTERS}]{_X})*|\p{{Nd}}{_X}(?:{_DIGIT_MID}{_X}\p{{Nd}}{_X})*)+|(?:[{_KANA}]{_X})+)")
_TIE = rf"(?:[{_TIES}]{_X})"
_WORD = rf"(?:[{_THAI}]{_X})+|{_TIE}*{_CORE}(?:{_TIE}+{_CORE})*{_TIE}*"
_QUOTED = (rf"([{_HEBREW}]{_X})\"({_X}[{_HEBREW}])", "\\1\ue000\\2")
_BEFORE = ((rf"([\p{{Han}}\p{{Hiragana}}]{_X})", r" \1 "), _QUOTED, _QUOTED, (rf"([{_HEBREW}]{_X})'({_X})([^{_LETTERS}\p{{M}}]|$)", "\\1\ue001\\2\\3"))


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _tokens(body: str, profile: str) -> str:
    if profile == "ascii":
        return f"regexp_extract_all(lower({body}), '[a-z0-9]+', 0)"
    text = f"lower({body})"
    for pattern, new in _BEFORE:
        text = f"regexp_replace({text}, {_q(pattern)}, {_q(new)}, 'g')"
    found = f"regexp_extract_all({text}, {_q(_WORD)}, 0)"
    return f"list_transform({found}, lambda t: replace(replace(t, '\ue000', '\"'), '\ue001', {_q(chr(39))}))"


def _base(profile: str = "word", body: str = "d.text") -> str:
    stops = ", ".join(_q(w) for w in _STOPS)
    return f"""
corpus AS (
  SELECT d.doc_id, d.doc_id AS old_id,
         CASE WHEN ((d.doc_id % 10) + 10) % 10 < 7 THEN 'TRAIN'
              WHEN ((d.doc_id % 10) + 10) % 10 < 9 THEN 'TEST' ELSE 'NOT-USED' END AS split,
         '' AS title, {body} AS body,
         list_filter(['lang-' || d.lang,
                      CASE WHEN l.quality = 1 THEN 'quality-high' WHEN l.quality = 0 THEN 'quality-low' END,
                      CASE WHEN l.toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL) AS topics
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
),
kept AS (
  SELECT * FROM corpus WHERE split IN ('TRAIN', 'TEST') AND body <> ''
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY old_id DESC) = 1
),
tokens AS (
  SELECT doc_id, split, unnest({_tokens('body', profile)}) AS term FROM kept
),
tf AS (
  SELECT doc_id, split, term, count(*)::BIGINT AS tf FROM tokens
  WHERE term NOT IN ({stops})
  GROUP BY doc_id, split, term
),
ndocs AS (SELECT count(DISTINCT doc_id)::BIGINT AS n_docs FROM tf),
dfs AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
factors AS (SELECT term, df, (SELECT n_docs FROM ndocs) // df AS q FROM dfs),
vectors AS (SELECT t.doc_id, t.split, t.term, t.tf, t.tf * f.q AS w FROM tf t JOIN factors f USING (term)),
edges AS (
  SELECT DISTINCT doc_id, split, t AS topic FROM (
    SELECT doc_id, split, unnest(topics) AS t FROM kept
    WHERE split = 'TRAIN' OR (split = 'TEST' AND len(list_filter(topics, lambda x: x <> '')) > 0)
  ) WHERE t <> ''
),
vocab AS (SELECT topic, count(*)::BIGINT AS n_train FROM edges WHERE split = 'TRAIN' GROUP BY topic),
sums AS (
  SELECT e.topic, v.term, sum(v.w)::BIGINT AS sw
  FROM vectors v JOIN edges e ON e.doc_id = v.doc_id AND e.split = 'TRAIN'
  GROUP BY e.topic, v.term
),
tnorms AS (SELECT topic, sum(sw::HUGEINT * sw) AS n2 FROM sums GROUP BY topic),
test_docs AS (
  SELECT doc_id, topics FROM kept
  WHERE split = 'TEST' AND len(list_filter(topics, lambda x: x <> '')) > 0
),
test_vec AS (SELECT v.* FROM vectors v WHERE v.doc_id IN (SELECT doc_id FROM test_docs)),
dnorms AS (SELECT doc_id, sum(w::HUGEINT * w) AS n2 FROM test_vec GROUP BY doc_id),
dots AS (
  SELECT v.doc_id, s.topic, sum(v.w::HUGEINT * s.sw) AS dot
  FROM test_vec v JOIN sums s USING (term) GROUP BY v.doc_id, s.topic
),
sims AS (
  SELECT d.doc_id, d.topic, d.dot::DOUBLE AS dot,
         d.dot::DOUBLE / (sqrt(n.n2::DOUBLE) * sqrt(t.n2::DOUBLE)) AS sim
  FROM dots d JOIN dnorms n USING (doc_id) JOIN tnorms t USING (topic)
  WHERE n.n2 > 0 AND t.n2 > 0
),
best AS (
  SELECT doc_id, topic, sim FROM sims
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY sim DESC, topic ASC) = 1
),
deftopic AS (SELECT min(topic) AS topic FROM tnorms WHERE n2 > 0),
preds0 AS (
  SELECT t.doc_id,
         CASE WHEN b.topic IS NOT NULL THEN b.topic
              WHEN n.doc_id IS NOT NULL THEN (SELECT topic FROM deftopic) END AS topic,
         CASE WHEN b.topic IS NOT NULL THEN b.sim
              WHEN n.doc_id IS NOT NULL AND (SELECT topic FROM deftopic) IS NOT NULL THEN 0.0::DOUBLE END AS sim,
         b.topic IS NULL AS zero_overlap, t.topics
  FROM test_docs t LEFT JOIN best b USING (doc_id) LEFT JOIN dnorms n USING (doc_id)
),
preds AS (
  SELECT doc_id, topic, sim, zero_overlap, coalesce(list_contains(topics, topic), false) AS correct FROM preds0
),
pt AS (
  SELECT topic, count(*) AS retrieved, sum(CASE WHEN correct THEN 1 ELSE 0 END) AS hits
  FROM preds WHERE topic IS NOT NULL GROUP BY topic
),
rel AS (SELECT topic, count(*) AS relevant FROM edges WHERE split = 'TEST' GROUP BY topic),
ev0 AS (
  SELECT v.topic, coalesce(pt.retrieved, 0)::BIGINT AS retrieved, coalesce(rel.relevant, 0)::BIGINT AS relevant,
         coalesce(pt.hits, 0)::BIGINT AS hits
  FROM vocab v LEFT JOIN pt USING (topic) LEFT JOIN rel USING (topic)
),
ev1 AS (
  SELECT *,
    CASE WHEN retrieved > 0 THEN hits::DOUBLE / retrieved::DOUBLE END AS precision,
    CASE WHEN relevant > 0 THEN hits::DOUBLE / relevant::DOUBLE END AS recall,
    CASE WHEN retrieved > 0 THEN (retrieved - hits)::DOUBLE / retrieved::DOUBLE END AS literal_precision,
    CASE WHEN relevant > 0 THEN (retrieved - hits)::DOUBLE / relevant::DOUBLE END AS literal_recall
  FROM ev0
),
ev AS (
  SELECT *,
    CASE WHEN precision + recall <> 0 THEN 2.0::DOUBLE * ((precision * recall) / (precision + recall)) END AS f1,
    CASE WHEN literal_precision + literal_recall <> 0
         THEN 2.0::DOUBLE * ((literal_precision * literal_recall) / (literal_precision + literal_recall)) END
      AS literal_f1
  FROM ev1
)"""


def _with(select: str, profile: str = "word") -> str:
    return "WITH " + _base(profile).strip() + "\n" + select.strip()


def _report(full: bool, literal: bool) -> str:
    def number(x: str) -> str:
        text = f"printf('%.2f', {x})"
        return f"CASE WHEN {x} IS NULL THEN 'NaN' ELSE lpad({text}, greatest(length({text}), 5)::INTEGER, '0') END"

    p = "literal_" if literal else ""
    f1 = f"CASE WHEN {p}f1 IS NULL THEN 'NaN ' ELSE {number(p + 'f1')} END"
    some = "" if full else "WHERE retrieved > 0 AND relevant > 0"
    return f"""
, lines AS (
  SELECT 0 AS section, '' AS k, 'Recall' || chr(9) || 'Precision' || chr(9) || 'F-measure' || chr(9) || 'Topic' AS line
  UNION ALL SELECT 1, '', repeat('-', 43)
  UNION ALL SELECT 2, topic, {number(p + 'recall')} || chr(9) || {number(p + 'precision')} || chr(9) || chr(9) || {f1} || chr(9) || chr(9) || '> ' || topic FROM ev {some}
  UNION ALL SELECT 3, '', repeat('=', 43)
  UNION ALL SELECT 4, '', CASE WHEN count(*) = 0 THEN 'Overall accuracy: NaN%'
    ELSE printf('Overall accuracy: %.2f%%', 100.0::DOUBLE * sum(CASE WHEN correct THEN 1 ELSE 0 END)::DOUBLE / count(*)::DOUBLE) END FROM preds
)
SELECT row_number() OVER (ORDER BY section, k) AS line_no, line FROM lines"""


_ORACLE_SELECTS = {
    "split_counts": """
SELECT c.split, count(*)::BIGINT AS n_docs, sum(CASE WHEN c.body <> '' THEN 1 ELSE 0 END)::BIGINT AS n_nonempty,
       coalesce(max(k.n_kept), 0)::BIGINT AS n_kept
FROM corpus c LEFT JOIN (SELECT split, count(*) AS n_kept FROM kept GROUP BY split) k USING (split)
GROUP BY c.split""",
    "doc_topics": "SELECT doc_id, split, topic FROM edges",
    "topic_vocab": "SELECT topic, n_train FROM vocab",
    "dedup_last": """
SELECT doc_id, old_id, split, title, body FROM (
  SELECT floor(old_id / 3)::BIGINT AS doc_id, old_id, split, title, body FROM corpus
  WHERE split IN ('TRAIN', 'TEST') AND body <> ''
) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY old_id DESC) = 1""",
    "term_freq": "SELECT doc_id, split, term, tf FROM tf",
    "term_stats": "SELECT term, df FROM dfs",
    "corpus_size": "SELECT n_docs FROM ndocs",
    "doc_vectors": "SELECT doc_id, split, term, tf, w FROM vectors",
    "doc_vector_maps": """
SELECT doc_id, count(*)::BIGINT AS n_terms, string_agg(term || '=' || w::VARCHAR, ';' ORDER BY term) AS vector
FROM vectors GROUP BY doc_id""",
    "doc_norms": "SELECT doc_id, sum(w::HUGEINT * w)::DOUBLE AS n2 FROM vectors GROUP BY doc_id",
    "topic_norms": "SELECT topic, n2::DOUBLE AS n2 FROM tnorms",
    "centroids": """
SELECT s.topic, s.term, s.sw, v.n_train, s.sw::DOUBLE / v.n_train::DOUBLE AS w
FROM sums s JOIN vocab v USING (topic)""",
    "similarities": "SELECT doc_id, topic, dot, sim, cos(sim) AS cos_score FROM sims",
    "predictions": "SELECT doc_id, topic, sim, zero_overlap, correct FROM preds",
    "topic_ranking": """
SELECT doc_id, topic, sim, row_number() OVER (PARTITION BY doc_id ORDER BY sim DESC, topic ASC) AS rank FROM sims""",
    "topic_ranking_k": """
SELECT doc_id, topic, sim, rank FROM (
  SELECT doc_id, topic, sim, row_number() OVER (PARTITION BY doc_id ORDER BY sim DESC, topic ASC) AS rank FROM sims
) WHERE rank <= 3""",
    "predictions_pruned": """
, defined AS (SELECT topic, sqrt(n2::DOUBLE) AS root FROM tnorms WHERE n2 > 0),
tails AS (
  SELECT s.term, max(s.sw::DOUBLE / d.root) AS most FROM sums s JOIN defined d USING (topic)
  GROUP BY s.term HAVING count(*) > 0.5 * (SELECT count(*) FROM defined)
),
rests AS (SELECT doc_id, sum(coalesce(w * most, 0.0::DOUBLE)) AS rest FROM test_vec LEFT JOIN tails USING (term) GROUP BY doc_id),
firsts AS (
  SELECT v.doc_id, s.topic, sum(v.w::HUGEINT * s.sw)::DOUBLE / any_value(d.root) AS low
  FROM test_vec v JOIN sums s USING (term) JOIN defined d ON d.topic = s.topic
  WHERE v.term NOT IN (SELECT term FROM tails) GROUP BY v.doc_id, s.topic
),
bounds AS (
  SELECT r.doc_id, d.topic, coalesce(f.low, 0.0::DOUBLE) AS low, r.rest
  FROM rests r CROSS JOIN defined d LEFT JOIN firsts f ON f.doc_id = r.doc_id AND f.topic = d.topic
),
winners AS (
  SELECT doc_id, count(*)::BIGINT AS candidates FROM (SELECT *, max(low) OVER (PARTITION BY doc_id) AS best FROM bounds)
  WHERE (low + rest) * (1 + 1e-9::DOUBLE) >= best GROUP BY doc_id
)
SELECT p.doc_id, p.topic, p.sim, p.zero_overlap, p.correct, w.candidates FROM preds p LEFT JOIN winners w USING (doc_id)""",
    "true_topic_margin": """
, scored AS (SELECT doc_id, topic AS predicted, sim AS predicted_sim FROM preds WHERE sim IS NOT NULL),
defined AS (SELECT topic FROM tnorms WHERE n2 > 0),
dense AS (
  SELECT s.doc_id, d.topic, coalesce(x.sim, 0.0::DOUBLE) AS sim
  FROM scored s CROSS JOIN defined d LEFT JOIN sims x ON x.doc_id = s.doc_id AND x.topic = d.topic
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sim DESC, topic ASC) AS rank FROM dense),
truth AS (
  SELECT r.* FROM ranked r JOIN edges e ON e.doc_id = r.doc_id AND e.topic = r.topic AND e.split = 'TEST'
),
btrue AS (
  SELECT doc_id, topic AS best_true_topic, sim AS best_true_sim, rank AS best_true_rank FROM truth
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY rank) = 1
)
SELECT s.doc_id, s.predicted, s.predicted_sim, b.best_true_topic, b.best_true_sim, b.best_true_rank,
       s.predicted_sim - b.best_true_sim AS margin
FROM scored s LEFT JOIN btrue b USING (doc_id)""",
    "hits": "SELECT doc_id, topic, correct AS hit FROM preds",
    "accuracy": """
SELECT coalesce(sum(CASE WHEN correct THEN 1 ELSE 0 END), 0)::BIGINT AS correct,
       (count(*) - coalesce(sum(CASE WHEN correct THEN 1 ELSE 0 END), 0))::BIGINT AS incorrect,
       CASE WHEN count(*) > 0
            THEN 100.0::DOUBLE * sum(CASE WHEN correct THEN 1 ELSE 0 END)::DOUBLE / count(*)::DOUBLE END
         AS accuracy_pct
FROM preds""",
    "evaluation_brief": """
SELECT topic, retrieved, relevant, hits, precision, recall, f1 FROM ev WHERE retrieved > 0 AND relevant > 0""",
    "evaluation_full": "SELECT topic, retrieved, relevant, hits, precision, recall, f1 FROM ev",
    "evaluation_literal": """
SELECT topic, retrieved, relevant, hits, literal_precision, literal_recall, literal_f1
FROM ev WHERE retrieved > 0 AND relevant > 0""",
    "sgml_ingest_roundtrip": """
SELECT doc_id, old_id, split, title, body, array_to_string(topics, '|') AS topics FROM kept""",
    "report_lines": _report(full=False, literal=True),
    "report_lines_full": _report(full=True, literal=False),
    "corpus_parquet_roundtrip": """
SELECT k.doc_id, k.old_id, k.split, k.title, k.body, array_to_string(k.topics, '|') AS topics, v.n_terms, v.n_tokens, v.weight
FROM kept k LEFT JOIN (SELECT doc_id, count(*)::BIGINT AS n_terms, sum(tf)::BIGINT AS n_tokens, sum(w)::BIGINT AS weight
                       FROM vectors GROUP BY doc_id) v USING (doc_id)""",
    "corpus_clustered_roundtrip": "SELECT doc_id, old_id, split, title, body, array_to_string(topics, '|') AS topics FROM corpus",
    "classify_unlabelled": f"""
, newdocs AS (SELECT doc_id, body FROM corpus WHERE split = 'NOT-USED'),
newtokens AS (SELECT doc_id, unnest({_tokens('body', 'word')}) AS term FROM newdocs),
newvec AS (SELECT doc_id, term, count(*)::BIGINT * f.q AS w FROM newtokens JOIN factors f USING (term) GROUP BY doc_id, term, f.q),
newnorms AS (SELECT doc_id, sum(w::HUGEINT * w) AS n2 FROM newvec GROUP BY doc_id),
newdots AS (SELECT v.doc_id, s.topic, sum(v.w::HUGEINT * s.sw) AS dot FROM newvec v JOIN sums s USING (term) GROUP BY v.doc_id, s.topic),
newsims AS (SELECT d.doc_id, d.topic, d.dot::DOUBLE / (sqrt(n.n2::DOUBLE) * sqrt(t.n2::DOUBLE)) AS sim
            FROM newdots d JOIN newnorms n USING (doc_id) JOIN tnorms t USING (topic) WHERE n.n2 > 0 AND t.n2 > 0),
newbest AS (SELECT doc_id, topic, sim FROM newsims QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY sim DESC, topic ASC) = 1)
SELECT d.doc_id, CASE WHEN b.topic IS NOT NULL THEN b.topic WHEN n.doc_id IS NOT NULL THEN (SELECT topic FROM deftopic) END AS topic,
       CASE WHEN b.topic IS NOT NULL THEN b.sim WHEN n.doc_id IS NOT NULL AND (SELECT topic FROM deftopic) IS NOT NULL THEN 0.0::DOUBLE END AS sim,
       b.topic IS NULL AS zero_overlap, NULL::BOOLEAN AS correct
FROM newdocs d LEFT JOIN newbest b USING (doc_id) LEFT JOIN newnorms n USING (doc_id)""",
    "sgml_rejects": """
, heads AS (
  SELECT *, ((doc_id % 10) + 10) % 10 AS kind, '<REUTERS TOPICS="YES" LEWISSPLIT="' || split || '" CGISPLIT="X" OLDID="' || old_id || '" NEWID="' ||
         CASE WHEN ((doc_id % 10) + 10) % 10 = 2 THEN 'x' ELSE '' END || doc_id || '">' AS head FROM corpus)
SELECT CASE WHEN kind = 5 THEN doc_id + 3000000000 ELSE doc_id END AS doc_id, old_id, split,
       'T ' || doc_id || CASE WHEN kind = 0 THEN chr(10) || 'second' ELSE '' END AS title,
       CASE WHEN kind = 6 THEN '<DATELINE>D</DATELINE>' || replace(body, chr(10), ' ') || '</TEXT>'
            WHEN kind = 3 THEN body || chr(10) || '<REUTERS note> more'
            WHEN kind = 8 THEN body || chr(10) || 'see ' || head || chr(10) || '<REUTERS<REUTERS' || chr(10) || 'end' ELSE body END AS body,
       array_to_string(topics, '|') AS topics, NULL::VARCHAR AS reason, NULL::VARCHAR AS first_line
FROM heads WHERE kind NOT IN (1, 2)
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN kind = 2 THEN 'bad_id' ELSE 'unclosed_record' END, head FROM heads WHERE kind IN (1, 2)""",
    "model_roundtrip": "SELECT doc_id, topic, sim, zero_overlap, correct FROM preds",
}


def _render(name: str, select: str) -> str:
    if select.lstrip().startswith(","):
        # the query adds CTEs of its own after the shared ones
        return "WITH " + _base().strip() + select.rstrip()
    return _with(select)


ORACLE_SQL: dict[str, str] = {name: _render(name, sel) for name, sel in _ORACLE_SELECTS.items()}
ORACLE_SQL["term_freq_ascii"] = _with("SELECT doc_id, split, term, tf FROM tf", profile="ascii")

# the same replacements, in the same order, as the query's docstring names
_EDGE_BODY = ("replace(replace(replace(d.text, ' the ', ' ____ _the_ \u00bd1\u00bd \u6f22\u5b57\u304b\u306a1,2 x\u6f22y the\u00ad\u200dre '), "
              "' de ', ' de_la l''a._b 3.x \u0301e d\u0301\u2060e \u05d0\"\u05d1'' \u05d0'' '), "
              "' der ', ' \u2168 der\u30ab\u30bf der_\u30ab\u30bf\u30fc \u0e01\u0e32 1\u00ad2.\u00ad3 ')")
ORACLE_SQL["term_freq_edge"] = "WITH " + _base(body=_EDGE_BODY).strip() + "\nSELECT doc_id, split, term, tf FROM tf"
