"""SQL forms of the derived inputs and of the text pipeline."""

from __future__ import annotations

from feedback_lens.catalog.fixtures import HYPOTHESES, STOPWORDS, SYNONYMS
from feedback_lens.catalog.registry import view
from feedback_lens.functions.tokens import accent_table

ACCENTED, BARE = accent_table()
SEG = "review_type, year_quarter, brand"


def topic_tokens(col: str) -> str:
    text = f"translate(regexp_replace(lower({col}), '\\p{{Mn}}', '', 'g'), '{ACCENTED}', '{BARE}')"
    runs = f"regexp_extract_all({text}, '[\\p{{L}}\\p{{Nl}}\\p{{No}}_]+')"
    return f"list_filter({runs}, lambda x: length(x) BETWEEN 2 AND 15 AND NOT starts_with(x, '_'))"


def similarity_tokens(col: str) -> str:
    words = f"string_split(trim(regexp_replace(lower({col}), '\\s+', ' ', 'g')), ' ')"
    return f"list_filter({words}, lambda x: x <> '' AND NOT regexp_full_match(x, '[0-9]+'))"


def pieces(tokens: str) -> str:
    text = f"regexp_replace(array_to_string({tokens}, ' '), '([a-z])n[''’]t', '\\1 not', 'g')"
    return f"regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_\\s]')"


def phrases(kind: str) -> str:
    """Phrases of one pattern out of ``words`` and ``tags``."""
    pattern = {"noun": "D?A*N+", "verb": "V?[RD]*V+", "prep": "D?N(?:P?N)*"}[kind]
    marked = f"regexp_extract_all(regexp_replace(tags, '({pattern})', '<\\1>', 'g'), '<?[A-Z]>?')"
    bordered = (
        f"list_transform(list_zip(words, {marked}), lambda z: "
        "(CASE WHEN starts_with(z[2], '<') THEN chr(1) ELSE '' END) || z[1] || "
        "(CASE WHEN ends_with(z[2], '>') THEN chr(2) ELSE '' END))"
    )
    return f"regexp_extract_all(array_to_string({bordered}, ' '), chr(1) || '([^' || chr(2) || ']*)' || chr(2), 1)"


def values(rows: tuple) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in (r if isinstance(r, tuple) else (r,))) + ")" for r in rows)


def guessed_tag(w: str) -> str:
    return (
        f"CASE WHEN NOT regexp_matches({w}, '^[\\p{{L}}\\p{{N}}_]') THEN 'X' WHEN {w} LIKE '%ly' THEN 'R' "
        f"WHEN {w} LIKE '%ing' OR {w} LIKE '%ed' THEN 'V' "
        f"WHEN regexp_matches({w}, '(able|ible|ful|ous|ive|est)$') THEN 'A' ELSE 'N' END"
    )


view(
    "reviews",
    """SELECT doc_id AS review_id, 'Product ' || CAST(doc_id % 9 AS VARCHAR) AS name,
       CAST(1 + (doc_id // 3) % 5 AS DOUBLE) AS rating, text AS comment,
       DATE '2015-11-01' + CAST((doc_id * 37) % 365 AS INT) AS date,
       'brand' || CAST(doc_id % 3 AS VARCHAR) AS brand, CAST(doc_id % 4 AS INT) AS usefulness,
       'shop' || CAST((doc_id // 7) % 3 AS VARCHAR) AS source FROM documents""",
)
view(
    "reviews_q",
    """SELECT *, CAST(year(date) AS VARCHAR) || 'Q' || CAST(quarter(date) AS VARCHAR) AS year_quarter,
       CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative' END AS review_type FROM reviews""",
    "reviews",
)
view(
    "companies",
    """SELECT DISTINCT 'brand' || CAST(doc_id % 3 AS VARCHAR) AS brand,
       'Company ' || CAST(doc_id % 3 AS VARCHAR) AS company FROM documents WHERE doc_id % 3 < 2""",
)
view("token_docs", f"SELECT review_id, {topic_tokens('comment')} AS ws FROM reviews", "reviews")
view(
    "tokens",
    "SELECT review_id, CAST(generate_subscripts(ws, 1) - 1 AS INT) AS pos, unnest(ws) AS w FROM token_docs",
    "token_docs",
)
view(
    "lexicon",
    """SELECT w, pos, CASE WHEN w IN ('is','was','are','were') THEN 'be' WHEN w IN ('he','she','they') THEN '-PRON-'
       WHEN pos = 'V' AND w LIKE '%ing' AND length(w) > 5 THEN substr(w, 1, length(w) - 3)
       WHEN pos = 'V' AND w LIKE '%ed' AND length(w) > 4 THEN substr(w, 1, length(w) - 2) ELSE w END AS lemma
       FROM (SELECT DISTINCT w, CASE WHEN w IN ('the','a','an','this','that') THEN 'D'
          WHEN w IN ('of','in','on','for','with','by','at','from','to') THEN 'P'
          WHEN w IN ('is','was','be','are','were','have','had','do') THEN 'V'
          WHEN w IN ('not','never') THEN 'R' WHEN w IN ('and','or','but','as') THEN 'X'
          WHEN w LIKE '%ing' OR w LIKE '%ed' THEN 'V' WHEN w LIKE '%ly' THEN 'R'
          WHEN w LIKE '%ble' OR w LIKE '%est' THEN 'A' ELSE 'N' END AS pos FROM tokens)""",
    "tokens",
)
view("stopwords", f"SELECT w FROM (VALUES {values(STOPWORDS)}) AS t(w)")
view("synonyms", f"SELECT word, synonym FROM (VALUES {values(SYNONYMS)}) AS t(word, synonym)")
view("word_counts", "SELECT w, count(*) AS n FROM tokens GROUP BY w", "tokens")
view(
    "word_vectors",
    """SELECT v.w AS word, e.embedding AS vec FROM (SELECT w, (n * 31 + ascii(w) * 7 + ascii(substr(w, 2, 1)) * 13
       + length(w) * 3) % (SELECT count(*) FROM embeddings) AS vec_id FROM word_counts WHERE n >= 2) v
       JOIN embeddings e ON e.vec_id = v.vec_id""",
    "word_counts",
)
view(
    "ngram_vectors",
    """SELECT g.ngram, e.embedding AS vec FROM (SELECT DISTINCT unnest(list_transform(range(1, length(w) + 1),
       lambda i: substr('<' || w || '>', i, 3))) AS ngram FROM word_counts WHERE n >= 2) g
       JOIN embeddings e ON e.vec_id = (ascii(substr(ngram, 1, 1)) * 5 + ascii(substr(ngram, 2, 1)) * 11
       + ascii(substr(ngram, 3, 1)) * 17) % (SELECT count(*) FROM embeddings)""",
    "word_counts",
)

# Topic path.
view(
    "seg_docs",
    f"""SELECT {SEG}, review_id, ws FROM reviews_q JOIN token_docs USING (review_id) WHERE review_type IS NOT NULL""",
    "reviews_q token_docs",
)
view(
    "seg_tokens",
    f"SELECT {SEG}, review_id, CAST(generate_subscripts(ws, 1) - 1 AS INT) AS pos, unnest(ws) AS w FROM seg_docs",
    "seg_docs",
)
view("seg_uni", f"SELECT {SEG}, w, count(*) AS n FROM seg_tokens GROUP BY ALL", "seg_tokens")
view(
    "seg_pairs",
    f"""SELECT {SEG}, review_id, pos, w AS a, lead(w) OVER (PARTITION BY review_id ORDER BY pos) AS b
       FROM seg_tokens""",
    "seg_tokens",
)
view("seg_bi", f"SELECT {SEG}, a, b, count(*) AS n_ab FROM seg_pairs WHERE b IS NOT NULL GROUP BY ALL", "seg_pairs")
view(
    "seg_bigrams",
    f"""SELECT p.*, (p.n_ab - 3) / (x.n * y.n) * (u.v + c.v) AS score FROM seg_bi p
       JOIN seg_uni x ON (x.review_type, x.year_quarter, x.brand, x.w) = (p.review_type, p.year_quarter, p.brand, p.a)
       JOIN seg_uni y ON (y.review_type, y.year_quarter, y.brand, y.w) = (p.review_type, p.year_quarter, p.brand, p.b)
       JOIN (SELECT {SEG}, count(*) AS v FROM seg_uni GROUP BY ALL) u
         ON (u.review_type, u.year_quarter, u.brand) = (p.review_type, p.year_quarter, p.brand)
       JOIN (SELECT {SEG}, count(*) AS v FROM seg_bi GROUP BY ALL) c
         ON (c.review_type, c.year_quarter, c.brand) = (p.review_type, p.year_quarter, p.brand)
       WHERE (p.n_ab - 3) / (x.n * y.n) * (u.v + c.v) > 10""",
    "seg_bi seg_uni",
)
view(
    "seg_starts",
    f"""SELECT review_id, pos FROM (SELECT review_id, pos, row_number() OVER (PARTITION BY review_id, run ORDER BY pos) AS nth
       FROM (SELECT p.review_id, p.pos, p.pos - row_number() OVER (PARTITION BY p.review_id ORDER BY p.pos) AS run
             FROM seg_pairs p SEMI JOIN seg_bigrams g USING ({SEG}, a, b))) WHERE nth % 2 = 1""",
    "seg_pairs seg_bigrams",
)
view(
    "seg_merged",
    f"""SELECT t.review_type, t.year_quarter, t.brand, t.review_id, t.pos,
       CASE WHEN s.pos IS NOT NULL THEN t.a || '_' || t.b ELSE t.a END AS w
       FROM seg_pairs t LEFT JOIN seg_starts s ON s.review_id = t.review_id AND s.pos = t.pos
       ANTI JOIN seg_starts e ON e.review_id = t.review_id AND e.pos = t.pos - 1""",
    "seg_pairs seg_starts",
)
view(
    "seg_prepared",
    f"""SELECT {SEG}, review_id, pos, lemma FROM (SELECT m.*, coalesce(l.lemma, m.w) AS lemma,
         coalesce(l.pos, {guessed_tag('m.w')}) AS tag
         FROM seg_merged m LEFT JOIN lexicon l ON l.w = m.w)
       WHERE lemma <> '-PRON-' AND tag IN ('N','A','V','R') AND lemma NOT IN (SELECT w FROM stopwords)
       AND NOT regexp_full_match(lemma, '[0-9]+')""",
    "seg_merged lexicon stopwords",
)
view(
    "topic_term",
    f"""SELECT {SEG}, CAST((review_id // 15) % 3 + 1 AS INT) AS topic, w AS term, CAST(count(*) AS DOUBLE) AS weight
       FROM seg_tokens GROUP BY ALL""",
    "seg_tokens",
)
view(
    "doc_topics",
    f"""SELECT {SEG}, review_id, CAST(t AS INT) AS topic, (1 + (review_id * t) % 5)
       / (3 + review_id % 5 + (review_id * 2) % 5 + (review_id * 3) % 5) AS p
       FROM reviews_q, (VALUES (1), (2), (3)) AS k(t) WHERE review_type IS NOT NULL""",
    "reviews_q",
)
view(
    "keywords",
    f"""SELECT {SEG}, topic, CAST(rk AS INT) AS rank, term AS keyword, weight AS keyword_weight FROM (
       SELECT *, row_number() OVER (PARTITION BY {SEG}, topic ORDER BY weight DESC, term) AS rk FROM topic_term)
       WHERE rk <= 10""",
    "topic_term",
)
view(
    "seg_idf",
    f"""SELECT {SEG}, term, df, n_docs, ln((1 + n_docs) / (1 + df)) + 1 AS idf FROM (
         SELECT {SEG}, w AS term, count(DISTINCT review_id) AS df FROM seg_tokens GROUP BY ALL)
       JOIN (SELECT {SEG}, count(*) AS n_docs FROM reviews_q WHERE review_type IS NOT NULL GROUP BY ALL) USING ({SEG})""",
    "seg_tokens reviews_q",
)

# Similarity path.
view(
    "report_base",
    """SELECT * FROM reviews_q WHERE year(date) = 2016 AND (year_quarter, brand) IN (
       SELECT (year_quarter, brand) FROM reviews_q WHERE year(date) = 2016 GROUP BY year_quarter, brand
       HAVING count(*) >= 10)""",
    "reviews_q",
)
view(
    "sim_tokens",
    f"""SELECT review_id, CAST(generate_subscripts(ws, 1) - 1 AS INT) AS pos, unnest(ws) AS w FROM (
       SELECT review_id, {pieces(similarity_tokens('comment'))} AS ws FROM report_base)""",
    "report_base",
)
view(
    "sim_tagged",
    f"""SELECT review_id, t.pos, t.w, coalesce(l.lemma, t.w) AS lemma, coalesce(l.tag,
       {guessed_tag('t.w')}) AS tag
       FROM sim_tokens t LEFT JOIN (SELECT w, pos AS tag, lemma FROM lexicon) l ON l.w = t.w""",
    "sim_tokens lexicon",
)
view(
    "sim_words",
    """SELECT review_id, list(lemma ORDER BY pos) AS words, string_agg(tag, '' ORDER BY pos) AS tags FROM sim_tagged
       WHERE lemma <> '-PRON-' AND w NOT IN ('is','the','are','a') AND lemma NOT IN ('is','the','are','a')
       GROUP BY review_id""",
    "sim_tagged",
)
view(
    "sim_phrases",
    f"""SELECT DISTINCT review_id, phrase_type, phrase FROM (
       SELECT review_id, 'noun' AS phrase_type, unnest({phrases('noun')}) AS phrase FROM sim_words UNION ALL
       SELECT review_id, 'verb', unnest({phrases('verb')}) FROM sim_words UNION ALL
       SELECT review_id, 'prep', unnest({phrases('prep')}) FROM sim_words)""",
    "sim_words",
)
view(
    "hyp_words",
    f"""SELECT hypothesis, list(w ORDER BY pos) AS words, string_agg(tag, '' ORDER BY pos) AS tags FROM (
       SELECT h.hypothesis, h.pos, h.w, coalesce(l.tag, {guessed_tag('h.w')}) AS tag
       FROM (SELECT hypothesis, generate_subscripts(ws, 1) AS pos, unnest(ws) AS w FROM (
             SELECT hypothesis, {pieces(similarity_tokens('hypothesis'))} AS ws
             FROM (VALUES {values(HYPOTHESES)}) AS t(hypothesis))) h
       LEFT JOIN (SELECT w, pos AS tag FROM lexicon) l ON l.w = h.w) GROUP BY hypothesis""",
    "lexicon",
)
view(
    "hyp_analysed",
    f"""SELECT hypothesis, CASE most WHEN len(n) THEN 'noun' WHEN len(v) THEN 'verb' ELSE 'prep' END AS phrase_type,
       CASE most WHEN len(n) THEN n WHEN len(v) THEN v ELSE p END AS ps FROM (
       SELECT *, greatest(len(n), len(v), len(p)) AS most FROM (SELECT hypothesis, {phrases('noun')} AS n,
       {phrases('verb')} AS v, {phrases('prep')} AS p FROM hyp_words)) WHERE most > 0""",
    "hyp_words",
)
view(
    "hyp_phrases",
    "SELECT hypothesis, phrase_type, unnest(ps) AS phrase FROM hyp_analysed",
    "hyp_analysed",
)
view(
    "phrase_vecs",
    """SELECT phrase, list(x ORDER BY d) AS vec FROM (
       SELECT phrase, d, avg(x) AS x FROM (
         SELECT p.phrase, generate_subscripts(v.vec, 1) AS d, CAST(unnest(v.vec) AS DOUBLE) AS x
         FROM (SELECT phrase, unnest(string_split(phrase, ' ')) AS word FROM (
               SELECT DISTINCT phrase FROM sim_phrases UNION SELECT phrase FROM hyp_phrases)) p
         JOIN word_vectors v ON v.word = p.word) GROUP BY phrase, d) GROUP BY phrase""",
    "sim_phrases hyp_phrases word_vectors",
)
view(
    "phrase_scores",
    """SELECT r.phrase_type, r.phrase, h.hypothesis, max(list_cosine_similarity(rv.vec, hv.vec)) AS score
       FROM (SELECT DISTINCT phrase_type, phrase FROM sim_phrases) r JOIN phrase_vecs rv ON rv.phrase = r.phrase
       JOIN hyp_phrases h ON h.phrase_type = r.phrase_type JOIN phrase_vecs hv ON hv.phrase = h.phrase
       GROUP BY ALL""",
    "sim_phrases phrase_vecs hyp_phrases",
)
view(
    "best_scores",
    """SELECT review_id, hypothesis, round(max(score), 9) AS similarity FROM sim_phrases
       JOIN phrase_scores USING (phrase_type, phrase) GROUP BY ALL""",
    "sim_phrases phrase_scores",
)
view(
    "scored",
    """SELECT b.review_id, h.hypothesis, b.year_quarter, b.brand, b.rating, round(coalesce(s.similarity, 0)
       + CASE WHEN b.rating >= 4 THEN -0.2 WHEN b.rating <= 2 THEN 0.2 ELSE 0 END, 9) AS similarity
       FROM report_base b CROSS JOIN (SELECT hypothesis FROM hyp_analysed) h
       LEFT JOIN best_scores s ON s.review_id = b.review_id AND s.hypothesis = h.hypothesis""",
    "report_base hyp_analysed best_scores",
)
view(
    "shares",
    """SELECT hypothesis, year_quarter, brand, avg(CASE WHEN similarity > 0.6 THEN 1.0 ELSE 0.0 END) AS overall_score
       FROM scored GROUP BY ALL""",
    "scored",
)
view(
    "best_reviews",
    """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY hypothesis, year_quarter, brand
       ORDER BY similarity DESC, review_id) AS INT) AS rank FROM scored) WHERE rank <= 5""",
    "scored",
)
