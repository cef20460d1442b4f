"""Independent SQL for the registered queries: named steps over the raw tables, assembled into one statement.

Steps are plain SQL written from the contract of each operator; nothing here is derived from the Spark code except
the shared constants.
"""

from __future__ import annotations

import re

from folioscope import settings
from folioscope.functions.wordlists import CLEANING_STOP_WORDS, VECTOR_STOP_WORDS
from folioscope.operators.cleaning import NOUN_RULES

BLANK = r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def latex(c: str) -> str:
    return rf"regexp_replace(regexp_replace({c}, '\$\$.*?\$\$', '', 'gs'), '\$.*?\$', '', 'gs')"


def citations(c: str) -> str:
    return rf"regexp_replace({c}, '\[\d+(?:[-,]\d+)*\]', '', 'g')"


def urls(c: str) -> str:
    return rf"regexp_replace({c}, 'https?://\S+', '', 'g')"


def special(c: str) -> str:
    return rf"regexp_replace({c}, '[^a-zA-Z0-9\s.,;:!?-]', ' ', 'g')"


def collapse(c: str) -> str:
    return rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def kept_words(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda w: w <> '' AND w NOT IN ({quoted(CLEANING_STOP_WORDS)}))"


def cleaned_words(c: str) -> str:
    return kept_words(collapse(special(urls(citations(latex(f"lower(coalesce({c}, ''))"))))))


def tokens(c: str, stop: bool = False) -> str:
    found = f"regexp_extract_all(lower(coalesce({c}, '')), '[a-z]{{2,}}')"
    return f"list_filter({found}, lambda w: w NOT IN ({quoted(VECTOR_STOP_WORDS)}))" if stop else found


def with_bigrams(t: str) -> str:
    return f"list_concat({t}, list_transform(range(1, len({t})), lambda i: {t}[i] || ' ' || {t}[i + 1]))"


def preview(c: str, n: int = settings.PREVIEW_CHARS) -> str:
    return f"CASE WHEN length({c}) > {n} THEN substr({c}, 1, {n}) || '...' ELSE {c} END"


def _candidates() -> str:
    parts = ["SELECT w, w AS candidate, 0 AS place FROM forms"]
    for place, (ending, replacement) in enumerate(NOUN_RULES, start=1):
        cut = f"substr(w, 1, length(w) - {len(ending)}) || '{replacement}'"
        parts.append(f"SELECT w, {cut} AS candidate, {place} AS place FROM forms WHERE ends_with(w, '{ending}')")
    return " UNION ALL ".join(parts)


def ranked(items: str, weights: str, queries: str, k: int) -> str:
    """Top ``k`` by dot product of long unit vectors ``(id, term, w)`` for each query, zero scores included."""
    return f"""
        SELECT query_id, rank, id, seq, score FROM (
            SELECT q.query_id, p.id, p.seq, coalesce(s.score, 0.0) AS score,
                   CAST(row_number() OVER (PARTITION BY q.query_id
                        ORDER BY round(coalesce(s.score, 0.0), 6) DESC, p.seq) AS INTEGER) AS rank
            FROM {queries} q
            JOIN {items} p ON p.id <> q.query_id
            LEFT JOIN (
                SELECT a.id AS query_id, b.id, sum(a.w * b.w) AS score
                FROM {weights} a JOIN {weights} b ON a.term = b.term
                WHERE a.id IN (SELECT query_id FROM {queries})
                GROUP BY a.id, b.id
            ) s ON s.query_id = q.query_id AND s.id = p.id
        ) WHERE rank <= {k}"""


def unit(raw: str) -> str:
    """Long vectors ``(id, term, v)`` scaled to length one."""
    return f"SELECT id, term, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS w FROM {raw} WHERE v <> 0"


def sampled(items: str, n: int) -> str:
    return f"SELECT id AS query_id FROM {items} ORDER BY md5('{settings.SEED}-' || id), id LIMIT {n}"


def judged(ranked_step: str, category_step: str) -> str:
    return f"""
        SELECT r.query_id, r.rank, r.id, coalesce(c.category = q.category, false) AS relevant
        FROM {ranked_step} r JOIN {category_step} c ON c.id = r.id JOIN {category_step} q ON q.id = r.query_id"""


def per_query(judged_step: str, ks) -> str:
    return f"""
        SELECT query_id, k, sum(CASE WHEN relevant THEN 1 ELSE 0 END) / k AS precision,
               coalesce(1.0 / min(CASE WHEN relevant THEN rank END), 0.0) AS reciprocal_rank
        FROM {judged_step} JOIN (SELECT unnest([{", ".join(map(str, ks))}]) AS k) ON rank <= k
        GROUP BY query_id, k"""


def diversity(ranked_step: str, weights: str, ks) -> str:
    """Straight from the definition: mean of 1 - cosine over all unordered pairs of distinct results."""
    return f"""
        SELECT k, CASE WHEN count(*) < 2 THEN 0.0 ELSE avg_distance END AS diversity FROM (
            SELECT m.k, m.id, d.avg_distance FROM (
                SELECT DISTINCT k, id FROM {ranked_step} JOIN (SELECT unnest([{", ".join(map(str, ks))}]) AS k) ON rank <= k
            ) m LEFT JOIN (
                SELECT k, 1 - sum(coalesce(dot, 0.0)) / count(*) AS avg_distance FROM (
                    SELECT x.k, x.id AS a, y.id AS b FROM
                        (SELECT DISTINCT k, id FROM {ranked_step} JOIN (SELECT unnest([{", ".join(map(str, ks))}]) AS k) ON rank <= k) x
                        JOIN (SELECT DISTINCT k, id FROM {ranked_step} JOIN (SELECT unnest([{", ".join(map(str, ks))}]) AS k) ON rank <= k) y
                        ON x.k = y.k AND x.id < y.id
                ) pairs LEFT JOIN (
                    SELECT u.id AS a, v.id AS b, sum(u.w * v.w) AS dot
                    FROM {weights} u JOIN {weights} v ON u.term = v.term
                    WHERE u.id IN (SELECT id FROM {ranked_step}) AND v.id IN (SELECT id FROM {ranked_step}) AND u.id < v.id
                    GROUP BY u.id, v.id
                ) dots USING (a, b) GROUP BY k
            ) d ON d.k = m.k
        ) GROUP BY k, avg_distance"""


def metrics(name: str, ranked_step: str, judged_step: str, weights: str, items: str, ks, digits: int) -> str:
    return f"""
        SELECT '{name}' AS method, CAST(s.k AS INTEGER) AS k, s.num_queries, round(s.precision, {digits}) AS precision,
               round(s.precision_std, {digits}) AS precision_std, round(s.mrr, {digits}) AS mrr,
               round(d.diversity, {digits}) AS diversity, round(c.coverage, {digits}) AS catalog_coverage
        FROM (SELECT k, count(*) AS num_queries, avg(precision) AS precision, stddev_pop(precision) AS precision_std,
                     avg(reciprocal_rank) AS mrr FROM ({per_query(judged_step, ks)}) GROUP BY k) s
        JOIN ({diversity(ranked_step, weights, ks)}) d ON d.k = s.k
        JOIN (SELECT k, count(DISTINCT id) / (SELECT count(*) FROM {items}) AS coverage
              FROM {ranked_step} JOIN (SELECT unnest([{", ".join(map(str, ks))}]) AS k) ON rank <= k GROUP BY k) c ON c.k = s.k"""


def keyword_scores(clusters: str, exact: bool = True) -> str:
    total = "exact_counts" if exact else f"(SELECT * FROM exact_counts ORDER BY n DESC, term LIMIT {settings.GLOBAL_TERM_CAP})"
    return f"""
        WITH sizes AS (SELECT cluster_id, count(*) AS size FROM {clusters} GROUP BY cluster_id),
        found AS (SELECT cluster_id, unnest({tokens("title || ' ' || abstract", True)}) AS term
                  FROM papers JOIN {clusters} USING (id) JOIN sizes USING (cluster_id) WHERE size >= 2),
        counts AS (SELECT cluster_id, term, count(*) AS n FROM found GROUP BY cluster_id, term),
        exact_counts AS (SELECT term, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY term),
        top AS (SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, term)
                <= {settings.CLUSTER_TERM_CAP})
        SELECT t.cluster_id, t.term, t.n, t.n / (coalesce(g.n, 1) + 1) AS score
        FROM top t LEFT JOIN {total} g ON g.term = t.term"""


def keyword_lists(clusters: str, exact: bool = True) -> str:
    return f"""
        SELECT s.cluster_id, coalesce(k.keywords, [CASE WHEN s.size < 2 THEN '(small cluster)'
               ELSE '(keyword extraction failed)' END]) AS keywords
        FROM (SELECT cluster_id, count(*) AS size FROM {clusters} GROUP BY cluster_id) s
        LEFT JOIN (SELECT cluster_id, list(term ORDER BY score DESC, term) AS keywords FROM (
                SELECT * FROM ({keyword_scores(clusters, exact)})
                QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, term)
                <= {settings.KEYWORDS_PER_CLUSTER}) GROUP BY cluster_id) k USING (cluster_id)"""


STEPS = {
    "papers": """
        SELECT CAST(doc_id AS VARCHAR) AS id, split_part(text, chr(10), 1) AS title, text AS abstract,
               lang || ' ' || source AS categories, '' AS authors, doc_id AS seq FROM documents""",
    "marked": r"""
        SELECT CAST(doc_id AS VARCHAR) AS id, 'E$a_' || doc_id || '$ ' || text || ' $$y' || chr(10) || n_chars
               || ' $z$$ and [' || doc_id || ',' || n_chars || '-7] or [1, 2] see https://host.example/' || source
               || '?q=' || n_chars || ', end_' || lang AS text FROM documents""",
    "stripped": f"""
        SELECT *, {cleaned_words("title")} AS title_words, {cleaned_words("abstract")} AS abstract_words FROM papers""",
    "words": """
        SELECT id, 0 AS field, unnest(title_words) AS w, generate_subscripts(title_words, 1) AS pos FROM stripped
        UNION ALL
        SELECT id, 1 AS field, unnest(abstract_words) AS w, generate_subscripts(abstract_words, 1) AS pos FROM stripped""",
    "forms": "SELECT w, count(*) AS n FROM words GROUP BY w",
    "candidates": _candidates(),
    "lemmas": """
        SELECT c.w, c.candidate AS lemma FROM candidates c JOIN forms f ON f.w = c.candidate
        QUALIFY row_number() OVER (PARTITION BY c.w ORDER BY length(c.candidate), c.place) = 1""",
    "lemma_texts": """
        SELECT id, field, string_agg(lemma, ' ' ORDER BY pos) AS t FROM words JOIN lemmas USING (w) GROUP BY id, field""",
    "clean": f"""
        SELECT p.*, coalesce(a.t, '') AS cleaned_title, coalesce(b.t, '') AS cleaned_abstract,
               {collapse("coalesce(a.t, '') || ' ' || coalesce(b.t, '')")} AS final_text
        FROM papers p LEFT JOIN (SELECT * FROM lemma_texts WHERE field = 0) a ON a.id = p.id
        LEFT JOIN (SELECT * FROM lemma_texts WHERE field = 1) b ON b.id = p.id""",
    "doc_tokens": f"SELECT id, seq, {tokens('final_text', True)} AS t FROM clean",
    "doc_terms": f"SELECT id, seq, {with_bigrams('t')} AS terms FROM doc_tokens",
    "counts": "SELECT id, term, count(*) AS n FROM (SELECT id, unnest(terms) AS term FROM doc_terms) GROUP BY id, term",
    "vocab": f"""
        SELECT *, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_idx FROM (
            SELECT term, CAST(sum(n) AS BIGINT) AS ctf, count(*) AS df,
                   ln((1 + (SELECT count(*) FROM papers)) / (1 + count(*))) + 1 AS idf
            FROM counts GROUP BY term ORDER BY ctf DESC, term LIMIT {settings.MAX_TERMS})""",
    "tfidf_raw": "SELECT id, term, n * idf AS v FROM counts JOIN vocab USING (term)",
    "tfidf": unit("tfidf_raw"),
    "hashed_raw": f"""
        SELECT id, term, sum(sign) AS v FROM (
            SELECT id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % {settings.EMBEDDING_DIM} AS term,
                   CASE WHEN substr(md5(t), 9, 1) < '8' THEN 1.0 ELSE -1.0 END AS sign
            FROM (SELECT id, unnest({tokens("final_text")}) AS t FROM clean)) GROUP BY id, term""",
    "hashed": unit("hashed_raw"),
    "vectors": "SELECT CAST(vec_id AS VARCHAR) AS id, vec_id AS seq, embedding, label FROM embeddings",
    "vectors_raw": """
        SELECT id, generate_subscripts(embedding, 1) AS term, CAST(unnest(embedding) AS DOUBLE) AS v FROM vectors""",
    "vectors_unit": unit("vectors_raw"),
    "queries100": sampled("papers", settings.EVAL_QUERIES),
    "queries200": sampled("papers", settings.SWEEP_QUERIES),
    "vector_queries": sampled("vectors", settings.EVAL_QUERIES),
    "all_vectors": "SELECT id AS query_id FROM vectors",
    "ranked_tfidf": ranked("papers", "tfidf", "queries100", settings.TOP_K),
    "ranked_hashed": ranked("papers", "hashed", "queries100", settings.TOP_K),
    "ranked_vectors": ranked("vectors", "vectors_unit", "vector_queries", settings.TOP_K),
    "swept_tfidf": ranked("papers", "tfidf", "queries200", max(settings.SWEEP_KS)),
    "swept_hashed": ranked("papers", "hashed", "queries200", max(settings.SWEEP_KS)),
    "paper_category": "SELECT id, split_part(categories, ' ', 1) AS category FROM papers",
    "vector_category": "SELECT id, CAST(label AS VARCHAR) AS category FROM vectors",
    "quality_category": """
        SELECT p.id, coalesce('q' || l.quality, 'unknown') AS category
        FROM papers p LEFT JOIN labels l ON CAST(l.doc_id AS VARCHAR) = p.id""",
    "judged_tfidf": judged("ranked_tfidf", "paper_category"),
    "judged_hashed": judged("ranked_hashed", "paper_category"),
    "judged_vectors": judged("ranked_vectors", "vector_category"),
    "judged_quality": judged("ranked_tfidf", "quality_category"),
    "judged_swept_tfidf": judged("swept_tfidf", "paper_category"),
    "judged_swept_hashed": judged("swept_hashed", "paper_category"),
    "lang_clusters": """
        SELECT CAST(doc_id AS VARCHAR) AS id, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS cluster_id
        FROM documents""",
    "length_clusters": "SELECT CAST(doc_id AS VARCHAR) AS id, CAST(n_chars AS INTEGER) AS cluster_id FROM documents",
    "label_clusters": "SELECT id, CAST(label AS INTEGER) AS cluster_id FROM vectors",
    "lang_keywords": keyword_lists("lang_clusters"),
    "centroid_parts": """
        SELECT label AS cluster_id, term, avg(v) AS c FROM vectors_raw JOIN vectors USING (id) GROUP BY label, term""",
    "centroid_distances": """
        SELECT v.id, c.cluster_id, sum((v.v - c.c) * (v.v - c.c)) AS d
        FROM vectors_raw v JOIN centroid_parts c USING (term) GROUP BY v.id, c.cluster_id""",
    "silhouettes": """
        WITH pairs AS (
            SELECT x.id, x.label AS own, y.label AS other, sqrt(list_sum(list_transform(list_zip(x.embedding, y.embedding),
                   lambda p: (CAST(p[1] AS DOUBLE) - p[2]) * (CAST(p[1] AS DOUBLE) - p[2])))) AS d
            FROM vectors x JOIN vectors y ON x.id <> y.id),
        means AS (SELECT id, own, other, avg(d) AS m FROM pairs GROUP BY id, own, other),
        ab AS (SELECT id, own, max(CASE WHEN own = other THEN m END) AS a, min(CASE WHEN own <> other THEN m END) AS b
               FROM means GROUP BY id, own)
        SELECT id, CAST(own AS INTEGER) AS cluster_id,
               CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM ab""",
    "sampled_clusters": f"""
        SELECT id, cluster_id FROM (
            SELECT id, cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY md5('{settings.SEED}-' || id), id) AS r,
                   count(*) OVER (PARTITION BY cluster_id) AS size, count(*) OVER () AS total FROM lang_clusters)
        WHERE total <= 300 OR r <= greatest(1, floor(300 * (size / total))) OR id = '7'""",
    "plane": """
        SELECT id, CAST(doc.n_chars AS DOUBLE) AS x, sqrt(doc.n_chars) + doc.doc_id AS y
        FROM papers JOIN documents doc ON doc.doc_id = papers.seq""",
    "framed": """
        SELECT id, cluster_id, x, y, 60 + (x - (x0 - px)) / ((x1 - x0) + 2 * px) * 720 AS cx,
               40 + (y - (y0 - py)) / ((y1 - y0) + 2 * py) * 440 AS cy
        FROM (SELECT *, CASE WHEN x1 > x0 THEN (x1 - x0) * 0.05 ELSE 1 END AS px,
                     CASE WHEN y1 > y0 THEN (y1 - y0) * 0.05 ELSE 1 END AS py
              FROM (SELECT id, cluster_id, x, y, min(x) OVER () AS x0, max(x) OVER () AS x1,
                           min(y) OVER () AS y0, max(y) OVER () AS y1
                    FROM plane JOIN sampled_clusters USING (id)))""",
    "requests": """
        SELECT CAST(query_id AS BIGINT) * 5 + n AS request_id, CASE WHEN n = 3 THEN 'x' ELSE '' END || query_id AS paper_id,
               CASE n WHEN 0 THEN '5' WHEN 1 THEN ' +3 ' WHEN 2 THEN '1.5' WHEN 4 THEN '0' END AS k
        FROM queries100 JOIN (SELECT unnest(range(5)) AS n) ON true""",
}


def assemble(final: str) -> str:
    """``final`` preceded by the steps it needs, in dependency order."""
    order: list[str] = []
    if final.lstrip().startswith("WITH"):
        final = f"SELECT * FROM ({final})"

    def add(text: str, own: str | None = None) -> None:
        for name in STEPS:
            if name != own and name not in order and re.search(rf"\b(FROM|JOIN)\s+\(*{name}\b", text):
                add(STEPS[name], name)
                if name not in order:
                    order.append(name)

    add(final)
    if not order:
        return final
    # every step is used several times: compute it once
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({STEPS[name]})" for name in order) + "\n" + final
