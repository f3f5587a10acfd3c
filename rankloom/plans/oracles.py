"""The registered queries in plain SQL, for comparison with another engine."""

from __future__ import annotations

from ..functions import stemming
from ..functions.text import STOP_WORDS, TOKEN_PATTERN
from ..operators import pages
from ..operators.index import POSTING_BLOCK
from .registry import GRID, MONTH


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


STOP = "(" + ", ".join(quoted(w) for w in STOP_WORDS) + ")"
TOKENS = f"regexp_extract_all(lower(text), {quoted(TOKEN_PATTERN)})"


def post(name: str, source: str, key: str = "doc_id") -> str:
    """CTE of postings of a relation with columns ``key`` and ``text``."""
    return f"""{name} AS MATERIALIZED (
        SELECT {key}, term, count(*)::BIGINT AS tf
        FROM (SELECT {key}, unnest({TOKENS}) AS term FROM {source})
        WHERE term NOT IN {STOP} GROUP BY {key}, term)"""


def statement(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


Q = post("q0", "(SELECT item_id AS qid, trim(text) AS text FROM benchmark)", "qid")
Q += ", q AS (SELECT qid, term, tf AS qtf FROM q0)"
DOCS = post("d", "documents")

PAGE_TEXT = "html"
for _pattern in (
    pages.SCRIPT_PATTERN, pages.STYLE_PATTERN, pages.TAG_PATTERN, pages.ENTITY_PATTERN
):
    PAGE_TEXT = f"regexp_replace({PAGE_TEXT}, {quoted(_pattern)}, ' ', 'g')"
PAGE_TITLE = f"nullif(regexp_extract(html, {quoted(pages.TITLE_PATTERN)}, 1), '')"
LINKS = f"""links AS MATERIALIZED (
    SELECT page_id, pos, text,
        ('0x' || substr(md5(href), 1, 8))::BIGINT % (SELECT count(*) FROM pages) AS target
    FROM (SELECT page_id,
            unnest(range(len(h))) AS pos, unnest(h) AS href, unnest(a) AS text
        FROM (SELECT page_id,
                regexp_extract_all(html, {quoted(pages.ANCHOR_PATTERN)}, 1) AS h,
                regexp_extract_all(html, {quoted(pages.ANCHOR_PATTERN)}, 2) AS a
            FROM pages)))"""
TITLES = f"titles AS (SELECT page_id AS doc_id, {PAGE_TITLE} AS title FROM pages)"
BODY = post("body", f"(SELECT page_id AS doc_id, {PAGE_TEXT} AS text FROM pages)")
TITLE = post("title_p", "(SELECT doc_id, title AS text FROM titles)")
ANCHOR = post("anchor", "(SELECT target AS doc_id, text FROM links)")
PAGE_FIELDS = (LINKS, TITLES, BODY, TITLE, ANCHOR)

VIEWS = f"""views AS (SELECT user_id AS doc_id, count(*)::BIGINT AS views FROM events
    WHERE event_type = 'view' AND ts >= TIMESTAMP '{MONTH[0]}' AND ts < TIMESTAMP '{MONTH[1]}'
    GROUP BY user_id)"""


def rank_ctes(rounds: int = 10) -> str:
    ctes = [
        "edges AS MATERIALIZED (SELECT DISTINCT page_id AS src, target AS dst FROM links"
        " WHERE page_id <> target)",
        "n AS (SELECT count(*)::DOUBLE AS n FROM pages)",
        "nodes AS MATERIALIZED (SELECT page_id AS id, coalesce(o, 0) AS outdeg FROM pages LEFT JOIN"
        " (SELECT src, count(*) AS o FROM edges GROUP BY src) ON src = page_id)",
        "r0 AS MATERIALIZED (SELECT id, outdeg, 1.0 / n AS rank FROM nodes, n)",
    ]
    for i in range(rounds):
        ctes.append(
            f"""r{i + 1} AS MATERIALIZED (
            SELECT r.id, r.outdeg, 0.15 / n + 0.85 * (coalesce(g, 0) + coalesce((
                SELECT sum(rank) FROM r{i} WHERE outdeg = 0), 0) / n) AS rank
            FROM r{i} r CROSS JOIN n LEFT JOIN (SELECT dst, sum(rank / outdeg) AS g
                FROM edges JOIN r{i} ON src = id GROUP BY dst) ON dst = r.id)"""
        )
    ctes.append(f"page_rank AS (SELECT id AS doc_id, rank AS pagerank FROM r{rounds})")
    return ",\n".join(ctes)


RANKS = rank_ctes()


def stats(name: str, source: str) -> str:
    return f"""{name} AS MATERIALIZED (SELECT term, count(*)::BIGINT AS df,
        sum(tf)::BIGINT AS term_total FROM {source} GROUP BY term)"""


def tfidf_cte(name: str, post_name: str, n: str) -> str:
    return f"""{name} AS MATERIALIZED (
        SELECT qid, doc_id, sum(qtf * tf * log10({n} / df::DOUBLE)) AS score
        FROM q JOIN {post_name} p USING (term)
        JOIN (SELECT term, count(*) AS df FROM {post_name} GROUP BY term) USING (term)
        GROUP BY qid, doc_id)"""


def bm25_cte(name: str, post_name: str, n: str, k1: float, b: float) -> str:
    return f"""{name} AS MATERIALIZED (
        SELECT qid, doc_id, sum(qtf * log10({n} / df::DOUBLE) * tf * ({k1} + 1)::DOUBLE
            / (tf + {k1}::DOUBLE * (1 - {b}::DOUBLE + {b}::DOUBLE * doc_len / avg_len))) AS score
        FROM q JOIN {post_name} USING (term)
        JOIN (SELECT term, count(*) AS df FROM {post_name} GROUP BY term) USING (term)
        JOIN (SELECT doc_id, sum(tf)::DOUBLE AS doc_len FROM {post_name} GROUP BY doc_id)
            USING (doc_id)
        CROSS JOIN (SELECT sum(tf)::DOUBLE / {n} AS avg_len FROM {post_name})
        GROUP BY qid, doc_id)"""


def count_cte(name: str, post_name: str, expression: str) -> str:
    return f"""{name} AS (SELECT qid, doc_id, sum({expression})::BIGINT AS score
        FROM q JOIN {post_name} USING (term) GROUP BY qid, doc_id)"""


def per_term_cosine(name: str, post_name: str) -> str:
    return f"""{name}_w AS (SELECT qid, term, qtf, qtf * log10((SELECT count(DISTINCT term)
            FROM {post_name}) / df::DOUBLE) AS w
        FROM q JOIN (SELECT term, count(*) AS df FROM {post_name} GROUP BY term) USING (term)),
    {name} AS (SELECT qid, doc_id,
            sum(CASE WHEN norm = 0 THEN 0 ELSE qtf * abs(w) / norm END) AS score
        FROM {name}_w JOIN {post_name} USING (term)
        JOIN (SELECT qid, sqrt(sum(w * w)) AS norm FROM {name}_w GROUP BY qid) USING (qid)
        GROUP BY qid, doc_id)"""


def full_cosine(post_name: str) -> tuple[str, ...]:
    return (
        stats("st", post_name),
        """i AS MATERIALIZED (SELECT term, log10((SELECT count(*) FROM st) / df::DOUBLE) AS idf
            FROM st)""",
        """qn AS (SELECT qid, sqrt(sum((qtf * idf) ** 2)) AS qnorm FROM q JOIN i USING (term)
            GROUP BY qid)""",
        f"""dn AS (SELECT doc_id, sqrt(sum((tf * idf) ** 2)) AS dnorm FROM {post_name}
            JOIN i USING (term) GROUP BY doc_id)""",
        f"""s AS (SELECT qid, doc_id, sum(CASE WHEN qnorm * dnorm = 0 THEN 0
                ELSE qtf * idf * tf * idf / (qnorm * dnorm) END) AS score
            FROM q JOIN i USING (term) JOIN {post_name} USING (term) JOIN qn USING (qid)
            JOIN dn USING (doc_id) GROUP BY qid, doc_id)""",
    )


def top(source: str, k: int, by: str = "qid") -> str:
    return f"""(SELECT *, row_number() OVER (PARTITION BY {by}
        ORDER BY round(score, 9) DESC, doc_id) AS rank FROM {source}
        QUALIFY rank <= {k})"""


def show(source: str, k: int, more: str = "") -> str:
    return f"SELECT {more}qid, rank, doc_id, round(score, 6) AS score FROM {top(source, k)}"


def show_titled(source: str, k: int) -> str:
    return f"""SELECT qid, rank, doc_id, title, round(score, 6) AS score
        FROM {top(source, k)} LEFT JOIN titles USING (doc_id)"""


N_DOCS = "(SELECT count(*) FROM documents)"
N_PAGES = "(SELECT count(*) FROM pages)"


def candidates(name: str, source: str) -> str:
    return f"""{name} AS (SELECT qid, doc_id,
        coalesce(score / nullif(max(score) OVER (PARTITION BY qid), 0), 0) AS score
        FROM {top(source, 500)})"""


def wide(*fields: str) -> str:
    union = " UNION ALL ".join(
        f"SELECT qid, doc_id, '{f}' AS field, score FROM c_{f}" for f in fields
    )
    columns = ", ".join(
        f"coalesce(max(score) FILTER (WHERE field = '{f}'), 0) AS {f}" for f in fields
    )
    return f"""wide AS (SELECT w.*, coalesce(pagerank / (SELECT max(pagerank) FROM page_rank), 0)
            AS pagerank,
            coalesce(views / (SELECT max(views) FROM views)::DOUBLE, 0) AS pageviews
        FROM (SELECT qid, doc_id, {columns} FROM ({union}) GROUP BY qid, doc_id) w
        LEFT JOIN page_rank USING (doc_id) LEFT JOIN views USING (doc_id))"""


def weighted(text, title, anchor, pagerank, pageviews) -> str:
    parts = {
        "text": text, "title": title, "anchor": anchor, "pagerank": pagerank,
        "pageviews": pageviews,
    }
    return " + ".join(f"{name} * {weight}::DOUBLE" for name, weight in parts.items())


THREE_FIELDS = (
    Q, *PAGE_FIELDS, VIEWS, RANKS,
    bm25_cte("s_text", "body", N_PAGES, 1.2, 0.5),
    count_cte("s_title", "title_p", "qtf"),
    count_cte("s_anchor", "anchor", "qtf"),
    candidates("c_text", "s_text"),
    candidates("c_title", "s_title"),
    candidates("c_anchor", "s_anchor"),
    wide("text", "title", "anchor"),
)

EVALUATED = (
    Q,
    DOCS,
    tfidf_cte("s", "d", N_DOCS),
    f"runs AS MATERIALIZED (SELECT qid, doc_id, rank FROM {top('s', 100)})",
    "judged AS MATERIALIZED (SELECT item_id AS qid, doc_id FROM benchmark b, documents d"
    " WHERE contains(d.text, b.text))",
    "queries AS (SELECT item_id AS qid FROM benchmark)",
    """hits AS (SELECT r.qid, r.doc_id, r.rank, (j.doc_id IS NOT NULL)::INT AS hit
        FROM runs r LEFT JOIN judged j ON r.qid = j.qid AND r.doc_id = j.doc_id)""",
    "relevant AS (SELECT qid, count(*) AS n FROM judged GROUP BY qid)",
)


def precision(k: int) -> str:
    return f"""coalesce(round_even(sum(hit) FILTER (WHERE rank <= {k})
        / nullif(count(*) FILTER (WHERE rank <= {k}), 0), 3)::DOUBLE, 0)"""


def recall(k: int) -> str:
    return f"""CASE WHEN any_value(n) IS NULL THEN 1.0::DOUBLE ELSE coalesce(round_even(
        sum(hit) FILTER (WHERE rank <= {k}) / any_value(n)::DOUBLE, 3)::DOUBLE, 0) END"""


def harmonic(p: str, r: str) -> str:
    return f"""CASE WHEN {p} = 0 OR {r} = 0 THEN 0
        ELSE round_even(2.0::DOUBLE / (1.0::DOUBLE / {p} + 1.0::DOUBLE / {r}), 3)::DOUBLE END"""


METRICS = f"""metrics AS (SELECT qid, {precision(5)} AS p5, {precision(10)} AS p10,
        {precision(30)} AS p30, {recall(30)} AS r30, {recall(100)} AS r100,
        coalesce(1.0::DOUBLE / min(rank) FILTER (WHERE hit = 1), 0) AS rr,
        coalesce(sum(hit / log2(rank + 1)) FILTER (WHERE rank <= 10), 0) / coalesce(
            list_sum([1.0::DOUBLE / log2(i + 1) FOR i IN range(1, least(any_value(n), 10) + 1)]),
            1) AS ndcg,
        (coalesce(sum(hit) FILTER (WHERE rank <= 10), 0) / 10.0::DOUBLE) AS p_fixed
    FROM queries LEFT JOIN hits USING (qid) LEFT JOIN relevant USING (qid) GROUP BY qid)"""
AP = """ap AS (SELECT qid, coalesce(round_even(avg(so_far::DOUBLE / rank) FILTER (WHERE hit = 1),
            3)::DOUBLE, 0) AS ap
    FROM queries LEFT JOIN (SELECT *, sum(hit) OVER (PARTITION BY qid ORDER BY rank) AS so_far
        FROM hits WHERE rank <= 40) USING (qid) GROUP BY qid)"""
F1 = f"f1s AS (SELECT *, {harmonic('p30', 'r30')} AS f1 FROM metrics)"


def evaluated(select: str) -> str:
    return statement(*EVALUATED, METRICS, AP, F1, select=select)


ID_LIST = "(SELECT event_id AS pos, user_id * 2 AS doc_id FROM events)"

ORACLES: dict[str, str] = {
    "tokenize_docs": f"""SELECT doc_id, len(t)::BIGINT AS n_tokens,
            array_to_string(t, ' ') AS tokens
        FROM (SELECT doc_id, list_filter({TOKENS}, lambda x: x NOT IN {STOP}) AS t
            FROM documents)""",
    "postings": statement(DOCS, select="SELECT term, doc_id, tf FROM d"),
    "term_stats": statement(DOCS, stats("s", "d"), select="SELECT term, df, term_total FROM s"),
    "stream_index": statement(DOCS, stats("s", "d"), select="SELECT term, df, term_total FROM s"),
    "doc_lengths": statement(
        DOCS, select="SELECT doc_id, sum(tf)::BIGINT AS doc_len FROM d GROUP BY doc_id"
    ),
    "posting_lists": statement(
        DOCS,
        select=f"""SELECT term, doc_id // {POSTING_BLOCK} AS block,
            string_agg(doc_id || ':' || tf, ' ' ORDER BY doc_id) AS postings
            FROM d GROUP BY term, block""",
    ),
    "corpus_stats": statement(
        *PAGE_FIELDS,
        select=" UNION ALL ".join(
            f"""SELECT '{field}' AS field, {N_PAGES} AS n_docs,
                count(DISTINCT term) AS n_terms, sum(tf)::BIGINT AS sum_len,
                round(sum(tf)::DOUBLE / {N_PAGES}, 6) AS avg_len FROM {source}"""
            for field, source in (("body", "body"), ("title", "title_p"), ("anchor", "anchor"))
        ),
    ),
    "doc_norms": statement(
        DOCS,
        stats("s", "d"),
        select="""SELECT doc_id, round(sqrt(sum(w * w)), 6) AS doc_norm FROM (
            SELECT doc_id, tf * log10((SELECT count(*) FROM s) / df::DOUBLE) AS w
            FROM d JOIN s USING (term)) GROUP BY doc_id""",
    ),
    "field_postings": statement(
        *PAGE_FIELDS,
        select=" UNION ALL ".join(
            f"SELECT '{field}' AS field, term, doc_id, tf FROM {source}"
            for field, source in (("body", "body"), ("title", "title_p"), ("anchor", "anchor"))
        ),
    ),
    "idf": statement(
        DOCS,
        stats("s", "d"),
        select=f"SELECT term, df, round(log10({N_DOCS} / df::DOUBLE), 6) AS idf FROM s",
    ),
    "query_vector": statement(
        Q,
        DOCS,
        stats("s", "d"),
        "v AS (SELECT qid, term, qtf, qtf * log10((SELECT count(*) FROM s) / df::DOUBLE) AS w"
        " FROM q JOIN s USING (term))",
        select="""SELECT qid, term, qtf, round(w, 6) AS weight,
            round(sqrt(sum(w * w) OVER (PARTITION BY qid)), 6) AS norm FROM v""",
    ),
    "tfidf_topk": statement(Q, DOCS, tfidf_cte("s", "d", N_DOCS), select=show("s", 10)),
    "cosine_per_term": statement(Q, DOCS, per_term_cosine("s", "d"), select=show("s", 100)),
    "cosine_full": statement(Q, DOCS, *full_cosine("d"), select=show("s", 100)),
    "vector_cosine": statement(
        Q, DOCS, *full_cosine("d"), select="SELECT qid, doc_id, round(score, 6) AS cosine FROM s"
    ),
    "body_search": statement(
        Q, TITLES, BODY, *full_cosine("body"), select=show_titled("s", 100)
    ),
    "query_postings": statement(
        Q, DOCS, select="SELECT qid, term, doc_id, tf FROM q JOIN d USING (term)"
    ),
    "results_per_query": statement(
        Q, TITLES, TITLE,
        select="""SELECT item_id AS qid, count(DISTINCT doc_id) AS n_results FROM benchmark
            LEFT JOIN q ON qid = item_id LEFT JOIN title_p USING (term) GROUP BY item_id""",
    ),
    "unusual_queries": statement(
        Q, TITLES, TITLE,
        select="""SELECT item_id * 3 + k AS qid,
                (CASE WHEN k = 2 THEN n ELSE 0 END)::BIGINT AS n_results
            FROM (SELECT item_id, count(DISTINCT doc_id) AS n FROM benchmark
                LEFT JOIN q ON qid = item_id LEFT JOIN title_p USING (term) GROUP BY item_id),
            (SELECT unnest([0, 1, 2]) AS k)""",
    ),
    "link_edges": statement(
        LINKS,
        select="SELECT DISTINCT page_id AS src, target AS dst FROM links WHERE page_id <> target",
    ),
    "pagerank_lookup_normalized": statement(
        LINKS, RANKS,
        select=f"""SELECT pos, doc_id, round(coalesce(
                pagerank / (SELECT max(pagerank) FROM page_rank), 0), 6) AS pagerank
            FROM {ID_LIST} LEFT JOIN page_rank USING (doc_id)""",
    ),
    "eval_hits": statement(
        *EVALUATED,
        select="""SELECT qid, rank, doc_id, hit::BIGINT AS hit, round(sum(hit) OVER (
            PARTITION BY qid ORDER BY rank)::DOUBLE / rank, 6) AS precision FROM hits""",
    ),
    "bm25_topk": statement(
        Q, DOCS, bm25_cte("s", "d", N_DOCS, 1.2, 0.75), select=show("s", 100)
    ),
    "word_count": statement(Q, DOCS, count_cte("s", "d", "qtf"), select="SELECT * FROM s"),
    "tf_count": statement(Q, DOCS, count_cte("s", "d", "qtf * tf"), select="SELECT * FROM s"),
    "distinct_match_title": statement(
        Q, TITLES, TITLE, count_cte("s", "title_p", "1"),
        select="SELECT qid, doc_id, title, score FROM s LEFT JOIN titles USING (doc_id)",
    ),
    "distinct_match_anchor": statement(
        Q, LINKS, TITLES, ANCHOR, count_cte("s", "anchor", "1"),
        select="SELECT qid, doc_id, title, score FROM s LEFT JOIN titles USING (doc_id)",
    ),
    "title_per_term": statement(
        Q, TITLES, TITLE, per_term_cosine("s", "title_p"), select=show_titled("s", 100)
    ),
    "anchor_per_term": statement(
        Q, LINKS, TITLES, ANCHOR, per_term_cosine("s", "anchor"), select=show_titled("s", 100)
    ),
    "main_search": statement(
        Q, TITLES, BODY, tfidf_cte("s", "body", N_PAGES),
        select="SELECT *, 'https://en.wikipedia.org/?curid=' || doc_id AS link FROM ("
        + show_titled("s", 10) + ")",
    ),
    "max_normalize": statement(
        Q, DOCS, tfidf_cte("s", "d", N_DOCS),
        select="""SELECT qid, doc_id, round(coalesce(
            score / nullif(max(score) OVER (PARTITION BY qid), 0), 0), 6) AS score FROM s""",
    ),
    "fusion_two_field": statement(
        Q, *PAGE_FIELDS, VIEWS, RANKS,
        bm25_cte("s_text", "body", N_PAGES, 1.2, 0.6),
        bm25_cte("s_title", "title_p", N_PAGES, 1.5, 0.4),
        candidates("c_text", "s_text"),
        candidates("c_title", "s_title"),
        wide("text", "title"),
        """s AS (SELECT qid, doc_id, text * 1.9::DOUBLE + title * 1.1::DOUBLE
            + pagerank * 0.4::DOUBLE + pageviews * 0.6::DOUBLE AS score FROM wide)""",
        select=show_titled("s", 100),
    ),
    "fusion_three_field": statement(
        *THREE_FIELDS,
        f"s AS (SELECT qid, doc_id, {weighted(0.65, 0.25, 0.1, 1.0, 1.0)} AS score FROM wide)",
        select=show_titled("s", 100),
    ),
    "fusion_weight_grid": statement(
        *THREE_FIELDS,
        "s AS (" + " UNION ALL ".join(
            f"""SELECT {i}::BIGINT AS setting, qid, doc_id,
                {weighted(g.text, g.title, g.anchor, g.pagerank, g.pageviews)} AS score FROM wide"""
            for i, g in enumerate(GRID)
        ) + ")",
        select="SELECT setting, qid, rank, doc_id, round(score, 6) AS score FROM "
        + top("s", 20, "setting, qid"),
    ),
    "hybrid_pagerank": statement(
        Q, LINKS, BODY, RANKS, tfidf_cte("t", "body", N_PAGES),
        """s AS (SELECT qid, doc_id, 0.8::DOUBLE * score
            + 0.2::DOUBLE * ln(1 + coalesce(pagerank, 0)) AS score
            FROM t LEFT JOIN page_rank USING (doc_id))""",
        select=show("s", 100),
    ),
    "pageviews_month": statement(VIEWS, select="SELECT doc_id, views FROM views"),
    "titles_extract": statement(TITLES, select="SELECT doc_id, title FROM titles"),
    "anchors_extract": statement(LINKS, select="SELECT page_id, pos, target, text FROM links"),
    "page_rank": statement(
        LINKS, RANKS, select="SELECT doc_id, round(pagerank, 9) AS pagerank FROM page_rank"
    ),
    "pagerank_lookup": statement(
        LINKS, RANKS,
        select=f"""SELECT pos, doc_id, round(coalesce(pagerank, 0), 9) AS pagerank
            FROM {ID_LIST} LEFT JOIN page_rank USING (doc_id)""",
    ),
    "pageview_lookup": statement(
        VIEWS,
        select=f"""SELECT pos, doc_id, coalesce(views, 0) AS views
            FROM {ID_LIST} LEFT JOIN views USING (doc_id)""",
    ),
    "title_lookup": statement(
        TITLES,
        select=f"SELECT pos, doc_id, title FROM {ID_LIST} LEFT JOIN titles USING (doc_id)",
    ),
    "judgments": "SELECT item_id AS qid, doc_id FROM benchmark b, documents d"
    " WHERE contains(d.text, b.text)",
    "eval_p_at_k": evaluated("SELECT qid, p5 AS precision FROM metrics"),
    "eval_p_at_k_fixed": evaluated(
        """SELECT qid, coalesce(sum(hit), 0) / 10.0::DOUBLE AS precision,
            coalesce(sum(hit), 0)::BIGINT AS relevant_found,
            coalesce(any_value(n), 0)::BIGINT AS total_relevant,
            count(rank)::BIGINT AS total_retrieved,
            coalesce(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id::VARCHAR)
                FILTER (WHERE hit = 1), '') AS hit_ids,
            coalesce(string_agg(doc_id::VARCHAR, ',' ORDER BY rank), '') AS retrieved_ids
        FROM queries LEFT JOIN (SELECT * FROM hits WHERE rank <= 10) USING (qid)
        LEFT JOIN relevant USING (qid) GROUP BY qid"""
    ),
    "eval_recall": evaluated("SELECT qid, r30 AS recall FROM metrics"),
    "eval_f1": evaluated("SELECT qid, f1 FROM f1s"),
    "eval_results_quality": evaluated(
        f"SELECT qid, {harmonic('p5', 'f1')} AS quality FROM f1s"
    ),
    "eval_ap": evaluated("SELECT qid, ap AS average_precision FROM ap"),
    "eval_mrr": evaluated("SELECT round(avg(rr), 6) AS mrr FROM metrics"),
    "eval_ndcg": evaluated("SELECT qid, round(ndcg, 6) AS ndcg FROM metrics"),
    "eval_summary": evaluated(
        """SELECT count(*) AS total_queries, round(avg(p_fixed), 6) AS mean_precision,
            round(median(p_fixed), 6) AS median_precision,
            round(coalesce(stddev_samp(p_fixed), 0), 6) AS stdev_precision,
            round(min(p_fixed), 6) AS min_precision, round(max(p_fixed), 6) AS max_precision,
            count(*) FILTER (WHERE p_fixed = 1) AS perfect_scores,
            count(*) FILTER (WHERE p_fixed = 0) AS zero_scores FROM metrics"""
    ),
    "eval_histogram": evaluated(
        """SELECT round_even(p_fixed, 1)::DOUBLE AS precision, count(*) AS n_queries
            FROM metrics GROUP BY 1"""
    ),
    "eval_mean": evaluated(
        f"""SELECT round(avg(ap), 6) AS map, round(avg(p5), 6) AS p_at_5,
            round(avg(p10), 6) AS p_at_10, round(avg(r100), 6) AS recall_at_100,
            round(avg(f1), 6) AS f1_at_30, round(avg({harmonic('p5', 'f1')}), 6) AS quality,
            round(avg(rr), 6) AS mrr, round(avg(ndcg), 6) AS ndcg_at_10
        FROM f1s JOIN ap USING (qid)"""
    ),
}
# Written to files and read back.
ORACLES["page_rank_round_trip"] = ORACLES["page_rank"]
ORACLES["report_round_trip"] = ORACLES["eval_p_at_k_fixed"]

ORACLES["page_rank_normalized"] = statement(
    LINKS, RANKS,
    select="SELECT doc_id, round(pagerank / max(pagerank) OVER (), 9) AS pagerank FROM page_rank",
)
# A file of judged queries numbers them by their place.
PLACED = """(SELECT item_id, coalesce(text, '') AS query, row_number() OVER (ORDER BY item_id) - 1 AS pos
    FROM benchmark)"""
ORACLES["judged_query_run"] = f"""SELECT p.pos AS qid, r.* EXCLUDE (qid)
    FROM ({ORACLES["eval_p_at_k_fixed"]}) r JOIN {PLACED} p ON p.item_id = r.qid"""
ORACLES["judged_queries_round_trip"] = f"""SELECT p.pos AS qid, p.query,
        coalesce(string_agg(j.doc_id::VARCHAR, ',' ORDER BY j.doc_id), '') AS ids
    FROM {PLACED} p LEFT JOIN ({ORACLES["judgments"]}) j ON j.qid = p.item_id GROUP BY ALL"""

# Other ways to the same rows
ORACLES["query_postings_from_blocks"] = ORACLES["query_postings"]
ORACLES["tfidf_topk_pruned"] = ORACLES["tfidf_topk"]
ORACLES["bm25_topk_pruned"] = ORACLES["bm25_topk"]

ORACLES["replaced_documents"] = statement(
    DOCS, stats("s", "d"), select=f"SELECT term, df, term_total, {N_DOCS} AS n_docs FROM s"
)


def stem_ctes(terms: str) -> str:
    """CTE ``stems(term, stem)`` of the different terms of a relation, one layer of rules in each."""

    def shape(word: str) -> str:
        letters = f"list_prepend('', string_split({word}, ''))"
        return f"list_reduce({letters}, lambda acc, ch: acc || {stemming.LETTER})"

    ctes, before = [f"layer0 AS MATERIALIZED (SELECT DISTINCT term FROM {terms})"], "layer0"
    for k, (name, expression) in enumerate(stemming.layers(shape), 1):
        ctes.append(f"layer{k} AS MATERIALIZED (SELECT *, {expression} AS {name} FROM {before})")
        before = f"layer{k}"
    return ",\n".join([*ctes, f"stems AS (SELECT term, stem FROM {before})"])


ORACLES["stemmed_terms"] = statement(
    DOCS, stem_ctes("d"),
    select="SELECT term, df, stem FROM stems JOIN (SELECT term, count(*) AS df FROM d GROUP BY term) USING (term)",
)
ORACLES["stemmed_search"] = statement(
    Q.split(", q AS")[0], DOCS, stem_ctes("(SELECT term FROM d UNION SELECT term FROM q0)"),
    "ds AS MATERIALIZED (SELECT doc_id, stem AS term, sum(tf)::BIGINT AS tf FROM d JOIN stems USING (term)"
    " GROUP BY doc_id, stem)",
    "q AS (SELECT qid, stem AS term, sum(tf)::BIGINT AS qtf FROM q0 JOIN stems USING (term) GROUP BY qid, stem)",
    tfidf_cte("s", "ds", N_DOCS), select=show("s", 10),
)

# What the links were written for, known without resolving any of them.
ORACLES["resolved_links"] = r"""
WITH p AS (SELECT page_id, regexp_replace(url, '#.*', '') AS url, split_part(url, ':', 1) AS scheme FROM pages),
t AS (SELECT url, min(page_id) AS target FROM p GROUP BY url),
b AS (SELECT p.page_id, p.url, p.scheme, n.url AS next, n.scheme AS next_scheme
      FROM p JOIN p n ON n.page_id = p.page_id + 1),
l AS (
  SELECT page_id, unnest([0, 2]) AS pos, next AS url FROM b
  UNION ALL SELECT page_id, 1, scheme || substr(next, length(next_scheme) + 1) FROM b
  UNION ALL SELECT page_id, unnest([3, 4]), url FROM b)
SELECT page_id, pos::BIGINT AS pos, target FROM l JOIN t USING (url)
"""
