"""Text processing and retrieval (X*), vectors of words (R8), ranking quality (E11)."""

import string

from pyspark.sql import Window
from pyspark.sql import functions as F

from brightledger.functions.geometry import dot, norm
from brightledger.operators import aggregates as agg
from brightledger.operators import evaluation as ev
from brightledger.operators import retrieval as rt
from brightledger.operators import vector_index as vi
from brightledger.operators import text as tx
from brightledger.operators.ordering import with_position
from brightledger.plans.registry import query
from brightledger.plans.statistics import rounded
from brightledger.plans.view_sql import QA, WORDS, with_views
from brightledger.session import materialise

_VARIANTS = "translate({c}, 'يكةۀؤإأآ' || chr(8204) || chr(8203), 'یکههوااا ')"
_CLEAN = (r"trim(regexp_replace(regexp_replace(regexp_replace({c}, '[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}]+', '', 'g'), "
          r"'([؟!.,]){2,}', '\1', 'g'), '[\s]+', ' ', 'g'))")
_NOISY = "replace(replace(replace(translate(text, 'ei', 'يك'), '.', '.!' || chr(128512)), ' a', chr(8203) || 'a'), ', ', chr(8204))"


_GAPPY = f"coalesce(CASE WHEN doc_id % 10 <> 3 THEN {_NOISY} END, '')"


def noisy(t):
    """Documents with letter variants, pictographs and repeated marks put in."""
    c = F.translate("text", "ei", "يك")
    c = F.replace(c, F.lit("."), F.lit(".!\U0001F600"))
    c = F.replace(c, F.lit(" a"), F.lit("\u200ba"))
    return t.documents.select("doc_id", F.replace(c, F.lit(", "), F.lit("\u200c")).alias("text"))


@query("x1_unify_letters", f"SELECT doc_id, {_VARIANTS.format(c=_NOISY)} AS text FROM documents")
def _(t):
    return noisy(t).select("doc_id", tx.unify_letters(F.col("text")).alias("text"))


@query("x1_unify_accents", "SELECT doc_id, translate(text, 'éèêçñóíä', 'eeecnoia') AS text FROM documents")
def _(t):
    accents = {"é": "e", "è": "e", "ê": "e", "ç": "c", "ñ": "n", "ó": "o", "í": "i", "ä": "a"}
    return t.documents.select("doc_id", tx.unify_letters(F.col("text"), accents, "").alias("text"))


@query("x2_clean_punctuation", f"SELECT doc_id, {_CLEAN.replace('{c}', _NOISY)} AS text FROM documents")
def _(t):
    return noisy(t).select("doc_id", tx.clean_punctuation(F.col("text")).alias("text"))


@query("x3_clean", f"SELECT doc_id, {_CLEAN.replace('{c}', _VARIANTS.format(c=_GAPPY))} AS text FROM documents")
def _(t):
    gaps = noisy(t).withColumn("text", F.when(F.col("doc_id") % 10 != 3, F.col("text")))
    return gaps.select("doc_id", tx.clean(F.col("text")).alias("text"))


_MARKED = "replace(replace(text, 'é', 'e' || chr(1611)), 'ñ', 'n' || chr(1618))"


def marked(t):
    c = F.replace(F.col("text"), F.lit("é"), F.lit("e\u064b"))
    return t.documents.select("doc_id", F.replace(c, F.lit("ñ"), F.lit("n\u0652")).alias("text"))


@query("x4_marks_present", " UNION ALL ".join(
    f"SELECT '{col}' AS \"column\", chr({ord(m)}) AS mark, coalesce(max(contains({e}, chr({ord(m)}))), false) AS present FROM documents"
    for col, e in (("before", _MARKED), ("after", f"regexp_replace({_MARKED}, '[\u064b-\u0652\u0670]', '', 'g')")) for m in tx.VOWEL_MARKS))
def _(t):
    return tx.marks_present(marked(t), {"before": F.col("text"), "after": tx.remove_marks(F.col("text"))})


@query("x5_remove_marks", f"SELECT doc_id, regexp_replace({_MARKED}, '[\u064b-\u0652\u0670]', '', 'g') AS text FROM documents")
def _(t):
    return marked(t).select("doc_id", tx.remove_marks(F.col("text")).alias("text"))


_TOKENS = r"string_split(trim(regexp_replace(text, '[\s]+', ' ', 'g')), ' ')"


@query("x6_tokens", f"SELECT doc_id, len({_TOKENS}) AS n_tokens, array_to_string({_TOKENS}, '|') AS joined FROM documents")
def _(t):
    tok = t.documents.select("doc_id", tx.tokens(F.col("text")).alias("t"))
    return tok.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.array_join("t", "|").alias("joined"))


STOP_WORDS = ["the", "of", "and", "in", "la", "le", "de", "des", "et", "der", "die", "und", "que", "los"]
_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)


@query("x7_stop_words", f"SELECT doc_id, len({_TOKENS}) AS n_with, len(list_filter({_TOKENS}, lambda w: w NOT IN ({_STOPS}))) AS n_without, array_to_string(list_filter({_TOKENS}, lambda w: w NOT IN ({_STOPS})), ' ') AS kept FROM documents")
def _(t):
    tok = t.documents.select("doc_id", tx.tokens(F.col("text")).alias("t"))
    kept = tok.withColumn("k", tx.without_stop_words(F.col("t"), STOP_WORDS))
    return kept.select("doc_id", F.size("t").cast("bigint").alias("n_with"), F.size("k").cast("bigint").alias("n_without"),
                       F.array_join("k", " ").alias("kept"))


def _short_sql():
    special = set(r"\.^$*+?()[]{}|-")
    e = r"trim(regexp_replace(replace(replace(text, 'on', 'onnnn'), 'a', 'aaa'), '[\s]+', ' ', 'g'))"
    for ch in string.ascii_letters + string.digits + string.punctuation + "éèêçñóíäöüßÉÈÊÇÑÓÍÄÖÜ":
        pattern = ("\\" + ch if ch in special else ch).replace("'", "''")
        twice = (ch * 2).replace("\\", "\\\\").replace("'", "''")
        e = f"regexp_replace({e}, '{pattern}{{3,}}', '{twice}', 'g')"
    return e


@query("x8_shorten_repeats", f"SELECT doc_id, {_short_sql()} AS text FROM documents")
def _(t):
    stretched = F.replace(F.replace(F.col("text"), F.lit("on"), F.lit("onnnn")), F.lit("a"), F.lit("aaa"))
    return t.documents.select("doc_id", F.array_join(tx.shorten_repeats(tx.tokens(stretched)), " ").alias("text"))


@query("x9_replace_words", f"SELECT doc_id, array_to_string(list_transform({_TOKENS}, lambda w: CASE w WHEN 'the' THEN 'article' WHEN 'la' THEN 'artículo' WHEN 'and' THEN 'link' ELSE w END), ' ') AS text FROM documents")
def _(t):
    swapped = tx.replace_words(tx.tokens(F.col("text")), {"the": "article", "la": "artículo", "and": "link"})
    return t.documents.select("doc_id", F.array_join(swapped, " ").alias("text"))


@query("x10_word_frequency", f"""SELECT word, count(*) AS n FROM (SELECT unnest({_TOKENS}) AS word FROM documents) WHERE word NOT IN ('.', ',', '!', '?', '-', ':') GROUP BY 1 ORDER BY n DESC, word LIMIT 50""")
def _(t):
    tok = t.documents.select(tx.tokens(F.col("text")).alias("t"))
    return tx.word_frequency(tok, "t", [".", ",", "!", "?", "-", ":"], 50)


_WORDS = WORDS


@query("x11_top_ngrams", f"WITH w AS (SELECT {_WORDS} AS w FROM documents) " + " UNION ALL ".join(
    f"SELECT * FROM (SELECT CAST({n} AS INTEGER) AS size, array_to_string(list_slice(w, i, i + {n - 1}), ' ') AS ngram, count(*) AS n FROM (SELECT w, unnest(generate_series(1, len(w) - {n - 1})) AS i FROM w) GROUP BY 2 ORDER BY n DESC, ngram LIMIT 20)"
    for n in (1, 2, 3)))
def _(t):
    out, tokens = None, materialise(t.documents.select(tx.words(F.col("text")).alias("w")), "tokens")
    for n in (1, 2, 3):
        part = tx.top_ngrams(tokens, F.col("w"), n).select(F.lit(n).alias("size"), "ngram", "n")
        out = part if out is None else out.unionByName(part)
    return out


_BARE = r"trim(regexp_replace(replace(txt, '.', ''), '\s+', ' ', 'g'))"
_LEN = with_views(QA) + f""", x AS (SELECT 'question' AS part, question AS txt FROM qa UNION ALL SELECT 'answer', answer FROM qa WHERE answer IS NOT NULL),
l AS (SELECT part, length(txt) AS chars, CASE WHEN {_BARE} = '' THEN 0 ELSE len(string_split({_BARE}, ' ')) END AS words FROM x),
v AS (SELECT part, 'chars' AS measure, chars AS v FROM l UNION ALL SELECT part, 'words', words FROM l)
SELECT part, measure, count(*) AS n, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.5), 6) AS median FROM v GROUP BY 1, 2"""


@query("x12_length_statistics", _LEN)
def _(t):
    both = t.qa.select(F.lit("question").alias("part"), F.col("question").alias("txt")).unionByName(
        t.qa.select(F.lit("answer").alias("part"), F.col("answer").alias("txt")))
    return rounded(tx.length_statistics(both, "txt", ["part"]), "mean", "median")


@query("x13_most_answered", with_views(QA) + """SELECT conv_id, count(answer_turn) AS n_answers FROM qa GROUP BY 1 ORDER BY n_answers DESC, conv_id LIMIT 20""")
def _(t):
    return t.qa.groupBy("conv_id").agg(F.count("answer_turn").alias("n_answers")).orderBy(F.desc("n_answers"), "conv_id").limit(20)


@query("x13_subject_statistics", """SELECT role, count(DISTINCT conv_id) AS n_threads, count(*) AS n_turns FROM conversations GROUP BY 1""")
def _(t):
    per = t.conversations.groupBy("role", "conv_id").agg(F.count("*").alias("c"))
    return per.groupBy("role").agg(F.count("*").alias("n_threads"), F.sum("c").alias("n_turns"))


@query("x13_top_users", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 10")
def _(t):
    return agg.frequency(t.events, ["user_id"]).orderBy(F.desc("n"), "user_id").limit(10)


@query("x13_hour_weekday_table", "SELECT hour(ts) AS hour, " + ", ".join(f"count(*) FILTER (isodow(ts) = {d + 1}) AS day_{d}" for d in range(7)) + " FROM events GROUP BY 1")
def _(t):
    return agg.crosstab(t.events.select(F.hour("ts").alias("hour"), F.weekday("ts").alias("weekday")), "hour", "weekday", range(7), "day_")


# --- retrieval: one query vector per label (its mean), one keyword query per language ------------------

_CENTROIDS = """c AS (SELECT label AS query_id, i AS d, avg(embedding[i]::DOUBLE) AS m FROM embeddings, (SELECT unnest(generate_series(1, 64)) AS i) GROUP BY 1, 2),
q AS (SELECT query_id, list(m ORDER BY d) AS v FROM c GROUP BY 1),
dist AS (SELECT query_id, vec_id, label, list_distance(CAST(embedding AS DOUBLE[]), v) AS distance, list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) AS cosine FROM embeddings, q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM dist) """
DIMS = 64


def centroids(t):
    """Mean vector per label: one row per label whatever the number of vectors."""
    means = t.embeddings.groupBy(F.col("label").alias("query_id")).agg(
        *[F.avg(F.col("embedding")[i].cast("double")).alias(f"m{i}") for i in range(DIMS)])
    return means.select("query_id", F.array(*[f"m{i}" for i in range(DIMS)]).alias("embedding"))


@query("x14_vector_search", "WITH " + _CENTROIDS + "SELECT query_id, vec_id, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 5")
def _(t):
    return rounded(rt.nearest(t.embeddings, centroids(t), 5), "distance")


def indexed(t):
    """An index of all vectors, and as queries every vector whose id is divisible by 50."""
    index = vi.build(t.embeddings, n_lists=128)
    return index, t.embeddings.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query("x14_indexed_search")
def _(t):
    index, asked = indexed(t)
    return rounded(vi.search(index, asked, 5, probes=48), "distance")


@query("x14_index_recall")
def _(t):
    """Recall of the indexed search against the exact one, and the share of vectors it compares by code."""
    index, asked = indexed(t)
    asked = materialise(asked, "asked")
    found, truth = vi.search(index, asked, 5, probes=48), rt.nearest(t.embeddings, asked, 5)
    share = vi.compared(index, asked, probes=48).select(F.round(F.col("compared") / F.col("of"), 4)).scalar()
    return vi.recall(found, truth).withColumn("share_compared", share)


@query("x17_rerank", "WITH " + _CENTROIDS + "SELECT query_id, vec_id, round(cosine, 6) AS rerank_score, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id) AS new_rank FROM ranked WHERE rank <= 10")
def _(t):
    found = rt.nearest(t.embeddings, centroids(t), 10)
    pairs = found.join(t.embeddings.select("vec_id", F.col("embedding").alias("v")), "vec_id").join(
        centroids(t).withColumnRenamed("embedding", "q"), "query_id")
    cosine = dot(F.col("v"), F.col("q")) / (norm(F.col("v")) * norm(F.col("q")))
    return rounded(rt.rerank(pairs, cosine).select("query_id", "vec_id", "rerank_score", "new_rank"), "rerank_score")


@query("e11_ranking_quality", "WITH " + _CENTROIDS + """, r AS (SELECT query_id, rank, CASE WHEN label = query_id THEN 1 ELSE 0 END AS rel FROM ranked WHERE rank <= 10),
i AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rel DESC, rank) AS ideal FROM r),
s AS (SELECT query_id, sum(rel) / 10.0::DOUBLE AS p, sum(rel) / any_value((SELECT count(*) FROM embeddings e WHERE e.label = i.query_id))::DOUBLE AS rc, sum((pow(2, rel) - 1) / log2(rank + 1)) AS dcg, sum((pow(2, rel) - 1) / log2(ideal + 1)) AS idcg FROM i GROUP BY 1)
SELECT query_id, round(p, 6) AS "precision", round(rc, 6) AS recall, round(coalesce(2 * p * rc / nullif(p + rc, 0), 0), 6) AS f1, round(coalesce(dcg / nullif(idcg, 0), 0), 6) AS ndcg FROM s""")
def _(t):
    found = rt.nearest(t.embeddings, centroids(t), 10).join(t.embeddings.select("vec_id", "label"), "vec_id")
    rel = found.withColumn("rel", (F.col("label") == F.col("query_id")).cast("int"))
    totals = t.embeddings.groupBy(F.col("label").alias("query_id")).agg(F.count("*").alias("n_relevant"))
    return rounded(ev.ranking_quality(rel, totals, "query_id", "rank", "rel", 10), "precision", "recall", "f1", "ndcg")


_BM25 = f"""tok AS (SELECT doc_id, lang, unnest({_WORDS}) AS term FROM documents),
qt AS (SELECT query_id, term FROM (SELECT lang AS query_id, term, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, term) AS r FROM tok WHERE length(term) >= 4 GROUP BY 1, 2) WHERE r <= 3),
len AS (SELECT doc_id, len({_WORDS}) AS n_tokens FROM documents), st AS (SELECT count(*) AS n, avg(n_tokens) AS avg_len FROM len),
post AS (SELECT term, doc_id, count(*) AS tf FROM tok GROUP BY 1, 2), df AS (SELECT term, count(*) AS df FROM post GROUP BY 1),
sc AS (SELECT query_id, p.doc_id AS id, sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n_tokens / avg_len))) AS score
FROM qt JOIN post p USING (term) JOIN df USING (term) JOIN len USING (doc_id), st GROUP BY 1, 2),
kw AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM sc) """


def keyword_queries(counted):
    """The three most frequent longer words of each language."""
    terms = counted.select(F.col("lang").alias("query_id"), F.inline("terms")).filter(
        F.length("term") >= 4).groupBy("query_id", "term").agg(F.sum("tf").alias("n"))
    w = Window.partitionBy("query_id").orderBy(F.desc("n"), "term")
    return terms.withColumn("r", F.row_number().over(w)).filter("r <= 3").select("query_id", "term")


def asked_index(t):
    """Stored postings and lengths of the documents, and the terms asked for."""
    counted = rt.count_terms(t.documents, ["doc_id", "lang"], tx.words(F.col("text")))
    postings, lengths = rt.build_index(counted, "doc_id")
    return postings, lengths, materialise(keyword_queries(counted), "asked")


@query("x15_keyword_search", "WITH " + _BM25 + "SELECT query_id, id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM kw WHERE rank <= 5")
def _(t):
    return rounded(rt.keyword_search(*asked_index(t), 5).select("query_id", "id", "score", "rank"), "score")


_LANG_CENTROIDS = """lc AS (SELECT lang AS query_id, i AS d, avg(embedding[i]::DOUBLE) AS m FROM embeddings JOIN documents ON doc_id = vec_id, (SELECT unnest(generate_series(1, 64)) AS i) GROUP BY 1, 2),
lq AS (SELECT query_id, list(m ORDER BY d) AS v FROM lc GROUP BY 1),
dn AS (SELECT query_id, vec_id AS id, row_number() OVER (PARTITION BY query_id ORDER BY list_distance(CAST(embedding AS DOUBLE[]), v), vec_id) AS rank FROM embeddings, lq) """


@query("x16_hybrid_search", "WITH " + _BM25 + "," + _LANG_CENTROIDS + """, f AS (SELECT coalesce(a.query_id, b.query_id) AS query_id, coalesce(a.id, b.id) AS id,
coalesce(1.0::DOUBLE / (60 + a.rank), 0) + coalesce(1.0::DOUBLE / (60 + b.rank), 0) AS score FROM kw a FULL JOIN dn b ON a.query_id = b.query_id AND a.id = b.id)
SELECT query_id, id, round(score, 9) AS score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, id) AS rank FROM f) WHERE rank <= 5""")
def _(t):
    # documents and vectors share ids; a language asks with its most frequent words and with the mean of its vectors
    known = t.documents.select(F.col("doc_id").alias("vec_id"), F.col("lang").alias("query_id")).join(t.embeddings, "vec_id")
    means = known.groupBy("query_id").agg(*[F.avg(F.col("embedding")[i].cast("double")).alias(f"m{i}") for i in range(DIMS)])
    asked = means.select("query_id", F.array(*[f"m{i}" for i in range(DIMS)]).alias("embedding"))
    out = rt.hybrid_search(rt.keyword_scores(*asked_index(t)), t.embeddings.select("vec_id", "embedding"), asked, 5)
    return out.select("query_id", "id", F.round("score", 9).alias("score"), "rank")


_R8 = f"""WITH tok AS (SELECT doc_id, unnest({_WORDS}) AS word FROM documents), voc AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) - 1 AS idx FROM tok GROUP BY 1),
vv AS (SELECT word, embedding AS v FROM voc JOIN embeddings ON vec_id = idx), m AS (SELECT doc_id, avg(v[1]::DOUBLE) AS a, avg(v[2]::DOUBLE) AS b, avg(v[64]::DOUBLE) AS z FROM tok JOIN vv USING (word) GROUP BY 1)
SELECT doc_id, round(coalesce(a, 0), 6) AS v_first, round(coalesce(b, 0), 6) AS v_second, round(coalesce(z, 0), 6) AS v_last FROM documents LEFT JOIN m USING (doc_id)"""


@query("r8_mean_word_vectors", _R8)
def _(t):
    docs = materialise(t.documents.select("doc_id", tx.words(F.col("text")).alias("w")), "tokens")
    by_count = with_position(tx.word_frequency(docs, "w"), [F.desc("n"), "word"], name="vec_id")
    vocabulary = by_count.join(t.embeddings, "vec_id").select("word", F.col("embedding").alias("vector"))
    v = rt.mean_word_vectors(docs, "doc_id", "w", vocabulary, DIMS)
    return v.select("doc_id", *[F.round(F.col("vector")[i], 6).alias(n) for i, n in ((0, "v_first"), (1, "v_second"), (63, "v_last"))])


@query("ud4_embedding_table", """SELECT doc_id, CAST(length(text) AS DOUBLE) AS chars, CAST(len(regexp_extract_all(text, '\\p{Lu}')) AS DOUBLE) AS capitals, CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS spaces
FROM (SELECT DISTINCT doc_id, text FROM documents)""")
def _(t):
    def character_profile(texts):
        return [[len(x), sum(map(str.isupper, x)), x.count(" ")] for x in texts]

    made = rt.embed_texts(t.documents, "doc_id", "text", character_profile, 3)
    return made.select("doc_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(("chars", "capitals", "spaces"))])
