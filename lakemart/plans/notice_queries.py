"""Catalogue of the notice queries over ``documents``, with their ANSI twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import minhash as M
from lakemart.functions import sets as S
from lakemart.functions import text as X
from lakemart.operators import cards, clusters, lsh, similarity
from lakemart.operators.corpus import build_corpus
from lakemart.operators.quantiles import exact_percentiles
from lakemart.plans import notices as N
from lakemart.sources import lake
from lakemart.sources import tables as T
from lakemart.workspace import durable

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

PERCENT = N.SIMILAR_PERCENT


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# --- shared pieces of the ANSI twins -------------------------------------------------------------------

def tok_sql(text: str) -> str:
    return f"tok AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower({text}), '[a-z0-9]+') AS t FROM documents)"


TOK_SQL = tok_sql("text")


def _runs(k: int) -> str:
    return " || ' ' || ".join(f"t[i + {j}]" if j else "t[i]" for j in range(k))


def shingle_sql(k: int, name: str = "sh", source: str = "tok") -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT DISTINCT doc_id, {_runs(k)} AS s FROM {source}, unnest(range(1, len(t) - {k} + 2)) AS g(i) WHERE len(t) >= {k}
  UNION SELECT DISTINCT doc_id, w FROM {source}, unnest(t) AS g(w) WHERE len(t) < {k})"""


SH_SQL = TOK_SQL + "," + shingle_sql(3)

GROUPS_SQL = SH_SQL + """,
keyed AS (SELECT doc_id, sha256(string_agg(s, '|' ORDER BY s)) AS content, count(*) AS n FROM sh GROUP BY doc_id),
member AS MATERIALIZED (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY content) AS group_id FROM keyed),
grp AS MATERIALIZED (SELECT group_id, count(*) AS n_docs, min(n) AS n FROM member GROUP BY group_id),
gsh AS MATERIALIZED (SELECT doc_id AS group_id, s FROM sh WHERE doc_id IN (SELECT group_id FROM grp))"""

NEAR_SQL = GROUPS_SQL + f""",
shared AS (SELECT a.group_id AS group_a, b.group_id AS group_b, count(*) AS shared
           FROM gsh a JOIN gsh b ON a.s = b.s AND a.group_id < b.group_id GROUP BY 1, 2),
near AS MATERIALIZED (
  SELECT group_a, group_b, shared, shared / (a.n + b.n - shared) AS jaccard, a.n_docs * b.n_docs AS doc_pairs
  FROM shared JOIN grp a ON a.group_id = group_a JOIN grp b ON b.group_id = group_b
  WHERE shared * 100 >= {PERCENT} * (a.n + b.n - shared)),
truth AS (SELECT group_a, group_b, jaccard, doc_pairs FROM near
          UNION ALL SELECT group_id, group_id, 1.0, n_docs * (n_docs - 1) // 2 FROM grp WHERE n_docs > 1)"""

COEF_SQL = "coef(i, a, b) AS (VALUES " + ", ".join(
    f"({i}, {a}, {b})" for i, (a, b) in enumerate(M.coefficients())
) + ")"


def _sig(source: str, key: str) -> str:
    return f"""
hashed AS MATERIALIZED (SELECT DISTINCT {key}, CAST('0x' || substr(sha256(s), 1, 8) AS BIGINT) % {M.PRIME} AS h FROM {source}),
{COEF_SQL},
sig AS MATERIALIZED (SELECT {key}, i, min((h * a + b) % {M.PRIME}) AS m FROM hashed, coef GROUP BY {key}, i)"""


BANDS_SQL = GROUPS_SQL + "," + _sig("gsh", "group_id") + f""",
band AS MATERIALIZED (
  SELECT group_id, n_docs, i // {M.ROWS} AS band_id,
         CAST('0x' || substr(sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY i)), 1, 15) AS BIGINT) AS bucket_hash
  FROM sig JOIN grp USING (group_id) GROUP BY group_id, n_docs, i // {M.ROWS}),
bucket AS MATERIALIZED (SELECT band_id, bucket_hash, count(*) AS groups, sum(n_docs) AS docs FROM band GROUP BY 1, 2)"""

PAIRS_SQL = SH_SQL + "," + _sig("sh", "doc_id") + """,
opening AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY string_split(text, chr(10))[1]) AS first_id FROM documents),
pairs AS (SELECT a.doc_id AS doc_a, a.doc_id + 1 AS doc_b FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1
          UNION SELECT first_id, doc_id FROM opening WHERE first_id < doc_id),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
inter AS (SELECT doc_a, doc_b, count(*) AS shared FROM pairs JOIN sh x ON x.doc_id = doc_a
          JOIN sh y ON y.doc_id = doc_b AND x.s = y.s GROUP BY 1, 2),
agree AS (SELECT doc_a, doc_b, sum(CAST(x.m = y.m AS INTEGER)) / 128 AS estimate
          FROM pairs JOIN sig x ON x.doc_id = doc_a JOIN sig y ON y.doc_id = doc_b AND x.i = y.i GROUP BY 1, 2),
scored AS MATERIALIZED (
  SELECT doc_a, doc_b, a.n AS n_a, b.n AS n_b, coalesce(shared, 0) AS shared,
         coalesce(shared, 0) / (a.n + b.n - coalesce(shared, 0)) AS jaccard, estimate
  FROM pairs JOIN sizes a ON a.doc_id = doc_a JOIN sizes b ON b.doc_id = doc_b
  LEFT JOIN inter USING (doc_a, doc_b) JOIN agree USING (doc_a, doc_b))"""

CLUSTER_SQL = NEAR_SQL + """,
edge AS (SELECT group_a AS u, group_b AS v FROM near UNION ALL SELECT group_b, group_a FROM near),
walk(node, seen) AS (SELECT group_id, group_id FROM grp UNION SELECT node, v FROM walk JOIN edge ON seen = u),
cluster AS (SELECT node AS group_id, min(seen) AS cluster_id FROM walk GROUP BY node),
clustered AS (SELECT doc_id, cluster_id FROM member JOIN cluster USING (group_id))"""

BAND_CASE = (
    "CAST(CASE WHEN jaccard < 0.2 THEN 0.0 WHEN jaccard < 0.5 THEN 0.2 WHEN jaccard < 0.8 THEN 0.5 ELSE 0.8 END AS DOUBLE)"
)


# --- tokens, cleaning, shingles ------------------------------------------------------------------------

@query(r"""
SELECT doc_id, CAST(len(a) AS INTEGER) AS tokens, CAST(len(list_distinct(a)) AS INTEGER) AS distinct_tokens,
       CAST(len(u) AS INTEGER) AS unicode_words
FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS a,
             regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS u FROM documents)""")
def raw_token_stats(spark: SparkSession, folder: str) -> DataFrame:
    return N.documents(spark, folder).select(
        "doc_id", X.tokens(F.col("text")).alias("a"), X.tokens(F.col("text"), X.UNICODE_WORD).alias("u")
    ).select(
        "doc_id", F.size("a").alias("tokens"), F.size(F.array_distinct("a")).alias("distinct_tokens"),
        F.size("u").alias("unicode_words"),
    )


def _re2(rules, source: str) -> str:
    """The rules as nested RE2 replacements: a look-ahead becomes a kept group, a word start likewise."""
    text = source
    for rule in rules:
        if rule.title:
            continue
        pattern, replacement = rule.pattern.replace("'", "''"), rule.replacement
        if r"(?=(Name of work:|$))" in pattern:
            pattern, replacement = pattern.replace(r"(?=(Name of work:|$))", r"(Name of work:|$)"), r"\1"
        if pattern.startswith(r"\b"):
            pattern, replacement = r"(^|[^\p{L}\p{N}_])" + pattern[2:].replace("(", "(?:", 1), r"\1" + replacement
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'gi')"
    return text


def _re2_text(rules, joiner: str) -> str:
    title, rest = "string_split(text, chr(10))[1]", r"regexp_replace(text, '^[^\n]*\n?', '')"
    for rule in rules:
        if rule.title:
            title = f"regexp_replace({title}, '{rule.pattern}', '{rule.replacement}', 'gi')"
    return _re2(rules, f"({title} || '{joiner}' || {rest})")


_CLEANINGS = (
    ("raw", X.RAW_RULES, " "), ("standard", X.STANDARD_RULES, " "), ("body", X.BODY_RULES, " "),
    ("blocks", X.BLOCK_RULES, "\n"), ("strict", X.STRICT_RULES, " "),
)


@query("SELECT doc_id, " + ", ".join(
    f"CAST(len(regexp_extract_all(lower({_re2_text(rules, joiner)}), '[a-z0-9]+')) AS INTEGER) AS {name}_tokens"
    for name, rules, joiner in _CLEANINGS
) + " FROM documents")
def clean_token_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens left by each set of cleaning rules."""
    split = N.title_and_body(N.documents(spark, folder))
    return split.select("doc_id", *[
        F.size(X.tokens(X.cleaned(F.col("title"), F.col("body"), rules, joiner))).alias(f"{name}_tokens")
        for name, rules, joiner in _CLEANINGS
    ])


@query(f"""
WITH {TOK_SQL}, {shingle_sql(1, "s1")}, {shingle_sql(2, "s2")}, {shingle_sql(3, "s3")},
folded AS (SELECT doc_id, regexp_replace(lower(text), '\\s+', ' ', 'g') AS f FROM documents),
letters AS MATERIALIZED (SELECT doc_id, f, string_split(f, '') AS t FROM folded),
chars AS (SELECT DISTINCT doc_id, {_runs(9).replace(" || ' ' || ", " || ")} AS s
          FROM letters, unnest(range(1, len(t) - 7)) AS g(i) WHERE len(t) >= 9
          UNION SELECT doc_id, f FROM letters WHERE len(t) < 9),
n1 AS (SELECT doc_id, count(*) AS c FROM s1 GROUP BY 1), n2 AS (SELECT doc_id, count(*) AS c FROM s2 GROUP BY 1),
n3 AS (SELECT doc_id, count(*) AS c FROM s3 GROUP BY 1), n9 AS (SELECT doc_id, count(*) AS c FROM chars GROUP BY 1)
SELECT doc_id, CAST(coalesce(n1.c, 0) AS INTEGER) AS word_1, CAST(coalesce(n2.c, 0) AS INTEGER) AS word_2,
       CAST(coalesce(n3.c, 0) AS INTEGER) AS word_3, CAST(n9.c AS INTEGER) AS char_9
FROM tok LEFT JOIN n1 USING (doc_id) LEFT JOIN n2 USING (doc_id) LEFT JOIN n3 USING (doc_id) JOIN n9 USING (doc_id)""")
def shingle_counts(spark: SparkSession, folder: str) -> DataFrame:
    words = N.documents(spark, folder).select("doc_id", X.folded(F.col("text")).alias("folded"), X.tokens(F.col("text")).alias("words"))
    return words.select(
        "doc_id", *[S.distinct_spans(F.col("words"), k).alias(f"word_{k}") for k in (1, 2, 3)],
        S.distinct_letter_runs(F.col("folded"), 9).alias("char_9"),
    )


# --- similarity ----------------------------------------------------------------------------------------

@query(f"""
WITH {PAIRS_SQL}
SELECT doc_a, doc_b, CAST(shared AS INTEGER) AS shared, jaccard, CASE WHEN least(n_a, n_b) > 0 THEN shared / least(n_a, n_b) ELSE 0.0 END AS containment
FROM scored""")
def jaccard_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return N.scored_neighbours(spark, folder).select("doc_a", "doc_b", "shared", "jaccard", "containment")


_REPR = {
    "title": "string_split(text, chr(10))[1]",
    "head": "substr(text, 1, 1500)",
    "full": "text",
    "clean": _re2_text(X.STRICT_RULES, " "),
}


def _repr_sql(name: str) -> str:
    return (
        f"tok_{name} AS (SELECT doc_id, regexp_extract_all(lower({_REPR[name]}), '[a-z0-9]+') AS t FROM documents),"
        + shingle_sql(2, f"sh_{name}", f"tok_{name}")
        + f""",
j_{name} AS (
  SELECT '{name}' AS representation, coalesce(shared, 0) / nullif(coalesce(a.n, 0) + coalesce(b.n, 0) - coalesce(shared, 0), 0) AS j
  FROM pairs LEFT JOIN (SELECT doc_id, count(*) AS n FROM sh_{name} GROUP BY 1) a ON a.doc_id = doc_a
  LEFT JOIN (SELECT doc_id, count(*) AS n FROM sh_{name} GROUP BY 1) b ON b.doc_id = doc_b
  LEFT JOIN (SELECT doc_a, doc_b, count(*) AS shared FROM pairs JOIN sh_{name} x ON x.doc_id = doc_a
             JOIN sh_{name} y ON y.doc_id = doc_b AND x.s = y.s GROUP BY 1, 2) USING (doc_a, doc_b))"""
    )


@query(
    "WITH opening AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY string_split(text, chr(10))[1]) AS first_id FROM documents),"
    " pairs AS (SELECT a.doc_id AS doc_a, a.doc_id + 1 AS doc_b FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1"
    " UNION SELECT first_id, doc_id FROM opening WHERE first_id < doc_id), "
    + ", ".join(_repr_sql(name) for name in _REPR)
    + ", every AS (" + " UNION ALL ".join(f"SELECT representation, coalesce(j, 0.0) AS j FROM j_{name}" for name in _REPR)
    + """)
SELECT representation, count(*) AS pairs, min(j) AS minimum, quantile_cont(j, 0.1) AS p10, quantile_cont(j, 0.5) AS median,
       quantile_cont(j, 0.9) AS p90, max(j) AS maximum
FROM every GROUP BY representation"""
)
def repr_compare(spark: SparkSession, folder: str) -> DataFrame:
    """How title, opening, whole text and cleaned text separate the same pairs (2-word shingles)."""
    docs = N.title_and_body(N.documents(spark, folder))
    texts = {
        "title": F.col("title"), "head": F.substring("text", 1, 1500), "full": F.col("text"),
        "clean": X.cleaned(F.col("title"), F.col("body"), X.STRICT_RULES),
    }
    words = docs.select("doc_id", *[F.array_join(X.tokens(text), " ").alias(name) for name, text in texts.items()])
    sets = durable(words, "representations")
    a, b = (sets.select(*[F.col(c).alias(f"{c}_{side}") for c in sets.columns]) for side in "ab")
    pairs = N.neighbour_pairs(N.documents(spark, folder)).withColumnsRenamed({"doc_a": "doc_id_a", "doc_b": "doc_id_b"})
    joined = pairs.join(a, "doc_id_a").join(b, "doc_id_b")
    long = joined.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("representation"), S.jaccards(F.col(f"{name}_a"), F.col(f"{name}_b"), (2,))[0].alias("j"))
        for name in texts
    ])).alias("r")).select("r.*")
    found = exact_percentiles(long, ["representation"], "j", {"p10": 0.1, "median": 0.5, "p90": 0.9})
    return found.select(
        "representation", F.col("count").alias("pairs"), "minimum", "p10", "median", "p90", "maximum"
    )


_BY_K = (1, 2, 3)
#: Pairs of one first notice that meet under one join key.
LANE_PAIRS = 1024


@query(
    f"WITH {tok_sql(_re2_text(X.STRICT_RULES, ' '))}, "
    "opening AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY string_split(text, chr(10))[1]) AS first_id FROM documents),"
    " pairs AS (SELECT first_id AS doc_a, doc_id AS doc_b, 'same' AS label FROM opening WHERE first_id < doc_id"
    " UNION ALL SELECT a.doc_id, b.doc_id, 'different' FROM opening a JOIN opening b ON b.doc_id = a.doc_id + 1"
    " WHERE a.first_id <> b.first_id), "
    + ", ".join(shingle_sql(k, f"sh_{k}") for k in _BY_K) + ", every AS ("
    + " UNION ALL ".join(f"""
SELECT label, {k} AS k, coalesce(shared / nullif(coalesce(a.n, 0) + coalesce(b.n, 0) - shared, 0), 0.0) AS j
FROM (SELECT doc_a, doc_b, label, count(y.s) AS shared FROM pairs LEFT JOIN sh_{k} x ON x.doc_id = doc_a
      LEFT JOIN sh_{k} y ON y.doc_id = doc_b AND x.s = y.s GROUP BY ALL)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM sh_{k} GROUP BY 1) a ON a.doc_id = doc_a
LEFT JOIN (SELECT doc_id, count(*) AS n FROM sh_{k} GROUP BY 1) b ON b.doc_id = doc_b""" for k in _BY_K)
    + """)
SELECT label, k, count(*) AS pairs, min(j) AS minimum, quantile_cont(j, 0.1) AS p10, quantile_cont(j, 0.5) AS median,
       quantile_cont(j, 0.9) AS p90, max(j) AS maximum
FROM every GROUP BY label, k"""
)
def similarity_by_label_and_k(spark: SparkSession, folder: str) -> DataFrame:
    """How shingles of one, two and three words separate pairs of one opening line from neighbours that have another.

    Texts are read, cleaned and cut into words once; each pair is met once for all lengths, and all percentiles come from one
    ranking of the pairs' values.
    """
    docs = N.title_and_body(N.documents(spark, folder))
    words = docs.select("doc_id", F.xxhash64("title").alias("opening"), F.array_join(X.tokens(X.cleaned(F.col("title"), F.col("body"), X.STRICT_RULES)), " ").alias("words"))
    held = durable(words, "words")
    ids = held.select("doc_id", "opening")
    first = ids.where(F.col("opening").isNotNull()).groupBy("opening").agg(
        F.min("doc_id").alias("doc_a"), F.ceil(F.count("*") / LANE_PAIRS).alias("lanes")
    )
    same = ids.join(first, "opening").where(F.col("doc_a") < F.col("doc_id")).select(
        "doc_a", F.col("doc_id").alias("doc_b"), F.lit("same").alias("label"), F.pmod("doc_id", "lanes").alias("lane")
    )
    following = ids.select((F.col("doc_id") - 1).alias("doc_a"), F.col("doc_id").alias("doc_b"), F.col("opening").alias("next_opening"))
    different = ids.withColumnRenamed("doc_id", "doc_a").join(following, "doc_a").where(F.col("opening") != F.col("next_opening")).select(
        "doc_a", "doc_b", F.lit("different").alias("label"), F.lit(0).cast("bigint").alias("lane")
    )
    a, b = (held.drop("opening").select(*[F.col(c).alias(f"{c}_{side}") for c in ("doc_id", "words")]) for side in "ab")
    lanes = first.select(F.col("doc_a").alias("doc_id_a"), "lanes")  # a first notice goes to as many lanes as its pairs fill
    a = a.join(lanes, "doc_id_a", "left").withColumn("lane", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("lanes", F.lit(1)) - 1)))
    pairs = same.unionByName(different).withColumnsRenamed({"doc_a": "doc_id_a", "doc_b": "doc_id_b"})
    met = pairs.join(a, ["doc_id_a", "lane"]).join(b, "doc_id_b").select("label", S.jaccards(F.col("words_a"), F.col("words_b"), _BY_K).alias("js"))
    long = met.select("label", F.posexplode("js").alias("at", "j")).select("label", (F.col("at") + _BY_K[0]).alias("k"), "j")
    found = exact_percentiles(long, ["label", "k"], "j", {"p10": 0.1, "median": 0.5, "p90": 0.9})
    return found.select("label", "k", F.col("count").alias("pairs"), "minimum", "p10", "median", "p90", "maximum")


@query(f"WITH {NEAR_SQL} SELECT group_a, group_b, jaccard, doc_pairs FROM truth")
def exact_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair at or above the threshold, identical copies folded into counts."""
    corpus = build_corpus(N.documents(spark, folder))
    return similarity.near_duplicates(corpus.groups, similarity.similar_groups(corpus.group_sets, PERCENT, corpus.sets))


# --- MinHash -------------------------------------------------------------------------------------------

@query(f"WITH {SH_SQL}, {_sig('sh', 'doc_id')} SELECT doc_id, CAST(i AS INTEGER) AS position, CAST(m AS INTEGER) AS value FROM sig")
def minhash_signature(spark: SparkSession, folder: str) -> DataFrame:
    words = N.documents(spark, folder).select("doc_id", X.tokens(F.col("text")).alias("words"))
    sets = words.select("doc_id", X.word_shingles(F.col("words"), 3).alias("shingles"))
    signed = sets.select("doc_id", M.signature(M.shingle_hashes(F.col("shingles"))).alias("signature"))
    return signed.select("doc_id", F.posexplode_outer("signature").alias("position", "value"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(f"""
WITH {PAIRS_SQL}, err AS (SELECT estimate - jaccard AS e FROM scored)
SELECT count(*) AS pairs, round(avg(e), 6) AS bias, round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse,
       round(stddev_pop(e), 6) AS std, round(max(abs(e)), 6) AS max_abs FROM err""")
def minhash_error(spark: SparkSession, folder: str) -> DataFrame:
    summary = lsh.error_summary(N.scored_neighbours(spark, folder))
    return _rounded(summary, "bias", "mae", "rmse", "std", "max_abs")


@query(f"""
WITH {PAIRS_SQL}
SELECT {BAND_CASE} AS band, count(*) AS pairs, round(sqrt(avg((estimate - jaccard) * (estimate - jaccard))), 6) AS rmse,
       round(sqrt(avg(jaccard) * (1 - avg(jaccard)) / 128), 6) AS theory
FROM scored GROUP BY 1""")
def minhash_error_bands(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(lsh.error_by_band(N.scored_neighbours(spark, folder)), "rmse", "theory")


# --- LSH -----------------------------------------------------------------------------------------------

@query(f"""
WITH {BANDS_SQL}
SELECT CAST(band_id AS INTEGER) AS band_id, count(*) AS buckets, CAST(sum(docs) AS BIGINT) AS docs,
       CAST(max(docs) AS BIGINT) AS largest_bucket
FROM bucket GROUP BY band_id""")
def lsh_bands(spark: SparkSession, folder: str) -> DataFrame:
    corpus = build_corpus(N.documents(spark, folder))
    return lsh.bucket_sizes(lsh.band_rows(corpus.groups)).groupBy("band_id").agg(
        F.count("*").alias("buckets"), F.sum("docs").alias("docs"), F.max("docs").alias("largest_bucket")
    )


LOW_CAP = 10


@query(f"""
WITH {BANDS_SQL},
docband AS (SELECT doc_id, band_id, bucket_hash, docs FROM band JOIN member USING (group_id) JOIN bucket USING (band_id, bucket_hash))
SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b, 'pair' AS kind
FROM docband a JOIN docband b ON a.band_id = b.band_id AND a.bucket_hash = b.bucket_hash AND a.doc_id < b.doc_id
WHERE a.docs <= {LOW_CAP}
UNION ALL
SELECT DISTINCT h.head, d.doc_id, 'bucket'
FROM docband d JOIN (SELECT band_id, bucket_hash, min(doc_id) AS head FROM docband WHERE docs > {LOW_CAP} GROUP BY 1, 2) h
  ON d.band_id = h.band_id AND d.bucket_hash = h.bucket_hash AND d.doc_id > h.head""")
def lsh_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate pairs; buckets above a cap of ten notices are listed as buckets."""
    corpus = build_corpus(N.documents(spark, folder))
    return lsh.candidate_pairs(lsh.band_rows(corpus.groups), corpus.members, LOW_CAP)


@query(f"""
WITH {BANDS_SQL}
SELECT CAST(band_id AS INTEGER) AS band_id, bucket_hash, CAST(docs AS BIGINT) AS docs FROM bucket
ORDER BY docs DESC, band_id, bucket_hash LIMIT 15""")
def bucket_top(spark: SparkSession, folder: str) -> DataFrame:
    corpus = build_corpus(N.documents(spark, folder))
    return lsh.largest_buckets(lsh.band_rows(corpus.groups), 15)


@query(f"""
WITH {BANDS_SQL},
top AS (SELECT band_id, bucket_hash, docs FROM bucket ORDER BY docs DESC, band_id, bucket_hash LIMIT 1)
SELECT source, count(*) AS docs, round(count(*) / max(top.docs) * 100, 1) AS pct
FROM top JOIN band USING (band_id, bucket_hash) JOIN member USING (group_id) JOIN documents USING (doc_id) GROUP BY source""")
def bucket_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    corpus = build_corpus(N.documents(spark, folder))
    return lsh.bucket_mix(lsh.band_rows(corpus.groups), corpus.members, N.documents(spark, folder), "source")


def _load_sql(stage: str, cap: str) -> str:
    return f"""
SELECT '{stage}' AS stage, count(*) AS notices, avg(load) AS mean, quantile_cont(load, 0.5) AS median, quantile_cont(load, 0.95) AS p95,
       quantile_cont(load, 0.99) AS p99, CAST(max(load) AS BIGINT) AS max, CAST(sum(load) // 2 AS BIGINT) AS total_comparisons
FROM (SELECT doc_id, CAST(sum(CASE WHEN {cap} THEN docs - 1 ELSE 0 END) AS BIGINT) AS load
      FROM band JOIN bucket USING (band_id, bucket_hash) JOIN member USING (group_id) GROUP BY doc_id)"""


@query(f"WITH {BANDS_SQL} {_load_sql('before', 'TRUE')} UNION ALL {_load_sql('after', f'docs <= {LOW_CAP}')}")
def candidate_load(spark: SparkSession, folder: str) -> DataFrame:
    """Comparisons per notice with and without the bucket cap."""
    bands = lsh.band_rows(build_corpus(N.documents(spark, folder)).groups)
    return lsh.load_summary(lsh.candidate_load(bands), "before").unionByName(
        lsh.load_summary(lsh.candidate_load(bands, LOW_CAP), "after")
    )


@query(
    f"SELECT * FROM (WITH {BANDS_SQL} {_load_sql('raw text', 'TRUE')}) UNION ALL SELECT * FROM (WITH "
    + BANDS_SQL.replace(TOK_SQL, tok_sql(_re2_text(X.STANDARD_RULES, " ")))
    + f" {_load_sql('cleaned text, capped', f'docs <= {lsh.BUCKET_CAP}')})"
)
def skew_mitigation(spark: SparkSession, folder: str) -> DataFrame:
    """The same load on raw text without a cap and on cleaned text with one."""
    docs = N.title_and_body(N.documents(spark, folder))
    raw = lsh.band_rows(build_corpus(docs).groups)
    clean = lsh.band_rows(build_corpus(
        docs, rules=X.STANDARD_RULES, title=F.col("title"), body_col="body"
    ).groups)
    return lsh.load_summary(lsh.candidate_load(raw), "raw text").unionByName(
        lsh.load_summary(lsh.candidate_load(clean, lsh.BUCKET_CAP), "cleaned text, capped")
    )


@query(f"""
WITH {BANDS_SQL}, {NEAR_SQL[len(GROUPS_SQL) + 1:]},
usable AS (SELECT group_id, band_id, bucket_hash, docs FROM band JOIN bucket USING (band_id, bucket_hash)),
hit AS (SELECT t.group_a, t.group_b, doc_pairs, min(a.docs) AS docs FROM truth t JOIN usable a ON a.group_id = t.group_a
        JOIN usable b ON b.group_id = t.group_b AND a.band_id = b.band_id AND a.bucket_hash = b.bucket_hash GROUP BY ALL),
sums AS (SELECT CAST((SELECT sum(doc_pairs) FROM truth) AS BIGINT) AS truth, CAST((SELECT sum(doc_pairs) FROM hit) AS BIGINT) AS hits,
                CAST((SELECT sum(doc_pairs) FROM hit WHERE docs <= {LOW_CAP}) AS BIGINT) AS capped_hits)
SELECT truth, hits, hits / truth AS recall, capped_hits, capped_hits / truth AS capped_recall FROM sums""")
def lsh_recall(spark: SparkSession, folder: str) -> DataFrame:
    """Share of all true pairs that the buckets retrieve, and beside it the share that small buckets would."""
    corpus = build_corpus(N.documents(spark, folder))
    truth = similarity.near_duplicates(corpus.groups, similarity.similar_groups(corpus.group_sets, PERCENT, corpus.sets))
    truth = durable(truth, "true-pairs")
    capped = lsh.recall(truth, corpus.groups, LOW_CAP).select("truth", F.col("hits").alias("capped_hits"), F.col("recall").alias("capped_recall"))
    return lsh.recall(truth, corpus.groups).join(capped, "truth")


_VERIFIED_SQL = f"""
WITH {BANDS_SQL}, {NEAR_SQL[len(GROUPS_SQL) + 1:]},
colliding AS (SELECT DISTINCT a.group_id AS group_a, b.group_id AS group_b
              FROM band a JOIN band b ON a.band_id = b.band_id AND a.bucket_hash = b.bucket_hash AND a.group_id < b.group_id)"""


@query(f"""{_VERIFIED_SQL}
SELECT group_a, group_b, jaccard, a.n_chars = b.n_chars AS same_value
FROM near JOIN colliding USING (group_a, group_b) JOIN documents a ON a.doc_id = group_a JOIN documents b ON b.doc_id = group_b""")
def verified_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates confirmed by exact Jaccard, and whether their parsed value agrees; a cap of four forces the exact path."""
    notices = N.documents(spark, folder)
    corpus = build_corpus(notices)
    values = notices.select("doc_id", "n_chars")
    return (
        lsh.verified_pairs(corpus.groups, corpus.sets, PERCENT, cap=4)
        .join(values.select(F.col("doc_id").alias("group_a"), F.col("n_chars").alias("value_a")), "group_a")
        .join(values.select(F.col("doc_id").alias("group_b"), F.col("n_chars").alias("value_b")), "group_b")
        .select("group_a", "group_b", "jaccard", (F.col("value_a") == F.col("value_b")).alias("same_value"))
    )


_LABELLED_SQL = f"""
WITH {PAIRS_SQL},
labelled AS (SELECT *, CASE WHEN jaccard >= {PERCENT / 100} THEN 'same' ELSE 'different' END AS label FROM scored)"""


@query(f"{_LABELLED_SQL} SELECT doc_a, doc_b, jaccard FROM labelled WHERE label = 'same' AND jaccard < 0.9")
def low_same_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs labelled the same that share less than nine tenths."""
    return similarity.low_similarity(N.scored_neighbours(spark, folder), 0.9).select("doc_a", "doc_b", "jaccard")


@query(f"""{_LABELLED_SQL}
SELECT doc_a, doc_b, a.source AS portal, jaccard
FROM labelled JOIN documents a ON a.doc_id = doc_a JOIN documents b ON b.doc_id = doc_b
WHERE label = 'different' AND a.source = b.source""")
def same_portal_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Different notices on one portal, where shared boilerplate would show."""
    pairs = similarity.same_portal(N.scored_neighbours(spark, folder), N.documents(spark, folder), "source")
    return pairs.select("doc_a", "doc_b", F.col("source_a").alias("portal"), "jaccard")


@query(f"""{_LABELLED_SQL}
SELECT label, count(*) AS pairs, avg(CAST(a.n_chars = b.n_chars AS INTEGER)) AS match_rate
FROM labelled JOIN documents a ON a.doc_id = doc_a JOIN documents b ON b.doc_id = doc_b GROUP BY label""")
def value_match_rate(spark: SparkSession, folder: str) -> DataFrame:
    """How often the parsed value agrees, per label."""
    return similarity.match_rate(N.scored_neighbours(spark, folder), N.documents(spark, folder), "n_chars")


_SWEEP_SQL = f"""
WITH {PAIRS_SQL},
labelled AS (SELECT estimate, CASE WHEN jaccard >= 0.8 THEN 'same' ELSE 'different' END AS label FROM scored)
SELECT CAST(t AS INTEGER) AS threshold_pct, count(*) FILTER (estimate >= t / 100.0 AND label = 'different') AS false_merges,
       count(*) FILTER (estimate < t / 100.0 AND label = 'same') AS misses,
       count(*) FILTER (estimate >= t / 100.0 AND label = 'different') * 100
       + count(*) FILTER (estimate < t / 100.0 AND label = 'same') AS cost
FROM labelled, range(50, 100, 5) AS r(t) GROUP BY t"""


@query(_SWEEP_SQL)
def cost_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return lsh.cost_sweep(N.scored_neighbours(spark, folder), tuple(range(50, 100, 5)))


@query(f"SELECT * FROM ({_SWEEP_SQL}) ORDER BY cost, threshold_pct DESC LIMIT 1")
def operating_point(spark: SparkSession, folder: str) -> DataFrame:
    """The cheapest threshold of the sweep."""
    return lsh.operating_point(cost_sweep(spark, folder))


def _calibration_sql(b: int, r: int) -> str:
    return f"""
SELECT {b} AS bands, {r} AS rows, {BAND_CASE} AS band, count(*) AS pairs,
       round(avg(1.0 - pow(1.0 - pow(jaccard, {r}), {b})), 6) AS predicted, round(avg(CAST(hit AS INTEGER)), 6) AS observed
FROM (SELECT doc_a, doc_b, jaccard, max(whole) AS hit
      FROM (SELECT doc_a, doc_b, jaccard, bool_and(x.m = y.m) AS whole
            FROM scored JOIN sig x ON x.doc_id = doc_a JOIN sig y ON y.doc_id = doc_b AND x.i = y.i
            GROUP BY doc_a, doc_b, jaccard, x.i // {r}) GROUP BY ALL)
GROUP BY 3"""


@query(f"WITH {PAIRS_SQL} " + " UNION ALL ".join(_calibration_sql(b, r) for b, r in M.BAND_CONFIGS))
def survival_calibration(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(lsh.survival_calibration(N.scored_neighbours(spark, folder)), "predicted", "observed")


@query()
def bucket_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """One bucket read from bands laid out by bucket and from an unordered copy: rows, files and bytes."""
    corpus = build_corpus(N.documents(spark, folder))
    bands = lsh.notice_bands(lsh.band_rows(corpus.groups), corpus.members)
    return lake.lookup_report(bands, lsh.largest_buckets(lsh.band_rows(corpus.groups), 1).first())


# --- clusters and cards --------------------------------------------------------------------------------

@query(f"WITH RECURSIVE {CLUSTER_SQL} SELECT doc_id, cluster_id FROM clustered")
def dup_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return N.exact_clusters(build_corpus(N.documents(spark, folder)))


@query(f"""
WITH RECURSIVE {CLUSTER_SQL}
SELECT doc_id, cluster_id FROM clustered WHERE cluster_id IN (SELECT cluster_id FROM clustered GROUP BY 1 HAVING count(*) >= 3)""")
def larger_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Notices of clusters of at least three."""
    return clusters.larger_clusters(N.exact_clusters(build_corpus(N.documents(spark, folder))), 3)


@query(f"""
WITH RECURSIVE {CLUSTER_SQL},
per AS (SELECT cluster_id, count(*) AS size, count(DISTINCT n_chars) AS vals, count(DISTINCT source) AS kinds
        FROM clustered JOIN documents USING (doc_id) GROUP BY 1)
SELECT size, count(*) AS clusters, CAST(sum(size) AS BIGINT) AS notices, CAST(sum(size * (size - 1) // 2) AS BIGINT) AS duplicate_pairs,
       count(*) FILTER (vals > 1) AS value_conflicts, count(*) FILTER (kinds > 2) AS mixed_clusters
FROM per GROUP BY size""")
def cluster_profile(spark: SparkSession, folder: str) -> DataFrame:
    notices = N.documents(spark, folder)
    clustered = N.exact_clusters(build_corpus(notices)).join(notices.select("doc_id", "source", "n_chars"), "doc_id")
    return clusters.cluster_profile(clustered, value="n_chars", archetype="source")


@query(f"""
WITH RECURSIVE {CLUSTER_SQL},
per AS (SELECT cluster_id, count(*) AS size FROM clustered GROUP BY 1),
sums AS (SELECT CAST(sum(size) AS BIGINT) AS notices, CAST(sum(size * (size - 1) // 2) AS BIGINT) AS duplicate_pairs FROM per)
SELECT *, duplicate_pairs / (CAST(notices AS DOUBLE) * (notices - 1) / 2) AS base_rate FROM sums""")
def duplicate_base_rate(spark: SparkSession, folder: str) -> DataFrame:
    notices = N.documents(spark, folder)
    clustered = N.exact_clusters(build_corpus(notices)).join(notices.select("doc_id", "source", "n_chars"), "doc_id")
    return clusters.base_rate(clusters.cluster_profile(clustered, value="n_chars", archetype="source"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def portal_counts(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.value_counts(N.documents(spark, folder), "source")


N_NIGHTS = 3


def night_of(notices: DataFrame) -> DataFrame:
    """Sources arrive on three nights; by the last one all notices are there."""
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    return notices.select("doc_id", (F.coalesce(number, F.lit(0)) % N_NIGHTS + 1).alias("night"))


def _history(spark: SparkSession, folder: str) -> N.CardHistory:
    notices = N.documents(spark, folder)
    return N.replay_cards(build_corpus(notices), night_of(notices), N_NIGHTS)


# A card is named after the smallest notice of its cluster on the night on which the cluster first had one.
_CARDS_SQL = f"""
WITH RECURSIVE {BANDS_SQL}, {NEAR_SQL[len(GROUPS_SQL) + 1:]},
colliding AS (SELECT DISTINCT a.group_id AS group_a, b.group_id AS group_b
              FROM band a JOIN band b ON a.band_id = b.band_id AND a.bucket_hash = b.bucket_hash AND a.group_id < b.group_id),
kept AS (SELECT group_a, group_b FROM near JOIN colliding USING (group_a, group_b)),
edge AS (SELECT group_a AS u, group_b AS v FROM kept UNION ALL SELECT group_b, group_a FROM kept),
walk(node, seen) AS (SELECT group_id, group_id FROM grp UNION SELECT node, v FROM walk JOIN edge ON seen = u),
cluster AS (SELECT node AS group_id, min(seen) AS cluster_id FROM walk GROUP BY node),
arrived AS (SELECT doc_id, cluster_id, CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) % {N_NIGHTS} + 1 AS night
            FROM member JOIN cluster USING (group_id) JOIN documents USING (doc_id)),
named AS (SELECT cluster_id, arg_min(doc_id, night * 1000000000000 + doc_id) AS canonical FROM arrived GROUP BY 1)"""


@query(f"{_CARDS_SQL} SELECT doc_id, cluster_id FROM arrived")
def notice_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """The nightly job from texts to clusters: sketches, buckets, exact verification, components."""
    return N.run_notices(N.documents(spark, folder)).clusters


@query(f"{_CARDS_SQL} SELECT doc_id, 'CARD-' || canonical AS card_id FROM arrived JOIN named USING (cluster_id)")
def cards_after_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """Which card each notice is on after three nights of a growing corpus."""
    return _history(spark, folder).state.mapping.select(F.col("notice_id").alias("doc_id"), "card_id")


# A card was issued on the night on which a cluster of what had arrived by then was all new; it is named after the cluster's
# smallest notice and leads to the card of the cluster it is in at the end.
def _issued_sql() -> str:
    nights = ""
    for k in range(1, N_NIGHTS + 1):
        nights += f""",
here{k} AS MATERIALIZED (SELECT group_id FROM since WHERE night <= {k}),
edge{k} AS MATERIALIZED (SELECT u, v FROM edge WHERE u IN (SELECT group_id FROM here{k}) AND v IN (SELECT group_id FROM here{k})),
walk{k}(node, seen) AS (SELECT group_id, group_id FROM here{k} UNION SELECT node, v FROM walk{k} JOIN edge{k} ON seen = u),
comp{k} AS (SELECT node AS group_id, min(seen) AS c FROM walk{k} GROUP BY node),
card{k} AS (SELECT min(doc_id) AS canonical FROM comp{k} JOIN docs USING (group_id) WHERE night <= {k} GROUP BY c HAVING min(night) = {k})"""
    return f"""{_CARDS_SQL},
docs AS MATERIALIZED (SELECT member.doc_id, group_id, night FROM member JOIN arrived USING (doc_id)),
since AS MATERIALIZED (SELECT group_id, min(night) AS night FROM docs GROUP BY 1){nights},
issued AS ({" UNION ALL ".join(f"SELECT canonical FROM card{k}" for k in range(1, N_NIGHTS + 1))}),
led AS MATERIALIZED (
  SELECT i.canonical AS old, n.canonical AS active, m.members FROM issued i JOIN arrived a ON a.doc_id = i.canonical
  JOIN named n USING (cluster_id) JOIN (SELECT cluster_id, count(*) AS members FROM arrived GROUP BY 1) m USING (cluster_id))"""


@query(f"{_issued_sql()} SELECT 'CARD-' || old AS deprecated_card_id, 'CARD-' || active AS active_card_id FROM led WHERE old != active")
def card_redirects(spark: SparkSession, folder: str) -> DataFrame:
    """Cards that merged into older ones over three nights, and where they lead."""
    ends = clusters.follow(_history(spark, folder).state.redirects, "deprecated_card_id", "active_card_id")
    return ends.select(F.col("node").alias("deprecated_card_id"), F.col("cluster").alias("active_card_id"))


@query(f"""{_issued_sql()}
SELECT 'CARD-' || old AS card_id, 'CARD-' || active AS active_card_id, active AS canonical_notice_id, members FROM led""")
def card_resolution(spark: SparkSession, folder: str) -> DataFrame:
    """Every card ever handed out, as bookmarks: the card it leads to today, its canonical notice and its size."""
    history = _history(spark, folder)
    return cards.resolve(history.state, history.issued.select("card_id").distinct())
