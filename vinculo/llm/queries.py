"""The registered queries: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculo.llm import (
    alignment,
    bpe,
    decontaminate,
    language,
    line_chunks,
    recompression,
    resampling,
    search,
    secrets,
    simhash,
    suffix_dedup,
    token_files,
    url_models,
)
from vinculo.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its own name, with its SQL if there is one."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, radius=3)


@query()
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10)
    hit = F.aggregate("spans", F.lit(0), lambda total, span: total + span["high"] - span["low"]).cast("long")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query()
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.train(docs.where(~language.held_out()))
    return language.predict(docs, model).withColumn("held_out", language.held_out()).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


# Stated without names or chunks: two lines go if the same two stand earlier, with the blank lines between them.
_LINE_CHUNKS_SQL = f"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
        FROM documents
    ), solid AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM lines WHERE regexp_matches(line, '{line_chunks.SOLID}')
    ), pairs AS (
        SELECT CAST(doc_id AS HUGEINT) * {line_chunks.ROOM} + k AS place, doc_id, i AS start, lead(i) OVER w AS stop,
               line || chr(10) || lead(line) OVER w AS body
        FROM solid WINDOW w AS (PARTITION BY doc_id ORDER BY k)
    ), late AS (
        SELECT doc_id, start, stop FROM pairs WHERE stop IS NOT NULL QUALIFY place > min(place) OVER (PARTITION BY body) + 1
    ), gone AS (
        SELECT DISTINCT doc_id, unnest(range(start, stop + 1)) AS i FROM late
    ), kept AS (
        SELECT doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
               coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS text
        FROM lines l LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id
    )
    SELECT d.doc_id, k.text, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
    FROM documents d LEFT JOIN kept k USING (doc_id)
"""


@query(_LINE_CHUNKS_SQL)
def op3_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_chunks.remove_repeated(docs)


@query()
def op1_recompression(spark: SparkSession, folder: str) -> DataFrame:
    kept = recompression.remove_repeats(table(spark, folder, "documents"), window=13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# Rules are (host, path); every url is judged.
URL_RULES = (
    url_models.Rule("allow", "org", "/"),
    url_models.Rule("block", "example.org", "/es/"),
    url_models.Rule("block", "example.org", "/en/1"),
    url_models.Rule("allow", "com", "/fr/"),
    url_models.Rule("block", "com", "/de/"),
)


def _url_models_sql() -> str:
    """The same models over the same n-grams, one common table expression per order."""
    rules = sorted(URL_RULES, key=lambda r: -len(r.name))
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in rules]
    names = " ".join(f"WHEN {test} THEN '{r.name}'" for r, test in zip(rules, fits, strict=True))
    labels = " ".join(f"WHEN {test} THEN '{r.verdict}'" for r, test in zip(rules, fits, strict=True))
    order, bins = url_models.ORDER, url_models.MOST_BINS
    steps = []
    for k in range(order + 1):
        before = f"p{k - 1}" if k else f"(SELECT gram, {1.0 / url_models.LETTERS!r}::DOUBLE AS a, {1.0 / url_models.LETTERS!r}::DOUBLE AS b FROM counts)"
        steps.append(f"""
        seen{k} AS (SELECT right(gram, {k + 1}) AS tail, sum(a) AS a, sum(b) AS b FROM counts WHERE a + b > 0 GROUP BY 1),
        contexts{k} AS (
            SELECT left(tail, {k}) AS context, sum(a) AS a, sum(b) AS b, count(*) FILTER (a > 0) AS ka, count(*) FILTER (b > 0) AS kb
            FROM seen{k} GROUP BY 1
        ),
        p{k} AS (
            SELECT p.gram,
                   CASE WHEN c.ka > 0 THEN (coalesce(s.a, 0) + c.ka * p.a) / (c.a + c.ka) ELSE p.a END AS a,
                   CASE WHEN c.kb > 0 THEN (coalesce(s.b, 0) + c.kb * p.b) / (c.b + c.kb) ELSE p.b END AS b
            FROM {before} p LEFT JOIN seen{k} s ON s.tail = right(p.gram, {k + 1})
            LEFT JOIN contexts{k} c ON c.context = left(right(p.gram, {k + 1}), {k})
        )""")
    return f"""
    WITH parts AS (
        SELECT page_id, coalesce(url, '') AS url, row_number() OVER () AS row,
               CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) END AS rest FROM pages
    ), split AS (
        SELECT page_id, url, row, coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), '{url_models.UPPER}', '{url_models.LOWER}'), '') AS host,
               coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts
    ), rows AS (
        SELECT *, CASE {names} END AS rule, CASE {labels} END AS label,
               CAST('0x' || substr(md5(url), 1, 8) AS BIGINT) % {url_models.FOLDS} = 0 AS aside FROM split
    ), spelt AS (
        SELECT row, CASE WHEN NOT aside THEN label END AS label, unnest(list_transform(range(1, length(url) + 2),
               lambda i: substring(repeat(chr(2), {order}) || url || chr(3), i, {order + 1}))) AS gram FROM rows
    ), counts AS (
        SELECT gram, count(*) FILTER (label = 'allow') AS a, count(*) FILTER (label = 'block') AS b FROM spelt GROUP BY 1
    ), {",".join(steps)}, scores AS (
        SELECT row, sum(ln(a) - ln(b)) / count(*) AS score FROM spelt JOIN p{order} USING (gram) GROUP BY row
    ), binned AS (
        SELECT r.*, greatest(-{bins}, least({bins}, CAST(floor(round(score, 9) * {url_models.BINS_PER_UNIT}) AS INTEGER))) AS bin
        FROM rows r JOIN scores USING (row)
    ), histogram AS (
        SELECT bin, count(*) FILTER (label = 'allow') AS a, count(*) FILTER (label = 'block') AS b FROM binned WHERE label IS NOT NULL AND aside GROUP BY 1
    ), cuts AS (
        SELECT bin, CAST(floor((bin + coalesce(lag(bin) OVER (ORDER BY bin), bin) + 1) / 2.0) AS INTEGER) AS middle,
               (sum(a) OVER (ORDER BY bin DESC)) * (sum(b) OVER ()) + (sum(b) OVER (ORDER BY bin) - b) * (sum(a) OVER ()) AS value,
               sum(a) OVER () AS alls, sum(b) OVER () AS blls
        FROM histogram
    ), threshold AS (
        SELECT coalesce((SELECT CASE WHEN alls > 0 AND blls > 0 THEN middle ELSE 0 END FROM cuts ORDER BY value DESC, bin LIMIT 1), 0) AS cut
    )
    SELECT page_id, host, path, rule,
           coalesce(label, CASE WHEN bin >= (SELECT cut FROM threshold) THEN 'allow' ELSE 'block' END) AS verdict
    FROM binned
    """


@query(_url_models_sql())
def op7_url_models(spark: SparkSession, folder: str) -> DataFrame:
    return url_models.judge(table(spark, folder, "pages"), URL_RULES).drop("score")


@query()
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, folder, "documents"), length=50)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, folder, "documents"), target, public_tokenizers.path("byte_bpe_50k.json"), end=0)
    return token_files.read_documents(spark, target)


_SEARCH_SQL = """
    WITH words AS (
        SELECT doc_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS term
        FROM documents
    ), postings AS (
        SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
    ), lengths AS (
        SELECT doc_id, sum(tf) AS dl FROM postings GROUP BY 1
    ), facts AS (
        SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(dl) FROM lengths) / (SELECT count(*) FROM documents) AS average
    ), weights AS (
        SELECT term, ln(1 + ((SELECT n FROM facts) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM postings GROUP BY 1
    ), impacts AS (
        SELECT doc_id, term,
               CAST(round_even(idf * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * (dl / (SELECT average FROM facts))))) * 1e9, 0) AS BIGINT) AS part
        FROM postings JOIN weights USING (term) JOIN lengths USING (doc_id)
    ), scores AS (
        SELECT q.doc_id AS query_id, d.doc_id, sum(d.part) AS units
        FROM postings q JOIN impacts d USING (term) WHERE q.doc_id % 50 = 0 GROUP BY ALL
    )
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY units DESC, doc_id) AS rank, doc_id, units / 1e9::DOUBLE AS score
    FROM scores QUALIFY rank <= 10
"""


@query(_SEARCH_SQL)
def op2_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.top_documents(table(spark, folder, "documents"), F.col("doc_id") % 50 == 0, k=10)


@query()
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.link_statistics(table(spark, folder, "documents"), *paths)


# CRC-32 by its polynomial, over the bytes of every distinct word.
_RESAMPLING_SQL = """
    WITH RECURSIVE texts AS (
        SELECT 0 AS side, doc_id, row_number() OVER () AS row, text FROM documents
        UNION ALL SELECT 1, NULL, row_number() OVER (), text FROM benchmark
    ), words AS (
        SELECT side, row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts
    ), distinct_words AS (
        SELECT DISTINCT word FROM words
    ), codes(n, step, code) AS (
        SELECT n, 0, n FROM (SELECT unnest(range(256)) AS n)
        UNION ALL SELECT n, step + 1, CASE WHEN code % 2 = 1 THEN xor(code // 2, 3988292384) ELSE code // 2 END FROM codes WHERE step < 8
    ), lookup AS (
        SELECT list(code ORDER BY n) AS codes FROM codes WHERE step = 8
    ), hashed AS (
        SELECT word, xor(list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(word))),
                       lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT))),
                   lambda c, b: xor(c // 256, codes[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket
        FROM distinct_words, lookup
    ), features AS (
        SELECT side, row, bucket, count(*) AS n FROM words JOIN hashed USING (word) GROUP BY ALL
    ), buckets AS (
        SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t FROM features GROUP BY 1
    ), totals AS (
        SELECT sum(s) AS s, sum(t) AS t FROM buckets
    ), gains AS (
        SELECT bucket, CAST(floor(1000 * ln((b.t + 1) * (totals.s + 10000) / ((b.s + 1) * (totals.t + 10000)))) AS BIGINT) AS gain FROM buckets b, totals
    ), weights AS (
        SELECT row, sum(n) AS n, sum(n * gain) AS weight FROM features JOIN gains USING (bucket) WHERE side = 0 GROUP BY 1
    ), scores AS (
        SELECT doc_id, row, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
               CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
        FROM texts LEFT JOIN weights USING (row) WHERE side = 0
    ), places AS (
        SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= 20) OVER () AS eligible FROM scores
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= (10 * eligible) // 100 THEN place END AS rank FROM places
"""


@query(_RESAMPLING_SQL)
def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs, target = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return resampling.resample(docs, target, longest=1, buckets=10_000, least_words=20, percent=10, seed=2024)


@query()
def op13_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda x: x["kind"].isin(*kinds))

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.STRONG]
    return found.select("doc_id", *counts, F.sha2(written(of(*secrets.STRONG)), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
