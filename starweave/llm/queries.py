"""Registered queries over the given tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.llm import (
    embeddings, exact, lines, mixing, packing, periodic, pii, simhash, spelling, substrings, tokens, toxicity, warc,
)
from starweave.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return keep


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Where the box has a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_simhash_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"), shingle=4, most_bits=4)


#: DuckDB: base32 of the SHA-1 in hexadecimal ``h``, four characters for five digits.
SQL_BASE32 = " || ".join(
    "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"((('0x' || substr(h, {at}, 5))::INTEGER >> {shift}) & 31) + 1, 1)"
    for at in range(1, 41, 5)
    for shift in (15, 10, 5, 0)
)


@register(
    "op2_warc_revisits",
    """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS h FROM p),
    w AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM d)
    SELECT page_id, payload_bytes,
           BASE32 AS payload_digest,
           CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
    FROM w
    """.replace("BASE32", SQL_BASE32),
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.archive(table(spark, sf_dir, "pages"), path)
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(.*)>$', 1) as long)")
    responses = warc.read(spark, path).where("record_type = 'response'")
    revisits = warc.read(spark, path, payload=False).where("record_type = 'revisit'")
    return responses.select(
        number("record_id").alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"),
        warc.base32(F.sha1("payload")).alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"),
    ).union(
        revisits.select(number("record_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to"))
    )


@register("op3_personal_data")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.personal_data(docs, pii.train(docs))


@register("op4_embedding_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_dedup(table(spark, sf_dir, "embeddings"), threshold=0.9)


@register(
    "op5_substring_dedup",
    r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS s, len(w) AS n FROM d),
    k AS (
      SELECT *, CASE WHEN s + 19 <= n THEN string_agg(word, ' ') OVER (
               PARTITION BY doc_id ORDER BY s ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) END AS win
      FROM u),
    r AS (
      SELECT *, CASE WHEN win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, s) > 1
               THEN 1 ELSE 0 END AS rep FROM k),
    c AS (
      SELECT *, max(rep) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM r),
    a AS (
      SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed,
             string_agg(word, ' ' ORDER BY s) FILTER (gone = 0) AS kept
      FROM c GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN a USING (doc_id)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"), width=20)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@register("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), vocabulary())


@register("op7_harmonic_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), end=2, capacity=4096)


#: Texts that score this much or more are toxic.
TOXIC = 0.3


@register("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )


@register(
    "op9_source_mix",
    r"""
    WITH d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             ((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT)::DOUBLE + 0.5)
               / 4503599627370496.0 AS u
      FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    w AS (
      SELECT *, 2.0::DOUBLE * source_size AS cap,
             [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT]::DOUBLE AS weight
      FROM s),
    r AS (SELECT *, cap / weight AS ratio FROM w),
    v AS (
      SELECT *, row_number() OVER o AS nth,
             (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM r WINDOW o AS (ORDER BY ratio, source IS NULL, encode(source))),
    g AS (
      SELECT source, source_size,
             least(cap, weight * (SELECT level FROM v WHERE level <= ratio ORDER BY nth LIMIT 1)) AS target
      FROM v),
    b AS (
      SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS base FROM g),
    t AS (SELECT *, target - base * source_size AS rest FROM b),
    h AS (SELECT source, size, count(*) AS n FROM d GROUP BY source, size),
    c AS (
      SELECT h.source, size, rest,
             coalesce(sum(size * n) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS above,
             sum(size * size * n) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS squares
      FROM h JOIN t ON h.source IS NOT DISTINCT FROM t.source WINDOW o AS (PARTITION BY h.source ORDER BY size DESC)),
    k AS (
      SELECT source, arg_max((rest - above) / squares, size) AS scale
      FROM c WHERE squares > 0 AND (rest - above) / squares * size <= 1 GROUP BY source),
    p AS (
      SELECT d.doc_id, d.source, d.size, d.u, t.source_size, t.target, t.base, t.rest,
             least(1.0::DOUBLE, coalesce(k.scale, 0) * d.size) AS p
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source),
    q AS (
      SELECT doc_id, source, size, rest, (u / (1 - u)) * ((1 - p) / p) AS q FROM p WHERE p > 0),
    m AS (
      SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY q, doc_id NULLS LAST, size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE + size / 2.0::DOUBLE AS middle
      FROM q),
    x AS (SELECT DISTINCT doc_id, source, size FROM m WHERE middle <= rest)
    SELECT p.doc_id, p.size, p.source_size, p.target,
           (p.size * (p.base + CASE WHEN x.size IS NULL THEN 0 ELSE 1 END))::BIGINT AS taken
    FROM p LEFT JOIN x ON p.doc_id IS NOT DISTINCT FROM x.doc_id AND p.source IS NOT DISTINCT FROM x.source AND p.size = x.size
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


@register(
    "op10_exact_dedup",
    r"""
    WITH d AS (
      SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@register(
    "op11_line_dedup",
    r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
    u AS (SELECT r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM d),
    k AS (
      SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM u),
    f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
    m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
    SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY r, doc_id
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.line_dedup(table(spark, sf_dir, "documents"), least_docs=10, least_chars=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@register(
    "op12_spelling_variants",
    r"""
    WITH RECURSIVE crc_table AS (
      SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                              lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
      FROM (SELECT unnest(range(256)) AS i)),
    d AS (
      SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
    r AS (
      SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
      FROM d GROUP BY ALL),
    b AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM r WHERE length(run) >= 5),
    h AS (
      SELECT run, n, xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i::INT, 2))::BIGINT)),
               lambda c, v: xor(c // 256, t[(xor(c, v) % 256 + 1)::INT]))) AS h
      FROM b, crc_table),
    w AS (
      SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word,
             sum(n)::BIGINT AS n
      FROM h GROUP BY 1 HAVING sum(n) >= 3),
    v AS (SELECT * FROM w WHERE length(word) >= 5),
    s AS (
      SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i, left(word, i - 1) || substr(word, i + 1) AS rest FROM v),
    p AS (
      SELECT a.word, b.word AS other, b.n AS other_n FROM s a JOIN s b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM s a JOIN v b ON a.rest = b.word
      UNION SELECT b.word, a.word, a.n FROM s a JOIN v b ON a.rest = b.word),
    q AS (
      SELECT word, count(*) AS n_near, max(other_n) AS most, arg_min(encode(other), (-other_n, encode(other))) AS best FROM p GROUP BY word),
    f AS (
      SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near,
             CASE WHEN most >= 2 * v.n THEN decode(best) END AS form, CASE WHEN most >= 2 * v.n THEN most END AS form_n
      FROM v LEFT JOIN q USING (word)),
    c AS (
      SELECT word, word AS root, 0 AS steps FROM f
      UNION ALL SELECT c.word, f.form, steps + 1 FROM c JOIN f ON c.root = f.word WHERE f.form IS NOT NULL)
    SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n
    FROM f JOIN (SELECT word, arg_max(root, steps) AS root FROM c GROUP BY word) e USING (word)
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), least_chars=5, least_count=3, drop_every=97)
    return spelling.spelling_variants(words)


@register(
    "op13_periodic_runs",
    r"""
    WITH crc_table AS (
      SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                              lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
      FROM (SELECT unnest(range(256)) AS i)),
    d AS (
      SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(doc_id::VARCHAR, ''))) AS x,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    h AS (
      SELECT r, doc_id, w, len(w)::BIGINT AS n, xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i::INT, 2))::BIGINT)),
               lambda c, v: xor(c // 256, t[(xor(c, v) % 256 + 1)::INT]))) AS h
      FROM d, crc_table),
    a AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a FROM h),
    e AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
    k AS (
      SELECT r, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[(a + (i - a) % p + 1)::INT] ELSE w[i + 1] END AS word
      FROM (SELECT *, unnest(range(n::INT)) AS i FROM e)),
    q AS (SELECT x.r, x.i, y.i - x.i AS p FROM k x JOIN k y ON x.r = y.r AND x.word = y.word AND y.i > x.i),
    o AS (SELECT *, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM q),
    s AS (
      SELECT r, p, min(i) AS start, count(*) + p AS length FROM o
      GROUP BY r, p, island HAVING count(*) + p >= greatest(12, 2 * p)),
    u AS (SELECT r, start, length, min(p) AS period FROM s GROUP BY r, start, length),
    c AS (SELECT r, start + period AS i, 1 AS v FROM u UNION ALL SELECT r, start + length, -1 FROM u UNION ALL SELECT r, i, 0 FROM k),
    g AS (
      SELECT DISTINCT r, i, sum(v) OVER (PARTITION BY r ORDER BY i RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > 0 AS gone FROM c),
    t AS (
      SELECT k.r, string_agg(word, ' ' ORDER BY k.i) FILTER (NOT gone) AS kept
      FROM k JOIN g ON k.r = g.r AND k.i = g.i GROUP BY k.r),
    z AS (
      SELECT r, count(*) AS n_runs, arg_min({'start': start, 'length': length, 'period': period}, (-length, start, period)) AS b,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS all_runs
      FROM u GROUP BY r)
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length,
           b.period::BIGINT AS period, (1000 * b.length // b.period)::BIGINT AS exponent_milli,
           sha256(coalesce(all_runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM h LEFT JOIN z USING (r) LEFT JOIN t USING (r)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), least=12, lay=True)
    # the longest run; of several the one with the smallest start, then period
    best = F.expr("array_min(transform(runs, r -> struct(-r.length as less, r.start as start, r.period as period)))")
    lines = F.expr("transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", (-F.col("best.less")).alias("length"),
        "best.period", F.expr("-1000 * best.less div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
