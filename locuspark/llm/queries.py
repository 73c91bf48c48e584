"""Registered queries of the operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.llm.common import shared_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return add


_LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op1_decontaminate", f"""
WITH D AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(x="coalesce(text, '')")} AS w FROM documents),
B AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS.format(x="coalesce(text, '')")} AS w FROM benchmark),
BW AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS win
       FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM B WHERE len(w) > 0)),
L AS (SELECT DISTINCT n FROM BW),
DW AS (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM D, L WHERE len(w) >= n)),
H AS (SELECT d.r, d.s, d.n, b.item FROM DW d JOIN BW b ON d.n = b.n AND d.win = b.win),
C AS (SELECT r, count(DISTINCT p) AS n_hit
      FROM (SELECT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, s, n FROM H)) GROUP BY r),
I AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item FROM H) GROUP BY r)
SELECT D.doc_id, CAST(len(D.w) AS BIGINT) AS n_words, CAST(coalesce(C.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(I.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(I.items, '')) AS items_sha256,
       coalesce(C.n_hit, 0) > 0 AND 20 * coalesce(C.n_hit, 0) >= len(D.w) AS contaminated
FROM D LEFT JOIN C USING (r) LEFT JOIN I USING (r)""")
def op1(spark, d):
    from locuspark.llm.decontaminate import decontaminate
    return decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark")).drop("items", "row_key")


@query("op2_exact_dedup", f"""
WITH D AS (SELECT doc_id, {_LOWER.format(x="coalesce(text, '')")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, CAST(count(*) OVER (PARTITION BY t) AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM D""")
def op2(spark, d):
    from locuspark.llm.exact_dedup import exact_dedup
    return exact_dedup(table(spark, d, "documents"), keep="max")


@query("op6_simhash")
def op6(spark, d):
    from locuspark.llm.simhash import simhash_near_dedup
    return simhash_near_dedup(table(spark, d, "documents")).drop("keep")


@query("op9_substring_dedup", r"""
WITH D AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
S AS (SELECT r, s, array_to_string(w[s:s + 34], ' ') AS win
      FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM D WHERE len(w) >= 35)),
X AS (SELECT r, s FROM S WHERE win IN (SELECT win FROM S GROUP BY win HAVING count(*) > 1)),
C AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM X),
P AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM D),
K AS (SELECT P.r, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
      FROM P ANTI JOIN C ON P.r = C.r AND P.p = C.p GROUP BY P.r)
SELECT D.doc_id, CAST(len(D.w) AS BIGINT) AS n_words, CAST(len(D.w) - coalesce(K.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(K.kept, '')) AS kept_sha256
FROM D LEFT JOIN K USING (r)""")
def op9(spark, d):
    from locuspark.llm.substring_dedup import substring_dedup
    return substring_dedup(table(spark, d, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


_B32 = "array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', " \
       "CAST((('0x' || substr(sha1(h), CAST(i // 4 * 5 + 1 AS BIGINT), 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS BIGINT)) " \
       "& 31 AS BIGINT) + 1, 1)), '')"


@query("op10_warc", f"""
WITH P AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
G AS (SELECT page_id, h, min(page_id) OVER (PARTITION BY h) AS m FROM P)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, {_B32} AS payload_digest,
       CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> m THEN m END AS refers_to
FROM G""")
def op10(spark, d):
    from locuspark.llm.warc import read_archive, record_index, write_archive
    path = shared_path(spark, "warc")
    write_archive(table(spark, d, "pages"), path)
    return record_index(read_archive(spark, path))


def held_out():
    """crc32 of the id as text, modulo 5, is 0; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


@query("op8_toxicity")
def op8(spark, d):
    from locuspark.llm.toxicity import toxicity
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    scored = toxicity(docs.select("doc_id", "text"), labels.where(~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("_tox_score").alias("score"),
                         (F.col("_tox_score") >= 0.5).cast("int").alias("predicted"), "_tox_evidence")


@query("op5_langid")
def op5(spark, d):
    from locuspark.llm.langid import identify
    return identify(table(spark, d, "documents"), held_out())


@query("op4_secrets")
def op4(spark, d):
    from locuspark.llm.secret_scan import secret_spans
    found = secret_spans(table(spark, d, "documents"))
    base = F.filter("spans", lambda x: x["kind"] != "model")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


OLD_SHARDS, SHARDS = 16, 16


def old_shard():
    """The layout to mend: each source was hashed to one of 16 shards."""
    return F.pmod(F.crc32(F.coalesce("source", F.lit(""))), F.lit(OLD_SHARDS))


@query("op7_resharding")
def op7(spark, d):
    from locuspark.llm.sharding import reshard, with_slots
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    new = reshard(docs, old_shard(), SHARDS)
    text = F.coalesce("text", F.lit(""))
    slim = new.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                      F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"), "shard")
    return with_slots(slim).withColumn("grown_shard", F.lit(None).cast("int"))


def domain():
    """Four domains by the number in the source's name; "other" without one."""
    number = F.regexp_extract("source", r"([0-9]+)", 1)
    names = F.array(*[F.lit(x) for x in ("web", "reference", "forum", "news")])
    return F.when(number != "", F.element_at(names, (F.substring(number, -2, 2).cast("int") % 4 + 1).cast("int"))
                  ).otherwise("other")


def mix_target(max_epochs: int = 2):
    from locuspark.llm.mixing import Mix
    return Mix(domains={"web": 4, "reference": 3, "forum": 2, "news": 1}, langs={"en": 5, "de": 2, "fr": 2, "es": 1},
               sources={}, max_epochs=max_epochs)


def _fill_sql(name: str, parent: str, nodes: str) -> str:
    """Split ``budget`` among children of one parent by weight, none above its capacity."""
    return f"""{name}0 AS ({nodes}),
{name}1 AS (SELECT *, sum(cap) OVER o - cap AS used, sum(w) OVER (PARTITION BY {parent}) - sum(w) OVER o + w AS rest
  FROM {name}0 WINDOW o AS (PARTITION BY {parent} ORDER BY cap / w::DOUBLE, nm ROWS UNBOUNDED PRECEDING)),
{name}2 AS (SELECT *, cap::HUGEINT * rest <= (budget - used)::HUGEINT * w AS is_full FROM {name}1),
{name}3 AS (SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER (PARTITION BY {parent}) AS taken,
  sum(CASE WHEN is_full THEN 0 ELSE w END) OVER (PARTITION BY {parent}) AS op FROM {name}2),
{name} AS (SELECT * EXCLUDE (budget), CAST(CASE WHEN is_full THEN cap
  ELSE (budget - taken)::HUGEINT * w // op END AS BIGINT) AS budget FROM {name}3)"""


_H60 = "('0x' || substr(md5(concat_ws(':', '42', CAST({e} AS VARCHAR), CAST(doc_id AS VARCHAR))), 1, 15))::BIGINT"


@query("op3_mixing", rf"""
WITH D AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)', 1) = '' THEN 'other'
       ELSE ['web', 'reference', 'forum', 'news'][right(regexp_extract(source, '([0-9]+)', 1), 2)::INT % 4 + 1] END AS domain,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n FROM documents),
L AS (SELECT domain, lang, source, CAST(sum(n) AS BIGINT) AS tokens FROM D GROUP BY ALL),
{_fill_sql("T", "root", '''SELECT 0 AS root, domain, domain AS nm, sum(tokens) * 2 AS cap,
  CASE domain WHEN 'web' THEN 4 WHEN 'reference' THEN 3 WHEN 'forum' THEN 2 ELSE 1 END AS w,
  (SELECT sum(tokens) * 600 // 1000 FROM L) AS budget FROM L GROUP BY domain''')},
{_fill_sql("G", "domain", '''SELECT L.domain, L.lang, L.lang AS nm, sum(L.tokens) * 2 AS cap,
  CASE L.lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w, any_value(T.budget) AS budget
  FROM L JOIN T USING (domain) GROUP BY L.domain, L.lang''')},
{_fill_sql("S", "domain, lang", '''SELECT L.domain, L.lang, L.source, L.source AS nm, L.tokens * 2 AS cap, 1 AS w, L.tokens,
  G.budget FROM L JOIN G USING (domain, lang)''')},
E AS (SELECT D.*, S.budget, CASE WHEN tokens > 0 THEN S.budget // tokens ELSE 0 END AS epoch,
  CASE WHEN tokens > 0 THEN S.budget % tokens ELSE -1 END AS rest FROM D JOIN S USING (domain, lang, source)),
P AS (SELECT *, sum(n) OVER (PARTITION BY domain, lang, source ORDER BY {_H60.format(e="epoch")}, doc_id
  ROWS UNBOUNDED PRECEDING) AS upto FROM E)
SELECT doc_id, domain, lang, source, n AS n_tokens, budget AS leaf_budget,
  CAST(epoch + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM P""")
def op3(spark, d):
    from locuspark.llm.mixing import mix_plan
    return mix_plan(table(spark, d, "documents"), domain(), mix_target()).drop("epoch", "h", "k")


@query("op13_license_scan")
def op13(spark, d):
    from locuspark.llm.license_scan import license_scan
    return license_scan(table(spark, d, "documents")).drop("detections")


_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"


@query("op11_spelling_variants", rf"""
WITH RECURSIVE T AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, x: {_CRC_STEP}) AS v FROM (SELECT unnest(range(0, 256)) AS i))),
R AS (SELECT id, run, count(*) AS n FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
      unnest(regexp_extract_all({_LOWER.format(x="coalesce(text, '')")}, '[a-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
H AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || run, ''),
        lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, (unicode(x) - 64)::BIGINT] END))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM R, T),
W AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 97 = 0
        THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM H)
      WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
V AS (SELECT DISTINCT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS v
      FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM W)),
N AS (SELECT a.word, b.word AS near FROM V a JOIN V b ON a.v = b.v AND a.p = b.p AND a.word <> b.word
      UNION SELECT V.word, W.word FROM V JOIN W ON V.v = W.word UNION SELECT W.word, V.word FROM V JOIN W ON V.v = W.word),
B AS (SELECT N.word, count(*) AS n_near, list(near ORDER BY W.n DESC, encode(near))[1] AS near, max(W.n) AS near_n
      FROM N JOIN W ON N.near = W.word GROUP BY N.word),
F AS (SELECT W.word, W.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * W.n THEN near END AS form,
             CASE WHEN near_n >= 2 * W.n THEN near_n END AS form_n FROM W LEFT JOIN B USING (word)),
U AS (SELECT word, word AS root FROM F UNION ALL SELECT U.word, F.form FROM U JOIN F ON U.root = F.word WHERE F.form IS NOT NULL)
SELECT F.word, F.form, U.root, F.n, F.n_near, F.form_n FROM F JOIN U USING (word)
WHERE U.root IN (SELECT word FROM F WHERE form IS NULL)""")
def op11(spark, d):
    from locuspark.llm.spelling import spelling_variants
    return spelling_variants(table(spark, d, "documents"))


@query("op12_token_alignment")
def op12(spark, d):
    from locuspark.llm.alignment import align
    return align(table(spark, d, "documents"))
