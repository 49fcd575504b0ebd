"""The registered queries of this subpackage: thin wrappers around the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelab.llm import (
    chat,
    decontam,
    html_text,
    langid,
    license,
    merkle,
    mixing,
    ngram_join,
    quality,
    spelling,
    substring,
    urls,
    warc,
)
from tablelab.session import scratch_dir, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn

    return keep


@query("op1_warc", r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT *, octet_length(body) AS payload_bytes, sha1(body) AS hex, sha256(body) AS key FROM p),
d AS (
  SELECT page_id, url, html, key, payload_bytes, list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + (((('0x' || substr(hex, 5 * (i // 4)::INT + 1, 5))::BIGINT) >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)),
    'string_agg', '') AS payload_digest FROM h),
r AS (
  SELECT *, CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = max(page_id) OVER w THEN NULL ELSE max(page_id) OVER w END AS refers_to
  FROM d WINDOW w AS (PARTITION BY key)),
u AS (SELECT *, replace(replace(replace(replace(url, '%0D', '%250D'), '%0A', '%250A'), chr(13), '%0D'), chr(10), '%0A') AS uri, chr(13) || chr(10) AS nl FROM r)
SELECT page_id, payload_bytes, payload_digest, record_type, refers_to,
  sha256('WARC/1.1' || nl || 'WARC-Type: ' || record_type || nl || 'WARC-Record-ID: <urn:x-record:' || coalesce(page_id::VARCHAR, '') || '>' || nl
    || 'WARC-Date: 1970-01-01T00:00:00Z' || nl || coalesce('WARC-Target-URI: ' || uri || nl, '') || 'WARC-Payload-Digest: sha1:' || payload_digest || nl
    || 'X-Payload-SHA256: ' || key || nl || CASE record_type WHEN 'response' THEN 'Content-Type: text/html; charset=utf-8' || nl ELSE
      'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' || nl || 'WARC-Refers-To: <urn:x-record:' || refers_to || '>' || nl END
    || 'Content-Length: ' || CASE record_type WHEN 'response' THEN payload_bytes ELSE 0 END || nl || nl || html || nl || nl) AS record_sha256
FROM u
""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages archived as WARC, read back, and every record rebuilt: its headers with the whole payload."""
    path = scratch_dir(spark, "warc")
    warc.write_warc(warc.plan_records(table(spark, sf_dir, "pages")), path)
    back = warc.original_record(warc.restore(warc.read_warc(spark, path)))
    return back.select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"), F.sha2("record", 256).alias("record_sha256"),
    )


_QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, k, w[k:k + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 0) + 1)) AS k FROM d)),
r AS (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, g) > 1 AS twice FROM g),
c AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS x FROM r WHERE twice) GROUP BY doc_id),
f AS (
  SELECT doc_id, lang, source, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, len(lines) AS n_lines FROM d LEFT JOIN c USING (doc_id)),
m AS (
  SELECT doc_id, lang, source, unnest([
    {'measure': 'word_length', 'v': (word_chars * 10000) // n_words}, {'measure': 'symbols', 'v': (n_symbols * 10000) // n_words},
    {'measure': 'dup_lines', 'v': (n_dup_lines * 10000) // n_lines}, {'measure': 'repeat_words', 'v': (n_repeat_words * 10000) // n_words}
  ], recursive := true) FROM f WHERE n_words > 0),
s AS (
  SELECT *, greatest(length(bin(v)) - 6, 0) * 32 + (v >> greatest(length(bin(v)) - 6, 0)) AS step FROM m),
h AS (
  SELECT grouping(source, lang) AS level, lang, source, measure, step, count(*) AS n FROM s
  GROUP BY GROUPING SETS ((lang, source, measure, step), (lang, measure, step), (measure, step))),
u AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY step) AS upto,
    sum(n) OVER (PARTITION BY level, lang, source, measure) AS total FROM h),
q AS (
  SELECT level, lang, source, measure, max(total) AS n, min(step) FILTER (upto >= 0.25 * total) AS s1,
    min(step) FILTER (upto >= 0.5 * total) AS s2, min(step) FILTER (upto >= 0.75 * total) AS s3 FROM u GROUP BY ALL),
v AS (
  SELECT level, lang, source, measure, n, {'q1': (s1 - greatest(s1 // 32 - 1, 0) * 32) << greatest(s1 // 32 - 1, 0),
    'mid': (s2 - greatest(s2 // 32 - 1, 0) * 32) << greatest(s2 // 32 - 1, 0),
    'q3': (s3 - greatest(s3 // 32 - 1, 0) * 32) << greatest(s3 // 32 - 1, 0)} AS q FROM q),
e AS (
  SELECT a.lang, a.source, a.measure, CASE WHEN a.n >= 100 THEN a.q WHEN b.n >= 100 THEN b.q ELSE z.q END AS q,
    CASE a.measure WHEN 'word_length' THEN 15000 WHEN 'symbols' THEN 1000 WHEN 'dup_lines' THEN 4000 ELSE 3000 END AS gap
  FROM v a JOIN v b ON b.level = 2 AND a.lang IS NOT DISTINCT FROM b.lang AND a.measure = b.measure
  JOIN v z ON z.level = 3 AND a.measure = z.measure WHERE a.level = 0),
o AS (
  SELECT doc_id, bool_and(s.v <= greatest(q.q3 + 4 * (q.q3 - q.q1), q.mid + gap)
    AND (s.measure <> 'word_length' OR s.v >= least(q.q1 - 4 * (q.q3 - q.q1), q.mid - gap))) AS ok
  FROM s JOIN e ON s.lang IS NOT DISTINCT FROM e.lang AND s.source IS NOT DISTINCT FROM e.source AND s.measure = e.measure GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce(ok, false) AS kept
FROM f LEFT JOIN o USING (doc_id)
"""


@query("op2_quality", _QUALITY_SQL)
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the adaptive verdict; features are counted once and kept as a table."""
    path = scratch_dir(spark, "features")
    docs = table(spark, sf_dir, "documents")
    docs.select("doc_id", "lang", "source", quality.features(F.col("text")).alias("f")).write.parquet(path)
    judged = quality.judge(spark.read.parquet(path))
    return judged.select(
        "doc_id", *[f"f.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed", "kept",
    )


@query("op3_mixing", r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight FROM d GROUP BY source),
f AS (
  SELECT *, 3 * source_size AS cap, (3 * source_size) / weight AS fill,
    sum(source_size) OVER ()::BIGINT AS total, sum(weight) OVER ()::BIGINT AS weights FROM s),
l AS (
  SELECT *, ((total - sum(cap) OVER w + cap)::BIGINT / (weights - sum(weight) OVER w + weight)::BIGINT) AS level,
    row_number() OVER w AS k
  FROM f WINDOW w AS (ORDER BY fill, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
m AS (SELECT min({'k': k, 'level': level}) FILTER (level <= fill) AS first FROM l),
t AS (
  SELECT source, source_size, CASE WHEN first IS NULL OR k < first.k THEN cap::DOUBLE
    ELSE least(first.level * weight, cap::DOUBLE) END AS target FROM l, m),
r AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
""")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their source's target and the words the mix takes of them."""
    planned = mixing.plan_mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.copies") * F.col("mix.size")).alias("taken")
    )


@query("op4_substring", r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 12, 0) + 1)) AS i FROM d),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h FROM s),
r AS (SELECT doc_id, i, doc_id > min(doc_id) OVER (PARTITION BY h) AS again FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM r WHERE again),
gone AS (SELECT doc_id, list(i) AS pos FROM c GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(pos), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN pos IS NULL THEN w ELSE
    list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(pos, j)), lambda j: w[j]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
""")
def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that repeat an earlier document's window of 13 words, removed from all documents."""
    marked = substring.mark_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select(
        "doc_id", "n_words", substring.n_removed(F.col("removed")).alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


@query("op10_ngram_join", r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
r AS (SELECT g, count(*) AS df FROM s GROUP BY g),
o AS (SELECT doc_id, g, n, df, row_number() OVER (PARTITION BY doc_id ORDER BY df, g) AS pos FROM s JOIN r USING (g) JOIN n USING (doc_id)),
p AS MATERIALIZED (SELECT doc_id, g, n FROM o WHERE df > 1 AND pos <= n - ceil(0.9::DECIMAL(2,1) * n) + 1),
c AS MATERIALIZED (
  SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb FROM p x JOIN p y ON x.g = y.g AND x.doc_id < y.doc_id
  WHERE 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)),
l AS MATERIALIZED (
  SELECT a, b FROM (SELECT a, b, na, nb, count(*) AS i FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.g = x.g GROUP BY ALL)
  WHERE 100 * i >= 90 * (na + nb - i)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
t AS (SELECT a, b FROM e UNION SELECT t.a, e.b FROM t JOIN e ON t.b = e.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM t GROUP BY a) USING (doc_id)
""")
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked by Jaccard similarity of 0.9 on 3-word shingles."""
    classes = ngram_join.link_classes(table(spark, sf_dir, "documents"))
    return classes.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query("op6_decontam", r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []::VARCHAR[]) AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
b AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[k:k + 12], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
z AS (SELECT DISTINCT size FROM b),
p AS (SELECT doc_id, w, size, unnest(range(1, greatest(len(w) - size + 1, 0) + 1)) AS k FROM w, z),
h AS (SELECT doc_id, item_id, k, p.size FROM p JOIN b ON p.size = b.size AND array_to_string(w[k:k + p.size - 1], ' ') = g),
c AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(k, k + size)) AS x FROM h) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(w) AS contaminated
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
""")
def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all windows of the benchmark."""
    found = decontam.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontam.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


@query("op7_langid")
def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by a network fitted on those that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(F.col("doc_id").isNotNull() & ~out))
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query("op9_license")
def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and fuzzy notices in all documents."""
    found = license.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[f"license.{c}" for c in ("n_words", "n_base", "first_word", "last_word")],
        license.joined_labels(F.col("license.base_labels")).alias("base_labels"),
        license.joined_labels(F.col("license.labels")).alias("labels"), "license.score",
        F.to_json("license.spans").alias("spans"),
    )


@query("op5_html")
def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    found = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op8_chat")
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns of all conversations, repaired and rendered."""
    done = chat.format_chats(table(spark, sf_dir, "conversations"))
    return done.select(
        F.col("conv").alias("conv_id"), "turn", "role", "new_role", "action", F.array_join("inserted", ",").alias("inserted"),
        F.array_join("closed_by", ",").alias("closed_by"), "piece", "cost",
    )


#: Unsigned crc32 of bytes given as a list of numbers, in SQL: eight shifts for each byte.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {bytes}), lambda c, b:
    list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


@query("op11_urls", r"""
WITH r(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
m AS (
  SELECT u.*, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY page_id, u.host, u.path ORDER BY length(r.host) DESC, length(r.path) DESC) AS k
  FROM u LEFT JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
""")
def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages' urls against the contract's rules; a url without a rule is allowed."""
    rules = urls.rules_table(spark, urls.EXAMPLE_RULES)
    judged = urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", *[f"judged.{c}" for c in ("host", "path", "rule", "verdict")])


@query("op12_spelling", r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents) GROUP BY ALL),
h AS (
  SELECT run, n, CRC AS h FROM (
    SELECT run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c:
      CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS b
    FROM runs WHERE length(run) >= 7)),
v AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (
  SELECT x.word, x.n, y.word AS other, y.n AS m FROM cuts x JOIN cuts y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT x.word, x.n, y.word, y.n FROM cuts x JOIN v y ON x.a || x.z = y.word
  UNION SELECT y.word, y.n, x.word, x.n FROM cuts x JOIN v y ON x.a || x.z = y.word),
best AS (
  SELECT word, n, count(*) AS n_near, max(m) AS m, min(other) FILTER (m = top) AS other
  FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM pairs) GROUP BY ALL),
forms AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * v.n THEN other END AS form, CASE WHEN m >= 10 * v.n THEN m END AS form_n
  FROM v LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS here, 0 AS k FROM forms
  UNION ALL SELECT w.word, f.form, k + 1 FROM walk w JOIN forms f ON f.word = w.here WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM forms f JOIN (SELECT word, arg_max(here, k) AS root FROM walk GROUP BY word) w USING (word)
""".replace("CRC", _CRC.format(bytes="b")).replace("\u00C0-\u00FF", "À-ÿ"))
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = spelling.vocabulary(docs, misspell=spelling.drop_a_letter)
    return spelling.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def _encoded(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::VARCHAR))::VARCHAR || ':' || {column}::VARCHAR, '-')"


_LOWER_TEXT = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LEAF = " || ".join(_encoded(c) for c in merkle.FIELDS)


@query("op13_merkle", f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, sha256({_LEAF}) AS leaf, sha256({_LEAF.replace('text::VARCHAR', _LOWER_TEXT)}) AS low,
    string_split(doc_id::VARCHAR, '') AS digits FROM documents),
c AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, leaf, CASE WHEN {_CRC.format(bytes="list_transform(digits, lambda x: unicode(x)::BIGINT)")} % 3 = 0
    THEN low ELSE leaf END AS seen FROM d),
l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM c),
t AS (
  SELECT g, 0 AS level, pos, n, leaf AS h FROM l
  UNION ALL SELECT g, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY ALL),
s AS MATERIALIZED (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM s
  UNION ALL SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY ALL),
runs AS MATERIALIZED (
  SELECT g, level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM t WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT NULL, level, pos // 8, list(h ORDER BY pos) FROM u WHERE n > 1 GROUP BY ALL),
w AS (
  SELECT doc_id, leaf, g, 0 AS level, pos, seen AS cur, '' AS proof, false AS crowned FROM l
  UNION ALL (
    SELECT w.doc_id, w.leaf, w.g, CASE WHEN r.run IS NULL THEN 0 ELSE w.level + 1 END,
      CASE WHEN r.run IS NULL THEN s.pos ELSE w.pos // 8 END,
      CASE WHEN r.run IS NULL THEN cur ELSE sha256(array_to_string(hs[1:w.pos % 8] || [cur] || hs[w.pos % 8 + 2:], '')) END,
      CASE WHEN r.run IS NULL THEN proof ELSE proof || array_to_string(hs[1:w.pos % 8] || hs[w.pos % 8 + 2:], '') END,
      crowned OR r.run IS NULL
    FROM w LEFT JOIN runs r ON r.level = w.level AND r.run = w.pos // 8 AND r.g IS NOT DISTINCT FROM CASE WHEN crowned THEN NULL ELSE w.g END
    JOIN s ON s.g = w.g WHERE NOT (crowned AND r.run IS NULL))),
f AS (SELECT * FROM w WHERE crowned QUALIFY row_number() OVER (PARTITION BY g, doc_id, leaf ORDER BY level DESC) = 1)
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = h AS verified
FROM f JOIN s USING (g) JOIN u ON u.n = 1
""")
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, checked against a copy with some texts lower-cased."""
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = merkle.manifest(docs, altered={"text": merkle.lower_ascii(F.col("text"))}, where=third)
    return merkle.verify(rows).select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
