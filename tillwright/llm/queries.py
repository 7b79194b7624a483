"""One registered query per operator, over its whole table with production settings."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tillwright.llm import (
    contamination, divergence, language, licenses, lines, near_copies, pieces, quality, ranking,
    secrets, token_counts, toxicity, urls,
)
from tillwright.llm.common import read_table
from tillwright.registry.entry import Query


def _op1(spark, sf_dir):
    found = contamination.find_passages(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    hit = contamination.n_hit()
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        contamination.items_digest().alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
_OP1_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS words FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark
  WHERE item_id IS NOT NULL
), sized AS (
  SELECT item, words, least(10, len(words)) AS size FROM items WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item, size, array_to_string(words[pos : pos + size - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS pos FROM sized)
), grams AS (
  SELECT row_id, pos, size, array_to_string(words[pos : pos + size - 1], ' ') AS gram
  FROM (SELECT row_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
        FROM docs CROSS JOIN (SELECT DISTINCT size FROM sized) WHERE len(words) >= size)
), hits AS (
  SELECT row_id, pos, size, item FROM grams JOIN windows USING (size, gram)
), hit_words AS (
  SELECT row_id, count(DISTINCT place) AS n_hit
  FROM (SELECT row_id, unnest(range(pos, pos + size)) AS place FROM hits) GROUP BY row_id
), hit_items AS (
  SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT row_id, item FROM hits) GROUP BY row_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit_words USING (row_id) LEFT JOIN hit_items USING (row_id)
"""


def _op2(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out()))
    found = language.predict(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def _op3(spark, sf_dir):
    found = licenses.find_licenses(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join("licenses", ",").alias("licenses"),
    )


_LETTERS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"
_TEMPLATES = ", ".join(
    "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.TEMPLATES
)
_OP3_SQL = f"""
WITH templates AS (
  SELECT row_number() OVER () AS template, license, {_LETTERS} AS words
  FROM (VALUES {_TEMPLATES}) v(license, text)
), shingles AS (
  SELECT DISTINCT template, license, array_to_string(words[pos : pos + 4], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - 3)) AS pos FROM templates)
), sizes AS (
  SELECT template, license, count(*) AS size,
         CAST(pow(2, ceil(log2(count(*)))) AS BIGINT) AS stride
  FROM shingles GROUP BY template, license
), docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, {_LETTERS} AS words FROM documents
), hits AS (
  SELECT row_id, template, gram, pos - 1 AS place
  FROM (SELECT row_id, pos, array_to_string(words[pos : pos + 4], ' ') AS gram
        FROM (SELECT *, unnest(range(1, len(words) - 3)) AS pos FROM docs))
  JOIN shingles USING (gram)
), windows AS (
  SELECT row_id, template, part, count(DISTINCT gram) AS held
  FROM (SELECT row_id, template, gram, unnest([place // stride, place // stride - 1]) AS part
        FROM hits JOIN sizes USING (template))
  GROUP BY row_id, template, part
), stated AS (
  SELECT DISTINCT row_id, license FROM windows JOIN sizes USING (template)
  WHERE held >= 0.8 * size
)
SELECT doc_id, count(license) AS n_licenses,
       coalesce(string_agg(license, ',' ORDER BY license), '') AS licenses
FROM docs LEFT JOIN stated USING (row_id) GROUP BY row_id, doc_id
"""


def _op4(spark, sf_dir):
    found = lines.report(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", F.size("gone").cast("long").alias("n_removed"), "n_near",
        F.array_join(F.col("gone").cast("array<string>"), ",").alias("removed"),
    )


def _op5(spark, sf_dir):
    return token_counts.token_counts(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def _op6(spark, sf_dir):
    vocabulary = pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.summarize(read_table(spark, sf_dir, "documents"), vocabulary)


def _op7(spark, sf_dir):
    found = quality.judged(
        read_table(spark, sf_dir, "documents"), keep=["doc_id", "lang", "source"]
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("row.doc_id", *[f"counts.{c}" for c in counts], "base_failed", "kept")


def _op8(spark, sf_dir):
    found = near_copies.near_copies(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _op9(spark, sf_dir):
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        secrets.n_of(secrets.ASSIGN).alias("n_assign"),
        secrets.n_of(secrets.ACCESS).alias("n_access"),
        secrets.n_of(secrets.HEX).alias("n_hex"),
        F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


# The rules that pages are judged by (fixed values).
PAGE_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


def _op10(spark, sf_dir):
    return urls.judge(read_table(spark, sf_dir, "pages"), PAGE_RULES)


_RULES = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in PAGE_RULES)
_LINK = r"""regexp_extract(list_filter(regexp_extract_all(html, '(?is)<{tag}\b[^>]*'),
  lambda t: regexp_matches(t, '(?is)\b{mark}'))[1], '(?is)\b{target}([^"''\s>]+)', 1)"""
_CANONICAL = _LINK.format(tag="link", mark=r"""rel\s*=\s*["'']?canonical\b""",
                          target=r"""href\s*=\s*["'']?""")
_REFRESH = _LINK.format(tag="meta", mark=r"""http-equiv\s*=\s*["'']?refresh\b""",
                        target=r"""url\s*=\s*["'']?""")
_OP10_SQL = rf"""
WITH RECURSIVE rules AS (
  SELECT * FROM (VALUES {_RULES}) v(verdict, domain, start)
), links AS (
  SELECT url, unnest([{_CANONICAL}, {_REFRESH}]) AS link FROM pages WHERE url IS NOT NULL
), hops AS (
  SELECT DISTINCT url AS a, CASE
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN link LIKE '//%' THEN scheme || ':' || link
    WHEN link LIKE '/%' THEN scheme || '://' || site || link
    WHEN regexp_matches(link, '^[?#]') THEN scheme || '://' || site || path || link
    ELSE scheme || '://' || site
      || coalesce(nullif(regexp_replace(path, '[^/]*$', ''), ''), '/') || link END AS b
  FROM (SELECT *, regexp_extract(url, '(?s)^(.*?)://', 1) AS scheme,
               regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) AS site,
               regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
        FROM links WHERE link <> '')
), named AS (
  SELECT url FROM pages WHERE url IS NOT NULL UNION SELECT a FROM hops UNION SELECT b FROM hops
), parsed AS (
  SELECT url, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_replace(regexp_replace(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1),
           '(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '', 'g'), '^&', '') AS query
  FROM named
), judged AS (
  SELECT url, host, path, 'page://' || host || regexp_replace(path, '/$', '')
           || CASE WHEN query = '' THEN '' ELSE '?' || query END AS spelling,
         arg_max(domain || start, length(domain || start)) AS rule,
         arg_max(verdict, length(domain || start)) AS decided
  FROM parsed LEFT JOIN rules
    ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start)
  GROUP BY ALL
), edges AS (
  SELECT url AS a, spelling AS b FROM judged UNION SELECT spelling, url FROM judged
  UNION SELECT a, b FROM hops UNION SELECT b, a FROM hops
), reached AS (
  SELECT url, url AS other FROM judged WHERE decided IS NULL
  UNION SELECT r.url, e.b FROM reached r JOIN edges e ON r.other = e.a
), inherited AS (
  SELECT r.url, bool_or(j.decided = 'allow') AS allows
  FROM reached r JOIN judged j ON r.other = j.url WHERE j.decided IS NOT NULL GROUP BY r.url
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN decided IS NOT NULL THEN decided WHEN NOT allows THEN 'block' ELSE 'allow' END
         AS verdict
FROM pages p LEFT JOIN judged j ON p.url = j.url LEFT JOIN inherited i ON p.url = i.url
"""


def _op11(spark, sf_dir):
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    known = labels.where(~toxicity.held_out())
    found = toxicity.score_calibrated(docs, known, toxicity.train(docs, known))
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def _op12(spark, sf_dir):
    return ranking.rank(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


_LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
_OP12_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all({_LOWERED},
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(terms)) AS BIGINT) AS big_l
  FROM docs WHERE len(terms) > 0
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWERED},
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), found AS (
  SELECT row_id, term, count(*) AS tf
  FROM (SELECT row_id, unnest(terms) AS term FROM docs) JOIN (SELECT DISTINCT term FROM asked)
    USING (term) GROUP BY row_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT)
    AS w FROM found, totals GROUP BY term, big_n
), scored AS (
  SELECT item_id, row_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN found USING (term) JOIN (
    SELECT row_id, 100 - 50 + ((50 * CAST(len(terms) AS BIGINT) * big_n) // big_l) AS m
    FROM docs, totals WHERE len(terms) > 0
  ) USING (row_id) GROUP BY item_id, row_id
), ranked AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored JOIN docs USING (row_id) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def _op13(spark, sf_dir):
    return divergence.divergence(read_table(spark, sf_dir, "documents"))


_OP13_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWERED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), words AS (
  SELECT row_id, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term
  HAVING count(DISTINCT row_id) >= 10
), langs AS (
  SELECT lang, CAST(sum(lang_n) AS HUGEINT) AS total, count(*) AS v FROM kept GROUP BY lang
), counted AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term)
  GROUP BY lang, source, term
), cells AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, lang_n,
         sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS group_total
  FROM (SELECT DISTINCT lang, source FROM docs) JOIN kept USING (lang)
  LEFT JOIN counted USING (lang, source, term)
), shares AS (
  SELECT lang, source, term, n,
         CAST(1 + (1000000000::HUGEINT * (n + 2)) // (group_total + 2 * v) AS HUGEINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (lang_n + 2)) // (total + 2 * v) AS HUGEINT) AS q
  FROM cells JOIN langs USING (lang)
), pairs AS (
  SELECT g.lang, g.source, h.source AS item,
         CAST(coalesce(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)), 0) AS BIGINT) AS value
  FROM (SELECT DISTINCT lang, source FROM docs) g
  JOIN (SELECT DISTINCT lang, source FROM docs) h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN shares a ON a.lang = g.lang AND a.source = g.source
  LEFT JOIN shares b ON b.lang = h.lang AND b.source = h.source AND a.term = b.term
  WHERE a.term IS NULL OR b.term IS NOT NULL
  GROUP BY g.lang, g.source, h.source
), used AS (
  SELECT lang, source, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value
  FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs
        UNION ALL SELECT lang, source, 'term', item, value FROM used)
) WHERE part = 'pair' OR rank <= 10
"""


QUERIES = [
    Query("op1_decontamination", _op1, _OP1_SQL),
    Query("op2_language_id", _op2),
    Query("op3_license_scans", _op3, _OP3_SQL),
    Query("op4_line_dedup", _op4),
    Query("op5_token_counts", _op5),
    Query("op6_sentencepiece", _op6),
    Query("op7_quality_rules", _op7),
    Query("op8_simhash_near_dedup", _op8),
    Query("op9_secret_scans", _op9),
    Query("op10_url_filters", _op10, _OP10_SQL),
    Query("op11_toxicity", _op11),
    Query("op12_ranked_search", _op12, _OP12_SQL),
    Query("op13_source_divergence", _op13, _OP13_SQL),
]
