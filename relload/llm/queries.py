"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relload.llm import ann, decontam, divergence, fim, langid, licenses, lm, mixing, repeats, shard, simhash, toxicity, urls
from relload.llm.common import held_out

URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
SHARDS = 16
TOXIC_AT = 0.3
ENTROPY_SHARE = 0.95


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page."""
    return urls.judge(_table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs, ~held_out(F.col("doc_id")))
    out = langid.predict(docs.select("doc_id", "text"), model, "text", "lang_pred", "score", "rejected")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal row counts that each match the source mixture."""
    out = shard.assign(_table(spark, sf_dir, "documents"), SHARDS)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the bytes of repeated 200-byte strings."""
    out = repeats.strip_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate license block of every document with its confirmed template."""
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op8_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every verified overlap of a document with a benchmark item."""
    found = decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "shift", "window", "matched")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from labels that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    out = toxicity.score(docs, model, "text", "score", "patterns")
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"), "patterns"
    )


def op10_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uses of every document when sources are flattened to 95 % of the largest entropy, within the corpus's tokens."""
    return mixing.mix(_table(spark, sf_dir, "documents"), entropy_share=ENTROPY_SHARE)


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base and n-gram score of every document; one document in five is held out of the training."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    return lm.train_and_score(_table(spark, sf_dir, "documents"), held)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every pair of sources of a language, and the ten terms that mark each source."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's fill-in-the-middle output."""
    out = fim.fill_in_middle(_table(spark, sf_dir, "documents"))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES = {
    f.__name__: f
    for f in (
        op1_hilbert_neighbours, op2_simhash_components, op3_url_filter, op4_language, op5_shards, op6_repeated_passages,
        op7_licenses, op8_contamination, op9_toxicity, op10_temperature_mix, op11_language_model, op12_divergence, op13_fill_in_middle,
    )
}


ORACLES = {
    # exact search: the operator's recall is measured against it in the tests
    "op3_url_filter": r"""
WITH RECURSIVE rules(verdict, host, path, len) AS (
  SELECT *, length(column1) + length(column2) FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) v(column0, column1, column2)
), p AS (
  SELECT page_id, html, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^#]*)', 1) AS rest
  FROM pages
), t AS (
  SELECT host, path, rest, regexp_replace(tag, '^<[A-Za-z]+', '') AS inside, regexp_matches(tag, '(?i)^<link') AS is_link
  FROM (SELECT host, path, rest, unnest(regexp_extract_all(html, '@MARKUP@')) AS tag FROM p WHERE host <> '')
  WHERE regexp_matches(tag, '(?i)^<(link|meta)[\s/]') AND ends_with(tag, '>')
), v AS (
  SELECT *, list_transform(regexp_extract_all(inside, '@ATTRIBUTE@', 1), lambda x: lower(x)) AS names,
    list_transform(regexp_extract_all(inside, '@ATTRIBUTE@', 2), lambda x: CASE WHEN regexp_matches(x, '^["'']') THEN x[2:-2] ELSE coalesce(x, '') END) AS vals FROM t
), w AS (
  SELECT host, path, rest, is_link, CASE WHEN is_link THEN vals[list_position(names, 'href')] ELSE vals[list_position(names, 'content')] END AS val FROM v
  WHERE CASE WHEN is_link THEN list_contains(regexp_split_to_array(lower(vals[list_position(names, 'rel')]), '\s+'), 'canonical')
    ELSE trim(lower(vals[list_position(names, 'http-equiv')])) = 'refresh' END
), c AS (
  SELECT * EXCLUDE (val), array_to_string(list_transform(
    regexp_extract_all(val, '(?s)(&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*[;=]?|[^&]+|&)'),
    lambda x: CASE WHEN starts_with(x, '&#') AND length(x) > 2 THEN (
        CASE WHEN length(regexp_extract(x, '^&#[xX]?0*([0-9a-fA-F]*);?$', 1)) NOT BETWEEN 1 AND 7 THEN chr(65533)
          WHEN (CASE WHEN x[3] IN ('x', 'X') THEN '0x' ELSE '' END || regexp_extract(x, '^&#[xX]?0*([0-9a-fA-F]*);?$', 1))::BIGINT BETWEEN 55296 AND 57343
            OR (CASE WHEN x[3] IN ('x', 'X') THEN '0x' ELSE '' END || regexp_extract(x, '^&#[xX]?0*([0-9a-fA-F]*);?$', 1))::BIGINT > 1114111 THEN chr(65533)
          ELSE chr((CASE WHEN x[3] IN ('x', 'X') THEN '0x' ELSE '' END || regexp_extract(x, '^&#[xX]?0*([0-9a-fA-F]*);?$', 1))::INT) END)
      WHEN starts_with(x, '&') THEN coalesce(named[x], x) ELSE x END), '') AS val
  FROM w, (SELECT @NAMES@ AS named)
), g AS (
  SELECT host, path, rest, trim(regexp_replace(CASE WHEN is_link THEN val WHEN regexp_extract(val, '@REFRESH_URL@', 1) <> '' THEN regexp_extract(val, '@REFRESH_URL@', 1)
    WHEN regexp_extract(val, '@REFRESH_BARE@', 1) NOT ILIKE 'url%' THEN regexp_extract(val, '@REFRESH_BARE@', 1) END, '[\t\r\n]', '', 'g')) AS target FROM c
), f AS (
  SELECT host || rest AS a, CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target WHEN starts_with(target, '//') THEN 'http:' || target
    WHEN starts_with(target, '/') THEN 'http://' || host || target WHEN starts_with(target, '?') THEN 'http://' || host || path || target
    WHEN starts_with(target, '#') OR regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    ELSE 'http://' || host || CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END || target END AS goal
  FROM g WHERE target <> ''
), h AS (
  SELECT a, translate(regexp_extract(goal, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS gh,
    regexp_extract(goal, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS gp, regexp_extract(goal, '(?s)^.*?://[^?#]*(\?[^#]*)', 1) AS gq FROM f WHERE goal IS NOT NULL
), d AS (
  SELECT a, gh || gp || gq AS raw, gh || CASE WHEN regexp_matches(gp, '(?i)/(\.|%2e){1,2}(/|$)') THEN array_to_string(
      list_reduce(list_transform(string_split(gp, '/'), lambda s: [s]), lambda done, s: CASE WHEN regexp_matches(s[1], '(?i)^(\.|%2e)$') THEN done
        WHEN regexp_matches(s[1], '(?i)^(\.|%2e){2}$') THEN CASE WHEN len(done) > 1 THEN done[:len(done) - 1] ELSE done END ELSE list_concat(done, s) END, []::VARCHAR[])
      || CASE WHEN regexp_matches(gp, '(?i)/(\.|%2e){1,2}$') THEN [''] ELSE []::VARCHAR[] END, '/') ELSE gp END || gq AS b FROM h WHERE gh <> ''
), e AS (SELECT a, b FROM d UNION SELECT raw, b FROM d),
sym AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
nodes AS (SELECT DISTINCT a AS node, regexp_extract(a, '^([^/?#]*)', 1) AS host, regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path FROM sym),
bad AS (
  SELECT node FROM (SELECT node, arg_max(r.verdict, r.len * 1000 + length(r.host)) AS verdict FROM nodes n JOIN rules r
    ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path) GROUP BY node) WHERE verdict = 'block'
), reach(node) AS (SELECT node FROM bad UNION SELECT sym.b FROM reach JOIN sym ON sym.a = reach.node),
hit AS (
  SELECT host, path, arg_max(rule, rank) AS rule, arg_max(verdict, rank) AS verdict FROM (
    SELECT u.host, u.path, r.host || r.path AS rule, r.verdict, r.len * 1000 + length(r.host) AS rank
    FROM (SELECT DISTINCT host, path FROM p) u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
  GROUP BY host, path
)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, CASE WHEN host || rest IN (SELECT node FROM reach) AND p.host <> '' THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN hit USING (host, path)
""",
    # CRC-32 over the bytes with its table made by rule; places as in the operator
    "op5_shards": r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(9), lambda c, i: CASE WHEN i = 0 THEN c WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n::BIGINT)) AS t
), d AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 AS size, md5('shards:' || coalesce(doc_id::VARCHAR, '')) AS mixed,
    regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS b FROM documents
), c AS (
  SELECT doc_id, source, size, mixed, xor(4294967295, list_reduce(list_transform(b, lambda x: ('0x' || x)::BIGINT), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT)) AS text_crc32
  FROM d, tab
), r AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY mixed, doc_id, size, text_crc32) - 1 AS rank, count(*) OVER (PARTITION BY source) AS n FROM c
), g AS (
  SELECT *, row_number() OVER (ORDER BY (rank * 2 + 1)::DOUBLE / (n * 2)::DOUBLE, source NULLS FIRST, mixed, doc_id, size, text_crc32) - 1 AS place, count(*) OVER () AS total FROM r
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (place * 16 // total)::INT AS shard,
  (place - ((place * 16 // total) * total + 15) // 16)::BIGINT AS slot, NULL::INT AS grown_shard, source FROM g
""",
    "op8_contamination": r"""
WITH items AS (SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\pL\pN]+') AS iw FROM benchmark),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\pL\pN]+') AS w FROM documents),
masks(m, o) AS (VALUES (0, [0, 1, 2, 4, 6, 7]), (1, [0, 1, 4, 5, 6, 7])),
iseed AS (SELECT item_id, iw, pos, m, list_transform(o, lambda x: iw[pos + x + 1]) AS seed FROM (SELECT item_id, iw, unnest(range(len(iw) - 7)) AS pos FROM items WHERE len(iw) >= 8), masks),
dpos AS (SELECT r, unnest(range(len(w) - 7)) AS pos FROM docs WHERE len(w) >= 8),
dword AS (SELECT r, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word FROM docs WHERE len(w) >= 8),
grams AS (SELECT r, pos, list(word) OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS g FROM dword),
dseed AS (SELECT r, pos, m, list_transform(o, lambda x: g[x + 1]) AS seed FROM grams, masks WHERE len(g) = 8),
hits AS (SELECT DISTINCT d.r, i.item_id, i.iw, (d.pos - i.pos)::INT AS shift FROM dseed d JOIN iseed i USING (m, seed)),
met AS (
  SELECT doc_id, item_id, shift, least(13, len(iw))::INT AS win,
    list_transform(range(greatest(0, -shift), least(len(iw), len(w) - shift)), lambda i: (iw[i + 1] = w[i + shift + 1])::INT) AS same
  FROM hits JOIN docs USING (r)
), best AS (
  SELECT doc_id, item_id, shift, win, list_max(list_transform(range(1, len(same) - win + 2), lambda s: list_sum(same[s:s + win - 1])))::INT AS matched FROM met WHERE len(same) >= win
)
SELECT doc_id, item_id, shift, win AS "window", matched FROM best WHERE matched * 5 >= win * 4
""",
    "op10_temperature_mix": r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens FROM documents),
src AS (SELECT source, sum(tokens)::BIGINT AS tokens FROM d GROUP BY source),
share AS (SELECT source, tokens, tokens::DOUBLE / greatest((SELECT sum(tokens) FROM src), 1)::DOUBLE AS share FROM src),
lp AS (SELECT list(ln(share)) AS l, count(*) AS n FROM share WHERE share > 0),
cut(lo, hi) AS (  -- the largest grid point that holds the entropy; 1000001 stands for none above the grid
  SELECT 0, 1000001 UNION ALL
  SELECT CASE WHEN fits THEN mid ELSE lo END, CASE WHEN fits THEN hi ELSE mid END FROM (
    SELECT lo, hi, mid, ln(z) - mid / 1000000.0::DOUBLE * s / z >= 0.95::DOUBLE * ln(n) AS fits FROM (
      SELECT lo, hi, (lo + hi) // 2 AS mid, n, list_sum(list_transform(l, lambda x: exp(((lo + hi) // 2) / 1000000.0::DOUBLE * x))) AS z,
        list_sum(list_transform(l, lambda x: x * exp(((lo + hi) // 2) / 1000000.0::DOUBLE * x))) AS s FROM cut, lp WHERE hi - lo > 1))
), expo AS (SELECT CASE WHEN (SELECT n FROM lp) < 2 THEN 1.0 ELSE max(lo) / 1000000.0 END::DOUBLE AS a FROM cut),
power AS (SELECT *, CASE WHEN share > 0 THEN exp(a * ln(share)) ELSE 0 END AS p FROM share, expo),
quota AS (SELECT source, tokens AS t, floor(p / (SELECT sum(p) FROM power) * (SELECT sum(tokens) FROM src)::DOUBLE * (1 + 1e-12::DOUBLE) + 1e-6::DOUBLE)::BIGINT AS q FROM power),
plan AS (SELECT source, t, CASE WHEN t > 0 THEN q // greatest(t, 1) ELSE 1 END AS blocks, CASE WHEN t > 0 THEN q % greatest(t, 1) ELSE 0 END AS rest FROM quota),
used AS (
  SELECT doc_id, source, tokens, blocks, rest, block, md5('mix:' || block || ':' || coalesce(doc_id::VARCHAR, '')) AS mixed FROM (
    SELECT d.*, blocks, rest, unnest(range(blocks + CASE WHEN rest > 0 THEN 1 ELSE 0 END)) AS block FROM d JOIN plan ON d.source IS NOT DISTINCT FROM plan.source)
), placed AS (
  SELECT *, row_number() OVER w - 1 AS place, sum(tokens) OVER (w ROWS UNBOUNDED PRECEDING) AS used_tokens FROM used
  WINDOW w AS (PARTITION BY source, block ORDER BY mixed, doc_id, tokens)
)
SELECT doc_id, source, tokens, block::BIGINT AS block, place::BIGINT AS place FROM placed WHERE block < blocks OR used_tokens <= rest
""",
    "op12_divergence": r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT lang, source, r, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS m FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
lt AS (SELECT lang, count(*) AS v, sum(m)::HUGEINT AS n FROM k GROUP BY lang),
c AS (SELECT g.lang, g.source, k.term, k.m, coalesce(x.n, 0) AS n FROM g JOIN k ON k.lang = g.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
gt AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY lang, source),
p AS (SELECT c.*, 1 + 1000000000::HUGEINT * (c.n + 2) // (gt.total + 2 * lt.v) AS p, 1 + 1000000000::HUGEINT * (m + 2) // (lt.n + 2 * lt.v) AS q
  FROM c JOIN gt USING (lang, source) JOIN lt USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
  ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM terms) WHERE rank <= 10
""",
    "op13_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT *, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1, n - b) AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM o
""",
}


def _with_url_patterns(sql: str) -> str:
    """``sql`` with the operator's patterns of markup (DuckDB's need no possessive marks) and the names of character references."""
    quoted = lambda x: x.replace("'", "''")
    for name in ("MARKUP", "ATTRIBUTE", "REFRESH_URL", "REFRESH_BARE"):
        sql = sql.replace(f"@{name}@", quoted(getattr(urls, name).replace("++", "+").replace("*+", "*")))
    return sql.replace("@NAMES@", "MAP {" + ", ".join(f"'&{k}': '{quoted(v)}'" for k, v in html5.items()) + "}")


ORACLES["op3_url_filter"] = _with_url_patterns(ORACLES["op3_url_filter"])
