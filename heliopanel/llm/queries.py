"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (byte_bpe, html_extract, merkle, mixing, near_dedup, ngram_join, oracles, orc_tokens, permutation_index,
               phrases, quality, secret_scan, toxicity, warc)
from .common import shared_path, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_html_extract(spark, sf_dir):
    """Main text of every page by the recurrent block labeller."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


@register
def op2_warc_revisits(spark, sf_dir):
    """Every revisit of a crawl of all pages, resolved to the earlier response it confirms."""
    out = warc.resolve_revisits(warc.crawl_of_pages(table(spark, sf_dir, "pages")))
    return out.select("record_id", "url", "canonical_url", "outcome",
                      F.coalesce("response_id", F.lit(-1)).alias("response_id"), "digest",
                      warc.field_text(F.col("fields")).alias("fields"))


_DAY = "'%a, %d %b %Y %H:%M:%S GMT'"
_AT = "(TIMESTAMP '2024-01-01' + to_seconds({}))"
ORACLE["op2_warc_revisits"] = f"""
WITH p AS (SELECT page_id AS id, url, md5(html) AS digest, length(html) AS size,
                  (page_id * 7919) % 2592000 AS second
           FROM pages WHERE page_id IS NOT NULL AND url IS NOT NULL AND html IS NOT NULL),
r AS (SELECT id * 4 AS record_id, 0 AS n, id, url, second, digest, size, digest AS own, substr(digest, 1, 16) AS tag FROM p),
v AS (SELECT id * 4 + n AS record_id, n, id,
             CASE n WHEN 1 THEN url || '#part' WHEN 2 THEN regexp_replace(url, '^https?://', 'HTTPS://www.') ELSE url END AS url,
             second + n * 3600 AS second, CASE WHEN id % 7 = 3 THEN NULL ELSE digest END AS digest, size, digest AS own,
             CASE WHEN id % 7 = 3 THEN 'changed' ELSE substr(digest, 1, 16) END AS tag
      FROM (SELECT *, unnest(range(1, id % 3 + 2)) AS n FROM p) AS t),
a AS (SELECT *, regexp_replace(trim(url), '#.*$', '') AS u, CASE WHEN id % 11 = 5 THEN NULL ELSE tag END AS etag
      FROM (SELECT * FROM r UNION ALL SELECT * FROM v) AS t),
k AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), ':(80|443)?$', ''), '^www[.]', '')
             || regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?]*)', 1), '/+$', '')
             || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS key
      FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(u, '[?](.*)$', 1), '&'),
               lambda x: x <> '' AND NOT regexp_matches(lower(x), '{warc.TRACKING}'))) AS q FROM a) AS t),
w AS (SELECT *, last_value(CASE WHEN n = 0 THEN {{'id': record_id, 'digest': digest, 'etag': etag, 'size': size, 'second': second}} END
                           IGNORE NULLS) OVER (PARTITION BY key ORDER BY second, record_id
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM k),
o AS (SELECT *, CASE WHEN prior IS NULL THEN 'no_response'
                     WHEN etag IS NOT NULL AND prior.etag IS NOT NULL THEN CASE WHEN etag = prior.etag THEN 'resolved' ELSE 'mismatch' END
                     WHEN digest IS NULL THEN 'unverified'
                     WHEN digest = prior.digest THEN 'resolved' ELSE 'mismatch' END AS outcome FROM w WHERE n > 0)
SELECT record_id, url, key AS canonical_url, outcome,
       CASE WHEN outcome = 'resolved' THEN prior.id ELSE -1 END AS response_id,
       CASE WHEN outcome = 'resolved' THEN prior.digest END AS digest,
       CASE WHEN outcome = 'resolved' THEN
         concat('cache-control: max-age=', n * 100, chr(10), 'content-length: ', prior.size, chr(10),
                'content-type: text/html; charset=utf-8', chr(10), 'date: ', strftime({_AT.format('second')}, {_DAY}), chr(10),
                CASE WHEN etag IS NOT NULL THEN concat('etag: ', CASE WHEN n = 2 THEN 'W/' ELSE '' END, '"', etag, '"', chr(10))
                     WHEN prior.etag IS NOT NULL THEN concat('etag: "', prior.etag, '"', chr(10)) ELSE '' END,
                'last-modified: ', strftime({_AT.format('prior.second - 86400')}, {_DAY})) END AS fields
FROM o
"""


@register
def op3_permutation_index(spark, sf_dir):
    """The 20 nearest found of every 20th vector, by pivot inverted files and reranking."""
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


@register
def op4_minhash_dedup(spark, sf_dir):
    """Components of near-duplicate documents by bottom-k sketches, confirmed on full sets."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op5_byte_bpe(spark, sf_dir):
    """Byte-level BPE of every whole document text, encoded and decoded up a tree."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"),
                               public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op6_quality_rules(spark, sf_dir):
    """Base counts and the verdict by adaptive thresholds, per document."""
    return quality.verdicts(table(spark, sf_dir, "documents"))


@register
def op7_temperature_mixing(spark, sf_dir):
    """The training order of all documents under temperature-mixed source weights."""
    return mixing.schedule(table(spark, sf_dir, "documents"))


# The same in SQL: bisection as a recursive query over the sources' shares, block
# permutations by md5 keys.
ORACLE["op7_temperature_mixing"] = f"""
WITH RECURSIVE c AS (
  SELECT doc_id, coalesce(source, '') AS source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens,
         md5(concat('{mixing.SEED}:', coalesce(doc_id::VARCHAR, 'null'))) AS doc_key
  FROM documents),
s AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM c GROUP BY source),
p AS (SELECT source, tokens, tokens::DOUBLE / (SELECT sum(tokens) FROM s) AS p FROM s WHERE tokens > 0),
facts AS (SELECT {mixing.ENTROPY_SHARE} * ln(count(*)) AS target, sum(tokens)::DOUBLE AS budget,
                 -sum(p * ln(p)) AS plain, list(p) AS ps, min(p) AS rare FROM p),
steps AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, 0.0::DOUBLE AS rlo, 1.0::DOUBLE AS rhi
  UNION ALL
  SELECT i + 1,
    CASE WHEN e >= target THEN mid ELSE lo END, CASE WHEN e >= target THEN hi ELSE mid END,
    CASE WHEN r > {mixing.MAX_REPEATS} THEN rmid ELSE rlo END, CASE WHEN r > {mixing.MAX_REPEATS} THEN rhi ELSE rmid END
  FROM (SELECT i, lo, hi, rlo, rhi, mid, rmid, target,
          ln(list_sum(list_transform(ps, lambda x: pow(x, mid))))
            - mid * list_sum(list_transform(ps, lambda x: pow(x, mid) * ln(x)))
                  / list_sum(list_transform(ps, lambda x: pow(x, mid))) AS e,
          pow(rare, rmid - 1.0) / list_sum(list_transform(ps, lambda x: pow(x, rmid))) AS r
        FROM (SELECT *, (lo + hi) / 2 AS mid, (rlo + rhi) / 2 AS rmid FROM steps, facts) AS t
        WHERE i < {mixing.STEPS}) AS u),
a AS (SELECT greatest(CASE WHEN plain >= target THEN 1.0 ELSE lo END,
                      CASE WHEN 1.0 / (rare * len(ps)) <= {mixing.MAX_REPEATS} THEN 0.0 ELSE rhi END) AS a,
             budget, ps FROM steps, facts WHERE i = {mixing.STEPS}),
w AS (SELECT source, pow(p, a) / list_sum(list_transform(ps, lambda x: pow(x, a))) * budget AS want FROM p, a),
q AS (SELECT s.source, s.tokens,
             least({mixing.MAX_BLOCKS}, greatest(1, ceil(s.tokens / {mixing.BLOCK_TOKENS})))::BIGINT AS blocks,
             CASE WHEN s.tokens = 0 THEN 0 ELSE floor(least(want, {mixing.MAX_REPEATS} * s.tokens) + 0.5) END AS quota
      FROM s LEFT JOIN w USING (source)),
n AS (SELECT *, CASE WHEN tokens = 0 THEN 1 ELSE floor(quota / tokens) END::BIGINT AS passes FROM q),
d AS (SELECT c.*, passes, CASE WHEN tokens = 0 THEN 0 ELSE quota - passes * tokens END AS rest,
             (('0x' || substr(doc_key, 25, 8))::BIGINT % blocks) AS block
      FROM c JOIN n USING (source)),
b AS (SELECT source, block, rest, sum(n_tokens) AS in_block,
             md5(concat_ws(':', '{mixing.SEED}', passes::VARCHAR, source, block::VARCHAR)) AS block_key
      FROM d GROUP BY source, block, rest, passes),
f AS (SELECT *, sum(in_block) OVER (PARTITION BY source ORDER BY block_key, block ROWS UNBOUNDED PRECEDING)
                - in_block AS before FROM b),
k AS (SELECT d.*, f.before AS block_before, in_block,
             sum(n_tokens) OVER (PARTITION BY d.source, d.block ORDER BY doc_key RANGE UNBOUNDED PRECEDING)
             - sum(n_tokens) OVER (PARTITION BY d.source, d.block, doc_key) AS doc_before
      FROM d JOIN f USING (source, block)),
copies AS (SELECT *, passes + CASE WHEN rest > 0 AND block_before < rest AND (block_before + in_block < rest
                                   OR doc_before < rest - block_before) THEN 1 ELSE 0 END AS copies FROM k)
SELECT doc_id, source, n_tokens, epoch, block,
       md5(concat_ws(':', '{mixing.SEED}', epoch::VARCHAR, source, block::VARCHAR)) AS block_key, doc_key
FROM (SELECT *, unnest(range(copies)) AS epoch FROM copies) AS t
"""


@register
def op8_orc_tokens(spark, sf_dir):
    """Token ids written as indexed ORC in document order; the result is read from the files."""
    path = shared_path(spark, "orc-tokens")
    orc_tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return orc_tokens.catalogue(spark, path)


@register
def op9_secret_scan(spark, sf_dir):
    """Secrets of every whole document text, by one combined automaton."""
    return secret_scan.digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


@register
def op10_crf_toxicity(spark, sf_dir):
    """Toxicity of every whole document text from the chain's marginals, with toxic spans."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op11_phrase_stripes(spark, sf_dir):
    """Each language's best phrases of two and three words, counted by merged stripes."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLE["op11_phrase_stripes"] = oracles.PHRASES


@register
def op12_merkle_manifest(spark, sf_dir):
    """Merkle manifest of all documents, and every document's proof, some offered with a changed n_chars."""
    return merkle.tampering(table(spark, sf_dir, "documents"))


ORACLE["op12_merkle_manifest"] = oracles.MERKLE


@register
def op13_ngram_jaccard(spark, sf_dir):
    """Components of the documents linked by word 3-gram sets, by a blocked sparse product."""
    return ngram_join.components(table(spark, sf_dir, "documents"))
