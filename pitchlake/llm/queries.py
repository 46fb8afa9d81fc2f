"""The driver's queries over this subpackage, and their SQL where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.session import table

from . import fingerprints, jaccard, langid, merkle, mixing, packing, prefix_trie, quality, repeats, secret_scan, simhash, tokens, urls


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.cut_repeats(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return cut.select("doc_id", *repeats.digests(), spans.alias("spans"), "kept")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), replica_col="replica")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_sets(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(merkle.build(table(spark, sf_dir, "documents"), claims=merkle.tampered()))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_token_counts, op3_language_id, op4_suffix_dedup, op5_best_fit_packing, op6_mix_sources, op7_quality_rules,
    op8_fingerprints, op9_simhash, op10_url_filter, op11_ngram_jaccard, op12_prefix_trie, op13_merkle_manifest)}

ORACLE: dict[str, str] = {}

ORACLE["op6_mix_sources"] = """
WITH RECURSIVE sources AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, CAST(1 AS DOUBLE) / (SELECT count(*) FROM sources) * (SELECT count(*) FROM documents) / n AS rate FROM sources),
terms(source, rate, k, p, c) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM terms WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
sums AS (SELECT source, list(c) AS cs FROM terms GROUP BY source),
drawn AS (
  SELECT d.*, len(list_filter(cs, lambda c: c <= CAST('0x' || substr(md5('42:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
                                             / CAST(4503599627370496 AS DOUBLE))) AS copies
  FROM documents d JOIN sums ON d.source IS NOT DISTINCT FROM sums.source)
SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(copies)) AS INTEGER) AS replica FROM drawn
"""

# ids are unique there; the operator orders equal ids by a hash that SQL lacks
ORACLE["op8_fingerprints"] = """
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS t,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS nx
  FROM documents),
texts AS (
  SELECT doc_id, t AS t0, left(t, length(t) - length(t) // 4) || left(nx, length(t) // 4) AS t1, nx AS t2 FROM ordered),
kinds AS (
  SELECT doc_id, 0 AS kind, t0 AS t FROM texts UNION ALL SELECT doc_id, 1, t1 FROM texts UNION ALL SELECT doc_id, 2, t2 FROM texts),
phrases AS (
  SELECT doc_id, kind, t, list_transform(string_split(t, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)),
    lambda p: list_transform(regexp_extract_all(p, '[^.,;:!?|]{1,64}[.,;:!?|]*|[.,;:!?|]+'), lambda x: md5(x)))) AS leaves
  FROM kinds),
paragraphs AS (
  SELECT *, list_transform(leaves, lambda s: list_transform(s, lambda p: md5(array_to_string(p, '')))) AS pars FROM phrases),
sections AS (SELECT *, list_transform(pars, lambda s: md5(array_to_string(s, ''))) AS secs FROM paragraphs),
trees AS (
  SELECT doc_id, kind, t, pars, md5(array_to_string(secs, '')) AS root,
         list_transform(flatten(flatten(leaves)), lambda x: left(x, 8)) AS short,
         array_to_string([md5(array_to_string(secs, '')), array_to_string(list_transform(secs, lambda x: left(x, 8)), ''),
           array_to_string(list_transform(pars, lambda s: array_to_string(list_transform(s, lambda x: left(x, 8)), '')), ';'),
           array_to_string(list_transform(flatten(flatten(leaves)), lambda x: left(x, 8)), '')], '/') AS print
  FROM sections),
pairs AS (
  SELECT a.*, b.t AS et, b.pars AS epars, b.print AS eprint, b.root AS eroot, b.short AS eshort, c.root AS nroot, c.short AS nshort
  FROM trees a JOIN trees b ON a.doc_id = b.doc_id AND a.kind = 0 AND b.kind = 1 JOIN trees c ON a.doc_id = c.doc_id AND c.kind = 2),
edits AS (
  SELECT *, list_filter(flatten(list_transform(range(greatest(len(pars), len(epars))), lambda s: list_transform(
    range(greatest(coalesce(len(pars[s + 1]), 0), coalesce(len(epars[s + 1]), 0))),
    lambda p: {'s': s, 'p': p, 'd': pars[s + 1][p + 1] IS DISTINCT FROM epars[s + 1][p + 1]}))), lambda x: x.d) AS changed
  FROM pairs)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(et) AS edited_sha256, print AS fingerprint, eprint AS edited_fingerprint,
       CASE WHEN root = eroot THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(short, eshort))
         / greatest(len(list_distinct(short)) + len(list_distinct(eshort)), 1) END AS near_edited,
       CASE WHEN root = nroot THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(short, nshort))
         / greatest(len(list_distinct(short)) + len(list_distinct(nshort)), 1) END AS near_next,
       CAST(len(changed) AS BIGINT) AS edited_paragraphs,
       CASE WHEN len(changed) > 0 THEN changed[1].s || '.' || changed[1].p END AS first_edit
FROM edits
"""


def _crc32(digits: str) -> str:
    """SQL for the unsigned crc32 of a number's decimal digits."""
    step = (f"CASE WHEN (CASE WHEN k % 8 = 0 THEN xor(a, ascii({digits}[CAST(k // 8 + 1 AS INTEGER)])) ELSE a END) & 1 = 1"
            f" THEN xor((CASE WHEN k % 8 = 0 THEN xor(a, ascii({digits}[CAST(k // 8 + 1 AS INTEGER)])) ELSE a END) >> 1, 3988292384)"
            f" ELSE (CASE WHEN k % 8 = 0 THEN xor(a, ascii({digits}[CAST(k // 8 + 1 AS INTEGER)])) ELSE a END) >> 1 END")
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), range(8 * length({digits}))), lambda a, k: {step}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


ORACLE["op13_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g, {_leaf("n_chars")} AS leaf,
         CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS claim
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
nodes(g, lvl, pos, digest, n) AS (
  SELECT g, 0, pos, leaf, count(*) OVER (PARTITION BY g) FROM placed
  UNION ALL
  SELECT g, lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY g, lvl, pos // 2, n),
subroots AS (SELECT g, digest, row_number() OVER (ORDER BY g) - 1 AS pos FROM nodes WHERE n = 1),
heads(lvl, pos, digest, n) AS (
  SELECT 0, pos, digest, count(*) OVER () FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM heads WHERE n > 1 GROUP BY lvl, pos // 2, n),
steps AS (
  SELECT p.g, p.pos, 0 AS tree, v.lvl, xor(p.pos >> v.lvl, 1) < p.pos >> v.lvl AS on_left, s.digest
  FROM placed p JOIN (SELECT DISTINCT g, lvl FROM nodes WHERE n > 1) v USING (g)
  LEFT JOIN nodes s ON s.g = p.g AND s.lvl = v.lvl AND s.pos = xor(p.pos >> v.lvl, 1)
  UNION ALL
  SELECT p.g, p.pos, 1, v.lvl, xor(r.pos >> v.lvl, 1) < r.pos >> v.lvl, s.digest
  FROM placed p JOIN subroots r USING (g) CROSS JOIN (SELECT DISTINCT lvl FROM heads WHERE n > 1) v
  LEFT JOIN heads s ON s.lvl = v.lvl AND s.pos = xor(r.pos >> v.lvl, 1)),
ways AS (SELECT g, pos, list({{'l': on_left, 'd': digest}} ORDER BY tree, lvl) AS way FROM steps GROUP BY g, pos),
climbed(g, pos, k, way, digest) AS (
  SELECT p.g, p.pos, 0, coalesce(w.way, []), p.claim FROM placed p LEFT JOIN ways w ON p.g = w.g AND p.pos = w.pos
  UNION ALL
  SELECT g, pos, k + 1, way, CASE WHEN way[k + 1].d IS NULL THEN sha256(digest) WHEN way[k + 1].l THEN sha256(way[k + 1].d || digest)
                                  ELSE sha256(digest || way[k + 1].d) END
  FROM climbed WHERE k < len(way))
SELECT p.doc_id, p.leaf, s.digest AS subroot, h.digest AS root, sha256(array_to_string(list_transform(c.way, lambda x: x.d), '')) AS proof_sha256,
       c.digest AS folded_root, c.digest = h.digest AS verified
FROM placed p JOIN subroots s USING (g) CROSS JOIN (SELECT digest FROM heads WHERE n = 1) h
JOIN climbed c ON c.g = p.g AND c.pos = p.pos AND c.k = len(c.way)
"""

ORACLE["op11_ngram_jaccard"] = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))) END AS s
  FROM words),
grams AS (SELECT r, len(s) AS n, unnest(s) AS g FROM sets),
meets AS (SELECT a.r AS a, b.r AS b, count(*) AS k, any_value(a.n) AS na, any_value(b.n) AS nb FROM grams a JOIN grams b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2),
links AS (SELECT a, b FROM meets WHERE 100 * k >= 85 * (na + nb - k)),
reached(r, b) AS (SELECT r, r FROM sets UNION SELECT reached.r, links.b FROM reached JOIN links ON links.a = reached.b)
SELECT any_value(s.doc_id) AS doc_id, CAST(any_value(len(s.s)) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM reached JOIN sets s ON s.r = reached.r JOIN sets o ON o.r = reached.b GROUP BY reached.r
"""

ORACLE["op12_prefix_trie"] = f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS x
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(x ORDER BY k) AS xs, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM turns GROUP BY conv_id),
built AS (SELECT a.conv_id, list_concat(coalesce(b.xs[1 : a.h], []), a.xs[a.h + 1 :]) AS xs FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
prefixes AS (SELECT conv_id, len(xs) AS n, xs, unnest(range(len(xs) + 1)) AS depth FROM built),
nodes AS (
  SELECT depth, xs[1 : depth] AS p, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, xs[1 : depth]),
priced AS (SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(p[depth].text) END AS saved FROM nodes),
family AS (SELECT c.depth, c.p, q.conv_id AS parent_conv_id FROM nodes c JOIN nodes q ON q.depth = c.depth - 1 AND q.p = c.p[1 : c.depth - 1]),
kids AS (SELECT depth - 1 AS depth, p[1 : depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
known AS (
  SELECT v.*, f.parent_conv_id, coalesce(k.n_children, 0) AS n_children
  FROM priced v LEFT JOIN family f ON f.depth = v.depth AND f.p = v.p LEFT JOIN kids k ON k.depth = v.depth AND k.p = v.p)
SELECT a.conv_id, CAST(a.depth AS BIGINT) AS depth, any_value(a.parent_conv_id) AS parent_conv_id, any_value(a.n_convs) AS n_convs, any_value(a.n_children) AS n_children,
       count(*) FILTER (d.n_children = 0) AS n_leaves, CAST(sum(d.saved) AS BIGINT) AS saved_tokens, any_value(a.ends_sha256) AS ends_sha256
FROM known a JOIN known d ON d.depth >= a.depth AND d.p[1 : a.depth] = a.p GROUP BY a.conv_id, a.depth
"""
