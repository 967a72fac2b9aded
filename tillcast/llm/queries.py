"""Registered queries of the subpackage and their DuckDB SQL, as far as SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import bpe, decontaminate, exact, fim, language, linkgraph, merkle, simhash, substring, suffix, toxicity, vptree, wrapper
from tillcast.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return wrap


@register("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return simhash.simhash_groups(docs, keep_text=False).select("doc_id", "near_copies.fingerprint", "near_copies.component_id")


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS size,
              array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT row_no, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
       FROM (SELECT row_no, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT dw.row_no, dw.size, dw.i, bw.item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.gram = bw.gram),
covered AS (SELECT row_no, count(DISTINCT p) AS n_hit
            FROM (SELECT row_no, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT row_no, size, i FROM hits)) GROUP BY row_no),
items AS (SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT row_no, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY row_no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (row_no) LEFT JOIN items USING (row_no)
"""


@register("op6_decontaminate", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    found = decontaminate.find_contamination(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))
    c = "contamination"
    return found.select("doc_id", f"{c}.n_words", f"{c}.n_hit", F.size(f"{c}.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(f"{c}.items", ","), 256).alias("items_sha256"), f"{c}.contaminated")


@register("op1_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    coded = bpe.encode_and_decode(docs, path)
    return coded.select("doc_id", (F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("coded.ids", 256).alias("ids_sha256"), F.sha2("coded.decoded", 256).alias("decoded_sha256"))


@register("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    scored = toxicity.classify(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


@register("op8_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    found = language.identify(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"),
                        F.col("prediction.lang").alias("lang_pred"), F.col("prediction.score").alias("score"))


OP10_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 100 = 0),
d AS (SELECT q.vec_id AS query_id, v.vec_id AS vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1),
             lambda i: (q.e[i] - v.e[i]) * (q.e[i] - v.e[i])), lambda a, b: a + b)) AS score
      FROM q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@register("op10_vptree", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return vptree.search(vectors.filter("vec_id % 100 = 0"), vectors, k=10)


_RULE_SQL = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p} {kind}'"
    for kind, h, p in sorted(linkgraph.RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])))
OP9_SQL = rf"""
WITH RECURSIVE u AS (SELECT page_id, coalesce(html, '') AS html,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT *, CASE {_RULE_SQL} END AS found FROM u),
p AS (SELECT *, split_part(found, ' ', 1) AS rule, split_part(found, ' ', 2) AS own FROM r),
seeds AS (SELECT host, avg(CASE WHEN own = 'allow' THEN 1.0 ELSE 0.0 END) AS good, avg(CASE WHEN own = 'block' THEN 1.0 ELSE 0.0 END) AS bad
          FROM p WHERE host <> '' GROUP BY host),
links AS (SELECT host AS src, translate(regexp_extract(link, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
          FROM (SELECT host, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']?([a-z][a-z0-9+.\-]*://[^"''\s>]*)', 1)) AS link FROM p)),
edges AS (SELECT src, dst, CAST(count(*) AS DOUBLE) AS n FROM links WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
w AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS forward, n / sum(n) OVER (PARTITION BY dst) AS back FROM edges),
base AS (SELECT host, sum(good) AS good, sum(bad) AS bad FROM (SELECT * FROM seeds UNION ALL SELECT src, 0, 0 FROM w UNION ALL SELECT dst, 0, 0 FROM w) GROUP BY host),
m AS (SELECT host AS a, host AS b, 0.0 AS f, 0.0 AS g, {1 - linkgraph.DAMPING} * good AS c, {1 - linkgraph.DAMPING} * bad AS d FROM base
      UNION ALL SELECT src, dst, {linkgraph.DAMPING} * forward, 0.0, 0.0, 0.0 FROM w
      UNION ALL SELECT dst, src, 0.0, {linkgraph.DAMPING} * back, 0.0, 0.0 FROM w),
it AS (SELECT 0 AS k, host, CAST(good AS DOUBLE) AS trust, CAST(bad AS DOUBLE) AS distrust FROM base
       UNION ALL
       SELECT k + 1, b, CAST(sum(trust * f + c) AS DOUBLE), CAST(sum(distrust * g + d) AS DOUBLE) FROM it JOIN m ON it.host = m.a
       WHERE k < {linkgraph.ITERATIONS} GROUP BY k, b)
SELECT page_id, p.host AS host, path, rule, coalesce(own, CASE WHEN distrust > {linkgraph.RATIO} * trust THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN (SELECT * FROM it WHERE k = {linkgraph.ITERATIONS}) t ON p.host = t.host
"""


@register("op9_linkgraph", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = linkgraph.judge(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return judged.select("page_id", *[f"url_verdict.{c}" for c in ("host", "path", "rule", "verdict")])


@register("op7_wrapper")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrapper.extract(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


@register("op3_substring")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring.remove_repeats(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return done.select("doc_id", F.col("repeats.removed").alias("n_removed"), F.col("repeats.runs").alias("n_spans"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"), F.col("repeats.kept_in").alias("kept_in"))


@register("op2_suffix")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix.remove_repeats(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return done.select("doc_id", "unique.n_bytes", "unique.n_removed", "unique.n_spans", F.sha2("unique.kept", 256).alias("kept_sha256"))


# output: <P>prefix<S>suffix<M>middle or <S>suffix<P>prefix<M>middle; the restored text is cut out of it again
OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(h, k, 8) AS BIGINT)) AS h FROM d),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                  WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
o AS (SELECT *, CASE form WHEN 'plain' THEN t
                          WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
                          ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END AS output FROM c),
r AS (SELECT *, string_split_regex(output, '<[PSM]>') AS p FROM o)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output WHEN 'psm' THEN p[2] || p[4] || p[3] ELSE p[3] || p[4] || p[2] END) AS restored_sha256
FROM r
"""


@register("op11_fim", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fim.fill_in_middle(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), keep_text=False)
    return done.select("doc_id", *[f"fim.{c}" for c in ("n", "form", "prefix_chars", "middle_chars")],
                       F.sha2("fim.output", 256).alias("output_sha256"), F.sha2(fim.restore(F.col("fim.output"), F.col("fim.form")), 256).alias("restored_sha256"))


OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""


@register("op12_exact", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    docs = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return exact.exact_groups(docs, keep_text=False).select("doc_id", "copies.keep_id", "copies.group_size", "copies.kept", "text_sha256")


def _tree_sql(name: str, source: str, groups: str) -> str:
    """Levels of the trees over ``source`` (grp, i, h, n): ``name`` (k, grp, i, h, n)."""
    return f"""{name} AS (SELECT 0 AS k, {groups} AS grp, i, h, n FROM {source}
      UNION ALL SELECT k + 1, grp, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY k, grp, i // 2, n)"""


def _path_sql(name: str, source: str, levels: str) -> str:
    """Folds ``source`` (row_no, grp, i, n, f, proof) up the trees ``levels``, sibling by sibling."""
    return f"""{name} AS (SELECT 0 AS k, row_no, grp, i, n, f, proof FROM {source}
      UNION ALL SELECT p.k + 1, p.row_no, p.grp, p.i // 2, (p.n + 1) // 2,
             CASE WHEN s.h IS NULL THEN sha256(p.f) WHEN p.i % 2 = 0 THEN sha256(p.f || s.h) ELSE sha256(s.h || p.f) END, p.proof || coalesce(s.h, '')
      FROM {name} p LEFT JOIN {levels} s ON s.k = p.k AND s.grp = p.grp AND s.i = xor(p.i, 1) WHERE p.n > 1)"""


def _leaf_sql(fields: list[str]) -> str:
    return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END" for c in fields) + ")"


# CRC-32 of the decimal id, bit by bit: each character enters once, then eight shifts
_CRC_SQL = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    flatten(list_transform(range(1, length(id_text) + 1), lambda k: [CAST(ascii(substr(id_text, k, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))))"""
OP13_SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row_no, doc_id, source, lang, n_chars, text,
        coalesce('=' || lang, '') AS grp, CAST(doc_id AS VARCHAR) AS id_text FROM documents),
e AS (SELECT row_no, doc_id, grp, {_leaf_sql(["doc_id", "source", "lang", "n_chars", "text"])} AS h,
             {_leaf_sql(["doc_id", "source", "lang", "(n_chars + 1)", "text"])} AS tampered,
             coalesce({_CRC_SQL} % 7 = 0, false) AS hit FROM d),
leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY grp) AS n FROM e),
{_tree_sql("low", "leaves", "grp")},
subs AS (SELECT grp AS of, h, row_number() OVER (ORDER BY grp) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
{_tree_sql("high", "subs", "''")},
start AS (SELECT row_no, grp, i, n, CASE WHEN hit THEN tampered ELSE h END AS f, '' AS proof FROM leaves),
{_path_sql("lower_path", "start", "low")},
middle AS (SELECT row_no, '' AS grp, s.i, s.n, f, proof FROM lower_path JOIN subs s ON s.of = grp WHERE lower_path.n = 1),
{_path_sql("upper_path", "middle", "high")}
SELECT doc_id, leaves.h AS leaf, subs.h AS subroot, high.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = high.h AS verified
FROM leaves JOIN subs ON subs.of = leaves.grp JOIN high ON high.n = 1 JOIN upper_path u ON u.row_no = leaves.row_no AND u.n = 1
"""


@register("op13_merkle", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = read_table(spark, sf_dir, "documents", fields)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    shown = [F.when(hit, F.col(c) + 1).otherwise(F.col(c)) if c == "n_chars" else F.col(c) for c in fields]
    made = merkle.manifest(docs.withColumn("shown_leaf", merkle.leaf(shown)), fields, keep=["doc_id", "shown_leaf"])
    m = "merkle"
    folded = merkle.fold(F.col("shown_leaf"), F.col(f"{m}.witness"))
    return (made.select("doc_id", f"{m}.leaf", f"{m}.subroot", f"{m}.root", F.sha2(merkle.siblings(F.col(f"{m}.witness")), 256).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root")))
