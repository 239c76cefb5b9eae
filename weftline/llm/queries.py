"""The registered queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import decontam, deobfuscate, interactions, jaccard, ledger, licenses, linespread, pieces, quality, simhash, turns, urls, wrapper
from weftline.llm.common import Written, remainder, table


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, test item) pair where the document holds the item, with score and overlaps."""
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    shown = [F.round(c, 4).alias(c) for c in ("score", "question_overlap", "answer_overlap")]
    return found.select("doc_id", "item_id", *shown)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of ids and decoded text."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_decode(docs, model).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand on several sites; its text is given by length and digest."""
    cleaned = linespread.remove_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    text = F.coalesce("text", F.lit(""))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.length(text).cast("long").alias("n_chars"), F.md5(text.cast("binary")).alias("text_md5"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *(name for name, _ in licenses.FIELDS))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by its host's wrapper."""
    return wrapper.extract_text(table(spark, sf_dir, "pages"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: list rules, then boosted trees learnt from the labelled part of the hosts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = urls.train(urls.listed_labels(pages))
    judged = urls.judge(pages, model).withColumn("held_out", urls.unlabelled(F.col("host")))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score", "held_out")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, links of 3 bits or fewer."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document after restoring disguised words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = Written(deobfuscate.word_counts(docs))
    model = deobfuscate.fit_language_model(counts.df)
    counts.drop()
    lexicon = deobfuscate.train(docs, table(spark, sf_dir, "labels"), model)
    scored = deobfuscate.score(docs, model, lexicon)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op10_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule measurements of every document, the base rules' verdict and the full policy's."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = ledger.apply_policy(ledger.ledger(docs), ledger.POLICIES[1])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed_rules").bitwiseAND(F.lit(ledger.BASE)) != 0).alias("base_failed"), "kept", "failed_rules",
    )


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For both policies and each of their rules: documents that fail it, and those that it alone rejects, from the ledger's masks."""
    return ledger.ablations(ledger.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in every order, by language: what each step keeps and removes."""
    return interactions.audit(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of distinct 5-word shingles and the smallest id that links of Jaccard 0.8 or more reach."""
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie over all conversations, rebuilt on shared first turns."""
    return turns.conversation_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's result."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_gam, op2_decontamination, op3_sentencepiece, op4_line_spread, op5_license_scan,
        op6_html_extraction, op7_url_filter, op8_simhash, op9_toxicity, op10_rule_ledger, rule_ablations, op11_filter_audit, op12_ngram_jaccard,
        op13_conversation_trie, pipeline,
    )
}

_NOTICE_TOKENS = ",\n    ".join(
    f"('{n.label}', '{t.decode()}', {n.need}, {n.span}, {len(n.tokens)})" for n in licenses.prepare(licenses.NOTICES, {}) for t in n.tokens
)
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op5_license_scan": f"""
WITH tok(label, token, need, span, size) AS (VALUES
    {_NOTICE_TOKENS}
), d AS (SELECT doc_id, {_LOWER} AS t FROM documents),
a AS (SELECT doc_id, generate_subscripts(ws, 1) - 1 AS i, unnest(ws) AS w FROM (SELECT doc_id, regexp_extract_all(t, '{_WORD}') AS ws FROM d)),
n AS (SELECT doc_id, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM a WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
b AS (
  SELECT doc_id, i, CASE WHEN w = 'mit' AND w1 = 'license' THEN 'mit' WHEN w = 'apache' AND w1 = 'license' THEN 'apache'
    WHEN w = 'general' AND w1 = 'public' AND w2 = 'license' THEN 'gpl' END AS label FROM n
), met AS (SELECT a.doc_id, a.i, tok.* FROM a JOIN tok ON a.w = tok.token),
enough AS (SELECT doc_id, label FROM met GROUP BY doc_id, label HAVING count(DISTINCT token) >= any_value(need)),
own AS (SELECT met.* FROM met JOIN enough ON met.doc_id = enough.doc_id AND met.label = enough.label),
best AS (
  SELECT x.doc_id, x.label, x.i, count(DISTINCT y.token) AS held, any_value(x.need) AS need, any_value(x.size) AS size
  FROM own x JOIN own y ON x.doc_id = y.doc_id AND x.label = y.label AND y.i BETWEEN x.i AND x.i + x.span - 1
  GROUP BY x.doc_id, x.label, x.i
), notices AS (SELECT doc_id, label, max(CAST(held AS DOUBLE) / size) AS share FROM best WHERE held >= need GROUP BY doc_id, label),
every AS (SELECT doc_id, label FROM b WHERE label IS NOT NULL UNION SELECT doc_id, label FROM notices),
counts AS (SELECT doc_id, count(*) AS n FROM a GROUP BY doc_id),
base AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM b WHERE label IS NOT NULL GROUP BY doc_id),
labelled AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM every GROUP BY doc_id),
shares AS (SELECT doc_id, max(share) AS share FROM notices GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(counts.n, 0) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base, CAST(base.lo AS BIGINT) AS first_word,
       CAST(base.hi AS BIGINT) AS last_word, coalesce(base.labels, '') AS base_labels, coalesce(labelled.labels, '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(shares.share, 0.0) END AS score
FROM d LEFT JOIN counts ON d.doc_id = counts.doc_id LEFT JOIN base ON d.doc_id = base.doc_id
LEFT JOIN labelled ON d.doc_id = labelled.doc_id LEFT JOIN shares ON d.doc_id = shares.doc_id""",
    "op4_line_spread": r"""
WITH lines AS (
  SELECT doc_id, source, text, coalesce(string_split(text, chr(10)), []::VARCHAR[]) AS l FROM documents
), rows AS (
  SELECT doc_id, coalesce(source, '') AS source, lower(trim(regexp_replace(unnest(l), '\s+', ' ', 'g'))) AS k FROM lines
), common AS (
  SELECT k, min(doc_id) AS first FROM rows WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= 3
), drops AS (
  SELECT r.doc_id, list(DISTINCT r.k) AS d FROM rows r JOIN common c ON r.k = c.k AND r.doc_id <> c.first GROUP BY r.doc_id
), cut AS (
  SELECT x.doc_id, x.l, list_transform(x.l, lambda y: lower(trim(regexp_replace(y, '\s+', ' ', 'g')))) AS n,
         coalesce(d.d, []::VARCHAR[]) AS d
  FROM lines x LEFT JOIN drops d ON x.doc_id = d.doc_id
), kept AS (
  SELECT doc_id, len(list_filter(n, lambda y: y <> '')) AS n_lines, len(list_filter(n, lambda y: list_contains(d, y))) AS n_removed,
         coalesce(array_to_string(list_filter(l, lambda y: NOT list_contains(d, lower(trim(regexp_replace(y, '\s+', ' ', 'g'))))), chr(10)), '') AS t
  FROM cut
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed,
       CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS text_md5
FROM kept""",
    "op10_rule_ledger": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word
  FROM (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)
), win AS (
  SELECT doc_id, i, word, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, b, c) AS n FROM win WHERE c IS NOT NULL) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id
), runs AS (
  SELECT doc_id, max(n) AS n FROM (
    SELECT doc_id, count(*) AS n FROM (SELECT doc_id, word, i - row_number() OVER (PARTITION BY doc_id, word ORDER BY i) AS g FROM w) GROUP BY doc_id, word, g
  ) GROUP BY doc_id
), sums AS (SELECT doc_id, count(*) AS n, sum(length(word)) AS chars FROM w GROUP BY doc_id),
l AS (
  SELECT doc_id, t, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS x FROM d
), m AS (
  SELECT l.doc_id, coalesce(s.n, 0) AS n_words, coalesce(s.chars, 0) AS word_chars, length(regexp_replace(l.t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l.x) - len(list_distinct(l.x)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(l.x) AS n_lines, coalesce(r.n, 0) AS max_run
  FROM l LEFT JOIN sums s ON l.doc_id = s.doc_id LEFT JOIN covered c ON l.doc_id = c.doc_id LEFT JOIN runs r ON l.doc_id = r.doc_id
), f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * n_symbols > 25 * n_words AND n_symbols > 10 THEN 4 ELSE 0 END) + (CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END) + (CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 60 * n_lines THEN 32 ELSE 0 END)
    + (CASE WHEN max_run >= 12 THEN 64 ELSE 0 END) AS failed FROM m
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, failed = 0 AS kept, CAST(failed AS BIGINT) AS failed_rules
FROM f""",
}

_CELLS = ", ".join(
    f"('{p.version}', '{r.name}', {p.mask}, {1 << b})" for p in ledger.POLICIES for b, r in enumerate(ledger.RULES) if p.mask >> b & 1
)
ORACLE_SQL["rule_ablations"] = f"""
WITH judged AS ({ORACLE_SQL["op10_rule_ledger"]}), cells(version, rule, mask, b) AS (VALUES {_CELLS})
SELECT version, rule, CAST(count(*) FILTER (WHERE (failed_rules & b) <> 0) AS BIGINT) AS fails,
       CAST(count(*) FILTER (WHERE (failed_rules & mask) = b) AS BIGINT) AS only_by
FROM cells LEFT JOIN judged ON true GROUP BY version, rule"""


ORACLE_SQL["op11_filter_audit"] = r"""
WITH l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
first AS (SELECT t, min(doc_id) AS id FROM d GROUP BY t),
w AS (SELECT d.*, first.id, regexp_extract_all(d.t, '[^\x20\x09-\x0D]+') AS ws FROM d JOIN first ON d.t = first.t),
f AS (
  SELECT part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d, coalesce(w.doc_id > id, false) AS e
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
), m AS (
  SELECT part, good, toxic, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
         CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails FROM f
), x(v) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
  SELECT concat(p.v, q.v, r.v, s.v, u.v) AS filter_order FROM x p JOIN x q ON q.v <> p.v JOIN x r ON r.v NOT IN (p.v, q.v)
  JOIN x s ON s.v NOT IN (p.v, q.v, r.v) JOIN x u ON u.v NOT IN (p.v, q.v, r.v, s.v)
), st AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
k AS (
  SELECT filter_order, step, substr(filter_order, CAST(step AS INT), 1) AS own, left(filter_order, CAST(step AS INT) - 1) AS before FROM st
), cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails),
j AS (
  SELECT part, filter_order, CAST(step AS INT) AS step, own, n, good, toxic, fails, contains(fails, own) AS hit,
         length(fails) <> length(translate(fails, before, '')) AS gone FROM cells JOIN k ON true
), s AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept, sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM j GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM s"""

_CRC32 = """list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS UBIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda u: CAST(0 AS UBIGINT))), lambda z, u: xor(z >> 1, CAST(3988292384 AS UBIGINT) * (z & 1))))"""
ORACLE_SQL["op13_conversation_trie"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, strlen(coalesce(text, '')) AS b,
         sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS tok FROM conversations WHERE conv_id IS NOT NULL
), o AS (SELECT conv_id, tok, b, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, tok) AS i FROM t),
c AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
e AS (SELECT conv_id, n, conv_id - conv_id % 5 AS base, CAST(xor({_CRC32}, CAST(4294967295 AS UBIGINT)) % 9 AS BIGINT) AS h FROM c),
x AS (SELECT e.*, coalesce(p.n, 0) AS nb FROM e LEFT JOIN c p ON e.base = p.conv_id),
re AS (
  SELECT x.conv_id, o.i AS d, o.tok, o.b FROM x JOIN o ON o.conv_id = x.base AND o.i <= x.h
  UNION ALL SELECT x.conv_id, least(x.h, x.nb) + o.i - x.h, o.tok, o.b FROM x JOIN o ON o.conv_id = x.conv_id AND o.i > x.h
), s AS (
  SELECT x.conv_id, coalesce(list(re.tok ORDER BY re.d) FILTER (WHERE re.tok IS NOT NULL), []) AS toks, coalesce(list(re.b ORDER BY re.d) FILTER (WHERE re.tok IS NOT NULL), []) AS bytes
  FROM x LEFT JOIN re ON x.conv_id = re.conv_id GROUP BY x.conv_id
), p AS (SELECT conv_id, toks, bytes, unnest(range(0, len(toks) + 1)) AS d FROM s),
m AS (
  SELECT d, toks[1:d] AS path, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(bytes[d]), 0) AS own,
         coalesce(string_agg(CASE WHEN len(toks) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
  FROM p GROUP BY d, toks[1:d]
), k AS (SELECT path[1:d - 1] AS path, count(*) AS n FROM m WHERE d > 0 GROUP BY ALL),
a AS (
  SELECT m.d, m.path, m.conv_id, m.n_convs, m.ends, coalesce(k.n, 0) AS n_children, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf, (m.n_convs - 1) * m.own AS saved
  FROM m LEFT JOIN k ON m.path = k.path
), u AS (SELECT path[1:z] AS path, sum(leaf) AS n_leaves, sum(saved) AS saved FROM (SELECT path, leaf, saved, unnest(range(0, d + 1)) AS z FROM a) GROUP BY ALL)
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(a.n_convs AS BIGINT) AS n_convs, CAST(a.n_children AS BIGINT) AS n_children,
       CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM a JOIN u ON a.path = u.path LEFT JOIN a up ON a.d > 0 AND up.path = a.path[1:a.d - 1]"""

ORACLE_SQL["op12_ngram_jaccard"] = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM g),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), l AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT g.doc_id, CAST(len(g.s) AS BIGINT) AS n_shingles, least(g.doc_id, coalesce(c.y, g.doc_id)) AS component_id FROM g LEFT JOIN c ON g.doc_id = c.x"""
