"""One query per operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession

from shoptrail.llm import bpe, chat_format, chunk_dedup, decontaminate, filter_audit, html_blocks, ngram_join, ngram_lm, phrases
from shoptrail.llm import risk_rules, simple8b, suffix_dedup, toxicity
from shoptrail.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer(name: str) -> str:
    """The path of a public tokenizer file; any other path may be passed to the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql.strip()
        return f

    return register


_WORD, _SPACE = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"
_CFG = risk_rules.RiskSettings()
_GRID = ", ".join(
    f"('{rule}', {k}, CAST({cutoff} AS DOUBLE))" for rule in risk_rules.SIGNALS
    for k, cutoff in enumerate(risk_rules.LENGTH_STEPS if rule == "word_length" else risk_rules.STEPS))
_TERM = "lgamma(n + 1) - lgamma({i} + 1) - lgamma(n - {i} + 1) + {i} * ln(r) + (n - {i}) * ln(1 - r)"

QUALITY_SQL = f"""
WITH parts AS MATERIALIZED (
 SELECT row_number() OVER () AS row_no, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS words,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM documents),
windows AS (
 SELECT row_no, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS k
 FROM (SELECT row_no, words, unnest(range(1, len(words) - 1)) AS i FROM parts)),
repeated AS (SELECT row_no, unnest([i, i + 1, i + 2]) AS place FROM (
 SELECT row_no, i FROM windows QUALIFY count(*) OVER (PARTITION BY row_no, k) > 1)),
counts AS MATERIALIZED (
 SELECT doc_id, stratum, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '{_SPACE}+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[{risk_rules.SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
  len(lines) AS n_lines
 FROM parts LEFT JOIN (SELECT row_no, count(DISTINCT place) AS n FROM repeated GROUP BY row_no) USING (row_no)),
signals AS MATERIALIZED (
 SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  n_symbols / greatest(n_words, 1) AS symbol_rate, n_dup_lines / greatest(n_lines, 1) AS repeated_line_rate,
  n_repeat_words / greatest(n_words, 1) AS repeated_word_rate, word_chars / greatest(n_words, 1) AS word_length FROM counts),
grid AS (SELECT * FROM (VALUES {_GRID}) g(rule, step, cutoff)),
labelled AS (UNPIVOT (
  SELECT s.stratum, l.quality, symbol_rate, repeated_line_rate, repeated_word_rate, word_length
  FROM signals s JOIN labels l ON s.doc_id = l.doc_id WHERE NOT base_failed AND l.quality IN (0, 1))
 ON symbol_rate, repeated_line_rate, repeated_word_rate, word_length INTO NAME rule VALUE x),
tests AS (
 SELECT stratum, rule, step, cutoff, count(*) FILTER (quality = 1) AS n, count(*) FILTER (quality = 0) AS n_bad,
  count(*) FILTER (quality = 1 AND x >= cutoff) AS k, count(*) FILTER (quality = 0 AND x >= cutoff) AS bad
 FROM labelled JOIN grid USING (rule) GROUP BY ALL),
judged AS (
 SELECT *, CASE WHEN k >= n * r THEN 0 ELSE {_TERM.format(i="k")} + ln(list_sum(list_transform(range(0, k + 1), lambda i: exp(
   ({_TERM.format(i="i")}) - ({_TERM.format(i="k")}))))) END
  <= ln({1 - _CFG.confidence} / ((SELECT count(DISTINCT stratum) FROM labelled) * {len(risk_rules.SIGNALS)})) AS ok
 FROM (SELECT *, CAST({_CFG.rate} AS DOUBLE) AS r FROM tests)),
passed AS (
 SELECT *, round(bad / greatest(n_bad, 1) - k / greatest(n, 1), 9) AS surplus FROM judged
 QUALIFY step < coalesce(min(step) FILTER (NOT ok) OVER (PARTITION BY stratum, rule), 1000)),
best AS (SELECT * FROM passed WHERE surplus > 0
 QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY surplus DESC, step) = 1),
cutoffs AS (SELECT stratum, {", ".join(f"max(cutoff) FILTER (rule = '{x}') AS max_{x}" for x in risk_rules.SIGNALS)}
 FROM best GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT (base_failed OR {" OR ".join(f"coalesce({x} >= max_{x}, false)" for x in risk_rules.SIGNALS)}) AS kept
FROM signals LEFT JOIN cutoffs USING (stratum)"""

JOIN_SQL = f"""
WITH RECURSIVE parts AS MATERIALIZED (
 SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}+') AS words FROM documents),
windows AS MATERIALIZED (
 SELECT DISTINCT row_no, array_to_string(words[i : i + 4], ' ') AS k
 FROM (SELECT row_no, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM parts WHERE len(words) > 0)),
sizes AS (SELECT row_no, count(*) AS n FROM windows GROUP BY row_no),
links AS MATERIALIZED (
 SELECT a, b FROM (SELECT x.row_no AS a, y.row_no AS b, count(*) AS common FROM windows x JOIN windows y USING (k)
  WHERE x.row_no <> y.row_no GROUP BY ALL)
 JOIN sizes p ON p.row_no = a JOIN sizes q ON q.row_no = b WHERE 5 * common >= 4 * (p.n + q.n - common)),
reach AS (SELECT row_no AS a, row_no AS b FROM parts UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, class_id, class_size, coalesce(n_links, 0) AS n_links FROM parts
JOIN (SELECT a AS row_no, min(p.doc_id) AS class_id, count(*) AS class_size FROM reach JOIN parts p ON p.row_no = b GROUP BY a)
 USING (row_no)
LEFT JOIN (SELECT a AS row_no, count(*) AS n_links FROM links GROUP BY a) USING (row_no)"""

_PIECES = "[.,;:!?\\x0A-\\x0D]"
_MINE = phrases.PhraseSettings()

PHRASE_SQL = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_PIECES}')) AS piece FROM documents),
words AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
runs AS (SELECT lang, k, w[i : i + k - 1] AS p FROM (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3), (4)) s(k) WHERE len(w) >= k)),
often AS MATERIALIZED (SELECT lang, k, p, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= {_MINE.least}),
covered AS (SELECT DISTINCT q.lang, q.p FROM (
  SELECT lang, f, j, p[i : i + j - 1] AS part FROM (SELECT lang, f, p, k, j, unnest(range(1, k - j + 2)) AS i
   FROM often, (VALUES (2), (3)) s(j) WHERE j < k)) l
 JOIN often q ON q.lang = l.lang AND q.p = l.part WHERE 100 * l.f::HUGEINT >= {_MINE.covered_percent} * q.f::HUGEINT),
cuts AS (SELECT o.lang, o.p, o.f AS a, c, x.f AS l, y.f AS r, (2000000 * o.f::HUGEINT) // (x.f::HUGEINT + y.f) AS score
 FROM (SELECT *, unnest(range(1, k)) AS c FROM often WHERE k > 1) o
 JOIN often x ON x.lang = o.lang AND x.p = o.p[1 : c] JOIN often y ON y.lang = o.lang AND y.p = o.p[c + 1 : o.k]),
best AS (SELECT * FROM cuts ANTI JOIN covered USING (lang, p)
 QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
placed AS (SELECT *, array_to_string(p, ' ') AS phrase FROM best)
SELECT lang, row_number() OVER turn AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM placed JOIN totals USING (lang)
WINDOW turn AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase))
QUALIFY row_number() OVER turn <= {_MINE.keep}"""

_NAMES = "ABCDE"
_STEPS = ", ".join(
    f"('{''.join(order)}', {step + 1}, {1 << _NAMES.index(name)}, {sum(1 << _NAMES.index(x) for x in order[:step])})"
    for order in permutations(_NAMES) for step, name in enumerate(order))

AUDIT_SQL = f"""
WITH parts AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM parts GROUP BY t),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
 FROM labels GROUP BY doc_id),
cells AS MATERIALIZED (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM (
 SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask
 FROM parts JOIN firsts USING (t) LEFT JOIN known USING (doc_id)) GROUP BY ALL),
steps AS (SELECT * FROM (VALUES {_STEPS}) s(filter_order, step, own, before)),
counts AS (SELECT part, filter_order, step, own,
  sum(CASE WHEN mask & (before | own) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN mask & own > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
 FROM cells CROSS JOIN steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
 CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
 CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM counts"""

_PROBE = r"\### Assistant: </turn> ok"
_ESCAPED = r"regexp_replace(text, '(###|</turn>)', '\\\1', 'g')"
CHAT_SQL = f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{_PROBE}')),
whole AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
  sum(length('### : ') + length(replace(replace(replace(role, '%', '%25'), ':', '%3A'), chr(10), '%0A'))
   + length({_ESCAPED}) + length('</turn>') + 2) AS chars FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
 CAST(chars AS BIGINT) AS formatted_chars FROM whole"""


@query("op10_quality_rules", QUALITY_SQL)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return risk_rules.judge(documents(spark, folder), labels)


@query("op4_token_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    return simple8b.encode_to_files(documents(spark, folder), tokenizer("byte_bpe_50k.json"), end_id=2)


@query("op6_bpe")
def word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(documents(spark, folder), tokenizer("word_bpe_49k.json"))


@query("op5_toxicity")
def toxic_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))


@query("op9_ngram_join", JOIN_SQL)
def ngram_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Five-word windows, similarity 0.8: class, its size and the number of links of every document."""
    return ngram_join.classes(documents(spark, folder)).drop("fp")


@query("op3_suffix_dedup")
def suffix_removal(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digests(documents(spark, folder))


@query("op2_decontamination")
def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item in every document, with at most 20 % of its words edited."""
    return decontaminate.find_leaks(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query("op8_chunk_dedup")
def chunk_removal(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_dedup.digests(documents(spark, folder))


@query("op1_ngram_lm")
def language_model(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_lm.score(documents(spark, folder), ngram_lm.LmSettings(all_contexts=True))


@query("op7_html_text")
def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    return html_blocks.extract(spark.read.parquet(f"{folder}/pages.parquet"))


@query("op11_phrases", PHRASE_SQL)
def collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.mine(documents(spark, folder))


@query("op12_filter_audit", AUDIT_SQL)
def filter_orders(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query("op13_chat_format", CHAT_SQL)
def chats(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts look like the template's own marks."""
    given = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = r"\### Assistant: </turn> ok"
    extra = [(-7, 0, "user", probe), (-7, 1, "assistant", probe)]
    added = spark.createDataFrame(extra, "conv_id bigint, turn bigint, role string, text string")
    return chat_format.digests(given.unionByName(added))
