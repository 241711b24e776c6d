"""The operators and the pipeline as named queries over the test tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelcast.llm import embedding_dedup, exact_dedup, line_dedup, packing, prefix_trie, quality, role_repair, secrets, sentencepiece_bpe, simhash, token_files, url_filters, warc
from panelcast.llm.common import table, text_session
from panelcast.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Vocabulary files; each operator takes another path as a parameter.
WORD_BPE, PIECE_BPE, BYTE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(text_session(spark), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def _sql_rules() -> str:
    """Every rule as a row, the way a reader without an index would try them: all on all URLs."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = [(quoted(r.text), quoted(r.verdict), quoted(url_filters.host_regex(r)), "true", str(len(r.text))) for r in url_filters.HOST_RULES]
    rows += [(quoted(r.text), quoted(r.verdict), quoted(url_filters.pattern_regex(r)), "false", str(len(r.text))) for r in url_filters.PATTERN_RULES]
    return ", ".join("(" + ", ".join(r) + ")" for r in rows)


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URL_SQL = f"""
WITH rules(rule, says, regex, by_host, size) AS (VALUES {_sql_rules()}),
u AS (SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url, instr(coalesce(url, ''), '://') AS pos FROM pages),
s AS (SELECT *, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM u),
p AS (SELECT *, {LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s),
h AS (SELECT r, rule, says FROM (SELECT r, rule, says, row_number() OVER (PARTITION BY r ORDER BY size DESC, rule) AS k
  FROM p JOIN rules ON by_host AND regexp_matches(host || path, regex)) WHERE k = 1),
m AS (SELECT r, min(says) AS says, min(says || chr(0) || lpad(CAST(1000 - size AS VARCHAR), 4, '0') || rule) AS best
  FROM p JOIN rules ON NOT by_host AND regexp_matches({LOWER.format("url")}, regex) GROUP BY r)
SELECT page_id, host, path, h.rule AS rule, coalesce(h.says, m.says, 'allow') AS verdict,
  CASE WHEN h.rule IS NULL THEN substr(m.best, length(m.says) + 6) END AS pattern
FROM p LEFT JOIN h USING (r) LEFT JOIN m USING (r)"""


@query("op1_url_filters", URL_SQL)
def _(spark, sf):
    return url_filters.judge_urls(table(spark, sf, "pages"), "page_id")


@query("op2_best_fit_packing")
def _(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), vocabulary(WORD_BPE))


LINE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, {LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
g AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3),
j AS (SELECT k.*, g.key IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN g USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM j GROUP BY r, doc_id"""


@query("op3_line_dedup", LINE_SQL)
def _(spark, sf):
    out = line_dedup.dedup_lines(table(spark, sf, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op4_simhash")
def _(spark, sf):
    return simhash.simhash_groups(table(spark, sf, "documents"))


@query("op5_quality_classifier")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf, "labels")))


@query("op6_sentencepiece")
def _(spark, sf):
    return sentencepiece_bpe.encode_documents(table(spark, sf, "documents"), vocabulary(PIECE_BPE))


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY html)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, true AS intact FROM p LEFT JOIN f USING (html)"""


@query("op7_warc", WARC_SQL)
def _(spark, sf):
    path = shared_dir(spark, "warc")
    warc.write_archives(table(spark, sf, "pages"), path)
    return warc.records(warc.read_archives(spark, path))


@query("op8_embedding_dedup")
def _(spark, sf):
    return embedding_dedup.near_vectors(table(spark, sf, "embeddings"))


EXACT_SQL = f"""
WITH d AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)"""


@query("op9_exact_dedup", EXACT_SQL)
def _(spark, sf):
    return exact_dedup.exact_groups(table(spark, sf, "documents")).drop("row")


@query("op10_secret_scans")
def _(spark, sf):
    return secrets.scan(table(spark, sf, "documents"))


@query("op11_prefix_trie")
def _(spark, sf):
    turns, sizes = prefix_trie.numbered(table(spark, sf, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(turns, sizes), sizes)


@query("op12_token_files")
def _(spark, sf):
    path = shared_dir(spark, "tokens")
    token_files.write_tokens(table(spark, sf, "documents"), path, vocabulary(BYTE_BPE))
    return token_files.documents(token_files.read_tokens(spark, path))


@query("op13_role_repair")
def _(spark, sf):
    return role_repair.repair(role_repair.damaged(table(spark, sf, "conversations")), gone_col="gone")


@query("pipeline")
def _(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)
