"""The registered queries of the operators: name -> f(spark, sf_dir), and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    align, ann, bpe, chat, collocations, decontaminate, html_extract, jaccard, pieces,
    quality, token_counts, url_rules, warc)
from tidemark.llm.common import shipped, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def tokenizer(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """(rank file, split pattern) of a public vocabulary."""
    import public_tokenizers
    return public_tokenizers.path(name), public_tokenizers.PATTERN


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = shipped(fn)
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


@register("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of `documents` encoded and decoded; per document the
    token count and the digests of the ids and of the decoded bytes."""
    path, pattern = tokenizer()
    return bpe.round_trip(table(spark, sf_dir, "documents"), "doc_id", "text", path, pattern)


@register("op2_html")
def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


END_OF_DOCUMENT = 50256  # the id that the vocabulary leaves free


@register("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` written as flat token files; every document's token count
    found by scanning them for the end-of-document identifier."""
    path, pattern = tokenizer()
    return token_counts.token_counts(spark, table(spark, sf_dir, "documents"), "doc_id", "text",
                                     path, pattern, END_OF_DOCUMENT)


@register("op4_ann")
def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest found of every vector whose id is divisible by 50."""
    return ann.search(spark, table(spark, sf_dir, "embeddings"), "id % 50 = 0")


@register("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier keeps, with their perplexity
    and the threshold of their language."""
    judged = quality.classify(spark, table(spark, sf_dir, "documents"),
                              table(spark, sf_dir, "labels"))
    return judged.filter("keep").withColumnRenamed("id", "doc_id")


@register("op6_jaccard", sql=r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ')
    ELSE array_to_string(words[i:i + 4], ' ') END AS gram
  FROM w, unnest(range(1, greatest(len(words) - 4, 1) + 1)) t(i) WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (gram)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
reach(doc, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT l.y, r.other FROM reach r JOIN links l ON l.x = r.doc),
c AS (SELECT doc, min(other) AS component_id FROM reach GROUP BY doc)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d JOIN c ON c.doc = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
""")
def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of `documents` that share 80 % of their 5-word shingles."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


# A user and an assistant row that say control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@register("op7_chat", sql="""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(role) + length(text)
    + list_sum(list_transform(['\\', '<s>', '</s>', '[INST]', '[/INST]'], lambda w:
        (length(role) - length(replace(role, w, ''))) / length(w)
        + (length(text) - length(replace(text, w, ''))) / length(w))) AS chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(chars + 7 + 8 + 4))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""")
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that says control strings, formatted and
    read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string")
    return chat.digest_conversations(rows.unionByName(control))


@register("op8_decontaminate")
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of `documents` within the edit budget of a `benchmark` item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark"))


@register("op9_warc", sql="""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha1(coalesce(html, '')) AS hex,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages),
d AS (
  SELECT *, list_aggregate(list_transform(range(0, 32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(hex, (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31)
        + 1, 1)), 'string_agg', '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d
""")
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page in ZIP packages, read back by ranges."""
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@register("op10_url_rules", sql="""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rule_host, rule_path, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT s.*, rule_host || rule_path AS rule, v, row_number() OVER (PARTITION BY page_id
    ORDER BY length(rule_host) DESC NULLS LAST, length(rule_path) DESC) AS k
  FROM s LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
""")
def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.apply_rules(spark, table(spark, sf_dir, "pages"), rules)


@register("op11_align")
def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the byte-level and the piece tokens of every
    document, with the corpus-wide counts of the linked id pairs."""
    import public_tokenizers
    return align.score(table(spark, sf_dir, "documents"), "doc_id", "text",
                       *tokenizer("byte_bpe_50k.json"),
                       public_tokenizers.path("piece_bpe_32k.model"))


@register("op12_collocations", sql=r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, 1 AS words, unnest(ws) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)),
    lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1),
    lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w),
f AS MATERIALIZED (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY ALL),
c AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS ws FROM f
  WHERE words > 1 AND f >= 10),
part AS (SELECT lang, phrase AS part, f FROM f WHERE f >= 10),
cut AS (
  SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r,
    (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, words)) AS k FROM c)) c
  JOIN part l ON l.lang = c.lang AND l.part = c.head
  JOIN part r ON r.lang = c.lang AND r.part = c.tail),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase
  ORDER BY score, k) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase
    FROM c WHERE words = 3) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
  AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked
JOIN (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang) USING (lang)
WHERE rank <= 2000
""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best collocations of two and three words."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register("op13_pieces")
def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of `documents` encoded and decoded by the pieces of a
    SentencePiece model; per document the token count and both digests."""
    import public_tokenizers
    return pieces.round_trip(table(spark, sf_dir, "documents"), "doc_id", "text",
                             public_tokenizers.path("piece_bpe_32k.model"))
